import math
import random
import re
from collections import Counter

import numpy as np

from millrace.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _brute(docs, items, k=20):
    counted = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n, words = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in {x for x in items if x[1] is not None}:
        scores = []
        for i, c in counted:
            m = 75 + (25 * c.total() * n) // words
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in TERM.findall(text.translate(LOWER)) if c[t])
            if s > 0:
                scores.append((-s, -1 if i is None else i))
        out += [(item, r + 1, None if i == -1 else i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def _found(spark, docs, items):
    left = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, rank int")
    right = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = lexical.search(left, right)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def _corpus(n=400):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(300)] + ["Éa", "ñu", "A1", "ünï中文"]
    share = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, rng.choice([" ", "-", ", "]).join(rng.choices(words, share, k=rng.choice([1, 3, 30, 200])))) for i in range(n)]
    docs += [(1000 + i, docs[5][1]) for i in range(40)] + [docs[7], (None, docs[8][1]), (2000, None), (2001, ""), (2002, "-- !!"), (2003, "w1 w2 " * 20_000)]
    items = [(i, " ".join(rng.choices(words, share, k=12))) for i in range(25)]
    items += [(100, docs[5][1]), (100, docs[5][1]), (101, None), (102, ""), (103, "nowhere"), (104, "w1"), (104, "w2 w2 W3")]
    return docs, items


def test_against_brute_force(spark):
    docs, items = _corpus()
    assert _found(spark, docs, items) == _brute(docs, items)


def test_blocks_of_items_and_shuffled_candidates(spark, monkeypatch):
    docs, items = _corpus(120)
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 10)
    monkeypatch.setattr(lexical, "BROADCAST_PAIRS", 3)
    assert _found(spark, docs, items) == _brute(docs, items)


def test_empty_tables(spark):
    assert _found(spark, [], [(1, "a")]) == [] == _found(spark, [(1, "a")], [])
    assert _found(spark, [(1, None)], [(1, "a")]) == []


def test_bounds_are_never_too_low_and_exclude_most():
    docs, texts = _corpus()
    counts = [Counter(lexical.terms(t)) for _, t in docs if lexical.terms(t)]
    items = lexical.Items([t for _, t in texts if t])
    df = Counter(items.place[t] for c in counts for t in c if t in items.place)
    items.weigh(len(counts), sum(c.total() for c in counts), df)
    tokens = []
    for c in counts:
        hashes = np.array([lexical.xxhash.xxh3_64_intdigest(t) for t in c], np.uint64)
        times = np.array(list(c.values()))
        tokens.append(np.concatenate([lexical._level_hash(hashes[times >= t], i) for i, t in enumerate(lexical.levels())]))
    seen = 0
    for ids, sizes, width, slices in lexical._blocks(list(range(len(counts))), [c.total() for c in counts], tokens):
        bounds = items.bounds(sizes, width, slices)
        for j, d in enumerate(ids):
            m = lexical.norm(sizes[j], items.docs, items.words)
            exact = np.array([items.score(i, counts[d], m) for i in range(len(items.counts))])
            assert (bounds[:, j] >= exact).all()
            assert bounds[:, j].sum() <= 1.3 * exact.sum() + 2e7
            seen += 1
    assert seen == len(counts)
