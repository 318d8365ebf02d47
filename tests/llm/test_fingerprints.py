import hashlib
import math
import random
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import fingerprints

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _hash(x, seed, size=8):
    return xxhash.xxh64_intdigest((x % 2 ** (8 * size)).to_bytes(size, "little"), seed)


def _gamma(h):
    return 64 * math.log(2) - math.log(((h & 0xFFFFFFFF) + 0.5) * ((h >> 32) + 0.5))


def _samples(text, samples):
    """The least (value, word, t) of each sample, by the definition."""
    out = []
    counts = Counter(WORD.findall(text or ""))
    for j in range(samples if counts else 0):
        values = []
        for word, n in counts.items():
            x = _hash(j, _hash(xxhash.xxh64_intdigest(word.encode(), 42), 42), 4)
            r, c = _gamma(_hash(0, x, 4)), _gamma(_hash(1, x, 4))
            b = (_hash(2, x, 4) >> 11) * 2.0**-53
            t = math.floor(math.log(n) / r + b)
            values.append((c * math.exp(-r * (t + 1 - b)), word, t))
        out.append(min(values))
    return out


def _share(a, b):
    return sum(x[1:] == y[1:] for x, y in zip(a, b, strict=True)) / len(a) if a and b else float(not a and not b)


def _brute(docs, samples):
    ids = sorted({i for i, _ in docs}, key=lambda i: (i is not None, i), reverse=True)
    first = {i: min((t or "") for j, t in docs if j == i) for i in ids}
    out = []
    for i, t in docs:
        t = t or ""
        follower = first[ids[(ids.index(i) + 1) % len(ids)]]
        k = len(t) // 3
        edited = t[: len(t) - k] + follower[:k]
        own, other, after = (_samples(x, samples) for x in (t, edited, follower))
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), _share(own, other), _share(own, after)))
    return sorted(out, key=repr)


def _corpus():
    rng = random.Random(3)
    words = ["a", "b", "the", "naïve", "中文", "x y", "𝒳"] + [f"w{i}" for i in range(60)]
    share = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, rng.choice([" ", "\n", "\t "]).join(rng.choices(words, share, k=rng.choice([1, 2, 9, 60])))) for i in range(60)]
    docs += [(100, docs[3][1]), (101, docs[3][1]), (102, None), (103, ""), (104, " \n "), (None, "no id at all"), (None, "again none")]
    return docs + [docs[4], (7, "another text of seven"), (105, "long " * 30_000 + "end")]


@pytest.mark.parametrize("order_rows", [10, 1_000_000])
def test_against_brute_force(spark, monkeypatch, order_rows):
    monkeypatch.setattr(fingerprints, "ORDER_ROWS", order_rows)
    docs = _corpus()
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, key string")
    got = fingerprints.compare_edited(df, samples=16).cache()
    found = sorted((tuple(r) for r in got.select("doc_id", "n_chars", "edited_sha256", "near_edited", "near_next").collect()), key=repr)
    want = _brute(docs, 16)
    assert [f[:3] for f in found] == [w[:3] for w in want]
    # 16 bits of a sample may agree by chance.
    assert all(abs(f[i] - w[i]) <= 1 / 16 for f, w in zip(found, want, strict=True) for i in (3, 4))
    assert sum(f != w for f, w in zip(found, want, strict=True)) <= 1
    prints = {(r["doc_id"], r["n_chars"]): r["fingerprint"] for r in got.collect()}
    assert prints[(100, len(docs[3][1]))] == prints[(101, len(docs[3][1]))] == prints[(3, len(docs[3][1]))]
    assert prints[(103, 0)] == prints[(102, 0)] == prints[(104, 3)] == ""
    assert {len(p) for p in prints.values()} == {0, 64}


def test_same_text_same_fingerprint_in_any_table(spark):
    docs = _corpus()
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, fingerprint string")
    alone = fingerprints.fingerprint(df, samples=16)
    assert alone.columns == ["doc_id", "text", "fingerprint"] and alone.count() == len(docs)
    left = {(r["doc_id"], r["text"]): r["fingerprint"] for r in alone.collect()}
    beside = fingerprints.compare_edited(df, samples=16).collect()
    assert sorted(map(repr, left.values())) == sorted(map(repr, {(r["doc_id"], r["edited_sha256"], r["n_chars"]): r["fingerprint"] for r in beside}.values()))


def test_collisions_are_the_generalised_jaccard_similarity(spark):
    a = "x " * 8 + "y " * 4 + "z u v w"
    b = "x " * 4 + "y " * 4 + "z u q r s"
    df = spark.createDataFrame([(a, b)], "a string, b string")
    one = fingerprints.fingerprint(df, "a", 1024).withColumnRenamed("fingerprint", "p")
    both = fingerprints.fingerprint(one, "b", 1024).first()
    chunks = [[both[c][i : i + 4] for i in range(0, 4096, 4)] for c in ("p", "fingerprint")]
    share = sum(x == y for x, y in zip(*chunks, strict=True)) / 1024
    left, right = Counter(a.split()), Counter(b.split())
    assert abs(share - (left & right).total() / (left | right).total()) < 0.06


def test_single_document_and_empty_table(spark):
    schema = "doc_id long, text string"
    row = fingerprints.compare_edited(spark.createDataFrame([(5, "abcdef gh")], schema)).first()
    assert (row["n_chars"], row["near_next"], row["edited_sha256"]) == (9, 1.0, hashlib.sha256(b"abcdefabc").hexdigest())
    assert fingerprints.compare_edited(spark.createDataFrame([], schema)).count() == 0
    assert fingerprints.fingerprint(spark.createDataFrame([], schema)).count() == 0


def test_plan_has_no_python_and_moves_no_words(spark):
    docs = spark.createDataFrame([(i, "a b c") for i in range(10)], "doc_id long, text string")
    rows = fingerprints._dealt(docs.withColumn("row", F.col("doc_id")), "doc_id", 4)
    plan = fingerprints._samples(rows, ["text"], 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan and "Arrow" not in plan
