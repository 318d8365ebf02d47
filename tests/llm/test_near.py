import random

import pytest

from millrace.llm import near
from millrace.llm.components import components


def _shingles(text, size):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def _brute(docs, size, percent):
    sets = {}
    for i, text in docs:
        sets.setdefault(i, []).append(_shingles(text, size))
    parent = {i: i for i in sets if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in parent:
        for b in parent:
            if a < b and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                lo, hi = sorted((root(a), root(b)))
                parent[hi] = lo
    return {i: root(i) for i in parent}


def _corpus():
    rng = random.Random(5)
    word = lambda: "w" + str(rng.randrange(3000))
    docs, i = [], 0
    for family in range(12):
        base = [word() for _ in range(rng.choice([3, 20, 60, 150]))]
        for _ in range(rng.choice([1, 4, 12])):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                text[rng.randrange(len(text))] = word()
            docs.append((i, " ".join(text).upper() if i % 3 else "\t".join(text)))
            i += 1
    # A chain: neighbours are similar, the ends aren't.
    base = [word() for _ in range(120)]
    for step in range(10):
        base[step * 11] = word()
        docs.append((i, " ".join(base)))
        i += 1
    docs += [(i, None), (i + 1, ""), (i + 2, " \n"), (i + 3, "one"), (i + 4, "ONE"), (i + 5, "a b"), (i + 6, "a b"), (3, docs[0][1])]
    return docs


def test_components_against_brute_force(spark):
    docs = _corpus()
    df = spark.createDataFrame([(i, t, "old") for i, t in docs], "doc_id long, text string, kept string")
    found = near.near_duplicates(df, size=4, percent=80).collect()
    assert len(found) == len(docs)
    want = _brute(docs, 4, 80)
    assert {r["doc_id"]: r["component_id"] for r in found} == want
    assert all(r["kept"] == (r["doc_id"] == want[r["doc_id"]]) for r in found)
    assert {r["doc_id"]: r["n_shingles"] for r in found if r["doc_id"] != 3} == {i: len(_shingles(t, 4)) for i, t in docs if i != 3}


def test_rows_without_id_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f")], "doc_id long, text string")
    found = {r["doc_id"]: (r["component_id"], r["kept"]) for r in near.near_duplicates(df).collect()}
    assert found == {None: (None, True), 1: (1, True), 2: (1, False)}
    kept = near.drop_near_duplicates(df)
    assert kept.columns == df.columns and kept.count() == 2
    assert near.near_duplicates(df.limit(0)).collect() == []


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7), (101, 100)], "a long, b long")
    found = {r["node"]: r["component"] for r in components(links).collect()}
    assert found == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def test_ids_with_different_texts(spark):
    """Each text of an id is compared for itself, and links carry on through the id."""
    rng = random.Random(7)
    text = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    near_to = lambda words: [*words[:-1], "other"]
    a, b, c, d = text(60), text(60), text(40), text(900)
    docs = [(1, a), (5, near_to(a)), (5, b), (7, near_to(b)), (8, c), (8, d), (9, near_to(c)), (10, near_to(d)), (11, text(50))]
    docs = [(i, " ".join(w)) for i, w in docs] + [(12, ""), (12, docs[-1][1][0]), (5, None)]
    # Families of texts that only the second round compares.
    for i in range(20, 40):
        base = text(80)
        docs += [(i, " ".join(base)), (i, " ".join(text(400))), (i + 20, " ".join(near_to(base))), (i + 40, " ".join(["first", *near_to(base)[1:]]))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = near.near_duplicates(df, size=4, percent=80).collect()
    want = _brute(docs, 4, 80)
    assert want[7] == 1 and want[10] == want[9] == 8
    assert len(found) == len(docs)
    assert {r["doc_id"]: r["component_id"] for r in found} == want
    assert all(r["component_id"] == want[r["doc_id"]] for r in found)
    named = df.selectExpr("concat('d', 100 + doc_id) AS doc_id", "text")
    found = {r["doc_id"]: r["component_id"] for r in near.near_duplicates(named, size=4, percent=80).collect()}
    assert found == {f"d{100 + i}": f"d{100 + j}" for i, j in want.items()}


def test_thresholds_that_signatures_cannot_serve_are_refused(spark):
    with pytest.raises(ValueError, match="percent"):
        near.near_duplicates(spark.createDataFrame([], "doc_id long, text string"), percent=79)


def test_words_that_a_polynomial_confuses_stay_apart(spark):
    word = "a"
    while len(word) < 4096:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    docs = [(i, w) for i, w in enumerate([word[:1024], other[:1024], word, other])]
    found = near.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == {0: 0, 1: 1, 2: 2, 3: 3}


def test_blocks_meet_each_other(spark, rows, monkeypatch):
    monkeypatch.setattr(near, "BLOCK_SHINGLES", 300)
    docs = _corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = near.near_duplicates(df, size=4, percent=80).select("doc_id", "component_id").distinct()
    want = _brute(docs, 4, 80)
    assert {r["doc_id"]: r["component_id"] for r in found.collect() if r["doc_id"] is not None} == want


@pytest.mark.parametrize("copies", [300, 900])
def test_a_large_group_gives_few_links(spark, monkeypatch, copies):
    rng = random.Random(copies)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    docs = []
    for i in range(copies):
        text = list(base)
        for _ in range(rng.randrange(3)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
        docs.append((i, " ".join(text)))
    seen = []

    def counted(links, *names):
        seen.append(links.count())
        return components(links, *names)

    monkeypatch.setattr(near, "components", counted)
    found = near.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), size=4)
    assert found.select("component_id").distinct().count() <= 3
    assert max(seen) <= 4 * copies
