import random

from millrace.llm import repeats


def _brute(docs, window):
    words = [(i, (t or "").encode().split()) for i, t in docs]
    first = {}
    for i, w in words:
        for j in range(len(w) - window + 1):
            key = tuple(w[j : j + window])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = set()
        for j in range(len(w) - window + 1):
            if i is not None and first[tuple(w[j : j + window])] < i:
                gone.update(range(j, j + window))
        out.append((i, len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode()))
    return sorted(out, key=repr)


def _corpus(rng, window):
    word = lambda: "é" + str(rng.randrange(500))
    text = lambda n: [word() for _ in range(n)]
    passage, other = text(window + 7), text(window)
    docs = []
    for i in range(25):
        body = text(rng.choice([0, 5, window - 1, 2 * window, 90]))
        for p in rng.sample([passage, other, passage[3:], other[1:]], rng.randrange(3)):
            at = rng.randrange(len(body) + 1)
            body[at:at] = p
        docs.append((i, "\u00a0x ".join(body[:2]) + " " + "\t ".join(body[2:])))
    whole = " ".join(text(3 * window))
    docs += [(30, whole), (31, whole), (32, whole + "\n"), (33, None), (34, ""), (35, "same " * (4 * window)), (36, "same " * (2 * window))]
    return docs + [(None, whole), (None, "x")]


def test_against_brute_force(spark):
    for window, prefix in ((12, 4), (50, 12)):
        docs = _corpus(random.Random(window), window)
        df = spark.createDataFrame([(i, t, "mine") for i, t in docs], "doc_id long, text string, starts string")
        found = repeats.drop_repeats(df, window=window, prefix=prefix)
        assert {r["starts"] for r in found.select("starts").collect()} == {"mine"}
        got = [(r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"] or "") for r in found.collect()]
        assert sorted(got, key=repr) == _brute(docs, window)


def test_frequent_prefixes_give_the_same(spark, monkeypatch):
    docs = _corpus(random.Random(2), 12)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    monkeypatch.setattr(repeats, "GROUP", 1)
    got = [(r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"] or "") for r in repeats.drop_repeats(df, window=12, prefix=4).collect()]
    assert sorted(got, key=repr) == _brute(docs, 12)


def test_repeated_rows_and_empty_table(spark):
    text = " ".join(map(str, range(60)))
    df = spark.createDataFrame([(1, text), (1, text), (2, text)], "doc_id long, text string")
    assert sorted((r["doc_id"], r["n_removed"]) for r in repeats.drop_repeats(df).collect()) == [(1, 0), (1, 0), (2, 60)]
    assert repeats.drop_repeats(df.limit(0)).collect() == []
