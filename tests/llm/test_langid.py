import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import langid
from millrace.llm.queries import QUERIES


def _grams(text):
    plain = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
    found = Counter(c for c in plain if c != " ")
    for n in (2, 3):
        found.update(plain[i : i + n] for i in range(len(plain) - n + 1))
    return found


def test_grams_and_ranks():
    for text in ("Der Hund, der bellt!", "été à 3 l'eau", "x"):
        values, counts = langid.grams(text)
        want = _grams(text)
        assert dict(zip(values.tolist(), counts.tolist(), strict=True)) == {sum(ord(c) << 21 * i for i, c in enumerate(reversed(g))): n for g, n in want.items()}
    assert langid.ranked(np.array([5, 3, 9, 1]), np.array([2, 2, 7, 2]), 3).tolist() == [9, 1, 3]
    assert len(langid.grams("123 ... __")[0]) == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()
    lang = {r["doc_id"]: r["lang"] for r in docs}
    found = QUERIES["op6_langid"](spark, "/root/testdata/sf0.01").collect()
    assert len(found) == len(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    assert all(0 <= r["score"] <= 1 for r in found)
    held = [r["lang_pred"] == lang[r["doc_id"]] for r in found if r["held_out"]]
    assert np.mean(held) > 0.98


def test_labels_of_held_out_rows_are_not_read(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    swapped = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    rows = lambda df: sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in langid.identify(df).collect())
    assert rows(docs) == rows(swapped)


def test_odd_rows(spark):
    rows = [(1, "the cat and the dog", "en", 1), (2, None, "en", 1), (3, "12 34 !", None, 1), (4, "", "de", 1), (None, "the", None, 1), (6, "der hund " * 9, "de", 1), (6, "der hund " * 9, "de", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    found = langid.identify(df).collect()
    assert len(found) == 7
    assert {r["lang_pred"] for r in found if r["doc_id"] in (2, 3, 4)} == {"und"}
    kept = langid.keep_identified(df, 0.0)
    assert kept.columns == df.columns and kept.count() == 4
    assert langid.identify(df.limit(0)).collect() == []
    assert {r["lang_pred"] for r in langid.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_numbers_are_no_letters(spark):
    rows = [(i, t, None) for i, t in enumerate(("½ ²", "①②", "Ⅷ", "12", "ª"))] + [(10 + i, "the cat and the dog", "en") for i in range(9)]
    found = {r["doc_id"]: r["lang_pred"] for r in langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert [found[i] for i in range(5)] == ["und"] * 4 + ["en"]


def test_distances_by_hand(spark):
    """Labels and scores of short texts, from profiles counted and compared in plain Python."""
    words = {"en": "the cat and the dog", "de": "der hund und die katze", "fr": "le chat et le chien"}
    rows = [(10 * j + i, " ".join((t.split() * 3)[i : i + 4]), lang) for j, (lang, t) in enumerate(words.items()) for i in range(8)]
    rows += [(100 + i, t, None) for i, t in enumerate(("the hund", "le dog et", "die katze and", "x"))]

    def counted(text):
        line, n = f" {text} ", {}
        for size in (1, 2, 3):
            for i in range(len(line) - size + 1):
                if line[i : i + size] != " ":
                    n[line[i : i + size]] = n.get(line[i : i + size], 0) + 1
        return n

    # Shorter n-grams first on equal counts, then by character code.
    order = lambda n: sorted(n, key=lambda g: (-n[g], len(g), g))[: langid.PROFILE]
    learned = {}
    for i, text, lang in rows:
        if lang and zlib.crc32(str(i).encode()) % 5:
            for g, n in counted(text).items():
                learned.setdefault(lang, {})[g] = learned.get(lang, {}).get(g, 0) + n
    profiles = {lang: {g: r for r, g in enumerate(order(n))} for lang, n in learned.items()}
    found = {r["doc_id"]: r for r in langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    for i, text, _ in rows:
        own = order(counted(text))
        far = {lang: sum(abs(r - ranks[g]) if g in ranks else langid.PROFILE for r, g in enumerate(own)) for lang, ranks in profiles.items()}
        best = min(far, key=lambda lang: (far[lang], lang))
        assert found[i]["lang_pred"] == best
        assert abs(found[i]["score"] - (1 - far[best] / (len(own) * langid.PROFILE))) < 1e-9
