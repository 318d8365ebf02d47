import random
import re

from millrace.llm import decontaminate

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def _brute(text, items):
    words, hit, found = _words(text), set(), set()
    for item, body in items:
        own = _words(body)
        size = min(len(own), 10)
        for i in range(len(own) - size + 1 if size else 0):
            for j in range(len(words) - size + 1):
                if words[j : j + size] == own[i : i + size]:
                    hit.update(range(j, j + size))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


def test_against_brute_force(spark):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice("a b c d EÉ".split()) for _ in range(n))
    items = [(i, text(rng.choice([0, 2, 4, 9, 10, 11, 25]))) for i in range(14)] + [(90, "a b a c"), (91, "a b a c"), (92, None), (93, "-- !")]
    docs = [(i, text(rng.choice([0, 1, 3, 12, 60])), "s", 1) for i in range(40)]
    docs += [(50, None, "s", 1), (51, f"x {items[5][1]}! {items[5][1]} y", "s", 1), (7, items[6][1], "s", 2), (None, items[3][1], "s", 1), (None, "q", "s", 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, items string, key int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(df, bench)
    got = sorted((r["n_words"], r["n_hit"], r["items"]) for r in found.collect())
    assert got == sorted(_brute(t, items) for _, t, _, _ in docs)
    kept = decontaminate.drop_contaminated(df, bench)
    assert kept.columns == df.columns
    assert kept.count() == sum(not _brute(t, items)[1] for _, t, _, _ in docs)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    row = decontaminate.contamination(docs, none).first()
    assert (row["n_words"], row["n_hit"], row["items"]) == (3, 0, [])
    assert decontaminate.contamination(docs.limit(0), spark.createDataFrame([(1, "a b")], "item_id long, text string")).collect() == []
