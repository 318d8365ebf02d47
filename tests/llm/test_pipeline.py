"""The pipeline against its contract, step by step, on a small table."""

import re

from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from millrace.llm import bpe, decontaminate, lines

SMALL = "/root/testdata/sf0.001"


def _kept(spark, docs):
    """Line dedup, near dedup and decontamination in plain Python."""
    pages, counts = {}, {}
    for host, text in {(d["source"], d["text"]) for d in docs}:
        pages[host] = pages.get(host, 0) + 1
        for line in {x.strip(" ") for x in text.split("\n")} - {""}:
            counts[host, line] = counts.get((host, line), 0) + 1
    texts = {}
    for d in docs:
        def bad(line, host=d["source"]):
            n = counts.get((host, line.strip(" ")), 0)
            return n >= lines.MIN_PAGES and n > lines.RATIO * pages[host]

        own = d["text"].split("\n")
        rest = [x for x in own if not bad(x)]
        texts[d["doc_id"]] = d["text"] if len(rest) == len(own) else "\n".join(rest)
    sets = {}
    for i, text in texts.items():
        w = text.lower().encode().split()
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((top(a), top(b)))
                root[high] = low
    texts = {i: t for i, t in texts.items() if top(i) == i}
    windows = set()
    for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect():
        w = re.findall(decontaminate.WORD, r["text"].lower())
        n = min(10, len(w))
        windows.update(tuple(w[j : j + n]) for j in range(len(w) - n + 1 if n else 0))
    sizes = {len(w) for w in windows}

    def clean(text):
        w = re.findall(decontaminate.WORD, text.lower())
        return not any(tuple(w[j : j + n]) in windows for n in sizes for j in range(len(w) - n + 1))

    return {i: t for i, t in texts.items() if clean(t)}


def test_run_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    found = {r["doc_id"]: r for r in pipeline.run(spark, SMALL).collect()}
    want = _kept(spark, docs)
    assert set(found) == set(want)
    tokenizer = Tokenizer.from_file(bpe.default_path())
    for i, text in want.items():
        assert found[i]["ids"] == tokenizer.encode(text, add_special_tokens=False).ids


def test_stages_take_odd_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, extra string"
    body = "the cat and the dog went out of the house "
    rows = [(1, body, "en", "a", 1, "x"), (1, body, "en", "a", 1, "x"), (2, body + "again", None, None, None, None), (3, None, "en", "a", None, "x"), (4, "", None, "b", 0, "x"), (None, "un chien " * 40, "fr", "a", 1, "x")]
    spark.createDataFrame([(1, None), (2, "")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for table in (rows, []):
        docs = spark.createDataFrame(table, schema)
        for name, function in pipeline.STAGES:
            found = function(spark, docs, str(tmp_path))
            if name != "tokens":
                assert found.columns == docs.columns
            found.collect()
            docs = found
        assert docs.count() == (3 if table else 0)
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "tokens"]
