"""Substring dedup with prefix-partitioned suffix trees, over words.

A window is ``window`` consecutive words.  Words go that a window covers whose
words also start in a document with a smaller id.

Suffixes are taken up where a shared window must show itself: every window names
the place of its smallest run of ``prefix`` words, so equal windows name equal runs
at equal offsets (one place in about 20 words).  Runs that stand in one document
only branch no further.  For the others, the suffixes of the windows naming them
are split by prefix into groups of bounded size: a run of up to ``GROUP`` places
is a prefix of its own, more frequent runs are extended to the whole window.  Each
group is a subtree, kept as its sorted suffixes; suffixes that agree down to the
window's depth are one deep internal node, a maximal repeat's window.  The most
frequent prefixes need only the smallest document of each node, which combines
before the shuffle.

Words are compared by two 64-bit hashes of the whole window.  Defined results: a
null or empty text has no words; texts shorter than a window lose nothing; rows
without id neither lose nor take away; rows that repeat an id are one document, and
places found in any of them go from each; equal texts of different ids are settled
as wholes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import named_again, plain_names
from millrace.llm.rolling import Words, mix, slabs
from millrace.sources.sinks import stage

WINDOW_WORDS = 50
PREFIX_WORDS = 12
#: Places of a prefix that one group takes, with 39 windows each (under 100 MB); more
#: frequent prefixes are extended.
GROUP = 50_000
#: Suffixes in a bucket of groups.
BUCKET_ROWS = 200_000


def _named_places(runs: np.ndarray, first: int, n: int, window: int, prefix: int) -> np.ndarray:
    """For each window of a text, the place of its smallest run (the first of equals)."""
    own = runs[first : first + n - prefix + 1]
    width = window - prefix + 1
    return np.lib.stride_tricks.sliding_window_view(own, width).argmin(1) + np.arange(len(own) - width + 1)


def _lists(rows: list[np.ndarray], kind: type) -> pa.ListArray:
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    values = np.concatenate([np.zeros(0, kind), *rows]).astype(kind, copy=False)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _outline(window: int, prefix: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, classes, hashes, places = [], [], [], []
            for first, last, words in slabs(batch["text"]):
                runs = words.runs(prefix)
                whole = [_whole(words, salt) for salt in (3, 4)]
                for i in range(last - first):
                    start, n = words.firsts[i], int(words.counts[i])
                    counts.append(n)
                    at = np.zeros(0, np.int64)
                    if n >= window:
                        at = np.unique(_named_places(runs, start, n, window, prefix))
                    hashes.append(runs[start + at].view(np.int64) if len(at) else np.zeros(0, np.int64))
                    places.append(at.astype(np.int32))
                    classes.append(np.array([w[i] for w in whole], np.uint64).tobytes() if n >= window else None)
            yield pa.record_batch(
                {
                    "doc": batch["doc"],
                    "n_words": pa.array(counts, pa.int64()),
                    "class": pa.array(classes, pa.binary()),
                    "runs": _lists(hashes, np.int64),
                    "places": _lists(places, np.int32),
                }
            )

    return run


def _whole(words: Words, salt: int) -> np.ndarray:
    """A hash of each text's words and their order."""
    order = np.arange(len(words.hashes)) - np.repeat(words.firsts[:-1], words.counts)
    each = mix(words.hashed(salt) ^ mix(order.astype(np.uint64), salt))
    run = np.zeros(len(each) + 1, np.uint64)
    np.cumsum(each, out=run[1:])
    return mix((run[words.firsts[1:]] - run[words.firsts[:-1]]) ^ words.counts.astype(np.uint64))


def _suffixes(window: int, prefix: int) -> Callable:
    """Windows that name a repeated run: prefix, the window's two hashes, place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rare, often = batch["rare"].to_pylist(), batch["often"].to_pylist()
            for first, last, words in slabs(batch["text"]):
                runs = words.runs(prefix)
                paths = [words.runs(window, salt) for salt in (0, 5)]
                for i in range(last - first):
                    start, n = words.firsts[i], int(words.counts[i])
                    if n < window:
                        continue
                    named = _named_places(runs, start, n, window, prefix)
                    for hot, known in ((False, rare[first + i]), (True, often[first + i])):
                        at = np.flatnonzero(np.isin(named, known)) if known else np.zeros(0, np.int64)
                        if len(at):
                            yield pa.record_batch(
                                {
                                    "doc": pa.array([batch["doc"][first + i].as_py()] * len(at), batch["doc"].type),
                                    "start": pa.array(at.astype(np.int32)),
                                    "prefix": pa.array(runs[start + named[at]].view(np.int64)),
                                    "path": pa.array(paths[0][start + at].view(np.int64)),
                                    "check": pa.array(paths[1][start + at].view(np.int64)),
                                    "hot": pa.array([hot] * len(at)),
                                }
                            )

    return run


def _deep_nodes(table: pa.Table) -> pa.Table:
    """The suffixes of a bucket that share a deep node with a smaller document."""
    doc = table["doc"].combine_chunks()
    ranks = doc.dictionary_encode()
    order = pc.rank(ranks.dictionary, tiebreaker="dense").to_numpy().astype(np.int64)
    rank = order[ranks.indices.to_numpy()]
    prefix, path, check = (table[c].to_numpy() for c in ("prefix", "path", "check"))
    leaves = np.lexsort((rank, check, path, prefix))
    new = np.zeros(len(leaves), bool)
    new[:1] = True
    for column in (prefix, path, check):
        new[1:] |= column[leaves][1:] != column[leaves][:-1]
    node = np.cumsum(new) - 1
    least = rank[leaves][np.flatnonzero(new)]
    covered = leaves[rank[leaves] > least[node]]
    return pa.table({"doc": doc.take(pa.array(covered)), "start": table["start"].combine_chunks().take(pa.array(covered))})


def repeated_spans(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW_WORDS, prefix: int = PREFIX_WORDS
) -> DataFrame:
    """(doc, n_words, whole, starts): what repeats an earlier document, one row per document.

    ``whole``: the text as such is there already; ``starts``: of the repeated windows.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc"), F.col(text).cast("string").alias("text")).filter("doc IS NOT NULL")
    outline = f"doc {kind}, n_words long, class binary, runs array<long>, places array<int>"
    outline = stage(rows.mapInArrow(_outline(window, prefix), outline), "outline").filter("class IS NOT NULL")
    first = outline.groupBy("class").agg(F.min("doc").alias("first"))
    known = outline.select("doc", "class").distinct().join(first, "class")
    known = stage(known.select("doc", (F.col("doc") > F.col("first")).alias("whole")).groupBy("doc").agg(F.min("whole").alias("whole")), "wholes")
    # Prefixes of more than one document.
    each = outline.join(known.filter("NOT whole"), "doc").select("doc", F.explode(F.arrays_zip("runs", "places")).alias("x"))
    each = each.select("doc", F.col("x.runs").alias("run"), F.col("x.places").alias("place"))
    often = each.groupBy("run").agg(F.min("doc").alias("a"), F.max("doc").alias("b"), F.count("*").alias("n")).filter("a < b")
    # Written first, so that the join is between two plain tables and a frequent run can be split.
    often = stage(often.select("run", (F.col("n") > GROUP).alias("hot")), "runs")
    met = each.join(often, "run")
    places = [F.collect_list(F.when(F.col("hot") == hot, F.col("place"))).alias(name) for hot, name in ((False, "rare"), (True, "often"))]
    met = met.groupBy("doc").agg(*places)
    schema = f"doc {kind}, start int, prefix long, path long, check long, hot boolean"
    found = stage(rows.join(met, "doc").mapInArrow(_suffixes(window, prefix), schema), "suffixes")
    n = found.filter("NOT hot").count()
    buckets = max(3 * docs.sparkSession.sparkContext.defaultParallelism, math.ceil(n / BUCKET_ROWS))
    groups = found.filter("NOT hot").withColumn("bucket", F.pmod(F.xxhash64("prefix"), F.lit(buckets)).cast("int"))
    cold = groups.groupBy("bucket").applyInArrow(_deep_nodes, f"doc {kind}, start int")
    hot = found.filter("hot")
    ends = hot.groupBy("path", "check").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    nodes = stage(ends.filter("first < last").select("path", "check", "first"), "nodes")
    hot = hot.join(nodes, ["path", "check"]).filter("doc > first").select("doc", "start")
    starts = cold.unionByName(hot).groupBy("doc").agg(F.array_sort(F.collect_set("start")).alias("starts"))
    return known.join(starts, "doc", "left")


def _kept(window: int, names: list[str], text: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, removed = [], [], []
            for value, whole, starts in zip(batch[text], batch["whole"], batch["starts"], strict=True):
                # bytes.split() parts at the six ASCII blanks only.
                words = value.as_buffer().to_pybytes().split() if value.is_valid else []
                counts.append(len(words))
                if whole.as_py() and len(words) >= window:
                    kept = []
                elif starts.is_valid:
                    covered = np.zeros(len(words) + 1, np.int64)
                    at = starts.values.to_numpy()
                    at = at[at <= len(words) - window]
                    covered[at] += 1
                    np.subtract.at(covered, at + window, 1)
                    kept = [words[i] for i in np.flatnonzero(np.cumsum(covered[:-1]) == 0).tolist()]
                else:
                    kept = words
                removed.append(len(words) - len(kept))
                texts.append(b" ".join(kept).decode() if value.is_valid else None)
            made = [pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string())]
            yield pa.record_batch([batch[n] for n in names] + made, [*names, "n_words", "n_removed", "kept"])

    return run


def drop_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    out: str = "kept_text",
    window: int = WINDOW_WORDS,
    prefix: int = PREFIX_WORDS,
) -> DataFrame:
    """Add ``n_words``, ``n_removed`` and the kept words, joined by one blank, to each row."""
    plain, names = plain_names(docs)
    key, body = names[doc_id], names[text]
    plain = plain.withColumn(body, F.col(body).cast("string"))
    spans = repeated_spans(plain, key, body, window, prefix)
    both = plain.join(spans, F.col(key) == F.col("doc"), "left").select(*plain.columns, "whole", "starts")
    made = ["n_words long", "n_removed long", "kept string"]
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in plain.schema.fields] + made)
    found = both.mapInArrow(_kept(window, plain.columns, body), schema)
    return named_again(found, names, n_words="n_words", n_removed="n_removed", **{out: "kept"})
