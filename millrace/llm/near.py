"""MinHash near-dedup by a multi-index Hamming join.

A document is the set of its distinct shingles.  Its signature holds ``symbols``
minimum hashes of ``bits`` bits, cut into chunks of ``chunk`` symbols.  Two
signatures that differ in fewer than 2 * chunks symbols have, by pigeonhole, a chunk
that differs in one symbol at most; each chunk is therefore filed under all its
masks with one symbol left out, and documents that share a key are candidates.  All
pairs under that distance are found; what decides is the exact similarity of the
full sets (of 64-bit shingle hashes).

Groups of copies stay linear: texts with equal sets are one node; texts of one id
are linked; a key ties
its nodes to its smallest one; pairs within a component need no further look.  Only
nodes of different components that share a key are compared with each other.
Shingles that no other of these nodes has can't be common to any pair; what is left
of a set bounds its similarity to every other and settles most nodes.  The others
meet in blocks of bounded size, by families (nodes tied by keys), where sizes, bounds
and signatures decide which sets are compared; only links leave a block.

Defined results: a null text, one without words and a row without id are linked with
nothing; a text of fewer words than a shingle is one shingle; rows that repeat an id
are one document, linked if any of its texts is; a similarity at the threshold
exactly is a link; a threshold under 80 percent is refused.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.frames import named_again, plain_names
from millrace.llm.rolling import mix, slabs
from millrace.sources.sinks import stage

SHINGLE_WORDS = 5
PERCENT = 80
#: The chunks and FAR find next to all pairs at this similarity, and too few below it.
LEAST_PERCENT = 80
SYMBOLS, CHUNK, BITS = 50, 5, 16
#: Signatures that differ in more symbols aren't compared in full after the first
#: round: at a similarity of 0.8 the chance of that is below one in 10 ** 8.
FAR = 27
#: Shingles in a block of nodes, which is compared with one other at a time, and in
#: what a task takes at once.
BLOCK_SHINGLES, BUCKET_SHINGLES = 500_000, 2_000_000


def shingle_sets(texts: pa.StringArray, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for first, last, words in slabs(texts, lower=True):
        runs = words.runs(size)
        for i in range(last - first):
            start, n = words.firsts[i], words.counts[i]
            if n >= size:
                yield np.unique(runs[start : start + n - size + 1])
            elif n:
                yield np.array([words.whole(i)], np.uint64)
            else:
                yield np.zeros(0, np.uint64)


def _class(found: np.ndarray) -> bytes:
    """128 bits that equal sets share."""
    return np.array([mix(found, s).sum(dtype=np.uint64) for s in (11, 12)], np.uint64).tobytes()


def _fingerprints(size: int) -> Callable:
    rng = np.random.default_rng(20)
    factors = rng.integers(0, 1 << 63, SYMBOLS, np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = rng.integers(0, 1 << 63, SYMBOLS, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, classes, signatures = [], [], []
            for found in shingle_sets(batch["text"], size):
                counts.append(len(found))
                if not len(found):
                    classes.append(None)
                    signatures.append(None)
                    continue
                classes.append(_class(found))
                least = np.empty(SYMBOLS, np.uint64)
                for j in range(SYMBOLS):
                    least[j] = (found * factors[j] + shifts[j]).min()
                signatures.append((mix(least) >> np.uint64(64 - BITS)).astype("<u2").tobytes())
            yield pa.record_batch(
                {
                    "doc": batch["doc"],
                    "n_shingles": pa.array(counts, pa.int64()),
                    "class": pa.array(classes, pa.binary()),
                    "signature": pa.array(signatures, pa.binary()),
                }
            )

    return run


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every chunk with each of its symbols left out in turn."""
    for batch in batches:
        symbols = np.frombuffer(b"".join(batch["signature"].to_pylist()), "<u2").reshape(-1, SYMBOLS).astype(np.uint64)
        for c in range(SYMBOLS // CHUNK):
            for masked in range(CHUNK):
                key = np.full(len(symbols), c * CHUNK + masked, np.uint64)
                for j in range(CHUNK):
                    if j != masked:
                        key = mix(key ^ (symbols[:, c * CHUNK + j] << np.uint64(20)))
                yield pa.record_batch({"key": pa.array(key.view(np.int64)), "node": batch["node"]})


def _sets(size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # An id may have other texts, too.
            own = [s.astype("<u8").tobytes() if len(s) and _class(s) == c.as_py() else None for s, c in zip(shingle_sets(batch["text"], size), batch["class"], strict=True)]
            found = pa.array(own, pa.binary())
            yield pa.record_batch({"node": batch["node"], "set": found}).filter(found.is_valid())

    return run


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles as 32 bits: two that meet by chance only count as common."""
    for batch in batches:
        for node, found in zip(batch["node"], batch["set"], strict=True):
            token = (np.frombuffer(found.as_buffer(), "<u8") >> np.uint64(32)).astype("<u4").view(np.int32)
            yield pa.record_batch({"node": pa.repeat(node, len(token)), "token": pa.array(token)})


def _similar(percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["set_a"], batch["set_b"], strict=True):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                common, short, long = 0, min(len(x), len(y)), max(len(x), len(y))
                if 100 * short >= percent * long > 0:
                    common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(common > 0 and 100 * common >= percent * (short + long - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _across(percent: int) -> Callable:
    """Links that join components within the blocks of a bucket: for each two blocks fewer than components."""

    def run(table: pa.Table) -> pa.Table:
        family, component = table["family"].to_numpy(), table["component"].to_numpy()
        i, j, block, n, common = (table[c].to_numpy() for c in ("i", "j", "block", "n", "common"))
        sets = [np.frombuffer(x.as_buffer(), "<u8") for x in table["set"]]
        symbols = np.frombuffer(b"".join(table["signature"].to_pylist()), "<u2").reshape(-1, SYMBOLS)
        order = np.lexsort((table["node"].to_numpy(), j, i, family))
        cuts = np.flatnonzero((np.diff(family[order]) != 0) | (np.diff(i[order]) != 0) | (np.diff(j[order]) != 0)) + 1
        left, right = [], []
        for piece in np.split(order, cuts):
            inner = i[piece[0]] == j[piece[0]]
            rows = piece if inner else piece[block[piece] == i[piece[0]]]
            columns = piece if inner else piece[block[piece] == j[piece[0]]]
            # Components that a link has joined are one from then on.
            joined = component.copy()
            for place, row in enumerate(rows):
                others = columns[place + 1 :] if inner else columns
                others = others[joined[others] != joined[row]]
                # |x & y| / |x | y| >= t needs |x & y| >= t / (1 + t) * (|x| + |y|).
                most = np.minimum(common[others], common[row])
                others = others[(100 + percent) * most >= percent * (n[others] + n[row])]
                others = others[(symbols[others] == symbols[row]).sum(1) >= SYMBOLS - FAR]
                if len(others):
                    sizes = np.array([len(sets[x]) for x in others])
                    both = np.isin(np.concatenate([sets[x] for x in others]), sets[row])
                    both = np.add.reduceat(both.astype(np.int64), np.cumsum(sizes) - sizes)
                    for other in others[100 * both >= percent * (sizes + len(sets[row]) - both)]:
                        if joined[other] != joined[row]:
                            left.append(component[row])
                            right.append(component[other])
                            joined[piece[joined[piece] == joined[other]]] = joined[row]
        return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})

    return run


def _by_least(links: DataFrame, node: str, other: str) -> DataFrame:
    """The same ties with a node's others, at most as many as keys, tied to the smallest of them."""
    met = links.groupBy(node).agg(F.collect_set(other).alias("met")).withColumn("a", F.array_min("met"))
    return met.select("a", F.explode(F.array_append("met", F.col(node))).alias("b")).filter("a != b").distinct()


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE_WORDS, percent: int = PERCENT
) -> DataFrame:
    """Add ``n_shingles``, ``component_id`` (the smallest id of the group) and ``kept`` to each row."""
    if percent < LEAST_PERCENT:
        raise ValueError(f"percent is {percent}, but signatures are made for {LEAST_PERCENT} at least")
    plain, names = plain_names(docs)
    kind = plain.schema[names[doc_id]].dataType.simpleString()
    rows = plain.select(F.col(names[doc_id]).alias("doc"), F.col(names[text]).cast("string").alias("text"))
    prints = f"doc {kind}, n_shingles long, class binary, signature binary"
    prints = stage(rows.mapInArrow(_fingerprints(size), prints), "fingerprints")
    nodes = prints.filter("class IS NOT NULL AND doc IS NOT NULL").groupBy("class")
    nodes = nodes.agg(F.min("doc").alias("doc"), F.first("signature").alias("signature"), F.first("n_shingles").alias("n"))
    nodes = stage(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    labels = stage(_node_components(nodes, rows.filter("doc IS NOT NULL"), _ties(prints, nodes), size, percent), "labels")
    # A component is named by the smallest id in it.
    least = labels.join(nodes.select("node", "doc"), "node").groupBy("component").agg(F.min("doc").alias("least"))
    labels = labels.join(least, "component").select("node", "least")
    named = nodes.join(labels, "node", "left").select("class", F.coalesce("least", "doc").alias("component"))
    of = prints.select("doc", "n_shingles", "class").distinct().join(named, "class", "left")
    of = of.select(F.col("doc"), F.col("class"), F.col("n_shingles"), F.when(F.col("doc").isNotNull(), F.coalesce("component", "doc")).alias("component_id"))
    of = of.groupBy("doc").agg(F.min("component_id").alias("component_id"), F.max("n_shingles").alias("n_shingles"))
    found = plain.join(of, F.col(names[doc_id]).eqNullSafe(F.col("doc")), "left")
    found = found.withColumn("kept", F.coalesce(F.col("doc") == F.col("component_id"), F.lit(True)))
    return named_again(found, names, n_shingles="n_shingles", component_id="component_id", kept="kept")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options: int) -> DataFrame:
    """One document of each group, the one with the smallest id, with its own columns."""
    plain, names = plain_names(docs)
    return named_again(near_duplicates(plain, names[doc_id], names[text], **options).filter("kept"), names)


def _ties(prints: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links between the nodes of an id with several texts."""
    texts = prints.filter("class IS NOT NULL AND doc IS NOT NULL").select("doc", "class", F.xxhash64("class").alias("h"))
    many = texts.groupBy("doc").agg(F.min("h").alias("x"), F.max("h").alias("y")).filter("x < y").select("doc")
    of = stage(texts.join(many, "doc").select("doc", "class").distinct().join(nodes.select("class", "node"), "class").select("doc", "node"), "texts")
    return of.join(of.groupBy("doc").agg(F.min("node").alias("a")), "doc").filter("a < node").select("a", F.col("node").alias("b"))


def _node_components(nodes: DataFrame, docs: DataFrame, ties: DataFrame, size: int, percent: int) -> DataFrame:
    keys = nodes.select("node", "signature").mapInArrow(_keys, "key long, node long")
    centers = keys.groupBy("key").agg(F.min("node").alias("center"), F.max("node").alias("last")).filter("center < last")
    shared = stage(keys.join(centers.select("key", "center"), "key"), "shared")
    wanted = shared.select("node").distinct().join(nodes.select("node", "doc", "class"), "node")
    texts = docs.join(wanted, "doc").select("node", "class", "text")
    sets = stage(texts.mapInArrow(_sets(size), "node long, set binary"), "sets")
    # Each key's nodes against its smallest one.
    stars = shared.filter("node > center").select(F.col("center").alias("a"), F.col("node").alias("b")).distinct()
    both = stars.join(sets.select(F.col("node").alias("a"), F.col("set").alias("set_a")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("set").alias("set_b")), "b")
    links = both.select("a", "b", "set_a", "set_b").mapInArrow(_similar(percent), "a long, b long")
    labels = components(_by_least(links, "b", "a").unionByName(ties))
    # Nodes of one key that are still apart, and how much of each may be common to two.
    placed = shared.select("key", "node").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = stage(_apart(placed), "apart")
    tokens = sets.join(placed.select("node").distinct(), "node").select("node", "set").mapInArrow(_tokens, "node long, token int")
    lone = tokens.groupBy("token").agg(F.count("*").alias("times"), F.min("node").alias("node")).filter("times = 1")
    lone = lone.groupBy("node").agg(F.count("*").alias("lone"))
    sizes = nodes.select("node", "n", "signature").join(lone, "node", "left")
    common = F.col("n") - F.coalesce("lone", F.lit(0))
    sizes = sizes.select("node", "signature", "n", common.alias("common")).filter(100 * F.col("common") >= percent * F.col("n"))
    placed = stage(_apart(placed.join(sizes, "node")), "open")
    ends = placed.groupBy("key").agg(F.min("node").alias("a"))
    family = components(_by_least(placed.join(ends, "key").select("a", "node"), "node", "a"))
    members = placed.select("node", "component", "signature", "n", "common").distinct()
    members = members.join(family.withColumnRenamed("component", "family"), "node")
    blocks = members.groupBy("family").agg(F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES)).cast("int").alias("blocks"))
    members = members.join(blocks, "family").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    members = members.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other", "blocks")
    members = stage(members, "members")
    amount = members.agg(F.sum("n")).first()[0]
    if not amount:
        return labels
    buckets = max(3 * docs.sparkSession.sparkContext.defaultParallelism, math.ceil(amount / BUCKET_SHINGLES))
    dealt = members.withColumn("bucket", F.pmod(F.xxhash64("family", "i", "j"), F.lit(buckets)).cast("int"))
    more = dealt.join(sets, "node").groupBy("bucket").applyInArrow(_across(percent), "a long, b long")
    # Links between components; one of a single node has the node's name.
    merged = components(more).withColumnRenamed("component", "of").withColumnRenamed("node", "was")
    alone = merged.join(labels, merged["was"] == labels["node"], "left_anti")
    labels = labels.join(merged, labels["component"] == merged["was"], "left")
    labels = labels.select("node", F.coalesce("of", "component").alias("component"))
    return labels.unionByName(alone.select(F.col("was").alias("node"), F.col("of").alias("component")))


def _apart(placed: DataFrame) -> DataFrame:
    """The rows of keys whose nodes lie in several components."""
    ends = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    return placed.join(ends.filter("x < y").select("key"), "key")
