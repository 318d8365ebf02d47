"""Ranked lexical search over bit-sliced Bloom signatures.

A document's signature holds its terms, and each term again for every frequency level
it reaches (1, 2, 3, 4, 6, 9, ... occurrences).  Signatures of documents of like size
lie in one block as bit slices: row i of a block has bit i of every document, so the
documents that may hold a term are the bitwise and of a few rows.  A signature never
misses a term; it may show one too many.

An item's weights summed over the slices of a level, times what that level can add to
a score at a document's length, give an upper bound of every document's score.  The
documents of the highest bounds are scored exactly first; the k-th of these exact
scores is what others must reach.  Then all documents whose bound isn't below it are
scored exactly, from their whole texts, and only these scores are returned.

Items are taken in blocks of bounded size; a task holds one block of items, the
signatures of one block of documents, and one document's text at a time.

Defined results: a null text, or one without terms, is no document and no item;
repeated rows are documents of their own; documents without an id come first among
equal scores; rows that repeat an item count once, an item id with several texts is
ranked once for each; an item has as many rows as documents score above 0, k at most.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.rolling import mix
from millrace.sources.sinks import stage

K = 20
#: Terms in UTF-8 after lower-casing A-Z: letters and digits of ASCII, anything beyond it.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Bits of a signature for each of its tokens, and rows that are read for one.
BITS, ROWS = 12, 5
LEVELS = 8
#: Tokens and documents a task collects before it cuts blocks, documents of a block,
#: and bits of a block (one document may exceed them).
SLAB_TOKENS, SLAB_DOCS, BLOCK_DOCS, BLOCK_BITS = 3_000_000, 16_384, 1_024, 1 << 25
#: Items and bytes of their texts in a block of items.
BLOCK_ITEMS, BLOCK_BYTES = 1_000, 1_000_000
#: Pairs of item and candidate that are sent to every task (12 bytes or so each); more
#: are joined by shuffle.
BROADCAST_PAIRS = 1_000_000


def levels(n: int = LEVELS) -> list[int]:
    """The least occurrences of each level: steps of a half, at least one."""
    found = [1]
    while len(found) < n:
        found.append(max(found[-1] + 1, found[-1] * 3 // 2))
    return found


def terms(text: str | None) -> list[bytes]:
    return TERM.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


def gain(tf: int, m: int) -> int:
    """What ``tf`` occurrences add for each unit of weight."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def norm(n: int, total_docs: int, total_terms: int) -> int:
    return 100 - 25 + (25 * n * total_docs) // total_terms


def _level_hash(hashes: np.ndarray, level: int) -> np.ndarray:
    return mix(hashes, level)


def _places(hashes: np.ndarray, width: int) -> np.ndarray:
    """(hash, row) -> bit: ``ROWS`` places in a signature of ``width`` bits."""
    first, step = hashes >> np.uint64(32), (hashes & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    return ((first[:, None] + step[:, None] * np.arange(ROWS, dtype=np.uint64)) % np.uint64(width)).astype(np.int64)


def _blocks(ids: list, sizes: list[int], tokens: list[np.ndarray]) -> Iterator[tuple[list, list[int], int, bytes]]:
    """(ids, sizes, width, slices) of documents of like signature size."""
    order = sorted(range(len(ids)), key=lambda i: len(tokens[i]))
    while order:
        width = max(64, BITS * len(tokens[order[-1]]))
        least = max(1, BLOCK_BITS // width // 8 * 8)
        some = order[-min(BLOCK_DOCS, least) :]
        # Documents of under half as many tokens are worth a narrower block.
        some = [i for i in some if 2 * len(tokens[i]) >= len(tokens[some[-1]]) or width <= 512]
        del order[-len(some) :]
        bits = np.zeros((width, (len(some) + 7) // 8), np.uint8)
        for j, i in enumerate(some):
            bits[_places(tokens[i], width).ravel(), j >> 3] |= np.uint8(128 >> (j & 7))
        yield [ids[i] for i in some], [sizes[i] for i in some], width, bits.tobytes()


def _signatures(kind: pa.DataType) -> Callable:
    thresholds = levels()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sizes, tokens, held = [], [], [], 0

        def cut() -> Iterator[pa.RecordBatch]:
            for own, ns, width, slices in _blocks(ids, sizes, tokens):
                row = [[own], [ns], [width], [slices]]
                types = [pa.list_(kind), pa.list_(pa.int64()), pa.int64(), pa.binary()]
                yield pa.record_batch([pa.array(x, t) for x, t in zip(row, types, strict=True)], ["ids", "sizes", "width", "slices"])
            ids.clear(), sizes.clear(), tokens.clear()

        for batch in batches:
            for doc, text in zip(batch["id"], batch["text"], strict=True):
                counts = Counter(terms(text.as_py()))
                if not counts:
                    continue
                hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, counts), np.uint64, len(counts))
                times = np.fromiter(counts.values(), np.int64, len(counts))
                each = [_level_hash(hashes[times >= t], level) for level, t in enumerate(thresholds)]
                ids.append(doc.as_py()), sizes.append(int(times.sum())), tokens.append(np.concatenate(each))
                held += len(tokens[-1])
                if held >= SLAB_TOKENS or len(ids) >= SLAB_DOCS:
                    yield from cut()
                    held = 0
        yield from cut()

    return run


class Items:
    """A block of items: their terms, and the weights that the corpus gives them."""

    def __init__(self, texts: list[str]):
        self.counts = [Counter(terms(t)) for t in texts]
        self.terms = sorted(set().union(*self.counts)) if texts else []
        self.place = {t: i for i, t in enumerate(self.terms)}
        self.hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.terms), np.uint64, len(self.terms))
        self.docs = self.words = 0
        self.weights = [0] * len(self.terms)

    def weigh(self, docs: int, words: int, df: dict[int, int]) -> None:
        self.docs, self.words = docs, words
        self.weights = [math.floor(1000 * math.log((2 * docs + 2) / (2 * df.get(i, 0) + 1))) for i in range(len(self.terms))]
        self.rows = [np.array([self.place[t] for t in c], np.int64) for c in self.counts]
        self.sums = [np.array([self.weights[self.place[t]] * n for t, n in c.items()], np.float64) for c in self.counts]

    def score(self, item: int, counts: Counter, m: int) -> int:
        total = 0
        for t, repeats in self.counts[item].items():
            if tf := counts.get(t):
                total += repeats * self.weights[self.place[t]] * gain(tf, m)
        return total

    def bounds(self, sizes: list[int], width: int, slices: bytes) -> np.ndarray:
        """(item, document) -> the most that the document's score can be."""
        n = len(sizes)
        bits = np.frombuffer(slices, np.uint8).reshape(width, -1)
        norms = [norm(s, self.docs, self.words) for s in sizes]
        thresholds = levels()
        # The most occurrences of a term that stops at a level.
        most = [[t - 1] * n for t in thresholds[1:]] + [sizes]
        gains = [np.array([gain(t, m) for t, m in zip(ts, norms, strict=True)], np.float64) for ts in most]
        out = np.zeros((len(self.counts), n))
        present = None
        live = np.arange(len(self.terms))
        for level in range(len(thresholds)):
            found = np.bitwise_and.reduce(bits[_places(_level_hash(self.hashes[live], level), width)], axis=1)
            if present is not None:
                found &= present
            some = found.any(1)
            live, present = live[some], found[some]
            if not len(live):
                break
            where = np.full(len(self.terms), -1)
            where[live] = np.arange(len(live))
            step = gains[level] - (gains[level - 1] if level else 0)
            for i, (rows, sums) in enumerate(zip(self.rows, self.sums, strict=True)):
                at = where[rows]
                at, sums = at[at >= 0], sums[at >= 0]
                if len(at):
                    out[i] += (sums @ np.unpackbits(present[at], axis=1, count=n)) * step
        # Sums below 2 ** 53 are exact; larger ones get more than they can lose.
        return np.where(out < 2.0**52, out, out * (1 + 1e-9))


def _frequencies(items: Items) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        known = items.place.keys()
        for batch in batches:
            for text in batch["text"]:
                found.update(known & set(terms(text.as_py())))
        if found:
            yield pa.record_batch({"term": pa.array([items.place[t] for t in found], pa.int32()), "df": pa.array(found.values(), pa.int64())})

    return run


def _candidates(items: Items, kind: pa.DataType, k: int, least: dict[int, int] | None) -> Callable:
    """(item, id, bound): the k highest bounds of a task, or all that reach ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[float, object]]] = [[] for _ in items.counts]
        for batch in batches:
            for ids, sizes, width, slices in zip(*(batch[c] for c in ("ids", "sizes", "width", "slices")), strict=True):
                own = ids.as_py()
                bounds = items.bounds(sizes.as_py(), width.as_py(), slices.as_py())
                for i, row in enumerate(bounds):
                    if least is None:
                        top = np.argpartition(-row, k)[:k] if len(row) > k else np.arange(len(row))
                        best[i] = sorted(best[i] + [(row[j], own[j]) for j in top if row[j] > 0], key=lambda x: -x[0])[:k]
                    else:
                        reach = np.flatnonzero(row >= max(1, least.get(i, 1)))
                        best[i] += [(row[j], own[j]) for j in reach]
            if least is not None:
                yield _rows(best, kind)
                best = [[] for _ in items.counts]
        yield _rows(best, kind)

    return run


def _rows(best: list[list[tuple[float, object]]], kind: pa.DataType) -> pa.RecordBatch:
    found = [(i, doc, bound) for i, some in enumerate(best) for bound, doc in some]
    item, docs, bounds = zip(*found, strict=True) if found else ((), (), ())
    return pa.record_batch([pa.array(item, pa.int32()), pa.array(docs, kind), pa.array(bounds, pa.float64())], ["item", "id", "bound"])


def _scores(items: Items, kind: pa.DataType) -> Callable:
    """The exact score of each document for the items it is a candidate of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for doc, text, asked in zip(batch["id"], batch["text"], batch["items"], strict=True):
                counts = Counter(terms(text.as_py()))
                if counts:
                    m = norm(counts.total(), items.docs, items.words)
                    own = doc.as_py()
                    found += [(i, own, s) for i in asked.as_py() if (s := items.score(i, counts, m)) > 0]
            item, docs, scores = zip(*found, strict=True) if found else ((), (), ())
            yield pa.record_batch([pa.array(item, pa.int32()), pa.array(docs, kind), pa.array(scores, pa.int64())], ["item", "id", "score"])

    return run


def index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Blocks of documents: ``ids``, ``sizes`` (terms with repeats), ``width`` and bit ``slices``."""
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    schema = f"ids array<{kind}>, sizes array<long>, width long, slices binary"
    return stage(rows.mapInArrow(_signatures(_arrow(docs, doc_id)), schema), "signatures")


def _arrow(docs: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(docs.schema[column].dataType)


def _exact(rows: DataFrame, chosen: DataFrame, items: Items, kind: tuple[str, pa.DataType]) -> DataFrame:
    """(item, id, score) of the chosen documents; reads the texts, scores the chosen ones."""
    asked = stage(chosen.groupBy("id").agg(F.collect_set("item").alias("items")), "asked")
    pairs = asked.agg(F.sum(F.size("items"))).first()[0] or 0
    if pairs <= BROADCAST_PAIRS:
        asked = F.broadcast(asked)
    both = rows.join(asked, rows["id"].eqNullSafe(asked["id"])).select(rows["id"], "text", "items")
    return both.mapInArrow(_scores(items, kind[1]), f"item int, id {kind[0]}, score long")


def _best(scores: DataFrame, by: str, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc(by), F.asc_nulls_first("id"))
    return scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    k: int = K,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    kind = (docs.schema[doc_id].dataType.simpleString(), _arrow(docs, doc_id))
    signatures = index(docs, doc_id, text)
    size = F.aggregate("sizes", F.lit(0).cast("decimal(38,0)"), lambda a, x: (a + x).cast("decimal(38,0)"))
    total = signatures.agg(F.sum(F.size("ids")).alias("docs"), F.sum(size).alias("words")).first()
    asked = items.select(F.col(item_id).alias("item_id"), F.col(item_text).cast("string").alias("text")).filter("text IS NOT NULL").distinct()
    asked = stage(asked, "items")
    amount = asked.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    parts = max(1, math.ceil(amount["n"] / BLOCK_ITEMS), math.ceil((amount["bytes"] or 0) / BLOCK_BYTES))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)))
    found = []
    for part in range(parts if total["docs"] else 0):
        mine = asked.filter(F.col("part") == part).orderBy("item_id", "text").collect()
        if mine:
            best = _search_block(rows, signatures, Items([r["text"] for r in mine]), int(total["docs"]), int(total["words"]), kind, k)
            schema = f"item int, item_id {items.schema[item_id].dataType.simpleString()}"
            own = docs.sparkSession.createDataFrame([(i, r["item_id"]) for i, r in enumerate(mine)], schema)
            found.append(stage(best.join(F.broadcast(own), "item").select("item_id", "rank", "id", "score"), "ranked"))
    if not found:
        schema = f"item_id {items.schema[item_id].dataType.simpleString()}, rank int, {doc_id} {kind[0]}, score long"
        return docs.sparkSession.createDataFrame([], schema)
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.select("item_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(doc_id), "score")


def _search_block(rows: DataFrame, signatures: DataFrame, items: Items, docs: int, words: int, kind: tuple[str, pa.DataType], k: int) -> DataFrame:
    counted = rows.select("text").mapInArrow(_frequencies(items), "term int, df long")
    df = {r["term"]: r["df"] for r in counted.groupBy("term").agg(F.sum("df").alias("df")).collect()}
    items.weigh(docs, words, df)
    schema = f"item int, id {kind[0]}, bound double"
    first = _best(signatures.mapInArrow(_candidates(items, kind[1], k, None), schema), "bound", k)
    known = _best(_exact(rows, first, items, kind), "score", k)
    # The k-th exact score is what another document must reach.
    least = {r["item"]: r["score"] for r in known.filter(F.col("rank") == k).collect()}
    rest = signatures.mapInArrow(_candidates(items, kind[1], k, least), schema)
    return _best(_exact(rows, rest, items, kind), "score", k)
