"""Language identification by rank-order profiles.

A language's profile is the list of its most frequent letter n-grams (one to three
characters, words fenced by blanks), by rank.  A document's own most frequent
n-grams are compared with each profile: the out-of-place distance sums how far apart
an n-gram's ranks are, or the largest distance if the profile lacks it.

Profiles are learned from a sample of the labelled rows that a hash of their id
picks; its expected size per language is bounded.  n-grams are counted over whole
texts, by task first.

Defined results: a null text, one without letters, and any text if nothing could be
learned is ``und`` with score 0; equal counts rank by character code; equal
distances go to the language whose name comes first; repeated rows are judged one by
one.  The score is 1 minus the mean distance as a share of the largest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.frames import named_again, plain_names

#: n-grams in a profile and in a document's list.
PROFILE = 400
#: Expected number of labelled rows a language is learned from, at most.
SAMPLE_ROWS = 4_000
#: All but letters; numbers written as fractions, in circles or by signs of their own are none.
_NO_LETTERS = regex.compile(r"\P{L}+")
UNKNOWN = "und"


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams as integers, and their counts; none without letters."""
    plain = _NO_LETTERS.sub(" ", text.lower()).strip()
    if not plain:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes = np.frombuffer(f" {plain} ".encode("utf-32-le"), "<u4").astype(np.int64)
    # Three characters of 21 bits; shorter ones leave the upper bits empty.
    two = codes[:-1] << 21 | codes[1:]
    three = two[:-1] << 21 | codes[2:]
    parts = [codes[codes != 32], two, three]
    return np.unique(np.concatenate(parts), return_counts=True)


def ranked(values: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """The n most frequent, in order; equal counts by value."""
    if len(values) > n:
        # Every value at the n-th count stays, so that ties are settled below.
        keep = counts >= np.partition(counts, -n)[-n]
        values, counts = values[keep], counts[keep]
    return values[np.lexsort((values, -counts))][:n]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        by_lang: dict[str, list[str]] = {}
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
            by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            found = [grams(t) for t in texts]
            every = np.concatenate([v for v, _ in found])
            values, at = np.unique(every, return_inverse=True)
            counts = np.bincount(at, np.concatenate([c for _, c in found]).astype(float), len(values)).astype(np.int64)
            yield pa.record_batch({"lang": pa.array([lang] * len(values), pa.string()), "gram": pa.array(values), "n": pa.array(counts)})


def learn(rows: DataFrame, key: Column, text: str = "text", lang: str = "lang", sample: int = SAMPLE_ROWS, size: int = PROFILE) -> dict[str, np.ndarray]:
    """Profiles of the languages that label the rows.

    A hash of ``key`` picks the sample.  Only the languages' row counts and profiles
    (``size`` numbers each) come to the driver.
    """
    named = rows.select(F.col(lang).alias("lang"), F.col(text).cast("string").alias("text"), F.xxhash64(key, F.lit(6)).alias("at"))
    named = named.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = named.groupBy("lang").count().collect()
    if not sizes:
        return {}
    parts = 1 << 30
    cut = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(parts, parts * sample // r["count"]))])
    picked = named.filter(F.pmod("at", F.lit(parts)) < F.element_at(cut, F.col("lang")))
    counts = picked.select("lang", "text").mapInArrow(_count, "lang string, gram long, n long")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), F.asc("gram"))
    top = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)
    found: dict[str, dict[int, int]] = {}
    for row in top.select("lang", "gram", "rank").collect():
        found.setdefault(row["lang"], {})[row["rank"]] = row["gram"]
    return {name: np.array([ranks[r] for r in sorted(ranks)], np.int64) for name, ranks in sorted(found.items())}


class Judge:
    """All profiles as one table: n-gram to its rank in each language."""

    def __init__(self, profiles: dict[str, np.ndarray], size: int):
        self.names, self.size = list(profiles), size
        self.grams = np.unique(np.concatenate([np.zeros(0, np.int64), *profiles.values()]))
        # The last row is for n-grams that no profile has.
        self.ranks = np.full((len(self.grams) + 1, len(self.names)), -1, np.int64)
        for j, order in enumerate(profiles.values()):
            self.ranks[np.searchsorted(self.grams, order), j] = np.arange(len(order))

    def __call__(self, text: str | None) -> tuple[str, float]:
        values, counts = grams(text) if text else ((), ())
        if not len(values) or not self.names:
            return UNKNOWN, 0.0
        own = ranked(values, counts, self.size)
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        at = np.where(self.grams[at] == own, at, len(self.grams))
        ranks = self.ranks[at]
        apart = np.where(ranks < 0, self.size, np.minimum(np.abs(ranks - np.arange(len(own))[:, None]), self.size)).sum(0)
        best = int(apart.argmin())
        return self.names[best], float(1 - apart[best] / (self.size * len(own)))


def _judge(profiles: Callable[[], dict[str, np.ndarray]], size: int, text: str, names: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(profiles(), size)
        for batch in batches:
            found = [judge(x.as_py()) for x in batch[text]]
            made = [pa.array([n for n, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())]
            yield pa.record_batch([batch[n] for n in names] + made, [*names, "lang_pred", "score"])

    return run


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], text: str = "text", size: int = PROFILE) -> DataFrame:
    """Add ``lang_pred`` and ``score`` to each row, from its whole text alone."""
    plain, names = plain_names(docs)
    plain = plain.withColumn(names[text], F.col(names[text]).cast("string"))
    table = plain.sparkSession.sparkContext.broadcast(profiles)
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in plain.schema.fields] + ["lang_pred string", "score double"])
    found = plain.mapInArrow(_judge(lambda: table.value, size, names[text], plain.columns), schema)
    return named_again(found, names, lang_pred="lang_pred", score="score")


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Rows that profiles aren't learned from: a checksum of the id decides.  False without id."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % folds == 0, F.lit(False))


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Learn from the labelled rows that aren't held out; add ``held_out``, ``lang_pred``, ``score`` to all."""
    known = docs.filter(~held_out(F.col(doc_id)))
    profiles = learn(known, F.col(doc_id), text, lang)
    return predict(docs.withColumn("held_out", held_out(F.col(doc_id))), profiles, text)


def keep_identified(docs: DataFrame, least: float, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows in a learned language, with their own columns; a missing label is filled in.

    Rows without letters go, and those whose score is below ``least``.
    """
    plain, names = plain_names(docs)
    found = identify(plain, names[doc_id], names[text], names[lang])
    found = found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    found = found.withColumn(names[lang], F.coalesce(names[lang], "lang_pred"))
    return named_again(found, names)
