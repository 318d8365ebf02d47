"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions only.

An item is cut into windows of ``window`` consecutive words (a shorter item is one
window), and a window into shingles of five words (fewer, if it is shorter).
Shingles are ordered by their number of places in the corpus.  A window that lies
wholly in a document shares all its shingles with it, so the necessary prefix is
one shingle: the rarest.  Places of that shingle give candidate starts; starts
before the first word or too close to the end are dropped, and the words between
are compared with the window's.

Defined results: a null or empty text has no words and is clean; items without
words have no windows; equal windows of several items count for each of them;
repeated rows are judged one by one; rows that share a doc_id are each judged on
their own words; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.frames import ascii_lower, named_again, plain_names, words_of
from millrace.sources.sinks import stage

# Fixed value: what a word is.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW_WORDS = 10
SHINGLE_WORDS = 5
#: The benchmark's shingles or windows are broadcast up to so many rows (about
#: 100 MB); a larger benchmark is joined by shuffles.
BROADCAST_ROWS = 1_000_000


def words(text: Column) -> Column:
    return words_of(ascii_lower(text), WORD)


def _shingles(words: Column, size: Column | int) -> Column:
    last = F.size(words) - size
    each = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice(words, i + 1, size)))
    return F.when(last >= 0, each).otherwise(F.array().cast("array<bigint>"))


def benchmark_windows(items: DataFrame, item_id: str, text: str, window: int, shingle: int) -> DataFrame:
    """Distinct windows with their words, the items that hold them, and shingle hashes."""
    cut = items.select(F.col(item_id).cast("string").alias("item"), words(F.col(text)).alias("words"))
    cut = cut.filter(F.size("words") > 0).withColumn("length", F.least(F.size("words"), F.lit(window)))
    starts = F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)
    each = cut.select("item", F.explode(F.transform(starts, lambda i: F.slice("words", i, F.col("length")))).alias("words"))
    whole = each.groupBy("words").agg(F.collect_set("item").alias("items"))
    whole = whole.withColumn("size", F.least(F.size("words"), F.lit(shingle)))
    return whole.withColumn("shingles", _shingles(F.col("words"), F.col("size")))


def _sized(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def contamination(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW_WORDS,
    shingle: int = SHINGLE_WORDS,
) -> DataFrame:
    """Add ``n_words``, ``n_hit``, ``items`` (sorted) and ``spans`` to each document.

    ``spans`` are the places of benchmark windows, as word positions (end exclusive).
    """
    plain, names = plain_names(docs)
    key, body = names[doc_id], names[text]
    windows = stage(benchmark_windows(items, item_id, item_text, window, shingle), "windows")
    tokens = stage(windows.select("size", F.explode("shingles").alias("token")).distinct(), "tokens")
    n = tokens.count()
    sizes = [r[0] for r in tokens.select("size").distinct().collect()]  # 5 at most
    # Every place in the corpus of any shingle of the benchmark.
    cut = plain.select(F.col(key).alias("key"), words(F.col(body)).alias("words"))
    places = None
    for size in sizes:
        one = cut.select("key", F.posexplode(_shingles(F.col("words"), size)).alias("place", "token"))
        one = one.join(_sized(tokens.filter(F.col("size") == size).select("token"), n), "token", "left_semi")
        places = one if places is None else places.unionByName(one)
    if places is None:
        candidates = _none(docs.sparkSession, plain.schema[key].dataType.simpleString())
    else:
        places = stage(places, "places")
        candidates = _candidates(places, windows, n)
    judged = plain.join(candidates, F.col(key).eqNullSafe(F.col("key")), "left").withColumn("words", words(F.col(body)))
    true = F.transform(
        "found",
        lambda f: F.struct(
            F.filter(f["starts"], lambda s: F.slice("words", s + 1, F.size(f["words"])) == f["words"]).alias("starts"),
            F.size(f["words"]).alias("length"),
            f["items"].alias("items"),
        ),
    )
    judged = judged.withColumn("true", F.filter(F.coalesce(true, F.array()), lambda f: F.size(f["starts"]) > 0))
    spans = F.flatten(
        F.transform("true", lambda f: F.transform(f["starts"], lambda s: F.struct(s.alias("start"), (s + f["length"]).alias("end"))))
    )
    judged = judged.withColumn("spans", F.array_sort(F.array_distinct(spans)))
    judged = judged.withColumn("n_hit", covered(F.col("spans")))
    judged = judged.withColumn("items", F.array_sort(F.array_distinct(F.flatten(F.transform("true", lambda f: f["items"])))))
    judged = judged.withColumn("n_words", F.size("words").cast("long"))
    return named_again(judged, names, n_words="n_words", n_hit="n_hit", items="items", spans="spans")


def covered(spans: Column) -> Column:
    """How many positions the spans cover; they come sorted by start."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto"))

    def add(state: Column, span: Column) -> Column:
        more = F.greatest(F.lit(0), span["end"] - F.greatest(span["start"], state["upto"]))
        return F.struct((state["n"] + more).alias("n"), F.greatest(state["upto"], span["end"]).alias("upto"))

    return F.aggregate(spans, zero, add, lambda state: state["n"])


def _candidates(places: DataFrame, windows: DataFrame, n: int) -> DataFrame:
    """One row per document: windows whose rarest shingle it holds, with possible starts."""
    rarity = places.groupBy("token").agg(F.count("*").alias("n"))
    listed = windows.select("words", "items", F.posexplode("shingles").alias("offset", "token"))
    ranked = listed.join(_sized(rarity, n), "token", "left")
    # A window with a shingle that the corpus doesn't have occurs nowhere.
    first = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "offset"))
    prefix = ranked.groupBy("words").agg(F.first("items").alias("items"), first.alias("rarest")).filter("rarest.n > 0")
    prefix = prefix.select("words", "items", F.col("rarest.token").alias("token"), F.col("rarest.offset").alias("offset"))
    prefix = stage(prefix, "prefix")
    met = places.join(_sized(prefix, n), "token").withColumn("start", F.col("place") - F.col("offset")).filter("start >= 0")
    met = met.groupBy("key", "words").agg(F.first("items").alias("items"), F.collect_set("start").alias("starts"))
    return met.groupBy("key").agg(F.collect_list(F.struct("words", "items", "starts")).alias("found"))


def _none(spark: SparkSession, kind: str) -> DataFrame:
    found = "array<struct<words: array<string>, items: array<string>, starts: array<int>>>"
    return spark.createDataFrame([], f"key {kind}, found {found}")


def drop_contaminated(docs: DataFrame, items: DataFrame, ratio: float = 0.0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents whose share of hit words is at most ``ratio``, with their own columns."""
    plain, names = plain_names(docs)
    judged = contamination(plain, items, names[doc_id], names[text])
    return named_again(judged.filter(F.col("n_hit") <= ratio * F.col("n_words")), names)
