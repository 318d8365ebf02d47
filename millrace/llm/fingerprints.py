"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

A text is the multiset of its words.  For every sample and word, hashes give two
gamma-distributed numbers r and c, both of shape 2, and a uniform b; a word that
occurs n times gets t = floor(ln n / r + b) and the value c * exp(-r * (t + 1 - b)).
The word and t of the smallest value are the sample.  Two texts have the same sample
with a probability equal to their generalised Jaccard similarity, the sum of the
smaller counts by the sum of the larger ones.  As the value is made from sample, word
and t alone, equal values stand for equal samples; a fingerprint holds 16 bits of each.

Documents are dealt into buckets of bounded size by a hash of their id.  There each
word is counted in both texts and sampled once for both, so that after the texts have
come to their buckets nothing but fingerprints is shuffled.

Defined results: a null text is an empty one; a text without words has the empty
fingerprint, which is like itself and unlike any other; equal texts have equal
fingerprints, whatever table they are in; repeated rows are documents of their own;
rows without an id come after all others; an id with several texts is the next
document with the one that sorts first; a single document is its own next one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.frames import named_again, parts_for, plain_names, words_of
from millrace.sources.sinks import stage

WORD = r"[^\x20\x09-\x0D]+"
SAMPLES = 32
#: Bytes of text in a bucket, and ids in a block of their order.
BUCKET_BYTES, ORDER_ROWS = 16_000_000, 1_000_000
_DIGITS = 4
#: ln(2 ** 64): two halves of a hash, as whole numbers, are 2 ** 64 times two uniforms.
_LOG_SPAN = 64 * math.log(2)


@contextmanager
def _joined_in_place(spark: SparkSession) -> Iterator[None]:
    """Joins on a bucket and more take rows that are dealt by bucket as they are."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _dealt(df: DataFrame, key: str, parts: int, bucket: str = "bucket") -> DataFrame:
    """The rows with their bucket, one partition each."""
    made = df.withColumn(bucket, F.pmod(F.xxhash64(key), F.lit(parts)).cast("int"))
    return made.repartitionById(parts, F.col(bucket))


def _gamma(h: str) -> str:
    """Gamma of shape 2 from 64 random bits: minus the log of two uniforms."""
    return f"({_LOG_SPAN!r}D - ln((({h} & 4294967295L) + 0.5D) * (shiftrightunsigned({h}, 32) + 0.5D)))"


def _samples(rows: DataFrame, texts: list[str], samples: int) -> DataFrame:
    """(bucket, row, one fingerprint per text) of rows dealt by bucket; rows without any word are left out."""
    names = range(len(texts))
    sides = F.array(*[words_of(F.col(t), WORD) for t in texts])
    words = rows.select("bucket", "row", F.posexplode(sides).alias("side", "words"))
    words = words.select("bucket", "row", "side", F.explode("words").alias("word")).select("bucket", "row", "side", F.xxhash64("word").alias("x"))
    counts = words.groupBy("bucket", "row", "x").agg(*[F.count_if(F.col("side") == i).alias(f"n{i}") for i in names])
    logs = [f"CASE WHEN n{i} > 0 THEN ln(n{i}) END AS s{i}" for i in names]
    counts = counts.selectExpr("bucket", "row", "x", *logs)
    # A row a sample keeps the generated code small enough to be compiled.
    drawn = counts.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(samples - 1))))
    sides = [f"s{i}" for i in names]
    drawn = drawn.selectExpr("bucket", "row", "j", *sides, "xxhash64(x, j, 0) AS h0", "xxhash64(x, j, 1) AS h1", "xxhash64(x, j, 2) AS h2")
    uniform = f"(shiftrightunsigned(h2, 11) * {2.0**-53!r}D)"
    drawn = drawn.selectExpr("bucket", "row", "j", *sides, f"{_gamma('h0')} AS r", f"{_gamma('h1')} AS c", f"{uniform} AS b")
    # The value for t = 0, which is what a word that occurs once has.
    each = drawn.selectExpr("bucket", "row", "j", *sides, "r", "b", "c * exp(-r * (1 - b)) AS once")
    value = "CASE WHEN s{i} = 0 THEN once WHEN s{i} > 0 THEN once * exp(-r * floor(s{i} / r + b)) END"
    found = each.groupBy("bucket", "row", "j").agg(*[F.min(F.expr(value.format(i=i))).alias(f"m{i}") for i in names])
    digits = [F.lpad(F.lower(F.hex(F.xxhash64(f"m{i}").bitwiseAND(16**_DIGITS - 1))), _DIGITS, "0").alias(f"d{i}") for i in names]
    found = found.select("bucket", "row", F.struct("j", *[F.when(F.col(f"m{i}").isNotNull(), d).alias(f"d{i}") for i, d in zip(names, digits, strict=True)]).alias("d"))
    found = found.groupBy("bucket", "row").agg(F.array_sort(F.collect_list("d")).alias("all"))
    # A text without words has no sample at all, so its digits join to nothing.
    return found.select("bucket", "row", *[F.array_join(F.col("all")[f"d{i}"], "").alias(f"f{i}") for i in names])


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """The share of equal samples of two fingerprints; of two empty ones, 1."""
    same = [(F.substring(a, _DIGITS * j + 1, _DIGITS) == F.substring(b, _DIGITS * j + 1, _DIGITS)).cast("int") for j in range(samples)]
    total = same[0]
    for one in same[1:]:
        total = total + one
    return F.when(F.length(a) != F.length(b), F.lit(0.0)).otherwise(total / F.lit(float(samples)))


def fingerprint(docs: DataFrame, text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """The rows with ``fingerprint``; each text that differs is sampled once."""
    plain, names = plain_names(docs)
    body = F.coalesce(F.col(names[text]).cast("string"), F.lit(""))
    plain = plain.withColumn("key", F.sha2(F.encode(body, "utf-8"), 256))
    texts = plain.select("key", body.alias("text")).groupBy("key").agg(F.first("text").alias("text"))
    # A key's digest is the row's name within its bucket.
    dealt = _dealt(texts, "key", parts_for(plain, names[text], BUCKET_BYTES)).withColumn("row", F.col("key"))
    found = stage(_samples(dealt, ["text"], samples).select("row", "f0"), "fingerprints")
    joined = plain.join(found, plain["key"] == found["row"], "left").withColumn("fingerprint", F.coalesce("f0", F.lit("")))
    return named_again(joined, names, fingerprint="fingerprint")


def _neighbours(rows: DataFrame) -> DataFrame:
    """(key, doc, next_key, prev_key, wanted): the order of the ids, descending, in a circle.

    ``wanted`` is how many code points the document before, of ``prev_key``, takes.
    Ids are dealt by range; two rows a block, those at its ends, come to the driver.
    """
    ids = stage(rows.groupBy("key").agg(F.min("doc").alias("doc"), F.max(F.floor(F.length("text") / 3)).alias("third")), "ids")
    blocks = max(1, math.ceil(ids.count() / ORDER_ROWS))
    placed = stage(ids.repartitionByRange(blocks, F.col("doc").desc_nulls_last()).withColumn("block", F.spark_partition_id()), "order")
    order = Window.partitionBy("block").orderBy(F.col("doc").desc_nulls_last())
    made = [F.lead("key").over(order).alias("after"), F.lag("key").over(order).alias("before"), F.lag("third").over(order).alias("before_third")]
    linked = placed.select("block", "key", "doc", "third", *made)
    ends = linked.filter("after IS NULL OR before IS NULL").collect()
    firsts = sorted((r["block"], r["key"]) for r in ends if r["before"] is None)
    lasts = sorted((r["block"], r["key"], r["third"]) for r in ends if r["after"] is None)
    turns = [(block, firsts[(i + 1) % len(firsts)][1], lasts[i - 1][1], lasts[i - 1][2]) for i, (block, _) in enumerate(firsts)]
    turned = rows.sparkSession.createDataFrame(turns, "block int, first_after string, last_before string, last_third long")
    found = linked.join(F.broadcast(turned), "block", "left")
    return found.select(
        "key",
        "doc",
        F.coalesce("after", "first_after").alias("next_key"),
        F.coalesce("before", "last_before").alias("prev_key"),
        F.coalesce("before_third", "last_third").alias("wanted"),
    )


def compare_edited(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """Each document beside its edited text, whose last third is the next document's beginning.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next); documents follow each other by descending id.
    """
    spark = docs.sparkSession
    # The empty key is that of rows without an id.
    key = F.coalesce(F.concat(F.lit("."), F.col(doc_id).cast("string")), F.lit(""))
    rows = docs.select(key.alias("key"), F.col(doc_id).alias("doc"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    parts = parts_for(rows, "text", BUCKET_BYTES)
    around = _dealt(stage(_neighbours(rows), "neighbours").withColumnRenamed("key", "of"), "of", parts, "dealt")
    # The id comes back with its neighbours, so that every branch needs the same columns
    # and Spark deals the texts once.
    rows = _dealt(rows.select("key", "text"), "key", parts)
    rows = rows.join(around, (rows["bucket"] == around["dealt"]) & (rows["key"] == around["of"])).drop("dealt", "of")
    by_text = [F.row_number().over(Window.partitionBy(*p).orderBy(*o)) for p, o in ((("bucket", "key"), ("text",)), (("bucket",), ("key", "text")))]
    rows = rows.withColumn("copy", by_text[0]).withColumn("row", by_text[1])
    starts = rows.filter("copy = 1").selectExpr("prev_key AS of", "substring(text, 1, cast(wanted AS int)) AS start")
    starts = _dealt(starts, "of", parts, "dealt")
    both = rows.join(starts, (rows["bucket"] == starts["dealt"]) & (rows["key"] == starts["of"])).drop("dealt", "of")
    both = both.withColumn("n_chars", F.length("text").cast("long"))
    edited = "concat(substring(text, 1, cast(n_chars - n_chars div 3 AS int)), substring(start, 1, cast(n_chars div 3 AS int)))"
    both = both.withColumn("edited", F.expr(edited))
    facts = both.select("bucket", "row", "doc", "key", "copy", "next_key", "n_chars", F.sha2(F.encode("edited", "utf-8"), 256).alias("edited_sha256"))
    prints = [F.coalesce("f0", F.lit("")).alias("fingerprint"), F.coalesce("f1", F.lit("")).alias("edited_fingerprint")]
    with _joined_in_place(spark):
        found = facts.join(_samples(both, ["text", "edited"], samples), ["bucket", "row"], "left")
        found = stage(found.select("doc", "key", "copy", "next_key", "n_chars", "edited_sha256", *prints), "fingerprints")
    following = found.filter("copy = 1").select(F.col("key").alias("of"), F.col("fingerprint").alias("next_fingerprint"))
    pairs = found.join(following, found["next_key"] == following["of"])
    near = [likeness(F.col("fingerprint"), F.col(c), samples) for c in ("edited_fingerprint", "next_fingerprint")]
    return pairs.select(
        F.col("doc").alias(doc_id), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", near[0].alias("near_edited"), near[1].alias("near_next")
    )
