"""Line dedup by site-relative frequency, in DataFrame functions only.

Pages are grouped by host.  A line's frequency is the number of the host's pages
that hold it, divided by the host's pages; lines above a ratio are boilerplate of
that host and go from its pages.  Pages of a host whose whole texts are equal count as
one, in both numbers: copies of a page don't make its lines boilerplate.

Defined results: a null text stays null and counts as a page without lines; blank
lines are never boilerplate; pages without a host are a host of their own; each of
several equal rows loses the same lines; a line at the ratio exactly stays, and so
does one that a single page holds; the text of a page without boilerplate is
untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import named_again, plain_names
from millrace.sources.sinks import stage

#: Lines on more than this share of a host's pages are boilerplate ...
RATIO = 0.1
#: ... if they are on so many pages at least: what one page holds doesn't repeat.
MIN_PAGES = 2


def _mark(line: Column) -> Column:
    """96 bits of a line, blank ones excepted: what is compared across pages."""
    line = F.trim(line)
    return F.when(line != "", F.struct(F.xxhash64(line).alias("a"), F.crc32(F.encode(line, "utf-8")).alias("b")))


def boilerplate(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """One row per host that has any: ``host`` and the array ``marks`` of its boilerplate.

    A page adds each line once, so a host has at most (lines a page) / ratio of them.
    """
    lines = F.split(text, "\n")
    marks = F.array_distinct(F.filter(F.transform(lines, _mark), lambda m: m.isNotNull()))
    digest = F.struct(F.xxhash64(text).alias("a"), F.crc32(F.encode(F.col(text), "utf-8")).alias("b"), F.length(text).alias("n"))
    pages = docs.select(F.col(host).alias("host"), digest.alias("page"), marks.alias("marks"))
    pages = pages.groupBy("host", "page").agg(F.first("marks").alias("marks"))
    totals = pages.groupBy("host").agg(F.count("*").alias("pages"))
    counts = pages.select("host", F.explode("marks").alias("mark")).groupBy("host", "mark").agg(F.count("*").alias("n"))
    often = counts.filter(F.col("n") >= min_pages).join(totals, counts["host"].eqNullSafe(totals["host"]))
    often = often.filter(F.col("n") > F.lit(ratio) * F.col("pages")).select(counts["host"], "mark")
    return often.groupBy("host").agg(F.collect_list("mark").alias("marks"))


def drop_boilerplate(
    docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """The pages without their host's boilerplate; adds ``n_lines`` and ``n_dropped``."""
    plain, names = plain_names(docs)
    site, body = names[host], names[text]
    found = stage(boilerplate(plain, site, body, ratio, min_pages), "boilerplate")
    pages = plain.join(found, plain[site].eqNullSafe(found["host"]), "left")
    pages = pages.withColumn("lines", F.split(body, "\n"))
    kept = F.filter("lines", lambda line: ~F.coalesce(F.array_contains(F.col("marks"), _mark(line)), F.lit(False)))
    pages = pages.withColumn("kept", F.when(F.col("marks").isNull(), F.col("lines")).otherwise(kept))
    pages = pages.withColumn("n_lines", F.coalesce(F.size("lines"), F.lit(0)).cast("long"))
    pages = pages.withColumn("n_lines", F.when(F.col(body).isNull(), F.lit(0).cast("long")).otherwise(F.col("n_lines")))
    pages = pages.withColumn("n_dropped", F.when(F.col(body).isNull(), F.lit(0).cast("long")).otherwise(F.col("n_lines") - F.size("kept")))
    pages = pages.withColumn("text", F.when(F.col("n_dropped") > 0, F.array_join("kept", "\n")).otherwise(F.col(body)))
    return named_again(pages, names, **{text: "text", "n_lines": "n_lines", "n_dropped": "n_dropped"})
