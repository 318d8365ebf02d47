"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, codes, decontaminate, fingerprints, langid, lexical, licenses, lines, near, pages, pii, repeats, topk
from millrace.llm.frames import prepare


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the text they decode to, as digests."""
    path = bpe.default_path()
    encoded = bpe.encode(_read(spark, sf_dir, "documents").select("doc_id", "text"), path, packed=True)
    return bpe.decode(encoded, path).select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"),
    )


def op2_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its source's boilerplate lines."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return lines.drop_boilerplate(docs).select("doc_id", "text", "n_lines", "n_dropped")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which words of every document lie in passages of the benchmark, and whose."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    judged = decontaminate.contamination(docs, _read(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licenses that every document names."""
    seen = licenses.scan(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    starts = F.transform("base", lambda x: x["start"].cast("long"))
    return seen.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        licenses.labels(F.col("base")).alias("base_labels"),
        licenses.labels(F.col("detections")).alias("labels"),
        F.coalesce(F.array_max(F.transform("detections", lambda x: x["score"])), F.lit(0.0)).alias("score"),
    )


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.learn(docs)).select("doc_id", "base", "spans")

    def joined(spans: str) -> Column:
        each = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(each, ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(kind) for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from four fifths of them."""
    found = langid.identify(_read(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five vectors nearest by inner product to every 50th one."""
    return topk.top_k(_read(spark, sf_dir, "embeddings"), "id % 50 = 0")


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without passages of 50 words that an earlier one has."""
    found = repeats.drop_repeats(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.sha2(F.encode(F.coalesce("kept_text", F.lit("")), "utf-8"), 256)
    return found.select("doc_id", "n_words", "n_removed", kept.alias("kept_sha256"))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near copies among all documents."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    found = near.near_duplicates(docs, size=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op10_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    found = pages.extract(_read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint of every document and of its edited text, and how alike they are."""
    return fingerprints.compare_edited(_read(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 documents that match each benchmark item's terms best."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical.search(docs, _read(spark, sf_dir, "benchmark").select("item_id", "text"))


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The code of every vector, and what it loses."""
    vectors = _read(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    return codes.compress(vectors).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_lines": op2_lines,
    "op3_decontaminate": op3_decontaminate,
    "op4_licenses": op4_licenses,
    "op5_pii": op5_pii,
    "op6_langid": op6_langid,
    "op7_topk": op7_topk,
    "op8_repeats": op8_repeats,
    "op9_minhash": op9_minhash,
    "op10_pages": op10_pages,
    "op11_fingerprints": op11_fingerprints,
    "op12_lexical": op12_lexical,
    "op13_codes": op13_codes,
}
