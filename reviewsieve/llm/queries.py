"""Registered queries: each operator on its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewsieve.llm import chaining, decontaminate, fuzzy_lines, heap_kmeans, license_scan, mixing, quality_mcd, quality_rff, sharding, spelling, superminhash, url_aliases, warc_zstd
from reviewsieve.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op2_quality_mcd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_mcd.quality_verdicts(_table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(_table(spark, sf_dir, "documents"))


def op4_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_chaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.passage_report(_table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.benchmark_overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    hits = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    return found.select(
        "doc_id",
        "n_words",
        hits.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op7_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc_zstd.round_trip(_table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines.fuzzy_line_report(_table(spark, sf_dir, "documents"))


def op9_url_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return url_aliases.judge_pages(pages, url_aliases.alias_edges(pages))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(_table(spark, sf_dir, "documents"))


def op11_heap_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heap_kmeans.centroid_clusters(_table(spark, sf_dir, "embeddings"))


def op12_quality_rff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rff.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
