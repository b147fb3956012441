"""Corpus and batch reports. Every report reduces inside its tasks before anything is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedup_report(candidates: DataFrame) -> DataFrame:
    per_key = candidates.groupBy("benchmark_name", "pass_name").agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("candidates"), F.count("*").alias("unique_snapshots")
    ).withColumn("duplicates_dropped", F.col("candidates") - F.col("unique_snapshots"))


def size_metrics(kept_bytes: Column) -> list[Column]:
    """The aggregates of ``size_report``, also to be observed while rows are written."""
    return [
        F.count("*").alias("n_rows"),
        F.count_if("truncated").alias("truncated_rows"),
        F.coalesce(F.sum("ir_bytes"), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum(kept_bytes), F.lit(0)).alias("bytes_after"),
    ]


def text_bytes() -> Column:
    return F.octet_length("ir_text").cast("long")


def size_report(corpus: DataFrame) -> DataFrame:
    return corpus.agg(*size_metrics(text_bytes()))


def report_facts(corpus: DataFrame) -> DataFrame:
    """What reports need of corpus rows: no text, but the bytes that are kept of it."""
    return corpus.select("benchmark_name", "ir_bytes", "truncated", "dialects_present", text_bytes().alias("kept_bytes"))


def dialect_counts(corpus: DataFrame) -> DataFrame:
    """Rows that contain each dialect; the dialects of a row are distinct already."""
    return (
        corpus.select(F.explode_outer("dialects_present").alias("dialect"))
        .filter("dialect is not null")
        .groupBy("dialect")
        .agg(F.count("*").alias("n"))
    )


def dialect_frequency(corpus: DataFrame, top: int = 12) -> DataFrame:
    """The most frequent dialects; ties by name."""
    return dialect_counts(corpus).orderBy(F.desc("n"), "dialect").limit(top)


def distinct_dialects(corpus: DataFrame) -> DataFrame:
    return dialect_counts(corpus).agg(F.count("*").alias("distinct_dialects"))


def partition_report(corpus: DataFrame) -> DataFrame:
    return (
        corpus.groupBy("benchmark_name")
        .agg(F.count("*").alias("n_rows"), F.sum("ir_bytes").alias("ir_bytes"))
        .orderBy("benchmark_name")
    )


def planned_partitions(corpus: DataFrame) -> DataFrame:
    """How many partitions a write would touch."""
    return corpus.select("benchmark_name").distinct().agg(F.count("*").alias("partitions"))


def compression_report(corpus: DataFrame, files: DataFrame) -> DataFrame:
    """Text bytes against bytes on disk; ``files`` is a listing with a ``length`` column."""
    text = corpus.agg(F.coalesce(F.sum(F.octet_length("ir_text").cast("long")), F.lit(0)).alias("text_bytes"))
    disk = files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("disk_bytes"))
    # Both sides are single rows.
    return text.join(F.broadcast(disk)).withColumn(
        "ratio", F.when(F.col("disk_bytes") > 0, F.col("text_bytes") / F.col("disk_bytes"))
    )


def pass_frequency(corpus: DataFrame) -> DataFrame:
    """Benchmarks in which a pass occurs, its share of all benchmarks, and a tier for the share."""
    pairs = corpus.select("benchmark_name", "pass_name").distinct()
    per_pass = pairs.groupBy("pass_name").agg(F.count("*").alias("benchmarks"))
    total = corpus.select("benchmark_name").distinct().agg(F.count("*").alias("total_benchmarks"))
    share = F.col("benchmarks") / F.col("total_benchmarks")
    # Lower ends of the tiers about 100 %, 85 %, 50 %, 5-15 % and below 1 %.
    tier = (
        F.when(share >= 0.95, "universal")
        .when(share >= 0.70, "common")
        .when(share >= 0.30, "half")
        .when(share >= 0.01, "selective")
        .otherwise("rare")
    )
    # ``total`` is a single row.
    return per_pass.join(F.broadcast(total)).withColumns({"share": F.round(share, 6), "tier": tier})


def snapshots_per_benchmark(corpus: DataFrame, attempted: DataFrame | None = None) -> DataFrame:
    """Least, most, total and mean snapshots per benchmark, over benchmarks present and over benchmarks attempted."""
    per = corpus.groupBy("benchmark_name").agg(F.count("*").alias("n"))
    report = per.agg(
        F.min("n").alias("min_snapshots"),
        F.max("n").alias("max_snapshots"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_snapshots"),
        F.count("*").alias("benchmarks"),
    ).withColumn("avg_present", F.round(F.try_divide("total_snapshots", "benchmarks"), 6))
    if attempted is None:
        return report
    tried = attempted.select("benchmark").distinct().agg(F.count("*").alias("attempted"))
    return report.join(F.broadcast(tried)).withColumn(
        "avg_attempted", F.round(F.try_divide("total_snapshots", "attempted"), 6)
    )


def status_breakdown(summary: DataFrame) -> DataFrame:
    return summary.groupBy("status").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("status"))


def not_success(summary: DataFrame) -> DataFrame:
    return summary.filter("status <> 'success'")


def failure_modes(summary: DataFrame, top: int | None = 15, key_chars: int | None = 60) -> DataFrame:
    """Most frequent (status, start of the first error) pairs; white space is collapsed after grouping.

    Without ``key_chars`` errors are told apart by their whole text; without ``top`` all modes are listed.
    """
    error = F.coalesce(F.col("first_error"), F.lit(""))
    key = F.concat(F.col("status"), F.lit(": "), error if key_chars is None else F.substring(error, 1, key_chars))
    ranked = (
        not_success(summary).groupBy(key.alias("_key")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("_key"))
    )
    ranked = ranked if top is None else ranked.limit(top)
    return ranked.select(F.trim(F.regexp_replace("_key", r"[ \t\n]+", " ")).alias("failure_mode"), "n")


def batch_ok(summary: DataFrame) -> DataFrame:
    return summary.agg(F.count_if(F.col("status") != "success").alias("not_success")).withColumn(
        "ok", F.col("not_success") == 0
    )


def retention(summary: DataFrame) -> DataFrame:
    kept = F.count_if(F.col("status").isin("success", "partial_kept"))
    return summary.agg(F.count("*").alias("attempted"), kept.alias("retained")).withColumn(
        "retention", F.round(F.try_divide("retained", "attempted"), 6)
    )
