"""Following the lowering chain, and finding a benchmark's latest run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passtrail.operators.scale import keep_by_key, left_join_unique


def parent_links(corpus: DataFrame, hot_rows: int = 1_000_000) -> DataFrame:
    """Each row with its parent in the same benchmark and a link kind: root, linked or dangling.

    Copies of one text share a hash, so the parent side is reduced to one row per hash (its lowest pass index). Children
    that share a parent with very many others are dealt out by ``left_join_unique``. Only narrow columns are touched.
    """
    corpus = corpus.select("benchmark_name", "pass_index", "pass_name", "run_timestamp", "ir_sha256", "parent_sha256")
    parents = corpus.groupBy("benchmark_name", F.col("ir_sha256").alias("parent_sha256")).agg(
        F.min(F.struct("pass_index", "pass_name", "run_timestamp")).alias("_parent")
    )
    kind = (
        F.when(F.col("parent_sha256").isNull(), "root")
        .when(F.col("_parent").isNull(), "dangling")
        .otherwise("linked")
    )
    return left_join_unique(corpus, parents, ["benchmark_name", "parent_sha256"], hot_rows).select(
        "benchmark_name",
        "pass_index",
        "pass_name",
        "run_timestamp",
        "ir_sha256",
        "parent_sha256",
        F.col("_parent.pass_index").alias("parent_pass_index"),
        F.col("_parent.pass_name").alias("parent_pass_name"),
        F.col("_parent.run_timestamp").alias("parent_run_timestamp"),
        kind.alias("link"),
    )


def chain_report(corpus: DataFrame) -> DataFrame:
    """Rows per link kind and benchmark. Children are counted per hash before they meet the parents."""
    children = corpus.groupBy("benchmark_name", "parent_sha256").agg(F.count("*").alias("n"))
    parents = corpus.select("benchmark_name", F.col("ir_sha256").alias("parent_sha256")).distinct()
    linked = children.join(parents.withColumn("_found", F.lit(True)), ["benchmark_name", "parent_sha256"], "left")
    return linked.groupBy("benchmark_name").agg(
        F.coalesce(F.sum(F.expr("if(parent_sha256 is null, n, 0)")), F.lit(0)).alias("root"),
        F.coalesce(F.sum(F.expr("if(_found, n, 0)")), F.lit(0)).alias("linked"),
        F.coalesce(F.sum(F.expr("if(parent_sha256 is not null and _found is null, n, 0)")), F.lit(0)).alias("dangling"),
    )


def of_latest_run(rows: DataFrame, latest: DataFrame) -> DataFrame:
    """Rows keyed by ``run_id``, those of each benchmark's latest run only, keyed by ``benchmark``."""
    wanted = latest.select(F.col("run_dir").alias("run_id"), F.col("benchmark_name").alias("benchmark"))
    return keep_by_key(rows, wanted, "run_id").drop("run_id")


def latest_run(runs: DataFrame, modified: str = "modified") -> DataFrame:
    """The run directory last modified, per parsed benchmark name."""
    return runs.groupBy("benchmark_name").agg(
        F.max_by("run_dir", F.struct(modified, "run_dir")).alias("run_dir"), F.max(modified).alias(modified)
    )
