"""Corpus, summaries, manifests and diagnostic tables on disk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from passtrail.operators.reports import size_metrics, text_bytes
from passtrail.operators.stores import stored

MANIFEST_PART = 10_000


def write_corpus(corpus: DataFrame, path: str, rows_per_group: int = 512, sizes: Observation | None = None) -> None:
    """Hive partitions by benchmark, Zstandard level 3, rows in pass order; only touched partitions are replaced.

    Rebalancing sends a benchmark to one task, and so to one file, unless it is so large that the adaptive plan splits
    it; a hot benchmark then has several files and no task holds all of it. ``sizes`` observes the rows in the tasks that write them,
    whose metrics count once, also if a task is repeated.
    """
    rows = corpus.hint("rebalance", "benchmark_name")
    if sizes is not None:
        rows = rows.observe(sizes, *size_metrics(text_bytes()))
    (
        rows.sortWithinPartitions("benchmark_name", "pass_index")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .option("parquet.compression.codec.zstd.level", "3")
        .option("parquet.block.row.count.limit", str(rows_per_group))
        # A lookup of a pass over all benchmarks skips row groups without it; a group has at most so many passes.
        .options(**_bloom("pass_name", rows_per_group))
        .partitionBy("benchmark_name")
        .parquet(path)
    )


def write_summary(summary: DataFrame, path: str) -> None:
    """Unquoted CSV; ``first_error`` must have been cleaned."""
    options = {
        "header": True,
        "quote": "",
        "emptyValue": "",
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }
    summary.write.mode("overwrite").options(**options).csv(path)


def to_manifests(
    snapshots: DataFrame, runs: DataFrame, run: str = "run_id", part_size: int = MANIFEST_PART
) -> DataFrame:
    """(run, manifest_part, manifest): JSON documents with a run's provenance, counts and ordered snapshots.

    A run of up to ``part_size`` snapshots has one document. A larger one has several, each with the run's totals and the
    next snapshots by index, so that no document has to hold an unbounded run.
    """
    status = F.col("roundtrip_status")
    element = F.struct(
        "index", "pass_class", "pass_name", "filename", "bytes", "lines", "sha256", "parent_sha256", "roundtrip_status"
    )
    part = F.floor(F.col("index") / part_size).cast("long")
    parts = snapshots.groupBy(run, part.alias("manifest_part")).agg(
        F.sort_array(F.collect_list(element)).alias("snapshots")
    )
    totals = snapshots.groupBy(run).agg(
        F.count_if(status == "ok").cast("int").alias("snapshots_kept"),
        F.count_if(status == "failed").cast("int").alias("snapshots_dropped"),
    )
    # A run without snapshots still has a document.
    heads = runs.join(totals, run, "left").fillna(0, subset=["snapshots_kept", "snapshots_dropped"])
    rows = heads.join(parts, run, "left")
    document = F.struct(
        "source",
        "source_sha256",
        "stream_file",
        "stream_sha256",
        "snapshot_count",
        F.coalesce("snapshots", F.array().cast(parts.schema["snapshots"].dataType)).alias("snapshots"),
        "snapshots_kept",
        "snapshots_dropped",
    )
    return rows.select(
        run,
        F.coalesce("manifest_part", F.lit(0)).alias("manifest_part"),
        F.to_json(document, {"ignoreNullFields": "false"}).alias("manifest"),
    )


def write_manifests(manifests: DataFrame, path: str, run: str = "run_id") -> None:
    """One JSON document per line, with its run and part."""
    manifests.select(run, "manifest_part", "manifest").write.mode("overwrite").json(path)


def write_snapshot_files(snapshots: DataFrame, path: str, run: str = "run_id") -> None:
    """Snapshot bodies as text below ``<run>/<filename>`` directories; the writer adds the final line feed."""
    body = F.expr("substring(body, 1, length(body) - 1)").alias("value")
    (
        snapshots.select(F.col(run).alias("run_id"), "filename", body)
        .write.mode("overwrite")
        .partitionBy("run_id", "filename")
        .text(path)
    )


#: Folders of an error table; a run's rows are in the one that its hash names.
ERROR_BUCKETS = 64


def error_bucket(run: Column, buckets: int = ERROR_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(run.cast("string")), F.lit(buckets)).cast("int")


def write_error_tables(
    diagnostics: DataFrame, outcomes: DataFrame, path: str, run: str = "run_id", buckets: int = ERROR_BUCKETS
) -> None:
    """Diagnostics and round-trip outcomes in a bounded number of folders, sorted by run and with bloom filters on it.

    Runs that are written again replace their rows; those of other runs in the same folders are written back. Only folders of
    the runs at hand are read and replaced. Starts jobs.
    """
    for name, rows in (("diagnostics", diagnostics), ("roundtrip", outcomes)):
        target = f"{path}/{name}"
        fresh = rows.withColumn("bucket", error_bucket(F.col(run), buckets))
        if exists(rows.sparkSession, target):
            held = rows.sparkSession.read.schema(fresh.schema).parquet(target)
            touched = held.join(fresh.select("bucket").distinct(), "bucket", "left_semi")
            others = touched.join(fresh.select(run).distinct(), run, "left_anti").select(*fresh.columns)
            # The folders that are read are the ones to be replaced, so the rows are stored in between.
            fresh = stored(others.union(fresh), f"errors-{name}")
        (
            fresh.hint("rebalance", "bucket")
            .sortWithinPartitions("bucket", run)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .options(**_bloom(run))
            .option("parquet.block.row.count.limit", "65536")
            .partitionBy("bucket")
            .parquet(target)
        )


def read_errors(spark: SparkSession, path: str, name: str, run: str | None = None, key: str = "run_id", buckets: int = ERROR_BUCKETS) -> DataFrame:
    """The table ``name`` (``diagnostics`` or ``roundtrip``), or one run's rows of it: one folder, and there few row groups, are read."""
    rows = spark.read.parquet(f"{path}/{name}")
    if run is not None:
        rows = rows.filter((F.col("bucket") == error_bucket(F.lit(run), buckets)) & (F.col(key) == F.lit(run)))
    return rows.drop("bucket")


def exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def _bloom(column: str, distinct: int = 10_000) -> dict[str, str]:
    """Options for a bloom filter on a column of each row group, for that many distinct values."""
    return {f"parquet.bloom.filter.enabled#{column}": "true", f"parquet.bloom.filter.expected.ndv#{column}": str(distinct)}
