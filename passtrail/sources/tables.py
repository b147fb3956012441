"""Tabular inputs: the corpus, batch summaries, file listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passtrail.sources.streams import read_files

CORPUS_TYPE = (
    "source_lang string, pass_index int, pass_class string, pass_name string, ir_text string, ir_bytes bigint, "
    "ir_lines int, ir_sha256 string, parent_sha256 string, truncated boolean, dialects_present array<string>, "
    "source_sha256 string, run_timestamp string, corpus_ingest_utc string, benchmark_name string"
)
SUMMARY_TYPE = "benchmark string, exit_code int, status string, snapshots int, wall_seconds int, first_error string"


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """The corpus with its fixed schema, so that a benchmark name of digits stays a string and no file is opened early."""
    return spark.read.schema(CORPUS_TYPE).parquet(path)


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """A batch summary; cells are unquoted, an empty error is ''."""
    rows = spark.read.schema(SUMMARY_TYPE).options(header=True, quote="", enforceSchema=True).csv(path)
    return rows.fillna("", subset=["first_error"])


def file_lengths(spark: SparkSession, path: str, name_glob: str = "*.parquet") -> DataFrame:
    return read_files(spark, path, name_glob).select("path", "length")


def benchmark_listing(spark: SparkSession, root: str, name_glob: str = "*") -> DataFrame:
    """(benchmark, rel_path) of the files below each benchmark directory, for discovery and source selection."""
    anchored = read_files(spark, root, name_glob).select(
        F.substring_index("path", root.rstrip("/") + "/", -1).alias("_rest")
    )
    return anchored.filter(F.contains("_rest", F.lit("/"))).select(
        F.substring_index("_rest", "/", 1).alias("benchmark"),
        F.expr("substring(_rest, instr(_rest, '/') + 1)").alias("rel_path"),
    )
