"""Dump streams and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passtrail.functions import ir
from passtrail.functions import text as tx
from passtrail.operators.scale import fits_broadcast
from passtrail.operators.stores import stored


def run_dir_of(path, depth: int):
    """The directory name ``depth`` levels above the file."""
    return F.get(F.split(path, "/"), F.size(F.split(path, "/")) - 1 - depth)


def read_files(spark: SparkSession, root: str, name_glob: str) -> DataFrame:
    """Files below ``root`` whose name matches; columns that are not selected are not read, content included."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", name_glob)
        .load(root)
    )


def read_streams(spark: SparkSession, root: str, name_glob: str = "snapshot-stream.txt", depth: int = 1) -> DataFrame:
    """(run_id, stream_file, stream): each dump stream as one text. For files of up to 2 GB; see ``read_stream_blocks``."""
    path = F.col("path")
    return read_files(spark, root, name_glob).select(
        run_dir_of(path, depth).alias("run_id"),
        path.alias("stream_file"),
        tx.decode_text(F.col("content")).alias("stream"),
    )


def stream_records(spark: SparkSession, root: str, name_glob: str = "snapshot-stream.txt") -> DataFrame:
    """Records of dump streams, cut where a line starts with the dump banner; large files are read by many tasks."""
    return (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", name_glob)
        .option("lineSep", "\n" + ir.BANNER)
        .text(root)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("id"),
            "value",
        )
    )


def read_stream_blocks(
    spark: SparkSession, root: str, name_glob: str = "snapshot-stream.txt", depth: int = 1
) -> DataFrame:
    """(run_id, block, text, stream_file): dump streams cut into numbered blocks of whole lines, however large a file is.

    A block's number is its file split's offset and its place in the split. Both depend on how the scan was planned, so the records
    are stored with them once, where they were read; every later use sees the same numbers. ``segment_blocks`` puts the pieces
    together. Starts a job.
    """
    records = stored(stream_records(spark, root, name_glob), "stream-records")
    # A split is read by one task, whose ids are consecutive. There is one row per split.
    begins = records.groupBy("file", "split").agg(F.min("id").alias("begin"))
    begins = F.broadcast(begins) if fits_broadcast(begins) else begins
    numbered = records.join(begins, ["file", "split"]).withColumn("nth", F.col("id") - F.col("begin"))
    # A file's first record has lost no banner. Every record but a file's last has lost a line feed; one more at the very
    # end of a stream changes nothing, as bodies are stripped there.
    first = (F.col("split") == 0) & (F.col("nth") == 0)
    text = F.concat(F.when(first, F.lit("")).otherwise(F.lit(ir.BANNER)), F.col("value"), F.lit("\n"))
    return numbered.select(
        run_dir_of(F.col("file"), depth).alias("run_id"),
        # A split has fewer records than bytes, so offset plus place is unique and ordered within a file.
        (F.col("split") + F.col("nth")).alias("block"),
        tx.decode_text(text.cast("binary")).alias("text"),
        # Spelled as the whole-file source spells it.
        F.regexp_replace("file", r"\Afile:///", "file:/").alias("stream_file"),
    )


def read_log_texts(spark: SparkSession, root: str, name_glob: str = "*.log") -> DataFrame:
    """(benchmark, text) of per-benchmark log files."""
    return read_files(spark, root, name_glob).select(
        F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?\z", 1).alias("benchmark"),
        tx.decode_text(F.col("content")).alias("text"),
    )


def read_logs(spark: SparkSession, root: str, name_glob: str = "*.log") -> DataFrame:
    """(benchmark, line_no, line) of per-benchmark log files."""
    texts = read_log_texts(spark, root, name_glob)
    return texts.select("benchmark", F.posexplode(tx.splitlines(F.col("text"))).alias("line_no", "line"))


def read_run_texts(spark: SparkSession, root: str, file_name: str) -> DataFrame:
    """(run_id, text) of one named text file in each run directory, such as a round-trip log."""
    return read_files(spark, root, file_name).select(
        run_dir_of(F.col("path"), 1).alias("run_id"), tx.decode_text(F.col("content")).alias("text")
    )


def read_run_lines(spark: SparkSession, root: str, file_name: str) -> DataFrame:
    """(run_id, line_no, line) of such a file."""
    texts = read_run_texts(spark, root, file_name)
    return texts.select("run_id", F.posexplode(tx.splitlines(F.col("text"))).alias("line_no", "line"))
