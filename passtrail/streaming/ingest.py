"""Incremental ingest: new run manifests update the corpus, batch by batch.

A file stream names the manifests that have not been seen. Of each batch the valid, complete elements whose files exist compete with
what the corpus holds of the same (benchmark, pass): the latest run wins, by narrow rows. Only partitions of benchmarks with a new
winner are written. A batch that comes again, whole or in part, finds its own rows and gives the same ones, so a restart needs no
ledger beyond the stream's checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passtrail.functions import text as tx
from passtrail.operators import corpus as cp
from passtrail.operators import scale, validity
from passtrail.operators.stores import stored
from passtrail.sinks import tables as sinks
from passtrail.sources import runs, tables

_KEY = ["benchmark_name", "pass_name"]


def manifest_stream(spark: SparkSession, root: str, files_per_batch: int = 1000) -> DataFrame:
    """Manifest files below ``<root>/*/snapshots`` as they appear. A run's manifest has to be put in place after its snapshots."""
    return (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", "manifest*.json")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(f"{root}/*/snapshots")
    )


def merge_batch(
    files: DataFrame, out: str, ingest_utc: str, source_lang: str = cp.SOURCE_LANG, cap_bytes: int = cp.CAP_BYTES
) -> int:
    """Bring the manifests ``files`` (path, content) into the corpus at ``out``; the number of rows that are new in it.

    Where time stamps are equal the smaller pass index wins, and the newer reading of the same element. The folders of the
    batch are listed by the driver, whose number the stream bounds. Starts jobs.
    """
    spark = files.sparkSession
    documents = stored(runs.manifest_documents(files).filter("manifest is not null"), "ingest-manifests")
    folders = [r["snapshot_dir"] for r in documents.select("snapshot_dir").distinct().collect()]
    if not folders:
        return 0
    listed = cp.complete_elements(validity.valid_only(cp.explode_snapshots(runs.of_documents(documents))))
    texts = spark.read.format("binaryFile").load(folders)
    found = stored(cp.dedup_latest(listed.join(texts.select("path"), "path", "left_semi")), "ingest-found")
    held = tables.read_corpus(spark, out) if sinks.exists(spark, out) else spark.createDataFrame([], tables.CORPUS_TYPE)
    best = held.select(*_KEY, F.struct("run_timestamp", (-F.col("pass_index")).alias("place")).alias("held"))
    newer = F.col("held").isNull() | (F.struct("run_timestamp", (-F.col("pass_index")).alias("place")) >= F.col("held"))
    winners = stored(found.join(best, _KEY, "left").filter(newer).drop("held", "manifest_pos", "filename", "roundtrip_status"), "ingest-winners")
    count = winners.count()
    if not count:
        return 0
    read = scale.keep_by_key(texts.select("path", tx.decode_text(F.col("content")).alias("text")), winners, "path")
    fresh = cp.corpus_rows(read.withColumns(cp.text_columns("text", cap_bytes)), ingest_utc, source_lang)
    touched = held.join(winners.select("benchmark_name").distinct(), "benchmark_name", "left_semi")
    kept = touched.join(winners.select(*_KEY), _KEY, "left_anti").select(*fresh.columns)
    # The partitions that are read are the ones to be replaced, so the rows are stored in between.
    sinks.write_corpus(stored(kept.unionByName(fresh), "ingest-rows"), out)
    return count


def ingest_new_runs(
    spark: SparkSession, root: str, out: str, state: str, ingest_utc: str, files_per_batch: int = 1000, **settings
) -> None:
    """Bring all manifests that this stream has not seen into the corpus and return. ``state`` is the stream's checkpoint folder."""
    query = (
        manifest_stream(spark, root, files_per_batch)
        .writeStream.foreachBatch(lambda files, _: merge_batch(files, out, ingest_utc, **settings) and None)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
