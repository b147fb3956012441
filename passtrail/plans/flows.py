"""The four entry points, each composed from operators."""

from __future__ import annotations

import functools
import operator
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from passtrail.functions import batch as bx
from passtrail.operators import batch, chain, packing, reports, scale, segments, validity
from passtrail.operators import corpus as cp
from passtrail.operators.stores import stored
from passtrail.sinks import tables as sinks
from passtrail.sources import runs, streams, tables


def ingest_stamp(now: datetime | None = None) -> str:
    """One UTC time per job; pass the value on to make a re-run reproducible."""
    return (now or datetime.now(timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")


def capture(spark: SparkSession, root: str, large_files: bool = False, cap_bytes: int | None = None) -> DataFrame:
    """Dump streams below ``root`` to snapshots with bodies.

    Whole-file reading needs no shuffle before validity is attached. ``large_files`` reads streams beyond 2 GB in blocks; there
    ``cap_bytes`` bounds what is kept of a body, as a body of more than 2 GB is no value.
    """
    if not large_files:
        return segments.segment_streams(streams.read_streams(spark, root))
    parts = segments.segment_blocks(streams.read_stream_blocks(spark, root), cap_bytes=cap_bytes)
    # The bodies travel with the chain, in groups of 64; a narrow chain would have to be joined to bodies cut again.
    return segments.hash_chain(parts, width=64)


def run_manifests(spark: SparkSession, root: str, sources: DataFrame | None = None, large_files: bool = False) -> DataFrame:
    """The manifest documents of all dump streams below ``root``, with the outcomes of their round-trip logs.

    Snapshot rows without bodies are stored once, as the documents, their totals and the annotation use them. Whole files are read
    once, for snapshots and provenance; ``large_files`` folds the blocks of a stream instead, and no value holds a stream or a body.
    ``sources``, if given, has (run_id, source, source_text).
    """
    outcomes = validity.roundtrip_outcomes(streams.read_run_lines(spark, root, "roundtrip.log"))
    if large_files:
        blocks = streams.read_stream_blocks(spark, root)
        found = segments.segment_blocks(blocks, cap_bytes=0).drop("body")
        snapshots = segments.hash_chain(found)
        heads = segments.block_provenance(blocks, sources)
    else:
        seen = scale.settle(segments.narrow_streams(streams.read_streams(spark, root)))
        snapshots = seen.select("run_id", F.inline("snapshots"))
        count = F.size("snapshots").alias("snapshot_count")
        heads = segments.with_sources(seen.select("run_id", "stream_file", "stream_sha256", count), sources)
    return sinks.to_manifests(scale.settle(validity.annotate_roundtrip(snapshots, outcomes)), heads)


def candidates(spark: SparkSession, root: str) -> DataFrame:
    """Valid, complete manifest elements whose file exists. All of this is metadata; no text has been read."""
    listed = cp.complete_elements(validity.valid_only(cp.explode_snapshots(runs.read_manifests(spark, root))))
    return listed.join(runs.snapshot_listing(spark, root), "path", "left_semi")


def corpus_from_runs(
    spark: SparkSession,
    root: str,
    ingest_utc: str,
    source_lang: str = cp.SOURCE_LANG,
    cap_bytes: int = cp.CAP_BYTES,
    broadcast_bytes: int = scale.BROADCAST_BYTES,
    found: DataFrame | None = None,
) -> DataFrame:
    """A run tree to corpus rows; ``found`` are its candidates, if they have been stored already.

    Survivors are chosen on metadata. Where their paths are few enough to broadcast, superseded texts are dropped as they
    are read and only survivors are hashed and scanned. Beyond that the texts are measured and capped in the reading task,
    so that the shuffle by path carries capped texts.
    """
    found = scale.settle(candidates(spark, root)) if found is None else found
    survivors = cp.dedup_latest(found).drop("manifest_pos", "filename", "roundtrip_status")
    texts = runs.snapshot_texts(spark, root)
    columns = cp.text_columns("text", cap_bytes)
    if scale.fits_broadcast(survivors, broadcast_bytes):
        rows = texts.join(F.broadcast(survivors), "path").withColumns(columns)
    else:
        rows = texts.withColumns(columns).drop("text").join(survivors, "path")
    return cp.corpus_rows(rows, ingest_utc, source_lang)


def corpus_from_snapshots(
    snapshots: DataFrame,
    outcomes: DataFrame,
    runs_of: DataFrame,
    ingest_utc: str,
    source_lang: str = cp.SOURCE_LANG,
    cap_bytes: int = cp.CAP_BYTES,
) -> DataFrame:
    """Captured snapshots to corpus rows, from tables alone: no file is listed.

    ``snapshots`` are what ``capture`` gives, bodies included; ``outcomes`` are round-trip outcomes; ``runs_of`` has (run_id,
    benchmark_name, run_timestamp, source_sha256), one row per run. Validity and the latest run are decided on narrow rows, which
    are stored; only the survivors' keys meet the bodies. Starts jobs.
    """
    narrow = validity.valid_only(validity.annotate_roundtrip(snapshots.drop("body"), outcomes))
    listed = narrow.join(runs_of, "run_id").select(
        "run_id", "benchmark_name", "run_timestamp", "source_sha256", F.col("index").alias("pass_index"), "pass_class", "pass_name",
        F.col("index").cast("long").alias("manifest_pos"),
    )
    survivors = scale.settle(cp.dedup_latest(listed).drop("manifest_pos"))
    # Hashes are most of a narrow row and decide nothing, so they come with the bodies.
    bodies = snapshots.select("run_id", F.col("index").alias("pass_index"), "parent_sha256", "body")
    rows = scale.keep_by_key(bodies, survivors, ["run_id", "pass_index"])
    return cp.corpus_rows(rows.withColumns(cp.text_columns("body", cap_bytes)), ingest_utc, source_lang)


def corpus_reports(facts: DataFrame, sizes: DataFrame) -> dict[str, DataFrame]:
    """Reports of narrow corpus rows; ``sizes`` is known already."""
    return {
        "sizes": sizes,
        "distinct_dialects": reports.distinct_dialects(facts),
        "dialects": reports.dialect_frequency(facts),
        "partitions": reports.partition_report(facts),
        "planned_partitions": reports.planned_partitions(facts),
    }


def build_corpus(
    spark: SparkSession,
    root: str,
    out: str,
    source_lang: str = cp.SOURCE_LANG,
    cap_bytes: int = cp.CAP_BYTES,
    dry_run: bool = False,
    ingest_utc: str | None = None,
) -> dict[str, DataFrame]:
    """Aggregate a run tree into the corpus at ``out`` and return its reports as lazy DataFrames.

    Each text is read once. A dry run stores narrow facts of the rows, from which all reports come. A write observes its sizes as it
    goes; the other reports read narrow columns of the written table, of this job's benchmarks and stamp alone. A run tree without
    a valid snapshot is an error.
    """
    stamp = ingest_utc or ingest_stamp()
    found = scale.settle(candidates(spark, root))
    if found.isEmpty():
        raise ValueError(f"no snapshots to write below {root}")
    rows = corpus_from_runs(spark, root, stamp, source_lang, cap_bytes, found=found)
    if dry_run:
        facts = stored(reports.report_facts(rows), "corpus-facts")
        sizes = facts.agg(*reports.size_metrics(F.col("kept_bytes")))
    else:
        seen = Observation()
        sinks.write_corpus(rows, out, sizes=seen)
        kind = "n_rows long, truncated_rows long, bytes_before long, bytes_after long"
        sizes = spark.createDataFrame([tuple(seen.get[c.split()[0]] for c in kind.split(", "))], kind)
        # Benchmarks of earlier jobs keep their partitions, also those of a job with this stamp.
        mine = found.select("benchmark_name").distinct()
        written = tables.read_corpus(spark, out).filter(F.col("corpus_ingest_utc") == stamp)
        facts = written.select("benchmark_name", "ir_bytes", "truncated", "dialects_present").join(mine, "benchmark_name", "left_semi")
    return {"dedup": reports.dedup_report(found), **corpus_reports(facts, sizes)}


def prompt_rows(
    spark: SparkSession, corpus_path: str, benchmark: str, pass_name: str | None = None, max_lines: int = 200
) -> DataFrame:
    """The prompt of the first matching snapshot; an empty match is an error.

    The match is chosen by its keys alone; its text is read once, for the prompt.
    """
    corpus = tables.read_corpus(spark, corpus_path)
    keys = ("benchmark_name", "pass_name", "pass_index", "run_timestamp")
    first = cp.first_match(cp.lookup(corpus, benchmark, pass_name)).select(*keys).first()
    if first is None:
        raise ValueError(f"no snapshot for benchmark={benchmark} pass={pass_name}")
    chosen = corpus.filter(functools.reduce(operator.and_, [F.col(k).eqNullSafe(F.lit(first[k])) for k in keys]))
    return packing.prompts(chosen.select("benchmark_name", "pass_name", "pass_index", "ir_text"), max_lines)


def corpus_prompts(
    spark: SparkSession, corpus_path: str, benchmark: str | None = None, pass_name: str | None = None, max_lines: int = 200
) -> DataFrame:
    """A prompt for every row of the corpus, of a benchmark, or of a pass."""
    rows = cp.lookup(tables.read_corpus(spark, corpus_path), benchmark, pass_name)
    return packing.prompts(rows.select("benchmark_name", "pass_name", "pass_index", "ir_text"), max_lines)


def failed_bodies_dropped(snapshots: DataFrame, outcomes: DataFrame, run: str = "run_id") -> DataFrame:
    """Captured snapshots that the round trip kept, with their bodies.

    What stays is decided on narrow rows, whose keys then meet the bodies. Starts jobs.
    """
    kept = scale.settle(validity.drop_failed(snapshots.select(run, "index", "filename"), outcomes).select(run, "index"))
    return scale.keep_by_key(snapshots, kept, [run, "index"])


def runs_status(manifest_rows: DataFrame, compiled: DataFrame, run: str = "run_id") -> DataFrame:
    """Exit code and status of each run from its counts and from whether it compiled: (run, exit_code, status)."""
    code = validity.run_exit_code(
        F.col("compiler_exit"), F.col("snapshot_count"), F.col("snapshots_kept"), F.col("snapshots_dropped")
    )
    rows = compiled.join(manifest_rows, run, "left").fillna(0, subset=["snapshot_count", "snapshots_kept", "snapshots_dropped"])
    return rows.select(run, code.alias("exit_code")).withColumn("status", bx.status_of(F.col("exit_code")))


def write_run_errors(spark: SparkSession, root: str, out: str, compiled: DataFrame) -> None:
    """Diagnostics of the runs that failed to compile, and the round-trip outcomes of all runs, as tables at ``out``.

    ``compiled`` has (run_id, compiler_exit), one row per run. Streams of runs that compiled are dropped where they are read.
    """
    failed = scale.settle(compiled.filter("compiler_exit <> 0").select("run_id"))
    texts = scale.keep_by_key(streams.read_streams(spark, root).select("run_id", "stream"), failed, "run_id")
    found = texts.select("run_id", F.inline(batch.diagnostics_of(F.col("stream"))))
    outcomes = validity.roundtrip_outcomes(streams.read_run_lines(spark, root, "roundtrip.log"))
    sinks.write_error_tables(found, outcomes, out)


def summarize_batch(
    spark: SparkSession, attempts: DataFrame, logs_root: str, runs_root: str, timeout_seconds: int = 60
) -> DataFrame:
    """Summary rows of a batch from its logs and from the files in each benchmark's latest run directory.

    Each file is reduced to its few lines of interest where it is read; only those are joined.
    """
    latest = chain.latest_run(runs.run_times(spark, runs_root))
    text = F.col("text")
    logs = streams.read_log_texts(spark, logs_root).select("benchmark", batch.log_facts_of(text).alias("_facts"))
    compiled = streams.read_run_texts(spark, runs_root, "compile-errors.txt").select(
        "run_id", batch.first_line_of(text, lambda line: F.lit(True)).alias("first_diagnostic")
    )
    checked = streams.read_run_texts(spark, runs_root, "roundtrip.log").select(
        "run_id", batch.first_line_of(text, batch.is_dropped_line).alias("first_dropped")
    )
    return batch.outcome_rows(
        attempts,
        logs.select("benchmark", "_facts.*"),
        chain.of_latest_run(compiled, latest),
        chain.of_latest_run(checked, latest),
        timeout_seconds,
    )


def batch_report(summary: DataFrame) -> dict[str, DataFrame]:
    return {
        "status": reports.status_breakdown(summary),
        "failure_modes": reports.failure_modes(summary),
        "ok": reports.batch_ok(summary),
        "retention": reports.retention(summary),
    }


def batch_selection(
    listing: DataFrame, pattern: str = "*-cuda", limit: int = 20
) -> DataFrame:
    """The benchmarks a batch would attempt, each with its source file. None at all is an error. Starts a job."""
    chosen = scale.settle(batch.discover_benchmarks(listing.select(F.col("benchmark").alias("name")), pattern, limit))
    if chosen.isEmpty():
        raise ValueError(f"no benchmark matches {pattern}")
    wanted = listing.join(chosen.withColumnRenamed("name", "benchmark"), "benchmark", "left_semi")
    return batch.select_source_file(wanted)
