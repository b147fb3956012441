"""Registered queries: each runs one or more operators over whole tables and returns flat columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passtrail.functions import batch as bx
from passtrail.functions import ir
from passtrail.functions import text as tx
from passtrail.operators import batch, block_spans, chain, packing, reports, scale, segments, spans, validity
from passtrail.operators import corpus as cp
from passtrail.plans import flows, views
from passtrail.sinks.tables import MANIFEST_PART, to_manifests
from passtrail.sources import runs as run_sources

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

INGEST_UTC = "2024-01-01T00:00:00Z"
QUERY_CAP = 4096


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Text columns


@query
def decode_text(spark, base):
    """Bytes with mixed line ends and broken sequences, made from each document."""
    content = F.concat(
        F.replace("text", F.lit(". "), F.lit(".\r\n")).cast("binary"), F.lit(b"\r\xff"), F.lit("end").cast("binary")
    )
    text = tx.decode_text(content)
    return views.documents(spark, base).select(
        "doc_id", tx.sha256_hex(text).alias("sha256"), tx.byte_count(text).alias("bytes"),
        tx.line_count(text).alias("lines"),
    )


@query
def line_table(spark, base):
    return batch.to_lines(views.documents(spark, base), "doc_id", "text")


@query
def finish_body(spark, base):
    body = tx.finish_body(F.concat(F.col("text"), F.lit(" \t\n   \n")))
    return views.documents(spark, base).select(
        "doc_id", tx.sha256_hex(body).alias("sha256"), tx.byte_count(body).alias("bytes")
    )


@query
def cap_text(spark, base):
    text = F.col("text")
    return (
        views.documents(spark, base)
        .select("doc_id", tx.utf8_cap(text, QUERY_CAP).alias("capped"), tx.is_capped(text, QUERY_CAP).alias("truncated"))
        .select("doc_id", "truncated", tx.sha256_hex(F.col("capped")).alias("sha256"),
                tx.byte_count(F.col("capped")).alias("bytes"))
    )


@query
def dialects(spark, base):
    return views.pages(spark, base).select(
        "page_id", F.array_join(ir.dialects(F.col("html")), ",").alias("dialects")
    )


@query
def snapshot_filename(spark, base):
    name = F.concat("pass_name", F.lit(" / "), "pass_class")
    return views.snapshots(spark, base).select(
        "run_id", "pass_index", ir.snapshot_filename(F.col("pass_index"), name).alias("filename")
    )


@query
def run_dir_parse(spark, base):
    return run_sources.scan_runs(views.run_listing(spark, base)).select("run_dir", "benchmark_name", "run_timestamp")


# Segmentation and chain


@query
def segment_stream(spark, base):
    found = segments.segment_blocks(views.stream_blocks(spark, base))
    return found.select("run_id", "index", "pass_class", "pass_name", "body")


@query
def segment_rows(spark, base):
    return segments.segment_streams(views.streams(spark, base)).select("run_id", *segments.SNAPSHOT_COLUMNS)


@query
def segment_provenance(spark, base):
    streams = views.streams(spark, base)
    return segments.run_provenance(streams, streams.select("run_id", "source", "source_text")).select(
        "run_id", "source", "source_sha256", "stream_file", "stream_sha256", "snapshot_count"
    )


def _chained(spark, base):
    """Narrow snapshot rows with their hash chain."""
    text = F.col("ir_text")
    rows = views.snapshots(spark, base).withColumns(
        {"sha256": tx.sha256_hex(text), "bytes": tx.byte_count(text), "lines": tx.line_count(text)}
    )
    return segments.hash_chain(rows.drop("ir_text"), "run_id", "pass_index")


@query
def hash_chain(spark, base):
    return _chained(spark, base).select(
        "run_id", "pass_index", "bytes", "lines", "sha256", "parent_sha256"
    )


# Validity


def _named(spark, base):
    return views.snapshots(spark, base).select(
        "run_id",
        F.col("pass_index").alias("index"),
        ir.snapshot_filename(F.col("pass_index"), F.col("pass_name")).alias("filename"),
        "roundtrip_status",
    )


def _outcomes(spark, base):
    line = F.when(F.col("roundtrip_status") == "ok", F.concat(F.lit("OK   "), "filename")).otherwise(
        F.concat(F.lit("DROP "), "filename", F.lit(" (roundtrip failed, exit "), "run_id", F.lit(")"))
    )
    log = _named(spark, base).select("run_id", F.col("index").alias("line_no"), line.alias("line"))
    return validity.roundtrip_outcomes(log)


@query
def roundtrip_outcomes(spark, base):
    return _outcomes(spark, base)


@query
def roundtrip_annotate(spark, base):
    return validity.annotate_roundtrip(_named(spark, base).drop("roundtrip_status"), _outcomes(spark, base))


@query
def drop_failed(spark, base):
    return validity.drop_failed(_named(spark, base), _outcomes(spark, base)).select("run_id", "index", "filename")


@query
def dropped_only(spark, base):
    return validity.dropped_only(_named(spark, base), _outcomes(spark, base)).select("run_id", "index", "filename")


@query
def kept_dropped(spark, base):
    return validity.kept_dropped(_named(spark, base))


@query
def run_status(spark, base):
    """Status of every run, some of which failed to compile."""
    code = validity.run_exit_code(
        F.when(F.col("run_id") % 10 == 0, 1).otherwise(0),
        F.col("snapshot_count"), F.col("snapshots_kept"), F.col("snapshots_dropped"),
    )
    return (
        validity.kept_dropped(_named(spark, base))
        .withColumn("exit_code", code)
        .withColumn("status", bx.status_of(F.col("exit_code")))
    )


def _manifests(spark, base, part_size):
    """(run_id, manifest_part, manifest) of all runs."""
    rows = _chained(spark, base).withColumns(
        {
            "index": F.col("pass_index"),
            "filename": ir.snapshot_filename(F.col("pass_index"), F.col("pass_name")),
        }
    )
    heads = rows.groupBy("run_id").agg(F.count("*").cast("int").alias("snapshot_count")).withColumns(
        {
            "source": F.concat(F.lit("src/"), F.col("run_id"), F.lit(".cu")),
            "source_sha256": F.when(F.col("run_id") % 3 != 0, tx.sha256_hex(F.col("run_id").cast("string"))),
            "stream_file": F.lit("snapshot-stream.txt"),
            "stream_sha256": F.lit(None).cast("string"),
        }
    )
    return to_manifests(rows, heads, part_size=part_size)


@query
def manifest_roundtrip(spark, base):
    """Encode each run's manifest as JSON, decode it, and list its elements."""
    documents = _manifests(spark, base, MANIFEST_PART).withColumnRenamed("manifest", "raw")
    decoded = run_sources.decode_manifests(documents)
    return decoded.select(
        "run_id", "source_sha256", F.col("manifest.snapshots_kept").alias("snapshots_kept"),
        F.col("manifest.snapshot_count").alias("snapshot_count"), F.inline_outer("manifest.snapshots"),
    ).filter("index is not null")


@query
def manifest_elements(spark, base):
    """Candidates from manifests in parts, some of which lack the source hash's key or have an element whose index is no number."""
    documents = _manifests(spark, base, 3)
    keyless = F.regexp_replace("manifest", r'"source_sha256":(null|"[^"]*"),', "")
    raw = F.when(F.col("run_id") % 5 == 2, keyless).otherwise(F.col("manifest"))
    raw = F.when(F.col("run_id") % 7 == 3, F.replace(raw, F.lit('"index":1,'), F.lit('"index":"one",'))).otherwise(raw)
    decoded = run_sources.decode_manifests(documents.withColumn("raw", raw)).select(
        F.concat(F.lit("b"), F.col("run_id") % 20).alias("benchmark_name"), F.col("run_id").cast("string").alias("run_timestamp"),
        F.concat(F.lit("runs/"), "run_id").alias("snapshot_dir"), "source_sha256", "manifest_part",
        F.col("manifest.snapshots").alias("snapshots"),
    )
    return cp.complete_elements(cp.explode_snapshots(decoded))


# Corpus


def _valid(spark, base):
    return validity.valid_only(views.snapshots(spark, base).drop("ir_text"))


def _candidates(spark, base):
    return validity.valid_only(_chained(spark, base))


@query
def valid_only(spark, base):
    return _valid(spark, base).select("run_id", "pass_index", "pass_name")


@query
def dedup_latest(spark, base):
    return cp.dedup_latest(_valid(spark, base)).select("benchmark_name", "pass_name", "run_timestamp", "pass_index")


@query
def corpus_order(spark, base):
    ordered = cp.corpus_order(cp.dedup_latest(_valid(spark, base)))
    return ordered.select("benchmark_name", "pass_index", "pass_name", "run_timestamp")


@query
def dedup_report(spark, base):
    return reports.dedup_report(_valid(spark, base))


def _document_corpus(spark, base):
    """The newest document per (source, language) as corpus rows: chosen on narrow rows, text fetched afterwards."""
    docs = views.document_snapshots(spark, base)
    survivors = cp.dedup_latest(docs.drop("text"))
    rows = scale.keep_by_key(docs.select("doc_id", "text"), survivors, "doc_id")
    nothing = F.lit(None).cast("string")
    full = rows.withColumns({**cp.text_columns("text"), "parent_sha256": nothing, "source_sha256": nothing})
    return cp.corpus_rows(full, INGEST_UTC)


def _flat(corpus):
    return corpus.withColumn("dialects_present", F.array_join("dialects_present", ","))


@query
def corpus_rows(spark, base):
    return _flat(_document_corpus(spark, base))


def _all_documents(spark, base):
    """Every document with its corpus text columns, without deduplication."""
    return views.document_snapshots(spark, base).withColumns(cp.text_columns("text", QUERY_CAP)).drop("text")


@query
def size_report(spark, base):
    return reports.size_report(_all_documents(spark, base))


@query
def partition_report(spark, base):
    return reports.partition_report(_all_documents(spark, base))


@query
def planned_partitions(spark, base):
    return reports.planned_partitions(_valid(spark, base))


@query
def compression_report(spark, base):
    """Text bytes of the documents against a listing of files, for which the pages stand in."""
    files = views.pages(spark, base).select(F.octet_length("html").cast("long").alias("length"))
    return reports.compression_report(views.documents(spark, base).select(F.col("text").alias("ir_text")), files)


def _page_dialects(spark, base):
    return views.pages(spark, base).select(ir.dialects(F.col("html")).alias("dialects_present"))


@query
def dialect_frequency(spark, base):
    return reports.dialect_frequency(_page_dialects(spark, base))


@query
def distinct_dialects(spark, base):
    return reports.distinct_dialects(_page_dialects(spark, base))


@query
def pass_frequency(spark, base):
    return reports.pass_frequency(_valid(spark, base))


@query
def snapshots_per_benchmark(spark, base):
    tried = views.run_listing(spark, base).select(F.col("run_dir").alias("benchmark"))
    return reports.snapshots_per_benchmark(_valid(spark, base), tried)


@query
def capture_to_corpus(spark, base):
    """Dump streams to corpus rows: cut, chained, judged by round-trip outcomes, the latest run of each (benchmark, pass) kept."""
    streams = views.streams(spark, base)
    snapshots = segments.segment_streams(streams)
    line = F.concat(F.when(F.col("bytes") % 7 == 0, "DROP ").otherwise("OK   "), "filename")
    outcomes = validity.roundtrip_outcomes(snapshots.select("run_id", line.alias("line")))
    runs_of = streams.select(
        "run_id", F.concat(F.lit("b"), F.col("run_id") % 20).alias("benchmark_name"),
        F.concat(F.lit("20240101-"), F.lpad((F.col("run_id") % 50).cast("string"), 6, "0")).alias("run_timestamp"),
        F.lit(None).cast("string").alias("source_sha256"),
    )
    # Time stamps tie, so the benchmark is a run's own here but for every twentieth.
    runs_of = runs_of.withColumn("benchmark_name", F.concat("benchmark_name", F.lit("-"), F.floor(F.col("run_id") / 50).cast("string")))
    return _flat(flows.corpus_from_snapshots(snapshots, outcomes, runs_of, INGEST_UTC))


@query
def ir_hash_dedup(spark, base):
    """Documents of one text are one snapshot."""
    rows = _all_documents(spark, base).select("benchmark_name", "pass_name", "pass_index", "run_timestamp", "ir_sha256")
    return cp.dedup_by_hash(rows)


@query
def lookup_pass(spark, base):
    """One pass in all benchmarks."""
    return cp.lookup(views.document_snapshots(spark, base), pass_name="de").select("benchmark_name", "pass_name", "pass_index")


@query
def lookup(spark, base):
    return cp.lookup(views.document_snapshots(spark, base), "src3", "en").select(
        "benchmark_name", "pass_name", "pass_index"
    )


@query
def lookup_first(spark, base):
    chosen = cp.first_match(cp.lookup(views.document_snapshots(spark, base), "src3"))
    return chosen.select("benchmark_name", "pass_name", "pass_index", tx.sha256_hex(F.col("text")).alias("sha256"))


def _linked_corpus(spark, base):
    latest = cp.dedup_latest(_candidates(spark, base)).withColumnRenamed("sha256", "ir_sha256")
    return scale.settle(
        latest.select("benchmark_name", "pass_name", "pass_index", "run_timestamp", "ir_sha256", "parent_sha256")
    )


@query
def parent_links(spark, base):
    return chain.parent_links(_linked_corpus(spark, base))


@query
def chain_report(spark, base):
    return chain.chain_report(_linked_corpus(spark, base))


@query
def latest_run(spark, base):
    return chain.latest_run(run_sources.scan_runs(views.run_listing(spark, base)))


# Batch


def _summary(spark, base):
    return views.batch(spark, base).select(
        "benchmark",
        "exit_code",
        bx.status_of(F.col("exit_code")).alias("status"),
        "snapshots",
        "wall_seconds",
        bx.csv_clean(F.col("raw_error")).alias("first_error"),
    )


@query
def batch_summary(spark, base):
    return _summary(spark, base)


@query
def status_breakdown(spark, base):
    return reports.status_breakdown(_summary(spark, base))


@query
def failure_modes(spark, base):
    return reports.failure_modes(_summary(spark, base))


@query
def not_success(spark, base):
    return reports.not_success(_summary(spark, base)).select("benchmark", "status")


@query
def batch_ok(spark, base):
    return reports.batch_ok(_summary(spark, base))


@query
def retention(spark, base):
    return reports.retention(_summary(spark, base))


@query
def diagnostics(spark, base):
    return batch.diagnostics(views.log_lines(spark, base), "benchmark")


@query
def failure_excerpt(spark, base):
    return batch.failure_excerpt(views.log_lines(spark, base), "benchmark")


@query
def log_facts(spark, base):
    return batch.log_facts(views.log_lines(spark, base))


@query
def first_error(spark, base):
    """Summary rows of a batch with one attempt per user; a run's notes stand in for its round-trip log."""
    lines = views.log_lines(spark, base)
    roundtrip = lines.filter(F.col("line").startswith("note")).withColumn(
        "line", F.concat(F.lit("DROP "), "line")
    )
    attempts = views.attempts(spark, base)
    return batch.outcome_rows(
        attempts,
        batch.log_facts(lines),
        batch.first_diagnostic(batch.diagnostics(lines, "benchmark")),
        batch.first_dropped(roundtrip),
    )


@query
def text_diagnostics(spark, base):
    """Diagnostics of whole logs."""
    return views.log_texts(spark, base).select("run_id", F.inline(batch.diagnostics_of(F.col("text"))))


@query
def text_excerpt(spark, base):
    """Excerpts of whole logs; some logs have no diagnostics."""
    shown = views.log_texts(spark, base).select("run_id", batch.excerpt_of(F.col("text")).alias("e"))
    return shown.select("run_id", "e.kind", F.array_join("e.lines", "\n").alias("shown"))


@query
def text_log_facts(spark, base):
    facts = views.log_texts(spark, base).select("run_id", batch.log_facts_of(F.col("text")).alias("f"))
    return facts.select("run_id", "f.*")


@query
def discover_benchmarks(spark, base):
    return batch.discover_benchmarks(views.listing(spark, base).withColumnRenamed("benchmark", "name"))


@query
def discover_all_benchmarks(spark, base):
    return batch.discover_benchmarks(views.listing(spark, base).withColumnRenamed("benchmark", "name"), "*-cuda", 0)


@query
def select_source_file(spark, base):
    return batch.select_source_file(views.listing(spark, base))


# Functions and prompts


@query
def function_spans(spark, base):
    return spans.functions(views.modules(spark, base)).select("pass_index", "ordinal", "start_line", "end_line")


@query
def functions(spark, base):
    return spans.functions(views.modules(spark, base)).select(
        "benchmark_name", "pass_name", "pass_index", "ordinal", "signature", "n_lines",
        tx.sha256_hex(F.col("body")).alias("body_sha256"),
    )


@query
def functions_in_blocks(spark, base):
    """The functions of modules that come in blocks."""
    found = block_spans.functions_in_blocks(views.module_blocks(spark, base), ["pass_index"])
    return found.select(
        "pass_index", "ordinal", "signature", "is_user", "priority", "n_lines", tx.sha256_hex(F.col("body")).alias("body_sha256")
    )


@query
def user_functions(spark, base):
    return spans.user_functions(views.modules(spark, base)).select(
        "pass_index", "ordinal", "priority", "signature", "n_lines"
    )


@query
def snapshot_summary(spark, base):
    text = F.col("ir_text")
    measured = views.modules(spark, base).withColumns(
        {"ir_lines": tx.line_count(text), "ir_bytes": tx.byte_count(text)}
    )
    return cp.snapshot_summary(measured)


@query
def pack_signal(spark, base):
    return packing.signal(views.modules(spark, base)).select(
        "pass_index", "n_user", "n_total", tx.sha256_hex(F.col("signal")).alias("signal_sha256"),
        F.length("signal").alias("signal_chars"),
    )


@query
def pack_signal_tight(spark, base):
    """A budget that clips and omits most functions."""
    return packing.signal(views.modules(spark, base), 24).select("pass_index", "n_user", "n_total", "signal")


@query
def prompts(spark, base):
    rows = packing.prompts(views.modules(spark, base))
    system, user = F.get("messages", F.lit(0)), F.get("messages", F.lit(1))
    return rows.select(
        "benchmark_name", "pass_name", "pass_index", "n_user", "n_total",
        system["role"].alias("first_role"), tx.sha256_hex(system["content"]).alias("system_sha256"),
        user["role"].alias("second_role"), tx.sha256_hex(user["content"]).alias("user_sha256"),
    )
