"""Manifest elements to corpus rows: candidates, latest run per (benchmark, pass), derived text columns, lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passtrail.functions import ir
from passtrail.functions import text as tx

CAP_BYTES = 2 * 1024 * 1024
SOURCE_LANG = "cuda-host"
CORPUS_COLUMNS = (
    "benchmark_name", "source_lang", "pass_index", "pass_class", "pass_name", "ir_text", "ir_bytes", "ir_lines",
    "ir_sha256", "parent_sha256", "truncated", "dialects_present", "source_sha256", "run_timestamp",
    "corpus_ingest_utc",
)


def explode_snapshots(manifests: DataFrame) -> DataFrame:
    """One row per manifest element, with its position in the run's manifest.

    The outer form keeps the optimizer from deriving a size filter that would parse each manifest a second time.
    """
    return manifests.select(
        "benchmark_name",
        "run_timestamp",
        "snapshot_dir",
        "source_sha256",
        "manifest_part",
        F.posexplode_outer("snapshots").alias("pos", "s"),
    ).filter("pos is not null").select(
        "benchmark_name",
        "run_timestamp",
        "source_sha256",
        (F.col("manifest_part") * (1 << 31) + F.col("pos")).alias("manifest_pos"),
        F.concat_ws("/", "snapshot_dir", "s.filename").alias("path"),
        F.col("s.index").alias("pass_index"),
        "s.pass_class",
        "s.pass_name",
        "s.filename",
        F.col("s.sha256").alias("manifest_sha256"),
        "s.parent_sha256",
        "s.roundtrip_status",
    )


_REQUIRED = ("pass_index", "pass_class", "pass_name", "filename")


def complete_elements(candidates: DataFrame) -> DataFrame:
    return candidates.dropna(subset=list(_REQUIRED))


def rejected_elements(candidates: DataFrame) -> DataFrame:
    """Elements that lack a required field; they are set aside instead of failing the job."""
    missing = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in _REQUIRED]), lambda c: c.isNotNull())
    return candidates.withColumn("missing", missing).filter(F.size("missing") > 0)


def dedup_latest(
    candidates: DataFrame,
    keys: Sequence[str] = ("benchmark_name", "pass_name"),
    recency: str = "run_timestamp",
    position: str = "manifest_pos",
) -> DataFrame:
    """The newest row per key; among equals the first by position.

    Rows of one benchmark and one time stamp come from one run directory, so the position alone settles ties. This is an
    aggregate rather than a ranking window: each task sorts and reduces a hot key to one row before the shuffle. Use it on narrow
    rows and fetch the text of the survivors afterwards.
    """
    keys = list(keys)
    rest = [c for c in candidates.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(F.col(recency), (-F.col(position)).alias("first")))
    return candidates.groupBy(*keys).agg(newest.alias("_row")).select(*keys, "_row.*").select(*candidates.columns)


def text_columns(text: str, cap_bytes: int = CAP_BYTES, dialect_chars: int | None = None) -> dict:
    """Derived columns of a snapshot text. All but ``ir_text`` describe the full text; ``dialect_chars`` can narrow the dialects."""
    full = F.col(text)
    return {
        "ir_text": tx.utf8_cap(full, cap_bytes),
        "ir_bytes": tx.byte_count(full),
        "ir_lines": tx.line_count(full),
        "ir_sha256": tx.sha256_hex(full),
        "truncated": tx.is_capped(full, cap_bytes),
        "dialects_present": ir.dialects(full, dialect_chars),
    }


def corpus_rows(survivors: DataFrame, ingest_utc: str, source_lang: str = SOURCE_LANG) -> DataFrame:
    """Put survivors with text columns into the corpus schema."""
    return survivors.withColumns(
        {
            "source_lang": F.lit(source_lang),
            "corpus_ingest_utc": F.lit(ingest_utc),
            "pass_index": F.col("pass_index").cast("int"),
        }
    ).select(*CORPUS_COLUMNS)


def corpus_order(corpus: DataFrame) -> DataFrame:
    return corpus.orderBy("benchmark_name", "pass_index", "run_timestamp", "pass_name")


def dedup_by_hash(corpus: DataFrame) -> DataFrame:
    """One row per distinct text: the first by benchmark, pass number, time stamp and pass. ``copies`` counts its rows."""
    order = F.struct("benchmark_name", "pass_index", "run_timestamp", "pass_name")
    rest = [c for c in corpus.columns if c != "ir_sha256"]
    found = corpus.groupBy("ir_sha256").agg(F.min_by(F.struct(*rest), order).alias("_row"), F.count("*").alias("copies"))
    return found.select("ir_sha256", "_row.*", "copies").select(*corpus.columns, "copies")


def lookup(corpus: DataFrame, benchmark: str | None = None, pass_name: str | None = None) -> DataFrame:
    """Rows of a benchmark, of a pass in all benchmarks, or of both; the tests reach the scan."""
    rows = corpus.filter(F.col("benchmark_name") == benchmark) if benchmark else corpus
    return rows.filter(F.col("pass_name") == pass_name) if pass_name else rows


def first_match(rows: DataFrame) -> DataFrame:
    return rows.orderBy("pass_index", "run_timestamp", "pass_name").limit(1)


def snapshot_summary(corpus: DataFrame) -> DataFrame:
    """What a reader is told about a selected row before its text is distilled."""
    from passtrail.operators.spans import function_counts

    return function_counts(corpus).select(
        "benchmark_name", "pass_name", "pass_index", "ir_lines", "ir_bytes", "n_user", "n_total"
    )
