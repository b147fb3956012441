"""Batch outcomes: diagnostics, first errors, summaries, and the choice of benchmarks and their sources."""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passtrail.functions import batch as bx
from passtrail.functions import text as tx


def to_lines(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line_no, line) of each text."""
    return texts.select(key, F.posexplode(tx.splitlines(F.col(text))).alias("line_no", "line"))


def diagnostics(lines: DataFrame, run: str = "run_id") -> DataFrame:
    """Diagnostic lines as group 0 and include traces as group 1; a line may be in both. One pass over the lines."""
    line = F.col("line")
    groups = F.filter(
        F.array(F.when(line.rlike(bx.DIAGNOSTIC), 0), F.when(line.rlike(bx.INCLUDE_TRACE), 1)),
        lambda g: g.isNotNull(),
    )
    return lines.select(run, F.explode(groups).alias("group_no"), "line_no", "line")


def _ranked(rows: DataFrame, run: str, order: list, n: int) -> DataFrame:
    # A limit on row_number() is applied in each task before the shuffle, so a hot run sends at most n rows per task.
    rank = F.row_number().over(Window.partitionBy(run).orderBy(*order))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= n)


def failure_excerpt(lines: DataFrame, run: str = "run_id", head: int = 10, tail: int = 20) -> DataFrame:
    """First diagnostics of a failed run, or its last raw lines where there are none. Ranks follow line order.

    Every line is a candidate for the tail and may be one for the diagnostics; both are cut to their limits in one pass,
    before anything is shuffled.
    """
    line = F.col("line")
    place = F.col("line_no").cast("long")

    def entry(kind: str, group_no: int, order: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.lit(group_no).alias("group_no"), order.alias("place"))

    entries = F.filter(
        F.array(
            F.when(line.rlike(bx.DIAGNOSTIC), entry("diagnostic", 0, place)),
            F.when(line.rlike(bx.INCLUDE_TRACE), entry("diagnostic", 1, place)),
            entry("raw", 2, -place),
        ),
        lambda e: e.isNotNull(),
    )
    offered = lines.select(run, "line", F.inline(entries))
    rank = F.row_number().over(Window.partitionBy(run, "kind").orderBy("group_no", "place"))
    short = offered.withColumn("rank", rank).filter(F.col("rank") <= max(head, tail))
    short = short.filter(F.col("rank") <= F.when(F.col("kind") == "raw", tail).otherwise(head))
    # At most head + tail rows per run are left for the windows below.
    known = F.max(F.col("kind") == "diagnostic").over(Window.partitionBy(run))
    size = F.count("*").over(Window.partitionBy(run, "kind")).cast("int")
    forward = F.when(F.col("kind") == "raw", size - F.col("rank") + 1).otherwise(F.col("rank"))
    return (
        short.withColumns({"_known": known, "rank": forward})
        .filter(F.col("_known") == (F.col("kind") == "diagnostic"))
        .select(run, "rank", "line", "kind")
    )


def diagnostics_of(text: Column) -> Column:
    """Diagnostics of one whole text as an array of (group_no, line_no, line), in the order they are listed."""

    def matching(lines: Column, pattern: str, group_no: int) -> Column:
        numbered = F.transform(
            lines, lambda x, i: F.struct(F.lit(group_no).alias("group_no"), i.alias("line_no"), x.alias("line"))
        )
        return F.filter(numbered, lambda e: e["line"].rlike(pattern))

    return tx.let(
        tx.splitlines(text),
        lambda lines: F.concat(matching(lines, bx.DIAGNOSTIC, 0), matching(lines, bx.INCLUDE_TRACE, 1)),
    )


def excerpt_of(text: Column, head: int = 10, tail: int = 20) -> Column:
    """What to show of one failed run's text: ``struct(kind, lines)`` with its first diagnostics or its last raw lines.

    The row-wise form of ``failure_excerpt``, for texts that are read whole: nothing is exploded, sorted or shuffled.
    """

    def show(lines: Column) -> Column:
        found = F.concat(
            F.filter(lines, lambda x: x.rlike(bx.DIAGNOSTIC)), F.filter(lines, lambda x: x.rlike(bx.INCLUDE_TRACE))
        )
        return tx.let(
            found,
            lambda hits: F.when(
                F.size(hits) > 0,
                F.struct(F.lit("diagnostic").alias("kind"), F.slice(hits, 1, head).alias("lines")),
            ).otherwise(
                F.struct(
                    F.lit("raw").alias("kind"),
                    F.slice(lines, F.greatest(F.size(lines) - tail, F.lit(0)) + 1, F.lit(tail)).alias("lines"),
                )
            ),
        )

    return tx.let(tx.splitlines(text), show)


# What is looked for in a log, as predicates on a line.
_LOG_MARKS = {
    "first_driver_error": lambda line: line.startswith("error:"),
    "first_parse_error": lambda line: F.contains(line, F.lit("parser")) | F.contains(line, F.lit("error")),
    "first_any_error": lambda line: F.contains(line, F.lit("error:")),
}


def _first(condition: Column, line: str = "line") -> Column:
    return F.min_by(F.when(condition, F.col(line)), F.when(condition, F.col("line_no")))


def log_facts(log_lines: DataFrame, key: str = "benchmark") -> DataFrame:
    """First lines of interest in each benchmark's log, from a line table.

    Lines without any mark are dropped where they are read; a benchmark that has no others keeps a row of nulls.
    """
    line = F.col("line")
    count = bx.snapshot_count_in(line)
    marked = log_lines.filter(functools.reduce(operator.or_, [mark(line) for mark in _LOG_MARKS.values()], count.isNotNull()))
    facts = marked.groupBy(key).agg(
        *[_first(mark(line)).alias(name) for name, mark in _LOG_MARKS.items()],
        F.min_by(count, F.when(count.isNotNull(), F.col("line_no"))).alias("counted_snapshots"),
    )
    return log_lines.select(key).distinct().join(facts, key, "left")


def first_line_of(text: Column, mark: Callable[[Column], Column]) -> Column:
    return F.get(F.filter(tx.splitlines(text), mark), F.lit(0))


def log_facts_of(text: Column) -> Column:
    """The facts of one whole log text as a struct, without a line table."""

    def gather(lines: Column) -> Column:
        first = [F.get(F.filter(lines, mark), F.lit(0)).alias(name) for name, mark in _LOG_MARKS.items()]
        counts = F.filter(F.transform(lines, bx.snapshot_count_in), lambda n: n.isNotNull())
        return F.struct(*first, F.get(counts, F.lit(0)).alias("counted_snapshots"))

    return tx.let(tx.splitlines(text), gather)


def first_diagnostic(found: DataFrame, key: str = "benchmark") -> DataFrame:
    return found.groupBy(key).agg(F.min_by("line", F.struct("group_no", "line_no")).alias("first_diagnostic"))


def is_dropped_line(line: Column) -> Column:
    return line.startswith("DROP")


def first_dropped(roundtrip_lines: DataFrame, key: str = "benchmark") -> DataFrame:
    return roundtrip_lines.groupBy(key).agg(_first(is_dropped_line(F.col("line"))).alias("first_dropped"))


def outcome_rows(
    attempts: DataFrame,
    facts: DataFrame,
    compile_errors: DataFrame,
    roundtrip_errors: DataFrame,
    timeout_seconds: int = 60,
) -> DataFrame:
    """Summary rows of a batch.

    ``attempts`` has (benchmark, exit_code, start_epoch, end_epoch). The others have one narrow row per benchmark: facts of
    its log, and ``first_diagnostic`` and ``first_dropped`` of its latest run.
    """
    rows = attempts.withColumn("status", bx.status_of(F.col("exit_code")))
    for extra in (facts, compile_errors, roundtrip_errors):
        rows = rows.join(extra, "benchmark", "left")
    status = F.col("status")
    specific = (
        F.when(status == "compile_fail", F.col("first_diagnostic"))
        .when(status == "roundtrip_fail", F.col("first_dropped"))
        .when(status == "driver_error", F.col("first_driver_error"))
        .when(status.isin("timeout", "killed"), F.lit(f"killed after {timeout_seconds}s"))
        .when(status == "parse_fail", F.col("first_parse_error"))
    )
    fallback = F.when(F.col("exit_code") != 0, F.col("first_any_error"))
    error = F.coalesce(F.nullif(specific, F.lit("")), fallback, F.lit(""))
    counted = F.when(F.col("exit_code").isin(0, 4, 5), F.col("counted_snapshots"))
    return rows.select(
        "benchmark",
        "exit_code",
        "status",
        F.coalesce(counted, F.lit(0)).alias("snapshots"),
        (F.col("end_epoch") - F.col("start_epoch")).cast("int").alias("wall_seconds"),
        bx.csv_clean(error).alias("first_error"),
    )


def discover_benchmarks(listing: DataFrame, pattern: str = "*-cuda", limit: int = 20) -> DataFrame:
    """Names that match a glob, sorted; the first ``limit`` of them, or all where it is not positive."""
    names = listing.select("name").filter(F.col("name").rlike(bx.glob_regex(pattern))).distinct().orderBy("name")
    return names.limit(limit) if limit > 0 else names


def select_source_file(listing: DataFrame) -> DataFrame:
    """One source per benchmark by layout preference; ``rel_path`` may be null for an empty directory.

    Ranks: 1 main.cu, 2 src/main.cu, 3 another main.cu at most one directory down, 4 any .cu at most one directory down
    (ambiguous when there are several). Equal ranks go by path. A benchmark without a source keeps a row.
    """
    path = F.col("rel_path")
    rank = (
        F.when(path == "main.cu", 1)
        .when(path == "src/main.cu", 2)
        .when(path.rlike(r"\A[^/]+/main\.cu\z"), 3)
        .when(path.rlike(r"\A([^/]+/)?[^/]*\.cu\z"), 4)
    )
    ranked = listing.select("benchmark", F.struct(rank.alias("rank"), path.alias("path")).alias("_choice"))
    usable = F.when(F.col("_choice.rank").isNotNull(), F.col("_choice"))
    chosen = ranked.groupBy("benchmark").agg(F.min(usable).alias("_first"), F.max(usable).alias("_last"))
    several = (F.col("_first.rank") == 4) & (F.col("_first.path") != F.col("_last.path"))
    return chosen.select(
        "benchmark",
        F.col("_first.path").alias("source_path"),
        F.col("_first.rank").alias("rank"),
        F.coalesce(several, F.lit(False)).alias("ambiguous"),
        F.when(F.col("_first").isNull(), "could not find a source file").alias("error"),
    )
