"""Validity outcomes of snapshots: annotate, drop, count, and derive a run's status. Failing rows never fail the run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def roundtrip_outcomes(log_lines: DataFrame, run: str = "run_id") -> DataFrame:
    """(run, filename, outcome, exit_code) from the lines of a round-trip log."""
    pattern = r"\A(OK|DROP) +(\S+)(?: \(roundtrip failed, exit (\d+)\))?"
    line = F.col("line")
    return log_lines.filter(line.rlike(pattern)).select(
        run,
        F.regexp_extract(line, pattern, 2).alias("filename"),
        F.regexp_extract(line, pattern, 1).alias("outcome"),
        F.regexp_extract(line, pattern, 3).try_cast("int").alias("exit_code"),
    )


def kept_files(outcomes: DataFrame, run: str = "run_id") -> DataFrame:
    return outcomes.filter("outcome = 'OK'").select(run, "filename").distinct()


def annotate_roundtrip(snapshots: DataFrame, outcomes: DataFrame, run: str = "run_id") -> DataFrame:
    """``roundtrip_status`` is ok for a kept file and failed for any other."""
    kept = kept_files(outcomes, run).withColumn("_kept", F.lit(True))
    status = F.when(F.col("_kept"), "ok").otherwise("failed")
    return snapshots.join(kept, [run, "filename"], "left").withColumn("roundtrip_status", status).drop("_kept")


def drop_failed(snapshots: DataFrame, outcomes: DataFrame, run: str = "run_id") -> DataFrame:
    return snapshots.join(kept_files(outcomes, run), [run, "filename"], "left_semi")


def dropped_only(snapshots: DataFrame, outcomes: DataFrame, run: str = "run_id") -> DataFrame:
    return snapshots.join(kept_files(outcomes, run), [run, "filename"], "left_anti")


def kept_dropped(annotated: DataFrame, run: str = "run_id") -> DataFrame:
    status = F.col("roundtrip_status")
    return annotated.groupBy(run).agg(
        F.count("*").cast("int").alias("snapshot_count"),
        F.count_if(status == "ok").cast("int").alias("snapshots_kept"),
        F.count_if(status == "failed").cast("int").alias("snapshots_dropped"),
    )


def run_exit_code(compiler_exit: Column, count: Column, kept: Column, dropped: Column) -> Column:
    return (
        F.when(compiler_exit != 0, 2)
        .when(F.coalesce(count, F.lit(0)) == 0, 3)
        .when(dropped == 0, 0)
        .when(kept == 0, 4)
        .otherwise(5)
    )


def valid_only(snapshots: DataFrame) -> DataFrame:
    """A missing status, as left by a killed run, is not valid."""
    return snapshots.filter(F.col("roundtrip_status").eqNullSafe("ok"))
