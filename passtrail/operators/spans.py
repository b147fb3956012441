"""Functions inside a snapshot text: their spans come from a batched scan, all else is columns of the row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passtrail.functions import ir
from passtrail.functions import text as tx
from passtrail.operators.scan import with_spans

def parse_functions(text: Column, spans: Column) -> Column:
    """``struct(lines, functions)`` of a text with its spans; functions are (ordinal, start_line, end_line, signature, is_user, priority).

    The lines are bound once inside the expression. Were they a column of their own, a filter on a later column could be
    pushed below it and would then split the text again for every line.
    """

    def describe(lines: Column) -> Callable[[Column, Column], Column]:
        def of(s: Column, i: Column) -> Column:
            signature = tx.strip(F.get(lines, s["start"]))
            return tx.let(
                ir.function_rank(signature),
                lambda rank: F.struct(
                    i.cast("int").alias("ordinal"),
                    s["start"].alias("start_line"),
                    s["end"].alias("end_line"),
                    signature.alias("signature"),
                    (rank >= 0).alias("is_user"),
                    ir.shown_rank(rank).alias("priority"),
                ),
            )

        return of

    return tx.let(
        tx.splitlines(text),
        lambda lines: F.struct(
            lines.alias("lines"), F.transform(spans, describe(lines)).alias("functions")
        ),
    )


def span_lines(lines: Column, start: Column, end: Column) -> Column:
    return F.slice(lines, start + 1, end - start + 1)


def functions(corpus: DataFrame, text: str = "ir_text") -> DataFrame:
    """One row per function with its body; the snapshot text itself is not carried along."""
    keep = [c for c in corpus.columns if c != text]
    scanned = with_spans(corpus, text, "_spans")

    def with_body(parsed: Column) -> Column:
        return F.transform(
            parsed["functions"],
            lambda f: F.struct(
                f["ordinal"].alias("ordinal"),
                f["start_line"].alias("start_line"),
                f["end_line"].alias("end_line"),
                f["signature"].alias("signature"),
                f["is_user"].alias("is_user"),
                f["priority"].alias("priority"),
                F.array_join(span_lines(parsed["lines"], f["start_line"], f["end_line"]), "\n").alias("body"),
                (f["end_line"] - f["start_line"] + 1).alias("n_lines"),
            ),
        )

    return scanned.select(*keep, F.inline(tx.let(parse_functions(F.col(text), F.col("_spans")), with_body)))


def user_functions(corpus: DataFrame, text: str = "ir_text") -> DataFrame:
    """User functions only; (priority, ordinal) is the order in which they are shown."""
    return functions(corpus, text).filter("is_user")


def user_count(functions_: Column) -> Column:
    return F.size(F.filter(functions_, lambda f: f["is_user"]))


def function_counts(corpus: DataFrame, text: str = "ir_text") -> DataFrame:
    counts = tx.let(
        parse_functions(F.col(text), F.col("_spans"))["functions"],
        lambda fs: F.struct(user_count(fs).alias("n_user"), F.size(fs).alias("n_total")),
    )
    return with_spans(corpus, text, "_spans").withColumn("_counts", counts).select(*corpus.columns, "_counts.*")
