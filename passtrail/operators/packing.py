"""Distil snapshots into line-budgeted texts and chat prompts. Everything happens inside the row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passtrail.functions import text as tx
from passtrail.operators.scan import with_spans
from passtrail.operators.spans import parse_functions

# Texts that appear in the output.
MORE_DECLARATIONS = "// ... (%d more type/attr declarations)"
CLIPPED = "    // ... (function body truncated to fit budget)"
MORE_FUNCTIONS = "// ... (%d more user functions omitted for length)"
SYSTEM_PROMPT = (
    "You are a compiler engineer fluent in MLIR and Python. "
    "You are given the SIGNAL portion of an MLIR module (ClangIR/LLVM "
    "dialects) produced by lowering a CUDA/C++ program. Library boilerplate "
    "has been stripped; what remains is the user's own functions (main, "
    "CUDA kernel stubs, helpers). Write a short, readable Python program "
    "that performs the same high-level computation. Focus on observable "
    "behavior, not literal op-by-op translation. "
    "Output only a Python code block and one or two sentences of explanation."
)
USER_PROMPT = (
    "Benchmark: %s\n"
    "Pass stage: %s (index %d)\n"
    "Kept %d user functions out of %d total in the module.\n\n"
    "MLIR (signal only):\n```mlir\n%s\n```\n\n"
    "Write equivalent Python."
)


def trimmed_header(header: Column, keep: int = 8) -> Column:
    """The first header lines, and a line that counts the rest."""
    rest = F.size(header) - keep
    more = F.when(rest > 0, F.array(F.format_string(MORE_DECLARATIONS, rest))).otherwise(F.array().cast("array<string>"))
    return F.concat(F.slice(header, 1, keep), more)


def in_order(functions: Column) -> Column:
    """User functions as they are shown: by rank, and within a rank as they come."""

    def of_rank(rank: int) -> Column:
        return F.filter(functions, lambda f: f["is_user"] & (f["priority"] == rank))

    return F.concat(*[of_rank(rank) for rank in range(3)])


def _length(lines: Column, f: Column) -> Column:
    """Lines of a function's body; a last line that is empty does not count."""
    return f["end_line"] - f["start_line"] + 1 - F.when(F.get(lines, f["end_line"]) == "", 1).otherwise(0)


def ends_of(lengths: Column) -> Column:
    """The running sum of lengths, each with the blank line that follows a body."""
    start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("ends"))

    def step(a: Column, n: Column) -> Column:
        total = a["sum"] + n + 1
        return F.struct(total.alias("sum"), F.array_append(a["ends"], total).alias("ends"))

    return F.aggregate(lengths, start, step, lambda a: a["ends"])


def _shown(lines: Column, first: Column, budget: Column) -> Column:
    """Blocks of lines of the functions that begin within the budget, the last of them cut to what is left.

    A function takes two lines at least, so ``first`` need not hold more of them than half of the budget. Where each one ends
    follows from the lengths; only bodies that are shown are put together.
    """

    def blocks(ends: Column) -> Column:
        def begins(i: Column) -> Column:
            return F.when(i == 0, 0).otherwise(F.get(ends, i - 1))

        inside = F.size(F.filter(ends, lambda end, i: begins(i) < budget))

        def block(f: Column, i: Column) -> Column:
            length, left = _length(lines, f), budget - begins(i)
            whole = F.slice(lines, f["start_line"] + 1, F.least(length, left))
            return F.concat(whole, F.when(length > left, F.array(F.lit(CLIPPED), F.lit(""))).otherwise(F.array(F.lit(""))))

        return F.transform(F.slice(first, F.lit(1), inside), block)

    return tx.let(ends_of(F.transform(first, lambda f: _length(lines, f))), blocks)


def signal_of(text: Column, spans: Column, max_lines: int) -> Column:
    """``struct(signal, n_user, n_total)`` of a snapshot text with its spans, as one expression over one parse of the text."""

    def clip_top(parsed: Column) -> Column:
        return F.array_join(F.slice(parsed["lines"], F.lit(1), F.lit(max_lines)), "\n")

    def assemble(parsed: Column, user: Column) -> Column:
        first_start = F.coalesce(F.get(parsed["functions"], F.lit(0))["start_line"], F.lit(0))
        top = trimmed_header(tx.drop_last_empty(F.slice(parsed["lines"], F.lit(1), first_start)))

        def with_top(above: Column) -> Column:
            packed = _shown(parsed["lines"], first, F.lit(max_lines) - F.size(above))
            return tx.let(packed, lambda blocks: F.array_join(F.concat(above, F.flatten(blocks), omitted(blocks)), "\n"))

        def omitted(blocks: Column) -> Column:
            left_out = F.size(user) - F.size(blocks)
            return F.when(left_out > 0, F.array(F.format_string(MORE_FUNCTIONS, left_out))).otherwise(
                F.array().cast("array<string>")
            )

        first = F.slice(user, F.lit(1), F.lit(max_lines // 2 + 1))

        return tx.let(F.array_append(top, F.lit("")), with_top)

    def result(parsed: Column) -> Column:
        return tx.let(
            in_order(parsed["functions"]),
            lambda u: F.struct(
                F.when(F.size(u) == 0, clip_top(parsed)).otherwise(assemble(parsed, u)).alias("signal"),
                F.size(u).alias("n_user"),
                F.size(parsed["functions"]).alias("n_total"),
            ),
        )

    return tx.let(parse_functions(text, spans), result)


def signal(corpus: DataFrame, max_lines: int = 200, text: str = "ir_text") -> DataFrame:
    """Replace each snapshot's text by ``signal``, ``n_user`` and ``n_total``."""
    if max_lines < 0:
        raise ValueError("max_lines must not be negative")
    keep = [c for c in corpus.columns if c != text]
    found = signal_of(F.col(text), F.col("_spans"), max_lines).alias("_signal")
    return with_spans(corpus, text, "_spans").select(*keep, found).select(*keep, "_signal.*")


def prompts(corpus: DataFrame, max_lines: int = 200, text: str = "ir_text") -> DataFrame:
    """Chat messages of each snapshot: a constant system text and a user text with the distilled signal."""

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    user = F.format_string(USER_PROMPT, "benchmark_name", "pass_name", "pass_index", "n_user", "n_total", "signal")
    return signal(corpus, max_lines, text).select(
        "benchmark_name",
        "pass_name",
        "pass_index",
        "n_user",
        "n_total",
        F.array(message("system", F.lit(SYSTEM_PROMPT)), message("user", user)).alias("messages"),
    )
