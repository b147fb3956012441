"""Columns that know the shape of compiler-pass dumps, snapshot names and function signatures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from passtrail.functions.text import BREAKS, INLINE_SPACE, WORD, count_char, let

# The banner a compiler prints before each pass dump, and what follows it.
BANNER = "// -----// IR Dump After "
HEADER = rf"\A{BANNER}([{WORD}:]+):{INLINE_SPACE}*([{WORD}\-]+){INLINE_SPACE}*\("
# Zero-width: the places in a stream at which a header line starts. The banner is tested before the line start, as almost
# every place fails on its first character.
HEADER_START = rf"(?={HEADER[2:]})(?:\A|(?<=[{BREAKS}]))"

# Dotted operation names, run directory names, and signature markers. Java looks behind by whole code points
# only where the group itself holds a letter beyond the basic plane, hence the (redundant) mathematical A.
DIALECT = rf"(?<![{WORD}{chr(0x1D400)}])([a-z_][a-z0-9_]*)\.[a-z_][a-z0-9_]+"
RUN_DIR = r"(?d)\A(.+)-(\p{Nd}{8}-\p{Nd}{6})\n?\z"
FUNCTION_MARKERS = ("cir.func", "llvm.func")
KERNEL_MARKERS = ("device_stub", "cudalaunch", "kernel")
LIBRARY_MARKERS = (
    "std", "chrono", "random", "_zst", "__gnu", "basic_string", "allocator", "char_traits", "ratio", "duration",
    "operator",
)


def _any_of(conditions: list[Column]) -> Column:
    out = conditions[0]
    for condition in conditions[1:]:
        out = out | condition
    return out


def is_header(line: Column) -> Column:
    return line.rlike(HEADER)


def header_class(line: Column) -> Column:
    return F.regexp_extract(line, HEADER, 1)


def header_pass(line: Column) -> Column:
    return F.regexp_extract(line, HEADER, 2)


def snapshot_filename(index: Column, pass_name: Column) -> Column:
    return F.format_string("%02d_%s.mlir", index, F.regexp_replace(pass_name, rf"[^{WORD}\-]+", "_"))


def run_dir_benchmark(run_dir: Column) -> Column:
    return F.regexp_extract(run_dir, RUN_DIR, 1)


def run_dir_timestamp(run_dir: Column) -> Column:
    return F.regexp_extract(run_dir, RUN_DIR, 2)


def is_run_dir(run_dir: Column) -> Column:
    return run_dir.rlike(RUN_DIR)


def dialects(text: Column, scan_chars: int | None = None) -> Column:
    """Sorted distinct first parts of dotted names, of the whole text or, to agree with corpora made that way, of its beginning."""
    scanned = text if scan_chars is None else F.substring(text, 1, scan_chars)
    found = F.regexp_extract_all(scanned, F.lit(DIALECT), F.lit(1))
    return F.sort_array(F.array_distinct(found))


def is_function_line(line: Column) -> Column:
    return _any_of([F.contains(line, F.lit(m)) for m in FUNCTION_MARKERS])


def brace_delta(line: Column) -> Column:
    return count_char(line, "{") - count_char(line, "}")


def function_rank(signature: Column) -> Column:
    """The order in which user code is shown: 0 for main, 1 for kernels and their stubs, 2 for the rest; library code has -1.

    All is decided by substrings of the lower-cased signature. The empty signature is not user code.
    """

    def has(low: Column, *markers: str) -> Column:
        return _any_of([F.contains(low, F.lit(m)) for m in markers])

    def decide(low: Column) -> Column:
        return (
            F.when(has(low, "@main"), 0)
            .when(has(low, "device_stub", "kernel"), 1)
            .when(has(low, *KERNEL_MARKERS), 2)
            .when((low == "") | has(low, *LIBRARY_MARKERS), -1)
            .otherwise(2)
        )

    return F.when(signature.isNull(), -1).otherwise(let(F.lower(signature), decide))


def is_user_function(signature: Column) -> Column:
    return function_rank(signature) >= 0


def function_priority(signature: Column) -> Column:
    """The rank of a function among user code; library code counts as the rest."""
    return let(function_rank(signature), shown_rank)


def shown_rank(rank: Column) -> Column:
    return F.when(rank < 0, 2).otherwise(rank)
