"""Columns for batch outcomes: status names, CSV cleaning, log counts, name globs."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Exit codes of one benchmark run and the status each stands for.
STATUS_BY_EXIT_CODE = {
    0: "success",
    1: "driver_error",
    2: "compile_fail",
    3: "parse_fail",
    4: "roundtrip_fail",
    5: "partial_kept",
    124: "timeout",
    137: "killed",
}
# Line patterns of compiler diagnostics.
DIAGNOSTIC = r"(error|fatal error|warning): |errors generated"
INCLUDE_TRACE = r"\AIn file included from "


def status_of(exit_code: Column) -> Column:
    known = None
    for code, name in STATUS_BY_EXIT_CODE.items():
        known = F.when(exit_code == code, name) if known is None else known.when(exit_code == code, name)
    return known.otherwise(F.concat(F.lit("unknown_"), exit_code.cast("string")))


def csv_clean(text: Column, limit: int = 200) -> Column:
    """Make a value safe for an unquoted CSV cell, then keep its first ``limit`` characters."""
    return F.substring(F.translate(text, ',\n\r"', ";  "), 1, limit)


def snapshot_count_in(line: Column) -> Column:
    """The number in front of the word ``snapshots``, or null."""
    # The plain test spares nearly all lines the regular expression.
    number = F.regexp_extract(line, r"([0-9]+) snapshots", 1).try_cast("int")
    return F.when(F.contains(line, F.lit(" snapshots")), number)


def glob_regex(pattern: str) -> str:
    """A shell name glob as an anchored regular expression."""
    out, i = [], 0
    while i < len(pattern):
        char = pattern[i]
        close = pattern.find("]", i + 2) if char == "[" else -1
        if char == "*":
            out.append(".*")
        elif char == "?":
            out.append(".")
        elif close > 0:
            members = pattern[i + 1 : close].replace("\\", "\\\\").replace("[", "\\[").replace("&", "\\&")
            out.append("[" + ("^" + members[1:] if members[0] in "!^" else members) + "]")
            i = close
        else:
            out.append(re.escape(char))
        i += 1
    return r"(?s)\A" + "".join(out) + r"\z"
