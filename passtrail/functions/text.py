"""Text columns with Python's text semantics: decoding, line splitting, stripping, capping, measuring."""

from __future__ import annotations

import operator
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes for Java regular expressions. Java's own \s, \w and \b are ASCII by default, so the
# Unicode classes are spelled out. BREAKS are the characters that end a line, SPACE is Unicode white space, WORD is
# letter, digit or underscore.
BREAKS = r"\n\x0b\x0c\r\x1c\x1d\x1e\x85\x{2028}-\x{2029}"
RARE_BREAKS = "\x0b\x0c\r\x1c\x1d\x1e\x85\u2028\u2029"
SPACE = r"\p{IsWhite_Space}\x1c-\x1f"
INLINE_SPACE = rf"[{SPACE}&&[^{BREAKS}]]"
WORD = r"\p{L}\p{N}_"

# The same white space as a string of characters, for functions that trim.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"

_LINE_END = rf"[{BREAKS}](?:(?<=\r)\n)?+"
_AFTER_LINE_END = rf"(?<=[{BREAKS}])(?<!\r(?=\n))"
_FIRST_LINE = rf"\A[^{BREAKS}]*+(?:{_LINE_END})?+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``.

    A fold over no elements hands its start value to its last step as it is; a transform over one element would copy it.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda bound, _: bound, body)


def decode_text(content: Column) -> Column:
    """Bytes to text: UTF-8 with replacement of invalid sequences, then every line end as ``\\n``."""
    text = F.make_valid_utf8(content.cast("string"))
    return F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def splitlines(text: Column, keepends: bool = False) -> Column:
    """Lines of a text as an array; no empty element after a final line end, and no element at all for ''."""
    if keepends:
        return let(F.split(text, _AFTER_LINE_END, -1), drop_last_empty)

    def cut(bound: Column) -> Column:
        # Nearly all texts end their lines with line feeds only, and splitting at one plain character is much cheaper.
        rare = reduce(operator.or_, [F.contains(bound, F.lit(c)) for c in RARE_BREAKS])
        return F.when(rare, F.split(bound, _LINE_END, -1)).otherwise(F.split(bound, "\n", -1))

    return let(let(text, cut), drop_last_empty)


def drop_last_empty(lines: Column) -> Column:
    return F.slice(lines, F.lit(1), F.size(lines) - F.when(F.get(lines, F.size(lines) - 1) == "", 1).otherwise(0))


def drop_first_line(text: Column) -> Column:
    return F.substr(text, F.length(F.regexp_extract(text, _FIRST_LINE, 0)) + 1)


def rstrip(text: Column) -> Column:
    return F.rtrim(text, F.lit(SPACES))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def finish_body(text: Column) -> Column:
    """Strip trailing white space and end with exactly one line feed."""
    return F.concat(rstrip(text), F.lit("\n"))


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)


def byte_count(text: Column) -> Column:
    return F.octet_length(text).cast("long")


def count_char(text: Column, char: str) -> Column:
    """How often an ASCII character occurs."""
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(char), F.lit("")))


def line_count(text: Column) -> Column:
    """Number of line feeds, which is not the number of split lines."""
    return count_char(text, "\n")


def is_capped(text: Column, cap_bytes: int) -> Column:
    return F.octet_length(text) > cap_bytes


def utf8_cap(text: Column, cap_bytes: int) -> Column:
    """Longest prefix of at most ``cap_bytes`` UTF-8 bytes that does not cut a character."""
    if cap_bytes < 0:
        raise ValueError("cap_bytes must not be negative")
    data = text.cast("binary")

    def inside_character(position: int) -> Column:
        byte = F.substring(data, position, 1)
        return (byte >= F.lit(b"\x80")) & (byte < F.lit(b"\xc0"))

    # A cut after byte p is clean when byte p + 1 starts a character; a character has at most three bytes to go back.
    cut = F.lit(cap_bytes)
    backward = F.when(~inside_character(cap_bytes + 1), cut)
    for step in (1, 2):
        if cap_bytes >= step:
            backward = backward.when(~inside_character(cap_bytes + 1 - step), F.lit(cap_bytes - step))
    backward = backward.otherwise(F.lit(max(cap_bytes - 3, 0)))
    return F.when(is_capped(text, cap_bytes), F.substring(data, F.lit(1), backward).cast("string")).otherwise(text)
