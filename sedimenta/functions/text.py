"""Text functions as Column expressions, all inside the JVM. White space is Unicode white space."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space, and those that end a line.
SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
TAG = r"<[^>]+>"


#: The same characters one by one.
SPACE_CHARS = "".join(chr(c) for c in (*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
def strip(text: Column) -> Column:
    """Without white space at both ends; null stays null."""
    return F.btrim(text, F.lit(SPACE_CHARS))


def is_blank(text: Column) -> Column:
    """Null, empty or nothing but white space."""
    return text.isNull() | ~text.rlike(rf"[^{SPACE}]")


def coerce(value: Column) -> Column:
    """As stripped text; null gives an empty text."""
    return F.coalesce(strip(value.cast("string")), F.lit(""))


def first_truthy(*values: Column) -> Column:
    """The first value that is neither null nor empty, then stripped; a blank one is taken and gives an empty text."""
    return coerce(F.coalesce(*(F.nullif(v.cast("string"), F.lit("")) for v in values))) if values else F.lit("")


def first_filled(*values: Column) -> Column:
    """The first value that is not blank, stripped; else an empty text."""
    filled = F.filter(F.transform(F.array(*(v.cast("string") for v in values)), coerce), lambda x: x != "")
    return F.coalesce(F.get(filled, F.lit(0)), F.lit(""))  # one loop, however many values: the generated code stays small


def lines(text: Column) -> Column:
    """Stripped lines that are not blank."""
    return F.filter(F.transform(F.split(text, LINE_END), strip), lambda x: x != "")


def clean(text: Column, html: bool = True, spaces: bool = True) -> Column:
    """Without tags, with runs of blanks and tabs as one blank and at most one empty line in a row, stripped."""
    if html:
        text = F.regexp_replace(text, TAG, "")
    if spaces:
        text = strip(F.regexp_replace(F.regexp_replace(text, r"[ \t]+", " "), r"\n{3,}", "\n\n"))
    return text


def unix_lines(text: Column) -> Column:
    return F.regexp_replace(text, r"\r\n|\r", "\n")


def blocked(text: Column, substrings: tuple[str, ...] = (), patterns: tuple[str, ...] = ()) -> Column:
    """Whether the text holds a substring or a match of a pattern, letter case aside; null holds none."""
    tests = [F.contains(F.lower(text), F.lit(s.lower())) for s in substrings] + [text.rlike(f"(?iuUd){p}") for p in patterns]
    return F.coalesce(reduce(lambda a, b: a | b, tests, F.lit(False)), F.lit(False))


def once(value: Column) -> Column:
    """``value``, computed once a row: the optimizer copies it neither into filters nor into each of its users.

    Filters that read a column of expensive expressions would else be pushed below it, with a copy of the expression for
    every reference. The condition always holds, but the optimizer does not know (of ``rand() >= 0`` it does).
    """
    return F.when(F.spark_partition_id() >= 0, value)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def token_estimate(text: Column) -> Column:
    """Characters divided by four."""
    return F.length(text) / 4.0
