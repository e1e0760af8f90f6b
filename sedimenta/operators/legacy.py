"""Rules of the batch cleaner for tables of any columns: which columns hold text is told by their names."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.text import is_blank, strip, unix_lines
from sedimenta.operators import dedup

# Names of text, output and instruction columns.
TEXT_HINTS = ("text", "content", "code", "prompt", "response", "input", "output", "instruction", "answer", "question", "body", "solution", "func_code_string", "whole_func_string", "func_documentation_string", "docstring", "problem_statement", "patch", "hint")
OUTPUT_COLUMNS = ("output", "response", "code", "content", "answer", "solution", "func_code_string", "whole_func_string", "patch")
INSTRUCTION_COLUMNS = ("instruction", "prompt", "question", "input", "problem_statement", "func_documentation_string", "docstring", "hint", "body")
CHARS_PER_TOKEN = 4.0


def text_columns(df: DataFrame, explicit: list[str] | None = None) -> list[str]:
    """The named columns that exist, else those whose name holds a hint; names decide, types don't."""
    if explicit:
        return [c for c in explicit if c in df.columns]
    return [c for c in df.columns if any(h in c.lower() for h in TEXT_HINTS)]


def _strings(df: DataFrame, names) -> list[str]:
    kinds = dict(df.dtypes)
    return [c for c in names if kinds.get(c) == "string"]


def strip_text(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.withColumns({c: strip(F.col(c)) for c in _strings(df, text_columns(df, columns))})


def line_endings(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.withColumns({c: unix_lines(F.col(c)) for c in _strings(df, text_columns(df, columns))})


def empty(df: DataFrame, names: tuple[str, ...]) -> Column:
    """Whether any of the columns that exist, letter case of their names aside, is empty: null, or blank if it is a text."""
    own = [(c, kind) for c, kind in df.dtypes if c.lower() in names]
    return reduce(lambda a, b: a | b, ((is_blank(F.col(f"`{c}`")) if kind == "string" else F.col(f"`{c}`").isNull()) for c, kind in own), F.lit(False))


def text_length(df: DataFrame, columns: list[str] | None = None) -> Column:
    return reduce(lambda a, b: a + b, (F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) for c in text_columns(df, columns)), F.lit(0))


def remove_empty_outputs(df: DataFrame) -> DataFrame:
    return df.filter(~empty(df, OUTPUT_COLUMNS))


def remove_empty_instructions(df: DataFrame) -> DataFrame:
    return df.filter(~empty(df, INSTRUCTION_COLUMNS))


def remove_long(df: DataFrame, max_tokens: int = 8192, columns: list[str] | None = None) -> DataFrame:
    """Rows of at most so many estimated tokens of text; 0 or less switches the rule off."""
    return df if max_tokens <= 0 else df.filter(text_length(df, columns) <= max_tokens * CHARS_PER_TOKEN)


def filter_by_length(df: DataFrame, key: str = "response", least: int = 50, most: int = 8000) -> DataFrame:
    n = F.length(F.coalesce(F.col(key), F.lit(""))) if key in df.columns else F.lit(0)
    return df.filter(n.between(least, most))


def apply_filters(df: DataFrame, filters: list[Column | Callable[[DataFrame], Column]]) -> DataFrame:
    return reduce(lambda d, f: d.filter(f(d) if callable(f) and not isinstance(f, Column) else f), filters, df)


def clean(df: DataFrame, order: str, max_tokens: int = 8192, columns: list[str] | None = None) -> DataFrame:
    """All rules in order: strip, line ends, empty outputs and instructions, long rows, equal rows, equal texts."""
    df = line_endings(strip_text(df, columns), columns)
    df = remove_long(remove_empty_instructions(remove_empty_outputs(df)), max_tokens, columns)
    return dedup.by_text(dedup.by_row(df, order), text_columns(df, columns), order)


def clean_stats(df: DataFrame, order: str, max_tokens: int = 8192, columns: list[str] | None = None) -> DataFrame:
    """One row: rows before, removed by each rule, left, removed in all and percent kept (2 decimals).

    The row rules share one scan: the first that holds counts. Copies are counted from counts per hash: a row group
    loses all but one row, then a text group all but one of its row groups.
    """
    df = line_endings(strip_text(df, columns), columns)
    names = text_columns(df, columns)
    n = text_length(df, columns)
    rule = F.when(empty(df, OUTPUT_COLUMNS), F.lit("outputs")).when(empty(df, INSTRUCTION_COLUMNS), F.lit("instructions"))
    if max_tokens > 0:
        rule = rule.when(n > max_tokens * CHARS_PER_TOKEN, F.lit("long"))
    own = sorted(c for c in df.columns if c != order)
    row = F.sha2(F.to_json(F.struct(*own), {"ignoreNullFields": "false"}), 256)
    text = F.sha2(F.concat_ws("\x00", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in sorted(names))), 256) if names else row
    marked = df.select(rule.alias("rule"), F.when(rule.isNull(), row).alias("row"), F.when(rule.isNull(), text).alias("text"))
    rows = marked.groupBy("rule", "row", "text").agg(F.count("*").alias("n"))
    texts = rows.groupBy("rule", "text").agg(F.sum("n").alias("n"), F.count("*").alias("rows"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    of = lambda r: total(F.when(F.col("rule") == r, F.col("n")).otherwise(0))
    left = F.col("rule").isNull()
    out = texts.agg(
        total("n").alias("original_rows"), of("outputs").alias("removed_empty_outputs"), of("instructions").alias("removed_empty_instructions"), of("long").alias("removed_long"),
        total(F.when(left, F.col("n") - F.col("rows")).otherwise(0)).alias("removed_duplicate_rows"), total(F.when(left, F.col("rows") - 1).otherwise(0)).alias("removed_duplicate_texts"), F.count_if(left).alias("final_rows"),
    )
    kept = F.when(F.col("original_rows") > 0, 100.0 * F.col("final_rows") / F.col("original_rows")).otherwise(0.0)
    return out.withColumns({"total_removed": F.col("original_rows") - F.col("final_rows"), "retention_pct": F.round(kept, 2)})
