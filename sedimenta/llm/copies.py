"""Problem 1: records that differ only in formatting.

Each distinct value of a column is canonicalised once and gets an integer identifier (the smallest ordinal at which
its canonical form occurs), every record is rewritten as a tuple of identifiers, and the tuples are grouped.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.llm.graph import components
from sedimenta.session import materialise

#: A line ``Name: value``; a list marker may precede the one-word name.
FIELD_LINE = r"^\s*(?:[-*+•]\s*|\d+[.)]\s+)?[\p{L}\p{N}_-]+\s*:\s*\S.*$"
_OTHER = r"[^\p{L}\p{N}]+"


def reduced(text: Column) -> Column:
    """Letters and digits only, letter case folded (upper then lower, so that sharp s equals ss)."""
    return F.lower(F.regexp_replace(F.upper(text), _OTHER, ""))  # next to each other, the optimizer would drop the upper


def field_lines(text: Column) -> Column:
    """Order-free form of an instruction made of two or more ``Name: value`` lines, else null."""
    lines = F.filter(F.split(text, r"\r\n|[\n\r\x0b\x0c\x85  ]"), lambda x: F.length(F.regexp_replace(x, r"[\s ]+", "")) > 0)
    return F.when(
        text.contains(":") & (F.size(lines) >= 2) & F.forall(lines, lambda x: x.rlike(FIELD_LINE)),
        F.array_join(F.array_sort(F.transform(lines, reduced)), "\n"),
    )


_STRIP = re.compile(r"[\W_]+")


def _fold(x: object) -> str:
    return _STRIP.sub("", str(x)).upper().lower()


def _walk(value: object) -> str:
    if isinstance(value, _Object):
        return "{" + ",".join(sorted(f"{_fold(k)}:{_walk(v)}" for k, v in value)) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(_walk, value)) + "]"
    return _fold("null" if value is None else {True: "true", False: "false"}[value] if isinstance(value, bool) else value)


class _Object(list):
    """The members of a JSON object in order, repeated names included."""


def json_form(text: str | None) -> str | None:
    """Order-free form of a text that is one JSON object, else None."""
    if text is None:
        return None
    try:
        value = json.loads(text, object_pairs_hook=_Object, parse_float=str, parse_int=str)
        return _walk(value) if isinstance(value, _Object) else None
    except (ValueError, RecursionError):
        return None


@F.pandas_udf(T.StringType())
def _json_forms(text: pd.Series) -> pd.Series:
    return text.map(json_form)


def identifiers(df: DataFrame, order: str = "ordinal", instruction: str = "instruction", output: str = "output") -> DataFrame:
    """Rows of ``df`` that take part, as (``order``, instruction_id, output_id).

    Rows whose instruction or output is null or holds no letter or digit take no part. A canonical value's identifier
    is the smallest ``order`` at which it occurs: an integer, unique to the value, the same on every run, and found by
    partial aggregation only.
    """
    digest = lambda c: F.unhex(F.md5(c))
    rows = df.select(F.col(order).alias("ordinal"), F.col(instruction).alias("i"), F.col(output).alias("o")).filter(F.col("i").rlike(r"[\p{L}\p{N}]") & F.col("o").rlike(r"[\p{L}\p{N}]"))
    values = (
        rows.select("ordinal", F.explode(F.array(F.struct(F.lit(0).cast("byte").alias("field"), F.col("i").alias("value")), F.struct(F.lit(1).cast("byte").alias("field"), F.col("o").alias("value")))).alias("v"))
        .groupBy("v.field", "v.value")
        .agg(F.min("ordinal").alias("first"))
    )
    # one canonical form per distinct value; Python sees only the values that look like a JSON object
    looks_json = (F.col("field") == 1) & F.col("value").rlike(r"^\s*\{[\s\S]*\}\s*$")
    plain_form, free_form = digest(reduced(F.col("value"))), F.when(F.col("field") == 0, field_lines(F.col("value"))).otherwise(_json_forms(F.when(looks_json, F.col("value"))))
    forms = materialise(values.select("field", digest(F.col("value")).alias("digest"), "first", plain_form.alias("plain"), digest(free_form).alias("free")), "p1")  # read four times
    # values with the same letters and digits (plain) or the same lines or members in any order (free) fall together; few
    # values have a free form, and only a plain form with several of them links one free form to another
    node = lambda c: F.concat(F.when(F.col("field") == 0, F.lit(bytearray(b"i"))).otherwise(F.lit(bytearray(b"o"))), F.col(c))
    edges = forms.filter("free is not null").select("field", "plain", node("free").alias("v")).distinct()
    heads = edges.groupBy("field", "plain").agg(F.min("v").alias("head"), F.count("*").alias("n"))
    joins = components(edges.join(heads.filter("n > 1"), ["field", "plain"]).select(F.col("head").alias("u"), "v"))
    group = heads.join(joins, F.col("head") == F.col("v"), "left").select("field", "plain", F.coalesce("u", "head").alias("group"))
    plain = forms.groupBy("field", "plain").agg(F.min("first").alias("first")).join(group, ["field", "plain"], "left").select("field", "plain", "first", F.coalesce("group", node("plain")).alias("form"))
    ids = plain.groupBy("form").agg(F.min("first").alias("id"))
    dictionary = forms.select("field", "digest", "plain").join(plain.select("field", "plain", "form"), ["field", "plain"]).join(ids, "form").select("field", "digest", "id")
    tuples = rows.select("ordinal", digest(F.col("i")).alias("di"), digest(F.col("o")).alias("do"))
    di = dictionary.filter("field = 0").select(F.col("digest").alias("di"), F.col("id").alias("instruction_id"))
    do = dictionary.filter("field = 1").select(F.col("digest").alias("do"), F.col("id").alias("output_id"))
    return tuples.join(do, "do").join(di, "di").select("ordinal", "instruction_id", "output_id")


def collapse(df: DataFrame, **names: str) -> DataFrame:
    """One row for each group of copies: kept_ordinal and n_copies (1 where a record has no copy)."""
    groups = identifiers(df, **names).groupBy("instruction_id", "output_id").agg(F.min("ordinal").alias("kept_ordinal"), F.count("*").alias("n_copies"))
    return groups.select("kept_ordinal", "n_copies")


def found(df: DataFrame, **names: str) -> DataFrame:
    """One row (kept_ordinal, copy_ordinal) for each copy other than the first of its group.

    The group's first ordinal comes from a partial aggregate; rows meet it in an equi-join on the compact tuple, which
    adaptive execution splits where one group is very large. Repeated ordinals count as separate copies.
    """
    ids = materialise(identifiers(df, **names), "p1")
    groups = ids.groupBy("instruction_id", "output_id").agg(F.min("ordinal").alias("kept_ordinal"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return ids.join(groups, ["instruction_id", "output_id"]).filter("ordinal > kept_ordinal").select("kept_ordinal", F.col("ordinal").alias("copy_ordinal"))
