"""The canonical record: fields, vocabularies, construction, validation and metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.text import is_blank

SCHEMA_VERSION = "1.0"
UNKNOWN = "unknown"
# The vocabulary of task types.
TASK_TYPES = ("instruction", "completion", "qa", "debugging", "documentation")

CANONICAL = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("id", "schema_version", "dataset", "task_type", "language", "repository", "license", "instruction", "input", "output")]
    + [T.StructField("quality_score", T.DoubleType()), T.StructField("metadata", T.StringType())]
)


def make_id(instruction: Column, output: Column) -> Column:
    """64 hex digits: SHA-256 of instruction, a NUL and output; nulls count as empty."""
    return F.sha2(F.concat(F.coalesce(instruction, F.lit("")), F.lit("\x00"), F.coalesce(output, F.lit(""))), 256)


def canonical(df: DataFrame, *keep: str, **columns: Column) -> DataFrame:
    """``df`` as canonical rows plus the ``keep`` columns; fields that are not given get their defaults."""
    defaults = {"schema_version": F.lit(SCHEMA_VERSION), "task_type": F.lit("instruction"), "language": F.lit(UNKNOWN), "repository": F.lit(""), "license": F.lit(UNKNOWN), "input": F.lit(""), "quality_score": F.lit(0.0), "metadata": F.lit("{}")}
    made = defaults | columns
    made.setdefault("id", make_id(made["instruction"], made["output"]))
    return df.select(*keep, *(made[f.name].cast(f.dataType).alias(f.name) for f in CANONICAL.fields))


def from_storage(df: DataFrame, *keep: str) -> DataFrame:
    """Stored rows of any subset of the fields, as canonical rows: missing or null fields get their defaults."""
    defaults = {"schema_version": SCHEMA_VERSION, "task_type": "instruction", "language": UNKNOWN, "license": UNKNOWN, "quality_score": 0.0, "metadata": "{}"}
    cols = [F.coalesce(F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType), F.lit(defaults.get(f.name, ""))).alias(f.name) for f in CANONICAL.fields]
    return df.select(*keep, *cols)


def errors(df: DataFrame) -> Column:
    """Array of what is wrong with a canonical row; empty for a valid one. Nulls count as empty texts and bad scores."""
    score = F.col("quality_score")
    tests = (
        ("id is empty", F.coalesce(F.col("id"), F.lit("")) == ""),
        ("schema_version mismatch", ~F.col("schema_version").eqNullSafe(F.lit(SCHEMA_VERSION))),
        ("unknown task_type", ~F.coalesce(F.col("task_type").isin(*TASK_TYPES), F.lit(False))),
        ("instruction is blank", is_blank(F.col("instruction"))),
        ("output is blank", is_blank(F.col("output"))),
        ("quality_score out of range", ~F.coalesce((score >= 0.0) & (score <= 1.0), F.lit(False))),  # NaN is above every number
    )
    return F.array_compact(F.array(*(F.when(bad, F.lit(name)) for name, bad in tests)))


def valid(df: DataFrame) -> DataFrame:
    return df.filter(F.size(errors(df)) == 0)


def encode_metadata(value: Column) -> Column:
    """A map as compact JSON; null gives ``{}``."""
    return F.coalesce(F.to_json(value), F.lit("{}"))


def decode_metadata(text: Column) -> Column:
    """JSON text as map<string,string>; null, broken or non-object JSON gives an empty map. Nested values stay JSON."""
    ok = F.schema_of_variant(F.try_parse_json(text)).startswith("OBJECT")
    return F.coalesce(F.when(ok, F.from_json(text, T.MapType(T.StringType(), T.StringType()))), F.create_map().cast("map<string,string>"))
