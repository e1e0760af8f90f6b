"""Profiles of a dataset: columns, text lengths, token histogram, languages, sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.detect import detect_language
from sedimenta.functions.text import is_blank
from sedimenta.operators.legacy import TEXT_HINTS

# Upper bounds of the token histogram.
HISTOGRAM = (64, 128, 256, 512, 1024, 2048, 4096, 8192)


def text_flags(df: DataFrame) -> dict[str, bool]:
    """Whether each column holds text: by its name, or a string column at least half filled."""
    out = {c: any(h in c.lower() for h in TEXT_HINTS) for c in df.columns}
    unsure = [c for c, kind in df.dtypes if kind == "string" and not out[c]]
    if unsure:
        row = df.select(*(F.col(f"`{c}`") for c in unsure)).agg(F.count("*").alias("_n"), *(F.count(F.col(f"`{c}`")).alias(c) for c in unsure)).first()
        out |= {c: row["_n"] > 0 and row[c] >= 0.5 * row["_n"] for c in unsure}
    return out


def columns(df: DataFrame) -> DataFrame:
    """(column_name, dtype, total, missing, missing_pct, is_text): one scan with one aggregate for all columns."""
    flags = text_flags(df)
    one = df.agg(F.count("*").alias("_n"), *(F.count(F.col(f"`{c}`")).alias(f"_c{i}") for i, c in enumerate(df.columns)))
    stacked = one.select("_n", F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.lit(kind).alias("dtype"), F.col(f"_c{i}").alias("filled"), F.lit(flags[c]).alias("is_text")) for i, (c, kind) in enumerate(df.dtypes)))).alias("c"))
    missing = F.col("_n") - F.col("c.filled")
    return stacked.select(F.col("c.name").alias("column_name"), F.col("c.dtype").alias("dtype"), F.col("_n").alias("total"), missing.alias("missing"), F.round(F.when(F.col("_n") > 0, 100.0 * missing / F.col("_n")).otherwise(0.0), 4).alias("missing_pct"), F.col("c.is_text").alias("is_text"))


def texts(df: DataFrame, names: list[str]) -> DataFrame:
    """(column_name, n, avg_chars, max_chars, avg_tokens, max_tokens) of the non-null values."""
    one = df.agg(*(f(F.length(F.col(f"`{c}`"))).alias(f"_{k}{i}") for i, c in enumerate(names) for k, f in (("n", F.count), ("a", F.avg), ("m", F.max))))
    rows = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("n"), F.coalesce(F.col(f"_a{i}"), F.lit(0.0)).alias("avg"), F.coalesce(F.col(f"_m{i}"), F.lit(0)).alias("max")) for i, c in enumerate(names)))
    r = one.select(F.explode(rows).alias("r"))
    return r.select("r.column_name", "r.n", F.round("r.avg", 2).alias("avg_chars"), F.col("r.max").cast("long").alias("max_chars"), F.round(F.col("r.avg") / 4.0, 2).alias("avg_tokens"), F.ceil(F.col("r.max") / 4.0).cast("long").alias("max_tokens"))


def bucket(tokens: Column) -> Column:
    """Label ``lo-hi`` of the first bound that is not below, ``8192+`` beyond the last."""
    lows = (0, *HISTOGRAM[:-1])
    return reduce(lambda c, b: c.when(tokens <= b[1], F.lit(f"{b[0]}-{b[1]}")), zip(lows, HISTOGRAM), F.when(F.lit(False), "")).otherwise(F.lit(f"{HISTOGRAM[-1]}+"))


def token_histogram(df: DataFrame, *texts: str) -> DataFrame:
    """(bucket, n_rows) of the estimated tokens, a quarter of the characters rounded up, of the texts together."""
    n = F.ceil(reduce(lambda a, b: a + b, (F.coalesce(F.length(c), F.lit(0)) for c in texts)) / 4.0)
    return df.groupBy(bucket(n).alias("bucket")).agg(F.count("*").alias("n_rows"))


def languages(df: DataFrame, text: str = "output", top: int = 5) -> DataFrame:
    """(language, n_rows) of the most frequent detected languages; equals by name."""
    counts = df.filter(F.col(text).isNotNull()).groupBy(detect_language(F.col(text)).alias("language")).agg(F.count("*").alias("n_rows"))
    return counts.orderBy(F.desc("n_rows"), "language").limit(top)


def source_stats(df: DataFrame, source: str = "dataset", caps: dict[str, int] | None = None) -> DataFrame:
    """(source, raw, converted, dropped, sampled, drop_pct) and a row of totals with source ``TOTAL``, by one rollup."""
    good = ~is_blank(F.col("instruction")) & ~is_blank(F.col("output"))
    per = df.groupBy(F.coalesce(F.col(source), F.lit("")).alias("source")).agg(F.count("*").alias("raw"), F.count_if(good).alias("converted"))
    cap = F.col("converted") if caps is None else F.least("converted", reduce(lambda c, kv: c.when(F.col("source") == kv[0], F.lit(kv[1])), caps.items(), F.when(F.lit(False), F.lit(0))).otherwise(F.col("converted")))
    per = per.withColumns({"dropped": F.col("raw") - F.col("converted"), "sampled": cap})
    total = per.rollup("source").agg(*(F.sum(c).alias(c) for c in ("raw", "converted", "dropped", "sampled")))
    return total.withColumns({"source": F.coalesce("source", F.lit("TOTAL")), "drop_pct": F.round(100.0 * F.col("dropped") / F.greatest(F.col("raw"), F.lit(1)), 2)})
