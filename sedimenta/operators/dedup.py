"""Exact deduplication: keep the first copies in a stated order.

Copies are numbered by a window over the key; where only the first ``limit`` of each key are asked for, Spark cuts each
task's rows to that many per key before the shuffle (WindowGroupLimit), so one very frequent key does not fill a task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def occurrence(df: DataFrame, key: Column, order: str, name: str = "n", limit: int | None = None) -> DataFrame:
    """``df`` with the number of each row among the rows of its key in the order of ``order`` (1 for the first).

    With ``limit`` numbers beyond it may be missing, rows included. Without it a key's rows must be numbered in full: a
    salt splits them by blocks of the order, and offsets of the blocks are added up from their counts.
    """
    w = Window.partitionBy("_key").orderBy(order)
    keyed = df.withColumn("_key", key)
    if limit is not None:
        return keyed.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= limit).drop("_key")
    salted = keyed.withColumn("_block", F.floor(F.col(order) / SALT_ROWS))
    counts = salted.groupBy("_key", "_block").agg(F.count("*").alias("_c")).withColumn("_before", F.sum("_c").over(w.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)))
    ahead = counts.filter("_before is not null").select("_key", "_block", "_before")
    local = salted.withColumn("_local", F.row_number().over(Window.partitionBy("_key", "_block").orderBy(order)))
    return local.join(ahead, ["_key", "_block"], "left").withColumn(name, F.col("_local") + F.coalesce("_before", F.lit(0))).drop("_key", "_block", "_local", "_before")


#: Orders of one salt block: the most rows of one key that meet in a task.
SALT_ROWS = 1_000_000


def keep_copies(df: DataFrame, column: str, order: str, copies: int = 2) -> DataFrame:
    """The first ``copies`` rows of each value of ``column``; null is a value."""
    return occurrence(df, F.sha2(F.coalesce(F.col(column), F.lit("\x00null")), 256), order, "_n", copies).drop("_n")


def by_key(df: DataFrame, column: str, order: str) -> DataFrame:
    """The first row of each value; null counts as empty, and without such a column all rows are one value."""
    value = F.coalesce(F.col(column).cast("string"), F.lit("")) if column in df.columns else F.lit("")
    return occurrence(df, F.md5(value), order, "_n", 1).drop("_n")


def by_row(df: DataFrame, order: str) -> DataFrame:
    """The first of the rows that agree in all columns but ``order``; nulls agree."""
    own = [c for c in sorted(df.columns) if c != order]
    return occurrence(df, F.sha2(F.to_json(F.struct(*own), {"ignoreNullFields": "false"}), 256), order, "_n", 1).drop("_n")


def by_text(df: DataFrame, columns: list[str], order: str) -> DataFrame:
    """The first of the rows that agree in the text columns, null as empty; without columns all rows stay."""
    if not columns:
        return df
    joined = F.concat_ws("\x00", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in sorted(columns)))
    return occurrence(df, F.sha2(joined, 256), order, "_n", 1).drop("_n")


def copies(df: DataFrame, column: str) -> DataFrame:
    """(n_copies, n_values): how many values occur how often; partial aggregates only."""
    return df.groupBy(column).agg(F.count("*").alias("n_copies")).groupBy("n_copies").agg(F.count("*").alias("n_values"))


def stats(df: DataFrame, column: str = "output", kept: int = 2) -> DataFrame:
    """(total_seen, repeats, dropped, distinct) of keeping the first ``kept`` copies."""
    counts = df.groupBy(F.sha2(F.col(column), 256).alias("k")).agg(F.count("*").alias("n"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return counts.agg(total("n").alias("total_seen"), total(F.col("n") - 1).alias("repeats"), total(F.greatest(F.col("n") - kept, F.lit(0))).alias("dropped"), F.count("*").alias("distinct"))


def duplicate_rows(df: DataFrame, order: str | None = None, first: int | None = None) -> DataFrame:
    """(n_rows, n_duplicates, duplicate_pct): rows less distinct rows, percent of all rows; with ``first`` among the first in ``order`` only."""
    own = [c for c in df.columns if c != order]
    head = df.orderBy(order).limit(first) if first is not None and order else df
    keys = head.select(F.sha2(F.to_json(F.struct(*sorted(own)), {"ignoreNullFields": "false"}), 256).alias("k"))
    total = df.count()
    pct = 100.0 * F.col("n_duplicates") / max(total, 1)
    return keys.groupBy("k").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("n_duplicates")).select(F.lit(total).cast("long").alias("n_rows"), "n_duplicates", F.round(pct, 4).alias("duplicate_pct"))


def unseen(df: DataFrame, seen: DataFrame, column: str = "output") -> DataFrame:
    """Rows whose value is not among the hashes ``seen`` (column ``hash``) of earlier runs."""
    return df.withColumn("hash", F.sha2(F.col(column), 256)).join(seen.select("hash").distinct(), "hash", "left_anti").drop("hash")


def bloom_size(entries: int, rate: float) -> tuple[int, int]:
    """Bits and hash functions of a Bloom filter for so many entries at that rate of false positives."""
    if entries <= 0 or not 0 < rate < 1:
        raise ValueError("entries must be positive and the rate between 0 and 1")
    bits = int(-entries * math.log(rate) / math.log(2) ** 2)
    return bits, max(1, round(bits / entries * math.log(2)))
