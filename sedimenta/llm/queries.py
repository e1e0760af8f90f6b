"""Queries of the training-data operators, each over its whole tables, and their SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sedimenta.llm import budget, copies, cutoffs, defects, encode, leaks, mixing, packing, reading
from sedimenta.session import table

Query = Callable[[SparkSession, str], DataFrame]


def _capacities(spark: SparkSession, folder: str) -> list[tuple[int, int]]:
    return [(r["capacity_id"], r["capacity_tokens"]) for r in table(spark, folder, "pack_capacities").collect()]  # configuration


def _packed(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(packing.items(table(spark, folder, "canonical_examples")), _capacities(spark, folder))


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    return budget.texts(table(spark, folder, "canonical_examples"), table(spark, folder, "documents"))


def _mix(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(table(spark, folder, t) for t in ("canonical_examples", "mix_configs", "mix_ratios"))


def _levels(spark: SparkSession, folder: str) -> DataFrame:
    return reading.levels(table(spark, folder, "documents"), table(spark, folder, "reading_labels"))


def queries() -> dict[str, Query]:
    return {
        "p1_found": lambda s, d: copies.found(table(s, d, "canonical_examples")),
        "p1_collapsed": lambda s, d: copies.collapse(table(s, d, "canonical_examples")),
        "p2_kept": lambda s, d: cutoffs.kept(table(s, d, "canonical_examples"), table(s, d, "keep_targets")),
        "p2_cutoffs": lambda s, d: cutoffs.cutoffs(table(s, d, "canonical_examples"), table(s, d, "keep_targets")),
        "p3_slice_tokens": lambda s, d: budget.slice_tokens(_texts(s, d)),
        "p3_row_tokens": lambda s, d: budget.row_tokens(_texts(s, d)),
        "p4_mixed_rows": lambda s, d: mixing.mixed(*_mix(s, d)),
        "p4_mix_shares": lambda s, d: mixing.shares(*_mix(s, d)),
        "p5_packed": _packed,
        "p5_fill": lambda s, d: packing.fill(_packed(s, d), table(s, d, "pack_capacities")),
        "p6_found": lambda s, d: defects.found(table(s, d, "canonical_examples")),
        "p7_ids": lambda s, d: encode.encoded(table(s, d, "documents")),
        "p7_decoded": lambda s, d: encode.decoded(encode.encoded(table(s, d, "documents"))),
        "p8_found": lambda s, d: leaks.found(table(s, d, "documents"), table(s, d, "benchmark")),
        "p8_leaks": lambda s, d: leaks.leaks(table(s, d, "documents"), table(s, d, "benchmark")),
        "p9_levels": _levels,
        "p9_profile": lambda s, d: reading.profile(_levels(s, d), table(s, d, "documents")),
        "p9_accuracy": lambda s, d: reading.accuracy(table(s, d, "documents"), table(s, d, "reading_labels")),
    }


_P8_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
b AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark WHERE text IS NOT NULL),
dg AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 10), lambda i: hash(array_to_string(w[i:i+11], ' ')))) AS g FROM d WHERE len(w) >= 12),
bg AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 10), lambda i: hash(array_to_string(w[i:i+11], ' ')))) AS g FROM b WHERE len(w) >= 12)
SELECT DISTINCT doc_id, item_id FROM dg JOIN bg USING (g)
"""

_P7_TEXT_SQL = "SELECT doc_id, coalesce(text, '') AS text FROM documents"


def oracle_sql() -> dict[str, str]:
    return {"p2_kept": cutoffs.KEPT_SQL, "p2_cutoffs": cutoffs.SQL, "p4_mix_shares": mixing.SHARES_SQL, "p7_decoded": _P7_TEXT_SQL, "p8_found": _P8_SQL}
