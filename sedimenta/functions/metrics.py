"""Evaluation of predictions against references."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.text import strip

CODE_BLOCK = r"```\w*\n[\s\S]+?```"


def exact_match(prediction: Column, reference: Column) -> Column:
    """1 if both are the same text, white space at the ends aside; null with a null side."""
    return (strip(prediction) == strip(reference)).cast("double")


def contains_code_block(text: Column) -> Column:
    return F.coalesce(text.rlike("(?U)" + CODE_BLOCK), F.lit(False))


def pass_at_k(n: Column, c: Column, k: Column) -> Column:
    """Chance that one of ``k`` of ``n`` samples, of which ``c`` are right, is right."""
    n, c, k = n.cast("int"), c.cast("int"), k.cast("int")
    missed = F.aggregate(F.sequence(n - c + 1, n), F.lit(1.0), lambda a, i: a * (1.0 - k / i))
    return F.when(n - c < k, 1.0).when(c <= 0, 0.0).otherwise(1.0 - missed)


def evaluate(predictions: DataFrame, references: DataFrame, position: str = "position", metric: Callable[[Column, Column], Column] = exact_match) -> DataFrame:
    """(mean, n) of a metric over the pairs at the same position; pairs missing on one side don't count, no pair gives mean 0."""
    pairs = predictions.select(position, F.col("text").alias("prediction")).join(references.select(position, F.col("text").alias("reference")), position)
    return pairs.agg(F.coalesce(F.avg(metric(F.col("prediction"), F.col("reference"))), F.lit(0.0)).alias("mean"), F.count("*").alias("n"))


def evaluate_each(predictions: DataFrame, references: DataFrame, position: str = "position", metric: Callable[[Column, Column], Column] = exact_match) -> DataFrame:
    """(position, value) of each pair."""
    pairs = predictions.select(position, F.col("text").alias("prediction")).join(references.select(position, F.col("text").alias("reference")), position)
    return pairs.select(position, metric(F.col("prediction"), F.col("reference")).alias("value"))
