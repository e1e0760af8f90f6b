"""The curation chain: clean, score, filter and deduplicate canonical rows; each stage is a DataFrame transformation.

``mark`` computes why each row drops out in one pass, so that statistics need no second scan and no side effects.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.functions import text as X
from sedimenta.functions.quality import QualityConfig, quality
from sedimenta.operators.dedup import occurrence
from sedimenta.session import materialise


@dataclass(frozen=True)
class CleanConfig:
    """Rules of the cleaning stage; lengths are in characters, after cleaning."""

    strip_html: bool = True
    strip_spaces: bool = True
    min_output: int = 10
    max_output: int = 32768
    min_instruction: int = 3
    blocked_substrings: tuple[str, ...] = ()
    blocked_patterns: tuple[str, ...] = ()


@dataclass(frozen=True)
class PipelineConfig:
    """Which stages run, and how. ``max_copies`` of an output are kept (two, unless told otherwise)."""

    clean: CleanConfig = field(default_factory=CleanConfig)
    quality: QualityConfig = field(default_factory=QualityConfig)
    max_copies: int = 2
    enable_cleaning: bool = True
    enable_quality: bool = True
    enable_dedup: bool = True


def cleaned(df: DataFrame, c: CleanConfig = CleanConfig()) -> DataFrame:
    """Cleaned texts; the id stays that of the texts before cleaning."""
    tidy = lambda n: X.clean(F.col(n), c.strip_html, c.strip_spaces)
    input_ = F.when(F.coalesce(F.col("input"), F.lit("")) != "", tidy("input")).otherwise(F.lit(""))
    return df.withColumns({"instruction": X.once(tidy("instruction")), "output": X.once(tidy("output")), "input": input_})


def too_short_or_long(c: CleanConfig = CleanConfig()):
    n = F.coalesce(F.length("output"), F.lit(0))
    return (n < c.min_output) | (n > c.max_output) | (F.coalesce(F.length("instruction"), F.lit(0)) < c.min_instruction)


def on_blocklist(c: CleanConfig):
    return X.blocked(F.col("output"), c.blocked_substrings, c.blocked_patterns) | X.blocked(F.col("instruction"), c.blocked_substrings, c.blocked_patterns)


def clean_stage(df: DataFrame, c: CleanConfig = CleanConfig()) -> DataFrame:
    return cleaned(df, c).filter(~too_short_or_long(c) & ~on_blocklist(c))


def quality_stage(df: DataFrame, c: QualityConfig = QualityConfig()) -> DataFrame:
    """Rows whose unrounded score reaches the threshold, with the score rounded to 4 decimals."""
    scored = df.withColumn("_score", X.once(quality(F.col("output"), F.col("language"), c))).filter(F.col("_score") >= c.min_score)
    return scored.withColumn("quality_score", F.round("_score", 4)).drop("_score")


def dedup_stage(df: DataFrame, order: str = "ordinal", max_copies: int = 2) -> DataFrame:
    return occurrence(df, F.sha2("output", 256), order, "_n", max_copies).filter(F.col("_n") <= max_copies).drop("_n")


def curate(df: DataFrame, c: PipelineConfig = PipelineConfig(), order: str = "ordinal") -> DataFrame:
    """The rows left by the enabled stages."""
    if c.enable_cleaning:
        df = clean_stage(df, c.clean)
    if c.enable_quality:
        df = quality_stage(df, c.quality)
    return dedup_stage(df, order, c.max_copies) if c.enable_dedup else df


def mark(df: DataFrame, c: PipelineConfig = PipelineConfig(), order: str = "ordinal", only: tuple[str, ...] | None = None) -> DataFrame:
    """All rows, cleaned and scored, with ``drop_reason``: cleaning, quality, dedup, or null for a row that stays.

    Copies are counted among the rows that the earlier stages leave. ``_score`` is null for rows that were not scored.
    The two readers that the count of copies needs share one written table; with ``only`` it has no other columns.
    """
    reason = F.lit(None).cast("string")
    if c.enable_cleaning:
        df, reason = cleaned(df, c.clean), F.when(too_short_or_long(c.clean) | on_blocklist(c.clean), F.lit("cleaning"))
    df = df.withColumn("drop_reason", reason)
    score = quality(F.col("output"), F.col("language"), c.quality) if c.enable_quality else F.lit(None).cast("double")
    df = df.withColumn("_score", X.once(F.when(F.col("drop_reason").isNull(), score)))
    if c.enable_quality:
        df = df.withColumn("drop_reason", F.coalesce("drop_reason", F.when(F.col("_score") < c.quality.min_score, F.lit("quality"))))
        df = df.withColumn("quality_score", F.coalesce(F.round("_score", 4), "quality_score"))
    if c.enable_dedup:
        # rows that already dropped out get a key of their own: they neither count as copies nor gather in one task
        key = F.when(F.col("drop_reason").isNull(), F.sha2("output", 256)).otherwise(F.concat(F.lit("-"), F.col(order).cast("string")))
        own = df.columns if only is None else [*dict.fromkeys((*only, order, "drop_reason", "_score"))]
        df = occurrence(materialise(df.select(*own, key.alias("_copy")), "mark"), F.col("_copy"), order, "_n").drop("_copy")
        df = df.withColumn("drop_reason", F.coalesce("drop_reason", F.when(F.col("_n") > c.max_copies, F.lit("dedup")))).drop("_n")
    return df


def pipeline_stats(marked: DataFrame, *by: str) -> DataFrame:
    """Counts of each stage, and mean, sample variance, least and greatest rounded score before the quality filter."""
    dropped = lambda why: F.count_if(F.col("drop_reason") == why)
    q = F.round("_score", 4)
    return marked.groupBy(*by).agg(
        F.count("*").alias("source_rows"), dropped("cleaning").alias("dropped_cleaning"), dropped("quality").alias("dropped_quality"), dropped("dedup").alias("dropped_dedup"),
        F.count_if(F.col("drop_reason").isNull()).alias("yielded"), F.round(F.avg(q), 4).alias("quality_mean"), F.round(F.coalesce(F.var_samp(q), F.lit(0.0)), 4).alias("quality_variance"), F.min(q).alias("quality_min"), F.max(q).alias("quality_max"),
    )
