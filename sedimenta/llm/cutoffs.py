"""Problem 2: a score cutoff for each source that keeps a target share of its rows.

Scores are counted per (source, score), the counts range-sorted by source and descending score and written by partition.
Sums per partition and source, and a prefix sum over these few, locate the partition that holds a source's target row;
only the located partitions are read again, for the exact row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sedimenta.session import materialise


def source_name(dataset: Column) -> Column:
    """Names differing in case or outer blanks are one source; null and blank become ``unknown``."""
    name = F.lower(F.regexp_replace(dataset, r"^[\s ]+|[\s ]+$", ""))
    return F.when(F.length(name) > 0, name).otherwise(F.lit("unknown"))


@dataclass
class Cutoff:
    """What is known of a source with a target."""

    fraction: float
    n_rows: int = 0
    score: float | None = None
    n_kept: int = 0


def _scored(df: DataFrame, source: str, score: str, *keep: str) -> DataFrame:
    x = F.col(score).cast("double")
    return df.select(*keep, source_name(F.col(source)).alias("dataset"), F.when(F.isnan(x), None).otherwise(x + F.lit(0.0)).alias("score"))


def _local(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of a row per configured source; Spark knows its size, and broadcasts it if that is small."""
    return spark.createDataFrame(rows, schema)


def _solve(df: DataFrame, targets: DataFrame, source: str, score: str, fraction: str, partitions: int | None) -> tuple[DataFrame, dict[str, Cutoff]]:
    """(dataset, n_rows) of all sources, and the cutoffs of those with a target, which are configuration."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col(fraction).cast("double")))
    goals = targets.select(source_name(F.col(source)).alias("dataset"), share.alias("f")).groupBy("dataset").agg(F.max("f").alias("f")).filter("f is not null").collect()
    out = {g["dataset"]: Cutoff(g["f"]) for g in goals}

    counted = _scored(df, source, score).groupBy("dataset", "score").agg(F.count("*").alias("n"))
    ordered = counted.repartitionByRange(n, F.col("dataset"), F.col("score").desc_nulls_last()).withColumn("part", F.spark_partition_id())
    ordered = materialise(ordered, "p2", "part")  # one sort: all readers see the same partitions
    some = F.col("score").isNotNull()
    # a row for each partition and source in it: as many as partitions and sources together
    sums = materialise(ordered.groupBy("dataset", "part").agg(F.sum("n").alias("n"), F.sum(F.when(some, F.col("n")).otherwise(0)).alias("scored"), F.min("score").alias("edge")), "p2")
    sizes = sums.groupBy("dataset").agg(F.sum("n").alias("n_rows"))

    wanted = _local(spark, [(k, c.fraction) for k, c in out.items()], "dataset string, f double")
    every = Window.partitionBy("dataset")
    past = every.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = sums.join(wanted, "dataset").withColumns({"n_rows": F.sum("n").over(every), "before": F.coalesce(F.sum("scored").over(past), F.lit(0)), "edge": F.min("edge").over(past)})
    # the last partition with scores that begins before the goal holds the first row at or beyond it
    begins = (F.col("before") < F.col("f") * F.col("n_rows")) & (F.col("scored") > 0)
    at = F.max(F.when(begins, F.struct("part", "before", "edge"))).alias("at")
    located = placed.groupBy("dataset", "n_rows").agg(at).collect()  # a row for each source with a target
    for r in located:
        out[r["dataset"]].n_rows = r["n_rows"]
    here = [(r["dataset"], r["at"]["part"], r["at"]["before"], out[r["dataset"]].fraction * r["n_rows"]) for r in located if r["at"]]
    if not here:
        return sizes, out
    inside = Window.partitionBy("dataset").orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
    exact = ordered.filter(F.col("part").isin(sorted({h[1] for h in here})) & some).join(_local(spark, here, "dataset string, part int, before long, goal double"), ["dataset", "part"])
    exact = exact.withColumn("kept", F.col("before") + F.sum("n").over(inside))
    best = {r["dataset"]: r["b"] for r in exact.groupBy("dataset").agg(F.min(F.struct(F.abs(F.col("kept") - F.col("goal")).alias("off"), "kept", "score")).alias("b")).collect()}
    for r in located:
        if r["at"]:
            c, b = out[r["dataset"]], best[r["dataset"]]
            goal, before = c.fraction * c.n_rows, r["at"]["before"]
            # nearer may be the last score before the partition, or to keep none
            options = [(b["off"], b["kept"], b["score"]), (goal, 0, None)] + ([(abs(before - goal), before, r["at"]["edge"])] if before else [])
            _, c.n_kept, c.score = min(options, key=lambda o: o[:2])
    return sizes, out


def cutoffs(df: DataFrame, targets: DataFrame, source: str = "dataset", score: str = "quality_score", fraction: str = "target_fraction", partitions: int | None = None) -> DataFrame:
    """(dataset, target_fraction, n_rows, cutoff, n_kept, kept_fraction) for each source with a target or with rows.

    Kept are the rows with ``score >= cutoff``; the cutoff is the score of a row, chosen so that the number kept is
    nearest to ``target_fraction * n_rows``, of two equally near ones the higher. Null and NaN scores count as rows of
    the source but are never kept; scores out of range keep their order. A null cutoff keeps none: where no score gets
    nearer than that, where the source has no rows, or (with null n_kept) no target. Repeated targets: the largest
    holds. Shares outside [0, 1] are clamped.
    """
    sizes, known = _solve(df, targets, source, score, fraction, partitions)
    schema = "dataset string, target_fraction double, cutoff double, n_kept long"
    rows = [(k, c.fraction, c.score, c.n_kept) for k, c in known.items()]
    has = sizes.join(_local(df.sparkSession, rows, schema), "dataset", "left")
    ghosts = _local(df.sparkSession, [(k, 0, c.fraction, None, 0) for k, c in known.items() if not c.n_rows], "dataset string, n_rows long, target_fraction double, cutoff double, n_kept long")
    return has.select("dataset", "n_rows", "target_fraction", "cutoff", "n_kept").unionByName(ghosts).select("dataset", "target_fraction", "n_rows", "cutoff", "n_kept", (F.col("n_kept") / F.nullif(F.col("n_rows"), F.lit(0))).alias("kept_fraction"))


def kept(df: DataFrame, targets: DataFrame, order: str = "ordinal", source: str = "dataset", score: str = "quality_score", fraction: str = "target_fraction", partitions: int | None = None) -> DataFrame:
    """(ordinal, dataset, kept) of each row: whether its score reaches its source's cutoff; null without a target.

    The cutoffs are those of ``cutoffs``; they meet the rows in a join with a table of a row per target, which Spark
    broadcasts as its size is known. Repeated and null keys each keep their row.
    """
    _, known = _solve(df, targets, source, score, fraction, partitions)
    rows = _scored(df, source, score, F.col(order).alias("ordinal"))
    limits = _local(df.sparkSession, [(k, c.score) for k, c in known.items()], "dataset string, cutoff double").withColumn("aimed", F.lit(True))
    reached = F.coalesce(F.col("score") >= F.col("cutoff"), F.lit(False))
    return rows.join(limits, "dataset", "left").select("ordinal", "dataset", F.when(F.col("aimed"), reached).alias("kept"))


_WITH = r"""
WITH r AS (SELECT ordinal, CASE WHEN regexp_replace(coalesce(dataset,''),'^[\s\x{a0}]+|[\s\x{a0}]+$','','g')='' THEN 'unknown' ELSE lower(regexp_replace(dataset,'^[\s\x{a0}]+|[\s\x{a0}]+$','','g')) END AS dataset,
                  CASE WHEN isnan(quality_score) THEN NULL ELSE quality_score END AS score FROM canonical_examples),
g AS (SELECT lower(trim(dataset)) AS dataset, max(target_fraction) AS target_fraction FROM keep_targets GROUP BY 1),
z AS (SELECT dataset, count(*) AS n_rows FROM r GROUP BY 1),
c AS (SELECT dataset, score, sum(count(*)) OVER (PARTITION BY dataset ORDER BY score DESC) AS kept FROM r WHERE score IS NOT NULL GROUP BY dataset, score
      UNION ALL SELECT dataset, NULL, 0 FROM z),
o AS (SELECT c.dataset, c.score, c.kept, row_number() OVER (PARTITION BY c.dataset ORDER BY abs(c.kept - g.target_fraction*z.n_rows), c.kept) AS rn
      FROM c JOIN g USING (dataset) JOIN z USING (dataset))
"""

SQL = _WITH + r"""
SELECT coalesce(z.dataset, g.dataset) AS dataset, g.target_fraction, coalesce(z.n_rows, 0)::BIGINT AS n_rows, o.score AS cutoff,
       CASE WHEN g.target_fraction IS NOT NULL THEN coalesce(o.kept, 0)::BIGINT END AS n_kept,
       CASE WHEN g.target_fraction IS NOT NULL THEN coalesce(o.kept, 0)::DOUBLE / z.n_rows END AS kept_fraction
FROM z FULL JOIN g USING (dataset) LEFT JOIN o ON o.dataset = coalesce(z.dataset, g.dataset) AND o.rn = 1
"""

KEPT_SQL = _WITH + r"""
SELECT r.ordinal, r.dataset, CASE WHEN g.target_fraction IS NOT NULL THEN coalesce(r.score >= o.score, FALSE) END AS kept
FROM r LEFT JOIN g USING (dataset) LEFT JOIN o ON o.dataset = r.dataset AND o.rn = 1
"""
