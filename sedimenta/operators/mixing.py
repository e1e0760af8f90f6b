"""Mixing registered sources by ratio, caps, shuffles, samples and the split into training and validation rows."""

from __future__ import annotations

import logging
import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.operators.dedup import occurrence
from sedimenta.session import materialise

log = logging.getLogger(__name__)
STRATEGIES = ("approximate", "exact", "oversample")
#: Largest limit for which Spark cuts each task's rows before the shuffle (spark.sql.optimizer.windowGroupLimitThreshold).
LIMITED = 1_000


@dataclass(frozen=True)
class MixConfig:
    """Ratios by source, normalised to sum 1; ``ratios`` of 0 are allowed, a sum of 0 is not."""

    ratios: dict[str, float]
    strategy: str = "approximate"
    total_examples: int | None = None
    seed: int = 42
    shares: dict[str, float] = field(init=False)

    def __post_init__(self) -> None:
        if self.strategy not in STRATEGIES:
            raise ValueError(f"unknown strategy {self.strategy!r}; valid: {STRATEGIES}")
        if not self.ratios or any(r < 0 for r in self.ratios.values()) or math.fsum(self.ratios.values()) <= 0:
            raise ValueError("ratios must be given, none negative, and not all 0")
        total = math.fsum(self.ratios.values())
        object.__setattr__(self, "shares", {k: v / total for k, v in self.ratios.items()})

    @property
    def targets(self) -> dict[str, int]:
        """Rows of each source, rounded half to even; they need not sum to the total."""
        if self.total_examples is None:
            raise ValueError(f"{self.strategy} needs total_examples")
        return {k: round(v * self.total_examples) for k, v in self.shares.items()}


def parse_ratios(ratios: dict | None) -> dict[str, float]:
    """Normalised ratios; nothing, or a sum that is not positive, gives {} (uniform)."""
    total = math.fsum((ratios or {}).values())
    return {k: v / total for k, v in (ratios or {}).items()} if total > 0 else {}


def _by(column: str, values: dict, otherwise) -> Column:
    """The value of each name in ``column``; ``values`` is configuration, so a CASE takes the place of a join."""
    out = reduce(lambda c, kv: c.when(F.col(column) == kv[0], F.lit(kv[1])), values.items(), F.when(F.lit(False), F.lit(None)))
    return out.otherwise(F.lit(otherwise))


def random_key(seed: int, *columns: str) -> Column:
    """Seeded pseudo-random key of a row: the same on every run and in any partitioning."""
    return F.md5(F.concat_ws("-", F.lit(str(seed)), *(F.col(c).cast("string") for c in columns)))


class DatasetMixer:
    """Registered sources, mixed as configured; rows keep their columns and get ``_mix_source``."""

    def __init__(self, config: MixConfig, order: str = "ordinal") -> None:
        self.config, self.order, self.sources = config, order, {}

    def register(self, name: str, df: DataFrame) -> None:
        if name in self.sources:
            raise ValueError(f"source {name!r} is registered twice")
        if name not in self.config.ratios:
            log.warning("source %r has no ratio and gets weight 0", name)
        self.sources[name] = df

    def _union(self) -> DataFrame:
        if not self.sources:
            raise ValueError("no source is registered")
        return reduce(DataFrame.unionByName, (df.withColumn("_mix_source", F.lit(n)) for n, df in self.sources.items()))

    def mixed(self) -> DataFrame:
        rows, c = self._union(), self.config
        if c.strategy == "approximate":
            return approximate(rows, c, "_mix_source", self.order)
        if c.strategy == "exact":
            return exact(rows, c.targets, "_mix_source", self.order)
        missing = set(c.ratios) - set(self.sources)
        if missing:
            raise ValueError(f"ratios name sources that are not registered: {sorted(missing)}")
        return oversample(rows, c.targets, "_mix_source", self.order)

    def iter_mixed(self) -> DataFrame:
        """Always the approximate strategy."""
        return approximate(self._union(), self.config, "_mix_source", self.order)


def approximate(df: DataFrame, c: MixConfig, source: str = "dataset", order: str = "ordinal") -> DataFrame:
    """All rows of all sources of positive ratio, with ``_mix_at`` to sort by for a random interleaving by ratio.

    Sources arrive as Poisson processes whose rates are the ratios, until each is exhausted: given the number of its
    rows, a source's arrival times are uniform over rows / ratio. Nothing is drawn one by one; a source's own rows come
    in random order.
    """
    weight = _by(source, {k: float(v) for k, v in c.shares.items()}, 0.0)
    own = df.withColumn("_w", weight).filter("_w > 0")
    sizes = own.groupBy(source).agg(F.count("*").alias("_size"))  # a row per configured source
    uniform = (F.pmod(F.xxhash64(F.lit(c.seed), F.col(source), F.col(order)), F.lit(1 << 53)) + 0.5) / float(1 << 53)
    return own.join(F.broadcast(sizes), source).withColumn("_mix_at", uniform * F.col("_size") / F.col("_w")).drop("_w", "_size")


def _ranked(df: DataFrame, targets: dict[str, int], source: str, order: str) -> DataFrame:
    """The rows of the targets' sources with ``_rn``, their number within the source; numbers beyond all targets are missing.

    Up to ``LIMITED`` the window keeps only a target's worth of rows per task; beyond it a source is numbered by blocks of
    the order, so that no task takes a whole source.
    """
    most = max(targets.values(), default=0)
    own = df.filter(F.col(source).isin(list(targets)))
    return occurrence(own, F.col(source), order, "_rn", most if most <= LIMITED else None).filter(F.col("_rn") <= most)


def exact(df: DataFrame, targets: dict[str, int], source: str = "dataset", order: str = "ordinal") -> DataFrame:
    """The first rows of each source, up to its target."""
    return _ranked(df, targets, source, order).filter(F.col("_rn") <= _by(source, targets, 0)).drop("_rn")


def oversample(df: DataFrame, targets: dict[str, int], source: str = "dataset", order: str = "ordinal") -> DataFrame:
    """Each source's target of rows, its first rows, cycled where it is short; ``_mix_use`` counts a row's uses."""
    sizes = df.filter(F.col(source).isin(list(targets))).groupBy(source).agg(F.count("*").alias("_size"))  # a row per configured source
    ranked = _ranked(df, targets, source, order).join(F.broadcast(sizes), source)
    goal = _by(source, targets, 0)
    return ranked.filter(F.col("_rn") <= goal).withColumn("_at", F.explode(F.sequence(F.col("_rn").cast("long"), goal.cast("long"), F.col("_size")))).withColumn("_mix_use", (F.expr("(_at - 1) div _size") + 1).cast("int")).drop("_rn", "_size", "_at")


def mix_stats(df: DataFrame, source: str = "dataset") -> DataFrame:
    """(source, n_rows, actual_ratio) with 4 decimals."""
    counts = df.groupBy(source).agg(F.count("*").alias("n_rows"))
    total = F.sum("n_rows").over(Window.partitionBy())  # over one row per source
    return counts.withColumn("actual_ratio", F.round(F.col("n_rows") / total, 4))


def source_caps(sources: list[str], ratios: dict[str, float], total: int | None) -> dict[str, int] | None:
    """Most rows of each source, at least one; None without a total."""
    if not total:
        return None
    uniform = 1 / max(1, len(sources))
    return {s: max(1, round(total * ratios.get(s, uniform))) if ratios else max(1, total // max(1, len(sources))) for s in sources}


def cap_sources(df: DataFrame, caps: dict[str, int] | None, source: str = "_source", order: str = "ordinal") -> DataFrame:
    return df if caps is None else exact(df, caps, source, order)


def cap_total(df: DataFrame, total: int | None, *order: str) -> DataFrame:
    """The first rows of the whole in the given order.

    A few rows are taken by a top-k of each task. For more, the rows are range-sorted and written by partition, and
    counts per partition tell which are taken whole and how many rows of the one after them.
    """
    if not total:
        return df
    if total <= LIMITED:
        return df.orderBy(*order).limit(total)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = materialise(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), "first", "_part")
    rest, whole = total, -1
    for r in sorted_.groupBy("_part").agg(F.count("*").alias("n")).orderBy("_part").collect():  # a row per partition
        if r["n"] > rest:
            cut = sorted_.filter(F.col("_part") == r["_part"]).orderBy(*order).limit(rest)  # within one partition
            return sorted_.filter(F.col("_part") <= whole).unionByName(cut).drop("_part")
        rest, whole = rest - r["n"], r["_part"]
    return sorted_.drop("_part")


def dense(df: DataFrame, *order: str, name: str = "_n") -> DataFrame:
    """``df``, written by ranges of the order, with the dense number of each row from 1.

    A row's number is that within its range and the rows of the ranges before, of which the driver holds one count each.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = materialise(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), "dense")
    before, total = [], 0
    for r in parts.groupBy("_part").agg(F.count("*").alias("n")).orderBy("_part").collect():
        before.append((r["_part"], total))
        total += r["n"]
    offsets = df.sparkSession.createDataFrame(before, "_part int, _before long")
    local = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return parts.withColumn(name, local).join(F.broadcast(offsets), "_part").withColumn(name, F.col(name) + F.col("_before")).drop("_part", "_before")


def shuffled(df: DataFrame, seed: int, *columns: str) -> DataFrame:
    """Rows in a seeded random order: a range sort by hash, spread over the cluster."""
    return df.orderBy(random_key(seed, *columns), *columns)


def sample(df: DataFrame, n: int, seed: int, *columns: str) -> DataFrame:
    """Exactly ``n`` rows (all, if fewer) without replacement, by the smallest seeded hashes."""
    return df.orderBy(random_key(seed, *columns), *columns).limit(n)


def split(df: DataFrame, ratio: float, seed: int, shard: str, *key: str) -> DataFrame:
    """``df`` with ``split``: in each shard the last ``round(n * ratio)`` rows of a seeded order are ``val``, the others ``train``.

    The ratio is clamped to [0, 0.5]; halves round to even. A shard is as large as its size limit.
    """
    r = min(max(ratio, 0.0), 0.5)
    w = Window.partitionBy(shard)
    at = F.row_number().over(w.orderBy(random_key(seed, *key), *key))
    n = F.count("*").over(w)
    return df.withColumns({"_at": at, "_n": n}).withColumn("split", F.when(F.col("_at") > F.col("_n") - F.bround(F.col("_n") * r), "val").otherwise("train")).drop("_at", "_n")


def numbered(df: DataFrame, order: str, size: int) -> DataFrame:
    """``df`` with ``shard``: blocks of ``size`` consecutive values of a dense ordinal."""
    return df.withColumn("shard", F.floor((F.col(order) - 1) / size))
