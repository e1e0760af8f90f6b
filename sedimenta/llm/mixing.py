"""Problem 4: combine sources to target shares of a total, with a cap on repeats.

A splitting tree divides each source's exact quota among the output shards: every node splits its vector of quotas
between its halves by a multivariate hypergeometric draw whose seed is the node's place, so any task can walk the tree
on its own and all tasks agree. The rows of a source are ranked in a seeded random order; a shard draws disjoint blocks
of that order and is shuffled within.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.cutoffs import source_name
from sedimenta.session import materialise

def hypergeometric(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """How many of ``sample`` draws without replacement are good, for populations of any size.

    numpy draws from populations below 1e9; larger ones are drawn by ratio of uniforms under the universal hat for
    log-concave counts (Stadlober 1990), with the probabilities from log-gamma.
    """
    size = good + bad
    if size < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, sample))
    if not bad or not good:
        return sample if not bad else 0
    if sample in (0, size):
        return good if sample else 0
    lo, hi = max(0, sample - bad), min(good, sample)
    weight = lambda k: -(math.lgamma(k + 1) + math.lgamma(good - k + 1) + math.lgamma(sample - k + 1) + math.lgamma(bad - sample + k + 1))
    mean = sample * good / size
    spread = 1.7155277699214135 * math.sqrt(mean * bad / size * (size - sample) / (size - 1) + 0.5) + 0.8989161620588988
    top = weight(min(hi, max(lo, int((sample + 1) * (good + 1) / (size + 2)))))
    while True:
        u, v = rng.random(2)
        k = math.floor(mean + 0.5 + spread * (v - 0.5) / u) if u else -1
        if lo <= k <= hi and 2 * math.log(u) <= weight(k) - top:
            return k


def split_counts(rng: np.random.Generator, counts: np.ndarray, sample: int) -> np.ndarray:
    """A multivariate hypergeometric draw: how many of ``sample`` draws fall on each of ``counts``."""
    if int(counts.sum()) < 1_000_000_000:
        return rng.multivariate_hypergeometric(counts, sample, method="marginals")
    out, rest = np.zeros_like(counts), int(counts.sum())
    for i, n in enumerate(counts.tolist()):
        rest -= n
        out[i] = hypergeometric(rng, n, rest, sample)
        sample -= int(out[i])
    return out


class Tree:
    """Division of ``quotas`` (rows per source) among ``shards`` equal shards in blocks of ``block`` rows."""

    def __init__(self, quotas: list[int], shards: int, seed: int, block: int = 1) -> None:
        self.blocks = np.array([-(-q // block) for q in quotas], dtype=np.int64)
        self.shards, self.seed, self.block, self.nodes = shards, seed, block, {}

    def left(self, lo: int, hi: int, counts: np.ndarray) -> np.ndarray:
        """Blocks of each source in the left half of node [lo, hi) that holds ``counts``."""
        if (lo, hi) not in self.nodes:
            half, total = (lo + hi) // 2 - lo, int(counts.sum())
            share = total * half // (hi - lo)
            rng = np.random.default_rng([self.seed & 0xFFFFFFFF, lo, hi])
            self.nodes[lo, hi] = split_counts(rng, counts, share) if total else counts * 0
        return self.nodes[lo, hi]

    def place(self, source: int, positions: np.ndarray) -> np.ndarray:
        """The shard of each position (0 .. quota-1) in the order of ``source``."""
        out = np.zeros(len(positions), dtype=np.int64)
        stack = [(0, self.shards, self.blocks, np.arange(len(positions)), positions // self.block)]
        while stack:
            lo, hi, counts, index, at = stack.pop()
            if hi - lo == 1 or not len(index):
                out[index] = lo
                continue
            left, mid = self.left(lo, hi, counts), (lo + hi) // 2
            goes = at < left[source]
            stack.append((lo, mid, left, index[goes], at[goes]))
            stack.append((mid, hi, counts - left, index[~goes], at[~goes] - left[source]))
        return out


def plan(configs: list[dict], ratios: list[dict], available: dict[str, int], shard_rows: int = 50_000, block: int = 1) -> list[dict]:
    """One entry for each mix and source: share, available, quota, shards. Configuration-sized, made on the driver.

    Shares are the ratios divided by their sum over the mix. The quota is the share of the total, rounded half to even,
    and at most ``available * max_repeats``. Shards draw blocks of ``block`` rows. With a null total every row of each source of positive ratio is used once.
    Null, NaN or negative ratios count as 0; a source named twice has the sum; a null ``max_repeats`` is 1.
    """
    out = []
    for c in sorted(configs, key=lambda c: c["mix_id"]):
        own: dict[str, float] = {}
        for r in ratios:
            if r["mix_id"] == c["mix_id"]:
                x = r["ratio"]
                own[r["dataset"]] = own.get(r["dataset"], 0.0) + (x if x is not None and x > 0 and math.isfinite(x) else 0.0)
        sum_ = math.fsum(own.values())
        rows = []
        for name in sorted(own):
            share, n = own[name] / sum_ if sum_ else 0.0, available.get(name, 0)
            repeats = max(1, c["max_repeats"] or 1)
            wanted = (n if share > 0 else 0) if c["total_examples"] is None else round(share * c["total_examples"])
            rows.append({"mix_id": c["mix_id"], "dataset": name, "target_share": share, "available": n, "wanted": wanted, "quota": min(wanted, n * repeats), "seed": c["seed"] or 0})
        total = sum(r["quota"] for r in rows)
        shards = max(1, -(-total // shard_rows))
        out += [r | {"source_no": i, "shards": shards, "block": block} for i, r in enumerate(rows)]
    return out


def _plan(df: DataFrame, configs: DataFrame, ratios: DataFrame, shard_rows: int) -> tuple[list[dict], DataFrame]:
    own = [r.asDict() for r in ratios.select("mix_id", source_name(F.col("dataset")).alias("dataset"), "ratio").collect()]  # configuration
    names = sorted({r["dataset"] for r in own})
    rows = df.select(F.col("ordinal"), source_name(F.col("dataset")).alias("dataset")).filter(F.col("dataset").isin(names))
    available = {r["dataset"]: r["n"] for r in rows.groupBy("dataset").agg(F.count("*").alias("n")).collect()}  # a row per configured source
    return plan([r.asDict() for r in configs.collect()], own, available, shard_rows), rows


def threshold(quota: int, available: int) -> int:
    """A 64-bit hash below which nearly surely at least ``quota`` of ``available`` uniform hashes lie."""
    if quota >= available:
        return (1 << 63) - 1
    share = (quota + 8 * math.sqrt(quota) + 32) / available
    return (1 << 63) - 1 if share >= 1 else int(share * (1 << 64)) - (1 << 63)


def mixed(df: DataFrame, configs: DataFrame, ratios: DataFrame, shard_rows: int = 50_000) -> DataFrame:
    """(mix_id, shard, pos, ordinal, dataset, use_no): the rows of each mix, shard by shard, shuffled within a shard.

    A row is used for the ``use_no``-th time; a source's uses differ by one at most over its rows. Mixes without
    ratios, without rows or with a total of 0 give no rows.
    """
    spark = df.sparkSession
    entries, rows = _plan(df, configs, ratios, shard_rows)
    used = [e for e in entries if e["quota"] > 0]
    schema = "mix_id int, dataset string, available long, quota long, seed int, most long"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), {}
        for pdf in batches:
            local = np.zeros(len(pdf), dtype=np.int64)
            for key, index in pdf.groupby(["mix_id", "dataset"], sort=False).indices.items():
                local[index] = seen.get(key, 0) + np.arange(len(index))
                seen[key] = seen.get(key, 0) + len(index)
            yield pdf.assign(part=part, local=local)

    whole: set[tuple] = set()
    while True:
        # a quota below its source takes the smallest hashes: others are left out by a threshold with room to spare
        wanted = spark.createDataFrame([(e["mix_id"], e["dataset"], e["available"], e["quota"], e["seed"], (1 << 63) - 1 if (e["mix_id"], e["dataset"]) in whole else threshold(e["quota"], e["available"])) for e in used], schema)
        keyed = rows.join(F.broadcast(wanted), "dataset").withColumn("h", F.xxhash64(F.col("seed"), F.lit("mix"), F.col("mix_id"), F.col("ordinal"))).filter("h <= most").drop("most")
        # random order of each mix and source: range sort, so that no source has to fit into a task
        ordered = keyed.repartitionByRange(n, "mix_id", "dataset", "h", "ordinal").sortWithinPartitions("mix_id", "dataset", "h", "ordinal")
        numbered = materialise(ordered.mapInPandas(number, "dataset string, ordinal long, mix_id int, available long, quota long, seed int, h long, part int, local long"), "p4")
        sums = materialise(numbered.groupBy("mix_id", "dataset", "part").agg(F.count("*").alias("n")), "p4")
        got = {(r["mix_id"], r["dataset"]): r["n"] for r in sums.groupBy("mix_id", "dataset").agg(F.sum("n").alias("n")).collect()}  # a row per mix and source
        short = {(e["mix_id"], e["dataset"]) for e in used if got.get((e["mix_id"], e["dataset"]), 0) < min(e["quota"], e["available"])}
        if not short - whole:
            break
        whole |= short  # too few below the threshold: once more with all rows of these
    before = sums.select("mix_id", "dataset", "part", F.coalesce(F.sum("n").over(Window.partitionBy("mix_id", "dataset").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    ranked = numbered.join(before, ["mix_id", "dataset", "part"]).withColumn("rank", F.col("before") + F.col("local")).filter("rank < quota")
    uses = ranked.select("mix_id", "dataset", "ordinal", "h", "available", F.explode(F.sequence(F.col("rank"), F.col("quota") - 1, F.col("available"))).alias("position"))

    trees = {m: ([e["quota"] for e in entries if e["mix_id"] == m], {e["dataset"]: e for e in entries if e["mix_id"] == m}) for m in {e["mix_id"] for e in used}}

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grown: dict[int, Tree] = {}
        for pdf in batches:
            shard = np.zeros(len(pdf), dtype=np.int64)
            position = pdf["position"].to_numpy()
            for (mix, name), index in pdf.groupby(["mix_id", "dataset"], sort=False).indices.items():
                quotas, by = trees[mix]
                e = by[name]
                tree = grown.setdefault(mix, Tree(quotas, e["shards"], e["seed"] * 1_000_003 + int(mix), e["block"]))
                shard[index] = tree.place(e["source_no"], position[index])
            yield pdf.assign(shard=shard)

    placed = uses.mapInPandas(place, "mix_id int, dataset string, ordinal long, h long, available long, position long, shard long")
    inside = Window.partitionBy("mix_id", "shard").orderBy(F.xxhash64("h", "position", "shard"), "ordinal", "position")
    return placed.select("mix_id", "shard", (F.row_number().over(inside) - 1).alias("pos"), "ordinal", "dataset", (F.expr("position div available") + 1).alias("use_no"))


def shares(df: DataFrame, configs: DataFrame, ratios: DataFrame, shard_rows: int = 50_000) -> DataFrame:
    """(mix_id, dataset, target_share, available, n_rows, n_distinct, max_uses, actual_share), counted over the rows mixed."""
    spark = df.sparkSession
    entries, _ = _plan(df, configs, ratios, shard_rows)
    goals = spark.createDataFrame([(e["mix_id"], e["dataset"], float(e["target_share"]), e["available"]) for e in entries], "mix_id int, dataset string, target_share double, available long")
    got = mixed(df, configs, ratios, shard_rows).groupBy("mix_id", "dataset").agg(F.count("*").alias("n_rows"), F.sum((F.col("use_no") == 1).cast("long")).alias("n_distinct"), F.max("use_no").alias("max_uses"))
    out = goals.join(got, ["mix_id", "dataset"], "left").fillna(0, ["n_rows", "n_distinct", "max_uses"])
    total = F.sum("n_rows").over(Window.partitionBy("mix_id"))
    return out.select("mix_id", "dataset", F.round("target_share", 9).alias("target_share"), "available", "n_rows", "n_distinct", "max_uses", F.round(F.when(total > 0, F.col("n_rows") / total).otherwise(0.0), 9).alias("actual_share"))


SHARES_SQL = r"""
WITH src AS (SELECT CASE WHEN regexp_replace(coalesce(dataset,''),'^[\s\x{a0}]+|[\s\x{a0}]+$','','g')='' THEN 'unknown' ELSE lower(regexp_replace(dataset,'^[\s\x{a0}]+|[\s\x{a0}]+$','','g')) END AS dataset FROM canonical_examples),
a AS (SELECT dataset, count(*) AS n FROM src GROUP BY 1),
r AS (SELECT mix_id, dataset, ratio / sum(ratio) OVER (PARTITION BY mix_id) AS share FROM mix_ratios),
q AS (SELECT r.mix_id, r.dataset, r.share, coalesce(a.n,0) AS available,
        least(CASE WHEN c.total_examples IS NULL THEN CASE WHEN r.share > 0 THEN coalesce(a.n,0) ELSE 0 END ELSE round_even(r.share * c.total_examples, 0) END, coalesce(a.n,0) * c.max_repeats)::BIGINT AS n_rows
      FROM r JOIN mix_configs c USING (mix_id) LEFT JOIN a ON a.dataset = r.dataset)
SELECT mix_id, dataset, round(share, 9) AS target_share, available, n_rows, least(n_rows, available) AS n_distinct,
  CASE WHEN n_rows = 0 THEN 0 ELSE ceil(n_rows / available)::BIGINT END AS max_uses, round(n_rows / sum(n_rows) OVER (PARTITION BY mix_id), 9) AS actual_share FROM q
"""
