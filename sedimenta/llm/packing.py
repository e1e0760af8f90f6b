"""Problem 5: put texts of varying length into containers of fixed capacity.

Bounded-space online best fit: a fixed number of open containers, kept by free space behind a bitset of the free spaces
in use. An item goes to the open container with the least space that still holds it; where none does, the fullest open
container closes and a new one opens. An item is split only if it is longer than a container.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.tokens import TOKENIZERS, token_count
from sedimenta.session import materialise

OPEN_BINS = 64
#: Items packed in one task: large enough that the containers left open at its end don't count.
ITEMS_PER_TASK = 250_000


class Packer:
    """Containers of ``capacity``; ``add`` returns the container's number."""

    def __init__(self, capacity: int, open_bins: int = OPEN_BINS) -> None:
        self.capacity, self.most = capacity, open_bins
        self.bits, self.by_free, self.n_open, self.n_bins = 0, {}, 0, 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        number = bins.pop()
        if not bins:
            del self.by_free[free]
            self.bits ^= 1 << free
        return number

    def _put(self, number: int, free: int) -> None:
        if free in self.by_free:
            self.by_free[free].append(number)
        else:
            self.by_free[free] = [number]
            self.bits |= 1 << free

    def add(self, size: int) -> int:
        fits = self.bits >> size
        if size == self.capacity and not fits:  # closes at once: no open container has to make room
            self.n_bins += 1
            return self.n_bins - 1
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            if self.n_open == self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
                self.n_open -= 1
            number, free = self.n_bins, self.capacity
            self.n_bins += 1
            self.n_open += 1
        if free > size or not size:
            self._put(number, free - size)
        else:
            self.n_open -= 1  # full
        return number

    def rest(self) -> dict[int, int]:
        """At the end: open containers that fit into another one, by best fit of the fullest first (old -> new number)."""
        moved, left = {}, Packer(self.capacity, 1 << 60)
        for free in sorted(self.by_free):
            for number in self.by_free[free]:
                at = left.add(self.capacity - free)
                moved[number] = at
        first: dict[int, int] = {}
        return {number: first.setdefault(at, number) for number, at in moved.items()}


def items(df: DataFrame, name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """(ordinal, n_tokens) of instruction plus output; a null or empty part has 0 tokens."""
    n = token_count(F.col("instruction"), name, folder) + token_count(F.col("output"), name, folder)
    return df.select("ordinal", n.alias("n_tokens"))


def packed(lengths: DataFrame, capacities: list[tuple[int, int]], open_bins: int = OPEN_BINS, items_per_task: int = ITEMS_PER_TASK) -> DataFrame:
    """(capacity_id, bin_id, ordinal, piece_no, piece_tokens) for items (ordinal, n_tokens) and each (id, tokens) capacity.

    Items are dealt by hash to tasks of about ``items_per_task``, so no source fills one task; each packs on its own. Items without tokens get a
    piece of 0 tokens in some container; capacities that are null or not positive are left out.
    """
    spark = lengths.sparkSession
    sizes = sorted({(int(k), int(c)) for k, c in capacities if k is not None and c is not None and c > 0})
    kept = materialise(lengths, "p5")
    tasks = max(1, -(-kept.count() // items_per_task))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 40
        parts = [b for b in batches if len(b)]
        if not parts:
            return
        pdf = pd.concat(parts).sort_values(["ordinal", "n_tokens"])  # one order, whatever the order of arrival
        ordinal, tokens = pdf["ordinal"].to_numpy(), pdf["n_tokens"].to_numpy()
        for key, capacity in sizes:
            whole = tokens // capacity - ((tokens % capacity == 0) & (tokens > 0))  # full pieces before the last one
            n = whole + 1
            row = np.repeat(np.arange(len(tokens)), n)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            size = np.where(piece < whole[row], capacity, (tokens - whole * capacity)[row])
            packer = Packer(capacity, open_bins)
            number = np.fromiter(map(packer.add, size.tolist()), dtype=np.int64, count=len(size))
            if moved := packer.rest():
                alias = np.arange(packer.n_bins)
                alias[list(moved)] = list(moved.values())
                number = alias[number]
            for at in range(0, len(row), 100_000):
                cut = slice(at, at + 100_000)
                yield pd.DataFrame({"capacity_id": np.int32(key), "bin_id": base + number[cut], "ordinal": ordinal[row[cut]], "piece_no": piece[cut].astype(np.int32), "piece_tokens": size[cut]})

    return kept.repartition(tasks, "ordinal").mapInPandas(pack, "capacity_id int, bin_id long, ordinal long, piece_no int, piece_tokens long")


def fill(pieces: DataFrame, capacities: DataFrame) -> DataFrame:
    """(capacity_id, capacity_tokens, n_bins, n_tokens, fill_share) of each capacity; nothing packed gives 0 bins."""
    bins = pieces.groupBy("capacity_id", "bin_id").agg(F.sum("piece_tokens").alias("tokens"))
    sums = bins.groupBy("capacity_id").agg(F.count("*").alias("n_bins"), F.sum("tokens").alias("n_tokens"))
    out = capacities.select("capacity_id", F.col("capacity_tokens").cast("long").alias("capacity_tokens")).join(sums, "capacity_id", "left").fillna(0, ["n_bins", "n_tokens"])
    return out.withColumn("fill_share", F.round(F.when(F.col("n_bins") > 0, F.col("n_tokens") / (F.col("n_bins") * F.col("capacity_tokens"))).otherwise(0.0), 6))
