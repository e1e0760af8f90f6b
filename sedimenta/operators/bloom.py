"""A Bloom filter built in the cluster: each task sets bits of its own, the bit arrays are joined by OR block by block."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.operators.dedup import bloom_size

#: Bits of a block: the unit that is shuffled and joined.
BLOCK_BITS = 1 << 20


class BloomFilter:
    """Bits for ``capacity`` texts at the rate ``fpr``; positions are ``h1 + i * h2`` of two 64-bit hashes."""

    def __init__(self, capacity: int = 5_000_000, fpr: float = 0.001, bits: np.ndarray | None = None, count: int = 0) -> None:
        self.n_bits, self.n_hashes = bloom_size(capacity, fpr)
        self.bits = np.zeros(-(-self.n_bits // 8), dtype=np.uint8) if bits is None else bits
        self.count = count

    def positions(self, text: str) -> np.ndarray:
        from xxhash import xxh64_intdigest

        data = text.encode("utf-8", "replace")
        h1, h2 = xxh64_intdigest(data, 0), xxh64_intdigest(data, 1) or 1
        return np.array([(h1 + i * h2) % self.n_bits for i in range(self.n_hashes)], dtype=np.int64)

    def add(self, text: str) -> None:
        at = self.positions(text)
        np.bitwise_or.at(self.bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
        self.count += 1

    def __contains__(self, text: str) -> bool:
        at = self.positions(text)
        return bool(np.all(self.bits[at >> 3] >> (at & 7) & 1))

    @property
    def memory_bytes(self) -> int:
        return self.bits.nbytes

    def estimated_fpr(self) -> float:
        return (1 - math.exp(-self.n_hashes * self.count / self.n_bits)) ** self.n_hashes if self.count else 0.0


def build(df: DataFrame, column: str, capacity: int, fpr: float = 0.001) -> BloomFilter:
    """The filter of all non-null values of a column. What reaches the driver is the bits, fixed by capacity and rate."""
    step = BLOCK_BITS // 8

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = BloomFilter(capacity, fpr)
        for pdf in batches:
            for x in pdf[column].dropna():
                own.add(x)
        for at in range(0, len(own.bits), step):
            if own.bits[at : at + step].any():
                yield pd.DataFrame({"at": [at], "bits": [own.bits[at : at + step].tobytes()], "n": [own.count if not at else 0]})

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        bits = np.bitwise_or.reduce([np.frombuffer(b, dtype=np.uint8) for b in pdf["bits"]])
        return pd.DataFrame({"at": pdf["at"].iloc[:1], "bits": [bits.tobytes()], "n": [pdf["n"].sum()]})

    rows = df.select(F.col(column).cast("string").alias(column)).mapInPandas(fill, "at int, bits binary, n long").groupBy("at").applyInPandas(join, "at int, bits binary, n long").collect()
    out = BloomFilter(capacity, fpr)
    for r in rows:
        out.bits[r["at"] : r["at"] + step] = np.frombuffer(r["bits"], dtype=np.uint8)
        out.count += r["n"]
    return out


def members(df: DataFrame, column: str, bloom: BloomFilter, name: str = "member") -> DataFrame:
    """``df`` with whether the filter may hold the value of ``column``; null for null. False is certain, true is not."""
    shared = df.sparkSession.sparkContext.broadcast(bloom)

    @F.pandas_udf("boolean")
    def test(values: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else x in shared.value for x in values], dtype=object)

    return df.withColumn(name, test(F.col(column).cast("string")))
