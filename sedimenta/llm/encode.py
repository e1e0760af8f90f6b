"""Problem 7: the corpus as token ids, by a table of distinct words.

Spark splits each text into words. A block of texts is dictionary-encoded: its distinct words, and its texts as codes
into them. The distinct words of all blocks are encoded once each, joined back to the blocks, and the codes of a block
are replaced by the ids of its words. Only distinct words per block cross the network, never positions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.llm.tokens import TOKENIZERS, encoding, words
from sedimenta.session import materialise

#: Most words in a block, unless a single text has more; bounds the memory of a task.
BLOCK_WORDS = 2_000_000

_BLOCKS = "block long, words array<string>, codes array<int>, keys array<long>, lengths array<int>"


def _ragged(lengths: np.ndarray) -> np.ndarray:
    """Offsets from lengths."""
    out = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def _list_of_one(values: pa.Array, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values.cast(kind))


def blocks(df: DataFrame, key: str = "doc_id", text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row for each block of texts: distinct words, codes of all its texts end to end, keys and word counts."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            column, keys = batch.column(1), batch.column(0)
            lengths = np.diff(column.offsets.to_numpy())
            if column.null_count:
                lengths = np.where(column.is_valid().to_numpy(zero_copy_only=False), lengths, 0)
            ends, at = np.cumsum(lengths), 0
            while at < len(lengths):
                stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + block_words, side="right")))
                coded = column.slice(at, stop - at).flatten().dictionary_encode()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), _list_of_one(coded.dictionary, pa.string()), _list_of_one(coded.indices, pa.int32()), _list_of_one(keys.slice(at, stop - at), pa.int64()), _list_of_one(pa.array(lengths[at:stop], pa.int32()), pa.int32())],
                    names=["block", "words", "codes", "keys", "lengths"],
                )
                number, at = number + 1, stop

    # null keys and texts stay rows: a null text has no words
    rows = df.select(F.col(key).cast("long").alias("key"), F.coalesce(words(F.col(text)), F.array().cast("array<string>")).alias("words"))
    return rows.mapInArrow(encode, _BLOCKS)


def encoded(df: DataFrame, key: str = "doc_id", text: str = "text", name: str = "byte_bpe_50k", folder: str = TOKENIZERS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(``key``, ids) with one row for each row of ``df``: the token ids of its text, without special tokens.

    Null and empty texts have an empty list of ids. Strings that look like special tokens are ordinary text. Repeated
    and null keys each keep their row.
    """

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def encode(values: pd.Series) -> pd.Series:
        one = encoding(name, folder).encode_ordinary
        return values.map(one)

    def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                keys, lengths, codes, order, ids = (batch.column(c).slice(i, 1) for c in range(5))
                keys, lengths, codes = keys.flatten(), lengths.flatten().to_numpy(), codes.flatten().to_numpy()
                place, lists = order.flatten().to_numpy(zero_copy_only=False), ids.flatten()
                sizes = np.diff(lists.offsets.to_numpy())
                flat, starts = lists.flatten().to_numpy(zero_copy_only=False), _ragged(sizes)[:-1]
                where = np.empty(len(place), dtype=np.int64)
                where[place] = np.arange(len(place))
                at = 0
                for part in range(0, max(1, len(keys)), 2_000):
                    n_words = lengths[part : part + 2_000]
                    own = where[codes[at : at + int(n_words.sum())]]
                    at += len(own)
                    size = sizes[own]
                    ends = _ragged(size)
                    out = flat[np.repeat(starts[own] - ends[:-1], size) + np.arange(ends[-1])] if len(own) else flat[:0]
                    offsets = ends[_ragged(n_words)]
                    yield pa.RecordBatch.from_arrays([keys.slice(part, 2_000), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(out, pa.int32()))], names=[key, "ids"])

    kept = materialise(blocks(df, key, text, block_words), "p7")
    occurrences = kept.select("block", F.posexplode("words").alias("at", "word"))
    table = occurrences.groupBy("word").agg(F.lit(1).alias("x")).select("word", encode("word").alias("ids"))
    back = occurrences.join(table, "word").groupBy("block").agg(F.collect_list(F.struct("at", "ids")).alias("w"))  # bounded by a block's distinct words
    joined = kept.select("block", "keys", "lengths", "codes").join(back, "block", "left")
    columns = joined.select("keys", "lengths", "codes", F.coalesce("w.at", F.array().cast("array<int>")).alias("at"), F.coalesce("w.ids", F.array().cast("array<array<int>>")).alias("ids"))
    return columns.mapInArrow(join_ids, f"{key} long, ids array<int>")


def decoded(df: DataFrame, key: str = "doc_id", name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """(``key``, text) from (``key``, ids): each id is joined to its piece, the pieces concatenated by position.

    The table of pieces has as many rows as the vocabulary, a fixed number, and is broadcast. Bytes that are no valid
    UTF-8 become the replacement character. Keys must be unique; an empty or null list gives an empty text, an id
    outside the vocabulary nothing.
    """
    spark = df.sparkSession
    enc = encoding(name, folder)
    pieces = spark.createDataFrame([(i, enc.decode_single_token_bytes(i).hex()) for i in sorted(enc._mergeable_ranks.values())], "id int, piece string")
    # lists of ids cross the network, not single ids: what follows keeps the partitioning by key
    parts = df.select(key, "ids").repartition(F.col(key)).select(key, F.posexplode_outer("ids").alias("pos", "id")).join(F.broadcast(pieces), "id", "left")
    grouped = parts.groupBy(key).agg(F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "piece")))).alias("p"))
    return grouped.select(key, F.decode(F.unhex(F.array_join("p.piece", "")), "UTF-8").alias("text"))
