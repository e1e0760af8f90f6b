"""Token ids of chat texts with any tokenizer, in Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.text import is_blank
from sedimenta.functions.vocabulary import TOKENIZERS, encoding
from sedimenta.operators.formats import chat_messages, render

Encode = Callable[[str], list[int]]
_PIECE = re.compile(r"\w+|[^\w\s]")


def hashed_pieces(text: str) -> list[int]:
    """Words and signs, each as a 31-bit hash: a tokenizer without a vocabulary, for where none is given."""
    from xxhash import xxh32_intdigest

    return [xxh32_intdigest(p.encode()) & 0x7FFFFFFF for p in _PIECE.findall(text)]


def vocabulary_pieces(name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> Callable[[list[str]], list[list[int]]]:
    """Token ids of a batch of texts by a public vocabulary, without special tokens."""
    return lambda texts: encoding(name, folder).encode_ordinary_batch(texts, num_threads=1)


def tokenised(df: DataFrame, encode: Encode | None = None, key: str = "ordinal", max_length: int = 8192, mask_prompt: bool = False, name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """(key, input_ids, attention_mask, labels) of the rendered chat of each row; labels are the ids.

    Ids are those of the vocabulary file ``name``, a batch at a time, or of ``encode`` text by text. Rows with a blank
    instruction or output drop out, and so do rows whose text ``encode`` refuses. Ids beyond ``max_length`` are cut off.
    With ``mask_prompt`` the labels of everything before the answer are -100.
    """
    text = render(chat_messages(F.col("instruction"), F.coalesce("input", F.lit("")), F.col("output")))
    rows = df.filter(~is_blank(F.col("instruction")) & ~is_blank(F.col("output"))).select(F.col(key).cast("long").alias("key"), text.alias("text"), F.concat(F.lit("assistant\n"), F.col("output"), F.lit("<|im_end|>\n")).alias("tail"))

    def each(texts: list[str]) -> list[list[int] | None]:
        out = []
        for x in texts:
            try:
                out.append(list(encode(x)))
            except Exception:  # noqa: BLE001 - a row that cannot be encoded counts as dropped
                out.append(None)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch_ids = each if encode else vocabulary_pieces(name, folder)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            ids = batch_ids(texts)
            heads = [0] * len(texts)
            if mask_prompt:
                heads = [len(h or ()) for h in batch_ids([x[: len(x) - len(t)] for x, t in zip(texts, batch.column(2).to_pylist())])]
            kept = [i for i, x in enumerate(ids) if x is not None]
            ids = [ids[i][:max_length] for i in kept]
            lists = pa.array(ids, pa.list_(pa.int32()))
            ones = pa.ListArray.from_arrays(lists.offsets, pa.array([1] * len(lists.values), pa.int32()))
            labels = pa.array([[-100] * min(heads[i], len(x)) + x[heads[i] :] for i, x in zip(kept, ids)], pa.list_(pa.int32())) if mask_prompt else lists
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(kept, pa.int64())), lists, ones, labels], names=["key", "input_ids", "attention_mask", "labels"])

    return rows.mapInArrow(run, "key long, input_ids array<int>, attention_mask array<int>, labels array<int>").withColumnRenamed("key", key)


def write_cache(tokens: DataFrame, target: str) -> None:
    """Token ids as Parquet; a cache that exists stays as it is."""
    tokens.write.mode("ignore").parquet(target)
