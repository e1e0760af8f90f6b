"""Token counts and words by the public tokenizers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.vocabulary import PATTERN, TOKENIZERS, encoding

__all__ = ["PATTERN", "TOKENIZERS", "encoding", "token_count", "words"]


def token_count(text: Column, name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> Column:
    """Exact number of tokens of a text; null and empty texts have 0."""

    @F.pandas_udf(T.LongType())
    def count(texts: pd.Series) -> pd.Series:
        encode = encoding(name, folder).encode_ordinary
        return pd.Series([len(encode(x)) if x else 0 for x in texts], dtype="int64")

    return count(text)


def words(text: Column) -> Column:
    """The words of a text in order, split in the JVM with Unicode white space as the tokenizer has it."""
    return F.regexp_extract_all(text, F.lit("(?U)" + PATTERN), F.lit(0))
