"""Problem 3: tokens of each text, and of each slice of source, language and domain.

Whole texts are hashed and deduplicated, each distinct text is tokenized once, and the counts are joined back to the
rows, or to the number of rows each slice has of the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.tokens import TOKENIZERS, token_count

_BLANK = r"^[\s ]+|[\s ]+$"


def slice_name(value: Column) -> Column:
    """Slice names without case and outer blanks; null and blank become ``unknown``."""
    name = F.lower(F.regexp_replace(value, _BLANK, ""))
    return F.when(F.length(name) > 0, name).otherwise(F.lit("unknown"))


def texts(examples: DataFrame, documents: DataFrame) -> DataFrame:
    """Both corpora as (corpus, key, source, language, domain, text)."""
    a = examples.select(F.lit("examples").alias("corpus"), F.col("ordinal").alias("key"), slice_name(F.col("dataset")).alias("source"), slice_name(F.col("language")).alias("language"), F.lit("none").alias("domain"), F.col("output").alias("text"))
    b = documents.select(F.lit("documents").alias("corpus"), F.col("doc_id").alias("key"), slice_name(F.col("source")).alias("source"), slice_name(F.col("lang")).alias("language"), slice_name(F.col("doc_domain")).alias("domain"), F.col("text"))
    return a.unionByName(b)


def counts(rows: DataFrame, name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """(digest, n_tokens) of each distinct non-null text. Copies within a task fall together before the shuffle."""
    distinct = rows.filter("text is not null").select(F.unhex(F.md5("text")).alias("digest"), "text").groupBy("digest", "text").agg(F.lit(1).alias("x"))
    return distinct.select("digest", token_count(F.col("text"), name, folder).alias("n_tokens"))


def row_tokens(rows: DataFrame, **tokenizer: str) -> DataFrame:
    """(corpus, key, n_tokens) of each row; null and empty texts have 0 tokens. Repeated keys stay apart."""
    keys = rows.select("corpus", "key", F.unhex(F.md5("text")).alias("digest"))
    some = keys.filter("digest is not null").join(counts(rows, **tokenizer), "digest")
    none = keys.filter("digest is null").withColumn("n_tokens", F.lit(0).cast("long"))
    return some.select("corpus", "key", "n_tokens").unionByName(none.select("corpus", "key", "n_tokens"))


def slice_tokens(rows: DataFrame, **tokenizer: str) -> DataFrame:
    """(corpus, source, language, domain, n_rows, n_distinct_texts, n_tokens, n_distinct_tokens) of each slice.

    Rows are counted per slice and text digest before the join, so a text repeated any number of times in a slice
    crosses the network once per task. ``n_distinct_tokens`` counts a text once in each slice.
    """
    keyed = rows.groupBy("corpus", "source", "language", "domain", F.unhex(F.md5("text")).alias("digest")).agg(F.count("*").alias("n"))
    joined = keyed.join(counts(rows, **tokenizer), "digest", "left")
    n = F.coalesce("n_tokens", F.lit(0).cast("long"))
    return joined.groupBy("corpus", "source", "language", "domain").agg(
        F.sum("n").alias("n_rows"), F.count("digest").alias("n_distinct_texts"), F.sum(F.col("n") * n).alias("n_tokens"), F.sum(n).alias("n_distinct_tokens")
    )
