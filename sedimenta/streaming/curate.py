"""The curation chain as a stream: micro-batches of files, copies counted in the state store across batches and restarts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from sedimenta.operators.curate import PipelineConfig, clean_stage, quality_stage
from sedimenta.schema import CANONICAL


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_stream(spark: SparkSession, path: str, schema: T.StructType = CANONICAL, files_per_batch: int = 1) -> DataFrame:
    """Parquet files as they arrive; a micro-batch takes the place of a shard."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def keep_copies(df: DataFrame, max_copies: int = 2, order: str | None = None) -> DataFrame:
    """The first ``max_copies`` rows of each output over the life of the query.

    The state of an output is one small number; it has no event time to expire by and stays for good. Rows of one batch
    count in the order of ``order``, if given. A batch's rows of an output beyond ``max_copies`` leave the task at once.
    """
    schema = T.StructType([f for f in df.schema.fields])

    def count(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen = state.get[0] if state.exists else 0
        room = max_copies - seen
        first = None
        for pdf in batches:
            pdf = pdf.drop(columns="_key")
            if room > 0 and len(pdf):
                first = pdf if first is None else pd.concat([first, pdf])
                first = (first.sort_values(order, kind="stable") if order else first).head(room)
        if first is not None:
            state.update((seen + len(first),))
            yield first

    keyed = df.withColumn("_key", F.sha2("output", 256))
    return keyed.groupBy("_key").applyInPandasWithState(count, schema, "n int", "append", GroupStateTimeout.NoTimeout)


def curated_stream(df: DataFrame, c: PipelineConfig = PipelineConfig(), order: str | None = None) -> DataFrame:
    """The same stages as the batch chain; only the count of copies is stateful."""
    if c.enable_cleaning:
        df = clean_stage(df, c.clean)
    if c.enable_quality:
        df = quality_stage(df, c.quality)
    return keep_copies(df, c.max_copies, order) if c.enable_dedup else df


def start(df: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Writes what has arrived and stops; a restart with the same checkpoint takes up where it ended, exactly once.

    State lies in RocksDB on the executors' disks, not in their heaps, and is saved to the checkpoint by what changed.
    """
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return df.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(target)
