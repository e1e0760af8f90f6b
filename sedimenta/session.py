"""Session helpers: table access and lineage cuts that survive the loss of an executor."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once a session, so that workers can import it wherever they run."""
    context = spark.sparkContext
    if not getattr(context, "_sedimenta_shipped", False):
        package = Path(__file__).resolve().parent
        # in the session's own folder on the driver, from where Spark serves it as long as the session lasts
        context.addPyFile(shutil.make_archive(f"{context._temp_dir}/sedimenta", "zip", package.parent, package.name))
        context._sedimenta_shipped = True


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors share one machine."""
    return spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Unset, a local session gets a temporary one (tests); a cluster must name it."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if context._jsc.sc().getCheckpointDir().isEmpty():
        if not named:
            if not is_local(spark):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            own = tempfile.mkdtemp(prefix="sedimenta-")
            atexit.register(shutil.rmtree, own, ignore_errors=True)
        context.setCheckpointDir(named or own)
    return named or context._jsc.sc().getCheckpointDir().get()


_open: ContextVar[list[str] | None] = ContextVar("sedimenta_scope", default=None)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder of any file system; one that is not there is no error."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Deletes what ``materialise`` wrote within it; results must be written or collected inside."""
    outer = _open.set([])
    try:
        yield
    finally:
        made = _open.get() or []
        _open.reset(outer)
        for path in made:
            remove(spark, path)


def materialise(df: DataFrame, name: str = "stage", *by: str) -> DataFrame:
    """Write ``df`` once as compressed Parquet into the shared folder and read it back.

    Cuts the lineage like ``checkpoint()``, but stays columnar: later readers fetch only the columns they use. With
    ``by`` the files lie in folders by these columns, and readers that filter on them open no others. The tables stay
    as long as the session's shared folder, or until the ``scope`` around the call ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    made = _open.get()
    if made is not None:
        made.append(path)
    df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
