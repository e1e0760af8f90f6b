"""Sources as functions from a session and options to a lazy DataFrame. A bad row never fails a read, unless asked to."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.operators.adapters import adapt, parse_lines
from sedimenta.schema import from_storage

log = logging.getLogger(__name__)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def jsonl_lines(spark: SparkSession, paths: list[str], encoding: str = "utf-8") -> DataFrame:
    """(raw_line, file_no, file_name) of the non-blank lines; a missing path is warned of and skipped. ``file_no`` is the path's place."""
    found = []
    for i, p in enumerate(paths):
        if exists(spark, p):
            found.append(spark.read.option("encoding", encoding).text(p).select(F.col("value").alias("raw_line"), F.lit(i).alias("file_no"), F.input_file_name().alias("file_name")))
        else:
            log.warning("no such file, skipped: %s", p)
    if not found:
        return spark.createDataFrame([], "raw_line string, file_no int, file_name string")
    return reduce(DataFrame.unionByName, found).filter(F.length(F.trim(F.regexp_replace("raw_line", r"\s", ""))) > 0)


def jsonl_source(spark: SparkSession, paths: list[str], dataset: str, adapter: str | None = None, license: str | None = None, task_type: str | None = None) -> DataFrame:
    """Canonical rows of JSON lines; malformed, blank and non-object lines and invalid rows are skipped."""
    rows = parse_lines(jsonl_lines(spark, paths)).select("raw.*")
    return adapt(rows, adapter or dataset, dataset, license, task_type)


def jsonl_row_estimate(spark: SparkSession, paths: list[str]) -> int:
    return jsonl_lines(spark, paths).count()


def load_jsonl(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Strict: a malformed line fails the read."""
    reader = spark.read.option("mode", "FAILFAST")
    return (reader.schema(schema) if schema else reader).json(path)


def parquet_source(spark: SparkSession, directory: str, glob: str = "*.parquet", tolerant: bool = False) -> DataFrame:
    """Stored canonical rows with ``_file`` and ``_row`` to order them by. With ``tolerant`` unreadable files are skipped."""
    reader = spark.read.option("pathGlobFilter", glob).option("ignoreCorruptFiles", tolerant).option("mergeSchema", False)
    df = reader.parquet(directory)
    return from_storage(df.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")), "_file", "_row")


def processed_shards(spark: SparkSession, directory: str) -> DataFrame:
    return parquet_source(spark, directory, "train-*.parquet", tolerant=True)


def parquet_row_count(spark: SparkSession, directory: str, glob: str = "*.parquet") -> int:
    """From the footers: no column is read."""
    return spark.read.option("pathGlobFilter", glob).parquet(directory).count()


def arrow_source(spark: SparkSession, path: str) -> DataFrame:
    """An Arrow IPC file or stream, or the first split of a folder of them; files are read by the tasks, one each."""
    import pyarrow as pa

    root = Path(path)
    splits = sorted(p for p in root.iterdir() if p.is_dir()) if root.is_dir() else []
    files = [str(p) for p in (sorted((splits[0] if splits else root).glob("*.arrow")) if root.is_dir() else [root])]
    if not files:
        raise FileNotFoundError(path)

    def batches_of(name: str):
        with pa.memory_map(name) as source:
            try:
                reader = pa.ipc.open_file(source)
                yield from (reader.get_batch(i) for i in range(reader.num_record_batches))
            except pa.ArrowInvalid:
                source.seek(0)
                yield from pa.ipc.open_stream(source)

    from pyspark.sql.pandas.types import from_arrow_schema

    with pa.memory_map(files[0]) as source:
        try:
            arrow = pa.ipc.open_file(source).schema
        except pa.ArrowInvalid:
            source.seek(0)
            arrow = pa.ipc.open_stream(source).schema

    def read(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                yield from batches_of(name)

    names = spark.createDataFrame([(f,) for f in files], "name string").repartition(len(files))
    return names.mapInArrow(read, from_arrow_schema(arrow))


def with_retry(read: Callable[[], DataFrame], fallback: Callable[[], DataFrame] | None = None, retries: int = 3, backoff_s: float = 5.0, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """``read``, tried ``retries`` times with waits doubling from ``backoff_s``, then ``fallback`` likewise, else RuntimeError."""
    error: Exception | None = None
    for attempt_of in filter(None, (read, fallback)):
        for attempt in range(1, retries + 1):
            try:
                return attempt_of()
            except Exception as e:  # noqa: BLE001 - any failure of a read is retried
                error = e
                log.warning("attempt %d failed: %s", attempt, e)
                if attempt < retries:
                    sleep(backoff_s * 2 ** (attempt - 1))
    raise RuntimeError("no attempt succeeded") from error


def hub_source(spark: SparkSession, mirror: str, repo_id: str, dataset: str, split: str = "train", config: str | None = None, adapter: str | None = None, license: str | None = None, task_type: str | None = None, **retry) -> DataFrame:
    """Canonical rows of a hub dataset from a local mirror ``mirror/repo_id[/config]/split`` of Parquet or JSON lines."""
    base = "/".join(filter(None, (mirror, repo_id, config, split)))

    def parquet() -> DataFrame:
        return spark.read.parquet(base)

    def lines() -> DataFrame:
        if not exists(spark, base):
            raise FileNotFoundError(base)
        return parse_lines(jsonl_lines(spark, [base])).select("raw.*")

    return adapt(with_retry(parquet, lines, **retry), adapter or dataset, dataset, license, task_type)


def git_source(*_: object, **__: object) -> DataFrame:
    """Reading repositories is not supported; ``source_files`` reads a checked-out tree."""
    raise NotImplementedError("git repositories are not supported")


# Languages by file extension.
EXTENSIONS = {"py": "python", "js": "javascript", "ts": "typescript", "java": "java", "go": "go", "rs": "rust"}


def source_files(spark: SparkSession, directory: str) -> DataFrame:
    """(path, lang, content) of the code files below a folder; bytes that are no UTF-8 become the replacement character."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{" + ",".join(EXTENSIONS) + "}").load(directory)
    ext = F.regexp_extract("path", r"\.(\w+)$", 1)
    lang = F.coalesce(*(F.when(ext == k, F.lit(v)) for k, v in EXTENSIONS.items()))
    return df.select("path", lang.alias("lang"), F.decode("content", "UTF-8").alias("content"))


def download(spark: SparkSession, entries: list[dict], mirror: str, dry_run: bool = False) -> DataFrame:
    """Copies each entry (name, repo_id, split, destination) of the mirror; (name, status, message).

    A destination that exists is SKIPPED; one failure does not stop the others.
    """
    out = []
    for e in entries:
        source, target = "/".join(filter(None, (mirror, e["repo_id"], e.get("config"), e["split"]))), e["destination"]
        try:
            if exists(spark, f"{target}/_SUCCESS") or exists(spark, f"{target}/*.parquet"):
                out.append((e["name"], "SKIPPED", target))
            elif dry_run:
                out.append((e["name"], "DRY-RUN", source))
            else:
                spark.read.parquet(source).write.mode("ignore").parquet(target)
                out.append((e["name"], "OK", target))
        except Exception as x:  # noqa: BLE001 - whatever fails is reported, and the next entry follows
            log.exception("download of %s failed", e["name"])
            out.append((e["name"], "FAILED", str(x).split("\n")[0]))
    return spark.createDataFrame(out, "name string, status string, message string")
