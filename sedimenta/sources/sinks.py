"""Sinks: sharded Parquet or JSON lines with atomic publication, sidecars, and reports of collected summaries."""

from __future__ import annotations

import json
import os
import time
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.operators.formats import to_alpaca
from sedimenta.operators.mixing import dense, numbered, split


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path for it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file on any file system: written under another name, which then takes the place of the old one."""
    fs, p = file_system(spark, path)
    tmp = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.tmp")
    stream = fs.create(tmp, True)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    fs.delete(p, False)
    fs.rename(tmp, p)


def listed(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """(path, bytes) of the files that match, in the order of their names."""
    fs, p = file_system(spark, pattern)
    return sorted((f.getPath().toString(), f.getLen()) for f in fs.globStatus(p) or ())


def write_shards(df: DataFrame, target: str, fmt: str = "parquet", compression: str = "snappy", shard_rows: int = 100_000, val_ratio: float = 0.05, seed: int = 42, order: str = "ordinal", key: str = "id", mode: str = "overwrite", named: bool = False) -> None:
    """Rows in ``target/split=train|val`` in files of at most ``shard_rows``; the split is made in blocks of that size.

    Blocks are of rows numbered densely by ``order``, whatever its gaps. Publication is the output committer's: a reader
    sees ``_SUCCESS`` or nothing; errors are raised. Empty input gives an empty table. With ``named`` the files get the
    names ``train-00000`` and ``val-00000`` and so on in the order of the rows, straight in ``target``.
    """
    if fmt not in ("parquet", "jsonl"):
        raise ValueError(f"unknown format {fmt!r}")
    spark = df.sparkSession
    rows = numbered(dense(df, order), "_n", shard_rows)
    out = split(rows, val_ratio, seed, "shard", key, order)
    staged = f"{target}/_staged-{uuid.uuid4().hex}" if named else target
    if named:
        out = out.repartitionByRange("shard").sortWithinPartitions("_n")
    writer = out.drop("shard", "_n").write.mode(mode).partitionBy("split").option("maxRecordsPerFile", shard_rows)
    if fmt == "parquet":
        writer.option("compression", compression).parquet(staged)
    else:
        writer.option("ignoreNullFields", False).json(staged)
    if named:
        fs, _ = file_system(spark, target)
        path = spark._jvm.org.apache.hadoop.fs.Path
        if mode == "overwrite":
            for old, _ in listed(spark, f"{target}/[tv]*-[0-9]*"):
                fs.delete(path(old), False)
        for part in ("train", "val"):
            first = len(listed(spark, f"{target}/{part}-[0-9]*"))
            for i, (file, _) in enumerate(listed(spark, f"{staged}/split={part}/part-*")):
                fs.rename(path(file), path(f"{target}/{part}-{first + i:05d}.{'parquet' if fmt == 'parquet' else 'jsonl'}"))
        fs.delete(path(staged), True)
        write_text(spark, f"{target}/_SUCCESS", "")


def sidecar(df: DataFrame, dataset: str, fmt: str, compression: str, files: list[str], size: int) -> dict:
    """Contents of ``_metadata.json``: counts by one aggregate."""
    row = df.agg(F.count_if(F.col("split") == "train").alias("t"), F.count_if(F.col("split") == "val").alias("v")).first()
    return {"dataset": dataset, "format": fmt, "compression": compression, "train_rows": row["t"], "val_rows": row["v"], "total_rows": row["t"] + row["v"], "files": sorted(files), "total_bytes": size, "written_at": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())}


def write_sidecar(spark: SparkSession, target: str, dataset: str, fmt: str = "parquet", compression: str = "snappy") -> dict:
    """Counts the named shards in ``target`` (Parquet by their footers) and writes ``_metadata.json`` beside them."""
    files = listed(spark, f"{target}/[tv]*-[0-9]*")
    reader = spark.read.parquet if fmt == "parquet" else spark.read.text
    rows = None
    for part in ("train", "val"):
        own = [f for f, _ in files if f.rsplit("/", 1)[-1].startswith(f"{part}-")]
        if own:
            one = reader(*own).select(F.lit(part).alias("split"))
            rows = one if rows is None else rows.unionByName(one)
    rows = spark.createDataFrame([], "split string") if rows is None else rows
    made = sidecar(rows, dataset, fmt, compression, [f.rsplit("/", 1)[-1] for f, _ in files], sum(n for _, n in files))
    write_text(spark, f"{target}/_metadata.json", json.dumps(made, indent=2))
    return made


def write_json(path: str, value: object) -> None:
    """Atomically: a temporary file takes the place of the old one."""
    p = Path(path)
    p.parent.mkdir(parents=True, exist_ok=True)
    tmp = p.with_name(p.name + ".tmp")
    tmp.write_text(json.dumps(value, ensure_ascii=False, indent=2), encoding="utf-8")
    os.replace(tmp, p)


def append_jsonl(path: str, value: object) -> None:
    with open(path, "a", encoding="utf-8") as f:
        f.write(json.dumps(value, ensure_ascii=False) + "\n")


def load_config(path: str) -> dict:
    """A YAML or JSON file; nothing where there is no file."""
    if not os.path.exists(path):
        return {}
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith(".json"):
        return json.loads(text)
    import yaml

    return yaml.safe_load(text) or {}


def write_alpaca(df: DataFrame, target: str, single_file: bool = False) -> None:
    """Instruction records as JSON lines. One file only on request: it makes one task write everything."""
    rows = to_alpaca(df).select("instruction", "input", "output")
    (rows.coalesce(1) if single_file else rows).write.mode("overwrite").option("ignoreNullFields", False).json(target)


def markdown(df: DataFrame, title: str) -> str:
    """A small summary table as Markdown; ``df`` is an aggregate."""
    rows = df.collect()
    head = "| " + " | ".join(df.columns) + " |\n|" + "---|" * len(df.columns)
    return f"# {title}\n\n{head}\n" + "\n".join("| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows) + "\n"
