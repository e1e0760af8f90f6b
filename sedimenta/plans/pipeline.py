"""Runs: raw records to curated shards, shards to a training set, cleaning and validation of tables of any columns."""

from __future__ import annotations

import json
import logging
from collections.abc import Iterable
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.functions.text import coerce
from sedimenta.operators import legacy, mixing, profile
from sedimenta.operators.curate import PipelineConfig, curate, mark, pipeline_stats
from sedimenta.operators.dedup import duplicate_rows
from sedimenta.operators.formats import to_alpaca
from sedimenta.plans.registry import DatasetEntry, DatasetInfo, RunManifest, StateStore, enabled
from sedimenta.session import materialise
from sedimenta.sources.files import exists, processed_shards
from sedimenta.sources.sinks import file_system, markdown, write_alpaca, write_shards, write_sidecar, write_text

log = logging.getLogger(__name__)


class PipelineError(RuntimeError):
    """A run that produced nothing."""


def run(spark: SparkSession, entries: Iterable[DatasetEntry], sources: dict[str, DataFrame], out: str, config: PipelineConfig = PipelineConfig(), *, names: list[str] | None = None, state: StateStore | None = None, resume: bool = False, force: bool = False, dry_run: bool = False, val_ratio: float = 0.05, seed: int = 42, shard_rows: int = 50_000, fmt: str = "parquet", compression: str = "snappy") -> RunManifest:
    """Curated shards of each enabled dataset in ``out/<name>``, and the manifest of the run.

    ``sources`` has the canonical rows of each dataset, with ``ordinal``. Copies of an output are counted over all
    datasets of the run, in the order of the entries. With ``resume`` a finished dataset is skipped, with ``force`` its
    state is dropped first; a dry run writes nothing. A dataset that fails is logged, and the run goes on.
    """
    todo = [e for e in enabled(list(entries), names) if e.name in sources]
    skipped = {e.name for e in todo if resume and not force and state and (s := state.load(e.name)) and s.finished}
    stats: dict[str, dict] = {}
    files: list[str] = []
    rows, before = None, 0
    for e in todo:
        try:  # each source is read on its own, so that one that cannot be read stops no other
            own = materialise(mixing.dense(sources[e.name], "ordinal", name="_n"), "run")
            n = own.count()
        except Exception:
            log.exception("dataset %s cannot be read", e.name)
            continue
        own = own.withColumns({"_run": F.col("_n") + F.lit(before), "_dataset": F.lit(e.name)}).drop("_n")
        rows, before = own if rows is None else rows.unionByName(own, allowMissingColumns=True), before + n
    if rows is not None:
        marked = materialise(mark(rows, config, "_run"), "run", "_dataset")
        stats = {r["_dataset"]: {k: v for k, v in r.asDict().items() if k != "_dataset"} for r in pipeline_stats(marked, "_dataset").collect()}
        for e in todo:
            if dry_run or e.name in skipped or e.name not in stats:
                continue
            try:
                if force and state:
                    state.reset(e.name)
                kept = marked.filter((F.col("_dataset") == e.name) & F.col("drop_reason").isNull())
                size = e.shard_size or shard_rows
                own = mixing.numbered(mixing.dense(kept, "_run"), "_n", size)
                done = state.load(e.name).completed if resume and state and state.load(e.name) else []
                counts = {r["shard"]: r["n"] for r in own.groupBy("shard").agg(F.count("*").alias("n")).collect()}  # a row per shard
                left = own.filter(~F.col("shard").isin(done)) if done else own
                target = f"{out}/{e.name}"
                write_shards(left.drop("drop_reason", "_score", "_run", "_dataset", "_n", "shard"), target, fmt, compression, size, val_ratio, seed, mode="append" if done else "overwrite", named=True)
                write_sidecar(spark, target, e.name, fmt, compression)
                files.append(target)
                if state:
                    for shard in sorted(set(counts) - set(done)):
                        state.mark_shard_done(e.name, int(shard), counts[shard], [target])
                    state.mark_finished(e.name)
            except Exception:
                log.exception("dataset %s failed", e.name)
    manifest = RunManifest.from_run({"pipeline": repr(config)}, files, stats)
    if not dry_run:
        write_text(spark, f"{out}/manifest.json", json.dumps(asdict(manifest), ensure_ascii=False, indent=2))
    return manifest


def training_set(spark: SparkSession, processed: str, out: str, *, ratios: dict | None = None, total: int | None = None, seed: int = 42, names: list[str] | None = None, info: DatasetInfo | None = None, register_as: str | None = None, dry_run: bool = False) -> DataFrame:
    """Instruction records of all processed datasets, capped by source and in all, in a seeded order; statistics returned.

    Folders whose names begin with ``_`` or ``.`` don't count. Nothing to write raises PipelineError. A dry run writes nothing.
    """
    fs, root = file_system(spark, processed)
    folders = [f.getPath().getName() for f in fs.listStatus(root) if f.isDirectory()]
    found = sorted(n for n in folders if n[0] not in "_." and (not names or n in names))
    rows = None
    for n in found:
        base = f"{processed}/{n}"
        own = processed_shards(spark, base) if exists(spark, f"{base}/train-*.parquet") else processed_shards_of(spark, base)
        own = own.withColumn("dataset", F.lit(n))
        rows = own if rows is None else rows.unionByName(own)
    if rows is None:
        raise PipelineError(f"no dataset in {processed}")
    ranked = rows.withColumn("ordinal", F.struct("_file", "_row"))
    alpaca = to_alpaca(ranked, "ordinal")
    caps = mixing.source_caps(found, mixing.parse_ratios(ratios), total)
    kept = mixing.cap_total(mixing.cap_sources(alpaca, caps), total, "_source", "ordinal")
    kept = materialise(kept, "training")
    if not kept.head(1):
        raise PipelineError("no valid rows")
    stats = profile.source_stats(rows, "dataset", caps)
    if not dry_run:
        key = kept.withColumn("_k", F.concat_ws("-", "_source", F.col("ordinal._file"), F.col("ordinal._row").cast("string")))
        write_alpaca(mixing.shuffled(key, seed, "_k").withColumn("dataset", F.col("_source")), f"{out}/train")
        write_text(spark, f"{out}/build_stats.json", json.dumps([r.asDict() for r in stats.collect()], indent=2))
        write_text(spark, f"{out}/build_stats.md", markdown(stats.orderBy("source"), "Training set") + markdown(profile.token_histogram(kept, "instruction", "output"), "Estimated tokens"))
        if info and register_as:
            info.register(register_as, DatasetInfo.entry("train"))
    return stats


def processed_shards_of(spark: SparkSession, base: str) -> DataFrame:
    """The training part of shards written by ``write_shards``."""
    from sedimenta.sources.files import parquet_source

    return parquet_source(spark, f"{base}/split=train" if exists(spark, f"{base}/split=train") else base, "*.parquet", tolerant=True)


def clean_table(df: DataFrame, order: str, target: str, report: str | None = None, max_tokens: int = 8192, columns: list[str] | None = None) -> DataFrame:
    """Writes the cleaned table unless the target exists; its statistics are returned, and written as JSON and Markdown."""
    stats = legacy.clean_stats(df, order, max_tokens, columns)
    legacy.clean(df, order, max_tokens, columns).write.mode("ignore").parquet(target)
    if report:
        write_text(df.sparkSession, f"{report}.json", json.dumps(stats.first().asDict(), indent=2))
        write_text(df.sparkSession, f"{report}.md", markdown(stats, "Cleaning"))
    return stats


def validate_table(df: DataFrame, order: str | None = None, report: str | None = None) -> dict:
    """Profile of a table: columns, text columns, languages of each text column, duplicates."""
    columns = materialise(profile.columns(df), "columns")  # one row per column, read twice
    found = [r.asDict() for r in columns.collect()]
    names = [r["column_name"] for r in found if r["is_text"] and r["dtype"] == "string"]
    texts = [r.asDict() for r in profile.texts(df, names).collect()] if names else []
    languages = {n: [r.asDict() for r in profile.languages(df, n).collect()] for n in names}
    duplicates = duplicate_rows(df, order).first().asDict()
    out = {"columns": found, "texts": texts, "languages": languages, "duplicates": duplicates}
    if report:
        spark = df.sparkSession
        write_text(spark, f"{report}.json", json.dumps(out, indent=2, default=str))
        parts = [markdown(columns, "Columns")]
        if names:
            parts.append(markdown(profile.texts(df, names), "Text lengths"))
            parts += [markdown(spark.createDataFrame([(r["language"], r["n_rows"]) for r in rows], "language string, n_rows long"), f"Languages of {n}") for n, rows in languages.items()]
        parts.append(markdown(spark.createDataFrame([tuple(duplicates.values())], "n_rows long, n_duplicates long, duplicate_pct double"), "Duplicates"))
        write_text(spark, f"{report}.md", "\n".join(parts))
    return out


def config_from(settings: dict) -> PipelineConfig:
    """A configuration from a settings file's ``quality`` and ``dedup`` sections."""
    from sedimenta.functions.quality import QualityConfig

    quality = QualityConfig.from_settings(settings["quality"]) if "quality" in settings else QualityConfig()
    return PipelineConfig(quality=quality, max_copies=int((settings.get("dedup") or {}).get("max_copies", 2)))


def curated(df: DataFrame, config: PipelineConfig = PipelineConfig()) -> DataFrame:
    return curate(df.withColumn("language", F.coalesce(F.nullif(F.lower(coerce(F.col("language"))), F.lit("")), F.lit("unknown"))), config)
