"""Command line: ``python -m sedimenta.cli run|build|validate|clean``."""

from __future__ import annotations

import argparse
import json
import logging
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sedimenta.operators.adapters import adapt
from sedimenta.operators.curate import PipelineConfig
from sedimenta.plans import pipeline
from sedimenta.plans.registry import DatasetInfo, StateStore, enabled, load_registry
from sedimenta.sources.files import jsonl_lines, parse_lines
from sedimenta.sources.sinks import load_config


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="sedimenta")
    sub = p.add_subparsers(dest="command", required=True)
    r = sub.add_parser("run", help="raw JSON lines to curated shards")
    r.add_argument("--registry", required=True)
    r.add_argument("--config")
    r.add_argument("--out", required=True)
    r.add_argument("--state")
    r.add_argument("--name", action="append")
    for flag in ("--force", "--dry-run", "--resume", "--no-dedup", "--no-quality"):
        r.add_argument(flag, action="store_true")
    b = sub.add_parser("build", help="curated shards to a training set")
    b.add_argument("--processed", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--config")
    b.add_argument("--max-samples", type=int)
    b.add_argument("--name", action="append")
    b.add_argument("--register")
    b.add_argument("--seed", type=int, default=42)
    b.add_argument("--dry-run", action="store_true")
    for name in ("validate", "clean"):
        v = sub.add_parser(name)
        v.add_argument("--input", required=True)
        v.add_argument("--report")
        if name == "clean":
            v.add_argument("--out", required=True)
            v.add_argument("--order", required=True)
    a = p.parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName("sedimenta").getOrCreate()
    if a.command == "run":
        entries = load_registry(a.registry)
        base = pipeline.config_from(load_config(a.config) if a.config else {})
        config = PipelineConfig(base.clean, base.quality, base.max_copies, True, not a.no_quality, not a.no_dedup)
        sources = {}
        for e in enabled(entries, a.name):
            lines = jsonl_lines(spark, [f"{e.destination}/*.jsonl"])
            rows = adapt(parse_lines(lines.withColumn("ordinal", F.monotonically_increasing_id())).select("ordinal", "raw.*"), e.adapter or e.name, e.name, e.license, e.task_type, keep=("ordinal",))
            sources[e.name] = rows
        print(pipeline.run(spark, entries, sources, a.out, config, names=a.name, state=StateStore(a.state) if a.state else None, resume=a.resume, force=a.force, dry_run=a.dry_run).summary())
    elif a.command == "build":
        settings = load_config(a.config) if a.config else {}
        try:
            stats = pipeline.training_set(spark, a.processed, a.out, ratios=settings.get("ratios"), total=settings.get("total_examples") or a.max_samples, seed=a.seed, names=a.name, info=DatasetInfo(f"{a.out}/dataset_info.json"), register_as=a.register, dry_run=a.dry_run)
        except pipeline.PipelineError as e:
            print(e, file=sys.stderr)
            return 1
        stats.show(truncate=False)
    elif a.command == "validate":
        print(json.dumps(pipeline.validate_table(spark.read.parquet(a.input), report=a.report), default=str))
    else:
        pipeline.clean_table(spark.read.parquet(a.input), a.order, a.out, a.report).show()
    return 0


if __name__ == "__main__":
    sys.exit(main())
