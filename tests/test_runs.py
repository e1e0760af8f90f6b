import json
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sedimenta.operators.curate import PipelineConfig
from sedimenta.plans import pipeline
from sedimenta.plans.registry import DatasetEntry, DatasetInfo, PreflightError, RunManifest, StateStore, enabled, load_registry, parse_entry, preflight
from sedimenta.schema import CANONICAL
from sedimenta.sources import files, sinks
from sedimenta.streaming.curate import curated_stream, read_stream, start
from test_operators import examples

RAW_CONFIG = PipelineConfig(enable_quality=False)


def test_jsonl_source_skips_what_is_broken(spark, tmp_path):
    (tmp_path / "a.jsonl").write_bytes(b'{"prompt": "p", "response": "r"}\n\n{"x"\n[1]\n{"prompt": "q\xff", "response": "s"}\n{"prompt": "only"}\n')
    paths = [str(tmp_path / "missing.jsonl"), str(tmp_path / "a.jsonl")]
    rows = files.jsonl_source(spark, paths, "opc_sft_stage1", license="MIT").collect()
    assert sorted(r["output"] for r in rows) == ["r", "s"] and "�" in max(r["instruction"] for r in rows)
    assert files.jsonl_row_estimate(spark, paths) == 5
    assert files.jsonl_source(spark, [paths[0]], "x").count() == 0
    with pytest.raises(Exception):
        files.load_jsonl(spark, paths[1], "prompt string, response string").collect()


def test_parquet_source_tolerates_corrupt_files(spark, tmp_path):
    examples(spark, 4).coalesce(1).write.parquet(str(tmp_path / "p"))
    part = next((tmp_path / "p").glob("*.parquet"))
    part.rename(tmp_path / "p/train-00001.parquet")
    (tmp_path / "p/train-00002.parquet").write_bytes(b"junk")
    assert files.processed_shards(spark, str(tmp_path / "p")).count() == 4
    assert files.parquet_row_count(spark, str(tmp_path / "p"), "train-00001*") == 4


def test_arrow_source_takes_the_first_split(spark, tmp_path):
    for split, n in (("a", 2), ("b", 3)):
        (tmp_path / split).mkdir()
        t = pa.table({"x": list(range(n)), "t": ["s"] * n})
        with pa.OSFile(str(tmp_path / split / "d.arrow"), "wb") as f, (pa.ipc.new_file if split == "a" else pa.ipc.new_stream)(f, t.schema) as w:
            w.write_table(t)
    assert files.arrow_source(spark, str(tmp_path)).count() == 2
    assert files.arrow_source(spark, str(tmp_path / "b")).count() == 3
    with pytest.raises(FileNotFoundError):
        (tmp_path / "c").mkdir()
        files.arrow_source(spark, str(tmp_path / "c"))


def test_retry_and_fallback():
    waits, calls = [], []

    def fail():
        calls.append(1)
        raise OSError("no")

    assert files.with_retry(fail, lambda: "ok", 3, 1.0, waits.append) == "ok" and waits == [1.0, 2.0] and len(calls) == 3
    with pytest.raises(RuntimeError):
        files.with_retry(fail, fail, 2, 1.0, waits.append)


def test_hub_mirror_and_download(spark, tmp_path):
    spark.createDataFrame([("a", "b")], "instruction string, output string").write.parquet(str(tmp_path / "o/r/train"))
    (tmp_path / "o/j/train").mkdir(parents=True)
    (tmp_path / "o/j/train/x.jsonl").write_text('{"question": "a", "answer": "b"}\n')
    assert files.hub_source(spark, str(tmp_path), "o/r", "d").count() == 1
    assert files.hub_source(spark, str(tmp_path), "o/j", "d", sleep=lambda s: None).count() == 1
    with pytest.raises(RuntimeError):
        files.hub_source(spark, str(tmp_path), "o/none", "d", retries=1)
    entries = [{"name": n, "repo_id": r, "split": "train", "destination": str(tmp_path / f"out/{n}")} for n, r in (("good", "o/r"), ("bad", "o/none"))]
    status = lambda **k: {r["name"]: r["status"] for r in files.download(spark, entries, str(tmp_path), **k).collect()}
    assert status(dry_run=True) == {"good": "DRY-RUN", "bad": "DRY-RUN"}
    assert status() == {"good": "OK", "bad": "FAILED"} and status()["good"] == "SKIPPED"
    with pytest.raises(NotImplementedError):
        files.git_source("x")


def test_source_files(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d/a.py").write_text("x = 1")
    (tmp_path / "d/b.txt").write_text("no")
    assert [(r["lang"], r["content"]) for r in files.source_files(spark, str(tmp_path)).collect()] == [("python", "x = 1")]


@pytest.mark.parametrize("fmt", ["parquet", "jsonl"])
def test_shards_and_split(spark, tmp_path, fmt):
    sinks.write_shards(examples(spark, 50), str(tmp_path / "w"), fmt, val_ratio=0.2, shard_rows=25)
    back = spark.read.format("parquet" if fmt == "parquet" else "json").load(str(tmp_path / "w"))
    assert {r[0]: r[1] for r in back.groupBy("split").count().collect()} == {"train": 40, "val": 10}
    side = sinks.sidecar(back, "d", fmt, "snappy", ["b", "a"], 1)
    assert side["total_rows"] == 50 and side["files"] == ["a", "b"]
    with pytest.raises(ValueError):
        sinks.write_shards(examples(spark, 1), str(tmp_path / "w2"), "csv")


def entry(name, **x):
    return DatasetEntry(name, f"o/{name}", "train", "dest", True, **x)


def test_a_run_and_the_training_set_built_from_it(spark, tmp_path):
    out, state = str(tmp_path / "out"), StateStore(str(tmp_path / "state"))
    sources = {"a": examples(spark, 20, dataset="a"), "b": examples(spark, 10, dataset="b")}
    entries = [entry("a"), entry("b"), DatasetEntry("c", "o/c", "train", "d", False)]
    m = pipeline.run(spark, entries, sources, out, RAW_CONFIG, state=state, val_ratio=0.0)
    assert m.total_rows == 30 and RunManifest.load(f"{out}/manifest.json").total_rows == 30 and "30 rows" in m.summary()
    assert state.load("a").finished and set(state.all_states()) == {"a", "b"}
    before = Path(out, "a/_SUCCESS").stat().st_mtime_ns
    pipeline.run(spark, entries, sources, out, RAW_CONFIG, state=state, resume=True, val_ratio=0.0)
    assert Path(out, "a/_SUCCESS").stat().st_mtime_ns == before
    info = DatasetInfo(str(tmp_path / "set/dataset_info.json"))
    stats = pipeline.training_set(spark, out, str(tmp_path / "set"), ratios={"a": 0.5, "b": 0.5}, total=12, info=info, register_as="mine")
    lines = [json.loads(x) for p in Path(tmp_path, "set/train").glob("*.json") for x in p.read_text().splitlines()]
    assert len(lines) == 12 and set(lines[0]) == {"instruction", "input", "output"}
    assert {r["source"]: r["converted"] for r in stats.collect()} == {"a": 20, "b": 10, "TOTAL": 30}
    assert preflight(spark, info, "mine") == 12
    assert pipeline.training_set(spark, out, str(tmp_path / "dry"), names=["a"], dry_run=True).count() == 2 and not (tmp_path / "dry").exists()
    with pytest.raises(pipeline.PipelineError):
        pipeline.training_set(spark, out, str(tmp_path / "x"), names=["zzz"])


def test_copies_count_over_the_datasets_of_a_run_and_dry_runs_write_nothing(spark, tmp_path):
    same = "def f():\n    return 'the same everywhere'"
    m = pipeline.run(spark, [entry("a"), entry("b")], {"a": examples(spark, 1, same), "b": examples(spark, 5, same)}, str(tmp_path / "o"), RAW_CONFIG, dry_run=True)
    assert {k: v["yielded"] for k, v in m.sources.items()} == {"a": 1, "b": 1} and not (tmp_path / "o").exists()


def test_clean_and_validate_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "b"), (2, "a", "b"), (3, "", "b")], "ordinal int, instruction string, output string")
    stats = pipeline.clean_table(df, "ordinal", str(tmp_path / "c"), str(tmp_path / "r"))
    assert stats.first()["final_rows"] == 1 and spark.read.parquet(str(tmp_path / "c")).count() == 1
    assert json.loads((tmp_path / "r.json").read_text())["original_rows"] == 3 and "| original_rows" in (tmp_path / "r.md").read_text()
    report = pipeline.validate_table(df, "ordinal", str(tmp_path / "v"))
    assert report["duplicates"]["n_duplicates"] == 1 and (tmp_path / "v.md").exists()


def test_registry_entries(tmp_path):
    good = {"name": "a", "repo_id": "r", "split": "train", "destination": "d", "enabled": True, "other": 1}
    (tmp_path / "r.yaml").write_text(json.dumps({"datasets": [good, good | {"name": "b", "enabled": False}]}))
    entries = load_registry(str(tmp_path / "r.yaml"))
    assert [e.name for e in enabled(entries)] == ["a"] and enabled(entries, ["zzz"]) == []
    (tmp_path / "e.json").write_text('{"datasets": []}')
    assert load_registry(str(tmp_path / "e.json")) == []
    for bad in ({**good, "enabled": "yes"}, {k: v for k, v in good.items() if k != "split"}, {**good, "shard_size": True}, []):
        with pytest.raises(ValueError):
            parse_entry(bad)
    with pytest.raises(FileNotFoundError):
        load_registry(str(tmp_path / "none.yaml"))


def test_training_file_catalog(spark, tmp_path):
    info = DatasetInfo(str(tmp_path / "dataset_info.json"))
    with pytest.raises(PreflightError):
        preflight(spark, info, "a")
    info.register("a", DatasetInfo.entry("a.jsonl"))
    assert info.is_registered("a") and info.file("a").name == "a.jsonl"
    with pytest.raises(ValueError):
        info.register("a", {}, overwrite=False)
    for name in ("zzz", "a"):
        with pytest.raises(PreflightError):
            preflight(spark, info, name)
    (tmp_path / "a.jsonl").write_text("\n")
    with pytest.raises(PreflightError):
        preflight(spark, info, "a")
    (tmp_path / "a.jsonl").write_text("{}\n")
    assert preflight(spark, info, "a") == 1
    assert info.unregister("a") and not info.unregister("a")
    Path(info.path).write_text("{broken")
    assert info.load() == {}


def test_states(tmp_path):
    s = StateStore(str(tmp_path))
    assert s.load("a") is None and not s.is_shard_done("a", 0)
    s.mark_shard_done("a", 0, 5)
    s.mark_shard_done("a", 0, 5)
    s.mark_shard_done("a", 2, 1)
    assert s.load("a").total_rows == 6 and s.load("a").completed == [0, 2] and s.is_shard_done("a", 2)
    (tmp_path / "b.json").write_text("{")
    assert s.load("b") is None and list(s.all_states()) == ["a"]
    s.reset("a")
    assert s.load("a") is None


def test_config_files(tmp_path):
    (tmp_path / "c.yaml").write_text("quality:\n  min_score: 0.5\ndedup:\n  max_copies: 1\n")
    c = pipeline.config_from(sinks.load_config(str(tmp_path / "c.yaml")))
    assert c.max_copies == 1 and c.quality.min_score == 0.5 and c.quality.autogen_patterns == ()
    assert sinks.load_config(str(tmp_path / "none.yaml")) == {}
    sinks.append_jsonl(str(tmp_path / "l.jsonl"), {"é": 1})
    assert (tmp_path / "l.jsonl").read_text() == '{"é": 1}\n'


def test_stream_counts_copies_over_batches_and_restarts(spark, tmp_path):
    same = "the same answer everywhere"
    source, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "ck"))

    def arrive(n, output=None):
        examples(spark, n, output).drop("ordinal").coalesce(1).write.mode("append").parquet(source)

    def run():
        start(curated_stream(read_stream(spark, source, CANONICAL), RAW_CONFIG), out, checkpoint).awaitTermination()
        return spark.read.schema(CANONICAL).parquet(out).groupBy((F.col("output") == same).alias("same")).count().collect()

    arrive(1, same)
    arrive(5, same)
    arrive(4)
    assert {r[0]: r[1] for r in run()} == {True: 2, False: 4}
    arrive(3, same)
    assert {r[0]: r[1] for r in run()} == {True: 2, False: 4}


def test_log_files_and_token_caches(spark, tmp_path):
    import logging

    from sedimenta.logs import configure
    from sedimenta.operators.tokenise import tokenised, write_cache

    log = configure(str(tmp_path / "l/run.log"), "sedimenta.test")
    assert configure(str(tmp_path / "l/run.log"), "sedimenta.test") is log and len(log.handlers) == 2
    log.debug("detail")
    logging.shutdown()
    assert "detail" in (tmp_path / "l/run.log").read_text()
    for n in (3, 5):
        write_cache(tokenised(examples(spark, n)), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "c")).count() == 3
