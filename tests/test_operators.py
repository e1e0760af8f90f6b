import random

import pytest
from pyspark.sql import functions as F

from sedimenta.operators import adapters, curate, dedup, formats, legacy, mixing, profile, tokenise
from sedimenta.operators.bloom import BloomFilter, build
from sedimenta.plans import catalogue
from sedimenta.schema import CANONICAL, canonical


def examples(spark, n, output=None, dataset="d"):
    rows = [(i, f"Write function #{i}.", output or f"def f{i}():\n    return {i}", dataset) for i in range(1, n + 1)]
    df = spark.createDataFrame(rows, "ordinal long, i string, o string, d string")
    return canonical(df, "ordinal", dataset=F.col("d"), instruction=F.col("i"), output=F.col("o"), language=F.lit("python"))


RAW = {
    "opc_sft_stage1": ({"instruction": "a", "output": "b"}, ("a", "b", "unknown", "instruction", "")),
    "the_stack_v2": ({"content": "x = 1", "lang": "Python", "repo": "o/r"}, ("Complete the following python code:", "x = 1", "python", "completion", "https://github.com/o/r")),
    "code_search_net": ({"func_code_string": "c", "func_documentation_string": "does", "language": "Go"}, ("Write a function that does the following:\ndoes", "c", "go", "instruction", "")),
    "swe_bench_verified": ({"problem_statement": "p", "patch": "q", "repo": "r"}, ("Fix the following software issue:\np", "q", "python", "debugging", "https://github.com/r")),
    "unheard_of": ({"question": "a", "answer": "b", "context": "c"}, ("a", "b", "unknown", "instruction", "")),
}


@pytest.mark.parametrize("name", RAW)
def test_adapters(spark, name):
    raw, want = RAW[name]
    df = spark.createDataFrame([tuple(raw.values())], ", ".join(f"{k} string" for k in raw))
    r = adapters.adapt(df, name, "d", "MIT").first()
    assert (r["instruction"], r["output"], r["language"], r["task_type"], r["repository"]) == want


def test_blank_first_field_drops_in_named_and_falls_through_in_generic_adapters(spark):
    df = spark.createDataFrame([("  ", "b", "o")], "instruction string, prompt string, output string")
    assert adapters.adapt(df, "opc_sft_stage1", "d").count() == 0
    assert adapters.adapt(df, "generic", "d").first()["instruction"] == "b"


def test_code_without_language_or_documentation(spark):
    df = spark.createDataFrame([("c",)], "code string")
    assert adapters.adapt(df, "the_stack_v2", "d").first()["instruction"] == "Complete the following code:"
    r = adapters.adapt(df, "code_search_net", "d").first()
    assert (r["instruction"], r["task_type"]) == ("Complete the following function:", "completion")
    assert adapters.adapter(None, "the_stack_v2") is adapters.code_files and adapters.adapter("x") is adapters.generic


def test_lines_of_many_datasets(spark):
    lines = [(1, "a", '{"instruction": "i", "output": "o", "output2": 1}'), (2, "a", "[1]"), (3, "a", '{"x"'), (4, "a", None), (5, "a", "  "), (6, "z", '{"question": 7, "answer": null, "code": "k"}'), (7, "a", '{"instruction": "i"}')]
    df = spark.createDataFrame(lines, "raw_id int, dataset string, raw_line string")
    reg = spark.createDataFrame([("a", "opc_sft_stage1", "MIT", "qa")], "name string, adapter string, license string, task_type string")
    got = {r["raw_id"]: (r["instruction"], r["output"], r["task_type"], r["license"]) for r in adapters.adapt_mixed(df, reg, ("raw_id",)).collect()}
    assert got == {1: ("i", "o", "qa", "MIT"), 6: ("7", "k", "instruction", "unknown")}


def test_five_equal_outputs_leave_two(spark):
    assert curate.curate(examples(spark, 5, "def f():\n    return 1 # same in all rows of the table"), curate.PipelineConfig(enable_quality=False)).count() == 2


def test_stages_can_be_switched_off(spark):
    off = curate.PipelineConfig(enable_cleaning=False, enable_quality=False, enable_dedup=False)
    assert curate.curate(examples(spark, 5), off).count() == 5
    r = curate.pipeline_stats(curate.mark(examples(spark, 5), off)).first()
    assert (r["source_rows"], r["yielded"], r["quality_mean"], r["quality_variance"]) == (5, 5, None, 0.0)


def test_marks_say_why_rows_drop_out(spark):
    rows = [("short", "x"), ("a task", "# auto-generated\n" * 4), ("a task", "good text of some length " * 4), ("a task", "good text of some length " * 4), ("a task", "good text of some length " * 4), (None, "good text of some length"), ("a task", None), ("a task", "")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "ordinal long, i string, o string")
    df = canonical(df, "ordinal", dataset=F.lit("d"), instruction=F.col("i"), output=F.col("o"))
    c = curate.PipelineConfig(quality=curate.QualityConfig(min_score=0.4), max_copies=2)
    got = [r["drop_reason"] for r in curate.mark(df, c).orderBy("ordinal").collect()]
    assert got == ["cleaning", "quality", None, None, "dedup", "cleaning", "cleaning", "cleaning"]
    assert sorted(r["ordinal"] for r in curate.curate(df, c).collect()) == [2, 3]
    s = curate.pipeline_stats(curate.mark(df, c)).first()
    assert (s["source_rows"], s["dropped_cleaning"], s["dropped_quality"], s["dropped_dedup"], s["yielded"]) == (8, 4, 1, 1, 2)


def test_blocklist_and_lengths(spark):
    c = curate.CleanConfig(blocked_substrings=("RETURN 3",), min_output=10)
    assert curate.clean_stage(examples(spark, 5), c).count() == 4
    assert curate.clean_stage(examples(spark, 5), curate.CleanConfig(min_instruction=100)).count() == 0
    assert curate.clean_stage(examples(spark, 0 + 1).limit(0)).count() == 0


def test_occurrence_numbers_rows_in_order_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(dedup, "SALT_ROWS", 10)
    rows = [(i, random.Random(i).choice("aab")) for i in range(100)]
    df = spark.createDataFrame(rows, "ordinal long, k string")
    seen, want = {}, {}
    for i, k in rows:
        seen[k] = seen.get(k, 0) + 1
        want[i] = seen[k]
    assert {r["ordinal"]: r["n"] for r in dedup.occurrence(df, F.col("k"), "ordinal").collect()} == want
    assert {r["ordinal"] for r in dedup.occurrence(df, F.col("k"), "ordinal", "n", 2).collect()} == {i for i, n in want.items() if n <= 2}


def test_deduplication_rules(spark):
    df = spark.createDataFrame([(1, "p", "x"), (2, "p", "y"), (3, None, "x"), (4, "", "x"), (5, "p", "x")], "ordinal int, prompt string, response string")
    ids = lambda d: sorted(r["ordinal"] for r in d.collect())
    assert ids(dedup.by_key(df, "prompt", "ordinal")) == [1, 3]
    assert ids(dedup.by_key(df, "absent", "ordinal")) == [1]
    assert ids(dedup.by_row(df, "ordinal")) == [1, 2, 3, 4]
    assert ids(dedup.by_text(df, ["response", "prompt"], "ordinal")) == [1, 2, 3]
    assert ids(dedup.by_text(df, [], "ordinal")) == [1, 2, 3, 4, 5]
    assert ids(dedup.keep_copies(df, "prompt", "ordinal", 2)) == [1, 2, 3, 4]
    assert tuple(dedup.stats(df, "response").first()) == (5, 3, 2, 2)
    assert tuple(dedup.duplicate_rows(df, "ordinal").first()) == (5, 1, 20.0)
    assert tuple(dedup.duplicate_rows(df.limit(0), "ordinal").first()) == (0, 0, 0.0)
    seen = df.limit(1).select(F.sha2("response", 256).alias("hash"))
    assert ids(dedup.unseen(df, seen, "response")) == [2]


def test_duplicates_are_counted_in_the_whole_table(spark, tmp_path):
    docs = spark.range(1, 500_003).select(F.col("id").alias("doc_id"), F.least("id", F.lit(500_001)).cast("string").alias("text"), F.lit("en").alias("lang"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")  # the two last rows are equal
    assert tuple(catalogue.queries()["duplicate_rows"](spark, str(tmp_path)).first())[:2] == (500_002, 1)
    assert tuple(dedup.duplicate_rows(docs, "doc_id", first=500_000).first())[:2] == (500_002, 0)


def test_bloom_filter(spark):
    with pytest.raises(ValueError):
        BloomFilter(0)
    with pytest.raises(ValueError):
        BloomFilter(10, 1.0)
    assert BloomFilter(5_000_000, 0.001).memory_bytes < 15 * 2**20
    f = build(spark.range(2000).select(F.concat(F.lit("t"), "id").alias("x")).repartition(4), "x", 2000)
    assert all(f"t{i}" in f for i in range(2000)) and f.count == 2000
    assert sum(f"u{i}" in f for i in range(5000)) < 25 and 0 < f.estimated_fpr() < 0.01
    assert "x" not in BloomFilter(10)


def test_legacy_rules(spark):
    rows = [(1, " a ", "b\r\nc"), (2, "a", "b\nc"), (3, "", "x"), (4, "q", None), (5, "q", "z" * 50), (6, "q", "r")]
    df = spark.createDataFrame(rows, "ordinal int, instruction string, output string")
    assert sorted(r["ordinal"] for r in legacy.clean(df, "ordinal", max_tokens=10).collect()) == [1, 6]
    s = legacy.clean_stats(df, "ordinal", max_tokens=10).first()
    assert tuple(s) == (6, 1, 1, 1, 1, 0, 2, 4, 33.33)
    assert legacy.text_columns(df) == ["instruction", "output"] and legacy.text_columns(df, ["output", "absent"]) == ["output"]
    assert legacy.remove_long(df, 0).count() == 6
    assert legacy.filter_by_length(df, "output").count() == 1 and legacy.filter_by_length(df, "absent", 0).count() == 6
    assert legacy.apply_filters(df, [F.col("ordinal") > 1, lambda d: d["ordinal"] < 4]).count() == 2
    alpaca = spark.createDataFrame([("a", "", "b")], "instruction string, input string, output string")
    assert legacy.remove_empty_instructions(alpaca).count() == 0
    assert legacy.clean_stats(df.limit(0), "ordinal").first()["retention_pct"] == 0.0


def test_mixer(spark):
    def mixer(strategy, total, a, b, ratios):
        m = mixing.DatasetMixer(mixing.MixConfig(ratios, strategy, total))
        m.register("a", examples(spark, a, dataset="a"))
        m.register("b", examples(spark, b, dataset="b"))
        return m

    assert mixer("approximate", None, 10, 10, {"a": 0.5, "b": 0.5}).mixed().count() == 20
    assert mixer("exact", 10, 20, 20, {"a": 1, "b": 1}).mixed().count() == 10
    over = mixer("oversample", 20, 3, 20, {"a": 0.7, "b": 0.3}).mixed()
    assert over.count() == 20 and max(r["_mix_use"] for r in over.collect()) == 5
    assert mixer("exact", 10, 5, 5, {"a": 1.0, "b": 0.0}).iter_mixed().count() == 5
    with pytest.raises(ValueError):
        mixer("oversample", 5, 2, 2, {"a": 1, "b": 1, "c": 1}).mixed()
    with pytest.raises(ValueError):
        m = mixing.DatasetMixer(mixing.MixConfig({"a": 1}))
        m.register("a", examples(spark, 1))
        m.register("a", examples(spark, 1))
    for bad in ({}, {"a": -1.0, "b": 2.0}, {"a": 0.0}):
        with pytest.raises(ValueError):
            mixing.MixConfig(bad)
    with pytest.raises(ValueError):
        mixing.MixConfig({"a": 1}, "other")
    with pytest.raises(ValueError):
        mixing.MixConfig({"a": 1}, "exact").targets


def test_approximate_mix_follows_the_ratios_until_a_source_is_exhausted(spark):
    m = mixing.DatasetMixer(mixing.MixConfig({"a": 3, "b": 1}))
    m.register("a", examples(spark, 3000, dataset="a"))
    m.register("b", examples(spark, 3000, dataset="b"))
    first = [r["dataset"] for r in m.mixed().orderBy("_mix_at").limit(2000).collect()]
    assert abs(first.count("a") / 2000 - 0.75) < 0.05


def test_quotas_round_half_to_even():
    assert mixing.MixConfig({"a": 1, "b": 1}, "exact", 5).targets == {"a": 2, "b": 2}
    assert mixing.parse_ratios(None) == {} and mixing.parse_ratios({"a": 0}) == {} and mixing.parse_ratios({"a": 1, "b": 3}) == {"a": 0.25, "b": 0.75}
    assert mixing.source_caps(["a", "b"], {}, 5) == {"a": 2, "b": 2} and mixing.source_caps(["a", "c"], {"a": 0.1}, 4) == {"a": 1, "c": 2} and mixing.source_caps(["a"], {}, None) is None


def test_split_sample_and_shuffle(spark):
    df = mixing.numbered(spark.range(1, 51).withColumnRenamed("id", "ordinal"), "ordinal", 25)
    got = mixing.split(df, 0.2, 42, "shard", "ordinal").groupBy("split").count().collect()
    assert dict((r[0], r[1]) for r in got) == {"train": 40, "val": 10}
    assert mixing.split(df, 0.9, 42, "shard", "ordinal").filter("split = 'val'").count() == 24  # clamped to a half, 12.5 rounds to 12
    assert mixing.split(df, 0.0, 42, "shard", "ordinal").filter("split = 'val'").count() == 0
    s = [r["ordinal"] for r in mixing.sample(df, 7, 1, "ordinal").collect()]
    assert len(set(s)) == 7 and s == [r["ordinal"] for r in mixing.sample(df.repartition(3), 7, 1, "ordinal").collect()]
    assert [r["ordinal"] for r in mixing.shuffled(df, 1, "ordinal").collect()] != list(range(1, 51))


def test_formats(spark):
    df = spark.createDataFrame([(1, " a ", "in", "o", "s"), (2, "a", None, "o", None), (3, " ", "x", "o", "s"), (4, "a", "x", None, "s")], "ordinal int, instruction string, input string, output string, dataset string")
    got = formats.to_alpaca(df, "ordinal").orderBy("ordinal").collect()
    assert [tuple(r) for r in got] == [(1, "a", "in", "o", "s"), (2, "a", "", "o", "")]
    assert formats.to_alpaca(df.drop("dataset", "input")).first()["_source"] == "unknown"
    assert [r["prompt"] for r in formats.to_prompt_response(df.filter("ordinal < 3")).collect()] == [" a \n\nInput:\nin", "a"]
    chat = df.filter("ordinal = 1").select(formats.render(formats.chat_messages(F.col("instruction"), F.col("input"), F.col("output")))).first()[0]
    assert chat == f"<|im_start|>system\n{formats.SYSTEM_PROMPT}<|im_end|>\n<|im_start|>user\n a \n\n```\nin\n```<|im_end|>\n<|im_start|>assistant\no<|im_end|>\n"


def test_tokenise(spark):
    df = spark.createDataFrame([(1, "a b", "", "c d"), (2, "", "", "x"), (3, "boom", "", "x")], "ordinal long, instruction string, input string, output string")

    def encode(text):
        if "boom" in text:
            raise ValueError(text)
        return [ord(c) for c in text]

    rows = tokenise.tokenised(df, encode, max_length=400, mask_prompt=True).collect()
    assert [r["ordinal"] for r in rows] == [1]
    labels = rows[0]["labels"]
    assert "".join(map(chr, (x for x in labels if x >= 0))) == "assistant\nc d<|im_end|>\n" and len(labels) == len(rows[0]["input_ids"])
    assert len(tokenise.tokenised(df, encode, max_length=5).first()["input_ids"]) == 5
    assert tokenise.tokenised(df).count() == 2


def test_profiles(spark):
    df = spark.createDataFrame([(1, "ab", None), (2, None, "x"), (3, "abcde", None)], "n int, text string, other string")
    got = {r["column_name"]: (r["missing"], r["missing_pct"], r["is_text"]) for r in profile.columns(df).collect()}
    assert got == {"n": (0, 0.0, False), "text": (1, 33.3333, True), "other": (2, 66.6667, False)}
    assert tuple(profile.texts(df, ["text"]).first()) == ("text", 2, 3.5, 5, 0.88, 2)
    h = {r["bucket"]: r["n_rows"] for r in profile.token_histogram(spark.createDataFrame([("x" * 256,), ("x" * 257,), (None,), ("x" * 40_000,)], "text string"), "text").collect()}
    assert h == {"0-64": 2, "64-128": 1, "8192+": 1}
    s = spark.createDataFrame([("a", "i", "o"), ("a", " ", "o"), (None, "i", None)], "dataset string, instruction string, output string")
    assert {r["source"]: (r["raw"], r["converted"], r["drop_pct"]) for r in profile.source_stats(s).collect()} == {"a": (2, 1, 50.0), "": (1, 0, 100.0), "TOTAL": (3, 1, 66.67)}
    assert profile.columns(df.limit(0)).first()["missing_pct"] == 0.0


def test_canonical_schema_has_twelve_fields():
    assert len(CANONICAL.fields) == 12


def test_large_targets_are_ranked_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(dedup, "SALT_ROWS", 500)
    df = spark.range(1, 4_001).select(F.col("id").alias("ordinal"), F.when(F.col("id") % 4 == 0, "b").otherwise("a").alias("dataset"))
    whole = {"a": [i for i in range(1, 4_001) if i % 4], "b": list(range(4, 4_001, 4))}
    targets = {"a": 2_500, "b": 1_200}
    exact, over = mixing.exact(df, targets), mixing.oversample(df, targets)
    assert all("_block" in d._jdf.queryExecution().optimizedPlan().toString() for d in (exact, over))
    assert sorted(r["ordinal"] for r in exact.collect()) == sorted(whole["a"][:2_500] + whole["b"])
    assert sorted((r["ordinal"], r["_mix_use"]) for r in over.collect()) == sorted([(i, 1) for i in whole["a"][:2_500] + whole["b"]] + [(i, 2) for i in whole["b"][:200]])
