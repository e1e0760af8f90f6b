"""Catalogue of the engine's queries, each over its whole tables, and their SQL over the same tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions import quality as Q
from sedimenta.functions import text as X
from sedimenta.functions.detect import DETECTORS, detect_language
from sedimenta.functions.metrics import contains_code_block, evaluate, evaluate_each, pass_at_k
from sedimenta.operators import bloom, curate, dedup, formats, legacy, mixing, profile, tokenise
from sedimenta.operators.adapters import INPUT_FIELDS, INSTRUCTION_FIELDS, OUTPUT_FIELDS, REPOSITORY_HOST, adapt_mixed
from sedimenta.schema import CANONICAL, TASK_TYPES, decode_metadata, encode_metadata, errors, from_storage, make_id
from sedimenta.plans import pipeline
from sedimenta.plans.registry import enabled, entries_of
from sedimenta.session import shared_dir, table
from sedimenta.sources import files, sinks

Query = Callable[[SparkSession, str], DataFrame]

BLOCKED = curate.CleanConfig(blocked_substrings=("language model", "No Library"), blocked_patterns=(r"go against my \w+",))
EXACT = mixing.MixConfig({"forge_stack": 0.40, "kiln_sft": 0.20, "issue_patch": 0.15, "doc_search": 0.15}, "exact", 1_000)
OVER = mixing.MixConfig({"tiny_katas": 3.0, "rare_langs": 1.0, "config_bank": 2.0, "qa_harbor": 3.5}, "oversample", 900)
APPROXIMATE = mixing.MixConfig({"forge_stack": 0.6, "tiny_katas": 0.4, "legacy_snippets": 0.0})
SEED, VAL_RATIO, SHARD_ROWS = 42, 0.05, 1_000
K = (1, 5)


def examples(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "canonical_examples")


def prepared(s: SparkSession, d: str) -> DataFrame:
    """Canonical rows with tidy languages, as the curation chain takes them."""
    df = from_storage(examples(s, d), "ordinal")
    return df.withColumn("language", F.coalesce(F.nullif(F.lower(X.strip(F.col("language"))), F.lit("")), F.lit("unknown")))


def _lines(s: SparkSession, d: str) -> DataFrame:
    line = F.col("raw_line")
    kind = F.schema_of_variant(F.try_parse_json(line))
    blank = X.is_blank(line)
    return table(s, d, "raw_records").groupBy("dataset").agg(F.count("*").alias("n_lines"), F.count_if(blank).alias("n_blank"), F.count_if(~blank & F.coalesce(kind.startswith("OBJECT"), F.lit(False))).alias("n_objects"), F.count_if(~blank & ~F.coalesce(kind.startswith("OBJECT"), F.lit(False))).alias("n_skipped"))


def _quality(s: SparkSession, d: str) -> DataFrame:
    out, lang = F.col("output"), F.col("language")
    parts = {"token": Q.token_score(out), "alpha": Q.alpha_score(out), "comment": Q.comment_score(out), "autogen": Q.autogen_score(out), "language": Q.language_score(lang), "total": Q.quality(out, lang)}
    return prepared(s, d).select("ordinal", *(F.round(v, 4).alias(f"{k}_score") for k, v in parts.items()))


def _pass_at_k(s: SparkSession, d: str) -> DataFrame:
    n = examples(s, d).filter("dataset is not null").groupBy("dataset").agg(F.count("*").alias("n"), F.count_if(F.col("quality_score").between(0.5, 1.0)).alias("c"))
    return n.select("dataset", "n", "c", *(F.round(pass_at_k(F.col("n"), F.col("c"), F.lit(k)), 6).alias(f"pass_at_{k}") for k in K))


def _pairs(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    df = examples(s, d)
    return df.select(F.col("ordinal").alias("position"), F.col("output").alias("text")), df.select(F.col("ordinal").alias("position"), F.col("instruction").alias("text"))


def _metadata(s: SparkSession, d: str) -> DataFrame:
    df = examples(s, d).select("ordinal", decode_metadata(F.col("metadata")).alias("m"))
    return df.select("ordinal", F.size("m").alias("n_keys"), F.array_join(F.array_sort(F.map_keys("m")), ",").alias("keys"), (F.size(decode_metadata(encode_metadata(F.col("m")))) == F.size("m")).alias("same_again"))


def _profile(s: SparkSession, d: str) -> DataFrame:
    out = None
    for name in ("customer", "orders", "documents"):
        one = profile.columns(table(s, d, name)).select(F.lit(name).alias("table_name"), "column_name", "total", "missing", "missing_pct", "is_text")
        out = one if out is None else out.unionByName(one)
    return out


def _stream(s: SparkSession, d: str) -> DataFrame:
    """The table in several files as a stream of as many batches, run to its end, with its result read back and counted."""
    from sedimenta.streaming.curate import keep_copies, read_stream, start

    at = _place(s, "stream")
    examples(s, d).select("id", "output").repartition(3).write.parquet(f"{at}/in")
    rows = read_stream(s, f"{at}/in", T.StructType([f for f in CANONICAL.fields if f.name in ("id", "output")]), 1).filter("output is not null").select("id", "output")
    start(keep_copies(rows), f"{at}/out", f"{at}/checkpoint").awaitTermination()
    kept = s.read.schema("id string, output string").parquet(f"{at}/out")
    return kept.groupBy(F.sha2("output", 256).alias("output_hash")).agg(F.count("*").alias("n_kept"))


def _place(s: SparkSession, name: str) -> str:
    return f"{shared_dir(s)}/{name}-{uuid.uuid4().hex}"


def _jsonl_rows(s: SparkSession, d: str) -> DataFrame:
    """The raw lines as files, one folder for each dataset, read by the source of JSON lines with the registry's adapters."""
    at = _place(s, "lines")
    table(s, d, "raw_records").filter("raw_line is not null").select("dataset", "raw_line").write.partitionBy("dataset").text(at)
    out = None
    for e in entries_of(table(s, d, "dataset_registry")):
        own = files.jsonl_source(s, [f"{at}/dataset={e.name}", f"{at}/missing"], e.name, e.adapter or "generic", e.license, e.task_type).select("dataset", "id", "task_type", "instruction", "input", "output")
        out = own if out is None else out.unionByName(own)
    return out


def _shards(s: SparkSession, d: str, ratio: float) -> str:
    at = _place(s, "shards")
    sinks.write_shards(examples(s, d), at, shard_rows=SHARD_ROWS, val_ratio=ratio, seed=SEED, named=True)
    return at


def _stored_rows(s: SparkSession, d: str) -> DataFrame:
    """The table written in shards, with a broken file among them, and read back as canonical rows."""
    at = _shards(s, d, 0.0)
    sinks.write_text(s, f"{at}/train-99999.parquet", "no parquet")
    return files.processed_shards(s, at).groupBy("dataset").agg(F.count("*").alias("n_rows"), F.sum(F.length("output")).alias("n_chars"), F.count_if(F.col("license") == "unknown").alias("n_unknown"))


def _sidecar(s: SparkSession, d: str) -> DataFrame:
    m = sinks.write_sidecar(s, _shards(s, d, VAL_RATIO), "examples")
    named = all(f.startswith(("train-0", "val-0")) and f.endswith(".parquet") for f in m["files"])
    return s.createDataFrame([(m["dataset"], m["train_rows"], m["val_rows"], m["total_rows"], named)], "dataset string, train_rows long, val_rows long, total_rows long, named boolean")


def _training_file(s: SparkSession, d: str) -> DataFrame:
    at = _place(s, "alpaca")
    sinks.write_alpaca(examples(s, d), at)
    return files.load_jsonl(s, at, "instruction string, input string, output string")


def _enabled(s: SparkSession, d: str) -> DataFrame:
    """The registry as entries, checked, and those that are enabled."""
    return s.createDataFrame([(e.name, e.shard_size or 50_000) for e in enabled(entries_of(table(s, d, "dataset_registry")))], "name string, shard_rows int")


def _bloom(s: SparkSession, d: str) -> DataFrame:
    texts = table(s, d, "documents").select("text").filter("text is not null")
    made = bloom.build(texts, "text", 1_000_000)
    return bloom.members(texts, "text", made).agg(F.count("*").alias("n_texts"), F.count_if("member").alias("n_found"))


def _shuffled(s: SparkSession, d: str) -> DataFrame:
    """The place of each row in the shuffled table."""
    rows = mixing.shuffled(examples(s, d).select("ordinal"), SEED, "ordinal").withColumn("_at", F.monotonically_increasing_id())
    return mixing.dense(rows, "_at", name="place").select("ordinal", F.col("place").cast("long").alias("place"))


def _run(s: SparkSession, d: str) -> DataFrame:
    """A dry run over the enabled datasets; what its manifest says of each."""
    entries = enabled(entries_of(table(s, d, "dataset_registry")))
    rows = prepared(s, d)
    m = pipeline.run(s, entries, {e.name: rows.filter(F.col("dataset") == e.name) for e in entries}, _place(s, "run"), dry_run=True)
    keys = ("source_rows", "dropped_cleaning", "dropped_quality", "dropped_dedup", "yielded")
    return s.createDataFrame([(n, *(int(x[k]) for k in keys)) for n, x in m.sources.items()], "dataset string, " + ", ".join(f"{k} long" for k in keys))


def _caps(s: SparkSession, d: str) -> DataFrame:
    caps = mixing.source_caps(list(EXACT.ratios), mixing.parse_ratios(EXACT.ratios), 500)
    alpaca = formats.to_alpaca(examples(s, d), "ordinal").filter(F.col("_source").isin(*caps))
    return mixing.cap_sources(alpaca, caps).select("ordinal", F.col("_source").alias("source"))


def _unseen(s: SparkSession, d: str) -> DataFrame:
    seen = table(s, d, "documents").select(F.sha2("text", 256).alias("hash")).filter("hash is not null")
    return dedup.unseen(examples(s, d).filter("output is not null"), seen).select("ordinal")


def queries() -> dict[str, Query]:
    """A function of session and folder for each query."""
    return {
        "pipeline_stats": lambda s, d: curate.pipeline_stats(curate.mark(prepared(s, d), only=("language",)), "language"),
        "curated": lambda s, d: curate.curate(prepared(s, d)).select("ordinal", "instruction", "input", "output", "quality_score"),
        "adapted": lambda s, d: adapt_mixed(table(s, d, "raw_records"), table(s, d, "dataset_registry"), ("raw_id",)).drop("schema_version", "quality_score", "metadata"),
        "jsonl_lines": _lines,
        "validation_errors": lambda s, d: examples(s, d).select("ordinal", F.array_join(errors(examples(s, d)), "; ").alias("errors")),
        "make_ids": lambda s, d: examples(s, d).select("ordinal", make_id(F.col("instruction"), F.col("output")).alias("made_id")),
        "cleaned": lambda s, d: curate.clean_stage(prepared(s, d)).select("ordinal", "instruction", "input", "output"),
        "blocked": lambda s, d: prepared(s, d).filter(curate.on_blocklist(BLOCKED)).select("ordinal"),
        "quality_scores": _quality,
        "quality_kept": lambda s, d: curate.quality_stage(prepared(s, d), Q.QualityConfig(min_score=0.8)).select("ordinal", "quality_score"),
        "dedup_keep_two": lambda s, d: dedup.keep_copies(examples(s, d).filter("output is not null"), "output", "ordinal").select("ordinal"),
        "dedup_by_key": lambda s, d: dedup.by_key(examples(s, d), "instruction", "ordinal").select("ordinal"),
        "dedup_by_row": lambda s, d: dedup.by_row(examples(s, d).select("ordinal", "dataset", "language", "instruction", "input", "output"), "ordinal").select("ordinal"),
        "dedup_by_text": lambda s, d: dedup.by_text(examples(s, d), ["instruction", "output"], "ordinal").select("ordinal"),
        "dedup_numbers": lambda s, d: dedup.occurrence(examples(s, d).filter("output is not null"), F.sha2("output", 256), "ordinal").select("ordinal", "n"),
        "dedup_stats": lambda s, d: dedup.stats(examples(s, d).filter("output is not null")),
        "dedup_copies": lambda s, d: dedup.copies(table(s, d, "documents").filter("text is not null"), "text"),
        "duplicate_rows": lambda s, d: dedup.duplicate_rows(table(s, d, "documents").select("doc_id", "text", "lang"), "doc_id"),
        "unseen_outputs": _unseen,
        "legacy_cleaned": lambda s, d: legacy.clean(examples(s, d).select("ordinal", "instruction", "output"), "ordinal").select("ordinal", "instruction", "output"),
        "legacy_stats": lambda s, d: legacy.clean_stats(examples(s, d).select("ordinal", "instruction", "output"), "ordinal"),
        "legacy_lengths": lambda s, d: legacy.filter_by_length(examples(s, d), "output").select("ordinal"),
        "source_stats": lambda s, d: profile.source_stats(examples(s, d)),
        "token_histogram": lambda s, d: profile.token_histogram(examples(s, d), "instruction", "output"),
        "column_profile": _profile,
        "text_stats": lambda s, d: profile.texts(examples(s, d), ["instruction", "input", "output"]),
        "detected_languages": lambda s, d: examples(s, d).select("ordinal", detect_language(F.col("output")).alias("detected")),
        "top_languages": lambda s, d: profile.languages(examples(s, d)),
        "mix_exact": lambda s, d: mixing.exact(examples(s, d), EXACT.targets).select("ordinal", "dataset"),
        "mix_oversample": lambda s, d: mixing.oversample(examples(s, d), OVER.targets).select("ordinal", "dataset", "_mix_use").withColumnRenamed("_mix_use", "use_no"),
        "mix_approximate": lambda s, d: mixing.mix_stats(mixing.approximate(examples(s, d), APPROXIMATE)),
        "source_caps": _caps,
        "total_cap": lambda s, d: mixing.cap_total(formats.to_alpaca(examples(s, d), "ordinal"), 700, "_source", "ordinal").select("ordinal", F.col("_source").alias("source")),
        "shuffled_ranks": _shuffled,
        "random_sample": lambda s, d: mixing.sample(examples(s, d).select("ordinal", "dataset"), 100, SEED, "ordinal"),
        "train_val_split": lambda s, d: mixing.split(mixing.numbered(examples(s, d).select("ordinal"), "ordinal", SHARD_ROWS), VAL_RATIO, SEED, "shard", "ordinal").select("ordinal", "split"),
        "chat_texts": lambda s, d: prepared(s, d).select("ordinal", formats.render(formats.chat_messages(F.col("instruction"), F.col("input"), F.col("output"))).alias("chat")),
        "chatml_messages": lambda s, d: prepared(s, d).select("ordinal", F.explode(formats.messages(F.col("instruction"), F.col("output"))).alias("m")).select("ordinal", "m.role", "m.content"),
        "alpaca_rows": lambda s, d: formats.to_alpaca(examples(s, d), "ordinal").withColumnRenamed("_source", "source"),
        "prompt_response": lambda s, d: formats.to_prompt_response(examples(s, d), "ordinal"),
        "tokenised": lambda s, d: tokenise.tokenised(examples(s, d)).select("ordinal", "input_ids", "labels"),
        "exact_match": lambda s, d: evaluate(*_pairs(s, d)).select(F.round("mean", 9).alias("mean"), "n"),
        "exact_match_each": lambda s, d: evaluate_each(*_pairs(s, d)),
        "code_blocks": lambda s, d: examples(s, d).groupBy("dataset").agg(F.count("*").alias("n_rows"), F.count_if(contains_code_block(F.col("output"))).alias("n_blocks")),
        "pass_at_k": _pass_at_k,
        "metadata_keys": _metadata,
        "enabled_datasets": _enabled,
        "jsonl_rows": _jsonl_rows,
        "stored_rows": _stored_rows,
        "shard_sidecar": _sidecar,
        "training_file": _training_file,
        "bloom_members": _bloom,
        "run_manifest": _run,
        "stream_keep_two": _stream,
    }


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{X.SPACE}]+|[{X.SPACE}]+$', '', 'g')"


def _coerce(x: str) -> str:
    return f"coalesce({_strip(x)}, '')"


def _truthy(*names: str) -> str:
    return _coerce("coalesce(" + ", ".join(f"nullif(raw_line->>'$.{n}', '')" for n in names) + ")")


def _filled(*names: str) -> str:
    values = ", ".join(f"nullif({_strip(f"raw_line->>'$.{n}'")}, '')" for n in names)
    return f"coalesce({values}, '')"


def _language(*names: str) -> str:
    return f"coalesce(nullif(lower({_filled(*names)}), ''), 'unknown')"


def _q(text: str) -> str:
    return text.replace("'", "''")


_PREPARED = f"""e AS (SELECT ordinal, coalesce(instruction, '') AS instruction, coalesce(input, '') AS input, coalesce(output, '') AS output,
  coalesce(nullif(lower({_strip("language")}), ''), 'unknown') AS language FROM canonical_examples)"""


def _clean(x: str) -> str:
    return _strip(f"regexp_replace(regexp_replace(regexp_replace({x}, '<[^>]+>', '', 'g'), '[ \\t]+', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g')")


_CLEANED = f"""c0 AS (SELECT ordinal, language, {_clean("instruction")} AS instruction, {_clean("input")} AS input, {_clean("output")} AS output FROM e),
c AS (SELECT * FROM c0 WHERE length(output) BETWEEN 10 AND 32768 AND length(instruction) >= 3)"""


def _scores(table_: str) -> str:
    lines = f"list_filter(list_transform(regexp_split_to_array(output, '{X.LINE_END}'), lambda l: {_strip('l')}), lambda l: l <> '')"
    comments = f"len(list_filter({lines}, lambda l: regexp_matches(l, '^(?:#|//|--|;|%|/\\*|\\*|\"\"\"|'''''')')))"
    autogen = "|".join(f"(?:{p})" for p in Q.AUTOGEN_PATTERNS)
    known = ", ".join(f"'{k}'" for k in Q.KNOWN_LANGUAGES)
    return f"""p AS (SELECT *, length(output) / 4.0::DOUBLE AS nt, length(regexp_replace(output, '{_q(Q.NOT_GOOD)}', '', 'g'))::DOUBLE / nullif(length(output), 0) AS good,
  {comments}::DOUBLE / nullif(len({lines}), 0) AS com FROM {table_}),
s AS (SELECT *,
  CASE WHEN nt = 0 OR nt < 10 OR nt > 8192 THEN 0.0::DOUBLE WHEN nt <= 10 + 0.1::DOUBLE * 8182 THEN (nt - 10) / (10 + 0.1::DOUBLE * 8182 - 10)
       WHEN nt >= 10 + 0.9::DOUBLE * 8182 THEN (8192 - nt) / (8192 - (10 + 0.9::DOUBLE * 8182)) ELSE 1.0 END AS s1,
  CASE WHEN good IS NULL THEN 0.0::DOUBLE WHEN good < 0.25 THEN good / 0.25::DOUBLE ELSE 1.0 END AS s2,
  CASE WHEN com IS NULL THEN 0.0::DOUBLE WHEN com > 0.8::DOUBLE THEN greatest(0.0::DOUBLE, 1.0::DOUBLE - (com - 0.8::DOUBLE) / (1.0::DOUBLE - 0.8::DOUBLE)) ELSE 1.0 END AS s3,
  CASE WHEN regexp_matches(substr(output, 1, 2000), '(?i){autogen}') THEN 0.0::DOUBLE ELSE 1.0 END AS s4,
  CASE WHEN language IN ({known}) THEN 1.0::DOUBLE ELSE 0.5 END AS s5 FROM p),
q AS (SELECT *, 0.25::DOUBLE * s1 + 0.2::DOUBLE * s2 + 0.2::DOUBLE * s3 + 0.2::DOUBLE * s4 + 0.15::DOUBLE * s5 AS score FROM s)"""


_DETECT = "CASE " + " ".join(
    f"WHEN best > 0 AND hits[{i + 1}] = best THEN '{name}'" for i, (name, _) in enumerate(DETECTORS)
) + " ELSE 'Unknown' END"
_HITS = "[" + ", ".join(" + ".join(f"regexp_matches(head, '{_q(p)}')::INT" for p in patterns) for _, patterns in DETECTORS) + "]"
_DETECTED = f"""h AS (SELECT ordinal, output, substr(coalesce(output, ''), 1, 2000) AS head FROM canonical_examples),
g AS (SELECT ordinal, output, {_HITS} AS hits FROM h), b AS (SELECT *, list_max(hits) AS best FROM g), l AS (SELECT ordinal, output, {_DETECT} AS detected FROM b)"""

_ALPACA = f"""a AS (SELECT ordinal, {_coerce("instruction")} AS instruction, {_coerce("input")} AS input, {_coerce("output")} AS output, {_coerce("dataset")} AS source
  FROM canonical_examples WHERE {_coerce("instruction")} <> '' AND {_coerce("output")} <> '')"""


def _targets(targets: dict[str, int]) -> str:
    return "t(dataset, target) AS (VALUES " + ", ".join(f"('{k}', {v})" for k, v in targets.items()) + ")"


def _first(partition: str, most: int, where: str = "TRUE") -> str:
    return f"SELECT ordinal FROM canonical_examples WHERE {where} QUALIFY row_number() OVER (PARTITION BY {partition} ORDER BY ordinal) <= {most}"


def _adapted() -> str:
    named = lambda lang, what: f"CASE WHEN {lang} <> 'unknown' THEN 'Complete the following ' || {lang} || ' {what}:' ELSE 'Complete the following {what}:' END"
    file_lang, func_lang = _language("lang", "language", "programming_language"), _language("language", "lang")
    doc, repo = _truthy("func_documentation_string", "docstring", "summary"), _truthy("repository_name", "repo_name", "repo")
    problem, issue_repo = _truthy("problem_statement", "text", "issue"), _truthy("repo", "repository")
    pick = lambda a, b, c, d, e: f"CASE adapter WHEN 'opc_sft_stage1' THEN {a} WHEN 'the_stack_v2' THEN {b} WHEN 'code_search_net' THEN {c} WHEN 'swe_bench_verified' THEN {d} ELSE {e} END"
    instruction = pick(_truthy("instruction", "prompt", "text"), named(file_lang, "code"), f"CASE WHEN {doc} <> '' THEN 'Write a function that does the following:' || chr(10) || {doc} ELSE {named(func_lang, 'function')} END", f"CASE WHEN {problem} <> '' THEN 'Fix the following software issue:' || chr(10) || {problem} ELSE '' END", _filled(*INSTRUCTION_FIELDS))
    output = pick(_truthy("output", "response"), _truthy("content", "text", "code"), _truthy("func_code_string", "whole_func_string", "code"), _truthy("patch", "solution", "output"), _filled(*OUTPUT_FIELDS))
    language = pick("'unknown'", file_lang, func_lang, "'python'", _language("language", "lang", "programming_language"))
    repository = pick("''", f"CASE WHEN contains({repo}, '/') THEN '{REPOSITORY_HOST}' || {repo} ELSE '' END", "''", f"CASE WHEN {issue_repo} <> '' THEN '{REPOSITORY_HOST}' || {issue_repo} ELSE '' END", "''")
    own = "coalesce(license, 'unknown')"
    license_ = pick(own, _coerce(f"coalesce(nullif(raw_line->>'$.license', ''), {own})"), own, own, own)
    task = f"coalesce(nullif(task_type, ''), {pick("'instruction'", "'completion'", f"CASE WHEN {doc} <> '' THEN 'instruction' ELSE 'completion' END", "'debugging'", "'instruction'")})"
    return f"""WITH r AS (SELECT raw_id, r.dataset, raw_line, adapter, license, task_type FROM raw_records r LEFT JOIN dataset_registry g ON g.name = r.dataset
  WHERE CASE WHEN json_valid(raw_line) THEN json_type(raw_line) = 'OBJECT' ELSE FALSE END),
o AS (SELECT raw_id, dataset, {task} AS task_type, {language} AS language, {repository} AS repository, {license_} AS license, {instruction} AS instruction,
  {pick("''", "''", "''", "''", _filled(*INPUT_FIELDS))} AS input, {output} AS output FROM r)
SELECT *, sha256(instruction || chr(0) || output) AS id FROM o WHERE instruction <> '' AND output <> ''"""


def _run_sql() -> str:
    """The curation chain over the enabled datasets, copies counted in the order of the registry."""
    prepared_ = f"""r AS (SELECT name, row_number() OVER () AS entry FROM dataset_registry), e AS (SELECT entry * 1000000000000 + ordinal AS ordinal, dataset, coalesce(instruction, '') AS instruction, coalesce(input, '') AS input, coalesce(output, '') AS output,
      coalesce(nullif(lower({_strip("language")}), ''), 'unknown') AS language FROM canonical_examples JOIN r ON r.name = dataset JOIN dataset_registry g ON g.name = r.name AND g.enabled)"""
    chain = f"WITH {prepared_}, {_CLEANED}, {_scores('c')}, f AS (SELECT *, row_number() OVER (PARTITION BY output ORDER BY ordinal) AS n FROM q WHERE score >= 0.3)"
    count = lambda why, name: f"count(*) FILTER (WHERE why = '{why}') AS {name}"
    return f"{chain}, m AS (SELECT e.dataset, CASE WHEN q.ordinal IS NULL THEN 'cleaning' WHEN q.score < 0.3 THEN 'quality' WHEN f.n > 2 THEN 'dedup' ELSE 'kept' END AS why FROM e LEFT JOIN q USING (ordinal) LEFT JOIN f USING (ordinal)) SELECT dataset, count(*) AS source_rows, {count('cleaning', 'dropped_cleaning')}, {count('quality', 'dropped_quality')}, {count('dedup', 'dropped_dedup')}, {count('kept', 'yielded')} FROM m GROUP BY dataset"


def oracle_sql() -> dict[str, str]:
    """SQL for each query that SQL can state."""
    over = "WITH " + _targets(OVER.targets)
    pass_ = lambda k: f"round(CASE WHEN n - c < {k} THEN 1.0 WHEN c <= 0 THEN 0.0 ELSE 1.0 - list_aggregate(list_transform(range(n - c + 1, n + 1), lambda i: 1.0::DOUBLE - {k}::DOUBLE / i), 'product') END, 6) AS pass_at_{k}"
    hist = " ".join(f"WHEN t <= {hi} THEN '{lo}-{hi}'" for lo, hi in zip((0, *profile.HISTOGRAM[:-1]), profile.HISTOGRAM))
    columns = {"customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"), "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"), "documents": ("doc_id", "text", "lang", "source", "doc_domain", "fetched_at", "n_chars")}
    strings = {"c_name", "c_mktsegment", "o_orderstatus", "o_orderpriority", "text", "lang", "source", "doc_domain"}
    profiles = " UNION ALL ".join(f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS total, count(*) - count({c}) AS missing, round(100.0::DOUBLE * (count(*) - count({c})) / count(*), 4) AS missing_pct, {c in strings} AS is_text FROM {t}" for t, cs in columns.items() for c in cs)
    texts = " UNION ALL ".join(f"SELECT '{c}' AS column_name, count({c}) AS n, round(avg(length({c})), 2) AS avg_chars, max(length({c})) AS max_chars, round(avg(length({c})) / 4.0::DOUBLE, 2) AS avg_tokens, ceil(max(length({c})) / 4.0)::BIGINT AS max_tokens FROM canonical_examples" for c in ("instruction", "input", "output"))
    stripped = f"k AS (SELECT ordinal, regexp_replace({_strip('instruction')}, '\\r\\n|\\r', chr(10), 'g') AS instruction, regexp_replace({_strip('output')}, '\\r\\n|\\r', chr(10), 'g') AS output FROM canonical_examples)"
    ruled = f"{stripped}, u AS (SELECT *, CASE WHEN coalesce({_strip('output')}, '') = '' THEN 1 WHEN coalesce({_strip('instruction')}, '') = '' THEN 2 WHEN length(instruction) + length(output) > 32768 THEN 3 ELSE 0 END AS rule FROM k)"
    caps = mixing.source_caps(list(EXACT.ratios), mixing.parse_ratios(EXACT.ratios), 500)
    chat = f"CASE WHEN {_strip('input')} <> '' THEN instruction || chr(10) || chr(10) || '```' || chr(10) || input || chr(10) || '```' ELSE instruction END"
    turn = lambda role, text: f"'<|im_start|>{role}' || chr(10) || {text} || '<|im_end|>' || chr(10)"
    system = f"'{formats.SYSTEM_PROMPT}'"
    stats = "count(*) AS source_rows, count(*) FILTER (WHERE drop_reason = 'cleaning') AS dropped_cleaning, count(*) FILTER (WHERE drop_reason = 'quality') AS dropped_quality, count(*) FILTER (WHERE drop_reason = 'dedup') AS dropped_dedup, count(*) FILTER (WHERE drop_reason IS NULL) AS yielded, round(avg(round(score, 4)), 4) AS quality_mean, round(coalesce(var_samp(round(score, 4)), 0.0), 4) AS quality_variance, min(round(score, 4)) AS quality_min, max(round(score, 4)) AS quality_max"
    chain = f"WITH {_PREPARED}, {_CLEANED}, {_scores('c')}, f AS (SELECT *, row_number() OVER (PARTITION BY output ORDER BY ordinal) AS n FROM q WHERE score >= 0.3)"
    return {
        "pipeline_stats": f"{chain}, m AS (SELECT e.language, q.score, CASE WHEN q.ordinal IS NULL THEN 'cleaning' WHEN q.score < 0.3 THEN 'quality' WHEN f.n > 2 THEN 'dedup' END AS drop_reason FROM e LEFT JOIN q USING (ordinal) LEFT JOIN f USING (ordinal)) SELECT language, {stats} FROM m GROUP BY language",
        "curated": f"{chain} SELECT ordinal, instruction, input, output, round(score, 4) AS quality_score FROM f WHERE n <= 2",
        "adapted": _adapted(),
        "jsonl_lines": f"WITH l AS (SELECT dataset, raw_line IS NULL OR {_strip('raw_line')} = '' AS blank, CASE WHEN json_valid(raw_line) THEN json_type(raw_line) = 'OBJECT' ELSE FALSE END AS obj FROM raw_records) SELECT dataset, count(*) AS n_lines, count_if(blank) AS n_blank, count_if(NOT blank AND obj) AS n_objects, count_if(NOT blank AND NOT obj) AS n_skipped FROM l GROUP BY dataset",
        "validation_errors": f"""SELECT ordinal, array_to_string(list_filter([CASE WHEN coalesce(id, '') = '' THEN 'id is empty' END, CASE WHEN schema_version IS DISTINCT FROM '1.0' THEN 'schema_version mismatch' END,
            CASE WHEN NOT coalesce(task_type IN ({', '.join(f"'{t}'" for t in TASK_TYPES)}), FALSE) THEN 'unknown task_type' END, CASE WHEN {_coerce('instruction')} = '' THEN 'instruction is blank' END,
            CASE WHEN {_coerce('output')} = '' THEN 'output is blank' END, CASE WHEN NOT coalesce(quality_score BETWEEN 0.0 AND 1.0, FALSE) THEN 'quality_score out of range' END], lambda x: x IS NOT NULL), '; ') AS errors FROM canonical_examples""",
        "make_ids": "SELECT ordinal, sha256(coalesce(instruction, '') || chr(0) || coalesce(output, '')) AS made_id FROM canonical_examples",
        "cleaned": f"WITH {_PREPARED}, {_CLEANED} SELECT ordinal, instruction, input, output FROM c",
        "blocked": f"WITH {_PREPARED} SELECT ordinal FROM e WHERE contains(lower(output), 'language model') OR contains(lower(instruction), 'language model') OR contains(lower(output), 'no library') OR contains(lower(instruction), 'no library') OR regexp_matches(output, '(?i)go against my \\w+') OR regexp_matches(instruction, '(?i)go against my \\w+')",
        "quality_scores": f"WITH {_PREPARED}, {_scores('e')} SELECT ordinal, round(s1, 4) AS token_score, round(s2, 4) AS alpha_score, round(s3, 4) AS comment_score, round(s4, 4) AS autogen_score, round(s5, 4) AS language_score, round(score, 4) AS total_score FROM q",
        "quality_kept": f"WITH {_PREPARED}, {_scores('e')} SELECT ordinal, round(score, 4) AS quality_score FROM q WHERE score >= 0.8",
        "dedup_keep_two": _first("output", 2, "output IS NOT NULL"),
        "dedup_by_key": _first("coalesce(instruction, '')", 1),
        "dedup_by_row": _first("dataset, language, instruction, input, output", 1),
        "dedup_by_text": _first("coalesce(instruction, ''), coalesce(output, '')", 1),
        "dedup_numbers": "SELECT ordinal, row_number() OVER (PARTITION BY output ORDER BY ordinal) AS n FROM canonical_examples WHERE output IS NOT NULL",
        "dedup_stats": "WITH c AS (SELECT count(*) AS n FROM canonical_examples WHERE output IS NOT NULL GROUP BY output) SELECT sum(n)::BIGINT AS total_seen, sum(n - 1)::BIGINT AS repeats, sum(greatest(n - 2, 0))::BIGINT AS dropped, count(*) AS \"distinct\" FROM c",
        "dedup_copies": "WITH c AS (SELECT count(*) AS n_copies FROM documents WHERE text IS NOT NULL GROUP BY text) SELECT n_copies, count(*) AS n_values FROM c GROUP BY 1",
        "duplicate_rows": "WITH c AS (SELECT count(*) AS n FROM (SELECT text, lang FROM documents) GROUP BY text, lang) SELECT (SELECT count(*) FROM documents) AS n_rows, sum(n - 1)::BIGINT AS n_duplicates, round(100.0::DOUBLE * sum(n - 1) / (SELECT count(*) FROM documents), 4) AS duplicate_pct FROM c",
        "unseen_outputs": "SELECT ordinal FROM canonical_examples WHERE output IS NOT NULL AND output NOT IN (SELECT text FROM documents WHERE text IS NOT NULL)",
        "legacy_cleaned": f"WITH {ruled} SELECT ordinal, instruction, output FROM u WHERE rule = 0 QUALIFY row_number() OVER (PARTITION BY instruction, output ORDER BY ordinal) = 1",
        "legacy_stats": f"WITH {ruled}, z AS (SELECT count(*) AS o, count_if(rule = 1) AS a, count_if(rule = 2) AS b, count_if(rule = 3) AS c, count_if(rule = 0) AS k FROM u), y AS (SELECT count(*) AS n FROM (SELECT DISTINCT instruction, output FROM u WHERE rule = 0)) SELECT o AS original_rows, a AS removed_empty_outputs, b AS removed_empty_instructions, c AS removed_long, k - n AS removed_duplicate_rows, 0 AS removed_duplicate_texts, n AS final_rows, o - n AS total_removed, round(100.0::DOUBLE * n / o, 2) AS retention_pct FROM z, y",
        "legacy_lengths": "SELECT ordinal FROM canonical_examples WHERE length(coalesce(output, '')) BETWEEN 50 AND 8000",
        "source_stats": f"WITH r AS (SELECT coalesce(dataset, '') AS source, {_coerce('instruction')} <> '' AND {_coerce('output')} <> '' AS good FROM canonical_examples), g AS (SELECT source, count(*) AS raw, count_if(good) AS converted FROM r GROUP BY source UNION ALL SELECT 'TOTAL', count(*), count_if(good) FROM r) SELECT source, raw, converted, raw - converted AS dropped, converted AS sampled, round(100.0::DOUBLE * (raw - converted) / greatest(raw, 1), 2) AS drop_pct FROM g",
        "token_histogram": f"WITH t AS (SELECT ceil((coalesce(length(instruction), 0) + coalesce(length(output), 0)) / 4.0) AS t FROM canonical_examples) SELECT CASE {hist} ELSE '8192+' END AS bucket, count(*) AS n_rows FROM t GROUP BY 1",
        "column_profile": profiles,
        "text_stats": texts,
        "detected_languages": f"WITH {_DETECTED} SELECT ordinal, detected FROM l",
        "top_languages": f"WITH {_DETECTED} SELECT detected AS language, count(*) AS n_rows FROM l WHERE output IS NOT NULL GROUP BY 1 ORDER BY n_rows DESC, language LIMIT 5",
        "mix_exact": f"WITH {_targets(EXACT.targets)} SELECT ordinal, dataset FROM canonical_examples JOIN t USING (dataset) QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY ordinal) <= target",
        "mix_oversample": f"{over}, r AS (SELECT ordinal, dataset, target, row_number() OVER (PARTITION BY dataset ORDER BY ordinal) AS rn, count(*) OVER (PARTITION BY dataset) AS n FROM canonical_examples JOIN t USING (dataset)), x AS (SELECT ordinal, dataset, n, unnest(range(rn, target + 1, n)) AS place FROM r WHERE rn <= target) SELECT ordinal, dataset, ((place - 1) // n + 1)::INT AS use_no FROM x",
        "mix_approximate": "WITH c AS (SELECT dataset, count(*) AS n_rows FROM canonical_examples WHERE dataset IN ('forge_stack', 'tiny_katas') GROUP BY dataset) SELECT dataset, n_rows, round(n_rows::DOUBLE / sum(n_rows) OVER (), 4) AS actual_ratio FROM c",
        "source_caps": f"WITH {_ALPACA}, {_targets(caps)} SELECT ordinal, source FROM a JOIN t ON t.dataset = a.source QUALIFY row_number() OVER (PARTITION BY source ORDER BY ordinal) <= target",
        "total_cap": f"WITH {_ALPACA} SELECT ordinal, source FROM a ORDER BY source, ordinal LIMIT 700",
        "shuffled_ranks": f"SELECT ordinal, row_number() OVER (ORDER BY md5('{SEED}-' || ordinal), ordinal) AS place FROM canonical_examples",
        "random_sample": f"SELECT ordinal, dataset FROM canonical_examples ORDER BY md5('{SEED}-' || ordinal), ordinal LIMIT 100",
        "train_val_split": f"WITH r AS (SELECT ordinal, row_number() OVER (PARTITION BY (ordinal - 1) // {SHARD_ROWS} ORDER BY md5('{SEED}-' || ordinal), ordinal) AS rn, count(*) OVER (PARTITION BY (ordinal - 1) // {SHARD_ROWS}) AS n FROM canonical_examples) SELECT ordinal, CASE WHEN rn > n - round_even(n * {VAL_RATIO}::DOUBLE, 0) THEN 'val' ELSE 'train' END AS split FROM r",
        "chat_texts": f"WITH {_PREPARED} SELECT ordinal, {turn('system', system)} || {turn('user', chat)} || {turn('assistant', 'output')} AS chat FROM e",
        "chatml_messages": f"WITH {_PREPARED} SELECT ordinal, 'system' AS role, {system} AS content FROM e UNION ALL SELECT ordinal, 'user', instruction FROM e UNION ALL SELECT ordinal, 'assistant', output FROM e",
        "alpaca_rows": f"WITH {_ALPACA} SELECT * FROM a",
        "prompt_response": "SELECT ordinal, coalesce(instruction, '') || CASE WHEN coalesce(input, '') <> '' THEN chr(10) || chr(10) || 'Input:' || chr(10) || input ELSE '' END AS prompt, coalesce(output, '') AS response FROM canonical_examples",
        "exact_match": f"SELECT round(avg(({_strip('output')} = {_strip('instruction')})::INT::DOUBLE), 9) AS mean, count(*) AS n FROM canonical_examples",
        "exact_match_each": f"SELECT ordinal AS position, ({_strip('output')} = {_strip('instruction')})::INT::DOUBLE AS value FROM canonical_examples",
        "code_blocks": "SELECT dataset, count(*) AS n_rows, count_if(regexp_matches(coalesce(output, ''), '```\\w*\\n[\\s\\S]+?```')) AS n_blocks FROM canonical_examples GROUP BY dataset",
        "pass_at_k": f"WITH n AS (SELECT dataset, count(*)::BIGINT AS n, (count(*) FILTER (WHERE quality_score BETWEEN 0.5 AND 1.0))::BIGINT AS c FROM canonical_examples WHERE dataset IS NOT NULL GROUP BY dataset) SELECT dataset, n, c, {', '.join(map(pass_, K))} FROM n",
        "metadata_keys": "WITH m AS (SELECT ordinal, CASE WHEN json_valid(metadata) THEN CASE WHEN json_type(metadata) = 'OBJECT' THEN json_keys(metadata) END END AS k FROM canonical_examples) SELECT ordinal, coalesce(len(k), 0) AS n_keys, coalesce(array_to_string(list_sort(k), ','), '') AS keys, TRUE AS same_again FROM m",
        "enabled_datasets": "SELECT name, coalesce(shard_size, 50000) AS shard_rows FROM dataset_registry WHERE enabled",
        "jsonl_rows": f"SELECT dataset, id, task_type, instruction, input, output FROM ({_adapted()}) WHERE task_type IN ('instruction', 'completion', 'qa', 'debugging', 'documentation')",
        "stored_rows": "SELECT coalesce(dataset, '') AS dataset, count(*) AS n_rows, sum(length(coalesce(output, '')))::BIGINT AS n_chars, count_if(coalesce(license, 'unknown') = 'unknown')::BIGINT AS n_unknown FROM canonical_examples GROUP BY 1",
        "shard_sidecar": f"WITH n AS (SELECT count(*) AS n FROM canonical_examples GROUP BY (ordinal - 1) // {SHARD_ROWS}) SELECT 'examples' AS dataset, sum(n - round_even(n * 0.05::DOUBLE, 0))::BIGINT AS train_rows, sum(round_even(n * 0.05::DOUBLE, 0))::BIGINT AS val_rows, sum(n)::BIGINT AS total_rows, TRUE AS named FROM n",
        "training_file": f"WITH {_ALPACA} SELECT instruction, input, output FROM a",
        "bloom_members": "SELECT count(*) AS n_texts, count(*) AS n_found FROM documents WHERE text IS NOT NULL",
        "run_manifest": _run_sql(),
        "stream_keep_two": "SELECT sha256(output) AS output_hash, least(count(*), 2) AS n_kept FROM canonical_examples WHERE output IS NOT NULL GROUP BY output",
    }
