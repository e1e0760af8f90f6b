"""Raw records of several shapes to canonical rows. An adapter maps a DataFrame to one; columns it lacks count as null."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.text import coerce, first_filled, first_truthy
from sedimenta.schema import UNKNOWN, canonical, valid

# Names under which the parts of a record are looked for, in order.
INSTRUCTION_FIELDS = ("instruction", "prompt", "question", "problem_statement", "text", "body", "hint", "query")
OUTPUT_FIELDS = ("output", "response", "answer", "solution", "code", "content", "patch", "func_code_string")
INPUT_FIELDS = ("input", "context", "auxiliary", "stdin")
OTHER_FIELDS = ("language", "lang", "programming_language", "repository_name", "repo_name", "repo", "repository", "license", "whole_func_string", "func_documentation_string", "docstring", "summary", "issue")
RAW_FIELDS = tuple(dict.fromkeys(INSTRUCTION_FIELDS + OUTPUT_FIELDS + INPUT_FIELDS + OTHER_FIELDS))
REPOSITORY_HOST = "https://github.com/"


class Fields:
    """Access to the raw fields of ``df``, by name."""

    def __init__(self, df: DataFrame, prefix: str = "") -> None:
        self.known = {c: F.col(f"{prefix}`{c}`") for c in (df.columns if not prefix else RAW_FIELDS)}

    def all(self, *names: str) -> list[Column]:
        return [self.known[n] for n in names if n in self.known] or [F.lit(None).cast("string")]

    def truthy(self, *names: str) -> Column:
        return first_truthy(*self.all(*names))

    def filled(self, *names: str) -> Column:
        return first_filled(*self.all(*names))

    def language(self, *names: str) -> Column:
        return F.coalesce(F.nullif(F.lower(self.filled(*names)), F.lit("")), F.lit(UNKNOWN))


def _named(known: Column, phrase: str) -> Column:
    """``Complete the following [language] <phrase>:``"""
    return F.when(known != UNKNOWN, F.concat(F.lit("Complete the following "), known, F.lit(f" {phrase}:"))).otherwise(F.lit(f"Complete the following {phrase}:"))


def instruction_pairs(f: Fields, license: Column, task: Column) -> dict[str, Column]:
    return {"instruction": f.truthy("instruction", "prompt", "text"), "output": f.truthy("output", "response"), "task_type": F.coalesce(F.nullif(task, F.lit("")), F.lit("instruction")), "license": license}


def code_files(f: Fields, license: Column, task: Column) -> dict[str, Column]:
    lang, repo = f.language("lang", "language", "programming_language"), f.truthy("repository_name", "repo_name", "repo")
    own = F.coalesce(*(F.nullif(c.cast("string"), F.lit("")) for c in f.all("license")), license)
    return {
        "instruction": _named(lang, "code"), "output": f.truthy("content", "text", "code"), "task_type": F.coalesce(F.nullif(task, F.lit("")), F.lit("completion")), "language": lang,
        "repository": F.when(repo.contains("/"), F.concat(F.lit(REPOSITORY_HOST), repo)).otherwise(F.lit("")), "license": coerce(own),
    }


def documented_functions(f: Fields, license: Column, task: Column) -> dict[str, Column]:
    lang, doc = f.language("language", "lang"), f.truthy("func_documentation_string", "docstring", "summary")
    return {
        "instruction": F.when(doc != "", F.concat(F.lit("Write a function that does the following:\n"), doc)).otherwise(_named(lang, "function")),
        "output": f.truthy("func_code_string", "whole_func_string", "code"), "language": lang, "license": license,
        "task_type": F.coalesce(F.nullif(task, F.lit("")), F.when(doc != "", F.lit("instruction")).otherwise(F.lit("completion"))),
    }


def issue_patches(f: Fields, license: Column, task: Column) -> dict[str, Column]:
    problem, repo = f.truthy("problem_statement", "text", "issue"), f.truthy("repo", "repository")
    return {
        "instruction": F.when(problem != "", F.concat(F.lit("Fix the following software issue:\n"), problem)).otherwise(F.lit("")), "output": f.truthy("patch", "solution", "output"),
        "task_type": F.coalesce(F.nullif(task, F.lit("")), F.lit("debugging")), "language": F.lit("python"), "repository": F.when(repo != "", F.concat(F.lit(REPOSITORY_HOST), repo)).otherwise(F.lit("")), "license": license,
    }


def generic(f: Fields, license: Column, task: Column) -> dict[str, Column]:
    return {"instruction": f.filled(*INSTRUCTION_FIELDS), "output": f.filled(*OUTPUT_FIELDS), "input": f.filled(*INPUT_FIELDS), "language": f.language("language", "lang", "programming_language"), "task_type": F.coalesce(F.nullif(task, F.lit("")), F.lit("instruction")), "license": license}


Adapter = Callable[[Fields, Column, Column], dict[str, Column]]
ADAPTERS: dict[str, Adapter] = {"opc_sft_stage1": instruction_pairs, "the_stack_v2": code_files, "code_search_net": documented_functions, "swe_bench_verified": issue_patches, "generic": generic}


def adapter(name: str | None, fallback: str | None = None) -> Adapter:
    """The adapter of that name, else of the fallback's, else the generic one."""
    return ADAPTERS.get(name or "") or ADAPTERS.get(fallback or "") or generic


def register(name: str, own: Adapter) -> None:
    ADAPTERS[name] = own


def adapt(df: DataFrame, name: str | None, dataset: str, license: str | None = None, task_type: str | None = None, keep: tuple[str, ...] = (), only_valid: bool = True) -> DataFrame:
    """Canonical rows of the raw rows ``df``; rows without instruction or output, and with ``only_valid`` invalid ones, drop out."""
    made = adapter(name)(Fields(df), F.lit(license or UNKNOWN), F.lit(task_type or ""))
    out = canonical(df, *keep, dataset=F.lit(dataset), **made).filter("instruction <> '' AND output <> ''")
    return valid(out) if only_valid else out


def parse_lines(df: DataFrame, line: str = "raw_line") -> DataFrame:
    """``df`` with a struct ``raw`` of the raw fields as texts, for lines that are one JSON object; other lines drop out.

    Null, blank, cut-off and non-object lines drop out. Numbers and nested values become their JSON text.
    """
    shape = T.StructType([T.StructField(n, T.StringType()) for n in RAW_FIELDS])
    ok = F.schema_of_variant(F.try_parse_json(F.col(line))).startswith("OBJECT")
    return df.filter(F.col(line).isNotNull() & ok).withColumn("raw", F.from_json(F.col(line), shape))


def adapt_mixed(df: DataFrame, registry: DataFrame, keep: tuple[str, ...] = (), line: str = "raw_line", dataset: str = "dataset") -> DataFrame:
    """Canonical rows of raw lines of many datasets at once, each by the adapter its registry entry names.

    The registry is a catalog of datasets, joined by name; lines of unregistered datasets take the generic adapter.
    """
    entries = registry.select(F.col("name").alias(dataset), F.col("adapter").alias("_adapter"), F.col("license").alias("_license"), F.col("task_type").alias("_task")).dropDuplicates([dataset])
    rows = parse_lines(df, line).join(entries, dataset, "left")
    f, license, task = Fields(rows, "raw."), F.coalesce(F.col("_license"), F.lit(UNKNOWN)), F.coalesce(F.col("_task"), F.lit(""))
    made = {name: own(f, license, task) for name, own in ADAPTERS.items()}
    named = [n for n in ADAPTERS if n != "generic"]
    columns = {}
    for c in dict.fromkeys(c for m in made.values() for c in m):
        value = made["generic"].get(c, F.lit(UNKNOWN if c == "language" else ""))
        for n in named:
            value = F.when(F.col("_adapter") == n, made[n].get(c, F.lit(UNKNOWN if c == "language" else ""))).otherwise(value)
        columns[c] = value
    return canonical(rows, *keep, dataset=F.col(dataset), **columns).filter("instruction <> '' AND output <> ''")
