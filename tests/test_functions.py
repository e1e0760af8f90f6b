import math

import pytest
from pyspark.sql import functions as F

from sedimenta.functions import metrics as M
from sedimenta.functions import quality as Q
from sedimenta.functions import text as X
from sedimenta.functions.detect import detect_language
from sedimenta.schema import CANONICAL, canonical, decode_metadata, encode_metadata, errors, from_storage, make_id, valid


def values(spark, column, *rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema).coalesce(1).select(column).collect()]


def test_strip_equals_python(spark):
    texts = [None, "", " a ", "\t\r\n\x0b\x0c\x1c\x1d\x1e\x1f a b\x85\xa0", "    x ", "   y  ", "a" * 50_000]
    assert values(spark, X.strip(F.col("x")), *texts) == [None if t is None else t.strip() for t in texts]


def test_lines_equal_python(spark):
    text = "a\n\n b\r\nc\rd\x0be\x0cf\x1cg\x1dh\x1ei\x85j k l\n"
    assert values(spark, X.lines(F.col("x")), text)[0] == [x.strip() for x in text.splitlines() if x.strip()]


def test_first_truthy_and_first_filled(spark):
    rows = [("  ", "b"), ("", "b"), (None, "b"), (None, None), (" a ", "b")]
    schema = "x string, y string"
    assert values(spark, X.first_truthy(F.col("x"), F.col("y")), *rows, schema=schema) == ["", "b", "b", "", "a"]
    assert values(spark, X.first_filled(F.col("x"), F.col("y")), *rows, schema=schema) == ["b", "b", "b", "", "a"]


def test_clean(spark):
    assert values(spark, X.clean(F.col("x")), "<b>a</b> \t b\n\n\n\nc <stdio.h>\n", None, "") == ["a b\n\nc", None, ""]
    assert values(spark, X.clean(F.col("x"), html=False), "<b>") == ["<b>"]


def test_blocked(spark):
    assert values(spark, X.blocked(F.col("x"), ("SECRET",), (r"\bto\w+",)), "a secret", "Token", "stop", None) == [True, True, False, False]


def test_unix_lines(spark):
    assert values(spark, X.unix_lines(F.col("x")), "a\r\nb\rc\n") == ["a\nb\nc\n"]


def brute_quality(text, language):
    n = len(text) / 4
    low, high = 10 + 0.1 * 8182, 10 + 0.9 * 8182
    token = 0.0 if not text or n < 10 or n > 8192 else (n - 10) / (low - 10) if n <= low else (8192 - n) / (8192 - high) if n >= high else 1.0
    good = sum(c.isalnum() or c in " \t\n\r_.,()[]{}:;\"'=-+*/\\|<>!@#$%^&~`" for c in text) / len(text) if text else 0.0
    lines = [x.strip() for x in text.splitlines() if x.strip()]
    share = sum(x.startswith(("#", "//", "--", ";", "%", "/*", "*", '"""', "'''")) for x in lines) / len(lines) if lines else None
    comment = 0.0 if share is None else max(0.0, 1 - (share - 0.8) / (1 - 0.8)) if share > 0.8 else 1.0
    return token, good / 0.25 if good < 0.25 else 1.0 if text else 0.0, comment


def test_scores_against_brute_force(spark):
    texts = ["", "x" * 39, "x" * 40, "x" * 2000, "y" * 3313, "z" * 20_000, "x" * 32_768, "x" * 32_769, "???" * 20, "é" * 50, "# a\n" * 9 + "b", "# a\n" * 4 + "b", "// only\n-- c", "\n \n"]
    df = spark.createDataFrame([(t,) for t in texts], "x string").coalesce(1)
    c = F.col("x")
    for t, r in zip(texts, df.select(Q.token_score(c), Q.alpha_score(c), Q.comment_score(c)).collect()):
        assert list(r) == pytest.approx(brute_quality(t, ""), abs=1e-9), t[:20]
    assert list(spark.createDataFrame([(None,)], "x string").select(Q.token_score(c), Q.alpha_score(c), Q.comment_score(c), Q.autogen_score(c)).first()) == [0.0, 0.0, 0.0, 1.0]


def test_autogen_looks_at_the_first_2000_characters(spark):
    c = Q.autogen_score(F.col("x"))
    assert values(spark, c, "# Auto-Generated", " " * 1984 + "@generated", " " * 1999 + "@generated", "do  NOT edit", "fine") == [0.0, 0.0, 1.0, 0.0, 1.0]
    assert values(spark, Q.autogen_score(F.col("x"), ()), "@generated") == [1.0]


def test_settings_without_patterns_switch_autogen_off():
    assert Q.QualityConfig.from_settings({"min_score": 0.5, "other": 1}) == Q.QualityConfig(min_score=0.5, autogen_patterns=())


def test_language_score(spark):
    assert values(spark, Q.language_score(F.col("x")), " Python ", "klingon", None) == [1.0, 0.5, 0.5]


def test_metrics(spark):
    assert values(spark, M.exact_match(F.col("x"), F.col("y")), (" a", "a "), ("a", "b"), (None, "a"), schema="x string, y string") == [1.0, 0.0, None]
    assert values(spark, M.contains_code_block(F.col("x")), "```py\nx\n```", "```\n\n```", "```py```", None) == [True, True, False, False]


def test_pass_at_k_equals_the_closed_form(spark):
    rows = [(10, 10, 1), (10, 0, 1), (10, 5, 1), (10, 3, 2), (5, 4, 3), (100, 7, 10)]
    want = [1.0 if n - c < k else 1 - math.comb(n - c, k) / math.comb(n, k) for n, c, k in rows]
    assert values(spark, M.pass_at_k(F.col("n"), F.col("c"), F.col("k")), *rows, schema="n int, c int, k int") == pytest.approx(want)


def test_evaluate(spark):
    p = spark.createDataFrame([(0, "hello"), (1, "world"), (2, "more")], "position int, text string")
    r = spark.createDataFrame([(0, "hello"), (1, "earth")], "position int, text string")
    assert M.evaluate(p, r).collect() == [(0.5, 2)]
    assert M.evaluate(p.limit(0), r).collect() == [(0.0, 0)]


def test_detect_language(spark):
    texts = ["def f():\n  import x", "const a = () => 1", "SELECT a FROM b WHERE c", "fn main() { let mut x }", "#!/bin/sh\necho ${a}", "nothing", None, "édef", "let"]
    assert values(spark, detect_language(F.col("x")), *texts) == ["Python", "JavaScript", "SQL", "Rust", "Shell/Bash", "Unknown", "Unknown", "Unknown", "JavaScript"]


def row(**x):
    base = {"id": "i", "schema_version": "1.0", "dataset": "d", "task_type": "qa", "language": "go", "repository": "", "license": "MIT", "instruction": "ask", "input": "", "output": "answer", "quality_score": 0.5, "metadata": "{}"}
    return tuple((base | x)[f.name] for f in CANONICAL.fields)


def test_errors(spark):
    bad = row(id="", schema_version="2", task_type="x", instruction=" ", output=None, quality_score=1.5)
    df = spark.createDataFrame([row(), bad, row(quality_score=float("nan")), row(quality_score=None)], CANONICAL).coalesce(1)
    assert [len(r[0]) for r in df.select(errors(df)).collect()] == [0, 6, 1, 1]
    assert valid(df).count() == 1


def test_ids_and_defaults(spark):
    import hashlib

    df = canonical(spark.createDataFrame([("a", "b")], "i string, o string"), dataset=F.lit("d"), instruction=F.col("i"), output=F.col("o"))
    r = df.first()
    assert r["id"] == hashlib.sha256(b"a\x00b").hexdigest() and r["language"] == "unknown" and r["quality_score"] == 0.0
    assert values(spark, make_id(F.col("x"), F.col("x")), None) == [hashlib.sha256(b"\x00").hexdigest()]


def test_from_storage_fills_what_is_missing(spark):
    r = from_storage(spark.createDataFrame([("a", 0.5, 1)], "instruction string, quality_score float, extra int")).first()
    assert (r["instruction"], r["output"], r["quality_score"], r["schema_version"], r["metadata"]) == ("a", "", 0.5, "1.0", "{}")


def test_metadata_round_trip(spark):
    assert values(spark, decode_metadata(F.col("x")), '{"a": 1, "b": "x"}', "[1]", "{broken", None, "") == [{"a": "1", "b": "x"}, {}, {}, {}, {}]
    assert values(spark, encode_metadata(F.create_map(F.lit("a"), F.col("x"))), "1") == ['{"a":"1"}']
