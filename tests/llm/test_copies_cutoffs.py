import random
import re

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sedimenta.llm import copies, cutoffs
from sedimenta.llm.graph import components

ROWS = [
    (1, "Write A!", "def f(): pass"),
    (2, "write a", "DEF F  ( ): pass\n"),
    (3, "- Task: x\n- Limit: 5", '{"a": 1, "b": {"c": [1, 2], "d": null}}'),
    (4, "Limit: 5\nTask: x", '{"b": {"d": null, "c": [1, 2]}, "a": 1}'),
    (5, "Limit: 5\nTask: x", '{"b": {"d": null, "c": [2, 1]}, "a": 1}'),
    (6, "limit 5 task x", '{"b":{"d":null,"c":[2,1]},"a":1}'),  # not in lines: equal to row 5 by its letters alone
    (7, None, "x"),
    (8, "x", None),
    (9, "!!", "x"),
    (10, "x", "```\n```"),
    (11, "Straße", "ß" * 60_000),
    (12, "STRASSE", "SS" * 60_000),
    (13, "first second", "x"),
    (14, "second first", "x"),
    (15, "Write A!", "def f(): pass"),
    (16, "éa", "y"),
    (17, "Éa", "Y"),
]
SCHEMA = "ordinal long, instruction string, output string"


def pairs(df):
    return sorted(tuple(r) for r in df.collect())


def test_found(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert pairs(copies.found(df)) == [(1, 2), (1, 15), (3, 4), (5, 6), (11, 12), (16, 17)]


def test_order_free_forms_reach_through_plain_ones(spark):
    rows = [(1, "b: 2\na: 1", "x"), (2, "a: 1\nb: 2", "x"), (3, "b 2 a 1", "x"), (4, "a 1 b 2", "x")]
    assert pairs(copies.found(spark.createDataFrame(rows, SCHEMA))) == [(1, 2), (1, 3), (1, 4)]


def test_forms_linked_by_several_line_splits(spark):
    rows = [(1, "a: b\nc: def", "x"), (2, "a: bcd\ne: f", "x"), (3, "e: f\na: bcd", "x"), (4, "c: def\na: b", "x")]
    assert pairs(copies.found(spark.createDataFrame(rows, SCHEMA))) == [(1, 2), (1, 3), (1, 4)]


def brute_pairs(rows):
    """Groups by repeated merging of all rows that share a form of both columns."""
    forms = lambda x, free: {re.sub(r"[\W_]+", "", x.lower())} | ({free(x)} if free(x) else set())
    lines = lambda x: "|".join(sorted(re.sub(r"[\W_]+", "", y.lower()) for y in x.split("\n"))) if x.count("\n") and all(re.match(r"\w+: \S", y) for y in x.split("\n")) else None
    group = {o: o for o, _, _ in rows}
    for _ in rows:
        for o, i, _ in rows:
            for p, j, _ in rows:
                if forms(i, lines) & forms(j, lines):
                    group[o] = group[p] = min(group[o], group[p])
    return sorted((g, o) for o, g in group.items() if g != o)


def test_forms_equal_brute_force(spark):
    r = random.Random(3)
    rows = []
    for i in range(60):
        letters = r.choice(["abcdef", "abcdfe", "efabcd", "defabc"])
        cuts = sorted(r.sample(range(1, 6), 3))
        a, b, c, d = (letters[x:y] for x, y in zip([0, *cuts], [*cuts, 6]))
        rows.append((i, f"{a}: {b}\n{c}: {d}" if r.random() < 0.8 else letters, "x"))
    assert pairs(copies.found(spark.createDataFrame(rows, SCHEMA))) == brute_pairs(rows)


def test_components_of_a_path_a_star_and_a_ring(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 140)]
    ring = [(200 + i, 200 + (i + 1) % 7) for i in range(7)]
    random.Random(1).shuffle(path)
    got = dict((v, u) for u, v in (tuple(x) for x in components(spark.createDataFrame(path + star + ring + [(300, 300)], "u long, v long")).collect()))
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 140)}, **{i: 200 for i in range(201, 207)}}


def test_collapse_counts_copies(spark):
    got = dict(pairs(copies.collapse(spark.createDataFrame(ROWS, SCHEMA))))
    assert got[1] == 3 and got[3] == 2 and sum(got.values()) == 13


def test_clashing_columns_and_empty_tables(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).withColumns({c: F.lit("x") for c in ("field", "value", "digest", "kept_ordinal", "i", "o", "n")})
    assert len(pairs(copies.found(df))) == 6
    assert pairs(copies.found(df.limit(0))) == [] and pairs(copies.collapse(df.limit(0))) == []


def test_a_third_of_all_rows_in_one_group(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"i{i}", "same" if i % 3 == 0 else f"o{i}") for i in range(900)]
    assert pairs(copies.found(spark.createDataFrame(rows, SCHEMA))) == [(0, i) for i in range(3, 900, 3)]


def test_json_forms():
    assert copies.json_form('{"A": "x", "b": true}') == copies.json_form('{"b":TRUE_,"a":"X"}'.replace("TRUE_", "true"))
    assert copies.json_form("[1]") is None and copies.json_form('{"a"') is None and copies.json_form(None) is None
    assert copies.json_form("[" * 100_000) is None
    assert copies.json_form('{"a": 1, "a": 2}') != copies.json_form('{"a": 2}')


def brute_cutoff(scores, fraction, n):
    goal, best = fraction * n, (fraction * n, 0, None)
    for s in sorted({x for x in scores if x is not None and x == x}):
        kept = sum(x is not None and x == x and x >= s for x in scores)
        best = min(best, (abs(kept - goal), kept, s), key=lambda b: b[:2])
    return best[2], best[1]


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_cutoffs_equal_brute_force(spark, partitions):
    r = random.Random(partitions)
    rows = [(r.choice(["a", "A ", "b", "tied", None, " "]), r.choice([None, float("nan"), -1.0, 2.0, 0.0, -0.0] + [round(r.random(), 2) for _ in range(20)])) for _ in range(600)]
    rows = [(d, 0.5 if d == "tied" else s) for d, s in rows]
    goals = [("a", 0.3), ("b", 0.75), ("tied", 0.4), ("ghost", 0.5), ("unknown", 1.0), ("b", 0.1), (" B", 0.75)]
    df = spark.createDataFrame([(*x, 1) for x in rows], "dataset string, quality_score double, part int")
    got = {x["dataset"]: x for x in cutoffs.cutoffs(df, spark.createDataFrame(goals, "dataset string, target_fraction double"), partitions=partitions).collect()}
    tidy = lambda d: (d or "").strip().lower() or "unknown"
    for name, fraction in (("a", 0.3), ("b", 0.75), ("tied", 0.4), ("unknown", 1.0)):
        scores = [s for d, s in rows if tidy(d) == name]
        assert (got[name]["cutoff"], got[name]["n_kept"]) == brute_cutoff(scores, fraction, len(scores)), name
        assert got[name]["n_rows"] == len(scores)
    assert (got["ghost"]["n_rows"], got["ghost"]["cutoff"], got["ghost"]["n_kept"]) == (0, None, 0)


def test_kept_rows_are_those_the_cutoffs_count(spark):
    rows = [(i, d, s) for i, (d, s) in enumerate([("a", 1.0), ("A", 2.0), ("a", 3.0), ("a", None), ("b", 1.0), (None, 0.5), ("b", float("nan"))])]
    df = spark.createDataFrame([(*x, "z") for x in rows] + [(None, "a", 3.0, "z")], "ordinal long, dataset string, quality_score double, cutoff string")
    goals = spark.createDataFrame([("a", 0.5), ("b", 0.9), ("ghost", 0.1)], "dataset string, target_fraction double")
    got = sorted(((r["ordinal"], r["dataset"], r["kept"]) for r in cutoffs.kept(df, goals).collect()), key=str)
    assert got == sorted([(0, "a", False), (1, "a", False), (2, "a", True), (3, "a", False), (4, "b", True), (5, "unknown", None), (6, "b", False), (None, "a", True)], key=str)
    assert cutoffs.kept(df.limit(0), goals).collect() == []
    assert {r["kept"] for r in cutoffs.kept(df, goals.limit(0)).collect()} == {None}
    counts = {r["dataset"]: r["n_kept"] for r in cutoffs.cutoffs(df, goals).collect()}
    assert counts == {"a": 2, "b": 1, "ghost": 0, "unknown": None}


def test_cutoffs_without_rows_targets_or_scores(spark):
    rows, goals = spark.createDataFrame([("a", None), ("a", float("nan"))], "dataset string, quality_score double"), spark.createDataFrame([("a", 0.5)], "dataset string, target_fraction double")
    r = cutoffs.cutoffs(rows, goals).first()
    assert (r["n_rows"], r["cutoff"], r["n_kept"]) == (2, None, 0)
    assert cutoffs.cutoffs(rows.limit(0), goals).first()["n_rows"] == 0
    assert cutoffs.cutoffs(rows, goals.limit(0)).first()["n_kept"] is None


def test_cutoffs_equal_sql(spark, data):
    con = duckdb.connect()
    for t in ("canonical_examples", "keep_targets"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    want = con.execute(cutoffs.SQL).df().sort_values("dataset").reset_index(drop=True)
    got = cutoffs.cutoffs(spark.read.parquet(f"{data}/canonical_examples.parquet"), spark.read.parquet(f"{data}/keep_targets.parquet")).toPandas().sort_values("dataset").reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want[got.columns], check_dtype=False)
