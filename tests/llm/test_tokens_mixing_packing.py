import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sedimenta.llm import budget, encode, mixing, packing, tokens

ODD = [None, "", " ", "\n\n  x", "it's we'll 'SS", "<|endoftext|>", "naïve café 数据清洗 のнет", "👩‍💻👍🏽 ﬁ №", "a" * 20_000, "12345 67", "tab\t\ttab  x", "x​y", "same", "same", "é é", "\x00\x07ctl", "سلام  ", "“q” — …"]


@pytest.fixture(scope="module")
def enc():
    return tokens.encoding()


def test_ids_equal_the_tokenizer_and_decode_back(spark, enc):
    rows = [(i, x) for i, x in enumerate(ODD)] + [(1, "again"), (None, "no key")]
    df = spark.createDataFrame([(*r, "w") for r in rows], "doc_id long, text string, words string").repartition(3)
    got = Counter((r["doc_id"], tuple(r["ids"])) for r in encode.encoded(df, block_words=7).collect())
    assert got == Counter((k, tuple(enc.encode_ordinary(x) if x else ())) for k, x in rows)
    unique = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    back = {r["doc_id"]: r["text"] for r in encode.decoded(encode.encoded(unique)).collect()}
    assert back == {i: x or "" for i, x in enumerate(ODD)}


def test_ids_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert encode.encoded(df).collect() == [] and encode.decoded(encode.encoded(df)).collect() == []
    one = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted((r[0], list(r[1])) for r in encode.encoded(one).collect()) == [(1, []), (2, [])]
    ids = spark.createDataFrame([(1, [2_000_000]), (2, None)], "doc_id long, ids array<int>")
    assert {r[0]: r[1] for r in encode.decoded(ids).collect()} == {1: "", 2: ""}


def test_ids_of_the_test_documents(spark, data, enc):
    df = spark.read.parquet(f"{data}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}
    got = {r["doc_id"]: list(r["ids"]) for r in encode.encoded(df).collect()}
    assert got == {k: enc.encode_ordinary(x) if x else [] for k, x in texts.items()}


def corpora(spark):
    e = spark.createDataFrame([(1, "A", "Go", "x y"), (2, " a", "go", "x y"), (3, None, None, None), (4, "b", "go", ""), (1, "A", "Go", "x y")], "ordinal long, dataset string, language string, output string")
    d = spark.createDataFrame([(1, "x y", "en", "s", "d"), (2, None, " ", "S", None)], "doc_id long, text string, lang string, source string, doc_domain string")
    return budget.texts(e, d)


def test_tokens_of_slices_and_rows(spark, enc):
    n = len(enc.encode_ordinary("x y"))
    got = {(r["corpus"], r["source"], r["language"], r["domain"]): (r["n_rows"], r["n_distinct_texts"], r["n_tokens"], r["n_distinct_tokens"]) for r in budget.slice_tokens(corpora(spark)).collect()}
    assert got == {("examples", "a", "go", "none"): (3, 1, 3 * n, n), ("examples", "unknown", "unknown", "none"): (1, 0, 0, 0), ("examples", "b", "go", "none"): (1, 1, 0, 0), ("documents", "s", "en", "d"): (1, 1, n, n), ("documents", "s", "unknown", "unknown"): (1, 0, 0, 0)}
    rows = sorted((r["corpus"], r["key"], r["n_tokens"]) for r in budget.row_tokens(corpora(spark)).collect())
    assert rows == [("documents", 1, n), ("documents", 2, 0), ("examples", 1, n), ("examples", 1, n), ("examples", 2, n), ("examples", 3, 0), ("examples", 4, 0)]
    assert budget.slice_tokens(corpora(spark).limit(0)).count() == 0


def test_tree_places_every_block_once():
    quotas, shards = [17, 0, 230, 3], 7
    tree = mixing.Tree(quotas, shards, 5)
    placed = [np.bincount(tree.place(s, np.arange(q)), minlength=shards) for s, q in enumerate(quotas)]
    assert sum(placed).max() - sum(placed).min() <= 2 and [p.sum() for p in placed] == quotas
    again = mixing.Tree(quotas, shards, 5)
    assert all((again.place(2, np.array([p])) == tree.place(2, np.arange(230))[p]).all() for p in (0, 100, 229))


def mix_tables(spark, rows):
    df = spark.createDataFrame(rows, "ordinal long, dataset string").withColumns({"mix_id": F.lit(9), "h": F.lit("x"), "part": F.lit(0)})
    configs = spark.createDataFrame([(1, "exact", 50, 1, 3), (2, "oversample", 100, 3, 4), (3, "approximate", None, 1, 5), (4, "exact", 0, 1, 6), (5, "exact", 10, None, None)], "mix_id int, strategy string, total_examples long, max_repeats int, seed int")
    ratios = spark.createDataFrame([(1, "a", 1.0), (1, "b", 1.0), (2, "b", 3.0), (2, "ghost", 1.0), (2, "a", 4.0), (3, "a", 0.5), (3, "b", 0.0), (4, "a", 1.0), (5, "a", None), (5, " B", 2.0)], "mix_id int, dataset string, ratio double")
    return df, configs, ratios


def test_mixes(spark):
    rows = [(i, random.Random(i).choice(["a", "a", " A", "b"])) for i in range(120)] + [(500, None), (501, "z")]
    tables = mix_tables(spark, rows)
    n = Counter((d or "").strip().lower() for _, d in rows)
    got = mixing.mixed(*tables, shard_rows=16).collect()
    count = Counter((r["mix_id"], r["dataset"]) for r in got)
    want = {(1, "a"): min(25, n["a"]), (1, "b"): min(25, n["b"]), (2, "a"): min(50, 3 * n["a"]), (2, "b"): min(38, 3 * n["b"]), (3, "a"): n["a"], (5, "b"): 10}
    assert count == want
    uses = Counter((r["mix_id"], r["ordinal"]) for r in got)
    assert max(v for (m, _), v in uses.items() if m == 2) <= 3 and max(v for (m, _), v in uses.items() if m != 2) == 1
    assert len({(r["mix_id"], r["ordinal"], r["use_no"]) for r in got}) == len(got)
    for m in (1, 2, 3):
        shards = Counter(r["shard"] for r in got if r["mix_id"] == m)
        assert max(shards.values()) <= 17
        assert sorted((r["shard"], r["pos"]) for r in got if r["mix_id"] == m) == [(s, p) for s in sorted(shards) for p in range(shards[s])]
    assert sorted(got) == sorted(mixing.mixed(*mix_tables(spark, rows[::-1]), shard_rows=16).collect())
    shares = {(r["mix_id"], r["dataset"]): r for r in mixing.shares(*tables).collect()}
    assert shares[2, "ghost"]["n_rows"] == 0 and shares[1, "a"]["actual_share"] == pytest.approx(want[1, "a"] / (want[1, "a"] + want[1, "b"])) and shares[5, "a"]["n_rows"] == 0


def test_mixes_of_nothing(spark):
    df, configs, ratios = mix_tables(spark, [])
    assert mixing.mixed(df, configs, ratios).collect() == []
    assert {r["n_rows"] for r in mixing.shares(df, configs, ratios).collect()} == {0}
    assert mixing.mixed(df, configs, ratios.limit(0)).collect() == []


def test_blocks_keep_quotas_exact():
    entries = mixing.plan([{"mix_id": 1, "total_examples": 1_500_000_000, "max_repeats": 1, "seed": 1}], [{"mix_id": 1, "dataset": d, "ratio": 1.0} for d in "ab"], {"a": 10**10, "b": 10**10}, block=3)
    assert [e["quota"] for e in entries] == [750_000_000] * 2 and entries[0]["block"] == 3
    tree = mixing.Tree([e["quota"] for e in entries], 1000, 1, 3)
    assert set(tree.place(0, np.array([0, 749_999_999]))) <= set(range(1000))


def test_packing_keeps_the_rules(spark):
    r = random.Random(1)
    lengths = [(i, r.choice([0, 1, 5, 63, 64, 65, 640, 1000, r.randint(0, 70)])) for i in range(3000)] + [(7, 10), (None, 3)]
    df = spark.createDataFrame(lengths, "ordinal long, n_tokens long")
    got = packing.packed(df, [(1, 64), (2, 512), (3, 0), (None, 5)], open_bins=8, items_per_task=1000).collect()
    assert {x["capacity_id"] for x in got} == {1, 2}
    for key, capacity in ((1, 64), (2, 512)):
        own = [x for x in got if x["capacity_id"] == key]
        fill = Counter()
        pieces: dict = {}
        for x in own:
            fill[x["bin_id"]] += x["piece_tokens"]
            pieces.setdefault(x["ordinal"], []).append(x["piece_tokens"])
        assert max(fill.values()) <= capacity
        for o, n in lengths:
            if o != 7:
                want = [capacity] * (n // capacity) + ([n % capacity] if n % capacity or not n else [])
                assert sorted(pieces[o]) == sorted(want), (o, n)
        assert sum(fill.values()) == sum(n for _, n in lengths)
        assert sum(fill.values()) / (capacity * len(fill)) > 0.85


def test_packer_takes_the_fullest_that_fits_and_closes_the_fullest():
    p = packing.Packer(10, 2)
    assert [p.add(s) for s in (6, 7, 3, 4)] == [0, 1, 1, 0]  # both are full now
    assert [p.add(s) for s in (6, 7, 8, 4)] == [2, 3, 4, 2]  # the third closes container 3, which is the fullest
    assert packing.Packer(10).rest() == {}


def test_packing_nothing_and_items(spark, enc):
    df = spark.createDataFrame([(1, "a b", None), (2, None, None)], "ordinal long, instruction string, output string")
    assert {r[0]: r[1] for r in packing.items(df).collect()} == {1: len(enc.encode_ordinary("a b")), 2: 0}
    none = packing.packed(packing.items(df.limit(0)), [(1, 8)])
    assert none.collect() == []
    caps = spark.createDataFrame([(1, 8)], "capacity_id int, capacity_tokens int")
    assert tuple(packing.fill(none, caps).first()) == (1, 8, 0, 0, 0.0)


def test_large_populations_are_drawn_alike():
    rng = np.random.default_rng(4)
    draws = np.array([mixing.hypergeometric(rng, 3 * 10**11, 7 * 10**11, 10**6) for _ in range(4000)])
    assert abs(draws.mean() - 300_000) < 4 * 458 / 60 and 0.93 < draws.std() / 458.26 < 1.07
    small = np.array([mixing.hypergeometric(rng, 2, 5 * 10**9, 25 * 10**8) for _ in range(4000)])
    assert np.allclose(np.bincount(small, minlength=3) / 4000, [0.25, 0.5, 0.25], atol=0.04)
    assert [mixing.hypergeometric(rng, g, b, n) for g, b, n in ((0, 10**10, 5), (10**10, 0, 5), (10**10, 3, 0), (10**10, 3, 10**10 + 3))] == [0, 5, 0, 10**10]


def test_trees_beyond_a_billion_blocks_keep_quotas():
    quotas = [6 * 10**9, 3 * 10**9, 7]
    tree = mixing.Tree(quotas, 4, 3)
    shards = [tree.place(s, np.array([0, q // 2, q - 1])) for s, q in enumerate(quotas)]
    left = tree.left(0, 4, tree.blocks)
    assert left.sum() == sum(quotas) // 2 and (left <= tree.blocks).all() and all(((0 <= x) & (x < 4)).all() for x in shards)


def test_a_small_quota_of_a_large_source_takes_the_smallest_hashes(spark, monkeypatch):
    df = spark.range(20_000).select(F.col("id").alias("ordinal"), F.lit("a").alias("dataset"))
    configs = spark.createDataFrame([(1, "m", "exact", 50, 1, 5)], "mix_id int, mix_name string, strategy string, total_examples long, max_repeats int, seed int")
    ratios = spark.createDataFrame([(1, "a", 1.0)], "mix_id int, dataset string, ratio double")
    want = sorted(r["ordinal"] for r in mixing.mixed(df, configs, ratios).collect())
    assert len(want) == 50 == len(set(want)) and mixing.threshold(50, 20_000) < (1 << 63) - 1
    monkeypatch.setattr(mixing, "threshold", lambda q, n: -(1 << 63))  # none below: once more with all rows
    assert sorted(r["ordinal"] for r in mixing.mixed(df, configs, ratios).collect()) == want


def test_an_item_of_the_capacity_closes_no_open_container():
    p = packing.Packer(100, 2)
    assert [p.add(x) for x in (60, 70, 100, 40, 30)] == [0, 1, 2, 0, 1] and p.n_bins == 3
