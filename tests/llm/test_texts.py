import os
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sedimenta.llm import defects, languages, leaks, reading, seeds

sys.path.insert(0, os.path.dirname(__file__))
import held_out  # noqa: E402

ITEM = "Array bozako stores 639 readings of gauge napupe and one counts as steady when its next 523 differ by less than zudazu in total"
WORDS = ITEM.split()


def leak_tables(spark):
    docs = [
        (1, "before " + ITEM.upper() + " after"),
        (2, "x y z " + ", ".join(WORDS[3:15]) + "! other words here"),  # 12 words in a row
        (3, "x y z " + " ".join(WORDS[3:14]) + " other words here"),  # 11
        (4, " ".join(WORDS[:6]) + " broken " + " ".join(WORDS[6:12])),
        (5, None),
        (6, ""),
        (7, ("filler text without any meaning " * 400) + ITEM + (" more filler" * 300)),
        (8, " ".join(WORDS[:12])),
        (8, ITEM),
        (None, ITEM),
    ]
    items = [(10, ITEM, "zudazu"), (11, "too short", None), (12, None, None), (13, " ".join(WORDS[2:]) + " and a second sentence of its own", "")]
    return spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, key string"), spark.createDataFrame(items, "item_id long, text string, reference_answer string")


def brute_leaks(docs, items):
    runs = lambda x: {tuple(w[i : i + 12]) for w in [leaks.split_words(x or "")] for i in range(len(w) - 11)}
    return {(d["doc_id"], i["item_id"]) for d in docs.collect() for i in items.collect() if d["doc_id"] is not None and runs(d["text"]) & runs(i["text"])}


def test_leaks_equal_brute_force(spark):
    docs, items = leak_tables(spark)
    got = [tuple(r) for r in leaks.found(docs, items).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_leaks(docs, items) and (2, 10) in got and (3, 10) not in got


def test_blocks_of_items_change_nothing(spark):
    docs, items = leak_tables(spark)
    tables = [sorted(map(tuple, leaks.leaks(docs, items, block_words=n).collect()), key=str) for n in (10_000, 20)]
    assert tables[0] == tables[1] != []
    assert {tuple(r) for r in leaks.found(docs, items, block_words=20).collect()} == brute_leaks(docs, items)


def test_exact_runs_and_all_pairs_equal_brute_force(spark):
    docs, items = leak_tables(spark)
    assert {tuple(r) for r in leaks.exact_runs(docs, items).collect()} == brute_leaks(docs, items)
    assert {tuple(r) for r in leaks.found(docs, items, least=-1.0).collect()} == brute_leaks(docs, items)


def test_more_words_than_a_task_may_hold_are_refused(spark, monkeypatch):
    monkeypatch.setattr(leaks, "MAX_VOCABULARY", 5)
    with pytest.raises(ValueError, match="distinct words"):
        leaks.found(*leak_tables(spark))


def test_recall_of_reworded_items(spark, data):
    """Every tenth word replaced, so that no run of 12 is left: nearly all such copies must be found."""
    items = spark.read.parquet(f"{data}/benchmark.parquet").orderBy("item_id").limit(60)
    rows = [(r["item_id"], leaks.split_words(r["text"] or "")) for r in items.collect()]
    rows = [(i, w) for i, w in rows if len(w) >= 20]
    docs = spark.createDataFrame([(i, " ".join(x if j % 10 != 4 else "moreover" for j, x in enumerate(w))) for i, w in rows], "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in leaks.leaks(docs, items).collect()}
    assert len({(i, i) for i, _ in rows} & got) >= 0.9 * len(rows)


def test_leaks_of_the_test_tables(spark, data):
    docs, items = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "benchmark"))
    assert {tuple(r) for r in leaks.found(docs, items).collect()} == brute_leaks(docs, items)


def test_paraphrases_and_answers(spark):
    docs, items = leak_tables(spark)
    swapped = " ".join(w if i % 8 else "moreover" for i, w in enumerate(WORDS, 1))
    more = spark.createDataFrame([(20, swapped, "")], "doc_id long, text string, key string")
    got = {(r["doc_id"], r["item_id"]): (r["kind"], r["answer_found"]) for r in leaks.leaks(docs.unionByName(more), items).collect()}
    assert got[1, 10] == ("verbatim", True) and got[20, 10][0] == "paraphrase" and got[1, 13][1] is None


def test_paraphrases_of_few_known_words(spark):
    words = [f"bolu{i}" for i in range(12)]
    items = spark.createDataFrame([(1, " ".join(words), None)], "item_id long, text string, reference_answer string")
    swapped = [w if i not in (3, 7) else f"new{i}" for i, w in enumerate(words)]
    docs = [(1, " ".join(swapped)), (2, " ".join(words[:10])), (3, " ".join(["other"] * 30 + swapped + ["other"] * 30)), (4, " ".join(words[:8])), (5, "other words")]
    got = {(r["doc_id"], r["item_id"]): r["kind"] for r in leaks.leaks(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()}
    assert got == {(i, 1): "paraphrase" for i in (1, 2, 3)}


def test_leaks_of_nothing(spark):
    docs, items = leak_tables(spark)
    assert leaks.found(docs.limit(0), items).collect() == [] and leaks.found(docs, items.limit(0)).collect() == []
    assert leaks.leaks(docs.limit(0), items).collect() == []


def test_vectors_are_those_of_dense_matrices():
    rng = np.random.default_rng(2)
    found = [rng.integers(-1, 9, size=n) for n in (24, 1, 0, 13, 24)] + [np.array([-1, -1])]
    idf = rng.random(9).astype(np.float32) + 0.1
    dense = np.zeros((len(found), 9))
    for i, p in enumerate(found):
        for c in p[p >= 0]:
            dense[i, c] += idf[c]
    dense /= np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-12)
    a, m, y, total = leaks.Sparse(found, idf), rng.random((9, 4)), rng.random((len(found), 3)), np.zeros((9, 3))
    a.add_transposed(y, total)
    assert np.allclose(a.times(m), dense @ m, atol=1e-5) and np.allclose(total, dense.T @ y, atol=1e-5)
    assert leaks.Sparse([], idf).times(m).shape == (0, 4)
    assert leaks.common_subsequence(np.array([0, 1, 2]), np.array([0, -1, 2, 1]), np.array([1.0, 2.0, 4.0])) == 5.0


EASY = "The cat sat on the mat. The dog ran to the shop. A man took the box. "
HARD = "Notwithstanding considerable heterogeneity, the probabilistic regularization necessitates commensurate serialization, whereas the idempotency, which circumscribes transactional deduplication, corroborates interoperability. "


def reading_tables(spark):
    docs = []
    for i in range(60):
        share = (i % 5) / 4
        text = EASY * max(0, round(4 * (1 - share))) + HARD * round(4 * share)
        docs.append((i, f"note {i} " + text, "en"))
    docs += [(100, None, "en"), (101, " \n", None), (102, "```\ncode only\n```", "de"), (103, HARD * 3, " DE-x"), (104, "12 34", "en"), (105, EASY * 2000, "und")]
    labels = [(i, f"r{j}", 1 + i % 5) for i in range(60) for j in range(1 + (i % 7 == 0))] + [(999, "r", 3), (1, "r", 9), (None, "r", 2)]
    return spark.createDataFrame([(*d, "s", "dom") for d in docs], "doc_id long, text string, lang string, source string, doc_domain string"), spark.createDataFrame(labels, "doc_id long, rater string, reading_level int")


def test_levels_follow_the_ratings(spark):
    docs, labels = reading_tables(spark)
    got = {r["doc_id"]: (r["reading_score"], r["reading_level"]) for r in reading.levels(docs, labels).collect()}
    assert len(got) == docs.count() and all(got[k] == (None, None) for k in (100, 101, 102, 104))
    assert np.mean([abs(got[i][1] - (1 + i % 5)) for i in range(60)]) < 0.3
    r = reading.accuracy(docs, labels).first()
    assert r["n_ratings"] == 69 and r["mean_error"] < 0.4 < r["baseline_error"]


def test_levels_are_the_same_in_any_partitioning(spark):
    docs, labels = reading_tables(spark)
    a = {r[0]: r[1] for r in reading.levels(docs, labels).collect()}
    b = {r[0]: r[1] for r in reading.levels(docs.repartition(5), labels.repartition(2)).collect()}
    assert all(a[k] == b[k] if a[k] is None else abs(a[k] - b[k]) < 0.001 for k in a)


def test_levels_without_ratings_or_documents(spark):
    docs, labels = reading_tables(spark)
    scores = {r["reading_score"] for r in reading.levels(docs, labels.limit(0)).collect()}
    assert len(scores - {None}) == 1
    assert reading.levels(docs.limit(0), labels).collect() == []
    assert reading.accuracy(docs, labels.limit(0)).first()["n_ratings"] == 0


def test_accuracy_scores_every_rating_beyond_the_fitting_sample(spark):
    docs, labels = reading_tables(spark)
    whole = reading.accuracy(docs, labels).first()
    for most in (40, 1):  # with 1 the sample is thinned to every 8th hash
        r = reading.accuracy(docs, labels, max_ratings=most).first()
        assert r["n_ratings"] == whole["n_ratings"] == 69
        assert 0 <= r["exact_share"] <= r["within_one_share"] <= 1
    r = reading.accuracy(docs, labels, max_ratings=40).first()
    assert r["mean_error"] < 0.6 < r["baseline_error"]


def test_profile(spark):
    docs, labels = reading_tables(spark)
    assert sum(r["n_docs"] for r in reading.profile(reading.levels(docs, labels), docs).collect()) == docs.count()


def test_ordinal_regression_recovers_an_order():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 3))
    z = 2 * x[:, 0] - x[:, 1] + rng.logistic(size=600) * 0.3
    y = 1 + np.digitize(z, [-2, -0.7, 0.7, 2])
    m = reading.Ordinal().fit(x, y)
    assert np.mean(np.abs(np.round(m.expected(x)) - y)) < 0.3 and (np.diff(m.cuts) > 0).all()


QUESTION = "Why does the buffer change after a call to `load_x`?"
ANSWER = "The function `load_x` reads the file first. After that, the buffer is updated on every pass."
GERMAN = "Die Funktion `load_x` liest zuerst die Datei. Danach wird der Puffer in jedem Durchgang aktualisiert."
CODE = "def f(rows):\n    out = []\n    for r in rows:\n        out.append(r)\n    return out\n"
CASES = [
    (QUESTION, ANSWER, None),
    (QUESTION, None, "empty"),
    (QUESTION, " \n", "empty"),
    (QUESTION, "```python\n```", "empty"),
    (QUESTION, "## Answer", "empty"),
    (QUESTION, "[no response]", "empty"),
    (QUESTION, "I'm sorry, but I cannot help with that request. Let me know if you have another question.", "refusal"),
    (QUESTION, QUESTION, "copies_question"),
    (QUESTION, "**Question:** why does the buffer change after a call to load_x", "copies_question"),
    (QUESTION, QUESTION + "\n\n" + ANSWER, None),
    (QUESTION, GERMAN, "other_language"),
    (QUESTION + " Answer in German, please.", GERMAN, None),
    (QUESTION, ANSWER[:-20], "truncated"),
    ("Complete the following python code:", CODE, None),
    ("Complete the following python code:", "```python\n" + CODE[:40], "truncated"),
    ("Give a JSON object.", '{"a": [1, 2], "b": {"c": null}}', None),
    ("Give a JSON object.", '{"a": [1, 2], "b": {"c"', "truncated"),
]


@pytest.fixture(scope="module")
def field():
    """Trained on the smaller of the test tables, as the operator does."""
    if not os.path.exists("/root/testdata/sf0.01"):
        pytest.skip("no test data here")
    rows = pd.read_parquet("/root/testdata/sf0.01/canonical_examples.parquet", columns=["instruction", "output"]).dropna().drop_duplicates()
    rows = rows[(rows.instruction.str.strip() != "") & rows.output.str.len().between(1, defects.MAX_TRAINING_CHARS)].sample(defects.MAX_TRAINING, random_state=1)
    return defects.fit(list(zip(rows.instruction, rows.output)))


def test_defects_of_a_table(spark, field):
    rows = [(i, q, o) for i, (q, o, _) in enumerate(CASES)] + [(90, None, None), (91, " \t", None), (92, QUESTION, None), (92, QUESTION, None), (93, QUESTION, (ANSWER + " ") * 3000), (94, None, "x")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "ordinal long, instruction string, output string, defect string")
    got = sorted(tuple(r) for r in defects.found(df, field=field).collect())
    assert got == sorted([(i, w) for i, (_, _, w) in enumerate(CASES) if w] + [(92, "empty")] * 2)
    assert defects.found(df.limit(0)).collect() == []


@pytest.mark.parametrize("kind", ["empty", "truncated", "refusal", "copies_question", "other_language", None])
def test_precision_and_recall_on_pairs_written_by_hand(field, kind):
    got = defects.defects([(q, a) for q, a, _ in held_out.CASES], field)
    both = sum(w == g == kind for (_, _, w), g in zip(held_out.CASES, got))
    assert both >= 0.9 * sum(w == kind for _, _, w in held_out.CASES), "recall"
    assert both >= 0.9 * sum(g == kind for g in got), "precision"


def test_no_pair_written_by_hand_is_trained_on():
    trained = {a for _, a in seeds.SOUND} | {*seeds.NOTES} | {b for r in seeds.REFUSALS.values() for b in r[1]} | {" ".join(x) for r in seeds.REFUSALS.values() for x in ((o, b) for o in r[0] for b in r[1])}
    assert not trained & {a for _, a, w in held_out.CASES if w in (None, "refusal", "truncated")}


def test_the_field_learns_from_damage_alone():
    """Tags of a chain: the second feature counts only after the first tag, which only the transitions can tell."""
    sequences = [([["bias", "a"], ["bias", "b"]], [[], []], [defects.E, defects.A]), ([["bias", "c"], ["bias", "b"]], [[], []], [defects.R, defects.R])] * 20
    f = defects.Field.train(sequences, {})
    assert f.tag([(x[0], x[1]) for x in sequences[:2]]) == [[defects.E, defects.A], [defects.R, defects.R]]
    assert defects.Field.train([], {}).tag([([["bias"]], [[]])]) != [] and f.tag([]) == []


def test_clauses_and_languages():
    assert [k for k, _ in defects.clauses("One. Two!\n- three\n```py\nx = 1\n```\nfour")] == ["prose", "prose", "item", "code", "prose"]
    assert [k for k, _ in defects.clauses("a\n```py\nx")] == ["prose", "open"] and defects.clauses("") == [("blank", "")]
    p = languages.Profiles()
    for name, text in (("de", "Der Hund schläft heute im Garten"), ("pl", "Pies śpi dzisiaj w ogrodzie"), ("ja", "犬は庭で寝ています"), ("ru", "Собака сегодня спит в саду")):
        assert languages.LANGUAGES[int(p.sum(defects.words_of(text)).argmax())] == name


def test_field_is_trained_on_distinct_pairs(spark, monkeypatch):
    pairs = spark.range(30).select(F.concat(F.lit("Question "), "id").alias("instruction"), F.concat(F.lit("The answer to this one is "), "id").alias("output"))
    first = pairs.orderBy(F.xxhash64("instruction", "output")).limit(1)
    seen = []
    monkeypatch.setattr(defects, "fit", lambda rows: seen.extend(rows))
    defects.trained(pairs.unionByName(first.crossJoin(spark.range(100)).drop("id")), most=20)
    assert len(seen) == len(set(seen)) == 20
