"""Problem 8: evaluation texts inside training documents.

Passages are windows of words. TF-IDF vectors over the words of the evaluation items are reduced by a distributed
randomised SVD; passages of documents are compared with passages of items by cosine in the reduced space, and the
candidates are checked for a common run of words, and for paraphrases for a long common subsequence and the answer.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.session import materialise

#: Consecutive words that make a leak.
RUN = 12
#: Words in a passage of a document; passages overlap by ``RUN``, so each run lies in one whole.
WINDOW = 2 * RUN
#: Step between the passages of an item.
ITEM_STEP = 4
#: Dimensions kept, and more of them in the random sketch.
RANK, OVERSAMPLE = 96, 16
#: Least cosine of a candidate; low, as an exact check follows.
LEAST_COSINE = 0.3
#: Words of the items searched for at once; bounds what a task holds. The result is the same for any number of blocks.
WORDS_PER_BLOCK = 40_000
#: Most distinct words of all items together: they, and a vector for each, are held by the driver and every task.
MAX_VOCABULARY = 1_000_000
#: A paraphrase has at least this cosine and this share of an item passage's words, weighted by rarity, in order;
#: a smaller share is enough where the item's reference answer stands in the document too.
PARAPHRASE_COSINE, PARAPHRASE_LCS, ANSWERED_LCS = 0.8, 0.75, 0.6

_WORD = re.compile(r"[^\W_]+")


def split_words(text: str) -> list[str]:
    """Runs of letters or digits, letter case folded."""
    return _WORD.findall(text.casefold())


class Block:
    """Some of the evaluation items, as codes of the vocabulary: passages, and the items that hold each run."""

    def __init__(self, rows: list[tuple[int, np.ndarray]]) -> None:
        self.ids, self.passages, owners = [], [], []
        self.by_run: dict[bytes, list[int]] = {}
        for owner, (item_id, codes) in enumerate(rows):
            self.ids.append(item_id)
            for p in item_passages(codes):
                self.passages.append(p)
                owners.append(owner)
            for run in runs(codes):
                self.by_run.setdefault(run, []).append(owner)
        self.owners = np.array(owners, dtype=np.int64)


def item_passages(codes: np.ndarray) -> list[np.ndarray]:
    """Overlapping windows of an item, one every ``ITEM_STEP`` words."""
    return [codes[at : at + WINDOW] for at in range(0, max(1, len(codes) - RUN + 1), ITEM_STEP) if len(codes[at : at + WINDOW])]


def runs(codes: np.ndarray) -> set[bytes]:
    """All runs of ``RUN`` known words, as bytes."""
    raw = codes.astype(np.int32).tobytes()
    known = np.concatenate([[0], np.cumsum(codes >= 0)])
    return {raw[4 * i : 4 * (i + RUN)] for i in range(len(codes) - RUN + 1) if known[i + RUN] - known[i] == RUN}


def common_subsequence(a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> float:
    """Weight of the heaviest common subsequence; words unknown to the items (-1) match nothing."""
    row = np.zeros(len(b) + 1)
    for x in a:
        if x >= 0:
            row[1:] = np.maximum.accumulate(np.where(b == x, row[:-1] + weight[x], row[1:]))
    return float(row[-1])


class Sparse:
    """Unit TF-IDF vectors of passages in rows of (code, value); a passage without known words has no entries."""

    def __init__(self, passages: list[np.ndarray], idf: np.ndarray) -> None:
        self.n = len(passages)
        flat = np.concatenate(passages).astype(np.int64) if self.n else np.zeros(0, np.int64)
        row = np.repeat(np.arange(self.n), [len(p) for p in passages])
        at, count = np.unique(row[flat >= 0] * len(idf) + flat[flat >= 0], return_counts=True)
        self.row, self.code = at // max(1, len(idf)), at % max(1, len(idf))
        value = idf[self.code] * count
        norm = np.sqrt(np.bincount(self.row, value * value, self.n))
        self.value = (value / np.where(norm > 0, norm, 1)[self.row]).astype(np.float32)

    def times(self, m: np.ndarray) -> np.ndarray:
        """The vectors times a matrix with a row per code."""
        out = np.zeros((self.n, m.shape[1]), dtype=np.float32)
        rows, first = np.unique(self.row, return_index=True)
        if len(rows):
            out[rows] = np.add.reduceat(m[self.code] * self.value[:, None], first, axis=0)
        return out

    def add_transposed(self, m: np.ndarray, total: np.ndarray) -> None:
        """Adds the transposed vectors times a matrix with a row per passage to ``total``."""
        order = np.argsort(self.code, kind="stable")
        codes, first = np.unique(self.code[order], return_index=True)
        if len(codes):
            total[codes] += np.add.reduceat(m[self.row[order]] * self.value[order, None], first, axis=0)


def passages(documents: DataFrame, vocabulary: dict[str, int], key: str = "doc_id", text: str = "text", weight: np.ndarray | None = None, least: float = 0.0) -> DataFrame:
    """(key, words) of each window with at least ``RUN`` words of the vocabulary; others share no run with an item.

    A word outside the vocabulary is -1. The windows of a document start every ``RUN`` words and cover it whole. With
    ``weight`` of the words the other windows instead, whose known words weigh ``least`` or more together, and shorter texts.
    """
    shared = documents.sparkSession.sparkContext.broadcast((vocabulary, None if weight is None else np.append(weight, 0).astype(np.float64)))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get, weight = shared.value[0].get, shared.value[1]
        shortest = RUN if weight is None else 1
        for pdf in batches:
            keys, found = [], []
            for k, x in zip(pdf[key], pdf[text]):
                if x is None or len(x) < 2 * shortest - 1:
                    continue
                codes = np.array([get(w, -1) for w in split_words(x)], dtype=np.int32)
                if len(codes) < shortest:
                    continue
                known = np.concatenate([[0], np.cumsum(codes >= 0)])
                starts = np.arange(0, max(1, len(codes) - RUN + 1), RUN)
                ends = np.minimum(starts + WINDOW, len(codes))
                kept = known[ends] - known[starts] >= RUN
                if weight is not None:
                    heavy = np.concatenate([[0], np.cumsum(weight[codes])])
                    kept = ~kept & (heavy[ends] - heavy[starts] >= least)
                for s in starts[kept]:
                    keys.append(k)
                    found.append(codes[s : s + WINDOW].tolist())
            yield pd.DataFrame({"key": pd.Series(keys, dtype="int64"), "words": pd.Series(found, dtype=object)})

    return documents.select(F.col(key).cast("long").alias(key), F.col(text)).filter(F.col(key).isNotNull() & F.col(text).isNotNull()).mapInPandas(cut, "key long, words array<int>")


def _sums(cut: DataFrame, part: Callable[[Sparse, np.ndarray], None], idf: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """What ``part(vectors, total)`` adds up over all passages, in each task and then in the cluster by row blocks."""

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(shape)
        for pdf in batches:
            for at in range(0, len(pdf), 2_000):
                part(Sparse([np.asarray(w) for w in pdf["words"].iloc[at : at + 2_000]], idf), total)
        for at in range(0, len(total), 256):
            if total[at : at + 256].any():
                yield pd.DataFrame({"at": [at], "m": [total[at : at + 256].tobytes()]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"at": pdf["at"].iloc[:1], "m": [sum(np.frombuffer(m) for m in pdf["m"]).tobytes()]})

    out = np.zeros(shape)
    # rows are as many as tasks and blocks of the vocabulary, not as passages
    for r in cut.mapInPandas(sketch, "at int, m binary").groupBy("at").applyInPandas(add, "at int, m binary").collect():
        out[r["at"] : r["at"] + 256] = np.frombuffer(r["m"]).reshape(-1, shape[1])
    return out


def basis(cut: DataFrame, idf: np.ndarray, rank: int = RANK) -> np.ndarray:
    """Right singular vectors (vocabulary x rank) of all passages in ``cut`` by a randomised SVD."""
    v, width = len(idf), min(rank + OVERSAMPLE, len(idf))
    omega = np.random.default_rng(20_117).standard_normal((v, width)).astype(np.float32)
    q, _ = np.linalg.qr(_sums(cut, lambda a, total: a.add_transposed(a.times(omega), total), idf, (v, width)))
    q = q.astype(np.float32)

    def gram(a: Sparse, total: np.ndarray) -> None:
        b = a.times(q)
        total += b.T @ b

    _, u = np.linalg.eigh(_sums(cut, gram, idf, (q.shape[1], q.shape[1])))
    return (q @ u[:, ::-1][:, : min(rank, q.shape[1])]).astype(np.float32)


def _codes(texts: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """(item_id, words) of whole items as codes."""
    shared = texts.sparkSession.sparkContext.broadcast(vocabulary)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"item_id": pdf["item_id"], "words": [[shared.value[w] for w in split_words(x)] for x in pdf["text"]]})

    return texts.mapInPandas(encode, "item_id long, words array<int>")


def _vocabulary(texts: DataFrame) -> dict[str, int]:
    """Codes of the distinct words of all items; their number is checked before any reaches the driver."""

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"w": sorted({w for x in pdf["text"] for w in split_words(x)})}, dtype=object)

    distinct = materialise(texts.mapInPandas(words, "w string").distinct(), "p8")
    if (n := distinct.count()) > MAX_VOCABULARY:
        raise ValueError(f"the items have {n} distinct words, more than {MAX_VOCABULARY}: search for them in several calls")
    return {w: i for i, w in enumerate(sorted(r["w"] for r in distinct.collect()))}


def _search(documents: DataFrame, benchmark: DataFrame, paraphrases: bool, key: str, rank: int, least: float, block_words: int) -> DataFrame:
    """(key, item_id, verbatim, cosine, lcs_share) of passages of documents near a passage of an item.

    Weights and space come from all passages with at least ``RUN`` known words and the passages of all items. For
    paraphrases the windows of fewer known words that weigh enough for one are searched, too. Items are worked through in
    blocks, each against all passages.
    """
    spark = documents.sparkSession
    schema = "key long, item_id long, verbatim boolean, cosine double, lcs_share double"
    texts = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("item_id is not null and text is not null")
    vocabulary = _vocabulary(texts)
    if not vocabulary:
        return spark.createDataFrame([], schema)
    items = materialise(_codes(texts, vocabulary), "p8")
    v = len(vocabulary)
    cut = materialise(passages(documents, vocabulary, key), "p8")

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [p.tolist() for w in pdf["words"] for p in item_passages(np.asarray(w, dtype=np.int32))]
            yield pd.DataFrame({"words": pd.Series(found, dtype=object)})

    own = materialise(items.mapInPandas(windows, "words array<int>"), "p8")
    df = np.zeros(v)
    for r in cut.select(F.explode(F.array_distinct("words")).alias("w")).filter("w >= 0").groupBy("w").agg(F.count("*").alias("n")).collect():  # a row per word of the items
        df[r["w"]] = r["n"]
    idf = (np.log((cut.count() + own.count() + 1) / (df + 1)) + 0.1).astype(np.float32)
    space = basis(cut.select("words").unionByName(own), idf, rank)
    weight = np.append(idf, np.float32(0))  # the last place stands for no word

    searched = cut
    if paraphrases:  # the lightest passage of all bounds what any window must weigh
        lightest = own.mapInPandas(lambda batches: (pd.DataFrame({"x": [float(weight[np.asarray(w)].sum()) for w in pdf["words"]]}) for pdf in batches), "x double").agg(F.min("x")).first()[0]
        searched = cut.unionByName(passages(documents, vocabulary, key, weight=idf, least=(lightest or 0.0) * min(PARAPHRASE_LCS, ANSWERED_LCS) * (1 - 1e-5)))  # sums of single precision

    at = items.select("item_id", F.size("words").alias("n")).groupBy("item_id").agg(F.sum("n").alias("n"))
    n_blocks = max(1, -(-int(at.agg(F.sum("n")).first()[0] or 0) // block_words))
    out = []
    for b in range(n_blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == b).orderBy("item_id", "words").collect()  # about WORDS_PER_BLOCK words
        block = Block([(r["item_id"], np.array(r["words"], dtype=np.int32)) for r in rows])
        if block.passages:
            out.append(_search_block(searched, block, idf, space, weight, paraphrases, least, schema))
    return reduce(DataFrame.unionByName, out) if out else spark.createDataFrame([], schema)


def _unit(m: np.ndarray) -> np.ndarray:
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-9)


def _search_block(searched: DataFrame, block: Block, idf: np.ndarray, space: np.ndarray, weight: np.ndarray, paraphrases: bool, least: float, schema: str) -> DataFrame:
    v, own = len(idf), block.passages
    padded = np.full((len(own), WINDOW), v, dtype=np.int32)
    for j, p in enumerate(own):
        padded[j, : len(p)] = p
    needed = weight[padded].sum(axis=1) * min(PARAPHRASE_LCS, ANSWERED_LCS)
    # the words of the block alone, numbered for a small table of which passage has which
    local = np.full(v + 1, -1, dtype=np.int32)
    used = np.unique(padded[padded < v])
    local[used] = np.arange(len(used))
    shared = searched.sparkSession.sparkContext.broadcast((block, idf, space, _unit(Sparse(own, idf).times(space)), local, local[padded], weight[padded], needed, len(used)))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, idf, space, targets, local, padded, heavy, needed, n_local = shared.value
        for pdf in batches:
            for at in range(0, len(pdf), 1_000):
                part = pdf.iloc[at : at + 1_000]
                found = [np.asarray(w) for w in part["words"]]
                tfidf = Sparse(found, idf)
                cosine = _unit(tfidf.times(space)) @ targets.T
                keys, near, out, hits = part["key"].to_numpy(), cosine >= least, [], {}
                for i in np.flatnonzero(near.any(axis=1)):
                    hit = {o for g in runs(found[i]) for o in block.by_run.get(g, ())}
                    if hit:
                        js = np.flatnonzero(near[i])
                        owners = block.owners[js]
                        hits[i] = hit.intersection(owners.tolist())
                        out += [(keys[i], block.ids[o], True, float(cosine[i, js[owners == o]].max()), 1.0) for o in hits[i]]
                if paraphrases:
                    pi, pj = np.nonzero(cosine >= PARAPHRASE_COSINE)
                    has = np.zeros((len(found), n_local + 1), dtype=bool)
                    has[tfidf.row, local[tfidf.code]] = True
                    has[:, -1] = False  # words of other blocks only
                    # the weight of the words in common bounds that of a subsequence: only pairs above it are aligned
                    for c in range(0, len(pi), 50_000):
                        i_, j_ = pi[c : c + 50_000], pj[c : c + 50_000]
                        common = (has[i_[:, None], padded[j_]] * heavy[j_]).sum(axis=1)
                        for i, j in zip(i_[common >= needed[j_]], j_[common >= needed[j_]]):
                            o, words = block.owners[j], block.passages[j]
                            if o not in hits.get(i, ()) and (share := common_subsequence(words, found[i], idf) / idf[words].sum()) >= min(PARAPHRASE_LCS, ANSWERED_LCS):
                                out.append((keys[i], block.ids[o], False, float(cosine[i, j]), share))
                yield pd.DataFrame(out, columns=["key", "item_id", "verbatim", "cosine", "lcs_share"])

    return searched.mapInPandas(search, schema)


def found(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", rank: int = RANK, least: float = LEAST_COSINE, block_words: int = WORDS_PER_BLOCK) -> DataFrame:
    """(doc_id, item_id) of each document that holds ``RUN`` or more consecutive words of the item, each pair once.

    Null keys and texts, and texts of fewer words, hold nothing. Repeated item ids count as one item with all texts.
    A ``least`` of -1 checks every pair of passages and misses no run.
    """
    return _search(documents, benchmark, False, key, rank, least, block_words).filter("verbatim").select(F.col("key").alias(key), "item_id").distinct()


def exact_runs(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id") -> DataFrame:
    """(doc_id, item_id) as ``found`` defines it, by a join on every run of words: the yardstick of its recall."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = [(k, " ".join(w[i : i + RUN])) for k, x in zip(pdf["key"], pdf["text"]) for w in [split_words(x)] for i in range(len(w) - RUN + 1)]
            yield pd.DataFrame(made, columns=["key", "run"])

    of = lambda df, k: df.select(F.col(k).cast("long").alias("key"), "text").filter("key is not null and text is not null").mapInPandas(cut, "key long, run string")
    wanted = of(benchmark, "item_id").select(F.col("key").alias("item_id"), F.unhex(F.md5("run")).alias("run")).distinct()
    return of(documents, key).select("key", F.unhex(F.md5("run")).alias("run")).join(wanted, "run").select(F.col("key").alias(key), "item_id").distinct()


def leaks(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", block_words: int = WORDS_PER_BLOCK) -> DataFrame:
    """(doc_id, item_id, kind, cosine, lcs_share, answer_found): verbatim leaks and paraphrases.

    A paraphrase has no common run, but ``PARAPHRASE_LCS`` of an item passage's words in order, or ``ANSWERED_LCS`` of
    them and the answer. ``answer_found``: a reference answer of the item stands in the document, blanks and letter case
    aside; null where there is none. Of repeated documents and items each text and answer counts.
    """
    best = (
        _search(documents, benchmark, True, key, RANK, LEAST_COSINE, block_words)
        .groupBy("key", "item_id")
        .agg(F.max("verbatim").alias("verbatim"), F.max("cosine").alias("cosine"), F.max("lcs_share").alias("lcs_share"))
    )
    best = materialise(best, "p8")
    flat = lambda c: F.lower(F.regexp_replace(c, r"[^\p{L}\p{N}]+", " "))
    answers = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.trim(flat(F.col("reference_answer"))).alias("answer")).filter("answer <> ''").distinct()
    texts = documents.select(F.col(key).cast("long").alias("key"), flat(F.col("text")).alias("own")).join(best.select("key").distinct(), "key", "left_semi")
    said = best.select("key", "item_id").join(answers, "item_id").join(texts, "key")
    stands = F.concat(F.lit(" "), "own", F.lit(" ")).contains(F.concat(F.lit(" "), "answer", F.lit(" ")))
    said = said.groupBy("key", "item_id").agg(F.max(F.coalesce(stands, F.lit(False))).alias("answer_found"))
    rows = best.join(said, ["key", "item_id"], "left").filter(F.col("verbatim") | (F.col("lcs_share") >= PARAPHRASE_LCS) | F.coalesce("answer_found", F.lit(False)))
    kind = F.when(F.col("verbatim"), "verbatim").otherwise("paraphrase")
    return rows.select(F.col("key").alias(key), "item_id", kind.alias("kind"), F.round("cosine", 3).alias("cosine"), F.round("lcs_share", 3).alias("lcs_share"), "answer_found")
