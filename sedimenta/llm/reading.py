"""Problem 9: how demanding a text is to read, on the raters' scale from 1 to 5.

Features of each document (lexical diversity, word rarity over the whole corpus, connectives, a proxy of clause depth,
lengths) are standardised within its language; a regularised ordinal regression (proportional odds) on the graded texts
turns them into a level.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.session import materialise

#: Word frequencies are kept in this many hashed counters: a fixed size, whatever the corpus.
BUCKETS = 1 << 18
#: Most ratings used to fit, those of the smallest hash of the document's key; all documents are scored.
MAX_RATINGS = 4_000
LEVELS = 5
FEATURES = ("log_words", "word_length", "long_words", "sentence_length", "diversity", "rarity", "connectives", "clauses")

# Connectives and words that open a subordinate clause, by language.
CONNECTIVES = {
    "en": "although because consequently furthermore hence however inasmuch insofar moreover nevertheless notwithstanding provided since so that therefore though thus unless until whereas whereby wherein whether which while who whose",
    "de": "als außerdem bevor da damit dass denn dennoch deshalb falls indem jedoch nachdem ob obwohl sobald sofern sondern soweit trotzdem weil wenn wobei wodurch zudem",
    "fr": "afin ainsi alors bien car cependant comme donc dont lorsque mais néanmoins parce pourtant puisque quand que qui quoique sauf si sinon toutefois",
    "es": "aunque además así como conforme cuando donde embargo luego mientras para pero porque pues puesto que quien salvo según si sino tanto",
}
_CONNECTIVE = {k: frozenset(v.split()) for k, v in CONNECTIVES.items()}
_WORD = re.compile(r"[^\W\d_]+")
_CODE = re.compile(r"```.*?(?:```|\Z)", re.S)
_END = re.compile(r"[.!?]+(?=\s|\Z)|\n\s*\n")
_COMMA = re.compile(r"[,;:]")


def language(lang: Column) -> Column:
    """Two-letter language of a label; anything but en, de, fr, es counts as other."""
    code = F.substring(F.lower(F.trim(lang)), 1, 2)
    return F.when(code.isin(list(CONNECTIVES)), code).otherwise("other")


def rarities(documents: DataFrame, text: str = "text") -> np.ndarray:
    """-log of the share of each counter in all words of the corpus; an unseen counter has the largest value."""
    words = documents.select(F.explode(F.split(F.lower(F.regexp_replace(F.col(text), r"```[\s\S]*?(?:```|\z)", " ")), r"[^\p{L}]+")).alias("w")).filter("w <> ''")
    rows = words.groupBy(F.pmod(F.xxhash64("w"), F.lit(BUCKETS)).alias("at")).agg(F.count("*").alias("n")).toPandas()
    counts = np.full(BUCKETS, 0.5)
    counts[rows["at"].to_numpy(dtype=np.int64)] += rows["n"].to_numpy(dtype=np.float64)
    return (math.log(counts.sum()) - np.log(counts)).astype(np.float32)


def measure(text: str | None, lang: str, rarity) -> list[float] | None:
    """The features of one text; None for a text without words. ``rarity`` maps a word to its rarity."""
    if not text:
        return None
    prose = _CODE.sub(" ", text).lower()
    words = _WORD.findall(prose)
    if not words:
        return None
    n, distinct = len(words), set(words)
    sentences = max(1, len(_END.findall(prose.rstrip())) + (not prose.rstrip().endswith((".", "!", "?"))))
    lengths = np.fromiter(map(len, words), dtype=np.int32, count=n)
    links = _CONNECTIVE.get(lang, _CONNECTIVE["en"])
    n_links = sum(w in links for w in words)
    return [
        math.log(n),
        float(lengths.mean()),
        float((lengths > 8).mean()),
        math.log(n / sentences),
        len(distinct) / math.sqrt(n),
        sum(map(rarity, words)) / n,
        n_links / sentences,
        (len(_COMMA.findall(prose)) + n_links) / sentences,
    ]


def features(documents: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(key, lang, f) of each document; f is null for a text without words (null, blank, only code or numbers)."""
    shared = documents.sparkSession.sparkContext.broadcast(rarities(documents, text))

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from xxhash import xxh64_intdigest

        table, known = shared.value, {}

        def rarity(word: str) -> float:
            if word not in known:
                if len(known) > 500_000:
                    known.clear()
                h = xxh64_intdigest(word.encode("utf-8", "replace"), 42)
                known[word] = float(table[(h - (1 << 64) if h >> 63 else h) % BUCKETS])
            return known[word]

        for pdf in batches:
            yield pd.DataFrame({"key": pdf["key"], "lang": pdf["lang"], "f": [measure(x, k, rarity) for x, k in zip(pdf["text"], pdf["lang"])]})

    rows = documents.select(F.col(key).alias("key"), language(F.coalesce(F.col(lang), F.lit(""))).alias("lang"), F.col(text).alias("text"))
    return rows.mapInPandas(compute, "key long, lang string, f array<double>")


class Ordinal:
    """Proportional-odds regression with an L2 penalty, fitted by gradient steps (Adam) on all given rows."""

    def __init__(self, levels: int = LEVELS, penalty: float = 1e-3) -> None:
        self.levels, self.penalty = levels, penalty

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 800) -> Ordinal:
        """``y`` in 1..levels. Without rows every weight is 0."""
        p = x.shape[1]
        theta = np.zeros(p + self.levels - 1)
        if len(y):
            share = np.clip(np.cumsum(np.bincount(y.astype(int) - 1, minlength=self.levels))[:-1] / len(y), 0.01, 0.99)
            cut = np.maximum.accumulate(np.log(share / (1 - share)) + np.arange(self.levels - 1) * 1e-3)
            theta[p] = cut[0]
            theta[p + 1 :] = np.log(np.maximum(np.diff(cut), 1e-2))
            m, v, upper = np.zeros_like(theta), np.zeros_like(theta), y.astype(int) - 1
            for t in range(1, steps + 1):
                g = self._gradient(theta, x, upper)
                m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
                theta -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        self.beta, self.cuts = theta[:p], self._cuts(theta[p:])
        return self

    @staticmethod
    def _cuts(free: np.ndarray) -> np.ndarray:
        return np.cumsum(np.concatenate([free[:1], np.exp(np.clip(free[1:], -20, 5))]))

    def _gradient(self, theta: np.ndarray, x: np.ndarray, level: np.ndarray) -> np.ndarray:
        p = x.shape[1]
        cuts = np.concatenate([[-np.inf], self._cuts(theta[p:]), [np.inf]])
        eta = x @ theta[:p]
        hi, lo = (1 / (1 + np.exp(-np.clip(cuts[level + s] - eta, -35, 35))) for s in (1, 0))
        hi, lo = np.where(level == self.levels - 1, 1.0, hi), np.where(level == 0, 0.0, lo)
        mass = np.maximum(hi - lo, 1e-9)
        d_hi, d_lo = hi * (1 - hi) / mass, lo * (1 - lo) / mass
        g_beta = x.T @ (d_hi - d_lo) / len(x) + self.penalty * theta[:p]
        g_cut = np.zeros(self.levels - 1)
        np.add.at(g_cut, level[level < self.levels - 1], -d_hi[level < self.levels - 1] / len(x))
        np.add.at(g_cut, level[level > 0] - 1, d_lo[level > 0] / len(x))
        tail = np.cumsum(g_cut[::-1])[::-1]
        return np.concatenate([g_beta, tail[:1], tail[1:] * np.exp(np.clip(theta[p + 1 :], -20, 5))])

    def expected(self, x: np.ndarray) -> np.ndarray:
        """Mean level of each row."""
        above = 1 / (1 + np.exp(-np.clip(x @ self.beta[:, None] - self.cuts, -35, 35)))
        return 1 + above.sum(axis=1)


def _standard(measured: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Mean and deviation of each feature in each of the five language groups."""
    n = len(FEATURES)
    aggs = [f(F.col("f")[i]).alias(f"{name}{i}") for i in range(n) for name, f in (("m", F.avg), ("s", F.stddev_pop))]
    rows = measured.filter("f is not null").groupBy("lang").agg(*aggs).collect()
    return {r["lang"]: (np.array([r[f"m{i}"] for i in range(n)]), np.array([r[f"s{i}"] or 1.0 for i in range(n)])) for r in rows}


def _scaled(f: list, langs: list[str], standard: dict) -> np.ndarray:
    out = np.zeros((len(f), len(FEATURES)))
    for i, (x, k) in enumerate(zip(f, langs)):
        if x is not None and k in standard:
            mean, dev = standard[k]
            out[i] = np.clip((np.asarray(x) - mean) / dev, -6, 6)
    return out


def _valid(labels: DataFrame) -> DataFrame:
    return labels.filter(F.col("reading_level").between(1, LEVELS) & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("key"), "reading_level")


def _rated(measured: DataFrame, rated: DataFrame) -> DataFrame:
    """The features of each rating's document, with ``h``, the hash of its key."""
    return measured.filter("f is not null").join(rated, "key").withColumn("h", F.xxhash64("key"))


def _ratings(measured: DataFrame, labels: DataFrame, most: int) -> pd.DataFrame:
    rated = _valid(labels)
    step = max(1, rated.count() // (8 * most))  # thins by hash first, so that tasks don't each send a whole sample
    return _rated(measured, rated).filter(F.pmod("h", F.lit(step)) == 0).orderBy("h", "reading_level").limit(most).toPandas()


def levels(documents: DataFrame, labels: DataFrame, max_ratings: int = MAX_RATINGS) -> DataFrame:
    """(doc_id, reading_score, reading_level) of each document: expected level, 4 decimals, and the level it rounds to.

    Both are null for texts without words. Ratings out of 1..5 or without a document are ignored; several ratings of a
    document all count. Without any rating every document has the middle score.
    """
    measured = materialise(features(documents), "p9")
    standard, rated = _standard(measured), _ratings(measured, labels, max_ratings)
    model = Ordinal().fit(_scaled(rated["f"].tolist(), rated["lang"].tolist(), standard), rated["reading_level"].to_numpy())

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            f = pdf["f"].tolist()
            s = np.round(model.expected(_scaled(f, pdf["lang"].tolist(), standard)), 4)
            none = np.array([x is None for x in f], dtype=bool)
            yield pd.DataFrame({"doc_id": pdf["key"], "reading_score": pd.Series(s).mask(none), "reading_level": pd.Series(np.clip(np.floor(s + 0.5), 1, LEVELS)).mask(none).astype("Int32")})

    return measured.mapInPandas(score, "doc_id long, reading_score double, reading_level int")


def profile(scored: DataFrame, documents: DataFrame) -> DataFrame:
    """(source, language, domain, reading_level, n_docs, mean_score) over all documents."""
    from sedimenta.llm.budget import slice_name

    slices = documents.select("doc_id", slice_name(F.col("source")).alias("source"), slice_name(F.col("lang")).alias("language"), slice_name(F.col("doc_domain")).alias("domain"))
    return scored.join(slices, "doc_id").groupBy("source", "language", "domain", "reading_level").agg(F.count("*").alias("n_docs"), F.round(F.avg("reading_score"), 4).alias("mean_score"))


def accuracy(documents: DataFrame, labels: DataFrame, max_ratings: int = MAX_RATINGS, folds: int = 5) -> DataFrame:
    """(n_ratings, mean_error, exact_share, within_one_share, baseline_error) of held-out ratings by cross-validation.

    Folds are of documents. Each fold's model is fitted on at most ``max_ratings`` of the other folds; every rating of the
    fold is scored. The baseline answers with the most frequent level of the ratings fitted on.
    """
    measured = materialise(features(documents), "p9")
    standard = _standard(measured)
    rated = materialise(_rated(measured, _valid(labels)).withColumn("fold", F.pmod("h", F.lit(folds))), "p9")
    step = max(1, rated.count() // (8 * max_ratings))
    # thinned by another hash than the folds', of which a step that they divide would leave one; the first of each fold hold the first of any others
    first = F.row_number().over(Window.partitionBy("fold").orderBy("h", "reading_level"))
    sample = rated.filter(F.pmod(F.xxhash64("h"), F.lit(step)) == 0).withColumn("n", first).filter(F.col("n") <= max_ratings).orderBy("h", "reading_level").toPandas()
    x, y = _scaled(sample["f"].tolist(), sample["lang"].tolist(), standard), sample["reading_level"].to_numpy(dtype=int)
    models = {}
    for k in range(folds):
        others = np.flatnonzero(sample["fold"].to_numpy() != k)[:max_ratings]
        if len(others):
            models[k] = Ordinal().fit(x[others], y[others]), np.bincount(y[others]).argmax()

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x, y, fold = _scaled(pdf["f"].tolist(), pdf["lang"].tolist(), standard), pdf["reading_level"].to_numpy(), pdf["fold"].to_numpy()
            guess, base = np.zeros(len(y)), np.zeros(len(y))
            for k, (model, usual) in models.items():
                held = fold == k
                guess[held] = np.clip(np.floor(model.expected(x[held]) + 0.5), 1, LEVELS)
                base[held] = usual
            yield pd.DataFrame({"off": np.abs(guess - y), "base_off": np.abs(base - y)})

    mean = lambda c, name: F.bround(F.avg(c.cast("double")), 4).alias(name)
    off = F.col("off")
    return rated.mapInPandas(score, "off double, base_off double").agg(F.count("*").alias("n_ratings"), mean(off, "mean_error"), mean(off == 0, "exact_share"), mean(off <= 1, "within_one_share"), mean(F.col("base_off"), "baseline_error"))
