"""Toxicity by a chain of linear classifiers.

The categories of the chain are predicted one after the other.  A later category's
model sees, beside the words, the probabilities of the earlier ones.  In training these
are out-of-fold predictions, so a later model learns from probabilities as good as those it
will meet on new documents, not from ones that have seen the answer.

The chain is fitted on a bounded sample of labelled documents; every document is scored by
its whole text.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, MapType, StringType

from lanewatch.llm.common import text_of

#: Most labelled documents that the chain is fitted on, half of them toxic if there are as many.
TRAIN_DOCUMENTS = 6000
#: Most words that a category may look at.
TERMS_PER_CATEGORY = 300
FOLDS = 5
#: A word is looked at if its log-likelihood ratio reaches this (1 in 1000 by chance is 10.8).
LEAST_RATIO = 12.0
#: And if it changes the odds of a category by this factor; weaker words tell of length mostly.
LEAST_ODDS = 3.0

CATEGORIES = ("junk", "toxic", "toxic_junk")

_WORD = re.compile(r"[^\W\d_]+")


#: Letters of a word that count as a term of their own: inflected and compound forms share them.
STEM = 5


def words_of(text: str) -> list[str]:
    """The words of a text in lower case, and the beginnings of the longer ones, marked ``*``."""
    words = _WORD.findall(text.lower())
    return words + [w[:STEM] + "*" for w in words if len(w) > STEM]


def chain_labels(labels: DataFrame) -> DataFrame:
    """One row per labelled document: low quality, toxic, and both at once.

    A document with several labels counts as toxic or of low quality if one says so.
    Null labels count as clean.
    """
    each = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("toxic"), F.lit(0))).alias("toxic"),
        F.min(F.coalesce(F.col("quality"), F.lit(1))).alias("quality"))
    junk = (F.col("quality") == 0).cast("int")
    toxic = (F.col("toxic") == 1).cast("int")
    return each.select("doc_id", junk.alias("junk"), toxic.alias("toxic"),
                       (junk * toxic).alias("toxic_junk"))


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str,
                    most: int) -> DataFrame:
    """Labelled documents of the smallest hashes: at most ``most``, half of them toxic."""
    known = chain_labels(labels).withColumn("_order", F.xxhash64(F.lit(5), "doc_id"))
    half = most // 2
    chosen = known.where("toxic = 1").orderBy("_order").limit(half).unionByName(
        known.where("toxic = 0").orderBy("_order").limit(most - half))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("_text"))
    # At most ``most`` rows of five numbers.
    return texts.join(F.broadcast(chosen.drop("_order")), "doc_id")


@F.pandas_udf(MapType(StringType(), IntegerType()))
def _word_counts(texts: pd.Series) -> pd.Series:
    return texts.map(lambda text: dict(Counter(words_of(text))))


def useful_words(counted: DataFrame, categories: tuple[str, ...],
                 most: int) -> dict[str, list[str]]:
    """For each category the words whose presence tells most about it, at most ``most``."""
    totals = counted.agg(F.count("*").alias("n"), *(
        F.sum(c).alias(c) for c in categories)).first()
    words = (
        counted.select(*categories, F.explode("_words").alias("word", "times"))
        .groupBy("word").agg(F.count("*").alias("_n"), *(F.sum(c).alias(c) for c in categories))
        .where("_n >= 2"))

    def log_likelihood(with_word: Column, rows: Column, hits: float, all_rows: float) -> Column:
        def term(seen: Column, expected: Column) -> Column:
            return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(F.lit(0.0))
        rate = F.lit(hits / all_rows)
        other, clean = F.lit(hits) - with_word, rows - with_word
        rest = F.lit(all_rows - hits) - clean
        left = F.lit(all_rows) - rows
        return 2 * (term(with_word, rows * rate) + term(clean, rows * (1 - rate))
                    + term(other, left * rate) + term(rest, left * (1 - rate)))

    found: dict[str, list[str]] = {category: [] for category in categories}
    for category in categories:
        hits, rows = float(totals[category] or 0), float(totals["n"])
        if not 0 < hits < rows:
            continue
        seen, of_all = F.col(category).cast("double"), F.col("_n").cast("double")
        odds = F.log((seen + 0.5) / (of_all - seen + 0.5)) - F.log(
            (F.lit(hits) - seen + 0.5) / (F.lit(rows - hits) - of_all + seen + 0.5))
        ranked = words.where(F.abs(odds) >= float(np.log(LEAST_ODDS))).select(
            "word", log_likelihood(seen, of_all, hits, rows).alias("g"))
        best = ranked.where(F.col("g") >= LEAST_RATIO).orderBy(F.desc("g"), "word").limit(most)
        found[category] = [r["word"] for r in best.collect()]
    return found


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0,
                 rounds: int = 250) -> np.ndarray:
    """Weights (last: intercept) of a ridge logistic model with classes weighing alike.

    Accelerated gradient steps, as long as the curvature's bound allows.
    """
    if y.min(initial=1) == y.max(initial=0) or not len(y):
        weights = np.zeros(x.shape[1] + 1)
        weights[-1] = 20.0 if len(y) and y[0] else -20.0
        return weights
    x1 = np.hstack([x, np.ones((len(x), 1))])
    share = np.where(y > 0, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9)) / len(y)
    ridge = np.full(x1.shape[1], penalty / len(y))
    ridge[-1] = 0
    v = np.ones(x1.shape[1])
    for _ in range(20):
        v = x1.T @ (share * (x1 @ v))
        v /= np.linalg.norm(v) + 1e-30
    step = 1 / (0.25 * 1.1 * (v @ (x1.T @ (share * (x1 @ v)))) + ridge.max() + 1e-12)
    w = look = np.zeros(x1.shape[1])
    t = 1.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-np.clip(x1 @ look, -40, 40))) - y
        new = look - step * (x1.T @ (share * error) + ridge * look)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return w


def predict(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -40, 40)))


@dataclass
class Chain:
    """Words looked at by each category, and its linear model, in the order of the chain."""

    categories: tuple[str, ...]
    words_of: dict[str, list[str]]
    models: list[np.ndarray]

    def __post_init__(self):
        self.words = list(dict.fromkeys(w for words in self.words_of.values() for w in words))
        place = {w: i for i, w in enumerate(self.words)}
        self.columns = [[place[w] for w in self.words_of[c]] for c in self.categories]

    def features(self, counts: list[dict[str, int]]) -> np.ndarray:
        place = {w: i for i, w in enumerate(self.words)}
        x = np.zeros((len(counts), len(self.words)))
        for row, own in enumerate(counts):
            for word, times in own.items():
                if word in place:
                    x[row, place[word]] = np.log1p(times)
        return x

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), len(self.models)))
        for k, weights in enumerate(self.models):
            out[:, k] = predict(np.hstack([x[:, self.columns[k]], out[:, :k]]), weights)
        return out


def fit_chain(counts: list[dict[str, int]], labels: np.ndarray, folds: np.ndarray,
              words: dict[str, list[str]], categories: tuple[str, ...] = CATEGORIES) -> Chain:
    """Fit the models in turn, each on out-of-fold probabilities of those before it."""
    chain = Chain(categories, words, [])
    every, earlier = chain.features(counts), np.zeros((len(counts), 0))
    for k in range(len(categories)):
        x, y = np.hstack([every[:, chain.columns[k]], earlier]), labels[:, k]
        chain.models.append(fit_logistic(x, y))
        out_of_fold = np.zeros(len(y))
        for fold in range(FOLDS):
            held = folds == fold
            if held.any():
                out_of_fold[held] = predict(x[held], fit_logistic(x[~held], y[~held]))
        earlier = np.hstack([earlier, out_of_fold[:, None]])
    return chain


def train_chain(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                text_col: str = "text", most: int = TRAIN_DOCUMENTS,
                terms: int = TERMS_PER_CATEGORY) -> Chain:
    """Fit a chain on at most ``most`` labelled documents.

    Only counts of the chosen words reach the driver: a row for each sampled document.
    Without labels, or with one class only, the models predict that class (clean).
    """
    sample = training_sample(docs, labels, id_col, text_col, most)
    counted = sample.withColumn("_words", _word_counts("_text")).drop("_text").cache()
    try:
        words = useful_words(counted, CATEGORIES, terms)
        every = sorted({w for own in words.values() for w in own})
        known = F.array(*(F.lit(w) for w in every)) if every else F.array().cast("array<string>")
        rows = counted.select(
            "doc_id", *CATEGORIES,
            F.map_filter("_words", lambda word, times: F.array_contains(known, word))
            .alias("_words"),
        ).orderBy("doc_id").collect()
    finally:
        counted.unpersist()
    targets = np.array([[r[c] for c in CATEGORIES] for r in rows], float).reshape(-1, len(CATEGORIES))
    folds = np.array([(r["doc_id"] * 2654435761 >> 7) % FOLDS for r in rows], np.int64)
    return fit_chain([r["_words"] for r in rows], targets, folds, words)


def scored(docs: DataFrame, chain: Chain, text_col: str = "text") -> DataFrame:
    """The rows in a struct ``_row``, with ``_p``: the chain's probabilities in order."""
    places = frozenset(chain.words)

    @F.pandas_udf(ArrayType(DoubleType()))
    def probabilities(texts: pd.Series) -> pd.Series:
        counts = [Counter(w for w in words_of(t) if w in places) for t in texts]
        return pd.Series(list(chain.probabilities(chain.features(counts))))

    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    return docs.select(row, probabilities(text_of(text_col)).alias("_p"))


def toxicity_report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """``(doc_id, p_junk, p_toxic, p_toxic_junk, rejected)``, one row per row of ``docs``.

    A document is rejected when its probability of being toxic reaches the threshold.
    Null texts count as empty.  Other columns of ``docs`` may have any name.
    """
    chain = train_chain(docs, labels, id_col, text_col)
    found = scored(docs, chain, text_col)
    return found.select(
        F.col("_row").getField(id_col).alias("doc_id"),
        *(F.col("_p")[k].alias(f"p_{c}") for k, c in enumerate(chain.categories)),
        (F.col("_p")[chain.categories.index("toxic")] >= threshold).alias("rejected"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
               text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with their columns as they are."""
    chain = train_chain(docs, labels, id_col, text_col)
    found = scored(docs, chain, text_col)
    toxic = F.col("_p")[chain.categories.index("toxic")]
    return found.where(toxic < threshold).select("_row.*")
