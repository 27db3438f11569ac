"""Toxicity from confirmed toxic examples and unlabelled text.

A logistic model over hashed words is trained with the non-negative risk estimator for
positive and unlabelled data: with class prior pi, the negative class's risk is the
unlabelled risk less pi times the risk of calling positives negative. Where that
difference falls below zero the model has begun to overfit, and the step goes up the
difference instead of down.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import fold_of

LETTERS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class ToxicityModel:
    """``positives`` and ``unlabelled`` bound the training sample, in documents.

    A sample is drawn by a hash of the id among the training folds; texts that repeat in
    it count once. A word becomes a feature if at least ``least`` positives hold it and
    their share differs from the unlabelled one by ``deviations`` standard errors.
    ``decay``: pull of the weights towards zero.
    """

    positives: int = 4_000
    unlabelled: int = 12_000
    folds: int = 3
    held_out: int = 1
    bits: int = 18
    least: int = 4
    deviations: float = 5.0
    steps: int = 400
    rate: float = 0.1
    decay: float = 1e-4
    threshold: float = 0.7


def features(text: str | None, bits: int) -> np.ndarray:
    """The hashed distinct words of a text: runs of letters, lower case."""
    shift = 64 - bits
    found = {xxhash.xxh3_64_intdigest(w) >> shift for w in set(LETTERS.findall((text or "").lower()))}
    return np.fromiter(found, np.int64, len(found))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, m: ToxicityModel) -> np.ndarray:
    """Weights of the hashed words, the intercept last, by Adam on the whole sample."""
    size = 1 << m.bits
    docs = positive + unlabelled
    n_pos, n_all = len(positive), len(docs)
    row = np.repeat(np.arange(n_all), [len(d) for d in docs])
    flat = np.concatenate(docs)
    with_pos = np.bincount(flat[row < n_pos], minlength=size)
    share = (np.bincount(flat[row >= n_pos], minlength=size) + 0.5) / (n_all - n_pos + 1)
    z = (with_pos / n_pos - share) / np.sqrt(share * (1 - share) / n_pos)
    used = np.flatnonzero(((with_pos >= m.least) | (z < 0)) & (np.abs(z) >= m.deviations))
    number = np.full(size, -1)
    number[used] = np.arange(len(used))
    keep = number[flat] >= 0
    row, col = row[keep], number[flat][keep]
    weights = np.zeros(len(used) + 1)
    weights[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    is_pos = np.arange(n_all) < n_pos
    for step in range(1, m.steps + 1):
        margin = np.bincount(row, weights[col], minlength=n_all) + weights[-1]
        chance = sigmoid(margin)
        as_negative = np.logaddexp(0, margin)  # loss of calling a document negative
        rest = as_negative[~is_pos].mean() - prior * as_negative[is_pos].mean()
        # derivatives by margin: of log(1 + e^-z) it is p - 1, of log(1 + e^z) it is p
        if rest >= 0:
            slope = np.where(is_pos, (prior * (chance - 1) - prior * chance) / n_pos, chance / (n_all - n_pos))
        else:
            slope = np.where(is_pos, prior * chance / n_pos, -chance / (n_all - n_pos))
        grad = np.append(np.bincount(col, slope[row], minlength=len(used)) + m.decay * weights[:-1], slope.sum())
        first += 0.1 * (grad - first)
        second += 0.001 * (grad * grad - second)
        scale = m.rate / (np.sqrt(second / (1 - 0.999**step)) + 1e-6)
        weights -= scale * first / (1 - 0.9**step)
    out = np.zeros(size + 1, np.float32)
    out[used], out[-1] = weights[:-1], weights[-1]
    return out


def _trainer(m: ToxicityModel, prior: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: tuple[dict, dict] = {}, {}
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"]):
                words = np.sort(features(text, m.bits))
                found[toxic][words.tobytes()] = words
        if all(found):
            # in an order of their own: sums of floats must not depend on that of the tasks
            positive, unlabelled = ([x[key] for key in sorted(x)] for x in reversed(found))
            yield pd.DataFrame({"weights": [fit(positive, unlabelled, prior, m).tobytes()]})

    return run


def _bounded(rows: DataFrame, most: int) -> DataFrame:
    """At most so many different (doc_id, text), by hash: the same ones in every run, however often rows repeat."""
    keyed = rows.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    keys = keyed.select("doc_id", "text_hash").distinct()
    keys = keys.orderBy(F.xxhash64("doc_id", "text_hash"), "doc_id", "text_hash").limit(most)
    keys = keys.select(F.col("doc_id").alias("key_id"), F.col("text_hash").alias("key_hash"))
    both = keyed.join(F.broadcast(keys), F.expr("doc_id = key_id and text_hash = key_hash"))
    return both.groupBy("doc_id", "text_hash").agg(F.min("text").alias("text"))


def train(docs: DataFrame, labels: DataFrame, m: ToxicityModel = ToxicityModel()) -> bytes | None:
    """Weights learnt from the training folds; None without a toxic or an unlabelled text.

    A document counts as confirmed toxic if any of its label rows says so. The class
    prior is the toxic share of the labelled documents, kept within 0.01 and 0.5.
    """
    text = F.col("text").cast("string").alias("text")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text)
    docs = docs.filter("doc_id is not null").filter(fold_of(F.col("doc_id"), m.folds) != m.held_out)
    known = labels.select(F.col("doc_id").cast("long").alias("labelled"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter("labelled is not null and toxic is not null")
    known = known.filter(fold_of(F.col("labelled"), m.folds) != m.held_out).groupBy("labelled").agg(F.max("toxic").alias("toxic"))
    toxic, counted = known.agg(F.sum((F.col("toxic") > 0).cast("int")), F.count("*")).first()
    if not toxic:
        return None
    prior = min(0.5, max(0.01, toxic / counted))
    rank = F.xxhash64(F.lit("positive"), "labelled")
    chosen = known.filter("toxic > 0").select("labelled").orderBy(rank, "labelled").limit(m.positives)
    # at most m.positives ids: small whatever the labels' size
    confirmed = _bounded(docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled")), 2 * m.positives)
    total = docs.count()
    share = min(1.0, m.unlabelled / max(1, total))
    drawn = F.pmod(F.xxhash64(F.lit("unlabelled"), "doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))
    some = _bounded(docs.filter(drawn), 2 * m.unlabelled)
    sample = confirmed.select("text", F.lit(True).alias("toxic")).union(some.select("text", F.lit(False).alias("toxic")))
    # the sample is bounded by the parameters, so one task trains on all of it
    found = sample.coalesce(1).mapInPandas(_trainer(m, prior), "weights binary").collect()
    return bytes(found[0][0]) if found else None


def score(text: Column, weights: bytes | None, m: ToxicityModel = ToxicityModel()) -> Column:
    """The probability that a text is toxic, 0 to 1; 0 without a model."""
    if weights is None:
        return F.lit(0.0)

    @F.pandas_udf("double")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        learnt = np.frombuffer(weights, np.float32).astype(np.float64)
        useful = set(np.flatnonzero(learnt[:-1]).tolist())
        shift, met = 64 - m.bits, {}

        def weight(word: str) -> float:
            value = met.get(word)
            if value is None:
                if len(met) > 200_000:
                    met.clear()
                spot = xxhash.xxh3_64_intdigest(word) >> shift
                value = met[word] = (spot, learnt[spot] if spot in useful else 0.0)
            return value

        for batch in texts:
            out = np.empty(len(batch))
            for k, text in enumerate(batch):
                found = dict(map(weight, set(LETTERS.findall((text or "").lower()))))
                out[k] = sum(found.values()) + learnt[-1]
            yield pd.Series(sigmoid(out))

    return run(text.cast("string"))


def toxicity(docs: DataFrame, labels: DataFrame, m: ToxicityModel = ToxicityModel()) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs`` (doc_id, text).

    A null text is empty, and an empty one has the score of a text without known words.
    Rows that repeat each get a row; a null id counts as an empty text in the fold and
    trains nothing. Without any confirmed toxic text every score is 0. Labels (doc_id,
    toxic) that are null are left out. Other columns are not read.
    """
    weights = train(docs, labels, m)
    chance = score(F.col("text"), weights, m)
    held_out = (fold_of(F.col("doc_id"), m.folds) == m.held_out).alias("held_out")
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out, chance.alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= m.threshold, 1).otherwise(0))


def without_toxic(docs: DataFrame, labels: DataFrame, m: ToxicityModel = ToxicityModel()) -> DataFrame:
    """The rows of ``docs`` whose texts score below the threshold."""
    return docs.filter(score(F.col("text"), train(docs, labels, m), m) < m.threshold)
