"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic rows are the positives, all other rows are unlabelled: a row labelled
clean is not trusted to be so. Linear classifiers over the presence of words minimise
the class-prior-corrected risk  pi * E_p[l(f)] + max(0, E_u[l(-f)] - pi * E_p[l(-f)])
with the logistic loss; where the second part falls below zero, the step goes against its
gradient instead, as the method has it. The prior pi is the share of toxic rows among
labelled training rows (``prior`` without any).

Training takes a sample of documented size (``positives`` and ``unlabelled`` rows, by
hash of the id); scores cover whole texts. A word is a run of letters in lower case.
NULL and empty texts get the score of a text without words, texts of any length are read
whole. Without a positive row every score is 0. Rows whose id repeats are scored each;
labels of a repeated id count as toxic if one of them is; rows without an id are scored
and never learned from. Equal texts have equal scores. An empty table gives no rows, empty
labels give scores of 0. Only doc_id and text are read: other columns may have any name.
"""

from __future__ import annotations

import math
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilmark.llm.arrow import Recent, batch, held, let_go, text_groups, tidy

#: Words of each age that a worker remembers.
REMEMBER = 150_000
PREFIXES = (4, 5, 6, 7, 8)
#: Positive rows that a feature with a weight is in.
LEAST = 8
#: Keeps the prior's logarithm finite.
FLOOR = 1e-9
_WORDS = re.compile(r"[^\W\d_]+").findall


def features(word: str) -> set[int]:
    """Hashes of a word and of its beginnings, so that other endings of a word are known too."""
    return {zlib.crc32(f.encode()) for f in (word, *("^" + word[:k] for k in PREFIXES if len(word) >= k))}


def _features(rows: DataFrame, among: np.ndarray | None = None) -> list[np.ndarray]:
    """The features of each text in ``rows``; with ``among``, those of them."""
    schema = pa.schema([("words", pa.list_(pa.int32()))])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for part in batches:
            found = [np.array(sorted(set().union(*map(features, set(_WORDS(t.lower()))))), np.uint32) for _, texts in text_groups(part["text"]) for t in texts]
            yield batch(schema, [(f if among is None else _within(f, among)).view(np.int32) for f in found])

    column = rows.select("text").mapInArrow(tidy(hashed), "words array<int>").toArrow()["words"].combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).view(np.uint32)
    return np.split(values, np.cumsum(pc.list_value_length(column).to_numpy())[:-1]) if len(column) else []


def _within(found: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Those of ``found`` that are in the sorted array ``among``."""
    if not len(among):
        return found[:0]
    return found[among[np.minimum(np.searchsorted(among, found), len(among) - 1)] == found]


def _sample(rows: DataFrame, n: int) -> DataFrame:
    """About ``n`` rows by hash of the id, the same ones under any partitioning."""
    total = rows.count()
    return rows if total <= n else rows.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000)) < int(1_000_000 * n / total))


class Classifier:
    """Weights of hashed features, and a bias."""

    def __init__(self, weights: dict[int, float], bias: float):
        self.weights, self.bias = weights, bias


def _risk(w: np.ndarray, data: dict, prior: float) -> tuple[float, float, np.ndarray, np.ndarray]:
    """The two parts of the risk, pi * E_p[l(f)] and E_u[l(-f)] - pi * E_p[l(-f)], and their
    gradients by the weights (the bias is the last). ``data`` has, for the positive and the
    unlabelled rows: the row and the feature of each feature present, and how many rows."""
    z = {k: np.bincount(r, w[c], n) + w[-1] for k, (r, c, n) in data.items()}

    def sigmoid(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x, -50, 50)))

    def gradient(kind: str, of_z: np.ndarray) -> np.ndarray:
        r, c, n = data[kind]
        g = of_z / n
        return np.append(np.bincount(c, g[r], len(w) - 1), g.sum())

    rest = np.logaddexp(0, z["u"]).mean() - prior * np.logaddexp(0, z["p"]).mean()
    return (
        prior * np.logaddexp(0, -z["p"]).mean(), rest,
        prior * gradient("p", sigmoid(z["p"]) - 1), gradient("u", sigmoid(z["u"])) - prior * gradient("p", sigmoid(z["p"])),
    )


def _fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, steps: int, rate: float, decay: float, least: int, sure: float) -> Classifier:
    """Full-batch Adam on the non-negative risk. Only features in ``least`` positive rows
    whose log odds against the unlabelled rows are ``sure`` standard errors from 0 have a
    weight: a rare word says nothing about rows outside the sample."""
    both = np.concatenate([*positive, *unlabelled])
    known, column = np.unique(both, return_inverse=True)
    row = np.repeat(np.arange(len(positive) + len(unlabelled)), [len(r) for r in [*positive, *unlabelled]])
    first = row < len(positive)
    seen = np.bincount(column[first], minlength=len(known)) + 0.5
    other = np.bincount(column[~first], minlength=len(known)) + 0.5
    odds = np.log(seen / len(positive)) - np.log(other / len(unlabelled))
    used = np.flatnonzero((seen >= least) & (np.abs(odds) >= sure * np.sqrt(1 / seen + 1 / other)))
    place = np.full(len(known), -1)
    place[used] = np.arange(len(used))
    column = place[column]
    data = {
        "p": (row[first & (column >= 0)], column[first & (column >= 0)], len(positive)),
        "u": (row[~first & (column >= 0)] - len(positive), column[~first & (column >= 0)], len(unlabelled)),
    }

    w, m, v = np.zeros(len(used) + 1), 0.0, 0.0
    w[-1] = np.log(prior / (1 - prior))
    for step in range(1, steps + 1):
        _, rest, g_positive, g_rest = _risk(w, data, prior)
        g = g_positive + g_rest if rest >= 0 else -g_rest
        g[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Classifier(dict(zip(known[used].tolist(), w[:-1].tolist(), strict=True)), float(w[-1]))


def train(
    documents: DataFrame, labels: DataFrame, training: Column, positives: int = 4000, unlabelled: int = 8000,
    prior: float = 0.1, members: int = 3, steps: int = 200,
) -> Classifier | None:
    """The mean of ``members`` classifiers, each from all sampled positives and its own
    part of the unlabelled rows; these are drawn from all texts, toxic ones among them.
    ``training`` says which ids labels may be learned from."""
    known = labels.where(training).where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    tally = known.agg(F.count("*").alias("n"), F.sum(F.when(F.col("toxic") == 1, 1)).alias("toxic")).first()
    if not tally["toxic"]:
        return None
    if 0 < tally["toxic"] < tally["n"]:
        prior = min(max(tally["toxic"] / tally["n"], FLOOR), 1 - FLOOR)
    texts = documents.where(training).select("doc_id", "text")
    toxic = _sample(known.where("toxic = 1").select("doc_id"), positives)
    marked = texts.join(F.broadcast(toxic), "doc_id")  # about ``positives`` ids
    p = _features(marked)
    if not p or not sum(map(len, p)):
        return None
    seen, n = np.unique(np.concatenate(p), return_counts=True)
    frequent = seen[n >= LEAST]
    p = [_within(f, frequent) for f in p]
    u = _features(_sample(texts, unlabelled), frequent)
    parts = [[f for i, f in enumerate(u) if members == 1 or i % members != k] for k in range(members)]
    fitted = [_fit(p, part, prior, steps, 0.1, 2e-4, LEAST, 5.0) for part in parts if part]
    if not fitted:
        return None
    names = set().union(*(c.weights for c in fitted))
    return Classifier(
        {f: sum(c.weights.get(f, 0.0) for c in fitted) / len(fitted) for f in names}, sum(c.bias for c in fitted) / len(fitted)
    )


def scores(classifier: Classifier | None) -> Callable[[Column], Column]:
    """A function of a text column: the score of each text."""
    key = uuid.uuid4().hex
    weights = None if classifier is None else classifier.weights
    bias = 0.0 if classifier is None else classifier.bias

    @F.arrow_udf(T.DoubleType())
    def rate(column: pa.Array) -> pa.Array:
        seen, z = held(key, lambda: Recent(REMEMBER)), []
        for _, texts in text_groups(column):
            if weights is None:
                z += [-np.inf] * len(texts)
                continue
            sets = [set(_WORDS(t.lower())) for t in texts]
            for w in seen.missing(set().union(*sets)):
                seen.new[w] = tuple(f for f in features(w) if f in weights)
            for words in sets:
                used = set().union(*filter(None, map(seen.new.__getitem__, words)))
                z.append(bias + math.fsum(weights[f] for f in used))
        with np.errstate(over="ignore"):
            return pa.array(1 / (1 + np.exp(-np.array(z, float))), pa.float64())

    return rate


def score(documents: DataFrame, classifier: Classifier | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of ``keep``, score and predicted of every row."""
    rated = documents.select(*keep, scores(classifier)(F.col("text")).alias("score"))
    return rated.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_clean(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not scored as toxic, learned from all labels."""
    return documents.where(scores(train(documents, labels, F.lit(True)))(F.col("text")) < 0.5)
