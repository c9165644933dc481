"""Quality scores by Bradley-Terry pairwise ranking.

Each text becomes a vector of character and word statistics. Preference pairs (a text of label 1 over one of label 0)
fit a linear score by logistic loss on differences of vectors; a quantile of the training scores is the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewise.llm.shared import give_back, small_batches

TRAIN_ROWS = 4000  #: expected number of labelled rows of each label, at most, that the fit uses
PAIRS = 40_000  #: preference pairs drawn from them
SCORE_AT_THRESHOLD = 0.3

_CLASS = np.zeros(256, np.int64)  # of each byte: 0 other, 1 lower, 2 upper, 3 digit, 4 stop or comma, 5 symbol, 6 space, 7 newline, 8 beyond ASCII
for _c in range(33, 127):
    _CLASS[_c] = 5
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[[44, 46]], _CLASS[[32, 9, 13]], _CLASS[10], _CLASS[128:] = 1, 2, 3, 4, 6, 7, 8
N_FEATURES = 9 + 94 + 10


def features(text: str | None) -> np.ndarray:
    """Shares of character classes and of printable ASCII characters, and statistics of words and lines."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    out = np.zeros(N_FEATURES, np.float64)
    if not raw:
        return out
    byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    out[:9] = np.bincount(_CLASS, weights=byte, minlength=9) / len(raw)
    out[9:103] = np.sqrt(byte[33:127] / len(raw))
    found = raw.lower().split()
    if found:
        n = len(found)
        lines = [x for x in raw.split(b"\n") if x.strip()]
        heads = found if n < 3 else list(zip(found, found[1:], found[2:]))
        out[103:] = (
            np.log1p(n) / 10,
            len(set(found)) / n,
            len(set(heads)) / len(heads),
            len(set(lines)) / len(lines),
            np.log1p(n / len(lines)),
            len(raw) / n / 10,
            np.log1p(max(map(len, found))) / 10,
            min(1.0, 20 / n),
            np.log1p(byte[10]) / 10,
            1.0,
        )
    return out


@dataclass(frozen=True)
class Ranker:
    """score = sigmoid(w . (x - mean) / scale - offset); the offset puts the quantile of training scores at 0.3."""

    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    offset: float

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = np.clip((x - self.mean) / self.scale, -8, 8) @ self.w - self.offset
        return 1 / (1 + np.exp(-np.clip(raw, -50, 50)))


def fit(
    x: np.ndarray, y: np.ndarray, quantile: float | None = None, seed: int = 7, ridge: float = 1e-3, weight: np.ndarray | None = None
) -> Ranker:
    """Newton steps on the Bradley-Terry loss of drawn pairs. weight: how many rows each sampled one stands for, 1 by
    default. quantile: weighted share of training scores below the threshold, by default that of label 0. Without both
    labels every score is 0.5."""
    good, bad = x[y == 1], x[y != 1]
    if not len(good) or not len(bad):
        return Ranker(np.zeros(x.shape[1]), np.ones(x.shape[1]), np.zeros(x.shape[1]), 0.0)
    share = np.full(len(x), 1 / len(x)) if weight is None else weight / weight.sum()
    mean = share @ x
    scale = np.sqrt(share @ (x - mean) ** 2)
    scale[scale < 1e-6] = 1
    z = lambda v: np.clip((v - mean) / scale, -8, 8)
    rng = np.random.default_rng(seed)
    d = z(good)[rng.integers(0, len(good), PAIRS)] - z(bad)[rng.integers(0, len(bad), PAIRS)]
    w = np.zeros(x.shape[1])
    for _ in range(12):
        p = 1 / (1 + np.exp(np.clip(d @ w, -50, 50)))
        grad = d.T @ p / len(d) - ridge * w
        hess = (d * (p * (1 - p))[:, None]).T @ d / len(d) + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    raw = z(x) @ w
    order = np.argsort(raw, kind="stable")
    raw = raw[order]
    q = share[y != 1].sum() if quantile is None else quantile
    # Halfway between the scores on either side of the quantile.
    at = int(np.abs(np.cumsum(share[order])[:-1] - q).argmin()) + 1
    threshold = (raw[at - 1] + raw[at]) / 2
    return Ranker(mean, scale, w, float(threshold - np.log(SCORE_AT_THRESHOLD / (1 - SCORE_AT_THRESHOLD))))


def sample_labelled(texts: DataFrame, label: str, rows: int) -> DataFrame:
    """About `rows` rows of each label value, all if there are fewer, picked by a hash of doc_id; `weight` is the number
    of rows of its label that a picked one stands for."""
    sizes = {r[label]: r["n"] for r in texts.groupBy(label).agg(F.count("*").alias("n")).collect()}
    at = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(1_000_000))
    keep, weight = F.lit(False), F.lit(None).cast("double")
    for value, n in sizes.items():
        slots, of_label = max(1, int(min(1.0, rows / n) * 1_000_000)), F.col(label) == F.lit(value)
        keep = keep | (of_label & (at < slots))
        weight = F.when(of_label, 1_000_000 / slots).otherwise(weight)
    return texts.where(keep).withColumn("weight", weight)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, quantile: float | None = None) -> Ranker:
    """docs: doc_id, text. labels: doc_id, quality (0 or 1; others and null are left out; of several labels of a document the
    lower one counts). Repeated documents teach as often as they occur. Empty tables, or one label alone, give a model
    with the score 0.5 for all. Only the vectors of the sampled rows, a fixed number of numbers each, reach the driver.
    Which rows may teach is the caller's choice. Other columns, whatever their names, are not read."""
    small_batches(docs.sparkSession)
    # Of a document with several labels the lower one counts.
    known = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    # Ids of the sample, bounded by `rows`; so no text is shuffled.
    known = sample_labelled(known, "quality", rows)
    found = (
        docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
        .mapInPandas(_vectors, "doc_id long, quality int, weight double, x array<double>").orderBy("doc_id", "x").collect()
    )
    x = np.array([r["x"] for r in found]).reshape(len(found), N_FEATURES)
    return fit(x, np.array([r["quality"] for r in found]), quantile, weight=np.array([r["weight"] for r in found]))


def _vectors(batches: Iterator):
    for b in batches:
        yield b[["doc_id", "quality", "weight"]].assign(x=[features(t) for t in b["text"]])


def _scored(model: Ranker):
    @give_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t) for t in batch.column(1).to_pylist()]).reshape(-1, N_FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], ["doc_id", "score"])

    return run


def score_texts(docs: DataFrame, model: Ranker) -> DataFrame:
    """(doc_id, score, predicted) for every row: score from 0 to 1, predicted 1 from 0.3 upward. Null and empty texts
    have the vector of zeros. Repeated rows give repeated results; other columns are not read."""
    small_batches(docs.sparkSession)
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scored(model), "doc_id long, score double")
        .withColumn("predicted", F.when(F.col("score") >= SCORE_AT_THRESHOLD, 1).otherwise(0).cast("int"))
    )


def scorer(model: Ranker, text: str = "text") -> Column:
    """The score as a column, for filters that keep whole rows where they are."""

    @give_back
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in texts:
            yield pd.Series(model.score(np.array([features(x) for x in t]).reshape(-1, N_FEATURES)))

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        return run(texts)

    return score(F.col(text))
