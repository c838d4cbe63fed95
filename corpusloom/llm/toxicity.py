"""Toxicity by FTRL-proximal logistic regression over hashed words, word pairs and skip-grams.

Each coordinate has its own learning rate, and the L1 term leaves most weights at exactly 0, so that what is broadcast
is small. A feature counts once per text, however often and wherever it stands.

Cases: null text counts as empty; an empty text gets the intercept's score; without labels of both kinds the score is the
share of toxic labels, one each assumed; null or repeated ids and empty tables are no special case; very long texts are
read in blocks; further columns pass through, but one named like the score's, which is replaced.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.llm.samples import fit, held_out, labelled
from corpusloom.plans.shared import ship, spread

#: Labelled rows that the model is fitted on, characters of text of them, passes over them.
SAMPLE_ROWS, SAMPLE_CHARS, EPOCHS = 16_000, 96 << 20, 4
BITS, ALPHA, BETA, L1, L2, BIAS_RATE = 20, 1.0, 1.0, 8.0, 0.0, 0.01
#: Sums are clipped here before they are calibrated.
CLIP = 12.0
BLOCK, CACHED = 1 << 20, 400_000
_WORD, _GAP = re.compile(r"[^\W\d_]+"), re.compile(r"[\W\d_]")
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


class _Ids(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= CACHED:
            self.clear()
        n = self[word] = zlib.crc32(word.encode("utf-8", "replace"))
        return n


_ids = _Ids()


def _slots(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _MIX[0] + np.uint64(salt)
    return ((x ^ (x >> np.uint64(32))) * _MIX[1]) >> np.uint64(64 - BITS)


def features(text: str) -> Iterator[np.ndarray]:
    """Slots of a text's words, pairs of neighbours and pairs with a word between, block by block."""
    text = text.lower()
    at, last = 0, np.empty(0, np.uint64)
    while at < len(text):
        end = len(text)
        if end - at > BLOCK and (gap := _GAP.search(text, at + BLOCK)):
            end = gap.end()
        words = _WORD.findall(text, at, end)
        a = np.fromiter(map(_ids.__getitem__, words), np.uint64, len(words))
        joined = np.concatenate([last, a])
        # Pairs within the part that the block before had are given again; that does no harm as a feature counts once.
        yield np.concatenate([_slots(a, 1), _slots(joined[:-1] * _MIX[1] + joined[1:] * _MIX[2], 2), _slots(joined[:-2] * _MIX[3] + joined[2:] * _MIX[4], 3)]).astype(np.int64)
        last, at = joined[-2:], end


def _calibrated(s: np.ndarray, y: np.ndarray, rounds: int = 30) -> tuple[float, float]:
    """Intercept and slope that turn sums, shrunk by the L1 term, into log odds."""
    x, w = np.c_[np.ones(len(s)), s], np.array([0.0, 1.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (p - y) + 1e-3 * w)
    return float(w[0]), float(w[1])


def train(rows: Iterator[tuple[str, int]], max_chars: int = SAMPLE_CHARS, epochs: int = EPOCHS) -> bytes:
    """Weights after ``epochs`` passes over the rows, but for those beyond ``max_chars`` characters of text."""
    data, taken, labels = [], 0, [0, 0]
    for text, label in rows:
        parts = list(features(text))
        data.append((np.unique(np.concatenate(parts)).astype(np.int32) if parts else np.empty(0, np.int32), label))
        labels[label] += 1
        taken += len(text)
        if taken > max_chars:
            break
    prior = (labels[1] + 1) / (sum(labels) + 2)
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias = base = float(np.log(prior / (1 - prior)))
    if not all(labels):
        return pickle.dumps((np.empty(0, np.int32), np.empty(0, np.float32), base, 0.0, 1.0))
    for _ in range(epochs):
        for i, y in data:
            zi, root = z[i], np.sqrt(n[i])
            w = np.where(np.abs(zi) > L1, -(zi - np.sign(zi) * L1) / ((BETA + root) / ALPHA + L2), 0.0)
            g = 1 / (1 + np.exp(-np.clip(bias + w.sum(), -30, 30))) - y
            z[i] = zi + g - (np.sqrt(n[i] + g * g) - root) / ALPHA * w
            n[i] += g * g
            bias -= BIAS_RATE * g
    kept = np.flatnonzero(np.abs(z) > L1)
    w = -(z[kept] - np.sign(z[kept]) * L1) / ((BETA + np.sqrt(n[kept])) / ALPHA + L2)
    dense = np.zeros(1 << BITS)
    dense[kept] = w
    sums = np.clip([bias + dense[i].sum() for i, _ in data], -CLIP, CLIP)
    at, slope = _calibrated(sums, np.array([y for _, y in data], float))
    return pickle.dumps((kept.astype(np.int32), w.astype(np.float32), bias, at, slope))


class Scorer:
    def __init__(self, raw: bytes):
        slots, weights, self.bias, self.at, self.slope = pickle.loads(raw)
        self.weights = np.zeros(1 << BITS, np.float32)
        self.weights[slots] = weights

    def score(self, text: str) -> float:
        hit = [i[self.weights[i] != 0] for i in features(text)]
        total = self.bias + (float(self.weights[np.unique(np.concatenate(hit))].sum()) if hit else 0.0)
        return float(1 / (1 + np.exp(-np.clip(self.at + self.slope * np.clip(total, -CLIP, CLIP), -30, 30))))


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = SAMPLE_ROWS, max_chars: int = SAMPLE_CHARS, epochs: int = EPOCHS) -> bytes:
    """The model, fitted on at most so many labelled rows and characters of their text."""
    return fit(labelled(docs, labels, "toxic", max_rows), partial(train, max_chars=max_chars, epochs=epochs))


def score_toxicity(docs: DataFrame, model: bytes, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability that its text is toxic."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shared.value)
        for texts in batches:
            yield pd.Series([scorer.score(t) for t in texts], dtype="float64")

    return docs.withColumn(name, score(F.coalesce(F.col(text_col), F.lit(""))))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "text")
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = score_toxicity(docs, model)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
