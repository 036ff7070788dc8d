"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader updates.

A feature is a hashed gram of one or two tokens; a token is a run of letters and digits or a run of
signs, A-Z as a-z, and a token that repeats the one before it, or a word that repeats the word before
a sign, counts as the repeat token. A feature's value is its share of the text's grams, so texts of
any length compare. Scoring is one sparse dot
product a text. The model (``buckets`` weights) is fitted on a bounded sample of labelled rows and
sent to the tasks; its size does not depend on the data.

Null and empty texts have no features and score the bias. Labels that are null or not 0/1 are not
learned from; without any labelled row every score is 0.5. Repeated rows are scored alike, extra
columns are kept, and input columns named ``score`` or ``predicted`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headwater.llm import words as W
from headwater.llm.tables import append_columns, fit_in_one_task, fold, labelled_sample, table

BUCKETS = 1 << 18
SCALE = 30.0
_REPEAT = np.uint64(0xA5A5A5A5DEADBEEF)


@dataclass
class Model:
    bias: float = 0.0
    weights: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS, np.float32))


def features(data: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, text index) of every gram of one or two tokens, and the number of grams of each text."""
    words = W.words_of(data, offsets, W.WORD_OR_SIGN)
    token, text = words.hash, words.text
    if not len(token):
        return np.zeros(0, np.int64), text, np.zeros(words.texts, np.int64)
    same = np.zeros(len(token), bool)
    same[1:] = (token[1:] == token[:-1]) & (text[1:] == text[:-1])
    same[2:] |= (token[2:] == token[:-2]) & (text[2:] == text[:-2]) & (W.ALNUM[data[words.start[2:]]] == 1)
    token = np.where(same, _REPEAT, token)
    pair = np.flatnonzero(text[1:] == text[:-1])
    both = W.mix(token[pair] * np.uint64(3) + W.mix(token[pair + 1]))
    owner = np.concatenate((text, text[pair]))
    bucket = (np.concatenate((token, both)) & np.uint64(buckets - 1)).astype(np.int64)
    return bucket, owner, np.bincount(owner, minlength=words.texts)


def fit(batches: Iterator[pa.RecordBatch], epochs: int = 4, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02) -> Model:
    """Follow-the-regularised-leader over (text, label) rows, in an order set by a hash of the texts."""
    examples = []
    for batch in batches:
        labels = batch.column("label").to_numpy()
        for first, _, data, offsets in W.text_chunks(batch.column("text"), W.SMALL_CHUNK_BYTES):
            bucket, owner, grams = features(data, offsets)
            cells, times = np.unique(owner * BUCKETS + bucket, return_counts=True)
            cuts = np.searchsorted(cells, np.arange(len(offsets)) * BUCKETS)
            for i, n in enumerate(grams):
                own = slice(cuts[i], cuts[i + 1])
                index = (cells[own] % BUCKETS).astype(np.int32)
                order = int(W.mix(np.array([index.sum() * 1000003 + int(n)]).astype(np.uint64))[0])
                examples.append((order, int(labels[first + i]), index, (times[own] * (SCALE / max(1, n))).astype(np.float32)))
    model = Model()
    if not examples:
        return model
    examples.sort(key=lambda e: e[:2])
    z, squares = np.zeros(BUCKETS), np.zeros(BUCKETS)
    bias_z = bias_squares = 0.0
    for _ in range(epochs):
        for _, label, index, value in examples:
            zi, ni = z[index], squares[index]
            root = np.sqrt(ni)
            weight = np.where(np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / ((beta + root) / alpha + l2))
            bias = -bias_z / ((beta + bias_squares**0.5) / alpha)
            error = 1 / (1 + np.exp(-np.clip(bias + weight @ value, -35, 35))) - label
            g = error * value
            z[index] = zi + g - (np.sqrt(ni + g * g) - root) / alpha * weight
            squares[index] = ni + g * g
            bias_z += error - ((bias_squares + error * error) ** 0.5 - bias_squares**0.5) / alpha * bias
            bias_squares += error * error
    model.weights = np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(squares)) / alpha + l2)).astype(np.float32)
    model.bias = -bias_z / ((beta + bias_squares**0.5) / alpha)
    return model


def score_texts(column: pa.Array, model: Model) -> np.ndarray:
    parts = []
    for _, _, data, offsets in W.text_chunks(column, W.SMALL_CHUNK_BYTES):
        bucket, owner, grams = features(data, offsets)
        total = np.bincount(owner, weights=model.weights[bucket], minlength=len(grams))
        parts.append(model.bias + total * SCALE / np.maximum(grams, 1))
    return 1 / (1 + np.exp(-np.clip(np.concatenate(parts), -35, 35))) if parts else np.zeros(0)


def train(docs: DataFrame, labels: DataFrame, where: Column, label: str = "quality", rows: int = 8000) -> Model:
    """A model from about ``rows`` of the labelled rows that ``where`` selects (``rows`` is the bound of the sample)."""
    return fit_in_one_task(labelled_sample(docs, labels, label, "doc_id", where, rows).select("text", "label"), fit)


def classify(docs: DataFrame, model: Model, threshold: float = 0.3, names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """``docs`` with a score (0 to 1) and a prediction (1 from ``threshold`` up), in columns of these names; such
    columns of ``docs`` are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(column: pa.Array) -> list[pa.Array]:
        score = score_texts(column, shared.value)
        return [pa.array(score), pa.array((score >= threshold).astype(np.int32))]

    return append_columns(docs, "text", f"`{names[0]}` double, `{names[1]}` int", compute)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    scored = classify(docs, model)
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")
