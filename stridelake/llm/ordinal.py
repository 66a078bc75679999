"""Graded quality by ordinal cumulative-link regression on hashed text.

Grades 0 < 1 < ... < G share one weight vector; ordered thresholds cut the line
it projects on: P(grade <= j) = logistic(threshold_j - f(text)). Thresholds are
a first value plus squared steps, so they stay in order while they are fitted.
From these come the expected grade and the tail probability of a wanted grade,
which selects documents.

Features are hashed: words, word shapes (runs of letter case, digits and signs),
repeats of the word before, and the shares of repeated and symbol-laden words
and lines, all as shares of the text's words, so a text of any length is judged
alike and whole.

Scale. Training collects a bounded sample (``per_grade`` rated documents each).
Scoring is one pass without a shuffle; distinct words are hashed once a chunk.

Defined cases: null and empty texts have the grade of no evidence (all
features 0); without two different grades to learn from every document gets the
only grade; repeated ratings of a document count as their least; extra columns
are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Vocabulary, crc_mod, sample_rows, sampled_texts, small_batches, word_chunks, word_ids

WORD_BUCKETS = 1 << 11
SHAPE_BUCKETS = 1 << 9
DENSE = 4
WIDTH = WORD_BUCKETS + SHAPE_BUCKETS + DENSE
RESULT = "doc_id long, held_out boolean, expected_grade double, score double, kept boolean"
RESULT_ARROW = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("expected_grade", pa.float64()),
                          ("score", pa.float64()), ("kept", pa.bool_())])
#: Classes of bytes for shapes: upper, lower (other letters too), digit, and each sign itself.
CLASS = bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256))
RUNS = re.compile(rb"(.)\1+", re.S)


def columns_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each distinct word: its bucket, its shape's bucket, signs or not."""
    bucket = np.fromiter((xxhash.xxh32_intdigest(w.lower()) % WORD_BUCKETS for w in words), np.int64, len(words))
    shapes = [RUNS.sub(rb"\1", w.translate(CLASS)) for w in words]
    shape = np.fromiter((xxhash.xxh32_intdigest(s, 1) % SHAPE_BUCKETS for s in shapes), np.int64, len(words))
    signs = np.fromiter((not s.strip(b"Aa0.,;:!?'\"()-") == b"" for s in shapes), bool, len(words))
    return bucket, WORD_BUCKETS + shape, signs


def dense_features(ids: np.ndarray, signs: np.ndarray) -> list[float]:
    """Shares of words equal to the word before, seen before, with signs; 1."""
    n = max(1, len(ids))
    return [float((ids[1:] == ids[:-1]).sum()) / n, 1 - len(np.unique(ids)) / n if len(ids) else 0.0,
            float(signs[ids].sum()) / n, float(len(ids) > 0)]


def feature_rows(words: list[bytes], sequences: list[np.ndarray]) -> np.ndarray:
    bucket, shape, signs = columns_of(words)
    out = np.zeros((len(sequences), WIDTH), np.float32)
    for i, ids in enumerate(sequences):
        n = max(1, len(ids))
        out[i] = np.bincount(bucket[ids], minlength=WIDTH) + np.bincount(shape[ids], minlength=WIDTH)
        out[i] /= n
        out[i, -DENSE:] = dense_features(ids, signs)
    return out


def logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Model:
    """Weights shared by all grades, and the grades' ordered thresholds."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray, grades: list[int]):
        self.weights, self.thresholds, self.grades = weights, thresholds, grades

    def tails(self, f: np.ndarray) -> np.ndarray:
        """P(grade is at least the j-th) for each j but the first."""
        return logistic(f[:, None] - self.thresholds[None])

    def expected(self, tails: np.ndarray) -> np.ndarray:
        return self.grades[0] + tails @ np.diff(self.grades).astype(float)


def fit(x: np.ndarray, grade: np.ndarray, *, steps: int = 300, decay: float = 3e-3, rate: float = 0.05) -> Model:
    """Maximum likelihood with an L2 penalty, by Adam on balanced grades."""
    grades = sorted(set(grade.tolist()))
    y = np.searchsorted(grades, grade)
    k = len(grades) - 1
    if k < 1:
        return Model(np.zeros(WIDTH), np.zeros(0), grades)
    size = np.bincount(y)
    case = (1.0 / size[y] / len(grades)).astype(np.float64)
    scale = 1.0 / np.maximum(0.03, np.sqrt((x * x).mean(axis=0)))  # rare features stay small
    x = x * scale.astype(np.float32)
    theta = np.concatenate([np.zeros(WIDTH), [-1.0], np.ones(k - 1)])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        w, first, roots = theta[:WIDTH], theta[WIDTH], theta[WIDTH + 1:]
        cuts = np.concatenate([[first], first + np.cumsum(roots**2)])
        f = x @ w.astype(np.float32)
        at_most = np.hstack([np.zeros((len(x), 1)), logistic(cuts[None] - f[:, None]), np.ones((len(x), 1))])
        rows = np.arange(len(x))
        high, low = at_most[rows, y + 1], at_most[rows, y]
        likely = np.maximum(high - low, 1e-9)
        dh, dl = high * (1 - high) / likely, low * (1 - low) / likely
        g_f = case * (dh - dl)
        g_cut = np.zeros(k + 2)
        np.add.at(g_cut, y + 1, -case * dh)
        np.add.at(g_cut, y, case * dl)
        g_cut = g_cut[1:-1]
        g = np.concatenate([x.T @ g_f.astype(np.float32) + decay * w, [g_cut.sum()],
                            2 * roots * np.cumsum(g_cut[::-1])[::-1][1:]])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta = theta - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    cuts = np.concatenate([[theta[WIDTH]], theta[WIDTH] + np.cumsum(theta[WIDTH + 1:]**2)])
    return Model(theta[:WIDTH] * scale, cuts, grades)


def unfolded(text: str) -> str:
    return text


def train_model(texts: list[str], grade: list[int]) -> Model:
    sequences, vocabulary = [], Vocabulary()
    for text in texts:
        sequences.append(word_ids(vocabulary, text.encode().split()))
    return fit(feature_rows(list(vocabulary), sequences), np.array(grade))


def scorer(model: Model | None, wanted: int, cutoff: float, max_words: int, fold: int):
    def run(batches):
        for rows, _, words, sequences in word_chunks(batches, 1, max_words, normal=unfolded):
            ids = [r[0] for r in rows]
            expected, tail = np.zeros(len(rows)), np.zeros(len(rows))
            if model is not None and len(model.grades) == 1:
                expected[:] = model.grades[0]
                tail[:] = float(model.grades[0] >= wanted)
            elif model is not None:
                bucket, shape, signs = columns_of(words)
                per_word = model.weights[bucket] + model.weights[shape]
                f = np.array([per_word[s].sum() / max(1, len(s)) + np.dot(model.weights[-DENSE:], dense_features(s, signs))
                              for s in sequences])
                tails = model.tails(f)
                expected = model.expected(tails)
                above = [j for j, g in enumerate(model.grades[1:]) if g >= wanted]
                tail = tails[:, above[0]] if above else tail
                tail = np.ones(len(rows)) if model.grades[0] >= wanted else tail
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([crc_mod(i, fold) == 2 for i in ids]), pa.array(expected),
                 pa.array(tail), pa.array(tail >= cutoff)], schema=RESULT_ARROW)
    return run


def grades_of(labels: DataFrame) -> DataFrame:
    """Graded ratings from the two marks: 0 poor, 1 well written but toxic, 2 good."""
    marks = labels.where(F.col("quality").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")) \
        .agg(F.min("quality").cast("int").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).cast("int").alias("toxic"))
    return marks.select("doc_id", F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2).alias("grade"))


def train(docs: DataFrame, ratings: DataFrame, may_learn: Column, *, per_grade: int = 800,
          max_grades: int = 20) -> Model | None:
    """A model from about ``per_grade`` documents of each grade; ``ratings`` has
    doc_id and an integer grade, ``may_learn`` is a column over its doc_id."""
    picked = sample_rows(ratings.where(may_learn), "grade", per_grade, max_grades, 31)
    rows = sampled_texts(docs, picked.select("doc_id", "grade")).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"] or ""))
    return train_model([r["text"] or "" for r in rows], [r["grade"] for r in rows]) if rows else None


def grade_documents(docs: DataFrame, model: Model | None, *, wanted: int = 1, cutoff: float = 0.5,
                    max_words: int = 2_000_000, fold: int = 4) -> DataFrame:
    """``doc_id, held_out, expected_grade, score, kept`` of every document: the
    score is the probability of the ``wanted`` grade or a better one."""
    small_batches(docs.sparkSession)
    return docs.select(docs["doc_id"].cast("long"), docs["text"]) \
        .mapInArrow(scorer(model, wanted, cutoff, max_words, fold), RESULT)
