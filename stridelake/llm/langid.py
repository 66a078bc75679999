"""Language identification by error-correcting output codes.

Each language has a codeword of bits; a binary classifier over hashed
character n-grams predicts each bit. A text's language is the codeword with the
least loss, bits weighing as much as their classifiers are reliable on the
training sample (loss-weighted decoding). The second best codeword measures
ambiguity. Few languages get the exhaustive code (every way to split them in
two); more get random codewords at least 10 log2 of their number long, those
with the largest least distance out of several draws.

Training uses a bounded sample: about ``per_language`` labelled documents of a
language, whole and as short pieces, collected to the driver. Prediction is one
pass over the documents; n-grams are scored once for each distinct word of a
chunk.

Defined cases: null texts and texts without a letter are ``und`` with score 0,
and so is every text if there is nothing to learn from; equal losses go to the
first language in order; extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Vocabulary, crc_mod, mix64, sample_rows, small_batches, word_chunks, word_ids

BUCKETS = 1 << 12
GRAMS = (1, 2, 3)
#: Share of the first language's weight that makes the second one a rival.
AMBIGUITY = 0.8
RESULT = "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean"
RESULT_ARROW = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()),
                          ("score", pa.float64()), ("ambiguous", pa.bool_())])


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """One row of -1 and 1 for each class."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 6:
        splits = [s for k in range(1, n) for s in combinations(range(n), k) if 0 in s]
        code = -np.ones((n, len(splits)))
        for bit, members in enumerate(splits):
            code[list(members), bit] = 1
        return code
    rng, best, least = np.random.default_rng(seed), None, -1
    for _ in range(50):
        code = rng.choice([-1.0, 1.0], size=(n, int(np.ceil(10 * np.log2(n)))))
        distance = ((code[:, None] != code[None]).sum(-1) + np.eye(n, dtype=int) * code.shape[1]).min()
        distance = -1 if (np.abs(code.sum(0)) == n).any() else distance
        if best is None or distance > least:
            best, least = code, distance
    return best


def gram_buckets(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, word of each) of all n-grams of ``_word_`` (bytes)."""
    text = np.frombuffer(b"_" + b"__".join(words) + b"_", np.uint8)
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    word = np.repeat(np.arange(len(words)), sizes)
    found, owners = [], []
    for n in GRAMS:
        h = np.full(len(text) - n + 1, n, np.uint64)
        for k in range(n):
            h = h * np.uint64(257) + text[k:len(text) - n + 1 + k]
        inside = word[:len(h)] == word[n - 1:]
        found.append((mix64(h[inside]) >> np.uint64(40)).astype(np.int64) % BUCKETS)
        owners.append(word[:len(h)][inside])
    return np.concatenate(found), np.concatenate(owners)


def word_matrix(words: list[bytes], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each word, its n-grams' weights summed for each bit, and their number."""
    buckets, owner = gram_buckets(words)
    sums = np.stack([np.bincount(owner, weights=w[buckets], minlength=len(words)) for w in weights.T], axis=1)
    return sums, np.bincount(owner, minlength=len(words))


def features(texts: list[str]) -> np.ndarray:
    out = np.zeros((len(texts), BUCKETS), np.float32)
    for i, text in enumerate(texts):
        vocabulary = Vocabulary()
        ids = word_ids(vocabulary, text.lower().encode().split())
        if len(ids):
            buckets, owner = gram_buckets(list(vocabulary))
            out[i] = np.bincount(buckets, weights=np.bincount(ids)[owner], minlength=BUCKETS)
    return out / np.maximum(1, out.sum(axis=1, keepdims=True))


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 150, decay: float = 1e-6) -> np.ndarray:
    """Weights (last row: bias) of a logistic classifier for each column of y."""
    w, bias = np.zeros((x.shape[1], y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
    scale = np.float32(1.0 / np.sqrt((x * x).mean(axis=0).max() + 1e-12))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), np.zeros_like(bias), np.zeros_like(bias)
    for t in range(1, steps + 1):
        margin = y * (scale * (x @ w) + bias)
        pull = -y / (1 + np.exp(np.clip(margin, -30, 30))) / len(x)
        g, gb = scale * (x.T @ pull) + decay * w, pull.sum(axis=0)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        fix, fix2 = 1 - 0.9**t, 1 - 0.99**t
        w -= 0.3 * (m / fix) / (np.sqrt(v / fix2) + 1e-9)
        bias -= 0.3 * (mb / fix) / (np.sqrt(vb / fix2) + 1e-9)
    return np.vstack([scale * w, bias]).astype(np.float64)


class Model:
    """Languages, their codewords, the bits' classifiers and reliabilities."""

    def __init__(self, texts: list[str], langs: list[str], seed: int = 3, pieces: int = 2):
        self.langs = sorted(set(langs))
        self.code = codewords(len(self.langs))
        self.weights = np.zeros((BUCKETS + 1, self.code.shape[1]))
        self.trust = np.full(self.code.shape[1], 1.0 / max(1, self.code.shape[1]))
        if len(self.langs) < 2:
            return
        rng, samples, owner = np.random.default_rng(seed), [], []
        for text, lang in zip(texts, langs):
            words = text.split()
            starts = rng.integers(0, max(1, len(words) - 6), pieces)
            samples += [text, *(" ".join(words[s:s + int(rng.integers(2, 12))]) for s in starts)]
            owner += [self.langs.index(lang)] * (1 + pieces)
        y = self.code[owner].astype(np.float32)
        x = features(samples)
        self.weights = logistic(x, y)
        right = ((x @ self.weights[:-1] + self.weights[-1]) * y > 0).mean(axis=0)
        self.trust = np.log(np.clip(right, 0.501, 0.999) / np.clip(1 - right, 0.001, 0.499))
        self.trust /= self.trust.sum()

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language, its share, share of the second) by weighted logistic loss."""
        signed = np.clip(margins, -30, 30)[:, None, :] * self.code[None]
        loss = (np.logaddexp(0, -signed) * self.trust).sum(axis=2)
        share = np.exp(-self.code.shape[1] * (loss - loss.min(axis=1, keepdims=True)))
        share /= share.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        top = np.sort(share, axis=1)
        return best, top[:, -1], top[:, -2] if share.shape[1] > 1 else np.zeros(len(share))


def predictor(model: Model | None, max_words: int, ambiguity: float, fold: int):
    def run(batches):
        for rows, letters, words, sequences in word_chunks(batches, 1, max_words):
            n = np.array([len(s) for s in sequences], np.int64)
            names, scores, unsure = ["und"] * len(rows), np.zeros(len(rows)), np.zeros(len(rows), bool)
            if model is not None and words:
                sums, grams = word_matrix(words, model.weights[:-1])
                ids, starts = np.concatenate(sequences), np.cumsum(n) - n
                total = np.append(0, np.cumsum(grams[ids]))
                total = total[starts + n] - total[starts]
                margins = np.empty((len(rows), sums.shape[1]))
                for bit in range(sums.shape[1]):
                    run_sum = np.append(0.0, np.cumsum(sums[ids, bit]))
                    margins[:, bit] = (run_sum[starts + n] - run_sum[starts]) / np.maximum(1, total)
                best, share, second = model.decode(margins + model.weights[-1])
                known = np.array(letters) & (n > 0)
                scores = np.where(known, share, 0.0)
                unsure = known & (second > ambiguity * share)
                names = [model.langs[b] if k else "und" for b, k in zip(best.tolist(), known.tolist())]
            ids = [r[0] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([crc_mod(i, fold) == 2 for i in ids]),
                 pa.array(names, pa.string()), pa.array(scores), pa.array(unsure)], schema=RESULT_ARROW)
    return run


def training_rows(docs: DataFrame, may_learn: Column, per_language: int, max_languages: int) -> DataFrame:
    rows = docs.where(may_learn & F.col("lang").isNotNull() & F.col("text").isNotNull()) \
        .select("lang", F.col("doc_id").cast("long").alias("doc_id"), "text")
    if rows.select("lang").distinct().limit(max_languages + 1).count() > max_languages:
        raise ValueError(f"more than {max_languages} languages; raise max_languages")
    keys = sample_rows(rows.select("lang", "doc_id"), "lang", per_language, max_languages, 17)
    return rows.join(F.broadcast(keys.distinct()), ["lang", "doc_id"])


def train(docs: DataFrame, may_learn: Column, *, per_language: int = 300, max_languages: int = 200) -> Model | None:
    """A model from about ``per_language`` documents of each language; more
    languages than ``max_languages``, which bounds the sample, are an error."""
    found = training_rows(docs, may_learn, per_language, max_languages).select("lang", "text").collect()
    found.sort(key=lambda r: (r["lang"], r["text"]))
    return Model([r["text"] for r in found], [r["lang"] for r in found]) if found else None


def identify(docs: DataFrame, model: Model | None, *, ambiguity: float = AMBIGUITY, max_words: int = 2_000_000,
             fold: int = 4) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, ambiguous`` of every document;
    ambiguous: the second language has over ``ambiguity`` of the first's share."""
    small_batches(docs.sparkSession)
    return docs.select(docs["doc_id"].cast("long"), docs["text"]) \
        .mapInArrow(predictor(model, max_words, ambiguity, fold), RESULT)


def accepter(model: Model | None, names: list[str], at: int, max_words: int, ambiguity: float):
    """Passes the rows whose language is known and clear, unchanged."""
    inner = predictor(model, max_words, ambiguity, 4)

    def run(batches):
        for batch in batches:
            only = pa.RecordBatch.from_arrays([pa.array([0] * batch.num_rows, pa.int64()), batch.column(at)], ["i", "text"])
            found = pa.Table.from_batches(list(inner([only])), schema=RESULT_ARROW)
            keep = [n != "und" and not a for n, a in zip(found["lang_pred"].to_pylist(), found["ambiguous"].to_pylist())]
            yield batch.filter(pa.array(keep, pa.bool_()))
    return run


def with_known_language(docs: DataFrame, model: Model | None, *, ambiguity: float = AMBIGUITY) -> DataFrame:
    """The documents whose language is neither unknown nor ambiguous."""
    small_batches(docs.sparkSession)
    return docs.mapInArrow(accepter(model, docs.columns, docs.columns.index("text"), 2_000_000, ambiguity), docs.schema)
