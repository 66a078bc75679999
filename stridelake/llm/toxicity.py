"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear SVM.

Kernel. Two words are alike as far as they share subsequences of four letters
(the start of a word counts as a letter), each weighing ``DECAY`` to the power
of the stretch it is spread over, at most ``SPAN`` letters. So a gapped or
inserted-character spelling keeps most of a word's subsequences. The kernel is
normalised by the words' own norms. Runs of single letters are joined to one
word more, which catches spaced-out spellings.

Model. A sentence is as toxic as its most toxic word; a document is judged by
the three most toxic different words of all its sentences, since one word may
look like an insult by chance. Labels are known for documents only, so training picks the
witness word of each toxic document, fits, and picks again (multiple-instance
learning); every word of the sentences of clean documents is an example
against. Landmarks are witness words; a word's Nyström features are its kernel
with them times the inverse root of the landmarks' own kernel matrix, and a
squared-hinge SVM is fitted on these. Since the decision is linear in the
kernel values, and these in the subsequences, it becomes one number for each
subsequence of the landmarks: scoring a word looks its own up and divides by
its norm. A logistic curve over a document's three decisions gives the score.

Scale. Training uses a bounded sample (``max_toxic`` and ``max_clean`` labelled
documents, collected to the driver); the landmarks' table is small and travels
with the job. Scoring is one pass over the documents without a shuffle; words
are scored once for each distinct word of a chunk.

Defined cases: null and empty texts have no word and get the score of no
evidence; without labels of both kinds every score is 0; long words are used
whole; repeated labels of a document count once, toxic if any says so; extra
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, sample_rows, sampled_texts, small_batches, word_chunks

LENGTH, SPAN, DECAY = 4, 6, 0.7
#: Most toxic words of a document that its score weighs.
TOP = 3
RESULT = "doc_id long, held_out boolean, score double, predicted int"
RESULT_ARROW = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()),
                          ("predicted", pa.int32())])
#: Digits and signs that stand for letters, and the punctuation that is dropped.
LOOKALIKES = bytes.maketrans(b"013457@$", b"oieastas")
PUNCTUATION = b"!\"#%&'()*+,-./:;<=>?[\\]^_`{|}~"
#: Letters a to z are 1 to 26, a word's start is 27, other bytes share 28 to 63.
SYMBOLS = np.array([b - 96 if 97 <= b <= 122 else 27 if b == 94 else 28 + b % 36 for b in range(256)], np.int64)


# --- kernel ------------------------------------------------------------------

def laid_out(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of all words, each after a start mark; word of each symbol)."""
    words = [w.translate(LOOKALIKES, PUNCTUATION) for w in words]
    text = np.frombuffer(b"".join(b"^" + w for w in words), np.uint8)
    sizes = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
    return SYMBOLS[text], np.repeat(np.arange(len(words)), sizes)


def subsequences(symbols: np.ndarray, word: np.ndarray):
    """(codes, weights, words) of all subsequences, one offset pattern at a time."""
    for rest in combinations(range(1, SPAN), LENGTH - 1):
        n = len(symbols) - rest[-1]
        if n <= 0:
            continue
        inside = np.flatnonzero(word[:n] == word[rest[-1]:])
        code = symbols[inside]
        for offset in rest:
            code = (code << 6) | symbols[inside + offset]
        yield code, DECAY ** (rest[-1] + 1), word[inside]


def kernel_rows(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, code, value) of the kernel's feature map, equal codes added up."""
    symbols, word = laid_out(words)
    parts = [(w, c, np.full(len(c), v)) for c, v, w in subsequences(symbols, word)]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    owner, code, value = (np.concatenate(x) for x in zip(*parts))
    keys, inverse = np.unique((owner << 24) | code, return_inverse=True)
    return keys >> 24, keys & 0xFFFFFF, np.bincount(inverse, weights=value, minlength=len(keys))


def norms(owner: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    return np.sqrt(np.bincount(owner, weights=value * value, minlength=n))


# --- model -------------------------------------------------------------------

class Model:
    """Subsequence codes that matter with what they add to a decision, the
    decision's bias and the score's curve."""

    def __init__(self, codes: np.ndarray, gains: np.ndarray, bias: float, curve: np.ndarray | None = None):
        self.codes, self.gains, self.bias, self.curve = codes, gains, bias, curve

    def decide(self, words: list[bytes], step: int = 20_000) -> np.ndarray:
        """Decision of each word; blocks of words bound the memory."""
        if not words or not len(self.codes):
            return np.full(len(words), self.bias)
        known = np.zeros(1 << 24, bool)
        known[self.codes] = True
        return np.concatenate([self.decide_block(words[a:a + step], known) for a in range(0, len(words), step)])

    def decide_block(self, words: list[bytes], known: np.ndarray) -> np.ndarray:
        out = np.full(len(words), self.bias)
        symbols, word = laid_out(words)
        touched = np.zeros(len(words), bool)
        for code, _, owner in subsequences(symbols, word):
            touched[owner[known[code]]] = True
        touched = np.flatnonzero(touched)
        if len(touched):
            some = [words[i] for i in touched.tolist()]
            owner, code, value = kernel_rows(some)
            size = norms(owner, value, len(some))
            at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            gain = np.where(self.codes[at] == code, self.gains[at], 0.0) * value
            out[touched] += np.bincount(owner, weights=gain, minlength=len(some)) / np.maximum(size, 1e-12)
        return out

    def strongest(self, decisions: np.ndarray) -> np.ndarray:
        """The TOP largest different decisions, however often each occurs,
        filled up with the bias."""
        best = np.unique(np.append(decisions, self.bias))[::-1][:TOP]
        return np.append(best, np.full(TOP - len(best), self.bias))

    def score(self, tops: np.ndarray) -> np.ndarray:
        """Scores of rows of strongest decisions."""
        return 1 / (1 + np.exp(-np.clip(tops @ self.curve[:-1] + self.curve[-1], -30, 30)))

    def score_words(self, words: list[bytes]) -> float:
        return float(self.score(self.strongest(self.decide(words))[None])[0])


def squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float, rounds: int = 30) -> np.ndarray:
    """Newton's method for an L2-regularised squared-hinge SVM with a bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    hold = ridge * np.eye(x.shape[1])
    hold[-1, -1] = 1e-6
    for _ in range(rounds):
        short = 1 - y * (x @ w)
        on = short > 0
        g = hold @ w - x[on].T @ (weight[on] * y[on] * short[on])
        h = hold + (x[on] * weight[on, None]).T @ x[on]
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_curve(tops: np.ndarray, label: np.ndarray, stand_for: tuple[float, float] = (1.0, 1.0),
              rounds: int = 4000) -> np.ndarray:
    """Logistic curve with rising (non-negative) slopes and Platt's smoothed
    targets, by projected gradient steps. A clean and a toxic document of the
    sample ``stand_for`` so many labelled ones: the score follows their share."""
    up, down = label.sum(), (1 - label).sum()
    target = np.where(label == 1, (up + 1) / (up + 2), 1 / (down + 2))
    x = np.hstack([tops, np.ones((len(tops), 1))])
    w = np.append(np.full(TOP, 1.0 / TOP), 0.0)
    weight = np.where(label == 1, stand_for[1], stand_for[0])
    weight = weight / weight.mean()
    h = 0.25 * (x * weight[:, None]).T @ x / len(x) + 1e-4 * np.eye(TOP + 1)
    step = 1 / np.linalg.eigvalsh(h).max()
    slow = w.copy()
    for t in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(slow @ x.T, -30, 30)))
        new = slow - step * (x.T @ (weight * (p - target)) / len(x) + 1e-4 * slow)
        new[:TOP] = np.maximum(new[:TOP], 0.05)
        slow = new + t / (t + 3) * (new - w)
        w = new
    return w


def joined_letters(words: list[bytes]) -> list[bytes]:
    """Runs of three or more single letters, as one word each."""
    out, run = [], []
    for w in [*words, b"--"]:
        if len(w) == 1:
            run.append(w)
        else:
            if len(run) >= 3:
                out.append(b"".join(run))
            run = []
    return out


def document_words(text: str) -> list[bytes]:
    words = text.lower().encode().split()
    return list(dict.fromkeys(words + joined_letters(words)))


def evidence(docs: list[list[bytes]], label: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Distinct words and how far their contiguous four-letter runs (with the
    word's start) tell toxic documents from clean ones: a first guess."""
    words = list(dict.fromkeys(w for d in docs for w in d))
    number = {w: i for i, w in enumerate(words)}
    symbols, owner = laid_out(words)
    symbols, owner = symbols.astype(np.int32), owner.astype(np.int32)
    n = max(0, len(symbols) - LENGTH + 1)
    inside = np.flatnonzero(owner[:n] == owner[LENGTH - 1:]).astype(np.int32)
    code = symbols[inside]
    for k in range(1, LENGTH):
        code = (code << 6) | symbols[inside + k]
    owner = owner[inside]
    cuts = np.searchsorted(owner, np.arange(len(words) + 1))
    seen = np.zeros((2, 1 << 24), np.uint16)  # by code, in clean and in toxic documents (a bounded sample)
    for d, y in zip(docs, label):
        own = [code[cuts[number[w]]:cuts[number[w] + 1]] for w in d]
        if own:
            seen[int(y), np.unique(np.concatenate(own))] += 1
    clean, toxic = (seen[y, code] / max(1, (label == y).sum()) for y in (0, 1))
    strength = np.where(seen[1, code] >= 2, toxic * np.log((toxic + 0.002) / (clean + 0.002)), 0.0)
    best = np.zeros(len(words))
    np.maximum.at(best, owner, strength)
    return words, best


def gapped(word: bytes, rng) -> bytes:
    """The word with a letter inserted inside, as evasive spellings have."""
    at = int(rng.integers(1, max(2, len(word))))
    return word[:at] + bytes([int(rng.integers(97, 123))]) + word[at:]


def train_model(texts: list[str], label: np.ndarray, *, landmarks: int = 160, rounds: int = 2,
                witnesses: int = 2, ridge: float = 0.02, variants: int = 2, seed: int = 29,
                stand_for: tuple[float, float] = (1.0, 1.0)) -> Model | None:
    if not (label == 1).any() or not (label == 0).any():
        return None
    docs = [document_words(t) for t in texts]
    words, guess = evidence(docs, label)
    number = {w: i for i, w in enumerate(words)}
    ids = [np.array([number[w] for w in d], np.int64) for d in docs]
    clean = Counter(i for d, y in zip(ids, label) if y == 0 for i in d.tolist())
    decision, model = guess, None
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        picked = Counter()
        for d, y in zip(ids, label):
            if y == 1 and len(d):
                for i in d[np.argsort(-decision[d], kind="stable")[:witnesses]].tolist():
                    if decision[i] > 0:
                        picked[i] += 1
        if not picked:
            return None
        marks = [i for i, _ in sorted(picked.items(), key=lambda x: (-x[1], words[x[0]]))[:landmarks]]
        owner, code, value = kernel_rows([words[i] for i in marks])
        codes, at = np.unique(code, return_inverse=True)
        phi = np.zeros((len(marks), len(codes)))
        phi[owner, at] = value
        phi /= np.maximum(1e-12, np.linalg.norm(phi, axis=1, keepdims=True))
        values, vectors = np.linalg.eigh(phi @ phi.T)
        good = values > 1e-4
        root = vectors[:, good] / np.sqrt(values[good])

        def features(some: list[bytes], step: int = 4000) -> np.ndarray:
            return np.vstack([feature_block(some[a:a + step]) for a in range(0, len(some), step)])

        def feature_block(some: list[bytes]) -> np.ndarray:
            own, c, v = kernel_rows(some)
            size = np.maximum(1e-12, norms(own, v, len(some)))
            place = np.minimum(np.searchsorted(codes, c), len(codes) - 1)
            hit = codes[place] == c
            k = np.zeros((len(some), len(marks)))
            for a in range(0, int(hit.sum()), 20_000):
                at = np.flatnonzero(hit)[a:a + 20_000]
                np.add.at(k, own[at], (phi[:, place[at]] * v[at]).T)
            return k / size[:, None] @ root

        probe = Model(codes, np.ones(len(codes)), 0.0)
        near = probe.decide([words[i] for i in clean])
        against = [i for i, x in zip(clean, near) if x > 0.15]
        positive = [i for i in picked if i not in clean or picked[i] > 3 * clean[i]]
        if not positive:
            return None
        # virtual examples: evasive spellings of the witnesses, at half weight
        evasive = [gapped(words[i], rng) for i in positive for _ in range(variants)]
        chosen = [words[i] for i in positive] + evasive + [words[i] for i in against]
        x = np.vstack([features(chosen), np.zeros((1, root.shape[1]))])
        n = len(positive) + len(evasive)
        y = np.array([1.0] * n + [-1.0] * (len(against) + 1))
        plus = np.array([float(picked[i]) for i in positive])
        minus = np.array([float(clean[i]) for i in against] + [1.0])
        weight = 100 * np.concatenate([
            plus / plus.sum(), np.repeat(plus, variants) / plus.sum() * 0.5 / max(1, variants),
            np.minimum(minus / minus.sum() + 1.0 / len(minus), 0.05)])
        w = squared_hinge(x, y, weight, ridge)
        model = Model(codes, phi.T @ (root @ w[:-1]), float(w[-1]))
        decision = model.decide(words)
    model.curve = fit_curve(np.array([model.strongest(decision[d]) for d in ids]), label.astype(float),
                            stand_for)
    return model


# --- scoring -----------------------------------------------------------------

def spaced_words(words: list[bytes], sequences: list[np.ndarray]) -> tuple[list[bytes], list[int]]:
    """Joined runs of single letters and the document of each."""
    single = np.array([len(w) == 1 for w in words] + [False])
    found, owners = [], []
    for i, s in enumerate(sequences):
        if len(s) >= 3 and single[s].any():
            for w in joined_letters([words[k] for k in s.tolist()]) if single[s].sum() >= 3 else ():
                found.append(w)
                owners.append(i)
    return found, owners


def scorer(model: Model | None, threshold: float, max_words: int, fold: int):
    def run(batches):
        for rows, _, words, sequences in word_chunks(batches, 1, max_words):
            ids = [r[0] for r in rows]
            score = np.zeros(len(rows))
            if model is not None:
                decisions = model.decide(words)
                extra, owners = spaced_words(words, sequences)
                more = dict.fromkeys(owners, np.zeros(0))
                for i, x in zip(owners, model.decide(extra).tolist()):
                    more[i] = np.append(more[i], x)
                top = np.array([model.strongest(np.append(decisions[s], more[i]) if i in more else decisions[s])
                                for i, s in enumerate(sequences)])
                score = model.score(top)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([crc_mod(i, fold) == 2 for i in ids]),
                 pa.array(score), pa.array((score >= threshold).astype(np.int32))], schema=RESULT_ARROW)
    return run


def train(docs: DataFrame, labels: DataFrame, may_learn: Column, *, max_toxic: int = 600,
          max_clean: int = 900, **options) -> Model | None:
    """A model from a bounded sample of the labelled documents that ``may_learn``
    (a column over ``doc_id``) allows."""
    marks = labels.where(F.col("toxic").isNotNull() & may_learn) \
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    # equal shares of both kinds would starve the commoner: sample each to its bound
    picked = sample_rows(marks.where("toxic = 1"), "toxic", max_toxic, 1, 23) \
        .unionByName(sample_rows(marks.where("toxic = 0"), "toxic", max_clean, 1, 23))
    rows = sampled_texts(docs, picked.select("doc_id", "toxic")).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"] or ""))
    label = np.array([r["toxic"] for r in rows], np.int64)
    all_marks = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    # the root: half way between the sample's balance and the labels' own, so
    # that one clear insult still weighs enough
    stand_for = tuple((all_marks.get(y, 0) / max(1, int((label == y).sum()))) ** 0.5 for y in (0, 1))
    return train_model([r["text"] or "" for r in rows], label, stand_for=stand_for, **options) if rows else None


def score_toxicity(docs: DataFrame, model: Model | None, *, threshold: float = 0.3, max_words: int = 2_000_000,
                   fold: int = 4) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document's whole text."""
    small_batches(docs.sparkSession)
    return docs.select(docs["doc_id"].cast("long"), docs["text"]) \
        .mapInArrow(scorer(model, threshold, max_words, fold), RESULT)
