"""Scores of operators 6, 8 and 10 against the same formulas written plainly, a
document at a time, without arrays, chunks or shared vocabularies."""

import math
import os
import re
from fractions import Fraction

import pytest
import xxhash

from stridelake.llm import langid, mixing, ordinal
from stridelake.llm.common import crc_mod_column, documents, labels
from tests.llm.fixtures import documents_frame, words_of

SMALL = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver test data not present")
MASK = (1 << 64) - 1


def mixed(x):
    x ^= x >> 31
    x = x * 0x9E3779B97F4A7C15 & MASK
    x ^= x >> 29
    x = x * 0xD6E8FEB86659FD93 & MASK
    return x ^ x >> 32


def buckets_of(word):
    marked = b"_" + word + b"_"
    for n in langid.GRAMS:
        for i in range(len(marked) - n + 1):
            h = n
            for byte in marked[i:i + n]:
                h = (h * 257 + byte) & MASK
            yield (mixed(h) >> 40) % langid.BUCKETS


def language(model, text):
    """(language, share, second share) of a text."""
    grams = [b for w in (text or "").lower().encode().split() for b in buckets_of(w)]
    if not grams or not any(c.isalpha() for c in text):
        return "und", 0.0, 0.0
    loss = []
    for code in model.code:
        total = 0.0
        for bit, side in enumerate(code):
            margin = math.fsum(model.weights[b, bit] for b in grams) / len(grams) + model.weights[-1, bit]
            total += model.trust[bit] * math.log1p(math.exp(-side * max(-30, min(30, margin))))
        loss.append(total)
    share = [math.exp(-len(model.trust) * (x - min(loss))) for x in loss]
    share = [x / sum(share) for x in share]
    best = share.index(max(share))
    return model.langs[best], share[best], sorted(share)[-2]


def test_language_scores(spark):
    docs = documents(spark, SMALL)
    model = langid.train(docs, crc_mod_column(docs["doc_id"], 4) != 2, per_language=60)
    assert len(model.langs) >= 3
    some = documents_frame(spark).select("doc_id", "text").unionByName(docs.select("doc_id", "text").orderBy("doc_id").limit(60))
    want = sorted((str(r.doc_id), *language(model, r.text)) for r in some.collect())
    got = sorted((str(r.doc_id), r.lang_pred, r.score, r.ambiguous) for r in langid.identify(some, model, ambiguity=0.3).collect())
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], abs=1e-9)
    assert [g[3] for g in got] == [w[3] > 0.3 * w[2] for w in want]


def grade(model, text):
    """(expected grade, chance of grade 1 or better)."""
    words = (text or "").encode().split()
    n = max(1, len(words))
    f = signed = 0.0
    for w in words:
        shape = re.sub(rb"(?s)(.)\1+", rb"\1", bytes(ordinal.CLASS[b] for b in w))
        f += model.weights[xxhash.xxh32_intdigest(w.lower()) % ordinal.WORD_BUCKETS]
        f += model.weights[ordinal.WORD_BUCKETS + xxhash.xxh32_intdigest(shape, 1) % ordinal.SHAPE_BUCKETS]
        signed += any(chr(b) not in "Aa0.,;:!?'\"()-" for b in shape.strip(b"Aa0.,;:!?'\"()-"))
    shares = [sum(a == b for a, b in zip(words, words[1:])) / n, 1 - len(set(words)) / n if words else 0.0, signed / n, float(bool(words))]
    f = f / n + sum(w * x for w, x in zip(model.weights[-4:], shares))
    tails = [1 / (1 + math.exp(-max(-30, min(30, f - cut)))) for cut in model.thresholds]
    steps = [b - a for a, b in zip(model.grades, model.grades[1:])]
    return model.grades[0] + sum(t * s for t, s in zip(tails, steps)), tails[0]


def test_grades(spark):
    docs, ratings = documents(spark, SMALL), ordinal.grades_of(labels(spark, SMALL))
    model = ordinal.train(docs, ratings, crc_mod_column(ratings["doc_id"], 4) != 2, per_grade=60)
    assert model.grades == [0, 1, 2] and list(model.thresholds) == sorted(model.thresholds)
    some = documents_frame(spark).select("doc_id", "text").unionByName(docs.select("doc_id", "text").orderBy("doc_id").limit(60))
    want = sorted((str(r.doc_id), *grade(model, r.text)) for r in some.collect())
    got = sorted((str(r.doc_id), r.expected_grade, r.score) for r in ordinal.grade_documents(some, model).collect())
    assert [g[0] for g in got] == [w[0] for w in want]
    assert [g[1] for g in got] == pytest.approx([w[1] for w in want], abs=1e-6)
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], abs=1e-6)


def plain_targets(sizes, weights):
    """Shares of all sizes, none above three times its source, in fractions."""
    targets, full = {}, set()
    while True:
        rest = Fraction(sum(sizes.values())) - sum(3 * sizes[s] for s in full)
        open_ = {s for s in sizes if s not in full}
        for s in open_:
            targets[s] = rest * weights[s] / sum(weights[k] for k in open_)
        above = {s for s in open_ if targets[s] > 3 * sizes[s]}
        if not above:
            return {s: Fraction(3 * sizes[s]) if s in full else targets[s] for s in sizes}
        full |= above


@pytest.mark.parametrize("table", ["documents", "hard"])
def test_mix(spark, table):
    docs = documents(spark, SMALL) if table == "documents" else documents_frame(spark)
    rows = docs.select("doc_id", "text", "source").collect()
    size = lambda text: len(words_of(text))
    sources = sorted({r.source for r in rows}, key=lambda s: (s is None, s or ""))
    weights = {s: 1 + i % 3 for i, s in enumerate(sources)}
    sizes = {s: sum(size(r.text) for r in rows if r.source == s) for s in sources}
    targets = plain_targets(sizes, weights)
    got = mixing.mixing_digest(mixing.mix_sources(docs)).collect()
    want = sorted((str(r.doc_id), size(r.text), sizes[r.source]) for r in rows)
    assert sorted((str(r.doc_id), r["size"], r.source_size) for r in got) == want
    by_size = {(str(r.doc_id), size(r.text)): r.source for r in rows}
    taken = dict.fromkeys(sources, 0)
    for r in got:
        source = by_size[(str(r.doc_id), r["size"])]
        assert r.target == pytest.approx(float(targets[source]), rel=1e-9)
        assert 0 <= r.taken <= 3 * r["size"] and (not r["size"] or r.taken % r["size"] == 0)
        # Whole copies below and above the rate, nothing else.
        rate = targets[source] / sizes[source] if sizes[source] else 0
        assert not r["size"] or r.taken // r["size"] in (math.floor(rate), math.ceil(rate))
        taken[source] += r.taken
    if table == "documents":
        for s in sources:
            assert abs(taken[s] - targets[s]) <= 0.01 * targets[s]
