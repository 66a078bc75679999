"""Suffix-array dedup against brute force over all strings."""

import hashlib
import random

import numpy as np
import pytest

from stridelake.llm import suffixes as S
from tests.llm.fixtures import documents_frame


def brute_force(rows, length):
    data = [(d, (t or "").encode()) for d, t in rows]
    last = float("inf")
    first = {}
    for d, b in data:
        for i in range(len(b) - length + 1):
            s = b[i:i + length]
            first[s] = min(first.get(s, last), last if d is None else d)
    out = []
    for d, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first[b[i:i + length]] < (last if d is None else d):
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("length, gram, chunk", [(50, 24, 16_000_000), (50, 24, 2_000), (12, 12, 900), (9, 4, 500)])
def test_against_brute_force(spark, length, gram, chunk):
    docs = documents_frame(spark)
    got = S.removal_digest(S.remove_repeats(docs, length=length, gram=gram, chunk_bytes=chunk)).collect()
    want = brute_force([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()], length)
    assert sorted((tuple(r) for r in got), key=str) == want
    assert any(r[2] for r in want) and any(not r[2] for r in want)


def test_documents_keep_their_columns(spark):
    docs = documents_frame(spark)
    cleaned = S.without_repeats(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == docs.count()
    strip = lambda df: sorted(map(str, df.drop("text").collect()))
    assert strip(cleaned) == strip(docs)
    kept = {(r["doc_id"], r["n_bytes"]): r["kept"].decode("utf-8", "ignore") for r in S.remove_repeats(docs).collect()}
    texts = sorted((r["doc_id"] or -1, r["text"]) for r in cleaned.collect())
    assert [t for _, t in texts] == [t for _, t in sorted((d or -1, t) for (d, _), t in kept.items())] or \
        len(kept) < len(texts)  # repeated rows share a key


def test_empty_table(spark):
    docs = documents_frame(spark).limit(0)
    assert S.remove_repeats(docs).count() == 0 and S.without_repeats(docs).count() == 0


def test_two_stage_order_is_the_suffix_array():
    rng = random.Random(2)
    for _ in range(40):
        depth = rng.choice([4, 8, 20])
        text = bytes(rng.choice(b"abc\x01") for _ in range(rng.randint(1, 120)))
        padded = np.frombuffer(text + bytes(depth + 16), np.uint8)
        wanted = np.zeros(len(padded), bool)
        wanted[:len(text)] = True
        order = S.two_stage_order(padded, wanted, depth).tolist()
        assert sorted(order) == list(range(len(text)))
        cut = [bytes(padded[i:i + depth]) for i in order]
        assert cut == sorted(cut)
        common = S.adjacent_prefixes(padded, np.array(order), depth).tolist()
        for a, b, n in zip(cut, cut[1:], common[1:]):
            assert a[:n] == b[:n] and (n == depth or a[n] != b[n])


def test_every_string_holds_an_anchor():
    rng = random.Random(4)
    text = np.frombuffer(bytes(rng.choice(b"abcd") for _ in range(4000)), np.uint8)
    at, h = S.anchors(text, np.array([1500, 1520, 4000]), 30, 12)
    spots = set(at.tolist())
    for stop, begin in ((1500, 0), (4000, 1520)):
        for s in range(begin, stop - 30 + 1):
            assert any(i in spots for i in range(s, s + 19))
    assert not any(1500 <= i < 1520 for i in spots)
    again = {}
    for i, x in zip(at.tolist(), h.tolist()):
        assert again.setdefault(bytes(text[i:i + 12]), x) == x
