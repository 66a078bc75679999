"""Packing: ids as the tokenizers library gives them, gapless sequences, and
plans that use every piece once."""

import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stridelake.llm import packing as K
from tests.llm.fixtures import documents_frame, hard_texts

P = pytest.importorskip("public_tokenizers")


def reference_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_fragments_give_the_same_ids():
    rng = random.Random(0)
    parts = ["a", "  ", "\n", " ", "\t", "'s", "12", "é", " ", "<|endoftext|>", "!!", "\x1c", "x", " \n ", "word"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    texts += [t or "" for t in hard_texts()]
    own = K.Fragments(*K.vocabulary_paths())
    assert [list(own.ids(t)) for t in texts] == reference_ids(texts)


def test_added_tokens_as_the_library_gives_them(spark):
    from tokenizers import Tokenizer

    rng = random.Random(4)
    parts = ["<|endoftext|>", " ", "  ", "a", "\n", "word", "<|", "|>", "é", "'s", "endoftext"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(500)]
    texts += ["hello <|endoftext|> world", "<|endoftext|>", "<|endoftext|><|endoftext|>x"]
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = [[*e.ids, 0] for e in library.encode_batch(texts, add_special_tokens=False)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in K.pack_documents(docs, with_ids=True).collect()}
    assert [got[i] for i in range(len(texts))] == want


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40), max_size=30), st.integers(60, 90))
def test_plan_uses_every_piece_once(counts, capacity):
    plan = K.pack_counts(dict(counts), capacity)
    used = defaultdict(int)
    for pattern, times in plan:
        assert times > 0 and sum(k * n for k, n in pattern.items()) <= capacity
        for k, n in pattern.items():
            used[k] += n * times
    assert dict(used) == counts
    total = sum(k * n for k, n in counts.items())
    least = max(math.ceil(total / capacity), sum(n for k, n in counts.items() if 2 * k > capacity))
    assert sum(t for _, t in plan) <= 1.5 * least + 1


def test_exact_complements_come_first():
    assert K.pack_counts({70: 1, 30: 1}, 100) == [({70: 1, 30: 1}, 1)]
    assert K.pack_counts({60: 2, 25: 2, 15: 2, 30: 1}, 100) == [({60: 1, 25: 1, 15: 1}, 2), ({30: 1}, 1)]
    assert K.pack_counts({50: 4}, 100) == [({50: 2}, 2)]
    assert sum(t for _, t in K.pack_counts({70: 3, 12: 3, 11: 3, 7: 3}, 100)) == 3


@pytest.mark.parametrize("capacity", [64, 2048])
def test_operator(spark, capacity):
    docs = documents_frame(spark)
    got = K.pack_documents(docs, capacity=capacity, with_ids=True).collect()
    rows = docs.select("doc_id", "text").collect()
    want = []
    for r, ids in zip(rows, reference_ids([r["text"] or "" for r in rows])):
        ids = np.array([*ids, 0], "<u4")
        start = 0
        for piece, length in enumerate([len(ids) % capacity or capacity] + [capacity] * (-(-len(ids) // capacity) - 1)):
            want.append((r["doc_id"], piece, start, length, zlib.crc32(ids[start:start + length].tobytes())))
            start += length
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] for r in got)
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity
    assert len(sequences) <= 1.03 * sum(w[3] for w in want) / capacity + 1
    again = K.pack_documents(docs, capacity=capacity).collect()
    assert sorted(map(str, ((r["doc_id"], r["piece"], r["sequence_id"], r["offset"]) for r in again))) == \
        sorted(map(str, ((r["doc_id"], r["piece"], r["sequence_id"], r["offset"]) for r in got)))


def test_empty_table(spark):
    assert K.pack_documents(documents_frame(spark).limit(0)).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 3), max_size=25), st.integers(1, 40),
       st.lists(st.integers(1, 40), max_size=4))
def test_a_gap_is_filled_whenever_it_can_be(counts, gap, taken):
    """Against every combination of one, two or three lengths."""
    from itertools import combinations_with_replacement

    used = {}
    for k in taken:
        if used.get(k, 0) < counts.get(k, 0):
            used[k] = used.get(k, 0) + 1
    lengths = K.Lengths(counts, 40)
    before = lengths.bits, lengths.turned
    found = lengths.complement(gap, used)

    def fits(c):
        return sum(c) == gap and all(counts.get(k, 0) - used.get(k, 0) >= c.count(k) for k in c)

    possible = [c for n in (1, 2, 3) for c in combinations_with_replacement(sorted(counts), n) if fits(c)]
    assert (found is None) == (not possible) and (found is None or fits(found))
    assert found is None or len(found) == min(map(len, possible))
    assert (lengths.bits, lengths.turned) == before


def test_many_lengths_that_are_used_up():
    """Hundreds of combinations fail before the one that fits."""
    counts = {k: 1 for k in range(100, 900)} | {1500: 1}
    used = {k: 1 for k in range(100, 900) if k not in (433, 299)}
    assert K.Lengths(counts, 2048).complement(433 + 299, used) == (433, 299)
