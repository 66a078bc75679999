"""Token counts against the tokenizers library's own."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stridelake.llm import token_counts as T
from tests.llm.fixtures import documents_frame, hard_texts

pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(T.vocabulary_path())


@pytest.fixture(scope="module")
def counter():
    return T.Counter(T.vocabulary_path())


def expected(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_counts_of_odd_texts(library, counter):
    rng = random.Random(1)
    pool = ["a", "A", "é", "é", "ß", "İ", "Σ", "ΑΣ", "日本", "각", " ", " ", "\x1c", "\x85", "'s", "'LL", "'",
            "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "1", "Ⅷ", "½", "😀", "​", "ǅ", "ﬁ", "x" * 50, "ab" * 40,
            "aaaa", "aaaaa", " ", "\n", "\t", "\x00", "_", "-", "...", "don't", "ẞ", "\xad", "ạ̇"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 12))) for _ in range(5000)]
    texts += [t or "" for t in hard_texts()]
    assert counter.counts([t.encode() for t in texts]) == expected(library, texts)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_counts_of_any_text(library, counter, text):
    assert counter.counts([text.encode()]) == expected(library, [text])


def test_long_fragment_without_white_space(library, counter):
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefghij") for _ in range(20_000)) + "ha" * 5000 + "z" * 4001
    assert counter.counts([text.encode()]) == expected(library, [text])


def test_overlapping_places_go_from_the_left(counter):
    tokens = [b"a" * n for n in range(1, 40)]
    together = counter.table.survivors(tokens)
    assert together.tolist() == [int(counter.table.survivors([t])[0]) for t in tokens]


def test_slices_join_to_the_text():
    data = b"one two  three\nfour" * 50 + b"x" * 300
    for size in (1, 7, 100, 10_000):
        assert b"".join(T.slices(data, size)) == data


def test_every_row_of_a_table(spark, library):
    docs = documents_frame(spark)
    rows = docs.select("doc_id", "text").collect()
    for slice_bytes in (T.SLICE, 50):
        found = T.count_digest(T.count_tokens(docs, slice_bytes=slice_bytes), limit=100)
        assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
        tokens = expected(library, [r.text or "" for r in rows])
        want = sorted(((r.doc_id, len((r.text or "").encode()), n, n > 100) for r, n in zip(rows, tokens)), key=str)
        assert sorted(map(tuple, found.collect()), key=str) == want
    assert T.count_tokens(docs.where(F.lit(False))).collect() == []


def test_wrong_vocabulary_is_refused():
    import public_tokenizers as P

    with pytest.raises(ValueError):
        T.Counter(P.path("byte_bpe_50k.json"))
    with pytest.raises(ValueError):
        letters = T.byte_letters()
        vocab = {c + e: i for i, (c, e) in enumerate([(c, e) for c in letters for e in ("", "|")])}
        T.MergeTable(vocab | {"aab": 600, "aa": 601}, [("aa", "b"), ("a", "a")], "|")
