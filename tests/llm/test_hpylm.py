"""Pitman-Yor model: exact base scores, probabilities that sum to one, and a
sampler whose tables follow the exact distribution."""

import math
from collections import Counter
from unittest import mock

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from stridelake.llm import hpylm as H
from stridelake.llm.common import crc_mod
from tests.llm.fixtures import documents_frame, words_of


def stirling(c, t, d):
    if c == t:
        return 1.0
    if t < 1 or t > c:
        return 0.0
    return stirling(c - 1, t - 1, d) + (c - 1 - d * t) * stirling(c - 1, t, d)


def test_alone_is_the_stirling_ratio():
    alone = H.Alone(0.6, top=30)
    for c in range(2, 12):
        for t in range(1, c + 1):
            want = stirling(c - 1, t - 1, 0.6) / stirling(c, t, 0.6)
            assert alone(np.array([c]), np.array([t]))[0] == pytest.approx(want, rel=1e-9)


def test_alone_beyond_the_table_is_close_to_exact():
    small, large = H.Alone(0.7, top=200), H.Alone(0.7, top=800)
    c = np.full(7, 800)
    t = np.array([2, 20, 100, 300, 500, 700, 800])
    assert np.abs(small(c, t) - large(c, t)).max() < 0.01


def test_moves_keep_the_exact_table_distribution():
    d, weight, c = 0.5, 0.8, 5
    rng, alone = np.random.default_rng(1), H.Alone(0.5, top=20)
    counts, t = np.full(40000, c), np.ones(40000, np.int64)
    for _ in range(40):
        t = H.move(rng, counts, t, np.full(40000, weight), d, alone)
    want = np.array([stirling(c, k, d) * weight**k for k in range(1, c + 1)])
    got = np.bincount(t, minlength=c + 1)[1:] / len(t)
    assert np.abs(got - want / want.sum()).max() < 0.012


@pytest.mark.parametrize("c", [5, 20, 32])
def test_draws_follow_the_distribution_that_moves_keep(c):
    d, weight, n = 0.5, 0.8, 20000
    rng, alone = np.random.default_rng(2), H.Alone(0.5, top=20)
    counts, w = np.full(n, c), np.full(n, weight)
    t = np.ones(n, np.int64)
    for _ in range(12 * c):
        t = H.move(rng, counts, t, w, d, alone)
    want = np.bincount(t, minlength=c + 1) / n
    got = np.bincount(H.draw(rng, counts, w, d, alone, cells=1000), minlength=c + 1) / n
    assert len(got) == c + 1 and np.abs(got - want).max() < 0.02
    if c <= 20:
        exact = np.array([stirling(c, k, d) * weight**k for k in range(1, c + 1)])
        assert np.abs(got[1:] - exact / exact.sum()).max() < 0.015


def groups(tables):
    table = pa.concat_tables(tables)
    return {k: table.filter(pc.equal(table["key"], k)) for k in sorted(set(table["key"].to_pylist()))}


def summed(opened, seated):
    return groups([H.later_sums(opened.get(k, H.block_table([])), g) for k, g in seated.items()])


def flow(docs, shards, samples=2, chunk_tokens=50):
    """The operator's steps without Spark; {(word, context): probability}."""
    parts = -(-shards // 2)                                   # groups that sum contexts
    batch = pa.record_batch([pa.array([i for i, _, _ in docs]), pa.array([t for _, t, _ in docs])], ["doc_id", "text"])
    held = {i: h for i, _, h in docs}
    with mock.patch.object(H, "TaskContext") as context:
        context.get.return_value.partitionId.return_value = 2
        sent = groups([pa.Table.from_batches([b])
                       for b in H.encoder(shards, chunk_tokens, held.get)([batch])])
    empty = H.block_table([])
    opened = groups([H.opener(parts)(g) for g in sent.values()])
    first = groups([H.first_sums(g) for g in opened.values()])
    seat = H.sampler(parts, 2, samples, 3, 1.0, 1.0, 5)
    final = summed(opened, groups([seat(g, first.get(k, empty)) for k, g in sent.items()]))
    answer = H.answerer(parts, samples, 1.0, 1.0)
    out = {}
    for k, g in sent.items():
        if k < 0:
            continue
        s = H.Shard(H.blocks(g), parts)
        replies = answer(g, final[k])
        logs = np.concatenate([H.unpack(b)["log"] for b in replies["blob"].to_pylist()])
        words = np.concatenate([np.repeat(H.unpack(b)["w"], H.unpack(b)["n"]) for _, b in H.blocks(g)])
        contexts = np.concatenate([H.from_six_bytes(H.unpack(b)["u"]) for _, b in H.blocks(g)])
        assert len(logs) == len(words) == len(s.where)
        for w, u, x in zip(words.tolist(), contexts.tolist(), logs.tolist()):
            assert out.setdefault((w, u), x) == x  # every chunk hears the same
    return out


@pytest.mark.parametrize("shards", [1, 4])
def test_probabilities_sum_to_one(shards):
    rng = np.random.default_rng(0)
    vocabulary = [f"w{i}" for i in range(12)]
    train = [(i, " ".join(rng.choice(vocabulary, 30, p=np.arange(12, 0, -1) / 78)), False) for i in range(20)]
    seen = sorted({w for _, t, _ in train for w in t.split()})
    ask = [(100, " ".join(x for w in [*seen, "never"] for x in ("w1", w)) + " w1", True)]
    found = flow(train + ask, shards)
    mark = H.xxhash.xxh64_intdigest(b"w1") & int(H.CONTEXT_BITS)
    words = {H.xxhash.xxh64_intdigest(w.encode()) for w in [*seen, "never"]} | {H.xxhash.xxh64_intdigest(H.END)}
    assert sum(10 ** found[(w, mark)] for w in words) == pytest.approx(1.0, abs=1e-5)


def test_tables_do_not_depend_on_the_number_of_shards():
    rng = np.random.default_rng(0)
    share = 1 / np.arange(1, 301) ** 1.3
    texts = [" ".join(f"w{x}" for x in rng.choice(300, 400, p=share / share.sum())) for _ in range(60)]
    batch = pa.record_batch([pa.array(range(60)), pa.array(texts)], ["doc_id", "text"])

    tables = {}
    for shards, parts in ((1, 1), (8, 2)):
        with mock.patch.object(H, "TaskContext") as context:
            context.get.return_value.partitionId.return_value = 0
            sent = groups([pa.Table.from_batches([b]) for b in H.encoder(shards, 5000, lambda i: False)([batch])])
        opened = groups([H.opener(parts)(g) for g in sent.values()])
        state = groups([H.first_sums(g) for g in opened.values()])
        for k in range(7):
            sweep = H.sampler(parts, 4, 3, 4, 1.0, 1.0, 7, k, k + 1)
            seated = [sweep(g, state.get(key, H.block_table([]))) for key, g in sent.items()]
            sent_back = groups(seated)
            assert sum(g.num_rows for g in seated) <= shards * (parts + 2)      # no block for a group without contexts
            state = summed(opened, sent_back)
        tables[shards] = next(x["header"]["C2"] for g in state.values() for src, b in H.blocks(g) if src >= 0
                              for x in [H.unpack(b)] if "header" in x)
    assert tables[8] == pytest.approx(tables[1], rel=0.03)


def test_operator_scores_whole_corpus(spark):
    docs = documents_frame(spark)
    got = sorted(H.score_documents(docs).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"]))
    rows = docs.select("doc_id", "text").collect()
    token = {id(r): [*words_of(r["text"], lower=True), "\n"] for r in rows}
    train = Counter(w for r in rows if crc_mod(r["doc_id"], 7) != 2 for w in token[id(r)])
    n, v = sum(train.values()), len(train)
    want = sorted(((r["doc_id"], crc_mod(r["doc_id"], 7) == 2, len(token[id(r)]),
                    sum(train[w] > 0 for w in token[id(r)]), n,
                    sum(math.log10((train[w] + 1) / (n + v + 1)) for w in token[id(r)])) for r in rows),
                  key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    assert [tuple(g)[:5] for g in got] == [w[:5] for w in want]
    assert [g["base_score"] for g in got] == pytest.approx([w[5] for w in want])
    assert sum(g["score"] for g in got) > sum(g["base_score"] for g in got)
    assert all(g["score"] < 0 for g in got)


def test_shards_exchange_totals_between_sweeps(spark):
    """Scores do not depend on how many shards the words are dealt to."""
    rng = np.random.default_rng(0)
    share = 1 / np.arange(1, 401) ** 1.1
    following = [rng.permutation(400) for _ in range(20)]
    rows = []
    for i in range(150):
        words, at = [], 0
        for x in rng.choice(400, 160, p=share / share.sum()):
            at = following[at % 20][x]
            words.append(f"w{at}")
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).cache()
    size, mean = sum(len(t) for _, t in rows), {}
    for shards in (1, 8):
        got = H.score_documents(docs, chunk_tokens=8000, shard_bytes=-(-size // shards)).collect()
        mean[shards] = sum(r["score"] for r in got) / sum(r["n_tokens"] for r in got)
    docs.unpersist()
    assert abs(mean[8] - mean[1]) < 0.0015


def test_values_are_summed_without_their_hashes():
    """Later exchanges send values alone, in the order of the opening blocks."""
    rng = np.random.default_rng(1)
    batch = pa.record_batch([pa.array(range(30)), pa.array([" ".join(f"w{x}" for x in rng.integers(0, 60, 40)) for _ in range(30)])], ["doc_id", "text"])
    with mock.patch.object(H, "TaskContext") as context:
        context.get.return_value.partitionId.return_value = 0
        sent = groups([pa.Table.from_batches([b]) for b in H.encoder(3, 300, lambda i: False)([batch])])
    opened = groups([H.opener(2)(g) for g in sent.values()])
    shards = {k: H.Shard(H.blocks(g), 2) for k, g in sent.items() if k >= 0}
    values = {k: rng.integers(0, 9, len(s.contexts)) for k, s in shards.items()}
    whole = Counter()
    for k, s in shards.items():
        some = np.flatnonzero(np.bincount(s.context, weights=s.count > 1, minlength=len(s.contexts)))
        whole.update(dict(zip(s.contexts[some].tolist(), values[k][some].tolist())) if not whole else {})
        if k != min(shards):
            for u, x in zip(s.contexts[some].tolist(), values[k][some].tolist()):
                whole[u] += x
    sends = [H.block_table(H.send_contexts(s, k, 2, {"more": values[k][f]}, {"C": 1}, f)) for k, s in shards.items()
             for f in [np.flatnonzero(np.bincount(s.context, weights=s.count > 1, minlength=len(s.contexts)))]]
    assert all("u" not in H.unpack(b) for t in sends for b in t["blob"].to_pylist())
    back = summed(opened, groups(sends))
    for k, s in shards.items():
        head, ctx, _ = H.totals(back[k])
        some = np.flatnonzero(np.bincount(s.context, weights=s.count > 1, minlength=len(s.contexts)))
        assert head == {"C": 3} and ctx["more"].tolist() == [whole[u] for u in s.contexts[some].tolist()]


def test_empty_table(spark):
    assert H.score_documents(documents_frame(spark).limit(0)).count() == 0
