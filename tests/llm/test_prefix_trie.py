"""The prefix trie against a recursive one, whatever the runs' lengths."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from stridelake.llm import prefix_trie as T

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, key string, sizes long, node_id long, kind string"


def brute(rows, family=5, longest=8):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)} {role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append(((turn is not None, turn or 0), digest, (role, text)))
    own = {c: [x for _, _, x in sorted(turns)] for c, turns in own.items()}
    whole, members, children, out = {}, {}, {}, []
    for c, turns in own.items():
        base = abs(c) // family * family * (1 if c >= 0 else -1)
        h = zlib.crc32(str(c).encode()) % (longest + 1)
        whole[c] = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(whole[c]) + 1):
            members.setdefault(whole[c][:d], []).append(c)
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    below = {}
    for node in sorted(members, key=len, reverse=True):
        kids = children.get(node, [])
        saved = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        below[node] = (sum(below[k][0] for k in kids) or 1, saved + sum(below[k][1] for k in kids))
        ends = ",".join(str(c) for c in sorted(members[node]) if whole[c] == node)
        out.append((min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]),
                    len(kids), *below[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def hard_rows():
    rng = random.Random(4)
    rows = []
    for c in [*range(-12, 120), *(10**9 * k for k in range(5)), 2**62]:
        for t in range(rng.choice([1, 1, 2, 3, 5, 9, 12])):
            rows.append((c, rng.choice([t, t, None]), rng.choice(["u", "a", None]), rng.choice(["x", "y", "é", None, "", "x"])))
    rows += [(c, t, "u", "same") for c in range(200, 350) for t in range(10)]      # one conversation, many copies
    rows += [(7, t, "u", "z") for t in range(150)]                                  # a very deep one
    rows += [(None, 1, "u", "q"), (9000, 0, "u", "word " * 30_000), (5002, 0, "ab", "c"), (5003, 0, "a", "bc")]
    return rows + rows[:20]


def table(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, 2, "node") for r in rows], SCHEMA).repartition(5)


def found(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("run_bytes,last_paths", [(16 << 20, 20_000), (3000, 20_000), (2000, 6)])
def test_like_the_recursive_trie(spark, run_bytes, last_paths):
    rows = hard_rows()
    got = found(T.conversation_trie(table(spark, rows), run_bytes=run_bytes, last_paths=last_paths))
    assert got == brute(rows)


def test_other_families_and_heads(spark):
    rows = [r for r in hard_rows() if r[0] is not None and r[0] < 60]
    got = found(T.conversation_trie(table(spark, rows), family=3, longest_head=2))
    assert got == brute(rows, 3, 2)


def test_turnless_conversations_are_in_the_root(spark):
    short = [c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 1][:7]
    rows = [(c, 0, "u", "hello") for c in short]                     # no family head, nothing left
    got = found(T.conversation_trie(table(spark, rows)))
    ends = hashlib.sha256(",".join(map(str, short)).encode()).hexdigest()
    assert got == [(short[0], 0, None, len(short), 0, 1, 0, ends)] == brute(rows)


def test_empty_table(spark):
    assert found(T.conversation_trie(table(spark, hard_rows()).where(F.lit(False)))) == []
    assert found(T.conversation_trie(table(spark, [(None, 1, "u", "x")]))) == []


def test_pieces_of_members_are_hashed_in_order(spark):
    import pyarrow as pa

    texts = [b"1,2", b"10", b"11,12"]
    batches = [pa.RecordBatch.from_pydict({"node_id": [b"a"], "conv_id": [i], "blob": [t]}) for i, t in enumerate(texts)]
    batches.append(pa.RecordBatch.from_pydict({"node_id": [b"b"], "conv_id": [7], "blob": [b"7"]}))
    rows = [tuple(r.values()) for b in T.hashing(iter(batches)) for r in b.to_pylist()]
    assert rows == [(b"a", hashlib.sha256(b"1,2,10,11,12").hexdigest()), (b"b", hashlib.sha256(b"7").hexdigest())]
