"""Vector codes against every distance worked out, exactly."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stridelake.llm import vector_codes as T

SCHEMA = "vec_id long, embedding array<double>, label int, part long, code string, blocks string, sums long"


def hard_rows():
    rng = random.Random(2)
    rows = []
    for i in range(300):
        v = [rng.choice([-0.3, -1 / 256, 0.0, 0.1, 1 / 3, rng.random() * 8 - 4]) for _ in range(32)]
        odd = {7: None, 9: [*v[:3], None, *v[4:]], 11: [math.nan, *v[1:]], 13: [*v[:31], -math.inf]}
        rows.append((rng.choice([i, i, i, None, 5]), odd.get(i % 40, v), rng.choice([1, 2, None])))
    return rows + rows[:60] + [(9, [0.5] * 32, 3)] * 200              # repeated rows, a large group of copies


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0, "c", "b", 1) for r in rows], SCHEMA)


def brute(rows, parts=16, entries=64, rounds=2):
    kept = [(i, [math.floor(256 * x) for x in v], l) for i, v, l in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.array([v for _, v, _ in kept])
    split = np.split(x, parts, axis=1)
    books = [s[:entries].copy() for s in split]

    def given():
        far = [((s[:, None] - b[None]) ** 2).sum(axis=2) for s, b in zip(split, books)]
        return [(f.argmin(axis=1), f.min(axis=1)) for f in far]

    for _ in range(rounds):
        for s, b, (code, _) in zip(split, books, given()):
            for e in range(len(b)):
                if (code == e).any():
                    b[e] = s[code == e].sum(axis=0) // (code == e).sum()
    final = given()
    errors = sum(f for _, f in final)
    by_label = {}
    for (_, _, label), e in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + int(e)
    sha = hashlib.sha256(",".join(str(c) for b in books for c in b.reshape(-1)).encode()).hexdigest()
    return sorted([(i, "".join(f"{c[k]:02x}" for c, _ in final), int(errors[k]), by_label[label], sha)
                   for k, (i, _, label) in enumerate(kept)], key=str)


@pytest.mark.parametrize("chunk,block", [(T.CHUNK, T.BLOCK), (100, 7), (1, 1)])
def test_like_every_distance(spark, chunk, block):
    rows = hard_rows()
    done = T.compression_digest(T.compress(frame(spark, rows), chunk=chunk, block=block))
    assert done.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, done.collect()), key=str) == brute(rows)


def test_other_shapes(spark):
    rows = [r for r in hard_rows() if r[1] is not None][:90]
    done = T.compression_digest(T.compress(frame(spark, rows), parts=4, entries=10, rounds=3, chunk=40, block=8))
    assert sorted(map(tuple, done.collect()), key=str) == brute(rows, 4, 10, 3)


def test_fewer_vectors_than_entries(spark):
    rows = hard_rows()[:5]
    assert sorted(map(tuple, T.compression_digest(T.compress(frame(spark, rows))).collect()), key=str) == brute(rows)


def test_nothing_to_compress(spark):
    for df in (frame(spark, hard_rows()).where(F.lit(False)), frame(spark, [(1, None, 2), (2, [math.nan] * 32, 2)])):
        assert T.compression_digest(T.compress(df)).collect() == []


def test_shortlists_hold_the_nearest_entry():
    rng = np.random.default_rng(3)
    for spread in (3, 40, 400):
        points = rng.integers(-spread, spread + 1, (500, 8))
        book = rng.integers(-spread, spread + 1, (20, 4))
        for p, part in enumerate(T.lay_out(points, 2, 16)):
            block, entry = T.shortlists(part, book)
            assert len(block) <= 20 * len(part["sizes"])
            found, far = T.nearest(part, book, block, entry, pairs=50)
            own = points[:, 4 * p:4 * p + 4][part["order"]]
            every = ((own[:, None] - book[None]) ** 2).sum(axis=2)
            assert found.reshape(-1)[:500].tolist() == every.argmin(axis=1).tolist()
            assert far.reshape(-1)[:500].tolist() == every.min(axis=1).tolist()


def test_hilbert_order_keeps_neighbours_together():
    grid = np.array([(a, b) for a in range(16) for b in range(16)])
    walk = grid[T.hilbert_rank(grid)]
    assert np.abs(np.diff(walk, axis=0)).sum(axis=1).max() == 1        # every step goes to a neighbour
    cube = np.array([(a, b, c) for a in range(8) for b in range(8) for c in range(8)])
    walk = cube[T.hilbert_rank(cube)]
    assert np.abs(np.diff(walk, axis=0)).sum(axis=1).max() == 1


def test_unequal_or_too_large_vectors_are_errors(spark):
    for rows in ([(1, [0.0] * 32, 1), (2, [0.0] * 16, 1)], [(1, [0.0] * 7, 1)], [(1, [1e30] * 32, 1)]):
        with pytest.raises(Exception, match="vectors need one length|components beyond"):
            T.compress(frame(spark, rows))
