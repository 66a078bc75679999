"""Best-fit packing of tokenised documents by exact complements.

Tokens. A text's ids are those that the ``tokenizers`` library gives for the
byte-level vocabulary by default, then one end id: literals of the vocabulary's
added tokens are taken out first and get their own ids. Documents longer than a sequence are
cut from their end backwards, so all pieces but the first are full.

Plan. Only the number of pieces of each length matters, at most ``capacity``
counts whatever the corpus. Longest first, the gap a length leaves is looked up
among the lengths, the sums of two and the sums of three lengths still
available (sets of sums as bit strings), and a combination that fills it
exactly is consumed as often as its scarcest length allows. What is left is
packed best fit: the longest piece that fits goes in, and every gap on the way
is looked up again. Each step uses up a length, so the plan has a bounded
number of patterns.

Scale. Pieces are numbered within their length by counting hash buckets first,
so a length that a third of all pieces have is numbered in many tasks. The plan
(a few thousand intervals) is sent to the tasks, which place their own pieces.

Defined cases: null and empty texts are one end id; a repeated row is packed
again; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import json
import re
import sys
import types
import zlib
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root
from .common import shard_count, small_batches

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PIECES_ARROW = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                          ("length", pa.int64()), ("ids_crc32", pa.int64())])
#: Cutting before a single space never moves a token border, unless white
#: space follows it.
UNSAFE = re.compile(r" (?:\s|\Z)")
#: Fragments a worker remembers; then it starts afresh.
REMEMBERED = 300_000


# --- tokens ------------------------------------------------------------------

def vocabulary_paths() -> tuple[str, str]:
    """(ranks file, split pattern) of the public byte-level vocabulary."""
    import public_tokenizers as P

    return P.path("byte_bpe_50k.tiktoken"), P.PATTERN


def added_tokens() -> dict[str, int]:
    """Ids of the public vocabulary's added tokens, which match in any text."""
    import public_tokenizers as P

    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        found = json.load(file)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in found):
        raise ValueError("added tokens that depend on what is around them")
    return {t["content"]: t["id"] for t in found}


class Fragments(dict):
    """Ids of the fragments between spaces, each with the space before it."""

    def __init__(self, path: str, pattern: str):
        super().__init__()
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks,
                                        special_tokens={}).encode_ordinary

    def __missing__(self, fragment):
        if len(self) >= REMEMBERED:
            self.clear()
        ids = self[fragment] = tuple(self.encode(" " + fragment))
        return ids

    def ids(self, text: str) -> array:
        if UNSAFE.search(text):
            return array("I", self.encode(text))
        first, *rest = text.split(" ")
        return array("I", chain(self.encode(first), chain.from_iterable(map(self.__getitem__, rest))))


def text_ids(fragments: Fragments, text: str, added: dict[str, int]) -> array:
    """A text's ids: added tokens, and the ids of what is between them."""
    if not any(token in text for token in added):
        return fragments.ids(text)
    ids = array("I")
    for part in re.split(f"({'|'.join(map(re.escape, sorted(added, key=len, reverse=True)))})", text):
        ids.extend([added[part]] if part in added else fragments.ids(part))
    return ids


def worker_fragments(path: str, pattern: str) -> Fragments:
    """One memory for all tasks of a worker process."""
    kept = sys.modules.setdefault("_worker_fragments", types.ModuleType("_worker_fragments"))
    if not hasattr(kept, path):
        setattr(kept, path, Fragments(path, pattern))
    return getattr(kept, path)


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: the first takes the remainder."""
    head = total % capacity or capacity
    return [(0, head), *((s, capacity) for s in range(head, total, capacity))]


def piece_maker(path: str, pattern: str, capacity: int, end_id: int, with_ids: bool, added: dict[str, int]):
    def run(batches):
        fragments = worker_fragments(path, pattern)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = text_ids(fragments, text or "", added)
                ids.append(end_id)
                if sys.byteorder == "big":
                    ids.byteswap()
                raw = memoryview(ids).cast("B")
                for piece, (start, length) in enumerate(cut(len(ids), capacity)):
                    own = raw[4 * start:4 * (start + length)]
                    rows.append((doc_id, piece, start, length, zlib.crc32(own), *([bytes(own)] * with_ids)))
            schema = PIECES_ARROW.append(pa.field("ids", pa.binary())) if with_ids else PIECES_ARROW
            columns = list(zip(*rows)) if rows else [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
    return run


# --- plan --------------------------------------------------------------------

class Lengths:
    """Counts of the lengths that are left, with the sums they can form."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.count = {k: v for k, v in counts.items() if v > 0}
        self.bits = sum(1 << k for k in self.count)  # bit k: length k is left
        self.turned = sum(1 << (capacity - k) for k in self.count)

    def take(self, length: int, n: int) -> None:
        self.count[length] -= n
        if not self.count[length]:
            del self.count[length]
            self.bits &= ~(1 << length)
            self.turned &= ~(1 << (self.capacity - length))

    def longest(self, at_most: int) -> int:
        return (self.bits & ((1 << (at_most + 1)) - 1)).bit_length() - 1

    def has(self, combination: tuple[int, ...], used: dict[int, int]) -> bool:
        return all(self.count.get(k, 0) >= used.get(k, 0) + combination.count(k) for k in set(combination))

    def pair_sums(self, total: int) -> int:
        """Bit k: k and total - k are both left."""
        shift = self.capacity - total
        return self.bits & (self.turned >> shift if shift >= 0 else self.turned << -shift)

    def singles(self, gap: int):
        if self.bits >> gap & 1:
            yield (gap,)

    def pairs(self, gap: int):
        bits = self.pair_sums(gap) & ((1 << (gap // 2 + 1)) - 1)
        while bits:  # the most even pair first: it keeps short pieces for later gaps
            k = bits.bit_length() - 1
            yield (gap - k, k)
            bits &= ~(1 << k)

    def triples(self, gap: int):
        low = -(-gap // 3)
        bits = (self.bits >> low << low) & ((1 << gap) - 1)
        while bits:
            k = (bits & -bits).bit_length() - 1
            rest = self.pair_sums(gap - k) & ((1 << (min(k, (gap - k) // 2) + 1)) - 1)
            while rest:
                j = rest.bit_length() - 1
                if gap - k - j <= k:
                    yield (k, gap - k - j, j)
                rest &= ~(1 << j)
            bits &= bits - 1

    def complement(self, gap: int, used: dict[int, int]) -> tuple[int, ...] | None:
        """One, two or three lengths that fill the gap, on top of those used;
        None only if there are none. Lengths that are used up are masked, so
        only combinations that need a length twice can still fail: two at most
        for each length."""
        bits, turned = self.bits, self.turned
        for k, n in used.items():
            if self.count.get(k, 0) <= n:
                self.bits &= ~(1 << k)
                self.turned &= ~(1 << (self.capacity - k))
        try:
            for kind in (self.singles, self.pairs, self.triples):
                for found in kind(gap):
                    if self.has(found, used):
                        return found
            return None
        finally:
            self.bits, self.turned = bits, turned


def tally(parts) -> dict[int, int]:
    out: dict[int, int] = {}
    for k in parts:
        out[k] = out.get(k, 0) + 1
    return out


def pack_counts(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """[(lengths of a sequence with their number, number of such sequences)]"""
    left, plan = Lengths(counts, capacity), []

    def consume(pattern: dict[int, int]) -> None:
        times = min(left.count[k] // n for k, n in pattern.items())
        for k, n in pattern.items():
            left.take(k, n * times)
        plan.append((pattern, times))

    for length in sorted(left.count, reverse=True):
        while left.count.get(length):
            if length == capacity:
                consume({length: 1})
                continue
            found = left.complement(capacity - length, {length: 1})
            if not found:
                break
            consume(tally((length, *found)))
    while left.count:
        pattern = {left.longest(capacity): 1}
        gap = capacity - next(iter(pattern))
        while gap:
            found = left.complement(gap, pattern)
            if not found:
                fits = [k for k in pattern if k <= gap and left.count[k] > pattern[k]]
                mask = sum(1 << k for k in pattern)
                best = max([((left.bits & ~mask) & ((1 << (gap + 1)) - 1)).bit_length() - 1, *fits])
                if best < 1:
                    break
                found = (best,)
            for k in found:
                pattern[k] = pattern.get(k, 0) + 1
                gap -= k
        consume(pattern)
    return plan


def intervals(plan: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """By length: rows (first number, first sequence, pieces a sequence, offset)."""
    used: dict[int, int] = {}
    out: dict[int, list] = {}
    sequence = 0
    for pattern, times in plan:
        offset = 0
        for length, n in sorted(pattern.items(), reverse=True):
            out.setdefault(length, []).append((used.get(length, 0), sequence, n, offset))
            used[length] = used.get(length, 0) + n * times
            offset += n * length
        sequence += times
    return {k: np.array(v, np.int64) for k, v in out.items()}


def placer(places: dict[int, np.ndarray]):
    def run(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("__number").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for k in np.unique(length).tolist():
                own = length == k
                table = places[k]
                row = table[np.searchsorted(table[:, 0], number[own], "right") - 1]
                step = number[own] - row[:, 0]
                sequence[own] = row[:, 1] + step // row[:, 2]
                offset[own] = row[:, 3] + step % row[:, 2] * k
            kept = [c for c in batch.schema.names if c != "__number"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(sequence), pa.array(offset)],
                [*kept, "sequence_id", "offset"])
    return run


# --- operator ----------------------------------------------------------------

def number_by_length(pieces: DataFrame, shards: int) -> DataFrame:
    """Numbers the pieces of each length from 0, hash bucket after hash bucket."""
    dealt = pieces.withColumn("__bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards)))
    sizes = dealt.groupBy("length", "__bucket").count()
    before = Window.partitionBy("length").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("length", "__bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__first"))
    inside = Window.partitionBy("length", "__bucket").orderBy("doc_id", "piece", "ids_crc32")
    return dealt.withColumn("__row", F.row_number().over(inside)).join(first, ["length", "__bucket"]) \
        .select(*pieces.columns, (F.col("__first") + F.col("__row") - 1).cast("long").alias("__number"))


def pack_documents(docs: DataFrame, *, capacity: int = 2048, end_id: int = 0, with_ids: bool = False,
                   ranks_path: str | None = None, pattern: str | None = None,
                   added: dict[str, int] | None = None) -> DataFrame:
    """Pieces of all documents with the sequence and offset each is packed at;
    ``with_ids`` adds the ids, as little-endian 32-bit numbers. The plan is made
    from counts by length, of which there are at most ``capacity``. A vocabulary
    of one's own has the ``added`` tokens that are given with it."""
    spark = docs.sparkSession
    checkpoint_root(spark)
    small_batches(spark)
    if ranks_path is None or pattern is None:
        ranks_path, pattern = vocabulary_paths()
        added = added_tokens() if added is None else added
    pieces = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(
        piece_maker(ranks_path, pattern, capacity, end_id, with_ids, added or {}),
        PIECES + ", ids binary" * with_ids).checkpoint()
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    places = intervals(pack_counts(counts, capacity))
    return number_by_length(pieces, shard_count(spark)) \
        .mapInArrow(placer(places), PIECES + ", ids binary" * with_ids + ", sequence_id long, offset long")
