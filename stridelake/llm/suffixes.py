"""Suffix-array deduplication: bytes under a string that an earlier document has.

A byte goes when some ``length``-byte string that covers it also starts in a
document with a smaller id; strings are judged on the input.

Candidates. Sorting every suffix of a corpus together would move each byte
many times. Every ``length``-byte string holds an *anchor*: the gram with the
least hash among its grams, which depends on the string alone. So chunks
first tell the anchors' shards which anchor hashes they hold, and learn which
occur in two documents. Only around these do they send text: the bytes of all
``length``-byte strings that hold the anchor, once for each distinct context.

Suffix sorting. A shard joins its distinct contexts into one text and sorts
their suffixes in two stages. Only suffixes smaller than (or equal in first
byte to) their successors are sorted directly; a scan of the buckets in
ascending order then places each remaining suffix, whose successor lies in a
smaller bucket, in the order of its successor. Common prefixes of neighbours
split the array into runs that share ``length`` bytes; the least document id
of a run is the first holder of its string. Chunks get these ids back and mark
the bytes. An anchor shared by chance costs a context and changes nothing.

Scale. Hot passages cost each chunk one context, not one for each copy; the
text itself goes only to its own chunk; shards hold hash ranges of anchors.

Defined cases: null text is empty; matches never cross documents or read into
a neighbour; equal ids do not remove each other's bytes; a null id counts as
later than all; documents shorter than ``length`` are kept; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import (BLOCK, block_batch, block_table, blocks, group_key, mix64, pack, shard_count,
                     small_batches, text_bytes, unpack)

LAST = np.int64(2**63 - 1)
RESULT = "doc_id long, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary"
RESULT_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
    ("kept", pa.binary())])
BLOCK_BYTES = 1 << 19


# --- anchors -----------------------------------------------------------------

def gram_hashes(text: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the gram at each position, by doubling; at least 1."""
    factor = 0x9E3779B97F4A7C15
    pieces = {1: mix64(np.arange(1, 257, dtype=np.uint64))[text]}
    size = 1
    while size * 2 <= gram:
        h = pieces[size]
        pieces[size * 2] = h[:-size] * np.uint64(pow(factor, size, 1 << 64)) + h[size:]
        size *= 2
    out, have = pieces[size], size
    while have < gram:
        step = 1 << ((gram - have).bit_length() - 1)
        tail = pieces[step][have:]
        out = out[:len(tail)] * np.uint64(pow(factor, step, 1 << 64)) + tail
        have += step
    return mix64(out) | np.uint64(1)


def slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over each ``width`` values, by doubling."""
    size, out = 1, values
    while size * 2 <= width:
        out = pick(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return pick(out[:len(out) - rest], out[rest:]) if rest else out


def anchors(text: np.ndarray, stops: np.ndarray, length: int, gram: int):
    """(positions, hashes) of the anchors of all ``length``-byte strings that
    stay within a document; ``stops`` are the documents' ends, ascending."""
    width = length - gram + 1
    places, found = [], []
    starts = np.concatenate([[0], stops[:-1]]) if len(stops) else stops
    d = 0
    while d < len(stops):
        e = max(d + 1, int(np.searchsorted(stops, starts[d] + BLOCK_BYTES, "right")))
        a, b = int(starts[d]), int(stops[e - 1])
        if b - a >= length:
            h = gram_hashes(text[a:b], gram)
            least = slide(h, width, np.minimum)
            for stop in (stops[d:e] - a).tolist():  # strings that cross an end
                least[max(0, stop - length + 1):stop] = 0
            edge = np.zeros(width - 1, np.uint64)
            most = slide(np.concatenate([edge, least, edge]), width, np.maximum)
            at = np.flatnonzero(most == h)
            places.append(at + a)
            found.append(h[at])
        d = e
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(places), np.concatenate(found)


class Chunk:
    """The texts of a chunk, joined, and its anchors by shard and hash."""

    def __init__(self, text: bytes, stops: np.ndarray, length: int, gram: int, shards: int):
        self.text = np.frombuffer(text, np.uint8)
        self.stops = stops
        self.at, h = anchors(self.text, stops, length, gram)
        self.doc = np.searchsorted(stops, self.at, "right")
        self.shard = ((h >> np.uint64(1)) % np.uint64(shards)).astype(np.int64)  # bit 0 is always set
        code = (self.shard.astype(np.uint64) << np.uint64(32)) | (h >> np.uint64(32))
        self.codes, self.code = np.unique(code, return_inverse=True)
        self.cuts = np.searchsorted(self.codes, np.arange(shards + 1, dtype=np.uint64) << np.uint64(32))


def least_by(group: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    out = np.full(n, LAST)
    np.minimum.at(out, group, values)
    return out


def as_bytes(batches: list[pa.RecordBatch]) -> bytes | None:
    """Columns that only pass through, as an Arrow stream."""
    if not batches:
        return None
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batches[0].schema) as out:
        for batch in batches:
            out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def reader(length: int, gram: int, shards: int, chunk_bytes: int):
    """Chunks of documents; the anchors they hold to the anchors' shards.
    Columns after the first two (id and text) pass through."""
    def flush(ids, texts, others, chunk):
        stops = np.cumsum([len(t) for t in texts])
        own = Chunk(b"".join(texts), stops, length, gram, shards)
        low, high = np.full(len(own.codes), LAST), np.full(len(own.codes), -1)
        np.minimum.at(low, own.code, own.doc)
        np.maximum.at(high, own.code, own.doc)
        several = low < high
        out = [(-1 - chunk, -2, pack(text=b"".join(texts), stops=stops, ids=ids, others=as_bytes(others)))]
        for p in range(shards):
            a, b = own.cuts[p], own.cuts[p + 1]
            if a < b:
                rest = own.codes[a:b].astype(np.uint32)
                out.append((p, chunk, pack(steps=np.diff(rest, prepend=np.uint32(0)),
                                           several=np.packbits(several[a:b]))))
        return block_batch(out)

    def run(batches):
        base, seq = TaskContext.get().partitionId() << 24, 0
        ids, texts, others, size = [], [], [], 0
        for batch in batches:
            first = 0
            for i, (doc_id, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1))):
                ids.append(doc_id)
                texts.append(text_bytes(text.as_py()))
                size += len(texts[-1])
                if size >= chunk_bytes or i + 1 == batch.num_rows:
                    if batch.num_columns > 2:
                        others.append(batch.slice(first, i + 1 - first).select(batch.schema.names[2:]))
                    first = i + 1
                if size >= chunk_bytes:
                    yield flush(ids, texts, others, base + seq)
                    seq, ids, texts, others, size = seq + 1, [], [], [], 0
        if ids:
            yield flush(ids, texts, others, base + seq)
    return run


def common_anchors(table: pa.Table) -> pa.Table:
    """Which of each chunk's anchors occur in two documents."""
    if group_key(table) < 0:
        return block_table([])
    key, found = group_key(table), [(s, unpack(b)) for s, b in blocks(table)]
    rests = [np.cumsum(x["steps"], dtype=np.uint32) for _, x in found]
    several = np.concatenate([np.unpackbits(x["several"], count=len(r)) for (_, x), r in zip(found, rests)])
    _, inverse, counts = np.unique(np.concatenate(rests), return_inverse=True, return_counts=True)
    shared = counts > 1
    shared[inverse[several > 0]] = True
    out, at = [], 0
    for (chunk, _), rest in zip(found, rests):
        out.append((-1 - chunk, key, pack(shared=np.packbits(shared[inverse[at:at + len(rest)]]))))
        at += len(rest)
    return block_table(out)


# --- contexts ----------------------------------------------------------------

def same_rows(matrix: np.ndarray, extra: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first row of each class, class of each row) of equal rows. Classes are
    hash classes split wherever bytes differ, so unequal rows never join."""
    width = -(-matrix.shape[1] // 8) * 8
    wide = np.zeros((len(matrix), width), np.uint8)
    wide[:, :matrix.shape[1]] = matrix
    h = mix64(extra.astype(np.uint64) + np.uint64(1))
    for column in wide.view(np.uint64).T:
        h = mix64(h ^ column)
    order = np.argsort(h, kind="stable")
    a, b = order[:-1], order[1:]
    new = np.ones(len(order), bool)
    new[1:] = (h[a] != h[b]) | (extra[a] != extra[b]) | (wide[a] != wide[b]).any(axis=1)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    return order[new], group


def context_sender(length: int, gram: int, shards: int):
    """The distinct contexts of shared anchors to the anchors' shards."""
    reach, width = length - gram, 2 * length - gram

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        key = group_key(left, right)
        if key >= 0 or not right.num_rows:
            return block_table([])
        chunk, own = -1 - key, unpack(blocks(left)[0][1])
        c = Chunk(own["text"], own["stops"], length, gram, shards)
        replies = dict(blocks(right))
        shared = np.concatenate([
            np.unpackbits(unpack(replies[p])["shared"], count=c.cuts[p + 1] - c.cuts[p])
            for p in range(shards) if c.cuts[p] < c.cuts[p + 1]])
        pick = np.flatnonzero(shared[c.code])
        at, doc, shard = c.at[pick], c.doc[pick], c.shard[pick]
        stops = c.stops[doc]
        begins = np.concatenate([[0], c.stops[:-1]])[doc]
        begin, end = np.maximum(begins, at - reach), np.minimum(stops, at + length)
        ids = np.array([LAST if i is None else i for i in own["ids"]], np.int64)[doc]
        order = np.lexsort((at, shard))
        out, cuts, at_class, classes = [], np.searchsorted(shard[order], np.arange(shards + 1)), np.zeros(len(at), np.int64), 0
        for p in range(shards):
            rows = order[cuts[p]:cuts[p + 1]]
            if not len(rows):
                continue
            size = (end - begin)[rows]
            spots = begin[rows][:, None] + np.arange(width)
            inside = np.arange(width) < size[:, None]
            matrix = np.where(inside, c.text[np.minimum(spots, len(c.text) - 1)], 0).astype(np.uint8)
            first, group = same_rows(matrix, size)
            at_class[rows] = group + classes
            classes += len(first)
            out.append((p, chunk, pack(rows=matrix[first], size=size[first].astype(np.uint8),
                                       least=least_by(group, ids[rows], len(first)))))
        out.append((key, -1, pack(begin=begin.astype(np.uint32), doc=doc.astype(np.uint32),
                                  group=at_class.astype(np.uint32))))
        return block_table(out)
    return run


# --- suffix sorting ----------------------------------------------------------

def keys_at(text: np.ndarray, spots: np.ndarray, depth: int) -> np.ndarray:
    """The ``depth`` symbols from each spot as big-endian 8-byte words."""
    words = -(-depth // 8)
    windows = np.lib.stride_tricks.sliding_window_view(text, words * 8)
    return windows[spots].view(">u8")


def two_stage_order(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """Positions of the ``wanted`` suffixes in order of their first ``depth``
    symbols. ``text`` must end with as many zeros as ``depth`` rounded up to 8,
    so every last real suffix has a successor."""
    ascending = np.ones(len(text), bool)  # smaller than its successor, or alike in the first symbol
    ascending[:-1] = text[:-1] <= text[1:]
    needed = wanted.copy()
    edge = np.flatnonzero(wanted & ~ascending)
    while len(edge):  # a placed suffix needs its successor's place
        edge = edge[~needed[edge + 1]] + 1
        needed[edge] = True
        edge = edge[~ascending[edge]]
    direct = np.flatnonzero(needed & ascending)
    direct = direct[np.argsort(text[direct], kind="stable")]
    direct_cuts = np.searchsorted(text[direct], np.arange(257))
    placed: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    for symbol in range(256):
        own = direct[direct_cuts[symbol]:direct_cuts[symbol + 1]]
        if len(own) > 1:
            own = own[np.lexsort(keys_at(text, own, depth).T[::-1])]
        bucket = np.concatenate([*placed[symbol], own])
        placed[symbol] = []
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[needed[before] & (text[before] > symbol)]
        if len(before):
            before = before[np.argsort(text[before], kind="stable")]
            first = np.flatnonzero(np.diff(text[before], prepend=-1))
            for piece in np.split(before, first[1:]):
                placed[text[piece[0]]].append(piece)
    order = np.concatenate(out) if out else np.zeros(0, np.int64)
    return order[wanted[order]]


def adjacent_prefixes(text: np.ndarray, order: np.ndarray, depth: int, step: int = 1 << 18) -> np.ndarray:
    """Length of the common prefix with the suffix before, at most ``depth``."""
    windows = np.lib.stride_tricks.sliding_window_view(text, depth)
    out = np.zeros(len(order), np.int64)
    for a in range(1, len(order), step):
        b = min(len(order), a + step)
        differ = windows[order[a - 1:b - 1]] != windows[order[a:b]]
        out[a:b] = np.where(differ.any(axis=1), differ.argmax(axis=1), depth)
    return out


def first_holders(rows: np.ndarray, size: np.ndarray, least: np.ndarray, length: int) -> np.ndarray:
    """For each row and start, the least document that holds the ``length``
    bytes there; ``least`` has a document of each row. Unused starts: LAST."""
    n, width = rows.shape
    stride = width + 1
    laid = np.zeros((n, stride), np.uint8)  # UTF-8 has no byte 255: add one, zero ends a row
    laid[:, :width] = np.where(np.arange(width) < size[:, None], rows + np.uint8(1), 0)
    text = np.concatenate([laid.ravel(), np.zeros(length + 16, np.uint8)])
    starts = np.arange(stride)[None, :] + length <= size[:, None]
    wanted = np.zeros(len(text), bool)
    wanted[:n * stride] = starts.ravel()
    order = two_stage_order(text, wanted, length)
    out = np.full((n, width - length + 1), LAST)
    if len(order):
        run = np.flatnonzero(adjacent_prefixes(text, order, length) < length)
        holders = np.minimum.reduceat(least[order // stride], run)
        out[order // stride, order % stride] = np.repeat(holders, np.diff(np.append(run, len(order))))
    return out


def holder_finder(length: int):
    def run(table: pa.Table) -> pa.Table:
        key, found = group_key(table), blocks(table)
        if key < 0:  # what a chunk keeps for itself
            return block_table([(key, s, b) for s, b in found])
        parts = [(s, unpack(b)) for s, b in found]
        rows = np.concatenate([x["rows"] for _, x in parts])
        size = np.concatenate([x["size"] for _, x in parts]).astype(np.int64)
        least = np.concatenate([x["least"] for _, x in parts])
        first, group = same_rows(rows, size)
        holders = first_holders(rows[first], size[first], least_by(group, least, len(first)), length)
        out, at = [], 0
        for chunk, x in parts:
            out.append((-1 - chunk, key, pack(holders=holders[group[at:at + len(x["size"])]])))
            at += len(x["size"])
        return block_table(out)
    return run


# --- removal -----------------------------------------------------------------

def runs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def removal(left: pa.Table, right: pa.Table, length: int) -> tuple[dict, np.ndarray]:
    """(a chunk's own block, mask of the bytes of its text that go)."""
    own = unpack(blocks(left)[0][1])
    gone = np.zeros(len(own["text"]) + 1, np.int32)
    replies = blocks(right)
    if len(replies) > 1:
        kept = unpack(replies[0][1])
        holders = np.concatenate([unpack(b)["holders"] for _, b in replies[1:]])
        order = np.array([LAST if i is None else i for i in own["ids"]], np.int64)[kept["doc"]]
        for r in range(holders.shape[1]):
            at = kept["begin"][holders[kept["group"], r] < order].astype(np.int64) + r
            np.add.at(gone, at, 1)
            np.add.at(gone, at + length, -1)
    np.cumsum(gone, out=gone)
    return own, gone[:-1] > 0


def kept_bytes(own: dict, mask: np.ndarray):
    """(id, size, mask, remaining bytes) of each document of a chunk."""
    text, begin = own["text"], 0
    letters = np.frombuffer(text, np.uint8)
    for doc_id, stop in zip(own["ids"], own["stops"].tolist()):
        cut = mask[begin:stop]
        yield doc_id, stop - begin, cut, letters[begin:stop][~cut].tobytes() if cut.any() else text[begin:stop]
        begin = stop


def remover(length: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if group_key(left, right) >= 0 or not left.num_rows:
            return RESULT_ARROW.empty_table()
        rows = {"doc_id": [], "n_bytes": [], "spans": [], "kept": []}
        for doc_id, size, cut, kept in kept_bytes(*removal(left, right, length)):
            a, b = runs_of(cut)
            rows["doc_id"].append(doc_id)
            rows["n_bytes"].append(size)
            rows["spans"].append([{"start": x, "stop": y} for x, y in zip(a.tolist(), b.tolist())])
            rows["kept"].append(kept)
        return pa.Table.from_pydict(rows, schema=RESULT_ARROW)
    return run


def text_replacer(length: int, schema: pa.Schema):
    """The documents themselves, with what is left of their texts (characters
    that lost a byte go whole)."""
    def run(left, right):
        if group_key(left, right) >= 0 or not left.num_rows:
            return schema.empty_table()
        own, mask = removal(left, right, length)
        texts = [kept.decode("utf-8", "ignore") for _, _, _, kept in kept_bytes(own, mask)]
        columns = {"doc_id": pa.array(own["ids"], pa.int64()), "text": pa.array(texts, pa.string())}
        if own["others"] is not None:
            others = pa.ipc.open_stream(own["others"]).read_all()
            columns |= {n: others.column(n) for n in others.column_names}
        return pa.table([columns[n] for n in schema.names], schema.names).cast(schema)
    return run


def mark_repeats(docs: DataFrame, others: list[str], finish, schema, length: int, gram: int,
                 chunk_bytes: int) -> DataFrame:
    spark = docs.sparkSession
    small_batches(spark)
    shards = 4 * shard_count(spark)  # a shard's suffixes are sorted in memory
    by_key = lambda df: df.groupBy("key")
    sent = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"], *[docs[c] for c in others]) \
        .mapInArrow(reader(length, gram, shards, chunk_bytes), BLOCK)
    shared = by_key(sent).applyInArrow(common_anchors, BLOCK)
    contexts = by_key(sent).cogroup(by_key(shared)).applyInArrow(context_sender(length, gram, shards), BLOCK)
    holders = by_key(contexts).applyInArrow(holder_finder(length), BLOCK)
    return by_key(sent).cogroup(by_key(holders)).applyInArrow(finish, schema)


def remove_repeats(docs: DataFrame, *, length: int = 50, gram: int = 24,
                   chunk_bytes: int = 8_000_000) -> DataFrame:
    """``doc_id, n_bytes, spans, kept``: the removed byte spans (maximal, end
    exclusive) and the remaining bytes of every document."""
    return mark_repeats(docs, [], remover(length), RESULT, length, gram, chunk_bytes)


def without_repeats(docs: DataFrame, *, length: int = 50, gram: int = 24,
                    chunk_bytes: int = 8_000_000) -> DataFrame:
    """``docs`` with the repeated bytes gone from their texts; all documents
    stay, those that repeat others entirely with an empty text."""
    names = docs.columns
    others = [c for c in names if c not in ("doc_id", "text")]
    schema = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *others).select(*names).schema
    return mark_repeats(docs, others, text_replacer(length, to_arrow_schema(schema)), schema, length, gram, chunk_bytes)


def removal_digest(removed: DataFrame) -> DataFrame:
    """One row for each document: how much went, and what is left as SHA-256."""
    return removed.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
