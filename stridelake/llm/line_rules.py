"""Quality rules on lines that recur across the documents of a host.

Lines are normalised (lower case A-Z, digits as 0, white space collapsed),
hashed with their host, and counted by distinct document texts: exact copies
of a document count once, they are not boilerplate. Lines above the limit are
removed from every document that has them, and a document is rejected when too
little of it is left or when it fails the base rules (too few words, or too
many of them in repeated 8-word windows).

Scale. Whether a line is common needs no more than ``max_documents + 1``
different texts that have it, so that many 64-bit text marks, the smallest, are
all that any step passes on for a line. A chunk sends its lines to their shard,
where chunks are dealt to buckets; a bucket merges what its chunks sent, and a
shard's total merges its buckets. With C chunks there are about sqrt(C) buckets,
so a line that every document has brings sqrt(C) times the limit of marks to a
group, never one for each document, and no group is ever a host. Verdicts go
back the same way, in the chunk's own order. Lines are hashes throughout; texts
move only when the cleaned texts are asked for.

Defined cases: null text has no words and fails the base rules; a null host is
a host; repeated rows are judged one by one but count as one text; blank lines
count for nothing; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (BLOCK, WHITE, Vocabulary, block_batch, block_table, blocks, group_key, mix64, pack,
                     shard_count, small_batches, text_bytes, unpack, word_ids)

SYMBOLS = "#*$%&|<>"
WINDOW = 8
FOLD = bytes(b + 32 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in range(256))
RESULT = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, n_lines long, n_common_lines long, n_words_left long, clean_text string")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines")


def line_counts(text: str) -> tuple[int, int, int]:
    """(characters in words, symbols, lines with a word equal to an earlier one)."""
    chars = len(text) - sum(text.count(c) for c in WHITE)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    return chars, symbols, len(lines) - len(set(lines))


def repeated_words(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each document, the words inside windows that occur twice or more in
    it. ``words`` joins the documents' word numbers."""
    n = len(words)
    out = np.zeros(len(starts), np.int64)
    if n < WINDOW:
        return out
    doc = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
    h = np.zeros(n - WINDOW + 1, np.uint64)
    mixed = mix64(words.astype(np.uint64) + np.uint64(1))
    for k in range(WINDOW):
        h = h * np.uint64(0x9E3779B97F4A7C15) + mixed[k:n - WINDOW + 1 + k]
    inside = np.flatnonzero(doc[:n - WINDOW + 1] == doc[WINDOW - 1:])
    h = mix64(h[inside] ^ mix64(doc[inside].astype(np.uint64) + np.uint64(1 << 40)))
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    twice = np.zeros(len(h), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n + 1, np.int32)
    at = inside[twice]
    np.add.at(covered, at, 1)
    np.add.at(covered, at + WINDOW, -1)
    mask = np.cumsum(covered[:-1]) > 0
    return np.bincount(doc[mask], minlength=len(starts))


def fewest(line: np.ndarray, mark: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (line, mark) pairs by line, of each line the ``most`` smallest marks."""
    order = np.lexsort((mark, line))
    line, mark = line[order], mark[order]
    new = np.ones(len(line), bool)
    new[1:] = (line[1:] != line[:-1]) | (mark[1:] != mark[:-1])
    line, mark = line[new], mark[new]
    keep = np.arange(len(line)) - np.searchsorted(line, line) < most
    return line[keep], mark[keep]


class Chunk:
    """Collects documents until they are sent."""

    def __init__(self):
        self.words, self.lines = Vocabulary(), Vocabulary()
        self.ids, self.texts, self.marks, self.stats = [], [], [], []
        self.sequences, self.doc_lines, self.line_words = [], [], []
        self.size = 0

    def add(self, doc_id, host: str | None, text: str | None) -> None:
        raw = text_bytes(text)
        words = raw.split()
        self.size += len(raw) + 64
        self.ids.append(doc_id)
        self.texts.append(raw)
        self.marks.append(xxhash.xxh64_intdigest(raw, 1))
        self.stats.append((len(words), *line_counts(text or "")))
        self.sequences.append(word_ids(self.words, words).astype(np.int32))
        salt = xxhash.xxh64_intdigest(b"\0" if host is None else b"\1" + host.encode())
        lines, counts = [], []
        for line in raw.translate(FOLD).split(b"\n"):
            parts = line.split()
            lines.append(self.lines[xxhash.xxh64_intdigest(b" ".join(parts), salt)] if parts else -1)
            counts.append(len(parts))
        self.doc_lines.append(np.array(lines, np.int64))
        self.line_words.append(np.array(counts, np.int32))

    def send(self, chunk: int, shards: int, buckets: int, most: int, with_text: bool) -> list[tuple[int, int, bytes]]:
        lengths = np.array([len(s) for s in self.sequences], np.int64)
        repeats = repeated_words(np.concatenate(self.sequences), np.cumsum(lengths) - lengths)
        hashes = np.fromiter(self.lines, np.uint64, len(self.lines))
        shard = (hashes % np.uint64(shards)).astype(np.int64)
        order = np.lexsort((hashes, shard))
        rank = np.empty(len(order) + 1, np.int64)
        rank[order], rank[-1] = np.arange(len(order)), -1
        n_lines = np.array([len(x) for x in self.doc_lines], np.int64)
        line = rank[np.concatenate(self.doc_lines)]
        mark = np.repeat(np.array(self.marks, np.uint64), n_lines)
        real = line >= 0
        owner, mark = fewest(line[real], mark[real], most)
        cuts = np.searchsorted(shard[order], np.arange(shards + 1))
        pair_cuts = np.searchsorted(owner, cuts)
        bucket = int(mix64(np.array([chunk], np.uint64))[0]) % buckets
        out = []
        for p in range(shards):
            a, b = cuts[p], cuts[p + 1]
            if a < b:
                own = slice(pair_cuts[p], pair_cuts[p + 1])
                out.append((p * buckets + bucket, chunk, pack(
                    lines=hashes[order[a:b]], texts=mark[own],
                    n=np.bincount(owner[own] - a, minlength=b - a).astype(np.uint32))))
        out.append((-1 - chunk, -2, pack(
            ids=self.ids, stats=np.array(self.stats, np.int64), repeats=repeats, n_lines=n_lines,
            line=line.astype(np.int32), words=np.concatenate(self.line_words),
            texts=self.texts if with_text else None)))
        return out


def sender(shards: int, buckets: int, most: int, chunk_bytes: int, with_text: bool):
    def run(batches):
        base, seq, chunk = TaskContext.get().partitionId() << 24, 0, Chunk()
        for batch in batches:
            for doc_id, host, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                chunk.add(doc_id, host, text.as_py())
                if chunk.size >= chunk_bytes:
                    yield block_batch(chunk.send(base + seq, shards, buckets, most, with_text))
                    seq, chunk = seq + 1, Chunk()
        if chunk.ids:
            yield block_batch(chunk.send(base + seq, shards, buckets, most, with_text))
    return run


def merged(parts: list[dict], most: int):
    """(lines of all parts, line of each part's entries, owners and marks)."""
    lines, line = np.unique(np.concatenate([x["lines"] for x in parts]), return_inverse=True)
    owner = np.repeat(line, np.concatenate([x["n"] for x in parts]))
    return lines, line, *fewest(owner, np.concatenate([x["texts"] for x in parts]), most)


def merger(shards: int, buckets: int, most: int):
    """A bucket's lines, each with its fewest marks, sent to the shard's total."""
    def run(table: pa.Table) -> pa.Table:
        key = group_key(table)
        if key < 0:
            return block_table([])
        lines, _, owner, mark = merged([unpack(b) for _, b in blocks(table)], most)
        n = np.bincount(owner, minlength=len(lines)).astype(np.uint32)
        return block_table([(shards * buckets + key // buckets, key, pack(lines=lines, texts=mark, n=n))])
    return run


def total(limit: int):
    """For each bucket's lines, whether more than ``limit`` texts have them."""
    def run(table: pa.Table) -> pa.Table:
        sources, blobs = zip(*blocks(table))
        parts = [unpack(b) for b in blobs]
        lines, line, owner, _ = merged(parts, limit + 1)
        common = (np.bincount(owner, minlength=len(lines)) > limit)[line]
        ends = np.cumsum([len(x["lines"]) for x in parts])[:-1]
        return block_table([(bucket, bucket, pack(common=c)) for bucket, c in zip(sources, np.split(common, ends))])
    return run


def tell_chunks(left: pa.Table, right: pa.Table) -> pa.Table:
    """A bucket's verdicts, to each of its chunks in the chunk's order."""
    key = group_key(left, right)
    if key < 0:
        return block_table([])
    parts = [(chunk, unpack(b)["lines"]) for chunk, b in blocks(left)]
    line = np.unique(np.concatenate([x for _, x in parts]), return_inverse=True)[1]
    common = unpack(blocks(right)[0][1])["common"][line]
    ends = np.cumsum([len(x) for _, x in parts])[:-1]
    return block_table([(-1 - chunk, key, pack(common=c)) for (chunk, _), c in zip(parts, np.split(common, ends))])


def judge(min_left: float, min_words: int, max_repeat_percent: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        key = group_key(left, right)
        if key >= 0 or not left.num_rows:
            return block_result([])
        own = unpack(blocks(left)[0][1])
        told = [unpack(b)["common"] for _, b in blocks(right)]
        common = np.concatenate([*told, np.zeros(1, bool)])
        gone = common[own["line"]]  # -1, a blank line, reads the last entry
        doc = np.repeat(np.arange(len(own["ids"])), own["n_lines"])
        removed = np.bincount(doc, weights=gone, minlength=len(own["ids"])).astype(np.int64)
        lost = np.bincount(doc, weights=gone * own["words"], minlength=len(own["ids"])).astype(np.int64)
        rows, at = [], 0
        for i, (doc_id, stats, repeats) in enumerate(zip(own["ids"], own["stats"].tolist(), own["repeats"].tolist())):
            n, n_lines = stats[0], int(own["n_lines"][i])
            failed = n < min_words or 100 * repeats > max_repeat_percent * n
            rest = n - int(lost[i])
            text = None
            if own["texts"] is not None:
                cut = gone[at:at + n_lines]
                text = b"\n".join(x for x, c in zip(own["texts"][i].split(b"\n"), cut) if not c).decode()
            rows.append((doc_id, *stats, repeats, failed, not failed and rest >= min_left * n,
                         int((own["line"][at:at + n_lines] >= 0).sum()), int(removed[i]), rest, text))
            at += n_lines
        return block_result(rows)
    return run


def block_result(rows: list[tuple]) -> pa.Table:
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in (*COUNTS, "n_repeat_words")),
                        ("base_failed", pa.bool_()), ("kept", pa.bool_()),
                        *((c, pa.int64()) for c in ("n_lines", "n_common_lines", "n_words_left")),
                        ("clean_text", pa.string())])
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def apply_line_rules(docs: DataFrame, *, host: str = "source", max_documents: int = 100, min_left: float = 0.5,
                     min_words: int = 20, max_repeat_percent: int = 30, with_text: bool = False,
                     chunk_bytes: int = 16_000_000) -> DataFrame:
    """The rules' counts and verdict for every document; ``clean_text`` (with
    ``with_text``) is the text without the lines that more than
    ``max_documents`` texts of its host have."""
    spark = docs.sparkSession
    small_batches(spark)
    shards, most = shard_count(spark), max_documents + 1
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 + isqrt(size // chunk_bytes)
    by_key = lambda df: df.groupBy("key")
    sent = docs.select(docs["doc_id"].cast("long"), docs[host].cast("string"), docs["text"]) \
        .mapInArrow(sender(shards, buckets, most, chunk_bytes, with_text), BLOCK)
    merged_lines = by_key(sent).applyInArrow(merger(shards, buckets, most), BLOCK)
    totals = by_key(merged_lines).applyInArrow(total(max_documents), BLOCK)
    told = by_key(sent).cogroup(by_key(totals)).applyInArrow(tell_chunks, BLOCK)
    found = by_key(sent).cogroup(by_key(told)) \
        .applyInArrow(judge(min_left, min_words, max_repeat_percent), RESULT)
    return found if with_text else found.drop("clean_text")


def kept_documents(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("kept"))
