"""Token counts by rank-synchronous merging of ragged arrays.

A text's tokens under a byte-level pair vocabulary with word ends: literals of
added tokens are taken out first (one token each); the rest is normalised, cut
into pre-tokens, and every pre-token's symbols are merged pair by pair, lowest
rank first. Only the number of surviving symbols is needed.

Method. The different pre-tokens of a run of texts lie behind each other in one
flat array of symbols. Each round finds the lowest rank among the neighbouring
pairs of every sequence (``minimum.reduceat``) and applies it in all sequences
at once, all places of a sequence together, left to right where they overlap;
then only the pairs beside a merge get new ranks. A sequence without a known
pair leaves the array with its length as count. Applying all places of the
lowest rank at once equals one at a time because a merge's result only takes
part in merges of higher rank; the table is checked for that.

Scale. A map over the documents: no shuffle, nothing reaches the driver. A task
remembers the counts of at most ``REMEMBERED`` fragments between white space and
holds a slice of a text at a time, so memory does not depend on text lengths
(but for a single fragment without white space, which stays whole).

Defined cases: null and empty texts count 0; every row gives one row, repeated
ones too, whatever its id; an empty table gives no rows; other columns are
ignored unless named in ``keep``.
"""

from __future__ import annotations

import json
import sys
import types

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: Different fragments whose counts a worker remembers; then it starts afresh.
REMEMBERED = 400_000
#: Bytes of text looked at together.
SLICE = 4 << 20
NO_RANK = np.int32(2**31 - 1)
SPACE = regex.compile(rb"[\x20\x09-\x0D]")
#: Characters whose composition, case and class no Unicode version changes:
#: fragments of these are normalised here, all others by the library.
PLAIN = regex.compile(r"[\x21-\x7e\xa1-\xac\xae-ſ]+")


def vocabulary_path() -> str:
    import public_tokenizers as P

    return P.path("word_bpe_49k.json")


class MergeTable:
    """Symbols and ranked pairs of a vocabulary file."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str):
        self.dense = max(vocab[c + end] for c in byte_letters() for end in ("", suffix)) + 1
        self.inner = np.array([vocab[c] for c in byte_letters()], np.int32)
        self.final = np.array([vocab[c + suffix] for c in byte_letters()], np.int32)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.result = np.array([vocab[a + b] for a, b in pairs], np.int32)
        made = np.full(max(vocab.values()) + 1, -1, np.int64)
        made[self.result] = np.arange(len(pairs))
        if len(np.unique(self.result)) < len(pairs) or np.any(np.maximum(made[left], made[right]) >= np.arange(len(pairs))):
            raise ValueError("a merge uses a symbol that a later merge makes")
        order = np.argsort(left << 32 | right)
        self.keys, self.ranks = (left << 32 | right)[order], order.astype(np.int32)
        self.first = np.full((self.dense, self.dense), NO_RANK, np.int32)
        small = (left < self.dense) & (right < self.dense)
        self.first[left[small], right[small]] = np.flatnonzero(small)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def survivors(self, tokens: list[bytes]) -> np.ndarray:
        """Symbols left of each token (non-empty) after all merges."""
        counts = np.zeros(len(tokens), np.int64)
        if not tokens:
            return counts
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        data = np.frombuffer(b"".join(tokens), np.uint8)
        symbols = self.inner[data]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.final[data[ends]]
        ranks = np.full(len(symbols), NO_RANK, np.int32)     # of the pair that begins here
        ranks[:-1] = self.first[symbols[:-1], symbols[1:]]
        ranks[ends] = NO_RANK
        number = np.arange(len(tokens))
        while len(number):
            starts = np.cumsum(lengths) - lengths
            lowest = np.minimum.reduceat(ranks, starts)
            going = lowest < NO_RANK
            if not going.all():
                counts[number[~going]] = lengths[~going]
                keep = np.repeat(going, lengths)
                symbols, ranks = symbols[keep], ranks[keep]
                number, lengths, lowest = number[going], lengths[going], lowest[going]
                if not len(number):
                    break
            sequence = np.repeat(np.arange(len(number)), lengths)
            at = np.flatnonzero(ranks == lowest[sequence])
            # Places of one rank overlap in a run of equal symbols only: every
            # second place of such a run, from its left end.
            run = np.concatenate([[0], np.cumsum(np.diff(at) != 1)])
            head = np.flatnonzero(np.concatenate([[True], np.diff(run) != 0]))
            at = at[(np.arange(len(at)) - head[run]) % 2 == 0]
            symbols[at] = self.result[ranks[at]]
            ranks[at] = ranks[at + 1]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, ranks = symbols[keep], ranks[keep]
            gone = np.bincount(sequence[at], minlength=len(number))
            lengths = lengths - gone
            at = at - np.arange(len(at))                     # where the merged symbols are now
            last = np.cumsum(lengths) - 1
            is_last = np.zeros(len(symbols), bool)
            is_last[last] = True
            for place in (at[~is_last[at]], at[(at > 0) & ~is_last[at - 1]] - 1):
                ranks[place] = self.rank(symbols[place], symbols[place + 1])
            ranks[last] = NO_RANK
        return counts


def byte_letters() -> list[str]:
    """The printable letters that stand for the 256 bytes: a byte that is
    printable in Latin-1 stands for itself, the others follow from U+0100."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class Counter:
    """Tokens of texts under one vocabulary file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        steps = spec["pre_tokenizer"].get("pretokenizers", [])
        if [s["type"] for s in steps] != ["Split", "ByteLevel"] or not model.get("end_of_word_suffix"):
            raise ValueError("a vocabulary of another kind")
        split, bytes_step = steps
        if (model["type"] != "BPE" or model["continuing_subword_prefix"] or bytes_step["add_prefix_space"]
                or (split["behavior"], split["invert"]) != ("Removed", True)
                or [n["type"] for n in spec["normalizer"]["normalizers"]] != ["NFC", "Replace", "Lowercase"]
                or any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"])):
            raise ValueError("a vocabulary of another kind")
        library = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self.parts = regex.compile(split["pattern"]["Regex"]).findall
        self.byte_of = {c: b for b, c in enumerate(byte_letters())}
        self.added = [t["content"].encode() for t in spec["added_tokens"]]
        self.cut_added = regex.compile(b"|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))))
        self.table = MergeTable(model["vocab"], model["merges"], model["end_of_word_suffix"])
        self.known: dict[bytes, int] = {}

    def pre_tokens(self, fragment: bytes) -> list[bytes]:
        text = fragment.decode("utf-8")
        if PLAIN.fullmatch(text):
            return [p.encode("utf-8") for p in self.parts(text.lower())]
        found = self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(text))
        return [bytes(map(self.byte_of.__getitem__, p)) for p, _ in found]

    def learn(self, fragments: set[bytes]) -> None:
        """Counts of fragments that are not known yet."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = [f for f in fragments if f not in self.known]
        numbers: dict[bytes, int] = {}
        owner, token = [], []
        for i, fragment in enumerate(new):
            for p in self.pre_tokens(fragment):
                owner.append(i)
                token.append(numbers.setdefault(p, len(numbers)))
        counts = self.table.survivors(list(numbers))
        sums = np.bincount(np.array(owner, np.int64), counts[np.array(token, np.int64)], minlength=len(new))
        self.known.update(zip(new, sums.astype(np.int64).tolist()))

    def fragments(self, data: bytes) -> tuple[list[bytes], int]:
        """What is between white space and added tokens; the number of these."""
        if not any(a in data for a in self.added):
            return data.split(), 0
        parts = self.cut_added.split(data)
        return [f for p in parts for f in p.split()], len(parts) - 1

    def counts(self, texts: list[bytes]) -> list[int]:
        found = [self.fragments(t) for t in texts]
        self.learn(set().union(*[f for f, _ in found]) if found else set())
        known = self.known.__getitem__
        return [sum(map(known, f)) + n for f, n in found]


def slices(data: bytes, size: int):
    """A text in pieces that end before white space."""
    start = 0
    while len(data) - start > size:
        space = SPACE.search(data, start + size)
        if not space:
            break
        yield data[start:space.start()]
        start = space.start()
    yield data[start:]


def worker_counter(path: str) -> Counter:
    """One vocabulary and memory for all tasks of a worker process."""
    kept = sys.modules.setdefault("_worker_token_counts", types.ModuleType("_worker_token_counts"))
    if not hasattr(kept, path):
        setattr(kept, path, Counter(path))
    return getattr(kept, path)


def counting(path: str, schema: pa.Schema, slice_bytes: int):
    """Batches of (kept columns..., text) -> (kept columns..., n_bytes, n_tokens)."""
    def run(batches):
        counter = worker_counter(path)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            sizes = np.zeros(batch.num_rows, np.int64)
            totals = np.zeros(batch.num_rows, np.int64)
            rows, waiting, held = [], [], 0
            for i in range(batch.num_rows):
                data = (texts[i].as_py() or "").encode("utf-8")
                sizes[i] = len(data)
                for piece in slices(data, slice_bytes):
                    rows.append(i)
                    waiting.append(piece)
                    held += len(piece)
                    if held >= slice_bytes:
                        np.add.at(totals, rows, counter.counts(waiting))
                        rows, waiting, held = [], [], 0
            if waiting:
                np.add.at(totals, rows, counter.counts(waiting))
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*[c.cast(f.type) for c, f in zip(columns, schema)], pa.array(sizes), pa.array(totals)], schema=schema)
    return run


def count_tokens(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text",
                 vocabulary: str | None = None, slice_bytes: int = SLICE) -> DataFrame:
    """``keep`` columns, ``n_bytes`` and ``n_tokens`` of every text (no begin,
    end or other added tokens but those written in the text)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import LongType, StructField, StructType

    small_batches(docs.sparkSession)
    chosen = docs.select(*[F.col(c) for c in keep], F.col(text).alias("_text"))
    out = StructType([*chosen.schema.fields[:-1], StructField("n_bytes", LongType()), StructField("n_tokens", LongType())])
    return chosen.mapInArrow(counting(vocabulary or vocabulary_path(), to_arrow_schema(out), slice_bytes), out)


def count_digest(counted: DataFrame, limit: int = 2048) -> DataFrame:
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
