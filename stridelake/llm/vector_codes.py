"""Vector code compression: product codes learned and assigned by exact integers.

Vectors become integers, floor(scale * x), and are cut into equal parts; every
part position has a codebook. A codebook starts as that part of the first
vectors by id; a round gives every part to its nearest entry and moves the
entries to the floor of their parts' mean; at the end all parts are given again
and an entry's number is that part's code.

Method. A chunk of vectors is laid out once: for every part position the
chunk's parts are sorted along a Hilbert curve and cut into flat blocks of
``block`` neighbours, stored with the least and greatest corner of their box and
with their sum. In a round the distances from a block's box to the entries make
its shortlist: an entry whose least distance to the box is more than another's
greatest distance can win no part of the block, nor can one that is further than
the entry of the least greatest distance in every corner of the box. A block with one entry on its
list adds its stored sum; the others are settled by an integer kernel over
(block, listed entry) pairs, with ties to the lower number. Everything is exact:
distances and sums are 64-bit integers.

Scale. Chunks are written once to the shared checkpoint folder, then each pass
is a map over chunks. A task adds up its chunks, so at most parts * entries
small rows a task are shuffled and parts * entries rows reach the driver, which
sends the codebooks (a few thousand integers) with the next pass. Nothing is
grouped by a key of the data but the label sums, which are partially aggregated.

Defined cases: a null vector, or one with a null, NaN or infinite component, is
left out; repeated rows count as often as they occur and give a row each; the
first vectors are taken in the order of id (null last), then of their
components; fewer vectors than entries give smaller codebooks; an empty table
gives no rows; a null label is a label of its own; other columns are ignored.
Vectors of different lengths, a length that ``parts`` does not divide, and
integers beyond ``LARGEST`` (whose squares would not fit) are errors.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from ..session import checkpoint_root
from .common import pack, unpack

#: Magnitude of an integer component: its squared differences fit 64 bits
#: for parts of up to 256 components, with an entry's number beside them.
LARGEST = 1 << 21
CHUNK = 32768
BLOCK = 32


# --- layout --------------------------------------------------------------------

def kept_vectors(vectors: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is whole and finite."""
    limit = float("inf")
    return vectors.where(F.col(vector).isNotNull()).where(F.forall(
        F.col(vector), lambda x: F.coalesce((F.abs(x) < limit) & ~F.isnan(x), F.lit(False))))


def as_integers(batch: pa.RecordBatch, column: int, parts: int, scale: float) -> np.ndarray:
    """(rows, components) of a batch of whole, finite vectors."""
    lists = batch.column(column)
    lengths = np.diff(np.asarray(lists.offsets))
    if len(lengths) and (lengths.min() != lengths.max() or lengths[0] % parts or not lengths[0]):
        raise ValueError(f"vectors need one length that {parts} divides")
    flat = np.floor(np.asarray(lists.flatten(), np.float64) * scale)
    if len(flat) and np.abs(flat).max() > LARGEST:
        raise ValueError(f"components beyond {LARGEST} / {scale}")
    return flat.astype(np.int64).reshape(len(lengths), -1)


def hilbert_rank(points: np.ndarray) -> np.ndarray:
    """Order of integer points along the Hilbert curve of their box: the axes'
    bits are Gray-decoded from the highest plane down, each plane turning the
    lower bits of the axes before it, and interleaved."""
    low = points.min(axis=0)
    axes = [(points[:, d] - low[d]).astype(np.uint64) for d in range(points.shape[1])]
    bits = max(1, min(int(max(a.max() for a in axes)).bit_length(), 62 // max(1, len(axes)) or 1))
    drop = np.uint64(max(0, int(max(a.max() for a in axes)).bit_length() - bits))
    axes = [a >> drop for a in axes]
    for plane in range(bits - 1, 0, -1):
        q = np.uint64(1 << plane)
        lower = q - np.uint64(1)
        for d, axis in enumerate(axes):
            is_set = (axis & q) > 0
            swap = (axes[0] ^ axis) & lower
            axes[0] = np.where(is_set, axes[0] ^ lower, axes[0] ^ swap)
            if d:
                axes[d] = np.where(is_set, axis, axis ^ swap)
    for d in range(1, len(axes)):
        axes[d] = axes[d] ^ axes[d - 1]
    turn = np.zeros_like(axes[0])
    for plane in range(bits - 1, 0, -1):
        q = np.uint64(1 << plane)
        turn = np.where((axes[-1] & q) > 0, turn ^ (q - np.uint64(1)), turn)
    axes = [a ^ turn for a in axes]
    code = np.zeros_like(axes[0])
    for plane in range(bits - 1, -1, -1):
        for axis in axes[:max(1, 62 // bits)]:
            code = code << np.uint64(1) | (axis >> np.uint64(plane)) & np.uint64(1)
    return np.argsort(code, kind="stable")


def lay_out(vectors: np.ndarray, parts: int, block: int) -> list[dict]:
    """For every part position: the parts in Hilbert order, padded to whole
    blocks with their last one, and the blocks' boxes, sums and sizes."""
    n, width = len(vectors), vectors.shape[1] // parts
    small = np.int16 if np.abs(vectors).max(initial=0) < 1 << 15 else np.int32
    flat = []
    for part in range(parts):
        own = vectors[:, part * width:(part + 1) * width]
        order = hilbert_rank(own)
        blocks = own[np.concatenate([order, np.repeat(order[-1:], -n % block)])].reshape(-1, block, width)
        sizes = np.full(len(blocks), block)
        sizes[-1] -= -n % block
        sums = blocks.sum(axis=1)
        sums[-1] = blocks[-1][:sizes[-1]].sum(axis=0)
        flat.append({"order": order.astype(np.int32), "points": blocks.astype(small), "low": blocks.min(axis=1),
                     "high": blocks.max(axis=1), "sums": sums, "sizes": sizes})
    return flat


def chunks(parts: int, scale: float, chunk: int, block: int, schema: pa.Schema):
    """(kept columns..., vector) -> (arrays of kept columns..., blocks)."""
    def run(batches):
        columns, found, held = [], [], 0

        def whole():
            rows = [pa.concat_arrays(c) for c in zip(*columns)]
            data = pack(parts=lay_out(np.concatenate(found), parts, block))
            lists = [pa.ListArray.from_arrays(pa.array([0, len(r)], pa.int32()), r) for r in rows]
            return pa.RecordBatch.from_arrays(
                [*[a.cast(f.type) for a, f in zip(lists, schema)], pa.array([data], pa.binary())], schema=schema)

        for batch in batches:
            for start in range(0, batch.num_rows, chunk):
                piece = batch.slice(start, chunk)
                found.append(as_integers(piece, piece.num_columns - 1, parts, scale))
                columns.append([piece.column(i) for i in range(piece.num_columns - 1)])
                held += piece.num_rows
                if held >= chunk:
                    yield whole()
                    columns, found, held = [], [], 0
        if held:
            yield whole()
    return run


# --- one pass --------------------------------------------------------------------

def shortlists(part: dict, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(block, entry) pairs that a block's box cannot rule out, by block."""
    low, high = part["low"][:, None, :], part["high"][:, None, :]
    outside = np.maximum(np.maximum(low - book, book - high), 0)
    furthest = np.maximum(np.abs(book - low), np.abs(book - high))
    least, most = (outside ** 2).sum(axis=2), (furthest ** 2).sum(axis=2)
    listed = least <= most.min(axis=1, keepdims=True)
    # The difference of two entries' distances is linear over the box, so its
    # greatest value lies in a corner: below 0, the other entry always loses.
    rival = book[most.argmin(axis=1)][:, None, :]
    slope = 2 * (book - rival)
    corner = (rival ** 2).sum(axis=2) - (book ** 2).sum(axis=1) + np.maximum(low * slope, high * slope).sum(axis=2)
    return np.nonzero(listed & (corner >= 0))


def nearest(part: dict, book: np.ndarray, block: np.ndarray, entry: np.ndarray, pairs: int = 1 << 14):
    """Entry and squared distance of every point of the listed blocks (two
    arrays, block by block). ``pairs`` are looked at together."""
    heads = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    ends = np.append(heads[1:], len(block))
    points, entries = part["points"], len(book)
    chosen = np.empty((len(heads), points.shape[1]), np.int64)
    a = 0
    while a < len(heads):
        b = max(a + 1, int(np.searchsorted(ends, heads[a] + pairs, side="right")))
        own = slice(heads[a], ends[b - 1])
        distance = np.zeros((own.stop - own.start, points.shape[1]), np.int64)
        for d in range(points.shape[2]):
            difference = points[block[own], :, d].astype(np.int64) - book[entry[own], d][:, None]
            distance += difference * difference
        chosen[a:b] = np.minimum.reduceat(distance * entries + entry[own][:, None], heads[a:b] - heads[a], axis=0)
        a = b
    return chosen % entries, chosen // entries


def add_up(part: dict, book: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> None:
    """Adds a chunk's parts to their nearest entries' counts and sums."""
    block, entry = shortlists(part, book)
    listed = np.bincount(block, minlength=len(part["sizes"]))
    single = listed[block] == 1
    np.add.at(counts, entry[single], part["sizes"][block[single]])
    np.add.at(sums, entry[single], part["sums"][block[single]])
    block, entry = block[~single], entry[~single]
    if len(block):
        own = np.unique(block)
        found, _ = nearest(part, book, block, entry)
        real = np.arange(found.shape[1])[None, :] < part["sizes"][own][:, None]
        np.add.at(counts, found[real], 1)
        np.add.at(sums, found[real], part["points"][own][real].astype(np.int64))


def summing(books: list[np.ndarray]):
    """Chunks -> (part, entry, n, sums): what a task's parts add to the entries."""
    schema = pa.schema([("part", pa.int64()), ("entry", pa.int64()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])

    def run(batches):
        counts = [np.zeros(len(b), np.int64) for b in books]
        sums = [np.zeros(b.shape, np.int64) for b in books]
        for batch in batches:
            for blob in batch.column(0):
                for part, book, n, s in zip(unpack(blob.as_py())["parts"], books, counts, sums):
                    add_up(part, book, n, s)
        rows = [(p, e, int(n), sums[p][e].tolist()) for p, own in enumerate(counts) for e, n in enumerate(own) if n]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    return run


def assigning(books: list[np.ndarray], schema: pa.Schema):
    """(arrays of kept columns..., blocks) -> (kept columns..., codes, error)."""
    def run(batches):
        for batch in batches:
            last = batch.num_columns - 1
            for row in range(batch.num_rows):
                parts = unpack(batch.column(last)[row].as_py())["parts"]
                n = len(parts[0]["order"])
                codes, error = np.zeros((n, len(parts)), np.int64), np.zeros(n, np.int64)
                for p, (part, book) in enumerate(zip(parts, books)):
                    found, distance = nearest(part, book, *shortlists(part, book))
                    codes[part["order"], p] = found.reshape(-1)[:n]
                    error[part["order"]] += distance.reshape(-1)[:n]
                digits = 2 * max(1, -(-(int(max(map(len, books))) - 1).bit_length() // 8))
                text = ["".join(f"{c:0{digits}x}" for c in row) for row in codes.tolist()]
                kept = [batch.column(i)[row].values for i in range(last)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(text), pa.array(error)], schema=schema)
    return run


# --- the operator ------------------------------------------------------------------

class Compressed:
    """``rows``: kept columns, code, error; ``books``: the final codebooks."""

    def __init__(self, rows: DataFrame, books: list[np.ndarray]):
        self.rows, self.books = rows, books

    def books_sha256(self) -> str:
        return hashlib.sha256(",".join(str(x) for b in self.books for x in b.reshape(-1).tolist()).encode()).hexdigest()


def first_books(kept: DataFrame, key: str, vector: str, parts: int, entries: int, scale: float) -> list[np.ndarray]:
    """Codebooks of the first vectors by id (``entries`` rows reach the driver)."""
    first = kept.orderBy(F.col(key).asc_nulls_last(), vector).limit(entries).select(vector).toArrow()
    rows = [as_integers(b, 0, parts, scale) for b in first.combine_chunks().to_batches() if b.num_rows]
    if not rows:
        return []
    table = np.concatenate(rows)
    return [b.copy() for b in np.split(table, parts, axis=1)]


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", keep: tuple[str, ...] = ("label",),
             parts: int = 16, entries: int = 64, rounds: int = 2, scale: float = 256.0,
             chunk: int = CHUNK, block: int = BLOCK) -> Compressed:
    """Product codes of all vectors and the codebooks they refer to."""
    spark = vectors.sparkSession
    folder = f"{checkpoint_root(spark).rstrip('/')}/vector-codes-{uuid.uuid4().hex}"
    kept = kept_vectors(vectors.select(key, *keep, F.col(vector).cast("array<double>").alias(vector)), vector)
    books = first_books(kept, key, vector, parts, entries, scale)
    names = [key, *keep]
    fields = [kept.schema[c] for c in names]
    rows = StructType([*[StructField(f.name, f.dataType) for f in fields], StructField("code", StringType()), StructField("error", LongType())])
    if not books:
        return Compressed(spark.createDataFrame([], rows), books)
    blocks = StructType([*[StructField(f.name, ArrayType(f.dataType)) for f in fields], StructField("blocks", BinaryType())])
    kept.mapInArrow(chunks(parts, scale, chunk, block, to_arrow_schema(blocks)), blocks).write.parquet(f"{folder}/chunks")
    laid = spark.read.schema(blocks).parquet(f"{folder}/chunks")
    for _ in range(rounds):
        width = books[0].shape[1]
        totals = (laid.select("blocks").mapInArrow(summing(books), "part long, entry long, n long, sums array<long>")
                  .groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[d]).alias(f"s{d}") for d in range(width)]))
        books = [b.copy() for b in books]
        for row in totals.collect():                    # parts * entries rows at most
            books[row["part"]][row["entry"]] = [row[f"s{d}"] // row["n"] for d in range(width)]
    laid.mapInArrow(assigning(books, to_arrow_schema(rows)), rows).write.parquet(f"{folder}/codes")
    return Compressed(spark.read.schema(rows).parquet(f"{folder}/codes"), books)


def compression_digest(done: Compressed) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256."""
    sums = done.rows.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    return (done.rows.join(sums, F.col("label").eqNullSafe(F.col("_label")))
            .select("vec_id", "code", "error", "label_error", F.lit(done.books_sha256()).alias("codebooks_sha256")))
