"""Conversation prefix trie by truncation peeling.

Every distinct sequence of the first d turns of a conversation is a node. The
operator returns the nodes with their members, children, leaves and what could
be saved by sharing their prefixes.

Method. Conversations are peeled from the greatest depth: at depth d the nodes
that survive from below are joined by the conversations that end there, equal
prefixes are regrouped, the groups are nodes, their sums are complete, and their
last turn is stripped so that they go on as members of depth d - 1. Nodes are
found and summed in the same pass.

Scale. Texts are replaced by digests (16 bytes and a length a turn) in the scan.
One range shuffle sorts the conversations by their digests, so a node's members
are neighbours, and every run of at most ``run_bytes`` is peeled for itself in a
task. A run's nodes are final but for those on the path of its first or its last
conversation, which may reach into the next run: these two paths go on with
their partial sums, are sorted and peeled again, with fewer paths each time,
until at most ``last_paths`` are left for one task. So a first turn, a prefix or
a whole conversation that a third of all rows share is spread over as many runs
as its rows need, and only its path meets. The ids of conversations that end in
such a node are joined run by run; the pieces are hashed in order by a stream
that holds one piece at a time. Every round is a table in the shared checkpoint
folder; a lost executor costs the tasks of a round.

A conversation's digests are one row (24 bytes a turn): that, a run and
``last_paths`` bound the memory.

Defined cases: rows with a null conv_id belong to no conversation and are left
out; a null role or text is empty; a null turn comes first; rows of one
conversation with the same turn come in the order of their digests (a repeated
row is one more turn); an empty table has no nodes; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root
from .common import mix64, pack, unpack

DIGEST = 16
NO_ID = np.iinfo(np.int64).max
NO_MEMBERS = hashlib.sha256(b"").hexdigest()
#: What a peel round writes: nodes, paths that go on, pieces of members' ids.
ROUND = ("kind string, conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
         "ends string, parent_conv_id long, parent_id binary, node_id binary, key binary, sizes array<long>, blob binary")
ROUND_ARROW = pa.schema([
    ("kind", pa.string()), *[(c, pa.int64()) for c in ("conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens")],
    ("ends", pa.string()), ("parent_conv_id", pa.int64()), ("parent_id", pa.binary()), ("node_id", pa.binary()),
    ("key", pa.binary()), ("sizes", pa.list_(pa.int64())), ("blob", pa.binary())])
COUNTS = ("n", "least", "children", "leaves", "saved")


# --- conversations as digests --------------------------------------------------

def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, n_bytes) of every turn that has a conv_id."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.length(role).cast("string"), F.lit(" "), role, text)
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.md5(whole.cast("binary")).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"))


def rebuilt(conversations: DataFrame, family: int = 5, longest_head: int = 8) -> DataFrame:
    """(conv_id, key, sizes): each conversation continued from the first turns
    of its family's first one. ``key``: the turns' digests, one after another."""
    c = F.col("conv_id")
    turns = turn_rows(conversations).withColumn("base", c - c % family).repartition("base")
    whole = (turns.groupBy("base", "conv_id")
             .agg(F.sort_array(F.collect_list(F.struct("turn", "digest", "n_bytes"))).alias("own")))
    # A family has at most 2 * family - 1 conversations (the ids around 0).
    head = F.max(F.when(c == F.col("base"), F.slice("own", 1, longest_head))).over(Window.partitionBy("base"))
    h = (F.crc32(c.cast("string").cast("binary")) % (longest_head + 1)).cast("int")
    empty = F.slice("own", 1, 0)
    joined = F.concat(F.slice(F.coalesce(head, empty), F.lit(1), h),
                      F.slice("own", h + 1, F.greatest(F.size("own") - h, F.lit(0))))
    return (whole.select(c, joined.alias("turns"))
            .select(c, F.unhex(F.array_join(F.col("turns.digest"), "")).alias("key"), F.col("turns.n_bytes").alias("sizes")))


# --- one run ---------------------------------------------------------------------

def ragged(values: list[np.ndarray], dtype) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, values), np.int64, len(values))
    flat = np.concatenate([*values, np.zeros(0, dtype)]).astype(dtype, copy=False)
    return flat, np.cumsum(lengths) - lengths


class Run:
    """A run of sorted conversations and paths, peeled from the greatest depth.

    ``rows``: (key, sizes, conv_id or None, blob or None); a blob holds a path's
    partial sums from its depth ``start`` on."""

    def __init__(self, rows: list[tuple]):
        self.keys, self.sizes, ids = [], [], []
        parts = {name: [] for name in ("key", "depth", *COUNTS)}

        def add(depth, **sums):
            for name, values in dict(depth=depth, **sums).items():
                parts[name].append(np.asarray(values, np.int64))
            parts["key"].append(np.full(len(depth), len(self.keys) - 1))

        plain_key, plain_id = [], []
        for key, sizes, conv_id, blob in rows:
            if not self.keys or self.keys[-1] != key:
                self.keys.append(key)
                self.sizes.append(np.asarray(sizes, np.int64))
            if blob is None:
                plain_key.append(len(self.keys) - 1)
                plain_id.append(conv_id)
            else:
                path = unpack(blob)
                depths = np.arange(path["start"], path["start"] + len(path["n"]))
                add(depths, **{name: path[name] for name in COUNTS})
        self.lengths = np.fromiter((len(k) // DIGEST for k in self.keys), np.int64, len(self.keys))
        k, i = np.array(plain_key, np.int64), np.array(plain_id, np.int64)
        self.members = (k, i)
        none = np.zeros(len(k), np.int64)
        parts["key"].append(k)
        for name, values in (("depth", self.lengths[k]), ("n", none + 1), ("least", i),
                             ("children", none), ("leaves", none), ("saved", none)):
            parts[name].append(values)
        self.parts = {name: np.concatenate(values).astype(np.int64) for name, values in parts.items()}
        # Prefix sums of mixed digests: equal for equal prefixes, and neighbours
        # are compared only.
        both = np.frombuffer(b"".join(self.keys), "<u8").reshape(-1, 2)
        self.offset = np.cumsum(self.lengths) - self.lengths
        place = np.arange(len(both), dtype=np.int64) - np.repeat(self.offset, self.lengths)
        mixed = mix64(both[:, 0] ^ mix64(place.astype(np.uint64))) + mix64(both[:, 1])
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
        self.flat_sizes, _ = ragged(self.sizes, np.int64)

    def prefix(self, key: np.ndarray, depth) -> np.ndarray:
        at = self.offset[key]
        return self.sums[at + depth] - self.sums[at]

    def node_id(self, key: int, depth: int) -> bytes:
        return hashlib.blake2b(self.keys[key][:DIGEST * depth], digest_size=16).digest()

    def peel(self, last: bool, named: bool):
        """Nodes (columns), paths (rows), pieces of ids (rows). ``last``: nothing
        reaches beyond this run; ``named``: nodes carry their id, since earlier
        runs may name them as parents."""
        deepest = int(self.lengths.max())
        order = np.argsort(self.parts["depth"], kind="stable")
        parts = {name: values[order] for name, values in self.parts.items()}
        begin = np.searchsorted(parts["depth"], np.arange(deepest + 2))
        first, final = 0, len(self.keys) - 1
        tail = len(self.keys) > 1
        path = {k: {name: np.full(int(self.lengths[k]) + 1, NO_ID if name == "least" else 0, np.int64) for name in COUNTS}
                for k in {first, final}}
        start = 0                                       # where the last path leaves the first one
        if tail:
            common = int(min(self.lengths[first], self.lengths[final]))
            depths = np.arange(common + 1)
            start = int(np.flatnonzero(self.prefix(np.full(common + 1, first), depths)
                                       == self.prefix(np.full(common + 1, final), depths))[-1]) + 1
        nodes, above = [], None
        alive = {name: np.zeros(0, np.int64) for name in ("key", *COUNTS, "row")}
        total = 0
        for depth in range(deepest, -1, -1):
            here = slice(begin[depth], begin[depth + 1])
            ended = {name: parts[name][here] for name in ("key", *COUNTS)}
            ended["row"] = np.full(len(ended["key"]), -1)
            # Survivors stand for a child each.
            level = {name: np.concatenate([alive[name], ended[name]]) for name in alive}
            if not len(level["key"]):
                continue
            by_key = np.argsort(level["key"], kind="stable")
            level = {name: values[by_key] for name, values in level.items()}
            mark = self.prefix(level["key"], depth)
            group_start = np.concatenate([[True], mark[1:] != mark[:-1]])
            heads = np.flatnonzero(group_start)
            group = np.cumsum(group_start) - 1
            key = level["key"][heads]
            sums = {name: np.add.reduceat(level[name], heads) for name in COUNTS if name != "least"}
            sums["least"] = np.minimum.reduceat(level["least"], heads)
            open_ = np.zeros(len(heads), bool)
            if not last:
                for edge in {first, final}:
                    if self.lengths[edge] >= depth:
                        at = np.flatnonzero(mark[heads] == self.prefix(np.array([edge]), depth))
                        open_[at] = True
                        keep = path[first] if edge == final and depth < start else path[edge]
                        for name in COUNTS:
                            for a in at:
                                keep[name][depth] = sums[name][a]
            closed = np.flatnonzero(~open_)
            leaves = np.where(sums["children"] == 0, 1, sums["leaves"])
            size = self.flat_sizes[self.offset[key] + depth - 1] if depth else np.zeros(len(heads), np.int64)
            saved = sums["saved"] + (sums["n"] - 1) * size
            # Parents of the nodes below are known now.
            row = level["row"]
            child = np.flatnonzero(row >= 0)
            rows_below = row[child]
            if above is not None and len(rows_below):
                mother = group[child]
                above["parent_conv_id"][rows_below] = np.where(open_[mother], NO_ID, sums["least"][mother])
                for r, m in zip(rows_below[open_[mother]], mother[open_[mother]]):
                    above["parent_id"][r] = self.node_id(key[m], depth)
            if above is not None:
                nodes.append(above)
            above = {"key": key[closed], "depth": np.full(len(closed), depth), "conv_id": sums["least"][closed],
                     "n_convs": sums["n"][closed], "n_children": sums["children"][closed], "n_leaves": leaves[closed],
                     "saved_tokens": saved[closed], "parent_conv_id": np.full(len(closed), NO_ID),
                     "parent_id": [None] * len(closed),
                     "node_id": [self.node_id(k, depth) for k in key[closed]] if named else [None] * len(closed)}
            alive = {"key": key[closed], "n": sums["n"][closed], "least": sums["least"][closed],
                     "children": np.ones(len(closed), np.int64), "leaves": leaves[closed], "saved": saved[closed],
                     "row": np.arange(len(closed))}
            total += len(closed)
        if above is not None:
            nodes.append(above)
        pieces = self.ended(nodes, last)
        paths = []
        if not last:
            paths.append((self.keys[first], self.sizes[first], pack(start=0, **path[first])))
            if tail and start <= self.lengths[final]:
                paths.append((self.keys[final], self.sizes[final],
                              pack(start=start, **{n: v[start:] for n, v in path[final].items()})))
        return nodes, paths, pieces

    def ended(self, nodes: list[dict], last: bool):
        """Hashes of the members that end in a node, set in ``nodes``; for nodes
        that are still open, (node_id, first id, joined ids) of this run."""
        key, ids = self.members
        joined: dict[int, tuple[int, bytes]] = {}
        if len(key):
            heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            for a, b in zip(heads, np.append(heads[1:], len(key))):
                own = np.sort(ids[a:b])
                joined[int(key[a])] = (int(own[0]), ",".join(map(str, own.tolist())).encode())
        whole = {}
        for level in nodes:
            level["ends"] = [NO_MEMBERS] * len(level["depth"])
            for r, (k, depth) in enumerate(zip(level["key"].tolist(), level["depth"].tolist())):
                if self.lengths[k] == depth and k in joined:
                    level["ends"][r] = hashlib.sha256(joined[k][1]).hexdigest()
                    whole[k] = True
        return [(self.node_id(k, int(self.lengths[k])), least, text)
                for k, (least, text) in joined.items() if k not in whole]


def peeling(run_bytes: int, last: bool, named: bool):
    """Sorted rows (key, sizes, conv_id, blob) -> rows of ``ROUND``."""
    def emit(rows):
        nodes, paths, pieces = Run(rows).peel(last, named)
        for level in nodes:
            count = len(level["depth"])
            if count:
                lost = level["parent_conv_id"] == NO_ID
                given = {name: pa.array(level[name], pa.int64())
                         for name in ("conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens")}
                yield {**given, "kind": pa.array(["node"] * count), "ends": pa.array(level["ends"], pa.string()),
                       "parent_conv_id": pa.array(level["parent_conv_id"], pa.int64(), mask=lost),
                       "parent_id": pa.array(level["parent_id"], pa.binary()),
                       "node_id": pa.array(level["node_id"], pa.binary())}
        if paths:
            yield {"kind": pa.array(["path"] * len(paths)), "key": pa.array([p[0] for p in paths], pa.binary()),
                   "sizes": pa.array([p[1] for p in paths], pa.list_(pa.int64())),
                   "blob": pa.array([p[2] for p in paths], pa.binary())}
        if pieces:
            yield {"kind": pa.array(["ends"] * len(pieces)), "node_id": pa.array([p[0] for p in pieces], pa.binary()),
                   "conv_id": pa.array([p[1] for p in pieces], pa.int64()),
                   "blob": pa.array([p[2] for p in pieces], pa.binary())}

    def batch_of(columns):
        count = len(columns["kind"])
        return pa.RecordBatch.from_arrays(
            [columns[f.name] if f.name in columns else pa.nulls(count, f.type) for f in ROUND_ARROW], schema=ROUND_ARROW)

    def run(batches):
        rows, held = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                rows.append(row)
                held += len(row[0]) + 8 * len(row[1]) + 120 + len(row[3] or b"")
                if held >= run_bytes:
                    yield from map(batch_of, emit(rows))
                    rows, held = [], 0
        if rows:
            yield from map(batch_of, emit(rows))
    return run


def hashing(batches):
    """(node_id, conv_id, blob) sorted by the first two -> (node_id, ends)."""
    node, state = None, None
    schema = pa.schema([("node_id", pa.binary()), ("found_ends", pa.string())])
    for batch in batches:
        done = []
        for node_id, blob in zip(batch.column("node_id").to_pylist(), batch.column("blob")):
            if node_id != node:
                if node is not None:
                    done.append((node, state.hexdigest()))
                node, state = node_id, hashlib.sha256(blob.as_py())
            else:
                state.update(b",")
                state.update(blob.as_py())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([state.hexdigest()])], schema=schema)


# --- the operator ------------------------------------------------------------------

def prefix_nodes(rows: DataFrame, run_bytes: int = 16 << 20, last_paths: int = 20_000) -> DataFrame:
    """All nodes of the trie of ``rows`` (conv_id, key, sizes): conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = rows.sparkSession
    folder = f"{checkpoint_root(spark).rstrip('/')}/prefix-trie-{uuid.uuid4().hex}"
    todo = rows.select("key", "sizes", "conv_id", F.lit(None).cast("binary").alias("blob"))
    dealt = todo.repartitionByRange("key", "conv_id")
    tables, number, last = [], 0, False
    while True:
        path = f"{folder}/round-{number}"
        (dealt.sortWithinPartitions("key", "conv_id")
         .mapInArrow(peeling(1 << 62 if last else run_bytes, last, number > 0), ROUND)
         .write.partitionBy("kind").parquet(path))
        tables.append(spark.read.schema(ROUND).parquet(path))
        if last:
            break
        todo = tables[-1].where("kind = 'path'").select("key", "sizes", "conv_id", "blob")
        paths = todo.count()
        if not paths:
            break
        # Two paths go on from each run, so longer and fewer runs each time.
        last, number, run_bytes = paths <= last_paths, number + 1, 4 * run_bytes
        dealt = todo.repartition(1) if last else todo.repartitionByRange(max(1, paths // 1000), "key", "conv_id")
    found = tables[0]
    for t in tables[1:]:
        found = found.unionByName(t)
    return with_parents(found)


def with_parents(found: DataFrame) -> DataFrame:
    """Nodes of all rounds with the parents and members' hashes that only later
    rounds knew."""
    def columns(parent: Column, ends: Column):
        return ["conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                "saved_tokens", ends.alias("ends_sha256")]

    nodes = found.where("kind = 'node'").drop("kind", "key", "sizes", "blob")
    settled = nodes.where("parent_id is null and node_id is null")
    rest = nodes.where("parent_id is not null or node_id is not null")
    late = nodes.where("node_id is not null").select(F.col("node_id").alias("late_id"), F.col("conv_id").alias("late_conv"))
    hashes = (found.where("kind = 'ends'").select("node_id", "conv_id", "blob")
              .repartition("node_id").sortWithinPartitions("node_id", "conv_id")
              .mapInArrow(hashing, "node_id binary, found_ends string")
              .withColumnRenamed("node_id", "hash_id"))
    rest = (rest.join(hashes, rest["node_id"] == hashes["hash_id"], "left")
            .join(late, rest["parent_id"] == late["late_id"], "left"))
    return settled.select(*columns(F.col("parent_conv_id"), F.col("ends"))).unionByName(
        rest.select(*columns(F.coalesce("parent_conv_id", "late_conv"), F.coalesce("found_ends", "ends"))))


def conversation_trie(conversations: DataFrame, family: int = 5, longest_head: int = 8, run_bytes: int = 16 << 20,
                      last_paths: int = 20_000) -> DataFrame:
    """The prefix trie of all rebuilt conversations."""
    return prefix_nodes(rebuilt(conversations, family, longest_head), run_bytes, last_paths)
