"""Hierarchical Pitman-Yor language model, trained and applied at once.

Model. A token's context is the word before it (an end mark at a text's
start). Each context is a Chinese restaurant whose dishes are words; all of
them share one parent, the root restaurant, whose base is uniform over the V
training words and one unknown word. A customer of a context restaurant that
opens a table is a customer of the root. With ``c`` customers and ``t`` tables

    P(w|u) = (c_uw - d t_uw) / (a + c_u) + (a + d t_u) / (a + c_u) P(w)
    P(w)   = (c_w - e t_w) / (b + c_0) + (b + e t_0) / (b + c_0) / (V + 1)

where the root's ``c_w`` is the number of tables serving w in all contexts.
Discounts d and e are n1 / (n1 + 2 n2) of their level's counts; the
concentrations are parameters.

Gibbs. Seatings are sampled by taking one customer of a dish away and seating
it again. How many sit alone is summed out: given (c, t) the customer leaves
an empty table with probability S(c-1, t-1) / S(c, t), S being generalised
Stirling numbers, and opens one in proportion to (a + d t_u) P(w) against
c - 1 - d t. A dish seen once has one table always. Every sweep moves all
customers of each dish of up to ``moves`` customers, and draws the tables of a
larger dish from the distribution that such moves keep, S(c, t) times a power
of the weight. A sweep is a Spark step of its own: shards exchange the totals of
contexts and of the root after each, and within a sweep all totals are those of
its start, as in approximate distributed Gibbs samplers, whatever the number of
shards. After ``burn`` sweeps, ``samples`` states are
kept, and a token's probability is the mean over them, each computed from that
state's exact totals, so it sums to one over the vocabulary.

Scale. Words are known by 64-bit hashes, so no vocabulary is ever shipped or
collected. The number of shards follows the bytes of text (``shard_bytes``), not
the session's shuffle width. Chunks send each distinct (context, word) pair once
to the word's shard; a frequent pair costs a row per chunk, a frequent context is
spread over all shards. Context totals are summed by groups of contexts, a group
for every ``SHARDS_A_GROUP`` shards; a shard sends each group it has contexts of
one block, so S shards send at most S * S / SHARDS_A_GROUP blocks an exchange.
Hashes travel once: later exchanges send values in the order of the first one,
which the summing groups read again. Between sweeps only contexts with a dish of
several customers are sent, as no other totals change. Global sums go a way of
their own, a row for each shard. Scores return per chunk in the pairs' own order.

Defined cases: null text is the empty text (one end token); words unseen in
training use the unknown share; repeated doc_id rows are scored one by one; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (BLOCK, Vocabulary, block_batch, block_table, blocks, crc_mod, group_key,
                     pack, small_batches, text_bytes, unpack, word_ids)

#: No word holds white space, so this names the end (and start) mark.
END = b"\n"
#: Bytes of text for each shard, and shards for each group that sums contexts.
SHARD_BYTES = 16 << 20
SHARDS_A_GROUP = 4
CONTEXT_BITS = np.uint64((1 << 48) - 1)
SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double")
SCORES_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
    ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()),
    ("score", pa.float64())])


def crc32_holdout(doc_id) -> bool:
    return crc_mod(doc_id, 7) == 2


def six_bytes(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def from_six_bytes(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


# --- chunks ------------------------------------------------------------------

def encode_chunk(vocabulary: Vocabulary, ids: list, held: list[bool], sequences: list[np.ndarray],
                 chunk: int, shards: int) -> list[tuple[int, int, bytes]]:
    """The blocks of one chunk of documents, given as numbered words: its
    distinct pairs to the words' shards, and to itself its tokens as indices of
    pairs."""
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in vocabulary), np.uint64, len(vocabulary))
    vocabulary.clear()
    lengths = np.array([len(s) for s in sequences], np.int64)
    starts = np.cumsum(lengths) - lengths
    shard_of = (hashes % np.uint64(shards)).astype(np.int64)
    order = np.lexsort((hashes, shard_of))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    codes = rank[np.concatenate(sequences)]
    sequences.clear()
    contexts = np.empty_like(codes)
    contexts[1:] = codes[:-1]
    contexts[starts] = rank[0]
    codes <<= 32
    codes |= contexts
    del contexts
    held = np.array(held, bool)
    pairs, index = np.unique(codes, return_inverse=True)
    del codes
    index = index.astype(np.uint32)
    counts = np.bincount(index[np.repeat(~held, lengths)], minlength=len(pairs))
    hashes, shard_of = hashes[order], shard_of[order]
    pair_word = pairs >> 32
    per_word = np.bincount(pair_word, minlength=len(hashes))
    context_hash = hashes[pairs & 0xFFFFFFFF] & CONTEXT_BITS
    word_cuts = np.searchsorted(shard_of, np.arange(shards + 1))
    pair_cuts = np.concatenate([[0], np.cumsum(per_word)])[word_cuts]
    out = []
    for p in range(shards):
        a, b = pair_cuts[p], pair_cuts[p + 1]
        if a < b:
            own = slice(word_cuts[p], word_cuts[p + 1])
            out.append((p, chunk, pack(w=hashes[own], n=per_word[own].astype(np.uint32),
                                       u=six_bytes(context_hash[a:b]), c=counts[a:b].astype(np.uint32))))
    out.append((-1 - chunk, -1, pack(
        index=index, starts=starts, held=held, ids=list(ids))))
    return out


def encoder(shards: int, chunk_tokens: int, is_held_out: Callable[[object], bool]):
    def encode(batches):
        base, seq = TaskContext.get().partitionId() << 24, 0
        vocabulary, ids, held, sequences, size = Vocabulary({END: 0}), [], [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = word_ids(vocabulary, text_bytes(text.as_py()).lower().split() + [END])
                ids.append(doc_id)
                held.append(is_held_out(doc_id))
                sequences.append(words.astype(np.int32))
                size += len(words)
                if size >= chunk_tokens:
                    yield block_batch(encode_chunk(vocabulary, ids, held, sequences, base + seq, shards))
                    seq += 1
                    vocabulary, ids, held, sequences, size = Vocabulary({END: 0}), [], [], [], 0
        if ids:
            yield block_batch(encode_chunk(vocabulary, ids, held, sequences, base + seq, shards))
    return encode


# --- shards ------------------------------------------------------------------

class Shard:
    """A shard's restaurants, merged from its chunks' pairs. All rows of the
    same word are adjacent; pairs without training count are only asked for."""

    def __init__(self, found: list[tuple[int, bytes]], groups: int):
        parts = [unpack(b) for _, b in found]
        self.chunks = [s for s, _ in found]
        self.sizes = [len(p["c"]) for p in parts]
        self.per_word = [p["n"] for p in parts]
        words = np.concatenate([np.repeat(p["w"], p["n"]) for p in parts])
        contexts = np.concatenate([from_six_bytes(p["u"]) for p in parts])
        counts = np.concatenate([p["c"] for p in parts]).astype(np.int64)
        order = np.lexsort((contexts, words))
        w, u = words[order], contexts[order]
        new = np.ones(len(w), bool)
        new[1:] = (w[1:] != w[:-1]) | (u[1:] != u[:-1])
        first = np.flatnonzero(new)
        #: of each sent pair, the merged pair
        self.where = np.empty(len(w), np.int64)
        self.where[order] = np.cumsum(new) - 1
        self.count = np.add.reduceat(counts[order], first)
        w, u = w[first], u[first]
        self.new_word = np.ones(len(w), bool)
        self.new_word[1:] = w[1:] != w[:-1]
        self.word_first = np.flatnonzero(self.new_word)
        self.word = np.cumsum(self.new_word) - 1
        self.word_count = np.add.reduceat(self.count, self.word_first)
        #: contexts, ordered by the group that sums them and by hash
        distinct, inverse = np.unique(u, return_inverse=True)
        owner = (distinct % np.uint64(groups)).astype(np.int64)
        order = np.argsort(owner, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.context = rank[inverse]
        self.contexts = distinct[order]
        self.context_cuts = np.searchsorted(owner[order], np.arange(groups + 1))

    def by_context(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.context, weights=values, minlength=len(self.contexts)).astype(np.int64)

    def by_word(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.word_first)


def first_tables(count: np.ndarray) -> np.ndarray:
    return (count > 0).astype(np.int64)


def send_contexts(shard: Shard, key: int, groups: int, columns: dict[str, np.ndarray], header: dict,
                  some: np.ndarray | None = None, hashes: bool = False):
    """A block of values to each summing group that has some, and the header
    to its own. Of all contexts, or of those whose (rising) places are ``some``."""
    cuts = shard.context_cuts if some is None else np.searchsorted(some, shard.context_cuts)
    out = [(groups, key, pack(header=header))]
    for q in np.flatnonzero(np.diff(cuts)).tolist():
        own = slice(cuts[q], cuts[q + 1])
        sent = {k: v[own].astype(np.uint32 if v.max(initial=0) < 2**32 else np.int64) for k, v in columns.items()}
        out.append((q, key, pack(**sent, some=some is not None, **({"u": six_bytes(shard.contexts[own])} if hashes else {}))))
    return out


def opener(groups: int):
    """First totals: customers and distinct dishes of each context, and whether
    it has a dish of several customers."""
    def run(table: pa.Table) -> pa.Table:
        key = group_key(table)
        if key < 0:
            return block_table([])
        s = Shard(blocks(table), groups)
        t = first_tables(s.count)
        per_word = s.by_word(t)
        many = np.zeros(len(s.contexts), np.int64)
        many[s.context[s.count > 1]] = 1
        header = {"N": s.count.sum(), "V": (s.word_count > 0).sum(), "pairs": t.sum(),
                  "n1": (s.count == 1).sum(), "n2": (s.count == 2).sum(),
                  "r1": (per_word == 1).sum(), "r2": (per_word == 2).sum()}
        columns = {"c": s.by_context(s.count), "t0": s.by_context(t), "many": many}
        return block_table(send_contexts(s, key, groups, columns, header, hashes=True))
    return run


def summed_values(key: int, found: list[tuple[int, dict]], contexts: dict[int, np.ndarray]):
    """Sums what shards sent of each context; the sums in each shard's order."""
    heads = [x["header"] for _, x in found if "header" in x]
    whole = {k: sum(h[k] for h in heads) for k in heads[0]} if heads else {}
    out = [(src, key, pack(header=whole)) for src, x in found if "header" in x]
    found = [(src, x) for src, x in found if "header" not in x]
    if not found:
        return out
    distinct, inverse = np.unique(np.concatenate([contexts[src] for src, _ in found]), return_inverse=True)
    columns = {}
    for name in found[0][1]:
        if name not in ("u", "many", "some"):
            values = np.concatenate([x[name] for _, x in found]).astype(np.float64)
            columns[name] = np.bincount(inverse, weights=values, minlength=len(distinct)).astype(np.int64)[inverse]
    at = 0
    for src, _ in found:
        own = slice(at, at + len(contexts[src]))
        out.append((src, key, pack(**{k: v[own] for k, v in columns.items()})))
        at += len(contexts[src])
    return out


def first_sums(table: pa.Table) -> pa.Table:
    """Sums of the opening blocks, which carry the contexts' hashes."""
    found = [(s, unpack(b)) for s, b in blocks(table)]
    return block_table(summed_values(group_key(table), found, {s: from_six_bytes(x["u"]) for s, x in found if "u" in x}))


def later_sums(opened: pa.Table, sent: pa.Table) -> pa.Table:
    """Sums of values sent in the order of the opening blocks; rows that a shard
    keeps for itself (src -1) pass."""
    key, blocks_sent = group_key(opened, sent), blocks(sent)
    kept = [(key, -1, b) for s, b in blocks_sent if s < 0]
    found = [(s, unpack(b)) for s, b in blocks_sent if s >= 0]
    some = {s: x["some"] for s, x in found if "some" in x}
    contexts = {}
    for s, b in blocks(opened) if some else []:
        x = unpack(b) if s in some else {}
        if "u" in x:
            contexts[s] = from_six_bytes(x["u"])[x["many"] > 0] if some[s] else from_six_bytes(x["u"])
    return block_table(kept + summed_values(key, found, contexts))


def totals(table: pa.Table) -> tuple[dict, dict[str, np.ndarray], list[bytes]]:
    """(global sums, context columns in the shard's order, blocks kept)."""
    found = blocks(table)
    parts = [unpack(b) for s, b in found if s >= 0]
    head = next(p["header"] for p in parts if "header" in p)
    parts = [p for p in parts if "header" not in p]
    names = list(parts[0]) if parts else []
    return head, {k: np.concatenate([p[k] for p in parts]).astype(np.float64) for k in names}, \
        [b for s, b in found if s < 0]


# --- seating -----------------------------------------------------------------

class Alone:
    """Probability that a customer sits alone: S(c-1, t-1) / S(c, t). Exact up
    to ``top`` customers; beyond, read at the same share of tables, on which
    alone it depends in the limit."""

    def __init__(self, discount: float, top: int = 400):
        self.top = top
        log_s = np.full(top + 1, -np.inf)
        log_s[1] = 0.0
        self.table = np.zeros((top + 1, top + 1))
        self.table[1, 1] = 1.0
        #: logarithms of the Stirling numbers
        self.log_s = np.full((top + 1, top + 1), -np.inf)
        self.log_s[1, 1] = 0.0
        t = np.arange(top + 1, dtype=np.float64)
        for c in range(2, top + 1):
            shifted = np.concatenate([[-np.inf], log_s[:-1]])
            with np.errstate(divide="ignore", invalid="ignore"):
                stay = log_s + np.log(np.maximum(c - 1 - discount * t, 0))
                now = np.logaddexp(shifted, stay)
                now[0] = -np.inf
                row = np.exp(shifted - now)
            self.table[c] = np.where(np.isfinite(row), row, 0.0)
            self.table[c, c] = 1.0
            log_s = self.log_s[c] = now
        self.shares = (np.arange(1, top + 1) - 1.0) / (top - 1.0)

    def __call__(self, c: np.ndarray, t: np.ndarray) -> np.ndarray:
        small = c <= self.top
        out = np.empty(len(c))
        out[small] = self.table[c[small], t[small]]
        out[~small] = np.interp((t[~small] - 1.0) / (c[~small] - 1.0), self.shares, self.table[self.top, 1:])
        return out


def settled(c: np.ndarray, weight: np.ndarray, discount: float, alone: Alone) -> np.ndarray:
    """Tables at which leaving and opening balance: the most likely number."""
    low, high = np.ones(len(c), np.int64), c.copy()
    while (low < high).any():
        t = (low + high + 1) // 2
        opened = weight / (weight + np.maximum(c - 1 - discount * (t - 1), 1e-9))
        up = (alone(c, t) <= opened) & (low < high)
        low, high = np.where(up, t, low), np.where(up | (low >= high), high, t - 1)
    return low


def move(rng, c, t, weight, discount, alone):
    """Takes one customer of each dish away and seats it again."""
    t = t - (rng.random(len(c)) < alone(c, t))
    opened = weight / (weight + (c - 1) - discount * t)
    return t + (rng.random(len(c)) < np.where(t == 0, 1.0, opened))


def pick(rng, logs: np.ndarray) -> np.ndarray:
    """A column of each row, drawn by the rows' logarithmic weights."""
    sums = np.exp(logs - logs.max(axis=1, keepdims=True)).cumsum(axis=1)
    return (sums < (rng.random(len(sums)) * sums[:, -1])[:, None]).sum(axis=1)


def draw(rng, c, weight, discount, alone, cells: int = 1_000_000):
    """Tables of each dish, drawn from the distribution that ``move`` keeps:
    in proportion to S(c, t) weight^t. Dishes beyond the exact table are drawn
    within eight deviations of their most likely number (the variance is at
    most the mean), by the ratios of neighbours that leaving and opening give."""
    t = np.empty(len(c), np.int64)
    order = np.argsort(c, kind="stable")
    small = int(np.searchsorted(c[order], alone.top, "right"))
    for part in np.split(order[:small], np.flatnonzero(np.diff(c[order[:small]])) + 1):
        n = int(c[part[0]]) if len(part) else 1
        for a in range(0, len(part), max(1, cells // n)):
            own = part[a:a + max(1, cells // n)]
            t[own] = 1 + pick(rng, alone.log_s[n, 1:n + 1] + np.log(weight[own])[:, None] * np.arange(1, n + 1))
    large = order[small:]
    middle = settled(c[large], weight[large], discount, alone)
    reach = 2 ** np.ceil(np.log2(8 * np.sqrt(middle) + 8)).astype(np.int64)
    for k in np.unique(reach).tolist():
        of_reach = np.flatnonzero(reach == k)
        for a in range(0, len(of_reach), max(1, cells // (2 * k + 1))):
            at = of_reach[a:a + max(1, cells // (2 * k + 1))]
            n, w = c[large[at]][:, None], weight[large[at]][:, None]
            tables = middle[at][:, None] + np.arange(-k, k + 1)
            inside = (tables >= 1) & (tables <= n)
            clipped = np.clip(tables, 1, n)
            sit = alone(np.broadcast_to(n, tables.shape).ravel(), clipped.ravel()).reshape(tables.shape)
            with np.errstate(divide="ignore", invalid="ignore"):
                steps = np.log((1 - sit[:, :-1]) * w / (sit[:, 1:] * (n - 1 - discount * clipped[:, :-1])))
            steps[~(inside[:, 1:] & inside[:, :-1])] = 0.0
            logs = np.concatenate([np.zeros((len(at), 1)), steps.cumsum(axis=1)], axis=1)
            t[large[at]] = np.take_along_axis(tables, pick(rng, np.where(inside, logs, -np.inf))[:, None], 1)[:, 0]
    return t


def reseat(rng, c, t, weight, moves, discount, alone):
    """A sweep over dishes: every customer of small ones, large ones drawn."""
    t, few = t.copy(), c <= moves
    for k in range(moves):
        go = np.flatnonzero(few & (c > k))
        t[go] = move(rng, c[go], t[go], weight[go], discount, alone)
    t[~few] = draw(rng, c[~few], weight[~few], discount, alone)
    return t


def discount_of(n1: float, n2: float) -> float:
    return min(0.95, max(0.05, n1 / (n1 + 2 * n2))) if n1 + n2 else 0.5


def root_weight(b: float, e: float, tables: float, v: float) -> float:
    return (b + e * tables) / (v + 1)


def sampler(groups: int, burn: int, samples: int, moves: int, a: float, b: float, seed: int,
            start: int = 0, stop: int | None = None):
    """Sweeps ``start`` to ``stop`` (all by default) on the totals last
    exchanged; own totals are kept up to date between the sweeps of a step."""
    stop = burn + samples if stop is None else stop

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        key = group_key(left, right)
        if key < 0 or not left.num_rows:
            return block_table([])
        s = Shard(blocks(left), groups)
        head, ctx, own = totals(right)
        t = first_tables(s.count)
        many = np.flatnonzero(s.count > 1)
        c_many, w_many = s.count[many], s.word[many]
        #: contexts whose totals change, and each dish's place among them
        some, u_many = np.unique(s.context[many], return_inverse=True)
        rng = np.random.default_rng([seed, key, start])
        if start:
            state = unpack(own[0])
            sums, first, root_t = state["sums"], state["first"].astype(np.float64), state["root"].astype(np.int64)
            now, kept = state["now"].astype(np.int64), state["kept"]
            t_some, root_c0, root_t0 = first + ctx.get("more", np.zeros(0)), head["C"], head["T"]
        else:
            sums = {"N": head["N"], "V": head["V"], "d": discount_of(head["n1"], head["n2"]),
                    "e": discount_of(head["r1"], head["r2"])}
            first, root_t = ctx["t0"][some], (s.by_word(t) > 0).astype(np.int64)
            now, kept = np.ones(len(many), np.int64), {}
            t_some, root_c0, root_t0 = first, head["pairs"], head["V"]
        d, e = sums["d"], sums["e"]
        alone, root_alone = Alone(d), Alone(e)
        t[many] = now
        served = s.by_word(t)
        for sweep in range(start, stop):
            base = root_weight(b, e, root_t0, sums["V"])
            parent = (np.maximum(served - e * root_t, 0) + base) / (b + root_c0)
            weight = (a + d * t_some[u_many]) * parent[w_many]
            before, tables_before = now, root_t.sum()
            now = reseat(rng, c_many, now, weight, moves, d, alone)
            t[many] = now
            served = s.by_word(t)
            several = np.flatnonzero(served > 1)
            root_t = (served > 0).astype(np.int64)
            root_t[several] = draw(rng, served[several], np.full(len(several), base), e, root_alone)
            t_some = t_some + np.bincount(u_many, weights=now - before, minlength=len(some))
            root_c0 += int((now - before).sum())
            root_t0 += int(root_t.sum() - tables_before)
            if sweep >= burn:
                k = sweep - burn
                kept |= {f"t{k}": now.astype(np.uint32), f"r{k}": root_t.astype(np.uint32)}
        if stop < burn + samples:
            header = {"C": int(t.sum()), "T": int(root_t.sum())}
            more = np.bincount(u_many, weights=now - 1, minlength=len(some)).astype(np.int64)
            state = pack(sums=sums, first=first.astype(np.int64), root=root_t.astype(np.uint32),
                         now=now.astype(np.uint32), kept=kept)
            return block_table([(key, -1, state), *send_contexts(s, key, groups, {"more": more}, header, some)])
        header = dict(sums)
        columns = {"c": s.by_context(s.count)}
        for k in range(samples):
            t[many] = kept[f"t{k}"]
            kept[f"t{k}"] = t.astype(np.uint32)
            header |= {f"C{k}": int(t.sum()), f"T{k}": int(kept[f"r{k}"].sum())}
            columns[f"t{k}"] = s.by_context(t)
        header["shards"] = 1                        # equal sums of all shards: their mean
        return block_table([(key, -1, pack(**kept)), *send_contexts(s, key, groups, columns, header)])
    return run


def answerer(groups: int, samples: int, a: float, b: float):
    """Mean predictive probability of every pair that a chunk holds."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        key = group_key(left, right)
        if key < 0 or not left.num_rows:
            return block_table([])
        s = Shard(blocks(left), groups)
        head, ctx, kept = totals(right)
        kept = unpack(kept[0])
        n, v, d, e = (head[k] / head["shards"] for k in ("N", "V", "d", "e"))
        mean = np.zeros(len(s.count))
        for k in range(samples):
            t = kept[f"t{k}"].astype(np.int64)
            root_t, served = kept[f"r{k}"].astype(np.float64), s.by_word(t)
            parent = (np.maximum(served - e * root_t, 0) + root_weight(b, e, head[f"T{k}"], v)) / (b + head[f"C{k}"])
            below = a + ctx["c"][s.context]
            mean += (np.maximum(s.count - d * t, 0) + (a + d * ctx[f"t{k}"][s.context]) * parent[s.word]) / below
        logs = np.log10(mean / samples).astype(np.float32)
        known = s.word_count[s.word]
        out, at = [], 0
        for chunk, size in zip(s.chunks, s.sizes):
            where = s.where[at:at + size]
            out.append((-1 - chunk, key, pack(log=logs[where], known=known[where], N=round(n), V=round(v))))
            at += size
        return block_table(out)
    return run


def score_chunk(left: pa.Table, right: pa.Table) -> pa.Table:
    key = group_key(left, right)
    if key >= 0 or not left.num_rows:
        return SCORES_ARROW.empty_table()
    own = unpack(blocks(left)[0][1])
    parts = [unpack(b) for _, b in blocks(right)]
    n, v = parts[0]["N"], parts[0]["V"]
    known = np.concatenate([p["known"] for p in parts])
    logs = np.concatenate([p["log"] for p in parts]).astype(np.float64)
    base = np.log10((known + 1.0) / (n + v + 1.0))
    index, starts = own["index"], own["starts"]
    return pa.table([
        pa.array(own["ids"], pa.int64()), pa.array(own["held"]),
        pa.array(np.diff(np.append(starts, len(index)))),
        pa.array(np.add.reduceat((known > 0)[index].astype(np.int64), starts)),
        pa.array(np.full(len(starts), n, np.int64)),
        pa.array(np.add.reduceat(base[index], starts)),
        pa.array(np.add.reduceat(logs[index], starts))], schema=SCORES_ARROW)


def score_documents(docs: DataFrame, is_held_out: Callable[[object], bool] = crc32_holdout, *,
                    burn: int = 3, samples: int = 3, moves: int = 4, concentration: float = 1.0,
                    root_concentration: float = 1.0, chunk_tokens: int = 4_000_000,
                    shard_bytes: int = SHARD_BYTES, seed: int = 7) -> DataFrame:
    """Learns from the documents that are not held out and scores all.

    ``docs`` needs ``doc_id`` and ``text``. ``score`` is the model's log10
    probability of the text's tokens (words and one end); ``base_score`` that
    of add-one unigrams. ``chunk_tokens`` bounds a task's memory; a document is
    never split between chunks. Perplexity: ``10 ** (-score / n_tokens)``.
    """
    spark = docs.sparkSession
    small_batches(spark)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    groups = -(-shards // SHARDS_A_GROUP)
    sent = docs.select(docs["doc_id"].cast("long"), docs["text"]) \
        .mapInArrow(encoder(shards, chunk_tokens, is_held_out), BLOCK)
    by_key = lambda df: df.groupBy("key")
    opened = by_key(sent).applyInArrow(opener(groups), BLOCK)
    summed = by_key(opened).applyInArrow(first_sums, BLOCK)
    for k in range(burn + samples):
        sweep = sampler(groups, burn, samples, moves, concentration, root_concentration, seed, k, k + 1)
        seated = by_key(sent).cogroup(by_key(summed)).applyInArrow(sweep, BLOCK)
        summed = by_key(opened).cogroup(by_key(seated)).applyInArrow(later_sums, BLOCK)
    answers = by_key(sent).cogroup(by_key(summed)) \
        .applyInArrow(answerer(groups, samples, concentration, root_concentration), BLOCK)
    return by_key(sent).cogroup(by_key(answers)).applyInArrow(score_chunk, SCORES)
