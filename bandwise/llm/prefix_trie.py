"""Prefix trie of conversations: every distinct sequence of first turns is a node.

1. ``paths``: conversations are streamed through partitions sorted by turn. A row per
   turn carries hashes (128 bits) of the turn and of the sequence up to it, its words, and how many turns are left.
2. The rows under a prefix are the sum of the turns left there. A prefix with more than ``shard_rows`` is an
   *upper* node; the first one on a path without that many is the top of a shard. So shards have prefixes of
   variable length and bounded size; a hot first turn is divided by what follows it, and a hot conversation
   consists of upper nodes, whose rows merge before the shuffle.
3. Shards (several per task) become double-array tries: turns get dense ids, level by level; a
   state's children lie at BASE[state] + id, and CHECK there names the state. The conversations walk through
   them, and CHECK is followed backwards to add up subtrees.
4. Upper nodes, shared by several shards, are merged globally: sums over their subtrees by doubling (after k rounds
   a node knows all below it within 2**k levels), so deep chains take few rounds.
   Who ends at an upper node is packed into sorted chunks, and the chunks are streamed into the digest.

Defined results: null role or text is empty; null turns come first, equal turns are ordered by role and text, repeated rows are
turns of their own; rows without a conv_id are left out; an empty table has no conversation and gives no
nodes, not even the root; other columns are ignored. A digest is sequential by nature: one task reads one node's chunks,
and one task one conversation's rows, both as a stream.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bandwise.llm.common import keep, shipped, shipped_group
from bandwise.llm.quality import word_list

SHARD_ROWS = 100_000
CHUNK_BYTES = 1 << 16
SHARED = 4  # a member of a family takes over fewer than this many turns
PATHS = (
    "conv long, depth int, k1 long, k2 long, u1 long, u2 long, t1 long, t2 long, words long, left long, last boolean"
)
_PATH_NAMES = [c.split()[0] for c in PATHS.split(", ")]
_KEYS = struct.Struct("<qq")


def _hash(*parts: bytes) -> bytes:
    h = hashlib.blake2b(digest_size=16)
    for p in parts:
        h.update(p)
    return h.digest()


def path_batches(batches, flush: int = 8192):
    """Rows of every conversation's path, from its root; rows come in the order of (family, member or head, conversation, turn)."""
    family = conv = None
    head_turns: list[tuple[bytes, int]] = []
    out: list[tuple] = []
    key, depth, total, seen, taken = bytes(16), 0, 0, 0, 0

    def row(up: tuple, turn: tuple, words: int) -> tuple:
        return (conv, depth, *_KEYS.unpack(key), *up, *turn, words, total - depth + 1, depth == total)

    def step(turn: bytes, words: int) -> None:
        nonlocal key, depth
        up, key, depth = _KEYS.unpack(key), _hash(key, turn), depth + 1
        out.append(row(up, _KEYS.unpack(turn), words))

    def packed() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 8, pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=_PATH_NAMES)

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("family", "conv_id", "shared", "own", "role", "text", "words"))
        for fam, c, shared, own, role, text, words in zip(*columns, strict=True):
            if fam != family:
                family, head_turns = fam, []
            if c != conv or seen == own:
                conv, key, depth, seen = c, bytes(16), 0, 0
                taken = 0 if c == fam else shared
                first = head_turns[:taken]
                total = len(first) + max(0, own - taken)
                out.append(row((None, None), (None, None), 0))
                for turn, n in first:
                    step(turn, n)
            r = role.encode()
            turn = _hash(struct.pack("<q", len(r)), r, text.encode())
            if c == fam and seen < SHARED - 1:
                head_turns.append((turn, words))
            if seen >= taken:
                step(turn, words)
            seen += 1
            if len(out) >= flush:
                yield packed()
                out = []
    if out:
        yield packed()


def paths(conversations: DataFrame, family: int | None = None) -> DataFrame:
    """Path rows (``PATHS``) of all conversations.

    With ``family``, conversation c is rebuilt: the first h turns of the family's head c - c % family, then its own
    turns after its first h, where h is crc32(c as text) % 4.
    """
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    head = F.col("conv_id") - F.col("conv_id") % family if family else F.col("conv_id")
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED if family else F.lit(0)
    rows = rows.withColumns({"family": head, "shared": shared.cast("long"), "words": F.size(word_list(F.col("text"))).cast("long")})
    rows = rows.withColumn("member", F.col("conv_id") != F.col("family"))
    order = ["family", "member", "conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    rows = rows.repartition("family").sortWithinPartitions(*order)
    rows = rows.withColumn("own", F.count("*").over(Window.partitionBy("family", "member", "conv_id")))
    rows = rows.select("family", "conv_id", "shared", "own", "role", "text", "words")
    return rows.mapInArrow(shipped(__name__, "path_batches"), PATHS)


class DoubleArray:
    """BASE and CHECK over dense ids; state 0 is the start. ``top`` is one beyond the last cell in use."""

    def __init__(self):
        self.base = np.zeros(64, np.int64)
        self.check = np.full(64, -1, np.int64)
        self.check[0] = 0
        self.top, self.free = 1, 1

    def _room(self, n: int) -> None:
        if n > len(self.base):
            more = max(n, 2 * len(self.base)) - len(self.base)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def _fit(self, ids: np.ndarray) -> int:
        """A base whose cells for the ids are free: near the first gap, else behind everything."""
        gaps = np.flatnonzero(self.check[self.free : self.top] < 0)[:8] + self.free
        for gap in gaps:
            cells = gap + ids - ids[0]
            self._room(int(cells[-1]) + 1)
            if (self.check[cells] < 0).all():
                return int(gap - ids[0])
        return int(self.top - ids[0])

    def add(self, states: np.ndarray, ids: np.ndarray) -> None:
        """Children of states that have none yet: pairs sorted by (state, id), all children of a state at once."""
        if not len(states):
            return
        first = np.flatnonzero(np.concatenate([[True], states[1:] != states[:-1]]))
        size = np.diff(np.append(first, len(states)))
        for a, n in zip(first[size > 1], size[size > 1], strict=True):  # wide states first, lone children fill the gaps
            base = self._fit(ids[a : a + n])
            cells = base + ids[a : a + n]
            self._room(int(cells[-1]) + 1)
            self.base[states[a]], self.check[cells] = base, states[a]
            self.top = max(self.top, int(cells[-1]) + 1)
        lone = first[size == 1]
        gaps = np.flatnonzero(self.check[self.free : self.top] < 0)[: len(lone)] + self.free
        cells = np.concatenate([gaps, self.top + np.arange(len(lone) - len(gaps))])
        if len(cells):
            self._room(int(cells[-1]) + 1)
            self.base[states[lone]], self.check[cells] = cells - ids[lone], states[lone]
            self.top = max(self.top, int(cells[-1]) + 1)
        left = np.flatnonzero(self.check[self.free : self.top] < 0)
        self.free = self.free + int(left[0]) if len(left) else self.top

    def step(self, states: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The states behind the ids; -1 where there is none."""
        cell = self.base[states] + ids
        ok = (cell >= 0) & (cell < self.top)
        cell = np.where(ok, cell, 0)
        return np.where(ok & (cell > 0) & (self.check[cell] == states), cell, -1)


def _dense(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, int]:
    """A number per row for each distinct pair (a, b)."""
    order = np.lexsort((b, a))
    new = np.ones(len(a), bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    out = np.empty(len(a), np.int64)
    out[order] = np.cumsum(new) - 1
    return out, int(new.sum())


NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, u1 long, u2 long, top boolean"
)


def shard_nodes(table: pa.Table) -> pa.Table:
    """The nodes of a task's shards, from the rows of the conversations below their tops."""
    col = {c: table.column(c).to_numpy(zero_copy_only=False) for c in ("s1", "s2", "conv", "depth", "words", "last")}
    t1, t2 = (table.column(c).fill_null(0).to_numpy() for c in ("t1", "t2"))
    order = np.lexsort((col["depth"], col["conv"], col["s2"], col["s1"]))
    col = {c: v[order] for c, v in col.items()}
    conv, depth, words, last = col["conv"], col["depth"].astype(np.int64), col["words"], col["last"].astype(bool)
    shard, n_shards = _dense(col["s1"], col["s2"])
    turn, n_turns = _dense(t1[order], t2[order])
    first = np.flatnonzero(np.concatenate([[True], (conv[1:] != conv[:-1]) | (shard[1:] != shard[:-1])]))
    level = np.arange(len(conv)) - np.repeat(first, np.diff(np.append(first, len(conv))))
    by_level = np.argsort(level, kind="stable")
    edges = np.searchsorted(level[by_level], np.arange(int(level.max()) + 2))

    trie, state = DoubleArray(), np.zeros(len(conv), np.int64)
    ids = np.full(n_turns, -1, np.int64)  # dense ids, given in the order in which the levels meet the turns
    known = n_shards
    for k in range(len(edges) - 1):
        rows = by_level[edges[k] : edges[k + 1]]
        if k:
            before = state[rows - 1]
            met = turn[rows]
            pair, _ = _dense(before, met)
            one = np.unique(pair, return_index=True)[1]
            fresh = met[one][ids[met[one]] < 0]
            fresh = fresh[np.sort(np.unique(fresh, return_index=True)[1])]
            ids[fresh] = known + np.arange(len(fresh))
            known += len(fresh)
            by, own = before[one], ids[met[one]]
            inner = np.lexsort((own, by))
            trie.add(by[inner], own[inner])
            state[rows] = trie.step(before, ids[met])
        else:  # the tops hang on the start state by the shards' numbers
            trie.add(np.zeros(n_shards, np.int64), np.arange(n_shards))
            state[rows] = trie.step(np.zeros(len(rows), np.int64), shard[rows])

    size = trie.top
    n_convs = np.bincount(state, minlength=size)
    least = np.full(size, np.iinfo(np.int64).max)
    np.minimum.at(least, state, conv)
    last_words, deep, tier = (np.zeros(size, np.int64) for _ in range(3))
    last_words[state], deep[state], tier[state] = words, depth, level
    cells = np.flatnonzero(n_convs)
    parent = trie.check[: trie.top]
    n_children = np.bincount(parent[cells], minlength=size)
    leaves, saved = (n_children == 0).astype(np.int64), (n_convs - 1) * last_words
    cells = cells[np.argsort(tier[cells], kind="stable")]
    marks = np.searchsorted(tier[cells], np.arange(1, int(tier.max()) + 2))
    for k in range(len(marks) - 1, 0, -1):  # from the deepest level up
        own = cells[marks[k - 1] : marks[k]]
        np.add.at(leaves, parent[own], leaves[own])
        np.add.at(saved, parent[own], saved[own])

    ends = np.flatnonzero(last)
    ends = ends[np.lexsort((conv[ends], state[ends]))]
    lo, hi = np.searchsorted(state[ends], cells), np.searchsorted(state[ends], cells, side="right")
    names = conv[ends].astype(str).tolist()
    digest = [hashlib.sha256(",".join(names[a:b]).encode()).hexdigest() for a, b in zip(lo, hi, strict=True)]
    top = tier[cells] == 0
    place = np.full(size, -1, np.int64)
    place[state[first]] = first  # a row of each top, to name the parent
    up = [table.column(c).take(pa.array(order[place[cells]], mask=~top)) for c in ("u1", "u2")]
    data = [least, deep, None, n_convs, n_children, leaves, saved]
    arrays = [pa.array(v[cells].astype(np.int64)) if v is not None else pa.array(least[parent[cells]], mask=top) for v in data]
    return pa.table([*arrays, pa.array(digest, pa.string()), *up, pa.array(top)], names=[c.split()[0] for c in NODES.split(", ")])


def chunk_batches(batches, limit: int = CHUNK_BYTES):
    """(k1, k2, first, chunk): comma-joined ids of sorted (k1, k2, conv) rows in pieces of about ``limit`` bytes."""
    now, first, parts, size = None, None, [], 0

    def out():
        values = [[now[0]], [now[1]], [first], [",".join(parts)]]
        return pa.RecordBatch.from_arrays([pa.array(v) for v in values], names=["k1", "k2", "first", "chunk"])

    for batch in batches:
        for k1, k2, c in zip(*(batch.column(i).to_pylist() for i in ("k1", "k2", "conv")), strict=True):
            if (k1, k2) != now or size >= limit:
                if parts:
                    yield out()
                now, first, parts, size = (k1, k2), c, [], 0
            parts.append(str(c))
            size += len(parts[-1]) + 1
    if parts:
        yield out()


def digest_batches(batches):
    """(k1, k2, ends_sha256) of chunks sorted by (k1, k2, first)."""
    now, h = None, None

    def out():
        return pa.RecordBatch.from_arrays([pa.array([now[0]]), pa.array([now[1]]), pa.array([h.hexdigest()])], names=["k1", "k2", "ends_sha256"])

    for batch in batches:
        for k1, k2, chunk in zip(*(batch.column(i).to_pylist() for i in ("k1", "k2", "chunk")), strict=True):
            if (k1, k2) != now:
                if h:
                    yield out()
                now, h = (k1, k2), hashlib.sha256()
                h.update(chunk.encode())
            else:
                h.update(b"," + chunk.encode())
    if h:
        yield out()


def end_digests(ends: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256) from rows (k1, k2, conv): digest of each key's ids, ascending, comma-joined.

    Rows are dealt by ranges of (key, id), so a hot key is many tasks' work; only its chunks meet in one.
    """
    keys = ["k1", "k2"]
    ranged = ends.select(*keys, "conv").repartitionByRange(*keys, "conv").sortWithinPartitions(*keys, "conv")
    chunks = ranged.mapInArrow(shipped(__name__, "chunk_batches"), "k1 long, k2 long, first long, chunk string")
    chunks = chunks.repartition(*keys).sortWithinPartitions(*keys, "first")
    return chunks.mapInArrow(shipped(__name__, "digest_batches"), "k1 long, k2 long, ends_sha256 string")


def _subtree_sums(nodes: DataFrame, deepest: int) -> DataFrame:
    """(k1, k2, n_leaves, saved_tokens) summed over each node's subtree; ``nodes`` has k1, k2, u1, u2 and own sums."""
    state = nodes.select("k1", "k2", F.col("u1").alias("a1"), F.col("u2").alias("a2"), "n_leaves", "saved_tokens")
    for k in range(deepest.bit_length()):
        more = state.where("a1 IS NOT NULL").groupBy(F.col("a1").alias("k1"), F.col("a2").alias("k2"))
        more = more.agg(F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
        above = state.select(F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.col("a1").alias("b1"), F.col("a2").alias("b2"))
        joined = state.join(more, ["k1", "k2"], "left").join(above, ["a1", "a2"], "left")
        sums = [(F.col(c) + F.coalesce(d, F.lit(0))).alias(c) for c, d in (("n_leaves", "l"), ("saved_tokens", "s"))]
        state = keep(joined.select("k1", "k2", F.col("b1").alias("a1"), F.col("b2").alias("a2"), *sums), f"subtrees{k}")
    return state.select("k1", "k2", "n_leaves", "saved_tokens")


RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_nodes(conversations: DataFrame, family: int | None = None, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Every node of the trie (``RESULT``); see ``paths`` for ``family``."""
    rows = keep(paths(conversations, family), "paths")
    keys = ["k1", "k2"]
    prefixes = rows.groupBy(*keys).agg(
        F.sum("left").alias("below"), F.count("*").alias("n_convs"), F.min("conv").alias("conv_id"), F.max("words").alias("words"),
        F.max("depth").cast("long").alias("depth"), F.min("u1").alias("u1"), F.min("u2").alias("u2"),
    )
    upper = keep(prefixes.where(F.col("below") > shard_rows).drop("below"), "upper")
    deepest = upper.agg(F.max("depth")).first()[0]
    tagged = rows.join(upper.select(*keys, F.lit(True).alias("upper")), keys, "left")
    path = Window.partitionBy("conv")
    top = F.min(F.when(F.col("upper").isNull(), F.struct("depth", "k1", "k2"))).over(path)
    lower = tagged.withColumn("top", top).where("upper IS NULL").drop("upper")
    n_tasks = max(1, -(-rows.count() // shard_rows))
    lower = lower.select("*", F.col("top.k1").alias("s1"), F.col("top.k2").alias("s2")).drop("top", "k1", "k2", "left")
    dealt = lower.withColumn("task", F.pmod(F.xxhash64("s1", "s2"), F.lit(n_tasks)))
    nodes = dealt.groupBy("task").applyInArrow(shipped_group(__name__, "shard_nodes"), NODES)
    if deepest is None:  # no prefix is larger than a shard: the root is the top of the only one
        return nodes.select(*RESULT)
    nodes = keep(nodes, "nodes")
    tops = nodes.where("top")
    under = tops.select(F.col("u1").alias("k1"), F.col("u2").alias("k2"), "n_leaves", "saved_tokens")
    own = upper.where("u1 IS NOT NULL").select(F.col("u1").alias("k1"), F.col("u2").alias("k2"), *(F.lit(0).cast("long").alias(c) for c in ("n_leaves", "saved_tokens")))
    under = under.unionByName(own).groupBy(*keys).agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
    zero = F.lit(0).cast("long")
    upper = upper.join(under, keys, "left").withColumns(
        {
            "n_children": F.coalesce("n_children", zero),
            "n_leaves": F.when(F.col("n_children").isNull(), F.lit(1)).otherwise(F.col("l")).cast("long"),
            "saved_tokens": (F.col("n_convs") - 1) * F.col("words") + F.coalesce("s", zero),
        }
    )
    upper = keep(upper.drop("l", "s"), "upper_sums")
    names = upper.select(F.col("k1").alias("u1"), F.col("k2").alias("u2"), F.col("conv_id").alias("parent_conv_id"))
    digests = end_digests(rows.where("last").join(upper.select(*keys), keys, "left_semi"))
    merged = upper.drop("n_leaves", "saved_tokens").join(_subtree_sums(upper, deepest), keys)
    merged = merged.join(names, ["u1", "u2"], "left").join(digests, keys, "left")
    merged = merged.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())))
    hung = tops.drop("parent_conv_id").join(names, ["u1", "u2"], "left")
    return nodes.where("NOT top").select(*RESULT).unionByName(hung.select(*RESULT)).unionByName(merged.select(*RESULT))
