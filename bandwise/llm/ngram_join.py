"""Exact Jaccard self-join of word-shingle sets, as a grouped prefix join.

1. Equal texts become one row (grouped before the shuffle).
2. Rarity: the distinct texts lie in hash buckets of bounded size. Each bucket
   sends the sorted shingle hashes of its texts, delta-coded, to counting parts,
   which answer with a rarity class for each; about 3 bytes travel per shingle.
3. In every bucket each text's set is ordered by (rarity class, hash). Its prefix
   of n - ceil(0.8 n) + 1 shingles must share a shingle with every similar
   set's prefix. Shingles that only one text has can match nothing and are left out, so most
   texts emit no row.
4. Texts with equal size, as many shingles of their own and the same shared prefix at the same
   places form a group (128-bit key). Only groups are listed under prefix shingles, one row for each, and pairs
   of groups pass length, positional and difference bounds (shingles of their own differ, and so do the bits in which
   parity maps of 256 classes differ; a group's map holds the bits its members agree on). Members appear when a pair has passed.
5. First every list's hubs (its least edited group, and one by hash) meet the list's groups, and the first of each
   group its members: a star of candidates, not all pairs. Links between members are verified on the whole
   sets, after the difference bound of the two members.
6. A list, or group, that lies in one component is done. What is left in different components is compared pair by
   pair: length classes and blocks of at most ``CELL`` groups (members) against blocks, dealt over tasks. New links join
   components, not texts. So every link between components is found, and the components are those of all links.

Defined results: null text, or text without words, has no shingles and is its
own component; texts of fewer than ``n`` words are one shingle, the whole
sequence; equal texts (repeated rows too) share a component; rows without
doc_id are left out; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandwise.llm import textblocks as tb
from bandwise.llm.common import id_text, keep, shipped_cogroup, shipped_group
from bandwise.llm.components import components

BUCKET_BYTES = 6 << 20  # text of one bucket
PART_SHINGLES = 4 << 20  # shingles counted in one part
CELL = 512  # groups (or members) of one side of a block that is compared pair by pair
NUM, DEN = 4, 5  # the least Jaccard likeness, 0.8


def shingle_sets(texts: pa.ChunkedArray | pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, shingle hash) of all distinct shingles, sorted by both."""
    text = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(len(text))), text], names=["doc_id", "text"])
    docs, hashes = [], []
    for block in tb.blocks(iter([batch])):
        w = tb.words(block, lower=True)
        roll = tb.Rolling(w.hash)
        many = np.diff(w.first)
        doc = np.repeat(np.arange(len(many)), many)
        if len(doc) >= n:
            ok = doc[: len(doc) - n + 1] == doc[n - 1 :]
            h, d = roll.grams(n)[ok], doc[: len(doc) - n + 1][ok]
        else:
            h, d = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        short = np.flatnonzero((many > 0) & (many < n))
        whole = tb.mix(tb.mix(roll.raw(w.first[short], w.first[short + 1])) + many[short].astype(np.uint64))
        h, d = np.concatenate([h, whole]), np.concatenate([d, short])
        order = np.lexsort((h, d))
        h, d = h[order], d[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
        docs.append(block.ids[d[new]])
        hashes.append(h[new])
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(docs), np.concatenate(hashes)


def pack_sorted(v: np.ndarray) -> bytes:
    """Sorted uint32 values as gaps in four byte planes (the high planes are nearly all zero)."""
    gaps = np.diff(v, prepend=np.uint32(0)).astype("<u4")
    return gaps.view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack_sorted(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(4, -1).T
    return np.cumsum(np.ascontiguousarray(planes).view("<u4").ravel(), dtype=np.uint64).astype(np.uint32)


def _ranged(hashes: np.ndarray, part_bits: int) -> np.ndarray:
    return hashes >> np.uint64(32 - part_bits)


def send_counts(table: pa.Table, n: int, part_bits: int) -> pa.Table:
    """One row per counting part: the bucket's distinct shingles there and in how many texts each is."""
    _, h = shingle_sets(table.column("text"), n)
    key, many = np.unique(_ranged(h, part_bits), return_counts=True)
    part = (key >> np.uint64(32)).astype(np.int64)
    value = key.astype(np.uint32)  # the lower 32 bits
    names, first = np.unique(part, return_index=True)
    ends = np.append(first[1:], len(part))
    bucket = table.column("bucket")[0].as_py()
    return pa.table(
        {
            "part": pa.array(names, pa.int64()),
            "bucket": pa.array([bucket] * len(names), pa.int64()),
            "shingles": pa.array([pack_sorted(value[a:b]) for a, b in zip(first, ends, strict=True)], pa.binary()),
            "many": pa.array([np.minimum(many[a:b], 65535).astype("<u2").tobytes() for a, b in zip(first, ends, strict=True)], pa.binary()),
        }
    )


def answer_counts(table: pa.Table) -> pa.Table:
    """Rarity class of every shingle that each bucket sent: 0 for one text, then eight steps per doubling."""
    sent = [unpack_sorted(x.as_py()) for x in table.column("shingles")]
    many = np.concatenate([np.frombuffer(x.as_py(), "<u2") for x in table.column("many")]).astype(np.float64)
    _, back = np.unique(np.concatenate(sent), return_inverse=True)
    total = np.bincount(back, weights=many)
    rank = np.minimum(np.floor(8 * np.log2(total) + 1e-9), 255).astype(np.uint8)[back]
    out, at = [], 0
    for v in sent:
        out.append(rank[at : at + len(v)].tobytes())
        at += len(v)
    return pa.table({"bucket": table.column("bucket"), "part": table.column("part"), "ranks": pa.array(out, pa.binary())})


SETS = "rep long, key string, n long, alone long, g1 long, g2 long, prefix array<long>, pos array<int>, shared array<long>, parity array<long>"
PARITY_BITS = 256


def order_sets(texts: pa.Table, answers: pa.Table, n: int, part_bits: int) -> pa.Table:
    """Per text: set size, group, shared prefix shingles with their places, and all shared shingles."""
    rows = texts.num_rows
    doc, h = shingle_sets(texts.column("text"), n)
    key, back = np.unique(_ranged(h, part_bits), return_inverse=True)
    ranks = np.zeros(len(key), np.uint8)
    part = (key >> np.uint64(32)).astype(np.int64)
    for p, raw in zip(answers.column("part").to_pylist(), answers.column("ranks").to_pylist(), strict=True):
        a, b = np.searchsorted(part, [p, p + 1])
        ranks[a:b] = np.frombuffer(raw, np.uint8)
    rank = ranks[back]
    size = np.bincount(doc, minlength=rows)
    first = np.concatenate([[0], np.cumsum(size)])
    shared = rank > 0
    shared_off = np.concatenate([[0], np.cumsum(shared)])[first]
    order = np.lexsort((h, rank, doc))
    place = np.arange(len(h)) - first[doc]  # doc is sorted, and stays so under the order
    length = size - -(-size * NUM // DEN) + 1
    in_prefix = place < length[doc]
    ho, so = h[order], shared[order]
    pick = in_prefix & so
    pre_off = np.concatenate([[0], np.cumsum(pick)])[first]
    alone = size - np.bincount(doc[shared], minlength=rows)
    groups = []
    for salt in (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)):  # two independent halves of the group key
        mixed = tb.mix(tb.mix(ho + salt) * (salt | np.uint64(1)) + place.astype(np.uint64))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(np.where(pick, mixed, np.uint64(0)))])
        groups.append(tb.mix(tb.mix(sums[first[1:]] - sums[first[:-1]] + size.astype(np.uint64)) + alone.astype(np.uint64) + salt))
    # a text that shares no prefix shingle takes no part: its shared shingles are not needed
    active = np.diff(pre_off) > 0
    use = shared & active[doc]
    shared_off = np.concatenate([[0], np.cumsum(use)])[first]
    lists = lambda off, v: pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), v)
    return pa.table(
        {
            "rep": texts.column("rep"),
            "key": texts.column("key"),
            "n": pa.array(size.astype(np.int64)),
            "alone": pa.array(alone.astype(np.int64)),
            "g1": pa.array(groups[0].view(np.int64)),
            "g2": pa.array(groups[1].view(np.int64)),
            "prefix": lists(pre_off, pa.array(ho[pick].view(np.int64))),
            "pos": lists(pre_off, pa.array(place[pick].astype(np.int32))),
            "shared": lists(shared_off, pa.array(h[use].view(np.int64))),
            "parity": lists(np.arange(rows + 1) * (PARITY_BITS // 64), pa.array(parity_maps(doc[use], h[use], rows))),
        }
    )


def parity_maps(doc: np.ndarray, h: np.ndarray, rows: int) -> np.ndarray:
    """Per text the parity of its shingles in PARITY_BITS classes, as 64-bit words: their
    Hamming distance never exceeds the number of shingles in which two sets differ."""
    out = np.zeros(rows * (PARITY_BITS // 64), np.int64)
    step = 4096  # texts at once
    edges = np.searchsorted(doc, np.arange(0, rows + step, step))
    for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        first, last = k * step, min(rows, (k + 1) * step)
        cell = (doc[a:b] - first) * PARITY_BITS + (h[a:b] >> np.uint64(7)).astype(np.int64) % PARITY_BITS
        odd = (np.bincount(cell, minlength=(last - first) * PARITY_BITS) & 1).astype(np.uint8)
        out[first * PARITY_BITS // 64 : last * PARITY_BITS // 64] = np.packbits(odd, bitorder="little").view("<i8")
    return out


def rarity_sets(docs: DataFrame, n: int) -> DataFrame:
    """Distinct texts with ordered sets, written to the shared folder."""
    rows = id_text(docs).where("text IS NOT NULL")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(1, -(-size // BUCKET_BYTES))
    part_bits = min(20, max(0, (size // 6 // PART_SHINGLES).bit_length()))
    distinct = rows.groupBy("text").agg(F.min("doc_id").alias("rep"))
    bucketed = distinct.select("rep", "text", F.md5("text").alias("key"), F.pmod(F.xxhash64("text"), F.lit(n_buckets)).alias("bucket"))

    send = shipped_group(__name__, "send_counts", n=n, part_bits=part_bits)
    order = shipped_cogroup(__name__, "order_sets", n=n, part_bits=part_bits)
    by_bucket = bucketed.groupBy("bucket")
    sent = by_bucket.applyInArrow(send, "part long, bucket long, shingles binary, many binary")
    answers = sent.groupBy("part").applyInArrow(shipped_group(__name__, "answer_counts"), "bucket long, part long, ranks binary")
    return keep(by_bucket.cogroup(answers.groupBy("bucket")).applyInArrow(order, SETS), "sets")


def _verified(pairs: DataFrame, sets: DataFrame, *carried: str) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough, with the ``carried`` columns."""
    s = sets.select("rep", "n", "shared")
    both = pairs.join(s.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("shared").alias("sa")), "a").join(
        s.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("shared").alias("sb")), "b"
    )
    common = F.size(F.array_intersect("sa", "sb"))
    return both.where((NUM + DEN) * common >= NUM * (F.col("na") + F.col("nb"))).select("a", "b", *carried)


def _close(*columns: Column) -> Column:
    """Can sets of these two sizes be similar that differ in at least ``differ`` shingles? (nx, ny, differ)"""
    nx, ny, differ = columns
    return (NUM + DEN) * differ <= (DEN - NUM) * (nx + ny)


WORDS = range(PARITY_BITS // 64)


def _differ(x: str, y: str, x_map: str, y_map: str, *masks: str) -> Column:
    """Shingles in which two sets differ at least: their own ones, and the parity bits that differ (under the masks)."""
    differ = F.col(f"{x}.alone") + F.col(f"{y}.alone")
    for w in WORDS:
        bits = F.col(f"{x}.{x_map}")[w].bitwiseXOR(F.col(f"{y}.{y_map}")[w])
        for m in masks:
            bits = bits.bitwiseAND(F.col(m)[w])
        differ = differ + F.bit_count(bits)
    return differ


def _possible(x: str, y: str) -> Column:
    """Length and positional bounds of two groups that share a shingle at these places, and that of their own shingles."""
    nx, ny, px, py = (F.col(f"{t}.{c}") for c in ("n", "pos") for t in (x, y))
    most = F.least(px, py) + 1 + F.least(nx - px - 1, ny - py - 1)
    bounds = (DEN * F.least(nx, ny) >= NUM * F.greatest(nx, ny)) & ((NUM + DEN) * most >= NUM * (nx + ny))
    return bounds & _close(nx, ny, F.col(f"{x}.alone") + F.col(f"{y}.alone"))


def _members_close(x: str, y: str) -> Column:
    """The difference bound of two members."""
    return _close(F.col(f"{x}.n"), F.col(f"{y}.n"), _differ(x, y, "parity", "parity"))


def _same_group(x: str, y: str) -> Column:
    return (F.col(f"{x}.g1") == F.col(f"{y}.g1")) & (F.col(f"{x}.g2") == F.col(f"{y}.g2"))


def group_table(active: DataFrame) -> DataFrame:
    """One row per group: g1, g2, first (smallest rep), m (members), n, alone, the prefix and parity map of the first,
    and the parity bits that all members agree on (``known``, with their values in ``agreed``)."""
    own = F.min_by(F.struct("prefix", "pos", "parity"), "rep")
    every = [f(F.col("parity")[w]).alias(f"{name}{w}") for w in WORDS for name, f in (("low", F.bit_and), ("high", F.bit_or))]
    rows = active.groupBy("g1", "g2", "n", "alone").agg(F.min("rep").alias("first"), F.count("*").alias("m"), own.alias("own"), *every)
    agreed = F.array(*[F.col(f"low{w}") for w in WORDS])
    known = F.array(*[F.bitwise_not(F.col(f"low{w}").bitwiseXOR(F.col(f"high{w}"))) for w in WORDS])
    return keep(rows.select("g1", "g2", "first", "m", "n", "alone", "own.*", agreed.alias("agreed"), known.alias("known")), "groups")


def group_lists(groups: DataFrame) -> DataFrame:
    """One row per group and shared prefix shingle (token)."""
    columns = ["g1", "g2", "first", "n", "alone", "parity", "agreed", "known"]
    rows = groups.select(*columns, F.explode(F.arrays_zip("prefix", "pos")).alias("e"))
    return rows.select(F.col("e.prefix").alias("token"), F.col("e.pos").alias("pos"), *columns)


def _inner_possible() -> Column:
    """Groups with several members that can be similar to one another."""
    return (F.col("m") > 1) & _close(F.col("n"), F.col("n"), 2 * F.col("alone"))


def hub_links(groups: DataFrame, lists: DataFrame, active: DataFrame) -> DataFrame:
    """Verified links of members to the hubs of their lists and to the first of their group."""
    hub = F.struct("first", "g1", "g2", "n", "alone", "parity", "pos")
    by_list = lists.groupBy("token").agg(
        F.count("*").alias("long"),
        F.min_by(hub, F.struct(F.col("alone") / F.col("n"), F.col("first"))).alias("h1"),
        F.min_by(hub, F.struct(F.xxhash64("first"), F.col("first"))).alias("h2"),
    )
    hubs = by_list.where("long > 1").select("token", F.explode(F.array_distinct(F.array("h1", "h2"))).alias("h")).select("token", "h.*")
    close = _close(F.col("x.n"), F.col("y.n"), _differ("x", "y", "agreed", "parity", "x.known"))
    pairs = lists.alias("x").join(hubs.alias("y"), "token").where(~_same_group("x", "y") & _possible("x", "y") & close)
    stars = pairs.select("x.g1", "x.g2", *(F.col(f"y.{c}") for c in ("first", "n", "alone", "parity")))
    inner = groups.where(_inner_possible()).select("g1", "g2", "first", "n", "alone", "parity")
    stars = stars.unionByName(inner).dropDuplicates(["g1", "g2", "first"])
    members = active.select("rep", "g1", "g2", "n", "alone", "parity")
    found = members.alias("x").join(stars.alias("y"), ["g1", "g2"]).where((F.col("rep") != F.col("first")) & _members_close("x", "y"))
    return _verified(found.select(F.col("rep").alias("a"), F.col("first").alias("b")), active)


def _blocks(count: str) -> Column:
    return F.coalesce(F.ceil(F.col(count) / CELL), F.lit(1)).cast("int")


def _dealt(rows: DataFrame, cell: list[str], mine: str, large: DataFrame) -> DataFrame:
    """Rows of one side with the blocks (i, j) they meet: an own block, and all of the other side's.

    ``large`` has the cells of more than one block, which are few; the rows of all others are block (0, 0).
    """
    theirs = {"x": "y", "y": "x"}[mine]
    own = F.pmod(F.xxhash64("g1", "g2"), _blocks(f"n_{mine}")).cast("int")
    other = F.explode(F.sequence(F.lit(0), _blocks(f"n_{theirs}") - 1))
    i, j = (own, other) if mine == "x" else (other, own)
    return rows.join(large, cell, "left").withColumn("i", i).withColumn("j", j).drop("n_x", "n_y")


def open_lists(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of the lists that hold several components, with the least (low) and greatest (high) one of each group (``labels``)."""
    rows = keep(lists.drop("parity", "first").join(labels, ["g1", "g2"]), "lists")
    mixed = rows.groupBy("token").agg(F.min("low").alias("lo"), F.max("high").alias("hi")).where("lo <> hi").select("token")
    return keep(rows.join(mixed, "token", "left_semi"), "open")


def open_pairs(rows: DataFrame) -> DataFrame:
    """Pairs of groups (g1, g2, h1, h2) of ``open_lists`` that may hold links between different components, each pair once.

    The shorter side (x) of a pair lies in its length
    class, the longer one in its own class and the one below: sizes of similar sets are at most one class apart.
    """
    x = rows.withColumn("cls", F.floor(F.log(F.col("n").cast("double")) / float(np.log(DEN / NUM))))
    y = x.withColumn("cls", F.explode(F.array(F.col("cls"), F.col("cls") - 1)))
    cell = ["token", "cls"]
    sides = x.select(*cell, F.lit(1).alias("x"), F.lit(0).alias("y")).unionByName(y.select(*cell, F.lit(0).alias("x"), F.lit(1).alias("y")))
    sizes = sides.groupBy(*cell).agg(F.sum("x").alias("n_x"), F.sum("y").alias("n_y"))
    large = keep(sizes.where((F.greatest("n_x", "n_y") > CELL) & (F.least("n_x", "n_y") > 0)), "large")  # few: their size is known then
    x, y = _dealt(x, cell, "x", large).alias("x"), _dealt(y, cell, "y", large).alias("y")
    order = F.struct("x.n", "x.g1", "x.g2") < F.struct("y.n", "y.g1", "y.g2")
    apart = (F.least("x.low", "y.low") != F.greatest("x.high", "y.high")) & order & _possible("x", "y")
    close = _close(F.col("x.n"), F.col("y.n"), _differ("x", "y", "agreed", "agreed", "x.known", "y.known"))
    pairs = x.join(y, [*cell, "i", "j"]).where(apart & close)
    return pairs.select("x.g1", "x.g2", F.col("y.g1").alias("h1"), F.col("y.g2").alias("h2")).distinct()


def rest_links(pairs: DataFrame, members: DataFrame, active: DataFrame) -> DataFrame:
    """Verified links (as pairs of components) of the members of the pairs' groups that lie in different components."""
    cell = ["g1", "g2", "h1", "h2"]
    sizes = members.groupBy("g1", "g2").agg(F.count("*").alias("m"))
    cells = pairs.join(sizes.withColumnRenamed("m", "n_x"), ["g1", "g2"]).join(
        sizes.select(F.col("g1").alias("h1"), F.col("g2").alias("h2"), F.col("m").alias("n_y")), ["h1", "h2"]
    )
    for block, count in (("i", "n_x"), ("j", "n_y")):
        cells = cells.withColumn(block, F.explode(F.sequence(F.lit(0), _blocks(count) - 1)))
    large = sizes.where(F.col("m") > CELL)
    blocked = members.join(large, ["g1", "g2"], "left").withColumn("b", F.pmod(F.xxhash64("rep"), _blocks("m")).cast("int")).drop("m")
    x = blocked.withColumnRenamed("b", "i").alias("x")
    y = blocked.withColumnsRenamed({"g1": "h1", "g2": "h2", "b": "j"}).alias("y")
    met = cells.select(*cell, "i", "j").join(x, ["g1", "g2", "i"]).join(y, ["h1", "h2", "j"])
    one = (F.col("g1") == F.col("h1")) & (F.col("g2") == F.col("h2"))
    ok = (F.col("x.comp") != F.col("y.comp")) & (~one | (F.col("x.rep") < F.col("y.rep"))) & _members_close("x", "y")
    found = met.where(ok).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"), F.col("x.comp").alias("ca"), F.col("y.comp").alias("cb"))
    return _verified(found, active, "ca", "cb").select(F.col("ca").alias("a"), F.col("cb").alias("b"))


def link_components(sets: DataFrame) -> DataFrame:
    """(node, component) of the distinct texts that have a link."""
    active = sets.where(F.size("prefix") > 0)
    groups = group_table(active)
    lists = group_lists(groups)
    comp = components(hub_links(groups, lists, active))
    label = active.select("rep", "g1", "g2", "n", "alone", "parity").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
    members = keep(label.withColumn("comp", F.coalesce("component", "rep")).drop("component"), "members")
    labels = members.groupBy("g1", "g2").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    inner = groups.where(_inner_possible()).join(labels.where("low <> high"), ["g1", "g2"])
    pairs = open_pairs(open_lists(lists, labels)).unionByName(inner.select("g1", "g2", F.col("g1").alias("h1"), F.col("g2").alias("h2")))
    pairs = keep(pairs, "pairs")
    if pairs.isEmpty():
        return comp
    links = keep(rest_links(pairs, members, active), "rest")
    if links.isEmpty():
        return comp
    joined = components(links)  # between components
    moved = comp.join(joined.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left")
    moved = moved.select("node", F.coalesce("to", "component").alias("component"))
    return moved.unionByName(joined.join(comp.select("node"), "node", "left_anti"))


def near_duplicates(docs: DataFrame, n: int = 5) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest linked doc_id) of every document."""
    sets = rarity_sets(docs, n)
    comp = link_components(sets)
    classes = sets.select("rep", "key", "n").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
    classes = classes.select("key", "n", F.coalesce("component", "rep").alias("component"))
    rows = id_text(docs).select("doc_id", F.md5("text").alias("key"))
    return rows.join(classes, "key", "left").select(
        "doc_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
    )
