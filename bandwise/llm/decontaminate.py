"""Benchmark decontamination by a prefix-filtered join of word windows.

A benchmark item is cut into windows of ``window`` consecutive words (one
window if it has fewer). A window is contained in a document only if all its
``shingle``-word shingles are, so one necessary token is enough to join on: the
window's rarest shingle over the whole corpus (a containment of 1 gives a
prefix of length 1). Pass one counts the item shingles in all documents. Pass
two finds the chosen shingles, bounds the window's place (it must lie within
the document), and verifies the window by two independent 64-bit hashes of its words.

The benchmark's windows go to the tasks in blocks of at most ``block_windows``
(about 40 bytes each); a larger benchmark takes further blocks over the same
rows, never a larger broadcast. Documents never leave their partition.

Defined results: null text, or text without words, has n_words 0 and no hit; an
item without words, or without an id, matches nothing; items of equal text are
all reported; repeated rows give repeated rows; an empty benchmark leaves all
documents clean; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.llm import textblocks as tb
from bandwise.llm.common import shipped

RESULT = "doc_id long, n_words long, spans array<struct<start:long,end:long>>, items array<string>"


@dataclass
class Windows:
    """Windows of one benchmark block; arrays of equal length."""

    item: list[str]
    size: np.ndarray  # words
    one: np.ndarray  # two hashes of the window's words
    two: np.ndarray
    grams: np.ndarray  # (windows, most shingles): hashes, padded with the first
    gram: np.ndarray  # words of a shingle


def gram_key(roll: tb.Rolling, start: np.ndarray, size) -> np.ndarray:
    return tb.mix(roll.raw(start, start + size) + np.asarray(size).astype(np.uint64))


def item_windows(rows: list[tuple[str, str]], window: int, shingle: int) -> Windows:
    item, size, one, two, grams, gram = [], [], [], [], [], []
    most = window - min(window, shingle) + 1
    for item_id, text in rows:
        data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
        w = tb.words(tb.Block(np.zeros(1, np.int64), data, np.array([0, len(data)])), tb.ALNUM_CLASS, lower=True)
        n = len(w.hash)
        m = min(n, window)
        if not n:
            continue
        s = min(shingle, m)
        roll, roll2 = tb.Rolling(w.hash), tb.second(w.hash)
        at = np.arange(n - m + 1)
        inside = at[:, None] + np.minimum(np.arange(most), m - s)[None, :]
        item += [item_id] * len(at)
        size.append(np.full(len(at), m))
        gram.append(np.full(len(at), s))
        one.append(roll.raw(at, at + m))
        two.append(roll2.raw(at, at + m))
        grams.append(gram_key(roll, inside, s))
    if not item:
        z = np.zeros(0, np.uint64)
        return Windows([], np.zeros(0, int), z, z, np.zeros((0, most), np.uint64), np.zeros(0, int))
    return Windows(item, np.concatenate(size), np.concatenate(one), np.concatenate(two), np.concatenate(grams), np.concatenate(gram))


def count_batches(batches, wanted):
    """How often each wanted shingle occurs, added up per block before anything is shuffled."""
    sizes: dict[int, np.ndarray] = wanted.value
    for block in tb.blocks(batches):
        w = tb.words(block, tb.ALNUM_CLASS, lower=True)
        roll = tb.Rolling(w.hash)
        for s, keys in sizes.items():
            n = len(w.hash) - s + 1
            if n <= 0:
                continue
            at = np.arange(n)
            same = np.searchsorted(w.first, at, side="right") == np.searchsorted(w.first, at + s - 1, side="right")
            k = gram_key(roll, at[same], s)
            hit = np.searchsorted(keys, k)
            hit[hit == len(keys)] = 0
            found, many = np.unique(k[keys[hit] == k], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(many.astype(np.int64))], names=["gram", "n"])


def hit_batches(batches, lookup, carry):
    """One row per document: hit spans (merged, in words) and the items found, added to earlier blocks' ones."""
    t = lookup.value
    for block, earlier in _with_earlier(batches):
        w = tb.words(block, tb.ALNUM_CLASS, lower=True)
        roll, roll2 = tb.Rolling(w.hash), tb.second(w.hash)
        starts, ends, wins = [], [], []
        for s, (keys, ptr, order) in t["by_size"].items():
            n = len(w.hash) - s + 1
            if n <= 0 or not len(keys):
                continue
            k = gram_key(roll, np.arange(n), s)
            j = np.searchsorted(keys, k)
            j[j == len(keys)] = 0
            pos = np.flatnonzero(keys[j] == k)
            j = j[pos]
            many = ptr[j + 1] - ptr[j]
            win = order[np.repeat(ptr[j], many) + np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)]
            start = np.repeat(pos, many) - t["offset"][win]
            end = start + t["size"][win]
            fits = (start >= 0) & (end <= len(w.hash))  # positional bounds
            start, end, win = start[fits], end[fits], win[fits]
            doc = np.searchsorted(w.first, start, side="right")
            fits = doc == np.searchsorted(w.first, end - 1, side="right")
            start, end, win = start[fits], end[fits], win[fits]
            same = (roll.raw(start, end) == t["one"][win]) & (roll2.raw(start, end) == t["two"][win])
            starts.append(start[same])
            ends.append(end[same])
            wins.append(win[same])
        start, end, win = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (starts, ends, wins))
        yield _rows(block, w, start, end, t["item"][win] if len(win) else np.zeros(0, object), earlier, carry)


def _with_earlier(batches):
    """Blocks, each with the spans and items that earlier benchmark blocks found in its documents."""
    spans: list = []
    items: list = []

    def watched():
        for b in batches:
            if "spans" in b.schema.names:
                spans.extend(b.column("spans").to_pylist())
                items.extend(b.column("items").to_pylist())
            yield b

    for block in tb.blocks(watched()):
        n = len(block.ids)
        yield block, (spans[:n], items[:n])
        del spans[:n], items[:n]


def _rows(block, w, start, end, item, earlier, carry) -> pa.RecordBatch:
    n_docs = len(block.ids)
    doc = np.searchsorted(w.first, start, side="right") - 1
    # several documents may begin at one word index (empty ones): the owner is the last of them
    order = np.lexsort((start, doc))
    bounds = np.searchsorted(doc[order], np.arange(n_docs + 1))
    first = w.first.tolist()
    all_spans, all_items = [], []
    old_spans, old_items = earlier
    for i in range(n_docs):
        a, b = bounds[i], bounds[i + 1]
        found = set(old_items[i]) if old_items else set()
        pairs = [(p["start"], p["end"]) for p in old_spans[i]] if old_spans else []
        if b > a:
            own = order[a:b]
            found.update(item[own].tolist())
            pairs = sorted(pairs + list(set(zip((start[own] - first[i]).tolist(), (end[own] - first[i]).tolist(), strict=True))))
        merged: list[list[int]] = []
        for s, e in pairs:
            if merged and s <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        all_spans.append([{"start": s, "end": e} for s, e in merged])
        all_items.append(sorted(found))
    cols = {
        "doc_id": pa.array(block.ids),
        "n_words": pa.array(np.diff(w.first).astype(np.int64)),
        "spans": pa.array(all_spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        "items": pa.array(all_items, pa.list_(pa.string())),
    }
    if carry:  # the next block of the benchmark reads the same texts
        cols["text"] = pa.array([block.text(i).decode("utf-8", "surrogatepass") for i in range(n_docs)], pa.string())
    return pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 4, block_windows: int = 1_000_000) -> DataFrame:
    """doc_id, n_words, spans (hit word ranges) and items of every document."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id IS NOT NULL")
    bench = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"), "text")
    # an item has at most one window for two bytes of its text
    size = bench.agg(F.sum(F.octet_length("text") / 2 + 1)).first()[0] or 0
    n_blocks = max(1, int(-(-size // block_windows)))
    out = rows
    for b in range(n_blocks):
        own = bench.where(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == b) if n_blocks > 1 else bench
        win = item_windows(sorted((r.item_id, r.text) for r in own.collect()), window, shingle)
        sizes = {int(s): np.unique(win.grams[win.gram == s]) for s in np.unique(win.gram)}
        wanted = spark.sparkContext.broadcast(sizes)
        counted = rows.mapInArrow(shipped(__name__, "count_batches", wanted=wanted), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
        count = {r.gram: r.n for r in counted.collect()}  # at most the block's shingles
        carry = b < n_blocks - 1
        lookup = spark.sparkContext.broadcast(_lookup(win, count))
        out = out.mapInArrow(shipped(__name__, "hit_batches", lookup=lookup, carry=carry), RESULT + ", text string" * carry)
    return out


def _lookup(win: Windows, count: dict[int, int]) -> dict:
    """Every window under its rarest shingle; windows with a shingle that no document has are left out."""
    n, most = win.grams.shape
    keys = np.fromiter(count, np.int64, len(count)).view(np.uint64)
    order = np.argsort(keys)
    keys, many = keys[order], np.fromiter(count.values(), np.int64, len(count))[order]
    at = np.searchsorted(keys, win.grams)
    at[at == len(keys)] = 0
    found = keys[at] == win.grams if len(keys) else np.zeros((n, most), bool)
    often = np.where(found, many[at] if len(keys) else 0, 0)
    offset = often.argmin(axis=1) if n else np.zeros(0, int)  # of equal counts the first
    alive = often[np.arange(n), offset] > 0 if n else np.zeros(0, bool)
    offset = np.minimum(offset, win.size - win.gram)
    prefix = win.grams[np.arange(n), offset] if n else np.zeros(0, np.uint64)
    by_size = {}
    for s in np.unique(win.gram):
        mine = np.flatnonzero((win.gram == s) & alive)
        mine = mine[np.argsort(prefix[mine], kind="stable")]
        k, first = np.unique(prefix[mine], return_index=True)
        by_size[int(s)] = (k, np.append(first, len(mine)), mine)
    return {"by_size": by_size, "offset": offset, "size": win.size, "one": win.one, "two": win.two, "item": np.array(win.item, object)}
