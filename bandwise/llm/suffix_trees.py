"""Substring dedup over words, with prefix-partitioned suffix trees.

A word belongs to a repeat if it lies in a window of ``length`` words whose word
sequence also starts earlier (smaller doc_id, or earlier in the document).
``repeats`` finds the windows that can repeat. Their suffixes are partitioned
by a prefix of variable length: all words up to the end of the window's anchor
gram, and the whole window where that prefix is too frequent (hot grams).
So every partition is of bounded size. Each builds its subtree, as the sorted suffixes with
their longest common prefixes; internal nodes of depth ``length`` or more are
the repeats, and all leaves but a node's earliest are removed.

Defined results: null text has no words; fewer than ``length`` words hold no
window; rows with equal doc_id are taken as copies of one document (each is
reported, none removes the other); an empty table gives no rows; rows without
doc_id are left out; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.llm import repeats
from bandwise.llm import textblocks as tb
from bandwise.llm.common import id_text, parts, shipped

SUBTREE_SUFFIXES = 100_000  # suffixes sorted at once, 8 * length bytes each
CONTEXTS = "key long, doc_id long, lo int, hi int, words binary"
_NAMES = ["key", "doc_id", "lo", "hi", "words"]
_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]


def context_batches(batches, length: int):
    """Open contexts as (prefix key, document, first window, words); hot ones window by window.

    Windows of hot grams that repeat within the slice leave only their earliest;
    the others pass through as removed (no words).
    """
    for batch, block in tb.sliced(batches):
        off, run = repeats.lists(batch)
        n = off[-1]
        if not n:
            continue
        w = tb.words(block)
        doc = np.repeat(np.arange(len(block.ids)), np.diff(off))
        hot = run["hot"].astype(bool)
        out = []
        k = np.flatnonzero(~hot)
        if len(k):
            out.append((run["gram"][k], doc[k], run["lo"][k], run["hi"][k]))
        k = np.flatnonzero(hot)
        if len(k):
            many = run["hi"][k] - run["lo"][k] + 1
            d = np.repeat(doc[k], many)
            s = np.repeat(run["lo"][k], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            start = w.first[d] + s
            key = tb.mix(tb.Rolling(w.hash).raw(start, start + length) + np.uint64(length)).view(np.int64)
            order = np.lexsort((s, block.ids[d], key))
            key, d, s = key[order], d[order], s[order]
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            head = np.flatnonzero(new)[np.cumsum(new) - 1]
            out.append((key[new], d[new], s[new], s[new]))
            later = ~new & ((block.ids[d] != block.ids[d[head]]) | (s != s[head]))
            ids = block.ids[d[later]]
            yield _batch(tb.mix(ids.view(np.uint64)).view(np.int64), ids, s[later], s[later], [None] * int(later.sum()))
        key, d, lo, hi = (np.concatenate(x) for x in zip(*out, strict=True))
        a, b = w.start[w.first[d] + lo].tolist(), w.end[w.first[d] + hi + length - 1].tolist()
        raw = block.data.tobytes()
        yield _batch(key, block.ids[d], lo, hi, [raw[x:y] for x, y in zip(a, b, strict=True)])


def _batch(*cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t, safe=False) for c, t in zip(cols, _TYPES, strict=True)], names=_NAMES)


def sorted_suffixes(symbols: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(order of the suffixes, common prefix of each with the one before it), compared up to ``length`` symbols."""
    rows = np.ascontiguousarray(symbols[start[:, None] + np.arange(length)].astype(">u8"))
    order = np.argsort(rows.view(f"V{8 * length}").ravel(), kind="stable")
    rows = rows[order]
    lcp = np.zeros(len(order), np.int64)
    lcp[1:] = np.cumprod(rows[1:] == rows[:-1], axis=1).sum(axis=1)
    return order, lcp


def deep_nodes(lcp: np.ndarray, depth: int) -> np.ndarray:
    """For each leaf, in sorted order, the number of its ancestor at ``depth`` (leaves that share one meet at or below it)."""
    return np.cumsum(lcp < depth) - 1


def subtree_batches(batches, length: int):
    """Removed windows of every prefix partition (rows sorted by key)."""
    held = None
    for batch in batches:
        gone = batch.column("words").is_null().to_numpy(zero_copy_only=False)
        if gone.any():
            yield _removed(*(batch.column(c).to_numpy()[gone] for c in ("doc_id", "lo", "hi")))
        rows = batch.filter(pa.array(~gone))
        if not rows.num_rows:
            continue
        held = pa.Table.from_batches([rows]) if held is None else pa.concat_tables([held, pa.Table.from_batches([rows])])
        if int(_windows(held).sum()) < SUBTREE_SUFFIXES:
            continue
        key = held.column("key").to_numpy()
        differs = np.flatnonzero(key != key[-1])
        cut = int(differs[-1]) + 1 if len(differs) else 0
        if cut:
            done, _ = _subtree(held.slice(0, cut), length)
            yield done
            held = held.slice(cut)
        if int(_windows(held).sum()) >= SUBTREE_SUFFIXES:  # one window, many times: its earliest is enough
            done, held = _subtree(held, length)
            yield done
    if held is not None and held.num_rows:
        yield _subtree(held, length)[0]


def _windows(t: pa.Table) -> np.ndarray:
    return t.column("hi").to_numpy().astype(np.int64) - t.column("lo").to_numpy() + 1


def _subtree(t: pa.Table, length: int) -> tuple[pa.RecordBatch, pa.Table]:
    """(removed windows, the rows that hold a node's earliest leaf)."""
    text = t.column("words").combine_chunks()
    block = next(tb.blocks(iter([pa.RecordBatch.from_arrays([pa.array(np.arange(t.num_rows)), text], names=["doc_id", "text"])]), limit=1 << 62))
    w = tb.words(block)
    many = _windows(t)
    row = np.repeat(np.arange(t.num_rows), many)
    step = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    doc = t.column("doc_id").to_numpy()[row]
    place = t.column("lo").to_numpy()[row] + step
    order, lcp = sorted_suffixes(w.hash, w.first[row] + step, length)
    node = np.empty(len(order), np.int64)
    node[order] = deep_nodes(lcp, length)
    by_node = np.lexsort((place, doc, node))
    new = np.ones(len(by_node), bool)
    new[1:] = node[by_node][1:] != node[by_node][:-1]
    head = by_node[np.flatnonzero(new)[np.cumsum(new) - 1]]  # the node's earliest leaf
    later = (doc[by_node] != doc[head]) | (place[by_node] != place[head])
    k = by_node[later]
    return _removed(doc[k], place[k], place[k]), t.take(pa.array(np.unique(row[by_node[new]])))


def _removed(doc, lo, hi) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(lo, pa.int32(), safe=False), pa.array(hi, pa.int32(), safe=False)], names=["doc_id", "lo", "hi"])


def kept_batches(batches, length: int):
    """Every document's words without the removed ones, joined by one space."""
    for batch, block in tb.sliced(batches):
        off, run = repeats.lists(batch)
        w = tb.words(block)
        n_words = np.diff(w.first)
        texts, n_removed = [], []
        for i, n in enumerate(n_words.tolist()):
            if off[i] == off[i + 1]:
                texts.append(b" ".join(block.text(i).split()))  # splits at \\x20 and \\x09-\\x0D
                n_removed.append(0)
                continue
            gone = repeats.covered(run["lo"][off[i] : off[i + 1]], run["hi"][off[i] : off[i + 1]], length, n)
            edge = np.flatnonzero(np.diff(np.concatenate([[1], gone.astype(np.int8), [1]])))
            f = w.first[i]
            kept = [block.data[w.start[f + a] : w.end[f + b - 1]].tobytes() for a, b in edge.reshape(-1, 2).tolist()]
            texts.append(b" ".join(x for k in kept for x in k.split()))
            n_removed.append(int(gone.sum()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(block.ids), pa.array(n_words.astype(np.int64)), pa.array(n_removed, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept"],
        )


def dedup(docs: DataFrame, length: int = 20, gram: int = 5) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the text that stays) of every document."""
    rows = id_text(docs)
    found = repeats.verdicts(rows, "word", length, gram, keep_first=True)
    by_doc = rows.repartition(parts(rows), "doc_id")  # one shuffle of the texts for both joins
    opened = repeats.per_document(found.where("open"), "lo", "hi", "gram", "hot")
    contexts = by_doc.join(opened, "doc_id").mapInArrow(shipped(__name__, "context_batches", length=length), CONTEXTS)
    dealt = contexts.repartition(parts(rows), "key").sortWithinPartitions("key", "doc_id", "lo")
    later = dealt.mapInArrow(shipped(__name__, "subtree_batches", length=length), "doc_id long, lo int, hi int")
    removed = repeats.per_document(found.where("NOT open").select("doc_id", "lo", "hi").unionByName(later), "lo", "hi")
    return by_doc.join(removed, "doc_id", "left").mapInArrow(
        shipped(__name__, "kept_batches", length=length), "doc_id long, n_words long, n_removed long, kept string"
    )
