"""Candidates for repeated windows: what the two substring-dedup operators share.

A window is ``length`` consecutive symbols (words, or bytes) of one document.
Winnowed anchors (``textblocks.anchors``) stand for runs of windows, and equal
windows always have equal anchor grams. Per anchor there travel only the hash
of its gram and of its context (all symbols of its windows):

* anchors whose gram occurs nowhere else hold no repeated window;
* anchors with equal grams and contexts repeat each other in whole (128 hash bits);
* a gram with several contexts is *open*: only its contexts (one for each set
  of equal ones) are compared symbol by symbol, by the calling operator.

Equal contexts merge within each block before the shuffle. A gram with many
contexts within a block is *hot*: its anchors are dealt by (gram, context)
and later compared window by window, so no group of anchors meets in one task.
Rows with the same doc_id and place count as one occurrence.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.llm import textblocks as tb
from bandwise.llm.common import keep, parts, shipped

BLOCK_HOT = {"word": 8, "byte": 64}  # contexts of one gram in one block that make it hot
GRAM_ROWS = 2048  # anchors of one gram that make it hot over all blocks
DONE, HOT, MANY, MARK = 1, 2, 4, 8  # flags: result passed through; hot gram; context occurs twice; only says that the gram is hot
NAMES = ["route", "gram", "context", "doc_id", "at", "lo", "hi", "flag"]
ROWS = "route long, gram long, context long, doc_id long, at int, lo int, hi int, flag int"
VERDICTS = "doc_id long, at int, lo int, hi int, gram long, hot boolean, open boolean"
_TYPES = [pa.int64()] * 4 + [pa.int32()] * 4


def symbols(block: tb.Block, unit: str) -> tuple[np.ndarray, np.ndarray, tb.Words | None]:
    """(symbols, index of each document's first symbol, words if the unit is a word)."""
    if unit == "byte":
        return tb._SYMBOL[block.data], block.bounds, None
    w = tb.words(block)
    return w.hash, w.first, w


def anchor_batches(batches, unit: str, length: int, gram: int, keep_first: bool):
    """Anchor rows of every block, equal contexts merged; settled ones as DONE rows.

    keep_first: the first occurrence stays, later ones are removed; otherwise all
    occurrences of a repeated window are removed.
    """
    for block in tb.blocks(batches):
        sym, first, _ = symbols(block, unit)
        a = tb.anchors(sym, first, length, gram)
        n = len(a.at)
        if not n:
            continue
        doc = block.ids[a.doc]
        base = first[a.doc]
        lo, hi, at = a.lo - base, a.hi - base, a.at - base
        g, c = a.gram.view(np.int64), a.context.view(np.int64)
        order = np.lexsort((lo, doc, c, g))
        g, c, doc, lo, hi, at = (x[order] for x in (g, c, doc, lo, hi, at))
        new_gram = np.ones(n, bool)
        new_gram[1:] = g[1:] != g[:-1]
        new_ctx = new_gram.copy()
        new_ctx[1:] |= c[1:] != c[:-1]
        head = np.flatnonzero(new_ctx)
        ctx = np.cumsum(new_ctx) - 1
        other = (doc != doc[head[ctx]]) | (lo != lo[head[ctx]])  # than the context's first occurrence
        many = np.bincount(ctx, weights=other) > 0
        done = other if keep_first else many[ctx]
        gram_no = np.cumsum(new_gram) - 1
        contexts = np.bincount(gram_no[head])
        hot = contexts >= BLOCK_HOT[unit]
        rep_hot = hot[gram_no[head]]
        # representatives, settled rows, and one mark for each hot gram
        flag = np.where(rep_hot, HOT, 0) | np.where(many, MANY, 0)
        route = np.where(rep_hot, tb.mix(g[head].view(np.uint64) ^ tb.mix(c[head].view(np.uint64))).view(np.int64), g[head])
        yield _batch(route, g[head], c[head], doc[head], at[head], lo[head], hi[head], flag)
        k = np.flatnonzero(done)
        if len(k):
            zero = np.zeros(len(k), np.int64)
            yield _batch(tb.mix(doc[k].view(np.uint64)).view(np.int64), zero, zero, doc[k], at[k], lo[k], hi[k], zero + DONE)
        m = np.flatnonzero(new_gram)[hot]
        if len(m):
            zero = np.zeros(len(m), np.int64)
            yield _batch(g[m], g[m], zero + np.iinfo(np.int64).min, zero, zero, zero, zero, zero + MARK)


def _batch(*cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(c), t, safe=False) for c, t in zip(cols, _TYPES, strict=True)], names=NAMES)


def verdict_batches(batches, keep_first: bool):
    """One pass over anchor rows sorted by gram, context, document and place.

    Rows of the last gram wait for the next batch, at most GRAM_ROWS of them:
    a longer gram is hot, and hot grams need no look-ahead.
    """
    held: dict[str, np.ndarray] | None = None
    before: tuple | None = None  # gram, context, and that context's first (doc_id, lo, at, hi), of a hot gram that was cut
    for batch in batches:
        rows = {c: batch.column(c).to_numpy() for c in NAMES}
        if held is not None:
            rows = {c: np.concatenate([held[c], rows[c]]) for c in NAMES}
        g = rows["gram"]
        if not len(g):
            continue
        cut = int(np.flatnonzero(g != g[-1])[-1]) + 1 if (g != g[-1]).any() else 0
        over = len(g) - cut > GRAM_ROWS
        if over:
            yield _judge(rows, before, keep_first, cut_gram=g[-1])
            last = {c: rows[c][-1] for c in NAMES}
            head = _context_head(rows, before)
            before = (last["gram"], last["context"], *head)
            held = None
        else:
            if cut:
                yield _judge({c: v[:cut] for c, v in rows.items()}, before, keep_first)
                before = None
            held = {c: v[cut:] for c, v in rows.items()}
    if held is not None and len(held["gram"]):
        yield _judge(held, before, keep_first)


def _context_head(rows, before) -> tuple:
    """(doc_id, lo, at, hi) of the first occurrence of the last row's context."""
    g, c = rows["gram"], rows["context"]
    differs = np.flatnonzero((g != g[-1]) | (c != c[-1]))
    i = int(differs[-1]) + 1 if len(differs) else 0
    if i == 0 and before and before[0] == g[-1] and before[1] == c[-1]:
        return before[2:]
    return tuple(rows[k][i] for k in ("doc_id", "lo", "at", "hi"))


def _judge(rows, before, keep_first: bool, cut_gram=None) -> pa.RecordBatch:
    """Removed and open rows. before: the hot gram that earlier rows belong to; cut_gram: one that goes on."""
    g, c, flag, doc, lo = (rows[k] for k in ("gram", "context", "flag", "doc_id", "lo"))
    n = len(g)
    passed = (flag & DONE) > 0
    mark = (flag & MARK) > 0
    real = ~passed & ~mark
    new_gram = np.ones(n, bool)
    new_gram[1:] = g[1:] != g[:-1]
    new_ctx = new_gram.copy()
    new_ctx[1:] |= c[1:] != c[:-1]
    new_ctx[1:] |= passed[1:] != passed[:-1]
    gram_no, ctx = np.cumsum(new_gram) - 1, np.cumsum(new_ctx) - 1
    head = np.flatnonzero(new_ctx)
    head_doc, head_lo = doc[head].copy(), lo[head].copy()
    going_on = before is not None and before[0] == g[0] and before[1] == c[0]
    if going_on:
        head_doc[0], head_lo[0] = before[2], before[3]
    other = (doc != head_doc[ctx]) | (lo != head_lo[ctx])
    many = (np.bincount(ctx, weights=other) > 0) | (np.bincount(ctx, weights=(flag & MANY) > 0) > 0)
    hot = np.bincount(gram_no, weights=mark | ((flag & HOT) > 0)) > 0
    if before is not None and before[0] == g[0]:
        hot[0] = True
    if cut_gram is not None:
        hot[-1] = True
    contexts = np.bincount(gram_no[head], weights=real[head])
    is_open = (contexts[gram_no] > 1) | hot[gram_no]
    is_head = new_ctx.copy()
    if going_on:
        is_head[0] = False
    removed = passed | (real & (other if keep_first else many[ctx]))
    opened = real & is_head & is_open
    k = np.concatenate([np.flatnonzero(removed), np.flatnonzero(opened)])
    is_opened = np.arange(len(k)) >= removed.sum()
    cols = [rows["doc_id"][k], rows["at"][k], rows["lo"][k], rows["hi"][k], g[k], hot[gram_no][k], is_opened]
    if going_on and not keep_first and many[0]:  # its first occurrence went out before it was known to repeat
        first = (before[2], before[4], before[3], before[5], before[0], True, False)
        cols = [np.append(x, y) for x, y in zip(cols, first, strict=True)]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, types, strict=True)], names=["doc_id", "at", "lo", "hi", "gram", "hot", "open"])


def verdicts(rows: DataFrame, unit: str, length: int, gram: int, keep_first: bool) -> DataFrame:
    """Settled (removed) window runs and open anchors of all documents, written to the shared folder."""
    found = rows.mapInArrow(shipped(__name__, "anchor_batches", unit=unit, length=length, gram=gram, keep_first=keep_first), ROWS)
    dealt = found.repartition(parts(rows), "route").sortWithinPartitions("route", "gram", "context", "doc_id", "lo")
    return keep(dealt.mapInArrow(shipped(__name__, "verdict_batches", keep_first=keep_first), VERDICTS), "verdicts")


def per_document(v: DataFrame, *columns: str) -> DataFrame:
    """doc_id and its rows as one list (never more than the document has places)."""
    return v.groupBy("doc_id").agg(F.collect_list(F.struct(*columns)).alias("runs"))


def lists(batch: pa.RecordBatch) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """(offsets, fields) of the column ``runs``; a null list is empty."""
    runs = batch.column("runs")
    count = np.nan_to_num(pa.compute.list_value_length(runs).to_numpy(zero_copy_only=False)).astype(np.int64)
    flat = runs.flatten()
    fields = {f.name: flat.field(i).to_numpy(zero_copy_only=False) for i, f in enumerate(flat.type)}
    return np.concatenate([[0], np.cumsum(count)]), fields


def covered(lo: np.ndarray, hi: np.ndarray, length: int, size: int) -> np.ndarray:
    """Which of ``size`` symbols lie in a window that starts in one of the runs lo..hi."""
    step = np.zeros(size + 1, np.int64)
    np.add.at(step, lo, 1)
    np.add.at(step, hi + length, -1)
    return np.cumsum(step[:size]) > 0
