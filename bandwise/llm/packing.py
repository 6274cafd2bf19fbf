"""Bound-certified best-fit packing of documents into sequences of fixed length.

Texts become token counts in one pass (the ids themselves never travel).
Pieces are dealt to partitions of about ``part_rows`` by a hash; each runs
best-fit decreasing and compares its bin count with a lower bound from
dual-feasible functions. A partition that meets its bound is done. One with a
gap keeps its full bins and gives the pieces of the others to the next round,
where fewer partitions repack what all of them gave. The last round keeps all.

Defined results: null or empty text is the single end token; a row without a
doc_id is left out; repeated rows are packed each for itself; an empty table
gives no rows; extra columns are ignored. Equal lengths are told apart by
(doc_id, piece), so a rerun gives the same sequences.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.llm import textblocks as tb
from bandwise.llm.common import id_text, keep, shipped, shipped_group
from bandwise.llm.tokens import tokenizer

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long, final boolean, lower_bound long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_batches(batches, capacity: int, end_id: int, tokenizer_path: str):
    """Token pieces of every document: whole, or cut so that only the first is short."""
    tok = tokenizer(tokenizer_path)
    for block in tb.blocks(batches):
        ids, off = tok.encode(block)
        off = off.tolist()
        rows: list[tuple[int, int, int, int, int]] = []
        for i, doc in enumerate(block.ids.tolist()):
            own = np.append(ids[off[i] : off[i + 1]], end_id).astype("<u4")
            n = len(own)
            first = n if n <= capacity else n % capacity or capacity
            at, k = 0, 0
            while at < n:
                to = first if not k else at + capacity
                rows.append((doc, k, at, to - at, zlib.crc32(own[at:to].tobytes())))
                at, k = to, k + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
            names=["doc_id", "piece", "start", "length", "ids_crc32"],
        )


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Best-fit over lengths in the given (descending) order: bin and offset of each, room left per bin.

    Open bins hang in one list per room size; a bit set of the non-empty sizes
    yields the tightest fit by its lowest set bit.
    """
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    bins, offsets, left = [], [], []
    for n in lengths:
        fit = rooms >> n
        if fit:
            room = n + (fit & -fit).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, len(left)
            left.append(capacity)
        bins.append(b)
        offsets.append(capacity - room)
        room -= n
        left[b] = room
        if room:
            by_room[room].append(b)
            rooms |= 1 << room
    return bins, offsets, left


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The best of two families of dual-feasible functions (no packing needs fewer bins)."""
    if not len(lengths):
        return 0
    h = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1)
    many, total = np.cumsum(h), np.cumsum(h * size)
    best = -(-int(total[-1]) // capacity)
    for lam in range(1, capacity // 2 + 1):  # over capacity - lam: 1; below lam: 0; else in proportion
        big = int(many[-1] - many[capacity - lam])
        mid = int(total[capacity - lam] - total[lam - 1])
        best = max(best, big - (-mid // capacity))
    for k in range(1, 33):  # size * (k + 1) / capacity rounded down, over k
        scaled = size * (k + 1)
        whole = scaled % capacity == 0
        value = int((h * np.where(whole, size * k, scaled // capacity * capacity)).sum())  # times k * capacity
        best = max(best, -(-value // (k * capacity)))
    return best


def pack_part(t: pa.Table, capacity: int, round_no: int, last: bool) -> pa.Table:
    part = t.column("part")[0].as_py()
    length, doc, piece = (t.column(c).to_numpy() for c in ("length", "doc_id", "piece"))
    order = np.lexsort((piece, doc, -length))
    bins, offsets, left = best_fit(length[order].tolist(), capacity)
    bound = lower_bound(length, capacity)
    place = np.empty(len(order), np.int64)
    place[order] = bins
    offset = np.empty(len(order), np.int64)
    offset[order] = offsets
    done = np.ones(len(order), bool) if last or len(left) == bound else np.array(left)[place] == 0
    out = t.select(["doc_id", "piece", "start", "length", "ids_crc32"])
    for name, col in (("sequence_id", (round_no << 58) | (part << 32) | place), ("offset", offset)):
        out = out.append_column(name, pa.array(col, pa.int64()))
    return out.append_column("final", pa.array(done)).append_column("lower_bound", pa.array(np.full(len(order), bound), pa.int64()))


def _round(df: DataFrame, parts: int, capacity: int, round_no: int, last: bool) -> DataFrame:
    pack = shipped_group(__name__, "pack_part", capacity=capacity, round_no=round_no, last=last)
    dealt = df.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", F.lit(round_no)), F.lit(parts)))
    return dealt.groupBy("part").applyInArrow(pack, PACKED)


def pack(docs: DataFrame, capacity: int = 1024, end_id: int = 2, tokenizer_path: str | None = None, part_rows: int = 40_000, rounds: int = 3) -> DataFrame:
    """All pieces with sequence_id and offset (columns of ``PIECES`` and these two)."""
    params = {"capacity": capacity, "end_id": end_id, "tokenizer_path": tokenizer_path or default_tokenizer()}
    todo = keep(id_text(docs).mapInArrow(shipped(__name__, "piece_batches", **params), PIECES), "pieces")
    done, count = None, todo.count()
    for r in range(rounds):
        parts = -(-count // part_rows) or 1
        last = r == rounds - 1 or parts == 1
        packed = _round(todo, parts, capacity, r, last)
        if not last:
            packed = keep(packed, f"packed{r}")
        fixed = packed.where("final").drop("final", "lower_bound")
        done = fixed if done is None else done.unionByName(fixed)
        if last:
            break
        todo = packed.where("NOT final").drop("final", "lower_bound", "sequence_id", "offset")
        count = todo.count()
        if not count:
            break
    return done
