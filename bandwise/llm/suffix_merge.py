"""Substring dedup over bytes, with a common-prefix-aware distributed merge sort.

A byte is removed if it lies in a ``length``-byte string that also starts
anywhere else (same document included); strings never cross documents.

``repeats`` finds the windows that can repeat; their anchors sample the
suffixes to sort, so every open window lies around one sorted suffix. Tasks sort
the suffixes of their open anchors and exchange them as front-coded runs
(length of the prefix shared with the one before, and the rest). Each
receiver combines its runs with a loser tree that keeps, for every loser, the prefix it shares
with the winner that beat it: suffixes are told apart by those numbers alone
unless they are equal, and then compared only beyond the known prefix. The
merge so yields the suffix array of its range with its common prefixes. Two
anchors share the windows that reach no further than their common prefix to
the right and their common suffix to the left.

Windows of hot grams (too many different contexts for one task) are dealt by
themselves, as 128-bit hashes: merged within each block, then packed into one row for each receiver.

Defined results: null text is empty; a text shorter than ``length`` keeps all
bytes; rows with equal doc_id are taken as copies of one document; an empty
table gives no rows; rows without doc_id are left out; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.llm import repeats
from bandwise.llm import textblocks as tb
from bandwise.llm.common import id_text, parts, shipped

RUN_BYTES = 16 << 20  # suffix bytes sorted into one set of runs
PART_BYTES = 16 << 20  # suffix bytes merged by one receiver
FEW = 6  # members of a gram that are compared two by two
RUN, WINDOWS, DONE = 0, 1, 2
SENT = "kind int, part long, packed binary, doc_id long, lo int, hi int"
_SENT = [("kind", pa.int32()), ("part", pa.int64()), ("packed", pa.binary()), ("doc_id", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())]
_WINDOW = np.dtype([("one", "<u8"), ("two", "<u8"), ("doc_id", "<i8"), ("lo", "<i4"), ("many", "<i4")])


def common(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of a and b, known to be at least ``at``."""
    n = min(len(a), len(b))
    while at < n:
        x, y = a[at : at + 64], b[at : at + 64]
        if x != y:
            m = min(len(x), len(y))
            diff = int.from_bytes(x[:m]) ^ int.from_bytes(y[:m])
            return at + m - (diff.bit_length() + 7) // 8
        at += 64
    return n


def encode_run(items: list[tuple[bytes, bytes, int, int, int, int]]) -> bytes:
    """Front-coded run of sorted (right, left, doc_id, at, lo, hi)."""
    n = len(items)
    lcp, before, tails = np.zeros(n, np.int32), b"", []
    for i, x in enumerate(items):
        lcp[i] = common(before, x[0], 0)
        before = x[0]
        tails.append(before[lcp[i] :])
    cols = [np.array([x[k] for x in items], t) for k, t in ((2, np.int64), (3, np.int32), (4, np.int32), (5, np.int32))]
    cols += [lcp, np.array([len(t) for t in tails], np.int32)]
    return np.int64(n).tobytes() + b"".join(c.tobytes() for c in cols) + b"".join(tails) + b"".join(x[1] for x in items)


def decode_run(raw: bytes) -> Iterator[tuple[bytes, int, tuple]]:
    """(suffix, prefix shared with the one before, (left, doc_id, at, lo, hi)), in order."""
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    pos, cols = 8, []
    for t in (np.int64, np.int32, np.int32, np.int32, np.int32, np.int32):
        cols.append(np.frombuffer(raw, t, n, pos).tolist())
        pos += n * np.dtype(t).itemsize
    left_at = pos + sum(cols[5])
    before = b""
    for doc, at, lo, hi, lcp, tail in zip(*cols, strict=True):
        before = before[:lcp] + raw[pos : pos + tail]
        pos += tail
        yield before, lcp, (raw[left_at : left_at + at - lo], doc, at, lo, hi)
        left_at += at - lo


class LoserTree:
    """Merges sorted runs; yields (suffix, prefix shared with the one yielded before, payload).

    A player is [suffix or None, shared, payload, run]. ``shared`` of a loser is
    its common prefix with the winner that last passed its node; a run's next
    player starts with the prefix shared with its forerunner, the last winner.
    """

    def __init__(self, runs: list[Iterator]):
        self.runs = runs
        self.size = 1
        while self.size < len(runs):
            self.size *= 2
        self.node: list = [None] * self.size
        self.top = self._build(1)

    def _next(self, run: int) -> list:
        if run < len(self.runs):
            for suffix, shared, payload in self.runs[run]:
                return [suffix, shared, payload, run]
        return [None, -1, None, run]

    def _build(self, at: int) -> list:
        if at >= self.size:
            first = self._next(at - self.size)
            if first[0] is not None:
                first[1] = 0
            return first
        winner, self.node[at] = self._play(self._build(2 * at), self._build(2 * at + 1))
        return winner

    @staticmethod
    def _play(a: list, b: list) -> tuple[list, list]:
        """(winner, loser): both share their known prefix with the same earlier string."""
        if a[1] != b[1]:
            return (a, b) if a[1] > b[1] else (b, a)  # the longer shared prefix comes first
        if a[0] is None:
            return a, b
        x, y, known = a[0], b[0], a[1]
        both = common(x, y, known)
        a_first = both == len(x) or (both < len(y) and x[both] < y[both])
        if a_first:
            b[1] = both
            return a, b
        a[1] = both
        return b, a

    def __iter__(self):
        while self.top[0] is not None:
            suffix, shared, payload, run = self.top
            yield suffix, shared, payload
            player = self._next(run)
            at = (run + self.size) // 2
            while at:
                player, self.node[at] = self._play(player, self.node[at])
                at //= 2
            self.top = player


def shared_windows(members: list[tuple], right: list[int], length: int) -> list[tuple[int, int, int]]:
    """Runs (doc_id, lo, hi) of repeated windows among the members of one gram.

    members: (left, doc_id, at, lo, hi) in suffix order; right[i]: prefix that
    members i and i - 1 share. A window of a member begins ``a`` bytes before its anchor.
    """
    out = []
    n = len(members)
    span = [(m[2] - m[4], m[2] - m[3]) for m in members]  # least and largest a

    def add(i: int, a: int, b: int) -> None:
        out.append((members[i][1], members[i][2] - b, members[i][2] - a))

    if n <= FEW:
        for i in range(n):
            reach = 1 << 60
            for j in range(i + 1, n):
                reach = min(reach, right[j])
                if members[i][1:3] == members[j][1:3]:
                    continue
                back = common(members[i][0][::-1], members[j][0][::-1], 0)
                a, b = max(span[i][0], span[j][0], length - reach), min(span[i][1], span[j][1], back)
                if a <= b:
                    add(i, a, b)
                    add(j, a, b)
        return out
    # classes by the right and the left context change with a only at a few places
    flipped = [m[0][::-1] for m in members]
    by_left = sorted(range(n), key=lambda i: flipped[i])
    back = np.array([0] + [common(flipped[x], flipped[y], 0) for x, y in zip(by_left[:-1], by_left[1:], strict=True)])
    ahead = np.array([0] + right[1:])
    low, high = (np.array(x) for x in zip(*span, strict=True))
    edges = np.unique(np.concatenate([low, high + 1, length - ahead[1:], back[1:] + 1]))
    edges = edges[(edges >= low.min()) & (edges <= high.max() + 1)]
    place = np.array([hash(m[1:3]) for m in members])
    for a, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        class_r = np.cumsum(ahead < length - a)
        class_l = np.empty(n, np.int64)
        class_l[by_left] = np.cumsum(back < a) if a else 0
        valid = np.flatnonzero((low <= a) & (high >= a))
        _, cls = np.unique(class_r[valid] * (n + 1) + class_l[valid], return_inverse=True)
        if not len(cls):
            continue
        least, most = np.full(cls.max() + 1, np.iinfo(np.int64).max), np.full(cls.max() + 1, np.iinfo(np.int64).min)
        np.minimum.at(least, cls, place[valid])
        np.maximum.at(most, cls, place[valid])
        for i in valid[least[cls] < most[cls]].tolist():
            add(i, a, end - 1)
    return out


def merged_windows(runs: list[bytes], length: int, gram: int) -> list[tuple[int, int, int]]:
    """All repeated windows that the merged runs show."""
    out, members, right = [], [], []
    for _, shared, payload in LoserTree([decode_run(r) for r in runs]):
        if shared < gram and members:  # another gram begins
            if len(members) > 1:
                out += shared_windows(members, right, length)
            members, right = [], []
        members.append(payload)
        right.append(shared)
    if len(members) > 1:
        out += shared_windows(members, right, length)
    return out


def send_batches(batches, length: int, n_parts: int):
    """Sorted front-coded runs for every receiver, and the hashed windows of hot grams."""
    held: dict[int, list] = {}
    size = 0
    for batch, block in tb.sliced(batches):
        off, run = repeats.lists(batch)
        if not off[-1]:
            continue
        doc = np.repeat(np.arange(len(block.ids)), np.diff(off))
        raw = block.data.tobytes()
        cold = np.flatnonzero(~run["hot"].astype(bool))
        base = block.bounds[doc[cold]].tolist()
        to = (tb.mix(run["gram"][cold].view(np.uint64)) % np.uint64(n_parts)).tolist()
        cols = [run[c][cold].tolist() for c in ("at", "lo", "hi")]
        for p, d, f, at, lo, hi in zip(to, block.ids[doc[cold]].tolist(), base, *cols, strict=True):
            held.setdefault(p, []).append((raw[f + at : f + hi + length], raw[f + lo : f + at], d, at, lo, hi))
            size += hi + length - lo
        if size >= RUN_BYTES:
            yield _runs(held)
            held, size = {}, 0
        hot = np.flatnonzero(run["hot"].astype(bool))
        if len(hot):
            yield from _hot_windows(block, doc[hot], run["lo"][hot], run["hi"][hot], length, n_parts)
    if held:
        yield _runs(held)


def _sent(kind: int, part, packed=None, doc_id=None, lo=None, hi=None) -> pa.RecordBatch:
    n = len(part)
    cols = [np.full(n, kind), part, packed, doc_id, lo, hi]
    return pa.RecordBatch.from_arrays([pa.array([None] * n if c is None else c, t) for c, (_, t) in zip(cols, _SENT, strict=True)], names=[k for k, _ in _SENT])


def _runs(held: dict[int, list]) -> pa.RecordBatch:
    names = sorted(held)
    coded = []
    for p in names:
        held[p].sort(key=lambda x: x[0])
        coded.append(encode_run(held[p]))
    return _sent(RUN, names, coded)


def _repeated(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(windows that stand for each distinct one, with their many mark; all windows that occur more than once)."""
    w = w[np.lexsort((w["lo"], w["doc_id"], w["two"], w["one"]))]
    new = np.ones(len(w), bool)
    new[1:] = (w["one"][1:] != w["one"][:-1]) | (w["two"][1:] != w["two"][:-1])
    head, cls = np.flatnonzero(new), np.cumsum(new) - 1
    other = (w["doc_id"] != w["doc_id"][head[cls]]) | (w["lo"] != w["lo"][head[cls]])
    many = np.bincount(cls, weights=other | (w["many"] > 0)) > 0
    heads = w[head]
    heads["many"] = many
    return heads, w[many[cls]]


def _as_runs(w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc_id, lo, hi) of the maximal runs of consecutive windows."""
    w = w[np.lexsort((w["lo"], w["doc_id"]))]
    new = np.ones(len(w), bool)
    new[1:] = (w["doc_id"][1:] != w["doc_id"][:-1]) | (w["lo"][1:] > w["lo"][:-1] + 1)
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(w)) - 1 if len(w) else head
    return w["doc_id"][head], w["lo"][head], w["lo"][last]


def _hot_windows(block: tb.Block, doc, lo, hi, length: int, n_parts: int):
    """The distinct windows, packed for each receiver, and the runs of those that the block itself repeats."""
    sym = tb._SYMBOL[block.data]
    many = hi.astype(np.int64) - lo + 1
    d = np.repeat(doc, many)
    s = np.repeat(lo, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    at = block.bounds[d] + s
    w = np.zeros(len(at), _WINDOW)
    w["one"], w["two"] = (tb.mix(r.raw(at, at + length)) for r in (tb.Rolling(sym), tb.second(sym)))
    w["doc_id"], w["lo"] = block.ids[d], s
    heads, twice = _repeated(w)
    part = (tb.mix(heads["one"]) % np.uint64(n_parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    names, first = np.unique(part[order], return_index=True)
    yield _sent(WINDOWS, names, [x.tobytes() for x in np.split(heads[order], first[1:])])
    if len(twice):
        ids, a, b = _as_runs(twice)
        yield _sent(DONE, (tb.mix(ids.view(np.uint64)) % np.uint64(n_parts)).astype(np.int64), None, ids, a, b)


def receive_batches(batches, length: int, gram: int):
    """Repeated windows, part by part: of the merged runs, of the hashed windows, and those known before."""
    part, runs, packed = None, [], []

    def found() -> Iterator[pa.RecordBatch]:
        merged = merged_windows(runs, length, gram) if runs else []
        if merged:
            yield _windows(*zip(*merged, strict=True))
        if packed:
            _, twice = _repeated(np.concatenate([np.frombuffer(x, _WINDOW) for x in packed]))
            yield _windows(*_as_runs(twice))

    for batch in batches:
        known = batch.column("kind").to_numpy() == DONE
        if known.any():
            yield _windows(*(batch.column(c).to_numpy(zero_copy_only=False)[known] for c in ("doc_id", "lo", "hi")))
        rest = batch.filter(pa.array(~known))
        for kind, p, x in zip(*(rest.column(c).to_pylist() for c in ("kind", "part", "packed")), strict=True):
            if p != part:
                yield from found()
                part, runs, packed = p, [], []
            (runs if kind == RUN else packed).append(x)
    yield from found()


def _windows(doc_id, lo, hi) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t, safe=False) for c, t in zip((doc_id, lo, hi), (pa.int64(), pa.int32(), pa.int32()), strict=True)], names=["doc_id", "lo", "hi"])


def kept_batches(batches, length: int):
    """Every document's bytes without the removed ones."""
    for batch, block in tb.sliced(batches):
        off, run = repeats.lists(batch)
        sizes = np.diff(block.bounds)
        kept, removed, spans = [], [], []
        for i, n in enumerate(sizes.tolist()):
            data = block.data[block.bounds[i] : block.bounds[i + 1]]
            if off[i] == off[i + 1]:
                kept.append(data.tobytes())
                removed.append(0)
                spans.append(0)
                continue
            gone = repeats.covered(run["lo"][off[i] : off[i + 1]], run["hi"][off[i] : off[i + 1]], length, n)
            kept.append(data[~gone].tobytes())
            removed.append(int(gone.sum()))
            spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(block.ids), pa.array(sizes), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def dedup(docs: DataFrame, length: int = 400, gram: int = 128) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the bytes that stay) of every document."""
    rows = id_text(docs)
    found = repeats.verdicts(rows, "byte", length, gram, keep_first=False)
    windows = F.col("hi") - F.col("lo") + 1
    size = found.where("open").agg(F.sum(F.when(F.col("hot"), windows * _WINDOW.itemsize).otherwise(windows + length))).first()[0] or 0
    n = parts(rows)
    n_parts = max(n, -(-size // PART_BYTES))
    by_doc = rows.repartition(n, "doc_id")  # one shuffle of the texts for both joins
    opened = repeats.per_document(found.where("open"), "at", "lo", "hi", "gram", "hot")
    sent = by_doc.join(opened, "doc_id").mapInArrow(shipped(__name__, "send_batches", length=length, n_parts=n_parts), SENT)
    dealt = sent.repartition(n, "part").sortWithinPartitions("part", "kind")
    more = dealt.mapInArrow(shipped(__name__, "receive_batches", length=length, gram=gram), "doc_id long, lo int, hi int")
    removed = repeats.per_document(found.where("NOT open").select("doc_id", "lo", "hi").unionByName(more), "lo", "hi")
    return by_doc.join(removed, "doc_id", "left").mapInArrow(
        shipped(__name__, "kept_batches", length=length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )
