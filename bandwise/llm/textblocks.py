"""Vectorised words, rolling hashes and winnowed anchors over blocks of whole texts.

A *block* is a bounded batch of documents whose UTF-8 bytes lie behind each
other in one numpy buffer. Everything here works on the whole block at once,
so no Python code runs per word or per byte. Nothing crosses a document's end.

Hashes are polynomial sums modulo 2**64 over randomly mapped symbols (fixed
seed), finished by a mixer. Anchors follow winnowing (Schleimer, Wilkerson and
Aiken, SIGMOD 2003): a window of ``length`` symbols is represented by the
leftmost smallest hash among its ``gram``-symbol grams. Equal windows choose
the same gram at the same place, so equal windows always share an anchor hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)

BLOCK_BYTES = 2 << 20  # texts of one block; a longer text is a block of its own
_U = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20260719))
_SYMBOL = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE2 = 0xD6E8FEB86659FD93 | 1

SPACE_CLASS = np.ones(256, bool)
SPACE_CLASS[[0x20, 9, 10, 11, 12, 13]] = False  # True: a byte of a word `[^\x20\x09-\x0D]+`
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32  # A-Z only
ALNUM_CLASS = np.zeros(256, bool)  # after LOWER: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`
ALNUM_CLASS[48:58] = ALNUM_CLASS[97:123] = ALNUM_CLASS[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all input bits over all output bits (splitmix64's finisher)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Powers:
    """base**i and base**-i modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.up, self.down = base, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            m = -(-n // (1 << 18)) << 18
            inverse = pow(self.base, -1, 1 << 64)
            for name, b in (("up", self.base), ("down", inverse)):
                a = np.full(m, b, np.uint64)
                a[0] = 1
                setattr(self, name, np.multiply.accumulate(a))
        return self.up[:n], self.down[:n]


_POWERS, _POWERS2 = Powers(_BASE), Powers(_BASE2)


class Rolling:
    """Hashes of arbitrary ranges [start, end) of a symbol sequence."""

    def __init__(self, symbols: np.ndarray, powers: Powers = _POWERS):
        up, self.down = powers.upto(len(symbols) + 1)
        self.sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(symbols * up[:-1], out=self.sums[1:])

    def raw(self, start, end) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def grams(self, size: int) -> np.ndarray:
        """Hash of every ``size`` consecutive symbols."""
        n = len(self.sums) - size
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[size:] - self.sums[:n]) * self.down[:n])


def second(symbols: np.ndarray) -> Rolling:
    """A rolling hash independent of the first one."""
    return Rolling(mix(symbols + _U(0x632BE59BD9B4E019)), _POWERS2)


@dataclass
class Block:
    ids: np.ndarray  # int64 document ids
    data: np.ndarray  # uint8, all texts behind each other
    bounds: np.ndarray  # int64, len(ids) + 1 byte offsets

    def text(self, i: int) -> bytes:
        return self.data[self.bounds[i] : self.bounds[i + 1]].tobytes()


def blocks(batches: Iterator[pa.RecordBatch], id_col: str = "doc_id", text_col: str = "text", limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of at most about ``limit`` bytes; null texts count as empty."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def flush() -> Block:
        ids = np.concatenate([h[0] for h in held])
        bounds = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(np.concatenate([h[2] for h in held]), out=bounds[1:])
        return Block(ids, np.concatenate([h[1] for h in held]), bounds)

    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column(id_col).to_numpy(zero_copy_only=False).astype(np.int64)
        text = batch.column(text_col)
        text = text.cast(pa.large_binary() if not pa.types.is_large_string(text.type) and not pa.types.is_large_binary(text.type) else pa.large_binary())
        text = text.fill_null(b"")
        offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        raw = text.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        lo = 0
        while lo < len(ids):
            hi = int(np.searchsorted(offsets, offsets[lo] + max(limit - size, 0), side="right")) - 1
            hi = min(max(hi, lo + (0 if held else 1)), len(ids))
            if hi > lo:
                held.append((ids[lo:hi], data[offsets[lo] : offsets[hi]].copy(), np.diff(offsets[lo : hi + 1])))
                size += int(offsets[hi] - offsets[lo])
            lo = hi
            if lo < len(ids) or size >= limit:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def sliced(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, Block]]:
    """Slices of the batches with at most about ``limit`` bytes of text, each with its block."""
    for batch in batches:
        size = np.nan_to_num(pa.compute.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(float))
        part = (np.cumsum(size) // limit).astype(np.int64)
        edges = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [batch.num_rows]]) if batch.num_rows else [0]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            piece = batch.slice(a, b - a)
            yield piece, next(blocks(iter([piece]), limit=1 << 62))


@dataclass
class Words:
    start: np.ndarray  # byte offset of each word
    end: np.ndarray
    hash: np.ndarray  # uint64 per word
    first: np.ndarray  # len(docs) + 1: index of each document's first word


def words(block: Block, member: np.ndarray = SPACE_CLASS, lower: bool = False) -> Words:
    """The words of every text: maximal runs of bytes of class ``member``."""
    data = LOWER[block.data] if lower else block.data
    n = len(data)
    inside = member[data]
    edge = np.zeros(n + 1, bool)
    edge[block.bounds[block.bounds < n]] = True  # a word never crosses a text's end
    before = np.empty(n, bool)
    if n:
        before[0] = False
        before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.empty(n, bool)
    if n:
        after[-1] = False
        after[:-1] = inside[1:]
    edge[n] = True
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    roll = Rolling(_SYMBOL[data])
    return Words(start, end, mix(roll.raw(start, end) + (end - start).astype(np.uint64)), np.searchsorted(start, block.bounds))


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """min(a[i : i + width]) for every i (block prefix and suffix minima)."""
    n = len(a) - width + 1
    if n <= 0:
        return a[:0]
    if width == 1:
        return a
    pad = -len(a) % width
    top = np.iinfo(a.dtype).max
    grid = np.concatenate([a, np.full(pad, top, a.dtype)]).reshape(-1, width)
    prefix = np.minimum.accumulate(grid, axis=1).ravel()
    suffix = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(suffix[:n], prefix[width - 1 : width - 1 + n])


@dataclass
class Anchors:
    """Anchor ``at`` stands for the windows that start at lo..hi (inclusive)."""

    doc: np.ndarray  # index of the document in the block
    at: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    gram: np.ndarray  # uint64 hash of the anchor gram
    context: np.ndarray  # uint64 hash of the symbols lo .. hi + length, and of at - lo


def anchors(symbols: np.ndarray, first: np.ndarray, length: int, gram: int) -> Anchors:
    """Winnowed anchors of all windows of ``length`` symbols that lie within one document."""
    n = len(symbols)
    starts = n - length + 1
    if starts <= 0:
        z = np.zeros(0, np.int64)
        return Anchors(z, z, z, z, z.astype(np.uint64), z.astype(np.uint64))
    roll = Rolling(symbols)
    h = roll.grams(gram)
    bits = _U(max(1, int(len(h)).bit_length()))
    low = (_U(1) << bits) - _U(1)
    key = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    best = sliding_min(key, length - gram + 1)
    sizes = np.diff(first)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    s = np.arange(starts)
    ok = doc[:starts] == doc[length - 1 :]
    fresh = np.ones(starts, bool)
    fresh[1:] = (best[1:] != best[:-1]) | ~ok[:-1] | (doc[1:starts] != doc[: starts - 1])
    head = np.flatnonzero(fresh & ok)
    tail_mask = np.ones(starts, bool)
    tail_mask[:-1] = fresh[1:] | ~ok[1:]
    tail = np.flatnonzero(tail_mask & ok)
    at = (best[head] & low).astype(np.int64)
    ctx = second(symbols)
    context = mix(ctx.raw(head, tail + length) + mix((at - head).astype(np.uint64) * _U(0x1000003) + (tail - head).astype(np.uint64)))
    return Anchors(doc[head], at, head, tail, h[at], context)
