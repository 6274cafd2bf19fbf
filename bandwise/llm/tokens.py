"""Byte-BPE ids of whole texts, each distinct chunk tokenised once per worker.

A text is cut before a single white-space byte between two other characters.
No token of the GPT-style pre-tokeniser crosses such a cut (a lone space joins
the word behind it, a lone line break is a token of its own), so the ids of the
chunks, in order, are the ids of the text. ``tests/llm`` compares both.
"""

from __future__ import annotations

import os

import numpy as np

from bandwise.llm import textblocks as tb

CACHE_CHUNKS = 1_500_000  # known chunks of one worker, about 30 bytes each; beyond it the cache starts anew
PROBE = 2000  # chunks given to the tokenizer at once


class ChunkTokenizer:
    def __init__(self, path: str, plain_specials: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = plain_specials  # True: their strings in a text are ordinary text
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.checks = np.zeros(0, np.uint64)  # a second hash of the same chunk
        self.start = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int32)
        self.flat = np.zeros(0, np.int32)

    @staticmethod
    def hashes(symbols: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = (end - start).astype(np.uint64)
        return tb.mix(tb.Rolling(symbols).raw(start, end) + size), tb.mix(tb.second(symbols).raw(start, end) + size)

    def _learn(self, keys: np.ndarray, checks: np.ndarray, chunks: list[str]) -> None:
        if len(self.keys) and len(self.keys) + len(keys) > CACHE_CHUNKS:
            self.clear()
        ids: list[list[int]] = []
        for i in range(0, len(chunks), PROBE):
            ids += [e.ids for e in self.tok.encode_batch_fast(chunks[i : i + PROBE], add_special_tokens=False)]
        count = np.fromiter((len(x) for x in ids), np.int32, len(ids))
        flat = np.fromiter((y for x in ids for y in x), np.int32, int(count.sum()))
        start = len(self.flat) + np.cumsum(count, dtype=np.int64) - count
        all_keys = np.concatenate([self.keys, keys])
        order = np.argsort(all_keys, kind="stable")
        self.keys = all_keys[order]
        self.checks = np.concatenate([self.checks, checks])[order]
        self.start = np.concatenate([self.start, start])[order]
        self.count = np.concatenate([self.count, count])[order]
        self.flat = np.concatenate([self.flat, flat])

    def encode(self, block: tb.Block) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts behind each other, len(texts) + 1 offsets)."""
        start, end = cuts(block)
        if not len(start):
            return np.zeros(0, np.int32), np.zeros(len(block.ids) + 1, np.int64)
        symbols = tb._SYMBOL[block.data]
        key, check = self.hashes(symbols, start, end)
        distinct, first, back = np.unique(key, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, distinct)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == distinct[known]
        if not known.all():
            if len(self.keys) + int((~known).sum()) > CACHE_CHUNKS:
                self.clear()
                known[:] = False
            new = np.flatnonzero(~known)
            raw = block.data.tobytes()
            s, e = start[first[new]].tolist(), end[first[new]].tolist()
            self._learn(distinct[new], check[first[new]], [raw[a:b].decode("utf-8", "surrogatepass") for a, b in zip(s, e, strict=True)])
            at = np.searchsorted(self.keys, distinct)
        each_start, each_count = self.start[at][back], self.count[at][back].astype(np.int64)
        stop = np.cumsum(each_count)
        ids = self.flat[np.repeat(each_start - (stop - each_count), each_count) + np.arange(int(stop[-1]))]
        chunk_of = np.searchsorted(start, block.bounds)
        off = np.concatenate([[0], stop])[chunk_of]
        if (self.checks[at][back] != check).any():  # two chunks with one key
            return self._apart(block, ids, off, chunk_of, self.checks[at][back] != check)
        return ids, off

    def _apart(self, block: tb.Block, ids: np.ndarray, off: np.ndarray, chunk_of: np.ndarray, wrong: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts with a chunk that the cache takes for another one are tokenised whole."""
        bad = np.diff(np.concatenate([[0], np.cumsum(wrong)])[chunk_of]) > 0
        own = [ids[a:b] for a, b in zip(off[:-1], off[1:], strict=True)]
        for i in np.flatnonzero(bad):
            own[i] = np.array(self.tok.encode(block.text(i).decode("utf-8", "surrogatepass"), add_special_tokens=False).ids, np.int32)
        return np.concatenate(own), np.concatenate([[0], np.cumsum([len(x) for x in own])])


def cuts(block: tb.Block) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges [start, end) of the chunks of every non-empty text."""
    d = block.data
    n = len(d)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z
    plain = (d > 0x20) & (d < 0x80)  # neither white space nor part of a longer character
    lead2 = (d >= 0xC3) & (d <= 0xDF)  # first byte of a two-byte character that is no white space
    left = plain.copy()
    left[1:] |= (d[1:] >= 0x80) & lead2[:-1]
    right = plain | lead2
    blank = (d == 0x20) | (d == 10)
    cut = np.zeros(n + 1, bool)
    if n > 2:
        cut[1 : n - 1] = blank[1:-1] & left[:-2] & right[2:]
    edge = np.zeros(n + 1, bool)
    edge[block.bounds] = True
    inner = cut[:n].copy()
    inner[1:] &= ~edge[1:n]
    nxt = edge[1 : n + 1]
    inner &= ~nxt  # the blank is its text's last character
    inner |= edge[:n]
    start = np.flatnonzero(inner)
    end = np.append(start[1:], n)
    return start, end


_CACHE: dict[tuple[str, bool], ChunkTokenizer] = {}


def tokenizer(path: str, plain_specials: bool = False) -> ChunkTokenizer:
    if (path, plain_specials) not in _CACHE:
        _CACHE[path, plain_specials] = ChunkTokenizer(path, plain_specials)
    return _CACHE[path, plain_specials]
