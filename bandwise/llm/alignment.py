"""Alignment of two tokenizers over the same text, and how often their tokens meet.

A byte-level BPE (side a) reads a space and the text; a sentencepiece BPE with byte fallback
(side b), which adds that space itself, reads the text. Both then cut the same bytes, so a
token is a byte range. Per batch two ``pandas.merge_asof``, keyed by document, find for each token
start the other side's token that covers it. The union of both directions are the
overlaps; a token whose covering token starts at the same byte (both sides' tokens before it
end there) begins a group. All a-b pairs of a group are links.

Counting: every batch reduces its links to distinct (document, id pair) with their number. A
block of about ``BLOCK`` bytes of text asks once for each of its id pairs. So what is
shuffled are distinct pairs per block, and a pair that occurs in every text is one row a block.

Defined results: a null or empty text, and one whose joined tokens differ from space + text on
either side, has no tokens (zeros, an empty digest); each row is a document of its own, so repeated
rows and doc_ids count apiece; rows without a doc_id are left out; an empty table gives no rows; other columns
are ignored. Long texts: side b is fed pieces cut at blanks between plain characters (no
piece crosses such a blank), the frames are slices of at most about ``SLICE`` tokens that end at a common end.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bandwise.llm import textblocks as tb
from bandwise.llm.common import id_text, keep, shipped, shipped_cogroup
from bandwise.llm.tokens import ChunkTokenizer, tokenizer

TEXT = 1 << 19  # bytes of text aligned together; a longer text is aligned alone
SLICE = 1 << 20  # tokens of one side aligned at once
FEED = 1 << 20  # characters given to side b at once, up to the next safe blank
BLOCK = 8 << 20  # bytes of text that ask for pair counts together
LINKS = 1 << 21  # links expanded at once
HELD = 2 << 20  # distinct pairs a counting task holds before it hands them on
WIDTH = 1 << 15  # ids of side b; a pair is a * WIDTH + b
_SAFE = re.compile(r"(?<=[!-~]) (?=[!-~])")


@dataclass
class Vocabulary:
    """Bytes of every token: ``flat[start[i] : start[i] + size[i]]``."""

    start: np.ndarray
    size: np.ndarray
    flat: np.ndarray

    @classmethod
    def of(cls, tokens: list[bytes]) -> Vocabulary:
        size = np.array([len(t) for t in tokens], np.int64)
        return cls(np.cumsum(size) - size, size, np.frombuffer(b"".join(tokens), np.uint8))

    def joined(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        stop = np.cumsum(size)
        return self.flat[np.repeat(self.start[ids] - (stop - size), size) + np.arange(int(stop[-1]) if len(stop) else 0)]


def byte_letters() -> dict[str, int]:
    """Letter -> byte of byte-level vocabularies: printable bytes stand for themselves, the others follow from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class SideA:
    def __init__(self, path: str):
        self.chunks: ChunkTokenizer = tokenizer(path, plain_specials=True)
        tok, letters = self.chunks.tok, byte_letters()
        names = [tok.id_to_token(i) or "" for i in range(tok.get_vocab_size(with_added_tokens=True))]
        self.words = Vocabulary.of([bytes(letters[c] for c in n) if all(c in letters for c in n) else n.encode() for n in names])

    def encode(self, spaced: tb.Block) -> tuple[np.ndarray, np.ndarray]:
        return self.chunks.encode(spaced)


class SideB:
    def __init__(self, path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(self.sp.get_piece_size())
        names = [self.sp.id_to_piece(i) for i in ids]
        self.words = Vocabulary.of(
            [bytes([int(n[3:5], 16)]) if self.sp.is_byte(i) else n.replace("▁", " ").encode() for i, n in zip(ids, names, strict=True)]
        )
        # texts may be cut before a blank only if no piece goes on across one
        self.cuttable = not any("▁" in n.lstrip("▁") for n in names)

    def feeds(self, text: str) -> Iterator[str]:
        at = 0
        while self.cuttable and len(text) - at > FEED and (found := _SAFE.search(text, at + FEED)):
            yield text[at : found.start()]
            at = found.end()  # side b puts the blank back
        yield text[at:]

    def encode(self, block: tb.Block) -> tuple[np.ndarray, np.ndarray]:
        parts, sizes = [], []
        for i in range(len(block.ids)):
            text = block.text(i).decode("utf-8", "replace")
            own = [np.array(self.sp.encode(f), np.int32) for f in self.feeds(text)] if text else []
            parts += own
            sizes.append(sum(map(len, own)))
        return np.concatenate([np.zeros(0, np.int32), *parts]), np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


_SIDES: dict[tuple[str, str], tuple[SideA, SideB]] = {}


def sides(a_path: str, b_path: str) -> tuple[SideA, SideB]:
    if (a_path, b_path) not in _SIDES:
        _SIDES[a_path, b_path] = SideA(a_path), SideB(b_path)
    return _SIDES[a_path, b_path]


def spaced(block: tb.Block) -> tb.Block:
    """A space before every text that is not empty."""
    size = np.diff(block.bounds)
    bounds = np.concatenate([[0], np.cumsum(size + (size > 0))])
    data = np.full(bounds[-1], 0x20, np.uint8)
    inside = np.ones(bounds[-1], bool)
    inside[bounds[:-1][size > 0]] = False
    data[inside] = block.data
    return tb.Block(block.ids, data, bounds)


@dataclass
class Side:
    ids: np.ndarray
    doc: np.ndarray  # index of the document in the block
    start: np.ndarray  # byte offset in the block
    end: np.ndarray

    def cut(self, lo: int, hi: int) -> Side:
        return Side(self.ids[lo:hi], self.doc[lo:hi], self.start[lo:hi], self.end[lo:hi])


def token_sides(block: tb.Block, a: SideA, b: SideB) -> tuple[Side, Side]:
    """Both sides' tokens of the texts whose tokens join to space + text on both sides."""
    want = spaced(block)
    held = [(side.words, *side.encode(x)) for side, x in ((a, want), (b, block))]
    good = np.ones(len(block.ids), bool)
    for words, ids, off in held:
        stop = np.concatenate([[0], np.cumsum(words.size[ids])])[off]
        raw = words.joined(ids)
        for i in range(len(good)):
            good[i] &= np.array_equal(raw[stop[i] : stop[i + 1]], want.data[want.bounds[i] : want.bounds[i + 1]])
    out = []
    for words, ids, off in held:
        doc = np.repeat(np.arange(len(good)), np.diff(off))
        use = good[doc]
        ids, doc = ids[use], doc[use]
        end = np.cumsum(words.size[ids])
        out.append(Side(ids.astype(np.int64), doc, end - words.size[ids], end))
    return out[0], out[1]


def slices(a: Side, b: Side) -> Iterator[tuple[Side, Side]]:
    """Slices of about SLICE tokens of side a that end where tokens of both sides end."""
    at_a = at_b = 0
    while at_a < len(a.ids):
        to_a, step = at_a + SLICE, 256
        to_b = len(b.ids)
        while to_a < len(a.ids):
            ends = a.end[to_a : to_a + step]
            place = np.minimum(np.searchsorted(b.end, ends), len(b.end) - 1)
            common = np.flatnonzero(b.end[place] == ends)
            if len(common):
                to_a, to_b = to_a + int(common[0]) + 1, int(place[common[0]]) + 1
                break
            to_a, step = to_a + step, step * 2
        yield a.cut(at_a, to_a), b.cut(at_b, to_b)
        at_a, at_b = to_a, to_b


@dataclass
class Groups:
    """One slice, aligned. ``over_a[i]`` is the b token that covers the start of a token i, ``over_b`` the reverse."""

    a: Side
    b: Side
    over_a: np.ndarray
    over_b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    first_a: np.ndarray  # first a token of each group, and the end
    first_b: np.ndarray


def align(a: Side, b: Side) -> Groups:
    fa = pd.DataFrame({"doc": a.doc, "start": a.start, "a_start": a.start, "a": np.arange(len(a.ids))})
    fb = pd.DataFrame({"doc": b.doc, "start": b.start, "b_start": b.start, "b": np.arange(len(b.ids))})
    over_a = pd.merge_asof(fa, fb, on="start", by="doc")
    over_b = pd.merge_asof(fb, fa, on="start", by="doc")
    new_a = (over_a["b_start"] == over_a["a_start"]).to_numpy()
    new_b = (over_b["a_start"] == over_b["b_start"]).to_numpy()
    return Groups(
        a, b, over_a["b"].to_numpy(np.int64), over_b["a"].to_numpy(np.int64), np.cumsum(new_a) - 1, np.cumsum(new_b) - 1,
        np.append(np.flatnonzero(new_a), len(a.ids)), np.append(np.flatnonzero(new_b), len(b.ids)),
    )


def _runs(key: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys with the sums of their weights."""
    order = np.argsort(key, kind="stable")
    key, weight = key[order], weight[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(weight, first) if len(first) else weight


def links(g: Groups) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, id pair) keys of a slice and how many links each has.

    A group's ids are made distinct first, so that its links are never spelled out one by one.
    """
    ka, many_a = _runs((g.group_a << 16) | g.a.ids, np.ones(len(g.a.ids), np.int64))
    kb, many_b = _runs((g.group_b << 16) | g.b.ids, np.ones(len(g.b.ids), np.int64))
    group = ka >> 16
    lo, hi = np.searchsorted(kb >> 16, group), np.searchsorted(kb >> 16, group, side="right")
    doc = g.a.doc[g.first_a[group]]
    stop = np.cumsum(hi - lo)
    keys, times = [], []
    at = 0
    while at < len(ka):
        to = max(at + 1, int(np.searchsorted(stop, (stop[at - 1] if at else 0) + LINKS, side="right")))
        n = (hi - lo)[at:to]
        j = np.repeat(lo[at:to] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        i = np.repeat(np.arange(at, to), n)
        k, t = _runs((doc[i] << 31) | ((ka[i] & 0xFFFF) * WIDTH) | (kb[j] & 0xFFFF), many_a[i] * many_b[j])
        keys.append(k)
        times.append(t)
        at = to
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return (keys[0], times[0]) if len(keys) == 1 else _runs(np.concatenate(keys), np.concatenate(times))


_SPELLED = np.array([f"{i}{sep}".encode() for sep in ",|;" for i in range(1 << 16)], object)


def spelled(g: Groups) -> tuple[np.ndarray, np.ndarray]:
    """Every group as ``a1,a2|b1;`` in pieces of bytes, and the document of each piece."""
    na, nb = len(g.a.ids), len(g.b.ids)
    code, doc = np.empty(na + nb, np.int64), np.empty(na + nb, np.int64)
    place_a, place_b = np.arange(na) + g.first_b[g.group_a], np.arange(nb) + g.first_a[g.group_b + 1]
    last_a, last_b = np.zeros(na, np.int64), np.zeros(nb, np.int64)
    last_a[g.first_a[1:] - 1], last_b[g.first_b[1:] - 1] = 1, 2
    code[place_a], code[place_b] = g.a.ids + (last_a << 16), g.b.ids + (last_b << 16)
    doc[place_a], doc[place_b] = g.a.doc, g.b.doc
    return _SPELLED[code], doc


def aligned_batches(batches, a_path: str, b_path: str):
    """Per document: counts, digest, distinct id pairs with their links, and its block."""
    from pyspark import TaskContext

    a_side, b_side = sides(a_path, b_path)
    task = TaskContext.get()
    block_id, seen = (task.partitionId() if task else 0) << 32, 0
    for block in tb.blocks(batches, limit=TEXT):
        if seen + len(block.data) > BLOCK and seen:
            block_id, seen = block_id + 1, 0
        seen += len(block.data)
        n = len(block.ids)
        sums = {c: np.zeros(n, np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")}
        digests = [hashlib.sha256() for _ in range(n)]
        filled = np.zeros(n, bool)
        keys, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a, b in slices(*token_sides(block, a_side, b_side)):
            g = align(a, b)
            size_a, size_b = np.diff(g.first_a), np.diff(g.first_b)
            of = a.doc[g.first_a[:-1]]
            sums["n_a"] += np.bincount(a.doc, minlength=n)
            sums["n_b"] += np.bincount(b.doc, minlength=n)
            sums["n_groups"] += np.bincount(of, minlength=n)
            np.add.at(sums["n_links"], of, size_a * size_b)
            pieces, doc = spelled(g)
            edges = np.searchsorted(doc, np.arange(n + 1))
            for i in np.unique(of):
                text = b"".join(pieces[edges[i] : edges[i + 1]])
                digests[i].update(b";" + text[:-1] if filled[i] else text[:-1])
                filled[i] = True
            k, t = links(g)
            keys.append(k)
            times.append(t)
        key, many = _runs(np.concatenate(keys), np.concatenate(times)) if len(keys) > 2 else (keys[-1], times[-1])
        off = pa.array(np.searchsorted(key >> 31, np.arange(n + 1)).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(block.ids),
                *(pa.array(v) for v in sums.values()),
                pa.array([d.hexdigest() if f else "" for d, f in zip(digests, filled, strict=True)]),
                pa.ListArray.from_arrays(off, pa.array((key & ((1 << 31) - 1)).astype(np.int32))),
                pa.ListArray.from_arrays(off, pa.array(many)),
                pa.array(np.full(n, block_id)),
            ],
            names=["doc_id", *sums, "groups_sha256", "pairs", "times", "block"],
        )


ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<int>, times array<long>, block long"
)


def spelled_batches(batches, a_path: str, b_path: str):
    """Per document the tokens, their groups and the overlaps as lists (the general interface)."""
    a_side, b_side = sides(a_path, b_path)
    for block in tb.blocks(batches, limit=TEXT):
        rows = [{"doc_id": int(d), "a_ids": [], "b_ids": [], "a_group": [], "b_group": [], "overlaps": []} for d in block.ids]
        for a, b in slices(*token_sides(block, a_side, b_side)):
            g = align(a, b)
            pairs = np.unique(np.concatenate([np.stack([np.arange(len(a.ids)), g.over_a], 1), np.stack([g.over_b, np.arange(len(b.ids))], 1)]), axis=0)
            for i in np.unique(a.doc):
                row = rows[i]
                (la, ha), (lb, hb) = (np.searchsorted(s.doc, [i, i + 1]) for s in (a, b))
                base = row["a_group"][-1] + 1 if row["a_group"] else 0
                seen_a, seen_b = len(row["a_ids"]), len(row["b_ids"])
                own = pairs[(pairs[:, 0] >= la) & (pairs[:, 0] < ha)]
                row["overlaps"] += [{"a": int(x - la) + seen_a, "b": int(y - lb) + seen_b} for x, y in own]
                row["a_ids"] += a.ids[la:ha].tolist()
                row["b_ids"] += b.ids[lb:hb].tolist()
                row["a_group"] += (g.group_a[la:ha] - g.group_a[la] + base).tolist()
                row["b_group"] += (g.group_b[lb:hb] - g.group_b[lb] + base).tolist()
        i32 = pa.list_(pa.int32())
        kinds = [pa.int64(), i32, i32, i32, i32, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in zip(rows[0], kinds, strict=True)], names=list(rows[0]))


SPELLED = "doc_id long, a_ids array<int>, b_ids array<int>, a_group array<int>, b_group array<int>, overlaps array<struct<a:int,b:int>>"


def count_batches(batches):
    """(pair, n): in how many of the task's documents each id pair is linked."""
    held, many = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def out():
        return pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(many)], names=["pair", "n"])

    for batch in batches:
        k, n = np.unique(batch.column("pairs").flatten().to_numpy(), return_counts=True)
        held, many = _runs(np.concatenate([held, k.astype(np.int64)]), np.concatenate([many, n]))
        if len(held) > HELD:
            yield out()
            held, many = held[:0], many[:0]
    if len(held):
        yield out()


def ask_batches(batches):
    """(block, pair): the distinct id pairs of every block."""
    for batch in batches:
        pairs = batch.column("pairs")
        size = np.diff(pairs.offsets.to_numpy())
        block = np.repeat(batch.column("block").to_numpy(), size)
        for b in np.unique(block):
            k = np.unique(pairs.flatten().to_numpy()[block == b])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), b)), pa.array(k)], names=["block", "pair"])


def score_block(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """Counts of a block's pairs, summed over each document's links."""
    pair = answers.column("pair").to_numpy()
    order = np.argsort(pair)
    pair, n, best = pair[order], answers.column("n").to_numpy()[order], answers.column("best").to_numpy()[order]
    out: list[list] = [[], []]
    for piece in docs.select(["pairs", "times"]).to_batches():
        codes, times = piece.column("pairs"), piece.column("times").flatten().to_numpy()
        at = np.searchsorted(pair, codes.flatten().to_numpy())
        off = codes.offsets.to_numpy() - codes.offsets[0].as_py()
        for to, value in zip(out, (times * best[at], times * n[at]), strict=True):
            to.append(np.diff(np.concatenate([[0], np.cumsum(value)])[off]))
    sums = [np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int64) for x in out]
    for name, values in zip(("n_best", "count_sum"), sums, strict=True):
        docs = docs.append_column(name, pa.array(values))
    return docs.select(SCORED_COLUMNS)


SCORED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
SCORED_COLUMNS = [c.split()[0] for c in SCORED.split(", ")]


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _paths(a_path: str | None, b_path: str | None) -> dict[str, str]:
    a, b = (a_path, b_path) if a_path and b_path else default_tokenizers()
    return {"a_path": a_path or a, "b_path": b_path or b}


def alignments(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Per document both sides' token ids, the group of every token and the overlapping tokens (places in the id lists)."""
    return id_text(docs).mapInArrow(shipped(__name__, "spelled_batches", **_paths(a_path, b_path)), SPELLED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): documents that hold each id pair linked; best if no pair of the same a id has more.

    The window over an a id holds at most one row per b id of the vocabulary.
    """
    counts = aligned.select("pairs").mapInArrow(shipped(__name__, "count_batches"), "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    most = F.max("n").over(Window.partitionBy(F.expr(f"pair div {WIDTH}")))
    return counts.withColumn("best", F.col("n") == most)


def link_scores(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Token, group and link numbers of every document, with the corpus counts of its links (``SCORED``)."""
    aligned = keep(id_text(docs).mapInArrow(shipped(__name__, "aligned_batches", **_paths(a_path, b_path)), ALIGNED), "aligned")
    asked = aligned.select("block", "pairs").mapInArrow(shipped(__name__, "ask_batches"), "block long, pair int")
    answers = asked.join(pair_counts(aligned), "pair").select("block", "pair", "n", "best")
    return aligned.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(shipped_cogroup(__name__, "score_block"), SCORED)
