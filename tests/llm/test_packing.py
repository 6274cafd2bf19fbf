"""Token ids of chunks against the plain tokenizer; packing invariants."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from bandwise.llm import packing as p
from bandwise.llm import textblocks as tb
from bandwise.llm.tokens import ChunkTokenizer
from tests.llm.conftest import DOCS

ODD = [
    "", "a", "  a  b \n\n c", " x", "x ", "it's  don't  a  b", "日本 語 x", "a <|endoftext|> b", "é è \n à\n\nß", "a\tb\t c \r\n d",
    "x \U0001f600 y\u0085 z", None, "1 2  3", "\n", " \n a", "a  b", "a  b", "don 't", "a\nb c\n d", "\x1c a \x1f b",
]


@pytest.fixture(scope="module")
def tok():
    return ChunkTokenizer(p.default_tokenizer())


def test_chunk_ids_equal_text_ids(tok, sample):
    texts = ODD + [t for _, t in sample] + ["ab cd " * 4000]
    t = pa.table({"doc_id": pa.array(range(len(texts))), "text": pa.array(texts)})
    seen = 0
    for block in tb.blocks(iter(t.to_batches(max_chunksize=7)), limit=5000):
        ids, off = tok.encode(block)
        for i in range(len(block.ids)):
            assert ids[off[i] : off[i + 1]].tolist() == tok.tok.encode(block.text(i).decode(), add_special_tokens=False).ids
            seen += 1
    assert seen == len(texts)


def test_best_fit_and_bound():
    rng = np.random.default_rng(3)
    for _ in range(30):
        n = np.sort(rng.integers(1, 101, rng.integers(1, 80)))[::-1]
        bins, offsets, left = p.best_fit(n.tolist(), 100)
        used = np.zeros(len(left), int)
        for size, b, o in zip(n, bins, offsets):
            assert o == used[b]
            used[b] += size
        assert (used <= 100).all() and (100 - used).tolist() == left
        assert -(-n.sum() // 100) <= p.lower_bound(n, 100) <= len(left)
    assert p.lower_bound(np.array([51, 51, 51]), 100) == 3
    assert p.lower_bound(np.array([34] * 5), 100) == 3


def check(rows, texts, tok, capacity):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for d, own in by_doc.items():
        ids = tok.tok.encode(texts[d] or "", add_special_tokens=False).ids + [2]
        own.sort(key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        at = 0
        for r in own:
            assert r.start == at and (r.length == capacity or r.piece == 0)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids) and (len(own) == 1) == (at <= capacity)
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_seq)


@pytest.mark.parametrize("capacity,part_rows", [(64, 40_000), (64, 20), (1024, 30)])
def test_packing(spark, make_docs, sample, tok, capacity, part_rows):
    texts = dict(sample) | {10_000 + i: t for i, t in enumerate(ODD)}
    rows = p.pack(make_docs(list(texts.items())), capacity=capacity, part_rows=part_rows).collect()
    n = check(rows, texts, tok, capacity)
    alone = len(p.best_fit(sorted((r.length for r in rows), reverse=True), capacity)[2])  # all in one partition
    assert n <= 1.05 * alone + 3


def test_edges(spark, make_docs):
    assert p.pack(spark.createDataFrame([], DOCS)).count() == 0
    rows = p.pack(make_docs([(1, None), (1, None), (2, "")])).collect()
    assert sorted(r.doc_id for r in rows) == [1, 1, 2] and {r.length for r in rows} == {1} and len({r.sequence_id for r in rows}) == 1
    assert sorted(r.offset for r in rows) == [0, 1, 2]
