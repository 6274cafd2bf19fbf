"""The shared kernel against plain Python (no Spark)."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from bandwise.llm import repeats
from bandwise.llm import textblocks as tb

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab AZ\t\n\x0b\x1cé日0-", max_size=60)), max_size=8)


def batch(texts):
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])


@given(TEXTS, st.integers(1, 200), st.integers(1, 5))
@settings(max_examples=120, deadline=None)
def test_blocks_and_words(texts, limit, step):
    raw = batch(texts)
    pieces = [raw.slice(i, step) for i in range(0, len(texts), step)]
    found = {"space": [], "alnum": []}
    ids = []
    for block in tb.blocks(iter(pieces), limit=limit):
        ids += block.ids.tolist()
        for kind, (member, lower) in {"space": (tb.SPACE_CLASS, False), "alnum": (tb.ALNUM_CLASS, True)}.items():
            w = tb.words(block, member, lower)
            data = (tb.LOWER[block.data] if lower else block.data).tobytes()
            for i in range(len(block.ids)):
                own = range(w.first[i], w.first[i + 1])
                found[kind].append([(data[w.start[j] : w.end[j]].decode(), w.hash[j]) for j in own])
    assert ids == list(range(len(texts)))
    hashes = {}
    for i, t in enumerate(texts):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        assert [x for x, _ in found["space"][i]] == re.findall(r"[^\x20\x09-\x0D]+", t or "")
        assert [x for x, _ in found["alnum"][i]] == re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        for x, h in found["space"][i] + found["alnum"][i]:
            assert hashes.setdefault(x, h) == h  # equal words, equal hashes
    assert len(set(hashes.values())) == len(hashes)


@given(st.lists(st.integers(0, 50), max_size=60), st.integers(1, 20))
@settings(max_examples=80, deadline=None)
def test_sliding_min(values, width):
    a = np.array(values, np.uint64)
    assert tb.sliding_min(a, width).tolist() == [min(values[i : i + width]) for i in range(max(0, len(values) - width + 1))]


@given(st.lists(st.lists(st.integers(0, 3), max_size=40), max_size=6), st.integers(2, 8), st.integers(1, 8))
@settings(max_examples=150, deadline=None)
def test_anchors_cover_every_window_once_and_equally(docs, length, gram):
    gram = min(gram, length)
    symbols = tb.mix(np.array([x for d in docs for x in d], np.uint64) + np.uint64(1))
    first = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
    a = tb.anchors(symbols, first, length, gram)
    own, by_window = {}, {}
    for doc, at, lo, hi, g in zip(a.doc, a.at, a.lo, a.hi, a.gram):
        for s in range(lo, hi + 1):
            assert s not in own and first[doc] <= s and s + length <= first[doc + 1] and s <= at <= s + length - gram
            own[s] = g
            key = tuple(symbols[s : s + length])
            assert by_window.setdefault(key, (g, at - s)) == (g, at - s)  # equal windows: same gram at the same place
    assert sorted(own) == [s for i, d in enumerate(docs) for s in range(first[i], first[i] + max(0, len(d) - length + 1))]


def test_slices_cover_the_batch():
    texts = ["x" * n for n in (0, 5, 900, 3, 3, 3, 2000, 1)] + [None, ""]
    rows = []
    for piece, block in tb.sliced(iter([batch(texts)]), limit=10):
        assert piece.column("doc_id").to_pylist() == block.ids.tolist()
        rows += [block.text(i).decode() for i in range(len(block.ids))]
    assert rows == [t or "" for t in texts]


def test_covered():
    got = repeats.covered(np.array([1, 2, 7]), np.array([2, 2, 7]), 3, 10)
    assert got.tolist() == [False, True, True, True, True, False, False, True, True, True]
