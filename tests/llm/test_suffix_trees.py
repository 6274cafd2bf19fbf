"""Word-window dedup against brute force."""

import random

import numpy as np
import pytest

from bandwise.llm import repeats, suffix_trees
from bandwise.llm import textblocks as tb
from tests.llm.conftest import DOCS, space_words


def brute(docs, length):
    seen, out = set(), {}
    for doc_id, text in sorted(docs, key=lambda d: d[0]):
        w = space_words(text)
        gone = set()
        for s in range(len(w) - length + 1):
            k = tuple(w[s : s + length])
            if k in seen:
                gone.update(range(s, s + length))
            seen.add(k)
        out[doc_id] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


def got(df):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in df.collect()}


def corpus(seed, n=60):
    """Copies, shared passages, periodic texts and near copies over a small vocabulary."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)] + ["é", "日本", "a"]
    passages = [rng.choices(vocab, k=rng.randint(5, 60)) for _ in range(4)]
    texts = []
    for i in range(n):
        w = rng.choices(vocab, k=rng.randint(0, 80))
        for _ in range(rng.randint(0, 2)):
            at = rng.randint(0, len(w))
            w[at:at] = rng.choice(passages)
        if i % 7 == 0 and texts:
            w = texts[rng.randrange(len(texts))].split()
            if w and i % 2:
                w[rng.randrange(len(w))] = "changed"
        texts.append(rng.choice([" ", "  ", "\n"]).join(w))
    texts += [None, "", " ", "a " * 100, "a " * 150, "a b " * 60, "x", passages[0][0], " ".join(passages[1] * 5)]
    docs = list(enumerate(texts))
    rng.shuffle(docs)
    return docs


def test_sample(make_docs, sample):
    have = got(suffix_trees.dedup(make_docs(sample)))
    assert have == brute(sample, 20)
    assert any(v[1] for v in have.values())


@pytest.mark.parametrize("seed,length,gram,hot,rows,suffixes,block", [(1, 20, 5, 8, 2048, 100_000, 4 << 20), (2, 6, 2, 2, 3, 20, 600), (3, 8, 3, 3, 5, 40, 300)])
def test_corpus(make_docs, monkeypatch, seed, length, gram, hot, rows, suffixes, block):
    """Also with tiny blocks and bounds, run in this process so that they take effect."""
    monkeypatch.setitem(repeats.BLOCK_HOT, "word", hot)
    monkeypatch.setattr(repeats, "GRAM_ROWS", rows)
    monkeypatch.setattr(suffix_trees, "SUBTREE_SUFFIXES", suffixes)
    docs = corpus(seed)
    if block == 4 << 20:
        assert got(suffix_trees.dedup(make_docs(docs), length, gram)) == brute(docs, length)
    else:
        assert local(docs, length, gram, block) == brute(docs, length)


def local(docs, length, gram, block):
    """The same steps without Spark: shuffles become sorts."""
    import pyarrow as pa

    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.array([t for _, t in rows], pa.string())], names=["doc_id", "text"])

    def sort(batches, *keys, step=7):
        t = pa.Table.from_batches(batches).sort_by([(k, "ascending") for k in keys])
        return iter(t.to_batches(max_chunksize=step))

    def with_runs(found, fields):
        runs = {}
        for r in found:
            runs.setdefault(r["doc_id"], []).append({f: r[f] for f in fields})
        kinds = {"gram": pa.int64(), "hot": pa.bool_()}
        return table(docs).append_column("runs", pa.array([runs.get(i) for i, _ in docs], pa.list_(pa.struct([(f, kinds.get(f, pa.int32())) for f in fields]))))

    old = tb.blocks.__defaults__
    tb.blocks.__defaults__ = (*old[:2], block)
    try:
        anchors = list(repeats.anchor_batches(iter([table(docs)]), "word", length, gram, True))
    finally:
        tb.blocks.__defaults__ = old
    found = [r for b in repeats.verdict_batches(sort(anchors, "route", "gram", "context", "doc_id", "lo"), True) for r in b.to_pylist()]
    opened = with_runs([r for r in found if r["open"]], ["lo", "hi", "gram", "hot"])
    contexts = list(suffix_trees.context_batches(iter([opened]), length))
    later = [r for b in suffix_trees.subtree_batches(sort(contexts, "key", "doc_id", "lo"), length) for r in b.to_pylist()] if contexts else []
    final = with_runs([r for r in found if not r["open"]] + later, ["lo", "hi"])
    rows = [r for b in suffix_trees.kept_batches(iter([final]), length) for r in b.to_pylist()]
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in rows}


def test_edges(spark, make_docs):
    assert suffix_trees.dedup(spark.createDataFrame([], DOCS)).count() == 0
    text = " ".join(f"u{i}" for i in range(30))
    rows = suffix_trees.dedup(make_docs([(4, text), (4, text), (7, text)])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in rows) == [(4, 0), (4, 0), (7, 30)]


def test_suffix_order():
    rng = np.random.default_rng(1)
    s = rng.integers(0, 3, 200).astype(np.uint64)
    start = np.arange(190)
    order, lcp = suffix_trees.sorted_suffixes(s, start, 10)
    rows = [tuple(s[i : i + 10]) for i in order]
    assert rows == sorted(rows)
    assert all(rows[i][: lcp[i]] == rows[i - 1][: lcp[i]] and (lcp[i] == 10 or rows[i][lcp[i]] != rows[i - 1][lcp[i]]) for i in range(1, 190))
