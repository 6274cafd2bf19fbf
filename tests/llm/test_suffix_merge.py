"""Byte-window dedup and the loser tree against brute force."""

import random
from collections import Counter

import pyarrow as pa
import pytest

from bandwise.llm import queries, repeats, suffix_merge
from bandwise.llm import textblocks as tb
from tests.llm.conftest import DOCS
from tests.llm.test_suffix_trees import corpus


def brute(docs, length):
    data = {i: (t or "").encode() for i, t in docs}
    seen = Counter(b[s : s + length] for b in data.values() for s in range(len(b) - length + 1))
    out = {}
    for i, b in data.items():
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        spans = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(b)))
        out[i] = (len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g))
    return out


def got(rows):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept"]) for r in rows}


def test_sample(make_docs, sample):
    have = got([r.asDict() for r in suffix_merge.dedup(make_docs(sample)).collect()])
    assert have == brute(sample, 400)
    assert any(v[1] for v in have.values())


@pytest.mark.parametrize("seed,length,gram", [(1, 60, 20), (4, 24, 8)])
def test_corpus(make_docs, seed, length, gram):
    docs = corpus(seed)
    assert got([r.asDict() for r in suffix_merge.dedup(make_docs(docs), length, gram).collect()]) == brute(docs, length)


@pytest.mark.parametrize("seed,hot,rows,few,block", [(1, 64, 2048, 6, 4 << 20), (2, 2, 3, 1, 500), (3, 3, 5, 0, 2000), (5, 99, 9999, 2, 300), (6, 2, 9999, 2, 900)])
def test_bounds(monkeypatch, seed, hot, rows, few, block, length=30, gram=9):
    monkeypatch.setitem(repeats.BLOCK_HOT, "byte", hot)
    monkeypatch.setattr(repeats, "GRAM_ROWS", rows)
    monkeypatch.setattr(suffix_merge, "FEW", few)
    monkeypatch.setattr(suffix_merge, "RUN_BYTES", 700)
    docs = corpus(seed)

    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.array([t for _, t in rows], pa.string())], names=["doc_id", "text"])

    def sort(batches, *keys, step=7):
        t = pa.Table.from_batches(batches).sort_by([(k, "ascending") for k in keys])
        return t.to_batches(max_chunksize=step)

    def with_runs(found, fields):
        runs = {}
        for r in found:
            runs.setdefault(r["doc_id"], []).append({f: r[f] for f in fields})
        kinds = {"gram": pa.int64(), "hot": pa.bool_()}
        return table(docs).append_column("runs", pa.array([runs.get(i) for i, _ in docs], pa.list_(pa.struct([(f, kinds.get(f, pa.int32())) for f in fields]))))

    old = tb.blocks.__defaults__
    tb.blocks.__defaults__ = (*old[:2], block)
    try:
        anchors = list(repeats.anchor_batches(iter([table(docs)]), "byte", length, gram, False))
    finally:
        tb.blocks.__defaults__ = old
    found = [r for b in repeats.verdict_batches(iter(sort(anchors, "route", "gram", "context", "doc_id", "lo")), False) for r in b.to_pylist()]
    opened = with_runs([r for r in found if r["open"]], ["at", "lo", "hi", "gram", "hot"])
    sent = list(suffix_merge.send_batches(iter([opened]), length, 3))
    received = suffix_merge.receive_batches(iter(sort(sent, "part", "kind")), length, gram) if sent else []
    more = [r for b in received for r in b.to_pylist()]
    final = with_runs([r for r in found if not r["open"]] + more, ["lo", "hi"])
    assert got([r for b in suffix_merge.kept_batches(iter([final]), length) for r in b.to_pylist()]) == brute(docs, length)


def test_loser_tree():
    rng = random.Random(8)
    for n_runs in (1, 2, 3, 7, 8):
        runs, all_items = [], []
        for _ in range(n_runs):
            items = sorted((bytes(rng.choices(b"ab", k=rng.randint(0, 90))), b"", rng.randint(0, 99), 0, 0, 0) for _ in range(rng.randint(0, 20)))
            all_items += items
            runs.append(suffix_merge.encode_run(items))
        out = list(suffix_merge.LoserTree([suffix_merge.decode_run(r) for r in runs]))
        assert [x[0] for x in out] == sorted(x[0] for x in all_items)
        for a, b in zip(out, out[1:]):
            assert b[1] == suffix_merge.common(a[0], b[0], 0)


def test_edges(spark, make_docs):
    assert suffix_merge.dedup(spark.createDataFrame([], DOCS)).count() == 0
    text = "".join(random.Random(1).choices("abcdefgh ", k=500))
    rows = suffix_merge.dedup(make_docs([(4, text), (4, text), (7, None), (8, "é" * 199)])).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed) for r in rows) == [(4, 500, 0), (4, 500, 0), (7, 0, 0), (8, 398, 0)]
    rows = suffix_merge.dedup(make_docs([(4, text), (7, text)])).collect()
    assert {r.n_removed for r in rows} == {500}


def test_planted_passages(spark, make_docs, tmp_path):
    """Passages of 51 and more words: what decides is 400 bytes, not the number of words; all holders lose them, the first one too."""
    rng = random.Random(51)

    def words(n):
        return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 9))) for _ in range(n))

    docs, planted = [], {}
    for n_words, size in [(51, 300), (51, 399), (51, 400), (51, 401), (60, 399), (60, 400), (80, 399), (80, 560)]:
        passage = " ".join("".join(rng.choices("abcdefghijklmnop", k=size // n_words - 1)) for _ in range(n_words)).ljust(size, "q")
        assert len(passage) == size and len(passage.split()) == n_words
        for left, right in ("\n\t", "\t\n", "\r "):  # no two holders share a byte more
            planted[len(docs)] = size
            docs.append(words(90) + left + passage + right + words(90))
        docs.append(words(200))
    make_docs(docs).write.parquet(str(tmp_path / "documents.parquet"))
    rows = queries.op8_suffix_array_dedup(spark, str(tmp_path)).collect()
    size = {i: planted.get(i, 0) for i in range(len(docs))}
    assert {r.doc_id: (r.n_removed, r.n_spans) for r in rows} == {i: (s, 1) if s >= 400 else (0, 0) for i, s in size.items()}
    assert {r.doc_id: r.n_bytes for r in rows} == {i: len(t) for i, t in enumerate(docs)}
