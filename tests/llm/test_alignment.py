"""Alignment against plain encoding, sets of ends and counting link by link."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bandwise.llm import alignment as al
from bandwise.llm import textblocks as tb
from tests.llm.conftest import DOCS
from tests.llm.test_packing import ODD

TEXTS = ODD + ["▁ x", "a <0x41> </s> <s> <unk>", "x" * 300, "日本語のテキスト、改行\nなし", "a\x00b", "é é 🏳️‍🌈", "same text", "same text", " ", "\r\n"]


@pytest.fixture(scope="module")
def plain():
    import sentencepiece
    from tokenizers import Tokenizer

    a_path, b_path = al.default_tokenizers()
    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=b_path)
    letters = al.byte_letters()

    def encode(text):
        """[(id, end)] of both sides; nothing if the bytes differ."""
        if not text:
            return [], []
        ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        ba = [bytes(letters[c] for c in a.id_to_token(i)) for i in ia]
        bb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
        if not b"".join(ba) == b"".join(bb) == (" " + text).encode():
            return [], []
        return [list(zip(i, np.cumsum([len(x) for x in s]).tolist(), strict=True)) for i, s in ((ia, ba), (ib, bb))]

    return encode


def groups(a, b):
    """Lists of a ids and b ids between common ends."""
    common = {e for _, e in a} & {e for _, e in b}
    out, ia, ib = [], iter(a), iter(b)
    for end in sorted(common):
        take = []
        for side in (ia, ib):
            ids = []
            for i, e in side:
                ids.append(i)
                if e == end:
                    break
            take.append(ids)
        out.append(take)
    return out


def expected(rows, plain):
    cut = [(d, groups(*plain(t))) for d, t in rows]
    links = [Counter((x, y) for ga, gb in g for x in ga for y in gb) for _, g in cut]
    count = Counter(p for c in links for p in c)
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for (d, g), c in zip(cut, links, strict=True):
        spelled = ";".join("|".join(",".join(map(str, s)) for s in pair) for pair in g)
        out.append(
            (d, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(c.values()), sum(n for p, n in c.items() if count[p] == best[p[0]]),
             sum(n * count[p] for p, n in c.items()), hashlib.sha256(spelled.encode()).hexdigest() if g else "")
        )
    return sorted(out)


def got(df):
    return sorted(tuple(r[c] for c in al.SCORED_COLUMNS) for r in df.collect())


def test_scores_equal_counting_by_hand(make_docs, sample, plain):
    rows = sample + [(10_000 + i, t) for i, t in enumerate(TEXTS)] + [(7, "a repeated id"), (7, "a repeated id")]
    assert got(al.link_scores(make_docs(rows))) == expected(rows, plain)


def test_small_blocks_slices_and_feeds(make_docs, sample, plain, monkeypatch):
    """Every bound made small: the kernel cuts everywhere it may."""
    for name, value in (("SLICE", 64), ("FEED", 50), ("LINKS", 40), ("BLOCK", 3000), ("HELD", 30)):
        monkeypatch.setattr(al, name, value)
    rows = [(i, t) for i, t in enumerate([t for _, t in sample[:40]] + TEXTS)]
    table = pa.table({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]})
    done = pa.Table.from_batches(list(al.aligned_batches(iter(table.to_batches(max_chunksize=9)), *al.default_tokenizers())))
    counts = Counter()
    for batch in al.count_batches(iter(done.to_batches())):
        counts.update(dict(zip(batch.column("pair").to_pylist(), batch.column("n").to_pylist(), strict=True)))
    want = expected(rows, plain)
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    assert sorted(tuple(r[c] for c in kept) for r in done.to_pylist()) == [w[:5] + w[7:] for w in want]
    sums = {r["doc_id"]: sum(t * counts[p] for p, t in zip(r["pairs"], r["times"], strict=True)) for r in done.to_pylist()}
    assert sums == {w[0]: w[6] for w in want}


def test_long_text_is_cut_at_blanks(plain):
    text = "Some words, in plain text \n and 日本 語 mixed  in. " * 60_000  # more than one feed and one slice
    table = pa.table({"doc_id": [1], "text": [text]})
    assert len(text.encode()) > tb.BLOCK_BYTES
    row = pa.Table.from_batches(list(al.aligned_batches(iter(table.to_batches()), *al.default_tokenizers()))).to_pylist()[0]
    g = groups(*plain(text))
    assert (row["n_groups"], row["n_links"]) == (len(g), sum(len(x) * len(y) for x, y in g))


def test_overlaps_are_the_tokens_that_share_bytes(make_docs, plain):
    rows = list(enumerate(TEXTS))
    for r in al.alignments(make_docs(rows)).collect():
        a, b = plain(TEXTS[r.doc_id])
        ranges = [[(lo, hi) for lo, hi in zip([0, *[e for _, e in s][:-1]], [e for _, e in s], strict=True)] if s else [] for s in (a, b)]
        share = {(i, j) for i, (la, ha) in enumerate(ranges[0]) for j, (lb, hb) in enumerate(ranges[1]) if la < hb and lb < ha}
        assert {(x.a, x.b) for x in r.overlaps} == share
        assert r.a_ids == [i for i, _ in a] and r.b_ids == [i for i, _ in b]
        parts = [[[], []] for _ in groups(a, b)]
        for k, (ids, of) in enumerate(((r.a_ids, r.a_group), (r.b_ids, r.b_group))):
            for i, g in zip(ids, of, strict=True):
                parts[g][k].append(i)
        assert parts == groups(a, b)


def test_edges(spark, make_docs):
    assert al.link_scores(spark.createDataFrame([], DOCS)).count() == 0
    odd = make_docs(["plain words"]).withColumn("pairs", F.lit(1)).withColumn("block", F.lit("x")).withColumn("n", F.lit(2))
    empty = make_docs([(None, "no id"), (2, None), (3, "")]).withColumn("pairs", F.lit(0)).withColumn("block", F.lit("y")).withColumn("n", F.lit(0))
    rows = got(al.link_scores(odd.unionByName(empty)))
    assert [r[0] for r in rows] == [0, 2, 3] and rows[1][1:] == rows[2][1:] == (0, 0, 0, 0, 0, 0, "")
    assert rows[0][3] == 2 and rows[0][5] == rows[0][4]


def test_chunk_cache_tells_chunks_with_one_key_apart():
    from bandwise.llm.tokens import ChunkTokenizer

    class Coarse(ChunkTokenizer):
        @staticmethod
        def hashes(symbols, start, end):
            key, check = ChunkTokenizer.hashes(symbols, start, end)
            return key % np.uint64(5), check

    tok = Coarse(al.default_tokenizers()[0], plain_specials=True)
    for texts in (["one two three", "two one 三 three", ""], ["six ten two", "one", "seven one"]):
        block = next(tb.blocks(iter(pa.table({"doc_id": [1, 2, 3], "text": texts}).to_batches())))
        ids, off = tok.encode(block)
        for i, t in enumerate(texts):
            assert ids[off[i] : off[i + 1]].tolist() == tok.tok.encode(t, add_special_tokens=False).ids
