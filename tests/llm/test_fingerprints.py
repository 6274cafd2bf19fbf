"""Fingerprints against plain sets."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from bandwise.llm import fingerprints as f
from tests.llm.conftest import DOCS
from tests.llm.test_ngram_join import shingles


def test_edited_texts_and_order(spark, make_docs, sample):
    texts = dict(sample) | {5000: None, 5001: "", 5002: "a", 5003: "é\U0001f600é\U0001f600", 5009: "x y z"}
    for ranges in (1, 7):
        rows = {r.doc_id: r for r in f.with_edits(make_docs(list(texts.items())), ranges=ranges).collect()}
        ids = sorted(texts)
        assert sorted(rows) == ids
        for i, nxt in zip(ids, ids[1:] + ids[:1]):
            t, u = texts[i] or "", texts[nxt] or ""
            k = len(t) // 4
            assert rows[i].n_chars == len(t) and rows[i].edited == t[: len(t) - k] + u[:k]
            own, new, other = f.sketches([t, rows[i].edited, u], 5, 0.25)
            assert rows[i].fingerprint == f.written(own) and rows[i].edited_fingerprint == f.written(new)
            assert rows[i].near_edited == f.likeness(own, new) and rows[i].near_next == f.likeness(own, other)


def test_estimates(sample):
    texts = [t for _, t in sample]
    sk = f.sketches(texts, 5, 0.25)
    errors = []
    for a, b, x, y in zip(texts, texts[1:], sk, sk[1:]):
        mixed = a[: len(a) // 2] + b
        (z,) = f.sketches([mixed], 5, 0.25)
        s, m = shingles(a), shingles(mixed)
        if len(s | m) > 100:
            errors.append(abs(f.likeness(x, z) - len(s & m) / len(s | m)))
    assert np.mean(errors) < 0.05
    full = f.sketches(texts, 5, 1.0)
    assert [len(x) for x in full] == [len(shingles(t)) for t in texts]
    assert all(set(x) <= set(y) for x, y in zip(sk, full))


def test_columns(spark):
    a, b = f.sketches(["one two three four five six seven", "two three four five six seven eight nine"], 5, 1.0)
    row = spark.createDataFrame([(f.written(a), f.written(b), "")], "a string, b string, e string")
    r = row.select(f.containment(F.col("a"), F.col("b")).alias("c"), f.containment(F.col("e"), F.col("b")).alias("d"), f.merged(F.col("a"), F.col("b")).alias("m")).first()
    assert r.c == pytest.approx(2 / 3) and r.d == 1.0 and r.m == f.written(np.union1d(a, b))


def test_edges(spark, make_docs):
    assert f.with_edits(spark.createDataFrame([], DOCS)).count() == 0
    (r,) = f.with_edits(make_docs([(3, "a b c d")])).collect()
    assert r.edited == "a b c " + "a"
    rows = f.with_edits(make_docs([(3, "same text"), (3, "same text"), (4, None)])).collect()
    assert len(rows) == 3 and len({r.fingerprint for r in rows if r.doc_id == 3}) == 1
    got = {r.doc_id: r.fingerprint for r in f.fingerprints(make_docs([(1, "Same TEXT"), (2, "same text"), (3, "")])).collect()}
    assert got[1] == got[2] and got[3] == ""
