"""Base counts and scores against plain Python; labels decide the target; held-out labels."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bandwise.llm import quality as q
from bandwise.llm.common import table
from tests.llm.conftest import DOCS, space_words

LABELS = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "quality", "toxic")])
TEXTS = [
    None, "", " \n\t", "one", "a b c d e f g h", "a b c d e f g h a b c d e f g h", "x " * 40, "# a\n# a\n \n \n# a \nb|c <d> $%&*",
    "p q r s t u v w x p q r s t u v w y p q r s t u v w z", "日本 語 " * 12, "1 2 3 4 5 6 7 8 9 " * 3 + "tail", "\x0b\x0c a\x00b \U0001f600#",
    "l m n\r\nl m n\r\n", "abcdefgh " * 9, "a b c d e f g h i a b c d e f g h i j k l",
]


def brute(text):
    t = text or ""
    w = space_words(t)
    win = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    many = Counter(win)
    hit = {i + k for i, x in enumerate(win) if many[x] > 1 for k in range(8)}
    lines = [x for x in t.split("\n") if space_words(x)]
    counts = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit))
    return (*counts, len(w) < 20 or 100 * len(hit) > 30 * len(w))


def test_base_counts(spark, make_docs, sample):
    rows = sample + [(10_000 + i, t) for i, t in enumerate(TEXTS)] + [(20_000, "ab cd ef " * 3 + "gh " * 2 + "x y z " * 9000), (5, "again")]
    docs, labels = make_docs(rows), spark.createDataFrame([], LABELS)
    got = sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in q.judge(docs, labels).collect())
    assert got == sorted((d, *brute(t), not brute(t)[-1]) for d, t in rows)  # without labels only the base rules decide


def cells(spark, text, buckets):
    row = q.with_grams(spark.createDataFrame([(0, text)], "doc_id long, text string"))
    return [r.c for r in row.select(F.explode(F.concat("ones", "twos")).alias("g")).select(q.cell(F.col("g"), buckets).alias("c")).collect()]


def test_scores_are_mean_log_ratios(spark, make_docs):
    texts = {1: "good words are good", 2: "good plain words", 3: "| | junk |", 4: "", 5: "good junk", 6: "words are plain", 7: None}
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, None), (2, 1, 0), (5, 1, 1), (6, 1, 0), (6, 0, 0), (3, 0, 0), (99, 1, 0), (None, 1, 0)], LABELS)
    buckets = 32
    own = {d: cells(spark, t or "", buckets) for d, t in texts.items()}
    raw, target = Counter(), Counter()
    for d, c in own.items():
        raw.update(c)
        if d in (1, 2):  # 5 is toxic, the labels of 6 differ
            target.update(c)
    n, m = sum(raw.values()), sum(target.values())
    ratio = {c: math.log((target[c] + buckets * raw[c] / n) / (m + buckets) / (raw[c] / n)) for c in raw}
    docs = make_docs(list(texts.items()))
    for r in q.judge(docs, labels, buckets=buckets).collect():
        want = sum(ratio[c] for c in own[r.doc_id]) / len(own[r.doc_id]) if own[r.doc_id] else 0.0
        assert len(own[r.doc_id]) == max(0, 2 * r.n_words - 1) and r.score == pytest.approx(want, abs=1e-12)
    got = {r.cell: (r.raw, r.target) for r in q.cell_counts(docs, labels, buckets).collect()}
    assert got == {c: (raw[c], target[c]) for c in range(buckets)}
    assert {r.doc_id for r in q.trusted_ids(labels, 10).collect()} == {1, 2, 99} and q.trusted_ids(labels, 2).count() == 2


def test_labelled_documents_left_out_of_the_target(spark):
    """Documents labelled bad go, those labelled good stay; every second label is hidden from the operator."""
    docs, labels = (table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    hidden = F.col("doc_id") % 2 == 0
    judged = q.judge(docs, labels.where(~hidden)).join(labels.where(hidden), "doc_id").where("NOT base_failed")
    shares = {r.quality: r.kept for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert shares[1] > 0.995 and shares[0] < 0.1


def test_edges(spark, make_docs):
    labels = spark.createDataFrame([(1, 1, 0)], LABELS)
    assert q.judge(spark.createDataFrame([], DOCS), labels).count() == 0
    odd = make_docs([(None, "x"), (1, "some words " * 15), (1, "some words " * 15), (2, None)])
    for c in ("words", "score", "trusted", "cell", "raw", "target", "quality", "toxic", "kept", "cells"):
        odd = odd.withColumn(c, F.lit("x"))
    rows = sorted((r.doc_id, r.n_words, r.n_repeat_words, r.kept) for r in q.judge(odd, labels.withColumn("text", F.lit("y"))).collect())
    assert rows == [(1, 30, 30, False), (1, 30, 30, False), (2, 0, 0, False)]


def test_no_python_on_the_main_path(spark, make_docs):
    plan = q.judge(make_docs(["a b"]), spark.createDataFrame([(0, 1, 0)], LABELS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
