"""The pipeline's stages against brute force on a small table."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import test_decontaminate, test_ngram_join, test_secrets
from tests.llm.conftest import DOCS


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, sample):
    d = tmp_path_factory.mktemp("corpus")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items.write.parquet(str(d / "benchmark.parquet"))
    item = items.first().text
    real = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    extra = [
        (9001, None), (9002, "12 34 !"), (9003, ""), (9004, f"the {item} and"), (9005, "token=0123456789abcdef01 is the end of it"),
        (9006, sample[0][1]), (9006, sample[0][1]), (None, "of the and in"),
    ]
    rows = spark.createDataFrame([(i, t, None, "s", None if t is None else len(t)) for i, t in extra], DOCS)
    real.select(*DOCS.names).unionByName(rows).withColumn("rep", F.lit(1)).withColumn("key", F.lit("x")).write.parquet(str(d / "documents.parquet"))
    return str(d), [(r.item_id, r.text) for r in items.collect()]


def test_stages(spark, folder):
    d, items = folder
    docs = spark.read.parquet(d + "/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:4]:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        docs = stage(spark, docs, d)
        assert docs.columns == columns, name
        docs.write.parquet(f"{d}/{name}")
        docs = spark.read.parquet(f"{d}/{name}")
        after = [(r.doc_id, r.text) for r in docs.collect()]
        known = [(i, t) for i, t in before if i is not None]
        if name == "language_id":
            want = [(i, t) for i, t in before if re.search(r"[^\W\d_]", t or "")]
        elif name == "ngram_jaccard_join":
            comp = test_ngram_join.brute(sorted(set(known)))
            want = list({(i, t) for i, t in before if i is None or comp[i][1] == i})
            assert len(want) < len(before)
        elif name == "benchmark_decontamination":
            hit = test_decontaminate.brute(known, items)
            want = [(i, t) for i, t in before if i is None or not hit[i][1]]
            assert len(want) < len(before)
        else:
            assert sorted(str(i) for i, _ in after) == sorted(str(i) for i, _ in before)
            assert not [1 for _, t in after if test_secrets.brute(t)]
            old = dict(known)
            assert all(t == old[i] for i, t in after if i is not None and "<secret>" not in (t or ""))
            assert all(r.n_chars == len(r.text) for r in docs.collect() if "<secret>" in r.text)
            continue
        assert sorted(after, key=str) == sorted(want, key=str), name


def test_run(spark, folder):
    rows = corpus_pipeline.run(spark, folder[0]).collect()
    used = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == used.get(r.sequence_id, 0)
        used[r.sequence_id] = r.offset + r.length
    assert max(used.values()) <= 1024
    assert 9005 in {r.doc_id for r in rows} and not {9001, 9002, 9003, 9004, 9006} & {r.doc_id for r in rows}


CLASHES = ["__spans", "__clean", "spans", "rows", "row", "sid", "id", "many", "hit", "clean", "component_id", "has_letter", "a.b"]


def odd(spark, rows):
    """Documents (doc_id, text, lang) with further columns of every name that the stages use."""
    df = spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t)) for i, t, lang in rows], DOCS).repartition(3)
    return df.withColumns({c: F.concat(F.lit(c), F.lit("!")) for c in CLASHES})


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_empty_tables(spark, folder, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, odd(spark, []), folder[0])
    assert out.count() == 0 and (name == "best_fit_packing" or out.columns == odd(spark, []).columns)


def test_rows_that_share_a_doc_id_are_judged_apart(spark, folder):
    d, items = folder
    item = items[0][1]
    long = " ".join(f"word{i}" for i in range(40))
    rows = [(1, "a clean text", "en"), (1, None, "en"), (1, "12 34", "en"), (2, f"x {item} y", "en"), (2, "another clean text", "en"),
            (3, long, "en"), (4, long + " end", "en"), (4, "something else here", "en"), (4, "something else here", "en"), (5, "", "en"), (None, long, "en")]
    docs = odd(spark, rows)
    out = corpus_pipeline.language_id(spark, docs, d)
    texts = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)
    assert texts(out) == sorted([(i, t) for i, t, _ in rows if re.search("[a-z]", t or "")], key=str)
    out = corpus_pipeline.near_duplicates(spark, out, d)
    assert texts(out) == sorted([(1, "a clean text"), (2, f"x {item} y"), (2, "another clean text"), (3, long), (4, "something else here"), (None, long)], key=str)
    out = corpus_pipeline.decontamination(spark, out, d)
    assert texts(out) == sorted([(1, "a clean text"), (2, "another clean text"), (3, long), (4, "something else here"), (None, long)], key=str)
    assert all(r[c] == c + "!" for r in out.collect() for c in CLASHES)


def test_an_unlabelled_corpus_keeps_its_clean_rows(spark, folder):
    docs = odd(spark, [(i, t, None) for i, t in enumerate(["some text", "der Text", None, "7 8", "le texte"])])
    assert sorted(r.doc_id for r in corpus_pipeline.language_id(spark, docs, folder[0]).collect()) == [0, 1, 4]


def test_clashing_names_in_the_secret_stage(spark, folder):
    docs = odd(spark, [(1, "token=0123456789abcdef01 is it", "en"), (2, "nothing here", "en"), (3, None, "en")])
    out = corpus_pipeline.secret_scan(spark, docs, folder[0])
    assert out.columns == docs.columns
    got = {r.doc_id: r for r in out.collect()}
    assert "<secret>" in got[1].text and got[1].n_chars == len(got[1].text) and got[2].text == "nothing here" and got[3].text is None
    assert all(r[c] == c + "!" for r in got.values() for c in CLASHES)
