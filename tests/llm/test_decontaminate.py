"""Benchmark decontamination against brute force."""

import re

import pytest
from pyspark.sql import functions as F

from bandwise.llm import decontaminate as d
from tests.llm.conftest import DOCS


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, window=10):
    out = {}
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item_id, item in items:
            iw = words(item)
            m = min(len(iw), window)
            for a in range(len(iw) - m + 1 if m else 0):
                for s in range(len(w) - m + 1):
                    if w[s : s + m] == iw[a : a + m]:
                        hit.update(range(s, s + m))
                        found.add(str(item_id))
        out[doc_id] = (len(w), len(hit), sorted(found))
    return out


TEN = "one two three four five six seven eight nine ten"
ITEMS = [(1, TEN + " eleven twelve"), (2, "Short item"), (3, TEN), (4, None), (5, "..."), (6, "solo"), (7, "a b a b a b a b a b a b a b")]
DOCS_ = [
    None, "", "x", TEN, "pre " + TEN.upper() + " post", "one two three four five six seven eight nine", "short, ITEM short item",
    "solo", "two three four five six seven eight nine ten eleven", " ".join(["a", "b"] * 20), TEN + " " + TEN, "b a b a b a b a b a", "ſolo É x",
    "z " * 3000 + TEN, "ten " + TEN + " eleven",
]


@pytest.mark.parametrize("block_windows", [1_000_000, 8])
def test_against_brute_force(spark, make_docs, block_windows):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("doc_id", F.lit(7))
    got = d.contamination(make_docs(DOCS_), items, block_windows=block_windows).collect()
    want = brute(list(enumerate(DOCS_)), ITEMS)
    assert {r.doc_id: (r.n_words, sum(s.end - s.start for s in r.spans), r["items"]) for r in got} == want


def test_sample_table(spark, sample, make_docs):
    import pyarrow.dataset as ds

    items = ds.dataset("/root/testdata/sf0.001/benchmark.parquet").to_table().to_pandas()
    items = list(items[["item_id", "text"]].itertuples(index=False, name=None))
    got = d.contamination(make_docs(sample), spark.createDataFrame(items, "item_id long, text string")).collect()
    have = {r.doc_id: (r.n_words, sum(s.end - s.start for s in r.spans), r["items"]) for r in got}
    assert have == brute(sample, items)
    assert any(v[1] for v in have.values())


def test_empty_tables_and_repeats(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.spans for r in d.contamination(make_docs([TEN]), none).collect()] == [[]]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert d.contamination(spark.createDataFrame([], DOCS), items).count() == 0
    assert d.contamination(make_docs([(3, TEN), (3, TEN)]), items).count() == 2
