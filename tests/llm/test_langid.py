"""Language ID: automaton and cross-parsing against brute force, held-out accuracy."""

import random

import pytest

from bandwise.llm import langid
from tests.llm.conftest import DOCS


def brute_phrases(text, sample):
    n, at = 0, 0
    while at < len(text):
        m = 0
        while at + m < len(text) and text[at : at + m + 1] in sample:
            m += 1
        at += max(m, 1)
        n += 1
    return n


@pytest.mark.parametrize("piece", [512, 7])
def test_phrases_against_brute_force(monkeypatch, piece):
    monkeypatch.setattr(langid, "PIECE", piece)
    rng = random.Random(1)
    samples = {k: ["".join(rng.choices("abcd é", k=200)) for _ in range(3)] for k in ("x", "y")}
    model = langid.Model(samples)
    texts = ["", "a", "zzz", "ab ab, cd!!", "ÀÉé é"] + ["".join(rng.choices("abcdez é,\n", k=rng.randint(1, 90))) for _ in range(40)]
    got = model.phrases([model.encode(t) for t in texts])
    for t, row in zip(texts, got.tolist()):
        s = langid.symbols(t)
        want = [sum(brute_phrases(s[i : i + piece], " ".join(langid.symbols(x) for x in samples[k])) for i in range(0, len(s), piece)) for k in ("x", "y")]
        assert row == want, t


@pytest.mark.parametrize("dense", [1 << 23, 0])
def test_packed_and_dense_tables_parse_alike(monkeypatch, dense):
    monkeypatch.setattr(langid, "DENSE", dense)
    rng = random.Random(2)
    letters = "abcdefgh\U00010428\U00010429\U0001042a語 "  # some above U+FFFF
    samples = {k: ["".join(rng.choices(a, k=150)) for _ in range(3)] for k, a in (("x", letters[:6] + " "), ("y", letters), ("z", letters[6:]))}
    model = langid.Model(samples)
    assert model.dense == bool(dense)
    texts = ["".join(rng.choices(letters + "q\U0001d518.", k=rng.randint(1, 120))) for _ in range(40)]
    got = model.phrases([model.encode(t) for t in texts])
    for t, row in zip(texts, got.tolist()):
        s = langid.symbols(t)
        assert row == [brute_phrases(s, " ".join(langid.symbols(x) for x in samples[k])) for k in ("x", "y", "z")], t


def test_scripts_above_the_basic_plane_are_told_apart(make_docs):
    rng = random.Random(3)
    scripts = {"deseret": [chr(c) for c in range(0x10428, 0x10450)], "osage": [chr(c) for c in range(0x104D8, 0x104FC)]}
    rows = [(k, "".join(rng.choices([*a, " "], k=90)), k) for k, a in scripts.items() for _ in range(60)]
    docs = make_docs([(i, t) for i, (_, t, _) in enumerate(rows)]).drop("lang")
    langs = docs.sparkSession.createDataFrame([(i, k) for i, (k, _, _) in enumerate(rows)], "doc_id long, lang string")
    got = {r.doc_id: r.lang_pred for r in langid.language_id(docs.join(langs, "doc_id")).collect()}
    assert all(got[i] == k for i, (k, _, _) in enumerate(rows))


def test_large_alphabets_take_little_memory():
    rng = random.Random(4)
    script = [chr(0x4E00 + i) for i in range(3500)]
    samples = {f"l{j}": ["".join(rng.choices(script, k=800)) for _ in range(16)] for j in range(10)}
    model = langid.Model(samples)
    size = sum(getattr(model, x).nbytes for x in ("keys", "goal", "first", "classes", "codes"))
    assert not model.dense and size < 30 << 20


def test_excerpts_come_from_the_whole_text_and_copies_count_once(make_docs):
    copies = [(i, "the same words again") for i in range(400)]
    late = [(1000 + i, "1" * 3000 + " only the end has words " + chr(97 + i) * 3) for i in range(40)]
    mixed = [(2000 + i, f"start{i} " + "x" * 900 + f" middle{i} " + "y" * 900) for i in range(40)]
    texts = langid.learn(langid.labelled(make_docs(copies + mixed)))["en"]
    assert len(texts) == 16 and sum("same words" in t for t in texts) <= 1 and any(not t.startswith("start") for t in texts)
    assert all(langid.symbols(t) for t in langid.learn(langid.labelled(make_docs(late)), chars_per_row=3020)["en"])


def test_automaton_accepts_exactly_the_substrings():
    text = "abcbcabb"
    a = langid.Automaton(text)
    subs = {text[i:j] for i in range(len(text)) for j in range(i + 1, len(text) + 1)}
    found, todo = set(), [(0, "")]
    while todo:
        s, w = todo.pop()
        for c, t in a.next[s].items():
            found.add(w + c)
            todo.append((t, w + c))
    assert found == subs


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 150 and sum(r.lang_pred == r.lang for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_edges(spark, make_docs):
    known = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(*DOCS.names)
    odd = make_docs([(9000, None), (9001, ""), (9002, "12 ++ \n"), (9003, "\U0001d518 ok"), (9004, "the and of"), (9004, "the and of")], lang=None)
    got = {}
    for r in langid.language_id(known.unionByName(odd)).where("doc_id >= 9000").collect():
        got.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    assert got[9000] == got[9001] == got[9002] == [("und", 0.0)]
    assert len(got[9004]) == 2 and got[9004][0][0] == "en" and got[9003][0][0] != "und"
    assert langid.language_id(spark.createDataFrame([], DOCS)).count() == 0
    assert {r.lang_pred for r in langid.language_id(make_docs(["some text", None], lang=None)).collect()} == {"und"}
