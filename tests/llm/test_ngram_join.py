"""N-gram Jaccard components against brute force."""

import random

import numpy as np
import pytest

from bandwise.llm import ngram_join as j
from tests.llm.conftest import DOCS, space_words


def shingles(text, n=5):
    w = space_words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def brute(docs):
    sets = [(i, shingles(t)) for i, t in docs]
    root = {i: i for i, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for m, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                p, q = find(i), find(m)
                root[max(p, q)] = min(p, q)
    return {i: (len(s), find(i) if s else i) for i, s in sets}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_sample(make_docs, sample):
    have = got(j.near_duplicates(make_docs(sample)))
    assert have == brute(sample)
    assert any(c != i for i, (_, c) in have.items())


@pytest.mark.parametrize("seed,bucket_bytes", [(1, 6 << 20), (2, 700)])
def test_near_copies(make_docs, monkeypatch, seed, bucket_bytes):
    monkeypatch.setattr(j, "BUCKET_BYTES", bucket_bytes)
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocab, k=25)
    texts = []
    for _ in range(12):
        base = rng.choices(vocab, k=rng.randint(3, 90))
        if rng.random() < 0.5:
            base = base + passage
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            texts.append(" ".join(copy))
    texts += [None, "", " \n", "A b", "a B", "a  b", "a b c d e", "A b c d e", "x " * 300, "x " * 900, "é é é"]
    docs = list(enumerate(texts))
    rng.shuffle(docs)
    assert got(j.near_duplicates(make_docs(docs))) == brute(sorted(docs))


def test_edges(spark, make_docs):
    assert j.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0
    rows = j.near_duplicates(make_docs([(5, "a b c"), (5, "a b c"), (9, "a b c"), (2, None), (3, "")])).collect()
    assert sorted((r.doc_id, r.component_id) for r in rows) == [(2, 2), (3, 3), (5, 5), (5, 5), (9, 5)]


def test_codec():
    v = np.unique(np.random.default_rng(1).integers(0, 1 << 32, 1000, dtype=np.uint32))
    assert (j.unpack_sorted(j.pack_sorted(v)) == v).all()


def clusters(seed):
    """Variants of a base with and without the base itself, texts around one common line, copies with equal prefixes."""
    rng = random.Random(seed)
    vocab = [f"v{i}" for i in range(3000)]
    line = rng.choices(vocab, k=8)
    texts = []
    for k, edits in enumerate((1, 2, 3, 5)):
        base = rng.choices(vocab, k=110)
        if k % 2:
            texts.append(" ".join(base))
        for _ in range(14):
            copy = list(base)
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            texts.append(" ".join(copy))
        for cut in range(1, 12):  # the same words, some cut off at either end
            texts.append(" ".join(base[cut:] if cut % 2 else base[:-cut]))
    texts += [" ".join(line + [rng.choice(vocab)]) for _ in range(25)] + [" ".join([rng.choice(vocab)] + line) for _ in range(10)] + [" ".join(line)]
    return list(enumerate(texts))


@pytest.mark.parametrize("cell", [512, 3])
def test_clusters_in_blocks(make_docs, monkeypatch, cell):
    monkeypatch.setattr(j, "CELL", cell)
    docs = clusters(7)
    want = brute(docs)
    assert got(j.near_duplicates(make_docs(docs))) == want
    assert len({c for _, c in want.values()}) > 12 and max(sum(c == x for _, c in want.values()) for _, x in want.values()) > 15


def test_hubs_leave_little_and_the_rest_is_found(make_docs, monkeypatch):
    """Without hubs, the comparison by blocks alone gives the same components."""
    docs = clusters(8)
    monkeypatch.setattr(j, "hub_links", lambda groups, lists, active: groups.select(groups["first"].alias("a"), groups["first"].alias("b")).where("false"))
    monkeypatch.setattr(j, "CELL", 5)
    assert got(j.near_duplicates(make_docs(docs))) == brute(docs)


def test_groups_meet_not_texts(make_docs):
    """Texts that differ behind their prefix only are one row in the lists."""
    common = [f"c{i}" for i in range(60)]
    texts = [" ".join(common[:40] + [f"c{i}" for i in range(40, 60)] + ["t"] * (5 + k % 3)) for k in range(30)]
    rare = " ".join(f"r{i}" for i in range(9))
    docs = [(i, rare + " " + t) for i, t in enumerate(texts)] + [(100 + i, t + " z") for i, t in enumerate(texts)]
    sets = j.rarity_sets(make_docs(docs), 5)
    active = sets.where("size(prefix) > 0")
    assert j.group_table(active).count() < active.count() or active.count() == active.select("g1").distinct().count()
    assert got(j.near_duplicates(make_docs(docs))) == brute(docs)
