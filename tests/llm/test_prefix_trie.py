"""Trie nodes against dictionaries of prefixes; the double array against plain transitions."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bandwise.llm import prefix_trie as pt
from bandwise.llm.common import table

TURNS = T.StructType(
    [T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]
)


def rebuilt(rows, family):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [v[2:] for v in sorted(turns)] for c, turns in own.items()}
    if not family:
        return own
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in own}
    return {c: own.get(c - int(np.fmod(c, family)), [])[: h[c]] + v[h[c] :] for c, v in own.items()}


def brute(rows, family=20):
    convs = rebuilt(rows, family)
    members, kids, leaves, saved = defaultdict(list), defaultdict(list), {}, {}
    for c, v in convs.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    for n in members:
        if n:
            kids[n[:-1]].append(n)
    out = []
    for n in sorted(members, key=len, reverse=True):
        m, words = members[n], len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0
        leaves[n] = sum(leaves[k] for k in kids[n]) or 1
        saved[n] = (len(m) - 1) * words + sum(saved[k] for k in kids[n])
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(n))
        parent = min(members[n[:-1]]) if n else None
        out.append((min(m), len(n), parent, len(m), len(kids[n]), leaves[n], saved[n], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def got(df):
    return sorted((tuple(r[c] for c in pt.RESULT) for r in df.collect()), key=lambda r: r[:2])


def hot():
    """A first turn that all share, a conversation of which most are copies, a wide node, a deep chain and odd rows."""
    rows = []
    for c in range(300):
        rows += [(c, 0, "system", "the same words"), (c, 1, "user", "hello there" if c % 3 else f"own {c % 90}"), (c, 2, "assistant", "yes")]
        rows += [(c, k, "user", f"more {k} {c % 7 if c % 5 == 0 else 0}") for k in range(3, 3 + c % 4)]
    rows += [(1000, k, "user", "deep " * (k % 3)) for k in range(150)] + [(1001, k, "user", "deep " * (k % 3)) for k in range(140)]
    rows += [(2000, None, None, None), (2000, None, None, "x"), (2000, 3, "user", "x"), (2000, 3, "user", "x"), (2000, -1, "a", "b"), (None, 0, "user", "x")]
    rows += [(2021, 0, "user", "only one"), (-7, 0, "user", "below"), (-7, 1, "user", "zero"), (3001, 0, "ab", "c"), (3002, 0, "a", "bc")]
    return rows


@pytest.mark.parametrize("family", [20, None])
@pytest.mark.parametrize("shard_rows", [100_000, 200, 5])
def test_nodes_equal_dictionaries(spark, family, shard_rows):
    rows = hot()
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    assert got(pt.prefix_nodes(df, family, shard_rows)) == brute(rows, family)


def test_whole_table(spark):
    df = table(spark, "/root/testdata/sf0.01", "conversations")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert got(pt.prefix_nodes(df, 20, 200)) == brute(rows)


def test_double_array_follows_plain_transitions():
    rng = np.random.default_rng(5)
    trie, plain, states = pt.DoubleArray(), {}, np.array([0])
    for _ in range(12):
        pairs = {(int(s), int(i)) for s in states for i in rng.choice(60, rng.choice([0, 1, 1, 2, 5, 25]), replace=False)}
        if not pairs:
            break
        by, ids = (np.array(x) for x in zip(*sorted(pairs), strict=True))
        trie.add(by, ids)
        to = trie.step(by, ids)
        assert len(set(to.tolist())) == len(to) and not set(to.tolist()) & ({0} | set(plain.values()))
        plain |= dict(zip(zip(by.tolist(), ids.tolist(), strict=True), to.tolist(), strict=True))
        states = rng.choice(to, min(40, len(to)), replace=False)
    for s in {0, *plain.values()}:
        for i in range(60):
            assert trie.step(np.array([s]), np.array([i]))[0] == plain.get((s, i), -1)
    assert trie.top < 3 * len(plain) + 64


def test_digest_of_a_hot_key_is_chunked(spark):
    ids = list(range(5000))
    df = spark.createDataFrame([(1, 2, i) for i in ids] + [(1, 3, 9), (-4, 2, 8)], "k1 long, k2 long, conv long").repartition(4)
    want = {(1, 2): ",".join(map(str, ids)), (1, 3): "9", (-4, 2): "8"}
    found = {(r.k1, r.k2): r.ends_sha256 for r in pt.end_digests(df).collect()}
    assert found == {k: hashlib.sha256(v.encode()).hexdigest() for k, v in want.items()}


def test_edges(spark):
    empty = spark.createDataFrame([], TURNS)
    assert pt.prefix_nodes(empty, 20).count() == 0
    odd = spark.createDataFrame([(1, 0, "user", None), (1, 1, None, "a b c " * 100_000)], TURNS)
    for c in ("family", "shared", "own", "words", "member", "k1", "depth", "upper", "top"):
        odd = odd.withColumn(c, F.lit("x"))
    rows = [(1, 0, "user", None), (1, 1, None, "a b c " * 100_000)]
    assert got(pt.prefix_nodes(odd, None)) == brute(rows, None)
