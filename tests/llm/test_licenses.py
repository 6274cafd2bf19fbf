"""Licence scans against plain TF-IDF."""

import math
import random
import re
import textwrap
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from bandwise.llm import licenses, queries
from tests.llm.test_decontaminate import words

SCHEMA = "doc_id long, path string, text string, license string, unit int"  # also clashing names
APACHE, MIT = licenses.TEMPLATES["Apache-2.0"][1], licenses.TEMPLATES["MIT"][1]


def brute(files, threshold=0.8):
    units = [Counter(words(line)) for _, _, t in files for line in (t or "").split("\n") if words(line)]
    names = [(k, Counter(words(t))) for k in sorted(licenses.TEMPLATES) for t in licenses.TEMPLATES[k]]
    vocab = {x for _, c in names for x in c}
    n = len(units)
    df = Counter(x for u in units for x in u)
    idf = lambda x: math.log((1 + n) / (1 + df[x])) + 1 if x in vocab else math.log(1 + n) + 1
    norm = lambda c: math.sqrt(sum((v * idf(x)) ** 2 for x, v in c.items()))

    def best(c):
        if not c:
            return 0, None
        scores = [(sum(c[x] * t[x] * idf(x) ** 2 for x in t) / norm(c) / norm(t), k) for k, t in names]
        top = max(s for s, _ in scores)
        return top, next(k for s, k in scores if s == top)

    own = {}
    for i, path, t in files:
        cands = [best(Counter(words(line))) for line in (t or "").split("\n") if words(line)]
        whole = best(Counter(words(t)))
        top = max([*cands, whole], key=lambda x: x[0], default=(0, None))
        own[i] = (path, top[1] if top[0] >= threshold else None, whole[0] >= threshold)
    votes = {}
    for path, k, whole in own.values():
        if k and path and "/" in path:
            votes.setdefault(path.rsplit("/", 1)[0], []).append((k, whole))
    declared = {d: min({k for k, _ in v}, key=lambda k: (-sum(w for x, w in v if x == k), -sum(x == k for x, _ in v), k)) for d, v in votes.items()}
    out = {}
    for i, (path, k, _) in own.items():
        above, d = None, path
        while k is None and d and "/" in d:
            d = d.rsplit("/", 1)[0]
            if d in declared:
                above = d
                break
        out[i] = (k, k or (declared[above] if above else None), above)
    return out


FILES = [
    (1, "a/LICENSE", MIT), (2, "a/b/x.py", "code here\n# Licensed under the Apache License, Version 2.0.\nmore code"), (3, "a/b/y.py", "just words of the code"),
    (4, "a/c/d/z.py", None), (5, "e/f.py", "nothing at all"), (6, "a/b/c/w.py", ""), (7, None, "Released under the MIT License."), (8, "top.txt", "no directory"),
    (9, "g/h/1", "This work is licensed under the GNU General Public License, version 3."), (10, "g/h/2", "Released under the MIT License."), (11, "g/h/i/3", "text"),
    (12, "g/h/i", "the the the"), (13, "ab/x", "prefix of no directory"), (14, "a/n/q.py", "long prose " * 2000 + "\nLicensed under CC BY-NC 4.0.\n" + "of the work " * 50),
    (15, "s/LICENSE", APACHE), (16, "s/1", "Released under the MIT License.\ncode one two three four"), (17, "s/2", "x = 1 for all of them\nReleased under the MIT License."), (18, "s/t/u/3", "é ü"),
]


def got(spark, files):
    rows = spark.createDataFrame([(i, p, t, "x", 1) for i, p, t in files], SCHEMA).repartition(3)
    return {r.doc_id: (r.license, r.effective, r.inherited_from) for r in licenses.license_scan(rows).collect()}


def test_against_brute_force(spark):
    have = got(spark, FILES)
    assert have == brute(FILES)
    assert have[3][1] == "Apache-2.0" and have[4][1:] == ("MIT", "a") and have[18][1:] == ("Apache-2.0", "s") and have[13] == (None, None, None)


def test_sample(spark, sample):
    files = [(i, f"s{i % 3}/{i // 20}/{i // 5}/{i}", t) for i, t in sample]
    have = got(spark, files)
    assert have == brute(files)
    marked = {i for i, t in sample if re.search("(?m)^(Licensed under|Released under the MIT|This work is licensed)", t)}
    assert marked and marked <= {i for i, v in have.items() if v[0]}


def test_edges(spark):
    assert got(spark, []) == {}
    rows = spark.createDataFrame([(1, "a/b", "Released under the MIT License."), (1, "a/b", "Released under the MIT License."), (None, "a/c", "x")], "doc_id long, path string, text string")
    assert licenses.license_scan(rows).count() == 2
    paths = spark.createDataFrame([("a/b/c",), ("a",), (None,)], "p string").select(licenses.parent(F.col("p")).alias("d"))
    assert [r.d for r in paths.collect()] == ["a/b", None, None]


@pytest.mark.parametrize("k", sorted(licenses.TEMPLATES))
def test_templates_match_themselves(spark, k):
    files = [(i, f"d{i}/f", t) for i, t in enumerate(licenses.TEMPLATES[k])]
    assert {v[0] for v in got(spark, files).values()} == {k}


def wrapped(text, mark="# ", width=72):
    return "\n".join(mark + x for x in textwrap.wrap(text, width))


FULL = sorted(p.stem for p in (Path(licenses.__file__).parent / "license_texts").glob("*.txt"))


def prose(n):
    rng = random.Random(n)
    words_ = ["".join(rng.choices("aeiounrst", k=6)) for _ in range(300)]
    return [(10000 + i, f"z/{i}/f", "\n".join(" ".join(rng.choices(words_, k=9)) for _ in range(10))) for i in range(n)]


def test_full_texts(spark):
    texts = {k: licenses.TEMPLATES[k][-1].replace("<year>", "2021").replace("<owner>", "Some Person").replace("<copyright holders>", "Some Person") for k in FULL}
    assert len(texts) == 12
    files = [(i, f"d{i}/LICENSE", "Copyright (c) 2021 Some Person\n\n" + texts[k]) for i, k in enumerate(FULL)] + prose(200)
    have = got(spark, files)
    assert {k: have[i][0] for i, k in enumerate(FULL)} == {k: k for k in FULL}


@pytest.mark.parametrize("where", ["before", "inside", "after"])
def test_full_texts_in_long_files(spark, where):
    """A full text before, amid or behind thousands of lines of code gets its own licence, not a relative's."""
    rng = random.Random(11)
    names = ["".join(rng.choices("abcdefgh_", k=7)) for _ in range(400)]
    code = [f"    {rng.choice(names)} = {rng.choice(names)}({rng.choice(names)}, {rng.randrange(99)})  # the {rng.choice(names)} of it" for _ in range(4000)]
    cut = {"before": 0, "inside": 2000, "after": 4000}[where]
    files = []
    for i, k in enumerate(FULL):
        text = licenses.TEMPLATES[k][-1].split("\n")
        files.append((i, f"d{i}/x.py", "\n".join([*code[:cut], *(("# " + x) if i % 2 else x for x in text), *code[cut:]])))
    have = got(spark, files + prose(100) + [(9000, "q/x.py", "\n".join(code))])
    assert {k: have[i][0] for i, k in enumerate(FULL)} == {k: k for k in FULL}
    assert have[9000][0] is None


def test_wrapped_headers(spark):
    code = "\n".join(f"value_{i} = compute_{i}(argument_{i})" for i in range(60))
    wanted, files = {}, []
    for k in licenses.TEMPLATES:
        for t in licenses.TEMPLATES[k]:
            if 12 <= len(t.split()) <= 230 and "conditions are met" not in t[-30:]:
                i = len(files)
                wanted[i] = k
                files.append((i, f"d{i}/x.py", "#!/bin/python\n# Copyright 2021 Some Person\n#\n" + wrapped(t) + "\n\n" + code))
    have = got(spark, files + prose(200))
    assert {i: have[i][0] for i in wanted} == wanted


def test_versions_and_relatives(spark):
    lines = {
        "GPL-2.0": "GNU General Public License, version 2", "CC-BY-4.0": "Licensed under CC BY 4.0.", "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
        "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    }
    files = [(i, f"d{i}/x", f"text of it\n{t}\nmore of it") for i, t in enumerate(lines.values())]
    have = got(spark, files + prose(50))
    assert [have[i][0] for i in range(len(lines))] == list(lines)


def test_query_inherits_over_levels(spark, make_docs, tmp_path):
    def scanned(texts, name):
        make_docs(texts).write.parquet(str(tmp_path / name / "documents.parquet"))
        return queries.op1_license_scans(spark, str(tmp_path / name)).collect()

    plain = "just words of the text"
    path = {r.doc_id: r.path.split("/") for r in scanned([plain] * 4000, "plain")}
    # licensed: the files of the source's directory, those of one directory below it, and some of the lowest
    licensed = {i for i, p in path.items() if len(p) == 2 or (len(p) == 3 and p[1] == "1") or i % 70 == 0 and len(p) == 4}
    rows = scanned(["Released under the MIT License." if i in licensed else plain for i in range(4000)], "licensed")
    assert {r.doc_id for r in rows if r.license == "MIT"} == licensed
    declared = {r.path.rsplit("/", 1)[0] for r in rows if r.license}
    for r in rows:
        parts = r.path.split("/")
        above = next((d for d in ("/".join(parts[:n]) for n in range(len(parts) - 1, 0, -1)) if d in declared), None)
        assert (r.effective, r.inherited_from) == (("MIT", None) if r.license else (above and "MIT", above))
    assert {r.path.count("/") for r in rows} == {1, 2, 3}
    assert {r.path.count("/") - 1 - r.inherited_from.count("/") for r in rows if r.inherited_from} == {0, 1, 2}
