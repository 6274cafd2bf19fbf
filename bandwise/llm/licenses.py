"""Licence scans: sparse TF-IDF cosine to templates, then inheritance along directories.

Every run of up to ``WINDOW`` consecutive lines with words is a header candidate (notices are
wrapped), and the whole text a licence-file candidate. A full text inside other text may be of any length:
for each template longer than ``LONG`` words the run of lines with the largest sum of (weight of the words that
the template has - ``FOREIGN`` * weight of all others) is a candidate too. Templates are one-line notices, header
notices and full licence texts (``license_texts/``). Words are lower-cased. A template word weighs
log((1 + units) / (1 + units with it)) + 1, counted over the lines of all documents;
other words count as seen in none, so long prose lines have a large norm and a
small cosine. Pass one counts, pass two scores; both add up per block.

A file's own licence is that of its best unit at or above ``threshold``: the one with the largest
(cosine - threshold) * words, the lesser count of the template's and the unit's template words, so that
a full text outweighs a sentence that two licences share. A directory declares the licence of its licence files (whole text at or above the threshold), or
else the one that most of its files' headers name. Files without a licence of their own
take that of the nearest ancestor directory that declares one, found by joining
each directory's ancestor paths with the declaring directories.

Defined results: null text is empty and has no licence of its own; ties take the
licence that sorts first; a null path inherits nothing; rows without doc_id are
left out; repeated rows are scored each for itself; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bandwise.llm import textblocks as tb
from bandwise.llm.common import keep, shipped

def _notice(name: str, version: str, later: str) -> str:
    """The header notice of a GNU licence."""
    return (
        f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by "
        f"the Free Software Foundation, {'either ' if later else ''}version {version} of the License{later}. "
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        f"MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details. "
        f"You should have received a copy of the GNU {name} along with this program. If not, see <https://www.gnu.org/licenses/>."
    )


def _gnu(name: str, version: str, spdx: str) -> list[str]:
    """Notices of a GNU licence: one line, the opening paragraph, the whole header, and identifiers."""
    out = [f"This work is licensed under the GNU {name}, version {version}.", f"GNU {name}, version {version}", f"Licensed under the GNU {name} v{version}."]
    for later in ("", ", or (at your option) any later version"):
        whole = _notice(name, version, later)
        out += [whole.split(". This program is")[0], whole]
    return out + [f"SPDX-License-Identifier: {spdx}-only", f"SPDX-License-Identifier: {spdx}-or-later"]


def _creative(name: str, short: str) -> list[str]:
    return [
        f"Licensed under {short} 4.0.",
        f"This work is licensed under a Creative Commons {name} 4.0 International License.",
        f"This work is licensed under the Creative Commons {name} 4.0 International License. To view a copy of this license, visit "
        f"http://creativecommons.org/licenses/{short[3:].lower()}/4.0/ or send a letter to Creative Commons, PO Box 1866, Mountain View, CA 94042, USA.",
        f"SPDX-License-Identifier: {short.replace(' ', '-')}-4.0",
    ]


# One-line notices, header notices and full texts of public licences.
TEMPLATES: dict[str, list[str]] = {
    "AGPL-3.0": _gnu("Affero General Public License", "3", "AGPL-3.0"),
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "BSD-2-Clause": ["SPDX-License-Identifier: BSD-2-Clause"],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "CC-BY-4.0": _creative("Attribution", "CC BY"),
    "CC-BY-NC-4.0": _creative("Attribution-NonCommercial", "CC BY-NC"),
    "CC-BY-SA-4.0": _creative("Attribution-ShareAlike", "CC BY-SA"),
    "GPL-2.0": _gnu("General Public License", "2", "GPL-2.0"),
    "GPL-3.0": _gnu("General Public License", "3", "GPL-3.0"),
    "ISC": ["SPDX-License-Identifier: ISC", "Released under the ISC License."],
    "LGPL-2.1": _gnu("Lesser General Public License", "2.1", "LGPL-2.1"),
    "LGPL-3.0": _gnu("Lesser General Public License", "3", "LGPL-3.0"),
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
        "You can obtain one at https://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
}
for _file in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
    TEMPLATES[_file.stem].append(_file.read_text(encoding="utf-8"))
WINDOW = 32  # lines of a header at most
LONG = 300  # words of a template that is looked for in runs of any length
FOREIGN = 2.0  # what a word that the template lacks costs in a run
RUN_SHARE = 0.3  # share of the template's weight that a run must hold to be scored
SLICE = 1 << 14  # lines whose windows are held at once
SCORED = "doc_id long, path string, license string, score double, unit int, whole boolean"


def _text_words(text: str) -> tb.Words:
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    return tb.words(tb.Block(np.zeros(1, np.int64), data, np.array([0, len(data)])), tb.ALNUM_CLASS, lower=True)


class Vocabulary:
    """The template words, and every template's term counts."""

    def __init__(self, templates: dict[str, list[str]]):
        self.names = [k for k in sorted(templates) for _ in templates[k]]
        counted = [np.unique(_text_words(t).hash, return_counts=True) for k in sorted(templates) for t in templates[k]]
        self.terms = np.unique(np.concatenate([h for h, _ in counted])) if counted else np.zeros(0, np.uint64)
        self.counts = np.zeros((len(counted), len(self.terms)))
        for i, (h, n) in enumerate(counted):
            self.counts[i, np.searchsorted(self.terms, h)] = n
        self.size = self.counts.sum(axis=1)

    def index(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash among the terms, -1 if it is none."""
        at = np.searchsorted(self.terms, hashes)
        at[at == len(self.terms)] = 0
        return np.where(self.terms[at] == hashes, at, -1) if len(self.terms) else np.full(len(hashes), -1)


def _lines(block: tb.Block, w: tb.Words) -> np.ndarray:
    """A number for each word that tells its line (and so its document), ascending."""
    breaks = np.zeros(len(block.data) + 1, np.int64)
    breaks[:-1] = block.data == 10
    breaks[block.bounds] += 1  # a text's beginning
    return np.cumsum(breaks)[w.start]


def _term_counts(unit: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit, word, count) of all distinct words of each unit."""
    order = np.lexsort((hashes, unit))
    u, h = unit[order], hashes[order]
    new = np.ones(len(u), bool)
    new[1:] = (u[1:] != u[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(new)
    return u[at], h[at], np.diff(np.append(at, len(u)))


def _sum_counts(unit: np.ndarray, hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit, word, count) with the counts of equal words of a unit added up."""
    order = np.lexsort((hashes, unit))
    u, h, n = unit[order], hashes[order], counts[order]
    at = np.flatnonzero(np.append(True, (u[1:] != u[:-1]) | (h[1:] != h[:-1]))) if len(u) else np.zeros(0, int)
    return u[at], h[at], np.add.reduceat(n, at) if len(at) else n


def count_batches(batches, templates: dict[str, list[str]]):
    """Per block: in how many lines each template word is, and how many lines there are (term -1)."""
    vocabulary = Vocabulary(templates)
    for block in tb.blocks(batches):
        w = tb.words(block, tb.ALNUM_CLASS, lower=True)
        if not len(w.hash):
            continue
        line = _lines(block, w)
        term = vocabulary.index(w.hash)
        use = term >= 0
        u, t = line[use], term[use].astype(np.int64)
        pairs = np.unique(u * len(vocabulary.terms) + t)
        n = np.bincount(pairs % len(vocabulary.terms), minlength=len(vocabulary.terms)) if len(pairs) else np.zeros(len(vocabulary.terms), int)
        found = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(found, -1), pa.int64()), pa.array(np.append(n[found], len(np.unique(line))), pa.int64())], names=["term", "n"]
        )


class Scorer:
    """Cosines of units of one block to the templates."""

    def __init__(self, vocabulary: Vocabulary, idf: list[float], unseen: float, threshold: float):
        self.vocabulary, self.threshold, self.unseen = vocabulary, threshold, unseen
        self.weight = np.append(np.array(idf), unseen)  # the last one stands for all other words
        target = vocabulary.counts * self.weight[:-1]
        self.target = target / np.maximum(np.sqrt((target**2).sum(axis=1, keepdims=True)), 1e-300)

    def dots(self, u: np.ndarray, h: np.ndarray, n: np.ndarray, units: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per unit: product with every template, squared norm, count of template words, and the part of the squared norm on them."""
        term = self.vocabulary.index(h)
        value = n * self.weight[term]
        seen = term >= 0
        at, t, v = u[seen], term[seen], value[seen]
        dot = np.array([np.bincount(at, weights=v * row[t], minlength=units) for row in self.target]).reshape(len(self.target), units)
        count = np.bincount(at, weights=n[seen], minlength=units)
        return dot, np.bincount(u, weights=value**2, minlength=units), count, np.bincount(at, weights=v**2, minlength=units)

    def best(self, dot: np.ndarray, norm2: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per unit: the evidence (-1 below the threshold), template and cosine of the template that explains most."""
        cosine = np.minimum(dot / np.maximum(np.sqrt(norm2), 1e-300), 1.0)
        evidence = np.where(cosine >= self.threshold, (cosine - self.threshold) * np.minimum(self.vocabulary.size[:, None], count), -1.0)
        if not len(evidence):
            return np.full(len(norm2), -1.0), np.zeros(len(norm2), int), np.zeros(len(norm2))
        top, all_units = evidence.argmax(axis=0), np.arange(len(norm2))
        return evidence[top, all_units], top, cosine[top, all_units]


def _ranges(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the range, place) of all places of the ranges."""
    size = end - start
    owner = np.repeat(np.arange(len(size)), size)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + start[owner]


def score_batches(batches, templates: dict[str, list[str]], idf: list[float], unseen: float, threshold: float):
    """Each document's best unit, if it reaches the threshold."""
    vocabulary = Vocabulary(templates)
    scorer = Scorer(vocabulary, idf, unseen, threshold)
    for batch, block in tb.sliced(batches):
        w = tb.words(block, tb.ALNUM_CLASS, lower=True)
        n_docs = len(block.ids)
        best, score = np.full(n_docs, -1.0), np.zeros(n_docs)
        name, place, whole = np.full(n_docs, -1), np.zeros(n_docs, np.int64), np.zeros(n_docs, bool)

        def offer(owner, number, evidence, top, cosine):
            """Take the first of the best units offered if it beats what the document has."""
            order = np.lexsort((number, -evidence, owner))
            order = order[np.append(True, owner[order][1:] != owner[order][:-1])] if len(order) else order
            order = order[evidence[order] > best[owner[order]] + 1e-9]  # the same words in another order add up with other roundings
            d = owner[order]
            best[d], score[d], name[d], place[d] = evidence[order], cosine[order], top[order], number[order]

        if len(w.hash):
            doc = np.repeat(np.arange(n_docs), np.diff(w.first))
            line = np.cumsum(np.append(0, np.diff(_lines(block, w)) > 0))  # only lines with words
            head = np.flatnonzero(np.append(True, np.diff(line) > 0))
            line_doc, tail = doc[head], np.append(head[1:], len(line))
            first_line = np.searchsorted(line_doc, np.arange(n_docs))
            for a in range(0, len(head), SLICE):
                _score_lines(scorer, w.hash, head, tail, line_doc, first_line, a, min(a + SLICE, len(head)), best, offer)
            _score_runs(scorer, w.hash, line, head, tail, line_doc, first_line, offer)
            seen = np.bincount(doc, weights=vocabulary.index(w.hash) >= 0, minlength=n_docs) > 0
            pick = seen[doc]
            u, h, n = _term_counts(doc[pick], w.hash[pick])
            evidence, top, cosine = scorer.best(*scorer.dots(u, h, n, n_docs)[:3])
            whole = evidence >= 0
            at = np.flatnonzero(whole)
            offer(at, np.zeros(len(at), np.int64), evidence[at], top[at], cosine[at])
        names = [vocabulary.names[i] if i >= 0 else None for i in name.tolist()]
        found = name >= 0
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(block.ids),
                batch.column("path"),
                pa.array(names, pa.string()),
                pa.array(np.round(score, 9), pa.float64()),
                pa.array(place, pa.int32(), mask=~found, safe=False) if not found.all() else pa.array(place.astype(np.int32)),
                pa.array(whole & found),
            ],
            names=["doc_id", "path", "license", "score", "unit", "whole"],
        )


def _score_lines(scorer: Scorer, hashes, head, tail, line_doc, first_line, a: int, b: int, best, offer) -> None:
    """Offers the best of the lines a..b, and of the windows of up to WINDOW lines that begin there."""
    z = min(b + WINDOW - 1, len(head))
    m = z - a
    place = np.arange(head[a], tail[z - 1])
    u, h, n = _term_counts(np.repeat(np.arange(m), tail[a:z] - head[a:z]), hashes[place])
    dot, norm2, count, part2 = scorer.dots(u, h, n, m)
    docs = line_doc[a:z]
    number = np.arange(a, z) - first_line[docs]
    at = np.flatnonzero(part2[: b - a] >= scorer.threshold**2 * norm2[: b - a] * (1 - 1e-9))  # Cauchy's inequality
    evidence, top, cosine = scorer.best(dot[:, at], norm2[at], count[at])
    offer(docs[at], number[at], evidence, top, cosine)
    # A window's product is the sum of its lines', its norm at least the root of the sum of their squared norms.
    # Windows that cannot reach the threshold by that are left out: first by each line's largest product alone.
    if not len(dot):
        return
    most, norm, counts = (np.append(0, np.cumsum(x)) for x in (dot.max(axis=0), norm2, count))
    starts, ends = [], []
    for size in range(2, min(WINDOW, m) + 1):
        s = np.arange(min(b - a, m - size + 1))
        sums = most[s + size] - most[s]
        s = s[(docs[s] == docs[s + size - 1]) & (sums >= scorer.threshold * np.sqrt(norm[s + size] - norm[s]) * (1 - 1e-6))]
        starts.append(s)
        ends.append(s + size)
    starts, ends = np.concatenate(starts or [np.zeros(0, int)]), np.concatenate(ends or [np.zeros(0, int)])
    if not len(starts):
        return
    sums = np.concatenate([np.zeros((len(dot), 1)), np.cumsum(dot, axis=1)], axis=1)
    bound = np.empty(len(starts))
    for i in range(0, len(starts), 1 << 15):
        s, e = starts[i : i + (1 << 15)], ends[i : i + (1 << 15)]
        bound[i : i + (1 << 15)] = scorer.best((sums[:, e] - sums[:, s]) * (1 + 1e-6), norm[e] - norm[s], counts[e] - counts[s])[0]
    # Exact cosines, the most promising windows of every document first, until none can beat the best one
    entry = np.searchsorted(u, np.arange(m + 1))  # first entry of each line
    order = np.lexsort((ends, starts, -bound, docs[starts]))
    order = order[bound[order] >= 0]
    while len(order):
        order = order[bound[order] > best[docs[starts[order]]]]
        d = docs[starts[order]]
        fresh = np.flatnonzero(np.append(True, d[1:] != d[:-1])) if len(d) else np.zeros(0, int)
        rank = np.arange(len(d)) - np.repeat(fresh, np.diff(np.append(fresh, len(d))))
        take = order[rank < 4]
        for i in range(0, len(take), 1 << 10):
            t = take[i : i + (1 << 10)]
            owner, x = _ranges(entry[starts[t]], entry[ends[t]])
            uu, hh, nn = _sum_counts(owner, h[x], n[x])
            evidence, top, cosine = scorer.best(*scorer.dots(uu, hh, nn, len(t))[:3])
            ok = evidence >= 0
            offer(docs[starts[t]][ok], number[starts[t]][ok], evidence[ok], top[ok], cosine[ok])
        order = order[rank >= 4]


def _score_runs(scorer: Scorer, hashes, line, head, tail, line_doc, first_line, offer) -> None:
    """Offers, for every document and long template, the run of lines that belongs to the template most (the largest sum)."""
    vocabulary = scorer.vocabulary
    term = vocabulary.index(hashes)
    weight = scorer.weight[term]
    total = np.bincount(line, weights=weight, minlength=len(head))
    seen = term >= 0
    at, words, value = line[seen], term[seen], weight[seen]
    turn = line_doc * 2 * (FOREIGN + 1) * (total.sum() + 1)  # keeps the running minimum within a document
    starts, ends = [], []
    for row in vocabulary.counts[vocabulary.size > LONG]:
        own = np.bincount(at, weights=value * (row[words] > 0), minlength=len(head))
        if own.max(initial=0.0) == 0:
            continue
        gain = np.cumsum(own - FOREIGN * (total - own))
        before = np.concatenate([[0.0], gain[:-1]]) - turn  # the sum before each line
        low = np.minimum.accumulate(before)
        sums = gain - turn - low
        order = np.lexsort((-sums, line_doc))
        last = order[np.append(True, np.diff(line_doc[order]) > 0)]  # of each document the line where its best run ends
        least = RUN_SHARE * float((np.minimum(row, 2) * scorer.weight[:-1]).sum())
        last = last[sums[last] >= least]
        new = np.flatnonzero(np.append(True, before[1:] < low[:-1]))  # lines that set a new minimum begin the runs
        starts.append(new[np.searchsorted(new, last, side="right") - 1])
        ends.append(last + 1)
    if not starts:
        return
    starts, ends = np.concatenate(starts), np.concatenate(ends)
    long = ends - starts > 1
    starts, ends = starts[long], ends[long]
    for i in range(0, len(starts), 256):
        s, e = starts[i : i + 256], ends[i : i + 256]
        owner, place = _ranges(head[s], tail[e - 1])
        evidence, top, cosine = scorer.best(*scorer.dots(*_term_counts(owner, hashes[place]), len(s))[:3])
        ok = evidence >= 0
        offer(line_doc[s][ok], (s - first_line[line_doc[s]])[ok], evidence[ok], top[ok], cosine[ok])


def scan(files: DataFrame, templates: dict[str, list[str]] | None = None, threshold: float = 0.8) -> DataFrame:
    """Own licence of every row (columns of SCORED); needs doc_id, path and text."""
    templates = templates or TEMPLATES
    rows = files.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("path").cast("string").alias("path"))
    rows = rows.where("doc_id IS NOT NULL")
    counted = rows.mapInArrow(shipped(__name__, "count_batches", templates=templates), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    n = {r.term: r.n for r in counted.collect()}  # at most the template words
    units = n.get(-1, 0)
    idf = [math.log((1 + units) / (1 + n.get(t, 0))) + 1 for t in range(len(Vocabulary(templates).terms))]
    unseen = math.log(1 + units) + 1
    return rows.mapInArrow(shipped(__name__, "score_batches", templates=templates, idf=idf, unseen=unseen, threshold=threshold), SCORED)


def parent(path: Column) -> Column:
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, "/[^/]*$", ""))


def ancestors(directory: Column) -> Column:
    """The directory and all above it: array<struct<depth, path>>."""
    names = F.split(directory, "/")
    return F.transform(
        F.sequence(F.lit(1), F.size(names)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(names, 1, n), "/").alias("path"))
    )


def inherit(scored: DataFrame) -> DataFrame:
    """Adds effective (own or inherited licence) and inherited_from (the declaring directory)."""
    rows = keep(scored.withColumn("dir", parent(F.col("path"))), "licenses")
    votes = rows.where("license IS NOT NULL AND dir IS NOT NULL").groupBy("dir", "license").agg(F.sum(F.col("whole").cast("int")).alias("files"), F.count("*").alias("n"))
    order = Window.partitionBy("dir").orderBy(F.desc("files"), F.desc("n"), "license")
    declared = votes.withColumn("place", F.row_number().over(order)).where("place = 1").select(F.col("dir").alias("above"), F.col("license").alias("declared"))
    # directories, not files, are joined: each distinct one once for each ancestor
    needed = rows.where("license IS NULL AND dir IS NOT NULL").select("dir").distinct()
    climbs = needed.select("dir", F.explode(ancestors(F.col("dir"))).alias("up")).select("dir", "up.depth", F.col("up.path").alias("above"))
    nearest = climbs.join(declared, "above").groupBy("dir").agg(F.max_by(F.struct("declared", "above"), "depth").alias("d"))
    found = rows.join(nearest, "dir", "left")
    own = F.col("license").isNotNull()
    return found.select(
        "doc_id",
        "path",
        "license",
        "score",
        "unit",
        F.when(own, F.col("license")).otherwise(F.col("d.declared")).alias("effective"),
        F.when(~own, F.col("d.above")).alias("inherited_from"),
    )


def license_scan(files: DataFrame, templates: dict[str, list[str]] | None = None, threshold: float = 0.8) -> DataFrame:
    return inherit(scan(files, templates, threshold))
