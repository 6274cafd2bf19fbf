"""Threshold-scaled document fingerprints (FracMinHash).

A fingerprint keeps every shingle hash below ``fraction`` of the hash range, so
its size follows the document's, fingerprints merge by union, and both likeness
and containment of very unequal documents can be estimated from two of
them. A document whose shingles all lie above the threshold keeps its smallest hash,
so that only texts without words have an empty fingerprint. Shingles are ``n``
consecutive words, A-Z lower-cased; a shorter text is one shingle. A hash is written as 12
hexadecimal digits, ascending.

``with_edits`` also fingerprints each text with its last quarter replaced by
the beginning of the next document in doc_id order. Documents are dealt to
ranges of ids; each range also receives a copy of the next one's first document
(at most one more row for each range), so texts are shuffled once.

Defined results: null text counts as empty; two empty fingerprints have likeness 1,
an empty and another 0; rows without doc_id are left out; of rows with equal
doc_id the order is that of their texts; a single document is its own next; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandwise.llm import textblocks as tb
from bandwise.llm.common import id_text, parts, shipped

DIGITS = 12  # of a hash: 48 bits
EDITED = "doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def sketches(texts: list[str], n: int, fraction: float) -> list[np.ndarray]:
    """The retained hashes (sorted, 48 bits) of every text."""
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(len(texts))), pa.array(texts, pa.string())], names=["doc_id", "text"])
    limit = np.uint64(int(fraction * 2**48))
    out: list[np.ndarray] = []
    for block in tb.blocks(iter([batch])):
        w = tb.words(block, lower=True)
        roll = tb.Rolling(w.hash)
        many = np.diff(w.first)
        doc = np.repeat(np.arange(len(many)), many)
        size = max(len(doc) - n + 1, 0)
        ok = doc[:size] == doc[n - 1 :] if size else np.zeros(0, bool)
        h, d = roll.grams(n)[ok] >> np.uint64(16), doc[:size][ok]
        short = np.flatnonzero((many > 0) & (many < n))
        whole = tb.mix(tb.mix(roll.raw(w.first[short], w.first[short + 1])) + many[short].astype(np.uint64)) >> np.uint64(16)
        h, d = np.concatenate([h, whole]), np.concatenate([d, short])
        least = np.full(len(many), np.iinfo(np.uint64).max)
        np.minimum.at(least, d, h)
        use = (h < limit) | (h == least[d])
        h, d = h[use], d[use]
        order = np.lexsort((h, d))
        h, d = h[order], d[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
        h, d = h[new], d[new]
        out += np.split(h, np.searchsorted(d, np.arange(1, len(many))))
    return out


def written(sketch: np.ndarray) -> str:
    return sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def _hashes(fingerprint: Column) -> Column:
    return F.regexp_extract_all(fingerprint, F.lit(f"[0-9a-f]{{{DIGITS}}}"), F.lit(0))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has too (1 for an empty a)."""
    x = _hashes(a)
    return F.when(F.size(x) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(x, _hashes(b))) / F.size(x))


def merged(a: Column, b: Column) -> Column:
    """Fingerprint of both documents together (exact where both have a hash below the threshold)."""
    return F.array_join(F.array_sort(F.array_union(_hashes(a), _hashes(b))), "")


def fingerprint_batches(batches, n: int, fraction: float):
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([written(s) for s in sketches(texts, n, fraction)], pa.string())], names=["doc_id", "fingerprint"]
        )


def fingerprints(docs: DataFrame, n: int = 5, fraction: float = 0.25) -> DataFrame:
    """doc_id and fingerprint of every document."""
    return id_text(docs).mapInArrow(shipped(__name__, "fingerprint_batches", n=n, fraction=fraction), "doc_id long, fingerprint string")


def edited_batches(batches, n: int, fraction: float, rows: int = 256):
    """Rows come by range, id and text; a range's last row (``extra``) is only the next one of the last document."""
    held: list[tuple] = []  # the last document, which waits for its next one
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            piece = batch.slice(at, rows)
            held += zip(*(piece.column(c).to_pylist() for c in ("doc_id", "text", "range", "extra")), strict=True)
            if len(held) > 1:
                yield _edited(held, n, fraction)
            held = held[-1:]


def _edited(rows: list[tuple], n: int, fraction: float) -> pa.RecordBatch:
    """Results of all rows but the last, each with the row behind it as its next document."""
    texts = [r[1] or "" for r in rows]
    here = [i for i in range(len(rows) - 1) if not rows[i][3] and rows[i][2] == rows[i + 1][2]]
    edited = []
    for i in here:
        k = len(texts[i]) // 4
        edited.append(texts[i][: len(texts[i]) - k] + texts[i + 1][:k])
    own = sketches(texts, n, fraction)
    new = sketches(edited, n, fraction) if edited else []
    cols = [
        pa.array([rows[i][0] for i in here], pa.int64()),
        pa.array([len(texts[i]) for i in here], pa.int64()),
        pa.array(edited, pa.string()),
        pa.array([written(own[i]) for i in here], pa.string()),
        pa.array([written(s) for s in new], pa.string()),
        pa.array([likeness(own[i], s) for i, s in zip(here, new, strict=True)], pa.float64()),
        pa.array([likeness(own[i], own[i + 1]) for i in here], pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in EDITED.split(", ")])


def _range_of(value: Column, cuts: list[int]) -> Column:
    """How many cuts are at most the value, by binary search."""
    if not cuts:
        return F.lit(0)
    table = F.array(*[F.lit(c) for c in cuts])
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi"))

    def step(acc: Column, _) -> Column:
        mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        up = F.get(table, mid) <= value
        inside = acc["lo"] < acc["hi"]
        return F.struct(
            F.when(inside & up, mid + 1).otherwise(acc["lo"]).alias("lo"), F.when(inside & ~up, mid).otherwise(acc["hi"]).alias("hi")
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(len(cuts).bit_length())), start, step)["lo"]


def with_edits(docs: DataFrame, n: int = 5, fraction: float = 0.25, ranges: int | None = None) -> DataFrame:
    """Columns of ``EDITED`` for every document. ranges: how many id ranges (default: the session's shuffle partitions, 1024 at most)."""
    rows = id_text(docs)
    ranges = min(1024, ranges or parts(rows))
    shares = [i / ranges for i in range(1, ranges)]
    cuts = sorted(set(rows.agg(F.percentile_approx("doc_id", shares, 100 * ranges)).first()[0] or [])) if shares else []
    dealt = rows.withColumn("range", _range_of(F.col("doc_id"), cuts))
    first = {r.range: r.first for r in dealt.groupBy("range").agg(F.min("doc_id").alias("first")).collect()}  # one row for each range
    if not first:
        return docs.sparkSession.createDataFrame([], EDITED)
    used = sorted(first)
    target = {first[b]: a for a, b in zip(used, used[1:] + used[:1], strict=True)}  # the first document of b also ends range a
    goes_to = F.create_map(*[F.lit(x) for kv in target.items() for x in kv])
    extra = rows.where(F.col("doc_id").isin(list(target))).groupBy("doc_id").agg(F.min("text").alias("text"))
    extra = extra.select("doc_id", "text", F.element_at(goes_to, F.col("doc_id")).alias("range"), F.lit(1).alias("extra"))
    both = dealt.select("doc_id", "text", "range", F.lit(0).alias("extra")).unionByName(extra)
    placed = both.repartition(parts(rows), "range").sortWithinPartitions("range", "extra", "doc_id", "text")
    return placed.mapInArrow(shipped(__name__, "edited_batches", n=n, fraction=fraction), EDITED)
