"""Secret scans with DataFrame functions only: fixed patterns, and a randomness test battery.

Fixed patterns (assignments, access keys, long hex runs) are found as leftmost
non-overlapping matches. Further candidates are runs of 20 or more of the
characters of common encodings. Each is tested for randomness in its inferred
encoding: chi-squared uniformity over five cells of the alphabet (4 degrees of
freedom), Wald-Wolfowitz runs about the alphabet's middle, and lag-1 serial
correlation; Fisher's method combines the three. Random strings have uniform
p-values, words and paths have tiny ones.

False-discovery control is length-aware: distinct candidate strings (copies are
no independent tests) are counted by (encoding, length class, p-value bin) over
the whole corpus. In each class the number of truly random strings follows from
the p-values above 1/2, and the smallest p-value is taken at which the estimated
share of other strings among those reported stays within ``q``, but none so small that random strings would be
expected there less than ``LOST`` times. The estimate is a share of the strings above ``PLAIN_P``; it is shrunk towards
the share of the neighbouring length classes (half the weight for each step), and that one towards 1, as if by ``PRIOR`` more
strings. So a class of one string follows its neighbours, and their say fades with every further string. That table has at
most a few thousand rows.

Positions count code points, end exclusive. Defined results: null text counts
as empty; an empty text has no spans; repeated rows give repeated rows; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandwise.llm.common import keep

# The required patterns and the least length of what counts.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"  # 18 or more in all
HEX = r"[0-9a-f]{16,}"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
KINDS = ("assign", "access", "hex", "random")

ALPHABETS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
    "any": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_",
}
CELLS = 5
BLOCK = 256  # matches added up at once
LOG_BINS = 48  # p-value bins, four for each power of ten
PRIOR = 100.0  # strings that the share of the neighbouring length classes counts for
PLAIN_P, PLAIN_BINS = 0.01, 8  # strings above this p-value may be random; bins above it
LOST = 0.01  # expected number of random strings below the smallest p-value reported


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, m>> of all leftmost non-overlapping matches.

    The pieces between the matches and the matches themselves alternate, so
    running lengths give the places; they are added up in two levels, which
    keeps texts with very many matches linear.
    """
    pieces = F.zip_with(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda p, m: F.struct(F.coalesce(F.length(p), F.lit(0)).alias("gap"), m.alias("m")),
    )
    pieces = F.filter(pieces, lambda x: x["m"].isNotNull())
    empty = F.array().cast("array<struct<start:int,end:int,m:string>>")

    def place(block: Column, base: Column) -> Column:
        return F.aggregate(
            block,
            F.struct(base.alias("at"), empty.alias("out")),
            lambda acc, x: F.struct(
                (acc["at"] + x["gap"] + F.length(x["m"])).alias("at"),
                F.array_append(
                    acc["out"],
                    F.struct(
                        (acc["at"] + x["gap"]).alias("start"),
                        (acc["at"] + x["gap"] + F.length(x["m"])).alias("end"),
                        x["m"].alias("m"),
                    ),
                ).alias("out"),
            ),
        )

    blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(pieces) / BLOCK).cast("int")), lambda b: F.slice(pieces, b * BLOCK + 1, BLOCK))
    placed = F.aggregate(
        blocks,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<array<struct<start:int,end:int,m:string>>>").alias("out")),
        lambda acc, b: F.transform(F.array(place(b, acc["at"])), lambda r: F.struct(r["at"].alias("at"), F.array_append(acc["out"], r["out"]).alias("out")))[0],
    )
    return F.when(text.rlike(pattern), F.flatten(placed["out"])).otherwise(empty)


def _of_kind(k: int):
    return lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit(k).alias("kind"))


def _between(low: Column, high: Column):
    return lambda y: (y >= low) & (y < high)


def base_spans(text: Column) -> Column:
    """array<struct<start, end, kind>> of the fixed patterns, kind as its place in KINDS."""
    kinds = []
    for k, pattern in enumerate((ASSIGN, ACCESS, HEX)):
        found = matches(text, pattern)
        if pattern is ASSIGN:
            found = F.filter(found, lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 2)) >= 12)
        kinds.append(F.transform(found, _of_kind(k)))
    return F.concat(*kinds)


def two_sided(z: Column) -> Column:
    """P(|N| > |z|), by Abramowitz and Stegun 7.1.26 (absolute error under 2e-7)."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return F.greatest(poly * F.exp(-x * x), F.lit(1e-300))


def encoding(m: Column) -> Column:
    """The smallest alphabet that holds the string (base62 for plain letters and digits)."""
    return (
        F.when(m.rlike("^[0-9a-f]+$"), "hex")
        .when(m.rlike("^[0-9A-F]+$"), "HEX")
        .when(m.rlike("^[A-Z2-7]+$"), "base32")
        .when(m.rlike("^[A-Za-z0-9]+$"), "base62")
        .when(m.rlike("^[A-Za-z0-9+/]+$"), "base64")
        .when(m.rlike("^[A-Za-z0-9_-]+$"), "base64url")
        .otherwise("any")
    )


def _in(column: Column, f) -> Column:
    """f(column) with the column evaluated once."""
    return F.transform(F.array(column), f)[0]


def randomness(m: Column, enc: Column) -> Column:
    """Combined p-value of the three tests under 'uniformly random over the alphabet'."""
    alphabet = F.coalesce(*[F.when(enc == k, F.lit(a)) for k, a in ALPHABETS.items()])
    return _in(
        F.struct(F.split(m, "").alias("c"), alphabet.alias("a")),
        lambda s: _in(
            F.struct(F.transform(s["c"], lambda c: F.instr(s["a"], c) - 1).alias("v"), F.length(s["a"]).alias("k")),
            lambda x: _p_value(x["v"], x["k"]),
        ),
    )


def _p_value(v: Column, k: Column) -> Column:
    n = F.size(v).cast("double")
    kd = k.cast("double")
    # chi-squared: cell j holds the values from ceil(j k / 5) to below ceil((j + 1) k / 5)
    cells = []
    for j in range(CELLS):
        low, high = F.ceil(kd * j / CELLS), F.ceil(kd * (j + 1) / CELLS)
        seen = F.size(F.filter(v, _between(low, high)))
        expected = n * (high - low) / kd
        cells.append((seen - expected) * (seen - expected) / expected)
    half_chi = sum(cells[1:], cells[0]) / 2
    p_chi = F.exp(-half_chi) * (1 + half_chi)  # 4 degrees of freedom
    # runs about the middle
    pairs = F.zip_with(F.slice(v, 1, F.size(v) - 1), F.slice(v, 2, F.size(v) - 1), lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    n1 = F.size(F.filter(v, lambda y: 2 * y >= k)).cast("double")
    n2 = n - n1
    runs = 1 + F.size(F.filter(pairs, lambda q: (2 * q["x"] >= k) != (2 * q["y"] >= k)))
    mean = 2 * n1 * n2 / n + 1
    var = (mean - 1) * (mean - 2) / (n - 1)
    p_runs = F.when((n1 == 0) | (n2 == 0), F.pow(F.lit(2.0), 1 - n)).when(var <= 0, F.lit(1.0)).otherwise(two_sided((runs - mean) / F.sqrt(var)))
    # lag-1 serial correlation
    total = F.aggregate(v, F.lit(0.0), lambda acc, y: acc + y)
    avg = total / n
    spread = F.aggregate(v, F.lit(0.0), lambda acc, y: acc + (y - avg) * (y - avg))
    lagged = F.aggregate(pairs, F.lit(0.0), lambda acc, q: acc + (q["x"] - avg) * (q["y"] - avg))
    p_serial = F.when(spread <= 0, F.lit(1e-300)).otherwise(two_sided((lagged / spread + 1 / n) * F.sqrt(n)))
    half = -(F.log(F.greatest(p_chi, F.lit(1e-300))) + F.log(F.greatest(p_runs, F.lit(1e-300))) + F.log(p_serial))
    return F.exp(-half) * (1 + half + half * half / 2)  # Fisher: 6 degrees of freedom


def length_class(n: Column) -> Column:
    """Half powers of two from 20 characters on, up to 640."""
    return F.least(F.lit(10), F.floor(2 * F.log2(n / 20.0))).cast("int")


def scan(docs: DataFrame, carried: list[str]) -> DataFrame:
    """The carried columns, base spans and tested candidates of every row, written to the shared folder."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    row = F.struct(*carried).alias("row")  # one column, so that no name can clash
    found = docs.select(row, base_spans(text).alias("base"), matches(text, CANDIDATE).alias("runs"))

    def tested(x: Column) -> Column:
        return _in(
            F.struct(x.alias("x"), encoding(x["m"]).alias("enc")),
            lambda s: F.struct(
                s["x"]["start"].alias("start"),
                s["x"]["end"].alias("end"),
                s["enc"].alias("enc"),
                length_class(s["x"]["end"] - s["x"]["start"]).alias("len_class"),
                randomness(s["x"]["m"], s["enc"]).alias("p"),
                F.xxhash64(s["x"]["m"]).alias("string"),
            ),
        )

    free = F.filter("runs", lambda r: ~F.exists("base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
    return keep(found.select("row", "base", F.transform(free, tested).alias("candidates")), "secrets")


def p_bin(p: Column) -> Column:
    return F.least(F.lit(LOG_BINS - 1), F.floor(-4 * F.log10(F.greatest(p, F.lit(1e-300))))).cast("int")


def thresholds(scanned: DataFrame, q: float) -> dict[tuple[str, int], int]:
    """The last p-value bin that is reported in each (encoding, length class)."""
    each = scanned.select(F.explode("candidates").alias("c")).select("c.*")
    strings = each.groupBy("enc", "len_class", "string").agg(F.max("p").alias("p"))  # copies have equal p
    counts = strings.groupBy("enc", "len_class", p_bin(F.col("p")).alias("bin")).agg(
        F.count("*").alias("n"), F.count(F.when(F.col("p") > 0.5, 1)).alias("upper")
    )
    classes: dict[tuple[str, int], dict[int, tuple[int, int]]] = {}
    for r in counts.collect():  # at most encodings x length classes x bins
        classes.setdefault((r.enc, r.len_class), {})[r.bin] = (r.n, r.upper)
    out = {}
    for key, bins in classes.items():
        random = random_strings(classes, key)
        reported, best = 0, None
        for b in range(LOG_BINS):
            reported += bins.get(b, (0, 0))[0]
            others = reported - random * (1 - 10 ** (-(b + 1) / 4))
            if reported and others <= q * reported and random * 10 ** (-b / 4) >= LOST:
                best = b
        if best is not None:
            out[key] = best
    return out


def random_strings(classes: dict, key: tuple[str, int]) -> float:
    """Estimated number of random strings of a class: those above PLAIN_P, times the share of them that is random."""

    def above(bins) -> tuple[float, float]:
        """(twice those above one half, those above PLAIN_P scaled to all): equal if every one of them is random"""
        return 2.0 * sum(u for _, u in bins.values()), sum(n for b, (n, _) in bins.items() if b < PLAIN_BINS) / (1 - PLAIN_P)

    enc, length = key
    near = [(2.0 ** -abs(c - length), above(bins)) for (e, c), bins in classes.items() if e == enc and c != length]
    pool = (sum(w * u for w, (u, _) in near) + PRIOR) / (sum(w * n for w, (_, n) in near) + PRIOR)
    upper, plain = above(classes[key])
    return plain * (upper + PRIOR * pool) / (plain + PRIOR)


def find_secrets(docs: DataFrame, q: float = 0.05, carried: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """row (a struct of the carried columns) and spans (array<struct<start, end, kind>>, by start, then kind) of every row."""
    scanned = scan(docs, list(carried))
    limits = thresholds(scanned, q)
    table = F.create_map(*[F.lit(x) for (enc, c), b in sorted(limits.items()) for x in (f"{enc}:{c}", b)]) if limits else F.lit(None).cast("map<string,int>")

    def reported(c: Column) -> Column:
        return F.coalesce(p_bin(c["p"]) <= F.element_at(table, F.concat(c["enc"], F.lit(":"), c["len_class"].cast("string"))), F.lit(False))

    added = F.transform(F.filter("candidates", reported), lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), F.lit(3).alias("kind")))
    names = F.array(*[F.lit(k) for k in KINDS])
    spans = F.transform(F.array_sort(F.concat("base", added)), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), names[s["kind"]].alias("kind")))
    # array_sort orders by start, then end, then kind; spans that start together are put in kind order
    spans = F.array_sort(
        spans,
        lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(F.array_position(names, a["kind"]) - F.array_position(names, b["kind"])).cast("int"),
    )
    return scanned.select("row", spans.alias("spans"))


def redacted(text: Column, spans: Column, mark: str = "<secret>") -> Column:
    """The text with every span (overlaps merged) replaced by a mark."""
    done = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.when(
            s["end"] <= acc["at"], acc
        ).when(
            (s["start"] < acc["at"]) & (acc["at"] > 0), F.struct(s["end"].alias("at"), acc["out"].alias("out"))
        ).otherwise(
            F.struct(s["end"].alias("at"), F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)).alias("out"))
        ),
    )
    return F.when(F.size(spans) == 0, text).otherwise(
        F.transform(F.array(done), lambda d: F.concat(d["out"], F.substring(text, d["at"] + 1, F.length(text) - d["at"])))[0]
    )
