"""Quality rules: counts that need no model, and a hashed n-gram log-likelihood ratio. DataFrame functions only.

Word unigrams and bigrams hash into ``buckets`` cells. Two multinomials over the cells are
counted: the raw corpus (every document) and the trusted target (documents labelled good and not
toxic). A cell's ratio is log(target / raw), where the target is smoothed towards the raw distribution with a weight
of one count per cell: a cell without evidence has a ratio near 0. A document's score is
the mean ratio of its n-grams, so long and short documents compare; every document is judged by the
same ``threshold`` (no sampling, no noise).

The raw counts cover every document. The target is fitted on at most ``target_docs`` trusted documents (those
whose ids hash lowest), so their ids may be broadcast and no text is shuffled. One narrow pass counts
(a task sends at most ``buckets`` rows), one scores; the ratios are one array of ``buckets`` doubles.

Defined results: null or empty text has no words, score 0 and fails the base rules; without
any trusted document all ratios are 0 and only the base rules decide; a document whose labels differ is trusted
if all are; repeated rows count and are judged apiece; rows without a doc_id are left out; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandwise.llm.common import id_text

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
TARGET_DOCS = 100_000  # most labelled documents the target is fitted on
BUCKETS = 1 << 14
THRESHOLD = -0.1  # mean log ratio per n-gram, in nats
MIN_WORDS, MAX_REPEATED = 20, 30  # words; per cent


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also where the body uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def word_list(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _shared(entries: Column) -> Column:
    """The entries (key, at) of a list sorted by key whose key occurs more than once."""

    def same(x: Column, j: Column) -> Column:
        return F.get(entries, j)["key"].eqNullSafe(x["key"])

    return F.filter(entries, lambda x, j: same(x, j - 1) | same(x, j + 1))


def hashed(words: Column) -> Column:
    """A 64-bit hash of every word."""
    return F.transform(words, lambda w: F.xxhash64(w))


def joined(hashes: Column, distance: int) -> Column:
    """Hash of every entry together with the one ``distance`` behind it."""
    n = F.greatest(F.size(hashes) - distance, F.lit(0))
    return F.zip_with(F.slice(hashes, 1, n), F.slice(hashes, 1 + distance, n), lambda a, b: F.xxhash64(a, b))


def repeated_words(words: Column, pairs: Column) -> Column:
    """Words that lie in a window of 8 words found twice or more in the list; ``pairs`` are ``joined(hashed(words), 1)``.

    Window hashes find the candidates; those are compared as strings.
    """

    def entry(key: Column, at: Column) -> Column:
        return F.struct(key.alias("key"), at.alias("at"))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - x, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda s, x: s + x)

    def exact(found: Column) -> Column:
        spelled = F.transform(found, lambda x: entry(F.array_join(F.slice(words, x["at"] + 1, WINDOW), " "), x["at"]))
        return _let(F.sort_array(spelled), lambda s: _let(F.sort_array(F.transform(_shared(s), lambda x: x["at"])), covered))

    def judged(keys: Column) -> Column:
        entries = F.sort_array(F.transform(keys, lambda k, i: entry(k, i)))
        many = _let(entries, lambda s: _let(_shared(s), exact))
        return F.when(F.size(F.array_distinct(keys)) < F.size(keys), many).otherwise(F.lit(0).cast("long"))

    windows = _let(pairs, lambda two: _let(joined(two, 2), lambda four: _let(joined(four, 4), judged)))
    return F.when(F.size(words) > WINDOW, windows).otherwise(F.lit(0).cast("long"))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    return _let(lines, lambda s: (F.size(s) - F.size(F.array_distinct(s))).cast("long"))


def cell(gram: Column, buckets: int) -> Column:
    """The cell (from 0) of a hashed unigram or bigram."""
    return F.pmod(gram, F.lit(buckets)).cast("int")


def with_grams(docs: DataFrame, *columns: str) -> DataFrame:
    """doc_id, text (null: empty), words, their hashes (ones), those of adjacent words (twos), and ``columns``."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *columns)
    rows = rows.select("*", word_list(F.col("text")).alias("words"))
    rows = rows.select("*", hashed(F.col("words")).alias("ones"))
    return rows.select("*", joined(F.col("ones"), 1).alias("twos"))


def trusted_ids(labels: DataFrame, most: int) -> DataFrame:
    """doc_id of the documents that every label calls good and none toxic; of more than ``most`` those that hash lowest."""
    rows = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    good = (F.min(F.coalesce("quality", F.lit(0))) == 1) & (F.max(F.coalesce("toxic", F.lit(0))) == 0)
    rows = rows.agg(good.alias("trusted")).where("trusted")
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def cell_counts(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, target_docs: int = TARGET_DOCS) -> DataFrame:
    """(cell, raw, target): n-grams of all documents and of the trusted ones in every cell, 0 where there are none."""
    trusted = F.broadcast(trusted_ids(labels, target_docs))  # at most ``target_docs`` ids
    rows = with_grams(id_text(docs).join(trusted, "doc_id", "left"), "trusted")
    cells = rows.select("trusted", F.explode(F.concat("ones", "twos")).alias("gram")).select("trusted", cell(F.col("gram"), buckets).alias("cell"))
    counts = cells.groupBy("cell").agg(F.count("*").alias("raw"), F.count("trusted").alias("target"))
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("cell"))
    return every.join(counts, "cell", "left").select("cell", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("raw", "target")))


def ratio_array(counts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row: the log ratios of all cells, in their order (``buckets`` doubles)."""

    def total(cells: Column, name: str) -> Column:
        return F.aggregate(cells, F.lit(0).cast("long"), lambda s, x: s + x[name])

    def ratios(cells: Column, raw: Column, target: Column) -> Column:
        def ratio(x: Column) -> Column:
            share = x["raw"] / raw
            return F.when((x["raw"] > 0) & (target > 0), F.log((x["target"] + buckets * share) / (target + buckets) / share)).otherwise(F.lit(0.0))

        return F.transform(cells, ratio)

    rows = counts.agg(F.sort_array(F.collect_list(F.struct("cell", "raw", "target"))).alias("cells"))
    rows = rows.select("cells", total(F.col("cells"), "raw").alias("raw"), total(F.col("cells"), "target").alias("target"))
    return rows.select(_let(F.col("cells"), lambda c: ratios(c, F.col("raw"), F.col("target"))).alias("ratios"))


def mean_ratio(words: Column, ones: Column, twos: Column, ratios: Column, buckets: int) -> Column:
    """Mean log ratio of a text's n-grams; 0 for a text without words."""

    def summed(grams: Column) -> Column:
        return F.aggregate(grams, F.lit(0.0), lambda s, g: s + F.element_at(ratios, cell(g, buckets) + 1))

    return F.when(F.size(words) > 0, (summed(ones) + summed(twos)) / (F.size(ones) + F.size(twos))).otherwise(F.lit(0.0))


def base_counts(text: Column, words: Column, twos: Column) -> list[Column]:
    return [
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        duplicate_lines(text).alias("n_dup_lines"),
        repeated_words(words, twos).alias("n_repeat_words"),
    ]


def judge(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, threshold: float = THRESHOLD, target_docs: int = TARGET_DOCS) -> DataFrame:
    """Base counts, base_failed, score (mean log ratio per n-gram) and kept of every document."""
    known = ratio_array(cell_counts(docs, labels, buckets, target_docs), buckets).first()["ratios"]  # ``buckets`` doubles
    # folded to one array literal; a scalar subquery may not stand inside a higher-order function
    ratios = F.split(F.lit(",".join(map(repr, known))), ",").cast("array<double>")
    words, ones, twos = F.col("words"), F.col("ones"), F.col("twos")
    score = mean_ratio(words, ones, twos, ratios, buckets).alias("score")
    rows = with_grams(id_text(docs)).select("doc_id", *base_counts(F.col("text"), words, twos), score)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
