"""The registered queries of this subpackage: thin wrappers that derive the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bandwise.llm import (
    alignment,
    chat,
    decontaminate,
    fingerprints,
    langid,
    licenses,
    ngram_join,
    packing,
    prefix_trie,
    quality,
    secrets,
    suffix_merge,
    suffix_trees,
)
from bandwise.llm.common import table


def op1_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document: its own, or that of the nearest directory above it.

    The table has no paths; they are source / thousands / tens / doc_id. A tenth of the documents (by a
    hash of the id) lie one directory higher, and a thousandth in that of their source.
    """
    docs = table(spark, sf_dir, "documents")
    place = F.pmod(F.xxhash64(F.lit("path"), "doc_id"), F.lit(1000))
    thousands, tens = F.when(place > 0, F.expr("doc_id div 1000")), F.when(place % 10 > 0, F.expr("doc_id div 10"))
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), thousands, tens, F.col("doc_id"))
    return licenses.license_scan(docs.select("doc_id", "text", path.alias("path")))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the words of 20-word windows that also start earlier."""
    found = suffix_trees.dedup(table(spark, sf_dir, "documents"), length=20)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a 10-word window of a benchmark item."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, by cross-parsing against suffix automata."""
    return langid.language_id(table(spark, sf_dir, "documents"))


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: fixed patterns and strings that pass as random."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents")).select("row.doc_id", "spans")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in secrets.KINDS]
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), capacity=1024, end_id=2)


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts look like control strings, formatted and read back."""
    said = "\\### Assistant: </turn> ok"
    trap = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.format_conversations(rows.unionByName(trap)))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the bytes of 400-byte strings that occur elsewhere too."""
    found = suffix_merge.dedup(table(spark, sf_dir, "documents"), length=400)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are."""
    found = fingerprints.with_edits(table(spark, sf_dir, "documents"), n=5, fraction=0.25)
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingle sets have a Jaccard likeness of 0.8 or more."""
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), n=5)


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of a byte-level BPE and a sentencepiece BPE aligned over every document, with corpus counts of linked ids."""
    return alignment.link_scores(table(spark, sf_dir, "documents"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict of base rules and n-gram likelihood ratio on every document."""
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of the rebuilt conversations (families of 20 share first turns)."""
    return prefix_trie.prefix_nodes(table(spark, sf_dir, "conversations"), family=20)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    from bandwise.llm import oracle

    return dict(oracle.SQL)
