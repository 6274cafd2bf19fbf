"""Corpus pipeline: language ID, near-duplicate removal, decontamination, secret redaction, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``. ``run`` writes every stage's result
to the shared folder and reads it again as the next one's input.

Defined results: a document is a doc_id with a text. Rows that share a doc_id but not the text are judged
apart; rows that share both are one document (stage 2 keeps one of them). Stage 1 drops null texts and texts without a
letter; a corpus without usable labels teaches no language, and keeps all others. Rows without a doc_id cannot be
judged: stages 1 to 3 pass them on, stage 4 redacts them too, packing leaves them out. Extra columns travel along
under any name (rows are carried as one struct). Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bandwise.llm import decontaminate, langid, ngram_join, packing, secrets
from bandwise.llm.common import keep, table

ORACLE_SQL = None  # trained models, packing and p-values: tests/llm/test_pipeline.py checks the stages instead


def _row(docs: DataFrame):
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def _documents(docs: DataFrame) -> DataFrame:
    """row, id, sid and key of every row. ``sid`` names a document: its doc_id, or, where several texts share that, a hash of both.

    What is written here is small and its size then known, so rows move only where it is large.
    """
    key = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    null = F.col("text").isNull().cast("string")  # a null text is no empty text
    rows = docs.select(_row(docs), F.col("doc_id").cast("long").alias("id"), F.concat(key, null).alias("key"))
    many = rows.where("id IS NOT NULL").groupBy("id").agg(F.min("key").alias("a"), F.max("key").alias("b")).where("a <> b")
    many = keep(many.select("id", F.lit(True).alias("many")), "ids")
    own = F.when(F.col("many"), F.xxhash64("id", "key")).otherwise(F.col("id"))
    return rows.join(many, "id", "left").select("row", "id", own.alias("sid"), "key")


def _texts(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("sid").alias("doc_id"), F.col("row.text").alias("text"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language cannot be told: null text, or no letter. Only ids and texts go through Python."""
    rows = _documents(docs)
    texts = rows.select(F.col("sid").alias("doc_id"), F.col("row.text").cast("string").alias("text"))
    judged = langid.predict(texts, langid.learn(langid.labelled(docs)), ["doc_id"])
    reject = keep(judged.where("NOT has_letter").select(F.col("row.doc_id").alias("sid")).distinct(), "rejected")
    return rows.join(reject, "sid", "left_anti").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest doc_id of every group of near copies; of repeated rows one."""
    rows = _documents(docs)
    groups = ngram_join.near_duplicates(_texts(rows), n=5).select(F.col("doc_id").alias("sid"), "component_id").distinct()
    named = rows.where("sid IS NOT NULL").groupBy("sid").agg(F.min("id").alias("id"), F.min("key").alias("key"), F.count("*").alias("n"))
    first = F.min(F.struct("id", "key", "sid", "n")).alias("first")
    stay = keep(named.join(groups, "sid").groupBy("component_id").agg(first).select("first.sid", "first.n"), "stay")
    kept = rows.select("row", "sid").join(stay, "sid")
    once = kept.where("n = 1").select("row").unionByName(kept.where("n > 1").dropDuplicates(["sid"]).select("row"))
    return once.unionByName(rows.where("sid IS NULL").select("row")).select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    rows = _documents(docs)
    found = decontaminate.contamination(_texts(rows), table(spark, sf_dir, "benchmark"))
    hit = keep(found.where(F.size("spans") > 0).select(F.col("doc_id").alias("sid")).distinct(), "hits")
    return rows.join(hit, "sid", "left_anti").select("row.*")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by a mark; n_chars follows the text."""
    found = secrets.find_secrets(docs.withColumn("text", F.col("text").cast("string")), carried=tuple(f"`{c}`" for c in docs.columns))
    hit = F.size("spans") > 0
    clean = F.when(hit, secrets.redacted(F.col("row.text"), F.col("spans"))).otherwise(F.col("row.text"))
    found = found.select("row", hit.alias("hit"), clean.alias("clean"))
    new = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("hit"), F.length("clean")).otherwise(F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType)
    return found.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 1024."""
    return packing.pack(docs, capacity=1024, end_id=2)


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("secret_scans", secret_scan),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = keep(docs, name)
    return docs
