"""Corpus pipeline: toxicity, near-duplicates, decontamination, personal data, BPE.

Every stage takes (spark, docs, sf_dir) and returns the documents it keeps,
with the columns of ``documents``; the last returns their ids and digests of
ids and decoded text. ``run`` writes each stage's result as Parquet into the
shared folder and reads it again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.llm import bpe, decontaminate, jaccard, pii, toxicity
from docflow.llm.common import id_bucket, small_side, staged, text_hash
from docflow.llm.queries import TOXIC_FROM, WORD_BPE, round_trip_digests
from docflow.session import table


def _free(docs: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as make it no column of ``docs``."""
    while name in docs.columns:
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose toxicity score stays below the threshold."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), train_rows=id_bucket("doc_id", 4) != 2)
    score = _free(docs, "toxicity")
    return toxicity.score(docs, model, score_col=score).where(F.col(score) < TOXIC_FROM).select(*docs.columns)


def _named(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """``rows`` (doc_id, text_hash) by names that no column of ``docs`` has."""
    return rows.select(F.col("doc_id").alias(_free(docs, "their_id")), F.col("text_hash").alias(_free(docs, "their_hash")))


def _same(docs: DataFrame) -> Column:
    """Whether a document and a row of ``_named`` have the same id (or none) and the same text."""
    return F.col("doc_id").eqNullSafe(F.col(_free(docs, "their_id"))) & (text_hash() == F.col(_free(docs, "their_hash")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id, and one of those without an id.

    Rows that share an id are one document if they share their text, and one of
    them is kept; a group's rows with the smallest id and other texts give way
    to one of them. Rows without an id are compared with one another only.
    """
    groups = staged(jaccard.grouped(docs.select("doc_id", "text")), "groups")
    row = F.struct("doc_id", "text_hash")
    first = (groups.where("component IS NOT NULL").groupBy("component", F.col("doc_id").isNull().alias("without"))
             .agg(F.min(row).alias("first"), F.max(row).alias("last")).where("first != last"))
    several = small_side(staged(first.select("component", "without", "first"), "several"))
    members = groups.withColumn("without", F.col("doc_id").isNull()).join(several, ["component", "without"])
    copies = staged(_named(members.where(row != F.col("first")), docs).distinct(), "copies")
    same = groups.where("doc_id IS NOT NULL OR component IS NOT NULL").groupBy("doc_id", "text_hash")
    repeated = staged(_named(same.agg(F.count("*").alias("n")).where("n > 1"), docs), "repeated")
    kept = docs.join(small_side(copies), _same(docs), "left_anti")
    if repeated.isEmpty():
        return kept
    once = (kept.join(small_side(repeated), _same(docs), "left_semi").withColumn(_free(docs, "hash"), text_hash())
            .dropDuplicates(["doc_id", _free(docs, "hash")]).drop(_free(docs, "hash")))
    return kept.join(small_side(repeated), _same(docs), "left_anti").unionByName(once)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark passage."""
    found = decontaminate.overlaps(docs, table(spark, sf_dir, "benchmark"))
    leaks = staged(_named(found.select("doc_id", "text_hash").distinct(), docs), "leaks")
    return docs.join(small_side(leaks), _same(docs), "left_anti")


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and the terms that disclose it replaced; ``n_chars`` follows the text."""
    return (pii.sanitise(docs)
            .withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")))
            .select(*docs.columns))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of every document."""
    return round_trip_digests(bpe.encode(docs, WORD_BPE, keep=["doc_id"], decoded=True))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", sanitise),
    ("bpe", encode),
]

#: FTRL-proximal training and heap-ordered merges have no SQL form; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
