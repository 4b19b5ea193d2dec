"""The registered ``opN_<name>`` queries: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.llm import (bpe, decontaminate, exactdedup, fertility, htmltext, jaccard, langid, licences, merkle, pii, toxicity,
                         warc, whitening)
from docflow.llm.common import id_bucket, staged
from docflow.session import shared_dir, table

BYTE_VOCABULARIES = {n: public_tokenizers.path(f"{n}.tiktoken") for n in ("byte_bpe_multi_50k", "byte_bpe_50k")}
#: Score from which a document counts as toxic.
TOXIC_FROM = 0.3
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_warc_boundary_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back from the archive files."""
    path = shared_dir(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    return warc.read_warc(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_licence_sentence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence rules that match in every document."""
    return licences.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_html_template_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return htmltext.extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"])


def op4_toxicity_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned outside the held-out quarter of the ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), train_rows=id_bucket("doc_id", 4) != 2)
    return toxicity.score(docs, model, keep=["doc_id"]).select(
        "doc_id",
        F.coalesce(id_bucket("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )


def op5_pii_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document, and the terms near it that give it away."""
    return pii.described(pii.find(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op6_language_bigru(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned outside the held-out third of the ids."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs, train_rows=id_bucket("doc_id", 3) != 1)
    return langid.predict(docs, model, keep=["doc_id"]).select(
        "doc_id", F.coalesce(id_bucket("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op7_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word, line and repetition counts of every document and whether it is kept."""
    docs = table(spark, sf_dir, "documents")
    rows = staged(fertility.measure(docs, BYTE_VOCABULARIES, public_tokenizers.PATTERN, keep=["doc_id"]), "fertility")
    accepted = fertility.accepted(fertility.learn(rows))
    return rows.select("doc_id", *fertility.COUNTS, fertility.base_failed().alias("base_failed"),
                       (~fertility.base_failed() & accepted).alias("kept"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shingle count and the smallest doc_id that its links reach."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold benchmark passages, with the items and the overlaps."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def round_trip_digests(coded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encoded and decoded documents."""
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op10_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as counts and digests."""
    docs = table(spark, sf_dir, "documents")
    return round_trip_digests(bpe.encode(docs, WORD_BPE, keep=["doc_id"], decoded=True))


def op11_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the 16 leading components, whitened."""
    rows = whitening.whiten(table(spark, sf_dir, "embeddings"), wanted=16)
    # decimal(38,0) in the operator; null where the sum is beyond a long
    return rows.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


def op12_merkle_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof in the manifest of the table, folded with a tampered leaf for a fifth of the ids."""
    docs = table(spark, sf_dir, "documents")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    tampered = merkle.leaf_digest(["doc_id", "source", "lang", "n_chars", F.translate("text", upper, lower)])
    leaves = docs.select("doc_id", "source", merkle.leaf_digest(merkle.FIELDS).alias("leaf"),
                         F.when(id_bucket("doc_id", 5) == 0, F.unhex(tampered)).alias("tampered"))
    manifest = merkle.build(leaves)
    start = merkle.text_of(F.coalesce("row.tampered", "leaf"))
    proofs = merkle.prove(manifest).select(
        F.col("row.doc_id").alias("doc_id"), merkle.text_of("leaf").alias("leaf"), merkle.text_of("subroot").alias("subroot"),
        F.lit(manifest.root).alias("root"), merkle.proof_digest().alias("proof_sha256"), merkle.folded(start).alias("folded_root"))
    return proofs.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_digest_run_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one of its equal texts that stays."""
    return exactdedup.exact_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_boundary_chain": op1_warc_boundary_chain,
    "op2_licence_sentence_rules": op2_licence_sentence_rules,
    "op3_html_template_text": op3_html_template_text,
    "op4_toxicity_ftrl": op4_toxicity_ftrl,
    "op5_pii_disclosure": op5_pii_disclosure,
    "op6_language_bigru": op6_language_bigru,
    "op7_tokeniser_fertility": op7_tokeniser_fertility,
    "op8_ngram_jaccard_join": op8_ngram_jaccard_join,
    "op9_spaced_seed_decontamination": op9_spaced_seed_decontamination,
    "op10_bpe_round_trip": op10_bpe_round_trip,
    "op11_feast_whitening": op11_feast_whitening,
    "op12_merkle_descent": op12_merkle_descent,
    "op13_digest_run_merge": op13_digest_run_merge,
}
