"""Directory and table delivery jobs (R5), and the ledger that makes them resumable.

The ledger is a stored collection (request key, digest of what was sent, run).
A job sends the anti-join of its requests with it and then enters what was
delivered, so a second hand-over of the same rows sends nothing and a changed
row is sent alone. Entries are made after the sending: a job that dies in
between sends the requests it had not entered again (at least once).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.functions.urls import request_target
from docflow.operators.deliver import (DELIVERED, FAILED, LAST_HOST_RETRY_WAIT_S, batch_body, deliver,
                                      json_batches, meter_by_host, write_batches_by_host)
from docflow.operators.transports import HttpTransport
from docflow.session import shared_dir
from docflow.sinks.collection import collection_exists, read_bucketed, upsert_path
from docflow.sources.files import read_files

DEFAULT_HOST = "http://localhost:8764"
SKIPPED = "skipped"


def build_requests(df: DataFrame, *, id_col: str, path_col: str, body_col: str, pipeline: str,
                   collection: str, parser: str | None = None) -> DataFrame:
    """Id, request target (path form-encoded as content source), body."""
    return df.select(F.col(id_col), request_target(path_col, pipeline, collection, parser).alias("target"),
                     F.col(body_col).alias("body"))


LEDGER_BUCKETS = 64


def content_digest(*columns: str) -> Column:
    """SHA-256 over the columns, each with its length, so that no two contents run together."""
    part = lambda c: F.coalesce(F.concat(F.octet_length(F.col(c).cast("binary")).cast("string"), F.lit(":"),
                                         F.sha2(F.col(c).cast("binary"), 256)), F.lit("-"))
    return F.sha2(F.concat(*[part(c) for c in columns]).cast("binary"), 256)


def unsent(requests: DataFrame, ledger: str, key_col: str, content_cols: Sequence[str]) -> DataFrame:
    """``requests`` that the ledger does not hold with this content, with their ``_digest``.

    Only keys and digests meet the ledger; a null key is the empty key.
    """
    spark = requests.sparkSession
    mine = requests.withColumn("_digest", content_digest(*content_cols)).withColumn(
        "_sent_key", F.coalesce(F.col(key_col).cast("string"), F.lit("")))
    if not collection_exists(spark, ledger):
        return mine
    entered = read_bucketed(spark, ledger).select(F.col("key").alias("_k"), F.col("digest").alias("_d"))
    return mine.join(entered, (F.col("_sent_key") == F.col("_k")) & (F.col("_digest") == F.col("_d")), "left_anti")


def enter(ledger: str, sent: DataFrame, run_id: str) -> None:
    """Enter requests (``_sent_key``, ``_digest``) as delivered by ``run_id``; a key's newest content stands."""
    rows = sent.groupBy(F.col("_sent_key").alias("key")).agg(F.max("_digest").alias("digest"))
    upsert_path(sent.sparkSession, ledger, rows.withColumn("run", F.lit(run_id)), "key", buckets=LEDGER_BUCKETS)


def hand_over(batches: DataFrame, path: str, hosts: Sequence[str], ledger: str, run_id: str, *, key_col: str = "batch",
              body_col: str = "body") -> DataFrame:
    """K7/K8 with a ledger: the batches not handed over yet, written to their host's sub-folder and read back.

    They are staged first, so what is entered is what was written.
    """
    spark = batches.sparkSession
    stage = shared_dir(spark, "unsent")
    unsent(batches.select(F.col(key_col).alias("batch"), F.col(body_col).alias("body")), ledger, "batch", ["body"]).write.parquet(stage)
    new = spark.read.parquet(stage)
    if new.isEmpty():
        return spark.createDataFrame([], "host string, batch string, body string")
    back = write_batches_by_host(new.select("batch", "body"), path, hosts)
    enter(ledger, new, run_id)
    return back


@dataclass
class DeliveryResult:
    found: int
    delivered: int
    failed: int
    report: DataFrame
    meter: DataFrame


def run_delivery(spark: SparkSession, path: str, collection: str, *, pipeline: str | None = None,
                 parser: str | None = None, hosts: Sequence[str] = (DEFAULT_HOST,),
                 transport_factory: Callable[[], object] = HttpTransport,
                 partitions: int | None = None, glob: str | None = None,
                 max_bytes: int | None = None, recursive: bool = False, retry_wait_s: float = LAST_HOST_RETRY_WAIT_S,
                 fail_on_error: bool = False, report_path: str | None = None,
                 ledger: str | None = None, run_id: str = "") -> DeliveryResult:
    """Send every file of a directory to the indexing endpoint.

    Files are listed and read by ``binaryFile`` on the executors; one
    request per file, one report row per file. The report is computed by a
    single action and written to ``report_path`` (default: a new folder under
    the shared checkpoint folder), so neither counting it nor losing an
    executor makes Spark recompute the plan and send the files again. With a
    ``ledger`` only files that it does not hold with this content are sent
    (``found`` counts those), and the delivered ones are entered.
    """
    files = read_files(spark, path, glob=glob, recursive=recursive)
    skipped = None
    if max_bytes is not None:
        # A file over the limit is not sent, but it is found and reported.
        skipped = files.where(F.col("length") > max_bytes).select(
            "path", F.lit(None).cast("string").alias("target"), F.lit(None).cast("string").alias("host"),
            F.lit(SKIPPED).alias("status"), F.lit(0).alias("attempts"),
            F.concat(F.lit("over the size limit: "), F.col("length").cast("string"), F.lit(" bytes")).alias("error"))
        files = files.where(F.col("length") <= max_bytes)
    requests = build_requests(files, id_col="path", path_col="path", body_col="content",
                              pipeline=pipeline or collection, collection=collection,
                              parser=parser or collection)
    if ledger is not None:
        requests = unsent(requests, ledger, "path", ["target", "body"])
        digests = shared_dir(spark, "digests")
        requests.select("path", "_sent_key", "_digest").write.parquet(digests)
        requests = requests.join(spark.read.parquet(digests).select("path"), "path", "left_semi")
    report = deliver(requests, id_col="path", target_col="target", body_col="body", hosts=hosts,
                     transport_factory=transport_factory, partitions=partitions,
                     retry_wait_s=retry_wait_s, fail_on_error=fail_on_error)
    report_path = report_path or shared_dir(spark, "delivery-report")
    report.write.mode("overwrite").parquet(report_path)
    if skipped is not None:
        skipped.write.mode("append").parquet(report_path)
    report = spark.read.parquet(report_path)
    if ledger is not None:
        arrived = report.where(F.col("status") == DELIVERED).select("path")
        enter(ledger, spark.read.parquet(digests).join(arrived, "path", "left_semi"), run_id)
    counts = report.agg(F.count(F.lit(1)).alias("n"),
                        F.count(F.when(F.col("status") == DELIVERED, 1)).alias("ok"),
                        F.count(F.when(F.col("status") == FAILED, 1)).alias("bad")).first()
    return DeliveryResult(found=counts["n"], delivered=counts["ok"], failed=counts["bad"],
                          report=report, meter=meter_by_host(report))


def batch_key(group_col: str):
    """``<group>-<batch_id>``; a null group gives ``-<batch_id>``."""
    return F.concat(F.coalesce(F.col(group_col).cast("string"), F.lit("")), F.lit("-"),
                    F.col("batch_id").cast("string"))


def deliver_json_batches(df: DataFrame, *, group_col: str, order_col: str, batch_size: int,
                         target: str, hosts: Sequence[str], transport_factory: Callable[[], object],
                         retry_wait_s: float = LAST_HOST_RETRY_WAIT_S) -> DataFrame:
    """K7: send rows as JSON arrays of ``batch_size`` documents, one request per batch.

    Report rows are keyed by ``<group>-<batch_id>`` (also the idempotency key).
    """
    batches = json_batches(df, group_col, order_col, batch_size)
    requests = batches.select(
        batch_key(group_col).alias("batch"),
        F.lit(target).alias("target"), batch_body("docs").alias("body"))
    return deliver(requests, id_col="batch", target_col="target", body_col="body", hosts=hosts,
                   transport_factory=transport_factory, retry_wait_s=retry_wait_s)
