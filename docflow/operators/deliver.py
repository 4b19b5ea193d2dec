"""Delivery of rows or files to endpoints with host failover.

Sending is a side effect inside a plan: run the report's action once and
persist the report (re-evaluating it would send again). Delivery is
at-least-once; each request carries its key so an endpoint can drop repeats.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from docflow.functions.jsonrows import row_json
from docflow.operators.numbering import batch_ids
from docflow.session import ship_package

# Wait before the last host's second try, seconds.
LAST_HOST_RETRY_WAIT_S = 1.0

DELIVERED, FAILED = "delivered", "failed"


def assign_host(key: str | Column, n_hosts: int) -> Column:
    """K8: host number in [0, n) from the first 32 bits of md5(key).

    Reproducible (the source client picked at random); the same rule is
    ``('0x' || substr(md5(k), 1, 8))::bigint % n`` in SQL engines.
    """
    col = F.col(key) if isinstance(key, str) else key
    return (F.conv(F.substring(F.md5(col.cast("string")), 1, 8), 16, 10).cast("long")
            % F.lit(n_hosts)).cast("int")


def report_schema(id_field: StructField) -> StructType:
    return StructType([
        StructField(id_field.name, id_field.dataType),
        StructField("target", StringType()),
        StructField("host", StringType()),
        StructField("status", StringType()),
        StructField("attempts", IntegerType()),
        StructField("error", StringType()),
    ])


def send_with_failover(transport, hosts: Sequence[str], start: int, target: str, body,
                       key: str, wait_s: float) -> tuple[str, str, int, str | None]:
    """K9: try hosts from ``start`` in ring order, dropping each that fails.

    The last remaining host gets one more try after ``wait_s``; so a request
    makes at most ``len(hosts) + 1`` attempts. Returns (host, status,
    attempts, last error).
    """
    remaining = [hosts[(start + i) % len(hosts)] for i in range(len(hosts))]
    attempts = 0
    while True:
        host = remaining[0]
        attempts += 1
        try:
            transport.send(host, target, body, key, attempts)
            return host, DELIVERED, attempts, None
        except Exception:  # noqa: BLE001 - any transport failure
            if len(remaining) > 1:
                remaining.pop(0)
                continue
            if wait_s:
                time.sleep(wait_s)
            attempts += 1
            try:
                transport.send(host, target, body, key, attempts)
                return host, DELIVERED, attempts, None
            except Exception as exc2:  # noqa: BLE001
                return host, FAILED, attempts, f"{type(exc2).__name__}: {exc2}"


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """The rows dealt evenly over ``partitions`` tasks; as they are without it."""
    return df.repartition(int(partitions)) if partitions else df


def deliver(df: DataFrame, *, id_col: str, target_col: str, body_col: str,
            hosts: Sequence[str], transport_factory: Callable[[], object],
            partitions: int | None = None, retry_wait_s: float = LAST_HOST_RETRY_WAIT_S,
            fail_on_error: bool = False) -> DataFrame:
    """Send each row's body from the executors; one report row each.

    One transport per task (built by ``transport_factory`` on the executor).
    A failed row is reported, not raised, unless ``fail_on_error``.
    ``partitions`` spreads the rows over that many tasks; by default the
    input's own partitioning is kept, so bodies are not shuffled. The key's
    text and first host are computed before rows reach Python, so a null id is
    sent like any other (its key is empty) and other ids keep their exact text.
    """
    hosts = list(hosts)
    if not hosts:
        raise ValueError("deliver needs at least one host")
    ship_package(df.sparkSession)
    src = df.select(F.col(id_col), F.col(target_col).alias("_target"),
                    F.col(body_col).alias("_body"), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_key"))
    src = src.withColumn("_start", assign_host("_key", len(hosts)))
    src = spread(src, partitions)
    schema = report_schema(df.schema[id_col])
    # ids travel as text and take their type again afterwards (pandas has no null integers)
    text_schema = report_schema(StructField(id_col, StringType()))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        transport = transport_factory()
        try:
            for pdf in batches:
                rows = []
                for rid, key, target, body, start in zip(pdf[id_col], pdf["_key"], pdf["_target"], pdf["_body"],
                                                         pdf["_start"]):
                    host, status, attempts, err = send_with_failover(
                        transport, hosts, int(start), target, body, key, retry_wait_s)
                    if status == FAILED and fail_on_error:
                        raise RuntimeError(f"delivery of {key} failed after {attempts} attempts: {err}")
                    rows.append((rid, target, host, status, attempts, err))
                yield pd.DataFrame(rows, columns=[f.name for f in text_schema.fields])
        finally:
            close = getattr(transport, "close", None)
            if close:
                close()

    sent = src.withColumn(id_col, F.col(id_col).cast("string")).mapInPandas(run, text_schema)
    return sent.withColumn(id_col, F.col(id_col).cast(schema[id_col].dataType))


def meter_by_host(report: DataFrame, docs_col: str | None = None) -> DataFrame:
    """Per host that ended a request, the documents delivered and failed and the request's attempts.

    A request counts as ``docs_col`` documents (a batch of n counts n), as one
    without it. ``attempts`` are those of the requests that ended at the host,
    tries at hosts before it included.
    """
    docs = F.col(docs_col) if docs_col else F.lit(1)
    return report.groupBy("host").agg(
        F.coalesce(F.sum(F.when(F.col("status") == DELIVERED, docs)), F.lit(0)).cast("long").alias("delivered"),
        F.coalesce(F.sum(F.when(F.col("status") == FAILED, docs)), F.lit(0)).cast("long").alias("failed"),
        F.sum("attempts").cast("long").alias("attempts"))


def write_batches_by_host(batches: DataFrame, path: str, hosts: Sequence[str], key_col: str = "batch",
                          body_col: str = "body") -> DataFrame:
    """K7/K8 into a shared folder: each batch's body as a line of text in its host's sub-folder.

    Returns what was written, read back: host number, batch key and body. The
    folder is the hand-over to a host that takes files rather than requests.
    """
    hosts = list(hosts)
    placed = batches.select(assign_host(key_col, len(hosts)).alias("host"),
                            F.to_json(F.struct(F.col(key_col).alias("batch"), F.col(body_col).alias("body")))
                            .alias("value"))
    placed.write.partitionBy("host").text(path)
    names = F.array(*[F.lit(h) for h in hosts])
    line = F.from_json("value", "batch string, body string")
    return (batches.sparkSession.read.text(path)
            .select(F.element_at(names, F.col("host").cast("int") + 1).alias("host"), line.alias("l"))
            .select("host", "l.batch", "l.body"))


def json_batches(df: DataFrame, group_col: str, order_col: str, batch_size: int,
                 cols: Sequence[str] | None = None) -> DataFrame:
    """K7: rows in batches of ``batch_size`` by ``order_col`` within each group.

    One output row per batch: group, batch_id, rows, first_id, last_id and
    ``docs`` (array of JSON texts in order). Batch numbering stays parallel
    when one group holds most rows (see ``numbering``). Null groups and null
    order values are batched like others; ids may be of any type that sorts.
    """
    numbered = batch_ids(df, [group_col], order_col, batch_size)
    doc = row_json(df, cols)
    return (numbered.groupBy(group_col, "batch_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(order_col).alias("first_id"),
        F.max(order_col).alias("last_id"),
        F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("o"), doc.alias("j")))).alias("_docs"))
        .withColumn("docs", F.transform("_docs", lambda x: x["j"]))
        .drop("_docs"))


def batch_body(docs_col: str = "docs") -> Column:
    """A JSON array text from an array of JSON object texts."""
    return F.concat(F.lit("["), F.array_join(F.col(docs_col), ","), F.lit("]"))
