"""Incremental transfer and key dedupe as Structured Streaming.

The stream's checkpoint replaces the destination watermark of the batch job:
files already processed are not read again. ``availableNow`` processes what
is there and stops, so a scheduled run behaves like the batch job.
``foreachBatch`` is at-least-once; each micro-batch is written with the keyed
upsert, so replaying a batch rewrites the same rows (idempotent).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docflow.functions.keys import with_natural_key
from docflow.functions.predicates import all_of, range_
from docflow.plans.transfer import TAG_COL, tag_rows
from docflow.session import hadoop_fs, shared_dir
from docflow.sinks.collection import DEFAULT_BUCKETS, collection_exists, read_bucketed, upsert_path
from docflow.operators.latest import latest_per_key


def file_stream(spark: SparkSession, folder: str, schema: StructType, *, glob: str | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet file stream over a folder (a glob picks the files)."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.parquet(folder)


def stream_transfer(stream: DataFrame, destination: str, checkpoint: str, *, key: str,
                    ts_col: str, run_id: str, newest_ts=None, as_of=None,
                    where: str | Column | None = None, order: Sequence[str] = (),
                    key_fields: Sequence[str] = (),
                    buckets: int = DEFAULT_BUCKETS, tag_col: str = TAG_COL) -> int:
    """Upsert every new row of ``stream`` into the bucketed ``destination``.

    Optional ``newest_ts``/``as_of`` bound the rows like the batch job; note
    that the checkpoint marks a file done once read, so rows of it outside
    the bounds are not picked up by a later run (leave the bounds unset for
    a stream that should take every row once). With ``key_fields`` the key
    column is overwritten by the natural key (E1), as in the batch job.
    Each micro-batch keeps the newest row per key, and drops rows older than
    the stored row of their key, before the upsert; so rows that arrive in a
    later batch with an older time replace nothing. The tag is
    ``<run_id>-<batch id>``. Runs to completion (``availableNow``) and returns
    the rows that all its micro-batches received within the bounds, counted
    in each batch (null keys are an error, as in the batch job).
    """
    dtype = dict(stream.dtypes)[ts_col]
    bounded = stream.filter(all_of(where, range_(ts_col, lo=newest_ts, hi=as_of, dtype=dtype)
                                   if (newest_ts is not None or as_of is not None) else None))
    keyed = with_natural_key(bounded, key_fields, key)
    received: dict[int, int] = {}

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stage = shared_dir(spark, "micro-batch")
        batch.write.parquet(stage)                          # one read of the input, whatever follows
        rows = spark.read.schema(batch.schema).parquet(stage)
        n, with_key = rows.agg(F.count(F.lit(1)), F.count(key)).first()
        if n > with_key:
            raise ValueError(f"{n - with_key} rows have no {key}; give key_fields or filter them out")
        received[batch_id] = n
        newest = tag_rows(latest_per_key(rows, [key], [ts_col, *order]), f"{run_id}-{batch_id}", tag_col)
        if collection_exists(spark, destination):
            mine = newest.select(F.pmod(F.xxhash64(key), F.lit(buckets)).alias("b")).distinct()
            stored = read_bucketed(spark, destination, buckets=[r.b for r in mine.collect()])
            older = newest.alias("n").join(stored.select(F.col(key), F.col(ts_col).alias("_stored")).alias("s"), key)
            newest = newest.join(older.where(F.col("_stored") > F.col(ts_col)).select(key), key, "left_anti")
        upsert_path(spark, destination, newest, key, buckets=buckets)
        fs, folder = hadoop_fs(spark, stage)
        fs.delete(folder, True)

    q = (keyed.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return sum(received.values())


def dedupe_stream(stream: DataFrame, keys: Sequence[str], ts_col: str, delay: str,
                  event_col: str = "_event_time") -> DataFrame:
    """Drop rows whose key was already seen within ``delay`` of event time.

    ``withWatermark`` needs a zoned timestamp, so a ``timestamp_ntz`` event
    column is cast (session time zone) into ``event_col`` and dropped after.
    Keys are kept in state until the watermark passes their event time plus
    ``delay``; a repeat arriving in that span is dropped. The watermark moves
    between micro-batches: a row that is older than the watermark in force
    when its batch runs is dropped as late, whether its key was seen or not.
    """
    dtype = dict(stream.dtypes)[ts_col]
    ev = F.col(ts_col).cast("timestamp") if dtype == "timestamp_ntz" else F.col(ts_col)
    return (stream.withColumn(event_col, ev)
            .withWatermark(event_col, delay)
            .dropDuplicatesWithinWatermark(list(keys))
            .drop(event_col))


NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def _start(spark: SparkSession, writer, conf: dict[str, str]):
    """Start a query with session settings that the query reads once at
    start; the session's own values are put back right after."""
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        return writer.start()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def run_to_parquet(stream: DataFrame, path: str, checkpoint: str, *,
                   final_eviction_batch: bool = False) -> None:
    """Append a stream to Parquet until the input is drained (availableNow).

    After the data, Spark would run one more batch without data only to
    evict state the watermark has passed; rows are already emitted (append
    mode), so by default that batch is skipped and the next run's first
    batch evicts instead.
    """
    writer = (stream.writeStream.format("parquet").option("path", path)
              .option("checkpointLocation", checkpoint).outputMode("append")
              .trigger(availableNow=True))
    conf = {} if final_eviction_batch else {NO_DATA_BATCHES: "false"}
    q = _start(stream.sparkSession, writer, conf)
    q.awaitTermination()
