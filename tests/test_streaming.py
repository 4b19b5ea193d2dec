"""Stream behaviour: repeats within the delay, re-runs on one checkpoint."""

import datetime as dt
import os
import time

from pyspark.sql import functions as F

from docflow.sinks.collection import read_bucketed
from docflow.streaming.transfer import dedupe_stream, run_to_parquet, stream_transfer

D = dt.datetime
SCHEMA = "id long, ts timestamp_ntz, v int"


def _drop(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(os.path.join(folder, name))


def test_dedupe_drops_repeats_within_delay(spark, out):
    src = os.path.join(out, "in")
    os.makedirs(src)
    # two files, one micro-batch each (maxFilesPerTrigger=1), in name order
    _drop(spark, src, "a", [(1, D(2024, 1, 1, 10), 1), (2, D(2024, 1, 1, 11), 1)])
    time.sleep(1.1)   # files are taken in modification-time order
    _drop(spark, src, "b", [(1, D(2024, 1, 1, 10, 30), 2),     # repeat of key 1, within the delay
                            (3, D(2024, 1, 1, 8), 3),          # behind the watermark, new key: kept
                            (4, D(2024, 1, 1, 12), 4)])
    sink = os.path.join(out, "sink")
    # parquet folders: read the part files inside each written folder
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(src)
    run_to_parquet(dedupe_stream(stream, ["id"], "ts", "1 hour"), sink, os.path.join(out, "ckpt"))
    got = sorted((r["id"], r["v"]) for r in spark.read.parquet(sink).collect())
    assert got == [(1, 1), (2, 1), (3, 3), (4, 4)]


def test_stream_transfer_rerun_is_noop(spark, out):
    src = os.path.join(out, "in")
    os.makedirs(src)
    _drop(spark, src, "a", [(1, D(2024, 1, 1), 1), (2, D(2024, 1, 2), 2)])
    schema = spark.createDataFrame([], SCHEMA).schema

    def run():
        s = spark.readStream.schema(schema).option("recursiveFileLookup", "true") \
            .option("pathGlobFilter", "*.parquet").parquet(src)
        stream_transfer(s, os.path.join(out, "dest"), os.path.join(out, "ckpt"), key="id", ts_col="ts",
                        run_id="s1", buckets=2)

    run()
    first = sorted(tuple(r) for r in read_bucketed(spark, os.path.join(out, "dest")).select("id", "v").collect())
    run()   # same checkpoint: the file was already processed
    again = sorted(tuple(r) for r in read_bucketed(spark, os.path.join(out, "dest")).select("id", "v").collect())
    assert first == again == [(1, 1), (2, 2)]
    _drop(spark, src, "b", [(2, D(2024, 1, 3), 20), (3, D(2024, 1, 3), 3)])
    run()   # new file: key 2 replaced, key 3 added
    final = sorted(tuple(r) for r in read_bucketed(spark, os.path.join(out, "dest")).select("id", "v").collect())
    assert final == [(1, 1), (2, 20), (3, 3)]
    assert read_bucketed(spark, os.path.join(out, "dest")).filter(~F.col("_xfer_id").startswith("s1-")).count() == 0


def test_stream_transfer_natural_key_and_count(spark, out):
    src = os.path.join(out, "in")
    os.makedirs(src)
    _drop(spark, src, "a", [(1, D(2024, 1, 1), 7), (2, D(2024, 1, 2), 7), (3, D(2024, 1, 3), 8)])
    schema = spark.createDataFrame([], SCHEMA).schema
    s = spark.readStream.schema(schema).option("recursiveFileLookup", "true") \
        .option("pathGlobFilter", "*.parquet").parquet(src).withColumn("nk", F.lit(None).cast("string"))
    n = stream_transfer(s, os.path.join(out, "dest"), os.path.join(out, "ckpt"), key="nk", ts_col="ts",
                        run_id="s1", key_fields=["v"], buckets=2)
    got = {r["nk"]: r["id"] for r in read_bucketed(spark, os.path.join(out, "dest")).collect()}
    assert n == 3 and got == {"7": 2, "8": 3}    # newest row per natural key


def test_dedupe_drops_late_rows_two_batches_behind(spark, out):
    src = os.path.join(out, "in")
    os.makedirs(src)
    _drop(spark, src, "a", [(1, D(2024, 1, 1, 10), 1)])
    time.sleep(1.1)
    _drop(spark, src, "b", [(2, D(2024, 1, 1, 15), 1)])
    time.sleep(1.1)
    _drop(spark, src, "c", [(3, D(2024, 1, 1, 8), 1), (4, D(2024, 1, 1, 16), 1)])      # key 3 is late by then
    sink = os.path.join(out, "sink")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(src)
    run_to_parquet(dedupe_stream(stream, ["id"], "ts", "1 hour"), sink, os.path.join(out, "ckpt"))
    assert sorted(r["id"] for r in spark.read.parquet(sink).collect()) == [1, 2, 4]


def test_newest_row_wins_across_batches_and_all_are_counted(spark, out):
    src = os.path.join(out, "in")
    os.makedirs(src)
    for name, rows in (("a", [(1, D(2024, 1, 5), 5), (2, D(2024, 1, 1), 1)]),
                       ("b", [(1, D(2024, 1, 3), 3), (2, D(2024, 1, 2), 2)]),      # key 1: older than stored
                       ("c", [(3, D(2024, 1, 1), 1)])):
        _drop(spark, src, name, rows)
        time.sleep(1.1)
    schema = spark.createDataFrame([], SCHEMA).schema
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true") \
        .option("pathGlobFilter", "*.parquet").parquet(src)
    n = stream_transfer(s, os.path.join(out, "dest"), os.path.join(out, "ckpt"), key="id", ts_col="ts",
                        run_id="s", buckets=2)
    got = sorted((r["id"], r["v"], r["_xfer_id"]) for r in read_bucketed(spark, os.path.join(out, "dest")).collect())
    assert n == 5 and got == [(1, 5, "s-0"), (2, 2, "s-1"), (3, 1, "s-2")]
