"""Incremental and full transfer of a collection into another.

Order of work, each step a DataFrame function:
watermark of the destination (A2) -> new-row filter (A3) -> count of new rows
(A4, stop if none) -> filtered scan (S4/S6) -> natural key (E1) -> latest row
per key (W1) -> run tag (E2) -> bucketed upsert (K1/K5) -> optional
compaction (K4) -> count of rows carrying the tag (A5) -> report (R4).
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from docflow.functions.keys import with_natural_key
from docflow.functions.predicates import all_of
from docflow.operators.counts import Mark, count_new, later, mark_text, new_rows_filter
from docflow.operators.latest import latest_per_key
from docflow.session import hadoop_fs, shared_dir
from docflow.sinks.collection import (DEFAULT_BUCKETS, compact, read_bucketed, stored_count, stored_newest, upsert_path)
from docflow.sources.collection import read_collection

TAG_COL = "_xfer_id"
# Run log inside the destination folder; the leading "_" hides it from the
# Parquet reader of the collection itself.
LOG_DIR = "_xfer_log"

REPORT_SCHEMA = StructType([
    StructField("run_id", StringType()),
    StructField("found", LongType()),
    StructField("written", LongType()),
    StructField("before", LongType()),
    StructField("after", LongType()),
    StructField("elapsed_ms", LongType()),
    StructField("lost", LongType()),
])


@dataclass
class TransferResult:
    run_id: str
    found: int
    written: int
    before: int
    after: int
    elapsed_ms: int
    lost: int = 0
    """Rows that the run wrote and that are not there when it counts them (0 unless files are lost)."""

    def to_df(self, spark: SparkSession) -> DataFrame:
        """The run report as a one-row DataFrame."""
        return one_row(spark, asdict(self), REPORT_SCHEMA)


def one_row(spark: SparkSession, values: dict, schema: StructType) -> DataFrame:
    """A one-row DataFrame of literals, built in the JVM (no Python rows)."""
    return spark.range(1).select(*[F.lit(values[f.name]).cast(f.dataType).alias(f.name)
                                   for f in schema.fields])


def tag_rows(df: DataFrame, run_id: str, tag_col: str = TAG_COL) -> DataFrame:
    """Every row carries the run's id."""
    return df.withColumn(tag_col, F.lit(run_id))


def transfer_delta(source: DataFrame, *, ts_col: str, newest_ts=None, as_of=None,
                   new_only: bool = True, where: str | Column | None = None,
                   key: str = "id", key_fields: Sequence[str] = (),
                   tiebreak: Sequence[str] = (), run_id: str,
                   tag_col: str = TAG_COL, dedupe: bool = True, observed: Observation | None = None) -> DataFrame:
    """The rows one run writes, keyed and tagged (lazy; nothing is read yet).

    With ``new_only`` the rows are ``newest_ts < ts <= as_of``; without it,
    every row matching ``where`` (null and future timestamps included).
    Rows sharing a key (natural-key collisions, or a repeated ``key``)
    keep the newest by ``ts_col`` then ``tiebreak``, as the last write of a
    key wins at the destination. ``dedupe=False`` skips that aggregation
    when the keys are known to be unique (e.g. a full copy of a keyed
    collection), saving a shuffle of the delta. ``observed`` takes ``found``,
    ``nulls`` (rows without a key) and ``newest`` (text of the newest
    timestamp) over the rows before those of one key are merged.
    """
    dtype = dict(source.dtypes)[ts_col]
    window = new_rows_filter(ts_col, newest_ts, as_of, dtype) if new_only else None
    df = source.filter(all_of(where, window))
    if key_fields:
        df = with_natural_key(df, key_fields, key)
    if observed is not None:
        df = df.observe(observed, F.count(F.lit(1)).alias("found"), F.count_if(F.col(key).isNull()).alias("nulls"),
                        mark_text(F.max(ts_col), dtype).alias("newest"))
    if dedupe or key_fields:
        df = latest_per_key(df, [key], [ts_col, *tiebreak])
    return tag_rows(df, run_id, tag_col)


def _log_path(destination: str) -> str:
    return f"{destination.rstrip('/')}/{LOG_DIR}"


def _mark_json(m: Mark | None) -> dict | None:
    return None if m is None else asdict(m)


def _mark(entry: dict | None) -> Mark | None:
    return None if entry is None else Mark(**entry)


def last_run(spark: SparkSession, destination: str) -> dict | None:
    """The newest run-log entry of a destination, or None.

    Entries are small JSON files named by a zero-padded sequence number, so
    the newest is the greatest name; a listing and one small read, no job.
    """
    fs, log = hadoop_fs(spark, _log_path(destination))
    if not fs.exists(log):
        return None
    names = [st.getPath().getName() for st in fs.listStatus(log)]
    names = [n for n in names if n.endswith(".json") and not n.startswith((".", "_"))]
    if not names:
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(jvm.org.apache.hadoop.fs.Path(log, max(names)))
    try:
        text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def _log(spark: SparkSession, destination: str, run_id: str, state: str, used, after) -> None:
    """Append one run-log entry (a small JSON file written on the driver)."""
    entry = {"run_id": run_id, "seq": time.time_ns() // 1000, "state": state,
             "watermark_used": _mark_json(used), "watermark_after": _mark_json(after)}
    fs, log = hadoop_fs(spark, _log_path(destination))
    jvm = spark.sparkContext._jvm
    out = fs.create(jvm.org.apache.hadoop.fs.Path(log, f"{entry['seq']:020d}-{state}.json"), False)
    try:
        out.write(bytearray(json.dumps(entry).encode("utf-8")))
    finally:
        out.close()


def resume_watermark(last: dict | None, dest_newest):
    """The low bound of the next run, from the newest run-log entry ``last``.

    With no run log: the newest timestamp of the destination (A2). After a
    committed run: the later of the watermark it recorded and the newest
    timestamp stored (rows by other writers, streams included, count). After
    a run that started but never committed: the watermark that run used, so
    its rows are sent again (the keyed upsert makes the repeat harmless) and
    none is skipped.
    """
    if last is None:
        return dest_newest
    if last["state"] == "started":
        return _mark(last["watermark_used"])
    return later(_mark(last["watermark_after"]), dest_newest)


def _remove(spark: SparkSession, path: str) -> None:
    """Delete a stage folder of this run (its name is unique to the run)."""
    fs, jpath = hadoop_fs(spark, path)
    fs.delete(jpath, True)


def run_transfer(spark: SparkSession, source: DataFrame | str, destination: str, *,
                 ts_col: str = "timestamp_tdt", key: str = "id",
                 where: str | Column | None = None, new_only: bool = True, as_of=None,
                 key_fields: Sequence[str] = (), tiebreak: Sequence[str] = (),
                 batch_size: int | None = None, compact_to: int = 0,
                 splits: int | None = None, run_id: str | None = None,
                 tag_col: str = TAG_COL, buckets: int = DEFAULT_BUCKETS,
                 dedupe: bool = True, verbose: bool = False) -> TransferResult:
    """Copy the new (or all) rows of ``source`` into ``destination``.

    ``destination`` is a bucketed Parquet collection (created on first use).
    ``as_of`` is "now" (an instant taken once) unless given; a datetime without
    a zone is read in the session's zone, and columns without a zone hold UTC.
    The delta is staged as Parquet in the shared folder before writing, so
    every write step sees the same rows even if the source grows meanwhile or
    an executor is lost; it is removed after the run. Rows without a key are
    an error before anything is written. With nothing new, nothing is written
    (found = written = 0). ``found`` is observed on the rows read while they
    are staged, ``written`` counted in the stored files afterwards, and
    ``lost`` is what should be there and is not. Files at rest are sized by bytes; ``batch_size``
    also caps their rows (K2). A run log (``_xfer_log``) makes a failed run
    restartable: see :func:`resume_watermark`. ``splits`` asks for at least so
    many scan tasks (by smaller scan splits, not by a shuffle).

    The watermark is the newest timestamp over all destination rows,
    whatever ``where`` selects: narrowing ``where`` later does not pick up
    older rows. The low bound is exclusive, so a late row stamped at or
    before the watermark is not sent by a later run.
    """
    t0 = time.monotonic()
    run_id = run_id or str(uuid.uuid4())
    src = read_collection(spark, source, splits=splits) if isinstance(source, str) else source
    if verbose:
        for k, v in sorted(spark.sparkContext.getConf().getAll()):
            print(f"{k}={v}")
        src.printSchema()
    logged = last_run(spark, destination) if new_only else None
    before = stored_count(spark, destination)               # from the file entries
    dest_newest = stored_newest(spark, destination, ts_col) if new_only and before else None     # A2, from the zone maps

    newest_ts = None
    if new_only:
        if as_of is None:
            as_of = dt.datetime.now(dt.timezone.utc)
        newest_ts = resume_watermark(logged, dest_newest)
        found = count_new(src, ts_col, newest_ts, as_of, where)
        if found == 0:
            return TransferResult(run_id, 0, 0, before, before, int((time.monotonic() - t0) * 1000))
    counted = Observation()
    delta = transfer_delta(src, ts_col=ts_col, newest_ts=newest_ts, as_of=as_of, new_only=new_only,
                           where=where, key=key, key_fields=key_fields, tiebreak=tiebreak,
                           run_id=run_id, tag_col=tag_col, dedupe=dedupe, observed=counted)
    # Merging takes several passes over the delta (keys, buckets, rewrite,
    # append), and each reads only the columns it needs of the staged rows.
    stage = shared_dir(spark, "delta")
    delta.write.parquet(stage)
    seen = counted.get
    delta = spark.read.schema(delta.schema).parquet(stage)
    if seen["nulls"]:
        _remove(spark, stage)
        raise ValueError(f"{seen['nulls']} rows have no {key}; give key_fields or filter them out")
    mine = None if seen["newest"] is None else Mark(dict(src.dtypes)[ts_col], seen["newest"])
    _log(spark, destination, run_id, "started", newest_ts, None)
    written_buckets = upsert_path(spark, destination, delta, key, buckets=buckets, batch_size=batch_size,
                                  frozen=True)
    if compact_to > 0:
        # only the buckets this run wrote gained files
        compact(spark, destination, compact_to, key=key, only_buckets=written_buckets)
    # A5: rows with this run's tag can only be in the buckets it wrote, so only
    # their files are read; a file that is gone counts as no rows here.
    stored = read_bucketed(spark, destination, buckets=written_buckets, adds=False, lost_files=True)
    written = stored.filter(F.col(tag_col) == F.lit(run_id)).count()
    expected = delta.count()                                # footers of the stage: found, less the merged rows
    after = stored_count(spark, destination)
    # a run that lost rows stays "started": the next one sends them again
    if written == expected:
        _log(spark, destination, run_id, "committed", newest_ts, later(newest_ts, mine))
    _remove(spark, stage)
    return TransferResult(run_id, int(seen["found"]), int(written), int(before), int(after),
                          int((time.monotonic() - t0) * 1000), int(expected - written))
