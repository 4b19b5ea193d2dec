"""Writing collections (K1-K5).

A destination collection at rest is a folder of Parquet files, each holding
rows of one hash bucket of the key (column ``_b``), and a snapshot that says
which files count (see :mod:`docflow.sinks.manifest`). Bucket count, key, key
types and schema are part of the snapshot. A write with another bucket count
or key type is refused: its rows would land in other buckets and never meet
their keys.

An upsert finds the files that may hold its keys by bucket, key range and
Bloom filter, reads their key column, and writes anew only the files that do
hold one, together with the new rows; one commit swaps the files. A writer
that finds its buckets changed meanwhile starts over from the new snapshot.

Adds (values to append to stored arrays, J2) are logged as files of their own
beside the rows: a read merges them, and :func:`fold_adds` writes them into
the files that hold their keys. Files put below a collection by other writers
are read as rows too, and are taken in by the next write.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from docflow.operators.counts import later, newest_mark
from docflow.operators.upsert import atomic_add, upsert
from docflow.session import hadoop_fs, shared_dir
from docflow.sinks import manifest
from docflow.sinks.manifest import BUCKET_COL, Conflict, Snapshot, Written, snapshot

# Bucket count of a new destination: aim for buckets of a few GB (about 4,096
# for 10 TB). Never change it for an existing destination.
DEFAULT_BUCKETS = 512
DEFAULT_BATCH_ROWS = 10_000
# Target rows / bytes one write task handles.
DEFAULT_ROWS_PER_TASK = 2_000_000
DEFAULT_FILE_BYTES = 256 * 1024 * 1024
SALT_SEED = 17
# Update keys of up to so many bytes (text and row overhead, summed exactly)
# are broadcast to the existence check and the anti-join, so stored rows are
# not shuffled.
BROADCAST_KEY_BYTES = 64 * 1024 * 1024
KEY_OVERHEAD_BYTES = 48
#: A write that meets another one in its buckets starts over so often.
MOST_TRIES = 20


def bucket_of(key: str | Sequence[str], buckets: int):
    keys = [key] if isinstance(key, str) else list(key)
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def _drop(spark: SparkSession, path: str) -> None:
    fs, jpath = hadoop_fs(spark, path)
    fs.delete(jpath, True)


def _described(snap: Snapshot | None, path: str, rows: DataFrame, keys: Sequence[str], buckets: int,
               stored: DataFrame | None = None) -> dict:
    """The collection's description with the new columns of ``rows``, after a check against the stored one."""
    types = [dict(rows.dtypes)[k] for k in keys]
    if snap is not None:
        for name, mine in (("buckets", buckets), ("key", list(keys)), ("key_types", types)):
            if snap.table[name] != mine:
                raise ValueError(f"{path} was written with {name} {snap.table[name]}, not {mine}")
        first = StructType.fromJson(snap.table["schema"]).fields
    else:
        first = [f for f in (stored.schema.fields if stored is not None else []) if f.name != BUCKET_COL]
    names = {f.name for f in first}
    fresh = [f for f in rows.schema.fields if f.name != BUCKET_COL and f.name not in names]
    described = {"buckets": buckets, "key": list(keys), "key_types": types,
                 "schema": StructType([*first, *fresh]).jsonValue()}
    return (snap.table | described) if snap is not None else described


def collection_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds rows: a snapshot, or files of other writers.

    (A run log alone, such as ``_xfer_log``, does not make a collection.)
    """
    if manifest.newest_number(spark, path):
        return True
    fs, jpath = hadoop_fs(spark, path)
    return bool(fs.exists(jpath)) and any(_visible(st.getPath().getName()) for st in fs.listStatus(jpath))


def _visible(name: str) -> bool:
    # Spark's own rule: "_" and "." names are hidden, but "_b=3" is a partition.
    return not name.startswith(".") and (not name.startswith("_") or "=" in name)


def write_collection(df: DataFrame, path: str, *, mode: str = "append",
                     batch_size: int = DEFAULT_BATCH_ROWS,
                     partition_by: Sequence[str] = ()) -> None:
    """K1-K3: write rows; each file holds at most ``batch_size`` rows.

    Rows become visible when the job commits (file output committer).
    "overwrite" replaces the whole collection, partitioned or not, whatever
    the session's overwrite mode is.
    """
    w = df.write.mode(mode).option("partitionOverwriteMode", "static").option("maxRecordsPerFile", int(batch_size))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


# ---- reading -------------------------------------------------------------------


def _rows_of(spark: SparkSession, path: str, snap: Snapshot, names: Sequence[str], lost_files: bool = False) -> DataFrame:
    """The rows of some data files (full names), with the columns of the snapshot's schema and ``_b``."""
    reader = spark.read.schema(snap.schema())
    if lost_files:
        fs, _ = hadoop_fs(spark, path)
        jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        names = [n for n in names if fs.exists(jpath(n))]
        reader = reader.option("ignoreMissingFiles", "true")
    return reader.parquet(*names) if names else spark.createDataFrame([], snap.schema())


def _foreign_rows(spark: SparkSession, snap: Snapshot, names: Sequence[str]) -> DataFrame:
    """Rows of files by other writers; columns they lack are null, and the bucket follows from the key."""
    schema = StructType.fromJson(snap.table["schema"])
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*names)
    return rows.withColumn(BUCKET_COL, bucket_of(snap.table["key"], snap.table["buckets"]))


def read_bucketed(spark: SparkSession, path: str, *, buckets: Sequence[int] | None = None, adds: bool = True,
                  lost_files: bool = False) -> DataFrame:
    """A stored collection as its newest snapshot has it, with the bucket number in ``_b``.

    ``buckets`` names the only buckets wanted, and only their files are given
    to the reader. Logged adds are merged unless ``adds`` is False; rows of
    files by other writers are included. ``lost_files`` reads what is left if
    files of the snapshot are missing (for a count that is to notice it). A
    folder that no write of ours has described is read as it is.
    """
    snap = snapshot(spark, path)
    if snap is None:
        return spark.read.option("mergeSchema", "true").parquet(path)
    chosen = snap.files if buckets is None else snap.files.where(F.col("bucket").isin(list(buckets)))
    data = chosen.where("kind = 'data'")
    logged = chosen.where("kind = 'adds'")
    waiting = sorted(r[0] for r in logged.select("bucket").distinct().collect()) if adds and snap.has_adds else []
    if waiting:
        inside = F.col("bucket").isin(waiting)
        under = _rows_of(spark, path, snap, manifest.paths(path, data.where(inside)), lost_files)
        merged = _with_adds(snap, under, _adds(spark, path, snap, logged))
        rows = _rows_of(spark, path, snap, manifest.paths(path, data.where(~inside)), lost_files).unionByName(merged)
    else:
        rows = _rows_of(spark, path, snap, manifest.paths(path, data), lost_files)
    names = manifest.foreign_files(spark, path, snap)
    if names:
        foreign = _foreign_rows(spark, snap, names)
        rows = rows.unionByName(foreign if buckets is None else foreign.where(F.col(BUCKET_COL).isin(list(buckets))))
    return rows


def stored_count(spark: SparkSession, path: str) -> int:
    """Rows of a collection: from the entries; files of other writers and waiting adds are read."""
    snap = snapshot(spark, path)
    if snap is None:
        return spark.read.option("mergeSchema", "true").parquet(path).count() if collection_exists(spark, path) else 0
    rows, waiting = manifest.stored_rows(snap)
    if waiting:
        return read_bucketed(spark, path).count()
    names = manifest.foreign_files(spark, path, snap)
    return rows + (_foreign_rows(spark, snap, names).count() if names else 0)


def stored_newest(spark: SparkSession, path: str, column: str):
    """A2 at rest: the newest value of ``column``, from the zone maps; only files by other writers are scanned."""
    snap = snapshot(spark, path)
    if snap is None:
        rows = read_bucketed(spark, path)
        return newest_mark(rows, column) if column in rows.columns else None
    types = {f.name: f.dataType.simpleString() for f in snap.schema().fields}
    if column not in types:
        return None
    if types[column] not in manifest.ZONED:
        return newest_mark(read_bucketed(spark, path), column)
    names = manifest.foreign_files(spark, path, snap)
    foreign = newest_mark(_foreign_rows(spark, snap, names), column) if names else None
    return later(manifest.newest_zone(snap, column, types[column]), foreign)


# ---- writing -------------------------------------------------------------------


def _salt(keys: Sequence[str], spread: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(SALT_SEED)), F.lit(int(spread)))


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a plan (no job runs), or None when Spark
    has no real figure (it then reports ``spark.sql.defaultSizeInBytes``,
    e.g. for checkpointed data)."""
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - estimate unavailable
        return None
    unknown = int(df.sparkSession.conf.get("spark.sql.defaultSizeInBytes", str(2 ** 63 - 1)))
    return None if size <= 0 or size >= unknown else size


def _spread(n_buckets: int, rows: int | None = None, stored_bytes: int | None = None,
            rows_per_task: int = DEFAULT_ROWS_PER_TASK, file_bytes: int = DEFAULT_FILE_BYTES) -> int:
    """Tasks (and files) per bucket, from known rows and stored bytes."""
    n = max(1, n_buckets)
    return int(max(1, -(-(rows or 0) // (n * rows_per_task)), -(-(stored_bytes or 0) // (n * file_bytes))))


def _write(spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], n_buckets: int, spread: int, **how) -> Written:
    """Rows into files by (bucket, salt): a big bucket is split over ``spread`` tasks and gets about as many files."""
    return manifest.write_files(spark, path, rows, keys, max(1, n_buckets) * spread, _salt(keys, spread), **how)


def _retried(attempt: Callable[[], list[int]]) -> list[int]:
    """Run ``attempt`` until no other writer comes between."""
    for turn in range(MOST_TRIES):
        try:
            return attempt()
        except Conflict:
            if turn == MOST_TRIES - 1:
                raise
    return []


def _take_in_foreign(spark: SparkSession, path: str, rows: DataFrame, keys: list[str], buckets: int) -> None:
    """Make rows of files by other writers rows of the collection; those files no longer count."""
    def attempt() -> list[int]:
        snap = snapshot(spark, path)
        names = manifest.foreign_files(spark, path, snap)
        if not names:
            return []
        stored = spark.read.option("mergeSchema", "true").parquet(*names) if snap is None else None
        table = _described(snap, path, rows, keys, buckets, stored)
        own = Snapshot(0, {"table": table}, None)
        found = _foreign_rows(spark, own, names)
        size = estimated_bytes(found)
        spread = _spread(buckets, stored_bytes=size)
        new = _write(spark, path, found, keys, buckets, spread)
        removed = spark.createDataFrame([(n,) for n in names], "path string")
        manifest.commit(spark, path, snap, table, op="take in", buckets=new.buckets, added=[new], removed=removed)
        return new.buckets

    _retried(attempt)


def upsert_path(spark: SparkSession, path: str, updates: DataFrame, key: str | Sequence[str], *,
                buckets: int = DEFAULT_BUCKETS, batch_size: int | None = None,
                frozen: bool = False, filters: bool = True) -> list[int]:
    """K5: upsert ``updates`` (one row per key) into the collection at ``path``.

    1. Rows of files by other writers are taken in, adds that wait in touched
       buckets are folded, and bucket count and key types are checked.
    2. A first load has nothing to merge: one pass, then the commit.
    3. Otherwise the updates are staged in the shared folder (unless
       ``frozen``: the caller already did), so every step below sees the same
       rows and reads only the columns it needs.
    4. The files that may hold update keys are found from the entries and
       Bloom filters (``filters=False``: all files of the touched buckets);
       only their key column is read to find those that do.
    5. Rows of these files whose keys are not replaced are written anew,
       together with the updates; one commit swaps the files. Files without
       an update key stay as they are.

    If another writer committed to one of the touched buckets meanwhile, 4 and
    5 are done again on its snapshot. Returns the bucket numbers written
    (empty: nothing was written; a first load reports every bucket number).
    Files are sized by bytes; ``batch_size`` also caps their rows (K2).
    """
    keys = [key] if isinstance(key, str) else list(key)
    _described(snapshot(spark, path), path, updates, keys, buckets)
    _take_in_foreign(spark, path, updates, keys, buckets)
    staged = updates.withColumn(BUCKET_COL, bucket_of(keys, buckets))
    stage = None
    if not frozen and snapshot(spark, path) is not None:
        stage = shared_dir(spark, "updates")
        staged.write.parquet(stage)
        staged = spark.read.schema(staged.schema).parquet(stage)

    def attempt() -> list[int]:
        snap = snapshot(spark, path)
        table = _described(snap, path, updates, keys, buckets)
        if snap is None:
            size = estimated_bytes(staged)
            spread = _spread(buckets, stored_bytes=size) if size is not None else _spread(buckets, rows=staged.count())
            new = _write(spark, path, staged, keys, buckets, spread, batch_size=batch_size)
            manifest.commit(spark, path, None, table, op="load", buckets=range(buckets), added=[new])
            return list(range(buckets))
        return _merge(spark, path, snap, table, staged, keys, batch_size, filters)

    done = _retried(attempt)
    if stage:
        _drop(spark, stage)
    return done


def _merge(spark: SparkSession, path: str, snap: Snapshot, table: dict, staged: DataFrame, keys: list[str],
           batch_size: int | None, filters: bool) -> list[int]:
    width = sum(F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in keys) + KEY_OVERHEAD_BYTES
    per_bucket = {r[0]: (r[1], r[2]) for r in staged.groupBy(BUCKET_COL).agg(F.count(F.lit(1)), F.sum(width)).collect()}
    touched = sorted(per_bucket)
    if not touched:
        return []
    if fold_adds(spark, path, only_buckets=touched):
        snap = snapshot(spark, path)
        table = _described(snap, path, staged, keys, table["buckets"])
    small = sum(b for _, b in per_bucket.values()) <= BROADCAST_KEY_BYTES      # summed: a proven bound
    old = _holding(spark, path, snap, staged, keys, small, filters)
    merged = staged
    if old:
        merged = upsert(_rows_of(spark, path, snap, _full(path, old)), staged, keys, broadcast_keys=small)
    spread = _spread(len(touched), rows=sum(n for n, _ in per_bucket.values()), stored_bytes=sum(old.values()))
    new = _write(spark, path, merged, keys, len(touched), spread, batch_size=batch_size)
    manifest.commit(spark, path, snap, table, op="upsert", buckets=touched, added=[new], removed=_named(spark, old))
    return touched


def _full(path: str, names: Iterable[str]) -> list[str]:
    return [f"{path.rstrip('/')}/{manifest.DATA}/{n}" for n in names]


def _named(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], "path string")


def _holding(spark: SparkSession, path: str, snap: Snapshot, wanted: DataFrame, keys: Sequence[str], small: bool,
             filters: bool = True) -> dict[str, int]:
    """Names and bytes of the data files that hold one of the ``wanted`` keys (with ``_b``): those to be written anew."""
    maybe = manifest.may_hold(spark, path, snap.files.where("kind = 'data'"), wanted.select(*keys, BUCKET_COL), keys, filters)
    sizes = {r["path"]: r["bytes"] for r in maybe.select("path", "bytes").collect()}
    if not sizes:
        return {}
    stored = _rows_of(spark, path, snap, _full(path, sizes)).select(*keys, F.col("_metadata.file_path").alias("_file"))
    asked = wanted.select(*[F.col(k).alias(f"_u{i}") for i, k in enumerate(keys)])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_u{i}"))
    # stored keys stream past broadcast update keys: no shuffle of the stored side
    hits = stored.join(F.broadcast(asked) if small else asked, same, "left_semi")
    names = hits.select(F.substring_index("_file", f"/{manifest.DATA}/", -1).alias("path")).distinct()
    return {r[0]: sizes[r[0]] for r in names.collect()}


# ---- adds at rest ----------------------------------------------------------------


def atomic_add_path(spark: SparkSession, path: str, adds: DataFrame, fields: Sequence[str], *, batch_id: str,
                    distinct: bool = False, buckets: int = DEFAULT_BUCKETS, key: str | None = None) -> bool:
    """J2 at rest: log values to be appended to stored arrays, once per ``batch_id``.

    ``adds`` holds the key and array ``fields``; several rows of a key count
    together. Nothing stored is read or written anew: a read merges the log,
    and :func:`fold_adds` (or the next upsert of a touched bucket) writes it
    into the rows. Keys that are not stored become rows. Returns False, and
    adds nothing, if this batch was added before. ``distinct`` keeps each
    value once; it is a property of the collection, set by the first add.
    A collection that does not exist yet is made (``key`` names its key).
    """
    fields = list(fields)

    def attempt() -> list[int]:
        snap = snapshot(spark, path)
        keys = snap.table["key"] if snap else [key]
        if len(keys) != 1 or keys[0] is None:
            raise ValueError("adds need a collection with one key column")
        n_buckets = snap.table["buckets"] if snap else buckets
        rows = adds.select(keys[0], *fields).withColumn(BUCKET_COL, bucket_of(keys, n_buckets))
        table = _described(snap, path, rows, keys, n_buckets)
        if table.setdefault("distinct_adds", distinct) != distinct:
            raise ValueError(f"{path} keeps adds with distinct={table['distinct_adds']}")
        schema = StructType.fromJson(table["schema"])
        for f in fields:
            if not isinstance(schema[f].dataType, ArrayType):
                raise ValueError(f"{f} is no array")
            rows = rows.withColumn(f, F.col(f).cast(schema[f].dataType))
        table["add_fields"] = sorted({*table.get("add_fields", []), *fields})
        if snap is not None and not snap.files.where((F.col("kind") == "marker") & (F.col("path") == batch_id)).isEmpty():
            return []
        size = estimated_bytes(rows)
        new = _write(spark, path, rows, keys, n_buckets, _spread(n_buckets, stored_bytes=size), kind="adds")
        manifest.commit(spark, path, snap, table, op="adds", buckets=new.buckets, added=[new], marker=batch_id, commutes=True)
        return [1]

    return bool(_retried(attempt))


def _adds(spark: SparkSession, path: str, snap: Snapshot, logged: DataFrame) -> DataFrame:
    """Logged adds as rows (key, array fields): a field that a log lacks is null."""
    schema = StructType.fromJson(snap.table["schema"])
    fields = StructType([schema[snap.table["key"][0]], *[schema[f] for f in snap.table["add_fields"]]])
    return spark.read.schema(fields).parquet(*manifest.paths(path, logged))


def _with_adds(snap: Snapshot, rows: DataFrame, adds: DataFrame) -> DataFrame:
    """Stored rows with their adds; a null array that nothing is added to stays null."""
    key = snap.table["key"][0]
    fields = [c for c in adds.columns if c != key]
    stored = rows.drop(BUCKET_COL).select("*", *[F.col(f).isNull().alias(f"_null_{f}") for f in fields])
    out = atomic_add(stored, adds, key, fields, distinct=snap.table["distinct_adds"])
    for f in fields:
        out = out.withColumn(f, F.when(~(F.coalesce(f"_null_{f}", F.lit(False)) & (F.size(f) == 0)), F.col(f)))
    return out.withColumn(BUCKET_COL, bucket_of(key, snap.table["buckets"])).select(*rows.columns)


def fold_adds(spark: SparkSession, path: str, only_buckets: Sequence[int] | None = None) -> list[int]:
    """Write waiting adds into the rows of their buckets; returns these buckets.

    Only files that hold a key of the log are written anew (see
    :func:`upsert_path`); keys that are not stored become rows.
    """
    def attempt() -> list[int]:
        snap = snapshot(spark, path)
        if snap is None or not snap.has_adds:
            return []
        logged = snap.files.where("kind = 'adds'")
        if only_buckets is not None:
            logged = logged.where(F.col("bucket").isin(list(only_buckets)))
        waiting = sorted(r[0] for r in logged.select("bucket").distinct().collect())
        if not waiting:
            return []
        keys = snap.table["key"]
        adds = _adds(spark, path, snap, logged)
        asked = adds.select(*keys).withColumn(BUCKET_COL, bucket_of(keys, snap.table["buckets"]))
        old = _holding(spark, path, snap, asked, keys, small=False)
        merged = _with_adds(snap, _rows_of(spark, path, snap, _full(path, old)), adds)
        size = sum(old.values()) + (logged.agg(F.sum("bytes")).first()[0] or 0)
        new = _write(spark, path, merged, keys, len(waiting), _spread(len(waiting), stored_bytes=size))
        manifest.commit(spark, path, snap, snap.table, op="fold", buckets=waiting, added=[new],
                        removed=_named(spark, old).unionByName(logged.select("path")))
        return waiting

    return _retried(attempt)


# ---- compaction ------------------------------------------------------------------


def compact(spark: SparkSession, path: str, parts: int, out_path: str | None = None,
            key: str | Sequence[str] | None = None, only_buckets: Sequence[int] | None = None,
            keep_s: float = 3600) -> str:
    """K4: reduce a collection to few files; ``parts`` 0 leaves it as is.

    A bucketed collection is compacted to about ``parts`` files per bucket, or
    as many as its bytes fill if that is more; buckets that already have so
    few are neither read nor written. ``only_buckets`` limits the work (e.g.
    to the ones a transfer just appended to). Waiting adds of these buckets are
    folded, and files replaced ``keep_s`` seconds ago are deleted.
    A plain collection is rewritten into ``parts`` files at ``out_path``, which
    the caller switches to: one path cannot be read and overwritten in a
    single static overwrite.
    """
    if parts <= 0:
        return path
    if snapshot(spark, path) is None:
        if not out_path:
            raise ValueError("compacting a plain collection needs out_path")
        spark.read.option("mergeSchema", "true").parquet(path).repartition(int(parts)).write.mode("overwrite").parquet(out_path)
        return out_path
    fold_adds(spark, path, only_buckets)

    def attempt() -> list[int]:
        snap = snapshot(spark, path)
        data = snap.files.where("kind = 'data'")
        if only_buckets is not None:
            data = data.where(F.col("bucket").isin(list(only_buckets)))
        sizes = data.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("size"))
        full = F.greatest(F.lit(int(parts)), F.ceil(F.col("size") / DEFAULT_FILE_BYTES))
        loose = {r["bucket"]: r["size"] for r in sizes.where(F.col("n") > full).collect()}
        if not loose:
            return []
        old = data.where(F.col("bucket").isin(list(loose)))
        keys = snap.table["key"]
        spread = max(int(parts), _spread(len(loose), stored_bytes=sum(loose.values())))
        new = _write(spark, path, _rows_of(spark, path, snap, manifest.paths(path, old)), keys, len(loose), spread)
        manifest.commit(spark, path, snap, snap.table, op="compact", buckets=sorted(loose), added=[new], removed=old)
        return sorted(loose)

    _retried(attempt)
    manifest.vacuum(spark, path, keep_s)
    return path


def file_count(spark: SparkSession, path: str, bucket: int | None = None) -> int:
    """Number of data files: those of the snapshot (of one bucket), or all visible ones of a plain collection."""
    snap = snapshot(spark, path)
    if snap is not None:
        files = snap.files.where("kind = 'data'")
        return files.count() if bucket is None else files.where(F.col("bucket") == bucket).count()
    names = spark.read.schema("x int").option("recursiveFileLookup", "true").parquet(path).inputFiles()
    return len(names)
