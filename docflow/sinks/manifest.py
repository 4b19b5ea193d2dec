"""The snapshot of a collection: which files it consists of, changed by one atomic create.

Data files lie in ``_data/<write>/`` below the collection, hidden from plain
file readers; nothing but the snapshot says which of them count. A commit is a
small JSON file ``_log/<number>.json``, written aside and renamed to a name
that must not exist yet. It names Parquet folders (``parts``) of file entries,
added and removed; the live files are those added and not removed. So a reader
sees the whole state before a commit or the whole state after it, a run that
dies leaves files which nobody reads, and of two writers that create the same
number one fails and looks again at what the other did.

An entry holds the file's bucket, rows, bytes, zone map (least and greatest
value of every number and time column, as exact text), key range, and the
number of blocks of its Bloom filter. Filters lie beside the data, one row
(4,096 bytes) per file and block. Both are taken by reading back the key and
zone columns of the files just written, whose row counts are compared with
those that the write observed.

Entries stay in DataFrames. The driver holds the commit file, the numbers of
the buckets touched, and the names of the files that a read is given (which
Spark's own file index holds as well).
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from docflow.operators.counts import Mark, newest_mark
from docflow.session import hadoop_fs

BUCKET_COL = "_b"
#: Folder column of a write; the bucket itself is a column of the files.
FOLDER_COL = "_p"
LOG, DATA, FILTERS = "_log", "_data", "f-"
ENTRY = ("op int, kind string, path string, write string, bucket int, rows bigint, bytes bigint, "
         "zones map<string,struct<low:string,high:string>>, key_low string, key_high string, blocks int, at bigint")
#: Parts after which a commit writes the live entries anew as one.
MOST_PARTS = 20
#: Removed files stay known for so long, and are deleted by a :func:`vacuum` in that time.
KEEP_REMOVALS_S = 30 * 86400
#: A filter block is one bitmap of Spark's (32,768 bits); a key sets so many bits of one block, with ten bits a key.
BLOCK_BITS, BITS_PER_KEY, PROBES, BLOCK_SEED = 32768, 10, 4, 97
ZONED = ("timestamp", "timestamp_ntz", "date", "tinyint", "smallint", "int", "bigint", "float", "double")


_SIDE = ThreadPoolExecutor(max_workers=4, thread_name_prefix="filters")


class Conflict(RuntimeError):
    """Another writer committed to the same buckets meanwhile."""


class LostRows(RuntimeError):
    """The files of a write do not hold the rows that were written."""


@dataclass
class Snapshot:
    """One committed state: its number, the commit file's content, and the live entries."""

    seq: int
    info: dict
    files: DataFrame

    @property
    def table(self) -> dict:
        """Bucket count, key, key types and schema of the collection."""
        return self.info["table"]

    @property
    def has_adds(self) -> bool:
        return "add_fields" in self.table

    def schema(self) -> StructType:
        return StructType.fromJson(self.table["schema"]).add(BUCKET_COL, IntegerType())


@dataclass
class Written:
    """Files of one write that nobody reads yet: the part that holds their entries, rows and buckets."""

    part: str
    rows: int
    buckets: list[int]


def _at(path: str, *names: str) -> str:
    return "/".join([path.rstrip("/"), *names])


def read_json(spark: SparkSession, file: str) -> dict | None:
    fs, jpath = hadoop_fs(spark, file)
    if not fs.exists(jpath):
        return None
    stream = fs.open(jpath)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def create_once(spark: SparkSession, folder: str, name: str, value: dict) -> bool:
    """Write ``value`` as ``folder/name`` unless that file exists (then False): whole or not at all."""
    fs, aside = hadoop_fs(spark, _at(folder, f".{uuid.uuid4().hex}"))
    out = fs.create(aside, False)
    try:
        out.write(bytearray(json.dumps(value).encode("utf-8")))
    finally:
        out.close()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(aside), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(_at(folder, name))),
                       gateway.new_array(rename, 0))
        return True
    except Exception as exc:  # noqa: BLE001 - py4j wraps the Java error
        if "FileAlreadyExistsException" not in str(exc):
            raise
        return False
    finally:
        fs.delete(aside, False)


def _name(seq: int) -> str:
    return f"{seq:020d}.json"


def newest_number(spark: SparkSession, path: str) -> int:
    """The number of the newest commit, 0 if there is none."""
    fs, log = hadoop_fs(spark, _at(path, LOG))
    if not fs.exists(log):
        return 0
    names = [s.getPath().getName() for s in fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(log, "*.json"))]
    return int(max(names)[:-5]) if names else 0


def snapshot(spark: SparkSession, path: str) -> Snapshot | None:
    """The newest committed state, or None."""
    seq = newest_number(spark, path)
    if not seq:
        return None
    info = read_json(spark, _at(path, LOG, _name(seq)))
    return Snapshot(seq, info, live(spark, path, info["parts"]))


def entries(spark: SparkSession, path: str, parts: Sequence[str]) -> DataFrame:
    return spark.read.schema(ENTRY).parquet(*[_at(path, LOG, p) for p in parts])


def live(spark: SparkSession, path: str, parts: Sequence[str]) -> DataFrame:
    """The files added and not removed; a path is never used twice."""
    every = entries(spark, path, parts)
    return every.where("op = 1").join(every.where("op = -1").select("path"), "path", "left_anti").select(*every.columns)


def _anew(spark: SparkSession, path: str, parts: Sequence[str]) -> DataFrame:
    """All that later readers need of some parts: live files, and removals that :func:`vacuum` may not have seen."""
    removed = entries(spark, path, parts).where("op = -1")
    recent = removed.where((F.col("at") > int(time.time()) - KEEP_REMOVALS_S) | F.col("path").contains(":/"))
    return live(spark, path, parts).unionByName(recent)


def paths(path: str, files: DataFrame) -> list[str]:
    """The full names of some files, for a reader."""
    return [_at(path, DATA, r[0]) for r in files.select("path").collect()]


# ---- writing files -------------------------------------------------------------


def _text(column: str, dtype: str) -> Column:
    return (F.unix_micros(column) if dtype == "timestamp" else F.col(column)).cast("string")


def _value(text: Column, dtype: str) -> Column:
    return F.timestamp_micros(text.cast("bigint")) if dtype == "timestamp" else text.cast(dtype)


def key_text(keys: Sequence[str]) -> Column:
    """What a key range is taken over: the first key column as text."""
    return F.col(keys[0]).cast("string")


def _block(keys: Sequence[str], blocks: Column) -> Column:
    return F.pmod(F.xxhash64(*keys, F.lit(BLOCK_SEED)), blocks).cast("int")


def _bit(keys: Sequence[str], probe: int) -> Column:
    return F.pmod(F.xxhash64(*keys, F.lit(probe)), F.lit(BLOCK_BITS))


def write_files(spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], tasks: int, salt: Column,
                *, kind: str = "data", batch_size: int | None = None) -> Written:
    """Write ``rows`` (with ``_b``) by bucket into a folder of their own, and take their entries and filters."""
    write = uuid.uuid4().hex[:16]
    folder = _at(path, DATA, write)
    counted = Observation()
    out = (rows.repartition(max(1, tasks), F.col(BUCKET_COL), salt).withColumn(FOLDER_COL, F.col(BUCKET_COL))
           .observe(counted, F.count(F.lit(1)).alias("n")).write)
    if batch_size:
        out = out.option("maxRecordsPerFile", int(batch_size))
    out.partitionBy(FOLDER_COL).parquet(folder)
    types = dict(rows.dtypes)
    zoned = [c for c in rows.columns if types[c] in ZONED and c != BUCKET_COL]
    back = (spark.read.schema(rows.schema).option("recursiveFileLookup", "true").parquet(folder)
            .withColumn("_file", F.substring_index("_metadata.file_path", f"/{DATA}/", -1))
            .withColumn("_size", F.col("_metadata.file_size")))
    zones = F.map_from_arrays(F.array(*[F.lit(c) for c in zoned]), F.array(*[
        F.struct(_text(f"_low{k}", types[c]).alias("low"), _text(f"_high{k}", types[c]).alias("high"))
        for k, c in enumerate(zoned)])) if zoned else F.lit(None)
    per_file = back.groupBy("_file").agg(
        F.first(BUCKET_COL).alias("bucket"), F.count(F.lit(1)).alias("rows"), F.max("_size").alias("bytes"),
        F.min(key_text(keys)).alias("key_low"), F.max(key_text(keys)).alias("key_high"),
        F.max(key_text(keys).isNull()).alias("_null"),
        *[f(c).alias(f"_{n}{k}") for k, c in enumerate(zoned) for n, f in (("low", F.min), ("high", F.max))])
    n = int(counted.get["n"])
    # keys are spread by hash, so twice the mean leaves room in every file
    blocks = -(-2 * n * BITS_PER_KEY // (max(1, tasks) * BLOCK_BITS)) or 1
    part = f"w-{write}"
    # both read the new files back, side by side
    filters = _SIDE.submit(_write_filters, back, keys, blocks, _at(path, DATA, f"{FILTERS}{write}")) if kind == "data" and n else None
    # a file with a null key has no range: any key may be in it
    (per_file.select(F.lit(1).alias("op"), F.lit(kind).alias("kind"), F.col("_file").alias("path"), F.lit(write).alias("write"),
                     "bucket", "rows", "bytes", zones.cast("map<string,struct<low:string,high:string>>").alias("zones"),
                     *[F.when(~F.col("_null"), F.col(c)).alias(c) for c in ("key_low", "key_high")],
                     F.lit(blocks).alias("blocks"), F.lit(int(time.time())).cast("bigint").alias("at"))
     .write.parquet(_at(path, LOG, part)))
    if filters is not None:
        filters.result()
    total, per_bucket = entries(spark, path, [part]).agg(F.sum("rows"), F.collect_set("bucket")).first()
    if (total or 0) != n:
        raise LostRows(f"{n} rows were written to {folder}, {total or 0} are there")
    return Written(part, n, sorted(per_bucket))


def _write_filters(back: DataFrame, keys: Sequence[str], blocks: int, folder: str) -> None:
    bits = [F.bitmap_construct_agg(_bit(keys, p)).alias(f"bits{p}") for p in range(PROBES)]
    each = back.groupBy(F.col("_file").alias("path"), _block(keys, F.lit(blocks)).alias("block")).agg(*bits)
    both = each.select("path", "block", F.explode(F.array(*[f"bits{p}" for p in range(PROBES)])).alias("bits"))
    both.groupBy("path", "block").agg(F.bitmap_or_agg("bits").alias("bits")).write.parquet(folder)


def may_hold(spark: SparkSession, path: str, files: DataFrame, wanted: DataFrame, keys: Sequence[str],
             filters: bool = True) -> DataFrame:
    """The files (their entries) that may hold one of the ``wanted`` keys (with ``_b``): by bucket, key range and filter."""
    asked = wanted.select(F.col(BUCKET_COL).alias("_wb"), key_text(keys).alias("_wk"),
                          F.xxhash64(*keys, F.lit(BLOCK_SEED)).alias("_hash"), *[_bit(keys, p).alias(f"_bit{p}") for p in range(PROBES)])
    if not filters:
        return files.join(asked.select("_wb").distinct(), F.col("bucket") == F.col("_wb"), "left_semi")
    inside = F.coalesce(F.col("_wk").between(F.col("key_low"), F.col("key_high")), F.lit(True))
    pairs = files.select("path", "write", "bucket", "key_low", "key_high", "blocks").join(
        asked, (F.col("bucket") == F.col("_wb")) & inside).withColumn("block", F.pmod("_hash", "blocks").cast("int"))
    writes = [r[0] for r in pairs.select("write").distinct().collect()]         # one per commit that is not compacted yet
    if not writes:
        return files.limit(0)
    stored = spark.read.schema("path string, block int, bits binary").parquet(*[_at(path, DATA, f"{FILTERS}{w}") for w in writes])
    hit = F.lit(True)
    for p in range(PROBES):
        byte = f"cast(conv(hex(substring(bits, cast(_bit{p} DIV 8 AS int) + 1, 1)), 16, 10) AS int)"
        hit = hit & (F.expr(f"getbit({byte}, cast(_bit{p} % 8 AS int))") == 1)
    found = pairs.join(stored, ["path", "block"]).where(hit).select("path").distinct()
    return files.join(found, "path", "left_semi").select(*files.columns)


# ---- commits --------------------------------------------------------------------


def commit(spark: SparkSession, path: str, base: Snapshot | None, table: dict, *, op: str, buckets: Sequence[int],
           added: Sequence[Written] = (), removed: DataFrame | None = None, marker: str | None = None,
           commutes: bool = False) -> int:
    """Make files count and others not, in one step, on top of ``base``; returns the new number.

    ``Conflict`` if another writer committed to one of ``buckets`` (or changed
    the table's description) since ``base``; with ``commutes`` (rows are only
    added beside others) only a marker that is there already conflicts.
    ``removed`` holds entries or paths of live files. ``marker`` is kept as an
    entry of its own, for good: a commit with a marker is made once.
    """
    moment = int(time.time())
    mine = [w.part for w in added]
    rows = []
    if removed is not None:
        rows.append(removed.select(F.lit(-1).alias("op"), F.lit("data").alias("kind"), "path", F.lit(moment).cast("bigint").alias("at")))
    if marker is not None:
        rows.append(spark.range(1).select(F.lit(1).alias("op"), F.lit("marker").alias("kind"), F.lit(marker).alias("path"),
                                          F.lit(moment).cast("bigint").alias("at")))
    if rows:
        mine.append(f"p-{uuid.uuid4().hex[:16]}")
        reduce(lambda a, b: a.unionByName(b), rows).write.parquet(_at(path, LOG, mine[-1]))
    seen = base.seq if base else 0
    known = base.info if base else None
    while True:
        head = newest_number(spark, path)
        for seq in range(seen + 1, head + 1):
            known = read_json(spark, _at(path, LOG, _name(seq)))
            if known is None or (not commutes and set(known["buckets"]) & set(buckets)) or (
                    marker is not None and known.get("marker") == marker) or (base is None and not commutes):
                raise Conflict(f"{path}: commit {seq} of another writer")
            table = known["table"] if base and table == base.table else _joined(table, known["table"])
            seen = seq
        parts = [*(known["parts"] if known else []), *mine]
        if len(parts) > MOST_PARTS:
            whole = f"p-{uuid.uuid4().hex[:16]}"
            _anew(spark, path, parts).write.parquet(_at(path, LOG, whole))
            parts = [whole]
        value = {"seq": seen + 1, "op": op, "at": moment, "buckets": sorted(buckets), "marker": marker, "parts": parts, "table": table}
        if create_once(spark, _at(path, LOG), _name(seen + 1), value):
            return seen + 1


def _joined(mine: dict, theirs: dict) -> dict:
    """One description of two that both only add columns."""
    if any(mine[k] != theirs[k] for k in ("buckets", "key", "key_types")):
        raise Conflict("another writer described the collection otherwise")
    if mine.get("distinct_adds", False) != theirs.get("distinct_adds", mine.get("distinct_adds", False)):
        raise Conflict("another writer keeps adds otherwise")
    first, more = StructType.fromJson(theirs["schema"]), StructType.fromJson(mine["schema"])
    for f in more.fields:
        if f.name in first.names and first[f.name].dataType != f.dataType:
            raise Conflict(f"another writer added {f.name} as {first[f.name].dataType.simpleString()}")
    fresh = [f for f in more.fields if f.name not in first.names]
    adds = sorted({*mine.get("add_fields", []), *theirs.get("add_fields", [])})
    return theirs | mine | {"schema": StructType([*first.fields, *fresh]).jsonValue(), **({"add_fields": adds} if adds else {})}


# ---- what the entries say ----------------------------------------------------------


def foreign_files(spark: SparkSession, path: str, snap: Snapshot | None) -> list[str]:
    """Visible files below the collection that no commit took in: they were put there by other writers.

    Spark's file index lists them in parallel; the names are those a read is given.
    """
    fs, root = hadoop_fs(spark, path)
    if not fs.exists(root):
        return []
    names = spark.read.schema("x int").option("recursiveFileLookup", "true").parquet(path).inputFiles()
    if not names or snap is None:
        return sorted(names)
    taken = entries(spark, path, snap.info["parts"]).where("op = -1").select("path")
    listed = spark.createDataFrame([(n,) for n in names], "path string")
    return sorted(r[0] for r in listed.join(taken, "path", "left_anti").collect())


def stored_rows(snap: Snapshot) -> tuple[int, bool]:
    """Rows in the live data files, and whether adds wait beside them."""
    data = F.col("kind") == "data"
    rows, waiting = snap.files.agg(F.sum(F.when(data, F.col("rows"))), F.count_if(F.col("kind") == "adds")).first()
    return int(rows or 0), waiting > 0


def newest_zone(snap: Snapshot, column: str, dtype: str) -> Mark | None:
    """The greatest value of a zoned column over all live files, without opening one."""
    high = _value(F.col("zones")[column]["high"], dtype).alias(column)
    return newest_mark(snap.files.where("kind = 'data'").select(high), column)


def vacuum(spark: SparkSession, path: str, keep_s: float = 3600) -> int:
    """Delete what no reader can still be reading: files removed ``keep_s`` ago, and leftovers of runs that died.

    Returns the number of files and folders deleted. Readers and writers that
    started longer ago than ``keep_s`` must have ended.
    """
    snap = snapshot(spark, path)
    if snap is None:
        return 0
    before = int(time.time() - keep_s)
    every = entries(spark, path, snap.info["parts"])
    gone = every.where("op = -1").groupBy(F.col("path").alias("gone")).agg(F.max("at").alias("gone_at"))
    held = every.where("op = 1 AND kind <> 'marker'").join(gone, F.col("path") == F.col("gone"), "left").groupBy("write").agg(
        F.count_if(F.col("gone_at").isNull() | (F.col("gone_at") > before)).alias("held"))
    known = {r["write"]: r["held"] for r in held.collect()}                     # one per write that is not compacted yet
    deleted = 0
    for name, in gone.where(F.col("gone_at") <= before).select("gone").collect():
        fs, file = hadoop_fs(spark, name if ":/" in name else _at(path, DATA, name))
        deleted += bool(fs.exists(file) and fs.delete(file, False))
    in_use = {*snap.info["parts"], _name(snap.seq)}
    for folder in (DATA, LOG):
        fs, root = hadoop_fs(spark, _at(path, folder))
        for s in fs.listStatus(root) if fs.exists(root) else []:
            name = s.getPath().getName()
            write = name.removeprefix(FILTERS)
            if folder == DATA and write in known:
                dead = known[write] == 0
            else:                                           # a part or commit that was replaced, or a run that died
                dead = name not in in_use and s.getModificationTime() / 1000 <= before
            deleted += bool(dead and fs.delete(s.getPath(), True))
    return deleted
