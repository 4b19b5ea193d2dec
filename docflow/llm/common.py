"""Helpers shared by the operators: stage tables, size-checked broadcasts, text buffers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.session import shared_dir, ship_package

#: Rows and bytes of a build side that may be broadcast; beyond either the join shuffles.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 64 << 20

#: A key is hot with more than one in this many of a join's rows, and at least ``LEAST_HOT``; parts that it is spread over.
HOT_KEYS, LEAST_HOT, SPREAD = 10_000, 256, 64

#: Bytes of text that one numpy step handles (a longer text is handled alone).
STEP_BYTES = 1 << 20

#: Bytes of the Arrow batches that carry whole texts to Python workers and back.
BATCH_BYTES = 8 << 20


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back (cuts the lineage)."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _bytes_of(column: Column, kind: T.DataType) -> Column:
    """About the bytes that a value takes in memory."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)).cast("long") + 16
    if isinstance(kind, T.StructType):
        return sum((_bytes_of(column[f.name], f.dataType) for f in kind.fields), F.lit(16).cast("long"))
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.StructType, T.ArrayType)):
            held = F.aggregate(column, F.lit(0).cast("long"), lambda total, x: total + _bytes_of(x, kind.elementType))
            return F.coalesce(held, F.lit(0).cast("long")) + 24
        return F.greatest(F.size(column), F.lit(0)).cast("long") * 8 + 24
    return F.lit(8).cast("long")


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its rows and their summed bytes are within the bounds, else as it is.

    ``df`` should be a stage table: it is counted, and its bytes are summed if the count is within the bound.
    """
    if df.count() > max_rows:
        return df
    width = sum((_bytes_of(F.col(f.name), f.dataType) for f in df.schema.fields), F.lit(32).cast("long"))
    return F.broadcast(df) if (df.agg(F.sum(width)).first()[0] or 0) <= max_bytes else df


def spread_join(rows: DataFrame, side: DataFrame, key: str, by: Sequence[str], how: str = "inner") -> DataFrame:
    """``rows`` joined with ``side``, which has one row of each ``key`` and, in ``n``, how many of ``rows`` it meets.

    A key of more than one in ``HOT_KEYS`` of those rows is hot: its rows are
    spread by a hash of the columns ``by`` over ``SPREAD`` parts, and its row of
    ``side`` is repeated for each. Fewer than ``HOT_KEYS`` keys can be hot, so
    the broadcast list of them is bounded at every size. ``side`` is staged.
    """
    side = staged(side, "side")
    least = (side.agg(F.sum("n")).first()[0] or 0) / HOT_KEYS
    hot = F.broadcast(side.where(F.col("n") > F.lit(max(least, LEAST_HOT))).select(key, F.lit(SPREAD).alias("__parts")))
    part = F.coalesce(F.pmod(F.xxhash64(*by), F.col("__parts")).cast("int"), F.lit(0)).alias("__part")
    rows = rows.join(hot, key, "left").select(*rows.columns, part)
    parts = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__parts"), F.lit(1)) - 1)).alias("__part")
    side = side.join(hot, key, "left").select(*side.columns, parts)
    return rows.join(side, [key, "__part"], how).drop("__part")


def ready(spark: SparkSession) -> None:
    """Make docflow importable in the Python workers, and keep their batches of whole texts small.

    The batch size is set for this session unless the cluster names one.
    """
    ship_package(spark)
    if not spark.sparkContext.getConf().contains("spark.sql.execution.arrow.maxBytesPerBatch"):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def kept_fields(df: DataFrame, keep: Sequence[str] | None, new: Sequence[str]) -> list[T.StructField]:
    """The fields of ``df`` that pass through: those in ``keep`` (all if None), but for names that new columns take."""
    return [f for f in df.schema.fields if (keep is None or f.name in keep) and f.name not in new]


def id_bucket(column: str, modulus: int) -> Column:
    """crc32 of an id's decimal text, modulo ``modulus`` (null id: null)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def free_name(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores before it as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_hash(column: str = "text") -> Column:
    """The hash that, with its id, names a row's text (a null is an empty text)."""
    return F.xxhash64(F.coalesce(column, F.lit(""))).alias("text_hash")


def text_buffer(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its n + 1 offsets (a null is an empty text)."""
    if pa.types.is_large_string(array.type):
        wide = np.int64
    else:
        array = array.cast(pa.string())
        wide = np.int32
    if array.null_count:
        array = array.fill_null("")
    _, offsets, data = array.buffers()
    if len(array) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(offsets, wide)[array.offset:array.offset + len(array) + 1].astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[ends[0]:ends[-1]], ends - ends[0]


def steps(offsets: np.ndarray, step_bytes: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``step_bytes`` of text each; every row belongs to one range."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + step_bytes, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): spreads every input bit over the word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_ODD = np.uint64(0x9E3779B97F4A7C15)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, np.uint64(0x2545F4914F6CDD1D), np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out) if n else out


_POWERS = _powers(1 << 12)

#: Byte tables: 0 separates words, any other value is 1 + the byte that counts.
SPACE_TABLE = np.arange(1, 257, dtype=np.uint16)
SPACE_TABLE[65:91] += 32                                # A-Z
SPACE_TABLE[[9, 10, 11, 12, 13, 32]] = 0
LETTER_TABLE = SPACE_TABLE.copy()
LETTER_TABLE[[b for b in range(128) if not (48 <= b < 58 or 65 <= b < 91 or 97 <= b < 123)]] = 0


def _hashes(seen: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and byte positions of the words in ``seen``; ``breaks`` are further word starts."""
    global _POWERS
    inside = np.flatnonzero(seen)
    if not len(inside):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.ones(len(inside), bool)
    first[1:] = np.diff(inside) > 1
    broken = np.searchsorted(inside, breaks)
    first[broken[broken < len(inside)]] = True
    starts = np.flatnonzero(first)
    lengths = np.diff(np.append(starts, len(inside)))
    place = np.arange(len(inside)) - np.repeat(starts, lengths)
    longest = int(lengths.max())
    if longest > len(_POWERS):
        _POWERS = _powers(1 << longest.bit_length())
    value = seen[inside].astype(np.uint64) * _POWERS[place]
    return mix(np.add.reduceat(value, starts) * _ODD + lengths.astype(np.uint64)), inside[starts]


def word_hashes(raw: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of some texts, and the row that each word is from.

    ``table`` lower-cases A-Z and marks separators. A word's hash depends on
    its bytes only; words never reach over the end of a text. A very long text
    is read in steps that end at separators, so memory follows the step.
    """
    hashes, places, at = [], [], 0
    while at < len(raw):
        end = len(raw)
        if end - at > 2 * STEP_BYTES:                       # cut behind the next separator
            end = at + STEP_BYTES
            while end < len(raw):
                gap = np.flatnonzero(table[raw[end:end + 65536]] == 0)
                if len(gap):
                    end += int(gap[0])
                    break
                end = min(len(raw), end + 65536)
        lo, hi = np.searchsorted(offsets, [at, end])
        h, p = _hashes(table[raw[at:end]], offsets[lo:hi] - at)
        hashes.append(h)
        places.append(p + at)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    where = np.concatenate(places)
    return np.concatenate(hashes), np.searchsorted(offsets, where, side="right") - 1
