"""Counts and the destination watermark (A1-A5)."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.functions.predicates import all_of, range_


def count_collection(df: DataFrame, alias: str = "n") -> DataFrame:
    """A1: one row, the row count (partial counts per task, one final sum)."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def newest(df: DataFrame, ts_col: str, alias: str = "newest") -> DataFrame:
    """A2: the newest timestamp over all rows (null when empty or all null)."""
    return df.agg(F.max(F.col(ts_col)).alias(alias))


@dataclass(frozen=True)
class Mark:
    """A watermark as exact text with its column type.

    A zoned ``timestamp`` is held as epoch microseconds, so neither the
    driver's zone nor the session's can move it; other types as their own text.
    """

    type: str
    text: str

    def lit(self, dtype: str | None = None) -> Column:
        own = F.timestamp_micros(F.lit(int(self.text))) if self.type == "timestamp" else F.lit(self.text).cast(self.type)
        return own if dtype in (None, self.type) else own.cast(dtype)


def mark_text(col: Column, dtype: str) -> Column:
    """What a mark holds of a value of type ``dtype``."""
    return (F.unix_micros(col) if dtype == "timestamp" else col).cast("string")


def newest_mark(df: DataFrame | None, ts_col: str) -> Mark | None:
    """A2 as a driver value (one aggregated row): None when empty or all null."""
    if df is None:
        return None
    dtype = dict(df.dtypes)[ts_col]
    text = df.agg(mark_text(F.max(ts_col), dtype)).first()[0]
    return None if text is None else Mark(dtype, text)


def later(a: Mark | None, b: Mark | None) -> Mark | None:
    """The later of two marks of one type."""
    if a is None or b is None:
        return a or b
    if a.type != b.type:
        raise ValueError(f"the watermark was a {a.type}, the column is a {b.type}")
    if a.type in ("timestamp", "tinyint", "smallint", "int", "bigint"):
        return max(a, b, key=lambda m: int(m.text))
    if a.type in ("float", "double") or a.type.startswith("decimal"):
        return max(a, b, key=lambda m: Decimal(m.text))
    return max(a, b, key=lambda m: m.text)                  # ISO dates and times sort as text


def new_rows_filter(ts_col: str, newest_ts, as_of, dtype: str | None = None) -> Column:
    """A3: ``newest < ts <= as_of``; with no newest value, ``ts <= as_of``.

    Both bounds are literals, so the predicate reaches the Parquet scan. The
    low bound is exclusive: a late row stamped at or before the watermark is
    not picked up by a later run. The watermark is used at full precision
    (never truncated), so microsecond timestamps do not re-send rows.
    """
    return range_(ts_col, lo=newest_ts, hi=as_of, dtype=dtype)


def count_new(source: DataFrame, ts_col: str, newest_ts, as_of,
              where: str | Column | None = None) -> int:
    """A4: rows of the source matching the query and the watermark filter."""
    dtype = dict(source.dtypes)[ts_col]
    return source.filter(all_of(where, new_rows_filter(ts_col, newest_ts, as_of, dtype))).count()
