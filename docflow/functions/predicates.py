"""Row predicates as Columns.

The source system wrote these as query strings; here each one is a Column, so
Catalyst can push it into the Parquet scan (``PushedFilters``) and prune row
groups. No query-string parser is built.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_predicate(p: str | Column | None) -> Column:
    """A Column, an SQL boolean expression, or None (= match all)."""
    if p is None:
        return match_all()
    if isinstance(p, str):
        return F.expr(p)
    return p


def typed_lit(value, dtype: str | None = None) -> Column:
    """A literal of the column's type, so the comparison needs no cast on the
    column side and stays a pushed-down Parquet filter. Datetimes go through
    their ISO text, which converts exactly (microseconds kept)."""
    if isinstance(value, Column):
        return value
    if hasattr(value, "lit"):                               # a stored watermark knows its own type
        return value.lit(dtype)
    if isinstance(value, _dt.datetime) and value.tzinfo is not None:
        # an instant: exact whatever the zones of driver and session are
        micros = (value - _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc)) // _dt.timedelta(microseconds=1)
        instant = F.timestamp_micros(F.lit(micros))
        if dtype in (None, "timestamp"):
            return instant
        return F.lit(value.astimezone(_dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" ")).cast(dtype)
    if isinstance(value, _dt.datetime):
        return F.lit(value.isoformat(sep=" ")).cast(dtype or "timestamp_ntz")
    if dtype:
        return F.lit(value).cast(dtype)
    return F.lit(value)


def match_all() -> Column:
    """Every row."""
    return F.lit(True)


def exists(c: str | Column, is_array: bool = False) -> Column:
    """The field has a value; an array field also needs an element."""
    col = _col(c)
    if is_array:
        return col.isNotNull() & (F.size(col) > 0)
    return col.isNotNull()


def field_exists(df: DataFrame, name: str) -> Column:
    """P2 with the array test chosen from the DataFrame's schema."""
    dtype = df.schema[name].dataType
    return exists(name, is_array=isinstance(dtype, (ArrayType, MapType)))


def range_(c: str | Column, lo=None, hi=None, *, lo_inclusive: bool = False,
           hi_inclusive: bool = True, dtype: str | None = None) -> Column:
    """``lo < c <= hi`` by default; a missing bound is open.

    Rows whose field is null never match a bounded range (SQL null logic),
    which is what the source's ``[* TO hi]`` does too.
    """
    col = _col(c)
    parts = []
    if lo is not None:
        lit = typed_lit(lo, dtype)
        parts.append(col >= lit if lo_inclusive else col > lit)
    if hi is not None:
        lit = typed_lit(hi, dtype)
        parts.append(col <= lit if hi_inclusive else col < lit)
    if not parts:
        return col.isNotNull()
    return reduce(and_, parts)


def term(c: str | Column, value, is_array: bool = False) -> Column:
    """P5: field equals a value; on an array field, contains it."""
    col = _col(c)
    if is_array:
        return F.array_contains(col, F.lit(value))
    return col == F.lit(value)


def all_of(*preds: str | Column | None) -> Column:
    """Conjunction; None entries are skipped, nothing given = match all."""
    cols = [as_predicate(p) for p in preds if p is not None]
    if not cols:
        return match_all()
    return reduce(and_, cols)
