"""Natural keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

KEY_SEPARATOR = "|"


def natural_key(df: DataFrame, fields: Sequence[str], sep: str = KEY_SEPARATOR) -> Column:
    """Join the fields' text with ``sep``; a null becomes empty text.

    Positions stay stable because nulls are kept as empty segments. Every
    part is cast to string before the null default, so ANSI mode never sees
    ``coalesce(int, '')``. Nested fields cannot form a key.
    """
    if not fields:
        raise ValueError("natural_key needs at least one field")
    parts = []
    for f in fields:
        if f not in df.columns:
            raise ValueError(f"natural key field {f!r} is not a column")
        dtype = df.schema[f].dataType
        if isinstance(dtype, (ArrayType, MapType, StructType)):
            raise ValueError(
                f"natural key field {f!r} has type {dtype.simpleString()}; "
                "only scalar fields can form a key")
        parts.append(F.coalesce(F.col(f).cast("string"), F.lit("")))
    return F.concat_ws(sep, *parts)


def with_natural_key(df: DataFrame, fields: Sequence[str], key_col: str = "id",
                     sep: str = KEY_SEPARATOR) -> DataFrame:
    """Overwrite (or add) ``key_col`` with the natural key; no fields = as is."""
    if not fields:
        return df
    return df.withColumn(key_col, natural_key(df, fields, sep))


def split_key_fields(spec: str) -> list[str]:
    """Comma list of field names; parts are not trimmed, as in the source job."""
    spec = spec.strip()
    return spec.split(",") if spec else []
