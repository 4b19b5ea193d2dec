"""Rows to JSON text and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def row_json(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    """One JSON object per row, over ``cols`` (default all)."""
    names = list(cols) if cols else df.columns
    return F.to_json(F.struct(*[F.col(n) for n in names]))


def parse_json(c: str | Column, schema: StructType | str) -> Column:
    """JSON text to a struct of declared fields (bad text gives null fields)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.from_json(col, schema)
