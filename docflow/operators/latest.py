"""Latest row per key.

Written as an aggregation, not a ``row_number`` window: ``max_by`` is split
into a partial aggregate before the shuffle and a final one after it, so a hot
key that holds a large share of all rows is cut down to one row per map task
before it moves. A window would send every row of that key to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep, per ``keys``, the row with the largest ``order`` tuple.

    The tuple compares field by field (later fields break ties); a null
    sorts below any value, so a row with a value beats one without. Rows
    with equal full tuples are interchangeable; give a unique tie-break. Rows
    whose key is null are one key here (as in any grouping); a job that writes
    keyed rows refuses them first (``run_transfer``).
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    payload = F.struct(*[F.col(c) for c in rest])
    rank = F.struct(*[F.col(c) for c in order])
    picked = df.groupBy(*keys).agg(F.max_by(payload, rank).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)
