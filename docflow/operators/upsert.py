"""Keyed updates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(dest: DataFrame, updates: DataFrame, key: str | Sequence[str],
           broadcast_keys: bool = False) -> DataFrame:
    """Rows of ``updates`` replace destination rows with the same key.

    Plan: a left-anti join of the destination on the distinct update keys,
    then a union. The distinct keys are hash-partitioned on the key, which
    is the partitioning the join needs, so only one shuffle per side.
    ``updates`` should hold one row per key (see ``latest_per_key``).
    Null keys are equal to each other, so repeating an upsert never piles up
    rows. Columns missing on either side come back as null. ``broadcast_keys``
    (only for an update set of known, bounded size) broadcasts the update
    keys so the stored side is not shuffled.
    """
    keys = [key] if isinstance(key, str) else list(key)
    update_keys = updates.select(*[F.col(k).alias(f"_u{i}") for i, k in enumerate(keys)]).distinct()
    if broadcast_keys:
        # caller has bounded the update count: stream the stored rows past
        # the broadcast keys instead of shuffling them
        update_keys = F.broadcast(update_keys)
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_u{i}")) for i, k in enumerate(keys)))
    kept = dest.join(update_keys, same, "left_anti")
    return kept.unionByName(updates, allowMissingColumns=True)


def _numbered(n: int):
    return lambda v: F.struct(F.lit(n).alias("n"), v.alias("v"))


def atomic_add(dest: DataFrame, adds: DataFrame, key: str, fields: Sequence[str],
               distinct: bool = False) -> DataFrame:
    """Append the values of array ``fields`` in ``adds`` to the stored arrays.

    Other destination fields are untouched; keys absent from the destination
    are inserted. A null array counts as empty, so the result is never null.
    ``distinct=True`` keeps each value once: values are exploded and collected
    as sets, which reduces a hot key to its distinct values before the shuffle.
    Without it every added value is kept, as the stored field must hold them
    all: a key's array is then as large as the field being written.
    """
    fields = list(fields)
    if distinct:
        # one (field number, value) row per added value; an empty row keeps the key itself
        parts = [F.transform(F.coalesce(F.col(f), F.array().cast(adds.schema[f].dataType)),
                             _numbered(i)) for i, f in enumerate(fields)]
        values = adds.select(key, F.explode_outer(F.concat(*parts)).alias("_v"))
        merged_adds = values.groupBy(key).agg(*[
            F.array_sort(F.collect_set(F.when(F.col("_v.n") == i, F.col("_v.v")))).alias(f)
            for i, f in enumerate(fields)])
    else:
        merged_adds = adds.groupBy(key).agg(*[
            F.flatten(F.collect_list(F.coalesce(F.col(f), F.array().cast(adds.schema[f].dataType)))).alias(f)
            for f in fields])
    d, a = dest.alias("d"), merged_adds.alias("a")
    out_cols = []
    for c in dest.columns:
        if c == key:
            out_cols.append(F.coalesce(F.col(f"d.{key}"), F.col(f"a.{key}")).alias(key))
        elif c in fields:
            empty = F.array().cast(dest.schema[c].dataType)
            joined = F.concat(F.coalesce(F.col(f"d.{c}"), empty), F.coalesce(F.col(f"a.{c}"), empty))
            out_cols.append((F.array_distinct(joined) if distinct else joined).alias(c))
        else:
            out_cols.append(F.col(f"d.{c}").alias(c))
    for f in fields:
        if f not in dest.columns:
            out_cols.append(F.coalesce(F.col(f"a.{f}"), F.array().cast(adds.schema[f].dataType)).alias(f))
    return d.join(a, F.col(f"d.{key}").eqNullSafe(F.col(f"a.{key}")), "full_outer").select(*out_cols)
