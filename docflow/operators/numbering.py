"""Row numbers within a group that stay parallel when one group is huge.

``row_number() OVER (PARTITION BY g ORDER BY o)`` sends every row of a group
to one task. Here rows are range-partitioned on (group, order) by Spark, which
places the cuts at quantiles of the data, so a hot group spreads over many
ranges and one outlier moves no other row. Each row keeps the number of its
range; the rows per (group, range) give the offset of every range, and
``row_number`` only runs inside a range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docflow.session import shared_dir


def ordinal_within(df: DataFrame, groups: Sequence[str], order_col: str,
                   out_col: str = "rn", ranges: int | None = None) -> DataFrame:
    """Add ``out_col`` = 1-based position of the row in its group by ``order_col``.

    ``order_col`` may be of any type that sorts (numbers, text, timestamps);
    null groups are a group, and null order values come first in theirs. Ties
    on ``order_col`` get distinct but arbitrary positions. The rows are staged
    once in the shared folder with the number of their range (``ranges``,
    default one per shuffle partition), so every later step sees the same cuts.
    """
    groups = list(groups)
    spark = df.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64(*[F.col(c) for c in df.columns if not df.schema[c].dataType.typeName() in ("map", "variant")])
    path = shared_dir(spark, "ranges")
    (df.withColumn("_tie", tie).repartitionByRange(n, *[F.col(g) for g in groups], F.col(order_col), F.col("_tie"))
     .withColumn("_range", F.spark_partition_id()).write.parquet(path))
    cut = spark.read.parquet(path)
    counts = cut.groupBy(*groups, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(g).alias(f"_g{k}") for k, g in enumerate(groups)], F.col("_range").alias("_r"),
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    same = F.col("_range") == F.col("_r")
    for k, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{k}"))
    inside = Window.partitionBy(*groups, "_range").orderBy(F.col(order_col), F.col("_tie"))
    return (cut.join(offsets, same)
            .withColumn(out_col, F.col("_offset") + F.row_number().over(inside))
            .select(*df.columns, out_col))


def batch_ids(df: DataFrame, groups: Sequence[str], order_col: str, batch_size: int,
              out_col: str = "batch_id", ranges: int | None = None) -> DataFrame:
    """Add ``out_col`` = ``(position - 1) div batch_size`` within each group."""
    numbered = ordinal_within(df, groups, order_col, "_rn", ranges)
    return numbered.withColumn(out_col, F.floor((F.col("_rn") - 1) / F.lit(batch_size)).cast("long")) \
        .drop("_rn")
