"""Physical plan checks: pushdown, pruning, no needless shuffles."""

from tests.conftest import SF_SMALL
from docflow.plans import catalog as C


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_watermark_filter_is_pushed_to_parquet(spark):
    p = formatted(C.q_incremental_transfer(spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in p and "LessThanOrEqual(ts," in p


def test_projection_prunes_columns(spark):
    p = formatted(C.q_range_half_open(spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in p


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(C.q_top_k_newest(spark, SF_SMALL))


def test_natural_key_count_uses_partial_aggregation(spark):
    assert "partial_count" in plan(C.q_natural_key(spark, SF_SMALL))


def test_upsert_with_counted_keys_streams_stored_rows(spark, out):
    from pyspark.sql import functions as F
    from docflow.operators.upsert import upsert
    spark.range(0, 500).select(F.col("id").cast("string").alias("id"), F.col("id").alias("v")) \
        .write.parquet(f"{out}/stored")
    stored = spark.read.parquet(f"{out}/stored")
    updates = spark.range(0, 5).select(F.col("id").cast("string").alias("id"), F.lit(9).cast("long").alias("v"))
    p = formatted(upsert(stored, updates, "id", broadcast_keys=True))
    assert "BroadcastHashJoin" in p and "LeftAnti" in p
    # the stored scan feeds the join directly: its rows are never shuffled
    assert "Exchange" not in p.split("BroadcastHashJoin")[1].split("BroadcastExchange")[0]
