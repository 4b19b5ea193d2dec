import datetime as dt

import pytest

from pyspark.sql import functions as F

from docflow.operators.counts import Mark, count_new, newest_mark
from docflow.plans.transfer import TAG_COL, run_transfer
from docflow.sinks.collection import BUCKET_COL, file_count, read_bucketed, upsert_path

SCHEMA = "id string, ts timestamp_ntz, v int, tags array<string>"
D = dt.datetime
AS_OF = D(2024, 1, 25)


def src(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_empty_and_all_null_destination(spark):
    rows = src(spark, [("a", D(2024, 1, 1), 1, []), ("b", None, 2, []), ("c", D(2024, 2, 1), 3, [])])
    empty = rows.filter(F.lit(False))
    nulls = src(spark, [("x", None, 0, []), ("y", None, 0, [])])
    for dest in (empty, nulls):
        w = newest_mark(dest, "ts")
        assert w is None
        # ts <= as_of only: the null and the future row stay out
        assert count_new(rows, "ts", w, AS_OF) == 1


def test_watermark_and_as_of_bounds(spark):
    mark = D(2024, 1, 10, 12, 0, 0, 5)
    rows = src(spark, [("at_mark", mark, 1, []), ("after", mark + dt.timedelta(microseconds=1), 1, []),
                       ("at_as_of", AS_OF, 1, []), ("future", AS_OF + dt.timedelta(seconds=1), 1, [])])
    assert count_new(rows, "ts", mark, AS_OF) == 2


def test_incremental_transfer_then_noop(spark, out):
    dest = f"{out}/dest"
    first = src(spark, [("a", D(2024, 1, 1), 1, ["x"]), ("b", D(2024, 1, 5), 2, [])])
    res0 = run_transfer(spark, first, dest, ts_col="ts", as_of=AS_OF, run_id="r0", buckets=4)
    assert (res0.found, res0.written, res0.before, res0.after) == (2, 2, 0, 2)

    more = first.unionByName(src(spark, [("c", D(2024, 1, 6), 3, ["y"]), ("d", D(2024, 1, 5), 4, [])]))
    res1 = run_transfer(spark, more, dest, ts_col="ts", as_of=AS_OF, run_id="r1", buckets=4)
    # "d" is stamped at the watermark (exclusive low bound): not picked up
    assert (res1.found, res1.written, res1.before, res1.after) == (1, 1, 2, 3)
    out_df = read_bucketed(spark, dest)
    assert ids(out_df.filter(F.col(TAG_COL) == "r1")) == ["c"]
    assert [r["tags"] for r in out_df.filter("id = 'a'").collect()] == [["x"]]   # arrays kept

    res2 = run_transfer(spark, more, dest, ts_col="ts", as_of=AS_OF, run_id="r2", buckets=4)
    assert (res2.found, res2.written, res2.after) == (0, 0, 3)


def test_full_transfer_takes_null_and_future(spark, out):
    rows = src(spark, [("a", None, 1, []), ("b", D(2030, 1, 1), 2, []), ("c", D(2024, 1, 1), 3, [])])
    res = run_transfer(spark, rows, f"{out}/d", ts_col="ts", new_only=False, run_id="r", buckets=2)
    assert (res.found, res.written, res.after) == (3, 3, 3)


def test_natural_key_collision_keeps_newer(spark, out):
    rows = spark.createDataFrame(
        [("x", D(2024, 1, 1), 1, "k1"), ("y", D(2024, 1, 2), 2, "k1"), ("z", D(2024, 1, 3), 3, "k2")],
        "id string, ts timestamp_ntz, v int, nk string")
    res = run_transfer(spark, rows, f"{out}/d", ts_col="ts", as_of=AS_OF, key_fields=["nk", "v"],
                       run_id="r", buckets=2)
    assert res.written == 3   # (k1,1) (k1,2) (k2,3) are distinct keys
    rows2 = rows.withColumn("v", F.lit(0))
    res2 = run_transfer(spark, rows2, f"{out}/e", ts_col="ts", as_of=AS_OF, key_fields=["nk"],
                        run_id="r", buckets=2)
    got = {r["id"]: r["ts"] for r in read_bucketed(spark, f"{out}/e").collect()}
    assert res2.written == 2 and got == {"k1": D(2024, 1, 2), "k2": D(2024, 1, 3)}


def test_upsert_path_twice_is_once_and_touches_only_buckets(spark, out):
    path = f"{out}/c"
    base = spark.range(0, 200).select(F.col("id").cast("string").alias("id"), F.col("id").alias("v"))
    upsert_path(spark, path, base, "id", buckets=16)
    upd = spark.createDataFrame([("5", 500), ("7", 700), ("new", 1)], "id string, v long")
    upsert_path(spark, path, upd, "id", buckets=16)
    once = sorted(tuple(r) for r in read_bucketed(spark, path).drop(BUCKET_COL).collect())
    upsert_path(spark, path, upd, "id", buckets=16)
    twice = sorted(tuple(r) for r in read_bucketed(spark, path).drop(BUCKET_COL).collect())
    assert once == twice and len(once) == 201
    assert ("5", 500) in once and ("7", 700) in once
    assert not upsert_path(spark, path, upd.filter(F.lit(False)), "id", buckets=16)  # empty: no write


def test_write_batch_size_bounds_files(spark, out):
    from docflow.sinks.collection import compact, write_collection
    df = spark.range(0, 1000).coalesce(1)
    write_collection(df, f"{out}/w", mode="overwrite", batch_size=300)
    assert file_count(spark, f"{out}/w") == 4
    compacted = compact(spark, f"{out}/w", 1, out_path=f"{out}/w1")
    assert file_count(spark, compacted) == 1 and spark.read.parquet(compacted).count() == 1000


def test_restart_after_crash_uses_started_watermark(spark, out):
    from docflow.plans.transfer import _log, last_run
    dest = f"{out}/dest"
    first = src(spark, [("a", D(2024, 1, 1), 1, [])])
    run_transfer(spark, first, dest, ts_col="ts", as_of=AS_OF, run_id="r0", buckets=4)
    assert last_run(spark, dest)["state"] == "committed"
    # A run that crashed after writing only its newest row: the log says
    # "started" with the watermark it used, the destination holds row "c".
    _log(spark, dest, "crashed", "started", Mark("timestamp_ntz", "2024-01-01 00:00:00"), None)
    upsert_path(spark, dest, src(spark, [("c", D(2024, 1, 9), 3, [])]).withColumn(TAG_COL, F.lit("crashed")),
                "id", buckets=4)
    more = src(spark, [("a", D(2024, 1, 1), 1, []), ("b", D(2024, 1, 5), 2, []), ("c", D(2024, 1, 9), 3, [])])
    res = run_transfer(spark, more, dest, ts_col="ts", as_of=AS_OF, run_id="r1", buckets=4)
    assert res.found == 2 and ids(read_bucketed(spark, dest)) == ["a", "b", "c"]   # "b" not skipped
    assert last_run(spark, dest)["watermark_after"]["text"].startswith("2024-01-09")


def test_upsert_appends_new_keys_without_rewriting(spark, out):
    path = f"{out}/c"
    base = spark.range(0, 100).select(F.col("id").cast("string").alias("id"), F.col("id").alias("v"))
    upsert_path(spark, path, base, "id", buckets=4)
    files_before = file_count(spark, path)
    upsert_path(spark, path, spark.createDataFrame([("new1", 1), ("new2", 2)], "id string, v long"),
                "id", buckets=4)
    # no existing key touched: old files stay, new ones are added
    assert file_count(spark, path) > files_before
    assert read_bucketed(spark, path).count() == 102


def test_repeated_source_key_keeps_newest(spark, out):
    rows = src(spark, [("a", D(2024, 1, 1), 1, []), ("a", D(2024, 1, 3), 2, []), ("b", D(2024, 1, 2), 3, [])])
    res = run_transfer(spark, rows, f"{out}/d", ts_col="ts", as_of=AS_OF, run_id="r", buckets=2)
    got = {r["id"]: r["v"] for r in read_bucketed(spark, f"{out}/d").collect()}
    assert res.found == 3 and res.written == 2 and got == {"a": 2, "b": 3}


def test_compact_bucketed_in_place(spark, out):
    from docflow.sinks.collection import compact
    path = f"{out}/c"
    for i in range(4):   # four appends leave several files per bucket
        part = spark.range(i * 50, (i + 1) * 50).select(F.col("id").cast("string").alias("id"), F.col("id").alias("v"))
        upsert_path(spark, path, part, "id", buckets=2)
    before = sorted(tuple(r) for r in read_bucketed(spark, path).drop(BUCKET_COL).collect())
    assert file_count(spark, path) >= 4
    compact(spark, path, 1, key="id")
    assert file_count(spark, path) <= 2
    assert sorted(tuple(r) for r in read_bucketed(spark, path).drop(BUCKET_COL).collect()) == before


def test_destination_loaded_without_tag_column(spark, out):
    dest = f"{out}/d"
    upsert_path(spark, dest, src(spark, [("a", D(2024, 1, 1), 1, [])]), "id", buckets=2)   # no tag column
    more = src(spark, [("a", D(2024, 1, 1), 1, []), ("b", D(2024, 1, 4), 2, [])])
    res = run_transfer(spark, more, dest, ts_col="ts", as_of=AS_OF, run_id="r", buckets=2)
    assert (res.found, res.written, res.before, res.after) == (1, 1, 1, 2)


def test_transfer_where_splits_and_compaction(spark, out):
    dest = f"{out}/d"
    rows = src(spark, [(f"k{i}", D(2024, 1, 1 + i % 20), i, []) for i in range(60)])
    run_transfer(spark, rows.filter("v < 30"), dest, ts_col="ts", as_of=AS_OF, run_id="r0", buckets=2)
    res = run_transfer(spark, rows, dest, ts_col="ts", as_of=AS_OF, where="v % 2 = 0", splits=3,
                       compact_to=1, run_id="r1", buckets=2, new_only=False)
    got = read_bucketed(spark, dest)
    # full transfer of the even rows: 30 rows written (15 replace stored keys, 15 new)
    assert (res.found, res.written, res.before, res.after) == (30, 30, 30, 45)
    assert got.filter("v % 2 = 1 AND v >= 30").count() == 0
    assert file_count(spark, dest) <= 2            # compacted: about one file per bucket


def test_compact_only_given_buckets(spark, out):
    from docflow.sinks.collection import compact
    path = f"{out}/c"
    for i in range(3):
        part = spark.range(i * 40, (i + 1) * 40).select(F.col("id").cast("string").alias("id"), F.col("id").alias("v"))
        upsert_path(spark, path, part, "id", buckets=2)
    per_bucket = lambda: {b: file_count(spark, path, bucket=b) for b in (0, 1)}
    before = per_bucket()
    assert min(before.values()) >= 3
    compact(spark, path, 1, key="id", only_buckets=[0])
    after = per_bucket()
    assert after[0] == 1 and after[1] == before[1]
    assert read_bucketed(spark, path).count() == 120


ZONED = "id string, ts timestamp, v int"


@pytest.mark.parametrize("zone", ["Asia/Tokyo", "America/New_York", "UTC"])
def test_zoned_watermark_is_exact_in_any_zone(spark, out, zone, monkeypatch):
    import time
    monkeypatch.setenv("TZ", zone)
    time.tzset()
    utc = dt.timezone.utc
    at = lambda day, us=0: dt.datetime(2024, 3, day, 12, 0, 0, us, tzinfo=utc)
    rows = [("a", at(1), 1), ("b", at(5, 7), 2)]
    try:
        run_transfer(spark, spark.createDataFrame(rows, ZONED), f"{out}/d", ts_col="ts", as_of=at(20), run_id="r0",
                     buckets=2)
        more = spark.createDataFrame([*rows, ("c", at(5, 8), 3), ("d", at(6), 4), ("late", at(25), 5)], ZONED)
        res = run_transfer(spark, more, f"{out}/d", ts_col="ts", as_of=at(20), run_id="r1", buckets=2)
        assert (res.found, res.written) == (2, 2)
        res = run_transfer(spark, more, f"{out}/d", ts_col="ts", run_id="r2", buckets=2)      # now
        assert (res.found, res.written) == (1, 1)
    finally:
        monkeypatch.undo()
        time.tzset()


def test_epoch_number_watermark(spark, out):
    rows = spark.createDataFrame([("a", 1711120112345), ("b", 9)], "id string, ts long")
    run_transfer(spark, rows, f"{out}/d", ts_col="ts", as_of=2 * 10 ** 12, run_id="r0", buckets=2)
    more = rows.unionByName(spark.createDataFrame([("c", 1711120112346), ("d", 100)], "id string, ts long"))
    res = run_transfer(spark, more, f"{out}/d", ts_col="ts", as_of=2 * 10 ** 12, run_id="r1", buckets=2)
    assert (res.found, res.written, res.after) == (1, 1, 3)


def test_rows_by_other_writers_move_the_watermark(spark, out):
    run_transfer(spark, src(spark, [("a", D(2024, 1, 1), 1, [])]), f"{out}/d", ts_col="ts", as_of=AS_OF, buckets=2)
    upsert_path(spark, f"{out}/d", src(spark, [("b", D(2024, 1, 9), 1, [])]), "id", buckets=2)
    more = src(spark, [("b", D(2024, 1, 9), 1, []), ("c", D(2024, 1, 10), 1, [])])
    assert run_transfer(spark, more, f"{out}/d", ts_col="ts", as_of=AS_OF, buckets=2).found == 1


def test_null_keys_are_refused_before_anything_is_written(spark, out):
    rows = src(spark, [("a", D(2024, 1, 1), 1, []), (None, D(2024, 1, 2), 2, []), (None, D(2024, 1, 3), 3, [])])
    with pytest.raises(ValueError, match="rows have no id"):
        run_transfer(spark, rows, f"{out}/d", ts_col="ts", as_of=AS_OF, buckets=2)
    from docflow.sinks.collection import collection_exists
    assert not collection_exists(spark, f"{out}/d")


def test_bucket_count_and_key_type_are_checked(spark, out):
    base = spark.range(100).select(F.col("id"), F.col("id").alias("v"))
    upsert_path(spark, f"{out}/c", base, "id", buckets=8)
    with pytest.raises(ValueError, match="buckets"):
        upsert_path(spark, f"{out}/c", base, "id", buckets=16)
    with pytest.raises(ValueError, match="key_types"):
        upsert_path(spark, f"{out}/c", base.withColumn("id", F.col("id").cast("int")), "id", buckets=8)
    assert read_bucketed(spark, f"{out}/c").count() == 100


def test_null_upsert_keys_do_not_pile_up(spark, out):
    base = spark.createDataFrame([(None, 1), ("a", 2)], "id string, v int")
    for _ in range(3):
        upsert_path(spark, f"{out}/c", base, "id", buckets=2)
    assert read_bucketed(spark, f"{out}/c").count() == 2


def test_overwrite_leaves_no_old_partition(spark, out):
    from docflow.sinks.collection import write_collection
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "v int, p string")
        write_collection(df, f"{out}/w", mode="overwrite", partition_by=["p"])
        write_collection(df.where("p = 'a'"), f"{out}/w", mode="overwrite", partition_by=["p"])
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)
    assert spark.read.parquet(f"{out}/w").count() == 1
