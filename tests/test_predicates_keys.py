import datetime as dt

import pytest
from pyspark.sql import functions as F

from docflow.functions.keys import natural_key, split_key_fields, with_natural_key
from docflow.functions.predicates import all_of, exists, field_exists, match_all, range_, term


def ids(df):
    return sorted(r[0] for r in df.collect())


def test_range_half_open_and_unbounded(spark):
    df = spark.createDataFrame([(1, 5), (2, 10), (3, 15), (4, None)], "id int, v int")
    assert ids(df.filter(range_("v", 5, 15))) == [2, 3]          # low exclusive, high inclusive
    assert ids(df.filter(range_("v", None, 10))) == [1, 2]       # open below, null never matches
    assert ids(df.filter(range_("v", 5, 15, lo_inclusive=True, hi_inclusive=False))) == [1, 2]


def test_exists_term_all_of(spark):
    df = spark.createDataFrame([(1, ["a"], "x"), (2, [], "y"), (3, None, None)],
                               "id int, arr array<string>, s string")
    assert ids(df.filter(field_exists(df, "arr"))) == [1]
    assert ids(df.filter(exists("s"))) == [1, 2]
    assert ids(df.filter(term("arr", "a", is_array=True))) == [1]
    assert ids(df.filter(all_of(term("s", "x"), "id < 5"))) == [1]
    assert ids(df.filter(all_of())) == [1, 2, 3]
    assert ids(df.filter(match_all())) == [1, 2, 3]


def test_natural_key_null_int_date(spark):
    df = spark.createDataFrame([("a", None, dt.date(2024, 1, 2))], "s string, i int, d date")
    assert df.select(natural_key(df, ["s", "i", "d"]).alias("k")).first()[0] == "a||2024-01-02"
    df2 = spark.createDataFrame([(None, 7, None)], "s string, i int, d date")
    assert df2.select(natural_key(df2, ["s", "i", "d"])).first()[0] == "|7|"


def test_natural_key_rejects_arrays(spark):
    df = spark.createDataFrame([(1, ["x"])], "id int, tags array<string>")
    with pytest.raises(ValueError, match="only scalar"):
        natural_key(df, ["tags"])


def test_natural_key_overwrites_id_or_keeps(spark):
    df = spark.createDataFrame([("old", 1, 2)], "id string, a int, b int")
    assert with_natural_key(df, ["a", "b"]).first()["id"] == "1|2"
    assert with_natural_key(df, []).first()["id"] == "old"
    assert split_key_fields("a, b") == ["a", " b"]   # parts are not trimmed
    assert split_key_fields("  ") == []


def test_range_literal_keeps_microseconds(spark):
    t = dt.datetime(2024, 1, 1, 0, 0, 0, 123456)
    df = spark.createDataFrame([(1, t), (2, t + dt.timedelta(microseconds=1))], "id int, ts timestamp_ntz")
    assert ids(df.filter(range_("ts", t, None, dtype="timestamp_ntz"))) == [2]
    assert df.filter(F.col("ts") == F.lit("2024-01-01 00:00:00.123456").cast("timestamp_ntz")).count() == 1
