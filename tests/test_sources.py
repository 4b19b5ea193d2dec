import pytest
from pyspark.sql import functions as F

from docflow.sources.collection import flatten_arrays, parse_fields, read_collection, top_k


def test_read_collection_options(spark, out):
    df = spark.createDataFrame([(i, f"t{i}", ["a", str(i)]) for i in range(20)],
                               "id long, body string, tags array<string>")
    df.write.parquet(f"{out}/c")
    got = read_collection(spark, f"{out}/c", where="id >= 5", fields="id, tags", max_rows=3,
                          order_by="id", flatten_multivalued=True).collect()
    assert [(r["id"], r["tags"]) for r in got] == [(5, "a 5"), (6, "a 6"), (7, "a 7")]
    plan = read_collection(spark, f"{out}/c", splits=64)._jdf.queryExecution().toString()
    assert "RoundRobin" not in plan and spark.conf.get("spark.sql.files.minPartitionNum", None) is None
    df.createOrReplaceTempView("coll_view")
    assert read_collection(spark, "coll_view", format="table", where=F.col("id") < 3).count() == 3


def test_parse_fields_and_top_k(spark):
    assert parse_fields("id, body_t") == ["id", "body_t"]
    df = spark.createDataFrame([(1, 5), (2, None), (3, 9), (4, 9)], "id int, ts int")
    assert [r["id"] for r in top_k(df, "ts", 3, fields=["id"], tiebreak=["id"]).collect()] == [4, 3, 1]


def test_flatten_arrays_only_string_arrays(spark):
    df = spark.createDataFrame([(["x", "y"], [1.0])], "a array<string>, v array<double>")
    row = flatten_arrays(df).first()
    assert row["a"] == "x y" and row["v"] == [1.0]


def test_read_with_option_map(spark, out):
    from docflow.sources.collection import read_with_options
    df = spark.createDataFrame([(i, [f"w{i}", "x"]) for i in range(30)], "id long, body_t array<string>")
    df.write.parquet(f"{out}/notes")
    opts = {"collection": "notes", "fields": "id, body_t", "max_rows": "7", "query": "size(body_t) > 0",
            "flatten_multivalued": "true"}
    got = read_with_options(spark, f"{out}/notes", opts).collect()
    assert len(got) == 7 and got[0]["body_t"] == "w0 x"
    assert read_with_options(spark, f"{out}/notes", {"query": "*:*"}).count() == 30
    both = {"query": "id >= 5", "solr.params": "fq=id < 20&fq=id % 2 = 0"}
    assert read_with_options(spark, f"{out}/notes", both).count() == 7
    assert read_with_options(spark, f"{out}/notes", {"fq": "id < 3"}).count() == 3
    for bad in ({"filter": "id < 3"}, {"solr.params": "sort=id"}):
        with pytest.raises(ValueError):
            read_with_options(spark, f"{out}/notes", bad)


def test_splits_are_those_of_one_read(spark, out):
    df = spark.range(200_000).withColumn("v", F.sha2(F.col("id").cast("string"), 256))
    df.coalesce(1).write.option("parquet.block.size", 256 * 1024).parquet(f"{out}/c")
    plain = read_collection(spark, f"{out}/c")
    before = plain.rdd.getNumPartitions()
    many = read_collection(spark, f"{out}/c", splits=24)
    assert many.rdd.getNumPartitions() >= 24 > before == read_collection(spark, f"{out}/c").rdd.getNumPartitions()
    assert many.join(plain, "id").count() == 200_000
