from pyspark.sql import functions as F

from docflow.operators.enrich import (GazetteerTagger, entity_columns, entity_sets, gazetteer,
                                     map_tagger, tag_entities, tokenize, tokens)
from docflow.operators.upsert import atomic_add, upsert
from docflow.plans.enrichment import entity_rows, run_enrichment

ENTRIES = [("Paris", "LOCATION"), ("Acme", "ORGANIZATION"), ("Ada", "PERSON"), ("the", "O")]


def docs(spark):
    return spark.createDataFrame([
        ("1", ["Ada went to Paris", "Ada met Acme"]),
        ("2", ["nothing to see in the text"]),
        ("3", None),
    ], "id string, body_t array<string>")


def test_tokenize_unicode(spark):
    df = spark.createDataFrame([("Grüße, naïve café 42!",)], "t string")
    assert df.select(tokenize("t")).first()[0] == ["Grüße", "naïve", "café", "42"]


def test_entity_rows_keep_docs_without_entities(spark):
    out = {r["id"]: r for r in entity_rows(docs(spark), gazetteer(spark, ENTRIES)).collect()}
    assert set(out) == {"1", "2"}                       # null text skipped, empty kept
    assert out["1"]["location_ss"] == ["Paris"] and out["1"]["person_ss"] == ["Ada"]
    assert out["1"]["organization_ss"] == ["Acme"]
    assert (out["2"]["location_ss"], out["2"]["organization_ss"], out["2"]["person_ss"]) == ([], [], [])


def test_entity_sets_drop_other_class(spark):
    d = spark.createDataFrame([(1, "the Ada the Ada Paris")], "id long, text string")
    tags = tag_entities(tokens(d, "id", "text"), gazetteer(spark, ENTRIES))
    got = {r["entity_class"]: r["words"] for r in entity_sets(tags, "id").collect()}
    assert got == {"PERSON": ["Ada"], "LOCATION": ["Paris"]}


def test_udf_tagger_matches_gazetteer_join(spark):
    d = docs(spark).filter(F.col("body_t").isNotNull())
    flat = d.select("id", F.array_join("body_t", " ").alias("text"))
    udf = map_tagger(flat, lambda files: GazetteerTagger(ENTRIES), id_col="id", text_col="text")
    join = entity_rows(d, gazetteer(spark, ENTRIES))
    assert sorted(map(tuple, udf.collect())) == sorted(map(tuple, join.collect()))


def test_gazetteer_paths_by_size(spark):
    d = spark.createDataFrame([(1, "Ada met the Acme people")], "id long, text string")
    tok = tokens(d, "id", "text")
    table = spark.createDataFrame([*ENTRIES, ("Ada", "A-CLASS"), ("Acme", None), (None, "PERSON")],
                                  "token string, entity_class string")

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    broadcast = tag_entities(tok, table)                              # bytes fit: a checked broadcast
    assert "BroadcastHashJoin" in plan(broadcast)
    shuffled = tag_entities(tok, table, max_broadcast_bytes=10)       # over the bound: no hint
    rows = [sorted((r["pos"], r["token"], r["entity_class"]) for r in df.collect()) for df in (broadcast, shuffled)]
    # a repeated word has one class, words without a class drop out, whatever the join
    assert rows[0] == rows[1] == [(0, "Ada", "PERSON"), (2, "the", "O"), (3, "Acme", "ORGANIZATION")]


def test_gazetteer_from_table_path_or_pairs(spark, out):
    from docflow.operators.enrich import read_gazetteer
    gazetteer(spark, ENTRIES).write.parquet(f"{out}/gaz")
    dest = spark.createDataFrame([], "id string, person_ss array<string>, location_ss array<string>, "
                                     "organization_ss array<string>")
    runs = [sorted(map(str, run_enrichment(spark, docs(spark), g, dest).collect()))
            for g in (ENTRIES, f"{out}/gaz", read_gazetteer(spark, ENTRIES))]
    assert runs[0] == runs[1] == runs[2]


def test_large_gazetteer_costs_like_a_small_one(spark):
    import time
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    many = spark.range(20_000).select(F.concat(F.lit("entry"), F.col("id")).alias("token"),
                                      F.lit("PERSON").alias("entity_class"))

    def seconds(gaz):
        t0 = time.perf_counter()
        tag_entities(tokens(d, "doc_id", "text"), gaz).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    small = gazetteer(spark, ENTRIES)
    seconds(small)
    assert seconds(many) < 2 * seconds(small) + 2


def test_distinct_adds_are_collected_as_sets(spark):
    dest = spark.createDataFrame([("a", ["x"], ["k"])], "id string, t array<string>, u array<string>")
    adds = spark.createDataFrame([("a", ["y", "x"], None), ("a", ["y"], ["k", "m"]), ("b", [], []), (None, ["n"], [])],
                                 "id string, t array<string>, u array<string>")
    df = atomic_add(dest, adds, "id", ["t", "u"], distinct=True)
    assert "collect_set" in df._jdf.queryExecution().executedPlan().toString()
    got = {r["id"]: (sorted(r["t"]), sorted(r["u"])) for r in df.collect()}
    assert got == {"a": (["x", "y"], ["k", "m"]), "b": ([], []), None: (["n"], [])}


def test_atomic_add_present_absent_null(spark):
    dest = spark.createDataFrame([("a", ["x"], 1), ("c", None, 3)], "id string, tags array<string>, n int")
    adds = spark.createDataFrame([("a", ["y"]), ("b", ["z"]), ("c", ["w"]), ("a", ["y2"])],
                                 "id string, tags array<string>")
    got = {r["id"]: (sorted(r["tags"]), r["n"]) for r in atomic_add(dest, adds, "id", ["tags"]).collect()}
    assert got == {"a": (["x", "y", "y2"], 1), "b": (["z"], None), "c": (["w"], 3)}
    dup = spark.createDataFrame([("a", ["x"])], "id string, tags array<string>")
    assert atomic_add(dest, dup, "id", ["tags"], distinct=True).filter("id = 'a'").first()["tags"] == ["x"]


def test_run_enrichment_merges_back(spark):
    dest = spark.createDataFrame([("1", ["Ada"], [], []), ("9", [], [], [])],
                                 "id string, person_ss array<string>, location_ss array<string>, "
                                 "organization_ss array<string>")
    out = {r["id"]: r for r in run_enrichment(spark, docs(spark), ENTRIES, dest).collect()}
    assert sorted(out["1"]["person_ss"]) == ["Ada"]          # distinct add
    assert out["1"]["location_ss"] == ["Paris"] and out["9"]["person_ss"] == []
    assert "2" in out


def test_null_keys_upsert_once(spark):
    dest = spark.createDataFrame([(None, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(None, "A")], "k int, v string")
    assert sorted(map(str, upsert(upsert(dest, new, "k"), new, "k").collect())) == sorted(map(str, upsert(dest, new, "k").collect()))
    assert upsert(dest, new, "k").count() == 2


def test_upsert_replaces_and_inserts(spark):
    dest = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    once = upsert(dest, new, "k")
    assert sorted(map(tuple, once.collect())) == [(1, "a"), (2, "B"), (3, "C")]
    assert sorted(map(tuple, upsert(once, new, "k").collect())) == sorted(map(tuple, once.collect()))


def test_entity_columns_single_aggregation(spark):
    tags = spark.createDataFrame([(1, "Ada", "PERSON")], "id long, token string, entity_class string")
    ids = spark.createDataFrame([(1,), (2,)], "id long")
    plan = entity_columns(tags, ids, "id")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_map_tagger_side_file(spark, out):
    import os
    path = os.path.join(out, "gaz.tsv")
    with open(path, "w") as f:
        f.write("Ada\tPERSON\nParis\tLOCATION\n")

    def factory(files):
        with open(files["gaz.tsv"]) as fh:
            return GazetteerTagger(line.rstrip("\n").split("\t") for line in fh)

    d = spark.createDataFrame([("1", "Ada in Paris")], "id string, text string")
    row = map_tagger(d, factory, side_files=[path]).first()
    assert (row["person_ss"], row["location_ss"], row["organization_ss"]) == (["Ada"], ["Paris"], [])


def test_entity_rows_same_on_every_gazetteer_path(spark):
    want = sorted(map(tuple, entity_rows(docs(spark), gazetteer(spark, ENTRIES)).collect()))
    assert sorted(map(tuple, entity_rows(docs(spark), gazetteer(spark, ENTRIES), max_broadcast_bytes=1).collect())) == want


def test_entity_sets_of_docs_paths_agree(spark):
    from docflow.operators.enrich import entity_sets_of_docs
    d = spark.createDataFrame([(1, "the Ada the Ada Paris"), (2, "nothing"), (3, "Acme Ada")], "id long, text string")
    near = entity_sets_of_docs(d, gazetteer(spark, ENTRIES), "id", "text")
    joined = entity_sets_of_docs(d, gazetteer(spark, ENTRIES), "id", "text", max_broadcast_bytes=1)
    rows = [sorted((r["id"], r["entity_class"], tuple(r["words"])) for r in df.collect()) for df in (near, joined)]
    assert rows[0] == rows[1] == [(1, "LOCATION", ("Paris",)), (1, "PERSON", ("Ada",)),
                                  (3, "ORGANIZATION", ("Acme",)), (3, "PERSON", ("Ada",))]
