"""Random inputs against brute-force Python models (hypothesis, few examples: each runs Spark)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from docflow.operators.latest import latest_per_key
from docflow.operators.numbering import batch_ids, ordinal_within
from docflow.operators.upsert import upsert

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])

keys = st.sampled_from(["hot", "hot", "hot", "a", "b", "c"])          # one key dominates
rows = st.lists(st.tuples(keys, st.integers(0, 50), st.one_of(st.none(), st.integers(0, 5))),
                min_size=1, max_size=60)


@SETTINGS
@given(rows)
def test_latest_per_key_model(spark, data):
    # unique tie-break: position in the list
    data = [(k, o, v, i) for i, (k, o, v) in enumerate(data)]
    df = spark.createDataFrame(data, "k string, o int, v int, i int")
    got = sorted(map(tuple, latest_per_key(df, ["k"], ["v", "o", "i"]).collect()))

    def rank(r):   # nulls sort below any value, as in Spark's struct ordering
        return (r[2] is not None, r[2] if r[2] is not None else 0, r[1], r[3])

    best = {}
    for r in data:
        if r[0] not in best or rank(r) > rank(best[r[0]]):
            best[r[0]] = r
    assert got == sorted(best.values())


@SETTINGS
@given(st.lists(st.tuples(keys, st.integers(-10_000, 10_000)), min_size=1, max_size=80, unique_by=lambda r: r[1]),
       st.integers(1, 300), st.integers(1, 7))
def test_ordinal_and_batches_model(spark, data, width, batch):
    df = spark.createDataFrame(data, "g string, o long")
    got = {(r["g"], r["o"]): r["rn"] for r in ordinal_within(df, ["g"], "o", ranges=1 + width % 9).collect()}
    model = {}
    for g in {r[0] for r in data}:
        for pos, o in enumerate(sorted(o for gg, o in data if gg == g), start=1):
            model[(g, o)] = pos
    assert got == model
    got_b = {(r["g"], r["o"]): r["batch_id"] for r in batch_ids(df, ["g"], "o", batch).collect()}
    assert got_b == {k: (v - 1) // batch for k, v in model.items()}


@SETTINGS
@given(st.dictionaries(st.integers(0, 30), st.integers(0, 9), max_size=20),
       st.dictionaries(st.integers(0, 30), st.integers(10, 19), max_size=20))
def test_upsert_model(spark, dest, new):
    d = spark.createDataFrame(list(dest.items()), "k int, v int")
    n = spark.createDataFrame(list(new.items()), "k int, v int")
    once = upsert(d, n, "k")
    assert sorted(map(tuple, once.collect())) == sorted({**dest, **new}.items())
    assert sorted(map(tuple, upsert(once, n, "k").collect())) == sorted({**dest, **new}.items())
