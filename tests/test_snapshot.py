"""The collection at rest: one commit point, zone maps, filters, writers side by side, adds."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from docflow.operators.upsert import atomic_add
from docflow.plans import transfer
from docflow.plans.transfer import TAG_COL, run_transfer
from docflow.sinks import collection, manifest
from docflow.sinks.collection import (BUCKET_COL, atomic_add_path, compact, file_count, fold_adds, read_bucketed, stored_count,
                                      stored_newest, upsert_path)

D = dt.datetime
AS_OF = D(2024, 1, 25)
EVENTS = "id string, ts timestamp_ntz, v int"


def rows(spark, lo, hi, v=0):
    return spark.range(lo, hi).select(F.col("id").cast("string").alias("id"), (F.col("id") + v).alias("v"))


def content(spark, path, **how):
    return sorted((r["id"], r["v"]) for r in read_bucketed(spark, path, **how).collect())


def files(spark, path):
    return {r["path"]: r["bucket"] for r in manifest.snapshot(spark, path).files.where("kind <> 'marker'").collect()}


STEPS = [(manifest, "write_files"), (manifest, "_write_filters"), (manifest, "create_once"), (collection, "_holding"),
         (collection, "fold_adds")]


@pytest.mark.parametrize("module,name", STEPS, ids=[n for _, n in STEPS])
@pytest.mark.parametrize("after", [False, True])
def test_a_run_killed_at_any_step_leaves_a_whole_state(spark, out, monkeypatch, module, name, after):
    path = f"{out}/c"
    upsert_path(spark, path, rows(spark, 0, 60), "id", buckets=4)
    old = content(spark, path)
    updates = rows(spark, 50, 70, v=1000)
    new = sorted(dict(old) | {r["id"]: r["v"] for r in updates.collect()})
    real = getattr(module, name)

    def killed(*a, **k):
        if after:
            real(*a, **k)
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(module, name, killed)
        with pytest.raises(RuntimeError, match="driver lost"):
            upsert_path(spark, path, updates, "id", buckets=4)
    committed = name == "create_once" and after
    assert [k for k, _ in content(spark, path)] == (new if committed else [k for k, _ in old])
    upsert_path(spark, path, updates, "id", buckets=4)          # and the next run makes it good
    got = dict(content(spark, path))
    assert sorted(got) == new and got["55"] == 1055 and got["5"] == 5


def test_a_reader_keeps_its_state_during_an_upsert(spark, out):
    path = f"{out}/c"
    upsert_path(spark, path, rows(spark, 0, 100), "id", buckets=4)
    before = read_bucketed(spark, path)                         # resolved, not read yet
    upsert_path(spark, path, rows(spark, 0, 120, v=5), "id", buckets=4)
    compact(spark, path, 1)
    assert sorted((r["id"], r["v"]) for r in before.collect()) == sorted((str(k), k) for k in range(100))
    assert content(spark, path) == sorted((str(k), k + 5) for k in range(120))
    assert manifest.vacuum(spark, path, keep_s=0) > 0           # replaced files go when nobody reads them
    assert content(spark, path) == sorted((str(k), k + 5) for k in range(120))
    left = [f for _, _, names in os.walk(f"{path}/_data") for f in names if f.endswith(".parquet")]
    live = files(spark, path)
    assert sum(f.startswith("part-") and any(p.endswith(f) for p in live) for f in left) == len(live)


def test_leftovers_of_a_dead_run_are_deleted(spark, out, monkeypatch):
    path = f"{out}/c"
    upsert_path(spark, path, rows(spark, 0, 10), "id", buckets=2)
    with monkeypatch.context() as m:
        m.setattr(manifest, "create_once", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            upsert_path(spark, path, rows(spark, 5, 15), "id", buckets=2)
    dead = set(os.listdir(f"{path}/_data"))
    manifest.vacuum(spark, path, keep_s=0)
    assert set(os.listdir(f"{path}/_data")) < dead and len(content(spark, path)) == 10


def test_lost_rows_are_noticed_before_the_commit(spark, out, monkeypatch):
    path = f"{out}/c"
    upsert_path(spark, path, rows(spark, 0, 50), "id", buckets=2)
    with monkeypatch.context() as m:
        m.setattr(manifest, "entries", lambda s, p, parts, e=manifest.entries: e(s, p, parts).limit(1))
        with pytest.raises(manifest.LostRows):
            manifest.write_files(spark, path, rows(spark, 0, 50).withColumn(BUCKET_COL, collection.bucket_of("id", 2)),
                                 ["id"], 2, F.lit(0))
    assert len(content(spark, path)) == 50


# ---- zone maps and the incremental run -------------------------------------------


def events(spark, days, v=0):
    return spark.createDataFrame([(f"k{d}", D(2024, 1, d), v) for d in days], EVENTS)


def test_an_incremental_run_does_not_scan_the_destination(spark, out, monkeypatch):
    dest = f"{out}/d"
    run_transfer(spark, events(spark, range(1, 9)), dest, ts_col="ts", as_of=AS_OF, run_id="r0", buckets=2)
    scans = []
    with monkeypatch.context() as m:
        m.setattr(collection, "_rows_of", lambda s, p, snap, names, lost_files=False, real=collection._rows_of: (
            scans.append((len(names), lost_files)), real(s, p, snap, names, lost_files))[1])
        m.setattr(collection, "newest_mark", lambda *a: pytest.fail("the destination's column was scanned"))
        res = run_transfer(spark, events(spark, range(1, 12)), dest, ts_col="ts", as_of=AS_OF, run_id="r1", buckets=2)
    assert (res.found, res.written, res.before, res.after, res.lost) == (3, 3, 8, 11, 0)
    # the only rows read are those of the files just written, to count them (A5)
    assert all(lost for n, lost in scans if n)


def test_zone_maps_of_all_types(spark, out):
    at = D(2024, 3, 1, 12, 0, 0, 7)
    df = spark.createDataFrame([("a", at, at, at.date(), -3, 1.5), ("b", None, None, None, None, None)],
                               "id string, n timestamp_ntz, z timestamp, d date, i bigint, f double")
    upsert_path(spark, f"{out}/c", df, "id", buckets=2)
    snap = manifest.snapshot(spark, f"{out}/c")
    for column in ("n", "z", "d", "i", "f"):
        assert stored_newest(spark, f"{out}/c", column) == collection.newest_mark(df, column), column
    assert manifest.stored_rows(snap) == (2, False) and stored_newest(spark, f"{out}/c", "absent") is None


def test_files_by_other_writers_count_and_are_taken_in(spark, out):
    path = f"{out}/c"
    upsert_path(spark, path, events(spark, range(1, 5)), "id", buckets=2)
    events(spark, [20, 21], v=7).drop("v").write.mode("append").parquet(path)            # lacks a column
    assert stored_newest(spark, path, "ts").text.startswith("2024-01-21") and stored_count(spark, path) == 6
    assert sorted(r["id"] for r in read_bucketed(spark, path).collect()) == sorted(f"k{d}" for d in (1, 2, 3, 4, 20, 21))
    more = events(spark, [20, 22], v=9)
    upsert_path(spark, path, more, "id", buckets=2)
    got = {r["id"]: r["v"] for r in read_bucketed(spark, path).collect()}
    assert len(got) == 7 and got["k20"] == 9 and got["k21"] is None and stored_count(spark, path) == 7
    assert manifest.foreign_files(spark, path, manifest.snapshot(spark, path)) == []


def test_a_plain_collection_becomes_one_of_ours(spark, out):
    path = f"{out}/c"
    rows(spark, 0, 20).write.parquet(path)
    upsert_path(spark, path, rows(spark, 10, 30, v=100), "id", buckets=4)
    assert content(spark, path) == sorted((str(k), k + (100 if k > 9 else 0)) for k in range(30))


# ---- filters ---------------------------------------------------------------------


def test_ten_keys_read_only_files_that_may_hold_them(spark, out, monkeypatch):
    path = f"{out}/c"
    for part in range(6):                                       # files of one bucket with overlapping key ranges
        mine = spark.range(3000).where(F.col("id") % 6 == part)
        upsert_path(spark, path, mine.select(F.sha2(F.col("id").cast("string"), 256).alias("id"), F.col("id").alias("v")), "id", buckets=2)
    wanted = spark.range(10).select(F.sha2((F.col("id") * 6).cast("string"), 256).alias("id"), F.lit(-1).cast("long").alias("v"))
    snap = manifest.snapshot(spark, path)
    asked = wanted.withColumn(BUCKET_COL, collection.bucket_of("id", 2))
    data = snap.files.where("kind = 'data'")
    maybe = manifest.may_hold(spark, path, data, asked, ["id"])
    holding = collection._holding(spark, path, snap, asked, ["id"], True)
    assert data.count() == 12 and len(holding) == 2 and set(holding) <= {r["path"] for r in maybe.collect()}
    assert maybe.count() <= 4 and set(holding) == set(collection._holding(spark, path, snap, asked, ["id"], True, filters=False))
    kept = set(files(spark, path)) - set(holding)
    upsert_path(spark, path, wanted, "id", buckets=2)
    assert kept <= set(files(spark, path)) and stored_count(spark, path) == 3000
    assert read_bucketed(spark, path).where("v = -1").count() == 10


@pytest.mark.parametrize("filters", [True, False])
def test_filters_do_not_change_the_result(spark, out, filters):
    rng = random.Random(4)
    path, want = f"{out}/c", {}
    for turn in range(4):
        batch = {rng.choice([None, f"k{rng.randrange(80)}", f"{rng.randrange(9)}"]): turn * 100 + n for n in range(30)}
        want |= batch
        upsert_path(spark, path, spark.createDataFrame(list(batch.items()), "id string, v long"), "id", buckets=3, filters=filters)
    assert {r["id"]: r["v"] for r in read_bucketed(spark, path).collect()} == want and stored_count(spark, path) == len(want)


def test_batch_size_holds_in_files_written_anew(spark, out):
    path = f"{out}/c"
    upsert_path(spark, path, rows(spark, 0, 500), "id", buckets=2, batch_size=40)
    upsert_path(spark, path, rows(spark, 0, 500, v=1), "id", buckets=2, batch_size=40)
    snap = manifest.snapshot(spark, path)
    assert snap.files.agg(F.max("rows")).first()[0] <= 40 and stored_count(spark, path) == 500


# ---- writers side by side ----------------------------------------------------------


def interleaved(monkeypatch, other):
    """Run ``other`` once, just before the next commit."""
    real, calls = manifest.commit, []

    def late(*a, **k):
        if not calls:
            calls.append(1)
            other()
        return real(*a, **k)

    monkeypatch.setattr(manifest, "commit", late)
    return calls


@pytest.mark.parametrize("first", [True, False], ids=["first load", "stored"])
def test_two_writers_lose_no_row(spark, out, monkeypatch, first):
    path = f"{out}/c"
    if not first:
        upsert_path(spark, path, rows(spark, 0, 50), "id", buckets=2)
    interleaved(monkeypatch, lambda: upsert_path(spark, path, rows(spark, 40, 80, v=1), "id", buckets=2))
    upsert_path(spark, path, rows(spark, 60, 100, v=2), "id", buckets=2)
    got = dict(content(spark, path))
    assert got == {str(k): k + (2 if k >= 60 else 1) for k in range(40, 100)} | ({} if first else {str(k): k for k in range(40)})


def test_writers_of_other_buckets_do_not_wait(spark, out, monkeypatch):
    path = f"{out}/c"
    upsert_path(spark, path, rows(spark, 0, 50), "id", buckets=8)
    with_bucket = rows(spark, 100, 400).withColumn("b", collection.bucket_of("id", 8))
    mine, theirs = (with_bucket.where(F.col("b") == b).drop("b") for b in (1, 2))
    merges = []
    real = collection._merge
    monkeypatch.setattr(collection, "_merge", lambda *a: (merges.append(1), real(*a))[1])
    interleaved(monkeypatch, lambda: upsert_path(spark, path, theirs, "id", buckets=8))
    upsert_path(spark, path, mine, "id", buckets=8)
    assert len(merges) == 2 and stored_count(spark, path) == 50 + mine.count() + theirs.count()


def test_a_number_is_given_once(spark, out):
    assert manifest.create_once(spark, f"{out}/log", "1.json", {"a": 1})
    assert not manifest.create_once(spark, f"{out}/log", "1.json", {"a": 2})
    assert manifest.read_json(spark, f"{out}/log/1.json") == {"a": 1}
    assert sorted(f for f in os.listdir(f"{out}/log") if not f.endswith(".crc")) == ["1.json"]


def test_parts_are_drawn_together(spark, out, monkeypatch):
    monkeypatch.setattr(manifest, "MOST_PARTS", 3)
    path = f"{out}/c"
    for k in range(6):
        upsert_path(spark, path, rows(spark, k * 5, k * 5 + 10, v=k * 100), "id", buckets=2)
    assert len(manifest.snapshot(spark, path).info["parts"]) <= 3
    assert stored_count(spark, path) == 35 and dict(content(spark, path))["12"] == 12 + 200
    manifest.vacuum(spark, path, keep_s=0)
    assert len(content(spark, path)) == 35


def test_two_transfers_lose_no_row(spark, out, monkeypatch):
    dest = f"{out}/d"
    run_transfer(spark, events(spark, [1, 2]), dest, ts_col="ts", as_of=AS_OF, run_id="r0", buckets=2)
    other = lambda: run_transfer(spark, events(spark, [3, 5], v=1), dest, ts_col="ts", as_of=AS_OF, run_id="r1", buckets=2)
    interleaved(monkeypatch, other)
    res = run_transfer(spark, events(spark, [3, 4], v=2), dest, ts_col="ts", as_of=AS_OF, run_id="r2", buckets=2)
    got = {r["id"]: (r["v"], r[TAG_COL]) for r in read_bucketed(spark, dest).collect()}
    assert got == {"k1": (0, "r0"), "k2": (0, "r0"), "k3": (2, "r2"), "k4": (2, "r2"), "k5": (1, "r1")} and res.lost == 0


# ---- counts taken during the write ----------------------------------------------------


@pytest.mark.parametrize("new_only", [True, False])
def test_a_lost_file_is_reported(spark, out, monkeypatch, new_only):
    dest = f"{out}/d"
    run_transfer(spark, events(spark, [1, 2]), dest, ts_col="ts", as_of=AS_OF, run_id="r0", buckets=2)
    real = transfer.upsert_path

    def then_lose(s, path, *a, **k):
        done = real(s, path, *a, **k)
        newest = s.read.json(f"{path}/_log/{manifest._name(manifest.newest_number(s, path))}").first()["parts"][-2:]
        victim = manifest.entries(s, path, newest).where("op = 1").orderBy(F.desc("rows")).first()
        os.remove(f"{path}/_data/{victim['path']}")
        then_lose.rows = victim["rows"]
        return done

    monkeypatch.setattr(transfer, "upsert_path", then_lose)
    res = run_transfer(spark, events(spark, range(3, 15), v=1), dest, ts_col="ts", as_of=AS_OF, run_id="r1", buckets=2, new_only=new_only)
    assert res.found == 12 and res.written < 12 and res.lost == 12 - res.written
    assert transfer.last_run(spark, dest)["state"] == "started"       # the next run sends the rows again


def test_full_run_counts_found_and_written_apart(spark, out):
    twice = events(spark, [1, 1, 2, 3])
    res = run_transfer(spark, twice, f"{out}/d", ts_col="ts", new_only=False, run_id="r", buckets=2)
    assert (res.found, res.written, res.after, res.lost) == (4, 3, 3, 0)


def test_all_rows_without_a_key_are_counted(spark, out):
    bad = spark.createDataFrame([(None, D(2024, 1, 1), 1), (None, D(2024, 1, 2), 2), ("a", D(2024, 1, 3), 3)], EVENTS)
    with pytest.raises(ValueError, match="2 rows have no id"):
        run_transfer(spark, bad, f"{out}/d", ts_col="ts", as_of=AS_OF, buckets=2)


# ---- adds at rest -----------------------------------------------------------------------

TAGGED = "id string, lang string, tags array<string>, n array<int>"


def tagged(spark, data):
    return spark.createDataFrame(data, TAGGED)


def arrays(df):
    return sorted((r["id"] or "", r["lang"], None if r["tags"] is None else sorted(r["tags"]), r["n"]) for r in df.collect())


@pytest.mark.parametrize("distinct", [True, False])
def test_adds_are_read_folded_and_made_once(spark, out, distinct):
    path = f"{out}/c"
    base = tagged(spark, [(f"k{i}", "en", ["a"], [i]) for i in range(20)] + [("none", "de", None, None)])
    upsert_path(spark, path, base, "id", buckets=8)
    before = files(spark, path)
    adds = spark.createDataFrame([("k1", ["a", "b"]), ("k1", ["c"]), ("fresh", ["x"]), ("none", None)], "id string, tags array<string>")
    assert atomic_add_path(spark, path, adds, ["tags"], batch_id="b1", distinct=distinct)
    assert not atomic_add_path(spark, path, adds, ["tags"], batch_id="b1", distinct=distinct)       # a replay adds nothing
    want = arrays(atomic_add(base, adds, "id", ["tags"], distinct=distinct))
    want = [(i, g, None if i == "none" else t, n) for i, g, t, n in want]
    assert arrays(read_bucketed(spark, path)) == want and stored_count(spark, path) == 22
    assert {f: b for f, b in files(spark, path).items() if f in before} == before       # nothing written anew yet
    folded = fold_adds(spark, path)
    after = files(spark, path)
    assert folded and all(f in after for f, b in before.items() if b not in folded)
    assert sum(f not in after for f in before) <= 2                                     # the files of k1 and none
    assert arrays(read_bucketed(spark, path)) == want and fold_adds(spark, path) == []
    assert not atomic_add_path(spark, path, adds, ["tags"], batch_id="b1", distinct=distinct)       # not after folding either
    assert atomic_add_path(spark, path, adds, ["tags"], batch_id="b2", distinct=distinct)
    with pytest.raises(ValueError, match="distinct"):
        atomic_add_path(spark, path, adds, ["tags"], batch_id="b3", distinct=not distinct)


def test_an_upsert_replaces_what_was_added_before_it(spark, out):
    path = f"{out}/c"
    upsert_path(spark, path, tagged(spark, [("a", "en", ["x"], []), ("b", "en", ["x"], [])]), "id", buckets=1)
    atomic_add_path(spark, path, spark.createDataFrame([("a", ["y"]), ("b", ["y"])], "id string, tags array<string>"), ["tags"], batch_id="1")
    upsert_path(spark, path, tagged(spark, [("a", "de", ["z"], [])]), "id", buckets=1)
    atomic_add_path(spark, path, spark.createDataFrame([("a", ["w"], [7])], "id string, tags array<string>, n array<int>"), ["tags", "n"], batch_id="2")
    assert arrays(read_bucketed(spark, path)) == [("a", "de", ["w", "z"], [7]), ("b", "en", ["x", "y"], [])]


def test_adds_and_writers_side_by_side(spark, out, monkeypatch):
    path = f"{out}/c"
    upsert_path(spark, path, tagged(spark, [(f"k{i}", "en", [], []) for i in range(9)]), "id", buckets=2)
    add = lambda b, v: atomic_add_path(spark, path, spark.createDataFrame([("k3", [v])], "id string, tags array<string>"), ["tags"], batch_id=b)
    interleaved(monkeypatch, lambda: add("one", "1"))
    assert add("two", "2")
    interleaved(monkeypatch, lambda: add("three", "3"))
    fold_adds(spark, path)
    interleaved(monkeypatch, lambda: add("four", "4"))
    assert not add("four", "4")                                                         # the same batch by two runs
    got = {i: t for i, _, t, _ in arrays(read_bucketed(spark, path))}
    assert got["k3"] == ["1", "2", "3", "4"]


def test_adds_make_a_collection(spark, out):
    adds = spark.createDataFrame([("a", ["x"]), ("a", ["y"])], "id string, tags array<string>")
    with pytest.raises(ValueError, match="one key column"):
        atomic_add_path(spark, f"{out}/c", adds, ["tags"], batch_id="1")
    assert atomic_add_path(spark, f"{out}/c", adds, ["tags"], batch_id="1", key="id", buckets=2)
    compact(spark, f"{out}/c", 1)
    assert sorted(read_bucketed(spark, f"{out}/c").first()["tags"]) == ["x", "y"] and file_count(spark, f"{out}/c") == 1
