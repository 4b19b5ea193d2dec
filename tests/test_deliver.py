import os

import pytest

from pyspark.sql import functions as F

from docflow.functions.urls import form_encode, request_target, url_origin
from docflow.operators.deliver import deliver, json_batches, meter_by_host, send_with_failover
from tests.transports import FlakyTransport, RuleTransport
from docflow.plans.delivery import run_delivery
from docflow.sources.files import file_manifest


class Down:
    def send(self, host, target, body, key, attempt):
        raise ConnectionError("down")


def test_failover_attempt_counts():
    assert send_with_failover(FlakyTransport(1), ["h"], 0, "/t", b"", "k", 0)[1:3] == ("delivered", 2)
    assert send_with_failover(FlakyTransport(2), ["h"], 0, "/t", b"", "k", 0)[1:3] == ("failed", 2)
    host, status, attempts, err = send_with_failover(Down(), ["a", "b", "c"], 1, "/t", b"", "k", 0)
    assert (host, status, attempts) == ("a", "failed", 4) and "down" in err
    # two failures then success: the third host in ring order from the start
    assert send_with_failover(FlakyTransport(2), ["a", "b", "c"], 2, "/t", b"", "k", 0)[:3] == \
        ("b", "delivered", 3)


def test_deliver_report_one_row_each(spark):
    hosts = ["http://h0:1", "http://h1:1", "http://h2:1"]
    rows = spark.range(0, 60).select(F.col("id").alias("k"), F.lit("/t").alias("target"),
                                     F.lit("body").alias("body"))
    rep = deliver(rows, id_col="k", target_col="target", body_col="body", hosts=hosts,
                  transport_factory=lambda: RuleTransport(hosts), retry_wait_s=0, partitions=3)
    got = rep.collect()
    assert len(got) == 60 and max(r["attempts"] for r in got) <= len(hosts) + 1
    failed = {r["k"] for r in got if r["status"] == "failed"}
    assert failed == {0, 17, 34, 51}
    assert meter_by_host(rep).agg(F.sum("delivered")).first()[0] == 56


def test_urls(spark):
    df = spark.createDataFrame([("example.com/a b*~",), ("https://x.org:8443/p?q=1",), ("http://y.net/",)], "u string")
    got = df.select(url_origin("u").alias("o"), form_encode("u").alias("e"),
                    request_target("u", "p", "c").alias("t")).collect()
    assert [r["o"] for r in got] == ["http://example.com", "https://x.org:8443", "http://y.net"]
    assert got[0]["e"] == "example.com%2Fa+b*%7E"
    assert got[0]["t"] == ("/api/apollo/index-pipelines/p/collections/c/index?parserId=c"
                           "&contentSourceName=example.com%2Fa+b*%7E&echo=false")


def test_file_listing_reports_empty_and_hidden(spark, out):
    for name, data in [("a.txt", b"aa"), ("empty.txt", b""), (".hidden", b"h"), ("_meta", b"m")]:
        with open(os.path.join(out, name), "wb") as f:
            f.write(data)
    os.makedirs(os.path.join(out, "sub"))
    with open(os.path.join(out, "sub", "n.txt"), "wb") as f:
        f.write(b"n")
    names = sorted(r["name"] for r in file_manifest(spark, out).collect())
    assert names == [".hidden", "_meta", "a.txt", "empty.txt"]
    deep = file_manifest(spark, out, recursive=True, glob="*.txt")
    assert sorted((r["name"], r["length"]) for r in deep.collect()) == [("a.txt", 2), ("empty.txt", 0), ("n.txt", 1)]
    assert file_manifest(spark, f"file://{out}").count() == 4            # a path with its scheme


def test_run_delivery_over_directory(spark, out):
    for i in range(5):
        with open(os.path.join(out, f"f{i}.txt"), "w") as f:
            f.write("x" * (i + 1))
    res = run_delivery(spark, out, "coll", hosts=["http://a:1"], transport_factory=lambda: FlakyTransport(1),
                       retry_wait_s=0)
    assert (res.found, res.delivered, res.failed) == (5, 5, 0)
    assert {r["attempts"] for r in res.report.collect()} == {2}


def test_oversized_files_are_reported_as_skipped(spark, out):
    for name, size in (("a.txt", 3), ("b.txt", 30)):
        with open(os.path.join(out, name), "wb") as f:
            f.write(b"x" * size)
    res = run_delivery(spark, out, "coll", hosts=["http://a:1"], transport_factory=lambda: FlakyTransport(0),
                       max_bytes=10, retry_wait_s=0)
    assert (res.found, res.delivered, res.failed) == (2, 1, 0)
    assert [r["path"][-5:] for r in res.report.where("status = 'skipped'").collect()] == ["b.txt"]


class Keys:
    """Accepts everything and leaves the keys it was given in the error text of rule breakers."""

    def send(self, host, target, body, key, attempt):
        raise ConnectionError(f"key={key!r}")


def test_null_id_is_delivered_like_any_other(spark):
    rows = spark.createDataFrame([(5,), (None,), (9007199254740993,)], "k long").select(
        "k", F.lit("/t").alias("target"), F.lit("b").alias("body"))
    rep = deliver(rows, id_col="k", target_col="target", body_col="body", hosts=["h"], transport_factory=Keys,
                  retry_wait_s=0).collect()
    assert {(r["k"], r["error"].split("key=")[1]) for r in rep} == {
        (5, "'5'"), (None, "''"), (9007199254740993, "'9007199254740993'")}


def test_meter_counts_documents(spark):
    rep = spark.createDataFrame([("h", "delivered", 1, 100), ("h", "failed", 2, 7)],
                                "host string, status string, attempts int, rows int")
    assert tuple(meter_by_host(rep, "rows").first()) == ("h", 100, 7, 3)


def test_json_batches_keep_null_groups_null_and_text_ids(spark):
    rows = [(None, "a"), ("x1", "a"), ("x2", None), (None, None), ("x3", "a")]
    df = spark.createDataFrame(rows, "id string, g string")
    got = {(r["g"], r["batch_id"]): (r["rows"], r["first_id"], r["last_id"], len(r["docs"]))
           for r in json_batches(df, "g", "id", 2).collect()}
    assert got == {("a", 0): (2, "x1", "x1", 2), ("a", 1): (1, "x3", "x3", 1), (None, 0): (2, "x2", "x2", 2)}


def test_json_batches(spark):
    df = spark.createDataFrame([(i, "a" if i % 3 else "b") for i in range(25)], "id long, g string")
    got = {(r["g"], r["batch_id"]): (r["rows"], r["first_id"], r["last_id"], len(r["docs"]))
           for r in json_batches(df, "g", "id", 4).collect()}
    a_ids = [i for i in range(25) if i % 3]
    assert got[("a", 0)] == (4, a_ids[0], a_ids[3], 4)
    assert sum(v[0] for v in got.values()) == 25


class Recorder:
    sent = []

    def send(self, host, target, body, key, attempt):
        import json
        assert isinstance(json.loads(body), list)


def test_deliver_json_batches(spark):
    from docflow.plans.delivery import deliver_json_batches
    df = spark.createDataFrame([(i, "a" if i % 4 else "b", float(i)) for i in range(30)], "id long, g string, v double")
    rep = deliver_json_batches(df, group_col="g", order_col="id", batch_size=5, target="/index",
                               hosts=["http://h:1"], transport_factory=Recorder, retry_wait_s=0).collect()
    assert sorted(r["batch"] for r in rep) == ["a-0", "a-1", "a-2", "a-3", "a-4", "b-0", "b-1"]
    assert {r["status"] for r in rep} == {"delivered"}


def test_read_files_options(spark, out):
    from docflow.sources.files import read_files
    os.makedirs(os.path.join(out, "sub"))
    for name, size in [("a.txt", 3), ("b.txt", 30), ("c.bin", 5), ("sub/d.txt", 4)]:
        with open(os.path.join(out, name), "wb") as f:
            f.write(b"x" * size)
    names = lambda df: sorted(p.rsplit("/", 1)[-1] for p in (r["path"] for r in df.select("path").collect()))
    assert names(read_files(spark, out)) == ["a.txt", "b.txt", "c.bin"]
    assert names(read_files(spark, out, glob="*.txt")) == ["a.txt", "b.txt"]
    assert names(read_files(spark, out, recursive=True, glob="*.txt")) == ["a.txt", "b.txt", "d.txt"]


def test_fail_on_error_raises(spark):
    import pytest
    rows = spark.range(0, 2).select(F.col("id"), F.lit("/t").alias("target"), F.lit("b").alias("body"))
    rep = deliver(rows, id_col="id", target_col="target", body_col="body", hosts=["http://h:1"],
                  transport_factory=lambda: FlakyTransport(5), retry_wait_s=0, fail_on_error=True)
    with pytest.raises(Exception, match="failed after 2 attempts"):
        rep.collect()


def test_url_origin_edge_cases(spark):
    df = spark.createDataFrame([("HTTPS://User:pw@Host.Example:443/x",), ("10.0.0.5:8764/api",), ("",), ("://nohost",),
                                ("http://[2001:db8::1]:8080/x",)],
                               "u string")
    got = [r["o"] for r in df.select(url_origin("u").alias("o")).collect()]
    assert got == ["https://Host.Example:443", "http://10.0.0.5:8764", None, None, "http://[2001:db8::1]:8080"]


# ---- the ledger ---------------------------------------------------------------------


def _handed(spark, rows, out, ledger, run):
    from docflow.plans.delivery import hand_over
    df = spark.createDataFrame(rows, "batch string, body string")
    back = hand_over(df, f"{out}/{run}", ["h0", "h1"], ledger, run)
    return sorted((r["batch"] or "", r["body"]) for r in back.collect())


def test_second_hand_over_sends_nothing_and_a_changed_row_alone(spark, out):
    rows = [("a", "1"), ("b", "2"), ("c", None), (None, "4")]
    ledger = f"{out}/ledger"
    assert len(_handed(spark, rows, out, ledger, "r0")) == 4
    assert _handed(spark, rows, out, ledger, "r1") == []
    assert not os.path.exists(f"{out}/r1")
    changed = [("a", "1"), ("b", "two"), ("c", None), (None, "4"), ("d", "5")]
    assert _handed(spark, changed, out, ledger, "r2") == [("b", "two"), ("d", "5")]
    assert _handed(spark, rows, out, ledger, "r3") == [("b", "2")]           # back to what it was: sent again


def test_a_hand_over_that_died_before_its_entry_is_made_again(spark, out, monkeypatch):
    from docflow.plans import delivery
    rows = [("a", "1"), ("b", "2")]
    with monkeypatch.context() as m:
        m.setattr(delivery, "enter", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            _handed(spark, rows, out, f"{out}/ledger", "r0")
    assert len(_handed(spark, rows, out, f"{out}/ledger", "r1")) == 2
    assert _handed(spark, rows, out, f"{out}/ledger", "r2") == []


def test_content_digests_keep_columns_apart(spark):
    from docflow.plans.delivery import content_digest
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, "abc"), ("", "abc")], "x string, y string")
    assert df.select(content_digest("x", "y").alias("d")).distinct().count() == 4


def test_files_are_sent_once_with_a_ledger(spark, out):
    from docflow.plans.delivery import run_delivery
    folder = os.path.join(out, "files")
    os.makedirs(folder)
    for k in range(4):
        with open(os.path.join(folder, f"f{k}.txt"), "w") as f:
            f.write(f"body {k}")
    send = lambda run: run_delivery(spark, folder, "docs", hosts=["http://ok"], transport_factory=lambda: FlakyTransport(0),
                                    retry_wait_s=0, ledger=os.path.join(out, "ledger"), run_id=run)
    assert (lambda r: (r.found, r.delivered))(send("r0")) == (4, 4)
    assert (lambda r: (r.found, r.delivered))(send("r1")) == (0, 0)
    with open(os.path.join(folder, "f2.txt"), "w") as f:
        f.write("another body")
    again = send("r2")
    assert (again.found, again.delivered) == (1, 1) and again.report.first()["path"].endswith("f2.txt")
