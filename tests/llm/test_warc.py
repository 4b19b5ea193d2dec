import hashlib
from pathlib import Path

import pytest

from docflow.llm import warc
from tests.conftest import SF_SMALL

MAGIC = "WARC/1.0\r\n"
RECORD = f"{MAGIC}WARC-Type: response\r\nX-Page-ID: 999\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


def expected(rows, least=1000):
    out, best = [], {}
    body = lambda t: (t or "").encode()
    for i, _, t in rows:
        if len(body(t)) >= least and i is not None:
            best[body(t)] = max(i, best.get(body(t), i))
    for i, _, t in rows:
        top = best.get(body(t)) if len(body(t)) >= least else None
        revisit = top is not None and top != i
        out.append((i, len(body(t)), hashlib.sha1(body(t)).hexdigest(), "revisit" if revisit else "response",
                    top if revisit else None))
    return sorted(out, key=str)


def round_trip(spark, path, rows):
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows],
                                  "page_id long, url string, html string, digest string, bytes int")
    warc.write_warc(pages, path)
    got = warc.read_warc(spark, path)
    return sorted((tuple(r) for r in got.select("page_id", "payload_bytes", "payload_digest", "record_type",
                                                "refers_to").collect()), key=str)


EDGES = [
    (1, "http://a.example/x", "é" * 700), (2, "http://a.example/y", "é" * 700), (3, None, "é" * 700),
    (4, "http://a.example/\r\nX-Page-ID: 77", "short"), (5, "u", "short"), (6, "u", None), (7, "u", ""),
    (None, "u", "z" * 1500), (8, "u", "z" * 1500), (9, "u", "q" * 2000), (9, "u", "q" * 2000), (-5, "u", "q" * 2000),
    (None, "u", "k" * 1200), (None, "u", "k" * 1200),
    (10, "u", MAGIC), (11, "u", f"a{MAGIC}b{MAGIC}"), (12, "u", RECORD), (13, "u", RECORD * 40 + "tail"),
    (14, "u", "\r\n\r\n" + MAGIC * 3 + "\r\n\r\n"), (15, "u", "WARC/1.0"), (16, "u", "x" * 400_000 + RECORD),
    (17, "u", "end\r\n\r\n"), (18, "u", "WARC/1.0\r\nContent-Length: 9\r\n"),
]


def test_edges_and_magic_inside_payloads(spark, out):
    assert round_trip(spark, f"{out}/w", EDGES) == expected(EDGES)


@pytest.mark.parametrize("split", [37, 64, 1000])
def test_splits_anywhere(spark, out, split):
    """Split borders fall inside magic lines, headers and payloads."""
    rows = [r for r in EDGES if r[0] != 16] + [(100 + k, "u", f"page {k} " + MAGIC * (k % 3)) for k in range(30)]
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k) for k in names}
    try:
        pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
        warc.write_warc(pages, f"{out}/w")
        for k in names:
            spark.conf.set(k, str(max(split, 300) if "open" not in k else 1))
        got = warc.read_warc(spark, f"{out}/w").select("page_id", "payload_bytes", "payload_digest", "record_type",
                                                       "refers_to").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted((tuple(r) for r in got), key=str) == expected(rows)


def test_empty_table(spark, out):
    assert round_trip(spark, f"{out}/w", []) == []


def test_pointer_jumping_rejects_what_no_chain_reaches(spark):
    chain = [("f", k * 10, k * 10 + 10) for k in range(137)]
    decoys = [("f", 15, 20), ("f", 25, 33), ("f", 33, 40), ("g", 5, 10)]
    nodes = spark.createDataFrame([*chain, *decoys, ("g", 0, None)], "file string, offset long, next long")
    got = {tuple(r) for r in warc.reached(nodes).collect()}
    assert got == {("f", k * 10) for k in range(137)} | {("g", 0)}


def test_small_table(spark, out):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "url", "html")
    rows = [tuple(r) for r in pages.collect()]
    assert round_trip(spark, f"{out}/w", rows) == expected(rows)


def test_headers_of_any_length(spark, out):
    rows = [(1, "u", "first"), (2, "data:text/html," + "x" * 70_000, "long url"), (3, "é" * 300_000, "q" * 2000), (4, "u", "last")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write_warc(pages, f"{out}/w")
    got = warc.read_warc(spark, f"{out}/w").select("page_id", "url", "payload_bytes").collect()
    assert sorted(map(tuple, got)) == [(i, u, len(t)) for i, u, t in rows]


def test_a_chain_that_breaks_is_an_error(spark, out):
    record = f"{MAGIC}WARC-Type: response\r\nX-Page-ID: {{}}\r\nContent-Length: {{}}\r\n\r\nhello\r\n\r\n"
    (Path(out) / "w").mkdir()
    text = "".join(record.format(k, n) for k, n in ((1, 5), (2, 6), (3, 5)))
    (Path(out) / "w" / "part-0.txt").write_bytes(text.encode())
    with pytest.raises(ValueError, match="records end at byte"):
        warc.read_warc(spark, f"{out}/w")


def test_archives_of_any_name_and_folder(spark, out):
    import os
    pages = spark.createDataFrame([(1, "http://a", "x" * 2000), (2, "http://b", "x" * 2000), (3, None, "y")], "page_id long, url string, html string")
    warc.write_warc(pages.coalesce(1), f"{out}/w")
    name = next(n for n in os.listdir(f"{out}/w") if n.startswith("part-"))
    os.makedirs(f"{out}/named/deep")
    data = open(f"{out}/w/{name}", "rb").read()
    open(f"{out}/named/deep/crawl-00000.warc", "wb").write(data)
    columns = ["record_type", "page_id", "payload_bytes", "payload_digest", "refers_to"]
    read = lambda p: sorted(tuple(r) for r in warc.read_warc(spark, p).select(columns).collect())
    assert read(f"{out}/named") == read(f"{out}/w") and len(read(f"{out}/named")) == 3
    os.makedirs(f"{out}/empty")
    assert read(f"{out}/empty") == []
    # a revisit names the record it refers to in the standard's own field
    ids = [line.split(b": ")[1] for line in data.split(b"\r\n") if line.startswith(b"WARC-Record-ID")]
    refers = [line.split(b": ")[1] for line in data.split(b"\r\n") if line.startswith(b"WARC-Refers-To:")]
    assert len(refers) == 1 and refers[0] in ids and len(set(ids)) == 3


def test_broadcasts_are_bounded_by_bytes(spark):
    from docflow.llm.common import small_side, staged
    table = staged(spark.range(100).selectExpr("id", "repeat('x', 1000) AS t", "array(named_struct('a', 'yy', 'b', 1)) AS s"), "wide")
    joined = lambda **k: spark.range(10).join(small_side(table, **k), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in joined().lower() and "broadcast" not in joined(max_bytes=50_000).lower()
    assert "broadcast" not in joined(max_rows=99).lower()
