"""The stages against plain Python, and the registration of the queries."""

import hashlib
import random
import subprocess
import sys
from pathlib import Path

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline as P
from docflow.llm import decontaminate
from docflow.llm.oracle import SQL
from docflow.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm import plain
from tools.oracle_check import duck, rows_of

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(8)
    words = [f"w{k}" for k in range(900)]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(k, " ".join(text(30))) for k in range(5)]
    texts = []
    for k in range(140):
        body = text(rng.randrange(20, 70))
        if k % 5 == 0:
            body[3:3] = ["idiot", "scum", "trash"]
        if k % 11 == 0:
            body += items[k % 5][1].split()
        if k % 7 == 0:
            body += ["write", "to", f"user{k}@mail.example.com"]
        texts.append(" ".join(body))
    texts += [texts[2], texts[3] + " one", texts[4].upper(), "", None, "same", "same"]
    rows = [(k, t, "en", "s", None if t is None else len(t)) for k, t in enumerate(texts)]
    rows += [(None, texts[1], None, None, None), (9, texts[9], "en", "s", 1)]
    return rows, items


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    rows, items = corpus()
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    labels = [(k, 0, int(k % 5 == 0)) for k in range(140)] + [(None, 0, 1), (141, 0, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def stage(spark, tables, name, rows):
    out = dict(P.STAGES)[name](spark, spark.createDataFrame(rows, SCHEMA), tables)
    return [tuple(r) for r in out.collect()], out.columns


def order(rows):
    return sorted(rows, key=str)


def test_stage_list():
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "bpe"]


def test_toxicity_stage(spark, tables):
    rows, _ = corpus()
    got, columns = stage(spark, tables, "toxicity", rows)
    assert columns == [c.split()[0] for c in SCHEMA.split(", ")]
    toxic = lambda t: "idiot" in (t or "").lower()
    assert order(got) == order(r for r in rows if not toxic(r[1]))


def test_near_duplicate_stage(spark, tables):
    rows, _ = corpus()
    got, _ = stage(spark, tables, "near_duplicates", rows)
    groups = plain.near_duplicates([(r[0], r[1]) for r in rows])
    keep = {i for i, _, c in groups if i is not None and i == c}
    assert sorted(r[0] for r in got if r[0] is not None) == sorted(keep)        # repeated ids once
    assert [r for r in got if r[0] is None] == [r for r in rows if r[0] is None]


def test_decontamination_stage(spark, tables):
    rows, items = corpus()
    got, _ = stage(spark, tables, "decontamination", rows)
    leaks = {d for d, _ in plain.contaminated([(r[0], r[1]) for r in rows], items)}
    assert leaks and order(got) == order(r for r in rows if r[0] not in leaks)


def test_decontamination_stage_with_a_large_benchmark(spark, tables, monkeypatch):
    """Seeds beyond the bound of broadcasts are dealt out; the same documents go."""
    rows, items = corpus()
    want, _ = stage(spark, tables, "decontamination", rows)
    sent = []
    broadcast = F.broadcast
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 100, raising=False)
    monkeypatch.setattr(F, "broadcast", lambda df: sent.append(df.count() if "seed" in df.columns else 0) or broadcast(df))
    got, _ = stage(spark, tables, "decontamination", rows)
    assert len(want) < len(rows) and order(got) == order(want)
    assert sum(sent) <= 100


def test_personal_data_stage(spark, tables):
    rows, _ = corpus()
    got, _ = stage(spark, tables, "personal_data", rows)
    assert len(got) == len(rows)
    before = {r[0]: r for r in rows if r[0] is not None}
    for r in got:
        assert not plain.pii_spans(r[1])
        assert r[4] == (None if r[1] is None else len(r[1]))
        if r[0] is not None and not plain.pii_spans(before[r[0]][1]):
            assert r[1] == before[r[0]][1]


def test_bpe_stage(spark, tables):
    rows, _ = corpus()
    got, _ = stage(spark, tables, "bpe", rows)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for r in rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((r[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(text.encode()).hexdigest()))
    assert order(got) == order(want)


def test_stages_on_an_empty_table_and_extra_columns(spark, tables):
    extra = ", __toxicity string, text_hash long, terms string, component_id long, item_id long, ids string"
    for name, f in P.STAGES:
        empty = spark.createDataFrame([], SCHEMA)
        assert f(spark, empty, tables).collect() == []
        docs = spark.createDataFrame([(1, "some plain words here", "en", "s", 21, "x", 1, "t", 2, 3, "i")], SCHEMA + extra)
        rows = f(spark, docs, tables).collect()
        assert len(rows) == 1 and rows[0]["doc_id"] == 1, name


def test_run(spark, tables):
    rows, items = corpus()
    got = {r["doc_id"] for r in P.run(spark, tables).collect()}
    clean = {r[0] for r in rows if r[0] is not None and r[0] < 140 and r[0] % 5 and r[0] % 11}
    gone = {d for d, _ in plain.contaminated([(r[0], r[1]) for r in rows], items)}
    assert clean - gone <= got and not got & gone
    assert not {r[0] for r in rows if "idiot" in (r[1] or "").lower()} & got


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    res = duck(SF_SMALL).execute(SQL[name])
    columns = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, res.fetchall())


def test_registration():
    assert set(QUERIES) | {"pipeline"} == set(E.LLM_QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_entry_without_the_sub_package(tmp_path):
    root = Path(__file__).parents[2]
    for name in ("__spark_entry__.py", "docflow"):
        (tmp_path / name).symlink_to(root / name)
    code = ("import sys; sys.path.insert(0, '.'); sys.modules['docflow.llm'] = None; "
            "import __spark_entry__ as E; assert not E.LLM_QUERIES and len(E.queries()) > 40; print('fine')")
    out = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "fine" in out.stdout, out.stderr[-1500:]


def test_rows_are_told_apart_by_id_and_text(spark, tables):
    """Null and repeated ids: clean texts stay, copies go, one row of each group stays."""
    _, items = corpus()
    rng = random.Random(3)
    fresh = lambda n=30: " ".join(f"v{rng.randrange(10 ** 6)}" for _ in range(n))
    a, b, c, d, e = (fresh() for _ in range(5))
    leak = fresh() + " " + items[0][1]
    rows = [(i, t, "en", "s", len(t)) for i, t in [
        (None, leak), (None, a), (None, b), (500, leak), (500, c), (501, d)]]
    got, _ = stage(spark, tables, "decontamination", rows)
    assert order(got) == order(r for r in rows if r[1] != leak)

    near = a + " more"
    rows = [(i, t, "en", "s", len(t)) for i, t in [
        (None, a), (None, a), (None, near), (None, b), (700, c), (700, d), (701, c), (701, e), (701, e),
        (702, d + " more"), (None, ""), (None, "")]]
    got, _ = stage(spark, tables, "near_duplicates", rows)
    assert order((r[0], r[1]) for r in got if r[0] is not None) == order([(700, c), (700, d), (701, e)])
    texts = sorted(r[1] for r in got if r[0] is None)
    assert texts in (sorted(["", "", a, b]), sorted(["", "", near, b]))
