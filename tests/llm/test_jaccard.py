import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docflow.llm import common, jaccard
from docflow.llm.graph import components
from tests.conftest import SF_SMALL
from tests.llm.plain import EDGE_DOCS, near_duplicates


def run(spark, rows, **kwargs):
    docs = spark.createDataFrame([(i, t, 0, "n") for i, t in rows], "doc_id long, text string, node int, bitmap string")
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = sorted((tuple(r) for r in jaccard.near_duplicates(docs, **kwargs).collect()), key=key)
    return got, sorted(near_duplicates(rows), key=key)


def edited(words, rng, share):
    return [w if rng.random() > share else f"e{rng.randrange(10 ** 6)}" for w in words]


def test_edges(spark):
    got, want = run(spark, EDGE_DOCS)
    assert got == want


def test_empty_table(spark):
    assert jaccard.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_groups_chains_passages_and_copies(spark):
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(3000)}"
    passage = [word() for _ in range(60)]
    rows = []
    for _ in range(12):                                     # near copies, from a few words to long
        base = [word() for _ in range(rng.choice((6, 9, 14, 30, 80, 300)))]
        rows += [" ".join(edited(base, rng, rng.choice((0.0, 0.01, 0.02, 0.04)))) for _ in range(rng.randrange(2, 30))]
    for _ in range(40):                                     # one passage in many documents, which differ otherwise
        rows.append(" ".join([word() for _ in range(rng.choice((3, 10, 40)))] + passage + [word() for _ in range(9)]))
    chain = [f"c{k}" for k in range(100)]
    rows += [" ".join(chain[k:k + 60]) for k in range(0, 40, 3)]            # neighbours link, ends don't
    rows += [rows[0]] * 50 + [rows[0].upper()]
    rng.shuffle(rows)
    got, want = run(spark, list(enumerate(rows)))
    assert got == want
    assert len({c for _, _, c in want}) < len(rows) - 60


def test_blocks_of_large_tiles(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    monkeypatch.setattr(jaccard, "FEW", 5)
    rng = random.Random(5)
    base = [f"w{k}" for k in range(40)]
    rows = [" ".join(edited(base, rng, 0.06)) for _ in range(80)]
    got, want = run(spark, list(enumerate(rows)))
    assert got == want


def test_small_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got, want = run(spark, rows)
    assert got == want


@pytest.mark.parametrize("size", [1, 4, 5, 7, 8, 12, 20, 50, 200])
def test_linked_sets_share_a_tile(size):
    rng, rule = np.random.default_rng(size), jaccard.Rule()
    for _ in range(60):
        a = rng.integers(0, 2 ** 63, size, dtype=np.uint64)
        cut = int(rng.integers(0, max(1, size // 5) + 1))
        new = int(rng.integers(0, max(1, size // 5) + 1))
        b = np.concatenate([a[cut:], rng.integers(0, 2 ** 63, new, dtype=np.uint64)])
        a, b = np.unique(a), np.unique(b)
        shared = len(np.intersect1d(a, b))
        if len(b) == 0 or not rule.links(shared, len(a), len(b)) or np.array_equal(a, b):
            continue
        sizes = np.array([len(a), len(b)])
        at = jaccard.places_of(rule, np.concatenate([a, b]), sizes)
        shares = 0
        for level in set(at.level.tolist()):
            mine, other = (set(at.keys[(at.rows == r) & (at.level == level)].tolist()) for r in (0, 1))
            enough = [len(mine & other) >= at.need[level - at.own[r], r] > 0 for r in (0, 1) if 0 <= level - at.own[r] < 2]
            shares += len(enough) == 2 and all(enough)
        assert shares                                       # as many tiles as both need, in some band
        maps = jaccard.Bitmaps(jaccard.bitmaps(np.concatenate([a, b]), sizes), sizes)
        bound = maps.bounds(np.array([0]), np.array([1]))
        assert bound[0] >= shared


def test_spread_join_equals_a_join(spark, monkeypatch):
    monkeypatch.setattr(common, "LEAST_HOT", 5)
    monkeypatch.setattr(common, "HOT_KEYS", 20)
    rows = spark.createDataFrame([(k % 7 if k % 3 else 0, k) for k in range(400)] + [(99, 1)], "tile long, node long")
    side = rows.where("tile < 5").groupBy("tile").agg(F.count("*").alias("n"), F.max("node").alias("most"))
    want = sorted(map(tuple, rows.join(side, "tile").select("tile", "node", "n", "most").collect()))
    assert sorted(map(tuple, common.spread_join(rows, side, "tile", ["node"]).select("tile", "node", "n", "most").collect())) == want
    semi = common.spread_join(rows, side, "tile", ["node"], "left_semi")
    assert semi.columns == ["tile", "node"] and sorted(map(tuple, semi.collect())) == [(t, n) for t, n, _, _ in want]


def test_components(spark):
    rng = random.Random(5)
    chain = [(k, k + 1) for k in range(60)]                  # one wide component
    star = [(1_000, 1_000 + k) for k in range(1, 700)]       # one node that a third of all edges touch
    edges = [*chain, *star, *((rng.randrange(2_000, 2_300), rng.randrange(2_000, 2_300)) for _ in range(120)),
             (5_000, 5_000), (1, 0), (1, 0)]
    root = {n: n for e in edges for n in e}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    linked = {n for a, b in edges if a != b for n in (a, b)}
    df = spark.createDataFrame(edges, "a long, b long")
    assert {r["node"]: r["component"] for r in components(df).collect()} == {n: find(n) for n in linked}
    assert components(df.limit(0)).collect() == []
