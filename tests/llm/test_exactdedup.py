import random
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from docflow.llm import exactdedup
from tests.llm.plain import EDGE_DOCS


def plain(rows, largest=True):
    groups = defaultdict(list)
    for place, (i, t) in enumerate(rows):
        groups[t or ""].append((i is not None, (i or 0) * (1 if largest else -1), -place, i))
    out = []
    for text, members in groups.items():
        best = max(members)
        for m in members:
            out.append((m[3], best[3], len(members), m is best, sha256(text.encode()).hexdigest()))
    return out


def key(r):
    return [(x is None, x) for x in r]


def run(spark, rows, parts=5, **kwargs):
    docs = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], "doc_id long, text string, run int, sha string, best string")
    got = exactdedup.exact_duplicates(docs.repartition(parts), **kwargs)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=key)


@pytest.mark.parametrize("largest", [True, False])
def test_edges(spark, largest):
    assert run(spark, EDGE_DOCS, largest=largest) == sorted(plain(EDGE_DOCS, largest), key=key)


def test_empty_table(spark):
    assert run(spark, []) == []


@pytest.mark.parametrize("parts,fan_in", [(1, 16), (7, 2), (23, 3)])
def test_large_group_over_many_runs(spark, parts, fan_in):
    rng = random.Random(parts)
    rows = [(k, "the same") for k in range(400)] + [(k, f"t{rng.randrange(300)}") for k in range(400, 1200)]
    rng.shuffle(rows)
    assert run(spark, rows, parts, fan_in=fan_in) == sorted(plain(rows), key=key)


def test_rounds_merge_to_one_run(spark):
    rows = spark.createDataFrame([(r, 1, b"a", 1, (True, r, 0), 2) for r in range(40)],
                                 "run int, short long, sha binary, length int, best struct<a:boolean,id:int,b:int>, n long")
    got = exactdedup.merge_rounds(rows, fan_in=3).collect()
    assert [(r["run"], r["best"]["id"], r["n"]) for r in got] == [(0, 39, 80)]


def test_equal_short_digests_stay_apart(spark):
    rows = spark.createDataFrame([(0, 1, b"a", 1, 5, 1), (1, 1, b"b", 1, 6, 1)],
                                 "run int, short long, sha binary, length int, best int, n long")
    assert exactdedup.merge_rounds(rows).count() == 2


def test_normalised_texts_and_a_wrong_fan_in(spark):
    docs = spark.createDataFrame([(1, "A b"), (2, "a B"), (3, "c")], "doc_id long, text string")
    got = exactdedup.exact_duplicates(docs, normalise=F.lower).select("doc_id", "keep_id").collect()
    assert sorted(map(tuple, got)) == [(1, 2), (2, 2), (3, 3)]
    with pytest.raises(ValueError):
        exactdedup.exact_duplicates(docs, fan_in=1)
