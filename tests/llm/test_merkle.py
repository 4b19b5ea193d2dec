import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

import docflow.llm.merkle as merkle
from docflow.llm.queries import op12_merkle_descent

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, grp int, leaf string, path string"


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(nodes):
    """Root and, per node, the siblings (before, after) on its way up."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[k:k + 16] for k in range(0, len(nodes), 16)]
        for k, place in enumerate(places):
            run, at = runs[place // 16], place % 16
            paths[k].append(("".join(run[:at]), "".join(run[at + 1:])))
            places[k] = place // 16
        nodes = [H(*run) for run in runs]
    return nodes[0], paths


def plain(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    ordered = {s: sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in names}
    trees = {s: tree([leaf(r) for r in ordered[s]]) for s in names}
    root, above = tree([trees[s][0] for s in names]) if names else (None, [])
    out = []
    for s, up in zip(names, above):
        for row, path in zip(ordered[s], trees[s][1]):
            i, text = row[0], row[4]
            if i is not None and text is not None and zlib.crc32(str(i).encode()) % 5 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            at = leaf((*row[:4], text))
            for before, after in path + up:
                at = H(before, at, after)
            out.append((i, leaf(row), trees[s][0], root, H(*[b + a for b, a in path + up]), at, at == root))
    return sorted(out, key=str)


def run(spark, rows, tmp):
    docs = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)
    docs.repartition(3).write.parquet(f"{tmp}/documents.parquet")
    got = op12_merkle_descent(spark, tmp)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in got.collect()), key=str)


EDGES = [
    (1, None, "en", 3, "Abc"), (None, None, None, None, None), (None, "a", "de", 0, ""), (1, "a", "de", 0, ""),
    (1, "a", "de", 0, ""), (1, "a", "de", 1, "B"), (7, "é", "fr", 2, "ÀÉ"), (8, "Z", "", -4, "x:1"), (5, "z", "en", 10 ** 6, "Q" * 10 ** 6),
]


@pytest.mark.parametrize("rows", [[], [(3, "a", "en", 1, "A")], EDGES], ids=["empty", "one", "edges"])
def test_edges(spark, out, rows):
    assert run(spark, rows, out) == plain(rows)


def test_deep_groups_and_many_groups(spark, out):
    rng = random.Random(2)
    rows = [(k, "large", "en", k, f"Text {k}") for k in range(4500)]                  # four levels, a lone last node
    rows += [(k, f"s{rng.randrange(40)}", "en", k, rng.choice([None, "X", "y"])) for k in range(600)]
    rows += [(9, "same", None, 1, "copy")] * 40                                     # equal runs of equal leaves
    rng.shuffle(rows)
    got = run(spark, rows, out)
    assert got == plain(rows)
    assert any(not r[-1] for r in got) and sum(r[-1] for r in got) > 0.7 * len(got)


@pytest.mark.parametrize("n", [16, 17, 256, 257])
def test_sizes_at_the_edge_of_a_level(spark, out, n):
    rows = [(k, "s", "en", 1, "Aa") for k in range(n)]
    assert run(spark, rows, out) == plain(rows)


def test_some_requests_descend_alone(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(F.col("id") > 40, "big").otherwise("small").alias("source"),
                                    F.sha2(F.col("id").cast("string"), 256).alias("leaf"))
    manifest = merkle.build(docs)
    asked = manifest.leaves.where("row.doc_id IN (0, 40, 41, 4999)")
    proofs = merkle.prove(manifest, asked).withColumn("root", merkle.folded(merkle.text_of("leaf")))
    assert {r["root"] for r in proofs.collect()} == {manifest.root} and proofs.count() == 4
    assert manifest.records.count() == manifest.records.select("digest").distinct().count()
    wrong = proofs.withColumn("root", merkle.folded(F.sha2(F.lit("other"), 256)))
    assert manifest.root not in {r["root"] for r in wrong.collect()}
