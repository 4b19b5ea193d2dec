"""Entities of several words, and the tagger that uses context, against brute force."""

import itertools
import random

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from docflow.operators import phrases as phrases_module
from docflow.operators import sequence
from docflow.operators.phrases import tag_phrases
from docflow.operators.sequence import best_paths, class_counts, count_tables, decode, sentences

WORD = regex.compile(r"[\p{L}\p{N}]+")


def plain_phrases(docs, phrases):
    known = {}
    for p, c in phrases:
        words = tuple(WORD.findall(p or ""))
        if words and c is not None:
            known[words] = max(c, known.get(words, c))
    out = []
    for i, text in docs:
        words, at = WORD.findall(text or ""), 0
        while at < len(words):
            fits = [w for w in known if tuple(words[at:at + len(w)]) == w]
            if fits:
                best = max(fits, key=len)
                out.append((i, at, len(best), " ".join(best), known[best]))
                at += len(best)
            else:
                at += 1
    return sorted(out, key=str)


def run_phrases(spark, docs, phrases, **kwargs):
    d = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "id long, text string, pos int, row int")
    p = spark.createDataFrame(phrases, "phrase string, entity_class string")
    return sorted((tuple(r) for r in tag_phrases(d, p, **kwargs).collect()), key=str)


PHRASES = [("New York", "CITY"), ("New York Times", "PAPER"), ("York", "CITY"), ("Times Square Garden", "PLACE"), ("a b a", "X"),
           ("b a b", "Y"), ("New  York", "STATE"), ("", "Z"), (None, "Z"), ("none", None), ("né 中", "L")]
TEXTS = [(1, "in New York, the New-York Times square"), (2, None), (3, ""), (1, "in New York, the New-York Times square"),
         (None, "York New York Times Square Garden"), (4, "a b a b a b a b"), (5, "né 中 Né"), (6, "none of it")]


@pytest.mark.parametrize("bound", [1 << 20, 0], ids=["broadcast", "shuffled"])
def test_phrases_at_the_edges(spark, bound):
    assert run_phrases(spark, TEXTS, PHRASES, max_broadcast_bytes=bound) == plain_phrases(TEXTS, PHRASES)
    assert run_phrases(spark, [], PHRASES) == [] == run_phrases(spark, TEXTS, [])


@pytest.mark.parametrize("seed", range(3))
def test_phrases_overlapping_in_chains(spark, seed):
    rng = random.Random(seed)
    some = lambda n: " ".join(rng.choice("abcd") for _ in range(n))
    phrases = [(some(rng.randrange(1, 6)), rng.choice("PQ")) for _ in range(25)]
    docs = [(k, some(rng.randrange(60))) for k in range(80)]
    assert run_phrases(spark, docs, phrases) == plain_phrases(docs, phrases)


def test_phrases_are_not_matched_in_python(spark):
    d = spark.createDataFrame([(1, "a b")], "id long, text string")
    p = spark.createDataFrame([("a b", "X")], "phrase string, entity_class string")
    plan = tag_phrases(d, p)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("bound", [1 << 20, 0], ids=["broadcast", "shuffled"])
def test_phrases_in_runs_of_matches(spark, bound, monkeypatch):
    monkeypatch.setattr(phrases_module, "RUN", 3)
    phrases = [("a b", "X"), ("b a b a b a b a b", "Y"), ("b", "Z"), ("a", "Z"), ("c", "O")]
    docs = [(n, " ".join("abc"[(k * k + n) % 3] for k in range(n))) for n in range(12)] + [(99, "a b " * 40 + "c"), (100, "b a " * 31)]
    assert run_phrases(spark, docs, phrases, max_broadcast_bytes=bound) == plain_phrases(docs, phrases)


def test_matches_are_dealt_once(spark):
    d = spark.createDataFrame([(1, "a b")], "id long, text string")
    p = spark.createDataFrame([("a b", "X"), ("b c d", "Y")], "phrase string, entity_class string")
    plan = tag_phrases(d, p)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("Exchange hashpartitioning") == 1       # two windows and a group per chain before


# ---- context ---------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(20))
def test_best_path_is_the_best_of_all(seed):
    rng = np.random.default_rng(seed)
    states = int(rng.integers(1, 4))
    start, moves = rng.integers(-6, 0, states), rng.integers(-6, 0, (states, states))
    emitted = [rng.integers(-6, 0, (int(n), states)) for n in rng.integers(0, 6, 9)]
    for e, got in zip(emitted, best_paths(emitted, start, moves)):
        total = lambda p: start[p[0]] + e[0][p[0]] + sum(moves[a, b] + e[t + 1][b] for t, (a, b) in enumerate(zip(p, p[1:])))
        every = list(itertools.product(range(states), repeat=len(e))) if len(e) else [()]
        want = min(every, key=lambda p: (-total(p), p[::-1])) if len(e) else ()
        assert tuple(got) == tuple(want)


def tagged(spark, rows):
    return spark.createDataFrame(rows, "words array<string>, tags array<string>")


TRAIN = [(["mr", "rose", "sat"], ["O", "P", "O"]), (["mr", "smith", "sat"], ["O", "P", "O"]), (["a", "rose", "fell"], ["O", "O", "O"]),
         (["a", "rose", "grew"], ["O", "O", "O"])]


def test_counts(spark):
    tables = count_tables(tagged(spark, TRAIN), ["P", "O"])
    ln = lambda a, b: round(np.log(a / b) * 1_000_000)
    assert tables.classes == ["O", "P"] and tables.start == [ln(5, 6), ln(1, 6)]
    assert tables.moves == [[ln(5, 8), ln(3, 8)], [ln(3, 4), ln(1, 4)]]
    words = {r["word"]: list(r["scores"]) for r in tables.words.collect()}
    assert words["rose"] == [ln(3, 10 + 7 + 1), ln(2, 2 + 7 + 1)] and tables.unseen == [ln(1, 18), ln(1, 10)]


@pytest.mark.parametrize("bound", [1 << 20, 0], ids=["handed over", "joined"])
def test_the_same_word_by_its_context(spark, bound):
    docs = spark.createDataFrame([(1, "mr rose fell. a rose\nmr unheard sat!"), (2, None), (3, " . "), (1, "mr rose fell")], "id long, text string")
    train = [(["mr", "rose", "fell"], ["T", "P", "V"]), (["mr", "smith", "sat"], ["T", "P", "V"]),
             (["a", "rose", "grew"], ["D", "N", "V"]), (["a", "tree", "fell"], ["D", "N", "V"])]
    tables = count_tables(tagged(spark, train * 20), ["T", "P", "V", "D", "N"])
    got = sorted((r["id"], r["sentence"], r["words"], r["tags"]) for r in decode(sentences(docs, "id", "text"), tables, bound).collect())
    assert got == [(1, 0, ["mr", "rose", "fell"], ["T", "P", "V"]), (1, 0, ["mr", "rose", "fell"], ["T", "P", "V"]),
                   (1, 1, ["a", "rose"], ["D", "N"]), (1, 2, ["mr", "unheard", "sat"], ["T", "P", "V"])]


def test_no_labelled_text(spark):
    tables = count_tables(tagged(spark, []), ["A", "B"])
    assert tables.start == tables.moves[0] and tables.words.count() == 0
    docs = spark.createDataFrame([(1, "x y")], "id long, text string")
    assert decode(sentences(docs, "id", "text"), tables).first()["tags"] == ["A", "A"]


def test_steps_do_not_change_paths(monkeypatch):
    rng = np.random.default_rng(1)
    start, moves = rng.integers(-99, 0, 3), rng.integers(-99, 0, (3, 3))
    emitted = [rng.integers(-99, 0, (int(n), 3)) for n in rng.integers(1, 30, 50)]
    whole = best_paths(emitted, start, moves)
    monkeypatch.setattr(sequence, "STEP", 7)
    assert all((a == b).all() for a, b in zip(whole, best_paths(emitted, start, moves)))


@pytest.fixture(scope="module")
def context(spark):
    """Texts whose ids repeat or are null, and tables of words that are common, rare or (unheard) not counted."""
    rng = random.Random(4)
    text = lambda: "".join(rng.choice(["rose", "sat", "fell", "mr", "né", "unheard", "x9"]) + rng.choice("  , .\n") for _ in range(rng.randrange(40)))
    docs = [(rng.choice([None, 1, 2, 3, *range(10, 40)]), text()) for _ in range(60)] + [(5, None), (6, ""), (7, ".")]
    parts = sentences(spark.createDataFrame(docs, "id long, text string"), "id", "text")
    rare = [(["né", "x9"], ["P", "Q"])]
    return docs, parts, count_tables(tagged(spark, TRAIN * 9 + rare), ["P", "O", "Q"])


def test_a_row_is_a_text(context):
    docs, parts, _ = context
    got = parts.groupBy("row").agg(F.count_distinct("id"), F.count(F.lit(1)).alias("n"), F.count_distinct("sentence").alias("d")).collect()
    assert len(got) == sum(bool(WORD.search(t or "")) for _, t in docs) and all(r["n"] == r["d"] for r in got)


@pytest.mark.parametrize("bound", [0, 400])
def test_words_beyond_the_bound(spark, context, bound, monkeypatch):
    _, parts, tables = context
    monkeypatch.setattr(sequence, "BLOCK_SENTENCES", 9)
    assert 0 < tables.words.where(~sequence._held(tables, 400)[0]).count() < tables.words.count()
    key = lambda r: str((r["row"], r["sentence"], r["id"], r["words"], r["tags"]))
    apart = decode(parts, tables, bound)
    assert sorted(map(key, apart.collect())) == sorted(map(key, decode(parts, tables).collect()))
    assert "Generate" not in apart._jdf.queryExecution().executedPlan().toString()       # a row per word before


@pytest.mark.parametrize("bound", [1 << 20, 400, 0])
def test_counts_by_class(spark, context, bound, monkeypatch):
    _, parts, tables = context
    monkeypatch.setattr(sequence, "BLOCK_SENTENCES", 9)
    want = {}
    for r in decode(parts, tables).collect():
        for w, t in zip(r["words"], r["tags"]):
            want.setdefault((r["id"], t), []).append(w)
    got = class_counts(decode(parts, tables, bound, by_class=True)).collect()
    assert {(r["id"], r["tag"]): (r["n"], r["words"]) for r in got} == {k: (len(v), len(set(v))) for k, v in want.items()}
    assert len(got) == len(want)


def test_counts_in_steps(spark, monkeypatch):
    whole = count_tables(tagged(spark, TRAIN * 3), ["P", "O"])
    held = list(sequence._count_batches(["O", "P"])(iter(tagged(spark, TRAIN * 3).toArrow().to_batches())))
    monkeypatch.setattr(sequence, "COUNT_STEP", 4)
    parts = [b for t in TRAIN * 3 for b in tagged(spark, [t]).toArrow().to_batches()]
    steps = list(sequence._count_batches(["O", "P"])(iter(parts)))
    add = lambda bs: sorted({(r["word"], r["after"]): None for b in bs for r in b.to_pylist()}, key=str)
    total = lambda bs, c: sum(sum(b.column(c).to_pylist()) for b in bs)
    assert len(steps) == 6 and add(steps) == add(held) and all(total(steps, c) == total(held, c) for c in ("n0", "n1"))
    assert whole.words.where("word = 'rose'").first()["n"] == 9
