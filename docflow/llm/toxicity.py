"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams.

Features are the distinct hashed words, word pairs and skip-grams (pairs with
one word between) of a whole text. Training is one online pass with a learning
rate of its own for every coordinate and an L1 penalty, so that few weights
are not zero; these are broadcast to the scoring tasks, a narrow map.

Training reads a bounded sample of labelled rows (``max_rows``, documented
bound, chosen by a hash of the id over all labels); scoring reads every row.

Defined results: a null or empty text has no features and scores the learned
base rate; labels that are null or have a null id are not used; of several
labels of a document the largest holds; without any labelled row every score
is ``BASE_RATE``; repeated rows score alike; other columns pass
through, and the score replaces a column of its name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.llm.common import LETTER_TABLE, kept_fields, mix, ready, steps, text_buffer, word_hashes

#: Score of a text before anything is learned.
BASE_RATE = 0.1

_PAIR, _SKIP = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


@dataclass(frozen=True)
class Settings:
    """Size of the hash space and the FTRL-proximal constants."""

    bits: int = 20
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 0.01


@dataclass(frozen=True)
class Model:
    """The weights that are not zero, by coordinate, and the bias."""

    bits: int
    index: np.ndarray
    weight: np.ndarray
    bias: float


def features(raw: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, coordinate) of every word, pair and skip-gram of some texts, repeats included."""
    words, rows = word_hashes(raw, offsets, LETTER_TABLE)
    hashes, of = [mix(words)], [rows]
    for gap, salt in ((1, _PAIR), (2, _SKIP)):
        same = rows[gap:] == rows[:-gap]
        hashes.append(mix(words[:-gap] * salt + words[gap:])[same])
        of.append(rows[gap:][same])
    return np.concatenate(of), (np.concatenate(hashes) >> np.uint64(64 - bits)).astype(np.int64)


class Ftrl:
    """State of an FTRL-proximal learner over ``2 ** bits`` coordinates and a bias."""

    def __init__(self, settings: Settings):
        self.s = settings
        self.z = np.zeros(1 << settings.bits)
        self.n = np.zeros(1 << settings.bits)
        self.bias_z, self.bias_n = -math.log(BASE_RATE / (1 - BASE_RATE)) * settings.beta / settings.alpha, 0.0

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, s = self.z[at], self.s
        shrunk = np.sign(z) * np.maximum(np.abs(z) - s.l1, 0)
        return -shrunk / ((s.beta + np.sqrt(self.n[at])) / s.alpha + s.l2)

    def bias(self) -> float:
        return -self.bias_z / ((self.s.beta + math.sqrt(self.bias_n)) / self.s.alpha)

    def learn(self, at: np.ndarray, label: int) -> None:
        """One example: ``at`` holds its distinct coordinates."""
        w, b = self.weights(at), self.bias()
        p = 1 / (1 + math.exp(-max(-35.0, min(35.0, float(w.sum()) + b))))
        g = p - label
        root = np.sqrt(self.n[at])
        self.z[at] += g - (np.sqrt(self.n[at] + g * g) - root) / self.s.alpha * w
        self.n[at] += g * g
        step = (math.sqrt(self.bias_n + g * g) - math.sqrt(self.bias_n)) / self.s.alpha
        self.bias_z += g - step * b
        self.bias_n += g * g


def labelled_sample(labels: DataFrame, max_rows: int, train: Column | None = None,
                    label_col: str = "toxic") -> DataFrame:
    """At most ``max_rows`` (doc_id, label) rows, the first by a hash of the id."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isNotNull())
    if train is not None:
        rows = rows.where(train)
    rows = rows.groupBy("doc_id").agg((F.max(label_col) > 0).cast("int").alias("label"))
    return rows.withColumn("place", F.xxhash64("doc_id")).orderBy("place", "doc_id").limit(max_rows)


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), max_rows: int = 12_000,
          train_rows: Column | None = None, label_col: str = "toxic") -> Model:
    """Learn from ``docs`` (doc_id, text) and ``labels``; ``train_rows`` limits the label rows.

    The sampled ids are broadcast (``max_rows`` of them), features are taken
    where the texts lie, and one task learns from the sampled rows in the
    order of their hash.
    """
    ready(docs.sparkSession)
    sample = labelled_sample(labels, max_rows, train_rows, label_col)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    bits = settings.bits

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_buffer(batch.column(1))
            for i, j in steps(offsets):
                base = offsets[i]
                of, at = features(raw[base:offsets[j]], offsets[i:j + 1] - base, bits)
                both = np.unique((of << bits) | at)
                ends = np.searchsorted(both, np.arange(j - i + 1) << bits)
                both = (both & ((1 << bits) - 1)).astype(np.int32)
                parts = [both[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(2).slice(i, j - i), batch.column(3).slice(i, j - i), pa.array(parts, pa.binary())],
                    names=["label", "place", "at"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Ftrl(settings)
        for batch in batches:
            for label, at in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                model.learn(np.frombuffer(at, np.int32), label)
        every = model.weights(np.arange(1 << bits))
        kept = np.flatnonzero(every)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(kept, -1), pa.int32()), pa.array(np.append(every[kept], model.bias()), pa.float64())],
            names=["at", "weight"])

    taken = rows.select("doc_id", "text", "label", "place").mapInArrow(take, "label int, place long, at binary")
    learned = (taken.repartition(1).sortWithinPartitions("place", "at")
               .mapInArrow(learn, "at int, weight double").toPandas())
    index = learned["at"].to_numpy(np.int64)
    weight = learned["weight"].to_numpy(np.float64)
    if not len(index):                                      # no labelled row at all
        return Model(bits, index, weight, math.log(BASE_RATE / (1 - BASE_RATE)))
    return Model(bits, index[index >= 0], weight[index >= 0], float(weight[index < 0][0]))


def score(df: DataFrame, model: Model, text_col: str = "text", keep: Sequence[str] | None = None,
          score_col: str = "score") -> DataFrame:
    """``df``'s ``keep`` columns (all if None) with the score of every whole text."""
    spark = df.sparkSession
    ready(spark)
    kept = kept_fields(df, keep, [score_col])
    names = [f.name for f in kept]
    sent = spark.sparkContext.broadcast((model.bits, model.index, model.weight, model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, index, weight, bias = sent.value
        table = np.zeros(1 << bits)
        table[index] = weight
        for batch in batches:
            raw, offsets = text_buffer(batch.column(batch.schema.get_field_index(text_col)))
            total = np.full(batch.num_rows, bias)
            for i, j in steps(offsets):
                base = offsets[i]
                of, at = features(raw[base:offsets[j]], offsets[i:j + 1] - base, bits)
                hit = table[at] != 0
                both = np.unique((of[hit] << bits) | at[hit])
                total[i:j] += np.bincount(both >> bits, table[both & ((1 << bits) - 1)], j - i)
            scores = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
            columns = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores)], names=[*names, score_col])

    read = df if keep is None else df.select(*dict.fromkeys([*keep, text_col]))
    return read.mapInArrow(run, T.StructType([*kept, T.StructField(score_col, T.DoubleType())]))
