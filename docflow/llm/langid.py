"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads windows of bytes in both directions, gives every position a
distribution over the languages, and a document's probabilities are the mean
over all its positions. It is trained in numpy by backpropagation through time
in one task, on snippets from a bounded sample of rows (``max_rows`` rows of
``snippet`` characters, chosen by a hash of the id over all eligible rows); its
weights are a few kilobytes and are broadcast. Prediction is a narrow map that
reads whole texts, many windows at a time.

Defined results: a text that is null or without a letter is ``und`` with score
0, as is every text when there was nothing to learn from; rows with a null
language are not learned from; ties go to the first language by name; repeated
rows get equal results; the new columns replace those of their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.llm.common import kept_fields, ready, small_side, staged, text_buffer

#: The input symbol behind the end of a text.
PAD = 256


@dataclass(frozen=True)
class Settings:
    """Shape of the network and of its training."""

    hidden: int = 8
    window: int = 64
    batch: int = 128
    rounds: int = 300
    rate: float = 0.02
    seed: int = 7


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class BiGru:
    """Weights: for each direction ``x`` (symbol to gates), ``u`` (state to gates); ``v``, ``c`` to languages.

    Gates are stacked as update, reset and candidate.
    """

    def __init__(self, languages: Sequence[str], weights: dict[str, np.ndarray]):
        self.languages = list(languages)
        self.w = weights

    @classmethod
    def fresh(cls, languages: Sequence[str], settings: Settings) -> BiGru:
        rng, h = np.random.default_rng(settings.seed), settings.hidden
        w = {f"{k}{d}": rng.normal(0, 0.3 if k == "x" else h ** -0.5, (PAD + 1 if k == "x" else h, 3 * h))
             for d in "fb" for k in "xu"}
        w |= {"v": rng.normal(0, 0.3, (2 * h, len(languages))), "c": np.zeros(len(languages))}
        return cls(languages, {k: a.astype(np.float32) for k, a in w.items()})

    def _states(self, symbols: np.ndarray, d: str, trace: list | None = None) -> np.ndarray:
        """States (time, window, hidden) of one direction; ``symbols`` is (time, window)."""
        x, u = self.w["x" + d], self.w["u" + d]
        h = u.shape[0]
        state = np.zeros((symbols.shape[1], h), x.dtype)
        out = np.empty((*symbols.shape, h), x.dtype)
        for t in range(len(symbols)) if d == "f" else range(len(symbols) - 1, -1, -1):
            given = x[symbols[t]]
            carried = state @ u
            gates = _sigmoid(given[:, :2 * h] + carried[:, :2 * h])
            update, reset = gates[:, :h], gates[:, h:]
            new = 2 * _sigmoid(2 * (given[:, 2 * h:] + reset * carried[:, 2 * h:])) - 1     # tanh
            if trace is not None:
                trace.append((t, state, update, reset, new, carried[:, 2 * h:]))
            state = new + update * (state - new)
            out[t] = state
        return out

    def positions(self, symbols: np.ndarray, traces: tuple[list, list] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Language probabilities at every position, (time, window, language), and the states below."""
        parts = [self._states(symbols, d, traces[k] if traces else None) for k, d in enumerate("fb")]
        states = np.concatenate(parts, axis=2)
        logits = states @ self.w["v"] + self.w["c"]
        logits -= logits.max(axis=2, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=2, keepdims=True)
        return logits, states

    def gradients(self, symbols: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over all positions that are not padding, and its gradients."""
        traces: tuple[list, list] = ([], [])
        probs, states = self.positions(symbols, traces)
        real = symbols != PAD
        n = max(1, int(real.sum()))
        times, windows = np.indices(symbols.shape)
        at_label = probs[times, windows, labels[None, :]]
        loss = float(-(np.log(at_label + 1e-30) * real).sum() / n)
        dlogits = probs.copy()
        dlogits[times, windows, labels[None, :]] -= 1
        dlogits *= (real / n)[:, :, None].astype(probs.dtype)
        h2, classes = states.shape[2], probs.shape[2]
        grads = {"v": states.reshape(-1, h2).T @ dlogits.reshape(-1, classes), "c": dlogits.sum(axis=(0, 1))}
        dstates = dlogits @ self.w["v"].T
        h = h2 // 2
        one_hot = np.zeros((symbols.size, PAD + 1), probs.dtype)
        one_hot[np.arange(symbols.size), symbols.reshape(-1)] = 1
        for k, d in enumerate("fb"):
            u = self.w["u" + d]
            du, dgiven = np.zeros_like(u), np.empty((*symbols.shape, 3 * h), probs.dtype)
            later = np.zeros((symbols.shape[1], h), probs.dtype)
            for t, state, update, reset, new, carried in reversed(traces[k]):
                dstate = dstates[t, :, k * h:(k + 1) * h] + later
                dnew = dstate * (1 - update) * (1 - new * new)
                dupdate = dstate * (state - new) * update * (1 - update)
                dreset = dnew * carried * reset * (1 - reset)
                dgiven[t] = np.concatenate([dupdate, dreset, dnew], axis=1)
                dcarried = np.concatenate([dupdate, dreset, dnew * reset], axis=1)
                du += state.T @ dcarried
                later = dstate * update + dcarried @ u.T
            grads["u" + d] = du
            grads["x" + d] = one_hot.T @ dgiven.reshape(-1, 3 * h)
        return loss, grads

    def fit(self, texts: list[bytes], labels: np.ndarray, settings: Settings) -> None:
        """Adam over random windows, every language as often as any other."""
        rng = np.random.default_rng(settings.seed)
        of = [np.flatnonzero(labels == k) for k in range(len(self.languages))]
        first = {k: np.zeros_like(a) for k, a in self.w.items()}
        second = {k: np.zeros_like(a) for k, a in self.w.items()}
        for step in range(1, settings.rounds + 1):
            y = rng.integers(0, len(self.languages), settings.batch)
            symbols = np.full((settings.window, settings.batch), PAD, np.int64)
            for k, label in enumerate(y):
                text = texts[rng.choice(of[label])]
                at = int(rng.integers(0, max(1, len(text) - settings.window // 4)))
                part = np.frombuffer(text[at:at + settings.window], np.uint8)
                symbols[:len(part), k] = part
            _, grads = self.gradients(symbols, y)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            scale = min(1.0, 1.0 / (norm + 1e-12))
            rate = settings.rate * (1 - 0.9 * step / settings.rounds)
            for k, g in grads.items():
                g = g * scale
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                self.w[k] -= (rate * (first[k] / (1 - 0.9 ** step))
                              / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)).astype(self.w[k].dtype)

    def documents(self, raw: np.ndarray, offsets: np.ndarray, window: int, lot: int = 2048) -> np.ndarray:
        """Mean position probabilities of each text (zeros for an empty one)."""
        sizes = np.diff(offsets)
        count = -(-sizes // window)
        rows = np.repeat(np.arange(len(sizes)), count)
        place = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)
        begin = offsets[:-1][rows] + place * window
        filled = np.minimum(window, sizes[rows] - place * window)
        total = np.zeros((len(sizes), len(self.languages)))
        for at in range(0, len(rows), lot):
            b, n = begin[at:at + lot], filled[at:at + lot]
            step = np.arange(window)[:, None]
            inside = step < n[None, :]
            symbols = np.where(inside, raw[np.minimum(b[None, :] + step, len(raw) - 1)].astype(np.int64), PAD)
            probs, _ = self.positions(symbols)
            sums = (probs * inside[:, :, None]).sum(axis=0)
            for k in range(len(self.languages)):
                total[:, k] += np.bincount(rows[at:at + lot], sums[:, k], len(sizes))
        return total / np.maximum(sizes, 1)[:, None]


def sample(docs: DataFrame, max_rows: int, snippet: int, train_rows: Column | None = None) -> DataFrame:
    """At most ``max_rows`` (place, lang, part) rows, as many of each language as there are, up to an equal share.

    A language's rows are its first by a hash of the id, each a stretch of its
    text. A share of the hash's whole range, by the language's count, goes on
    to the choice, so few rows are sorted however many there are.
    """
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL")
    if train_rows is not None:
        rows = rows.where(train_rows)
    counts = staged(rows.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    quota = max(1, max_rows // max(1, counts.count()))
    place = F.xxhash64("doc_id", F.lit("snippet"))
    # a third more than wanted, and 50: enough rows are below the bound but for odds far below one in a million
    share = (F.lit(1.3 * quota + 50) / F.col("n"))
    bound = F.shiftrightunsigned("place", 1) / F.lit(float(2 ** 63))
    begin = F.pmod(F.xxhash64("doc_id"), F.greatest(F.lit(1), F.length("text") - snippet)) + 1
    some = (rows.withColumn("place", place).join(small_side(counts), "lang").where(bound < share)
            .select("place", "lang", F.substring("text", begin.cast("int"), F.lit(snippet)).alias("part")))
    first = Window.partitionBy("lang").orderBy("place", "part")
    return (some.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= quota).drop("nth")
            .orderBy("place", "lang", "part").limit(max_rows))


def train(docs: DataFrame, settings: Settings = Settings(), max_rows: int = 6000, snippet: int = 512,
          train_rows: Column | None = None) -> BiGru | None:
    """Learn from ``docs`` (doc_id, text, lang); None if no row has a language and a text."""
    ready(docs.sparkSession)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        if not rows:
            return
        languages = sorted({lang for lang, _ in rows})
        labels = np.array([languages.index(lang) for lang, _ in rows])
        model = BiGru.fresh(languages, settings)
        model.fit([part.encode("utf-8") for _, part in rows], labels, settings)
        yield pa.RecordBatch.from_pydict({
            "name": ["languages", *model.w],
            "shape": [[len(languages)], *([int(n) for n in a.shape] for a in model.w.values())],
            "data": ["\n".join(languages).encode("utf-8"), *(a.tobytes() for a in model.w.values())]},
            schema=pa.schema([("name", pa.string()), ("shape", pa.list_(pa.int32())), ("data", pa.binary())]))

    rows = sample(docs.select("doc_id", "text", "lang"), max_rows, snippet, train_rows)
    learned = (rows.repartition(1).sortWithinPartitions("place", "lang", "part").select("lang", "part")
               .mapInArrow(learn, "name string, shape array<int>, data binary")).collect()
    if not learned:
        return None
    parts = {r["name"]: r for r in learned}
    languages = bytes(parts.pop("languages")["data"]).decode("utf-8").split("\n")
    return BiGru(languages, {k: np.frombuffer(bytes(r["data"]), np.float32).reshape(r["shape"]).copy()
                             for k, r in parts.items()})


def predict(df: DataFrame, model: BiGru | None, text_col: str = "text", keep: Sequence[str] | None = None,
            window: int = Settings.window) -> DataFrame:
    """``df``'s ``keep`` columns (all if None) with ``lang_pred`` and ``score`` of every whole text."""
    kept = kept_fields(df, keep, ["lang_pred", "score"])
    names = [f.name for f in kept]
    schema = T.StructType([*kept, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    spark = df.sparkSession
    ready(spark)
    sent = spark.sparkContext.broadcast((model.languages, model.w) if model else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = BiGru(*sent.value) if sent.value else None
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            letters = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            columns = [batch.column(batch.schema.get_field_index(c)) for c in names]
            if net is None:
                found, score = ["und"] * batch.num_rows, np.zeros(batch.num_rows)
            else:
                means = net.documents(*text_buffer(texts), window)
                best = means.argmax(axis=1)
                found = [net.languages[k] if ok else "und" for k, ok in zip(best, letters)]
                score = np.where(letters, np.clip(means.max(axis=1), 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.string()), pa.array(score)],
                                             names=[*names, "lang_pred", "score"])

    read = df if keep is None else df.select(*dict.fromkeys([*keep, text_col]))
    return read.mapInArrow(run, schema)
