"""Quality rules from tokeniser fertility.

Public byte-level vocabularies encode every whole text; characters per token,
the share of byte-fallback tokens (single bytes that are no characters) and the
entropy of the tokens are compared with bands for the text's main script. The
bands are learned from the corpus: quartiles, per script and vocabulary, over
all documents that pass the base rules, widened by multiples of the distance
between them; a script with few such documents has a fixed band. Of the
vocabularies, the one whose characters per token vary least over a script's
documents (relative to the median) judges that script: a vocabulary that
splits it into bytes says little about it. Measuring is a narrow,
Arrow-batched map; learning shuffles one quantile sketch per task, script and
vocabulary, and a few numbers per script come to the driver.

Defined results: a null or empty text has no words, no tokens, script ``none``
and null measures, and no vocabulary accepts it; repeated rows measure alike
and each counts; the new columns replace those of their names; an empty table
learns nothing, so the fixed bands hold. Bands follow the middle half of a
script's documents: a corpus of which a quarter is junk widens them.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.llm.common import kept_fields, ready

#: First code point of each range and the script that holds from there.
SCRIPT_STARTS = (
    (0x0000, "none"), (0x0041, "latin"), (0x005B, "none"), (0x0061, "latin"), (0x007B, "none"), (0x00AA, "latin"),
    (0x00AB, "none"), (0x00BA, "latin"), (0x00BB, "none"), (0x00C0, "latin"), (0x02B0, "none"), (0x0370, "greek"),
    (0x0400, "cyrillic"), (0x0530, "other"), (0x0590, "hebrew"), (0x0600, "arabic"), (0x0780, "other"),
    (0x0900, "indic"), (0x0E00, "thai"), (0x0E80, "other"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "none"), (0x2C00, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"),
    (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"), (0xFE00, "none"),
    (0x10000, "other"), (0x1F000, "none"), (0x20000, "han"), (0x323B0, "none"))
_STARTS = np.array([s for s, _ in SCRIPT_STARTS], np.uint32)
_NAMES = sorted({n for _, n in SCRIPT_STARTS})
_CODES = np.array([_NAMES.index(n) for _, n in SCRIPT_STARTS])


@dataclass(frozen=True)
class Band:
    """What a text of a script may measure under a vocabulary."""

    least_chars: float
    most_chars: float = 12.0
    most_fallback: float = 1.0
    least_entropy: float = 2.0
    most_entropy: float = 16.0


#: Bands by script under a vocabulary of many languages, for scripts that the corpus has few documents of.
#: The least characters per token lie between those of prose and of random letters of the script.
BANDS = {
    "latin": Band(1.75, 9.0, 0.2),
    "cyrillic": Band(2.0, 9.0, 0.2),
    "greek": Band(1.55, 9.0, 0.2),
    "han": Band(0.7, 5.0, 0.45),
    "kana": Band(1.1, 5.0, 0.15),
    "hangul": Band(1.0, 5.0, 0.4),
    "arabic": Band(1.45, 9.0, 0.2),
    "hebrew": Band(1.5, 9.0, 0.2),
    "indic": Band(0.78, 9.0, 0.4),
    "thai": Band(1.0, 9.0, 0.2),
}
OTHER_BAND = Band(0.4, 12.0, 0.9)

#: Documents of a script from which its bands are learned.
SUPPORT = 100
#: How far a band reaches beyond the quartiles, in distances between them (Tukey's fences: 1.5 is outside, 3 far out).
#: Few characters per token are what junk and gibberish have, so that side is the narrow one.
FENCE, FAR_FENCE = 1.5, 3.0


def main_script(text: str) -> str:
    """The script of most of the text's letters (``none`` without letters; ties: the first by name)."""
    if not text:
        return "none"
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    counts = np.bincount(_CODES[np.searchsorted(_STARTS, points, side="right") - 1], minlength=len(_NAMES))
    counts[_NAMES.index("none")] = 0
    return _NAMES[int(counts.argmax())] if counts.any() else "none"


def repeated_words(words: list[bytes]) -> int:
    """Words in three-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    k = len(known)
    pair = ids[:-2] * k + ids[1:-1]
    if k > 2_000_000:                                       # k ** 3 must fit 63 bits
        _, pair = np.unique(pair, return_inverse=True)
    _, place, counts = np.unique(pair * k + ids[2:], return_inverse=True, return_counts=True)
    twice = counts[place] > 1
    inside = np.zeros(n, bool)
    inside[:-2] |= twice
    inside[1:-1] |= twice
    inside[2:] |= twice
    return int(inside.sum())


def counts_of(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (white space: blank, \\t to \\r)."""
    raw = text.encode("utf-8")
    words = raw.split()
    chars = len(text) - sum(text.count(c) for c in " \t\n\x0b\x0c\r")
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


class Vocabulary:
    """A public byte-level vocabulary (a file of base64 token and rank a line)."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.fallback = np.zeros(max(ranks.values()) + 1, bool)
        self.fallback[[r for b, r in ranks.items() if len(b) == 1 and b[0] >= 128]] = True

    def measure(self, text: str) -> tuple[int, float | None, float | None, float | None]:
        """Tokens, characters per token, byte-fallback share, entropy in bits."""
        ids = self.encoding.encode_to_numpy(text, disallowed_special=()) if text else np.zeros(0, np.uint32)
        if not len(ids):
            return 0, None, None, None
        _, counts = np.unique(ids, return_counts=True)
        share = counts / len(ids)
        return (len(ids), len(text) / len(ids), float(self.fallback[ids].mean()),
                float(-(share * np.log2(share)).sum()) + 0.0)


_LOADED: dict[tuple[str, str], Vocabulary] = {}


def _vocabulary(path: str, pattern: str) -> Vocabulary:
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = Vocabulary(path, pattern)
    return _LOADED[path, pattern]


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURE = T.ArrayType(T.StructType([
    T.StructField("vocabulary", T.StringType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("chars_per_token", T.DoubleType()), T.StructField("fallback_share", T.DoubleType()),
    T.StructField("entropy", T.DoubleType())]))
_ARROW = pa.list_(pa.struct([("vocabulary", pa.string()), ("n_tokens", pa.int64()), ("chars_per_token", pa.float64()),
                             ("fallback_share", pa.float64()), ("entropy", pa.float64())]))


def measure(df: DataFrame, vocabularies: dict[str, str], pattern: str, text_col: str = "text",
            keep: Sequence[str] | None = None) -> DataFrame:
    """``df``'s ``keep`` columns (all if None) with the counts, ``script`` and ``measures`` of every whole text.

    ``vocabularies`` maps names to paths that every executor can read, and
    ``pattern`` splits texts before merging.
    """
    new = [*(T.StructField(c, T.LongType()) for c in COUNTS), T.StructField("script", T.StringType()),
           T.StructField("measures", MEASURE)]
    kept = kept_fields(df, keep, [f.name for f in new])
    names = [f.name for f in (*kept, *new)]
    ready(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = [(n, _vocabulary(p, pattern)) for n, p in vocabularies.items()]
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            counts, scripts, measures = [], [], []
            for value in texts:
                text = value.as_py() or ""
                counts.append(counts_of(text))
                scripts.append(main_script(text))
                measures.append([dict(zip(("vocabulary", "n_tokens", "chars_per_token", "fallback_share", "entropy"),
                                          (n, *t.measure(text)))) for n, t in tools])
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            columns += [pa.array([c[k] for c in counts], pa.int64()) for k in range(len(COUNTS))]
            columns += [pa.array(scripts, pa.string()), pa.array(measures, _ARROW)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    read = df if keep is None else df.select(*dict.fromkeys([*keep, text_col]))
    return read.mapInArrow(run, T.StructType([*kept, *new]))


@dataclass(frozen=True)
class Judge:
    """The vocabulary that judges a script, and its band."""

    vocabulary: str
    band: Band


def learn(measured: DataFrame, support: int = SUPPORT) -> dict[str, Judge]:
    """The judge of every script with ``support`` documents that pass the base rules (columns of ``measure``)."""
    rows = measured.where(~base_failed()).select("script", F.explode("measures").alias("m")).where("m.n_tokens > 0")
    quartiles = lambda c: F.percentile_approx(f"m.{c}", [0.25, 0.5, 0.75], 10000).alias(c)
    found = rows.groupBy("script", "m.vocabulary").agg(
        F.count("*").alias("n"), *(quartiles(c) for c in ("chars_per_token", "fallback_share", "entropy"))).collect()
    judges: dict[str, tuple[float, Judge]] = {}
    for r in sorted(found):
        if r["n"] < support or r["script"] == "none":
            continue
        (c1, c2, c3), (f1, _, f3), (e1, _, e3) = r["chars_per_token"], r["fallback_share"], r["entropy"]
        spread, wide = max(c3 - c1, 0.02 * c2), max(e3 - e1, 0.1)
        band = Band(c1 - FENCE * spread, c3 + FAR_FENCE * spread, f3 + FAR_FENCE * max(f3 - f1, 0.02),
                    e1 - FAR_FENCE * wide, e3 + FAR_FENCE * wide)
        if r["script"] not in judges or (c3 - c1) / c2 < judges[r["script"]][0]:
            judges[r["script"]] = ((c3 - c1) / c2, Judge(r["vocabulary"], band))
    return {script: judge for script, (_, judge) in judges.items()}


def accepted(learned: dict[str, Judge] | None = None, bands: dict[str, Band] = BANDS, other: Band = OTHER_BAND) -> Column:
    """Whether the vocabulary that judges a text's script finds it inside the band (columns of ``measure``).

    Scripts that are not ``learned`` are judged by the first vocabulary and ``bands``.
    """
    def inside(m: Column, band: Band) -> Column:
        return (m["chars_per_token"].between(band.least_chars, band.most_chars)
                & (m["fallback_share"] <= band.most_fallback) & m["entropy"].between(band.least_entropy, band.most_entropy))

    def fits(judge: Judge) -> Column:
        return F.coalesce(F.exists("measures", lambda m: (m["vocabulary"] == judge.vocabulary) & inside(m, judge.band)), F.lit(False))

    first = lambda band: F.coalesce(inside(F.col("measures")[0], band), F.lit(False))
    out = F.when(F.lit(False), False)
    for script, judge in (learned or {}).items():
        out = out.when(F.col("script") == script, fits(judge))
    for script, band in bands.items():
        out = out.when(F.col("script") == script, first(band))
    return out.otherwise(first(other))


def base_failed() -> Column:
    """The base rules: fewer than 50 words, or over half of the words in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
