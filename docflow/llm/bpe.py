"""BPE encoding and decoding with a public vocabulary file.

Encoding merges each word's symbols by a priority queue of merge ranks over a
doubly linked symbol list; queue entries whose symbols have changed since are
stale and skipped. Decoding joins the vocabulary strings of the ids. Both are
Arrow-batched narrow maps (no shuffle): a worker holds the vocabulary and a
bounded cache of words it has merged before.

Defined results: a null text is encoded as the empty text; an empty text has
no ids and decodes to an empty string; repeated rows each get their own row;
other columns pass through unless ``keep`` leaves them out, and a new column
replaces one of its name. The texts are encoded whole, whatever their length.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from docflow.llm.common import STEP_BYTES, kept_fields, ready

#: Words that each generation of a worker's cache may hold (two generations).
CACHE_WORDS = 100_000


def byte_symbols() -> list[str]:
    """The printable stand-in for each byte that byte-level vocabularies use."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in printable}
    spare = 256
    for b in range(256):
        if b not in table:
            table[b] = chr(spare)
            spare += 1
    return [table[b] for b in range(256)]


class Bpe:
    """A word-end BPE vocabulary read from a tokenizer file."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [(n["type"], n.get("content")) for n in spec["normalizer"]["normalizers"]]
        if steps != [("NFC", None), ("Replace", " "), ("Lowercase", None)] or spec["model"]["type"] != "BPE":
            raise ValueError(f"{path}: not a lower-casing word BPE file")
        model = spec["model"]
        vocab = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in vocab.items()} | {i: s for s, i in self.special.items()}
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocab[left], vocab[right]] = (rank, vocab[left + right])
        symbols = byte_symbols()
        self.inner = [vocab.get(s) for s in symbols]
        self.final = [vocab.get(s + self.suffix) for s in symbols]
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(pattern.replace(r"\s", r"\p{White_Space}")).findall
        self.spaces = regex.compile(r"\p{White_Space}+")
        names = sorted(self.special, key=len, reverse=True)
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.cache_words = cache_words
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    def merge(self, piece: str) -> list[int]:
        """The ids of one piece: best-ranked merge first, leftmost of equal ranks."""
        raw = piece.encode("utf-8")
        ids = [self.inner[b] for b in raw[:-1]]
        ids.append(self.final[raw[-1]])
        ids = [i for i in ids if i is not None]
        n = len(ids)
        if n < 2:
            return ids
        merges = self.merges
        before = list(range(-1, n - 1))
        after = [*range(1, n), -1]
        queue = []
        for i in range(n - 1):
            found = merges.get((ids[i], ids[i + 1]))
            if found:
                queue.append((found[0], i, ids[i], ids[i + 1], found[1]))
        heapq.heapify(queue)
        while queue:
            _, i, left, right, merged = heapq.heappop(queue)
            j = after[i]
            if ids[i] != left or j < 0 or ids[j] != right:
                continue                                    # stale
            ids[i], ids[j] = merged, -1
            k = after[j]
            after[i] = k
            if k >= 0:
                before[k] = i
                found = merges.get((merged, ids[k]))
                if found:
                    heapq.heappush(queue, (found[0], i, merged, ids[k], found[1]))
            h = before[i]
            if h >= 0:
                found = merges.get((ids[h], merged))
                if found:
                    heapq.heappush(queue, (found[0], h, ids[h], merged, found[1]))
        return [i for i in ids if i >= 0]

    def word(self, word: str) -> tuple[int, ...]:
        """The ids of a run without white space, from the cache if it was met lately."""
        ids = self.old.get(word)
        if ids is None:
            ids = tuple(chain.from_iterable(map(self.merge, self.pieces(word))))
        if len(self.young) >= self.cache_words:
            self.old, self.young = self.young, {}
        self.young[word] = ids
        return ids

    def _plain(self, text: str) -> list[tuple[int, ...]]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        if regex.search("[\x1c-\x1f]", text):               # white space to Python only
            words = [w for w in self.spaces.split(text) if w]
        else:
            words = text.split()
        get = self.young.get
        return [get(w) or self.word(w) for w in words]

    def encode(self, text: str) -> list[int]:
        """All ids of a text; special tokens' strings in it become their ids."""
        if self.at_special is None or not self.at_special.search(text):
            return list(chain.from_iterable(self._plain(text)))
        out: list[int] = []
        for part in self.at_special.split(text):
            if part in self.special:
                out.append(self.special[part])
            else:
                out.extend(chain.from_iterable(self._plain(part)))
        return out

    def decode(self, ids: Sequence[int]) -> str:
        """The vocabulary strings of the ids, one space between (the file names no decoder)."""
        return " ".join(map(self.strings.__getitem__, ids))


_LOADED: dict[str, Bpe] = {}


def load(path: str) -> Bpe:
    """The vocabulary at ``path``, read once per process."""
    if path not in _LOADED:
        _LOADED[path] = Bpe(path)
    return _LOADED[path]


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    i, size = 0, 0
    for j in range(len(texts)):
        size += len(texts[j].as_py() or "") + 64
        if size >= STEP_BYTES // 2:
            yield i, j + 1
            i, size = j + 1, 0
    if i < len(texts):
        yield i, len(texts)


def _ids_array(lists: list[list[int]]) -> pa.ListArray:
    ends = np.zeros(len(lists) + 1, np.int32)
    np.cumsum([len(x) for x in lists], out=ends[1:])
    flat = np.fromiter(chain.from_iterable(lists), np.int32, count=int(ends[-1]))
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def encode(df: DataFrame, path: str, text_col: str = "text", keep: Sequence[str] | None = None,
           decoded: bool = False) -> DataFrame:
    """``df``'s ``keep`` columns (all if None) with ``ids array<int>`` of every whole text.

    With ``decoded``, the ids are also decoded in the same pass (column
    ``decoded``). ``path`` must name the vocabulary file on every executor.
    """
    new = [T.StructField("ids", T.ArrayType(T.IntegerType()))]
    if decoded:
        new.append(T.StructField("decoded", T.StringType()))
    kept = kept_fields(df, keep, [f.name for f in new])
    schema, names = T.StructType([*kept, *new]), [f.name for f in kept]
    ready(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            for i, j in _slices(texts):
                lists = [bpe.encode(t or "") for t in texts.slice(i, j - i).to_pylist()]
                columns = [batch.column(batch.schema.get_field_index(c)).slice(i, j - i) for c in names]
                columns.append(_ids_array(lists))
                if decoded:
                    columns.append(pa.array([bpe.decode(x) for x in lists], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=[*names, *(f.name for f in new)])

    read = df if keep is None else df.select(*dict.fromkeys([*keep, text_col]))
    return read.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids_col: str = "ids", keep: Sequence[str] | None = None) -> DataFrame:
    """``df``'s ``keep`` columns with ``decoded``, the text that the ids stand for (null ids: empty)."""
    kept = kept_fields(df, keep, ["decoded"])
    schema = T.StructType([*kept, T.StructField("decoded", T.StringType())])
    names = [f.name for f in kept]
    ready(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids_col)).to_pylist()
            columns = [batch.column(batch.schema.get_field_index(c)) for c in names]
            columns.append(pa.array([bpe.decode(x or ()) for x in lists], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "decoded"])

    return df.mapInArrow(run, schema)
