"""A tagger that uses context (U1): Viterbi decoding over counted tables.

Transitions between classes and words per class are counted in Spark from
tagged sentences. Scores are whole numbers (millionths of a natural
logarithm, each count plus one), so sums are exact and every engine finds the
same best path; of equal paths the one with the lower classes, compared from
the end, wins. Decoding runs in Arrow batches, many sentences at a time.

The word table is handed to the tasks if its summed bytes fit a bound; beyond
it, the commonest words are, and the others meet the table in a join, once per
block of neighbouring texts, from which their scores come back to the block.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.operators.enrich import BROADCAST_MAX_BYTES, ROW_OVERHEAD_BYTES, TOKEN_PATTERN, tokenize
from docflow.session import shared_dir, ship_package

SCALE = 1_000_000
SENTENCE_ENDS = r"[.!?\n]"
#: Sentences decoded side by side.
STEP = 4096
#: Words counted together before Spark adds the counts up.
COUNT_STEP = 1 << 20
#: Sentences, about, that are handed to Python together with the scores of their words.
BLOCK_SENTENCES = 1 << 14


@dataclass
class Tables:
    """``classes`` in order, ``start`` [S] and ``moves`` [S, S] (from, to) as scores, ``unseen`` [S] for words not
    in the table, and ``words``: (word, scores array<bigint>, n: how often it was counted)."""

    classes: list[str]
    start: list[int]
    moves: list[list[int]]
    unseen: list[int]
    words: DataFrame


def score(count: Column, total: Column) -> Column:
    """ln(count / total) in whole millionths."""
    return F.round(F.log(count / total) * SCALE).cast("long")


def sentences(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, row, sentence, words): the sentences of every text that have a word; ``row`` tells repeated ids apart."""
    path = shared_dir(docs.sparkSession, "sentences")
    texts = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"))
    parts = texts.select("id", "row", F.posexplode(F.split("text", SENTENCE_ENDS, -1)).alias("sentence", "text"))
    # a filter on the words themselves would run the word pattern twice
    parts.where(F.col("text").rlike(TOKEN_PATTERN)).select("id", "row", "sentence", tokenize("text").alias("words")).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def _flat(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The values of a list column and where each list begins, with the end of the last."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return column.flatten(), np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])


def _count_batches(classes: Sequence[str]):
    """Arrow batches of (words, tags) -> (word, after, n0..): counts by class of each word, and of the words that
    follow class number ``after`` (-1: that begin a sentence), added up over ``COUNT_STEP`` words or more."""
    n = len(classes)

    def counted(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        (words, starts), (tags, tag_starts) = _flat(whole.column("words")), _flat(whole.column("tags"))
        if not np.array_equal(starts, tag_starts):
            raise ValueError("a sentence needs as many tags as words")
        tag = pc.fill_null(pc.index_in(tags, pa.array(classes, pa.string())), -1).to_numpy(zero_copy_only=False)
        coded = words.dictionary_encode(null_encoding="encode")
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        ours = tag >= 0
        by_word = np.bincount(code[ours] * n + tag[ours], minlength=len(coded.dictionary) * n).reshape(-1, n)
        before = np.concatenate([[-1], tag[:-1]])
        before[starts[:-1][np.diff(starts) > 0]] = n                          # the first of a sentence
        pair = ours & (before >= 0)
        moved = np.bincount(before[pair].astype(np.int64) * n + tag[pair], minlength=(n + 1) * n).reshape(-1, n)
        counts = np.concatenate([by_word, moved])
        names = pa.concat_arrays([coded.dictionary, pa.nulls(n + 1, pa.string())])
        after = pa.concat_arrays([pa.nulls(len(by_word), pa.int32()), pa.array([*range(n), -1], pa.int32())])
        return pa.record_batch([names, after, *(pa.array(counts[:, k], pa.int64()) for k in range(n))],
                               names=["word", "after", *(f"n{k}" for k in range(n))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += len(batch.column("words").flatten())
            if size >= COUNT_STEP:
                yield counted(held)
                held, size = [], 0
        if held:
            yield counted(held)

    return run


def count_tables(tagged: DataFrame, classes: Sequence[str]) -> Tables:
    """The tables of tagged sentences (words array<string>, tags array<string>), counted in one pass.

    Tasks count in Arrow batches, Spark adds the counts up. Only the tables
    over classes (S x S numbers) come to the driver.
    """
    spark = tagged.sparkSession
    ship_package(spark)
    classes = sorted(classes)
    n = len(classes)
    path = shared_dir(spark, "word-counts")
    tagged.select("words", "tags").where("words IS NOT NULL").mapInArrow(
        _count_batches(classes), "word string, after int, " + ", ".join(f"n{k} bigint" for k in range(n))).groupBy("word", "after").agg(
        *[F.sum(f"n{k}").alias(f"n{k}") for k in range(n)]).write.parquet(path)
    counts = spark.read.parquet(path)
    moved = {r["after"]: [r[f"n{k}"] for k in range(n)] for r in counts.where("after IS NOT NULL").collect()}
    seen = counts.where("after IS NULL")

    def scores(counts: list[int]) -> list[int]:
        total = sum(counts) + n
        rows = spark.range(1).select(*[score(F.lit(c + 1), F.lit(total)) for c in counts])
        return [int(v) for v in rows.first()]

    sums = seen.agg(F.count(F.lit(1)), *[F.sum(f"n{k}") for k in range(n)]).first()
    totals = [int(s or 0) + int(sums[0]) + 1 for s in sums[1:]]                 # one more for words not seen
    words = seen.select("word", F.array(*[score(F.col(f"n{k}") + 1, F.lit(t)) for k, t in enumerate(totals)]).alias("scores"),
                        sum((F.col(f"n{k}") for k in range(n)), F.lit(0).cast("long")).alias("n"))
    one = spark.range(1).select(*[score(F.lit(1), F.lit(t)) for t in totals]).first()
    none = [0] * n
    return Tables(classes, scores(moved.get(-1, none)), [scores(moved.get(k, none)) for k in range(n)], [int(v) for v in one], words)


def _best_flat(emitted: np.ndarray, starts: np.ndarray, start: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The best class number of every word: ``emitted`` [words, S] holds the sentences one after the other, sentence
    k from ``starts[k]`` to ``starts[k + 1]``. ``STEP`` sentences go side by side, one word at a time."""
    states = len(start)
    path = np.zeros(len(emitted), np.int64)
    back = np.zeros((len(emitted), states), np.int32)
    lengths = np.diff(starts)
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    for lo in range(0, len(order), STEP):
        first, length = starts[order[lo:lo + STEP]], lengths[order[lo:lo + STEP]]
        live = np.searchsorted(-length, -np.arange(1, int(length[0]) + 1), side="left")   # longer than t words: these come first
        value = start + emitted[first]
        for t, k in enumerate([*live.tolist()], 1):
            path[first[k:len(value)] + t - 1] = value[k:].argmax(axis=1)        # sentences that end here
            if not k:
                break
            value = value[:k]
            best, came = value[:, :1] + moves[0], np.zeros((k, states), np.int32)
            for a in range(1, states):
                other = value[:, a:a + 1] + moves[a]
                came[other > best] = a                                           # the lowest of equal classes
                np.maximum(best, other, out=best)
            at = first[:k] + t
            back[at] = came
            value = best + emitted[at]
        for t in range(int(length[0]) - 1, 0, -1):
            at = first[:live[t - 1]] + t
            path[at - 1] = back[at, path[at]]
    return path


def best_paths(emitted: list[np.ndarray], start: np.ndarray, moves: np.ndarray) -> list[np.ndarray]:
    """The best class numbers of each sentence, given its words' scores [length, S]."""
    starts = np.concatenate([[0], np.cumsum([len(e) for e in emitted], dtype=np.int64)])
    if not starts[-1]:
        return [np.zeros(0, np.int64) for _ in emitted]
    flat = _best_flat(np.concatenate([e for e in emitted if len(e)]), starts, start, moves)
    return [flat[a:b] for a, b in zip(starts, starts[1:])]


def _held(tables: Tables, max_table_bytes: int) -> tuple[Column, bool]:
    """Which words are handed to the tasks, and whether that is all of them.

    The commonest that fit ``max_table_bytes``, by powers of two of their counts.
    """
    n = F.col("n") if "n" in tables.words.columns else F.lit(0)
    power = F.floor(F.log2(n + 1)).cast("int")
    size = F.sum(F.octet_length("word") + 8 * len(tables.classes) + ROW_OVERHEAD_BYTES)
    least, total, whole = None, 0, True
    for p, b in sorted(tuple(r) for r in tables.words.where("word IS NOT NULL").groupBy(power).agg(size).collect())[::-1]:
        total += b
        if total > max_table_bytes:
            whole = False
            break
        least = p
    return (F.lit(False) if least is None else power >= least), whole


def _sentence_rows(given: pa.Table, words: pa.Array, starts: np.ndarray, path: np.ndarray, classes: Sequence[str], _) -> pa.Table:
    """(id, row, sentence, words, tags)."""
    tags = pa.DictionaryArray.from_arrays(pa.array(path, pa.int32()), pa.array(classes, pa.string())).cast(pa.string())
    lists = [pa.ListArray.from_arrays(pa.array(starts, pa.int32()), v) for v in (words, tags)]
    return pa.table([*(given.column(c) for c in ("id", "row", "sentence")), *lists], names=["id", "row", "sentence", "words", "tags"])


def _class_rows(given: pa.Table, words: pa.Array, starts: np.ndarray, path: np.ndarray, classes: Sequence[str], shared: np.ndarray) -> pa.Table:
    """(id, row, tag, n, different, words) of the whole texts given; ``words`` only for the rows in ``shared``."""
    coded = words.dictionary_encode(null_encoding="encode")
    known = max(len(coded.dictionary), 1)
    rows, first, row = np.unique(given.column("row").to_numpy(), return_index=True, return_inverse=True)
    group = np.repeat(row, np.diff(starts)) * len(classes) + path
    pairs, times = np.unique(group * known + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
    groups, begin = np.unique(pairs // known, return_index=True)
    row, tag = groups // len(classes), groups % len(classes)
    different = np.diff([*begin, len(pairs)])
    kept = np.isin(rows[row], shared)
    ends = np.concatenate([[0], np.cumsum(np.where(kept, different, 0))])
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), coded.dictionary.take(pa.array(pairs[np.repeat(kept, different)] % known)),
                                     mask=pa.array(~kept))
    return pa.table([given.column("id").take(pa.array(first[row])), pa.array(rows[row], pa.int64()), pa.array(classes, pa.string()).take(pa.array(tag)),
                     pa.array(np.add.reduceat(times, begin), pa.int64()), pa.array(different, pa.int64()), lists],
                    names=["id", "row", "tag", "n", "different", "words"])


def decode(parts: DataFrame, tables: Tables, max_table_bytes: int = BROADCAST_MAX_BYTES, *, by_class: bool = False) -> DataFrame:
    """(id, row, sentence, words, tags): the best classes of every sentence's words.

    ``by_class`` gives them by text and class instead, (id, row, tag, n,
    different, words): how many words got the class, how many different ones,
    and which, if other texts have the id; :func:`class_counts` adds them up.
    """
    spark = parts.sparkSession
    ship_package(spark)
    start, moves = np.array(tables.start), np.array(tables.moves)
    classes, states = tables.classes, len(tables.classes)
    held, whole = _held(tables, max_table_bytes)
    common = tables.words.where(held).where("word IS NOT NULL").select("word", "scores").toArrow()
    listed = common.column("scores").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, states)
    kinds, kind = np.unique(listed, axis=0, return_inverse=True)                # few words have scores of their own
    known = spark.sparkContext.broadcast((dict(zip(common.column("word").to_pylist(), (kind.reshape(-1) + 1).tolist())),
                                          np.concatenate([[tables.unseen], kinds]).astype(np.int64)))
    finish = _class_rows if by_class else _sentence_rows

    def coded(column: pa.Array) -> tuple[pa.Array, np.ndarray, list, np.ndarray, np.ndarray]:
        """The words and where sentences begin; the different words, the number of each one's scores (0: not held), and which word is which."""
        words, starts = _flat(column)
        different = words.dictionary_encode(null_encoding="encode")
        names, get = different.dictionary.to_pylist(), known.value[0].get
        return words, starts, names, np.array([get(w, 0) for w in names], np.int64), different.indices.to_numpy(zero_copy_only=False)

    def tagged(given: pa.Table, more: pa.Table | None) -> pa.Table:
        words, starts, names, number, which = coded(given.column("words").combine_chunks())
        table, shared = known.value[1], np.zeros(0, np.int64)
        if more is not None and more.num_rows:
            shared = more.column("row").drop_null().to_numpy()
            found = more.filter(pc.is_valid(more.column("scores")))
            own = dict(zip(found.column("word").to_pylist(), range(len(table), len(table) + found.num_rows)))
            table = np.concatenate([table, found.column("scores").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, states)])
            number = np.array([k or own.get(w, 0) for k, w in zip(number.tolist(), names)], np.int64)
        return finish(given, words, starts, _best_flat(table[number[which]], starts, start, moves), classes, shared)

    id_type = parts.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, row bigint, " + ("tag string, n bigint, different bigint, words array<string>" if by_class else
                                              "sentence int, words array<string>, tags array<string>")
    given = parts.select("id", "row", "sentence", "words").where("size(words) > 0")
    if whole and not by_class:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    yield from tagged(pa.Table.from_batches([batch]), None).combine_chunks().to_batches()

        return given.mapInArrow(run, schema)

    # Texts go in blocks of neighbours, each with the scores of those of its words that are not held.
    n, texts = given.agg(F.count(F.lit(1)), F.approx_count_distinct("row")).first()
    blocked = given.withColumn("block", F.expr(f"row div {max(1, BLOCK_SENTENCES * texts // max(n, 1))}L"))

    def lacking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, starts, names, number, which = coded(batch.column("words"))
            block = np.repeat(batch.column("block").to_numpy(), np.diff(starts))
            ours = number[which] == 0
            blocks, at = np.unique(block[ours], return_inverse=True)
            pairs = np.unique(at * max(len(names), 1) + which[ours])
            yield pa.record_batch([pa.array(blocks[pairs // max(len(names), 1)], pa.int64()),
                                   pa.array(names, pa.string()).take(pa.array(pairs % max(len(names), 1)))], names=["block", "word"])

    more = spark.createDataFrame([], "block bigint, word string, scores array<bigint>, row bigint")
    if not whole:
        asked = blocked.select("block", "words").mapInArrow(lacking, "block bigint, word string")
        more = asked.join(tables.words.where(~held), "word").select("block", "word", "scores", F.lit(None).cast("long").alias("row"))
    if by_class:
        rows = blocked.select("id", "row", "block").distinct()
        repeated = rows.groupBy(F.col("id").alias("_id")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        more = more.unionByName(rows.join(repeated, F.col("id").eqNullSafe(F.col("_id"))).select(
            "block", F.lit(None).cast("string").alias("word"), F.lit(None).cast("array<bigint>").alias("scores"), "row"))

    def run_block(left: pa.Table, right: pa.Table) -> pa.Table:
        return tagged(left, right)                                               # no block without a sentence asks for anything

    return blocked.groupBy("block").cogroup(more.groupBy("block")).applyInArrow(run_block, schema)


def class_counts(found: DataFrame) -> DataFrame:
    """(id, tag, n, words): how many words of an id's texts got a class, and how many different ones, of what :func:`decode` gives ``by_class``."""
    listed = F.col("words").isNotNull()
    spread = found.select("id", "tag", "n", F.when(listed, 0).otherwise(F.col("different")).alias("alone"),
                          F.posexplode(F.coalesce("words", F.array(F.lit(None).cast("string")))).alias("k", "word"))
    return spread.groupBy("id", "tag").agg(F.sum(F.when(F.col("k") == 0, F.col("n"))).alias("n"),
                                           (F.sum("alone") + F.countDistinct("word")).alias("words"))


def with_gazetteer_tags(parts: DataFrame, entries: dict[str, str], other: str) -> DataFrame:
    """Sentences with the class that a small word list gives each word: what tables are counted from without labelled text."""
    found = F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])
    return parts.withColumn("tags", F.transform("words", lambda w: F.coalesce(found[w], F.lit(other))))
