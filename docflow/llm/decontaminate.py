"""Benchmark decontamination by spaced-seed hashing, in SQL functions only.

Tokens are words of letters and digits, lower-cased. A spaced seed hashes the
tokens that a fixed mask selects from a window and ignores the others, so a
window with substituted tokens at ignored places still hits. The seeds of the
benchmark items are joined with those of every position of every document;
around each hit, document and item are aligned without gaps and compared token
by token. A document is contaminated by an item if some window of ``window``
item tokens (the whole item if it is shorter) agrees in ``share`` of its
tokens with the document at that alignment.

Every task holds a bitmap of the benchmark's seeds (32 bits a seed, 16 MB at
most) and drops the positions whose seed is not marked there, so that memory
stays bounded for any benchmark and the documents' positions are not shuffled.
What is left meets the seeds themselves, which are broadcast if they are at
most ``block_seeds`` and small, and else dealt by seed. Hits are distinct by
document, item text and alignment before their documents are read again to
compare tokens; items of equal tokens are searched and compared once.

Defined results: null or empty texts and items without tokens match nothing;
short items have lighter masks of their own, and an item of fewer than five tokens,
which may have no substitution, is searched as its whole token sequence;
rows with equal doc_id and text count as one document, and equal item ids with
different texts are different items of one id; null ids are kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import BROADCAST_ROWS, small_side, staged, text_hash

#: The masks (1: the token counts, 0: ignored). Span 8 and 7, weight 5 each.
MASKS = ("11010011", "1100111")
#: With these, a seed hits under every pattern of substitutions that a window of 16 tokens and a share of 0.8 allow
#: (by enumeration in the tests): one mask for all items, and lighter ones for items of so many tokens.
MORE_MASKS = ("1111000101",)
SHORT_MASKS = {5: ("111", "1101"), 6: ("1111", "11011"), 7: ("11111", "111101"), 8: ("11111",), 10: ("11111",)}
ALL_MASKS = (*MASKS, *MORE_MASKS)

#: 64-bit words of the bitmap of seeds (two seeds a word between these), bits that each seed sets in its word, words of a part.
LEAST_WORDS, MOST_WORDS, MARKS, PART_WORDS = 1 << 10, 1 << 21, 4, 1 << 10


def tokens(text: Column) -> Column:
    """Lower-cased words of letters and digits (none for a null)."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _seed(hashes: Column, at: Column, mask: str) -> Column:
    """The hash of the tokens that ``mask`` selects at position ``at`` (from 0)."""
    chosen = [F.get(hashes, at + k) for k, c in enumerate(mask) if c == "1"]
    return F.xxhash64(F.lit(mask), *chosen)


def _seeded(rows: DataFrame, masks: list[str], only: dict[str, set[int]] | None = None) -> DataFrame:
    """``rows`` with (at, seed): a seed for every position and mask that fits there.

    A mask in ``only`` takes rows of its lengths.
    """
    last = F.size("h") - min(map(len, masks))
    at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    fits = [(F.size("h") - F.col("at") >= len(m)) & (F.size("h").isin(*only[m]) if only and m in only else F.lit(True))
            for m in masks]
    seeds = F.array(*(F.when(f, _seed(F.col("h"), F.col("at"), m)) for f, m in zip(fits, masks)))
    return (rows.withColumn("at", F.explode(at)).withColumn("seed", F.explode(seeds))
            .where("seed IS NOT NULL"))


def _word(seed: Column, words: int) -> Column:
    """The place of a seed's word in a bitmap of ``words`` words (a power of two)."""
    return F.shiftrightunsigned(seed, 6 * MARKS).bitwiseAND(F.lit(words - 1)).cast("int")


def _marks(seed: Column) -> Column:
    """A word with the bits that a seed sets."""
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(seed, 6 * k).bitwiseAND(F.lit(63)).cast("int"))
            for k in range(MARKS)]
    return reduce(Column.bitwiseOR, bits)


def _bitmap(seeds: DataFrame, words: int) -> DataFrame:
    """One row with the array of ``words`` words in which the seeds are marked; sorted in parts, then put together."""
    seed = F.col("seed")
    marked = seeds.groupBy(_word(seed, words).cast("long").alias("id")).agg(F.bit_or(_marks(seed)).alias("word"))
    word = F.struct("id", F.coalesce("word", F.lit(0).cast("long")).alias("word"))
    part = F.transform(F.array_sort(F.collect_list(word)), lambda x: x.word)
    parts = (seeds.sparkSession.range(words).join(marked, "id", "left")
             .groupBy(F.floor(F.col("id") / PART_WORDS).alias("part")).agg(part.alias("bits")))
    return parts.agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("part", "bits"))), lambda x: x.bits)).alias("bits"))


def contaminated(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = ALL_MASKS, window: int = 16,
                 share: float = 0.8, block_seeds: int = 2_000_000) -> DataFrame:
    """(doc_id, item_id, item_tokens, matched, best_window, first_token) of every contaminated document."""
    return overlaps(docs, benchmark, masks, window, share, block_seeds).drop("text_hash")


def overlaps(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = ALL_MASKS, window: int = 16,
             share: float = 0.8, block_seeds: int = 2_000_000) -> DataFrame:
    """``contaminated`` with the ``text_hash`` of the document's text besides.

    ``matched`` counts the item's tokens that agree at the best alignment,
    ``best_window`` those of the best window there, and ``first_token`` is the
    place of the item's first token in the document (negative if it is cut).
    """
    hashed = lambda c: F.transform(tokens(F.col(c)), lambda w: F.xxhash64(w))
    items = benchmark.select("item_id", hashed("text").alias("h")).where(F.size("h") > 0)
    items = staged(items.distinct().withColumn("item", F.xxhash64("h")), "items")
    wants = staged(items.select("item", "h").distinct(), "wants")
    # Lengths with masks of their own; of other items too short for any mask, the length is a mask without gaps.
    short = wants.select(F.size("h").alias("n")).where(F.col("n") <= max(*SHORT_MASKS, *map(len, masks))).distinct()
    only: dict[str, set[int]] = {}
    for n in sorted(r.n for r in short.collect()):
        for mask in SHORT_MASKS.get(n, ("1" * n,) if n < min(map(len, masks)) else ()):
            only.setdefault(mask, set()).add(n)
    every = [*masks, *only]
    seeds = staged(_seeded(wants, every, only).select("item", F.col("at").alias("item_at"), "seed"), "seeds")

    words = min(max(LEAST_WORDS, 1 << (seeds.count() // 2).bit_length()), MOST_WORDS)
    seed = F.col("seed")
    unmarked = F.bitwise_not(F.get(_bitmap(seeds, words).scalar(), _word(seed, words))).bitwiseAND(_marks(seed))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    places = _seeded(texts.select("doc_id", text_hash(), hashed("text").alias("h")), every)
    same = F.col("doc_id").eqNullSafe(F.col("their_id")) & (F.col("text_hash") == F.col("their_hash"))
    theirs = [F.col("doc_id").alias("their_id"), F.col("text_hash").alias("their_hash")]
    hits = (places.where(unmarked == 0).select("doc_id", "text_hash", "at", "seed")
            .join(small_side(seeds, min(block_seeds, BROADCAST_ROWS)), "seed")
            # the item's first token in the document
            .select(*theirs, "item", (F.col("at") - F.col("item_at")).alias("first_token")).distinct())
    hits = staged(hits.join(small_side(wants.select("item", F.col("h").alias("want"))), "item"), "hits")

    near = small_side(staged(hits.select("their_id", "their_hash").distinct(), "near"))
    held = staged(texts.withColumn("text_hash", text_hash()).join(near, same, "left_semi"), "held")
    if not held.groupBy("doc_id", "text_hash").count().where("count > 1").isEmpty():
        held = held.dropDuplicates(["doc_id", "text_hash"])
    hits = held.select("doc_id", "text_hash", hashed("text").alias("h")).join(small_side(hits), same)

    start = F.col("first_token")
    agree = F.transform("want", lambda w, k: F.when((start + k >= 0) & (F.get("h", start + k) == w), 1).otherwise(0))
    aligned = (hits.withColumn("agree", agree)
               .withColumn("item_tokens", F.size("want")).withColumn("width", F.least(F.size("want"), F.lit(window))))
    add = lambda a, b: a + b
    best = F.array_max(F.transform(F.sequence(F.lit(1), F.col("item_tokens") - F.col("width") + 1),
                                   lambda i: F.aggregate(F.slice("agree", i, F.col("width")), F.lit(0), add)))
    judged = (aligned.withColumn("matched", F.aggregate("agree", F.lit(0), add)).withColumn("best_window", best)
              .where(F.col("best_window") >= F.ceil(F.col("width") * share)))
    pick = F.max(F.struct("best_window", "matched", (-F.col("first_token")).alias("back"), "item_tokens")).alias("p")
    return (judged.groupBy("doc_id", "text_hash", "item").agg(pick)
            .join(small_side(items.select("item", "item_id")), "item")
            .select("doc_id", "text_hash", "item_id", "p.item_tokens", "p.matched", "p.best_window",
                    (-F.col("p.back")).alias("first_token")))
