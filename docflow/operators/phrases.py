"""Entities of several words (J3): the longest match in a trie of words.

The trie is a table with a row per prefix of a phrase, found by its text
(in a shuffle by the text's hash, too). Every word of a document starts a candidate;
the candidate goes down the trie by one join per level and remembers the
longest phrase it passed. Matches are then resolved per document, leftmost
first, longest first, without overlaps. Nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.operators.enrich import BROADCAST_MAX_BYTES, ROW_OVERHEAD_BYTES, tokenize
from docflow.session import shared_dir

#: Matches of a text that are gone through before what they keep is put to the rest.
RUN = 64


def phrase_trie(phrases: DataFrame, phrase_col: str = "phrase", class_col: str = "entity_class") -> DataFrame:
    """One row per prefix: (prefix, depth, class of the phrase that ends here or null, whether longer ones follow).

    A phrase is its words in order; of several classes it has the greatest.
    Phrases without a word and null classes drop out.
    """
    words = phrases.select(tokenize(phrase_col).alias("w"), F.col(class_col).alias("c")).where("size(w) > 0 AND c IS NOT NULL")
    prefix = lambda k: F.struct(F.array_join(F.slice("w", 1, k), " ").alias("prefix"), k.alias("depth"),
                                F.when(k == F.size("w"), F.col("c")).alias("c"), (k < F.size("w")).alias("more"))
    nodes = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.size("w")), prefix)).alias("n")).select("n.*")
    return nodes.groupBy("prefix", "depth").agg(F.max("c").alias("entity_class"), F.max("more").alias("more"))


def _down(at: DataFrame, trie: DataFrame, depth: int, small: bool) -> DataFrame:
    """Candidates one level deeper; those that end keep the longest phrase they passed."""
    level = trie.where(F.col("depth") == depth).select(
        F.col("prefix").alias("_prefix"), F.col("entity_class").alias("_class"), F.col("more").alias("_more"))
    alive = F.col("more") & F.col(f"w.w{depth}").isNotNull()
    met = at.withColumn("_text", F.when(alive, F.concat_ws(" ", *[f"w.w{k}" for k in range(1, depth + 1)])))
    same = F.col("_text") == F.col("_prefix")
    if small:
        level = F.broadcast(level)
    else:
        # candidates that are done meet no node: their key is their own place, so they do not pile up under one
        met = met.withColumn("_key", F.when(alive, F.xxhash64("_text")).otherwise(F.xxhash64("row", "pos")))
        same &= F.col("_key") == F.col("_node")
        level = level.withColumn("_node", F.xxhash64("_prefix"))
    met = met.join(level, same, "inner" if depth == 1 else "left")
    ends = F.col("_class").isNotNull()
    return met.select("row", "id", "pos", "w", F.when(ends, F.lit(depth)).otherwise(F.col("width")).alias("width"),
                      F.when(ends, F.col("_prefix")).otherwise(F.col("phrase")).alias("phrase"),
                      F.when(ends, F.col("_class")).otherwise(F.col("entity_class")).alias("entity_class"),
                      F.coalesce("_more", F.lit(False)).alias("more"))


def _resolved(found: DataFrame) -> DataFrame:
    """Leftmost matches first: a match is kept if it starts where the one kept before it has ended.

    The matches of a text meet in one list and are gone through in runs of
    ``RUN``, so that what is kept is not copied for every match.
    """
    match = F.struct("pos", "width", "phrase", "entity_class")
    texts = found.groupBy("row").agg(F.first("id").alias("id"), F.sort_array(F.collect_list(match)).alias("m"))
    runs = F.transform(F.sequence(F.lit(0), F.expr(f"cast((size(m) - 1) div {RUN} as int)")), lambda k: F.slice("m", k * RUN + 1, F.lit(RUN)))
    none = F.slice("m", 1, 0)

    def step(state: Column, m: Column) -> Column:
        kept = F.struct((m["pos"] + m["width"]).alias("end"), F.concat(state["kept"], F.array(m)).alias("kept"))
        return F.when(m["pos"] >= state["end"], kept).otherwise(state)

    def through(state: Column, run: Column) -> Column:
        return F.aggregate(run, F.struct(state["end"].alias("end"), none.alias("kept")), step, lambda s: F.struct(
            s["end"].alias("end"), F.concat(state["kept"], F.array(s["kept"])).alias("kept")))

    begin = F.struct(F.lit(0).alias("end"), F.slice(F.array("m"), 1, 0).alias("kept"))
    kept = F.flatten(F.aggregate(runs, begin, through, lambda s: s["kept"]))
    return texts.select("id", F.explode(kept).alias("k")).select("id", "k.*")


def tag_phrases(docs: DataFrame, phrases: DataFrame, *, id_col: str = "id", text_col: str = "text",
                max_broadcast_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """(id, pos, width, phrase, entity_class) of every phrase in every document, by words from 0.

    ``phrases`` holds ``phrase`` and ``entity_class``. The trie is broadcast if
    its summed bytes fit ``max_broadcast_bytes``; beyond that each level's join
    shuffles. Null texts have no phrases; repeated documents are each tagged.
    """
    spark = docs.sparkSession
    path = shared_dir(spark, "phrase-words")
    docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), tokenize(text_col).alias("words")).write.parquet(path)
    words = spark.read.parquet(path)
    trie_path = shared_dir(spark, "phrase-trie")
    phrase_trie(phrases).write.parquet(trie_path)
    trie = spark.read.parquet(trie_path)
    size, longest = trie.agg(F.sum(F.octet_length("prefix") + ROW_OVERHEAD_BYTES), F.max("depth")).first()
    small, longest = (size or 0) <= max_broadcast_bytes, longest or 1
    # word k of a candidate is the list of words without its first k - 1, at the same place
    ahead = F.arrays_zip(*[F.slice("words", k, F.size("words")).alias(f"w{k}") for k in range(1, longest + 1)])
    at = words.where("size(words) > 0").select("row", "id", F.posexplode(ahead).alias("pos", "w")).select(
        "row", "id", "pos", "w", F.lit(0).alias("width"), F.lit(None).cast("string").alias("phrase"),
        F.lit(None).cast("string").alias("entity_class"), F.lit(True).alias("more"))
    for depth in range(1, longest + 1):
        at = _down(at, trie, depth, small)
    return _resolved(at.where("width > 0")).select(F.col("id").alias(id_col), F.col("pos").cast("long").alias("pos"),
                                                   F.col("width").cast("long").alias("width"), "phrase", "entity_class")
