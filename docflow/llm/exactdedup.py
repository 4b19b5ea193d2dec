"""Exact duplicates: a tree of merges over sorted runs of digests.

Every input partition makes one run: its distinct digests, each with the row
that stays so far and a row count. Rounds then merge the runs that agree in
all but their last digit (base ``fan_in``), until one run holds every distinct
digest once. An entry leads with a 64-bit digest, by which runs are sorted and
dealt, and is merged only with entries that are verified equal: the same
SHA-256 and the same length. The way back goes from the last run to the first
ones and from there to the rows, so a text that a third of all rows share is
one entry per run in every step, and in the last one a run's rows of it.

All steps are DataFrame operations; a round shuffles distinct digests (about
60 bytes each), never texts.

Defined results
- null text: an empty text; all empty texts are equal;
- null id: lower than any other, so it stays only among rows without an id
  (``keep_id`` is then null);
- repeated rows (equal id and text): both count, exactly one is ``kept``;
- very long texts: only their digest leaves the row;
- empty table: no rows; a run without rows does not exist;
- other columns of any name are not read, and none of them is returned.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import staged

#: Runs merged into one in a round.
FAN_IN = 16

ENTRY = ["short", "sha", "length"]


def _runs(docs: DataFrame, id_col: str, text_col: str, normalise: Callable[[Column], Column] | None) -> DataFrame:
    """Rows (id, row, run, digest entry), the run being the input partition: written, so that it stays as it is."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    text = (normalise(text) if normalise else text).cast("binary")
    rows = docs.select(
        F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.spark_partition_id().alias("run"),
        F.xxhash64(text).alias("short"), F.unhex(F.sha2(text, 256)).alias("sha"), F.octet_length(text).alias("length"))
    return staged(rows, "digest-rows")


def merge_rounds(runs: DataFrame, pick: Callable[[str], Column] = F.max, fan_in: int = FAN_IN) -> DataFrame:
    """All runs (run, entry, best, n) merged into run 0, ``fan_in`` of them into one in every round."""
    last = runs.agg(F.max("run")).first()[0] or 0
    while last > 0:
        runs = (runs.groupBy(F.floor(F.col("run") / fan_in).cast("int").alias("run"), *ENTRY)
                .agg(pick("best").alias("best"), F.sum("n").alias("n")))
        last //= fan_in
    return runs


def exact_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", largest: bool = True,
                     normalise: Callable[[Column], Column] | None = None, fan_in: int = FAN_IN) -> DataFrame:
    """One row per document: (id, keep_id, group_size, kept, text_sha256).

    Of equal texts the row with the largest id stays (``largest=False``: the
    smallest), among repeated rows the first one. ``normalise`` maps the text
    before it is compared; texts are compared as they are without it.
    """
    if fan_in < 2:
        raise ValueError("fan_in must be 2 or more")
    rows = _runs(docs, id_col, text_col, normalise)
    if largest:
        pick, rank = F.max, F.struct(F.col("id").isNotNull().alias("a"), "id", (-F.col("row")).alias("b"))
    else:
        pick, rank = F.min, F.struct(F.col("id").isNull().alias("a"), "id", F.col("row").alias("b"))
    first = (rows.groupBy("run", *ENTRY).agg(pick(rank).alias("best"), F.count(F.lit(1)).alias("n"))
             .sortWithinPartitions("run", *ENTRY))
    first = staged(first, "digest-runs")
    groups = merge_rounds(first, pick, fan_in).where("n > 1").select(*ENTRY, "best", "n")
    # an entry is in a run once, so a text has at most as many rows here as there are runs
    shared = first.select("run", *ENTRY).join(groups, ENTRY)
    joined = rows.join(shared, ["run", *ENTRY], "left")
    alone = F.col("n").isNull()
    return joined.select(
        F.col("id").alias(id_col),
        F.when(alone, F.col("id")).otherwise(F.col("best.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.abs("best.b") == F.col("row"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))
