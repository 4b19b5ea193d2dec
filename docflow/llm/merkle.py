"""Merkle manifest of a table: a content-addressed graph of digests, and proofs by descending it.

Each row is a leaf, the SHA-256 of its fields. Per group (``source``) leaves
ascend by id; every 16 consecutive digests become the digest of their
concatenation until one remains, the group's root. The groups' roots, ordered
by group, make the table's root alike.

The graph is stored as records digest -> children (their digests in one binary),
each once, whatever place it has in the tree. Digests are binary here and
lower-case hex text where they are hashed again or given out. A proof is found by descending it: the address of a leaf
is the digits (base 16) of its group's rank and of its own rank in the group;
every digit chooses one child, and the children not chosen are the siblings.
Requests that share leading digits go down as one until they part, so no
record is asked for twice at a place and the root is no hot key. The path is
gathered from the root and reversed at its end.

A level takes one shuffle of its digests by parent (16 rows a key at most) and
one join by digest in the descent, so a group with a third of all rows is as
evenly dealt as any; ranks come from a range partitioning. Texts are read
once, for the leaf digests, and never shuffled. The driver keeps the root and
the number of levels.

Defined results
- null fields: ``-`` in place of byte count and value; null groups are a group
  and come first; null ids come first in their group;
- equal ids in a group: ordered by leaf digest; repeated rows are leaves of
  their own with equal digests and each with its place's proof;
- empty and very long texts: hashed whole;
- one leaf: it is the group's root; one group: its root is the table's; the
  proof is then the digest of nothing;
- empty table: no leaves, no root (None), no proofs;
- other columns of any name are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import staged
from docflow.operators.numbering import ordinal_within

#: Children of a node, the bits of a rank that one digit stands for, and the bytes of a digest.
WIDTH, BITS, BYTES = 16, 4, 32

#: Bits of a rank that are cut off where rows meet their group's description: 256 rows a key.
CHUNK_BITS = 8

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def field_bytes(column: str | Column) -> Column:
    """``-`` for a null, else the byte count, a colon and the value."""
    value = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(columns: Sequence[str | Column]) -> Column:
    """The digest of one row."""
    return F.sha2(F.concat(*[field_bytes(c) for c in columns]).cast("binary"), 256)


def text_of(digest: str | Column) -> Column:
    """A binary digest (or several joined) as lower-case hex text."""
    return F.lower(F.hex(digest))


def _hash(digests: Column) -> Column:
    """The digest of joined digests, as they are when written as text."""
    return F.unhex(F.sha2(text_of(digests).cast("binary"), 256))


@dataclass
class Manifest:
    """``records`` (digest, children), ``groups`` (grp, address, subroot, n), ``leaves`` (grp, address, leaf,
    subroot, and the columns carried as ``row``), all digests binary, and the root as hex text (None: no rows)."""

    records: DataFrame
    groups: DataFrame
    leaves: DataFrame
    root: str | None


def _roots(nodes: DataFrame, records: list[DataFrame]) -> DataFrame:
    """The root (tree, digest) of every tree of ``nodes`` (tree, idx, digest); inner nodes go to ``records``."""
    roots = []
    while True:
        in_order = F.sort_array(F.collect_list(F.struct(F.col("idx").alias("i"), "digest")))
        joined = F.array_join(F.transform(in_order, lambda n: F.hex(n["digest"])), "")
        runs = nodes.groupBy("tree", F.shiftright("idx", BITS).alias("idx")).agg(F.unhex(joined).alias("children"))
        runs = staged(runs.withColumn("digest", _hash(F.col("children"))), "merkle-level")
        alone = (F.col("idx") == 0) & (F.octet_length("children") == BYTES)      # the only node of its tree
        roots.append(runs.where(alone).select("tree", F.col("children").alias("digest")))
        nodes = runs.where(~alone)
        if nodes.isEmpty():
            return reduce(DataFrame.unionByName, roots)
        records.append(nodes.select("digest", "children"))


def _digits(rank: str, count: str | int) -> Column:
    """The digits of a rank, as many as the last of ``count`` ranks has (none if there is one only)."""
    n = F.col(count) if isinstance(count, str) else F.lit(count)
    return F.when(n > 1, F.lpad(F.lower(F.hex(rank)), F.length(F.hex(n - 1)), F.lit("0"))).otherwise("")


def _chunks(groups: DataFrame) -> DataFrame:
    """One row per group and chunk of its ranks, so that a large group's rows meet it under many keys."""
    last = F.shiftright(F.col("n") - 1, CHUNK_BITS)
    spans = groups.withColumn("span", F.explode(F.sequence(F.lit(0), F.shiftright(last, 12).cast("int"))))
    inside = F.explode(F.sequence(F.lit(0), F.least(F.lit(4095), last - F.col("span").cast("long") * 4096).cast("int")))
    return spans.withColumn("inside", inside).select(
        F.col("grp").alias("their_grp"), (F.col("span").cast("long") * 4096 + F.col("inside")).alias("chunk"),
        "n", "subroot", F.col("address").alias("above"))


def build(leaves: DataFrame, *, group_col: str = "source", id_col: str = "doc_id", leaf_col: str = "leaf") -> Manifest:
    """The manifest of ``leaves``, one row each with its group, id and digest (hex text).

    The id and the other columns are carried as ``row``.
    """
    given = leaves.select(F.col(group_col).alias("grp"),
                          F.struct(F.col(id_col).alias("id"), F.unhex(leaf_col).alias("leaf")).alias("place"),
                          F.struct(*[c for c in leaves.columns if c not in (group_col, leaf_col)]).alias("row"))
    ranked = ordinal_within(given, ["grp"], "place", "rank")
    ranked = staged(ranked.select("grp", (F.col("rank") - 1).cast("long").alias("rank"),
                                  F.col("place.leaf").alias("leaf"), "row"), "merkle-ranked")
    records: list[DataFrame] = []
    roots = _roots(ranked.select(F.col("grp").alias("tree"), F.col("rank").alias("idx"), F.col("leaf").alias("digest")), records)
    sizes = ranked.groupBy("grp").agg((F.max("rank") + 1).alias("n"))
    of_group = sizes.join(roots, F.col("grp").eqNullSafe(F.col("tree"))).select(
        "grp", "n", F.col("digest").alias("subroot"), F.lit(0).alias("all"))
    groups = staged(ordinal_within(of_group, ["all"], "grp", "place").select(
        "grp", "n", "subroot", (F.col("place") - 1).cast("long").alias("place")), "merkle-groups")
    tops = _roots(groups.select(F.lit(0).alias("tree"), F.col("place").alias("idx"), F.col("subroot").alias("digest")), records)
    top = tops.select("digest").first()
    groups = groups.select("grp", "n", "subroot", _digits("place", groups.count()).alias("address"))
    here = ranked.withColumn("at", F.shiftright("rank", CHUNK_BITS)).join(
        _chunks(groups), F.col("grp").eqNullSafe(F.col("their_grp")) & (F.col("at") == F.col("chunk")))
    addressed = here.select("grp", F.concat("above", _digits("rank", "n")).alias("address"), "leaf", "subroot", "row")
    none = leaves.sparkSession.createDataFrame([], "digest binary, children binary")
    stored = reduce(DataFrame.unionByName, records, none).dropDuplicates(["digest"])
    return Manifest(staged(stored, "merkle-records"), groups, staged(addressed, "merkle-leaves"), bytes(top[0]).hex() if top else None)


def _child(children: str, own: Column) -> Column:
    return F.col(children).substr(own * BYTES + 1, F.lit(BYTES))


def _siblings(children: str, own: Column) -> Column:
    """The digests before and behind the child ``own`` (from 0), joined."""
    return F.struct(F.col(children).substr(F.lit(1), own * BYTES).alias("before"),
                    F.col(children).substr((own + 1) * BYTES + 1, F.lit(WIDTH * BYTES)).alias("after"))


def prove(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """``requests`` (rows of ``manifest.leaves``; all of them if None) with ``path``: siblings, from the leaf to the root.

    Each entry of ``path`` holds the joined digests before and behind the node on the way.
    """
    asked = manifest.leaves if requests is None else requests
    prefixes = None
    if requests is not None:
        lengths = F.explode(F.sequence(F.lit(0), F.length("address")))
        prefixes = staged(asked.select("address", lengths.alias("k")).select(
            F.expr("left(address, k)").alias("wanted")).distinct(), "merkle-wanted")
    empty = F.array().cast("array<struct<before:binary,after:binary>>")
    found = [asked.where("address = ''").withColumn("path", empty)]
    deepest = asked.agg(F.max(F.length("address"))).first()[0] or 0
    nodes = manifest.records.where(F.col("digest") == F.unhex(F.lit(manifest.root))).select(
        F.lit("").alias("prefix"), "children", empty.alias("down"))
    for depth in range(deepest):
        nodes = staged(nodes, "merkle-descent")
        own = F.conv(F.right("address", F.lit(1)), 16, 10).cast("int")
        here = asked.where(F.length("address") == depth + 1).join(nodes, F.expr(f"left(address, {depth})") == F.col("prefix"))
        path = F.reverse(F.concat("down", F.array(_siblings("children", own))))
        found.append(here.select(*asked.columns, path.alias("path")))
        digits = F.sequence(F.lit(0), (F.octet_length("children") / BYTES).cast("int") - 1)
        step = nodes.select("*", F.explode(digits).alias("digit")).select(
            F.concat("prefix", F.lower(F.hex(F.col("digit").cast("long")))).alias("prefix"),
            _child("children", F.col("digit")).alias("child"),
            F.concat("down", F.array(_siblings("children", F.col("digit")))).alias("down"))
        if prefixes is not None:
            step = step.join(prefixes, F.col("prefix") == F.col("wanted"), "left_semi")
        nodes = step.join(manifest.records, F.col("child") == F.col("digest")).select("prefix", "children", "down")
    return reduce(DataFrame.unionByName, found)


def folded(leaf: Column, path: str = "path") -> Column:
    """The root that follows from a leaf digest (hex text) and its path."""
    return F.aggregate(path, leaf, lambda at, s: F.sha2(
        F.concat(text_of(s["before"]), at, text_of(s["after"])).cast("binary"), 256))


def proof_digest(path: str = "path") -> Column:
    """The digest of all siblings, level by level from the leaf to the root, each level from left to right."""
    siblings = F.transform(path, lambda s: text_of(F.concat(s["before"], s["after"])))
    return F.sha2(F.array_join(siblings, "").cast("binary"), 256)
