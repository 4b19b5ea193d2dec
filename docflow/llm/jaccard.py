"""Exact n-gram Jaccard self-join: size-banded tiles, bitmap bounds, sorted-array intersection.

A document is the set of its distinct 5-word shingles; two documents link when
their Jaccard similarity reaches the threshold. Equal sets are one node. Nodes
are dealt into tiles: sizes fall into bands, and inside a band the hash space
is cut into so many parts that two linked sets, whose symmetric difference the
band's largest size bounds, agree in at least one whole part (pigeonhole). A
tile holds the nodes of a band with the same content in a part. As at most so
many parts of linked sets differ, the others agree: a node that shares fewer
parts with anybody links with nobody and leaves, and of a node's tiles only the
smallest are kept that a linked node must share one of. Inside tiles, pairs are
bounded from above by bitmaps (bits that differ count elements that differ),
and the survivors are compared by intersecting their sorted arrays.

Only the links needed to join a component are verified: members of a tile are
first compared with a few salted leaders (linear in the tile), and only
members that are still in different components afterwards meet pair by pair,
in blocks, so a large tile is never one task and no link between components is
lost.

Defined results: a text without words (null, empty) has no shingles and links
with nothing; a text of fewer than five words has its whole sequence as the one
shingle; repeated rows and equal texts are one node; a null id gives way to the
other ids of its component. Sets and shingles are identified by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docflow.llm.common import (SPACE_TABLE, mix, ready, small_side, spread_join, staged, steps, text_buffer, text_hash,
                                word_hashes)
from docflow.llm.graph import components

#: A node's bitmap has the least power of two of bits that is so many times its size or more.
BITS_PER_ITEM, LEAST_BITS = 8, 256
#: Times that nodes without enough shared parts leave, which makes other tiles smaller.
NARROWINGS = 2
#: Members of a tile that meet pair by pair at once in the last stage, and bitmap bytes of the bins that tiles share.
BLOCK, BIN_BYTES = 2048, 1 << 23
#: Rounds of comparisons with a tile's salted leader, and the size beyond which a
#: tile still open after the first one takes part in the others before its pairs meet.
LEADER_ROUNDS, FEW = 3, 64

_STEP = np.uint64(0x9FB21C651E98DF25)
_U = np.uint64


@dataclass(frozen=True)
class Rule:
    """Shingle width and the threshold as an integer ratio (80 / 100 for 0.8)."""

    words: int = 5
    part: int = 80
    whole: int = 100

    def links(self, overlap: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.whole * overlap >= self.part * (a + b - overlap)

    def difference(self, total: int) -> int:
        """The largest symmetric difference of two linked sets whose sizes add up to ``total``."""
        return total * (self.whole - self.part) // (self.whole + self.part)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, words: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """All texts' sorted distinct shingle hashes, one text after the other, and each text's count."""
    hashes, rows = word_hashes(raw, offsets, SPACE_TABLE)
    n = len(offsets) - 1
    counts = np.bincount(rows, minlength=n)
    ends = np.cumsum(counts)
    window = hashes.copy()
    for k in range(1, words):
        window[:len(window) - k] = window[:len(window) - k] * _STEP + hashes[k:]
    window = mix(window)
    full = np.arange(len(hashes)) + words <= ends[rows] if len(hashes) else np.zeros(0, bool)
    short = np.flatnonzero((counts > 0) & (counts < words))
    parts, sizes = [], np.zeros(n, np.int64)
    whole: dict[int, np.ndarray] = {}
    for r in short:
        h = _U(int(counts[r]))
        for w in hashes[ends[r] - counts[r]:ends[r]]:
            h = mix(np.array([h]) * _STEP + w)[0]
        whole[int(r)] = np.array([h], np.uint64)
    kept = window[full]
    shingles = np.maximum(counts - words + 1, 0)
    stops = np.cumsum(shingles)
    for r in np.flatnonzero(counts):
        own = whole.get(int(r))
        if own is None:
            own = np.sort(kept[stops[r] - shingles[r]:stops[r]])
            own = own[np.append(True, own[1:] != own[:-1])]
        parts.append(own)
        sizes[r] = len(own)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), sizes


def bitmaps(values: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """A parity bitmap for each set: every element flips the bit that it hashes to.

    Halving a longer bitmap by exclusive or gives the bitmap of half the bits,
    so bitmaps of different lengths compare.
    """
    bits = np.maximum(LEAST_BITS, 1 << np.ceil(np.log2(np.maximum(BITS_PER_ITEM * sizes, 1))).astype(np.int64))
    ends = np.cumsum(bits)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    bit = (values & (bits[rows] - 1).astype(np.uint64)).astype(np.int64) + (ends - bits)[rows]
    flips = np.bincount(bit, minlength=int(ends[-1]) if len(ends) else 0) & 1
    packed = np.packbits(flips.astype(np.uint8), bitorder="little").tobytes()
    return [packed[(e - n) // 8:e // 8] for e, n in zip(ends.tolist(), bits.tolist())]


class Bitmaps:
    """Bitmaps of many sets, as matrices by length: as they are, and folded to half their bits."""

    def __init__(self, maps: list[bytes], sizes: np.ndarray):
        self.sizes = sizes
        self.words = np.array([len(m) // 8 for m in maps], np.int64)
        self.place = np.zeros(len(maps), np.int64)
        self.own: dict[int, np.ndarray] = {}
        self.half: dict[int, np.ndarray] = {}
        for n in np.unique(self.words).tolist():
            of = np.flatnonzero(self.words == n)
            self.place[of] = np.arange(len(of))
            self.own[n] = np.frombuffer(b"".join(maps[k] for k in of.tolist()), np.uint64).reshape(len(of), n)
            self.half[n] = self.own[n][:, :n // 2] ^ self.own[n][:, n // 2:]

    def bounds(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """An upper bound of the overlap of the sets ``i[k]`` and ``j[k]``, for every k.

        Every bit that differs counts an element that is in one set only, so
        the overlap is at most (sizes - differing bits) / 2, and at most the
        smaller size. (Lengths further apart than a factor of two are not
        compared: such sizes never link.)
        """
        bound = np.minimum(self.sizes[i], self.sizes[j])
        swap = self.words[i] > self.words[j]
        a, b = np.where(swap, j, i), np.where(swap, i, j)           # a has the shorter bitmap
        for n in self.own:
            for wide in (n, 2 * n):
                of = np.flatnonzero((self.words[a] == n) & (self.words[b] == wide))
                other = self.own[n] if wide == n else self.half.get(wide)
                step = max(1, (1 << 20) // n)                       # 8 MB at a time
                for at in range(0, len(of), step):
                    k = of[at:at + step]
                    apart = self.own[n][self.place[a[k]]] ^ other[self.place[b[k]]]
                    apart = np.bitwise_count(apart).sum(axis=1).astype(np.int64)
                    bound[k] = np.minimum(bound[k], (self.sizes[a[k]] + self.sizes[b[k]] - apart) // 2)
        return bound


def nodes_of(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit id of each set (0 for an empty one), the same for equal sets."""
    out = np.zeros(len(sizes), np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        starts = (np.cumsum(sizes) - sizes)[some]
        out[some] = mix(np.add.reduceat(mix(values + _STEP), starts) + sizes[some].astype(np.uint64))
    return out


@dataclass(frozen=True)
class Band:
    """A range of set sizes, the parts that its hash space is cut into, and the parts that may differ."""

    low: int
    high: int
    parts: int
    differing: int


def bands(rule: Rule, largest: int) -> list[Band]:
    """Size bands (ratio 1.5) up to ``largest``; linked sizes are in the same band or neighbours."""
    out, low = [], 1
    while low <= largest:
        high = max(low, math.ceil(low * 1.5) - 1)
        differing = rule.difference(2 * high)
        out.append(Band(low, high, math.ceil(1.5 * (differing + 1)), differing))
        low = high + 1
    return out


@dataclass(frozen=True)
class Places:
    """Where sets belong: (row, band, key) of every tile, and what each set needs in its two bands."""

    rows: np.ndarray
    level: np.ndarray
    keys: np.ndarray
    own: np.ndarray                                         # each set's own band
    need: np.ndarray                                        # (2, sets): agreeing parts that a link takes; 0: no links


def places_of(rule: Rule, values: np.ndarray, sizes: np.ndarray) -> Places:
    """The tiles of each set.

    A set enters its own band, and the next one if a linked set can be there.
    Content is only compared through parts that are not empty: of a set's
    filled parts all but the differing ones agree with a linked set. A set
    with no more filled parts than may differ draws again with the next salt
    (its earlier draws stay, for sets that were luckier at them).
    """
    plan = bands(rule, int(sizes.max()) if len(sizes) else 0)
    plan += bands(rule, plan[-1].high * 2)[len(plan):len(plan) + 1] if plan else []
    highs, lows, parts_of, differing = (np.array([getattr(b, f) for b in plan] or [0], np.int64)
                                        for f in ("high", "low", "parts", "differing"))
    own = np.searchsorted(highs, sizes) if plan else np.zeros(len(sizes), np.int64)
    starts = np.cumsum(sizes) - sizes
    out_rows, out_level, out_keys = [], [], []
    need = np.zeros((2, len(sizes)), np.int64)
    for up in (0, 1):
        level = np.minimum(own + up, max(len(plan) - 1, 0))
        live = (sizes > 0) & (differing[level] > 0)         # with none, only equal sets link
        if up:
            live &= rule.whole * sizes >= rule.part * lows[level]
        todo = np.flatnonzero(live)
        need[up, todo] = np.iinfo(np.int64).max
        salt = 0
        while len(todo):
            n = sizes[todo]
            at = np.repeat(starts[todo] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            rows = np.repeat(np.arange(len(todo)), n)
            drawn = values[at]
            if salt:
                drawn = mix(drawn + _U(salt) * _STEP)
                drawn = drawn[np.lexsort((drawn, rows))]
            parts = parts_of[level[todo]].astype(np.uint64)
            part = ((drawn >> _U(32)) * parts[rows]) >> _U(32)
            edge = np.ones(len(drawn), bool)
            edge[1:] = (part[1:] != part[:-1]) | (rows[1:] != rows[:-1])
            first = np.flatnonzero(edge)
            content = np.add.reduceat(mix(drawn), first)
            levels = level[todo][rows[first]]
            tag = (levels.astype(np.uint64) << _U(40)) + (_U(salt) << _U(32)) + part[first]
            out_rows.append(todo[rows[first]])
            out_level.append(levels)
            out_keys.append(mix(content + mix(tag + _STEP)))
            agreeing = np.bincount(rows[first], minlength=len(todo)) - differing[level[todo]]
            need[up, todo] = np.minimum(need[up, todo], np.maximum(agreeing, 1))
            todo = todo[agreeing < 1]
            salt += 1
    if not out_rows:
        none = np.zeros(0, np.int64)
        return Places(none, none, np.zeros(0, np.uint64), own, need)
    return Places(np.concatenate(out_rows), np.concatenate(out_level), np.concatenate(out_keys), own, need)


def _narrow(values: np.ndarray) -> bytes:
    """Small non-negative numbers in the fewest bytes each (the reader sees it from the length)."""
    top = int(values.max()) if len(values) else 0
    return values.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(t).max)).tobytes()


def _wide(data: bytes, n: int) -> np.ndarray:
    kind = {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.uint64}[len(data) // n]
    return np.frombuffer(data, kind).astype(np.uint64)


def document_nodes(docs: DataFrame, rule: Rule) -> DataFrame:
    """(doc_id, text_hash, n_shingles, node, band, need, need_up) of every row; a text without words has a null node.

    ``need`` is how many parts a link agrees in, in the node's own band and in
    the next one (0: the node has no links there).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_buffer(batch.column(1))
            for i, j in steps(offsets):
                base = offsets[i]
                values, sizes = shingle_sets(raw[base:offsets[j]], offsets[i:j + 1] - base, rule.words)
                where = places_of(rule, values, sizes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.array(sizes),
                     pa.array(nodes_of(values, sizes).view(np.int64), mask=sizes == 0), pa.array(where.own, pa.int32()),
                     pa.array(where.need[0], pa.int64()), pa.array(where.need[1], pa.int64())],
                    names=["doc_id", "text_hash", "n_shingles", "node", "band", "need", "need_up"])

    return docs.select(F.col("doc_id").cast("long"), "text", text_hash()).mapInArrow(
        run, "doc_id long, text_hash long, n_shingles long, node long, band int, need long, need_up long")


def tiles(docs: DataFrame, rule: Rule, buckets: int) -> DataFrame:
    """(tile, node, level, weight) of the tiles with two nodes or more.

    Tiles of equal members are one, of the weight of all of them. The keys of
    a batch travel packed: one row for each bucket of the key space, with four
    bytes of every key (its band among them) and the step from the node before.
    """
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_buffer(batch.column(0))
            for i, j in steps(offsets):
                base = offsets[i]
                values, sizes = shingle_sets(raw[base:offsets[j]], offsets[i:j + 1] - base, rule.words)
                nodes = nodes_of(values, sizes)
                where = places_of(rule, values, sizes)
                if not len(where.rows):
                    continue
                distinct, place = np.unique(nodes, return_inverse=True)
                bucket = ((where.keys & _U(0xFFFFFFFF)) * _U(buckets)) >> _U(32)
                place = place[where.rows]
                short = (((where.keys >> _U(38)) << _U(6)) | where.level.astype(np.uint64)).astype(np.uint32)
                order = np.lexsort((place, bucket))
                bucket, place, keys = bucket[order], place[order], short[order]
                cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
                out = {"bucket": [], "keys": [], "steps": [], "nodes": []}
                for a, b in zip(cuts[:-1], cuts[1:]):
                    used, slot = np.unique(place[a:b], return_inverse=True)
                    out["bucket"].append(int(bucket[a]))
                    out["keys"].append(keys[a:b].tobytes())
                    out["steps"].append(_narrow(slot[1:] - slot[:-1]))
                    out["nodes"].append(distinct[used].tobytes())
                yield pa.RecordBatch.from_pydict(
                    out, schema=pa.schema([("bucket", pa.int32()), ("keys", pa.binary()),
                                           ("steps", pa.binary()), ("nodes", pa.binary())]))

    def meet(group: pa.Table) -> pa.Table:
        keys, nodes = [], []
        for row in group.to_pylist():
            own = np.frombuffer(row["keys"], np.uint32)
            slot = np.zeros(len(own), np.int64)
            if len(own) > 1:
                slot[1:] = np.cumsum(_wide(row["steps"], len(own) - 1)).astype(np.int64)
            keys.append(own)
            nodes.append(np.frombuffer(row["nodes"], np.uint64)[slot])
        keys, nodes = np.concatenate(keys), np.concatenate(nodes)
        order = np.lexsort((nodes, keys))
        keys, nodes = keys[order], nodes[order]
        new = np.append(True, (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1]))
        keys, nodes = keys[new], nodes[new]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        n = np.diff(np.append(first, len(keys)))
        level = (keys[first] & np.uint32(63)).astype(np.uint64)
        tile = mix(np.add.reduceat(mix(nodes), first) + n.astype(np.uint64) + mix(level + _STEP))
        kept = np.flatnonzero(n > 1)
        _, once, weight = np.unique(tile[kept], return_index=True, return_counts=True)
        kept = kept[once]
        at = np.repeat(first[kept] - (np.cumsum(n[kept]) - n[kept]), n[kept]) + np.arange(n[kept].sum())
        return pa.table({"tile": pa.array(np.repeat(tile[kept], n[kept]).view(np.int64)),
                         "node": pa.array(nodes[at].view(np.int64)),
                         "level": pa.array(np.repeat(level[kept], n[kept]).astype(np.int32)),
                         "weight": pa.array(np.repeat(weight, n[kept]).astype(np.int64))})

    dealt = docs.select("text").mapInArrow(deal, "bucket int, keys binary, steps binary, nodes binary")
    met = dealt.groupBy("bucket").applyInArrow(meet, "tile long, node long, level int, weight long")
    return met.groupBy("tile", "node", "level").agg(F.sum("weight").alias("weight"))


def narrowed(members: DataFrame, needs: DataFrame) -> DataFrame:
    """The (tile, node) that links can go through.

    ``needs`` has (node, band, need, need_up). A node whose tiles of a band
    weigh less than it needs there has no link in that band. Of the others'
    tiles, in one order for all nodes (small tiles first), the last are left
    out whose weight falls short of the need: a link shares more than those.
    """
    rows = members.join(small_side(needs), "node").withColumn(
        "need", F.when(F.col("level") == F.col("band"), F.col("need")).otherwise(F.col("need_up"))).drop("band", "need_up")
    for _ in range(NARROWINGS):
        rows = rows.withColumn("sum", F.sum("weight").over(W.partitionBy("node", "level")))
        rows = rows.where((F.col("need") > 0) & (F.col("sum") >= F.col("need"))).drop("sum")
        rows = staged(_by_tile(rows.drop("size"), _larger(rows, 1)).withColumnRenamed("n", "size"), "narrowed")
    behind = W.partitionBy("node", "level").orderBy(F.desc("size"), F.desc("tile"))
    kept = (rows.withColumn("behind", F.sum("weight").over(behind.rowsBetween(W.unboundedPreceding, W.currentRow)))
            .where(F.col("behind") >= F.col("need")).select("tile", "node"))
    return _by_tile(kept, _larger(kept, 1), "left_semi")


def verified(pairs: DataFrame, texts: DataFrame, maps: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) of nodes that link: bitmap bound first, then the exact sets of the survivors."""
    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = np.concatenate([batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 3)])
            maps = batch.column(4).to_pylist() + batch.column(5).to_pylist()
            n = batch.num_rows
            bound = Bitmaps(maps, sizes).bounds(np.arange(n), np.arange(n) + n)
            yield batch.select([0, 1]).filter(pa.array(rule.links(bound, sizes[:n], sizes[n:])))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = np.zeros(batch.num_rows, bool)
            sides = [text_buffer(batch.column(k)) for k in (2, 3)]
            for i in range(batch.num_rows):
                (a, _), (b, _) = (shingle_sets(raw[o[i]:o[i + 1]], np.array([0, o[i + 1] - o[i]]), rule.words)
                                  for raw, o in sides)
                shared = len(np.intersect1d(a, b, assume_unique=True))
                same[i] = rule.links(shared, len(a), len(b))
            yield batch.select([0, 1]).filter(pa.array(same))

    def side(table: DataFrame, node: str, *columns: str) -> DataFrame:
        return table.select(F.col("node").alias(node), *(F.col(c).alias(f"{c}_{node}") for c in columns))

    near = (pairs.join(side(maps, "a", "n_shingles", "bitmap"), "a").join(side(maps, "b", "n_shingles", "bitmap"), "b")
            .select("a", "b", "n_shingles_a", "n_shingles_b", "bitmap_a", "bitmap_b")
            .mapInArrow(close, "a long, b long"))
    return (near.join(side(texts, "a", "text"), "a").join(side(texts, "b", "text"), "b")
            .select("a", "b", "text_a", "text_b").mapInArrow(exact, "a long, b long"))


def _open_tiles(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(tile, node, component) of the tiles whose members are in more than one component."""
    if labels is None:
        return members.withColumn("component", F.col("node"))
    known = (members.join(labels, "node", "left")
             .withColumn("component", F.coalesce("component", "node")).select("tile", "node", "component"))
    mixed = (known.groupBy("tile").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n"))
             .where("lo < hi").select("tile", "n"))
    return _by_tile(known, mixed, "left_semi")


def _larger(rows: DataFrame, n: int) -> DataFrame:
    """(tile, n) of the tiles with more than ``n`` members."""
    return rows.groupBy("tile").agg(F.count("*").alias("n")).where(F.col("n") > n)


def _by_tile(rows: DataFrame, tiles: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` joined by tile with ``tiles``, which has their counts ``n``; large tiles are spread by node."""
    return spread_join(rows, tiles, "tile", ["node"], how)


def _leader_pairs(rows: DataFrame, salt: int) -> DataFrame:
    """Every member with its tile's leader (the least by a salted hash), if their components differ."""
    leaders = (rows.groupBy("tile").agg(F.min(F.struct(F.xxhash64("node", F.lit(salt)).alias("h"), "node", "component"))
                                        .alias("leader"), F.count("*").alias("n")))
    return (_by_tile(rows, leaders).where("component != leader.component")
            .select(F.least("node", "leader.node").alias("a"), F.greatest("node", "leader.node").alias("b")).distinct())


def _block_pairs(rows: DataFrame, maps: DataFrame, rule: Rule) -> DataFrame:
    """The pairs of open tiles, of different components, that the bitmap bound lets through.

    Tiles are handled many at a time, in bins of bounded size. A tile of more
    than ``BLOCK`` members is cut into blocks and every pair of its blocks is
    handled on its own.
    """
    width = rows.join(maps.select("node", F.octet_length("bitmap").alias("width")), "node").agg(F.sum("width")).first()[0]
    bins = 1 + (width or 0) // BIN_BYTES
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    placed = (_by_tile(rows, _larger(rows, 0)).join(maps, "node")
              .select("tile", "node", "component", "n_shingles", "bitmap", blocks.alias("blocks"),
                      F.pmod(F.xxhash64("node"), blocks).cast("int").alias("mine"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("tile", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"),
                      "mine", "node", "component", "n_shingles", "bitmap"))
    lot = F.pmod(F.xxhash64("tile", "low", "high"), F.lit(bins))

    def pairs(group: pa.Table) -> pa.Table:
        low, high, mine, node, comp, size = (group[c].to_numpy() for c in (
            "low", "high", "mine", "node", "component", "n_shingles"))
        maps_ = group["bitmap"].to_pylist()
        _, part = np.unique(np.stack([group["tile"].to_numpy(), low, high]), axis=1, return_inverse=True)
        part = part.reshape(-1)
        order = np.lexsort((node, part))
        part, low, high, mine, node, comp, size = (x[order] for x in (part, low, high, mine, node, comp, size))
        maps_ = Bitmaps([maps_[k] for k in order], size)
        out = []
        at = np.arange(len(part))
        for apart in range(1, int(np.bincount(part).max()) if len(part) else 0):
            at = at[:np.searchsorted(at, len(part) - apart)]
            at = at[part[at] == part[at + apart]]
            if not len(at):
                break
            i, j = at, at + apart
            small, big = np.minimum(size[i], size[j]), np.maximum(size[i], size[j])
            fit = (comp[i] != comp[j]) & ((mine[i] != mine[j]) | (low[i] == high[i])) & rule.links(small, small, big)
            i, j = i[fit], j[fit]
            if len(i):
                fit = rule.links(maps_.bounds(i, j), size[i], size[j])
                out.append(np.stack([node[i[fit]], node[j[fit]]]))
        a, b = np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)
        return pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64())})

    return placed.groupBy(lot.alias("lot")).applyInArrow(pairs, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, rule: Rule = Rule(), buckets: int | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id that links reach, its own included.
    """
    return grouped(docs, rule, buckets).select("doc_id", "n_shingles", "component_id")


def grouped(docs: DataFrame, rule: Rule = Rule(), buckets: int | None = None) -> DataFrame:
    """``near_duplicates`` with (text_hash, component) besides, which name a row and its group also where ids do not.

    ``component`` is null for a text without words.
    ``buckets`` of the key space default to four for each shuffle partition.
    """
    spark = docs.sparkSession
    ready(spark)
    if buckets is None:
        buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = staged(document_nodes(docs, rule), "nodes")
    needs = staged(rows.where("need > 0 OR need_up > 0").select("node", "band", "need", "need_up").distinct(), "needs")
    members = staged(narrowed(staged(tiles(docs, rule, buckets), "dealt"), needs), "tiles")
    known = _known_nodes(docs, rows, members, rule)
    texts, maps = known.select("node", "text"), known.select("node", "n_shingles", "bitmap")

    links = staged(verified(_leader_pairs(_open_tiles(members, None), 0), texts, maps, rule), "links")
    labels = components(links)
    # A tile of two is settled by its leader pair; larger ones only while components differ in them.
    members = staged(_by_tile(members, _larger(members, 2), "left_semi"), "tiles")
    for salt in range(1, LEADER_ROUNDS + 1):
        still = staged(_open_tiles(members, labels), "open")
        large = _by_tile(still, _larger(still, FEW), "left_semi")
        last = salt == LEADER_ROUNDS or large.isEmpty()
        pairs = _block_pairs(still, maps, rule) if last else _leader_pairs(large, salt)
        found = staged(verified(pairs, texts, maps, rule), "links")
        if not found.isEmpty():
            links = links.union(found)
            labels = components(links)
        if last:
            break
    return _labelled(rows, labels)


def _known_nodes(docs: DataFrame, rows: DataFrame, members: DataFrame, rule: Rule) -> DataFrame:
    """Stage table (node, text, n_shingles, bitmap) of the nodes in tiles, read again from the documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_buffer(batch.column(0))
            for i, j in steps(offsets):
                base = offsets[i]
                values, sizes = shingle_sets(raw[base:offsets[j]], offsets[i:j + 1] - base, rule.words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes_of(values, sizes).view(np.int64)), batch.column(0).slice(i, j - i), pa.array(sizes),
                     pa.array(bitmaps(values, sizes), pa.binary())], names=["node", "text", "n_shingles", "bitmap"])

    wanted = small_side(staged(members.select("node").distinct(), "wanted"))
    first = rows.join(wanted, "node", "left_semi").groupBy("node").agg(F.min(F.struct("doc_id", "text_hash")).alias("wanted"))
    # A doc_id may be null or have several rows, so the text's own hash is asked for too.
    ids = small_side(staged(first.select(F.col("wanted.doc_id").alias("wanted"), F.col("wanted.text_hash").alias("hash")), "ids"))
    source = docs.select(F.col("doc_id").cast("long"), "text", text_hash().alias("text_hash"))
    picked = source.join(ids, F.col("doc_id").eqNullSafe(F.col("wanted")) & (F.col("text_hash") == F.col("hash")), "left_semi")
    named = picked.select("text").mapInArrow(run, "node long, text string, n_shingles long, bitmap binary")
    return staged(named.dropDuplicates(["node"]), "known")


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Each row with its component and the smallest doc_id of it."""
    nodes = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows"))
    if labels is not None:
        nodes = nodes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        least = nodes.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("n"))
        nodes = (spread_join(nodes, least, "component", ["node"])
                 .select("node", "component", "component_id", F.col("rows").alias("n")))
    else:
        nodes = nodes.select("node", F.col("node").alias("component"), F.col("least").alias("component_id"),
                             F.col("rows").alias("n"))
    out = ["doc_id", "text_hash", "n_shingles", "component", "component_id"]
    linked = spread_join(rows.where("node is not null"), nodes, "node", ["doc_id", "text_hash"]).select(*out)
    alone = rows.where("node is null").select("doc_id", "text_hash", "n_shingles", F.col("node").alias("component"),
                                              F.col("doc_id").alias("component_id"))
    return linked.unionAll(alone)
