"""WARC archives: writing pages as records and reading them back by boundary chains.

Writing: one record per row; payloads of at least ``min_bytes`` that occur more
than once are stored once, by the row with the largest id, and the others
become revisit records without a payload. Spark's text writer commits the
files, so lost executors leave no half archive.

Reading: an archive is read in splits, at every line ``WARC/1.0``. Each such
place is a candidate record; its header gives the candidate's successor. Only
candidates that are reached from the start of their file by following
successors are records, so the same line inside a payload starts none. The
chain is followed by pointer jumping: reached sets and pointers double in
every round, and all candidates of a file never meet in one task.

Defined results: a null payload is an empty one; a null id is smaller than any
other; equal ids with equal payloads are all stored; line breaks in a URL are
percent-encoded in its header; headers may have any length; an empty table gives
an empty archive; a file whose chain ends before its last byte is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docflow.llm.common import small_side, staged

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def _payloads(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    body = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    return (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), body.alias("body"))
            .withColumn("digest", F.sha1("body")).withColumn("bytes", F.octet_length("body").cast("long")))


def _originals(rows: DataFrame, min_bytes: int) -> DataFrame:
    """(digest, refers_to) of the payloads that are stored once and referred to by others."""
    return (rows.where(F.col("bytes") >= min_bytes).groupBy("digest")
            .agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least"),
                 F.count("*").alias("n"), F.count("page_id").alias("with_id"))
            .where((F.col("refers_to") > F.col("least")) | ((F.col("with_id") > 0) & (F.col("with_id") < F.col("n"))))
            .select("digest", "refers_to"))


def _header(name: str, value: Column) -> Column:
    return F.when(value.isNull(), "").otherwise(F.concat(F.lit(name + ": "), value.cast("string"), F.lit("\r\n")))


def _record_id(page_id: Column) -> Column:
    """The record id (as a UUID) of a payload that others refer to, from its page's id and digest."""
    name = F.md5(F.concat_ws(":", page_id.cast("string"), F.col("digest")).cast("binary"))
    return F.concat_ws("-", *[F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
               payload_col: str = "html", min_bytes: int = 1000) -> None:
    """Write a record for every row of ``pages`` into archive files under ``path``."""
    rows = _payloads(pages, id_col, url_col, payload_col)
    originals = staged(_originals(rows, min_bytes), "originals")
    # ids and digests meet the originals; bodies then meet one row of their page and digest, so a payload
    # that many pages share is no hot key, and they only move if the table of copies is too large to send
    copies = rows.select("page_id", "digest").join(small_side(originals), "digest").distinct()
    copies = small_side(staged(copies.select(F.col("page_id").alias("copy_id"), F.col("digest").alias("copy_digest"), "refers_to"), "copies"))
    marked = rows.join(copies, F.col("page_id").eqNullSafe(F.col("copy_id")) & (F.col("digest") == F.col("copy_digest")), "left")
    revisit = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    body = F.when(revisit, F.lit(b"")).otherwise(F.col("body"))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    record = F.concat(
        F.lit(MAGIC), F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit("\r\n"),
        F.lit("WARC-Record-ID: <urn:uuid:"),
        F.when(F.col("refers_to").isNotNull() & ~revisit, _record_id(F.col("page_id"))).otherwise(F.uuid()), F.lit(">\r\n"),
        F.lit("WARC-Date: "), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("\r\n"),
        F.when(revisit, f"WARC-Profile: {PROFILE}\r\n").otherwise(""),
        _header("WARC-Target-URI", url), _header("X-Page-ID", F.col("page_id")),
        F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"), F.lit("\r\n"),
        _header("X-Payload-Length", F.col("bytes")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:uuid:"), _record_id(F.col("refers_to")), F.lit(">\r\n"))).otherwise(""),
        _header("X-Refers-To-Page-ID", F.when(revisit, F.col("refers_to"))),
        F.lit("Content-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit(END))
    # cast(binary as string) keeps the bytes as they are, valid UTF-8 or not
    marked.select(F.concat(record, body.cast("string")).alias("value")).write.option("lineSep", END).text(path)


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """The stretches between magic lines: file, split, order within the split, bytes."""
    return (spark.read.option("lineSep", MAGIC).option("recursiveFileLookup", "true").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                    F.monotonically_increasing_id().alias("place"), F.col("value").cast("binary").alias("segment"),
                    F.octet_length("value").cast("long").alias("length")))


def _placed(segments: DataFrame, *carried: str) -> DataFrame:
    """Segments with ``offset``, where their magic line starts in the file (-10: no magic before it).

    Lengths are added up within each split, and the splits' totals along the
    file, so no task holds more than a split's rows.
    """
    width = len(MAGIC)
    inside = W.partitionBy("file", "split").orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    totals = segments.groupBy("file", "split").agg(F.sum(F.col("length") + width).alias("total"))
    along = W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    bases = totals.select("file", "split", F.coalesce(F.sum("total").over(along), F.lit(0)).alias("base"))
    return (segments.withColumn("within", F.coalesce(F.sum(F.col("length") + width).over(inside), F.lit(0)))
            .join(bases, ["file", "split"])
            .select("file", "split", (F.col("base") + F.col("within") - width).alias("offset"), "length", *carried))


def _field(name: str, value: str = r"[^\r\n]*") -> Column:
    """A header field's value from column ``head`` (null if it is not there or not of that form)."""
    found = F.regexp_extract("head", rf"(?i)(?:^|\r\n){name}:[ \t]*({value})[ \t]*(?:\r\n|$)", 1)
    return F.nullif(found, F.lit(""))


def _number(name: str) -> Column:
    return _field(name, "-?[0-9]{1,19}").try_cast("long")


def _candidates(segments: DataFrame) -> DataFrame:
    """Every segment with what its header says; ``sha1`` of the payload where it holds its whole record."""
    start = F.col("segment").cast("string")
    cut = F.instr(start, END)
    rows = (segments.withColumn("head", F.when(cut > 0, F.substring(start, F.lit(1), cut - 1)))
            .withColumn("head_bytes", F.octet_length("head").cast("long")))
    rows = rows.withColumn("content", F.when(_number("Content-Length") >= 0, _number("Content-Length")))
    rows = rows.withColumn("head", F.when(F.col("content").isNotNull(), F.col("head")))    # else it is no header
    whole = F.col("head_bytes") + 2 * len(END) + F.col("content") == F.col("length")
    body = F.expr(f"substring(segment, CAST(head_bytes AS INT) + {len(END) + 1}, CAST(content AS INT))")
    return (rows.withColumn("whole", F.coalesce(whole, F.lit(False)))
            .withColumn("sha1", F.when(F.col("whole"), F.sha1(body))))


def reached(nodes: DataFrame) -> DataFrame:
    """The (file, offset) that chains of ``next`` reach from offset 0 of each file, by pointer jumping.

    ``nodes`` has (file, offset, next); a pointer that meets no node ends its
    chain there. Rounds grow with the logarithm of the longest chain.
    """
    state = staged(nodes.select("file", "offset", "next", (F.col("offset") == 0).alias("on")), "chain")
    while True:
        ahead = state.select("file", F.col("offset").alias("next"), F.col("next").alias("after"))
        marks = state.where("on AND next IS NOT NULL").select("file", F.col("next").alias("offset"),
                                                              F.lit(True).alias("marked"))
        after = staged(
            state.join(ahead, ["file", "next"], "left").join(marks, ["file", "offset"], "left")
            .select("file", "offset", F.col("after").alias("next"),
                    (F.col("on") | F.coalesce("marked", F.lit(False))).alias("on"),
                    (F.col("on") | F.col("marked").isNull()).alias("same")), "chain")
        if after.where("NOT same").isEmpty():
            return after.where("on").select("file", "offset")
        state = after.select("file", "offset", "next", "on")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records under ``path``: file, offset, record_type, page_id, url, payload_bytes, payload_digest, refers_to.

    The digest of a stored payload is taken from the bytes that are read; for
    a revisit, length and digest are those its header names. A record whose
    payload holds the magic line is put together from its segments.
    """
    # Spark reads every file whose name and folders are not hidden, whatever the archives are called
    if not spark.read.schema("value string").option("recursiveFileLookup", "true").text(path).inputFiles():
        return spark.createDataFrame([], "file string, offset long, record_type string, page_id long, url string, "
                                         "payload_bytes long, payload_digest string, refers_to long")
    heads = ["head", "head_bytes", "content", "whole", "sha1"]
    found = staged(_placed(_candidates(_segments(spark, path)).drop("segment"), *heads).where("offset >= 0"),
                   "candidates")
    begin = F.col("offset") + len(MAGIC) + F.col("head_bytes") + len(END)
    behind = begin + F.col("content") + len(END)
    on = reached(found.select("file", "offset", behind.alias("next")))
    records = staged(found.join(on, ["file", "offset"]), "records")
    ends = found.groupBy("file").agg(F.max(F.col("offset") + len(MAGIC) + F.col("length")).alias("end"))
    last = records.groupBy("file").agg(F.max(behind).alias("reached"))
    broken = ends.join(last, "file", "left").where(~F.col("reached").eqNullSafe(F.col("end"))).first()
    if broken is not None:
        raise ValueError(f"{broken.file}: records end at byte {broken.reached} of {broken.end}")
    parted = records.where("NOT whole AND content IS NOT NULL").select("file", "offset", "head_bytes", "content")
    if not parted.isEmpty():
        records = (records.join(_joined(spark, path, found, on, parted), ["file", "offset"], "left")
                   .withColumn("sha1", F.coalesce("sha1", "joined")))
    kind = F.lower(_field("WARC-Type"))
    revisit = kind == "revisit"
    return records.select(
        "file", "offset", kind.alias("record_type"), _number("X-Page-ID").alias("page_id"),
        _field("WARC-Target-URI").alias("url"),
        F.when(revisit, _number("X-Payload-Length")).otherwise(F.col("content")).alias("payload_bytes"),
        F.when(revisit, F.regexp_replace(_field("WARC-Payload-Digest"), "^sha1:", "")).otherwise(F.col("sha1"))
        .alias("payload_digest"),
        _number("X-Refers-To-Page-ID").alias("refers_to"))


def _joined(spark: SparkSession, path: str, found: DataFrame, on: DataFrame, parted: DataFrame) -> DataFrame:
    """(file, offset, joined): the payload digests of records that magic lines cut into segments.

    Each segment belongs to the last record that starts at or before it. Only
    files with such records are read again, and a record's segments meet.
    """
    files = parted.select("file").distinct()
    marked = (found.join(small_side(staged(files, "files")), "file", "left_semi")
              .join(on.withColumn("start", F.col("offset")), ["file", "offset"], "left"))
    behind = W.partitionBy("file", "split").orderBy("offset")
    along = W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    before = (marked.groupBy("file", "split").agg(F.max("start").alias("last"))
              .select("file", "split", F.max("last").over(along).alias("before")))
    owned = (marked.withColumn("owner", F.last("start", ignorenulls=True).over(behind))
             .join(before, ["file", "split"])
             .select("file", "offset", F.coalesce("owner", "before").alias("owner"))
             .join(parted.withColumnRenamed("offset", "owner"), ["file", "owner"]))
    again = _placed(_segments(spark, path).join(small_side(staged(files, "files")), "file", "left_semi"), "segment")
    pieces = again.select("file", "offset", "segment").join(owned, ["file", "offset"])
    stretch = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("offset", F.col("segment").cast("string")
                                                                            .alias("part")))),
                                       lambda x: x["part"]), MAGIC).cast("binary")
    whole = (pieces.groupBy("file", "owner", "head_bytes", "content").agg(stretch.alias("stretch")))
    body = F.expr(f"substring(stretch, CAST(head_bytes AS INT) + {len(END) + 1}, CAST(content AS INT))")
    return whole.select("file", F.col("owner").alias("offset"),
                        F.when(F.octet_length(body) == F.col("content"), F.sha1(body)).alias("joined"))
