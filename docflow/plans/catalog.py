"""The registered queries: one per operator key, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables of ``sf_dir`` whole; arrays are handed to
the comparer as sorted, space-joined text. ``docflow.plans.oracle`` holds the
equivalent SQL for each key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.functions.keys import with_natural_key
from docflow.functions.predicates import all_of, exists, match_all, range_, term
from docflow.functions.jsonrows import parse_json
from docflow.functions.urls import request_target, url_origin
from docflow.operators.counts import count_collection, count_new, new_rows_filter, newest, newest_mark
from docflow.operators.deliver import (DELIVERED, assign_host, batch_body, json_batches, meter_by_host, spread,
                                      write_batches_by_host)
from docflow.operators.enrich import (GazetteerTagger, entity_sets_of_docs, gazetteer, map_tagger,
                                     tag_entities, tokenize, tokens)
from docflow.operators.latest import latest_per_key
from docflow.operators.phrases import tag_phrases
from docflow.operators.sequence import class_counts, count_tables, decode, sentences, with_gazetteer_tags
from docflow.operators.upsert import atomic_add, upsert
from docflow.plans.delivery import batch_key, hand_over
from docflow.plans.enrichment import entity_rows, run_enrichment, run_enrichment_at
from docflow.plans.transfer import TAG_COL, run_transfer, tag_rows, transfer_delta
from docflow.session import shared_dir, table
from docflow.sinks.collection import (atomic_add_path, compact, fold_adds, read_bucketed, stored_newest, upsert_path,
                                       write_collection)
from docflow.sources.collection import flatten_arrays, read_collection, read_with_options, top_k
from docflow.sources.files import file_manifest, read_files
from docflow.streaming.transfer import dedupe_stream, file_stream, run_to_parquet, stream_transfer

# Fixed parameters of the checks (the oracle SQL uses the same values).
LO = dt.datetime(2024, 1, 15)            # the destination holds events up to here
AS_OF = dt.datetime(2024, 1, 25)         # "now" of a transfer run
OVERLAP_FROM = dt.datetime(2024, 1, 10)  # updates start before LO, so keys overlap
RUN_ID = "7d3f0b8e-5a41-4c2e-9f6d-0c1e2a3b4c5d"
OTHER_RUN_ID = "initial-load"
HOSTS = ["http://index-a.example:8764", "http://index-b.example:8764", "http://index-c.example:8764"]
PIPELINE = COLLECTION = PARSER = "docs"
JSON_BATCH_ROWS = 100
PAGE_FOLDERS = 4
GAZETTEER = [
    ("MIT", "ORGANIZATION"),
    ("Apache", "ORGANIZATION"),
    ("Orre", "PERSON"),
    ("Anon", "PERSON"),
    ("Eriner", "LOCATION"),
    ("The", "O"),
]
EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return table(spark, d, name)


def _events(spark, d):
    return _t(spark, d, "events")


def _ts_lit(v: dt.datetime):
    return F.lit(v.isoformat(sep=" ")).cast("timestamp_ntz")


def _destination(spark, d):
    """The destination of the transfer checks: events up to LO."""
    return _events(spark, d).filter(F.col("ts") <= _ts_lit(LO))


def _joined(col: str, sep: str = " "):
    return F.array_join(F.array_sort(F.col(col)), sep).alias(col)


# ---- scans, predicates, top-k -------------------------------------------------

def q_count_collection(spark, d):
    return count_collection(read_collection(spark, f"{d}/documents.parquet"))


def q_scan_project_filter_limit(spark, d):
    return read_collection(spark, f"{d}/documents.parquet", where="n_chars > 500",
                           fields="doc_id, lang", max_rows=10, order_by="doc_id")


def q_scan_options(spark, d):
    """The option map of the source jobs, an extra filter (fq) included."""
    return read_with_options(spark, f"{d}/documents.parquet",
                             {"query": "n_chars > 500", "solr.params": "fq=lang = 'de'", "fields": "doc_id, lang",
                              "splits_per_shard": "4"})


def q_splits_read(spark, d):
    """A scan in many splits beside one in the session's own; the session is left as it was."""
    many = read_collection(spark, f"{d}/lineitem.parquet", fields="l_orderkey, l_quantity", splits=16)
    orders = read_collection(spark, f"{d}/orders.parquet", fields="o_orderkey, o_orderstatus")
    return (many.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_orderstatus")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity")))


def q_field_exists(spark, d):
    docs = _t(spark, d, "documents").select("doc_id")
    joined = docs.join(_t(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    return joined.filter(exists("quality")).select("doc_id")


def q_range_half_open(spark, d):
    return _events(spark, d).filter(range_("ts", LO, AS_OF, dtype="timestamp_ntz")).select("event_id", "ts")


def q_range_unbounded(spark, d):
    return _events(spark, d).filter(range_("ts", None, AS_OF, dtype="timestamp_ntz")).select("event_id", "ts")


def q_term_match(spark, d):
    return _events(spark, d).filter(term("event_type", "purchase")).select("event_id", "user_id", "event_type")


def q_conjunctive_filter(spark, d):
    pred = all_of(term("event_type", "purchase"), range_("ts", LO, AS_OF, dtype="timestamp_ntz"))
    return _events(spark, d).filter(pred).select("event_id", "ts")


def q_top_k_newest(spark, d):
    return top_k(_events(spark, d), "ts", 10, fields=["event_id", "ts"], tiebreak=["event_id"])


def q_flatten_multivalued(spark, d):
    # Turns gathered into one multi-valued (array) field per conversation,
    # then flattened to text as the reader option does. The joined text is a
    # single field of the output row: a conversation's size bounds it.
    conv = _t(spark, d, "conversations")
    multi = conv.groupBy("conv_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]).alias("text"))
    return flatten_arrays(multi)


def q_flatten_lines(spark, d):
    # E3 as the source applied it, per row: a multi-valued field (here the
    # lines of each whole document) joined into one text. No grouping.
    docs = _t(spark, d, "documents").select("doc_id", F.split(F.col("text"), "\n", -1).alias("text"))
    return flatten_arrays(docs)


def q_file_manifest(spark, d):
    """Pages written as text into folders by page_id, then listed and read back as files."""
    path = shared_dir(spark, "page-files")
    pages = _t(spark, d, "pages").select((F.col("page_id") % PAGE_FOLDERS).alias("folder"),
                                         F.regexp_replace("html", "[\r\n]", " ").alias("value"))
    pages.write.partitionBy("folder").text(path)
    listed = file_manifest(spark, path, glob="part-*", recursive=True).select("path", "length")
    read = read_files(spark, path, glob="part-*", recursive=True).select("path", F.length("content").alias("bytes"))
    folder = F.regexp_extract("path", "folder=([0-9]+)", 1).cast("long")
    both = listed.join(read, "path", "left")
    return both.groupBy(folder.alias("folder")).agg(F.sum("length").cast("long").alias("listed_bytes"),
                                                    F.sum("bytes").cast("long").alias("read_bytes"))


# ---- watermark and counts --------------------------------------------------------

def q_watermark_newest(spark, d):
    return newest(_destination(spark, d), "ts")


def q_watermark_fallback(spark, d):
    empty = _events(spark, d).filter(F.lit(False))
    newest_ts = newest_mark(empty, "ts")  # None: empty destination
    return count_collection(_events(spark, d).filter(new_rows_filter("ts", newest_ts, AS_OF, "timestamp_ntz")))


def q_new_rows_count(spark, d):
    mark = newest_mark(_destination(spark, d), "ts")
    n = count_new(_events(spark, d), "ts", mark, AS_OF)
    return spark.range(1).select(F.lit(n).cast("long").alias("n"))


# ---- transfer --------------------------------------------------------------------

def q_incremental_transfer(spark, d):
    newest_ts = newest_mark(_destination(spark, d), "ts")
    return transfer_delta(_events(spark, d), ts_col="ts", newest_ts=newest_ts, as_of=AS_OF,
                          key="event_id", run_id=RUN_ID).select(*EVENT_COLS, TAG_COL)


def q_full_transfer(spark, d):
    return transfer_delta(_events(spark, d), ts_col="ts", new_only=False, key="event_id",
                          run_id=RUN_ID).select(*EVENT_COLS, TAG_COL)


def _loaded_destination(spark, d, upto: dt.datetime) -> str:
    path = shared_dir(spark, "destination")
    rows = tag_rows(_events(spark, d).filter(F.col("ts") <= _ts_lit(upto)), OTHER_RUN_ID)
    upsert_path(spark, path, rows, "event_id", buckets=8)
    return path


def _report(spark, result) -> DataFrame:
    return result.to_df(spark).select("run_id", "found", "written", "before", "after")


def q_transfer_report(spark, d):
    path = _loaded_destination(spark, d, LO)
    res = run_transfer(spark, _events(spark, d), path, ts_col="ts", key="event_id", as_of=AS_OF,
                       run_id=RUN_ID, buckets=8)
    return _report(spark, res)


def q_transfer_noop(spark, d):
    path = _loaded_destination(spark, d, AS_OF)
    res = run_transfer(spark, _events(spark, d), path, ts_col="ts", key="event_id", as_of=AS_OF,
                       run_id=RUN_ID, buckets=8)
    return _report(spark, res)


def _transferred(spark, d, events: DataFrame) -> DataFrame:
    """A loaded destination after one run, read back whole."""
    path = shared_dir(spark, "destination")
    upto = F.to_timestamp(F.lit(LO.isoformat(sep=" "))) if dict(events.dtypes)["ts"] == "timestamp" else _ts_lit(LO)
    upsert_path(spark, path, tag_rows(events.filter(F.col("ts") <= upto), OTHER_RUN_ID), "event_id", buckets=8)
    run_transfer(spark, events, path, ts_col="ts", key="event_id", as_of=AS_OF, run_id=RUN_ID, buckets=8)
    return read_bucketed(spark, path).select(*EVENT_COLS, TAG_COL)


def q_transfer_rows(spark, d):
    return _transferred(spark, d, _events(spark, d))


def q_transfer_rows_zoned(spark, d):
    """The same with a zoned timestamp column (read back without its zone, as the source has it)."""
    zoned = _events(spark, d).withColumn("ts", F.col("ts").cast("timestamp"))
    return _transferred(spark, d, zoned).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _full_run(spark, d):
    path = _loaded_destination(spark, d, LO)
    return path, run_transfer(spark, _events(spark, d), path, ts_col="ts", key="event_id", new_only=False,
                              run_id=RUN_ID, buckets=8)


def q_full_transfer_rows(spark, d):
    """R2: a full run over a loaded destination, read back whole."""
    return read_bucketed(spark, _full_run(spark, d)[0]).select(*EVENT_COLS, TAG_COL)


def q_full_transfer_report(spark, d):
    """Of a full run, rows observed while reading against rows counted at rest."""
    return _full_run(spark, d)[1].to_df(spark).select("run_id", "found", "written", "before", "after", "lost")


def q_watermark_at_rest(spark, d):
    """A2 from the zone maps of a stored destination."""
    path = _loaded_destination(spark, d, LO)
    return spark.range(1).select(stored_newest(spark, path, "ts").lit("timestamp_ntz").alias("newest"))


def q_tag_rows(spark, d):
    return tag_rows(_events(spark, d), RUN_ID).select("event_id", TAG_COL)


def q_written_by_tag(spark, d):
    ev = _events(spark, d)
    both = tag_rows(ev.filter(F.col("ts") <= _ts_lit(LO)), OTHER_RUN_ID).unionByName(
        tag_rows(ev.filter(F.col("ts") > _ts_lit(LO)), RUN_ID))
    return both.groupBy(TAG_COL).agg(F.count(F.lit(1)).alias("n"))


# ---- keys --------------------------------------------------------------------------

def q_natural_key(spark, d):
    li = with_natural_key(_t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], "id")
    return li.groupBy("id").agg(F.count(F.lit(1)).alias("n"))


def q_natural_key_nullable(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "lang")
    joined = docs.join(_t(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    return with_natural_key(joined, ["doc_id", "quality", "lang"], "id").select("doc_id", "id")


def q_latest_per_key(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                          "l_shipdate", "l_quantity")
    return latest_per_key(li, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])


# ---- upsert, atomic add, writes ----------------------------------------------------

UPSERT_COLS = ["event_id", "ts", "event_type", "value"]


def _upsert_inputs(spark, d):
    ev = _events(spark, d).select(*UPSERT_COLS)
    dest = ev.filter(F.col("ts") <= _ts_lit(LO))
    updates = ev.filter(range_("ts", OVERLAP_FROM, AS_OF, dtype="timestamp_ntz")) \
        .withColumn("value", F.col("value") * F.lit(2.0))
    return dest, updates


def q_upsert_by_key(spark, d):
    dest, updates = _upsert_inputs(spark, d)
    return upsert(dest, updates, "event_id").select(*UPSERT_COLS)


def q_upsert_at_rest(spark, d):
    dest, updates = _upsert_inputs(spark, d)
    path = shared_dir(spark, "upsert")
    upsert_path(spark, path, dest, "event_id", buckets=8)
    upsert_path(spark, path, updates, "event_id", buckets=8)
    return read_bucketed(spark, path).select(*UPSERT_COLS)


def _add_inputs(spark, d):
    docs = _t(spark, d, "documents")
    dest = docs.select(F.col("doc_id").cast("string").alias("id"), "lang",
                       F.array(F.col("lang")).alias("tags_ss"))
    labels = _t(spark, d, "labels").select(
        F.col("doc_id").cast("string").alias("id"),
        F.array(F.concat(F.lit("quality:"), F.col("quality").cast("string")),
                F.concat(F.lit("toxic:"), F.col("toxic").cast("string"))).alias("tags_ss"))
    fresh = _t(spark, d, "benchmark").select(
        F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("id"),
        F.array(F.lit("benchmark")).alias("tags_ss"))
    return dest, labels, fresh


def q_atomic_add(spark, d):
    dest, labels, fresh = _add_inputs(spark, d)
    out = atomic_add(dest, labels.unionByName(fresh), "id", ["tags_ss"])
    return out.select("id", "lang", F.array_join(F.array_sort("tags_ss"), " ").alias("tags"))


def q_atomic_add_at_rest(spark, d):
    """J2 at rest: two batches of adds, the first one folded and sent again, read back with the second still in the log."""
    dest, labels, fresh = _add_inputs(spark, d)
    path = shared_dir(spark, "adds")
    upsert_path(spark, path, dest, "id", buckets=8)
    atomic_add_path(spark, path, labels, ["tags_ss"], batch_id="labels")
    fold_adds(spark, path)
    atomic_add_path(spark, path, labels, ["tags_ss"], batch_id="labels")
    atomic_add_path(spark, path, fresh, ["tags_ss"], batch_id="benchmark")
    out = read_bucketed(spark, path)
    return out.select("id", "lang", F.array_join(F.array_sort("tags_ss"), " ").alias("tags"))


def q_write_batches(spark, d):
    path = shared_dir(spark, "batches")
    write_collection(_events(spark, d), path, mode="overwrite", batch_size=1000)
    return spark.read.parquet(path).select(*EVENT_COLS)


def q_compaction(spark, d):
    """K4 on a bucketed collection: two appends leave several files per bucket,
    then each bucket is rewritten in place into one file."""
    path = shared_dir(spark, "many")
    ev = _events(spark, d)
    early = F.coalesce(F.col("ts") <= _ts_lit(LO), F.lit(False))   # the two parts cover every row
    upsert_path(spark, path, ev.filter(early), "event_id", buckets=8)
    upsert_path(spark, path, ev.filter(~early), "event_id", buckets=8)
    compact(spark, path, 1, key="event_id")
    return read_bucketed(spark, path).select(*EVENT_COLS)


# ---- enrichment --------------------------------------------------------------------

def _doc_tokens(spark, d):
    return tokens(_t(spark, d, "documents"), "doc_id", "text")


def q_tokenize_counts(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", tokenize("text").alias("t"))
    return docs.select("doc_id", F.size("t").cast("long").alias("tokens"),
                       F.size(F.array_distinct("t")).cast("long").alias("distinct_tokens"))


def q_entity_tags(spark, d):
    tags = tag_entities(_doc_tokens(spark, d), gazetteer(spark, GAZETTEER))
    return tags.select("doc_id", F.col("pos").cast("long").alias("pos"), "token", "entity_class")


def _table_gazetteer(spark, d) -> DataFrame:
    """A gazetteer from tables: words of part names (class PART) and long words of benchmark texts (BENCHMARK)."""
    parts = _t(spark, d, "part").select(F.explode(tokenize("p_name")).alias("token"), F.lit("PART").alias("entity_class"))
    bench = _t(spark, d, "benchmark").select(F.explode(tokenize("text")).alias("token"),
                                             F.lit("BENCHMARK").alias("entity_class"))
    return parts.unionByName(bench.where(F.length("token") >= 8)).distinct()


def q_entity_tags_table(spark, d):
    tags = tag_entities(_doc_tokens(spark, d), _table_gazetteer(spark, d))
    return tags.select("doc_id", F.col("pos").cast("long").alias("pos"), "token", "entity_class")


def q_entity_sets(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "text")
    return entity_sets_of_docs(docs, gazetteer(spark, GAZETTEER), "doc_id", "text") \
        .select("doc_id", "entity_class", _joined("words"))


def _entity_text(df: DataFrame) -> DataFrame:
    return df.select("id", _joined("location_ss"), _joined("organization_ss"), _joined("person_ss"))


def q_entity_pivot(spark, d):
    docs = _t(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("body_t"))
    return _entity_text(entity_rows(docs, gazetteer(spark, GAZETTEER)))


def q_udf_tagger(spark, d):
    docs = _t(spark, d, "documents").filter(F.col("text").isNotNull()) \
        .select(F.col("doc_id").cast("string").alias("id"), F.col("text"))
    entries = list(GAZETTEER)
    out = map_tagger(docs, lambda files: GazetteerTagger(entries), id_col="id", text_col="text")
    return _entity_text(out)


def q_enrichment_job(spark, d):
    """R6 end to end: tag documents, pivot, add the words to a destination by id."""
    docs = _t(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("body_t"))
    dest = _t(spark, d, "documents").select(
        F.col("doc_id").cast("string").alias("id"), "lang",
        F.array().cast("array<string>").alias("location_ss"),
        F.array(F.concat(F.lit("src:"), F.col("source"))).alias("organization_ss"),
        F.array().cast("array<string>").alias("person_ss"))
    out = run_enrichment(spark, docs, GAZETTEER, dest, id_col="id", text_col="body_t")
    return out.select("id", "lang", _joined("location_ss"), _joined("organization_ss"), _joined("person_ss"))


def q_enrichment_at_rest(spark, d):
    """R6 into a stored destination: the words found are added to its rows."""
    docs = _t(spark, d, "documents")
    path = shared_dir(spark, "enriched")
    none = F.array().cast("array<string>")
    upsert_path(spark, path, docs.select(
        F.col("doc_id").cast("string").alias("id"), "lang", none.alias("location_ss"),
        F.array(F.concat(F.lit("src:"), F.col("source"))).alias("organization_ss"), none.alias("person_ss")), "id", buckets=8)
    texts = docs.select(F.col("doc_id").alias("id"), F.col("text").alias("body_t"))
    run_enrichment_at(spark, texts, GAZETTEER, path, batch_id=RUN_ID)
    out = read_bucketed(spark, path)
    return out.select("id", "lang", _joined("location_ss"), _joined("organization_ss"), _joined("person_ss"))


def _phrases(spark, d) -> DataFrame:
    """Part names (class PART) and runs of two to four words of benchmark texts, some within others (BENCHMARK)."""
    words = tokenize("text")
    runs = F.array(*[F.array_join(F.slice(words, a, n), " ") for a, n in ((1, 2), (1, 4), (2, 2), (3, 3), (5, 1))])
    bench = _t(spark, d, "benchmark").select(F.explode(runs).alias("phrase"), F.lit("BENCHMARK").alias("entity_class"))
    parts = _t(spark, d, "part").select(F.col("p_name").alias("phrase"), F.lit("PART").alias("entity_class"))
    return parts.unionByName(bench)


def q_entity_phrases(spark, d):
    """J3 with entities of several words: in documents, and in the part names of each order as one text."""
    docs = _t(spark, d, "documents").select(F.concat(F.lit("d"), F.col("doc_id")).alias("id"), "text")
    names = (_t(spark, d, "lineitem").join(_t(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
             .groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_list("p_name")), " ").alias("text")))
    texts = docs.unionByName(names.select(F.concat(F.lit("o"), F.col("l_orderkey")).alias("id"), "text"))
    return tag_phrases(texts, _phrases(spark, d))


def q_sequence_tagger(spark, d):
    """U1 with context: tables counted from the word list's classes, then the best path of every sentence."""
    entries = dict(GAZETTEER)
    parts = sentences(_t(spark, d, "documents").where("doc_id IS NOT NULL"), "doc_id", "text")
    tables = count_tables(with_gazetteer_tags(parts, entries, "O"), sorted({*entries.values(), "O"}))
    found = class_counts(decode(parts, tables, by_class=True))
    return found.select(F.col("id").alias("doc_id"), F.col("tag").alias("entity_class"), "n", "words")


# ---- delivery ----------------------------------------------------------------------

def _pages(spark, d):
    return _t(spark, d, "pages")


def q_delivery_requests(spark, d):
    return _pages(spark, d).select("page_id", request_target("url", PIPELINE, COLLECTION, PARSER).alias("target"))


def q_url_origin(spark, d):
    return _pages(spark, d).select("page_id", url_origin("url").alias("origin"))


def q_delivery_assign(spark, d):
    hosts = F.array(*[F.lit(h) for h in HOSTS])
    return _pages(spark, d).select("page_id", F.element_at(hosts, assign_host("page_id", len(HOSTS)) + 1).alias("host"))


def q_batch_delivery(spark, d):
    """Pages in JSON batches, written as text to a folder per assigned host and read back."""
    pages = _pages(spark, d).select("page_id", url_origin("url").alias("origin"), F.length("html").alias("chars"))
    pages = pages.withColumn("lot", F.col("page_id") % PAGE_FOLDERS)
    batches = json_batches(pages, "lot", "page_id", JSON_BATCH_ROWS, cols=["page_id", "origin", "chars"])
    rows = batches.select(batch_key("lot").alias("batch"), batch_body("docs").alias("body"))
    return _metered(write_batches_by_host(rows, shared_dir(spark, "hand-over"), HOSTS))


def _metered(back: DataFrame) -> DataFrame:
    """A7 over handed-over batches: per host its batches, documents and characters."""
    docs = F.from_json("body", "array<struct<page_id:bigint,origin:string,chars:int>>")
    sent = back.select("host", docs.alias("docs")).select(
        "host", F.lit(DELIVERED).alias("status"), F.lit(1).alias("attempts"), F.size("docs").alias("documents"),
        F.aggregate("docs", F.lit(0).cast("long"), lambda a, x: a + x["chars"]).alias("chars"))
    chars = sent.groupBy("host").agg(F.sum("chars").cast("long").alias("chars"))
    meter = meter_by_host(sent, "documents")
    return meter.join(chars, "host").select("host", F.col("attempts").alias("batches"), F.col("delivered").alias("documents"), "chars")


def q_resumed_delivery(spark, d):
    """Pages handed over with a ledger in two runs; the second finds a tenth of them changed and sends only those."""
    pages = _pages(spark, d).select(F.col("page_id").cast("string").alias("batch"), F.col("html").alias("body"))
    changed = pages.withColumn("body", F.when(F.col("batch").cast("long") % 10 == 0, F.concat("body", F.lit("!"))).otherwise(F.col("body")))
    ledger = shared_dir(spark, "ledger")
    runs = [(f"run-{k}", hand_over(rows, shared_dir(spark, "hand-over"), HOSTS, ledger, f"run-{k}"))
            for k, rows in enumerate((pages, pages, changed))]
    sent = None
    for name, back in runs:
        mine = back.select(F.lit(name).alias("run"), "host", F.length("body").alias("chars"))
        sent = mine if sent is None else sent.unionByName(mine)
    return sent.groupBy("run", "host").agg(F.count(F.lit(1)).alias("sent"), F.sum("chars").cast("long").alias("chars"))


def q_match_all(spark, d):
    """Every row, spread over tasks as a delivery is."""
    ev = _events(spark, d).filter(match_all())
    return spread(ev, 10).select("event_id", "event_type")


def q_json_batches(spark, d):
    events = _events(spark, d).select("event_id", "event_type", "user_id")
    return json_batches(events, "event_type", "event_id", JSON_BATCH_ROWS) \
        .select("event_type", "batch_id", "rows", "first_id", "last_id", F.md5(batch_body("docs")).alias("body_md5"))


def q_json_parse(spark, d):
    ev = _events(spark, d)
    return ev.select("event_id", parse_json("props", "k int")["k"].alias("k"))


# ---- streaming ---------------------------------------------------------------------

def q_stream_transfer(spark, d):
    path = _loaded_destination(spark, d, LO)
    newest_ts = newest_mark(read_bucketed(spark, path), "ts")
    src = _events(spark, d)
    stream = file_stream(spark, d, src.schema, glob="events.parquet")
    stream_transfer(stream, path, shared_dir(spark, "stream-ckpt"), key="event_id", ts_col="ts",
                    run_id=RUN_ID, newest_ts=newest_ts, as_of=AS_OF, buckets=8)
    return read_bucketed(spark, path).select(*EVENT_COLS, TAG_COL)


def q_stream_dedupe(spark, d):
    src = _events(spark, d)
    s1 = file_stream(spark, d, src.schema, glob="events.parquet")
    s2 = file_stream(spark, d, src.schema, glob="events.parquet")
    out = shared_dir(spark, "dedupe")
    run_to_parquet(dedupe_stream(s1.unionByName(s2), ["event_id"], "ts", "1 hour"), out,
                   shared_dir(spark, "dedupe-ckpt"))
    return spark.read.parquet(out).select("event_id", "ts", "event_type")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "count_collection": q_count_collection,
    "scan_project_filter_limit": q_scan_project_filter_limit,
    "scan_options": q_scan_options,
    "field_exists": q_field_exists,
    "range_half_open": q_range_half_open,
    "range_unbounded": q_range_unbounded,
    "term_match": q_term_match,
    "conjunctive_filter": q_conjunctive_filter,
    "top_k_newest": q_top_k_newest,
    "flatten_multivalued": q_flatten_multivalued,
    "flatten_lines": q_flatten_lines,
    "file_manifest": q_file_manifest,
    "watermark_newest": q_watermark_newest,
    "watermark_at_rest": q_watermark_at_rest,
    "watermark_fallback": q_watermark_fallback,
    "new_rows_count": q_new_rows_count,
    "incremental_transfer": q_incremental_transfer,
    "full_transfer": q_full_transfer,
    "full_transfer_rows": q_full_transfer_rows,
    "full_transfer_report": q_full_transfer_report,
    "transfer_report": q_transfer_report,
    "transfer_noop": q_transfer_noop,
    "transfer_rows": q_transfer_rows,
    "transfer_rows_zoned": q_transfer_rows_zoned,
    "tag_rows": q_tag_rows,
    "written_by_tag": q_written_by_tag,
    "natural_key": q_natural_key,
    "natural_key_nullable": q_natural_key_nullable,
    "latest_per_key": q_latest_per_key,
    "upsert_by_key": q_upsert_by_key,
    "upsert_at_rest": q_upsert_at_rest,
    "atomic_add": q_atomic_add,
    "atomic_add_at_rest": q_atomic_add_at_rest,
    "write_batches": q_write_batches,
    "compaction": q_compaction,
    "tokenize_counts": q_tokenize_counts,
    "entity_tags": q_entity_tags,
    "entity_tags_table": q_entity_tags_table,
    "entity_phrases": q_entity_phrases,
    "entity_sets": q_entity_sets,
    "entity_pivot": q_entity_pivot,
    "udf_tagger": q_udf_tagger,
    "sequence_tagger": q_sequence_tagger,
    "enrichment_job": q_enrichment_job,
    "enrichment_at_rest": q_enrichment_at_rest,
    "delivery_requests": q_delivery_requests,
    "url_origin": q_url_origin,
    "delivery_assign": q_delivery_assign,
    "batch_delivery": q_batch_delivery,
    "resumed_delivery": q_resumed_delivery,
    "match_all": q_match_all,
    "splits_read": q_splits_read,
    "json_batches": q_json_batches,
    "json_parse": q_json_parse,
    "stream_transfer": q_stream_transfer,
    "stream_dedupe": q_stream_dedupe,
}


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """The full incremental transfer job; returns the rows this run wrote."""
    path = _loaded_destination(spark, d, LO)
    run_transfer(spark, _events(spark, d), path, ts_col="ts", key="event_id", as_of=AS_OF,
                 run_id=RUN_ID, buckets=8)
    return read_bucketed(spark, path).filter(term(TAG_COL, RUN_ID)).select(*EVENT_COLS, TAG_COL)
