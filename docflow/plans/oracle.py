"""Independent SQL (DuckDB dialect) for each registered query.

Tables are the driver's views. Constants match ``docflow.plans.catalog``.
"""

from __future__ import annotations

from docflow.functions.urls import index_path
from docflow.plans import catalog as C

LO = f"TIMESTAMP '{C.LO:%Y-%m-%d %H:%M:%S}'"
AS_OF = f"TIMESTAMP '{C.AS_OF:%Y-%m-%d %H:%M:%S}'"
OVERLAP_FROM = f"TIMESTAMP '{C.OVERLAP_FROM:%Y-%m-%d %H:%M:%S}'"
RUN = f"'{C.RUN_ID}'"
OTHER = f"'{C.OTHER_RUN_ID}'"
EV = "event_id, ts, user_id, event_type, value, props"
TOKENS = r"regexp_extract_all(text, '([\p{L}\p{N}]+)', 1)"
GAZ = "g(token, entity_class) AS (VALUES " + ", ".join(f"('{w}', '{c}')" for w, c in C.GAZETTEER) + ")"
NEWEST = f"(SELECT max(ts) FROM events WHERE ts <= {LO})"
HOSTS_SQL = "CASE {x} " + " ".join(f"WHEN {i} THEN '{h}'" for i, h in enumerate(C.HOSTS)) + " END"
N_HOSTS = len(C.HOSTS)


def _key(*parts: str) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts) + ")"


def _tags_cte() -> str:
    return (f"WITH {GAZ}, t AS (SELECT doc_id, unnest(range(len(toks))) AS pos, unnest(toks) AS token "
            f"FROM (SELECT doc_id, {TOKENS} AS toks FROM documents)), "
            "tags AS (SELECT t.doc_id, t.pos, t.token, g.entity_class FROM t JOIN g ON t.token = g.token) ")


ENTITY_COLS = (("LOCATION", "location_ss"), ("ORGANIZATION", "organization_ss"), ("PERSON", "person_ss"))


def _pivot_cte() -> str:
    """CTE ``p``: per document id, a sorted distinct word list per class (or null)."""
    cols = ", ".join(
        f"list_sort(list_distinct(list(tags.token) FILTER (WHERE tags.entity_class = '{cls}'))) AS {name}"
        for cls, name in ENTITY_COLS)
    return (_tags_cte() + f", p AS (SELECT CAST(d.doc_id AS VARCHAR) AS id, {cols} FROM documents d "
            "LEFT JOIN tags ON d.doc_id = tags.doc_id WHERE d.text IS NOT NULL GROUP BY d.doc_id) ")


def _pivot() -> str:
    cols = ", ".join(f"coalesce(array_to_string({name}, ' '), '') AS {name}" for _, name in ENTITY_COLS)
    return _pivot_cte() + f"SELECT id, {cols} FROM p"


def _enrichment_job() -> str:
    # Destination: empty location/person lists, organization holds 'src:<source>';
    # the found words are added without repeats.
    dst = ("dst AS (SELECT CAST(doc_id AS VARCHAR) AS id, lang, [] AS location_ss, "
           "['src:' || source] AS organization_ss, [] AS person_ss FROM documents) ")
    cols = ", ".join(
        f"array_to_string(list_sort(list_distinct(list_concat(coalesce(dst.{n}, []), coalesce(p.{n}, [])))), ' ') AS {n}"
        for _, n in ENTITY_COLS)
    return (_pivot_cte() + ", " + dst + f"SELECT coalesce(dst.id, p.id) AS id, dst.lang AS lang, {cols} "
            "FROM dst FULL OUTER JOIN p ON dst.id = p.id")


def _encode(x: str) -> str:
    # DuckDB's url_encode escapes space as %20 and '*', keeps '~';
    # form encoding writes '+', keeps '*', escapes '~'.
    return f"replace(replace(replace(url_encode({x}), '%20', '+'), '%2A', '*'), '~', '%7E')"


def _table_tags() -> str:
    words = lambda c: f"regexp_extract_all({c}, '[\\p{{L}}\\p{{N}}]+')"
    return ("WITH w AS (SELECT unnest(" + words("p_name") + ") AS token, 'PART' AS entity_class FROM part UNION ALL "
            "SELECT token, 'BENCHMARK' FROM (SELECT unnest(" + words("text") + ") AS token FROM benchmark) "
            "WHERE length(token) >= 8), "
            "g AS (SELECT token, max(entity_class) AS entity_class FROM w GROUP BY token), "
            "t AS (SELECT doc_id, unnest(range(len(ws))) AS pos, unnest(ws) AS token FROM "
            "(SELECT doc_id, " + words("text") + " AS ws FROM documents)) "
            "SELECT doc_id, CAST(pos AS BIGINT) AS pos, token, entity_class FROM t JOIN g USING (token)")


def _batch_delivery() -> str:
    key = "CAST(lot AS VARCHAR) || '-' || CAST(batch_id AS VARCHAR)"
    host = f"CAST(('0x' || substr(md5({key}), 1, 8)) AS BIGINT) % {N_HOSTS}"
    return ("WITH n AS (SELECT page_id % " + str(C.PAGE_FOLDERS) + " AS lot, length(html) AS chars, "
            "CAST((row_number() OVER (PARTITION BY page_id % " + str(C.PAGE_FOLDERS) + " ORDER BY page_id) - 1) // "
            f"{C.JSON_BATCH_ROWS} AS BIGINT) AS batch_id FROM pages), "
            f"b AS (SELECT {HOSTS_SQL.format(x=host)} AS host, lot, batch_id, chars FROM n) "
            "SELECT host, CAST(count(DISTINCT (lot, batch_id)) AS BIGINT) AS batches, count(*) AS documents, "
            "CAST(sum(chars) AS BIGINT) AS chars FROM b GROUP BY host")


UPSERT_SQL = (
    f"WITH d AS (SELECT event_id, ts, event_type, value FROM events WHERE ts <= {LO}), "
    f"u AS (SELECT event_id, ts, event_type, value * 2.0 AS value FROM events "
    f"WHERE ts > {OVERLAP_FROM} AND ts <= {AS_OF}) "
    "SELECT * FROM d WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.event_id = d.event_id) "
    "UNION ALL SELECT * FROM u")

def _entity_phrases() -> str:
    words = lambda c: f"regexp_extract_all({c}, '[\\p{{L}}\\p{{N}}]+')"
    runs = ", ".join(f"array_to_string(w[{a}:{a + n - 1}], ' ')" for a, n in ((1, 2), (1, 4), (2, 2), (3, 3), (5, 1)))
    return f"""
        WITH RECURSIVE names AS (
            SELECT array_to_string({words('p_name')}, ' ') AS phrase, 'PART' AS entity_class FROM part UNION ALL
            SELECT unnest([{runs}]), 'BENCHMARK' FROM (SELECT {words('text')} AS w FROM benchmark)),
        phrases AS (SELECT phrase, max(entity_class) AS entity_class FROM names WHERE phrase <> '' GROUP BY phrase),
        texts AS (SELECT 'd' || doc_id AS id, text FROM documents UNION ALL
                  SELECT 'o' || l_orderkey, string_agg(p_name, ' ' ORDER BY p_name) FROM lineitem
                  JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey),
        docs AS (SELECT row_number() OVER () AS r, id, {words('text')} AS w FROM texts),
        spots AS (SELECT r, id, w, unnest(range(len(w))) AS pos FROM docs),
        spans AS (SELECT r, id, pos, width, array_to_string(w[pos + 1:pos + width], ' ') AS phrase
                  FROM (SELECT *, unnest(range(1, least(4, len(w) - pos) + 1)) AS width FROM spots)),
        found AS MATERIALIZED (SELECT r, id, pos, max(width) AS width FROM spans JOIN phrases USING (phrase) GROUP BY r, id, pos),
        follows AS MATERIALIZED (SELECT a.r, a.pos, min(b.pos) AS next FROM found a
                    LEFT JOIN found b ON b.r = a.r AND b.pos >= a.pos + a.width GROUP BY a.r, a.pos),
        kept(r, pos) AS (SELECT r, min(pos) FROM found GROUP BY r
                         UNION ALL SELECT k.r, f.next FROM kept k JOIN follows f ON f.r = k.r AND f.pos = k.pos WHERE f.next IS NOT NULL)
        SELECT s.id, s.pos::BIGINT AS pos, s.width::BIGINT AS width, s.phrase, p.entity_class
        FROM kept k JOIN found f USING (r, pos) JOIN spans s ON s.r = f.r AND s.pos = f.pos AND s.width = f.width
        JOIN phrases p USING (phrase)"""


def _sequence_tagger() -> str:
    classes = sorted({c for _, c in C.GAZETTEER} | {"O"})
    numbered = ", ".join(f"({k}, '{c}')" for k, c in enumerate(classes))
    n = len(classes)
    into = lambda k: "[" + ", ".join(f"a.v[{j}] + m[{j}][{k}]" for j in range(1, n + 1)) + "]"
    values = ", ".join(f"list_max({into(k)}) + x.v[{k}]" for k in range(1, n + 1))
    backs = ", ".join(f"list_position({into(k)}, list_max({into(k)}))::BIGINT" for k in range(1, n + 1))
    return f"""
        WITH {GAZ}, cls(k, c) AS (VALUES {numbered}),
        docs AS (SELECT row_number() OVER () AS r, doc_id, string_split_regex(text, '[.!?\\n]') AS parts
                 FROM documents WHERE doc_id IS NOT NULL),
        sents AS (SELECT r, doc_id, s, regexp_extract_all(parts[s], '[\\p{{L}}\\p{{N}}]+') AS w
                  FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS s FROM docs)),
        toks AS MATERIALIZED (SELECT r, doc_id, s, pos, len(w) AS len, w[pos] AS word
                 FROM (SELECT *, unnest(range(1, len(w) + 1)) AS pos FROM sents)),
        tagged AS MATERIALIZED (SELECT t.*, coalesce(g.entity_class, 'O') AS c FROM toks t LEFT JOIN g ON g.token = t.word),
        firsts AS (SELECT cls.k, count(t.c) AS n FROM cls LEFT JOIN (SELECT c FROM tagged WHERE pos = 1) t ON t.c = cls.c GROUP BY cls.k),
        start AS (SELECT k, round(ln((n + 1)::DOUBLE / (sum(n) OVER () + {n})) * 1000000)::BIGINT AS v FROM firsts),
        steps AS (SELECT a.c AS a, b.c AS b, count(*) AS n FROM tagged a JOIN tagged b
                  ON b.r = a.r AND b.s = a.s AND b.pos = a.pos + 1 GROUP BY ALL),
        pairs AS (SELECT a.k AS a, b.k AS b, coalesce(n, 0) AS n FROM cls a CROSS JOIN cls b
                  LEFT JOIN steps ON steps.a = a.c AND steps.b = b.c),
        moves AS MATERIALIZED (SELECT a, b, round(ln((n + 1)::DOUBLE / (sum(n) OVER (PARTITION BY a) + {n})) * 1000000)::BIGINT AS v FROM pairs),
        vocabulary AS (SELECT DISTINCT word FROM toks),
        counts AS (SELECT v.word, cls.k, count(t.word) AS n FROM vocabulary v CROSS JOIN cls
                   LEFT JOIN tagged t ON t.word = v.word AND t.c = cls.c GROUP BY v.word, cls.k),
        emits AS MATERIALIZED (SELECT word, k, round(ln((n + 1)::DOUBLE / (sum(n) OVER (PARTITION BY k) + (SELECT count(*) FROM vocabulary) + 1))
                   * 1000000)::BIGINT AS v FROM counts),
        scores AS MATERIALIZED (SELECT word, list(v ORDER BY k) AS e FROM emits GROUP BY word),
        fixed AS MATERIALIZED (SELECT (SELECT list(v ORDER BY k) FROM start) AS st,
                   (SELECT list(row ORDER BY a) FROM (SELECT a, list(v ORDER BY b) AS row FROM moves GROUP BY a)) AS m),
        lattice AS MATERIALIZED (SELECT r, doc_id, s, list(word ORDER BY pos) AS w, list({{'v': CASE WHEN pos = 1
                       THEN list_transform(e, lambda x, i: x + st[i]) ELSE e END, 'back': []::BIGINT[][]}} ORDER BY pos) AS l
                   FROM toks JOIN scores USING (word), fixed GROUP BY r, doc_id, s),
        walked AS MATERIALIZED (SELECT doc_id, w, list_reduce(l, lambda a, x: {{'v': [{values}],
                       'back': list_append(a.back, [{backs}])}}) AS z FROM lattice, fixed),
        paths AS (SELECT doc_id, w, list_reverse(list_reduce([[list_position(z.v, list_max(z.v))::BIGINT]] || list_reverse(z.back),
                      lambda p, b: list_append(p, b[p[len(p)]]))) AS path FROM walked),
        words AS (SELECT doc_id, unnest(w) AS word, unnest(path) AS k FROM paths)
        SELECT doc_id, c AS entity_class, count(*) AS n, count(DISTINCT word) AS words
        FROM words JOIN cls ON cls.k = words.k - 1 GROUP BY doc_id, c"""


SQL: dict[str, str] = {
    "count_collection": "SELECT count(*) AS n FROM documents",
    "scan_project_filter_limit":
        "SELECT doc_id, lang FROM documents WHERE n_chars > 500 ORDER BY doc_id LIMIT 10",
    "field_exists":
        "SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NOT NULL",
    "range_half_open": f"SELECT event_id, ts FROM events WHERE ts > {LO} AND ts <= {AS_OF}",
    "range_unbounded": f"SELECT event_id, ts FROM events WHERE ts <= {AS_OF}",
    "term_match": "SELECT event_id, user_id, event_type FROM events WHERE event_type = 'purchase'",
    "conjunctive_filter":
        f"SELECT event_id, ts FROM events WHERE event_type = 'purchase' AND ts > {LO} AND ts <= {AS_OF}",
    "top_k_newest":
        "SELECT event_id, ts FROM events ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST LIMIT 10",
    "flatten_multivalued":
        "SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS text FROM conversations GROUP BY conv_id",
    "flatten_lines":
        "SELECT doc_id, array_to_string(string_split(text, chr(10)), ' ') AS text FROM documents",
    "watermark_newest": f"SELECT max(ts) AS newest FROM events WHERE ts <= {LO}",
    "watermark_fallback": f"SELECT count(*) AS n FROM events WHERE ts <= {AS_OF}",
    "new_rows_count": f"SELECT count(*) AS n FROM events WHERE ts > {NEWEST} AND ts <= {AS_OF}",
    "incremental_transfer":
        f"SELECT {EV}, {RUN} AS _xfer_id FROM events WHERE ts > {NEWEST} AND ts <= {AS_OF}",
    "full_transfer": f"SELECT {EV}, {RUN} AS _xfer_id FROM events",
    "transfer_rows":
        f"SELECT {EV}, _xfer_id FROM (SELECT *, CASE WHEN ts <= {LO} THEN {OTHER} ELSE {RUN} END AS _xfer_id "
        f"FROM events WHERE ts <= {AS_OF})",
    "transfer_rows_zoned":
        f"SELECT {EV}, _xfer_id FROM (SELECT *, CASE WHEN ts <= {LO} THEN {OTHER} ELSE {RUN} END AS _xfer_id "
        f"FROM events WHERE ts <= {AS_OF})",
    "scan_options": "SELECT doc_id, lang FROM documents WHERE n_chars > 500 AND lang = 'de'",
    "transfer_report":
        f"SELECT {RUN} AS run_id, n_new AS found, n_new AS written, n_before AS before, "
        f"n_before + n_new AS after FROM (SELECT "
        f"count(*) FILTER (WHERE ts <= {LO}) AS n_before, "
        f"count(*) FILTER (WHERE ts > {NEWEST} AND ts <= {AS_OF}) AS n_new FROM events)",
    "transfer_noop":
        f"SELECT {RUN} AS run_id, CAST(0 AS BIGINT) AS found, CAST(0 AS BIGINT) AS written, "
        f"count(*) AS before, count(*) AS after FROM events WHERE ts <= {AS_OF}",
    "tag_rows": f"SELECT event_id, {RUN} AS _xfer_id FROM events",
    "written_by_tag":
        f"SELECT CASE WHEN ts <= {LO} THEN {OTHER} ELSE {RUN} END AS _xfer_id, count(*) AS n "
        "FROM events GROUP BY 1",
    "natural_key":
        f"SELECT {_key('l_orderkey', 'l_linenumber')} AS id, count(*) AS n FROM lineitem GROUP BY 1",
    "natural_key_nullable":
        f"SELECT d.doc_id, {_key('d.doc_id', 'l.quality', 'd.lang')} AS id "
        "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id",
    "latest_per_key":
        "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity FROM ("
        "SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST, "
        "l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST) AS rn FROM lineitem) WHERE rn = 1",
    "full_transfer_rows": f"SELECT {EV}, {RUN} AS _xfer_id FROM events",
    "full_transfer_report":
        f"SELECT {RUN} AS run_id, count(*) AS found, count(*) AS written, count(*) FILTER (WHERE ts <= {LO}) AS before, "
        "count(*) AS after, CAST(0 AS BIGINT) AS lost FROM events",
    "watermark_at_rest": f"SELECT max(ts) AS newest FROM events WHERE ts <= {LO}",
    "entity_phrases": _entity_phrases(),
    "sequence_tagger": _sequence_tagger(),
    "enrichment_at_rest": _enrichment_job(),
    "upsert_by_key": UPSERT_SQL,
    "upsert_at_rest": UPSERT_SQL,
    "atomic_add":
        "WITH d AS (SELECT CAST(doc_id AS VARCHAR) AS id, lang, [lang] AS tags_ss FROM documents), "
        "a AS (SELECT CAST(doc_id AS VARCHAR) AS id, ['quality:' || CAST(quality AS VARCHAR), "
        "'toxic:' || CAST(toxic AS VARCHAR)] AS tags_ss FROM labels "
        "UNION ALL SELECT 'b' || CAST(item_id AS VARCHAR) AS id, ['benchmark'] AS tags_ss FROM benchmark), "
        "ag AS (SELECT id, flatten(list(tags_ss)) AS tags_ss FROM a GROUP BY id) "
        "SELECT coalesce(d.id, ag.id) AS id, d.lang AS lang, "
        "array_to_string(list_sort(list_concat(coalesce(d.tags_ss, []), coalesce(ag.tags_ss, []))), ' ') AS tags "
        "FROM d FULL OUTER JOIN ag ON d.id = ag.id",
    "write_batches": f"SELECT {EV} FROM events",
    "compaction": f"SELECT {EV} FROM events",
    "tokenize_counts":
        f"SELECT doc_id, CAST(len({TOKENS}) AS BIGINT) AS tokens, "
        f"CAST(len(list_distinct({TOKENS})) AS BIGINT) AS distinct_tokens FROM documents",
    "entity_tags": _tags_cte() + "SELECT doc_id, CAST(pos AS BIGINT) AS pos, token, entity_class FROM tags",
    "entity_tags_table": _table_tags(),
    "entity_sets":
        _tags_cte() + "SELECT doc_id, entity_class, array_to_string(list_sort(list_distinct(list(token))), ' ') "
        "AS words FROM tags WHERE entity_class <> 'O' GROUP BY doc_id, entity_class",
    "entity_pivot": _pivot(),
    "udf_tagger": _pivot(),
    "enrichment_job": _enrichment_job(),
    "delivery_requests":
        f"SELECT page_id, '{index_path(C.PIPELINE, C.COLLECTION, C.PARSER)}&contentSourceName=' || {_encode('url')} "
        "|| '&echo=false' AS target FROM pages",
    "url_origin":
        "SELECT page_id, regexp_extract(CASE WHEN url LIKE 'http://%' OR url LIKE 'https://%' THEN url "
        "ELSE 'http://' || url END, '^([a-zA-Z]+://[^/:?#]+(:[0-9]+)?)', 1) AS origin FROM pages",
    "delivery_assign":
        "SELECT page_id, " + HOSTS_SQL.format(
            x=f"CAST(('0x' || substr(md5(CAST(page_id AS VARCHAR)), 1, 8)) AS BIGINT) % {N_HOSTS}")
        + " AS host FROM pages",
    "batch_delivery": _batch_delivery(),
    "resumed_delivery":
        "WITH p AS (SELECT " + HOSTS_SQL.format(
            x=f"CAST(('0x' || substr(md5(CAST(page_id AS VARCHAR)), 1, 8)) AS BIGINT) % {N_HOSTS}")
        + " AS host, page_id, length(html) AS chars FROM pages), "
        "r AS (SELECT 'run-0' AS run, host, chars FROM p UNION ALL "
        "SELECT 'run-2', host, chars + 1 FROM p WHERE page_id % 10 = 0) "
        "SELECT run, host, count(*) AS sent, CAST(sum(chars) AS BIGINT) AS chars FROM r GROUP BY run, host",
    "match_all": "SELECT event_id, event_type FROM events",
    "splits_read":
        "SELECT o_orderstatus, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem "
        "JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderstatus",
    "file_manifest":
        f"SELECT page_id % {C.PAGE_FOLDERS} AS folder, CAST(sum(strlen(html) + 1) AS BIGINT) AS listed_bytes, "
        "CAST(sum(strlen(html) + 1) AS BIGINT) AS read_bytes FROM pages GROUP BY 1",
    "json_batches":
        "WITH n AS (SELECT event_type, event_id, user_id, CAST((row_number() OVER (PARTITION BY event_type "
        f"ORDER BY event_id) - 1) // {C.JSON_BATCH_ROWS} AS BIGINT) AS batch_id FROM events) "
        "SELECT event_type, batch_id, count(*) AS rows, min(event_id) AS first_id, max(event_id) AS last_id, "
        "md5('[' || string_agg('{\"event_id\":' || event_id || ',\"event_type\":\"' || event_type || "
        "'\",\"user_id\":' || user_id || '}', ',' ORDER BY event_id) || ']') AS body_md5 "
        "FROM n GROUP BY event_type, batch_id",
    "json_parse":
        "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    "stream_transfer":
        f"SELECT {EV}, CASE WHEN ts <= {LO} THEN {OTHER} ELSE {RUN} || '-0' END AS _xfer_id "
        f"FROM events WHERE ts <= {AS_OF}",
    "stream_dedupe": "SELECT event_id, ts, event_type FROM events",
}
SQL["atomic_add_at_rest"] = SQL["atomic_add"]
