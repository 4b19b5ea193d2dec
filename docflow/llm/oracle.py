"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from docflow.llm.licences import RULES, SENTENCES, normal, slot_patterns
from docflow.llm.pii import Disclosure


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _licences() -> str:
    """Every run of pieces against every known sentence: no hints, no growing."""
    known = ", ".join(f"({_text(normal(s))}, {_text(i)})" for i, s in SENTENCES.items())
    rules = ", ".join(f"({k}, {_text(r)}, {_text(n)}, {_text(''.join(f'<{i}>' for i in ids))}, {_text('<>' * len(ids))})"
                      for k, (r, n, ids) in enumerate(RULES, 1))
    line = "array_to_string(list_filter(pieces, lambda x: x <> ''), '|')"
    for pattern, to in slot_patterns():
        line = f"regexp_replace({line}, {_text(pattern)}, {_text(to.replace('$', chr(92)))}, 'g')"
    most = max(len(normal(s).split()) for s in SENTENCES.values())
    return f"""
        WITH RECURSIVE known(sentence, id) AS (VALUES {known}), rules(k, rule, licence, want, taken) AS (VALUES {rules}),
        cut AS (SELECT row_number() OVER () AS r, doc_id, list_transform(
                    string_split(regexp_replace(lower(text), '([.!?:])[ \\t\\r\\n]+', '\\1\n', 'g'), '\n'),
                    lambda x: trim(regexp_replace(x, '[^a-z0-9]+', ' ', 'g'))) AS pieces FROM documents),
        docs AS (SELECT r, doc_id, string_split({line}, '|') AS pieces FROM cut),
        starts AS (SELECT r, doc_id, pieces, unnest(range(len(pieces))) AS place FROM docs),
        runs AS (SELECT r, doc_id, place, width, array_to_string(pieces[place + 1:place + width], ' ') AS sentence
                 FROM (SELECT *, unnest(range(1, least({most}, len(pieces) - place) + 1)) AS width FROM starts)),
        found AS (SELECT r, doc_id, place, max(place + width) AS stop, arg_max(id, width) AS id
                  FROM runs JOIN known USING (sentence) GROUP BY r, doc_id, place),
        outer_found AS (SELECT * FROM found QUALIFY coalesce(max(stop) OVER (PARTITION BY r ORDER BY place
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < stop),
        sequences AS MATERIALIZED (SELECT r, doc_id, list(place ORDER BY place) AS places,
                          string_agg('<' || id || '>', '' ORDER BY place) AS sentences FROM outer_found GROUP BY r, doc_id),
        walk(r, k, rest, n, before) AS (
            SELECT r, 0, sentences, 0, 0 FROM sequences UNION ALL
            SELECT w.r, w.k + 1, replace(w.rest, want, taken),
                   (length(w.rest) - length(replace(w.rest, want, ''))) // length(want),
                   len(string_split(split_part(w.rest, want, 1), '<')) - 1
            FROM walk w JOIN rules ON rules.k = w.k + 1)
        SELECT doc_id, rule, licence, n::BIGINT AS n_matches, places[before + 1]::INTEGER AS first_piece, sentences
        FROM walk JOIN sequences USING (r) JOIN rules USING (k) WHERE n > 0"""


def _jaccard() -> str:
    return """
        WITH RECURSIVE
        docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        sets AS (SELECT doc_id, CASE WHEN len(w) >= 5
                     THEN list_distinct(list_transform(range(len(w) - 4), lambda k: array_to_string(w[k + 1:k + 5], ' ')))
                     WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM docs),
        classes AS (SELECT min(doc_id) AS node, list_sort(s) AS s FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)),
        items AS (SELECT node, len(s) AS n, unnest(s) AS x FROM classes),
        pairs AS (SELECT a.node AS a, b.node AS b, a.n AS na, b.n AS nb, count(*) AS shared
                  FROM items a JOIN items b ON a.x = b.x AND a.node < b.node GROUP BY ALL),
        links AS (SELECT a, b FROM pairs WHERE 100 * shared >= 80 * (na + nb - shared)),
        edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach(node, other) AS (SELECT node, node FROM classes
                               UNION SELECT r.node, e.b FROM reach r JOIN edges e ON e.a = r.other),
        least AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
        SELECT t.doc_id, len(t.s)::BIGINT AS n_shingles, coalesce(least.component_id, t.doc_id) AS component_id
        FROM sets t LEFT JOIN classes c ON c.s = list_sort(t.s) LEFT JOIN least ON least.node = c.node"""


def _decontaminate(window: int = 16, share: float = 0.8) -> str:
    """Every alignment of every item with every document that agrees in enough tokens; no seeds."""
    words = lambda c: (f"list_filter(string_split_regex(lower(coalesce({c}, '')), '[^\\p{{L}}\\p{{N}}]+'), "  # noqa: E731
                       "lambda x: x <> '')")
    return f"""
        WITH items AS MATERIALIZED (SELECT *, row_number() OVER () AS i FROM (SELECT DISTINCT item_id, {words('text')} AS want FROM benchmark)),
        docs AS MATERIALIZED (SELECT *, row_number() OVER () AS d FROM (SELECT DISTINCT doc_id, text, {words('text')} AS have FROM documents)),
        item_tokens AS (SELECT i, len(want) AS n, unnest(want) AS token, unnest(range(len(want))) AS k FROM items),
        doc_tokens AS (SELECT d, unnest(have) AS token, unnest(range(len(have))) AS pos FROM docs),
        hits AS MATERIALIZED (SELECT d, i, pos - k AS start FROM doc_tokens JOIN item_tokens USING (token)
                 GROUP BY d, i, pos - k, n HAVING count(*) >= ceil(least(n, {window}) * {share})),
        aligned AS (SELECT doc_id, text, item_id, want, start, least(len(want), {window}) AS width, list_transform(range(len(want)),
                        lambda k: CASE WHEN start + k >= 0 AND have[start + k + 1] = want[k + 1] THEN 1 ELSE 0 END) AS agree
                    FROM hits JOIN docs USING (d) JOIN items USING (i)),
        judged AS (SELECT *, list_sum(agree) AS matched, list_max(list_transform(range(len(want) - width + 1),
                       lambda j: list_sum(agree[j + 1:j + width]))) AS best_window FROM aligned),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id, text, item_id, want
                       ORDER BY best_window DESC, matched DESC, start) AS place
                   FROM judged WHERE best_window >= ceil(width * {share}))
        SELECT doc_id, item_id, len(want)::INTEGER AS item_tokens, matched::INTEGER AS matched,
               best_window::INTEGER AS best_window, start::INTEGER AS first_token
        FROM ranked WHERE place = 1"""


#: The base patterns as the contract states them.
PATTERNS = (("email", "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+"),
            ("ip", "[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)"),
            ("card", "[0-9]([\\x20-]?[0-9])+"),
            ("phone", "\\+[0-9][\\x20().0-9-]+[0-9]"))


def _located(table: str, text: str, pattern: str, carried: str, at: str = "0") -> str:
    """Rows (carried, start, end, value) of all matches of ``pattern`` in ``text``."""
    return f"""
        SELECT {carried}, {at} + coalesce(list_sum(list_transform(b[1:i], lambda x: length(x))), 0)
                   + coalesce(list_sum(list_transform(v[1:i - 1], lambda x: length(x))), 0) AS start, v[i] AS value
        FROM (SELECT *, unnest(range(1, len(v) + 1)) AS i FROM (
            SELECT *, regexp_extract_all({text}, '{pattern}') AS v, string_split_regex({text}, '{pattern}') AS b
            FROM {table}))"""


def _valid(kind: str, value: str) -> str:
    """Whether a match (an expression) is a span of its kind."""
    digits = f"regexp_replace({value}, '[^0-9]', '', 'g')"
    luhn = (f"list_sum(list_transform(string_split(reverse({digits}), ''), lambda d, n: CASE WHEN n % 2 = 1 THEN d::INTEGER "
            "WHEN d::INTEGER > 4 THEN 2 * d::INTEGER - 9 ELSE 2 * d::INTEGER END)) % 10 = 0")
    return {"email": "true", "phone": f"length({digits}) BETWEEN 9 AND 15",
            "ip": f"list_bool_and(list_transform(string_split({value}, '.'), lambda x: length(ltrim(x, '0')) <= 3 AND "
                  "coalesce(try_cast(ltrim(x, '0') AS INTEGER), 0) <= 255))",
            "card": f"CASE WHEN length({digits}) BETWEEN 13 AND 19 THEN {luhn} ELSE false END"}[kind]


def _pii(rule: Disclosure = Disclosure()) -> str:
    found = " UNION ALL ".join(
        f"SELECT r, {k} AS k, '{kind}' AS kind, start, value FROM ({_located('docs', 'text', p, 'r')}) WHERE {_valid(kind, 'value')}"
        for k, (kind, p) in enumerate(PATTERNS))
    blanks, before = [], "docs"
    for k, (kind, p) in enumerate(PATTERNS):
        gone = f"CASE WHEN {_valid(kind, 'v[i]')} THEN repeat(' ', length(v[i])) ELSE v[i] END"
        blanks.append(f"blank{k} AS MATERIALIZED (SELECT r, CASE WHEN len(v) = 0 THEN text ELSE array_to_string(list_transform("
                      f"range(1, len(b) + 1), lambda i: b[i] || CASE WHEN i <= len(v) THEN {gone} ELSE '' END), '') END AS text "
                      f"FROM (SELECT r, text, regexp_extract_all(text, '{p}') AS v, string_split_regex(text, '{p}') AS b FROM {before}))")
        before = f"blank{k}"
    words = "list_distinct(list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> ''))"
    return f"""
        WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
        spans AS MATERIALIZED (SELECT *, start + length(value) AS stop, kind || ':' || CASE WHEN kind IN ('card', 'phone')
                      THEN regexp_replace(value, '[^0-9]', '', 'g') ELSE lower(value) END AS entity FROM ({found})),
        {', '.join(blanks)},
        ents AS MATERIALIZED (SELECT DISTINCT r, text, entity FROM spans JOIN docs USING (r)),
        total AS (SELECT count(*)::DOUBLE AS n FROM docs),
        n_e AS (SELECT entity, count(*) AS n_e FROM ents GROUP BY entity HAVING count(DISTINCT text) >= {rule.support}),
        n_t AS (SELECT term, count(*) AS n_t FROM (SELECT unnest({words}) AS term FROM docs) GROUP BY term),
        known AS MATERIALIZED (SELECT ents.* FROM ents JOIN n_e USING (entity)),
        near AS (SELECT r, unnest({words}) AS term FROM {before} WHERE r IN (SELECT r FROM known)),
        n_et AS MATERIALIZED (SELECT entity, term, count(*) AS n_et FROM known JOIN near USING (r) GROUP BY ALL
                 HAVING count(DISTINCT text) >= {rule.support}),
        shares AS MATERIALIZED (SELECT entity, term, ln(n_et * n / (n_e * n_t)) / ln(n / n_e) AS share
                   FROM n_et JOIN n_e USING (entity) JOIN n_t USING (term), total WHERE n_e < n),
        marked AS (SELECT DISTINCT r, term FROM known JOIN shares USING (entity) WHERE share >= {rule.generalise}),
        places AS (SELECT w.r, start, start + length(value) AS stop FROM (
                       {_located(f'(SELECT * FROM {before} WHERE r IN (SELECT r FROM marked))', 'text', '[\\p{L}\\p{N}]+', 'r')}) w
                   JOIN marked m ON m.r = w.r AND m.term = lower(w.value)),
        base AS (SELECT r, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY k, start) AS t,
                        count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
                        count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone
                 FROM spans GROUP BY r),
        extra AS (SELECT r, string_agg('term:' || start || ':' || stop, ',' ORDER BY start) AS t FROM places GROUP BY r)
        SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
               coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base.t, '')) AS base_sha256,
               concat_ws(',', base.t, extra.t) AS spans
        FROM docs LEFT JOIN base USING (r) LEFT JOIN extra USING (r)"""


def _levels(nodes: str, name: str, levels: int) -> str:
    """CTEs of the levels ``name``_0 .. (tree, idx, n, digest) above ``nodes`` and of their runs (tree, idx, n, children)."""
    out = [f"{name}_0 AS MATERIALIZED (SELECT tree, idx, digest, count(*) OVER (PARTITION BY tree) AS n FROM {nodes})"]
    for k in range(levels):
        out.append(f"{name}_r{k} AS MATERIALIZED (SELECT tree, idx // 16 AS idx, n, list(digest ORDER BY idx) AS children "
                   f"FROM {name}_{k} GROUP BY tree, n, idx // 16)")
        out.append(f"{name}_{k + 1} AS MATERIALIZED (SELECT tree, idx, (n + 15) // 16 AS n, "
                   f"CASE WHEN n > 1 THEN sha256(array_to_string(children, '')) ELSE children[1] END AS digest FROM {name}_r{k})")
    return ", ".join(out)


def _climb(name: str, start: str, levels: int) -> str:
    """CTEs that take the rows of ``start`` (tree, idx, now, proof, ...) up the tree, level by level, to ``name``_up."""
    out, before = [], start
    for k in range(levels):
        left = "array_to_string(r.children[1:(s.idx % 16)], '')"
        right = "array_to_string(r.children[(s.idx % 16 + 2):], '')"
        after = f"{name}_up" if k == levels - 1 else f"{name}_up{k}"
        out.append(f"{after} AS MATERIALIZED (SELECT s.* REPLACE (s.idx // 16 AS idx, "
                   f"CASE WHEN r.n > 1 THEN s.proof || {left} || {right} ELSE s.proof END AS proof, "
                   f"CASE WHEN r.n > 1 THEN sha256({left} || s.now || {right}) ELSE s.now END AS now) "
                   f"FROM {before} s JOIN {name}_r{k} r ON r.tree IS NOT DISTINCT FROM s.tree AND r.idx = s.idx // 16)")
        before = after
    return ", ".join(out)


def _merkle(leaf_levels: int = 6, group_levels: int = 3) -> str:
    """The trees built and climbed level by level: up to 16^6 rows a source and 16^3 sources."""
    def leaf(text: str) -> str:
        part = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
        return f"sha256({' || '.join(part(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"

    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    bits = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, (v & 1) * 3988292384))"
    crc = (f"xor(list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT), "
           f"lambda c, b: {bits}), 4294967295)")
    return f"""
        WITH docs AS MATERIALIZED (SELECT doc_id, source, {leaf('text')} AS leaf,
                     CASE WHEN {crc} % 5 = 0 THEN {leaf(lowered)} ELSE {leaf('text')} END AS changed FROM documents),
        leaves AS MATERIALIZED (SELECT doc_id, source AS tree, leaf AS digest, changed AS now, '' AS proof,
                       row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM docs),
        {_levels('leaves', 'a', leaf_levels)},
        {_climb('a', 'leaves', leaf_levels)},
        groups AS MATERIALIZED (SELECT tree AS grp, 0 AS tree, digest, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS idx
                   FROM a_{leaf_levels}),
        {_levels('groups', 'b', group_levels)},
        inside AS MATERIALIZED (SELECT u.doc_id, u.digest AS leaf, g.digest AS subroot, g.tree, g.idx, u.now, u.proof
                   FROM a_up u JOIN groups g ON g.grp IS NOT DISTINCT FROM u.tree),
        {_climb('b', 'inside', group_levels)}
        SELECT doc_id, leaf, subroot, t.digest AS root, sha256(proof) AS proof_sha256, now AS folded_root,
               now = t.digest AS verified FROM b_up, b_{group_levels} t"""


SQL: dict[str, str] = {
    "op1_warc_boundary_chain": """
        WITH rows AS (
            SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
                   sha1(coalesce(html, '')) AS payload_digest
            FROM pages),
        marked AS (
            SELECT *, CASE WHEN payload_bytes >= 1000
                           THEN max(page_id) OVER (PARTITION BY payload_digest) END AS original
            FROM rows)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN original IS DISTINCT FROM page_id AND original IS NOT NULL
                    THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN original IS DISTINCT FROM page_id THEN original END AS refers_to
        FROM marked""",
    "op2_licence_sentence_rules": _licences(),
    "op5_pii_disclosure": _pii(),
    "op8_ngram_jaccard_join": _jaccard(),
    "op9_spaced_seed_decontamination": _decontaminate(),
    "op12_merkle_descent": _merkle(),
    "op13_digest_run_merge": """
        SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
               count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
               row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents""",
}
