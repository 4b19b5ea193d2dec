"""Personal data and the terms that give it away, in SQL functions only.

Base spans (email, ip, card, phone) are leftmost, non-overlapping matches of
fixed patterns, checked by their digits. Information-theoretic sanitisation
adds the terms that disclose a protected entity: over all documents it counts
how many hold an entity, how many hold a term, and how many hold both. The
share of the entity's information that a term gives away is
PMI(entity; term) / IC(entity) = ln(n_et N / (n_e n_t)) / ln(N / n_e). In every
document with the entity all occurrences of terms at or above ``generalise``
become ``[TERM]``, and of those at or above ``remove`` nothing.

Terms are all words of letters and digits, of any length, that stand outside
the spans (spans are blanked out, kind by kind, before words are looked for).
Counts are over all rows. Entities and pairs count as evidence only if they
occur in ``support`` different texts: copies of one text show nothing.

Entities that occur in the same documents share their counts, and so do
terms; pairs are counted between such classes, so a list of contacts with its
copies is one pair and not all pairs of its names. A term must be rare enough
for its class to pass the threshold at all, so common words meet no entity.
Positions are running sums in blocks, not sums from the start: the time for a
text grows with its length and little more.

Defined results: a null or empty text has no spans; equal rows get equal
spans; other columns of ``sanitise`` pass through, whatever their names;
positions are code points, end exclusive; spans that overlap are replaced from
the left.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import small_side, staged

#: The kinds in order, with their patterns. Possessive forms of the
#: base patterns (no class can give a character back to what follows it), started
#: only where a run of the first class begins or the match before ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must match for its kind to be looked for at all (cheaper than the pattern).
HINTS = {"email": r"@", "ip": r"[0-9]\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]"}
KINDS = tuple(PATTERNS)
SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"


WORD = r"[\p{L}\p{N}]++"
#: Values that are added up together for positions, and code points of a text that are looked at together.
BLOCK, CHUNK = 128, 2048


@dataclass(frozen=True)
class Disclosure:
    """Different texts needed as evidence, and the thresholds."""

    support: int = 2
    generalise: float = 0.8
    remove: float = 0.95


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once."""
    return F.transform(F.array(value), use).getItem(0)


def running(values: Column, join: Callable[[Column, Column], Column] = lambda a, b: a + b) -> Column:
    """For each value of an array what ``join`` makes of those before it (0 before the first), block by block."""
    zero = F.lit(0)
    folded = lambda part: F.aggregate(part, zero, join)

    def cut(every: Column) -> Column:
        last = F.greatest(F.floor((F.size(every) - 1) / BLOCK), F.lit(0)).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(every, b * BLOCK + 1, F.lit(BLOCK)))

    def spread(parts: Column) -> Column:
        totals = F.transform(parts, folded)
        before = let(totals, lambda t: F.transform(F.sequence(F.lit(1), F.size(t)), lambda k: folded(F.slice(t, F.lit(1), k - 1))))
        inside = lambda part, base: F.transform(part, lambda _, k: join(base, folded(F.slice(part, F.lit(1), k))))
        return F.flatten(F.zip_with(parts, before, inside))

    return let(let(values, cut), spread)


def _matches(text: Column, pattern: str) -> Column:
    """(b, v): every match of ``pattern`` with the text before it, and at the end (rest, null)."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.zip_with(F.split(text, pattern, -1), found, lambda b, v: F.struct(b.alias("b"), v.alias("v")))


def located(text: Column, pattern: str) -> Column:
    """All matches of ``pattern`` with their code-point positions."""
    width = lambda p: F.length(p["b"]) + F.coalesce(F.length(p["v"]), F.lit(0))

    def place(p: Column, at: Column) -> Column:
        begin = at + F.length(p["b"])
        return F.struct(begin.alias("start"), (begin + F.length(p["v"])).alias("end"), p["v"].alias("value"))

    placed = let(_matches(text, pattern), lambda pairs: F.zip_with(pairs, running(F.transform(pairs, width)), place))
    return F.filter(placed, lambda s: s["value"].isNotNull())


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        def small(part: Column) -> Column:
            bare = F.regexp_replace(part, "^0+(?=[0-9])", "")
            return F.when(F.length(bare) <= 3, bare.cast("int") <= 255).otherwise(False)
        return F.forall(F.split(value, r"\."), small)
    n = F.length(_digits(value))
    if kind == "card":
        return F.when(n.between(13, 19), _luhn(_digits(value))).otherwise(False)
    return n.between(9, 15) if kind == "phone" else F.lit(True)


def _kind_spans(text: Column, kind: str) -> Column:
    spans = F.filter(located(text, PATTERNS[kind]), lambda s: _valid(kind, s["value"]))
    named = F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"),
                                                  s["end"].alias("end"), s["value"].alias("value")))
    return F.when(text.rlike(HINTS[kind]), named).otherwise(F.array().cast(SPAN))


def base_spans(text: Column) -> Column:
    """The base spans of a text, by kind as listed and then by place."""
    return F.concat(*(_kind_spans(text, kind) for kind in KINDS))


def _entity(span: Column) -> Column:
    """What a span protects: the same entity however it is written."""
    plain = F.when(span["kind"].isin("card", "phone"), _digits(span["value"])).otherwise(F.lower(span["value"]))
    return F.concat_ws(":", span["kind"], plain)


def blanked(text: Column) -> Column:
    """The text with blanks in place of its spans, kind by kind (its length stays)."""
    def without(kind: str) -> Callable[[Column], Column]:
        def part(p: Column) -> Column:
            gone = F.when(_valid(kind, p["v"]), F.repeat(F.lit(" "), F.length(p["v"]))).otherwise(p["v"])
            return F.concat(p["b"], F.coalesce(gone, F.lit("")))
        return lambda t: F.when(t.rlike(HINTS[kind]), F.array_join(F.transform(_matches(t, PATTERNS[kind]), part), "")).otherwise(t)

    for kind in KINDS:
        text = let(text, without(kind))
    return text


def _words(text: Column) -> Column:
    """The distinct lower-case words of a text."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != ""))


def scan(docs: DataFrame) -> DataFrame:
    """Stage table (doc_id, text_hash, spans) of every row of ``docs`` (doc_id, text)."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return staged(rows.select("doc_id", F.xxhash64("text").alias("text_hash"), base_spans(F.col("text")).alias("spans")), "spans")


def _named(rows: DataFrame, taken: Sequence[str], *columns: str) -> tuple[DataFrame, dict[str, str]]:
    """``rows`` with ``columns`` renamed so that no name in ``taken`` is met, and the new names."""
    names = {}
    for c in columns:
        name = f"their_{c}"
        while name in taken:
            name += "_"
        names[c] = name
    return rows.select(*(F.col(c).alias(n) for c, n in names.items())), names


def _meet(docs: DataFrame, rows: DataFrame, *columns: str, how: str = "inner") -> tuple[DataFrame, dict[str, str]]:
    """``docs`` joined with ``rows`` by id (or none) and text; ``columns`` are added under new names."""
    other, names = _named(rows, docs.columns, "doc_id", "text_hash", *columns)
    text = F.coalesce(F.col("text"), F.lit(""))
    same = F.col("doc_id").eqNullSafe(F.col(names["doc_id"])) & (F.xxhash64(text) == F.col(names["text_hash"]))
    return docs.join(small_side(other), same, how), names


def disclosing(docs: DataFrame, scanned: DataFrame, rule: Disclosure = Disclosure()) -> DataFrame:
    """Stage table (doc_id, text_hash, term, disclosure): the terms that give away an entity of their document."""
    total = max(1, scanned.count())
    key = F.xxhash64("doc_id", "text_hash").alias("key")
    held = (scanned.where(F.size("spans") > 0)
            .select(key, "doc_id", "text_hash", F.explode(F.array_distinct(F.transform("spans", _entity))).alias("entity"))
            .groupBy("key", "doc_id", "text_hash", "entity").agg(F.count("*").alias("m")))
    held = staged(held, "entities")
    texts = held.groupBy("entity", "text_hash").agg(F.sum("m").alias("m"), F.bit_xor("key").alias("rows"))
    known = staged(texts.groupBy("entity").agg(F.sum("m").alias("n_e"), F.count("*").alias("texts"), F.bit_xor("rows").alias("e"))
                   .where((F.col("texts") >= rule.support) & (F.col("n_e") < total)).drop("texts"), "known")
    # e, t: the classes of entities and of terms, each a hash of the documents they are in
    rows_e = staged(held.join(small_side(known), "entity").select("key", "doc_id", "text_hash", "m", "e", "n_e").distinct(), "rows-e")
    wanted = staged(rows_e.select("doc_id", "text_hash").distinct(), "wanted")
    met, names = _meet(docs.select("doc_id", "text"), wanted)
    terms = met.select(F.xxhash64("doc_id", names["text_hash"]).alias("key"), F.explode(_words(blanked(F.col("text")))).alias("term")).distinct()
    terms = staged(terms, "terms")
    most = rows_e.agg(F.max("n_e")).first()[0] or 0
    repeated = terms.groupBy("term").agg(F.bit_xor("key").alias("t"), F.count("*").alias("rows")).where(F.col("rows") >= rule.support)
    counts = docs.select(F.explode(_words(F.coalesce("text", F.lit("")))).alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
    cap = lambda n_e: F.greatest(n_e, total * F.pow(n_e / F.lit(total), F.lit(rule.generalise))) * 1.000001
    info = staged(repeated.select("term", "t").join(counts, "term").where(F.col("n_t") <= cap(F.lit(float(most)))), "term-counts")
    rows_t = staged(terms.join(small_side(info), "term").select("key", "term", "t", "n_t"), "rows-t")
    both = rows_e.join(rows_t.select("key", "t", "n_t").distinct(), "key").where(F.col("n_t") <= cap(F.col("n_e")))
    per_text = both.groupBy("e", "n_e", "t", "n_t", "text_hash").agg(F.sum("m").alias("m"))
    pairs = per_text.groupBy("e", "n_e", "t", "n_t").agg(F.sum("m").alias("n_et"), F.count("*").alias("texts"))
    share = (F.log(F.col("n_et") * F.lit(float(total)) / (F.col("n_e") * F.col("n_t")))
             / F.log(F.lit(float(total)) / F.col("n_e")))
    pairs = staged(pairs.where(F.col("texts") >= rule.support).select("e", "n_e", "t", "n_t", share.alias("disclosure"))
                   .where(F.col("disclosure") >= rule.generalise), "pairs")
    found = rows_e.join(small_side(pairs), ["e", "n_e"]).join(rows_t, ["key", "t", "n_t"])
    return staged(found.groupBy("doc_id", "text_hash", "term").agg(F.max("disclosure").alias("disclosure")), "disclosing")


def term_spans(docs: DataFrame, found: DataFrame, rule: Disclosure = Disclosure()) -> DataFrame:
    """(doc_id, text_hash, terms): the places of the disclosing terms in each document that has some."""
    wanted = staged(found.select("doc_id", "text_hash").distinct(), "marked")
    met, names = _meet(docs.select("doc_id", "text"), wanted)
    words = met.select("doc_id", F.col(names["text_hash"]).alias("text_hash"), F.explode(located(blanked(F.col("text")), WORD)).alias("w"))
    words = words.select("doc_id", "text_hash", F.lower("w.value").alias("term"), "w.start", "w.end").distinct()
    marks = found.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), F.col("term").alias("mark"), "disclosure")
    here = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")) & (F.col("term") == F.col("mark"))
    kind = F.when(F.col("disclosure") >= rule.remove, "removed").otherwise("term")
    return (words.join(marks, here).groupBy("doc_id", "text_hash")
            .agg(F.sort_array(F.collect_list(F.struct("start", "end", kind.alias("kind")))).alias("terms")))


def _extra(docs: DataFrame, scanned: DataFrame, rule: Disclosure) -> DataFrame:
    return staged(term_spans(docs, disclosing(docs, scanned, rule), rule), "term-spans")


def find(docs: DataFrame, rule: Disclosure = Disclosure()) -> DataFrame:
    """(doc_id, text_hash, spans, terms) of every row: base spans, and the terms that disclose them (null: none)."""
    scanned = scan(docs)
    other, names = _named(_extra(docs, scanned, rule), scanned.columns, "doc_id", "text_hash", "terms")
    same = F.col("doc_id").eqNullSafe(F.col(names["doc_id"])) & (F.col("text_hash") == F.col(names["text_hash"]))
    return scanned.join(small_side(other), same, "left").select("doc_id", "text_hash", "spans", F.col(names["terms"]).alias("terms"))


def _cut(text: Column, spans: Column) -> Column:
    """``text`` with its sorted spans (start, end, kind) replaced; one that overlaps those before it only widens the gap."""
    def piece(chunks: Column, start: Column, end: Column) -> Column:
        first = F.floor(start / CHUNK).cast("int")
        near = F.array_join(F.slice(chunks, first + 1, F.floor(end / CHUNK).cast("int") - first + 1), "")
        return F.when(end > start, F.substring(near, start - first * CHUNK + 1, end - start)).otherwise("")

    def replaced(chunks: Column) -> Column:
        def part(s: Column, before: Column) -> Column:
            word = F.when(s["kind"] == "removed", "").otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
            return F.when(s["start"] >= before, F.concat(piece(chunks, before, s["start"]), word)).otherwise("")

        def whole(every: Column) -> Column:
            ends = F.transform(every, lambda s: s["end"])
            tail = piece(chunks, F.array_max(ends), F.length(text))
            return F.concat(F.array_join(F.zip_with(every, running(ends, lambda a, b: F.greatest(a, b)), part), ""), tail)

        return let(spans, whole)

    return let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)), replaced)


def sanitise(docs: DataFrame, rule: Disclosure = Disclosure(), text_col: str = "text") -> DataFrame:
    """``docs`` with every base span replaced by its kind, disclosing terms by ``[TERM]`` or by nothing."""
    read = docs.select("doc_id", F.col(text_col).alias("text"))
    extra = _extra(read, scan(read), rule)
    other, names = _named(extra, docs.columns, "doc_id", "text_hash", "terms")
    text = F.coalesce(F.col(text_col), F.lit(""))
    same = F.col("doc_id").eqNullSafe(F.col(names["doc_id"])) & (F.xxhash64(text) == F.col(names["text_hash"]))
    rows = docs.join(small_side(other), same, "left")
    none = F.array().cast("array<struct<start:int,end:int,kind:string>>")
    base = F.transform(base_spans(text), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    spans = F.array_sort(F.concat(base, F.coalesce(names["terms"], none)))
    whole = let(spans, lambda every: F.when(F.size(every) > 0, _cut(text, every)).otherwise(F.col(text_col)))
    return rows.withColumn(text_col, whole).select(*docs.columns)


def described(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of the base spans, and all spans as text."""
    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = joined(F.col("spans"))
    extra = F.transform("terms", lambda s: F.struct(F.lit("term").alias("kind"), s["start"].alias("start"),
                                                    s["end"].alias("end")))
    every = F.concat_ws(",", F.nullif(base, F.lit("")), joined(extra))
    return found.select("doc_id", *(count(k) for k in KINDS), F.sha2(base.cast("binary"), 256).alias("base_sha256"),
                        every.alias("spans"))
