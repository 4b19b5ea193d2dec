"""Main text of web pages by equivalence-class template deduction.

Tokens of a page are its elements (by their path) and all of its text blocks.
Tokens that have the same occurrence vector (the same count on every page) over
a host's pages, or over those of one of its layouts (pages with the same
elements outside the article), form an equivalence class. Classes that are
large and frequent, and that lie in order inside or around one another without
crossing, are the host's template. What a page has between template tokens are
its slots, inside an article too; the text of the slots that are article and not
menu, header, footer, sidebar, notice, advert, form or reader comment is the
main text.

Copies are no evidence: pages of one host whose articles have the same longest
block (captures and near copies of an article) count as one page, and of pages
without an article those of one URL.

Occurrence vectors are compared by a hash that is combined page by page, so a
host's pages never meet in one task; what meets is the tokens that half of the
host's or layout's pages have, a number that the length of a page bounds.
Reading pages is a narrow map before and after.

Defined results: null or empty html has an empty text; a page without a host,
or of a host with fewer than ``least_pages`` pages, has no template and is read
by its elements alone; broken markup is read as browsers do in outline (open
elements end with their parents); formulas (MathML) are text; repeated rows each get their row; ``text``
and ``n_chars`` replace columns of their names.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.llm.common import kept_fields, ready, small_side, staged

# Element names by what they do, and words of class, id and role that mark page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea noscript iframe noembed noframes xmp title svg".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp "
                   "small span strike strong sub sup time tt u var wbr math semantics mrow mi mn mo ms mtext mfrac "
                   "msqrt mroot msub msup msubsup munder mover munderover mmultiscripts mpadded mphantom menclose mstyle "
                   "merror annotation annotation-xml".split())
DROPPED = frozenset("head nav footer aside form button select dialog menu template object canvas audio video "
                    "fieldset datalist annotation annotation-xml".split()) | RAW
FURNITURE = frozenset(
    "ad ads adsense adslot banner sponsor sponsored promo promos promoted promotion cookie cookies consent gdpr notice "
    "notices notification alert popup modal overlay newsletter subscribe subscription signup sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs pagination pager footer masthead disqus reply replies respond share sharing "
    "social related recommended recommendations widget widgets toolbar login navigation contentinfo complementary "
    "search dialog".split())
#: Those of them that decide inside an article, whether or not the host's template has the element.
STRONG = frozenset(
    "ad ads adsense adslot advert adverts advertisement advertising banner sponsor sponsored promo promos promoted "
    "promotion comment comments commentlist cookie cookies consent gdpr popup modal overlay newsletter subscribe "
    "subscription signup sidebar nav navbar breadcrumb breadcrumbs pagination disqus share sharing social widget widgets login".split())
#: Of these, those that a part of the article may be about: they decide only beside words that say nothing.
UNSURE = frozenset("banner cookie cookies popup modal overlay share sharing social widget widgets login subscription signup "
                   "promotion navigation comment".split())
NEUTRAL = frozenset("area article bar block body box btn button buttons class clearfix col content container entry form footer "
                    "group header inline inner item items left lg list main md outer page panel post right row section sm "
                    "site small story text thread top bottom user users wrap wrapper xs".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FURNITURE_STARTS = ("advert", "comment", "cookie", "sidebar")
CONTENT_WORDS = frozenset("article content post entry story main".split())
CLOSED_BY = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"),
             "th": ("table", "tr"), "option": ("select",)}
SAME = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}

_TOKEN = re.compile(
    r"<!--(?:.*?--!?>|.*)"
    r"|<[!?][^>]*+>?"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*?)(?:>|\Z)"
    r"|[^<]++|<", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]++)\s*+(?:=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++))?")
_WORD = re.compile(r"[a-z0-9]+")

ARTICLE, MAIN, PLAIN = 2, 1, 0


@dataclass
class Block:
    """A run of text between block boundaries, where it stands, and whether it is page furniture."""

    text: str
    path: str
    rank: int
    dropped: bool
    linked: int = 0                                         # characters inside links
    doubts: tuple[tuple[int, bool], ...] = ()               # elements around it in the article with furniture's words


def _attributes(source: str) -> dict[str, str]:
    return {k.lower(): (v or "").strip("\"'").lower() for k, v in _ATTRIBUTE.findall(source)}


def _is_furniture(tag: str, attrs: dict[str, str], inside_article: bool) -> bool:
    """Whether an element is page furniture whatever the host's other pages have."""
    if tag in DROPPED or "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return True
    if tag == "header" and not inside_article:
        return True
    if tag in ("html", "body", "main", "article"):
        return False
    style = attrs.get("style", "").replace(" ", "")
    if "display:none" in style or "visibility:hidden" in style:
        return True
    if inside_article:
        return False
    words = _WORD.findall(" ".join((attrs.get("class", ""), attrs.get("id", ""), attrs.get("role", ""))))
    if any(w in FURNITURE or w.startswith(FURNITURE_STARTS) for w in words):
        return True
    return "header" in words and not CONTENT_WORDS & set(words)


def _doubt(tag: str, attrs: dict[str, str]) -> tuple[bool, bool]:
    """Whether an article's element may be furniture by its words, and whether they decide by themselves.

    A heading never is, and an id only as a whole.
    """
    if tag in HEADINGS or tag in ("html", "body", "main", "article"):
        return False, False
    words = _WORD.findall(attrs.get("class", "") + " " + attrs.get("role", "")) + [attrs.get("id", "").strip()]
    plain = all(w in FURNITURE or w in STRONG or w in NEUTRAL or w.isdigit() or not w for w in words)
    decides = any(w in STRONG and (plain or w not in UNSURE) for w in words)
    return any(w in FURNITURE or w in STRONG for w in words), decides


def parse(page: str) -> tuple[list[Block], list[str], list[str]]:
    """The text blocks of a page in order, the paths of its elements (inline ones left out), and those outside articles."""
    blocks: list[Block] = []
    paths: list[str] = []
    outside: list[str] = []
    # open elements: tag, path, rank, dropped, whether in a link, doubts
    stack: list[tuple[str, str, int, bool, bool, tuple]] = [("", "", PLAIN, False, False, ())]
    text: list[str] = []
    linked = 0
    at, end = 0, len(page)

    def flush() -> None:
        nonlocal linked
        if text:
            joined = " ".join(entities.unescape("".join(text)).split())
            if joined:
                _, path, rank, dropped, _, doubts = stack[-1]
                blocks.append(Block(joined, path, rank, dropped, linked, doubts))
            text.clear()
        linked = 0

    def cut(names: tuple[str, ...], stops: tuple[str, ...], inline_only: bool = False) -> None:
        for k in range(len(stack) - 1, 0, -1):
            tag = stack[k][0]
            if tag in names:
                del stack[k:]
                return
            if tag in stops or inline_only and tag not in INLINE:
                return

    while at < end:
        m = _TOKEN.match(page, at)
        at = m.end()
        tag = m.group(2)
        if tag is None:
            token = m.group()
            if token[0] != "<" or token == "<":
                text.append(token)
                if stack[-1][4]:
                    linked += len(token)
            continue
        tag = tag.lower()
        if tag not in INLINE:
            flush()
        if m.group(1):
            if tag == "br":
                continue
            if tag not in VOID and any(e[0] == tag for e in stack):
                if tag in INLINE and (stack[-1][3] or stack[-1][5]) and not text:
                    flush()
                kept = stack[-1]
                cut((tag,), ("td", "th", "table", "object") if tag not in ("td", "th", "tr", "table") else ())
                if text and (kept[3], kept[5]) != (stack[-1][3], stack[-1][5]):  # an inline element that was left out ends
                    around = stack[-1]
                    stack[-1] = kept
                    flush()
                    stack[-1] = around
            continue
        attrs = _attributes(m.group(3)) if m.group(3) else {}
        if tag not in INLINE:
            cut(("p",), (), inline_only=True)
            if tag in CLOSED_BY:
                cut(SAME.get(tag, (tag,)), CLOSED_BY[tag])
        _, path, rank, dropped, link, doubts = stack[-1]
        if tag in VOID:
            continue
        inner_drop = dropped or _is_furniture(tag, attrs, rank == ARTICLE)
        doubtful, alone = _doubt(tag, attrs) if rank == ARTICLE and attrs and not inner_drop else (False, False)
        if tag in INLINE and not doubtful:
            if inner_drop != dropped:
                flush()
            stack.append((tag, path, rank, inner_drop, link or tag == "a", doubts))
            continue
        words = _WORD.findall(attrs.get("class", "") + " " + attrs.get("id", ""))
        own = f"{path}>{tag}" + "".join("." + w for w in words)
        paths.append(own)
        if doubtful:
            doubts = (*doubts, (_token("element", own), alone))
        if tag in INLINE:
            flush()
            stack.append((tag, path, rank, inner_drop, link or tag == "a", doubts))
            continue
        path = own
        if rank < ARTICLE:
            outside.append(path)
        if tag in RAW:
            stop = re.compile(f"</{tag}[^>]*+>?", re.I).search(page, at)
            at = stop.end() if stop else end
            continue
        if tag == "article" or attrs.get("itemprop") == "articlebody":
            rank = ARTICLE
        elif rank == PLAIN and (tag == "main" or attrs.get("role") == "main" or CONTENT_WORDS & set(words)):
            rank = MAIN
        stack.append((tag, path, rank, inner_drop, link, doubts))
    flush()
    return blocks, paths, outside


def _token(kind: str, path: str, text: str = "") -> int:
    return xxhash.xxh64_intdigest(f"{kind}\0{path}\0{text}".encode()) - (1 << 63)


def page_tokens(blocks: list[Block], paths: list[str]) -> dict[int, tuple[int, int]]:
    """Every template candidate of a page: how often it occurs, and its first place."""
    out: dict[int, tuple[int, int]] = {}
    for k, token in enumerate([*(_token("element", p) for p in paths), *(_token("text", b.path, b.text) for b in blocks)]):
        n, first = out.get(token, (0, k))
        out[token] = (n + 1, first)
    return out


def identity(blocks: list[Block], url: str) -> int:
    """What a page shares with its copies: its article's longest block, or its URL if it has no article."""
    own = max((b.text for b in blocks if b.rank == ARTICLE and not b.dropped), key=len, default=None)
    return _token("page", url) if own is None else _token("article", "", own)


def deduce(tokens: list[tuple[int, int, int, float]], least_tokens: int) -> list[int]:
    """The template among (token, vector, support, place): valid equivalence classes of enough tokens.

    Classes are taken from the largest down; one whose places cross a class
    that was taken before (it lies neither in one gap of it nor around it) is
    not valid. A frequent class of one token is valid as a leaf.
    """
    classes: dict[tuple[int, int], list[tuple[float, int]]] = defaultdict(list)
    for token, vector, support, place in tokens:
        classes[vector, support].append((place, token))
    taken: list[list[float]] = []
    out: list[int] = []
    for (_, support), members in sorted(classes.items(), key=lambda c: (-len(c[1]), -c[0][1], c[0][0])):
        members.sort()
        places = [p for p, _ in members]
        if len(members) >= least_tokens and all(_nested(places, other) for other in taken):
            taken.append(places)
            out += [t for _, t in members]
    return out


def _nested(inner: list[float], outer: list[float]) -> bool:
    """Whether ``inner`` lies in one gap of ``outer``, before, behind or around it."""
    low, high = inner[0], inner[-1]
    return not any(low < p < high for p in outer) or not any(outer[0] < p < outer[-1] for p in inner)


def main_text(blocks: list[Block], template: frozenset[int]) -> str:
    """The text of a page's article slots, one space between blocks.

    Inside an article, an element is furniture if its words of class, id and
    role say so by themselves (comments, adverts), on every page; if they only
    may, it is where the template has the element. Text of the template is
    left out whatever its words are.
    """
    kept = [b for b in blocks if not b.dropped
            and not any(alone or token in template for token, alone in b.doubts)]
    best = max((b.rank for b in kept), default=PLAIN)
    slots = [b for b in kept if b.rank == best and not (template and _token("text", b.path, b.text) in template)]
    if best == PLAIN:
        slots = [b for b in slots if 2 * b.linked <= len(b.text)]
    return " ".join(b.text for b in slots)


def host_of(url: Column) -> Column:
    """The host of a URL in lower case (null if there is none)."""
    host = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]+)", 1)
    return F.nullif(F.lower(host), F.lit(""))


def templates(pages: DataFrame, html_col: str = "html", least_pages: int = 3, least_tokens: int = 2) -> DataFrame:
    """Stage table (host, template): the tokens of each host's template."""
    ready(pages.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, layouts, tokens, counts, places, each = [], [], [], [], [], []
            for host, page, url in zip(*(batch.column(k).to_pylist() for k in range(3))):
                blocks, paths, outside = parse(page or "")
                own = identity(blocks, url)
                layout = _token("layout", "\0".join(sorted(set(outside))))
                found = page_tokens(blocks, paths)
                for part in (0, layout):                    # 0: the whole host
                    hosts += [host] * len(found)
                    layouts += [part] * len(found)
                    tokens += found
                    counts += [n for n, _ in found.values()]
                    places += [first for _, first in found.values()]
                    each += [own] * len(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(layouts, pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array(counts, pa.int32()), pa.array(places, pa.int32()), pa.array(each, pa.int64())],
                names=["host", "layout", "token", "n", "place", "page"])

    rows = pages.select(host_of(F.col("url")).alias("host"), F.col(html_col), "url").where("host IS NOT NULL")
    tokens = rows.mapInArrow(read, "host string, layout long, token long, n int, place int, page long")
    # Copies of a page count once; a page without any token is of no host or layout.
    tokens = staged(tokens.groupBy("host", "layout", "token", "page")
                    .agg(F.max("n").alias("n"), F.min("place").alias("place")), "tokens")
    size = (tokens.groupBy("host", "layout", "page").agg(F.lit(1).alias("one"))
            .groupBy("host", "layout").agg(F.count("*").alias("pages")).where(F.col("pages") >= least_pages))
    vectors = (tokens.groupBy("host", "layout", "token")
               .agg(F.bit_xor(F.xxhash64("page", "n")).alias("vector"), F.count("*").alias("support"),
                    F.avg("place").alias("place")).where(F.col("support") >= least_pages))
    frequent = vectors.join(size, ["host", "layout"]).where(2 * F.col("support") >= F.col("pages")).drop("pages")

    def template(key: tuple, group: pa.Table) -> pa.Table:
        found = deduce(list(zip(*(group[c].to_pylist() for c in ("token", "vector", "support", "place")))), least_tokens)
        return pa.table({"host": pa.array([key[0].as_py()]), "template": pa.array([sorted(found)], pa.list_(pa.int64()))})

    found = frequent.groupBy("host", "layout").applyInArrow(template, "host string, template array<long>")
    every = F.array_sort(F.array_distinct(F.flatten(F.collect_list("template"))))
    return staged(found.groupBy("host").agg(every.alias("template")), "templates")


def extract(pages: DataFrame, html_col: str = "html", keep: Sequence[str] | None = None,
            least_pages: int = 3) -> DataFrame:
    """``pages``' ``keep`` columns (all but the html if None) with ``text`` and ``n_chars`` (its code points)."""
    kept = [f for f in kept_fields(pages, keep, ["text", "n_chars"]) if keep is not None or f.name != html_col]
    names = [f.name for f in kept]
    found = templates(pages, html_col, least_pages)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(parse(page or "")[0], frozenset(template or ()))
                     for page, template in zip(*(batch.column(k).to_pylist() for k in (len(names), len(names) + 1)))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(len(names))), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=[*names, "text", "n_chars"])

    other = small_side(found).withColumnsRenamed({"host": "__host", "template": "__template"})
    rows = pages.join(other, host_of(F.col("url")) == F.col("__host"), "left").select(
        *names, F.col(html_col).alias("__html"), "__template")
    return rows.mapInArrow(read, T.StructType([*kept, T.StructField("text", T.StringType()),
                                               T.StructField("n_chars", T.LongType())]))
