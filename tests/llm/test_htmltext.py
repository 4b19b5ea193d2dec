import pytest

from docflow.llm import htmltext
from docflow.llm.htmltext import deduce, main_text, parse
from tests.conftest import SF_SMALL


def text_of(page):
    return main_text(parse(page)[0], frozenset())


@pytest.mark.parametrize("page, text", [
    ("<article><h1>A &amp; B</h1><p>c\n d&nbsp;e</p></article>", "A & B c d e"),
    ("<nav>menu</nav><article><p><b>One<br><p>two <i>th</i>ree</article><footer>&copy; x", "One two three"),
    ("<article>a<aside>side</aside><div class='ad'>buy</div>b<form>f<input></form>c<script>x<p>y</script>d</article>",
     "a b c d"),
    ("<article>t<section id='comments'><p>first!</p></section><div class=comment-list>me too</div></article>", "t"),
    ("<header><h1>Site</h1></header><article><header><h1>Title</h1></header><p>body</p></article>", "Title body"),
    ("<body><div class='cookie-notice'>ok?</div><main><p>text</p></main><div role=contentinfo>foot</div>", "text"),
    ("<div class=sidebar><p>s</div><div class='post content'><p>kept</div>", "kept"),
    ("<p>plain</p><p>page</p>", "plain page"),
    ("<article><p>1 &lt; 2 &#233; &#x41; &unknown; &amp</p></article>", "1 < 2 é A &unknown; &"),
    ("<article><!-- no --><p title='a > b'>yes</p><p hidden>no</p><style>p{}</style></article>", "yes"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a b c d"),
    ("<article><p>cut <b", "cut"), ("<article><p>x</p", "x"), ("", ""), ("no markup", "no markup"), ("a < b", "a < b"),
    ("<article><span class=advert>no</span>yes <span>and</span> this</article>", "yes and this"),
    ("<article><p>unclosed <em>x<p>next</article><p>outside", "unclosed x next"),
    ("<ARTICLE><P>UP</P></ARTICLE>", "UP"), ("<article>a</article><article>b</article>", "a b"),
    ("<article><p>　wide space x </p></article>", "wide space x"),
    ("<article><script>never closed <p>x", ""), ("<article><p>a\x00b</p></article>", "a\x00b")])
def test_main_text(page, text):
    assert text_of(page) == text


def test_odd_markup_takes_linear_time():
    import time
    for page in ("<a href='" * 20_000, "<p \"" * 20_000, "<" * 50_000, "<!--" * 20_000, "<div>" * 3000 + "x",
                 "<![x" * 20_000, "&" * 50_000, "</p>" * 20_000):
        t0 = time.perf_counter()
        text_of(page)
        assert time.perf_counter() - t0 < 10, page[:10]


def test_classes_must_nest():
    outer = [(1, 11, 5, 0.0), (2, 11, 5, 10.0), (3, 11, 5, 20.0)]
    inside = [(4, 12, 4, 3.0), (5, 12, 4, 5.0)]
    crossing = [(6, 13, 4, 8.0), (7, 13, 4, 15.0)]
    lone = [(8, 14, 4, 1.0)]
    assert sorted(deduce([*outer, *inside, *crossing, *lone], 2)) == [1, 2, 3, 4, 5]


def host_pages(n, host="site.example"):
    page = ("<html><body><div>Site name</div><ul><li><a href=/>Home</a></ul><div><p>{}</p><p>{}</p></div>"
            "<div>All rights reserved</div></body></html>")
    return [(k, f"http://{host}/{k}", page.format(f"Story {k} begins here", f"and {k} ends")) for k in range(n)]


def test_template_text_of_a_host_goes(spark):
    rows = [*host_pages(6), *((100 + i, u, h) for i, u, h in host_pages(1, "other.example")),
            (200, None, "<div>Site name</div><p>free</p>")]
    pages = spark.createDataFrame([(*r, "t", 3) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = {r["page_id"]: r for r in htmltext.extract(pages).collect()}
    assert set(got[0].asDict()) == {"page_id", "url", "text", "n_chars"}
    for k in range(6):
        assert got[k]["text"] == f"Story {k} begins here and {k} ends" and got[k]["n_chars"] == len(got[k]["text"])
    assert got[100]["text"].startswith("Site name Story 0")  # one page of a host: no template
    assert got[200]["text"] == "Site name free"


def test_article_text_that_repeats_stays(spark):
    rows = [(k, "http://a.example/x", f"<nav>m</nav><article><p>same words</p><p>{k % 2}</p></article>") for k in range(8)]
    got = htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted(r["text"] for r in got) == ["same words 0"] * 4 + ["same words 1"] * 4


def test_edges(spark):
    rows = [(1, "http://a/x", None), (1, "http://a/x", None), (None, None, "<p>x</p>"), (2, "", ""), (3, "no url", "<p>y"),
            (4, "http://a/z", "<article>" + "<p>long text</p>" * 40_000 + "</article>")]
    got = htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), keep=["page_id"]).collect()
    assert sorted((str(r["page_id"]), r["text"][:9], r["n_chars"]) for r in got) == sorted([
        ("1", "", 0), ("1", "", 0), ("None", "x", 1), ("2", "", 0), ("3", "y", 1), ("4", "long text", 40_000 * 10 - 1)])
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert htmltext.extract(empty).collect() == []


def test_small_table(spark):
    import html
    import re
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    source = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in htmltext.extract(pages).collect():
        body = re.search(r"<article>(.*?)(</article>|\Z)", source[r["page_id"]], re.S).group(1)
        blocks = (" ".join(html.unescape(b.replace("<b>", "").replace("</b>", "")).split())
                  for b in re.split(r"</?(?:p|br|h1)>", body))
        assert r["text"] == " ".join(b for b in blocks if b)


def test_furniture_inside_the_article_goes(spark):
    """Text that a host, or one of its layouts, has on all pages is template inside the article too."""
    page = ("<html><body><nav>m</nav>{side}<article><h1>Title {k}</h1><div class=b7>Written by our staff</div>"
            "<p>Body {k} tells what only this page tells</p>{box}<p>End {k}</p></article></body></html>")
    rows = [(k, f"http://a.example/{k}", page.format(
        k=k, side="<div class=map>x</div>" if k >= 16 else "",
        box="<div class=q3><p>Read more on the map</p></div>" if k >= 16 else "")) for k in range(20)]
    got = {r["page_id"]: r["text"] for r in
           htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {k: f"Title {k} Body {k} tells what only this page tells End {k}" for k in range(20)}


def test_copies_of_an_article_are_no_template(spark):
    page = "<article><h1>News</h1><p>The same long paragraph on every copy</p><p>Printed {}</p></article>"
    rows = [(k, f"http://a.example/n?ref={k}", page.format(k)) for k in range(6)]
    got = htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["text"] for r in got} == {f"News The same long paragraph on every copy Printed {k}" for k in range(6)}


@pytest.mark.parametrize("page, text", [
    ("<article><h2 id='related-work'>Related work</h2><h2 class='search'>Search</h2></article>", "Related work Search"),
    ("<article><section id='search-algorithms'>a</section><section id='menu-design'>b</section></article>", "a b"),
    ("<article><h2 id='cookie-recipe'>c</h2><div class='commentary'>d</div><div class='footer-note reply'>e</div></article>",
     "c d e"),
    ("<article><p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</article>", "so x=2 holds"),
    ("<div class='footer-note reply'>no</div><div id='search-box'>no</div><article>f</article>", "f")])
def test_words_are_candidates_inside_an_article(page, text):
    assert text_of(page) == text


def test_candidates_go_where_the_host_has_them(spark):
    page = ("<body><nav>m</nav><article><h1>Title {0}</h1><p>Body {0} of this page</p><span class=reply>Answer {0}</span>"
            "<div class=notice><b>Read</b> {0} of 20</div>{1}</article></body>")
    rows = [(k, f"http://a.example/{k}", page.format(k, "<div class='alert'>An alert</div>" if k == 3 else ""))
            for k in range(8)]
    got = {r["page_id"]: r["text"] for r in
           htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {k: f"Title {k} Body {k} of this page" + " An alert" * (k == 3) for k in range(8)}


def test_comments_adverts_and_forms_go_on_every_page(spark):
    """A host of eight pages of which two have comments, and one an advert or a form, inside the article."""
    page = "<body><nav>m</nav><article><h1>Title {0}</h1><p>Body {0} of this page</p>{1}</article></body>"
    extra = {2: "<section class='comments'><p>first!</p></section>", 5: "<div class='comment-list'><p>me too</p></div>",
             6: "<div class='ad advert-box'>Buy</div>", 7: "<form><p>Your name</p></form>",
             1: "<div class='cookie-recipe'>Mix it</div>", 3: "<p class='commentary'>Seen</p>"}
    rows = [(k, f"http://a.example/{k}", page.format(k, extra.get(k, ""))) for k in range(8)]
    got = {r["page_id"]: r["text"] for r in
           htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {k: f"Title {k} Body {k} of this page" + {1: " Mix it", 3: " Seen"}.get(k, "") for k in range(8)}


def plain_templates(rows, least_pages=3, least_tokens=2):
    """host -> template tokens, with whole occurrence vectors kept in one place."""
    out = {}
    for host in {h for h, _, _ in rows}:
        pages = {}
        for _, url, page in (r for r in rows if r[0] == host):
            blocks, paths, outside = parse(page)
            counts = {t: list(v) for t, v in htmltext.page_tokens(blocks, paths).items()}
            for part in (None, tuple(sorted(set(outside)))):
                known = pages.setdefault(part, {}).setdefault(htmltext.identity(blocks, url), {})
                for t, (n, first) in counts.items():
                    old = known.get(t, (0, first))
                    known[t] = (max(n, old[0]), min(first, old[1]))
        found = set()
        for part, group in pages.items():
            group = {i: t for i, t in group.items() if t}
            if len(group) < least_pages:
                continue
            classes = {}
            for t in {t for g in group.values() for t in g}:
                on = {i: g[t] for i, g in group.items() if t in g}
                if len(on) >= least_pages and 2 * len(on) >= len(group):
                    vector = tuple(sorted((i, n) for i, (n, _) in on.items()))
                    classes.setdefault(vector, []).append((sum(f for _, f in on.values()) / len(on), t))
            taken = []
            for vector, members in sorted(classes.items(), key=lambda c: (-len(c[1]), -len(c[0]))):
                spots = sorted(p for p, _ in members)
                low, high = spots[0], spots[-1]
                apart = all(not any(low < p < high for p in o) or not any(o[0] < p < o[-1] for p in spots) for o in taken)
                if len(members) >= least_tokens and apart:
                    taken.append(spots)
                    found |= {t for _, t in members}
        out[host] = found
    return out


def test_deduction_against_plain_python(spark):
    import random
    rng, rows = random.Random(11), []
    for h in range(5):
        for k in range(rng.randrange(2, 12)):
            side = "<div class=s><p>Latest</p><p>Top</p></div>" if k % 3 else ""
            box = "<div class=q><p>By our staff</p><p>All rights</p></div>" if h % 2 else ""
            late = "<div class=z><p>More like this</p><p>Read on</p></div>" if k % 4 == 1 else ""
            page = f"<body><div class=t><p>Site {h}</p></div>{side}<article><h1>T {h} {k}</h1>{box}<p>Words {rng.random()}</p>{late}</article></body>"
            rows += [(f"h{h}.example", f"http://h{h}.example/{k}", page)] * rng.choice((1, 1, 2))
    pages = spark.createDataFrame(rows, "host string, url string, html string")
    got = {r["host"]: set(r["template"]) for r in htmltext.templates(pages).collect()}
    want = plain_templates(rows)
    assert {h: got.get(h, set()) for h in want} == want and any(want.values())
    with_template = {r["url"]: r["text"] for r in htmltext.extract(pages).collect()}
    alone = {u: text_of(page) for _, u, page in rows}
    differ = [u for u in alone if alone[u] != with_template[u]]
    assert differ and all("All rights" in alone[u] and "All rights" not in with_template[u] for u in differ if "//h1" in u or "//h3" in u)
