import hashlib
import math
import random
import re
from collections import Counter

import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docflow.llm import pii
from tests.llm.plain import EDGE_DOCS, PII, _holds, pii_spans

TEXTS = [
    "mail a.b@c.de, ip 1.2.3.4 and 1.2.3.4.5.6.7.8 and 300.1.1.1 and 010.020.030.040",
    "x@y.z@w.v a@b.c_x@y.z @a.b a@b a@b. éa@b.cé +a@b.c",
    "4111 1111 1111 1111 and 4111-1111-1111-1111-2 4111111111111111 1234567890123 0000000000000",
    "+1 (017) 555-7713 +49 30 1234567. +1 23 + 1234567890 +123456789012345678 ++12345678901",
    "12345678901234567890123 5 5 5 5 5 5 5 5 5 5 5 5 5", "Ω+49 170 1234567 中a@b.c文 1.1.1.1", "a@b.c" * 300,
    "1 " * 6000 + "9" * 6000, "1.1.1.1." * 500, "." * 3000 + "@" * 50, "9.9.9.999999999999999999999999999999",
]


def got_spans(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    rows = df.select("k", pii.base_spans(F.coalesce("text", F.lit(""))).alias("s")).collect()
    return {r["k"]: [(s["kind"], s["start"], s["end"]) for s in r["s"]] for r in rows}


def test_base_spans(spark):
    texts = [*TEXTS, *(t for _, t in EDGE_DOCS)]
    assert got_spans(spark, texts) == {k: pii_spans(t) for k, t in enumerate(texts)}


def test_random_texts(spark):
    rng = random.Random(1)
    parts = ["a", "b.", "@", "1", "22", "255", ".", "-", " ", "+", "(", ")", "_", "é", "4111111111111111", "\n", "%"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 60))) for _ in range(3000)]
    assert got_spans(spark, texts) == {k: pii_spans(t) for k, t in enumerate(texts)}


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab.@1-+_% é"), max_size=25))
def test_run_starts_lose_no_match(text):
    """Starting only at run starts or behind a match finds the same emails and addresses."""
    for kind, run in (("email", "[A-Za-z0-9._%+-]"), ("ip", "[0-9]")):
        plain = [m.span() for m in re.finditer(PII[kind], text)]
        ends, found = 0, []
        for m in re.finditer(PII[kind], text):
            before = text[m.start() - 1:m.start()]
            assert m.start() == ends or not re.fullmatch(run, before)
            ends = m.end()
            found.append(m.span())
        assert found == plain


def blanked(text):
    for kind in PII:
        text = re.sub(PII[kind], lambda m: " " * len(m[0]) if _holds(kind, m[0]) else m[0], text)
    return text


WORD = regex.compile(r"[\p{L}\p{N}]+")


def disclosures(texts, rule):
    """The places of disclosing terms, in plain Python over whole documents."""
    entity = lambda k, v: f"{k}:{re.sub('[^0-9]', '', v) if k in ('card', 'phone') else v.lower()}"
    terms_of = [set(WORD.findall(blanked(t).lower())) for t in texts]
    ents_of = [{entity(k, t[a:b]) for k, a, b in pii_spans(t)} for t in texts]
    n, n_t, n_e, n_et, in_e, in_et = len(texts), Counter(), Counter(), Counter(), {}, {}
    for t, terms, ents in zip(texts, terms_of, ents_of):
        n_t.update(set(WORD.findall(t.lower())))
        n_e.update(ents)
        for e in ents:
            in_e.setdefault(e, set()).add(t)
            for w in terms:
                n_et[e, w] += 1
                in_et.setdefault((e, w), set()).add(t)
    over = set()
    for (e, w), both in n_et.items():
        if len(in_e[e]) >= rule.support and len(in_et[e, w]) >= rule.support and n_e[e] < n:
            if math.log(both * n / (n_e[e] * n_t[w])) / math.log(n / n_e[e]) >= rule.generalise:
                over.add((e, w))
    return {(d, m.start(), m.end()) for d, t in enumerate(texts) for m in WORD.finditer(blanked(t))
            if any((e, m[0].lower()) in over for e in ents_of[d])}


def corpus():
    rng = random.Random(4)
    words = [f"{a}{b}word" for a in "abcdefgh" for b in "klmnop"]
    texts = []
    for k in range(60):
        body = [rng.choice(words) for _ in range(rng.randrange(5, 40))]
        if k % 3 == 0:
            body[2:2] = ["codename", "falcon", f"agent{'xyz'[k % 9 // 3]}@mail.example.com"]
        if k % 7 == 0:
            body.append("call +49 170 5550123 soon")
        texts.append(" ".join(body))
    far = " ".join(rng.choice(words) for _ in range(90))
    texts += [f"Li wrote this {far} {k} call +49 170 9998877 thanks" for k in range(3)]      # a name far from the number
    texts += ["Bob7 at bob@x.example said so"] * 5                                          # copies of one text show nothing
    return texts


def test_a_distant_short_name_is_found_and_common_words_are_not(spark):
    texts = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: {texts[r["doc_id"]][s["start"]:s["end"]] for s in (r["terms"] or [])} for r in pii.find(docs).collect()}
    assert {"Li", "wrote"} <= got[60] and "Bob7" not in got[63] and got[63] == set()


def test_a_list_of_twenty_thousand_contacts(spark):
    import time
    line = lambda k: f"name{k} user{k}@mail.example.com"
    texts = ["\n".join(line(k) for k in range(20_000)), "\n".join(line(k) for k in range(20_000)) + " more", "plain words only"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    t0 = time.time()
    got = {r["doc_id"]: (len(r["spans"]), len(r["terms"] or [])) for r in pii.find(docs).collect()}
    assert got == {0: (20_000, 20_000), 1: (20_000, 20_000), 2: (0, 0)}
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert time.time() - t0 < 60
    assert clean[0] == "\n".join([" [EMAIL]"] * 20_000) and clean[1] == clean[0] + " more" and clean[2] == texts[2]


def test_running_sums_and_cuts_over_blocks(spark):
    rng = random.Random(5)
    rows = [(k, [rng.randrange(9) for _ in range(n)]) for k, n in enumerate((0, 1, 127, 128, 129, 256, 1000))]
    df = spark.createDataFrame(rows, "k int, v array<int>")
    got = {r["k"]: (r["s"], r["m"]) for r in df.select("k", pii.running(F.col("v")).alias("s"), pii.running(F.col("v"), lambda a, b: F.greatest(a, b)).alias("m")).collect()}
    for k, v in rows:
        assert got[k] == ([sum(v[:i]) for i in range(len(v))], [max([0, *v[:i]]) for i in range(len(v))])
    text = "".join(rng.choice("abc é中\n") for _ in range(9000))
    spans = sorted((a, a + rng.randrange(1, 40), rng.choice(["email", "removed"])) for a in (rng.randrange(8900) for _ in range(300)))
    df = spark.createDataFrame([(text, spans)], "t string, s array<struct<start:int,end:int,kind:string>>")
    want, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            want += [text[at:a], "" if kind == "removed" else "[EMAIL]"]
        at = max(at, b)
    assert df.select(pii._cut(F.col("t"), F.col("s"))).first()[0] == "".join(want) + text[at:]


def test_names_of_columns_do_not_clash(spark):
    names = ["their_doc_id", "their_text_hash", "their_terms", "their_terms_", "__terms", "__doc_id", "text_hash"]
    docs = spark.createDataFrame([(1, "a@b.example x", *names)], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    row = pii.sanitise(docs).first()
    assert row["text"] == "[EMAIL] x" and [row[n] for n in names] == names and len(row) == len(names) + 2


def test_disclosing_terms(spark):
    texts, rule = corpus(), pii.Disclosure()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r["doc_id"], s["start"], s["end"]) for r in pii.find(docs, rule).collect() for s in (r["terms"] or [])}
    want = disclosures(texts, rule)
    assert want and got == want


def test_sanitise_and_clashing_columns(spark):
    texts = corpus()
    docs = spark.createDataFrame([(k, t, "h", "t", "s") for k, t in enumerate(texts)],
                                 "doc_id long, text string, text_hash string, terms string, spans string")
    out = {r["doc_id"]: r for r in pii.sanitise(docs).collect()}
    assert len(out) == len(texts) and out[0]["terms"] == "t"
    for k, r in out.items():
        assert not pii_spans(r["text"])
        assert ("[EMAIL]" in r["text"]) == ("@" in texts[k]) and ("[PHONE]" in r["text"]) == ("+49" in texts[k])
    clean = [k for k, t in enumerate(texts) if not pii_spans(t)]
    assert all(out[k]["text"] == texts[k] for k in clean)


def test_edges(spark):
    docs = spark.createDataFrame(EDGE_DOCS, "doc_id long, text string")
    rows = pii.described(pii.find(docs)).collect()
    assert len(rows) == len(EDGE_DOCS)
    none = hashlib.sha256(b"").hexdigest()
    assert all(r["base_sha256"] == none and r["spans"] == "" for r in rows)
    same = pii.sanitise(docs).collect()
    assert sorted(map(str, (tuple(r) for r in same))) == sorted(map(str, EDGE_DOCS))
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find(empty).collect() == [] and pii.sanitise(empty).collect() == []
