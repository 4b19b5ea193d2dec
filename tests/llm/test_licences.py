import re
import time

import pytest

from docflow.llm import licences
from docflow.llm.licences import HINTS, HOLDER, RULES, SENTENCES, SLOT_WORDS, SLOTS, TEXT_RULES, normal
from tests.conftest import SF_CHECK
from tests.llm.plain import EDGE_DOCS

KNOWN = {normal(s): i for i, s in SENTENCES.items()}


def plain_slots(pieces):
    """Pieces with holders' names as one word, word by word; a name's pieces become one."""
    words = [[w, k] for k, p in enumerate(pieces) for w in p.split()]
    for before, after in SLOTS:
        before, after, at = before.split(), after.split(), 0
        while at < len(words):
            spelt = [w for w, _ in words[at:at + len(before)]]
            for k in range(1, SLOT_WORDS + 1) if spelt == before else ():
                tail = at + len(before) + k
                if [w for w, _ in words[tail:tail + len(after)]] == after:
                    # the holder stays in the piece before it and what follows joins that piece
                    piece, last = words[at + len(before)][1], words[tail][1]
                    words[at + len(before):tail] = [[HOLDER, piece]]
                    words = [[w, piece if n > at + len(before) and p == last else p] for n, (w, p) in enumerate(words)]
                    at += len(before) + len(after)
                    break
            at += 1
    lines = {}
    for w, p in words:
        lines.setdefault(p, []).append(w)
    return [" ".join(ws) for _, ws in sorted(lines.items())]


def plain_scan(text):
    """{rule: (matches, first piece)} of one text: every run of pieces, without hints or prefixes."""
    cut = re.sub(r"([.!?:])[ \t\r\n]+", r"\1\n", (text or "").lower()).split("\n")
    words = [re.sub(r"[^a-z0-9]+", " ", p).strip() for p in cut]
    pieces = plain_slots([p for p in words if p])
    most = max(len(s.split()) for s in KNOWN)
    found, stop = [], 0
    for a in range(len(pieces)):
        spelt = [(a + k, KNOWN[run]) for k in range(1, most + 1)
                 if a + k <= len(pieces) and (run := " ".join(pieces[a:a + k])) in KNOWN]
        if spelt and max(spelt)[0] > stop:
            stop = max(spelt)[0]
            found.append((a, max(spelt)[1]))
    rest, out = [i for _, i in found], {}
    for rule, _, ids in RULES:
        at = n = 0
        while at <= len(rest) - len(ids):
            if tuple(rest[at:at + len(ids)]) == ids:
                out.setdefault(rule, found[at][0])
                rest[at:at + len(ids)] = [None] * len(ids)
                n += 1
            at += 1
        if n:
            out[rule] = (n, out[rule])
    return out


def wrapped(text, width):
    lines, line = [], ""
    for w in text.split():
        if line and len(line) + len(w) > width:
            lines.append(line)
            line = ""
        line = f"{line} {w}".strip()
    return "\n".join([*lines, line])


def scanned(spark, rows):
    df = spark.createDataFrame([(i, t, "r", 5, [1], 2) for i, t in rows],
                               "doc_id long, text string, rule string, n_matches int, found array<int>, hit int")
    got = {}
    for r in licences.scan(df).collect():
        assert set(r.asDict()) == {"doc_id", "found", "hit", "rule", "licence", "n_matches", "first_piece", "sentences"}
        assert r["found"] == [1] and r["hit"] == 2
        got.setdefault(r["doc_id"], {})[r["rule"]] = (r["n_matches"], r["first_piece"])
    return got


def text_of(rule):
    return [SENTENCES[i] for i in next(ids for r, _, ids in RULES if r == rule)]


def test_rules_are_consistent():
    assert len(SENTENCES) >= 100 and len(KNOWN) == len(SENTENCES)
    assert len({r for r, _, _ in RULES}) == len(RULES) and all(i in SENTENCES for _, _, ids in RULES for i in ids)
    assert {i for _, _, ids in RULES for i in ids} == set(SENTENCES)
    assert all(any(h in s for h in HINTS) for s in KNOWN)
    wants = ["".join(f"<{i}>" for i in ids) for _, _, ids in RULES]
    assert not [(a, b) for k, a in enumerate(wants) for b in wants[k + 1:] if a in b]  # longer rules come first


def test_every_rule_matches_its_own_text_alone(spark):
    texts = {k: "\n".join(text_of(rule)) for k, (rule, _, _) in enumerate(RULES)}
    narrow = {k + 1000: wrapped(t, 20) for k, t in texts.items()}
    got = scanned(spark, [*texts.items(), *narrow.items()])
    assert got == {k + off: {rule: (1, 0)} for k, (rule, _, _) in enumerate(RULES) for off in (0, 1000)}


def test_texts(spark):
    mit = "MIT License\n\nCopyright (c) 2020 Someone\n\n" + "\n\n".join(wrapped(s, 78) for s in text_of("mit-full-text"))
    bsd = " ".join(text_of("bsd-3-text")).replace("the copyright holder nor", "Some Company,\n  Inc. nor")
    four_words = "\n\n".join("\n".join(" ".join(s.split()[k:k + 4]) for k in range(0, len(s.split()), 4))
                             for s in text_of("mit-text"))
    texts = [mit, mit.upper(), bsd, f"x.\n{SENTENCES['mit-ref-2']} y. {SENTENCES['mit-ref-2']}\n{SENTENCES['apache-2']}",
             "# " + SENTENCES["mpl-2"].replace(" ", "\n# "), SENTENCES["bsd-source"] + " " + SENTENCES["bsd-grant"],
             "Permission is hereby granted to no one.", "licence", SENTENCES["gpl-later"] + "\n\n" + SENTENCES["gpl-no-warranty"],
             four_words, SENTENCES["unlicense"].replace("public domain", "public\ndomain"),
             "\n".join(text_of("bsd-2-text") + ["Unknown words."] + text_of("bsd-3-text") + text_of("bsd-2-text")),
             "// SPDX-License-Identifier: GPL-2.0-only\n", "SPDX-License-Identifier: GPL-2.0-only WITH x"]
    got = scanned(spark, list(enumerate(texts)))
    assert got == {k: plain_scan(t) for k, t in enumerate(texts) if plain_scan(t)}
    assert got[0] == {"mit-full-text": (1, 2)} == got[1]
    assert got[2] == {"bsd-3-text": (1, 0)}
    assert got[3]["mit-reference-2"] == (2, 1) and "mpl-2-notice" in got[4] and 5 not in got and "gpl-3-header" in got[8]
    assert got[9] == {"mit-text": (1, 0)} and got[10] == {"unlicense-text": (1, 0)}
    assert got[11] == {"bsd-3-text": (1, 4), "bsd-2-text": (2, 0)}
    assert got[12] == {"gpl-2.0-only-reference-6": (1, 0)} and 13 not in got


def test_edges(spark):
    assert scanned(spark, EDGE_DOCS) == {}
    own = SENTENCES["gpl-3.0-only-ref-4"]
    twice = [(1, own), (1, own), (None, own), (2, "copyright " * 50_000)]
    df = spark.createDataFrame(twice, "doc_id long, text string")
    assert sorted(str(r["doc_id"]) for r in licences.scan(df).collect()) == ["1", "1", "None"]
    assert licences.scan(df.limit(0)).collect() == []
    with pytest.raises(ValueError, match="hints"):
        licences.scan(df, hints=("nothing",))


def test_long_texts_of_known_sentences(spark):
    text = "\n".join(wrapped(s, 40) for s in text_of("bsd-3-text")) + "\n"
    began = time.time()
    assert scanned(spark, [(1, text * 2_000)]) == {1: {"bsd-3-text": (2_000, 0)}}
    assert time.time() - began < 60


def test_table(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert scanned(spark, rows) == {i: found for i, t in rows if (found := plain_scan(t))}
