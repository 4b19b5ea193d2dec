"""Plain Python versions of the operators, for comparison on small inputs."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORDS = re.compile("[^\x20\x09-\x0d]+")

#: (doc_id, text) rows with nulls, empty and long texts, ties and repeated rows.
EDGE_DOCS = [
    (1, "one two three four five six seven"),
    (1, "one two three four five six seven"),
    (2, None),
    (3, ""),
    (4, " \t\n "),
    (None, "one two three four five six seven"),
    (None, None),
    (5, "One TWO three four"),
    (6, "one two three four"),
    (7, "lone"),
    (8, " ".join(f"w{k % 977}" for k in range(60_000))),
    (9, "x" * 300_000),
    (10, "éÀ ß Ωmega 中文 text\x00with\x01odd bytes"),
]


def shingles(text: str | None, n: int = 5) -> frozenset:
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) >= n:
        return frozenset(tuple(words[k:k + n]) for k in range(len(words) - n + 1))
    return frozenset([tuple(words)]) if words else frozenset()


def near_duplicates(rows: list[tuple]) -> list[tuple]:
    """(doc_id, n_shingles, component_id) of each row, by comparing all sets that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    distinct = sorted({s for s in sets if s}, key=lambda s: sorted(map(str, s)))
    at = {s: k for k, s in enumerate(distinct)}
    parent = list(range(len(distinct)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    holders = defaultdict(list)
    for k, s in enumerate(distinct):
        for x in s:
            holders[x].append(k)
    pairs = {(a, b) for h in holders.values() for i, a in enumerate(h) for b in h[i + 1:]}
    for a, b in pairs:
        shared = len(distinct[a] & distinct[b])
        if 100 * shared >= 80 * len(distinct[a] | distinct[b]):
            parent[root(a)] = root(b)
    least: dict[int, int] = {}
    for (i, _), s in zip(rows, sets):
        if s and i is not None:
            r = root(at[s])
            least[r] = min(i, least.get(r, i))
    return [(i, len(s), least.get(root(at[s])) if s else i) for (i, _), s in zip(rows, sets)]


PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
       "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
       "card": r"[0-9]([\x20-]?[0-9])+",
       "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _holds(kind: str, value: str) -> bool:
    digits = [int(c) for c in value if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        total = sum(d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(digits[::-1]))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return True


def pii_spans(text: str | None) -> list[tuple]:
    kinds = [k for k in PII if k != "email" or "@" in (text or "")]      # no email without its sign
    return [(k, m.start(), m.end()) for k in kinds for m in re.finditer(PII[k], text or "") if _holds(k, m[0])]


def fertility_counts(text: str | None) -> tuple:
    text = text or ""
    words = WORDS.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    windows = list(zip(words, words[1:], words[2:]))
    times = Counter(windows)
    inside = {k + j for k, w in enumerate(windows) if times[w] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


def tokens(text: str | None) -> list[str]:
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def contaminated(docs: list[tuple], items: list[tuple], window: int = 16, share: float = 0.8) -> set[tuple]:
    """(doc_id, item_id) where some alignment has a window that agrees in ``share`` of its tokens."""
    out = set()
    for d, text in docs:
        have = tokens(text)
        for i, item in items:
            want = tokens(item)
            width = min(window, len(want))
            for start in range(-len(want) + 1, len(have)):
                agree = [0 <= start + k < len(have) and have[start + k] == w for k, w in enumerate(want)]
                if want and max(sum(agree[j:j + width]) for j in range(len(want) - width + 1)) >= -(-width * share // 1):
                    out.add((d, i))
                    break
    return out
