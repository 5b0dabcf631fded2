"""Plain versions of the contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
from itertools import combinations

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTER_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, k):
    words = SPACE_WORD.findall(lower(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def groups(texts, k, percent=80):
    """{doc_id: (n_shingles, component_id, kept)} of {doc_id: text}."""
    sets = {i: shingles(t, k) for i, t in texts.items()}
    up = {i: i for i in texts}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    has = {}
    for i, s in sets.items():
        for g in s:
            has.setdefault(g, []).append(i)
    pairs = {p for ids in has.values() for p in combinations(sorted(ids), 2)}
    for a, b in pairs:
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            up[y] = x
    return {i: (len(sets[i]), root(i), root(i) == i) for i in texts}


def overlaps(texts, items, window=10):
    """{doc_id: (n_words, n_hit, n_items, items_sha256, contaminated)}."""
    windows = {}
    for item, text in items:
        words = LETTER_WORD.findall(lower(text))
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = {}
    for doc, text in texts.items():
        words = LETTER_WORD.findall(lower(text))
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                owners = windows.get(tuple(words[i : i + size]))
                if owners:
                    hit.update(range(i, i + size))
                    found |= owners
        names = ",".join(sorted(str(i) for i in found if i is not None))
        out[doc] = (len(words), len(hit), sum(i is not None for i in found), hashlib.sha256(names.encode()).hexdigest(), bool(hit))
    return out


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def personal(text):
    """Base spans (kind, start, end) of the contract."""
    out = []
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card":
                twice = sum(int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d)))) for i, d in enumerate(reversed(digits)))
                if not 13 <= len(digits) <= 19 or twice % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


LINE = re.compile(r"(?:(?<=\n)|(?<=[.!?]\x20))(?!\Z)")


def lines(text):
    return LINE.split(text)


def bare(line):
    """A line without the line feed or space that ends it."""
    return line[:-1] if line.endswith("\n") or re.search(r"[.!?] \Z", line) else line


def without_repeated_runs(texts, least):
    """Texts without lines in shortest runs of `least` words that came before."""
    seen, out = set(), {}
    for i in sorted(texts):
        every = lines(texts[i] or "")
        full = [(k, bare(x)) for k, x in enumerate(every) if bare(x)]
        gone = set()
        for a in range(len(full)):
            n = 0
            for b in range(a, len(full)):
                n += len(SPACE_WORD.findall(full[b][1]))
                if n >= least:
                    run = tuple(x for _, x in full[a : b + 1])
                    if run in seen:
                        gone.update(k for k, _ in full[a : b + 1])
                    seen.add(run)
                    break
        out[i] = "".join(x for k, x in enumerate(every) if k not in gone)
    return out


def winnowed(text, k, window):
    """(position, gram) of the fingerprints: the least hash of each window, the rightmost of equal ones."""
    from stationflow.llm.winnowing import winnow

    grams = [text[i : i + k] for i in range(max(1, len(text) - k + 1))] if text else []
    order = {g: int(winnow([g], k, window)[0][0][0]) for g in set(grams)}
    out = set()
    for i in range(max(1, len(grams) - window + 1) if grams else 0):
        part = range(i, min(i + window, len(grams)))
        least = min(order[grams[j]] for j in part)
        best = max(j for j in part if order[grams[j]] == least)
        out.add((best, grams[best]))
    return out
