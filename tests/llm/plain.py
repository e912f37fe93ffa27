"""Plain versions of what the corpus operators compute, over lists of (id, text)."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def near(docs, size, percent=80):
    """id -> (shingles, smallest id reachable)."""
    sets = {}
    for i, t in docs:
        w = spaced((t or "").translate(UPPER))
        n = min(size, len(w))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()
    comp = {i: i for i in sets}
    ids = sorted(sets)
    edges = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    moved = True
    while moved:
        moved = False
        for a, b in edges:
            low = min(comp[a], comp[b])
            moved |= comp[a] != low or comp[b] != low
            comp[a] = comp[b] = low
    return {i: (len(sets[i]), comp[i]) for i in ids}


def later_bytes(docs, size):
    """id -> (bytes, removed, spans, sha of the rest)."""
    seen, out = set(), {}
    for i, t in sorted(docs):
        data = (t or "").encode()
        gone = [False] * len(data)
        for p in range(len(data) - size + 1):
            if data[p : p + size] in seen:
                gone[p : p + size] = [True] * size
            seen.add(data[p : p + size])
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(data), sum(gone), spans, sha(bytes(b for b, g in zip(data, gone, strict=True) if not g)))
    return out


def repeated_words(docs, size):
    """id -> (words, removed, sha of the rest)."""
    where = defaultdict(list)
    words = {i: spaced(t) for i, t in docs}
    for i, w in words.items():
        for p in range(len(w) - size + 1):
            where[tuple(w[p : p + size])].append((i, p))
    gone = {i: [False] * len(w) for i, w in words.items()}
    for places in where.values():
        if len(places) > 1:
            for i, p in places:
                gone[i][p : p + size] = [True] * size
    return {i: (len(w), sum(gone[i]), sha(" ".join(x for x, g in zip(w, gone[i], strict=True) if not g))) for i, w in words.items()}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    """Sorted (start, number of the kind, end)."""
    out = []
    for k, (kind, form) in enumerate(FORMS.items()):
        for m in re.finditer(form, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def hit_words(text, items, size=10):
    """Words, words covered by windows of the items, ids of the items that occur."""
    form = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    w = re.findall(form, (text or "").translate(UPPER))
    gone, found = set(), set()
    for item, t in items:
        own = re.findall(form, (t or "").translate(UPPER))
        n = min(size, len(own))
        for a in range(len(own) - n + 1 if n else 0):
            for p in range(len(w) - n + 1):
                if w[p : p + n] == own[a : a + n]:
                    gone |= set(range(p, p + n))
                    found.add(str(item))
    return len(w), len(gone), ",".join(sorted(found))
