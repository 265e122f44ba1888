"""Brute-force versions of the operators, for small tables of (doc_id, text)."""

import hashlib
import re
from collections import Counter

sha = lambda b: hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def lines(docs, percent=80):
    """Kept text, lines and removed lines of each row; docs sorted by id, texts not null."""
    seen, out = [], []
    for i, t in docs:
        parts, kept = t.split("\n"), []
        for x in parts:
            s = frozenset(w for w in x.split(" ") if w)
            gone = bool(s) and any(100 * len(s & o) >= percent * len(s | o) for j, o in seen if o)
            if not gone:
                kept.append(x)
            seen.append((i, s))
        out.append((i, len(parts), len(parts) - len(kept), "\n".join(kept)))
    return out


def shingles(t, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", low(t))
    return frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()


def components(docs, n=4, percent=85):
    sets = [(i, shingles(t, n)) for i, t in docs]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, s) in enumerate(sets):
        for j, o in sets[:k]:
            if s and o and 100 * len(s & o) >= percent * len(s | o):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets}


def leaks(docs, items, size=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))
    wins = {}
    for i, t in items:
        w = words(t)
        if w:
            for k in range(max(1, len(w) - size + 1)):
                wins.setdefault(tuple(w[k : k + size]), set()).add(i)
    out = []
    for i, t in docs:
        w, found = words(t), set()
        hit = [False] * len(w)
        for win, ids in wins.items():
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k : k + len(win)]) == win:
                    found |= ids
                    hit[k : k + len(win)] = [True] * len(win)
        found.discard(None)
        out.append((i, len(w), sum(hit), len(found), sha(",".join(sorted(map(str, found)))), any(hit)))
    return out


def repeats(docs, length):
    raws = [(t or "").encode() for _, t in docs]
    count = Counter(b[k : k + length] for b in raws for k in range(len(b) - length + 1))
    out = []
    for (i, _), b in zip(docs, raws):
        gone = [False] * len(b)
        for k in range(len(b) - length + 1):
            if count[b[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), runs, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


KINDS = ["email", "ip", "card", "phone"]
RX = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(s):
    return sum(int(c) if k % 2 == 0 else (2 * int(c) - 9 * (int(c) > 4)) for k, c in enumerate(reversed(s))) % 10 == 0


def personal(t):
    def ok(kind, m):
        g = re.sub("[^0-9]", "", m)
        return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.split(".")), "card": 14 <= len(g) <= 19 and luhn(g), "phone": 10 <= len(g) <= 15}[kind]

    found = sorted((m.start(), KINDS.index(k), m.end()) for k in KINDS for m in re.finditer(RX[k], t or "") if ok(k, m[0]))
    return [f"{KINDS[k]}:{s}:{e}" for s, k, e in found]
