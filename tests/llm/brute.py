"""Plain Python versions of the operators, over lists of (doc_id, text)."""

import collections
import hashlib
import itertools
import math
import re
import zlib

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def utf8(text):
    return (text or "").encode()


def repeats(rows, length=50):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    seen, out = set(), []
    for _, group in itertools.groupby(order, key=lambda r: (r[0] is None, r[0])):
        new = set()
        for i, text in group:
            b = utf8(text)
            gone = [False] * len(b)
            for k in range(len(b) - length + 1):
                s = b[k:k + length]
                if s in seen:
                    gone[k:k + length] = [True] * length
                new.add(s)
            spans = sum(g and not p for g, p in zip(gone, [False, *gone]))
            kept = bytes(x for x, g in zip(b, gone) if not g)
            out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
        seen |= new
    return out


def lm_base(rows, folds=7, held_out=2):
    counts, texts = collections.Counter(), []
    for i, text in rows:
        held = zlib.crc32(str(i).encode() if i is not None else b"") % folds == held_out
        t = [*WORD.findall(utf8(text).lower()), None]
        texts.append((i, held, t))
        if not held:
            counts.update(t)
    n, v = sum(counts.values()), len(counts)
    return [(i, held, len(t), sum(w in counts for w in t), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t))
            for i, held, t in texts]


def contamination(rows, items, window=10):
    grams = {}
    for item, text in items:
        w = ALNUM.findall(utf8(text).lower())
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            grams.setdefault(tuple(w[k:k + n]), set()).add("null" if item is None else str(item))
    out = []
    for i, text in rows:
        w = ALNUM.findall(utf8(text).lower())
        hit, found = set(), set()
        for n in {len(g) for g in grams}:
            for k in range(len(w) - n + 1):
                if items_ := grams.get(tuple(w[k:k + n])):
                    found |= items_
                    hit.update(range(k, k + n))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def quality(rows):
    out = []
    for i, text in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        c = collections.Counter(zip(w, w[1:], w[2:]))
        covered = {p for k in range(len(w) - 2) if c[w[k], w[k + 1], w[k + 2]] > 1 for p in range(k, k + 3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        out.append((i, len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), len(lines) - len(set(lines)), len(covered),
                    len(w) < 50 or 100 * len(covered) > 50 * len(w)))
    return out


def components(rows, n=5, pct=80):
    sets = []
    for i, text in rows:
        w = WORD.findall(utf8(text).lower())
        sets.append((i, {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()))
    parent = {i: i for i, _ in sets if i is not None}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    live = [(i, s) for i, s in sets if i is not None and s]
    for (i, s), (j, t) in itertools.combinations(live, 2):
        if 100 * len(s & t) >= pct * len(s | t):
            a, b = sorted((find(i), find(j)))
            parent[b] = a
    return [(i, len(s), None if i is None else find(i)) for i, s in sets]
