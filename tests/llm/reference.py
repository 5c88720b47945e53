"""Brute-force versions that the operators are held against."""

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def quality_base(text):
    text = text or ""
    w = words(text)
    count = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if count[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), len(w) < 20 or 100 * len(covered) > 30 * len(w)


def substring_dedup(docs, n=13):
    """docs: {id: text} -> {id: (words, removed, kept)}"""
    own, first = {i: words(t) for i, t in docs.items()}, {}
    for i in sorted(own):
        for k in range(len(own[i]) - n + 1):
            first.setdefault(tuple(own[i][k : k + n]), i)
    out = {}
    for i, w in own.items():
        gone = {j for k in range(len(w) - n + 1) if first[tuple(w[k : k + n])] < i for j in range(k, k + n)}
        out[i] = (len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone))
    return out


def shingles(text, k):
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def jaccard_components(docs, k, num, den):
    sets = {i: shingles(t, k) for i, t in docs.items()}
    up = {i: i for i in docs}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(docs)
    for p, i in enumerate(ids):
        for j in ids[:p]:
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in docs}


def line_dedup(docs, least):
    """docs: list of texts -> list of (lines, dropped, kept)"""
    key = lambda x: x.strip(WS).translate(LOWER)
    count = collections.Counter(k for t in docs for k in {key(x) for x in (t or "").split("\n")} if k)
    out = []
    for t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (key(x) and count[key(x)] >= least)]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out
