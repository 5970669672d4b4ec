"""Brute-force versions of the corpus operators over plain Python rows."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def lower(data):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in data)


class Groups:
    def __init__(self, keys):
        self.parent = {k: k for k in keys}

    def root(self, k):
        while self.parent[k] != k:
            k = self.parent[k]
        return k

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)


def shingle_sets(docs, size):
    sets = {}
    for key, text in docs:
        w = [lower(x) for x in words(text)]
        n = min(size, len(w))
        sets[key] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
    return sets


def near_duplicates(docs, size, percent=80):
    """{key: (n_shingles, component)} comparing every two documents that share a shingle."""
    sets = shingle_sets(docs, size)
    groups, index = Groups(sets), defaultdict(list)
    for key, s in sets.items():
        shared = Counter(other for g in s for other in index[g])
        for other, common in shared.items():
            if 100 * common >= percent * (len(s) + len(sets[other]) - common):
                groups.join(key, other)
        for g in s:
            index[g].append(key)
    return {key: (len(s), groups.root(key)) for key, s in sets.items()}


def remove_repeats(docs, window):
    """{key: (n_words, n_removed, kept words)}"""
    first = {}
    for key, text in docs:
        w = words(text)
        for i in range(len(w) - window + 1):
            seen = tuple(w[i : i + window])
            first[seen] = min(key, first.get(seen, key))
    out = {}
    for key, text in docs:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < key:
                gone[i : i + window] = [True] * window
        out[key] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode())
    return out


def base_rules(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    gone = [False] * len(w)
    for i in range(len(w) - 7):
        if windows[tuple(w[i : i + 8])] > 1:
            gone[i : i + 8] = [True] * 8
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    row = (len(w), sum(len(x.decode()) for x in w), symbols, len(lines) - len(set(lines)), sum(gone))
    return (*row, len(w) < 20 or 100 * sum(gone) > 30 * len(w))


def drop_lines(docs, ratio, least):
    """{key: (n_lines, n_removed, text)} for docs (key, source, text)."""
    pages, having = Counter(), Counter()
    for _, source, text in docs:
        pages[source] += 1
        for line in {x for x in (text or "").split("\n") if words(x)}:
            having[source, line] += 1
    out = {}
    for key, source, text in docs:
        if text is None:
            out[key] = (0, 0, None)
            continue
        lines = text.split("\n")
        bad = [bool(words(x)) and having[source, x] >= least and having[source, x] > ratio * pages[source] for x in lines]
        out[key] = (len(lines), sum(bad), "\n".join(x for x, b in zip(lines, bad) if not b))
    return out


def targets(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    fixed = {}
    while True:
        free = [s for s in names if s not in fixed]
        if not free:
            return fixed
        level = (share * sum(sizes.values()) - sum(fixed.values())) / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * level > cap * sizes[s]]
        if not over:
            return fixed | {s: weight[s] * level for s in free}
        fixed |= {s: cap * sizes[s] for s in over}


def sha1_base32(payload):
    import base64

    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def regrow(rows, grafts=6, family=100):
    """{conv: [(role, text)]} of (conv, turn, role, text) rows, with shared beginnings."""
    import zlib

    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % grafts for c in own}
    return {c: own.get(c - c % family, [])[: h[c]] + turns[h[c] :] for c, turns in own.items()}


def trie(conversations):
    """Rows of the prefix trie of {conv: [turn]}, a turn's last field being its text."""
    members, ends = defaultdict(list), defaultdict(list)
    for conv, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
        ends[tuple(turns)].append(conv)
    kids = defaultdict(set)
    for node in members:
        if node:
            kids[node[:-1]].add(node)
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        saved = (len(members[node]) - 1) * len(node[-1][-1]) if node else 0
        sums[node] = (sum(sums[k][0] for k in kids[node]) or 1, saved + sum(sums[k][1] for k in kids[node]))
    return [
        (min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(kids[node]), *sums[node],
         hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
        for node, m in members.items()
    ]


def search(docs, items, k=10):
    """{item row: [(rank, doc, score)]} for every item, scoring every document."""
    import math

    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower((t or "").encode()).decode())
    counts = [(doc, Counter(terms(text))) for doc, text in docs]
    n_docs, n_terms = sum(bool(c) for _, c in counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        asked, scores = Counter(terms(text)), []
        for doc, c in counts:
            if c:
                m = 25 + (75 * c.total() * n_docs) // n_terms
                score = sum(r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, r in asked.items() if c[t])
                if score > 0:
                    scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, i, s[3], -s[0]) for i, s in enumerate(sorted(scores)[:k], 1)]
    return out
