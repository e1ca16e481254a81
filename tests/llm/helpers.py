"""Brute-force versions of the corpus operators, and awkward documents."""

from __future__ import annotations

import hashlib
import random
import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def lower(text):
    return (text or "").translate(UPPER)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def awkward_texts(seed=3, n=60):
    """Nulls, empties, odd white space, long texts, exact and near copies, shared passages."""
    pick = random.Random(seed)
    vocabulary = ["".join(pick.choices("abcdeéß日", k=pick.randint(1, 6))) for _ in range(400)]
    words = lambda k: [pick.choice(vocabulary) for _ in range(k)]
    passage, line = " ".join(words(70)), "A shared line, " + " ".join(words(8))
    out = [None, "", " ", "\n", " \t\r\n\x0b\x0c ", "one", "one two", "ONE  Two", "É é", " nbsp ", "▁ a▁b", line, "  " + line.upper() + "\t"]
    for i in range(n):
        body = words(pick.choice([3, 20, 60, 120, 300]))
        if i % 3 == 0:
            body = passage.split(" ") + body
        text = " ".join(body)
        if i % 4 == 0:
            text = text.replace(" ", "\n", 3) + "\n" + line + ("\n" + line) * (i % 8 == 0)
        out.append(text)
        if i % 5 == 0:
            near = body[:]
            near[pick.randrange(len(near))] = "changed"
            out += [text, " ".join(near), text.upper()]
    out.append(" ".join(words(30_000)))
    return out


def shingle_set(text, k):
    w = SPACED.findall(lower(text))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_duplicates(docs, k, percent):
    """{id: (set size, component)} for a dict of texts."""
    sets = {i: shingle_set(t, k) for i, t in docs.items()}
    ids = sorted(sets)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1:]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    found = components(ids, links)
    return {i: (len(sets[i]), found[i]) for i in ids}


def substring_dedup(docs, size):
    """{id: (words, removed, digest)}."""
    words = {i: SPACED.findall(t or "") for i, t in docs.items()}
    first = {}
    for i in sorted(words):
        for j in range(len(words[i]) - size + 1):
            first.setdefault(tuple(words[i][j:j + size]), i)
    out = {}
    for i, w in words.items():
        keep = [True] * len(w)
        for j in range(len(w) - size + 1):
            if first[tuple(w[j:j + size])] < i:
                keep[j:j + size] = [False] * size
        out[i] = (len(w), keep.count(False), sha(" ".join(x for x, k in zip(w, keep, strict=True) if k)))
    return out


def line_dedup(docs, min_chars=20, min_docs=3):
    """{id: (lines, dropped, kept text)}."""
    key = lambda x: lower(x.strip(" \t\n\v\f\r"))
    lines = {i: (t or "").split("\n") for i, t in docs.items()}
    holders = {}
    for i, x in lines.items():
        for y in x:
            if len(key(y)) >= min_chars:
                holders.setdefault(key(y), set()).add(i)
    out = {}
    for i, x in lines.items():
        kept = [y for y in x if not (len(holders.get(key(y), ())) >= min_docs and i < max(holders[key(y)]))]
        out[i] = (len(x), len(x) - len(kept), "\n".join(kept))
    return out


def contamination(docs, items, size=13):
    """{id: (words, hit, items)} for texts and (item, text) pairs."""
    patterns = {}
    for item, t in items:
        w = ALNUM.findall(lower(t))
        k = min(size, len(w))
        for j in range(len(w) - k + 1 if k else 0):
            patterns.setdefault(tuple(w[j:j + k]), set()).add("" if item is None else str(item))
    sizes = {len(p) for p in patterns}
    out = {}
    for i, t in docs.items():
        w, hit, found = ALNUM.findall(lower(t)), set(), set()
        for k in sizes:
            for j in range(len(w) - k + 1):
                if tuple(w[j:j + k]) in patterns:
                    hit |= set(range(j, j + k))
                    found |= patterns[tuple(w[j:j + k])]
        out[i] = (len(w), len(hit), sorted(found))
    return out
