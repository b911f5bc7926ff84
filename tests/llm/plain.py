"""Plain Python versions of what the operators return, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

NON_SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def shingles(text, k=5):
    w = NON_SPACE.findall(lower(text))
    if len(w) < k:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def components(rows, percent=75):
    """[(doc_id, n_shingles, component_id)] for rows (doc_id, text), in their order."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)].append(doc)
    return [(doc, len(s), (min(least[find(i)], default=None) if s else doc))
            for i, ((doc, _), s) in enumerate(zip(rows, sets))]


def line_keys(text):
    return [x.strip(" \t\n\x0b\x0c\r").lower() if x.isascii() else lower(x).strip(" \t\n\x0b\x0c\r")
            for x in (text or "").split("\n")]


def kept_lines(rows, min_docs):
    """[(doc_id, n_lines, n_dropped, kept)]"""
    holds = defaultdict(set)
    for doc, text in rows:
        for k in line_keys(text):
            holds[k].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x, k in zip(lines, line_keys(text)) if not k or len(holds[k]) < min_docs]
        out.append((doc, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


def contamination(rows, items, window=10):
    """[(doc_id, n_words, n_hit, items, spans)]"""
    phrases = defaultdict(set)
    for item, text in items:
        w = ALNUM.findall(lower(text))
        k = min(window, len(w))
        for a in range(len(w) - k + 1 if k else 0):
            phrases[tuple(w[a:a + k])].add(item)
    out = []
    for doc, text in rows:
        w = ALNUM.findall(lower(text))
        hit, found = set(), set()
        for p, owners in phrases.items():
            for a in range(len(w) - len(p) + 1):
                if tuple(w[a:a + len(p)]) == p:
                    hit.update(range(a, a + len(p)))
                    found |= owners
        spans, start = [], None
        for i in range(len(w) + 1):
            if i in hit and start is None:
                start = i
            elif i not in hit and start is not None:
                spans.append((start, i))
                start = None
        out.append((doc, len(w), len(hit), sorted(i for i in found if i is not None), spans))
    return out


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """{source: target}, dealing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget = share * sum(sizes.values())
    full = set()
    while True:
        free = [s for s in names if s not in full]
        rest = budget - sum(most * sizes[s] for s in full)
        got = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if got[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else got[s] for s in names}
        full |= over


def greedy_pieces(pieces, word, longest):
    """How many longest pieces make up the word; 1 if it can't be cut."""
    at = count = 0
    while at < len(word):
        for end in range(min(len(word), at + longest), at, -1):
            if word[at:end] in pieces:
                break
        else:
            return 1
        at, count = end, count + 1
    return count


def phrase_places(text, phrases):
    """(n_words, sorted starts of all phrases, labels)"""
    w = ALNUM.findall(lower(text))
    found = []
    for p, label in phrases.items():
        p = p.split()
        found += [(i, label) for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
    return len(w), sorted(i for i, _ in found), sorted({x for _, x in found})


def held_out(doc):
    return zlib.crc32(str(doc).encode()) % 3 == 1


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def count_words(text):
    return Counter(ALNUM.findall(lower(text)))
