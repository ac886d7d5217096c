"""Plain Python statements of the operators, for small tables."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def lines(rows, min_docs):
    """[(id, text)] -> [(n_lines, n_dropped, kept)]"""
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(UPPER)
    found = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            found[key(line)].add(i)
    out = []
    for _, text in rows:
        ls = (text or "").split("\n")
        kept = [x for x in ls if not key(x) or len(found[key(x)]) < min_docs]
        out.append((len(ls), len(ls) - len(kept), "\n".join(kept)))
    return out


def shingles(text, k):
    ws = words((text or "").translate(UPPER))
    if len(ws) < k:
        return {tuple(ws)} if ws else set()
    return {tuple(ws[i:i + k]) for i in range(len(ws) - k + 1)}


def jaccard(rows, k, percent):
    """[(id, text)] -> [(n_shingles, n_links, component)]"""
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    links = Counter()
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(len(s), links[i], least.get(find(i)) if s else rows[i][0]) for i, s in enumerate(sets)]


def substrings(rows, k):
    """[(id, text)] -> [(n_words, n_removed, kept words)]"""
    ws = [words(t) for _, t in rows]
    found = Counter(tuple(w[i:i + k]) for w in ws for i in range(len(w) - k + 1))
    out = []
    for w in ws:
        gone = set()
        for i in range(len(w) - k + 1):
            if found[tuple(w[i:i + k])] > 1:
                gone.update(range(i, i + k))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def suffixes(rows, length):
    """[(id, text)] in order -> [(n_bytes, n_removed, n_spans, kept)]"""
    seen, out = set(), []
    for _, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for p in range(len(b) - length + 1):
            s = b[p:p + length]
            if s in seen:
                gone[p:p + length] = [True] * length
            seen.add(s)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return out


def rules(text):
    """text -> (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)"""
    ws, text = words(text), text or ""
    n = Counter(tuple(ws[i:i + 3]) for i in range(len(ws) - 2))
    again = {j for i in range(len(ws) - 2) if n[tuple(ws[i:i + 3])] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        dup += bool(words(line)) and line in seen
        seen.add(line)
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), dup, len(again)
