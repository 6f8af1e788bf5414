"""Plain versions of the operators, for small tables: documents are (doc_id, text, ...) with null texts as None."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict


def order(doc_id):
    return (doc_id is not None, doc_id or 0)


def repeated_bytes(docs, length=100):
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 by a table of every window's earliest start."""
    texts = sorted(((order(d), (t or "").encode(), d) for d, t in docs), key=lambda x: x[0])
    earliest, out = {}, []
    for place, data, doc in texts:
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if earliest.setdefault(window, (place, i)) < (place, i):
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=lambda r: (order(r[0]), r[1:]))


WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORDS.findall(lower)


def shingles(text, k=5):
    w = words(text)
    k = min(k, len(w))
    return [tuple(w[i : i + k]) for i in range(len(w) - k + 1)] if w else []


def common_subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def similar(a, b, least=0.8):
    """Aligned shingles over all; quick where multisets alone decide."""
    ca, cb = Counter(a), Counter(b)
    common = sum((ca & cb).values())
    if not a or not b or common < least * (len(a) + len(b) - common):
        return False
    c = common_subsequence(a, b)
    return c >= least * (len(a) + len(b) - c)


def near_classes(docs):
    """{doc_id: least doc_id of its class} for different ids."""
    by_text = defaultdict(list)
    for doc, text in docs:
        by_text[text or ""].append(doc)
    nodes = {min(ids, key=order): shingles(text) for text, ids in by_text.items()}
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    holders = defaultdict(set)
    for n, s in nodes.items():
        for x in set(s):
            holders[x].add(n)
    pairs = Counter()
    for group in holders.values():
        group = sorted(group, key=order)
        pairs.update((a, b) for i, a in enumerate(group) for b in group[i + 1 :])
    for (a, b), shared in pairs.items():
        if shared * 3 >= min(len(set(nodes[a])), len(set(nodes[b]))) and similar(nodes[a], nodes[b]):
            x, y = sorted((find(a), find(b)), key=order)
            root[y] = x
    return {d: find(min(ids, key=order)) for ids in by_text.values() for d in ids}


def contamination(docs, items, window=13):
    """doc_id, n_words, n_hit, sorted items."""
    owners = defaultdict(set)
    for item, text in items:
        w = words(text)
        k = min(window, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            owners[tuple(w[i : i + k])].add(item or "")
    sizes = {len(x) for x in owners}
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                if got := owners.get(tuple(w[i : i + k])):
                    hit.update(range(i, i + k))
                    found |= got
        out.append((doc, len(w), len(hit), sorted(found)))
    return out
