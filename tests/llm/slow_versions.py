"""Slow and plain versions of the corpus operators."""

from __future__ import annotations

import fractions
import hashlib
import itertools
import math
import re

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKEN = re.compile(rb"[^\x20\x09-\x0D]+")


def lower(text: str | None) -> bytes:
    return bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())


def contamination(docs, items, window=10):
    """{doc_id: (n_words, n_hit, n_items, sha256, contaminated)}; docs and items are (id, text) pairs."""
    windows = {}
    for item, text in items:
        words = WORD.findall(lower(text))
        for at in range(max(1, len(words) - window + 1) if words else 0):
            windows.setdefault(tuple(words[at : at + window]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = {}
    for doc, text in docs:
        words = WORD.findall(lower(text))
        hit, found = set(), set()
        for size in sizes:
            for at in range(len(words) - size + 1):
                own = windows.get(tuple(words[at : at + size]))
                if own:
                    found |= own
                    hit.update(range(at, at + size))
        out[doc] = (len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


def near(docs, words=3, percent=85):
    """{doc_id: (n_shingles, component_id, kept)} by comparing all pairs that share a shingle."""
    sets = {}
    for doc, text in docs:
        own = TOKEN.findall(lower(text))
        sets[doc] = {tuple(own[i : i + words]) for i in range(len(own) - words + 1)} if len(own) >= words else {tuple(own)} if own else set()
    top = {doc: doc for doc in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    by = {}
    for doc, own in sets.items():
        for s in own:
            by.setdefault(s, []).append(doc)
    shared = {}
    for group in by.values():
        for i, x in enumerate(group):
            for y in group[:i]:
                shared[x, y] = shared.get((x, y), 0) + 1
    for (x, y), n in shared.items():
        if 100 * n >= percent * (len(sets[x]) + len(sets[y]) - n):
            a, b = sorted((find(x), find(y)))
            top[b] = a
    return {doc: (len(own), find(doc), find(doc) == doc) for doc, own in sets.items()}


def repeats(docs, length=50):
    """{doc_id: (n_bytes, n_removed, n_spans, sha256)}; docs are (id, text) pairs with different ids."""
    least, out = {}, {}
    for doc, text in docs:
        body = (text or "").encode()
        for i in range(len(body) - length + 1):
            s = body[i : i + length]
            least[s] = min(least.get(s, doc), doc)
    for doc, text in docs:
        body = (text or "").encode()
        gone = bytearray(len(body))
        for i in range(len(body) - length + 1):
            if least[body[i : i + length]] < doc:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out[doc] = (len(body), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(body, gone) if not g)).hexdigest())
    return out


def cluster(rows, k=16, rounds=3, size=64, scale=64, seed="1:"):
    """[(id, cluster, distance, inertia of the cluster, inertia of all, sha256)] in Python's own integers; rows are (id, vector) pairs."""
    exact = lambda x: math.floor(fractions.Fraction(x) * scale)
    kept = [(i, [exact(v) for v in x]) for i, x in rows if x is not None and len(x) == size and all(v is not None and math.isfinite(v) for v in x)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"{seed}{r[0]}".encode()).hexdigest(), r[1])
    centers = [x for _, x in sorted(kept, key=key)[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centers))

    for _ in range(rounds):
        own = {}
        for _, x in kept:
            own.setdefault(nearest(x)[1], []).append(x)
        centers = [[sum(v) // len(own[j]) for v in zip(*own[j])] if j in own else c for j, c in enumerate(centers)]
    found = [(i, *reversed(nearest(x))) for i, x in kept]
    sums = {}
    for _, j, d in found:
        sums[j] = sums.get(j, 0) + d
    fit = lambda v: v if v < 2**63 else None
    return [(i, j, fit(d), fit(sums[j]), fit(sum(sums.values())), hashlib.sha256(",".join(map(str, centers[j])).encode()).hexdigest()) for i, j, d in found]


def audit(docs, labels):
    """{(part, order, step): (kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)}, document by document.

    docs are (id, text, lang), labels (id, quality, toxic).
    """
    good, toxic = {i for i, q, _ in labels if q == 1} - {None}, {i for i, _, t in labels if t == 1} - {None}
    texts = {}
    for i, text, _ in docs:
        texts.setdefault(text or "", []).append(i)
    marked = {}
    for i, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
                  "D": bool(re.search("[#$%&*|]", text)), "E": i is not None and any(x is not None and x < i for x in texts[text])}
        marked.setdefault(lang or "", []).append((i, {f for f, x in failed.items() if x}))
    out = {}
    for part, rows in marked.items():
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            here = rows
            for step, f in enumerate(order, 1):
                removed = [r for r in here if f in r[1]]
                here = [r for r in here if f not in r[1]]
                shapley[f] += len(removed)
                out[part, "".join(order), step] = [len(here), len(removed), sum(f in r[1] for r in rows) - len(removed), sum(r[1] == {f} for r in rows),
                                                   sum(r[0] in good for r in removed), sum(r[0] in toxic for r in removed), f]
        for key, x in out.items():
            if key[0] == part:
                x[6] = shapley[x[6]]
    return {key: tuple(x) for key, x in out.items()}
