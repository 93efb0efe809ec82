"""Plain versions of the operators, quadratic or in memory, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def quality(docs):
    out = {}
    for doc, text in docs:
        words = WORD.findall(text or "")
        seen = Counter(zip(words, words[1:], words[2:], strict=False))
        hit = {i + j for i, t in enumerate(zip(words, words[1:], words[2:], strict=False)) if seen[t] > 1 for j in range(3)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
        out[doc] = (
            len(words),
            sum(map(len, words)),
            sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)),
            len(hit),
            failed,
        )
    return out


def repeated_strings(docs, length=200):
    """docs: list of (id, text), ids may repeat. In order: n_bytes, n_removed, n_spans, kept_sha256."""
    raw = [(t or "").encode() for _, t in docs]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone, strict=True) if not g))))
    return out


def repeated_windows(docs, window=20):
    words = [WORD.findall(t or "") for _, t in docs]
    first = {}
    for (doc, _), w in zip(docs, words, strict=True):
        for i in range(len(w) - window + 1):
            key, place = tuple(w[i : i + window]), ((doc is not None, doc or 0), i)
            first[key] = min(first.get(key, place), place)
    out = []
    for (doc, _), w in zip(docs, words, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < ((doc is not None, doc or 0), i):
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone).encode())))
    return out


def fingerprint(text, shingle=4):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(docs, budget=4):
    prints = [fingerprint(t) for _, t in docs]
    distinct = sorted(set(prints))
    parent = {f: f for f in distinct}

    def find(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= budget:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    smallest = defaultdict(lambda: None)
    for (doc, _), f in zip(docs, prints, strict=True):
        if doc is not None:
            root = find(f)
            smallest[root] = doc if smallest[root] is None else min(smallest[root], doc)
    return [(f"{f:016x}", smallest[find(f)]) for f in prints]


def neighbours(rows, is_query, k=10):
    """rows: (id, vector or None). query, rank, id and distance of the k nearest, by plain loops."""
    use = {}
    for i, v in rows:
        if i is None or v is None or not len(v) or any(x is None or x != x or abs(x) == float("inf") for x in v):
            continue
        if any(v) and (i not in use or list(v) < use[i]):
            use[i] = list(v)
    out = []
    for q, a in use.items():
        if is_query(q):
            near = sorted(
                (sum((x - y) ** 2 for x, y in zip(a, b, strict=True)) ** 0.5, i)
                for i, b in use.items()
                if i != q and len(a) == len(b)
            )[:k]
            out += [(q, r + 1, i, d) for r, (d, i) in enumerate(near)]
    return out


def licences(text, templates, threshold):
    """(line, licence, dice) of the passages of a text."""

    def grams(passage):
        words = re.findall("[a-z0-9]+", passage.lower())
        return set(zip(words, words[1:], strict=False))

    text = text or ""
    lines = text.split("\n")
    out = []
    for line, passage in [(-1, text), *(enumerate(lines) if len(lines) > 1 else ())]:
        own, best = grams(passage), None
        for name, body in templates.items():
            other = grams(body)
            if other and own:
                dice = 2 * len(own & other) / (len(own) + len(other))
                if dice >= threshold and (best is None or (-dice, name) < (-best[2], best[1])):
                    best = (line, name, dice)
        out += [best] if best else []
    return out


def best_fit(sizes, sources, clusters, capacity):
    """Bins as lists of items; every bin is looked at for every item."""
    bins = []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = []
        for b, items in enumerate(bins):
            left = capacity - sum(sizes[j] for j in items)
            clash = any(
                (sources[i] >= 0 and sources[i] == sources[j]) or (clusters[i] >= 0 and clusters[i] == clusters[j])
                for j in items
            )
            if left >= sizes[i] and not clash:
                fits.append((left, b))
        if fits:
            bins[min(fits)[1]].append(i)
        else:
            bins.append([i])
    return bins
