"""Plain versions of the operators for small tables."""

import hashlib
import re

import numpy as np
import xxhash


def reach(nodes, links):
    """Smallest node reachable from each node."""
    low = {n: n for n in nodes}

    def root(n):
        while low[n] != n:
            n = low[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        low[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def simhash(text):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[k : k + 4]) for k in range(max(1, len(w) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_rows(docs):
    fp = {d: simhash(t) for d, t in docs}
    ids = sorted(fp)
    array = np.array([fp[d] for d in ids], np.uint64)
    links = []
    for k, d in enumerate(ids):
        near = np.flatnonzero(np.bitwise_count(array[:k] ^ array[k]) <= 4)
        links += [(ids[m], d) for m in near]
    low = reach(ids, links)
    return {(d, f"{fp[d]:016x}", low[d]) for d in ids}


def vector_rows(vectors, threshold=0.9):
    ids = [v for v, _ in vectors]
    units = {}
    for v, x in vectors:
        if x is not None and len(x) and all(c is not None and np.isfinite(c) for c in x) and any(x):
            a = np.array(x, float)
            units[v] = a / np.linalg.norm(a)
    links = [(a, b) for a in units for b in units if a < b and len(units[a]) == len(units[b]) and units[a] @ units[b] >= threshold]
    low = reach(ids, links)
    count = dict.fromkeys(ids, 0)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    return {(v, count[v], low[v], low[v] == v) for v in ids}


def repeated_windows(docs, length=35):
    """(key, n words, n removed, SHA-256 of the kept words) per row of docs."""
    seen = {}
    parts = [words(t) for _, t in docs]
    for k, w in enumerate(parts):
        for p in range(len(w) - length + 1):
            seen.setdefault(tuple(w[p : p + length]), []).append((k, p))
    gone = [set() for _ in parts]
    for places in seen.values():
        if len(places) > 1:
            for k, p in places:
                gone[k].update(range(p, p + length))
    out = []
    for (key, _), w, g in zip(docs, parts, gone):
        kept = " ".join(x for i, x in enumerate(w) if i not in g)
        out.append((key, len(w), len(g), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def edits(a, b):
    """Word edit distance."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def line_dedup(docs, least=8):
    """Kept text per document; docs is ordered by key."""
    seen, out = [], {}
    for key, text in docs:
        if text is None:
            out[key] = None
            continue
        kept, full = [], 0
        for line in text.split("\n"):
            norm = re.sub(r"\s+", " ", line, flags=re.ASCII).lower().strip(" ").split(" ")
            if norm == [""]:
                kept.append(line)
                continue
            same = any(norm == s for s in seen)
            near = len(norm) >= least and any(len(s) >= least and abs(len(s) - len(norm)) < 2 and edits(norm, s) <= 1 for s in seen)
            seen.append(norm)
            if not same and not near:
                kept.append(line)
                full += 1
        total = sum(bool(x.strip()) for x in text.split("\n"))
        out[key] = "" if total and not full else "\n".join(kept)
    return out
