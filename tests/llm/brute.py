"""Plain versions of the operators for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import xxhash

BLANKS = " \t\n\x0b\f\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def remainder(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts


def removed_repeats(docs, length=100):
    """doc_id -> (n_bytes, n_removed, n_spans, kept) of [(doc_id, text)] with distinct ids."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs, key=lambda d: d[0]):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for at in range(len(data) - length + 1):
            window = data[at : at + length]
            if window in seen:
                gone[at : at + length] = True
            seen.add(window)
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out[doc_id] = (len(data), int(gone.sum()), runs, np.frombuffer(data, np.uint8)[~gone].tobytes())
    return out


def dedup_lines(docs, min_chars=20, min_docs=3):
    """doc_id -> (n_lines, n_dropped, kept)."""
    holders = defaultdict(set)
    keyed = {}
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        keyed[doc_id] = [(line, line.strip(BLANKS).translate(LOWER)) for line in lines]
        for _, key in keyed[doc_id]:
            if len(key) >= min_chars:
                holders[key].add(doc_id)
    out = {}
    for doc_id, lines in keyed.items():
        kept = [line for line, key in lines if len(holders[key]) < min_docs or max(holders[key]) == doc_id]
        out[doc_id] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def fingerprint(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(ids, linked):
    """id -> smallest id reachable over ``linked(i)``, the linked positions of position i."""
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in linked(i):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    least = defaultdict(list)
    for i in range(len(ids)):
        least[find(i)].append(ids[i])
    return {ids[i]: min(least[find(i)]) for i in range(len(ids))}


def near_fingerprints(docs, bits=4):
    ids = [d for d, _ in docs]
    codes = np.array([fingerprint(t) for _, t in docs], np.uint64)
    return grouped(ids, lambda i: np.flatnonzero(np.bitwise_count(codes ^ codes[i]) <= bits))


def words(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER)) if w]


def contaminated(docs, items, window=10):
    """doc_id -> (n_words, n_hit, sorted items)."""
    index = defaultdict(set)
    for item, text in items:
        own = words(text)
        for i in range(max(1, len(own) - window + 1) if own else 0):
            index[tuple(own[i : i + window])].add(str(item))
    sizes = sorted({len(k) for k in index})
    out = {}
    for doc_id, text in docs:
        own, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(own) - n + 1):
                if (phrase := tuple(own[i : i + n])) in index:
                    hit.update(range(i, i + n))
                    found |= index[phrase]
        out[doc_id] = (len(own), len(hit), sorted(found))
    return out


def targets(sizes, weights=(5, 2, 1), share=Fraction(3, 2), cap=2):
    """source -> target, by sharing out, capping and sharing again until nothing is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / total > cap * sizes[s]}
        if not above:
            out |= {s: left * weight[s] / total for s in open_}
            break
        for s in above:
            out[s] = Fraction(cap * sizes[s])
            left -= out[s]
        open_ -= above
    return out


def mixed(docs, repeats=2):
    """[(finish, rank, pass, key, doc_id)] taken, in order, of [(doc_id, text, source)] with distinct ids."""
    slices = math.isqrt(len(docs)) + 1
    size = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t, _ in docs}
    sizes = defaultdict(int)
    for doc_id, _, source in docs:
        sizes[source] += size[doc_id]
    target = targets(sizes)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    queue = []
    for rank, source in enumerate(order):
        keyed = [(hashlib.md5(str(d).encode()).hexdigest(), d) for d, _, s in docs if s == source and size[d]]
        keyed.sort(key=lambda k: (int(k[0][:12], 16) % slices, k))
        done = 0
        for turn in range(repeats):
            for key, doc_id in keyed:
                done += size[doc_id]
                queue.append((Fraction(done) / target[source], rank, turn, key, doc_id))
    queue.sort()
    taken, total, budget = [], 0, sum(target.values())
    for entry in queue:
        total += size[entry[4]]
        if total > budget:
            break
        taken.append(entry)
    return taken
