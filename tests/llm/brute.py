"""Plain Python versions of the corpus operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def roots(n: int, links) -> list[int]:
    """Smallest member of the component of each of 0..n-1."""
    up = list(range(n))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def simhash(docs, width=3, most=3):
    """``{id: (fingerprint, component)}``; ids are different."""
    docs = sorted(docs)
    prints = []
    for _, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII))
        parts = [" ".join(w[i:i + width]) for i in range(max(1, len(w) - width + 1))] if w else []
        hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
        prints.append(sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)))
    links = [(i, j) for i in range(len(docs)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= most]
    return {d: (f"{p:016x}", docs[r][0]) for (d, _), p, r in zip(docs, prints, roots(len(docs), links))}


def windows(docs, length=20):
    """``{id: (n_words, n_removed, kept)}``"""
    seen, out = {}, {}
    split = {d: re.findall(r"[^\x20\x09-\x0D]+", t or "") for d, t in sorted(docs)}
    for d, w in split.items():
        gone = [False] * len(w)
        for s in range(len(w) - length + 1):
            if seen.setdefault(tuple(w[s:s + length]), (d, s)) != (d, s):
                gone[s:s + length] = [True] * length
        out[d] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out


def byte_strings(docs, length=50):
    """``{id: (n_bytes, spans, kept)}``"""
    first, out = {}, {}
    split = {d: (t or "").encode() for d, t in sorted(docs)}
    for d, b in split.items():
        gone = [False] * len(b)
        for s in range(len(b) - length + 1):
            if first.setdefault(b[s:s + length], d) != d:
                gone[s:s + length] = [True] * length
        edges = [i for i, (x, y) in enumerate(zip([False, *gone], [*gone, False])) if x != y]
        out[d] = (len(b), list(zip(edges[::2], edges[1::2])), bytes(x for x, g in zip(b, gone) if not g))
    return out


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII))


def contamination(docs, items, window=10):
    """``{id: (n_words, hit words, items)}``"""
    known = defaultdict(set)
    for item, text in items:
        w = item_words(text)
        n = min(window, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            known[tuple(w[s:s + n])].add(str(item))
    out = {}
    for d, text in docs:
        w, hit, found = item_words(text), set(), set()
        for n in {len(k) for k in known}:
            for s in range(len(w) - n + 1):
                if named := known.get(tuple(w[s:s + n])):
                    hit.update(range(s, s + n))
                    found |= named
        out[d] = (len(w), len(hit), sorted(found))
    return out


def char_shingles(line: bytes, k=5):
    text = line.decode()
    return {text[i:i + k] for i in range(max(1, len(text) - k + 1))}


def lines(docs, similar=0.8):
    """``{id: (n_lines, n_removed, text)}``: exact components by a prefix-filtered join."""
    rows = [(d, i, s.encode()) for d, t in sorted(docs) for i, line in enumerate((t or "").split("\n")) if (s := line.strip(" \t\n\r\x0b\x0c"))]
    different = list(dict.fromkeys(r[2] for r in rows))
    sets = [char_shingles(x) for x in different]
    often = Counter(s for x in sets for s in x)
    held, links = defaultdict(list), []
    for n in range(len(sets)):
        order = sorted(sets[n], key=lambda s: (often[s], s))
        prefix = order[:len(order) - math.ceil(similar * len(order) - 1e-9) + 1]
        for c in {c for s in prefix for c in held[s]}:
            both = len(sets[n] & sets[c])
            if both >= similar * (len(sets[n]) + len(sets[c]) - both):
                links.append((n, c))
        for s in prefix:
            held[s].append(n)
    root = dict(zip(different, roots(len(different), links)))
    seen, gone, count = set(), defaultdict(set), Counter()
    for d, i, line in rows:
        count[d] += 1
        if root[line] in seen:
            gone[d].add(i)
        seen.add(root[line])
    return {d: (count[d], len(gone[d]), t and "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d])) for d, t in docs}


def vectors(rows, least=0.93):
    """``[(id, n_links, component)]`` of rows ``(id, vector, label)`` with different ids."""
    rows = sorted(rows, key=lambda r: r[0])

    def sound(v):
        return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)

    links, count = [], Counter()
    for i, (_, v, a) in enumerate(rows):
        for j, (_, w, b) in enumerate(rows[:i]):
            if a is not None and a == b and sound(v) and sound(w) and len(v) == len(w):
                x, y = np.array(v, float), np.array(w, float)
                if x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= least:
                    links.append((i, j))
                    count.update((i, j))
    return [(rows[i][0], count[i], rows[r][0]) for i, r in enumerate(roots(len(rows), links))]
