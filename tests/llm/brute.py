"""Plain Python versions of the training-data operators."""

import re
import unicodedata

import numpy as np
import xxhash

WORD = re.compile("[^\x20\x09-\x0d]+")


def size(text):
    return len(WORD.findall(text or ""))


def fingerprint(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, ids, distance=4):
    """The smallest id (None last) that each row reaches through links of fingerprints."""
    nodes = sorted(set(prints))
    up = {f: f for f in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    array = np.array(nodes, np.uint64)
    for i, f in enumerate(nodes):
        for j in np.flatnonzero(np.bitwise_count(array[i] ^ array[i + 1 :]) <= distance) + i + 1:
            up[find(f)] = find(nodes[j])
    least = {}
    for f, i in zip(prints, ids, strict=True):
        r = find(f)
        least[r] = min(least.get(r, i), i, key=lambda x: (x is None, x))
    return [least[find(f)] for f in prints]


def has_letter(text):
    return any(unicodedata.category(c)[0] == "L" for c in text or "")


SECRET_PATTERNS = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 12, 2),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 18, 0),
    ("hex", re.compile(r"[0-9a-f]+"), 16, 0),
)


def secrets(text):
    """Base spans in order: kind:start:end."""
    found = [(m.start(), k, m.end()) for k, (_, p, least, group) in enumerate(SECRET_PATTERNS) for m in p.finditer(text or "") if len(m.group(group)) >= least]
    return [f"{SECRET_PATTERNS[k][0]}:{a}:{b}" for a, k, b in sorted(found)]


def targets(sizes, weights=(5.0, 2.0, 1.0), cap=3.0):
    """Target by source: reshare the excess of full sources by weight until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = {}, float(sum(sizes.values()))
    while True:
        rest = [s for s in names if s not in full]
        left = total - sum(full.values())
        share = {s: left * w[s] / sum(w[r] for r in rest) for s in rest}
        above = [s for s in rest if share[s] > cap * sizes[s] + 1e-9]
        if not above:
            return full | share
        full |= {s: cap * sizes[s] for s in above}
