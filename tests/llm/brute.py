"""Plain versions of the operators, pair by pair and character by character."""

import hashlib
import math
import re
import zlib

import numpy as np
import xxhash

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORDS.findall(text or "")


def components(nodes, links):
    """Smallest reachable node of each node."""
    near = {n: set() for n in nodes}
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for n in sorted(nodes):
        if n in out:
            continue
        todo = [n]
        while todo:
            x = todo.pop()
            if x not in out:
                out[x] = n
                todo += near[x]
    return out


def simhash(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def base_counts(text):
    t = text or ""
    w = words(t)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    hit = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(3)}
    lines = t.split("\n")
    dup = sum(1 for i, x in enumerate(lines) if words(x) and x in lines[:i])
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(hit)


def cosine(x, y):
    x, y = (np.array(v, dtype=np.float64) / max(map(abs, v)) for v in (x, y))
    return float(x @ y) / math.sqrt(float(x @ x)) / math.sqrt(float(y @ y))


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
