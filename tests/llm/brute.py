"""Plain versions of the operators, over Python lists, to compare with."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def roots(n, pairs):
    """The smallest place reachable from each."""
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def base_quality(text):
    w = words(text)
    seen, dups = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dups += line in seen
            seen.add(line)
    counts = Counter(zip(w, w[1:], w[2:]))
    hit = set()
    for i, window in enumerate(zip(w, w[1:], w[2:])):
        if counts[window] > 1:
            hit |= {i, i + 1, i + 2}
    failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dups, len(hit), failed


def fingerprint(text, shingle=4):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    parts = [" ".join(w[i : i + shingle]) for i in range(len(w) - shingle + 1)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_groups(docs, bits=4):
    """doc_id to (fingerprint, smallest id reachable)."""
    prints = [fingerprint(t) for _, t in docs]
    pairs = [(i, j) for i in range(len(docs)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= bits]
    order = roots(len(docs), pairs)
    least = defaultdict(list)
    for (d, _), r in zip(docs, order):
        least[r].append(d)
    return {d: (f"{p:016x}", min(least[r])) for (d, _), p, r in zip(docs, prints, order)}


def line_removals(docs, num=4, den=5):
    """doc_id to (lines with words, numbers of the lines that go), over (doc_id, text) in order."""
    first, earlier, gone = {}, [], set()
    every = []
    for d, t in sorted(docs):
        for k, line in enumerate((t or "").split("\n")):
            own = frozenset(words(line))
            if own:
                every.append((d, k, own))
                if own not in first:
                    first[own] = (d, k)
                    if any(den * len(own & x) >= num * len(own | x) for x in earlier):
                        gone.add(own)
                    earlier.append(own)
    out = {d: (0, []) for d, _ in docs}
    for d, k, own in every:
        n, away = out[d]
        out[d] = (n + 1, away + [k] * (first[own] != (d, k) or own in gone))
    return out


def targets(sizes, weights=(5, 2, 1), cap=3):
    """Source to target, by resharing until none is above its cap."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        level = (total - sum(fixed.values())) / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if weight[s] * level > cap * sizes[s]]
        if not over:
            return fixed | {s: weight[s] * level for s in free}
        fixed |= {s: cap * sizes[s] for s in over}


def uniform(seed, *parts):
    """The hash-made number of the mixture, written anew."""
    return int(hashlib.md5("\x01".join([str(seed), *map(str, parts)]).encode()).hexdigest()[:13], 16) / 2**52


def copies(docs, seed=17):
    """Times that each (doc_id, text, source) comes."""
    sizes = Counter()
    for _, t, s in docs:
        sizes[s] += len(words(t))
    aim = targets(sizes)
    out = []
    for d, t, s in docs:
        rate = aim[s] / sizes[s] if sizes[s] else 0
        out.append(math.floor(rate) + (uniform(seed, d, hashlib.md5((t or "").encode()).hexdigest()) < rate - math.floor(rate)))
    return out


def cosine_groups(vectors, threshold=0.9):
    """(links, smallest place reachable) of each row of a list of vectors, bad ones alone."""
    good = [v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v) for v in vectors]
    arrays = [np.array(v, float) if g else None for v, g in zip(vectors, good)]

    def linked(i, j):
        a, b = arrays[i], arrays[j]
        return good[i] and good[j] and len(a) == len(b) and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold

    pairs = [(i, j) for i in range(len(vectors)) for j in range(i) if linked(i, j)]
    counts = Counter(x for p in pairs for x in p)
    return [(counts[i], r) for i, r in enumerate(roots(len(vectors), pairs))]


def secret_spans(text):
    """(start, kind, end) of the fixed patterns."""
    out = []
    word = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_", "api"))
    word = word.replace("[aA][pP][iI]_|[aA][pP][iI]", "[aA][pP][iI]_?[kK][eE][yY]")
    for m in re.finditer(f"({word})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text or ""):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 24]
    return sorted(out)


def entropy_windows(run, width, least):
    """Joined windows of at least so many bits, each counted from the beginning."""
    out = []
    for i in range(len(run) - width + 1):
        counts = Counter(run[i : i + width]).values()
        if -sum(c / width * math.log2(c / width) for c in counts) >= least - 1e-9:
            if out and i <= out[-1][1]:
                out[-1] = (out[-1][0], i + width)
            else:
                out.append((i, i + width))
    return out


def best_spread(sizes, shards):
    """The least difference between the largest and the smallest shard, over all ways."""
    best = math.inf
    for way in range(shards ** len(sizes)):
        sums = [0] * shards
        for s in sizes:
            sums[way % shards] += s
            way //= shards
        best = min(best, max(sums) - min(sums))
    return best
