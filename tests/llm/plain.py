"""Plain versions of the operators' results, in memory, one document at a time."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import xxhash

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def utf8(text):
    return (text or "").encode()


def roots(n, links):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        up[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]


def fingerprint(text, k=3):
    w = utf8(text).translate(LOWER).split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + k]), 42) for i in range(max(1, len(w) - k + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def simhash(docs):
    """[(doc_id, fingerprint, component)] for (doc_id, text) rows."""
    fps = [fingerprint(t) for _, t in docs]
    links = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2]
    root = roots(len(docs), links)
    least = defaultdict(list)
    for (d, _), r in zip(docs, root):
        if d is not None:
            least[r].append(d)
    return [(d, format(f, "016x"), min(least[r], default=None)) for (d, _), f, r in zip(docs, fps, root)]


def byte_repeats(docs, k=400):
    seen = Counter()
    texts = [utf8(t) for _, t in docs]
    for b in texts:
        for i in range(len(b) - k + 1):
            seen[b[i:i + k]] += 1
    out = []
    for (d, _), b in zip(docs, texts):
        gone, end = bytearray(len(b)), 0
        for i in range(len(b) - k + 1):
            if seen[b[i:i + k]] > 1:
                for j in range(max(end, i), i + k):
                    gone[j] = 1
                end = i + k
        spans = sum(1 for i, x in enumerate(gone) if x and (not i or not gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


def word_repeats(docs, k=20):
    first = {}
    for d, t in docs:
        w = utf8(t).split()
        for i in range(len(w) - k + 1):
            at = (d is not None, d or 0, i)
            x = tuple(w[i:i + k])
            first[x] = min(first.get(x, at), at)
    out = []
    for d, t in docs:
        w = utf8(t).split()
        gone = bytearray(len(w))
        for i in range(len(w) - k + 1):
            if first[tuple(w[i:i + k])] < (d is not None, d or 0, i):
                gone[i:i + k] = b"\1" * k
        out.append((d, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()))
    return out


def quality_base(text):
    b = utf8(text)
    w = b.split()
    lines = [x for x in b.split(b"\n") if x.split()]
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    count = Counter(windows)
    cover = {j for i, x in enumerate(windows) if count[x] > 1 for j in range(i, i + 8)}
    n = len(w)
    return (n, sum(len(x.decode()) for x in w), sum(b.count(c) for c in b"#*$%&|<>"), len(lines) - len(set(lines)), len(cover),
            n < 20 or 100 * len(cover) > 30 * n)


def base_scores(docs):
    words = [utf8(t).translate(LOWER).split() + [None] for _, t in docs]
    out = [zlib.crc32(str(d).encode() if d is not None else b"") % 7 == 2 for d, _ in docs]
    c = Counter(x for w, o in zip(words, out) if not o for x in w)
    n, v = sum(c.values()), len(c)
    return [(d, o, len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w))
            for (d, _), o, w in zip(docs, out, words)]


def removed_lines(docs, k=5, similarity=0.8):
    places = defaultdict(list)
    for d, t in docs:
        for i, x in enumerate((t or "").split("\n")):
            if x.strip(" \t\n\r\x0b\x0c"):
                places[x].append((d is not None, d or 0, i))
    lines = list(places)
    sets = [frozenset(x[i:i + k] for i in range(max(1, len(x) - k + 1))) for x in lines]
    links = [(i, j) for i in range(len(lines)) for j in range(i)
             if len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j])]
    root = roots(len(lines), links)
    least = {}
    for x, r in zip(lines, root):
        least[r] = min(least.get(r, min(places[x])), min(places[x]))
    gone = defaultdict(list)
    for x, r in zip(lines, root):
        for p in places[x]:
            if p != least[r]:
                gone[p[1] if p[0] else None].append(p[2])
    return {d: sorted(v) for d, v in gone.items()}


def leaks(docs, items, k=5, similarity=0.8):
    def words(t):
        return utf8(t).decode().lower().encode().split()

    def shingles(w, n):
        return [tuple(w[i:i + n]) for i in range(len(w) - n + 1)]

    found = defaultdict(set)
    for item, t in items:
        own = words(t)
        if not own:
            continue
        n = min(k, len(own))
        want = Counter(shingles(own, n))
        for d, text in docs:
            s = shingles(words(text), n)
            if not any(x in want for x in s):
                continue
            size = len(own) - n + 1
            for i in range(len(s) - size + 1):
                both = sum((Counter(s[i:i + size]) & want).values())
                if both >= similarity * (2 * size - both):
                    found[d].add(item)
                    break
    return {d: sorted(v) for d, v in found.items()}


def suffix_scores(train, texts, depth, min_count, divergence, smoothing):
    """log10 probability of normal texts under the longest suffix states."""
    seen, total = Counter(), Counter()
    for t in train:
        past = b"\n" * depth + t + b"\n"
        for i in range(depth, len(past)):
            for k in range(depth + 1):
                seen[(past[i - k:i], past[i])] += 1
                total[past[i - k:i]] += 1

    def p(s, b):
        if not s:
            return (seen[(s, b)] + 1 / 257) / (total[s] + 1)
        own = {x: seen[(s, x)] for x in range(256) if seen[(s, x)]}
        gain = sum(m * math.log(m / total[s] / p(s[1:], x)) for x, m in own.items())
        if total[s] < min_count or gain <= divergence * len(own):
            return p(s[1:], b)
        weight = smoothing * len(own)
        return (seen[(s, b)] + weight * p(s[1:], b)) / (total[s] + weight)

    out = []
    for t in texts:
        past = b"\n" * depth + t + b"\n"
        out.append(sum(math.log10(p(past[i - depth:i], past[i])) for i in range(depth, len(past))))
    return out
