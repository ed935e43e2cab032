"""The operators said again, plainly, for small tables: lists of dicts in, rows out."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import xxhash

SPACE = " \t\n\x0b\x0c\r"


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def split_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def near_long(n):
    return max(-(2**63) + 1, min(2**63 - 1, n))


def top_k(rows, is_query, k=5):
    import math

    usable = [
        (i, [near_long(math.floor(Fraction(float(x)) * 256)) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, a in dict(r for r in usable if is_query(r[0])).items():
        scored = [(-near_long(sum(x * y for x, y in zip(a, b, strict=False))), i) for i, b in usable if i != q]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    values = [int(c) * (1 + n % 2) for n, c in enumerate(reversed(digits))]
    return sum(v - 9 * (v > 9) for v in values) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            valid = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if valid:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def line_dedup(rows, min_docs=10):
    def key(line):
        return lower(line.strip(SPACE))

    seen = defaultdict(set)
    for n, (_, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            seen[key(line)].add(n)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (key(x) and len(seen[key(x)]) >= min_docs)]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def substring_dedup(rows, window=13):
    late = float("inf")
    first = {}
    for doc, text in rows:
        w = split_words(text)
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, late), late if doc is None else doc)
    out = []
    for doc, text in rows:
        w = split_words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < (late if doc is None else doc):
                gone.update(range(i, i + window))
        out.append((doc, len(w), len(gone), " ".join(x for n, x in enumerate(w) if n not in gone)))
    return out


def shards(rows, n=16):
    sized = [(d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows]
    sized.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2], r[1]))
    total, begin, slots, out = sum(r[1] for r in sized), 0, defaultdict(int), []
    for doc, size, crc in sized:
        shard = min(n - 1, (2 * begin + size) * n // (2 * total))
        out.append((doc, size, crc, shard, slots[shard]))
        slots[shard] += 1
        begin += size
    return out


def fingerprint(text, length=3):
    w = split_words(lower(text or ""))
    runs = [" ".join(w[i : i + length]) for i in range(max(1, len(w) - length + 1))] if w else []
    counts = [0] * 64
    for run in runs:
        h = xxhash.xxh64_intdigest(run.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(runs))


def classes(prints, most_bits=3):
    """The index of each print's class, by the first member."""
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= most_bits:
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(prints))]


def simhash(rows):
    prints = [fingerprint(t) for _, t in rows]
    found = classes(prints)
    least = {}
    for (doc, _), c in zip(rows, found, strict=True):
        if doc is not None:
            least[c] = min(least.get(c, doc), doc)
    return [(d, f"{p:016x}", least.get(c)) for (d, _), p, c in zip(rows, prints, found, strict=True)]


def one_of_each(rows):
    """The (id, text) pairs that may stay: one per class, with its smallest id."""
    found = classes([fingerprint(t) for _, t in rows])
    best = {}
    for row, c in zip(rows, found, strict=True):
        order = (row[0] is None, row[0] or 0)
        if c not in best or order < best[c][0]:
            best[c] = (order, row)
    return [row for _, row in best.values()]


def targets(sizes, weights=(1, 2, 3), cap=3):
    """Shares of the total by weight; the excess over the cap is shared out again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[n % len(weights)] for n, s in enumerate(names)}
    fixed, left = {}, set(names)
    while left:
        rest = sum(sizes.values()) - sum(fixed.values())
        unit = rest / sum(weight[s] for s in left)
        over = {s for s in left if weight[s] * unit > cap * sizes[s]}
        if not over:
            return fixed | {s: weight[s] * unit for s in left}
        fixed |= {s: cap * sizes[s] for s in over}
        left -= over
    return fixed


def mixing(rows):
    """Rows (id, source, text) -> (id, size, source size, target, taken)."""
    sized = [(d, s, len(split_words(t)), _position(d, t)) for d, s, t in rows]
    sizes = defaultdict(int)
    for _, s, n, _ in sized:
        sizes[s] += n
    goal = targets(sizes)
    out, equal = [], defaultdict(int)
    for d, s, n, p in sized:
        rounds = int(goal[s] // sizes[s]) if sizes[s] else 0
        budget = goal[s] - rounds * sizes[s]
        before = sum(m for _, t, m, q in sized if t == s and q < p) + n * equal[s, p]
        equal[s, p] += 1
        last = budget > 0 and 2 * before + n <= 2 * budget
        out.append((d, n, sizes[s], goal[s], n * (rounds + last)))
    return out


def _position(doc, text):
    named = f"{'' if doc is None else doc}:{text or ''}"
    return int(hashlib.md5(named.encode()).hexdigest()[:15], 16)


def fold_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def contamination(rows, items, window=10, slop=0):
    """Rows (id, text) -> (id, words, hit, item ids, item ids within ``slop``)."""
    wins = []
    for item, text in items:
        w = fold_words(text)
        if item is None or not w:
            continue
        n = min(window, len(w))
        wins += [(item, w[i : i + n]) for i in range(len(w) - n + 1)]
    out = []
    for doc, text in rows:
        w = fold_words(text)
        hit, known, near = set(), set(), set()
        for item, win in wins:
            for i in range(-slop, len(w)):
                if i >= 0 and w[i : i + len(win)] == win:
                    hit.update(range(i, i + len(win)))
                    known.add(str(item))
                if slop and all(
                    x in w[max(0, i + n - slop) : max(0, i + n + slop + 1)] for n, x in enumerate(win)
                ):
                    near.add(str(item))
        out.append((doc, len(w), len(hit), sorted(known), sorted(near)))
    return out
