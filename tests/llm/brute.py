"""Plain versions of the operators, a document at a time."""

import hashlib
import re

SPACE = " \t\n\x0b\f\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [w for w in re.split("[ \t\n\x0b\f\r]+", text or "") if w]


def shingles(text, k=5):
    w = words((text or "").translate(LOWER))
    if not w:
        return set()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))}


def near_duplicates(data, percent=75):
    """{row number: (set size, component, kept)}"""
    sets = [shingles(t) for _, t in data]
    parent = list(range(len(data)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            near = both and 100 * both >= percent * len(sets[i] | sets[j])
            # Rows under one doc_id are one document, where they have words.
            one = data[i][0] is not None and data[i][0] == data[j][0] and sets[i] and sets[j]
            if near or one:
                parent[top(i)] = top(j)
    out = {}
    for i in range(len(data)):
        ids = [data[j][0] for j in range(len(data)) if top(j) == top(i) and data[j][0] is not None]
        c = min(ids) if ids else None
        out[i] = (len(sets[i]), c, c is None or data[i][0] == c)
    return out


def contained(data, items, percent=75):
    out = []
    for item, text in dict.fromkeys(items):
        w = words((text or "").translate(LOWER))
        q = shingles(text)
        for d, t in data:
            # A short item is a run of its words.
            n = len(q & shingles(t, len(w) if 0 < len(w) < 5 else 5))
            if q and 100 * n >= percent * len(q):
                out.append((d, item, len(q), n, n / len(q)))
    return out


def base_statistics(text):
    t = text or ""
    w = words(t)
    grams = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    held = {g for g in grams if grams.count(g) > 1}
    covered = {i + j for i, g in enumerate(grams) if g in held for j in range(8)}
    lines = [x for x in t.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def maglev(shards, slots, number):
    """The table slot by slot, with explicit permutations."""
    order = []
    for s in shards:
        o, k = number("offset:" + s) % slots, number("step:" + s) % (slots - 1) + 1
        order.append([(o + j * k) % slots for j in range(slots)])
    owner, at, left = [None] * slots, [0] * len(shards), slots
    while left:
        for i in range(len(shards)):
            free = next(j for j in order[i][at[i] :] if owner[j] is None)
            at[i] = order[i].index(free)
            owner[free] = i
            left -= 1
            if not left:
                break
    return owner


def secrets(text):
    t = text or ""
    key = "(password|passwd|secret|token|api_?key)"
    found = []
    for m in re.finditer(key + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A):
        if len(m.group(2)) >= 8:
            found.append((m.start(), 0, "assign", m.end()))
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 32]
    n = tuple(sum(f[1] == k for f in found) for k in range(3))
    line = ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))
    return n, hashlib.sha256(line.encode()).hexdigest(), line
