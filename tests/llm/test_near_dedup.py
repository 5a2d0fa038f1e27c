import random

import brute
import numpy as np
import pytest

from screenline.llm import components, near_dedup


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10**6)}"
    return " ".join(out)


def corpus(seed=1):
    rng = random.Random(seed)
    data = []
    for g in range(6):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.randrange(20, 150))]
        for _ in range(rng.randrange(2, 12)):
            data.append((len(data), edited(rng, base, rng.randrange(0, 6))))
    base = [f"v{rng.randrange(4000)}" for _ in range(120)]
    data += [(1000 + i, edited(rng, base, i % 8)) for i in range(60)]
    data += [(2000 + i, " ".join(base)) for i in range(20)]
    data += [(3000 + i, " ".join(f"u{rng.randrange(9000)}" for _ in range(40))) for i in range(20)]
    data += [(4000, None), (4001, ""), (4002, " \n\t"), (4003, "a b"), (4004, "A B"), (4005, "a  b c"), (None, "a b"),
             (None, "only here one two three"), (None, "only here one two three"), (None, None),
             (4006, "x y z " * 3000), (4007, "x y z " * 2999), (1000, data[3][1]), (5, data[5][1]), (5, data[5][1])]
    rng.shuffle(data)
    return data


def check(df, data):
    want = sorted(((d, *w) for (d, _), w in zip(data, brute.near_duplicates(data).values(), strict=True)), key=str)
    assert sorted((tuple(r) for r in df.collect()), key=str) == want


def test_equals_brute_force(docs):
    data = corpus()
    check(near_dedup.near_duplicates(docs(data)), data)


def test_large_groups_in_blocks(docs, monkeypatch):
    monkeypatch.setattr(near_dedup, "HOT", 3)
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    data = corpus(2)
    check(near_dedup.near_duplicates(docs(data)), data)


def test_empty(docs):
    assert near_dedup.near_duplicates(docs([])).count() == 0
    assert near_dedup.drop_near_duplicates(docs([])).count() == 0


def test_one_of_each_group_stays(docs):
    data = corpus(3)
    df = docs(data)
    left = near_dedup.drop_near_duplicates(df)
    assert left.columns == df.columns
    got = [tuple(r)[:2] for r in left.collect()]
    want = brute.near_duplicates(data)
    named = {d for (d, _), (_, c, kept) in zip(data, want.values(), strict=True) if kept and d is not None}
    assert sorted(d for d, _ in got if d is not None) == sorted(named)
    assert sorted(str(t) for d, t in got if d is None) == ["None", "only here one two three"]


def test_bit_counts_estimate_similarity(docs):
    rng = np.random.default_rng(0)
    x = rng.integers(0, 1 << 63, 600, dtype=np.uint64)
    for share in (0.0, 0.5, 0.75, 0.95):
        k = int(600 * 2 * share / (1 + share))
        y = np.concatenate([x[:k], rng.integers(0, 1 << 63, 600 - k, dtype=np.uint64)])
        p, q = (near_dedup.packed(near_dedup.minima(np.sort(s))) for s in (x, y))
        w = near_dedup.WORDS
        differ = int(np.bitwise_count((p[:w] ^ q[:w]) | (p[w:] ^ q[w:])).sum())
        assert (1 - differ / near_dedup.HASHES - 0.25) / 0.75 == pytest.approx(share, abs=0.17)


def test_common_is_exact():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 9000, rng.integers(0, 6000))).astype(np.int64) for _ in range(14)]
    got = near_dedup.common(sets[:5], sets[5:])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[5:]] for a in sets[:5]]


@pytest.mark.parametrize("seed", range(3))
def test_components(rows, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(100 + i, 101 + i) for i in range(30)] + [(7, 7), (None, 3)]
    low = {}
    for a, b in links:
        if a is not None and a != b:
            low.setdefault(a, a), low.setdefault(b, b)
    for _ in range(100):
        for a, b in links:
            if a in low and b in low:
                low[a] = low[b] = min(low[a], low[b])
    got = {r["node"]: r["component"] for r in components.components(rows(links, "a long, b long")).collect()}
    assert got == low
