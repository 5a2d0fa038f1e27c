"""The other operators against plain versions, on small tables with nulls,
empty and very long texts, ties, repeated rows and clashing column names."""

import random
import zlib
from collections import Counter
from fractions import Fraction

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from screenline.llm import (
    decontaminate,
    language_id,
    license_scan,
    mixing,
    quality_rules,
    recurrent_lm,
    secret_scan,
    sharding,
    token_counts,
)
from screenline.llm import shingles as sh

LETTERS = "abcdefghijklmnopqrstuvwxyz"
ODD = [(900, None), (901, ""), (902, " \n\t "), (None, "no id here"), (903, "?!? 12 34"), (904, "long " * 30_000), (905, "é" * 50)]


def prose(rng, n, letters=LETTERS):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(1, 8))) for _ in range(n))


def as_set(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# Decontamination


def leaks(seed):
    rng = random.Random(seed)
    sizes = [1, 3, 4, 5, 6, 7, 8, 9, 12, 20, 35, 60, 130]
    items = [(i, prose(rng, n)) for i, n in enumerate(sizes * 2)]
    items += [(50, None), (51, ""), (None, prose(rng, 15)), items[9], (52, items[9][1].upper())]
    data = []
    for i in range(60):
        text = prose(rng, rng.randrange(0, 300)).split(" ")
        for _, t in rng.sample(items, 2):
            w = (t or "").split(" ")
            k = rng.randrange(len(w) + 1)
            place = rng.randrange(len(text) + 1)
            # Whole items, and parts on both sides of the threshold.
            text[place:place] = w if i % 2 else w[k:]
        data.append((i, " ".join(text)))
    return data + [(i, t) for i, t in items if i is not None] + ODD + [data[1], data[1]], items


def test_contained_items(docs, rows):
    data, items = leaks(4)
    found = decontaminate.contained_items(docs(data), rows(items, "item_id long, text string"))
    assert as_set(found) == sorted(brute.contained(data, items), key=str)


def test_short_and_long_items(docs, rows):
    """A few words among others; one item of 20,000 words beside short texts."""
    import tracemalloc

    rng = random.Random(3)
    items = [(1, "alpha beta gamma"), (2, "Delta"), (3, "one two three four"), (4, prose(rng, 20_000)), (5, prose(rng, 400))]
    data = [(1, "x ALPHA  beta\ngamma y"), (2, "alpha beta"), (3, "gamma alpha beta"), (4, "deltas delta."), (5, "a delta b"), (6, "one two three four")]
    data += [(7, items[3][1][: len(items[3][1]) * 4 // 5]), (8, items[3][1][: len(items[3][1]) // 2]), (9, "u " + items[4][1]), (10, "beta gamma")]
    data += [(100 + i, prose(rng, 20)) for i in range(1000)]
    want = brute.contained(data, items)
    assert {(d, i) for d, i, *_ in want} == {(1, 1), (5, 2), (6, 3), (7, 4), (9, 5)}
    assert as_set(decontaminate.contained_items(docs(data), rows(items, "item_id long, text string"))) == sorted(want, key=str)
    block = decontaminate.Items(items)
    texts = pa.array([t for _, t in data[10:]])
    tracemalloc.start()
    assert list(block.found(texts, 75)) == []
    assert tracemalloc.get_traced_memory()[1] < 60 << 20
    tracemalloc.stop()


def test_blocks_of_items(docs, rows, monkeypatch):
    monkeypatch.setattr(decontaminate, "ITEMS", 5)
    data, items = leaks(5)
    want = brute.contained(data, items)
    found = decontaminate.contained_items(docs(data), rows(items, "item_id long, text string"))
    assert as_set(found) == sorted(want, key=str)
    left = decontaminate.drop_contaminated(docs(data), rows(items, "item_id long, text string"))
    hit = {i for i, *_ in brute.contained([(i, t) for i, (_, t) in enumerate(data)], items)}
    assert left.columns == docs(data).columns
    assert sorted((tuple(r)[:2] for r in left.collect()), key=str) == sorted(
        (d for i, d in enumerate(data) if i not in hit), key=str
    )


def test_contained_items_of_empty_tables(docs, rows):
    none = rows([], "item_id long, text string")
    assert decontaminate.contained_items(docs([(1, "a b c d e f")]), none).count() == 0
    assert decontaminate.contained_items(docs([]), rows([(1, "a b c d e f")], "item_id long, text string")).count() == 0
    assert decontaminate.drop_contaminated(docs([(1, "a")]), none).count() == 1


# Sharding


@pytest.mark.parametrize(("shards", "slots"), [(1, 2), (3, 7), (5, 101), (7, 211), (11, 11)])
def test_lookup_table(shards, slots):
    names = sharding.shard_names(shards)
    table = sharding.lookup_table(names, slots)
    assert table.tolist() == brute.maglev(names, slots, sharding._number)
    n = Counter(table.tolist())
    assert max(n.values()) - min(n.values()) <= 1


def test_taking_a_shard_away_moves_little():
    names = sharding.shard_names(10)
    whole, less = sharding.lookup_table(names, 10_007), sharding.lookup_table(names[:-1], 10_007)
    stay = whole != 9
    assert (whole[stay] != less[stay]).mean() < 0.15


def test_place(docs, spark):
    data = [(i, "t") for i in range(500)] + ODD + [(3, "t")]
    df = docs(data).withColumnRenamed("component", "slot")
    out = sharding.place(df, ["doc_id"], sharding.shard_names(4), 211)
    assert out.count() == len(data)
    assert out.columns == [c for c in df.columns if c != "slot"] + ["slot", "shard"]
    table = sharding.lookup_table(sharding.shard_names(4), 211)
    by_id = {}
    for r in out.collect():
        assert r["shard"] == sharding.shard_names(4)[table[r["slot"]]]
        assert by_id.setdefault(r["doc_id"], r["slot"]) == r["slot"]
    assert sharding.place(docs([]), ["doc_id"]).count() == 0
    for bad in (([], 7), (["a", "a"], 7), (["a"], 8)):
        with pytest.raises(ValueError):
            sharding.lookup_table(*bad)


def test_write_shards(docs, spark, tmp_path):
    out = sharding.place(docs([(i, "t") for i in range(100)]), ["doc_id"], sharding.shard_names(3), 7)
    sharding.write_shards(out, str(tmp_path / "s"), 2)
    assert spark.read.parquet(str(tmp_path / "s")).groupBy("shard").count().count() == 3


# Quality rules


def test_base_statistics(docs):
    rng = random.Random(6)
    data = [(i, prose(rng, rng.randrange(0, 60), "ab #*$\n\t")) for i in range(60)]
    data += [(100 + i, " ".join(rng.choice("xyz") for _ in range(rng.randrange(0, 120)))) for i in range(40)]
    data += [(200, "one line\none line\n\n \none line \none line"), (201, "a b c d e f g h " * 3), (202, "𝔘𝔫 | ſ é"), *ODD]
    out = quality_rules.judged(docs(data), []).select("_row.doc_id", *quality_rules.BASE, "base_failed", "kept")
    want = []
    for d, t in data:
        s = brute.base_statistics(t) if d != 904 else (30_000, 120_000, 0, 0, 30_000)
        bad = s[0] < 20 or 100 * s[4] > 30 * s[0]
        want.append((d, *s, bad, not bad))
    assert as_set(out) == sorted(want, key=str)


def test_learned_rules_find_junk(docs, rows):
    rng = random.Random(7)
    good = [(i, prose(rng, 80) + ".") for i in range(300)]
    junk = [(1000 + i, " ".join(w + "#$" for w in prose(rng, 60).split())) for i in range(60)]
    junk += [(2000 + i, prose(rng, 60).upper()) for i in range(60)]
    labels = [(i, 1, 0) for i, _ in good[::2]] + [(i, 0, 0) for i, _ in junk[::2]] + [(None, 0, 0), (5, None, 0), (77777, 0, 0)]
    labels = rows(labels, "doc_id long, quality int, toxic int")
    df = docs(good + junk + ODD)
    rules = quality_rules.learned_rules(df, labels)
    assert rules
    out = {r["doc_id"]: r["kept"] for r in quality_rules.judged(df, rules).select("_row.doc_id", "kept").collect()}
    assert all(out[i] for i, _ in good)
    assert not any(out[i] for i, _ in junk)
    left = quality_rules.keep_good(df, labels)
    assert left.columns == df.columns
    assert left.count() == sum(out.values())


def test_no_labels_no_rules(docs, rows):
    none = rows([], "doc_id long, quality int, toxic int")
    assert quality_rules.learned_rules(docs([(1, "a b")]), none) == []
    assert quality_rules.keep_good(docs([]), none).count() == 0
    assert quality_rules.learn(np.ones((5, 9)), np.ones(5, bool)) == []


# Mixing


@pytest.mark.parametrize("seed", range(8))
def test_sainte_lague_seat_by_seat(seed):
    rng = random.Random(seed)
    weights = [Fraction(rng.randrange(0, 1000), rng.randrange(1, 9)) for _ in range(rng.randrange(1, 12))]
    seats, most = rng.randrange(0, 200), [rng.randrange(0, 60) for _ in weights]
    for cap in (None, most):
        got = [0] * len(weights)
        for _ in range(seats):
            open_ = [i for i, w in enumerate(weights) if w and (cap is None or got[i] < cap[i])]
            if not open_:
                break
            got[max(open_, key=lambda i: (weights[i] / (2 * got[i] + 1), -i))] += 1
        assert mixing.sainte_lague(weights, seats, cap) == got


def mix_data(seed):
    rng = random.Random(seed)
    data = [(i, prose(rng, rng.randrange(0, 200)), "en", rng.choice(["a", "a", "a", "a", "b", "c", "ä", None, ""])) for i in range(300)]
    return data + [(d, t, None, "z") for d, t in ODD if d != 904] + [(7, "x y z", None, "a"), (7, "x y z", None, "a")]


def test_mix(docs):
    data = mix_data(8)
    rows = mixing.mix(docs(data)).collect()
    assert len(rows) == len(data)
    size = Counter()
    for _, t, _, s in data:
        size[s] += len(brute.words(t))
    names = sorted((s for s in size if s is not None)) + [None]
    want = dict(zip(names, mixing.targets([size[s] for s in names], [i % 3 + 1 for i in range(len(names))]), strict=True))
    assert sum(want.values()) == sum(size.values())
    assert all(want[s] <= 3 * size[s] for s in names)
    taken = Counter()
    by_size = {size[s]: s for s in names}
    for r in rows:
        s = by_size[r["source_size"]]
        assert r["taken"] <= 3 * r["size"]
        assert r["target"] == pytest.approx(float(want[s]))
        taken[s] += r["taken"]
    for s in names:
        assert abs(taken[s] - want[s]) <= mixing.BLOCK * 1.5 + 1
    assert as_set(mixing.mix(docs(data))) == sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("most", [10_000, 7])
def test_small_sources_come_near_their_targets(spark, docs, monkeypatch, most):
    """Beside large sources, and when there are nothing else; planned in the
    driver and in tasks."""
    monkeypatch.setattr(mixing, "MOST_SOURCES", most)
    for sizes in ([1, 8, 10, 20, 33, 65, 200, 5_000, 20_000, 60_000], [10] * 300, [0, 0, 0], [3]):
        data = []
        for i, n in enumerate(sizes):
            for k in range(0, max(n, 1), 700):
                data.append((len(data), "w " * min(700, n - k), None, f"s{i:04d}" if i else None))
        size = Counter()
        for _, t, _, s in data:
            size[s] += len(brute.words(t))
        names = sorted((s for s in size if s is not None)) + [None]
        want = dict(zip(names, mixing.targets([size[s] for s in names], [i % 3 + 1 for i in range(len(names))]), strict=True))
        of, taken = {d: s for d, _, _, s in data}, Counter()
        for r in mixing.mix(docs(data)).collect():
            assert r["taken"] <= 3 * r["size"] and r["target"] == pytest.approx(float(want[of[r["doc_id"]]]))
            taken[of[r["doc_id"]]] += r["taken"]
        for s in names:
            assert abs(taken[s] - want[s]) <= max(1, want[s] / 100)


def test_as_many_sources_as_there_are(spark, rows):
    n = 20_001
    d = rows([(i, "a b c d e f g h i j", f"s{i}") for i in range(n)], "doc_id long, text string, source string")
    got = mixing.mix(d).groupBy("target").agg({"taken": "sum", "doc_id": "count"}).collect()
    assert len(got) == 3 and sum(r["count(doc_id)"] for r in got) == n
    for r in got:
        assert abs(r["sum(taken)"] / r["count(doc_id)"] - r["target"]) <= 1


def test_mixed_texts_hold_the_words_taken(docs):
    data = mix_data(9)
    want = {}
    for r in mixing.mix(docs(data)).collect():
        want[r["doc_id"]] = want.get(r["doc_id"], 0) + r["taken"]
    df = docs(data)
    out = mixing.mixed(df)
    assert out.columns == df.columns
    got, texts = Counter(), {}
    for d, t, *_ in data:
        texts.setdefault(d, []).append(brute.words(t))
    for r in out.collect():
        w = brute.words(r["text"])
        got[r["doc_id"]] += len(w)
        assert r["n_chars"] == len(r["text"])
        assert any(set(w) <= set(t) and len(w) <= len(t) for t in texts[r["doc_id"]])
    assert got == Counter({d: n for d, n in want.items() if n})
    assert mixing.mix(docs([])).count() == 0
    assert mixing.mixed(docs([(1, None, None, "a")])).count() == 0


# License scan


def test_licenses(docs):
    rng = random.Random(10)
    data = []
    for i in range(80):
        text = prose(rng, rng.randrange(0, 60)).split(" ")
        for _ in range(rng.randrange(0, 3)):
            w = rng.choice(license_scan.TEMPLATES)[1].split(" ")
            k = rng.choice([0, 0, 1, 2])
            at = rng.randrange(len(text) + 1)
            text[at:at] = w[k:]
        data.append((i, " ".join(text).replace(" ", rng.choice([" ", "\n", ", "]))))
    data += ODD + [data[2], data[2]]
    got = {(r["doc_id"], r["license"]): (r["n_shingles"], r["n_common"]) for r in license_scan.find_licenses(docs(data)).collect()}
    want = {}
    for d, t in data:
        w = ["".join(c if c.isalnum() or ord(c) > 127 else " " for c in (t or "").translate(brute.LOWER))][0].split()
        for name, x in license_scan.TEMPLATES:
            q = "".join(c if c.isalnum() else " " for c in x.translate(brute.LOWER)).split()
            k = min(5, len(q))
            s = {tuple(q[i : i + k]) for i in range(len(q) - k + 1)}
            run = [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]
            stride, length = license_scan.window(license_scan.size_class(len(s)))
            n = max((len(s & set(run[i : i + length])) for i in range(0, len(run), stride)), default=0)
            if 100 * n >= 75 * len(s):
                want[d, name] = max(want.get((d, name), (0, 0)), (len(s), n))
    assert got == want
    assert license_scan.find_licenses(docs(data), []).count() == 0
    assert license_scan.find_licenses(docs([])).count() == 0


# Language model


def test_recurrent_gradients():
    rng = np.random.default_rng(1)
    m = recurrent_lm.Model(np.array([9.0, 5, 3, 2, 1]), np.array([0, 0, 1, 1, 1]), 4.0, 3.0)
    m.w = {k: v.astype(float) + rng.normal(0, 0.2, v.shape) for k, v in m.w.items()}
    x, y = rng.integers(0, 7, (6, 3)), rng.integers(0, 7, (6, 3))
    on, h = rng.random((6, 3)) < 0.8, rng.normal(0, 0.3, (3, recurrent_lm.STATE))
    _, g, _ = m.gradients(x, y, on, h)
    for k, v in m.w.items():
        at = np.unravel_index(np.abs(g[k]).argmax(), v.shape)
        old, loss = v[at], []
        for e in (1e-5, -1e-5):
            v[at] = old + e
            loss.append(m.gradients(x, y, on, h)[0])
        v[at] = old
        assert g[k][at] == pytest.approx((loss[0] - loss[1]) / 2e-5, rel=1e-4)


def test_scores_are_a_distribution_and_carry_state():
    m = recurrent_lm.Model(np.array([9.0, 5, 3, 2, 1]), np.array([0, 0, 1, 1, 1]), 4.0, 3.0)
    m.w = {k: v + np.random.default_rng(2).normal(0, 0.3, v.shape).astype(np.float32) for k, v in m.w.items()}
    m.ready()
    # All texts of up to two words, and the mass of longer ones.
    texts = [np.array(t, int) for t in [[], *[[i] for i in range(6)], *[[i, j] for i in range(6) for j in range(6)]]]
    p = np.exp(m.score(texts))
    first = np.exp(m.log_p(m.step(m.gates[[m.end]], np.zeros((1, recurrent_lm.STATE), np.float32))[0].repeat(7, 0), np.arange(7)))
    assert first.sum() == pytest.approx(1, abs=1e-5)
    assert p.sum() < 1
    long = np.random.default_rng(3).integers(0, 6, 500)
    h, last, total = np.zeros((1, recurrent_lm.STATE), np.float32), m.end, 0.0
    for w in [*long, m.end]:
        h = m.step(m.gates[[last]], h)[0]
        total += float(m.log_p(h, np.array([w]))[0])
        last = w
    assert m.score([long, np.array([1])])[0] == pytest.approx(total, rel=1e-4)


def test_score(docs, monkeypatch):
    monkeypatch.setattr(recurrent_lm, "FREQUENT", 60)
    monkeypatch.setattr(recurrent_lm, "HEAD", 20)
    rng = random.Random(11)
    data = [(i, " ".join(rng.choice(["the", "The", "of", "cat", "dog", prose(rng, 1)]) for _ in range(rng.randrange(0, 50)))) for i in range(80)]
    data += [d for d in ODD if d[0] != 904] + [data[4], data[4]]
    out = recurrent_lm.score(docs(data)).collect()
    assert len(out) == len(data)
    held = {d: zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1 for d, _ in data}
    count = Counter()
    for d, t in data:
        if not held[d]:
            count.update([*brute.words((t or "").translate(brute.LOWER)), None])
    total, kinds = sum(count.values()), len(count)
    by_key = {}
    for d, t in data:
        tokens = [*brute.words((t or "").translate(brute.LOWER)), None]
        base = sum(np.log10((count[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in tokens)
        by_key[d] = (held[d], len(tokens), sum(count[w] > 0 for w in tokens), total, pytest.approx(base))
    for r in out:
        assert tuple(r)[1:6] == by_key[r["doc_id"]]
        assert r["score"] < 0
    assert recurrent_lm.score(docs([])).count() == 0


def test_classes_of_words_come_from_every_training_document(docs, monkeypatch):
    rng, met = random.Random(15), []
    classes_of = recurrent_lm.classes_of
    monkeypatch.setattr(recurrent_lm, "classes_of", lambda m: met.append(m[:, -1]) or classes_of(m))
    data = [(i, f"the {prose(rng, 5)}") for i in range(400)]
    recurrent_lm.score(docs(data)).count()
    # In how many texts a word is found: the most frequent one is in all.
    assert met[0].max() == sum(zlib.crc32(str(i).encode()) % 5 != 1 for i, _ in data)


def test_the_network_meets_every_training_word(docs, monkeypatch):
    met, rng = [], random.Random(21)
    add = recurrent_lm.Model.add

    def counted(self, total):
        met.append(total[-self.n_classes :].sum())
        add(self, total)

    monkeypatch.setattr(recurrent_lm.Model, "add", counted)
    # More documents than any fixed sample, copies, and one long text.
    data = [(i, prose(rng, rng.randrange(0, 12))) for i in range(2600)] + [(3000 + i, "a copy") for i in range(90)]
    data += [(4000 + i, prose(rng, 3000)) for i in range(3)] + ODD[:4]
    known = [t for d, t in data if t is not None and zlib.crc32(("" if d is None else str(d)).encode()) % 5 != 1]
    assert recurrent_lm.score(docs(data)).count() == len(data)
    assert sum(met) == sum(len(brute.words(t)) + 1 for t in known)


def test_sums_over_tasks(docs):
    rows = docs([(i, "t") for i in range(40)]).select("doc_id").repartition(5)
    count = lambda batches: np.full(20_000, sum(b.num_rows for b in batches), float)
    assert (recurrent_lm.summed(rows, count, 20_000) == 40).all()
    assert (recurrent_lm.summed(rows.where("doc_id < 0"), count, 5) == 0).all()


# Token counts


PIECES = ["it's", "don't", "we're", "'ll", "'", " ", "  ", "\n", "\n\n", " \n", "\t", "hello", "World", "été", "über", "123", "4.5",
          "!!", "<|endoftext|>", "<|endoftext|", "<|", "日本語", "😀", " ", "\x1c", "\x85", "ſ", "'ve ", "\r\n", "=====", "'re", " 're"]


def test_every_prefix_as_the_library_counts_it():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), token_counts.PrefixCounter(path)
    rng = random.Random(12)
    for _ in range(150):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randrange(1, 12)))
        want = [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(1, len(text) + 1)]
        assert own.counts(text).tolist() == want


def test_prefix_table(docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rng = random.Random(13)
    data = [(i, "".join(rng.choice(PIECES) for _ in range(40))) for i in range(30)] + ODD
    for r in token_counts.prefix_table(docs(data), path, 7, keep_counts=True).collect():
        text = dict(data)[r["doc_id"]] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_chars"], r["n_tokens"]) == (len(text.encode()), len(text), n)
        fit = [i + 1 for i, c in enumerate(r["prefix_tokens"]) if c <= 7]
        assert r["fit_chars"] == (fit[-1] if fit else 0)
    assert token_counts.prefix_table(docs([]), path).count() == 0


# Language identification


def test_languages(docs):
    rng = random.Random(14)
    data = [(i, prose(rng, 40, "abcdeéè" if i % 2 else "mnopqß "), "fr" if i % 2 else "de") for i in range(300)]
    df = docs([*data, *[(d, t) for d, t in ODD], data[0]])
    out = language_id.identify(df, language_id.learn(df)).collect()
    assert len(out) == len(data) + len(ODD) + 1
    got = {r["doc_id"]: r for r in out}
    held = [d for d in data if got[d[0]]["held_out"]]
    assert {d[0] for d in held} == {d[0] for d in data if zlib.crc32(str(d[0]).encode()) % 4 == 2}
    assert np.mean([got[i]["lang_pred"] == lang for i, _, lang in held]) > 0.95
    assert {got[i]["lang_pred"] for i in (900, 901, 902, 903)} == {"und"}
    assert all(0 <= r["score"] <= 1 for r in out)
    bare = docs([(1, "text", None)])
    assert language_id.learn(bare) is None
    assert [tuple(r)[2:] for r in language_id.identify(bare, None).collect()] == [("und", 0.0)]


def test_copies_of_a_training_text_are_drawn_once(docs):
    rng = random.Random(22)
    data = [(i, prose(rng, 60), "fr") for i in range(40)] + [(100 + i, "la même phrase", "fr") for i in range(300)]
    data += [(1000 + i, prose(rng, 60), "de") for i in range(9)]
    drawn = language_id.training_windows(docs(data))
    assert sum(w == "la même phrase".encode() for _, w in drawn) == 1
    few = language_id.training_windows(docs(data), 5)
    for lang in ("fr", "de"):
        from_texts = {t for _, t, x in data if x == lang and any(y == lang and w.decode() in t for y, w in few)}
        assert len(from_texts) == 5


def test_windows_hold_every_byte():
    texts = ["", "a" * 128, "é" * 100, "b" * 300]
    data, starts, ends = __import__("screenline.llm.shingles", fromlist=["x"]).texts_as_bytes(pa.array(texts))
    ids, owner, size = language_id.windows(data, starts, ends)
    for i, t in enumerate(texts):
        assert b"".join(ids[j, : size[j]].tobytes() for j in np.flatnonzero(owner == i)) == t.encode()


# Secrets


def test_base_spans():
    rng = random.Random(15)
    parts = ["password", "Token", "api_key", "APIKEY", "secret", "=", ":", " ", '"', "'", "abcdefgh12345", "short", "AKIA", "AKIAABCDEFGH1234",
             "0123456789abcdef" * 2, "deadbeef", "é", "ſecret", "=", "\n", "AKIAZ"]
    for _ in range(400):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(0, 25)))
        n, _, line = brute.secrets(text)
        spans = secret_scan.base_spans(text)
        assert secret_scan.digest(spans) == line
        assert tuple(sum(k == i for _, k, _ in spans) for i in range(3)) == n


def test_scan(docs):
    rng = random.Random(16)
    key = lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    words = ["configuration", "connection", "international", "responsibility", "understanding", "the", "of", "communication"]
    data = [(i, " ".join(rng.choice(words) for _ in range(60)) + f' password = "{key(24)}" end') for i in range(200)]
    bare = [(500 + i, "some text " + key(40) + " more text") for i in range(20)]
    plain = [(600 + i, "_".join(rng.choice(words) for _ in range(4))) for i in range(20)]
    df = docs(data + bare + plain + ODD)
    out = {r["doc_id"]: r for r in secret_scan.scan(df, secret_scan.train(df)).collect()}
    for d, t in data + bare + plain + ODD:
        n, sha, line = brute.secrets(t)
        r = out[d]
        assert (r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) == (*n, sha)
        assert set(line.split(",")) - {""} <= set(r["spans"].split(","))
    assert np.mean([out[d]["n_markov"] == 1 for d, _ in bare]) > 0.9
    assert sum(out[d]["n_markov"] for d, _ in plain) == 0
    assert secret_scan.scan(docs([]), secret_scan.train(docs([]))).count() == 0


def test_random_strings_are_told_by_alphabet_and_length(spark):
    """Strings that training never saw; figures are in the README."""
    model = secret_scan.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    rng = random.Random(77)
    for letters in secret_scan.ALPHABETS.values():
        for n in (12, 16, 20, 31, 40):
            keys = ["".join(rng.choice(letters) for _ in range(n)) for _ in range(200)]
            assert sum(model.spans(f"it is {k} indeed") == [(6, 3, 6 + n)] for k in keys) >= 190
    plain = ["12345678901234567890", "=====================", "2024-01-02-2024-01-03", "0000000000000000000000", "------------"]
    plain += ["1234-5678-9012-3456", "+49-170-1234567", "aaaaaaaaaaaaaaaaaaaa", "some_function_name_2", "SOME_CONSTANT_NAME", "2024/12/31/235959"]
    plain += ["".join(rng.choice("0123456789") for _ in range(n)) for n in range(10, 60)]
    assert [p for p in plain if model.spans(f"a {p} b")] == []


def test_the_rest_of_a_run_beside_a_fixed_match(spark):
    model = secret_scan.Model([], ["ordinary", "words"])
    rng = random.Random(5)
    key = "".join(rng.choice(secret_scan.ALPHABETS["base62"]) for _ in range(24))
    text = f"{key}/{'0123456789abcdef' * 2}/{key}"
    base = secret_scan.base_spans(text)
    assert [text[a:b] for a, _, b in base] == ["0123456789abcdef" * 2]
    found = model.spans(text, secret_scan.merged([(a, b) for a, _, b in base]))
    assert found == [(0, 3, 25), (57, 3, len(text))]


@pytest.mark.parametrize("scale", [0.5, 40.0])
def test_recurrent_shares_with_mixed_classes(scale):
    """Classes whose words do not follow each other, and values too large for exp."""
    rng = np.random.default_rng(5)
    m = recurrent_lm.Model(np.array([9.0, 5, 3, 2, 1]), np.array([1, 0, 1, 0, 1]), 4.0, 3.0)
    m.w = {k: rng.normal(0, scale if k in ("cb", "ob") else 0.5, v.shape) for k, v in m.w.items()}
    assert m._fits() == (scale < 1)
    m.ready()
    h = np.tanh(rng.normal(0, 1, (6, recurrent_lm.STATE)))
    every = np.exp([m.log_p(h, np.full(6, y)).astype(float) for y in range(7)])
    assert every.sum(axis=0) == pytest.approx(np.ones(6), rel=1e-4)
    x, y, on = rng.integers(0, 7, (6, 3)), rng.integers(0, 7, (6, 3)), rng.random((6, 3)) < 0.8
    g = m.gradients(x, y, on, h[:3])[1]
    for k in ("cw", "cb", "ow", "ob", "embed"):
        at, step, loss = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape), 1e-5, []
        for sign in (1, -2):
            m.w[k][at] += sign * step
            loss.append(m.gradients(x, y, on, h[:3])[0])
        m.w[k][at] += step
        assert g[k][at] == pytest.approx((loss[0] - loss[1]) / (2 * step), rel=1e-3, abs=1e-7)


def test_recurrent_scoring_keeps_its_lanes_busy(monkeypatch):
    """Texts of very unlike lengths, an empty one among them, score as each does alone."""
    rng = np.random.default_rng(6)
    m = recurrent_lm.Model(np.array([9.0, 5, 3, 2, 1]), np.array([1, 0, 1, 0, 1]), 4.0, 3.0)
    m.w = {k: v + rng.normal(0, 0.3, v.shape).astype(np.float32) for k, v in m.w.items()}
    m.ready()
    texts = [rng.integers(0, 6, n) for n in [0, *rng.integers(1, 2000, 1100)]]
    widths, step = [], recurrent_lm.Model._step
    monkeypatch.setattr(recurrent_lm.Model, "_step", lambda self, x, h: widths.append(h.shape[1]) or step(self, x, h))
    got = m.score(texts)
    assert sum(widths) == sum(len(t) + 1 for t in texts)
    assert np.mean(widths) > 0.9 * max(widths)
    assert got[:40] == pytest.approx([m.score([t])[0] for t in texts[:40]], rel=1e-4)
    assert len(m.score([])) == 0


def test_a_long_text_alone_does_not_lead_the_network_away():
    """Its gradients wait until there are about as many words as the lanes bring."""
    rng = np.random.default_rng(7)
    short = [np.resize([0, 1, 2], rng.integers(60, 140)) for _ in range(400)]
    counts, klass = np.array([9.0, 9, 9, 9, 9]), np.array([0, 0, 1, 1, 1])
    plain, longer = (recurrent_lm.Model(counts, klass, 1.0, 3.0) for _ in range(2))
    plain.train(iter(short), 0.01)
    goals = longer.train(iter([*short, np.full(6000, 4)]), 0.01)[-longer.n_classes :]
    assert goals.sum() == sum(len(t) + 1 for t in short) + 6001
    for m in (plain, longer):
        m.ready()
    assert longer.score(short[:50]).sum() > 1.2 * plain.score(short[:50]).sum()


def test_recurrent_training_keeps_its_lanes_busy(monkeypatch):
    """Texts of very unlike lengths, whole: lanes end at about the same time."""
    rng = np.random.default_rng(8)
    m = recurrent_lm.Model(np.array([9.0, 5, 3, 2, 1]), np.array([1, 0, 1, 0, 1]), 4.0, 3.0)
    texts = [rng.integers(0, 6, n) for n in rng.integers(1, 3000, 700)]
    widths, step = [], recurrent_lm.Model._step
    monkeypatch.setattr(recurrent_lm.Model, "_step", lambda self, x, h: widths.append(h.shape[1]) or step(self, x, h))
    goals = m.train(iter(texts), 0.01)[-m.n_classes :]
    assert goals.sum() == sum(len(t) + 1 for t in texts)
    assert np.mean(widths) > 0.8 * max(widths)


def test_last_texts_by_length(monkeypatch):
    monkeypatch.setattr(recurrent_lm, "_WAIT", 12)
    lengths = lambda ns: [len(t) for t in recurrent_lm.last_by_length(np.zeros(n, int) for n in ns)]
    # Seven, one and one words wait at the end, with three ends.
    assert lengths([2, 9, 4, 30, 1, 1, 7]) == [2, 9, 4, 30, 7, 1, 1]
    assert lengths([1, 3, 2]) == [3, 2, 1]
    assert lengths([]) == []


def test_gates_at_their_limits():
    """The gates as they are written out, at inputs too large for exp as well."""
    m = recurrent_lm.Model(np.array([9.0, 5, 3]), np.array([0, 0, 0]), 4.0, 3.0)
    m.ready()
    rng, n = np.random.default_rng(9), recurrent_lm.STATE
    x = rng.normal(0, 1, (40, 3 * n)).astype(np.float32) * np.repeat(np.float32([1, 1000]), 20)[:, None]
    h = rng.uniform(-1, 1, (40, n)).astype(np.float32)
    u = (h @ m.w["wh"]).astype(float)
    z, r = (0.5 + 0.5 * np.tanh((x + u)[:, i : i + n] / 2) for i in (0, n))
    want = z * h + (1 - z) * np.tanh(x[:, 2 * n :] + r * u[:, 2 * n :])
    with np.errstate(all="raise", under="ignore"):
        assert m.step(x, h)[0] == pytest.approx(want, abs=1e-5)


def test_words_by_pieces():
    """Equal hashes for equal words and no others, at all lengths and places."""
    rng = random.Random(23)
    words = ["".join(rng.choice("abAB\0é") for _ in range(n)) for n in [*range(1, 45), 64, 65, 200] for _ in range(4)]
    texts = [rng.choice([" ", "\n\t ", ""]).join(rng.choices(words, k=9)) for _ in range(400)] + ["", " ", "a", "A"]
    by_word = {}
    for _, upto, hashes, counts in sh._chunks(pa.array(texts), sh.piece_hashes):
        assert upto == len(texts)
        split = [brute.words(t.translate(brute.LOWER)) for t in texts]
        assert counts.tolist() == [len(w) for w in split]
        for w, h in zip([w for s in split for w in s], hashes.tolist(), strict=True):
            by_word.setdefault(w, set()).add(h)
    assert all(len(v) == 1 for v in by_word.values())
    assert len({h for v in by_word.values() for h in v}) == len(by_word)


def test_company_of_words():
    rng = np.random.default_rng(10)
    texts = [rng.zipf(1.4, n).clip(1, 101) - 1 for n in rng.integers(0, 60, 300)]
    want = np.zeros((100, 65))
    for t in texts:
        about = np.bincount(t[t < 64], minlength=64)
        for w in set(t[t < 100].tolist()):
            want[w] += np.append(about / max(1, np.linalg.norm(about)), 1)
    assert recurrent_lm.company(iter(texts), 100) == pytest.approx(want, abs=1e-4)
    assert recurrent_lm.company(iter(texts[:1]), 0).shape == (0, 1)


def test_lookup_takes_few_places():
    rng = np.random.default_rng(11)
    keys = np.unique(rng.integers(0, 1 << 63, 1 << 12).astype(np.uint64))
    # Some that begin at the same place, which is full.
    keys = np.unique(np.append(keys, np.arange(1, 40, dtype=np.uint64) << np.uint64(20)))
    table = recurrent_lm.Lookup(keys)
    assert len(table.slot_at) <= 4 * len(keys)
    assert (table.find(keys) == np.arange(len(keys))).all()
    assert (table.find(keys + np.uint64(1)) == np.where(np.isin(keys + np.uint64(1), keys), np.searchsorted(keys, keys + np.uint64(1)), -1)).all()
