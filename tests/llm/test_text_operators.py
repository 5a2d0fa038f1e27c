"""Merge index, fill in the middle and spelling variants against plain versions,
on small tables with nulls, empty and very long texts, ties, repeated rows and
clashing column names."""

import hashlib
import random
import re
import zlib
from collections import Counter

import compare
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from screenline.llm import fill_middle, merge_index, queries, spelling

SF = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [(900, None), (901, ""), (902, " \n\t "), (None, "no id\nhere"), (903, "?!? 12 34\n"), (904, "long lines\n" * 30_000), (905, "é" * 50)]


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_sql(spark, con, name):
    assert compare.difference(queries.QUERIES[name](spark, SF), con, queries.ORACLES[name]) is None


# Merge index


def odd_texts(seed):
    rng = random.Random(seed)
    texts = ["<|endoftext|>", "a<|endoftext|>b <|startoftext|><|endoftext|>", "<|ENDOFTEXT|>", "<|end", "ΑΣ ΟΔΟΣ", "İx", "ȩ́å"]
    texts += ["\x1c\x1d a\x85b\xa0c", "it's I'LL 'RE", "''''s!!!'s", "aaaa" * 500, "\x00\x01", "世界 שלום ١٢٣ ²³ ½", "a" * 200_000]
    texts += ["".join(rng.choice("aehinorst") for _ in range(rng.randrange(1, 60))) for _ in range(300)]
    return texts + ["".join(rng.choice("ab c's<|>1é世ß\n!ΣÀ") for _ in range(rng.randrange(1, 40))) for _ in range(300)]


def test_round_trip_equals_the_library(docs):
    library = Tokenizer.from_file(WORDS)
    data = [*enumerate(odd_texts(3)), *ODD, (7, "twice"), (7, "twice")]
    found = merge_index.round_trip(docs(data), WORDS).collect()
    want = []
    for d, t in data:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((d, len(ids), np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)))
    assert sorted(map(str, ((r[0], r[1], bytes(r[2]), r[3]) for r in found))) == sorted(map(str, want))


def test_pieces_are_merged_alike_alone_and_together():
    """Whatever else is in the index, and when the kept pieces run out."""
    alone, together = merge_index.Coder(WORDS), merge_index.Coder(WORDS)
    texts = odd_texts(4)
    assert [alone.encode([t])[0] for t in texts] == together.encode(texts)


def test_lower_rank_made_by_a_merge_goes_first(tmp_path):
    """A rule that only a later rule's result can use, though it ranks before it."""
    import json

    with open(WORDS, encoding="utf-8") as f:
        spec = json.load(f)
    letters = merge_index._byte_letters()
    vocab = {c: i for i, c in enumerate(letters)} | {c + "</w>": 256 + i for i, c in enumerate(letters)}
    merges = [("bc", "a"), ("c", "a"), ("b", "c"), ("bca", "b")]
    for a, b in [("b", "c"), ("c", "a"), ("bc", "a"), ("bca", "b")]:
        vocab[a + b] = len(vocab)
    spec["model"].update(vocab=vocab, merges=[list(m) for m in merges])
    spec["added_tokens"] = []
    path = str(tmp_path / "small.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(spec, f)
    library, mine = Tokenizer.from_file(path), merge_index.Coder(path)
    rng = random.Random(5)
    texts = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 30))) for _ in range(3000)] + ["bcbcabbca"]
    want = [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
    assert mine.encode(texts) == want


def test_another_kind_is_refused():
    with pytest.raises((ValueError, KeyError)):
        merge_index.Coder(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_are_unpacked_and_decoded(docs):
    coded = merge_index.round_trip(docs([(1, "Hello, world <|endoftext|>"), (2, None)]), WORDS).drop("decoded")
    out = merge_index.decoded(coded.withColumn("numbers", merge_index.unpacked(F.col("ids"))), WORDS)
    rows = {r.doc_id: r for r in out.collect()}
    library = Tokenizer.from_file(WORDS)
    ids = library.encode("Hello, world <|endoftext|>", add_special_tokens=False).ids
    assert rows[1].numbers == ids and rows[1].decoded == library.decode(ids, skip_special_tokens=False)
    assert rows[2].numbers == [] and rows[2].decoded == ""


def test_empty_tables(docs):
    none = docs([(1, "x")]).where("doc_id > 1")
    assert merge_index.round_trip(none, WORDS).collect() == []
    assert fill_middle.transformed(none).collect() == []
    assert spelling.variants(none).collect() == []


# Fill in the middle


def plainly_filled(doc_id, text, seed=7, rate=100, spm=50):
    t = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", t)
    x = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    a, b, c, d = (int(x[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or c % 100 >= rate:
        return doc_id, len(lines), "plain", None, None, t
    i, j = sorted((a % (len(lines) + 1), b % (len(lines) + 1)))
    p, m, s = "".join(lines[:i]), "".join(lines[i:j]), "".join(lines[j:])
    if d % 100 < spm:
        return doc_id, len(lines), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(lines), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("seed, rate, spm", [(7, 100, 50), (3, 60, 10), (1, 0, 50)])
def test_filled_texts(docs, seed, rate, spm):
    rng = random.Random(6)
    data = [(i, "".join(rng.choice("ab \n\n世é<S") for _ in range(rng.randrange(0, 90)))) for i in range(400)]
    data += [(i + 1000, t) for i, t in enumerate(["<P>", "x<M>y", "\n", "\n\n", "<", "a<", "<S", "\r\n\r", "\x00\n"])]
    data += [(i + 2000, ("y" * rng.randrange(3000) + "\n") * rng.randrange(30)) for i in range(30)] + ODD + [data[0]] * 3
    out = fill_middle.transformed(docs(data), seed, rate, spm)
    back = out.select("*", fill_middle.restored(F.col("output"), F.col("form")).alias("back")).collect()
    assert sorted(map(str, (tuple(r)[:6] for r in back))) == sorted(str(plainly_filled(d, t, seed, rate, spm)) for d, t in data)
    assert Counter(r.back for r in back) == Counter(t or "" for _, t in data)


@pytest.mark.parametrize("block", [1, 2, 3, 7, 64, 4096])
def test_borders_do_not_depend_on_blocks(block):
    rng = random.Random(7)
    for _ in range(60):
        text = "".join(rng.choice("abc\n") for _ in range(rng.randrange(0, 80)))
        lines = re.findall(r"[^\n]*\n|[^\n]+", text)
        found = fill_middle.Lines(text, block)
        assert found.number == len(lines)
        assert [found.border(k) for k in range(len(lines) + 1)] == [len("".join(lines[:k])) for k in range(len(lines) + 1)]


def test_marks_that_would_not_be_found_again(docs):
    for marks in (("<P>", "<P>", "<M>"), ("<P<", "<S>", "<M>"), ("<P>", "[S]", "<M>")):
        with pytest.raises(ValueError):
            fill_middle.transformed(docs([(1, "x")]), marks=marks)


# Spelling variants


def edited_once(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    s, t = sorted((a, b), key=len)
    return any(t[:i] + t[i + 1 :] == s for i in range(len(t)))


def plain_variants(data, one_of):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n = Counter()
    for d, t in data:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % one_of == 0 else run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    near = {w: [v for v in n if edited_once(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 5 * n[w]:
            form[w] = best
    out = []
    for w, c in n.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, c, len(near[w]), form.get(w), n.get(form.get(w)), root))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed, one_of", [(1, 199), (2, 5), (3, 3)])
def test_variants(docs, seed, one_of):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abdeè") for _ in range(rng.randrange(5, 9))) for _ in range(40)]
    base += ["Straße", "ÀÈ" * 4, "aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "abcdefghij" * 300, "x×y÷zz"]
    often = [1 / (i + 1) for i in range(len(base))]
    data = []
    for i in range(300):
        words = []
        for w in rng.choices(base, often, k=rng.randrange(0, 60)):
            if rng.random() < 0.1:
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1 :], w[:k] + "b" + w[k + 1 :], w[:k] + "e" + w[k:], w.upper()])
            words.append(w)
        data.append((i, rng.choice([" ", "\n", ", ", "9"]).join(words)))
    data += ODD + [(906, "mixing " * 4), (906, "mixing mixinG"), (907, "mixxing " * 400), (908, "mixxinge " * 2100)] + [data[0]] * 6
    found = sorted((tuple(r) for r in spelling.variants(docs(data), one_of).collect()), key=str)
    assert found == plain_variants(data, one_of)
    if one_of == 199:
        assert any(r[5] not in (r[0], r[3]) for r in found)


def test_words_without_any_near_one(docs):
    found = spelling.variants(docs([(1, "solitary " * 5), (2, "different " * 7)]), 10**9).collect()
    assert sorted(tuple(r) for r in found) == [("different", 7, 0, None, None, "different"), ("solitary", 5, 0, None, None, "solitary")]


def test_signatures_meet_for_every_edit():
    rng = random.Random(9)
    part = {(c, j): rng.randrange(spelling.PARTS) for c in "abcdefgh" for j in range(1, 4)}
    for _ in range(2000):
        w = "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(6, 12)))
        k = rng.randrange(len(w))
        v = rng.choice([w[:k] + w[k + 1 :] if len(w) > 6 else w + "a", w[:k] + "h" + w[k + 1 :], w[:k] + "z" + w[k:]])
        assert set(spelling.signatures(w, part)) & set(spelling.signatures(v, part))
