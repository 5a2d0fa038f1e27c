"""Encoding with a merge vocabulary by an index of pair occurrences, and decoding.

Texts are cut into pieces by the tokenizer's own pattern. All pieces of a part
of a partition that have not been met before are laid end to end as symbols in
linked lists, and every adjacent pair that a merge rule joins is entered in an
index from the rule's rank to all its places. The active ranks are applied in
ascending order, each to all its places at once; a merge touches only the lists
of the two pairs it makes with its neighbours. A pair made by a merge may have
a lower rank than the rule at hand; then the places left wait until that rank
has been applied, so each piece sees its merges in the order of one piece alone.

Pieces' tokens are kept per worker, so a frequent piece is merged once.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenline.llm.batches import by_bytes, texts

# Pieces kept per worker, at most, and the longest piece that is kept.
KEPT = 500_000
KEPT_LENGTH = 64


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, the
    others from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def _one_byte(pattern: str) -> re.Pattern:
    """The pattern for texts of the first 256 code points, its classes spelt out."""
    for name, kind in ((r"\p{L}", r"\p{L}"), (r"\p{N}", r"\p{N}"), (r"\s", r"\p{White_Space}")):
        held = regex.findall(kind, "".join(map(chr, range(256))))
        pattern = pattern.replace(name, "".join(f"\\x{ord(c):02x}" for c in held))
    return re.compile(pattern)


class Coder:
    """A lower-casing merge vocabulary with marked word ends, in JSON form.

    Refuses a file whose normal form, cutting or decoding is another."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cutter = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        normal = [n["type"] for n in spec["normalizer"]["normalizers"]]
        known = (
            normal == ["NFC", "Replace", "Lowercase"]
            and [c["type"] for c in cutter] == ["Split", "ByteLevel"]
            and cutter[0]["invert"]
            and cutter[0]["behavior"] == "Removed"
            and not cutter[1]["use_regex"]
            and not cutter[1]["add_prefix_space"]
            and spec["decoder"] is None
            and not any(model[k] for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        )
        if not known:
            raise ValueError(f"{path} is another kind of tokenizer")
        # White space as the Unicode property, which leaves out 0x1C to 0x1F.
        pattern = cutter[0]["pattern"]["Regex"]
        self.piece = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        self.short_piece = _one_byte(pattern)
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        letters = _byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int32)
        self.last = np.array([vocab[c + end] for c in letters], np.int32)
        # Rank of each pair of symbols, and what each rank joins and makes.
        self.ranks: dict[tuple[int, int], int] = {}
        self.rules: list[tuple[int, int, int]] = []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocab[a], vocab[b]] = rank
            self.rules.append((vocab[a], vocab[b], vocab[a + b]))
        keys = np.array([(a << 32) | b for a, b in self.ranks], np.int64)
        order = np.argsort(keys)
        self.pairs, self.pair_ranks = keys[order], np.array(list(self.ranks.values()))[order]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = {t: np.array([i], "<u4").tobytes() for t, i in added.items()}
        longest = sorted(added, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if added else None
        by_id = {i: t for t, i in (vocab | added).items()}
        self.strings = [by_id.get(i, "") for i in range(max(by_id) + 1)]
        self.kept = dict(self.special)

    def _cut(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            # A final sigma is lower-cased like any other.
            return self.piece.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())
        return self.short_piece.findall(text.lower())

    def pieces(self, text: str) -> list[str]:
        """The pieces of a text; a special string is one piece."""
        if self.marks is None or not any(t in text for t in self.special):
            return self._cut(text)
        out = []
        for part in self.marks.split(text):
            out += [part] if part in self.special else self._cut(part)
        return out

    def merged(self, pieces: list[str]) -> Iterator[bytes]:
        """The token ids of each piece, as little-endian 32-bit numbers."""
        data = [p.encode() for p in pieces]
        ends = np.cumsum([len(d) for d in data], dtype=np.int64)
        starts = np.append(0, ends)[:-1]
        flat = np.frombuffer(b"".join(data), np.uint8)
        first = self.inner[flat]
        first[ends - 1] = self.last[flat[ends - 1]]
        after = np.arange(1, len(flat) + 1, dtype=np.int32)
        before = after - 2
        after[ends - 1] = before[starts] = -1
        # The index: each joined pair's rank, and its places in order.
        keys = (first[:-1].astype(np.int64) << 32) | first[1:]
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        held = np.flatnonzero((self.pairs[at] == keys) & (after[:-1] >= 0))
        found = self.pair_ranks[at[held]]
        order = np.argsort(found, kind="stable")
        ranks, cuts = np.unique(found[order], return_index=True)
        index = {r: array("i", p.astype(np.int32).tobytes()) for r, p in zip(ranks.tolist(), np.split(held[order], cuts[1:]), strict=True)} if len(held) else {}
        symbols, after, before = (array("i", x.astype(np.int32).tobytes()) for x in (first, after, before))
        rank_of, rules = self.ranks.get, self.rules
        active = list(index)
        heapify(active)
        while active:
            rank = heappop(active)
            a, b, made = rules[rank]
            places = sorted(index.pop(rank))
            for n, i in enumerate(places, 1):
                j = after[i]
                if j < 0 or symbols[i] != a or symbols[j] != b:
                    continue
                k, h = after[j], before[i]
                symbols[i], symbols[j], after[i] = made, -1, k
                low = rank
                if k >= 0:
                    before[k] = i
                    new = rank_of((made, symbols[k]))
                    if new is not None:
                        if new in index:
                            index[new].append(i)
                        else:
                            index[new] = array("i", (i,))
                            heappush(active, new)
                        low = min(low, new)
                if h >= 0:
                    new = rank_of((symbols[h], made))
                    if new is not None:
                        if new in index:
                            index[new].append(h)
                        else:
                            index[new] = array("i", (h,))
                            heappush(active, new)
                        low = min(low, new)
                if low < rank:
                    index[rank] = array("i", places[n:])
                    heappush(active, rank)
                    break
        done = np.frombuffer(symbols, np.int32) if len(symbols) else np.zeros(0, np.int32)
        kept = done >= 0
        packed = done[kept].astype("<u4").tobytes()
        bounds = np.append(0, np.cumsum(kept))[np.append(0, ends)] * 4
        for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            yield packed[i:j]

    def encode(self, some: list[str]) -> list[bytes]:
        """The ids of each text."""
        cut = [self.pieces(t) for t in some]
        kept = self.kept
        new = set().union(*cut) - kept.keys()
        if len(kept) + len(new) > KEPT:
            kept.clear()
            kept.update(self.special)
            new = set().union(*cut) - kept.keys()
        ordered = list(new)
        kept.update(zip(ordered, self.merged(ordered), strict=True))
        out = [b"".join(map(kept.__getitem__, c)) for c in cut]
        for p in ordered:
            if len(p) > KEPT_LENGTH:
                del kept[p]
        return out

    def decode(self, ids: bytes) -> str:
        """The text of packed ids: the tokens' own strings, parted by a space.
        Ids outside the vocabulary give nothing."""
        n, strings = len(self.strings), self.strings
        return " ".join([strings[i] for i in np.frombuffer(ids, "<u4").tolist() if i < n and strings[i]])


@lru_cache(maxsize=2)
def coder(path: str) -> Coder:
    """One coder per worker and vocabulary."""
    return Coder(path)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids (the tokens as little-endian unsigned 32-bit
    numbers) and decoded (the text the ids give) of each row.

    ``path`` names the vocabulary on every executor. A null text is empty: no
    tokens, no bytes, the empty text. Special strings in a text are their
    tokens; none is added. Texts of any length are encoded whole. Equal rows
    give equal rows, an empty table an empty one; other columns are not looked
    at."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = coder(path)
        for whole in batches:
            for batch in by_bytes(whole, 1):
                ids = known.encode(texts(batch.column(1)))
                columns = [
                    batch.column(0),
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array(map(known.decode, ids), pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids", "decoded"])

    fields = "doc_id long, n_tokens long, ids binary, decoded string"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(walk, fields)


def decoded(table: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """A table with packed ids and, as last column ``out``, their text; null ids
    have none. A column of that name is replaced."""
    kept = [c for c in table.columns if c != out]
    schema = table.select(*kept).schema.add(out, "string")
    at = kept.index(ids)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = coder(path)
        for whole in batches:
            for batch in by_bytes(whole, at):
                found = [None if i is None else known.decode(i) for i in batch.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*kept, out])

    return table.select(*kept).mapInArrow(walk, schema)


def unpacked(ids: Column) -> Column:
    """Packed ids as an array of numbers."""
    n = (F.length(ids) / 4).cast("int")
    # Four bytes, last first, are the number's hexadecimal digits.
    digits = lambda k: F.concat(*(F.hex(F.substring(ids, k * 4 + j, 1)) for j in (4, 3, 2, 1)))
    number = lambda k: F.conv(digits(k), 16, 10).cast("long")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), number)).when(n == 0, F.array().cast("array<bigint>"))
