"""Exact token counts of every prefix of a text, by dynamic programming.

For a piece of text the last token of a prefix's encoding is the one vocabulary
entry that ends there and leaves a pair with the last token before it that the
merge rules would not join otherwise; so one pass over the bytes gives the
encoding of every prefix. Pieces are what the tokenizer's pattern cuts a text
into. A prefix may be cut differently from the whole text only inside a run of
white space and inside a contraction, so text is walked in units (white space
and the piece after it) whose prefix counts depend on the unit alone. They are
worked out once per unit and kept; the counts of a text's prefixes are running
sums of them, and answer how many tokens a text has, and where to cut it for a
budget, without encoding anything again.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from operator import sub

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 512
# Units kept per worker, at most.
KEPT = 1_000_000

_TAILS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


def _pattern(space: str, letter: str, digit: str) -> str:
    """A unit: white space and the piece after it (the usual ones come first)."""
    mark = f"[^{space}{letter}{digit}]"
    return (
        f" ?[{letter}]+| {mark}+|"
        f"(?:[{space}]*(?=[{space}])[^ ])?(?:{'|'.join(_TAILS)})|"
        f"[{space}]*(?:[{letter}]+|[{digit}]+|{mark}+)|[{space}]+"
    )


_SPACE = regex.compile(r"\p{White_Space}*")
_UNIT = regex.compile(_pattern(r"\p{White_Space}", r"\p{L}", r"\p{N}"))
_ASCII_UNIT = re.compile(_pattern(r" \t\n\r\f\v", "A-Za-z", "0-9"))


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Kept(dict):
    """Units' counts. When full, what was used since the last time is kept."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, text: str) -> bytes:
        found = self.old.get(text)
        found = self.make(text) if found is None else found
        if len(text) <= 64:
            if len(self) >= KEPT // 2:
                self.old = dict(self)
                self.clear()
            self[text] = found
        return found


class PrefixCounter:
    """Prefix token counts under a byte-level merge vocabulary in JSON form."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        raw = {t: bytes(letters[c] for c in t) for t in spec["model"]["vocab"] if all(c in letters for c in t)}
        # Numbered by age: the bytes, then what each merge rule makes, in order.
        self.ids = {bytes([i]): i for i in range(256)}
        self.halves: list[tuple[int, int] | None] = [None] * 256
        self.joined: dict[tuple[int, int], int] = {}
        for pair in spec["model"]["merges"]:
            a, b = (raw[t] for t in (pair.split(" ") if isinstance(pair, str) else pair))
            made = self.ids.setdefault(a + b, len(self.halves))
            if made == len(self.halves):
                self.halves.append((self.ids[a], self.ids[b]))
            self.joined.setdefault((self.ids[a], self.ids[b]), made)
        self.longest = max(map(len, self.ids))
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.pairs: dict[tuple[int, int], bool] = {}
        self.units = _Kept(self.unit)

    def stays(self, a: int, b: int) -> bool:
        """Whether token b may follow token a: no merge across their border would
        have come before the merges that made them. The younger side is taken
        apart towards the border, and each pair met there must be no merge, or
        one younger than what was taken apart last."""
        joined, halves, limit = self.joined.get, self.halves, 1 << 60
        while True:
            made = joined((a, b))
            if made is not None and made < limit:
                return False
            # Of equal age the left side's merge comes first.
            for side in (0, 1) if a > b else (1, 0):
                if side == 0 and halves[a]:
                    limit, a = a, halves[a][1]
                    break
                if side == 1 and halves[b]:
                    limit, b = b + 1, halves[b][0]
                    break
            else:
                return True

    def piece(self, data: bytes) -> list[int]:
        """Tokens of each byte prefix of a piece, from the empty one on."""
        count, last = [0], [-1]
        find, longest, pairs = self.ids.get, self.longest, self.pairs
        for end in range(1, len(data) + 1):
            for start in range(max(0, end - longest), end):
                token = find(data[start:end])
                if token is None:
                    continue
                if start:
                    key = (last[start], token)
                    good = pairs.get(key)
                    if good is None:
                        if len(pairs) > KEPT:
                            pairs.clear()
                        good = pairs[key] = self.stays(*key)
                    if not good:
                        continue
                count.append(count[start] + 1)
                last.append(token)
                break
        return count

    def _at_chars(self, text: str) -> list[int]:
        """Tokens of each non-empty prefix of one piece, by code point."""
        data = text.encode()
        by_byte = self.piece(data)
        if len(data) == len(text):
            return by_byte[1:]
        return [by_byte[i] for i in range(1, len(data) + 1) if i == len(data) or data[i] & 0xC0 != 0x80]

    def unit(self, text: str) -> bytes:
        """Differences between the counts of a unit's successive prefixes."""
        edge = _SPACE.match(text).end()
        space, core = text[:edge], text[edge:]
        if space == " " and core:
            counts = self._at_chars(text)
        else:
            counts = self._at_chars(space) if space else []
            if core:
                base = counts[-2] if len(space) > 1 else 0
                if space and space[-1] == " ":
                    counts += [base + n for n in self._at_chars(" " + core)[1:]]
                else:
                    base += self._at_chars(space[-1])[-1] if space else 0
                    inside = self._at_chars(core)
                    if core in _TAILS and len(core) == 3:
                        inside[1] = inside[0] + self._at_chars(core[1])[0]
                    counts += [base + n for n in inside]
        return array("h", map(sub, counts, [0, *counts])).tobytes()

    def _plain(self, text: str) -> bytes:
        units = (_ASCII_UNIT if text.isascii() else _UNIT).findall(text)
        return b"".join(map(self.units.__getitem__, units))

    def counts(self, text: str) -> np.ndarray:
        """Tokens of each non-empty prefix of a text, by code point."""
        some = any(t in text for t in self.special)
        marks = [m.span() for m in self.cut.finditer(text)] if some else []
        if not marks:
            return np.cumsum(np.frombuffer(self._plain(text), np.int16), dtype=np.int64)
        parts, at, base = [], 0, 0
        for start, end in marks:
            # Short of its last letter a special string is ordinary text.
            open_ = np.cumsum(np.frombuffer(self._plain(text[at : end - 1]), np.int16), dtype=np.int64)
            before = int(open_[start - at - 1]) if start > at else 0
            parts += [base + open_, np.array([base + before + 1])]
            base, at = base + before + 1, end
        parts.append(base + np.cumsum(np.frombuffer(self._plain(text[at:]), np.int16), dtype=np.int64))
        return np.concatenate(parts)


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    """One counter per worker and vocabulary."""
    return PrefixCounter(path)


def longest_fit(counts: np.ndarray, budget: int) -> int:
    """Code points of the longest prefix of at most ``budget`` tokens."""
    fit = np.flatnonzero(counts <= budget)
    return int(fit[-1]) + 1 if len(fit) else 0


def prefix_table(docs: DataFrame, path: str, budget: int = LIMIT, keep_counts: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_chars, n_tokens, fit_chars (code points of the longest
    prefix within ``budget`` tokens) and, on request, prefix_tokens (the count of
    every prefix) of each row. A null text is empty: zero in every column. Equal
    rows give equal rows; other columns are not looked at."""
    fields = "doc_id long, n_bytes long, n_chars long, n_tokens long, fit_chars long"
    fields += ", prefix_tokens array<int>" if keep_counts else ""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counter(path)
        for batch in batches:
            out, kept = [], []
            for raw in batch.column(1).cast(pa.binary()).to_pylist():
                text = (raw or b"").decode("utf-8", "replace")
                counts = known.counts(text)
                out.append((len(raw or b""), len(text), int(counts[-1]) if len(counts) else 0, longest_fit(counts, budget)))
                if keep_counts:
                    kept.append(counts.astype(np.int32))
            columns = np.array(out, np.int64).reshape(-1, 4)
            arrays = [batch.column(0), *(pa.array(columns[:, i]) for i in range(4))]
            names = ["doc_id", "n_bytes", "n_chars", "n_tokens", "fit_chars"]
            if keep_counts:
                arrays.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("prefix_tokens")
            yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(walk, fields)
