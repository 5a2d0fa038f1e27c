"""Fill-in-the-middle forms of texts cut at unit borders.

A text's units are its lines. The text is covered by blocks of a fixed number
of code points, and a Fenwick tree over the blocks holds how many units end in
them and how many code points they have. A cut after the k-th unit is found by
binary lifting: the descent adds up blocks as long as fewer than k units end in
them, which gives the block of the cut and its first code point; the border
itself is looked for inside that block only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenline.llm.batches import by_bytes, texts

# Code points of a block.
BLOCK = 4096
MARKS = ("<P>", "<S>", "<M>")


class Lines:
    """The borders of a text's lines (a line ends after its line feed, the last
    one at the latest with the text)."""

    def __init__(self, text: str, block: int = BLOCK):
        self.text = text
        self.blocks = -(-len(text) // block)
        self.units = [0] * (self.blocks + 1)
        self.chars = [0] * (self.blocks + 1)
        for i in range(1, self.blocks + 1):
            start = (i - 1) * block
            self.units[i] += text.count("\n", start, start + block)
            self.chars[i] += min(block, len(text) - start)
            above = i + (i & -i)
            if above <= self.blocks:
                self.units[above] += self.units[i]
                self.chars[above] += self.chars[i]
        self.number = self._ended() + (not text.endswith("\n") and text != "")

    def _ended(self) -> int:
        """Line feeds of all blocks: the tree's sum from the last one down."""
        i, total = self.blocks, 0
        while i:
            total += self.units[i]
            i -= i & -i
        return total

    def border(self, k: int) -> int:
        """The code point at which the k-th line has ended."""
        if k <= 0:
            return 0
        if k >= self.number:
            return len(self.text)
        at, start, left = 0, 0, k
        step = 1 << self.blocks.bit_length()
        while step := step >> 1:
            if at + step <= self.blocks and self.units[at + step] < left:
                at += step
                left -= self.units[at]
                start += self.chars[at]
        for _ in range(left):
            start = self.text.index("\n", start) + 1
        return start


def _numbers(seed: int, doc_id: int | None) -> list[int]:
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digits[i : i + 8], 16) for i in (0, 8, 16, 24)]


def transformed(
    docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50, marks: tuple[str, str, str] = MARKS
) -> DataFrame:
    """doc_id, n (lines), form, prefix_chars, middle_chars, output of each row.

    ``rate`` percent of the texts are rearranged, ``spm`` percent of those with
    the suffix first (form ``spm``: suffix, prefix, middle), the others as
    ``psm`` (prefix, suffix, middle); ``marks`` stand before prefix, suffix and
    middle. Cuts, form and rate are drawn from the id and ``seed``, so a rerun
    gives the same. A text that is empty, null (taken as empty), or contains a
    mark stays as it is: form ``plain``, no lengths. Both cuts may fall on one
    border, then the middle is empty. A null id is drawn as an empty one; rows
    of one id are drawn alike; an empty table gives an empty one; other columns
    are not looked at. Marks begin with a character that they do not repeat, so
    that they are found again (``restored``)."""
    if any(not m or m[0] in m[1:] for m in marks) or len(set(marks)) < 3:
        raise ValueError("each mark must be its own and not repeat its first character")
    if len({m[0] for m in marks}) > 1 or len({len(m) for m in marks}) > 1:
        raise ValueError("marks must share their first character and length")

    def one(doc_id: int | None, text: str) -> tuple:
        lines = Lines(text)
        n = lines.number
        a, b, c, d = _numbers(seed, doc_id)
        if not text or any(m in text for m in marks) or c % 100 >= rate:
            return n, "plain", None, None, text
        first, second = sorted((a % (n + 1), b % (n + 1)))
        i, j = lines.border(first), lines.border(second)
        prefix, middle, suffix = text[:i], text[i:j], text[j:]
        p, s, m = marks
        if d % 100 < spm:
            return n, "spm", i, j - i, f"{s}{suffix}{p}{prefix}{m}{middle}"
        return n, "psm", i, j - i, f"{p}{prefix}{s}{suffix}{m}{middle}"

    fields = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n", pa.int64()),
            ("form", pa.string()),
            ("prefix_chars", pa.int64()),
            ("middle_chars", pa.int64()),
            ("output", pa.string()),
        ]
    )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_bytes(whole, 1):
                rows = map(one, batch.column(0).to_pylist(), texts(batch.column(1)))
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), list(fields)[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema=fields)

    out = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(walk, out)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that ``transformed`` was given, from its output and form."""
    parts = F.split(output, "|".join("\\Q" + m + "\\E" for m in marks), -1)
    return (
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )
