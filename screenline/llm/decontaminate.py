"""Benchmark decontamination: MinHash containment search, partitioned by size.

Test items are short and documents long, so the similarity of an item to a
whole document says nothing. Items are therefore partitioned by the number of
their shingles (up to 1, 2, 4, 8, ...), and for each partition documents are cut
into overlapping windows of that size: every run of as many shingles as the
largest item of the partition lies in one window. An item contained to 0.75 then
has a Jaccard similarity of at least 0.27 to some window, and shares at least
one of 32 minima with it with probability 1 - 4e-5 (one minimum per band).
Minima of blocks are halved into those of larger blocks, so all partitions of
short items cost about as much as one; for a partition of long items only the
documents that are long enough to contain one are cut, so a document is padded to
a few times its own length at most. Candidates are verified by exact shingle
containment in the whole document. An item of fewer words than a shingle has is a
run of so many words, looked up among all such runs of a document.

Documents are read in place and never shuffled. Items go to the tasks in blocks
of at most ITEMS items and CHARS characters, one pass over the documents per
block; so what is broadcast has a fixed bound, and any number of items works.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenline.llm import shingles as sh

SIZE = 5
PERCENT = 75
HASHES = 32
ITEMS = 4096
CHARS = 8_000_000
# Partitions of longer items are searched one by one.
TOGETHER = 256
FOUND = "doc_id long, item_id long, n_item_shingles long, n_common long, containment double"

_rng = np.random.default_rng(11)
_A = (_rng.integers(0, 1 << 32, HASHES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_PAD = np.uint32(0xFFFFFFFF)
_LOW = np.uint32(0xFFFF)


def _folded(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(32)).astype(np.uint32)


def size_class(n: int) -> int:
    """The partition of an item with n shingles: the next power of two."""
    return 1 << (n - 1).bit_length()


def _shape(size: int) -> tuple[int, int]:
    """Shingles per block and blocks per window of a partition."""
    return (1, size) if size <= 4 else (size // 4, 5)


class Items:
    """The minima of one block of items, by partition and hash function."""

    def __init__(self, rows: list[tuple[int | None, str | None]], size: int = SIZE):
        self.size = size
        texts = pa.array([t for _, t in rows], pa.string())
        self.ids, self.sets = [], []
        classes: dict[int, list[int]] = {}
        # Items of fewer words than a shingle: by number of words and hash.
        self.short: dict[int, dict[int, list[int]]] = {}
        for (item, _), words in zip(rows, sh.words_of(texts), strict=True):
            if len(words):
                i, s = len(self.ids), sh.shingles(words, size)
                self.ids.append(item)
                self.sets.append(s)
                if len(words) < size:
                    self.short.setdefault(len(words), {}).setdefault(int(s[0]), []).append(i)
                else:
                    classes.setdefault(size_class(len(s)), []).append(i)
        self.least = {c: min(len(self.sets[i]) for i in members) for c, members in classes.items()}
        self.tables = {}
        for c, members in classes.items():
            low = np.array([(_A[:, None] * _folded(self.sets[i])).min(axis=1) for i in members])
            order = np.argsort(low, axis=0, kind="stable")
            values = np.take_along_axis(low, order, axis=0)
            marks = np.zeros((HASHES, 1 << 16), bool)
            for h in range(HASHES):
                marks[h][values[:, h] & _LOW] = True
            self.tables[c] = (values.T.copy(), np.array(members)[order].T.copy(), marks)

    def candidates(self, hashes: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
        """Pairs of text number and item number that share a minimum; the texts'
        shingles in order lie end to end in ``hashes``."""
        small = [c for c in self.tables if c <= TOGETHER]
        found = [self._sharing(small, hashes, counts)]
        ends = np.cumsum(counts)
        for c in self.tables:
            if c > TOGETHER:
                fit = np.flatnonzero(100 * counts >= percent * self.least[c])
                if len(fit):
                    some = np.concatenate([hashes[ends[i] - counts[i] : ends[i]] for i in fit])
                    pairs = self._sharing([c], some, counts[fit])
                    found.append(np.column_stack([fit[pairs[:, 0]], pairs[:, 1]]))
        return np.unique(np.concatenate(found), axis=0)

    def runs(self, words: np.ndarray, counts: np.ndarray) -> set[tuple[int, int]]:
        """Pairs of text number and short item that is a run of its words."""
        ends, out = np.cumsum(counts), set()
        for k, items in self.short.items():
            if len(words) < k:
                continue
            over = sh.runs_of(words, k)
            at = np.flatnonzero(np.isin(over, np.fromiter(items, np.uint64, len(items))))
            text = np.searchsorted(ends, at, side="right")
            inside = at + k <= ends[text]
            out.update((int(t), i) for t, h in zip(text[inside], over[at[inside]], strict=True) for i in items[int(h)])
        return out

    def _sharing(self, classes: list[int], hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        blocks = {c: _shape(c) for c in classes}
        if not blocks or not len(hashes):
            return np.zeros((0, 2), np.int64)
        # Every text ends in padding, so no window reaches into the next one.
        widest = max(b for b, _ in blocks.values())
        reach = max(b * (n - 1) for b, n in blocks.values())
        padded = np.where(counts > 0, -(-(counts + reach) // widest) * widest, 0)
        begin = np.cumsum(padded) - padded
        first = np.cumsum(counts) - counts
        x = np.full(int(padded.sum()), _PAD, np.uint32)
        x[np.arange(len(hashes)) + np.repeat(begin - first, counts)] = _folded(hashes)
        text_of = np.repeat(np.arange(len(counts)), padded // widest)
        out = []
        for h in range(HASHES):
            level, width = x * _A[h], 1
            for c in sorted(classes):
                block, n = blocks[c]
                while width < block:
                    level = np.minimum(level[0::2], level[1::2])
                    width *= 2
                low = level
                for j in range(1, n):
                    low = np.minimum(low[: len(level) - j], level[j:])
                values, members, marks = self.tables[c]
                hit = np.flatnonzero(marks[h][low & _LOW])
                if not len(hit):
                    continue
                left = np.searchsorted(values[h], low[hit], "left")
                right = np.searchsorted(values[h], low[hit], "right")
                hit, left, right = (v[right > left] for v in (hit, left, right))
                for at, a, b in zip(text_of[hit * width // widest], left, right, strict=True):
                    out.extend((at, m) for m in members[h][a:b])
        return np.unique(np.array(out, np.int64).reshape(-1, 2), axis=0)

    def found(self, column: pa.Array, percent: int) -> Iterator[tuple[int, int, int]]:
        """(text number, item number, shingles in common) of each contained item."""
        for at, upto, hashes, counts in sh._chunks(column):
            runs = list(sh.shingles_of(column.slice(at, upto - at), self.size))
            lengths = np.array([len(r) for r in runs])
            last, full = -1, None
            for i, m in sorted(self.runs(hashes, np.asarray(counts))):
                yield at + i, m, 1
            for i, m in self.candidates(np.concatenate(runs), lengths, percent):
                if i != last:
                    last, full = i, np.sort(runs[i])
                item = self.sets[m]
                place = np.minimum(np.searchsorted(full, item), len(full) - 1)
                common = int((full[place] == item).sum())
                if 100 * common >= percent * len(item):
                    yield at + int(i), int(m), common


def item_blocks(items: DataFrame) -> Iterator[Items]:
    """The items (item_id, text) in blocks of bounded size, by hash of the row."""
    rows = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text is not null").distinct()
    total = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("c")).first()
    blocks = max(-(-total["n"] * 5 // (4 * ITEMS)), -(-total["c"] // CHARS), 1) if total["n"] else 0
    for b in range(blocks):
        block = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        yield Items([(r["item_id"], r["text"]) for r in block.orderBy("item_id", "text").collect()])


def contained_items(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per document row and test item of whose distinct 5-word shingles
    at least ``percent`` in 100 occur in the document: doc_id, item_id,
    n_item_shingles, n_common, containment.

    An item of fewer than five words is one shingle, and occurs where its words
    follow each other. Items and documents that are null or have no
    word match nothing; equal rows of items count once, equal rows of documents
    each. Empty tables give an empty result. Other columns are not looked at.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    parts = []
    for block in item_blocks(items):
        sent = spark.sparkContext.broadcast(block)

        def search(batches, sent=sent):
            for batch in batches:
                block = sent.value
                hits = list(block.found(batch.column(1), percent))
                if hits:
                    n = [len(block.sets[m]) for _, m, _ in hits]
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array([i for i, _, _ in hits])),
                            pa.array([block.ids[m] for _, m, _ in hits], pa.int64()),
                            pa.array(n, pa.int64()),
                            pa.array([c for _, _, c in hits], pa.int64()),
                            pa.array([c / k for (_, _, c), k in zip(hits, n, strict=True)], pa.float64()),
                        ],
                        ["doc_id", "item_id", "n_item_shingles", "n_common", "containment"],
                    )

        parts.append(rows.mapInArrow(search, FOUND))
    return reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], FOUND)


def drop_contaminated(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` in which no test item is contained, all columns."""
    at = docs.columns.index("text")
    for block in item_blocks(items):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def clean(batches, sent=sent):
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for i, _, _ in sent.value.found(batch.column(at), percent):
                    keep[i] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
