"""Spelling variants: words that differ by one letter, grouped under the
frequent form.

A word's letters as a multiset are a binary vector (one dimension for the j-th
copy of a letter). One inserted, deleted or replaced letter changes at most two
dimensions, so near words lie within Hamming distance two. The dimensions are
dealt to four parts; two changes touch two parts at most, so of the six choices
of two parts one is free of them: words that agree on no choice are not near.
Every word gives one exact signature per choice. A change also leaves the first
three or the last three letters as they are, wherever it falls; each signature
therefore occurs twice, bound to the letters in front and to those at the end.
Equal signatures are joined, and the words of each pair compared in full.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenline.llm.batches import by_bytes
from screenline.session import cut, shared_dir, spread

LEAST_LENGTH, LEAST_COUNT = 6, 5
# A form must be so many times as frequent.
FACTOR = 5
# One of so many runs loses a letter.
DAMAGE = 199
PARTS, AGREE, AFFIX = 4, 2, 3
# Copies of a letter that are dealt by frequency; later copies go by number.
COPIES = 4


_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
# Shorter runs give no word.
_RUN = re.compile("[a-z\u00c0-\u00ff]{%d,}" % LEAST_LENGTH)


def words_of(doc_id: int | None, text: bytes, one_of: int = DAMAGE) -> Counter[str]:
    """The words of one text with their numbers. A run loses a letter in one of
    ``one_of`` cases, which with the letter is drawn from document and run."""
    out: Counter[str] = Counter()
    drawn = zlib.crc32(b"%d:" % doc_id if doc_id is not None else b":")
    for run, n in Counter(_RUN.findall(text.translate(_LOWER).decode("utf-8", "replace"))).items():
        h = zlib.crc32(run.encode(), drawn)
        if h % one_of == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        out[run] += n
    return out


def word_counts(docs: DataFrame, one_of: int = DAMAGE) -> DataFrame:
    """word, n: the words of all texts of at least six letters and five
    occurrences. Counts are added up in each task before rows are exchanged."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_bytes(whole, 1):
                held: Counter[str] = Counter()
                raw = batch.column(1).cast(pa.binary()).to_pylist()
                for doc_id, text in zip(batch.column(0).to_pylist(), raw, strict=True):
                    for word, n in words_of(doc_id, text or b"", one_of).items():
                        held[word] += n
                columns = [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["word", "n"])

    some = docs.select("doc_id", "text").mapInArrow(count, "word string, n long")
    counts = some.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= LEAST_COUNT)


def dealt_letters(words: DataFrame) -> dict[tuple[str, int], int]:
    """The part of each (letter, copy), so that parts tell words apart about
    equally well. At most ``COPIES`` rows for each of the 89 letters are read."""
    each = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter"), "word")
    copies = F.length("word") - F.length(F.replace("word", F.col("letter")))
    held = each.select("letter", F.explode(F.sequence(F.lit(1), F.least(copies, F.lit(COPIES)))).alias("copy"))
    seen = held.groupBy("letter", "copy").agg(F.count("*").alias("n")).crossJoin(words.agg(F.count("*").alias("of")))
    weight = {(r.letter, r.copy): (r.n / r.of) * (1 - r.n / r.of) for r in seen.collect()}
    loads, part = [0.0] * PARTS, {}
    for key in sorted(weight, key=lambda k: (-weight[k], k)):
        part[key] = loads.index(min(loads))
        loads[part[key]] += weight[key]
    return part


def signatures(word: str, part: dict[tuple[str, int], int]) -> Iterator[int]:
    """The exact signatures of a word, as 64-bit numbers."""
    parts: list[list[str]] = [[] for _ in range(PARTS)]
    last, copy = "", 0
    for c in sorted(word):
        copy = copy + 1 if c == last else 1
        last = c
        at = part.get((c, copy))
        parts[(ord(c) + copy) % PARTS if at is None else at].append(f"{c}{copy}")
    joined = ["".join(p) for p in parts]
    for chosen in combinations(range(PARTS), PARTS - AGREE):
        letters = "|".join(f"{i}{joined[i]}" for i in chosen)
        yield xxhash.xxh64_intdigest(f"<{word[:AFFIX]}|{letters}") - (1 << 63)
        yield xxhash.xxh64_intdigest(f">{word[-AFFIX:]}|{letters}") - (1 << 63)


def near_words(words: DataFrame) -> DataFrame:
    """word, n, other, other_n: the pairs (both ways) of words that differ by
    exactly one inserted, deleted or replaced letter."""
    part = dealt_letters(words)

    def sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            signs = [sorted(set(signatures(w, part))) for w in frame["word"]]
            times = [len(s) for s in signs]
            yield pd.DataFrame(
                {
                    "sign": [s for some in signs for s in some],
                    "word": frame["word"].repeat(times).to_numpy(),
                    "n": frame["n"].repeat(times).to_numpy(),
                }
            )

    # Signed once, for both sides. As many partitions as set, not as few as the
    # rows' bytes ask for: the work is in the comparing.
    spark, fields = words.sparkSession, "sign long, word string, n long"
    folder = f"{shared_dir(spark)}/signatures-{uuid.uuid4().hex}"
    spread(words).mapInPandas(sign, fields).write.parquet(folder)
    many = int(spark.conf.get("spark.sql.shuffle.partitions"))
    signed = spark.read.schema(fields).parquet(folder).repartition(many, "sign")
    a, b = signed.alias("a"), signed.alias("b")
    long, short = F.length("a.word"), F.length("b.word")
    near = (
        (F.col("a.sign") == F.col("b.sign"))
        & (F.col("a.word") < F.col("b.word"))
        & (F.abs(long - short) <= 1)
        & (F.levenshtein("a.word", "b.word", 1) == 1)
    )
    one = F.struct(F.col("a.word"), F.col("a.n"), F.col("b.word").alias("other"), F.col("b.n").alias("other_n"))
    back = F.struct(F.col("b.word"), F.col("b.n"), F.col("a.word").alias("other"), F.col("a.n").alias("other_n"))
    return a.join(b, near).select(F.explode(F.array(one, back)).alias("pair")).select("pair.*").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word, root: where a word's forms end. A form is ``FACTOR`` times as
    frequent as its word, so no chain returns, and its length is a logarithm of
    the count; each round doubles the steps taken."""
    held = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        on = held.select(F.col("word").alias("root"), F.col("root").alias("further"))
        held = cut(held.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if held.where("moved").isEmpty():
            return held.select("word", "root")
        held = held.select("word", "root")


def variants(docs: DataFrame, one_of: int = DAMAGE) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of the texts.

    ``n_near`` counts the near words, ``form`` is the most frequent of them (the
    first in code-point order of several) where it is at least ``FACTOR`` times
    as frequent as the word, and ``root`` where following forms ends; the word
    itself where it has none. A null or empty text has no words; texts of any
    length are read whole; repeated rows count each time; a null doc_id is drawn
    as an empty one; an empty table gives an empty one; other columns are not
    looked at."""
    words = cut(word_counts(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), one_of))
    near = near_words(words)
    best = F.min_by("other", F.struct(-F.col("other_n"), F.col("other")))
    met = cut(near.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"), F.max("other_n").alias("best_n"), F.first("n").alias("n")))
    forms = met.where(F.col("best_n") >= FACTOR * F.col("n")).select("word", F.col("best").alias("form"), F.col("best_n").alias("form_n"))
    ends = forms.join(roots(forms), "word")
    out = words.join(met.select("word", "n_near"), "word", "left").join(ends, "word", "left")
    root, number = F.coalesce("root", "word"), F.coalesce("n_near", F.lit(0))
    return out.select("word", "n", number.cast("long").alias("n_near"), "form", "form_n", root.alias("root"))
