"""Which of very many phrases a text holds.

A text holds a phrase that occurs in it as it stands, or whose first four tokens
all do. A phrase that occurs brings its tokens along, so a phrase is sought by
its leading tokens alone, and one without any by itself. A short list is
compared within the row. Of a longer one, an automaton over all strings that are
sought is laid out once per Python worker and gives, in one scan of a text, the
numbers of the strings in it; these are kept. Phrases are cut in blocks so small
that a file of a block's rows names each phrase once, and the kept numbers are
met with one block at a time: which texts hold which strings is a table of bits,
a phrase's row of it that of its strings together. A worker gives each phrase of
a block once for many texts, with their rows in a list, so neither workers hold
the rows of the result, nor texts or found phrases are moved between tasks.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType
from pyspark.sql.window import Window as W

from screenline.functions.text import tokens
from screenline.operators.match import phrase_matches
from screenline.session import cut

# Ship the helpers with the job: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A list of at most so many phrases is compared in the row.
FEW = 500
# Characters of strings that are sought, and strings, in one automaton, about. If
# there are more, the phrases are cut in groups; the texts are read once per group.
BLOCK_CHARS = 8_000_000
BLOCK_STRINGS = 1_000_000
# Bytes of phrases in one block, at least so many of them each: a column's
# dictionary in a file of Parquet has a million bytes, and a phrase that is not in
# it is written again in every row.
BLOCK_BYTES, LEAST_BYTES = 700_000, 90
# Blocks, about, whose phrases the driver holds at a time.
AT_ONCE = 16
# Fixed value: tokens that can stand for a phrase.
LEADING = 4
# Texts met with a block at a time; texts, and numbers found in them, that a
# worker holds at a time; rows, and bytes of them, that it gives at a time.
SLICE_MET, SLICE_TEXTS, SLICE_FOUND = 1_024, 64, 250_000
GIVEN_ROWS, GIVEN_BYTES = 500_000, 16_000_000


def _strings_in(text: Column, shared) -> Column:
    """The numbers of a broadcast list's strings in each text. The automaton is
    built on first use and stays with the worker's copy of the list."""

    @F.arrow_udf("array<int>")
    def strings(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kept = shared.value
        if "automaton" not in kept:
            kept["automaton"] = ahocorasick.Automaton()
            for i, s in enumerate(kept.pop("strings")):
                kept["automaton"].add_word(s, i)
            kept["automaton"].make_automaton()
        for column in columns:
            found, ends = [], [0]

            def given() -> pa.Array:
                return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.array(found, np.int32)))

            for at in range(0, len(column), SLICE_TEXTS):
                for t in column.slice(at, SLICE_TEXTS).to_pylist():
                    found += () if t is None else {i for _, i in kept["automaton"].iter(t)}
                    ends.append(len(found))
                    if len(found) > SLICE_FOUND:
                        yield given()
                        found, ends = [], [0]
            if len(ends) > 1 or not len(column):
                yield given()

    return strings(text)


def _met(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From rows with the numbers of the strings in them to the phrases of a
    broadcast block, each with a list of the rows that hold all its strings."""

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases, sought, strings = shared.value
        names = np.unique(sought)
        # Each string's place in the block's table; the last line is for all others.
        place = np.full(strings, len(names), np.int32)
        place[names] = np.arange(len(names))
        at = place[sought]
        for batch in batches:
            for begin in range(0, len(batch), SLICE_MET):
                some = batch.slice(begin, SLICE_MET)
                lists = some.column("_strings")
                row = np.repeat(np.arange(len(some)), np.diff(lists.offsets.to_numpy()))
                holds = np.zeros((len(names) + 1, len(some)), bool)
                holds[place[lists.flatten().to_numpy()], row] = True
                held = holds[at[:, 0]]
                for i in range(1, at.shape[1]):
                    held &= holds[at[:, i]]
                rows = pa.StructArray.from_arrays(some.columns[:-1], fields=list(some.schema)[:-1])
                most = min(GIVEN_ROWS, GIVEN_BYTES * len(some) // max(1, some.nbytes))
                times = held.sum(axis=1)
                turn = np.cumsum(times) // max(1, most)
                for k in np.unique(turn[times > 0]):
                    which = np.flatnonzero((turn == k) & (times > 0))
                    ends = np.concatenate([[0], np.cumsum(times[which])]).astype(np.int32)
                    given = rows.take(pa.array(np.nonzero(held[which])[1]))
                    yield pa.RecordBatch.from_arrays([phrases.take(pa.array(which)), pa.ListArray.from_arrays(pa.array(ends), given)], ["phrase", "rows"])

    return met


def match_phrases(
    df: DataFrame, text: Column, phrases: DataFrame, stop: Sequence[str] = (), few: int = FEW, keep: Sequence[str] | None = None
) -> DataFrame:
    """Rows of ``df``, or the columns ``keep`` of them, with each phrase of the
    table (column phrase) they match.

    Empty and null phrases are left out, a phrase counts once; a null text
    matches none; equal rows match alike; without phrases there are no rows."""
    keep = list(keep or df.columns)
    p = cut(phrases.select("phrase").where(F.col("phrase") != "").distinct())
    n = p.count()
    low = F.lower(text)
    if n <= few:
        listed = F.array(*[F.lit(r.phrase) for r in p.collect()]).cast("array<string>")
        return df.select(*keep, F.explode(phrase_matches(low, listed, stop)).alias("phrase"))
    lead = F.array_sort(F.array_distinct(F.slice(tokens(F.col("phrase"), stop), 1, LEADING)))
    led = p.select("phrase", F.when(F.size(lead) > 0, lead).otherwise(F.array("phrase")).alias("sought"))
    size = F.greatest(F.octet_length("phrase"), F.lit(LEAST_BYTES))
    k, chars = led.select(F.explode("sought").alias("s")).distinct().agg(F.count("*"), F.sum(F.length("s"))).first()
    groups = max(-(-chars // BLOCK_CHARS), -(-k // BLOCK_STRINGS))
    cells = -(-led.agg(F.sum(size)).first()[0] // (groups * AT_ONCE * BLOCK_BYTES))
    dealt = F.xxhash64("phrase")
    led = led.withColumns({"g": F.pmod(dealt, F.lit(groups)), "c": F.pmod(F.shiftright(dealt, 32), F.lit(cells))})
    before = F.sum(size).over(W.partitionBy("g", "c").orderBy("phrase").rowsBetween(W.unboundedPreceding, 0)) - size
    led = cut(led.withColumn("b", F.floor(before / BLOCK_BYTES).cast("int")))
    fields = [df.schema[c] for c in keep]
    schema = StructType([led.schema["phrase"], StructField("rows", ArrayType(StructType(fields)))])
    send = df.sparkSession.sparkContext.broadcast
    out = None
    for g in range(groups):
        mine = led.where(F.col("g") == g)
        strings = [r.s for r in mine.select(F.explode("sought").alias("s")).distinct().collect()]
        number = {s: i for i, s in enumerate(strings)}
        found = df.select(*keep, _strings_in(low, send({"strings": strings})).alias("_strings"))
        some = [r.c for r in mine.select("c").distinct().orderBy("c").collect()]
        if len(some) > 1 or mine.where("b > 0").limit(1).count():
            found = cut(found)
        for c in some:
            blocks: dict[int, list] = {}
            for r in mine.where(F.col("c") == c).select("b", "phrase", "sought").collect():
                blocks.setdefault(r.b, []).append((r.phrase, [number[s] for s in r.sought]))
            for b in sorted(blocks):
                # A phrase of fewer strings names its first one again.
                sought = np.array([(some_ + some_[:1] * LEADING)[:LEADING] for _, some_ in blocks[b]], np.int32)
                block = send((pa.array([x for x, _ in blocks[b]], pa.string()), sought, len(strings)))
                part = found.mapInArrow(_met(block), schema).select(F.explode("rows").alias("r"), "phrase").select("r.*", "phrase")
                out = part if out is None else out.unionByName(part)
    return out
