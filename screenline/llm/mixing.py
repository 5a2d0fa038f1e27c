"""Mixing sources to target weights by Sainte-Lague apportionment.

The documents of a source, in an order drawn by a seed, lie end to end as one
stream of words. A stream is cut into blocks of BLOCK words. As many blocks as
the whole mix has are given to the sources one after the other, each to the
source with the highest quotient target / (2 * blocks + 1); sources too small for such blocks
share what is theirs in blocks of one word. A source with more
blocks than its stream has repeats the stream; what is left over is given to
the stripes of its stream (the shards of the mix) by the same rule, and each
stripe gives a run of so many blocks from a place drawn by the seed. What a
document gives follows from where its words lie, by arithmetic.

The words' places come from two sums: over cells of a source (a hash of the
document picks the cell, about one cell per square root of the documents) and
over the documents of a cell. So no window holds more than a cell, however
large a source is. One row per source reaches the driver, if there are at most
MOST_SOURCES; more sources are planned in tasks, by a search for the divisor.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from fractions import Fraction
from math import floor

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenline.operators.ranking import row_numbers
from screenline.session import cut, fits, local_table

WORD = "[^\\x20\\x09-\\x0D]+"
BLOCK = 64
STRIPES = 64
CAP = 3
SEED = 17
# Words of a source from which a block is less than half a percent of it;
# smaller sources are given word by word.
WHOLE_BLOCKS = 256 * BLOCK
# Sources whose plan is made in the driver and broadcast, at most.
MOST_SOURCES = 10_000
_PLAN = (
    "name string, source_size long, target double, block long, repeats long, stripe long, held array<long>,"
    " quota array<long>, first array<long>, words array<long>"
)


def sainte_lague(weights: list, seats: int, most: list[int] | None = None) -> list[int]:
    """``seats`` given one by one to the highest quotient weight / (2 * got + 1),
    never more than ``most`` to one party; ties go to the first. Seats that no
    party may take stay empty.

    Most seats are given at once: the result is round(weight / d) for some
    divisor d, and as roundings differ from shares by half a seat each, a party
    gets at least weight * (seats - parties / 2) / sum - 1/2 of them.
    """
    weights = [Fraction(w) for w in weights]
    most = [seats] * len(weights) if most is None else list(most)
    total = sum(weights)
    if not weights or total <= 0 or seats <= 0:
        return [0] * len(weights)
    sure = (seats - Fraction(len(weights), 2)) / total
    got = [max(0, min(m, floor(w * sure - Fraction(1, 2)))) for w, m in zip(weights, most, strict=True)]
    left = seats - sum(got)
    heap = [(-(w / (2 * g + 1)), i) for i, (w, g, m) in enumerate(zip(weights, got, most, strict=True)) if w and g < m]
    heapq.heapify(heap)
    while left > 0 and heap:
        _, i = heapq.heappop(heap)
        got[i] += 1
        left -= 1
        if got[i] < most[i]:
            heapq.heappush(heap, (-(weights[i] / (2 * got[i] + 1)), i))
    return got


def targets(sizes: list[int], weights: list[int], cap: int = CAP) -> list[Fraction]:
    """All words shared by weight; a share above ``cap`` times its source stops
    there, and the excess is shared again among the others."""
    out = [Fraction(0)] * len(sizes)
    left, open_ = Fraction(sum(sizes)), list(range(len(sizes)))
    while open_:
        whole = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] > cap * sizes[i] * whole]
        for i in over or open_:
            out[i] = Fraction(cap * sizes[i]) if over else left * weights[i] / whole
        if not over:
            break
        left -= sum(out[i] for i in over)
        open_ = [i for i in open_ if i not in set(over)]
    return out


def _block(n: int) -> int:
    return BLOCK if n >= WHOLE_BLOCKS else 1


def _plan(sources: list[tuple[str | None, int]], seed: int) -> list[tuple]:
    """The plan of each source, sources by name, null last."""
    sources = sorted(sources, key=lambda s: (s[0] is None, s[0] or ""))
    sizes = [n for _, n in sources]
    want = targets(sizes, [i % 3 + 1 for i in range(len(sources))])
    seats = [0] * len(sources)
    for block in (BLOCK, 1):
        mine = [i for i, n in enumerate(sizes) if _block(n) == block]
        most = [CAP * -(-sizes[i] // block) for i in mine]
        got = sainte_lague([want[i] for i in mine], round(sum((want[i] for i in mine), Fraction(0)) / block), most)
        for i, q in zip(mine, got, strict=True):
            seats[i] = q
    return [_planned(name, n, float(t), q, seed) for (name, n), t, q in zip(sources, want, seats, strict=True)]


def _planned(name: str | None, n: int, target: float, seats: int, seed: int) -> tuple:
    """One source: name, words, target, words of a block, whole repeats, words
    per stripe, quota and first block of each stripe, words given by the stripes
    before it."""
    block = _block(n)
    b = -(-n // block)
    repeats, rest = divmod(seats, b) if b else (0, 0)
    stripe = max(1, -(-b // STRIPES))
    held = [min(stripe, b - s) for s in range(0, b, stripe)]
    quota = sainte_lague(held, rest, held)
    first = [(seed * 7919 + 104_729 * s * s + 31 * s + len(held)) % h for s, h in enumerate(held)]
    before, words = 0, []
    for s, (h, k, f) in enumerate(zip(held, quota, first, strict=True)):
        words.append(before)
        length = min(stripe * block, n - s * stripe * block)
        before += _given(length, length, h, k, f, block)
    return name, n, target, block, repeats, stripe * block, held, quota, first, words


def _divided(parties: DataFrame, seats: int, block: int) -> DataFrame:
    """Parties (rank, target, most, ...) with ``seats``, given as the one-by-one
    rule does: round(target / d) for the divisor d that gives so many; of parties
    that stand equal at it the first ones get theirs."""

    def got(d: float) -> Column:
        return F.least("most", F.floor(F.col("target") / F.lit(d) + 0.5)).cast("long")

    def counts(ds: list[float]) -> list[int]:
        row = parties.agg(*[F.coalesce(F.sum(got(d)), F.lit(0)).alias(f"c{i}") for i, d in enumerate(ds)]).first()
        return list(row)

    # Low divisors give more seats than wanted, high ones fewer or as many.
    low, high = block / 4, block * 4.0
    while counts([high])[0] > seats:
        high *= 16
    for _ in range(40):
        if counts([low])[0] > seats or low < 1e-9:
            break
        low /= 16
    for _ in range(8):
        grid = [low * (high / low) ** (i / 32) for i in range(1, 32)]
        few = [i for i, n in enumerate(counts(grid)) if n <= seats]
        edges = [low, *grid, high]
        at = (few[0] if few else len(grid)) + 1
        low, high = edges[at - 1], edges[at]
        if high / low < 1 + 1e-12:
            break
    held = parties.withColumn("seats", got(high)).withColumn("_more", got(low) > got(high))
    left = seats - counts([high])[0]
    if left <= 0:
        return held.drop("_more")
    turn = row_numbers(held.where("_more").select("rank"), [], "rank", "_turn").where(F.col("_turn") <= left)
    extra = turn.select("rank", F.lit(1).alias("_extra"))
    held = held.join(extra, "rank", "left").withColumn("seats", F.col("seats") + F.coalesce("_extra", F.lit(0)))
    return held.drop("_more", "_extra")


def _planned_in_tasks(whole: DataFrame, seed: int) -> DataFrame:
    """The plan of any number of sources (source, n), made by sums over them."""
    named = row_numbers(whole.where("source is not null"), [], "source", "rank")
    last = whole.where("source is null").withColumn("rank", F.lit(whole.count()).cast("long"))
    d = cut(named.unionByName(last).withColumn("w", ((F.col("rank") - 1) % 3 + 1).cast("double")))
    total, weights = d.agg(F.sum("n"), F.sum("w")).first()
    # What one unit of weight gets, once the sources that stop short are out.
    share = total / weights
    while True:
        stops = F.col("n") * CAP < F.col("w") * F.lit(share)
        given, out = d.where(stops).agg(F.coalesce(F.sum("n"), F.lit(0)) * CAP, F.coalesce(F.sum("w"), F.lit(0.0))).first()
        now = (total - given) / (weights - out) if weights > out else share
        if now <= share:
            break
        share = now
    d = d.withColumn("target", F.least(F.col("n") * float(CAP), F.col("w") * F.lit(share)))
    parts = []
    for block, some in ((BLOCK, F.col("n") >= WHOLE_BLOCKS), (1, F.col("n") < WHOLE_BLOCKS)):
        mine = d.where(some).withColumn("most", F.ceil(F.col("n") / block) * CAP)
        seats = round((mine.agg(F.sum("target")).first()[0] or 0) / block)
        parts.append(_divided(mine, seats, block))
    seated = parts[0].unionByName(parts[1]).select("source", "n", "target", "seats")

    def plan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [_planned(*r, seed) for r in zip(f["source"], f["n"].tolist(), f["target"].tolist(), f["seats"].tolist(), strict=True)]
            yield pd.DataFrame(rows, columns=[c.split(" ")[0] for c in _PLAN.split(", ")])

    return cut(seated.mapInPandas(plan, _PLAN))


def _given(x: int, length: int, held: int, quota: int, first: int, block: int) -> int:
    """Words among the first ``x`` of a stripe of ``length`` words that lie in
    the run of ``quota`` of its ``held`` blocks from block ``first``, round the end."""
    head = max(0, first + quota - held)
    a, b, c = first * block, min((first + quota) * block, length), min(head * block, length)
    return max(0, min(x, b) - a) + min(x, c)


def _given_column(x: Column, length: Column, held: Column, quota: Column, first: Column) -> Column:
    head = F.greatest(F.lit(0), first + quota - held)
    block = F.col("block")
    b = F.least((first + quota) * block, length)
    return F.greatest(F.lit(0), F.least(x, b) - first * block) + F.least(x, F.least(head * block, length))


def _upto(x: Column) -> Column:
    """Words of the left-over blocks among the first ``x`` words of the stream."""
    s = F.least(F.floor(x / F.col("stripe")), F.size("held") - 1).cast("int")
    start = s.cast("long") * F.col("stripe")
    length = F.least(F.col("stripe"), F.col("source_size") - start)
    return F.get("words", s) + _given_column(x - start, length, F.get("held", s), F.get("quota", s), F.get("first", s))


def placed(docs: DataFrame, seed: int = SEED, carry: bool = False) -> DataFrame:
    """doc_id, source, size, the place of the document's first word in its
    source's stream (begin), and the source's plan, for each row; with ``carry``
    the whole row too, as _row.

    A null text has size 0; a null source is a source of its own, last in
    order. Equal rows lie next to each other; an empty table gives an empty one.
    """
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    draw = F.xxhash64(F.lit(seed), "doc_id")
    columns = [F.col("doc_id").cast("long"), F.col("source").cast("string"), size.alias("size"), draw.alias("draw")]
    narrow = cut(docs.select(*columns))
    cells = max(1, round(narrow.count() ** 0.5))
    # Rows of one doc_id, or without one, are spread by size as well.
    cell = F.pmod(F.xxhash64("draw", "size"), F.lit(cells)).alias("cell")
    sums = cut(narrow.select("*", cell).groupBy("source", "cell").agg(F.sum("size").alias("words")))
    whole = sums.groupBy("source").agg(F.sum("words").alias("n"))
    if fits(whole, MOST_SOURCES):
        listed = [(r["source"], r["n"]) for r in whole.collect()]
        plan = F.broadcast(local_table(docs.sparkSession, _plan(listed, seed), _PLAN))
    else:
        plan = _planned_in_tasks(cut(whole), seed)
    ahead = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source", "cell", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("before"))
    sums = sums.select(F.col("source").alias("_s"), F.col("cell").alias("_c"), "before")
    if carry:
        row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
        narrow = docs.select(*columns, row)
    inside = Window.partitionBy("source", "cell").orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = narrow.select("*", cell).withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    met = rows.join(sums, F.col("source").eqNullSafe(F.col("_s")) & (F.col("cell") == F.col("_c")))
    met = met.join(plan, F.col("source").eqNullSafe(F.col("name")))
    return met.withColumn("begin", F.col("before") + F.col("inside"))


def _rest() -> Column:
    """Words of the left-over blocks that lie in the document."""
    words = _upto(F.col("begin") + F.col("size")) - _upto(F.col("begin"))
    return F.when(F.col("size") > 0, words).otherwise(F.lit(0)).cast("long")


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken (words the mix takes of the
    document, repeats counted) and repeats (whole repeats), for each row.

    A null text has no words and is not taken; a null source is one of its own,
    last in order; rows of one id or without one, and equal rows, each take their
    own place; texts of any length are counted whole; an empty table gives an
    empty one; other columns are not looked at."""
    rows = placed(docs, seed)
    taken = F.col("repeats") * F.col("size") + _rest()
    return rows.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "repeats")


def mixed(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row per whole repeat of a
    document, and one for the left-over blocks in it. Where those hold a part of
    the document only, its text is the part's words, joined by spaces, and a
    column n_chars is its length. Documents without words are left out."""
    rows = placed(docs, seed, carry=True).withColumn("rest", _rest())
    copies = F.col("repeats") + F.when(F.col("rest") > 0, 1).otherwise(0)
    rows = rows.withColumn("copies", copies).where("copies > 0 and size > 0")
    rows = rows.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    place = F.col("begin")
    words = F.regexp_extract_all(F.col("_row.text").cast("string"), F.lit(WORD), F.lit(0))
    part = F.array_join(F.filter(words, lambda w, i: _upto(place + i + 1) > _upto(place + i)), " ")
    text = F.when((F.col("copy") > F.col("repeats")) & (F.col("rest") < F.col("size")), part).otherwise(F.col("_row.text"))
    rows = rows.withColumn("_text", text)

    def column(c: str) -> Column:
        if c == "text":
            return F.col("_text").alias(c)
        if c == "n_chars":
            return F.length("_text").cast(docs.schema[c].dataType).alias(c)
        return F.col(f"_row.`{c}`")

    return rows.select(*[column(c) for c in docs.columns])
