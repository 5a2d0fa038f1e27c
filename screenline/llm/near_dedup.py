"""Near-duplicate documents by b-bit MinHash.

1. Each text becomes its set of distinct word shingles, a fingerprint of that
   set, 128 minima and 32 bands of four minima (one Arrow pass, no shuffle). Of
   each minimum two bits are kept, packed in two planes of 128 bits.
2. Texts with equal sets form one class, whatever their number (an aggregate
   with partial results); only one row per class goes on.
3. Per band key the smallest node is the leader; each other member is paired
   with it. Pairs whose similarity, counted from the packed bits and corrected
   for chance agreement, is clearly below the threshold are let go; all others
   are confirmed on their full sets.
4. The links give components. In band keys that still hold several components,
   every member outside the most frequent component is compared with the members
   of other components: in small ones pair by pair, filtered and confirmed in
   the same way; in large ones in blocks of bounded size, of which only links
   leave. So no link between bucket members is lost, members known to be
   connected are not compared again, and a large group makes no table of pairs.

A pair at similarity 0.75 shares a band with probability 1 - 5e-6; the bit count
passes it with probability 1 - 4e-5.

doc_id names a document: texts under one doc_id count as one document. Rows
with a null doc_id are linked by their texts, but no component is named after
them unless it has no other rows (component_id null, kept true).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from screenline.llm import components as comp
from screenline.llm import shingles as sh
from screenline.session import cut, small

SIZE = 5
PERCENT = 75
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
WORDS = HASHES // 64
# The bit count's standard error at 0.75 is 0.046; four of them below it.
MARGIN = 0.18
# Members of a band key that are compared pair by pair, at most; and the sets of
# larger ones on each side of a block.
HOT, BLOCK = 64, 256
# Nodes whose sets are asked for by broadcast, at most.
NAMED = 200_000
# Nodes of texts without a doc_id lie from here on; doc_ids lie below.
NAMELESS = 1 << 62

_rng = np.random.default_rng(97)
_A = (_rng.integers(0, 1 << 32, HASHES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_SPAN = 256
_WORK = np.empty((HASHES, _SPAN), np.uint32)
_BAND = (_rng.integers(1, 1 << 63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)).astype(np.uint64)

_PLANES = [f"p{i}" for i in range(2 * WORDS)]
SIGNATURE = "doc_id long, n_shingles long, fp binary, bands array<long>, " + ", ".join(f"{p} long" for p in _PLANES)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The minimum of each hash function over a set of shingles."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), _SPAN):
        part = x[i : i + _SPAN]
        # Odd multipliers permute the 32-bit numbers.
        hashed = np.multiply(_A[:, None], part, out=_WORK[:, : len(part)])
        np.minimum(out, hashed.min(axis=1), out=out)
    return out


def band_keys(low: np.ndarray) -> np.ndarray:
    parts = low.reshape(BANDS, ROWS).astype(np.uint64) + np.uint64(1)
    return sh.mix((parts * _BAND).sum(axis=1, dtype=np.uint64))


def packed(low: np.ndarray) -> np.ndarray:
    """Two bits of each minimum as two planes of 64-bit words."""
    bits = sh.mix(low.astype(np.uint64) + np.uint64(1))
    planes = [np.packbits(((bits >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)).view(np.uint64) for b in (0, 1)]
    return np.concatenate(planes)


def fingerprint(shingles: np.ndarray) -> bytes:
    one = sh.mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    two = sh.mix(shingles + np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64)
    return sh.mix(np.array([one, two + np.uint64(len(shingles))], np.uint64)).tobytes()


def _long_lists(rows: list[np.ndarray | None]) -> pa.Array:
    lengths = [0 if r is None else len(r) for r in rows]
    offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
    full = [r for r in rows if r is not None]
    values = np.concatenate(full).view(np.int64) if full else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(offsets, pa.array(values), mask=pa.array([r is None for r in rows], pa.bool_()))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        counts, prints, bands = [], [], []
        planes = np.zeros((batch.num_rows, 2 * WORDS), np.uint64)
        for i, u in enumerate(sh.sets_of(batch.column(1), SIZE)):
            counts.append(len(u))
            if len(u):
                low = minima(u)
                prints.append(fingerprint(u))
                bands.append(band_keys(low))
                planes[i] = packed(low)
            else:
                prints.append(None)
                bands.append(None)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(counts, pa.int64()),
                pa.array(prints, pa.binary()),
                _long_lists(bands),
                *(pa.array(planes[:, j].view(np.int64)) for j in range(2 * WORDS)),
            ],
            ["doc_id", "n_shingles", "fp", "bands", *_PLANES],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        sets, prints = [], []
        for u in sh.sets_of(batch.column(1), SIZE):
            sets.append(u)
            prints.append(fingerprint(u) if len(u) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(prints, pa.binary()), _long_lists(sets)], ["doc_id", "fp", "shingles"]
        )


def _node(doc_id: Column, fp: Column) -> Column:
    """A class is named after its smallest doc_id, or after its set when it has
    none (a number from NAMELESS on, so that any doc_id comes before it)."""
    return F.coalesce(doc_id, F.xxhash64(fp).bitwiseAND(F.lit(NAMELESS - 1)).bitwiseOR(F.lit(NAMELESS)))


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, fp, bands and bit planes of each row (null or blank
    text: no fp, no bands)."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_sign, SIGNATURE)


def similarity(left: str, right: str) -> Column:
    """Share of agreeing minima, counted from two bits of each and corrected
    for the quarter that agrees by chance."""
    differ = sum(
        F.bit_count(
            F.col(f"{left}.p{i}").bitwiseXOR(F.col(f"{right}.p{i}")).bitwiseOR(
                F.col(f"{left}.p{WORDS + i}").bitwiseXOR(F.col(f"{right}.p{WORDS + i}"))
            )
        )
        for i in range(WORDS)
    )
    return (F.lit(1.0) - differ / F.lit(float(HASHES)) - F.lit(0.25)) / F.lit(0.75)


def sets_named(named: DataFrame, docs: DataFrame) -> DataFrame:
    """id, shingles: the sets of the nodes in ``named`` (id), made again from the
    texts. Up to NAMED ids are broadcast, so that no text is moved for them."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    wanted = rows.join(small(named, NAMED), F.col("doc_id") == F.col("id"), "left_semi")
    # Rows without an id are named after their sets, so all of them are looked at.
    sets = wanted.unionAll(rows.where("doc_id is null")).mapInArrow(_sets, "doc_id long, fp binary, shingles array<long>")
    return sets.where("fp is not null").select(_node(F.col("doc_id"), F.col("fp")).alias("id"), "shingles")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id")))


def confirm(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of nodes whose full sets have 100 * |both| >= percent * |either|."""
    one = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    met = pairs.select("a", "b").join(one, "a").join(two, "b")
    met = met.select("a", "b", F.size(F.array_intersect("sa", "sb")).alias("n"), (F.size("sa") + F.size("sb")).alias("m"))
    return met.where(100 * F.col("n") >= percent * (F.col("m") - F.col("n"))).select("a", "b")


def classes_of(base: DataFrame) -> DataFrame:
    """One row per distinct set: fp, node, bands, bit planes."""
    kept = base.where("fp is not null").groupBy("fp")
    return kept.agg(F.min("doc_id").alias("doc_id"), *(F.first(c).alias(c) for c in ["bands", *_PLANES])).select(
        "fp", _node(F.col("doc_id"), F.col("fp")).alias("node"), "bands", *_PLANES
    )


def _likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a > b) whose packed bits allow the threshold."""
    sig = classes.select("node", *_PLANES)
    met = (
        pairs.alias("q")
        .join(sig.alias("x"), F.col("q.a") == F.col("x.node"))
        .join(sig.alias("y"), F.col("q.b") == F.col("y.node"))
    )
    return met.where(similarity("x", "y") >= percent / 100 - MARGIN).select("q.a", "q.b").distinct()


def _one_id(base: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of one doc_id: they belong together."""
    h = F.xxhash64("fp")
    many = base.where("fp is not null and doc_id is not null").groupBy("doc_id").agg(F.min(h).alias("x"), F.max(h).alias("y"))
    many = many.where("x <> y").select("doc_id")
    met = base.join(many, "doc_id").join(classes.select("fp", "node"), "fp")
    return met.select(F.col("doc_id").alias("a"), F.col("node").alias("b"))


def link_components(docs: DataFrame, base: DataFrame, classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(node, component) of every node that is linked with another one."""
    bands = classes.select("node", F.explode("bands").alias("key"))
    buckets = bands.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("n"))
    members = cut(bands.join(buckets.where("low < high"), "key").select("key", "node", "low", "n"))
    stars = members.where("node > low").select(F.col("node").alias("a"), F.col("low").alias("b")).distinct()
    stars = cut(_likely(stars, classes, percent))
    sure = confirm(stars, sets_named(_ends(stars).distinct(), docs), percent)
    found = comp.components(sure.unionAll(_one_id(base, classes)))

    # Buckets whose members are still apart: large ones in blocks, small ones
    # pair by pair; pairs of one family are met in its blocks.
    apart = cut(_apart(members.where("n > 2"), found).join(classes.select("node", *_PLANES), "node"))
    families = apart.where(F.col("n") > HOT).select(F.col("most").alias("family"), "node", "component", *_PLANES)
    families = cut(families.dropDuplicates(["family", "node"]))
    home = families.groupBy("node").agg(F.min("family").alias("family"))
    member = apart.where(F.col("n") <= HOT).join(home, "node", "left")
    met = member.where("component != most").alias("x").join(
        member.alias("y"),
        (F.col("x.key") == F.col("y.key"))
        & (F.col("x.component") != F.col("y.component"))
        # Two strays meet once.
        & ((F.col("y.component") == F.col("y.most")) | (F.col("x.node") > F.col("y.node")))
        & ~F.coalesce(F.col("x.family") == F.col("y.family"), F.lit(False))
        & (similarity("x", "y") >= percent / 100 - MARGIN),
    )
    more = met.select(F.greatest("x.node", "y.node").alias("a"), F.least("x.node", "y.node").alias("b")).distinct()
    more = cut(more.join(stars, ["a", "b"], "left_anti"))
    likely = cut(_likely_members(families, percent))
    sets = cut(sets_named(_ends(more).unionAll(likely.select(F.col("node").alias("id"))).distinct(), docs))
    links = confirm(more, sets, percent).unionAll(_family_links(likely, sets, percent))
    # Links between components make components of components.
    for end in ("a", "b"):
        own = found.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}"))
        links = links.join(own, end, "left").withColumn(f"of_{end}", F.coalesce(f"of_{end}", end))
    links = cut(links.select("of_a", "of_b").distinct())
    joined = comp.components(links, "of_a", "of_b").select(F.col("node").alias("was"), F.col("component").alias("now"))
    out = found.join(joined, F.col("component") == F.col("was"), "full_outer")
    return out.select(F.coalesce("node", "was").alias("node"), F.coalesce("now", "component").alias("component"))


def _apart(members: DataFrame, found: DataFrame) -> DataFrame:
    """key, n, node, component and most (the most frequent component) of the
    members of buckets that hold several components."""
    member = members.join(found, "node", "left")
    member = member.select("key", "n", "node", F.coalesce("component", "node").alias("component"))
    counts = member.groupBy("key", "component").agg(F.count("*").alias("k"))
    most = counts.groupBy("key").agg(
        F.max_by("component", F.struct("k", (-F.col("component")).alias("c"))).alias("most"), F.count("*").alias("parts")
    )
    return member.join(most.where("parts > 1").select("key", "most"), "key")


def _blocks(families: DataFrame, size: int) -> DataFrame:
    """Rows of families dealt to blocks of about ``size`` strays by ``size``
    members: every stray meets every member of its family in one block."""
    stray = F.col("component") != F.col("family")
    n = families.groupBy("family").agg(
        F.ceil(F.count("*") / size).alias("across"), F.greatest(F.ceil(F.count_if(stray) / size), F.lit(1)).alias("down")
    )
    rows = families.join(small(n), "family")
    i, j = F.pmod(F.xxhash64("node", F.lit(1)), "down"), F.pmod(F.xxhash64("node", F.lit(2)), "across")
    whole = rows.select("*", F.lit(False).alias("left"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("down") - 1)).alias("i"), j.alias("j"))
    part = rows.where(stray).select("*", F.lit(True).alias("left"), i.alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("across") - 1)).alias("j"))
    return whole.unionByName(part).drop("across", "down")


def _likely_members(families: DataFrame, percent: int) -> DataFrame:
    """family, node, component of the members of families that have a partner
    in another component whose packed bits allow the threshold."""
    least = percent / 100 - MARGIN

    def likely(block: pd.DataFrame) -> pd.DataFrame:
        x, y = block[block["left"]], block[~block["left"]]
        p, q = (b[_PLANES].to_numpy(np.int64).view(np.uint64) for b in (x, y))
        differ = np.zeros((len(x), len(y)), np.int16)
        for w in range(WORDS):
            bits = (p[:, None, w] ^ q[None, :, w]) | (p[:, None, WORDS + w] ^ q[None, :, WORDS + w])
            differ += np.bitwise_count(bits)
        near = (1 - differ / HASHES - 0.25) / 0.75 >= least
        near &= x["component"].to_numpy()[:, None] != y["component"].to_numpy()[None, :]
        out = pd.concat([x[near.any(axis=1)], y[near.any(axis=0)]])
        return out[["family", "node", "component"]].drop_duplicates()

    # Dealt out anew: else all blocks of a family would stay in the task that
    # counted it.
    blocks = _blocks(families, 4 * BLOCK).repartition("family", "i", "j").groupBy("family", "i", "j")
    return blocks.applyInPandas(likely, "family long, node long, component long").distinct()


def _family_links(families: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of the strays of each family with other components in it:
    full sets meet in blocks, and only links leave a block."""

    def linked(block: pd.DataFrame) -> pd.DataFrame:
        x, y = block[block["left"]], block[~block["left"]]
        both = common(x["shingles"].tolist(), y["shingles"].tolist())
        size = [b["shingles"].map(len).to_numpy() for b in (x, y)]
        good = 100 * both >= percent * (size[0][:, None] + size[1][None, :] - both)
        good &= x["component"].to_numpy()[:, None] != y["component"].to_numpy()[None, :]
        at, to = np.nonzero(good)
        return pd.DataFrame({"a": x["node"].to_numpy()[at], "b": y["node"].to_numpy()[to]}, dtype="int64")

    blocks = _blocks(families, BLOCK).join(sets, F.col("node") == F.col("id"))
    return blocks.groupBy("family", "i", "j").applyInPandas(linked, "a long, b long")


def common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of two lists of sets, by a product of 0/1
    matrices over the numbers on both sides, some thousand columns at a time."""
    out = np.zeros((len(left), len(right)), np.float64)
    if not left or not right:
        return out
    a, b = np.concatenate(left), np.concatenate(right)
    kinds = np.intersect1d(a, b)
    rows = [np.repeat(np.arange(len(s)), [len(v) for v in s]) for s in (left, right)]
    places = []
    for v, r in zip((a, b), rows, strict=True):
        at = np.minimum(np.searchsorted(kinds, v), max(0, len(kinds) - 1))
        hit = kinds[at] == v if len(kinds) else np.zeros(len(v), bool)
        places.append((r[hit], at[hit]))
    for start in range(0, len(kinds), 4096):
        width = min(4096, len(kinds) - start)
        m = []
        for (r, at), n in zip(places, (len(left), len(right)), strict=True):
            part = (at >= start) & (at < start + width)
            one = np.zeros((n, width), np.float32)
            one[r[part], at[part] - start] = 1
            m.append(one)
        out += m[0] @ m[1].T
    return out


def decisions(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, fp and component of each row; component is NAMELESS
    or more where no document of the component has a doc_id, null where the
    text has no words."""
    base = cut(signatures(docs))
    classes = cut(classes_of(base))
    found = link_components(docs, base, classes, percent)
    name = classes.select("fp", "node").join(found, "node", "left")
    name = name.select("fp", F.coalesce("component", "node").alias("component"))
    return base.select("doc_id", "n_shingles", "fp").join(name, "fp", "left")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of documents.

    Links are pairs of texts whose sets of 5-word shingles have Jaccard
    similarity of at least ``percent``/100. component_id is the smallest doc_id
    reachable over links; kept is doc_id = component_id. Texts that are null or
    have no word link with nothing. An empty table gives an empty result; other
    columns of the input are not looked at.
    """
    own = F.coalesce("component", "doc_id")
    out = decisions(docs, percent).withColumn("component_id", F.when(own < NAMELESS, own))
    return out.select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"),
    )


@F.pandas_udf(T.BinaryType())
def _print_of(texts: pd.Series) -> pd.Series:
    sets = sh.sets_of(pa.array(texts, pa.string()), SIZE)
    return pd.Series([fingerprint(u) if len(u) else None for u in sets], dtype=object)


def drop_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` less near-duplicates: of each component the document
    with the smallest doc_id stays, one row of it. Rows with neither doc_id nor
    words stay."""
    made = cut(decisions(docs, percent))
    kept = made.where("doc_id is not null and (component is null or component = doc_id)").select("doc_id").distinct()
    named = docs.where("doc_id is not null").dropDuplicates(["doc_id"]).join(kept, "doc_id", "left_semi")
    # Rows without a doc_id: one of each component that has no other row.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    nameless = docs.where("doc_id is null").select(row, _print_of(F.col("text").cast("string")).alias("_fp"))
    names = made.where(F.col("component") >= NAMELESS).select("fp", "component").distinct()
    one = nameless.join(names, F.col("_fp") == F.col("fp")).dropDuplicates(["component"])
    rest = one.select("_row").unionAll(nameless.where("_fp is null").select("_row"))
    return named.unionAll(rest.select(*[F.col(f"_row.`{c}`") for c in docs.columns]))
