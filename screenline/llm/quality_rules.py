"""Quality rules: decision lists learned by sequential covering.

A rule is a conjunction of thresholds on statistics of a text. Rules are grown
one threshold at a time on two thirds of a bounded sample of labelled
documents, by information gain, pruned on the other third, and kept while they
are precise; the documents a rule covers are set aside before the next rule is
grown. The list becomes one ordered conditional expression of Spark, so scoring
is a projection of the documents: no join, no shuffle, no Python.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = "[\\x20\\x09-\\x0D]+"
WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30
# Labelled documents the rules are learned from, at most.
SAMPLE = 6000
MOST_RULES = 12
MOST_TERMS = 4
PRECISION = 0.9
CUTS = 48

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "n_words",
    "symbol_share",
    "upper_share",
    "mark_share",
    "digit_share",
    "mean_word",
    "dup_line_share",
    "repeat_share",
    "richness",
)


def _covered(words: str) -> list[tuple[str, Column]]:
    """Steps that give the number of words in windows found twice or more."""
    starts = F.sequence(F.lit(1), F.size(words) - (WINDOW - 1))
    hashes = F.when(
        F.size(words) >= WINDOW, F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    ).otherwise(F.array().cast("array<bigint>"))
    twice = F.size(F.array_distinct("_h")) < F.size("_h")
    # Windows in order of their hash: equal ones are neighbours.
    order = F.when(twice, F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))

    def same(e: Column, k: Column) -> Column:
        before = F.when(k > 0, F.get("_o", k - 1)["h"] == e["h"])
        return F.coalesce(before, F.lit(False)) | F.coalesce(F.get("_o", k + 1)["h"] == e["h"], F.lit(False))

    places = F.sort_array(F.transform(F.filter("_o", same), lambda e: e["i"]))
    # Each such window adds the words that the one before it does not hold.
    fresh = F.transform("_p", lambda p, k: F.when(k > 0, F.least(F.lit(WINDOW), p - F.get("_p", k - 1))).otherwise(WINDOW))
    total = F.coalesce(F.aggregate(fresh, F.lit(0), lambda a, b: a + b), F.lit(0))
    return [("_h", hashes), ("_o", order), ("_p", places), ("n_repeat_words", total.cast("long"))]


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs`` under _row, and the statistics of each text.

    A null or blank text has no words and zero in every statistic.
    """
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), body.alias("_t"))
    words = F.filter(F.split("_t", SPACE), lambda w: w != "")
    df = df.withColumn("_w", words)
    lines = F.filter(F.split("_t", "\n"), lambda x: F.length(F.btrim(x, F.lit(" \t\n\x0b\f\r"))) > 0)
    df = df.withColumn("_l", lines)
    for name, step in _covered("_w"):
        df = df.withColumn(name, step)
    n, chars = F.size("_w").cast("long"), F.length(F.array_join("_w", "")).cast("long")
    counts = F.struct(
        n.alias("n_words"),
        chars.alias("word_chars"),
        F.regexp_count("_t", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.size("_l").cast("long").alias("n_lines"),
        F.regexp_count("_t", F.lit("[A-Z\\u00C0-\\u00DE]")).alias("_upper"),
        F.regexp_count("_t", F.lit("[^\\p{L}\\p{N}\\x20\\x09-\\x0D]")).alias("_marks"),
        F.regexp_count("_t", F.lit("[0-9]")).alias("_digits"),
        F.size(F.array_distinct("_w")).alias("_kinds"),
    )
    # A generator: else a filter on a statistic would be pushed below the steps,
    # with all of them written out again inside it.
    df = df.select("_row", F.inline(F.array(counts)))

    def share(part: str, whole: str) -> Column:
        return F.col(part) / F.greatest(F.col(whole), F.lit(1))

    return df.select(
        "_row",
        *BASE,
        share("n_symbols", "word_chars").alias("symbol_share"),
        share("_upper", "word_chars").alias("upper_share"),
        share("_marks", "word_chars").alias("mark_share"),
        share("_digits", "word_chars").alias("digit_share"),
        share("word_chars", "n_words").alias("mean_word"),
        share("n_dup_lines", "n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        # Distinct words fall off with length, their logarithm's share hardly does.
        (F.log(F.col("_kinds") + 1.0) / F.log(F.col("n_words") + 1.5)).alias("richness"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Term:
    feature: str
    above: bool
    cut: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        v = x[:, FEATURES.index(self.feature)]
        return v > self.cut if self.above else v <= self.cut

    def column(self) -> Column:
        return F.col(self.feature) > self.cut if self.above else F.col(self.feature) <= self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


def _all(rule: list[Term], x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for t in rule:
        out &= t.holds(x)
    return out


def _best_term(x: np.ndarray, y: np.ndarray) -> Term | None:
    """The threshold with the highest information gain for the rows with y."""
    p, n = y.sum(), (~y).sum()
    if not p or not n:
        return None
    start, best, gain = np.log2(p / (p + n)), None, 1e-9
    for j, f in enumerate(FEATURES):
        # Half way between neighbouring quantiles of either class.
        at = np.linspace(0, 1, CUTS)
        seen = np.unique(np.concatenate([np.quantile(x[y, j], at), np.quantile(x[~y, j], at)]))
        cuts = (seen[1:] + seen[:-1]) / 2
        if not len(cuts):
            continue
        over = x[:, j][:, None] > cuts
        for above, side in ((True, over), (False, ~over)):
            tp, fp = (side & y[:, None]).sum(axis=0), (side & ~y[:, None]).sum(axis=0)
            worth = tp * (np.log2(np.maximum(tp, 0.5) / np.maximum(tp + fp, 1)) - start)
            k = int(np.argmax(worth))
            if worth[k] > gain:
                best, gain = Term(f, above, float(cuts[k])), worth[k]
    return best


def learn(x: np.ndarray, y: np.ndarray, seed: int = 3) -> list[list[Term]]:
    """An ordered list of rules for the rows with ``y`` true.

    Empty when a class is missing. Equal rows and ties change nothing: the
    first best threshold in feature order is taken.
    """
    rules: list[list[Term]] = []
    part = np.random.default_rng(seed).random(len(y)) < 2 / 3
    while len(rules) < MOST_RULES:
        gx, gy, px, py = x[part], y[part], x[~part], y[~part]
        rule: list[Term] = []
        inside = np.ones(len(gy), bool)
        while len(rule) < MOST_TERMS and (term := _best_term(gx[inside], gy[inside])):
            rule.append(term)
            inside &= term.holds(gx)
        if not rule:
            break

        def worth(r: list[Term], px=px, py=py) -> float:
            hit = _all(r, px)
            p, n = (hit & py).sum(), (hit & ~py).sum()
            return (p - n) / (p + n) if p + n else -1.0

        # Dropping trailing thresholds: the shortest of the best.
        rule = max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (worth(r), -len(r)))
        hit = _all(rule, x)
        if not (hit & y).sum() or (hit & y).sum() < PRECISION * hit.sum() or worth(rule) < 2 * PRECISION - 1:
            break
        rules.append(rule)
        x, y, part = x[~hit], y[~hit], part[~hit]
    return rules


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and low-quality flags of at most about ``sample`` labelled
    documents, drawn by hash of the doc_id from all labels; those that fail the
    base rule are left out, as no rule sees them. Labels or ids that are null
    count for nothing; of several labels of a document the lowest counts."""
    known = labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").alias("_id"))
    known = known.agg(F.min("quality").alias("_q"))
    n = known.count()
    if not n:
        return np.zeros((0, len(FEATURES))), np.zeros(0, bool)
    drawn = known.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 31)) < int(min(1.0, 0.9 * sample / n) * (1 << 31)))
    # At most ``sample`` ids, so they fit a broadcast.
    joined = docs.select(F.col("doc_id").alias("_id"), "text").join(F.broadcast(drawn.limit(sample)), "_id")
    rows = statistics(joined).where(~base_failed()).select("_row._id", "_row._q", *FEATURES).limit(sample).collect()
    rows.sort(key=lambda r: tuple(r))
    x = np.array([[float(r[f]) for f in FEATURES] for r in rows]).reshape(-1, len(FEATURES))
    return x, np.array([r["_q"] == 0 for r in rows], bool)


def verdict(rules: list[list[Term]]) -> Column:
    """The first rule that holds, as text; null when none does."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        both = rule[0].column()
        for t in rule[1:]:
            both = both & t.column()
        out = F.when(both, F.lit(" and ".join(map(str, rule)))).otherwise(out)
    return out


def judged(docs: DataFrame, rules: list[list[Term]]) -> DataFrame:
    """_row, statistics, base_failed, kept and rule of each document. kept is
    false when the base rule or a learned rule rejects it."""
    out = statistics(docs).withColumn("base_failed", base_failed()).withColumn("rule", verdict(rules))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def learned_rules(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[list[Term]]:
    return learn(*labelled_sample(docs, labels, sample))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, all columns."""
    out = judged(docs, learned_rules(docs, labels)).where("kept")
    return out.select(*[F.col(f"_row.`{c}`") for c in docs.columns])
