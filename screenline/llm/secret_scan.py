"""Secret scan: fixed patterns, and character Markov models.

Models of the next character given the one before it are counted from labelled
samples: random strings, one model for each alphabet that keys are written in
(hexadecimal, base 32, base 36, base 62, base 64), and ordinary identifiers and
words. The samples are what the fixed patterns found in the documents and seeded
random strings on the one side, words of the documents and seeded numbers, dates,
paths, names and rows of one mark made of them on the other. A run of letters,
digits and key characters is a secret when its log-likelihood ratio, under the
best alphabet and the ordinary model, is high enough, in whole and per
character. Samples are drawn by hash over all documents and bounded; what is
scanned is every whole text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # runs of [0-9a-f]+ are maximal: shorter ones fail
# Shorter runs cannot reach the ratio that is asked for.
SHORTEST = 10
RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % SHORTEST)
# A whole run of letters: pieces of a random string have digits beside them.
WORD = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z_-]{6,}(?![A-Za-z0-9+/_=-])")
KINDS = ("assign", "access", "hex", "markov")
# Training strings of each class, at most.
SAMPLE = 4000
# Log-likelihood ratio (nats) of a run, in whole and per character.
LEAST, LEAST_EACH = 13.0, 1.1
LONGEST = 400
# Runs whose ratio is kept per worker, at most.
KEPT = 200_000

_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ALPHABETS = {
    "hex": _DIGITS + "abcdef",
    "upper hex": _DIGITS + "ABCDEF",
    "base32": _LOWER + "234567",
    "upper base32": _UPPER + "234567",
    "base36": _LOWER + _DIGITS,
    "upper base36": _UPPER + _DIGITS,
    "base62": _LOWER + _UPPER + _DIGITS,
    "base64": _LOWER + _UPPER + _DIGITS + "+/",
    "url base64": _LOWER + _UPPER + _DIGITS + "-_",
}

# The marks of runs have codes of their own.
_CODES = np.full(256, 67, np.int64)
for _i, _c in enumerate((_UPPER + _LOWER + _DIGITS + "+/_=-").encode()):
    _CODES[_c] = _i
_STATES = 69  # 67 characters, one for all others, one for the start


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of each match of the fixed patterns, in order."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _steps(text: str) -> tuple[np.ndarray, np.ndarray]:
    codes = _CODES[np.frombuffer(text.encode("latin-1", "replace"), np.uint8)]
    return np.concatenate([[_STATES - 1], codes[:-1]]), codes


def transitions(samples: list[str]) -> np.ndarray:
    """Log probabilities of the next character after each one; what was seen
    too seldom after it leans on how often it was seen at all."""
    counts = np.zeros((_STATES, _STATES - 1))
    for s in samples:
        if s:
            np.add.at(counts, _steps(s), 1)
    alone = counts.sum(axis=0) + 0.1
    counts += 5 * alone / alone.sum()
    return np.log(counts / counts.sum(axis=1, keepdims=True))


def random_strings(alphabet: str, number: int, seed: int) -> list[str]:
    """Seeded random strings of 10 to 64 characters of an alphabet."""
    rng = np.random.default_rng(seed)
    letters = np.array(list(alphabet))
    return ["".join(letters[rng.integers(0, len(letters), n)]) for n in rng.integers(10, 65, number)]


def ordinary_strings(words: list[str], number: int, seed: int) -> list[str]:
    """Seeded strings as they stand in ordinary texts: words as names, paths and
    settings, numbers, dates, times, and rows of one mark."""
    rng = np.random.default_rng(seed)
    words = words or ["word"]

    def some() -> str:
        return words[rng.integers(len(words))].lower()

    def digits(n: int) -> str:
        return "".join(map(str, rng.integers(0, 10, n)))

    def date() -> str:
        return f"{rng.integers(1900, 2040)}-{rng.integers(1, 13):02d}-{rng.integers(1, 32):02d}"

    made = (
        lambda: "_".join(some() for _ in range(rng.integers(2, 5))),
        lambda: "-".join(some() for _ in range(rng.integers(2, 6))),
        lambda: "/".join(some() for _ in range(rng.integers(2, 5))),
        lambda: some() + "".join(some().title() for _ in range(rng.integers(1, 4))),
        lambda: "".join(some().title() for _ in range(rng.integers(1, 4))),
        lambda: some().upper(),
        lambda: "_".join(some() for _ in range(rng.integers(1, 4))).upper(),
        lambda: f"{some()}{rng.choice(['', '_', '-', '/'])}{digits(rng.integers(1, 5))}",
        lambda: f"{some()}={rng.choice([some(), digits(rng.integers(1, 9))])}",
        lambda: digits(rng.integers(4, 31)),
        lambda: "-".join(digits(rng.integers(2, 5)) for _ in range(rng.integers(2, 6))),
        lambda: "1234567890" * int(rng.integers(1, 4)),
        lambda: rng.choice(list(_LOWER + _UPPER + _DIGITS + "=-_/+=-_/+")) * int(rng.integers(4, 60)),
        lambda: date() + rng.choice(["", "-", "/", "_"]) + rng.choice([date(), digits(2) + "-" + digits(2), ""]),
        lambda: date().replace("-", rng.choice(["/", "_", ""])) + rng.choice(["", "T" + digits(6) + "Z", "_" + digits(6)]),
    )
    return [made[i % len(made)]() for i in range(number)]


class Model:
    """Ratios of random strings (the base's values join the alphabets that have
    all their characters) against ordinary ones."""

    def __init__(self, secrets: list[str], ordinary: list[str]):
        """Without ordinary words the seeded ones stand alone."""
        plain = transitions([*ordinary, *ordinary_strings(ordinary, SAMPLE, 5)])
        tables = []
        for i, letters in enumerate(ALPHABETS.values()):
            held = set(letters)
            fitting = [s for s in secrets if s and set(s) <= held]
            tables.append(transitions(random_strings(letters, SAMPLE, 100 + i) + fitting) - plain)
        self.ratios = np.stack(tables)
        self.kept: dict[str, float] = {}

    def score(self, run: str) -> float:
        """Log-likelihood ratio of a string, random against ordinary."""
        found = self.kept.get(run)
        if found is None:
            before, codes = _steps(run)
            found = float(self.ratios[:, before, codes].sum(axis=1).max()) if run else 0.0
            if len(run) <= 64:
                if len(self.kept) >= KEPT:
                    self.kept.clear()
                self.kept[run] = found
        return found

    def spans(self, text: str, taken: list[tuple[int, int]] = ()) -> list[tuple[int, int, int]]:
        """Random runs, and random pieces that ``taken`` spans, in order, leave
        of a run."""
        out, t = [], 0
        for m in RUN.finditer(text):
            at, end = m.span()
            pieces = []
            while t < len(taken) and taken[t][1] <= at:
                t += 1
            k = t
            while k < len(taken) and taken[k][0] < end:
                pieces.append((at, taken[k][0]))
                at = max(at, taken[k][1])
                k += 1
            pieces.append((at, end))
            for a, b in pieces:
                if b - a >= SHORTEST:
                    s = self.score(text[a:b])
                    if s >= LEAST and s >= LEAST_EACH * (b - a):
                        out.append((a, 3, b))
        return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, overlapping ones as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def digest(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def _harvest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text: its secret values, and long words that are no part of a secret."""
    for batch in batches:
        kinds, values = [], []
        for raw in batch.column(0).cast(pa.binary()).to_pylist():
            text = (raw or b"").decode("utf-8", "replace")
            spans = base_spans(text)
            found = [ASSIGN.match(text, a).group(2) if k == 0 else text[a:b] for a, k, b in spans]
            kinds += [1] * len(found)
            values += [v[:LONGEST] for v in found]
            for a, _, b in spans:
                text = text[:a] + " " * (b - a) + text[b:]
            words = WORD.findall(text)
            words = words[:: max(1, len(words) // 8)]
            kinds += [0] * len(words)
            values += [w[:LONGEST] for w in words]
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(values, pa.string())], ["secret", "value"])


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Models from at most ``sample`` secrets and ``sample`` ordinary words:
    those with the lowest hashes among all secrets, and among the words of a
    hash sample of documents of bounded size. Null texts teach nothing, repeated
    ones once; an empty table leaves the seeded strings."""
    texts = docs.select(F.col("text").cast("string")).where("text is not null")
    hinted = texts.where(F.col("text").rlike("(?i)password|passwd|secret|token|api_?key|AKIA|[0-9a-f]{32}"))
    n = texts.count()
    few = texts.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(min(1.0, sample / max(n, 1)) * (1 << 30)))

    def lowest(of: DataFrame, kind: int) -> list[str]:
        made = of.mapInArrow(_harvest, "secret int, value string").where(F.col("secret") == kind).select("value").distinct()
        return [r["value"] for r in made.orderBy(F.xxhash64("value"), "value").limit(sample).collect()]

    return Model(lowest(hinted, 1), lowest(few, 0))


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_markov, base_sha256 and spans of each
    row: places in code points, end exclusive. What a fixed
    pattern's match covers is left to that match, the rest of its run is not. A null text is empty: no spans, and
    the hash of an empty string. Equal rows give equal rows."""
    fields = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_markov long"

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for raw in batch.column(1).cast(pa.binary()).to_pylist():
                text = (raw or b"").decode("utf-8", "replace")
                base = base_spans(text)
                more = model.spans(text, merged([(a, b) for a, _, b in base]))
                n = [sum(k == kind for _, k, _ in base) for kind in range(3)]
                rows.append((*n, hashlib.sha256(digest(base).encode()).hexdigest(), digest(base + more), len(more)))
            names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_markov"]
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *names])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(look, fields)
