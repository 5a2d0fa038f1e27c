"""Language identification by a byte convolutional network.

Bytes of a window are embedded, convolved with filters of several widths,
rectified, pooled by maximum over the window and fed to a softmax. The network
is trained in numpy on windows of a bounded sample of labelled documents. A
text is cut into windows of fixed length, all of them are scored in batches,
and the class with the highest mean log-probability, windows weighted by their
bytes, is the prediction. Only the text is an input of it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenline.llm.shingles import texts_as_bytes

LENGTH = 128
EMBED = 8
FILTERS = 16
WIDTHS = (2, 3, 4)
BATCH = 32
# Training documents per language, and windows of each, at most.
DOCUMENTS, WINDOWS = 800, 4
EPOCHS, LEAST_STEPS, STEP = 6, 500, 0.004
UNKNOWN = "und"


def windows(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the texts, zero at their ends: bytes (n, LENGTH), text
    number and number of bytes of each. An empty text has none."""
    each = -(-(ends - starts) // LENGTH)
    owner = np.repeat(np.arange(len(each)), each)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(each) - each, each)
    begin = starts[owner] + place * LENGTH
    size = np.minimum(ends[owner] - begin, LENGTH)
    at = begin[:, None] + np.arange(LENGTH)
    padded = np.append(data, np.uint8(0))
    return np.where(np.arange(LENGTH) < size[:, None], padded[np.minimum(at, len(data))], 0), owner, size


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Network:
    def __init__(self, classes: list[str], seed: int = 5):
        rng = np.random.default_rng(seed)
        self.classes = classes
        self.w = {"embed": rng.normal(0, 0.3, (256, EMBED))}
        for k in WIDTHS:
            self.w[f"conv{k}"] = rng.normal(0, (2 / (k * EMBED)) ** 0.5, (k * EMBED, FILTERS))
            self.w[f"bias{k}"] = np.zeros(FILTERS)
        self.w["out"] = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(classes)))
        self.w["out_bias"] = np.zeros(len(classes))
        self.w = {n: v.astype(np.float32) for n, v in self.w.items()}
        self.tables = None

    def gradients(self, ids: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Loss and gradients of one batch of windows."""
        x = self.w["embed"][ids]
        n, pooled, kept = len(ids), [], []
        for k in WIDTHS:
            t = LENGTH - k + 1
            cols = np.concatenate([x[:, j : j + t] for j in range(k)], axis=2)
            raw = cols @ self.w[f"conv{k}"] + self.w[f"bias{k}"]
            best = raw.argmax(axis=1)
            top = np.take_along_axis(raw, best[:, None], axis=1)[:, 0]
            pooled.append(np.maximum(top, 0))
            kept.append((best, top > 0))
        hidden = np.concatenate(pooled, axis=1)
        p = softmax(hidden @ self.w["out"] + self.w["out_bias"])
        loss = -np.log(p[np.arange(n), y] + 1e-9).mean()
        d = p.copy()
        d[np.arange(n), y] -= 1
        d /= n
        g = {"out": hidden.T @ d, "out_bias": d.sum(axis=0)}
        back = d @ self.w["out"].T
        embed = np.zeros_like(self.w["embed"])
        rows = np.arange(n)[:, None]
        for i, (k, (best, on)) in enumerate(zip(WIDTHS, kept, strict=True)):
            dk = back[:, i * FILTERS : (i + 1) * FILTERS] * on
            g[f"bias{k}"] = dk.sum(axis=0)
            conv, conv_w = np.zeros_like(self.w[f"conv{k}"]), self.w[f"conv{k}"]
            for j in range(k):
                # Only the place of the maximum passes the gradient on.
                at = ids[rows, best + j]
                part = slice(j * EMBED, (j + 1) * EMBED)
                seen = self.w["embed"][at]
                conv[part] = np.einsum("nfe,nf->ef", seen, dk)
                np.add.at(embed, at, dk[:, :, None] * conv_w[part].T[None])
            g[f"conv{k}"] = conv
        g["embed"] = embed
        return loss, g

    def train(self, ids: np.ndarray, y: np.ndarray, seed: int = 6) -> None:
        rng = np.random.default_rng(seed)
        m = {n: np.zeros_like(v) for n, v in self.w.items()}
        v = {n: np.zeros_like(w) for n, w in self.w.items()}
        step = 0
        for _ in range(max(EPOCHS, -(-LEAST_STEPS * 64 // len(ids)))):
            order = rng.permutation(len(ids))
            for i in range(0, len(order), 64):
                step += 1
                part = order[i : i + 64]
                _, g = self.gradients(ids[part], y[part])
                for n, d in g.items():
                    m[n] += 0.1 * (d - m[n])
                    v[n] += 0.01 * (d * d - v[n])
                    size = STEP / (1 - 0.9**step) * (1 - 0.99**step) ** 0.5
                    self.w[n] -= (size * m[n] / (np.sqrt(v[n]) + 1e-8)).astype(np.float32)
        # Each filter's answer to each byte at each of its places.
        self.tables = {
            k: [(self.w["embed"] @ self.w[f"conv{k}"][j * EMBED : (j + 1) * EMBED]).astype(np.float32) for j in range(k)]
            for k in WIDTHS
        }

    def log_probabilities(self, ids: np.ndarray) -> np.ndarray:
        """Per window and class. Filters are sums of table rows, one per byte."""
        out = np.empty((len(ids), len(self.classes)), np.float32)
        sums = np.empty((LENGTH, BATCH, FILTERS), np.float32)
        more = np.empty_like(sums)
        for i in range(0, len(ids), BATCH):
            part = np.ascontiguousarray(ids[i : i + BATCH].T)
            b, pooled = part.shape[1], []
            for k in WIDTHS:
                t = LENGTH - k + 1
                s, r = (a.reshape(-1)[: t * b * FILTERS].reshape(t, b, FILTERS) for a in (sums, more))
                np.take(self.tables[k][0], part[:t], axis=0, out=s, mode="clip")
                for j in range(1, k):
                    np.take(self.tables[k][j], part[j : j + t], axis=0, out=r, mode="clip")
                    s += r
                pooled.append(np.maximum(s.max(axis=0) + self.w[f"bias{k}"], 0))
            x = np.concatenate(pooled, axis=1) @ self.w["out"] + self.w["out_bias"]
            x -= x.max(axis=1, keepdims=True)
            out[i : i + b] = x - np.log(np.exp(x).sum(axis=1, keepdims=True))
        return out

    def predict(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Class number and its probability for each text (-1 for one without windows)."""
        data, starts, ends = texts_as_bytes(column)
        total = np.zeros((len(column), len(self.classes)))
        weight = np.zeros(len(column))
        at = 0
        while at < len(column):
            # A bounded number of windows at a time; a longer text is one step.
            upto = max(at + 1, int(np.searchsorted(ends, starts[at] + (1 << 20), side="right")))
            ids, owner, size = windows(data, starts[at:upto], ends[at:upto])
            scores = self.log_probabilities(ids) * size[:, None]
            np.add.at(total, at + owner, scores)
            np.add.at(weight, at + owner, size)
            at = upto
        p = softmax(total / np.maximum(weight, 1)[:, None])
        best = p.argmax(axis=1)
        return np.where(weight > 0, best, -1), p[np.arange(len(best)), best]


def held_out() -> Column:
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    return F.pmod(F.crc32(key), F.lit(4)) == 2


def training_windows(docs: DataFrame, documents: int = DOCUMENTS) -> list[tuple[str, bytes]]:
    """(lang, bytes) of windows at places drawn by hash, from the ``documents``
    distinct texts of lowest hash per language, at most, of labelled documents
    that are not held out. Copies of a text are one text."""
    known = docs.where(F.col("lang").isNotNull() & ~held_out() & F.col("text").rlike("\\p{L}"))
    known = known.select("lang", "text", F.xxhash64("text").alias("_h"))
    # Ranked are only the lowest, twice as many as needed and some more.
    kinds, draw = known.select("lang", "_h").distinct(), F.pmod("_h", F.lit(1 << 30))
    n = F.broadcast(kinds.groupBy("lang").agg(F.count("*").alias("_n")))
    low = kinds.join(n, "lang").where(draw / F.lit(float(1 << 30)) * F.col("_n") < 2 * documents + 100)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(draw, "_h"))
    lowest = low.select("lang", "_h", rank.alias("_r")).where(F.col("_r") <= documents).drop("_r")
    places = F.transform(
        F.sequence(F.lit(1), F.lit(WINDOWS)),
        lambda i: F.pmod(F.xxhash64("text", i), F.greatest(F.length("text") - LENGTH, F.lit(1))).cast("int") + 1,
    )
    pieces = F.transform(F.array_distinct(places), lambda p: F.substring("text", p, F.lit(LENGTH)))
    drawn = known.join(F.broadcast(lowest), ["lang", "_h"]).select("lang", "_h", pieces.alias("_w")).dropDuplicates(["lang", "_h"])
    rows = drawn.select("lang", F.explode("_w").alias("w")).select("lang", F.col("w").cast("binary")).collect()
    return sorted((r["lang"], bytes(r["w"])[:LENGTH]) for r in rows)


def learn(docs: DataFrame, documents: int = DOCUMENTS) -> Network | None:
    """The network, or None when no document teaches a language."""
    rows = training_windows(docs, documents)
    if not rows:
        return None
    classes = sorted({lang for lang, _ in rows})
    ids = np.zeros((len(rows), LENGTH), np.uint8)
    for i, (_, w) in enumerate(rows):
        ids[i, : len(w)] = np.frombuffer(w, np.uint8)
    net = Network(classes)
    net.train(ids, np.array([classes.index(lang) for lang, _ in rows]))
    return net


_ASCII = re.compile(rb"[A-Za-z]")


def _has_letter(raw: bytes) -> bool:
    return bool(_ASCII.search(raw)) or any(c.isalpha() for c in raw.decode("utf-8", "replace"))


def identify(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each row. A null text, or one
    without a letter, is ``und`` with score 0; so is every text when no
    language was learned. Equal texts get equal answers."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2)
            raw = texts.cast(pa.binary()).to_pylist()
            if net and batch.num_rows:
                best, p = net.predict(texts)
            else:
                best, p = np.full(batch.num_rows, -1), np.zeros(batch.num_rows)
            known = [b >= 0 and r is not None and _has_letter(r) for b, r in zip(best, raw, strict=True)]
            lang = [net.classes[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
            score = np.where(known, p, 0.0)
            columns = [batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), F.col("text").cast("string"))
    return rows.mapInArrow(look, "doc_id long, held_out boolean, lang_pred string, score double")
