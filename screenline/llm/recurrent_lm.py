"""Scoring texts with a gated recurrent language model.

All words of the training documents are counted on Spark. The most frequent
ones (HEAD) are words of the network, in classes of at most CLASS words: the
model's probability of a word is that of its class given the state, times that
of the word in its class given the state. The text's end is a class of its own;
all other words are one class more, and share its probability by their counts,
so every word, known or not, has a probability and no count is left out.

The network is trained in numpy, in Spark tasks, on every training document,
whole: in rounds of growing shares of the documents, each task goes on from the
weights of the round before over its part, and the driver takes the mean of the
tasks' weights (of a word's by how often a task met it). Back-propagation is
truncated to STEPS words or more; the state is carried to a document's end. Scoring runs
over whole documents too, many side by side, in windows of STEPS words.

Words are looked up by 64-bit hash. Counts of at most FREQUENT words are sent
to the tasks; what a document needs of the rest is joined by word.
"""

from __future__ import annotations

import collections
import copy
import heapq
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenline.llm import shingles as sh
from screenline.session import cut

HEAD = 8192
CLASS = 96
TOPICS = 8
FREQUENT = 1 << 19
STATE = 24
STEPS = 32
LANES = 512
# Rounds of training: the first and the last draw (of DRAWS) of each, and its
# rate. Together they are all documents. Classes of words come from all of them
# at once.
DRAWS = 16
ROUNDS = ((0, 2, 0.01), (2, 6, 0.01), (6, 16, 0.005))
# Texts side by side in training, and words of a training task at least.
TRAIN_LANES, TRAIN_WORDS = 256, 2_000_000
# Values of a sum that go to the driver by way of one task.
SPAN = 1 << 13
END = np.uint64(0x2545F4914F6CDD1D)
LOG10 = 1.0 / np.log(10.0)
# What the gates' inputs are multiplied with, so that exp comes next: of a
# logistic function, of another one, of a tanh.
FACTOR = np.repeat(np.float32([-1, -1, 2]), STATE)


def held_out() -> Column:
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    return F.pmod(F.crc32(key), F.lit(5)) == 1


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, n) of the words of a task's texts, added up many texts at a time."""

    def summed(parts: list[np.ndarray]) -> pa.RecordBatch:
        token, n = np.unique(np.concatenate(parts), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n.astype(np.int64))], ["token", "n"])

    parts, size = [], 0
    for batch in batches:
        for _, _, hashes, counts in sh._chunks(batch.column(0), sh.piece_hashes):
            parts += [hashes, np.full(len(counts), END)]
            size += len(hashes) + len(counts)
            if size > 4_000_000:
                yield summed(parts)
                parts, size = [], 0
    if size:
        yield summed(parts)


def word_counts(docs: DataFrame) -> DataFrame:
    """token (hash), n: over every word of the documents that are not held out,
    one end for each."""
    texts = docs.where(~held_out()).select(F.coalesce(F.col("text").cast("string"), F.lit("")))
    return texts.mapInArrow(_count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


# Keys looked up at a time, so that the work arrays stay in the processor's cache.
_KEYS = 1 << 15


class Lookup:
    """Positions of 64-bit keys, by an open table."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(len(keys) * 2).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.slot_key = np.zeros(1 << bits, np.uint64)
        self.slot_at = np.full(1 << bits, -1, np.int32)
        todo, place = np.arange(len(keys)), (keys & self.mask).astype(np.int64)
        self.probes = 0
        while len(todo):
            self.probes += 1
            free = self.slot_at[place] < 0
            first = np.zeros(len(todo), bool)
            first[np.unique(place, return_index=True)[1]] = True
            take = free & first
            self.slot_key[place[take]] = keys[todo[take]]
            self.slot_at[place[take]] = todo[take]
            todo, place = todo[~take], (place[~take] + 1) & int(self.mask)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The position of each key, -1 for one that is not there."""
        out = np.full(len(keys), -1, np.int32)
        for i in range(0, len(keys), _KEYS):
            self._find(keys[i : i + _KEYS], out[i : i + _KEYS])
        return out

    def _find(self, keys: np.ndarray, out: np.ndarray) -> None:
        place = (keys & self.mask).astype(np.int64)
        todo = None
        for _ in range(self.probes):
            k, p = (keys, place) if todo is None else (keys[todo], place[todo])
            at = self.slot_at[p]
            hit = (at >= 0) & (self.slot_key[p] == k)
            if todo is None:
                out[hit] = at[hit]
                todo = np.flatnonzero(~hit & (at >= 0))
            else:
                out[todo[hit]] = at[hit]
                todo = todo[~hit & (at >= 0)]
            if not len(todo):
                break
            place[todo] = (place[todo] + 1) & int(self.mask)


# Texts whose words' company is added up at a time.
_TEXTS = 128


def company(texts: Iterator[np.ndarray], size: int) -> np.ndarray:
    """Added up over texts, for each of ``size`` words: the most frequent words
    of the texts that hold it, and the number of these texts."""
    top = min(64, size)
    out = np.zeros((size, top + 1))
    while some := list(itertools.islice(texts, _TEXTS)):
        n, word, text = len(some), np.concatenate(some), np.repeat(np.arange(len(some)), [len(s) for s in some])
        about = np.ones((n, top + 1), np.float32)
        few = word < top
        about[:, :top] = np.bincount(text[few] * top + word[few], minlength=n * top).reshape(n, top)
        about[:, :top] /= np.maximum(1, np.linalg.norm(about[:, :top], axis=1, keepdims=True))
        # Which word is in which text, a row for each word.
        known, held = word < size, np.zeros((size, n), np.float32)
        held.reshape(-1)[word[known].astype(np.int64) * n + text[known]] = 1
        out += held @ about
    return out


def classes_of(met: np.ndarray, seed: int = 8) -> np.ndarray:
    """A class for each word of ``company``: words met in like documents together,
    and within those, words of like frequency (lower numbers are more frequent)."""
    size, vector, n = len(met), met[:, :-1].copy(), met[:, -1]
    vector /= np.maximum(n, 1)[:, None]
    norm = np.linalg.norm(vector, axis=1, keepdims=True)
    vector /= np.maximum(norm, 1e-9)
    rng = np.random.default_rng(seed)
    k = max(1, min(TOPICS, size // 4))
    centre = vector[rng.choice(size, k, replace=False)] if size else vector
    near = np.zeros(size, int)
    for _ in range(12):
        near = (vector @ centre.T).argmax(axis=1) if size else near
        for j in range(k):
            if (near == j).any():
                mean = vector[near == j].mean(axis=0)
                centre[j] = mean / max(1e-9, np.linalg.norm(mean))
    out, at = np.zeros(size, int), 0
    for j in range(k):
        members = np.flatnonzero(near == j)
        # Few words in the first, most frequent class; then CLASS in each.
        edge, width = 0, 16
        while edge < len(members):
            out[members[edge : edge + width]] = at
            at, edge, width = at + 1, edge + width, min(CLASS, width * 2)
    return out


# Words of the texts that wait for a lane, see ``last_by_length``.
_WAIT = 1 << 19


def last_by_length(texts: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    """Texts in their order, but the last ones, of _WAIT words together, longest
    first, so that lanes end at about the same time."""
    held, size = collections.deque(), 0
    for t in texts:
        held.append(t)
        size += len(t) + 1
        while size > _WAIT:
            size -= len(held[0]) + 1
            yield held.popleft()
    yield from sorted(held, key=len, reverse=True)


# Rows of a softmax at a time, so that it stays in the processor's cache.
_ROWS = 1024
# Values updated at a time, for the same reason.
_VALUES = 1 << 14


class Model:
    """Word numbers: 0..size-1 the network's words, then the other words as one
    (size), then the end (size + 1), which is also what a text starts from."""

    def __init__(self, counts: np.ndarray, klass: np.ndarray, rest: float, ends: float, seed: int = 9):
        size = len(counts)
        self.size, self.other, self.end = size, size, size + 1
        n = int(klass.max()) + 1 if size else 0
        # Classes of as many words follow each other.
        widths = np.bincount(klass, minlength=n)
        klass = np.argsort(np.argsort(widths, kind="stable"))[klass]
        self.members = [np.flatnonzero(klass == c) for c in range(n)]
        self.klass = np.concatenate([klass, [n, n + 1]]).astype(np.int64)
        self.place = np.zeros(size + 2, np.int64)
        for m in self.members:
            self.place[m] = np.arange(len(m))
        self.n_classes = n + 2
        # Words in the order of their classes: where each class begins, and where each word is.
        self.order = np.concatenate([*self.members, []]).astype(np.int64)
        self.edges = np.cumsum([0, *map(len, self.members)])
        # First and last class of each number of words.
        self.alike = [(g[0], g[-1] + 1) for _, g in ((w, list(g)) for w, g in itertools.groupby(range(n), lambda c: len(self.members[c])))]
        self.at = np.arange(size + 2)
        self.at[self.order] = np.arange(size)
        rng = np.random.default_rng(seed)
        mass = np.array([counts[m].sum() for m in self.members] + [rest, ends], float) + 0.5
        self.w = {
            "embed": rng.normal(0, 0.3, (size + 2, STATE)),
            "wx": rng.normal(0, STATE**-0.5, (STATE, 3 * STATE)),
            "wh": rng.normal(0, STATE**-0.5, (STATE, 3 * STATE)),
            "b": np.zeros(3 * STATE),
            "cw": np.zeros((STATE, self.n_classes)),
            "cb": np.log(mass / mass.sum()),
            "ow": np.zeros((size, STATE)),
            "ob": np.log(counts[self.order] + 0.5) if size else np.zeros(0),
        }
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}
        self.table, self.into, self.on, self.outer, self.inner = None, None, None, None, []

    @property
    def gates(self) -> np.ndarray:
        """The gates' inputs from each word."""
        return self.w["embed"] @ self.w["wx"] + self.w["b"]

    def _steps(self) -> None:
        """Tables for steps: words with a one beside them, which the gates'
        constants go with, and the way from words and from states to the gates."""
        w = self.w
        self.table = np.concatenate([w["embed"], np.ones((self.size + 2, 1), w["embed"].dtype)], axis=1)
        self.into = np.ascontiguousarray((np.concatenate([w["wx"], w["b"][None]]) * FACTOR).T)
        self.on = np.ascontiguousarray((w["wh"] * FACTOR).T)

    @np.errstate(over="ignore")
    def step(self, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, tuple]:
        """One word further: x are the gates' inputs from the word."""
        new, saved = self._step(np.ascontiguousarray((x * FACTOR).T), np.ascontiguousarray(h.T))
        return new.T, saved

    def _step(self, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, tuple]:
        """The same with texts as columns, so that what belongs to a gate lies
        together, and with inputs times FACTOR. What is too large for exp gives
        infinity, and the gate its limit."""
        u = self.on @ h
        zr = x[: 2 * STATE] + u[: 2 * STATE]
        np.exp(zr, out=zr)
        zr += 1
        np.divide(1, zr, out=zr)
        z, r = zr[:STATE], zr[STATE:]
        c = r * u[2 * STATE :]
        c += x[2 * STATE :]
        np.exp(c, out=c)
        c += 1
        np.divide(-2, c, out=c)
        c += 1
        new = h - c
        new *= z
        new += c
        return new, (h, u, z, r, c)

    def _fits(self) -> bool:
        """True when no value before a softmax can be too large for exp: states
        are between -1 and 1."""
        w = self.w
        one = np.ones(STATE, w["ow"].dtype)
        tops = [one @ np.abs(w["cw"]) + np.abs(w["cb"]), np.abs(w["ow"]) @ one + np.abs(w["ob"])]
        return max(float(t.max(initial=0)) for t in tops) < 60

    def _log_share(self, x: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Log softmax of each row's entry k; x is used up."""
        if not self.safe:
            np.minimum(x, 80, out=x)
        chosen = x.reshape(-1).take(np.arange(0, x.size, x.shape[1]) + k)
        return chosen - np.log(np.exp(x, out=x) @ np.ones(x.shape[1], x.dtype))

    def log_p(self, h: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Natural log probability of each word (of the class of other words, for those)."""
        return self._log_p(np.concatenate([h, np.ones((len(h), 1), h.dtype)], axis=1), np.arange(len(y)), y)

    def _log_p(self, states: np.ndarray, at: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The same for the states at the given places, with a one beside each."""
        k = self.klass[y]
        order = np.argsort(k.astype(np.min_scalar_type(self.n_classes)), kind="stable")
        h1 = states.take(at[order], axis=0)
        k, place = k[order], self.place[y[order]]
        found = np.empty(len(y), np.float32)
        for i in range(0, len(y), _ROWS):
            part = slice(i, i + _ROWS)
            found[part] = self._log_share(h1[part] @ self.outer, k[part])
        edges = np.searchsorted(k, np.arange(len(self.members) + 1))
        for low, high in self.alike:
            part = slice(edges[low], edges[high])
            v = np.empty((edges[high] - edges[low], len(self.members[low])), np.result_type(h1, self.outer))
            for c in range(low, high):
                a, b = edges[c], edges[c + 1]
                if a < b:
                    np.matmul(h1[a:b], self.inner[c], out=v[a - edges[low] : b - edges[low]])
            found[part] += self._log_share(v, place[part])
        out = np.empty(len(y), np.float32)
        out[order] = found
        return out

    @np.errstate(over="ignore")
    def gradients(self, x: np.ndarray, y: np.ndarray, on: np.ndarray, h: np.ndarray) -> tuple[float, dict, np.ndarray]:
        """Loss, gradients and last state of one window: words x, next words y
        and what counts, all (steps, lanes), from states h."""
        w, steps, lanes = self.w, *x.shape
        self._steps()
        e = self.table.take(x, axis=0)
        gates = np.matmul(self.into, e.transpose(0, 2, 1))
        # States with a one beside them, which the softmax's constants go with.
        kept, states = [], np.ones((steps, lanes, STATE + 1), gates.dtype)
        # A text starts from nothing where its first input is the end before it.
        first = x == self.end
        begins = [np.flatnonzero(f) if any_ else None for f, any_ in zip(first, first.any(axis=1).tolist(), strict=True)]
        h = np.array(h.T, order="C")
        for t in range(steps):
            if begins[t] is not None:
                h[:, begins[t]] = 0
            h, saved = self._step(gates[t], h)
            kept.append(saved)
            states[t, :, :STATE] = h.T
        flat, goal = states.reshape(-1, STATE + 1), y.reshape(-1)
        live = np.flatnonzero(on.reshape(-1))
        live = live[np.argsort(self.klass[goal[live]].astype(np.min_scalar_type(self.n_classes)), kind="stable")]
        hs, ys = flat.take(live, axis=0), goal[live]
        k, place = self.klass[ys], self.place[ys]
        back, safe, loss = np.empty((len(live), STATE), hs.dtype), self._fits(), 0.0

        def share(
            edges: list[int], own: list[int], to: np.ndarray, fro: np.ndarray, at: np.ndarray, word: np.ndarray, grown: np.ndarray
        ) -> np.ndarray:
            """Of softmaxes of one width, each over the rows between two edges and
            with its own words: what goes back to the states. Adds to the loss
            and gives the gradient of ``to``, for these words. Entries are given by
            their place in the softmax (``at``) and among all words."""
            nonlocal loss
            first, n, width = edges[0], edges[-1] - edges[0], own[1] - own[0]
            blocks = [
                (slice(a, b), slice(a - first, b - first), slice(v, w))
                for (a, b), (v, w) in zip(itertools.pairwise(edges), itertools.pairwise(own), strict=True)
                if a < b
            ]
            p, b = np.empty((n, width), hs.dtype), np.empty((n, STATE + 1), hs.dtype)
            for rows, mine, words in blocks:
                np.matmul(hs[rows], to[words].T, out=p[mine])
            if not safe:
                p -= p.max(axis=1, keepdims=True)
            entry, every = np.arange(0, n * width, width) + at, p.reshape(-1)
            chosen = every.take(entry)
            loss -= chosen.sum(dtype=float)
            np.exp(p, out=p)
            for _, mine, words in blocks:
                np.matmul(p[mine], fro[words], out=b[mine])
            total = b[:, STATE].copy()
            every[entry] = np.exp(chosen) - total
            loss += np.log(total).sum(dtype=float)
            inv = (1 / total)[:, None]
            b *= inv
            b -= fro.take(word, axis=0)
            inv = hs[first : first + n] * inv
            for _, mine, words in blocks:
                np.matmul(p[mine].T, inv[mine], out=grown[words])
            return b[:, :STATE]

        to = np.concatenate([w["cw"].T, w["cb"][:, None]], axis=1)
        fro = np.concatenate([w["cw"].T, np.ones((self.n_classes, 1), hs.dtype)], axis=1)
        outer, grown = np.zeros_like(to), np.empty_like(to)
        for i in range(0, len(live), _ROWS):
            part = slice(i, i + _ROWS)
            back[part] = share([i, min(i + _ROWS, len(live))], [0, self.n_classes], to, fro, k[part], k[part], grown)
            outer += grown
        to = np.concatenate([w["ow"], w["ob"][:, None]], axis=1)
        fro = np.concatenate([w["ow"], np.ones((self.size, 1), hs.dtype)], axis=1)
        inner = np.zeros_like(to)
        edges, own, at = np.searchsorted(k, np.arange(len(self.members) + 1)).tolist(), self.edges.tolist(), self.at[ys]
        for low, high in self.alike:
            part = slice(edges[low], edges[high])
            back[part] += share(edges[low : high + 1], own[low : high + 1], to, fro, place[part], at[part], inner)
        dh_all = np.zeros((steps * lanes, STATE), hs.dtype)
        dh_all[live] = back
        dh_all = dh_all.reshape(steps, lanes, STATE).transpose(0, 2, 1)
        # By step: of the third gate's part from the state, then of all gates. The
        # first three of these four belong to the state, the last three to the word.
        every = np.empty((steps, 4 * STATE, lanes), gates.dtype)
        dgates, dh, don = every[:, STATE:], np.zeros_like(h), np.zeros_like(self.on)
        on = np.ascontiguousarray(np.roll(self.on, STATE, axis=0).T)
        for t in reversed(range(steps)):
            before, u, z, r, c = kept[t]
            dh += dh_all[t]
            d, rest = every[t], 1 - z
            rest *= dh
            dz = np.subtract(c, before, out=d[STATE : 2 * STATE])
            dz *= z
            dz *= rest
            dc = np.multiply(c, c, out=d[3 * STATE :])
            np.subtract(1, dc, out=dc)
            rest *= 0.5
            dc *= rest
            dcr = np.multiply(dc, r, out=d[:STATE])
            dr = np.multiply(dcr, u[2 * STATE :], out=d[2 * STATE : 3 * STATE])
            r -= 1
            dr *= r
            du = d[: 3 * STATE]
            don += du @ before.T
            dh *= z
            dh += on @ du
            if begins[t] is not None:
                dh[:, begins[t]] = 0
        into = np.matmul(dgates, e).sum(axis=0).T * FACTOR
        g = {"wh": np.roll(don, -STATE, axis=0).T * FACTOR, "wx": into[:STATE], "b": into[STATE]}
        g |= {"cw": outer[:, :STATE].T, "cb": outer[:, STATE], "ow": inner[:, :STATE], "ob": inner[:, STATE]}
        g = {k: np.ascontiguousarray(v) for k, v in g.items()}
        de = np.matmul(dgates.transpose(0, 2, 1), self.into[:, :STATE]).reshape(-1, STATE)
        g["embed"] = np.zeros_like(w["embed"])
        word = x.reshape(-1).astype(np.min_scalar_type(self.end))
        order = np.argsort(word, kind="stable")
        word = word[order]
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        g["embed"][word[first]] = np.add.reduceat(de.take(order, axis=0), first, axis=0)
        n = max(1, len(live))
        for v in g.values():
            v /= n
        return loss / n, g, h.T

    def train(self, texts: Iterator[np.ndarray], rate: float) -> np.ndarray:
        """One pass over texts, whole, in lanes: a lane takes the next text where
        its last one ends, the state carried through each. Returns ``change``."""
        begun = {k: v.copy() for k, v in self.w.items()}
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.w.items()}
        met, goals = np.zeros(self.size + 2, np.int64), np.zeros(self.n_classes, np.int64)
        step, held, waiting = 0, {}, 0

        def update(g: dict) -> None:
            nonlocal step
            step += 1
            big = np.sqrt(sum(float(np.vdot(d, d)) for d in g.values()))
            fit = np.float32(min(1.0, 1.0 / max(big, 1e-9)))
            pace = np.float32(rate * (1 - 0.99**step) ** 0.5 / (1 - 0.9**step))
            for k, all_d in g.items():
                for i in range(0, all_d.size, _VALUES):
                    d, m1, m2, v = (a.reshape(-1)[i : i + _VALUES] for a in (all_d, m[k], v2[k], self.w[k]))
                    # Ten times the mean and a hundred times that of squares.
                    d *= fit
                    m1 *= np.float32(0.9)
                    m1 += d
                    d *= d
                    m2 *= np.float32(0.99)
                    m2 += d
                    np.sqrt(m2, out=d)
                    d += np.float32(1e-6)
                    np.divide(m1, d, out=d)
                    d *= pace
                    v -= d

        # The first texts say how many lanes there is work for.
        texts = last_by_length(texts)
        first, size = [], 0
        for t in texts:
            first.append(t)
            size += len(t) + 1
            if size >= TRAIN_LANES * STEPS * 4:
                break
        lanes = max(1, min(TRAIN_LANES, size // (STEPS * 4)))
        texts = itertools.chain(first, texts)
        # The lanes' words, each lane's between two places of a pool.
        pool, top = np.empty(2 * size + lanes, np.int32), lanes
        pool[:lanes] = self.end
        start, stop, h = np.arange(lanes), np.arange(lanes) + 1, np.zeros((lanes, STATE), np.float32)
        while True:
            for j in np.flatnonzero(stop - start <= STEPS):
                # A lane begins with the word before its next one.
                while stop[j] - start[j] <= STEPS and (t := next(texts, None)) is not None:
                    more = stop[j] - start[j] + len(t) + 1
                    if top + more > len(pool):
                        old = [pool[a:b] for a, b in zip(start, stop, strict=True)]
                        stop = np.cumsum([len(o) for o in old])
                        start, top = np.append(0, stop[:-1]), int(stop[-1])
                        pool = np.empty(max(len(pool), 2 * (top + more)), np.int32)
                        pool[:top] = np.concatenate(old)
                    pool[top : top + more - len(t) - 1] = pool[start[j] : stop[j]]
                    pool[top + more - len(t) - 1 : top + more - 1] = t
                    pool[top + more - 1] = self.end
                    start[j], stop[j] = top, top + more
                    top += more
            # Where texts ran out, lanes close, and the rest take longer windows.
            running = stop - start > 1
            if not running.any():
                break
            start, stop, h = start[running], stop[running], h[running]
            steps = STEPS * min(16, lanes // len(start))
            ahead, left = np.arange(steps + 1), (stop - start)[:, None]
            window = np.where(ahead < left, pool[np.minimum(start[:, None] + ahead, top - 1)], self.end).astype(np.int64)
            on = ahead[1:] < left
            start = np.minimum(start + steps, stop - 1)
            x, y, on = (np.ascontiguousarray(a.T) for a in (window[:, :-1], window[:, 1:], on))
            _, g, h = self.gradients(x, y, on, h)
            met += np.bincount(x[on], minlength=self.size + 2)
            goals += np.bincount(self.klass[y[on]], minlength=self.n_classes)
            n = int(on.sum())
            if held or 2 * n < lanes * STEPS:
                # A few lanes' words alone would lead away: their gradients wait for more.
                held, waiting = {k: held.get(k, 0) + d * np.float32(n) for k, d in g.items()}, waiting + n
                if 2 * waiting < lanes * STEPS:
                    continue
                g = {k: d / np.float32(waiting) for k, d in held.items()}
                held, waiting = {}, 0
            update(g)
        if held:
            update({k: d / np.float32(lanes * STEPS) for k, d in held.items()})
        return self.change(begun, met, goals)

    def _weights(self, met: np.ndarray, goals: np.ndarray) -> dict:
        """How much a task's values count: those of a word by how often it was
        met, those of a word in its class by how often the class was the next."""
        inner = goals[self.klass[self.order]].astype(float)
        every = {k: np.array(float(goals.sum())) for k in self.w}
        return every | {"embed": met[:, None].astype(float), "ow": inner[:, None], "ob": inner}

    def change(self, start: dict, met: np.ndarray, goals: np.ndarray) -> np.ndarray:
        """What may be added up over tasks: changes of all values times their
        weights, then what the weights come from."""
        by = self._weights(met, goals)
        parts = [((self.w[k] - start[k]) * by[k]).reshape(-1) for k in sorted(self.w)]
        return np.concatenate([*parts, met, goals])

    def add(self, total: np.ndarray) -> None:
        """Take the mean of the tasks' changes."""
        at = len(total) - self.n_classes - self.size - 2
        met, goals = np.split(total[at:], [self.size + 2])
        by, at = self._weights(met, goals), 0
        for k in sorted(self.w):
            part = total[at : at + self.w[k].size].reshape(self.w[k].shape)
            self.w[k] = (self.w[k] + part / np.maximum(by[k], 1)).astype(np.float32)
            at += self.w[k].size

    def ready(self) -> None:
        """Tables for scoring."""
        self._steps()
        self.outer = np.concatenate([self.w["cw"], self.w["cb"][None]])
        inner = np.concatenate([self.w["ow"].T, self.w["ob"][None]])
        self.inner = [np.ascontiguousarray(inner[:, a:b]) for a, b in itertools.pairwise(self.edges)]
        self.safe = self._fits()

    @np.errstate(over="ignore")
    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        """Natural log probability of each text with its end. The texts run side
        by side in lanes of about the same length, one after another in each."""
        if not texts:
            return np.zeros(0)
        length = np.array([len(t) + 1 for t in texts])
        count = max(1, min(LANES, int(length.sum() // length.max())))
        # Longest first, each to the lane that is shortest so far.
        free, lanes = [(0, j) for j in range(count)], [[] for _ in range(count)]
        for i in np.argsort(-length, kind="stable").tolist():
            n, j = free[0]
            lanes[j].append(i)
            heapq.heapreplace(free, (n + int(length[i]), j))
        # The longest lane first, so those still running are always the first ones.
        size = np.array([n for n, _ in sorted(free, key=lambda f: f[1])])
        lanes, size = [lanes[j] for j in np.argsort(-size, kind="stable")], -np.sort(-size)
        words, found = np.full((size[0] + 1, count), self.end, np.int32), np.zeros((count, size[0]), np.float32)
        for j, own in enumerate(lanes):
            words[: size[j], j] = np.concatenate([part for i in own for part in ([self.end], texts[i])])
        h = np.zeros((STATE, count), np.float32)
        for t in range(0, int(size[0]), STEPS):
            steps = min(STEPS, int(size[0]) - t)
            x, goal = words[t : t + steps], words[t + 1 : t + steps + 1]
            running = (np.arange(t, t + steps)[:, None] < size).sum(axis=1)
            n = running[0]
            # A text starts from nothing where its first input is the end before it.
            first = x == self.end
            begins = first.any(axis=1).tolist()
            states = np.ones((steps, n, STATE + 1), np.float32)
            for s, k in enumerate(running.tolist()):
                h = np.ascontiguousarray(h[:, :k])
                if begins[s]:
                    h[:, np.flatnonzero(first[s, :k])] = 0
                h = self._step(self.into @ self.table.take(x[s, :k], axis=0).T, h)[0]
                states[s, :k, :STATE] = h.T
            at = np.flatnonzero(np.arange(n) < running[:, None])
            logp = np.zeros(steps * n, np.float32)
            logp[at] = self._log_p(states.reshape(-1, STATE + 1), at, goal[:, :n].reshape(-1)[at])
            found[:n, t : t + steps] = logp.reshape(steps, n).T
        # What lies behind a lane's last text is 0.
        starts = np.concatenate([j * size[0] + np.cumsum(np.append(0, length[own][:-1])) for j, own in enumerate(lanes)])
        out = np.empty(len(texts))
        out[np.concatenate(lanes)] = np.add.reduceat(found.reshape(-1), starts, dtype=float)
        return out


class Known:
    """What scoring needs: the model and the counts of the frequent words."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray, total: int, kinds: int, ends: int):
        order = np.argsort(-counts, kind="stable")
        self.tokens, self.counts = tokens[order], counts[order]
        self.total, self.kinds, self.ends = total, kinds, ends
        self.lookup = Lookup(self.tokens)
        self.head = min(HEAD, len(self.tokens))
        self.rest = total - ends - int(self.counts[: self.head].sum())
        self.rest_kinds = max(0, kinds - self.head - (ends > 0))
        self.model: Model | None = None

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.5) / (self.total + 0.5 * (self.kinds + 1)))

    def in_rest(self, c: np.ndarray) -> np.ndarray:
        """log10 probability of a word among the other words, by its count."""
        return np.log10((c + 0.5) / (self.rest + 0.5 * (self.rest_kinds + 1)))

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        at = self.lookup.find(hashes)
        return np.where((at >= 0) & (at < self.head), at, self.head)

    def learn(self, docs: DataFrame) -> None:
        """Classes and network, from all training documents."""
        texts = training_texts(docs)
        cores = docs.sparkSession.sparkContext.defaultParallelism
        words = Lookup(self.tokens[: self.head])
        size = self.head

        def in_round(low: int, high: int) -> DataFrame:
            # A task ends on its longest texts alone, so a small round has few tasks.
            parts = max(cores, self.total * (high - low) // DRAWS // TRAIN_WORDS)
            return texts.where((F.col("draw") >= low) & (F.col("draw") < high)).select("text").coalesce(parts)

        def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
            for batch in batches:
                for _, _, hashes, counts in sh._chunks(batch.column(0), sh.piece_hashes):
                    at = words.find(hashes)
                    yield from np.split(np.where(at >= 0, at, size), np.cumsum(counts)[:-1])

        wide = min(64, size) + 1
        met = summed(in_round(0, DRAWS), lambda batches: company(numbers(batches), size).reshape(-1), size * wide)
        klass = classes_of(met.reshape(size, wide))
        model = Model(self.counts[:size].astype(float), klass, self.rest, self.ends)
        length = sum(v.size for v in model.w.values()) + model.size + 2 + model.n_classes
        for low, high, rate in ROUNDS:
            sent = docs.sparkSession.sparkContext.broadcast(model)

            def work(batches: Iterator[pa.RecordBatch], sent=sent, rate=rate) -> np.ndarray:
                return copy.deepcopy(sent.value).train(numbers(batches), rate)

            model.add(summed(in_round(low, high), work, length))
            sent.unpersist()
        self.model = model
        self.model.ready()


def _known(counts: DataFrame) -> Known:
    """The frequent words: all with a count that at most FREQUENT words reach."""
    end = int(END.view(np.int64))
    total = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v"), F.sum(F.when(F.col("token") == end, F.col("n"))).alias("e"))
    total = total.first()
    # Words per order of size of their count: 64 rows for each doubling.
    size = F.floor(F.log2("n") * 64).alias("size")
    words = counts.where(F.col("token") != end)
    sizes = sorted(words.groupBy(size).agg(F.count("*").alias("k"), F.min("n").alias("n")).collect(), reverse=True)
    least, held = None, 0
    for r in sizes:
        held += r["k"]
        if held > FREQUENT:
            break
        least = r["n"]
    if least is None:
        table = pa.table({"token": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
    else:
        table = words.where(F.col("n") >= least).select("token", "n").toArrow()
    token, n = (table[c].to_numpy() for c in ("token", "n"))
    order = np.lexsort((token, -n))
    return Known(token[order].view(np.uint64), n[order], total["n"] or 0, total["v"], total["e"] or 0)


def training_texts(docs: DataFrame) -> DataFrame:
    """text and draw (0 to DRAWS - 1, by hash of the id) of every document that
    is not held out and has a text."""
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(DRAWS)).alias("draw")
    return docs.where(~held_out()).select(F.col("text").cast("string").alias("text"), draw).where("text is not null")


# Sums are of whole numbers of this part, so that their order does not matter.
_UNIT = 1 << 16


def summed(rows: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], np.ndarray], length: int) -> np.ndarray:
    """The sum over tasks of what ``work`` makes of a task's rows, ``length``
    numbers. Tasks send it in spans, each added up by one task on its way."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        out = work(itertools.chain([first], batches)).astype(np.float32)
        spans = range(0, len(out), SPAN)
        values = [out[i : i + SPAN].tobytes() for i in spans]
        yield pa.RecordBatch.from_arrays([pa.array(spans, pa.int64()), pa.array(values, pa.binary())], ["at", "v"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for batch in batches:
            for at, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                v = np.rint(np.frombuffer(v.as_buffer(), np.float32).astype(float) * _UNIT).astype(np.int64)
                sums[at] = sums[at] + v if at in sums else v
        if sums:
            values = [v.tobytes() for v in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(values, pa.binary())], ["at", "v"])

    schema = "at long, v binary"
    out = np.zeros(length, np.int64)
    for r in rows.mapInArrow(made, schema).repartition("at").mapInArrow(added, schema).collect():
        v = np.frombuffer(r["v"], np.int64)
        out[r["at"] : r["at"] + len(v)] += v
    return out / _UNIT


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score
    (both log10) of each row. A null or blank text is its end alone. With no
    training document nothing is known, and every word has the same small share.
    Equal rows get equal scores; other columns are not looked at."""
    spark = docs.sparkSession
    counts = cut(word_counts(docs))
    known = _known(counts)
    known.learn(docs)
    sent = spark.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        know = sent.value
        ends = know.base(np.array([know.ends]))[0]
        # By position of the word; the last one is for words that are not there.
        head = np.arange(len(know.counts)) < know.head
        base_of, rest_of = (np.append(v, 0.0) for v in (know.base(know.counts), np.where(head, 0.0, know.in_rest(know.counts))))
        number_of = np.append(np.where(head, np.arange(len(head)), know.head), know.head).astype(np.int32)
        for batch in batches:
            chunks = list(sh._chunks(batch.column(2), sh.piece_hashes))
            if not chunks:
                continue
            every, length = (np.concatenate([c[i] for c in chunks]) for i in (2, 3))
            n, edges = len(length), np.cumsum(length) - length
            owner = np.repeat(np.arange(n), length)
            at = know.lookup.find(every)
            hit = at >= 0
            base = np.bincount(owner, weights=base_of[at], minlength=n) + ends
            logp = np.bincount(owner, weights=rest_of[at], minlength=n)
            number = number_of[at]
            logp += know.model.score([number[e : e + k] for e, k in zip(edges, length, strict=True)]) * LOG10
            # Words that are not among the frequent ones, once per text.
            far = np.flatnonzero(~hit)
            far = far[np.lexsort((every[far], owner[far]))]
            token, who = every[far], owner[far]
            fresh = np.flatnonzero(np.append(True, (token[1:] != token[:-1]) | (who[1:] != who[:-1]))[: len(far)])
            tf = np.diff(np.append(fresh, len(far)))
            each = np.bincount(who[fresh], minlength=n)
            offsets = pa.array(np.concatenate([[0], np.cumsum(each)]).astype(np.int32))
            item = pa.StructArray.from_arrays(
                [pa.array(token[fresh].view(np.int64)), pa.array(tf.astype(np.int64))], ["token", "tf"]
            )
            words = (every[e : e + k] for e, k in zip(edges, length, strict=True))
            mark = np.array([int(sh.mix(w * np.arange(1, 2 * len(w), 2, dtype=np.uint64)).sum(dtype=np.uint64)) for w in words], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(mark.view(np.int64)),
                    pa.array(length + 1),
                    pa.array(np.bincount(owner[hit], minlength=n) + int(know.ends > 0)),
                    pa.array(base),
                    pa.array(logp),
                    pa.ListArray.from_arrays(offsets, item),
                ],
                ["doc_id", "held_out", "mark", "n_tokens", "n_known", "base_score", "score", "far"],
            )

    fields = (
        "doc_id long, held_out boolean, mark long, n_tokens long, n_known long, base_score double, score double,"
        " far array<struct<token: long, tf: long>>"
    )
    rows = docs.select(
        F.col("doc_id").cast("long"), held_out().alias("held_out"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    done = cut(rows.mapInArrow(run, fields))
    # Equal texts under one doc_id are looked up once.
    far = done.where(F.size("far") > 0).dropDuplicates(["doc_id", "mark"]).select("doc_id", "mark", F.inline("far"))
    far = far.join(counts, "token", "left").withColumn("c", F.coalesce("n", F.lit(0)))
    base = F.log10((F.col("c") + 0.5) / (known.total + 0.5 * (known.kinds + 1)))
    rest = F.log10((F.col("c") + 0.5) / (known.rest + 0.5 * (known.rest_kinds + 1)))
    far = far.groupBy(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).agg(
        F.sum(F.col("tf") * F.when(F.col("c") > 0, 1).otherwise(0)).alias("_known"),
        F.sum(F.col("tf") * base).alias("_base"),
        F.sum(F.col("tf") * rest).alias("_rest"),
    )
    met = done.join(far, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")), "left")

    def plus(c: str, more: str) -> Column:
        return (F.col(c) + F.coalesce(more, F.lit(0))).alias(c)

    return met.select(
        "doc_id",
        "held_out",
        "n_tokens",
        plus("n_known", "_known"),
        F.lit(known.total).cast("long").alias("train_tokens"),
        plus("base_score", "_base"),
        plus("score", "_rest"),
    )
