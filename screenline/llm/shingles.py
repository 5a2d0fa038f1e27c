"""Words and word shingles of whole texts as 64-bit hashes, a column batch at a time.

Words are the runs of bytes other than space and 0x09-0x0D, after A-Z are
lower-cased. A shingle is ``k`` consecutive words; a text with one to k-1 words
has its whole word sequence as its only shingle; a null or blank text has none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
MASK = (1 << 64) - 1
# Bytes hashed at a time, so that the work arrays stay in the processor's cache.
CHUNK = 1 << 18

_STEP = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_STEP, -1, 1 << 64)
_rng = np.random.default_rng(20_240_501)
_BYTES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTES[65:91] = _BYTES[97:123]  # A-Z hash as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# Masks of the first 0 to 8 bytes of a piece.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_PLACES = [U(int(x) | 1) for x in _rng.integers(1, 1 << 63, 64, dtype=np.uint64)]
_powers = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finalizer of a common hash)."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


def _power_table(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, CHUNK * 2), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return have


def word_places(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and stops of all words of several texts lying end to end in ``data``
    (``ends``: where each text ends) and the number of words of each text."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    np.greater(data - np.uint8(9), 4, out=inside[1:-1])
    inside[1:-1] &= data != 32
    # A word also ends where its text ends.
    change = np.flatnonzero(inside[1:] != inside[:-1])
    starts, stops = change[::2], change[1::2]
    breaks = ends[(ends > 0) & (ends < n)]
    breaks = np.unique(breaks[inside[breaks] & inside[breaks + 1]])
    if len(breaks):
        starts, stops = (np.insert(x, np.searchsorted(x, breaks), breaks) for x in (starts, stops))
    return starts, stops, np.diff(np.searchsorted(starts, ends, side="left"), prepend=0)


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of several texts lying end to end in ``data``
    (``ends``: where each text ends) and the number of words of each text."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(ends), np.int64)
    starts, stops, counts = word_places(data, ends)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[data] * _power_table(_STEP, n)[:n], out=sums[1:])
    hashes = (sums[stops] - sums[starts]) * _power_table(_INVERSE, n)[starts]
    return mix(hashes), counts


# Words of more bytes are hashed byte by byte.
_PIECED = 32


def piece_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Like ``word_hashes``, with other values, by pieces of eight bytes: quicker
    where words alone are hashed."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(ends), np.int64)
    starts, stops, counts = word_places(data, ends)
    low = np.zeros((n // 8 + 2) * 8, np.uint8)
    np.less(data - np.uint8(65), 26, out=low[:n].view(bool))
    low[:n] <<= 5
    low[:n] |= data
    eights, length = low.view("<u8"), stops - starts
    hashes, todo, at, left = length.astype(np.uint64) * U(_STEP), None, starts, length
    while len(at):
        # Eight bytes from any place lie in two words of memory.
        place, shift = at >> 3, (at.astype(np.uint64) & U(7)) << U(3)
        piece = eights.take(place) >> shift
        piece |= (eights.take(place + 1) << U(1)) << (U(63) - shift)
        piece &= _FIRST.take(np.minimum(left, 8))
        if todo is None:
            hashes = mix(hashes ^ piece)
            todo = np.flatnonzero((length > 8) & (length <= _PIECED))
        else:
            hashes[todo] = mix(hashes[todo] * U(_STEP) ^ piece)
            todo = todo[left > 8]
        done = 8 if at is starts else done + 8
        at, left = starts[todo] + done, length[todo] - done
    long = np.flatnonzero(length > _PIECED)
    if len(long):
        words = [data[a:b] for a, b in zip(starts[long].tolist(), stops[long].tolist(), strict=True)]
        hashes[long] = word_hashes(np.concatenate(words), np.cumsum(length[long]))[0]
    return hashes, counts


def _summed(words: np.ndarray, width: int) -> np.ndarray:
    out = words[: len(words) - width + 1] * _PLACES[0]
    for j in range(1, width):
        out += words[j : len(words) - width + 1 + j] * _PLACES[j]
    return mix(out + U(width))


def runs_of(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words."""
    return _summed(words, k)


def shingles_in_order(words: np.ndarray, k: int = 5) -> np.ndarray:
    """Shingle hashes of one text in order of place, repeats kept."""
    return _summed(words, min(k, len(words))) if len(words) else np.zeros(0, np.uint64)


def distinct(hashes: np.ndarray) -> np.ndarray:
    """Sorted distinct numbers."""
    if len(hashes) < 2:
        return hashes
    hashes = np.sort(hashes)
    fresh = np.empty(len(hashes), bool)
    fresh[0] = True
    np.not_equal(hashes[1:], hashes[:-1], out=fresh[1:])
    return hashes[fresh]


def shingles(words: np.ndarray, k: int = 5) -> np.ndarray:
    """Distinct shingle hashes of one text, sorted."""
    return distinct(shingles_in_order(words, k))


def texts_as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a string column, the start and the end of each text (null: empty)."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    starts, ends = offsets[:-1], offsets[1:]
    return data, starts, ends


def words_of(column: pa.Array) -> Iterator[np.ndarray]:
    """The word hashes of each text of a string column, in order."""
    for _, _, hashes, counts in _chunks(column):
        place = 0
        for c in counts:
            yield hashes[place : place + c]
            place += c


def _chunks(column: pa.Array, hashed: Callable = word_hashes):
    if not len(column):
        return
    data, starts, ends = texts_as_bytes(column)
    at, n = 0, len(ends)
    while at < n:
        upto = max(at + 1, int(np.searchsorted(ends, starts[at] + CHUNK, side="right")))
        low, high = int(starts[at]), int(ends[upto - 1])
        yield at, upto, *hashed(data[low:high], ends[at:upto] - low)
        at = upto


def shingles_of(column: pa.Array, k: int = 5) -> Iterator[np.ndarray]:
    """The shingle hashes of each text in order of place, repeats kept; hashed
    over many texts at a time."""
    for _, _, hashes, counts in _chunks(column):
        over = _summed(hashes, k) if len(hashes) >= k else None
        place = 0
        for c in counts:
            if c >= k:
                yield over[place : place + c - k + 1]
            else:
                yield shingles_in_order(hashes[place : place + c], k)
            place += c


def sets_of(column: pa.Array, k: int = 5) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, sorted."""
    return map(distinct, shingles_of(column, k))
