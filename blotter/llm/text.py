"""Words of whole Arrow text columns, found and hashed with numpy.

All functions work on UTF-8 bytes: the ASCII rules the operators use
(lower-casing A-Z, ASCII separators) never split a multi-byte character.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20      # bytes of text handled at once
BLOCK = 1 << 17      # bytes hashed at once: the powers stay in cache

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_space = np.zeros(256, bool)
_space[[32, 9, 10, 11, 12, 13]] = True
NON_SPACE = ~_space
#: ASCII digits, lower-case letters and every non-ASCII character.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer, elementwise."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _GOLDEN)
_BASE = 0xD6E8FEB86659FD93
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > len(_POWERS.get("up", ())):
        size = max(n, BLOCK + 1)
        one = np.ones(1, np.uint64)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            _POWERS[name] = np.concatenate([one, np.cumprod(np.full(size, base, np.uint64))])
    return _POWERS["up"], _POWERS["down"]


def chunks(batch: pa.RecordBatch, column: str, max_bytes: int = CHUNK) -> Iterator[tuple]:
    """(first row, end row, bytes, offsets) of runs of rows; a null text is empty."""
    arr = pc.fill_null(batch.column(column), "").cast(pa.large_string())
    if not len(arr):
        return
    offs = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
    buf = arr.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(arr):
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + max_bytes, "right")) - 1)
        hi = min(hi, len(arr))
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def words(data: np.ndarray, offs: np.ndarray, is_word: np.ndarray) -> tuple:
    """Starts and ends of the words, and per text the index of its first word."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offs), np.int64)
    inside = is_word[data]
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    before[offs[:-1][offs[:-1] < n]] = False
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    last = offs[1:] - 1
    after[last[last >= 0]] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes (spans in order of start and end)."""
    return prefix_hashes(data, starts, ends, ())[0]


def prefix_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, sizes: Sequence[int]) -> list[np.ndarray]:
    """``span_hash`` of each span, then of its first ``k`` bytes for each ``k`` of ``sizes`` (or all, if it has fewer)."""
    stops = [ends, *(np.minimum(ends, starts + k) for k in sizes)]
    out = [np.empty(len(starts), np.uint64) for _ in stops]
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + BLOCK, "right")))
        at = starts[a]
        seg = data[at:ends[b - 1]]
        up, down = _powers(len(seg) + 1)
        h = np.zeros(len(seg) + 1, np.uint64)
        np.cumsum(_BYTE[seg] * up[:len(seg)], out=h[1:])
        s = starts[a:b] - at
        first, shift = h[s], down[s]
        for found, stop in zip(out, stops):
            found[a:b] = (h[stop[a:b] - at] - first) * shift
        a = b
    return [mix64(found ^ ((stop - starts).astype(np.uint64) * _GOLDEN)) for found, stop in zip(out, stops)]


def roll(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k consecutive word hashes (across text borders too)."""
    n = max(0, len(h) - k + 1)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out += h[j:j + n] * np.uint64(pow(0xA24BAED4963EE407, j + 1, 1 << 64))
    return mix64(out ^ np.uint64(k))


def hash_word_list(texts: list[bytes], is_word: np.ndarray) -> list[np.ndarray]:
    """Word hashes of each text, lower-cased first."""
    if not texts:
        return []
    offs = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    data = LOWER[np.frombuffer(b"".join(texts), np.uint8)]
    s, e, first = words(data, offs, is_word)
    h = span_hash(data, s, e)
    return [h[first[i]:first[i + 1]] for i in range(len(texts))]


def nullable_ids(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """Integer ids (0 where null) and whether each is present."""
    col = batch.column(column).cast(pa.int64())
    return pc.fill_null(col, 0).to_numpy(zero_copy_only=False), col.is_valid().to_numpy(zero_copy_only=False)
