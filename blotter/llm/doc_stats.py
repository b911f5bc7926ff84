"""Numeric statistics of whole texts, one vector per row, from their bytes and words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .text import LOWER, NON_SPACE, chunks, roll, span_hash, words

_CLASSES = ("lower", "upper", "digit", "space", "newline", "blank", "continuation", "lead", "stop", "comma",
            "bang", "bar", "symbol", "punct", "control")
_CLASS = np.full(256, _CLASSES.index("punct"), np.uint8)
for _name, _bytes in (
        ("control", [*range(32), 127]), ("lower", range(97, 123)), ("upper", range(65, 91)), ("digit", range(48, 58)),
        ("space", [32]), ("newline", [10]), ("blank", [9, 11, 12, 13]), ("continuation", range(128, 192)),
        ("lead", range(192, 256)), ("stop", b".;:"), ("comma", b",'-"), ("bang", b"!?"), ("bar", b"|"),
        ("symbol", b"#$%&*+<=>@^_~")):
    _CLASS[list(_bytes)] = _CLASSES.index(_name)
_PIECE = 4 << 20

NAMES = [f"share_{c}" for c in _CLASSES] + [
    "log_chars", "log_words", "word_chars", "long_words", "distinct_words", "top_word", "repeated_next",
    "longest_run", "distinct_pairs", "distinct_triples", "upper_words", "symbol_ended", "bang_ended", "bar_words",
    "digit_words", "log_lines", "line_chars", "distinct_lines", "most_repeated_line"]


def _by_class(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    n, width = len(offs) - 1, len(_CLASSES)
    out = np.zeros(n * width)
    for at in range(0, len(data), _PIECE):
        seg = data[at:at + _PIECE]
        who = np.searchsorted(offs, np.array([at, at + len(seg) - 1]), "right") - 1
        lens = np.diff(np.clip(offs[who[0]:who[1] + 2], at, at + len(seg)))
        code = np.repeat(np.arange(who[0], who[1] + 1, dtype=np.int32) * width, lens) + _CLASS[seg]
        out += np.bincount(code, minlength=n * width)
    return out.reshape(n, width)


def _most(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Per text the largest of its values, which stand together; 0 for a text without any."""
    out = np.zeros(n)
    if len(values):
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        out[doc[first]] = np.maximum.reduceat(values, first)
    return out


def _distinct(h: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text: how many distinct hashes, and the count of the most frequent one."""
    bits = np.uint64(max(16, n.bit_length()))
    key = np.sort((doc.astype(np.uint64) << (np.uint64(64) - bits)) | (h >> bits))  # by text, then by hash
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[:len(key)])
    owner = (key[first] >> (np.uint64(64) - bits)).astype(np.int64)
    return np.bincount(owner, minlength=n), _most(np.diff(first, append=len(key)), owner, n)


def _longest_run(same: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Per text the longest run of True (``same[i]``: item i equals item i - 1)."""
    idx = np.arange(len(same))
    since = idx - np.maximum.accumulate(np.where(same, -1, idx)) if len(same) else idx
    return _most(since, doc, n)


def _stats(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    n = len(offs) - 1
    by = _by_class(data, offs)
    size = np.maximum(1, np.diff(offs)).astype(float)
    chars = np.diff(offs) - by[:, _CLASSES.index("continuation")]
    starts, ends, first = words(data, offs, NON_SPACE)
    h = span_hash(LOWER[data], starts, ends)
    count = np.diff(first)
    doc = np.repeat(np.arange(n), count)
    per_word = 1 / np.maximum(1, count)
    mean = lambda flags: np.bincount(doc, weights=flags, minlength=n) * per_word
    last, head = _CLASS[data[ends - 1]] if len(ends) else doc, _CLASS[data[starts]] if len(starts) else doc
    is_upper = np.concatenate([[0], np.cumsum((_CLASS[data] == _CLASSES.index("upper")).astype(np.int32))])
    is_lower = np.concatenate([[0], np.cumsum((_CLASS[data] == _CLASSES.index("lower")).astype(np.int32))])
    upper = is_upper[ends] - is_upper[starts]
    lower = is_lower[ends] - is_lower[starts]
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    distinct, top = _distinct(h, doc, n)
    pairs = []
    for k in (2, 3):
        g = roll(h, k)
        inside = doc[:len(g)] == doc[k - 1:] if len(g) else np.zeros(0, bool)
        found, _ = _distinct(g[inside], doc[:len(g)][inside], n)
        pairs.append(found / np.maximum(1, count - k + 1))
    ls, le, lfirst = words(data, offs, _NOT_NEWLINE)
    ldoc = np.repeat(np.arange(n), np.diff(lfirst))
    lines = np.diff(lfirst)
    ldistinct, ltop = _distinct(span_hash(data, ls, le), ldoc, n)
    cols = [by[:, i] / size for i in range(len(_CLASSES))] + [
        np.log1p(chars), np.log1p(count), chars * per_word, mean(ends - starts > 20), distinct * per_word,
        top * per_word, mean(same), _longest_run(same, doc, n), *pairs, mean((upper > 1) & (lower == 0)),
        mean(last == _CLASSES.index("symbol")), mean(last == _CLASSES.index("bang")),
        mean((last == _CLASSES.index("bar")) & (head == _CLASSES.index("bar"))), mean(head == _CLASSES.index("digit")),
        np.log1p(lines), chars / np.maximum(1, lines), ldistinct / np.maximum(1, lines), np.log1p(ltop)]
    return np.stack(cols, 1).astype(np.float32)


_NOT_NEWLINE = np.ones(256, bool)
_NOT_NEWLINE[10] = False


def document_stats(batch: pa.RecordBatch, text_col: str) -> np.ndarray:
    """One row of ``NAMES`` for each row of the batch; a null text counts as empty."""
    parts = [_stats(data, offs) for _, _, data, offs in chunks(batch, text_col)]
    return np.concatenate(parts) if parts else np.zeros((0, len(NAMES)), np.float32)
