"""Token counts by a linear longest-match automaton.

Greedy word pieces of a word are the longest vocabulary piece at its start,
then the longest piece after that, and so on. The automaton is the trie of the
pieces with failure links: where no edge goes on, a link pops the pieces that are
certain by then and moves to the rest. Only the *number* of popped pieces is
stored, so a word's length in pieces is found in one pass without building them.

Words are runs of other than ASCII white space, each with ``mark`` put before
it (byte-level vocabularies write a word's leading space so). The automaton steps
through all distinct words of a run of texts at once, byte by byte.

A word that can't be cut into pieces is one unknown token. Null, empty and
wordless texts have no words and no tokens; rows are counted one by one, columns
named like a result are replaced.
"""

from __future__ import annotations

import base64
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .shared import arrow_map, received, send
from .text import NON_SPACE, chunks, span_hash, words

RESULTS = ("n_words", "n_tokens")
MAX_VOCABULARY_BYTES = 64 << 20


@dataclass
class PieceAutomaton:
    """Edges sorted by ``state * 256 + byte``; ``fail`` is -1 where nothing is left to try."""

    edge: np.ndarray
    target: np.ndarray
    fail: np.ndarray
    pops: np.ndarray
    rest: np.ndarray       # pieces left at the end of a word; -1 if it can't be cut

    def __post_init__(self):
        self.direct = np.full(256, -1, np.int64)  # the root's edges
        low = self.edge < 256
        self.direct[self.edge[low]] = self.target[low]

    @classmethod
    def build(cls, pieces: list[bytes]) -> PieceAutomaton:
        if sum(map(len, pieces)) > MAX_VOCABULARY_BYTES:
            raise ValueError("the vocabulary is larger than what may be sent to every task")
        children: list[dict[int, int]] = [{}]
        is_piece = [False]
        for piece in sorted({p for p in pieces if p}):
            at = 0
            for byte in piece:
                nxt = children[at].get(byte)
                if nxt is None:
                    nxt = children[at][byte] = len(children)
                    children.append({})
                    is_piece.append(False)
                at = nxt
            is_piece[at] = True
        n = len(children)
        fail, pops = [-1] * n, [0] * n
        order = [0]
        for at in order:  # breadth first: links of shorter strings come before longer ones
            for byte, child in children[at].items():
                order.append(child)
                if is_piece[child]:
                    fail[child], pops[child] = 0, 1
                    continue
                back, popped = fail[at], pops[at]
                while back >= 0 and byte not in children[back]:
                    popped += pops[back]
                    back = fail[back]
                if back >= 0:
                    fail[child], pops[child] = children[back][byte], popped
        rest = [0] * n
        for at in order[1:]:  # a link's target is shorter, so it comes earlier
            back = fail[at]
            rest[at] = -1 if back < 0 or rest[back] < 0 else pops[at] + rest[back]
        edges = sorted((at << 8 | byte, child) for at in range(n) for byte, child in children[at].items())
        edge, target = np.array(edges, np.int64).reshape(-1, 2).T
        return cls(edge.copy(), target.copy(), np.array(fail, np.int64), np.array(pops, np.int64),
                   np.array(rest, np.int64))

    def _goto(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        out = np.full(len(state), -1, np.int64)
        root = state == 0
        out[root] = self.direct[byte[root]]
        other = np.flatnonzero(~root)
        if len(other) and len(self.edge):
            key = state[other] << 8 | byte[other]
            at = np.minimum(np.searchsorted(self.edge, key), len(self.edge) - 1)
            out[other] = np.where(self.edge[at] == key, self.target[at], -1)
        return out

    def lengths(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, mark: bytes = b"") -> np.ndarray:
        """Pieces of each span, with ``mark`` before it; 1 for a span that can't be cut."""
        count = np.zeros(len(starts), np.int64)
        state = np.zeros(len(starts), np.int64)
        live = np.arange(len(starts))
        for step in range(len(mark)):
            live = self._advance(live, np.full(len(live), mark[step], np.int64), state, count)
        order = live[np.argsort(starts[live] - ends[live], kind="stable")]  # longest first
        size = (ends - starts)[order]
        step = 0
        while len(order):
            keep = int(np.searchsorted(-size, -step, "left"))
            order, size = order[:keep], size[:keep]
            if not keep:
                break
            byte = data[starts[order] + step].astype(np.int64)
            alive = self._advance(order, byte, state, count)
            if len(alive) < len(order):
                on = state[order] >= 0
                order, size = order[on], size[on]
            step += 1
        rest = np.where(state >= 0, self.rest[np.maximum(state, 0)], -1)
        return np.where(rest >= 0, count + rest, 1)

    def _advance(self, live: np.ndarray, byte: np.ndarray, state: np.ndarray, count: np.ndarray) -> np.ndarray:
        """One byte for every live span, through as many failure links as it takes."""
        todo, byte_left = live, byte
        while len(todo):
            nxt = self._goto(state[todo], byte_left)
            done = nxt >= 0
            state[todo[done]] = nxt[done]
            todo, byte_left = todo[~done], byte_left[~done]
            if len(todo):
                at = state[todo]
                count[todo] += self.pops[at]
                state[todo] = self.fail[at]
                on = state[todo] >= 0
                todo, byte_left = todo[on], byte_left[on]
        return live[state[live] >= 0]


def read_ranked_pieces(path: str) -> list[bytes]:
    """Pieces of a ranked byte-level vocabulary file: a base64 piece and its rank on each line."""
    with open(path, "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f if line.strip()]


def _count(sent, text_col: str, mark: bytes):
    def run(batches):
        automaton = received(sent)
        for batch in batches:
            n_words, n_tokens = [], []
            for _, _, data, offs in chunks(batch, text_col):
                s, e, first = words(data, offs, NON_SPACE)
                h = span_hash(data, s, e)
                _, at, same = np.unique(h, return_index=True, return_inverse=True)
                each = automaton.lengths(data, s[at], e[at], mark)[same]
                total = np.concatenate([[0], np.cumsum(each)])
                n_words.append(np.diff(first))
                n_tokens.append(np.diff(total[first]))
            out = [pa.array(np.concatenate(x) if x else [], pa.int64()) for x in (n_words, n_tokens)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *out], [*batch.schema.names, *RESULTS])

    return run


def count_tokens(docs: DataFrame, pieces: list[bytes], text_col: str = "text", mark: bytes = b" ") -> DataFrame:
    """``docs`` with ``n_words`` and ``n_tokens``; the vocabulary's size bound is checked before it is sent."""
    docs = docs.drop(*RESULTS)
    sent = send(docs.sparkSession, PieceAutomaton.build(pieces))
    schema = T.StructType(list(docs.schema.fields)).add("n_words", "long").add("n_tokens", "long")
    return arrow_map(docs, _count(sent, text_col, mark), schema)
