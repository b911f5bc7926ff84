from __future__ import annotations

import base64
import random

import numpy as np
import pytest

from blotter.llm import token_counts as C
from tests.llm import plain
from tests.llm.conftest import edge_rows


def _spans(words):
    ends = np.cumsum([len(w) for w in words]).astype(np.int64)
    return np.frombuffer(b"".join(words), np.uint8), ends - [len(w) for w in words], ends


@pytest.mark.parametrize("seed", range(40))
def test_lengths_are_those_of_greedy_cutting(seed):
    rng = random.Random(seed)
    piece = lambda n: bytes(rng.choices(b"abc", k=rng.randint(1, n)))
    pieces = {piece(6) for _ in range(rng.randint(1, 15))}
    words = [piece(15) for _ in range(80)]
    automaton = C.PieceAutomaton.build(list(pieces))
    for mark in (b"", b"a", b"zz"):
        got = automaton.lengths(*_spans(words), mark).tolist()
        assert got == [plain.greedy_pieces(pieces, mark + w, 6) for w in words]


def test_edge_rows(edge):
    pieces = {b" ", b"w1", b" w", b"same", b"li", b"ne", *(bytes([i]) for i in range(0, 256) if i != ord("q"))}
    out = C.count_tokens(edge, list(pieces))
    assert out.columns == [c for c in edge.columns if c != "n_words"] + ["n_words", "n_tokens"]
    want = []
    for d, t in edge_rows():
        words = plain.NON_SPACE.findall(t or "")
        want.append((d, len(words), sum(plain.greedy_pieces(pieces, b" " + w.encode(), 5) for w in words)))
    assert sorted(((r["doc_id"], r["n_words"], r["n_tokens"]) for r in out.collect()), key=repr) == sorted(want, key=repr)


def test_empty_table_and_empty_vocabulary(no_docs, edge):
    assert C.count_tokens(no_docs, [b"a"]).count() == 0
    assert all(r["n_words"] == r["n_tokens"] for r in C.count_tokens(edge, []).collect())


def test_vocabulary_file_and_bound(tmp_path, monkeypatch):
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(p) + b" %d\n" % i for i, p in enumerate([b"a", b" b", b"\xff"])))
    assert C.read_ranked_pieces(str(path)) == [b"a", b" b", b"\xff"]
    monkeypatch.setattr(C, "MAX_VOCABULARY_BYTES", 2)
    with pytest.raises(ValueError):
        C.PieceAutomaton.build([b"abc"])
