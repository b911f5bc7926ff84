from __future__ import annotations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from blotter.llm.text import ALNUM, LOWER, NON_SPACE, chunks, prefix_hashes, roll, span_hash, words
from tests.llm import plain

texts = st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from(list("aB z9\n\t.é日\x00\x7f\x0b-")), max_size=40)),
                 max_size=8)


def _words(batch, is_word, size):
    out = []
    for _, _, data, offs in chunks(batch, "text", size):
        data = LOWER[data]
        s, e, first = words(data, offs, is_word)
        raw = data.tobytes()
        found = [raw[a:b].decode() for a, b in zip(s, e)]
        out += [found[x:y] for x, y in zip(first[:-1], first[1:])]
    return out


@settings(max_examples=150, deadline=None)
@given(texts, st.sampled_from([1, 7, 1000]))
def test_words_follow_the_patterns(rows, size):
    batch = pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], ["text"])
    for pattern, table in ((plain.ALNUM, ALNUM), (plain.NON_SPACE, NON_SPACE)):
        assert _words(batch, table, size) == [pattern.findall(plain.lower(t)) for t in rows]


def test_equal_words_hash_alike_wherever_they_stand():
    raw = b"abc abcd abc " + b"y" * 400_000 + b" abc"
    data = np.frombuffer(raw, np.uint8)
    s, e, _ = words(data, np.array([0, len(raw)]), NON_SPACE)
    h = span_hash(data, s, e)
    assert h[0] == h[2] == h[4] and len(set(h.tolist())) == 3


def test_rolled_hashes_depend_on_order_and_length():
    h = np.arange(1, 9, dtype=np.uint64)
    assert len(set(roll(h, 3).tolist()) | set(roll(h[::-1].copy(), 3).tolist()) | set(roll(h, 2).tolist())) == 6 + 6 + 7
    assert len(roll(h[:2], 3)) == 0


def test_beginnings_hash_as_words_of_their_own():
    raw = b"abcdef abc ab abcd " * 30_000
    data = np.frombuffer(raw, np.uint8)
    s, e, _ = words(data, np.array([0, len(raw)]), NON_SPACE)
    whole, three, nine = prefix_hashes(data, s, e, (3, 9))
    assert (whole == span_hash(data, s, e)).all() and (nine == whole).all()
    abc, ab = whole[1], whole[2]
    assert (three.reshape(-1, 4) == np.array([abc, abc, ab, abc])).all()
