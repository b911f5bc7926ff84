"""Benchmark decontamination with one FM-index per shard of training texts.

A task cuts its texts into shards. The words of a shard become ids of the
phrases' vocabulary; any other word ends a run, and runs too short for the
shortest phrase are left out, as none can occur there. The shard's FM-index is
searched backwards for all phrases at once through wavelet-tree ranks, hits are
located by sampled suffix positions, and overlapping spans are merged.

A phrase is ``window`` consecutive words of an item, or a shorter item as a
whole. Phrases go to the tasks in blocks of about ``block_bytes`` of item text.
The shard's index is over the vocabulary of all blocks, so it is built once and
searched for block after block; a task holds one block at a time, whatever the
size of the benchmark (only the vocabulary is held whole).

Rows: a null text has no words; null, empty and wordless items have no phrases;
an item with a null id marks words but can't be listed. Repeated items count
once per id, repeated rows are handled one by one. Input columns named like a
result are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .fm_index import FMIndex
from .shared import arrow_map, parts_for, received, send, text_bytes
from .text import ALNUM, LOWER, chunks, hash_word_list, span_hash, words

WINDOW = 10
BLOCK_BYTES = 2 << 20       # item text behind the phrases that tasks get at once
SHARD_WORDS = 1_000_000     # words of texts indexed at once (one longer text is one shard)
RESULTS = ("n_words", "n_hit", "items", "spans")


def _find(vocab: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Word ids from 1; 0 for words outside the vocabulary."""
    if not len(vocab):
        return np.zeros(len(h), np.int64)
    at = np.minimum(np.searchsorted(vocab, h), len(vocab) - 1)
    return np.where(vocab[at] == h, at + 1, 0)


class Phrases:
    """Distinct phrases of a block by length, their vocabulary, and the items of each."""

    def __init__(self, items: list[tuple[int | None, bytes]], window: int):
        seen: dict[bytes, set] = {}
        for (item, _), h in zip(items, hash_word_list([t for _, t in items], ALNUM)):
            size = min(window, len(h))
            for a in range(len(h) - size + 1 if size else 0):
                seen.setdefault(h[a:a + size].tobytes(), set()).add(item)
        self.vocab = np.unique(np.frombuffer(b"".join(seen), np.uint64))
        self.shortest = min((len(p) // 8 for p in seen), default=0)
        self.ids = sorted({i for s in seen.values() for i in s if i is not None})
        place = {i: n for n, i in enumerate(self.ids)}
        self.groups = []
        for size in sorted({len(p) // 8 for p in seen}):
            mine = sorted(p for p in seen if len(p) == 8 * size)
            ids = _find(self.vocab, np.frombuffer(b"".join(mine), np.uint64)).reshape(-1, size)
            owners = [sorted(place[i] for i in seen[p] if i is not None) for p in mine]
            self.groups.append((ids, np.cumsum([0, *map(len, owners)]),
                                np.array([o for x in owners for o in x], np.int64)))

    def renumbered(self, vocab: np.ndarray):
        """The groups with word ids of a vocabulary that holds this one."""
        ids_there = _find(vocab, self.vocab)
        for ids, cuts, owners in self.groups:
            yield ids_there[ids - 1], cuts, owners


def _runs(sym: np.ndarray, first: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The runs of at least ``least`` phrase words within one text, each ended by 0, and their word numbers."""
    ends = np.zeros(len(sym) + 1, bool)
    ends[first[first <= len(sym)]] = True
    ends[-1] = True
    inside = sym > 0
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | ends[1:-1]
    starts = np.flatnonzero(begin)
    stop = inside.copy()
    stop[:-1] &= ~inside[1:] | ends[1:-1]
    stops = np.flatnonzero(stop) + 1
    keep = stops - starts >= least
    starts, lens = starts[keep], (stops - starts)[keep]
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends_at = np.cumsum(lens + 1)
    where = np.arange(ends_at[-1]) - np.repeat(ends_at - lens - 1 - starts, lens + 1)
    out = np.zeros(len(where), np.int64)
    live = np.ones(len(where), bool)
    live[ends_at - 1] = False
    out[live] = sym[where[live]]
    return out, where


def _search_shard(blocks, vocab: np.ndarray, shortest: int, sym: np.ndarray, first: np.ndarray):
    """Hit flags of the shard's words and sorted (text, item id) pairs; ``blocks`` gives the blocks one after another."""
    hit = np.zeros(len(sym) + 1, np.int64)
    found = [np.zeros((0, 2), np.int64)]
    run, where = _runs(sym, first, shortest)
    index = FMIndex(run) if len(run) else None
    for phrases in blocks if index else ():
        item_ids = np.array(phrases.ids, np.int64)
        for ids, cuts, owners in phrases.renumbered(vocab):
            lo, hi = index.search(ids)
            count = hi - lo
            which = np.repeat(np.arange(len(ids)), count)
            if not len(which):
                continue
            rows = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + lo[which]
            at = where[index.locate(rows)]
            np.add.at(hit, at, 1)
            np.add.at(hit, at + ids.shape[1], -1)
            text = np.searchsorted(first, at, "right") - 1
            n = cuts[which + 1] - cuts[which]
            own = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(cuts[which], n)
            found.append(np.unique(np.stack([np.repeat(text, n), item_ids[owners[own]]], 1), axis=0))
    return np.cumsum(hit[:-1]) > 0, np.unique(np.concatenate(found), axis=0)


def _block_reader(sent: list):
    """Makes iterators over the blocks. A single block stays in memory, of several only the one in use."""
    if len(sent) == 1:
        only = [received(sent[0])]
        return lambda: iter(only)
    return lambda: (received(block, keep=False) for block in sent)


def _scan(sent_vocab, sent_blocks: list, shortest: int, text_col: str):
    def shard_rows(blocks, vocab, parts):
        sym = np.concatenate([s for s, _ in parts])
        sizes = np.concatenate([n for _, n in parts])
        first = np.concatenate([[0], np.cumsum(sizes)])
        hit, pairs = _search_shard(blocks, vocab, shortest, sym, first)
        total = np.concatenate([[0], np.cumsum(hit)])
        edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
        edge_first = first[:-1][sizes > 0]
        inner = edge_first[(edge_first > 0) & (edge_first < len(hit))]
        cut = inner[hit[inner - 1] & hit[inner]] if len(hit) else inner  # spans end with their text
        starts = np.sort(np.concatenate([np.flatnonzero(edge == 1), cut]))
        stops = np.sort(np.concatenate([np.flatnonzero(edge == -1), cut]))
        of_span = np.searchsorted(starts, first)
        of_pair = np.searchsorted(pairs[:, 0], np.arange(len(sizes) + 1))
        for i, n in enumerate(sizes.tolist()):
            a, b = of_span[i], of_span[i + 1]
            yield (n, int(total[first[i + 1]] - total[first[i]]),
                   pairs[of_pair[i]:of_pair[i + 1], 1].tolist(),
                   [{"first": int(x), "end": int(y)} for x, y in zip(starts[a:b] - first[i], stops[a:b] - first[i])])

    def run(batches):
        vocab, reader = received(sent_vocab), _block_reader(sent_blocks)
        for batch in batches:
            rows, parts, size = [], [], 0
            for _, _, data, offs in chunks(batch, text_col):
                data = LOWER[data]
                s, e, first = words(data, offs, ALNUM)
                h = span_hash(data, s, e)
                parts.append((_find(vocab, h), np.diff(first)))
                size += len(h)
                if size >= SHARD_WORDS:
                    rows.extend(shard_rows(reader(), vocab, parts))
                    parts, size = [], 0
            if parts:
                rows.extend(shard_rows(reader(), vocab, parts))
            n, hit, items, spans = zip(*rows) if rows else ((), (), (), ())
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()),
                     pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(list(v), k) for v, k in zip((n, hit, items, spans), kinds))],
                [*batch.schema.names, *RESULTS])

    return run


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text",
                       block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit`` (words inside any phrase), ``items`` (sorted ids whose phrases occur) and
    ``spans`` (merged word ranges to remove, ends exclusive)."""
    docs = docs.drop(*RESULTS)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text"))
    blocks = parts_for(text_bytes(items), block_bytes)
    kinds = T.StructType.fromDDL(
        "n_words long, n_hit long, items array<long>, spans array<struct<first: long, end: long>>")
    vocab, shortest, sent = np.zeros(0, np.uint64), window, []
    for b in range(blocks):
        mine = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        phrases = Phrases([(r["item_id"], (r["text"] or "").encode()) for r in mine.collect()], window)
        if phrases.groups:
            vocab, shortest = np.union1d(vocab, phrases.vocab), min(shortest, phrases.shortest)
            sent.append(send(docs.sparkSession, phrases))
    schema = T.StructType(docs.schema.fields + kinds.fields)
    return arrow_map(docs, _scan(send(docs.sparkSession, vocab), sent, shortest, text_col), schema)
