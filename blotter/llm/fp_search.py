"""Ranked lexical search of all documents for stated items, over document FP-trees.

An item is a set of terms. A document scores, for each of the item's terms,
``w * ((10^9 tf) div (1000 tf + 8 m))`` in whole numbers: ``tf`` is the term's
count in it, ``w`` falls with the documents that hold the term, ``m`` grows with
the document's length against the mean (see ``weight`` and ``length_norm``).

1. One pass over the texts keeps each document's vector restricted to the items'
   terms, its number of terms, and writes them as a table. Document frequencies
   and lengths are counted from it.
2. Each task packs its vectors into shards of ``SHARD`` documents. Terms of a
   vector stand in order of document frequency, rarest first, so that documents
   with a common beginning share a path of the shard's trie: copies share all of
   it, and a subtree holds no term rarer than its path's. Paths without a branch
   are one node. A node has the tf maxima of its path's own terms, the largest tf
   below it, the smallest m, and its documents.
3. Each item is searched depth first: a node's bound is what its path can give plus
   the weights of all later terms at the largest tf and smallest m below. Children
   are taken best bound first, a run at a time; subtrees whose bound is under the
   item's k-th best score are cut, leaves are scored exactly. The k best carry over
   from shard to shard of a task, and the tasks' lists are merged.

The result is exact (words are known by 64-bit hashes). Items beyond ``ITEM_TERMS``
(item, term) pairs are dealt into blocks by id; each block is a pass of its own over
the texts with its own tables, so what a task is sent is bounded (by one item's
terms, if those are more).

Rows: null, empty and wordless texts have no terms, count neither in N nor L, and
are never found. Every row is a document of its own, rows of one id too; equal
scores go by id, then by row. Rows without an id are counted but aren't found. Rows of
one item id are one item with the terms of all; rows without an item id take no
part. Extra columns aren't read. Without documents or items the result is empty.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import arrow_map, parts_for, received, send, shared_table
from .text import ALNUM, LOWER, chunks, nullable_ids, span_hash, words

K = 10
SHARD = 16_384            # documents of a tree
SHARD_TERMS = 4_000_000   # restricted terms of a tree, unless one document has more
ITEM_TERMS = 1 << 18      # (item, term) pairs searched in one pass
RUN = 512                 # nodes expanded at once

_VECTOR = "doc_id long, n long, terms binary, tfs binary"
_NAMES = ["doc_id", "n", "terms", "tfs"]


def weight(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * df + 1))).astype(np.int64)


def length_norm(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    return 10 + (90 * n * n_docs) // n_terms


def part_score(w, tf, m):
    return w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


# ---------------------------------------------------------------- texts to vectors

def _item_terms(batches):
    """(item_id, term) of all words."""
    for batch in batches:
        ids = batch.column("item_id").to_numpy(zero_copy_only=False)
        for lo, hi, data, offs in chunks(batch, "text"):
            data = LOWER[data]
            s, e, first = words(data, offs, ALNUM)
            owner = np.repeat(ids[lo:hi], np.diff(first))
            yield pa.RecordBatch.from_arrays([pa.array(owner), pa.array(span_hash(data, s, e).view(np.int64))],
                                             ["item_id", "term"])


def _vectors(sent):
    """Vectors over the items' terms: places in the sorted ``vocabulary``, with counts."""

    def run(batches):
        vocabulary = received(sent)
        width = len(vocabulary) + 1
        for batch in batches:
            ids, known = nullable_ids(batch, "doc_id")
            for lo, hi, data, offs in chunks(batch, "text"):
                data = LOWER[data]
                s, e, first = words(data, offs, ALNUM)
                h = span_hash(data, s, e)
                at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
                mine = vocabulary[at] == h
                owner = np.repeat(np.arange(hi - lo), np.diff(first))
                pair, tf = np.unique(owner[mine] * width + at[mine], return_counts=True)
                cut = np.searchsorted(pair, np.arange(hi - lo + 1) * width)
                term, tf = (pair % width).astype(np.int32), tf.astype(np.int32)
                cells = [[x[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])] for x in (term, tf)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[lo:hi], mask=~known[lo:hi]), pa.array(np.diff(first).astype(np.int64)),
                     *(pa.array(c, pa.binary()) for c in cells)], _NAMES)

    return run


def _frequencies(size: int):
    """A task's document frequencies of the terms that it holds."""

    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            terms = np.frombuffer(b"".join(batch.column("terms").to_pylist()), np.int32)
            total += np.bincount(terms, minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["term", "df"])

    return run


# ---------------------------------------------------------------- the tree of a shard

class Tree:
    """Compressed trie of one shard: branches in postorder (the root last), then a leaf for each document.

    A document's vector is a row of ``terms`` (ranks, rarest first) and ``tfs`` between ``first`` and the
    next; documents are in lexicographic order of their vectors, so a node is a range ``lo`` to ``hi`` of them.
    A branch's own terms are those of its path below its parent's; a leaf leaves its own to the vector.
    """

    def __init__(self, ids: np.ndarray, m: np.ndarray, cut: np.ndarray, terms: np.ndarray, tfs: np.ndarray):
        size = np.diff(cut)
        paths = [terms[a:b].astype(">i4").tobytes() for a, b in zip(cut[:-1], cut[1:])]
        order = np.array(sorted(range(len(ids)), key=paths.__getitem__), np.int64)
        self.ids, self.m, size = ids[order], m[order], size[order]
        self.first = np.concatenate([[0], np.cumsum(size)])
        src = np.repeat(cut[:-1][order] - self.first[:-1], size) + np.arange(self.first[-1])
        self.terms, self.tfs = terms[src], tfs[src].astype(np.int64)
        shared = self._shared(size)
        near = np.maximum(shared, np.append(shared[1:], 0))  # a leaf hangs on the deepest branch around it
        lo, hi, depth, above = np.array(_branches(shared.tolist()), np.int64).T
        self.branches, docs = len(lo), np.arange(len(ids))
        self.lo, self.hi = np.concatenate([lo, docs]), np.concatenate([hi, docs + 1])
        parent = self._parents(np.concatenate([depth, size]))
        self.kids = np.argsort(parent, kind="stable")
        self.child = np.searchsorted(parent[self.kids], np.arange(self.branches + 1))
        self._summaries(depth, above, near, parent)

    def _shared(self, size: np.ndarray) -> np.ndarray:
        """How many leading terms each document shares with the one before."""
        out = np.zeros(len(size), np.int64)
        live, depth = np.arange(1, len(size)), 0
        while len(live):
            live = live[(size[live] > depth) & (size[live - 1] > depth)]
            live = live[self.terms[self.first[live] + depth] == self.terms[self.first[live - 1] + depth]]
            depth += 1
            out[live] = depth
        return out

    def _parents(self, depth: np.ndarray) -> np.ndarray:
        """The narrowest other range around each node's (the root's parent is -1)."""
        parent, open_ = np.full(len(depth), -1), []
        leaf = np.arange(len(depth)) >= self.branches
        lows, highs = self.lo.tolist(), self.hi.tolist()
        for i in np.lexsort((leaf, depth, -self.hi, self.lo)).tolist():
            while open_ and highs[open_[-1]] <= lows[i]:
                open_.pop()
            parent[i] = open_[-1] if open_ else -1
            if i < self.branches:
                open_.append(i)
        return parent

    def _summaries(self, depth: np.ndarray, above: np.ndarray, near: np.ndarray, parent: np.ndarray) -> None:
        """m minima, own terms with tf maxima, and of what lies below the path: the first term and the largest tf."""
        n, many, size = len(self.ids), self.branches, np.diff(self.first)
        self.least_m = _least(self.m, self.lo, self.hi)
        own = depth - above
        self.own = np.concatenate([[0], np.cumsum(own)])
        node = np.repeat(np.arange(many), own)
        level = np.arange(self.own[-1]) - self.own[node] + above[node]
        self.own_term = self.terms[self.first[self.lo[node]] + level]
        # a place of a vector belongs to one branch at most, so all of them together are no more than the vectors
        wide = (self.hi - self.lo)[node]
        slot = np.repeat(np.arange(len(node)), wide)
        doc = self.lo[node][slot] + np.arange(len(slot)) - (np.cumsum(wide) - wide)[slot]
        self.own_tf = np.zeros(len(node), np.int64)
        if len(node):
            self.own_tf = np.maximum.reduceat(self.tfs[self.first[doc] + level[slot]], np.cumsum(wide) - wide)
        # the largest tf from a place of a vector to its end
        mark = np.repeat(np.arange(n)[::-1], size) << 32
        to_end = np.append(np.maximum.accumulate((mark + self.tfs)[::-1])[::-1] - mark, 0)
        at = self.first[:-1] + near
        tail = np.where(near < size, to_end[at], 0)
        self.later = np.concatenate([
            np.where(depth > 0, self.terms[np.maximum(self.first[self.lo[:many]] + depth - 1, 0)], -1) + 1,
            np.where(near < size, self.terms[np.minimum(at, len(self.terms) - 1)], np.iinfo(np.int32).max)])
        below = np.zeros(many + 1, np.int64)
        np.maximum.at(below, parent[many:], tail)
        top = np.zeros(many, np.int64)
        if len(node):
            with_own = np.flatnonzero(own)
            top[with_own] = np.maximum.reduceat(self.own_tf, self.own[:-1][with_own])
        most, ups, tops = below.tolist(), parent[:many].tolist(), top.tolist()
        for i, up in enumerate(ups):  # children come before their parents
            most[up] = max(most[up], most[i], tops[i])
        self.below = np.concatenate([np.array(most[:many], np.int64), tail])

    def search(self, item: np.ndarray, w: np.ndarray, k: int, best: list) -> None:
        """Put the shard's documents into ``best``, a heap of (score, -id) of at most ``k``.

        ``item`` and ``w`` are the item's terms (ranks, ascending) and weights.
        """
        dense = np.zeros(int(item[-1]) + 2, np.int64)
        dense[item] = w
        rest = np.concatenate([np.cumsum(w[::-1])[::-1], [0]])

        def later(nodes):
            return part_score(rest[np.searchsorted(item, self.later[nodes])], self.below[nodes], self.least_m[nodes])

        def least():
            return best[0][0] if len(best) == k else 1

        root = np.array([self.branches - 1])
        stack = [(root, np.zeros(1, np.int64), later(root))]
        while stack:
            nodes, path, bound = stack.pop()
            live = bound >= least()
            nodes, path = nodes[live], path[live]
            if not len(nodes):
                continue
            count = self.child[nodes + 1] - self.child[nodes]
            path = np.repeat(path, count)
            kids = self.kids[np.repeat(self.child[nodes] - (np.cumsum(count) - count), count) + np.arange(len(path))]
            leaves = kids >= self.branches
            docs = kids[leaves]
            bound = path[leaves] + later(docs)
            for run in _runs(bound, least()):
                self._score(docs[run[bound[run] >= least()]] - self.branches, dense, k, best)
            kids, path = kids[~leaves], path[~leaves]
            if len(kids):
                path = path + self._own_part(kids, dense)
                bound = path + later(kids)
                stack += [(kids[run], path[run], bound[run]) for run in reversed(list(_runs(bound, least())))]

    def _own_part(self, nodes: np.ndarray, dense: np.ndarray) -> np.ndarray:
        count = self.own[nodes + 1] - self.own[nodes]
        at = np.repeat(self.own[nodes] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        owner = np.repeat(np.arange(len(nodes)), count)
        w = _of(dense, self.own_term[at])
        hit = np.flatnonzero(w)
        out = np.zeros(len(nodes), np.int64)
        np.add.at(out, owner[hit], part_score(w[hit], self.own_tf[at[hit]], self.least_m[nodes[owner[hit]]]))
        return out

    def _score(self, docs: np.ndarray, dense: np.ndarray, k: int, best: list) -> None:
        """Exact scores of documents; the good ones enter ``best``."""
        count = self.first[docs + 1] - self.first[docs]
        at = np.repeat(self.first[docs] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        w = _of(dense, self.terms[at])
        hit = np.flatnonzero(w)
        owner = np.repeat(np.arange(len(docs)), count)[hit]
        score = np.zeros(len(docs), np.int64)
        np.add.at(score, owner, part_score(w[hit], self.tfs[at[hit]], self.m[docs[owner]]))
        floor = best[0][0] if len(best) == k else 1
        good = np.flatnonzero(score >= floor)
        if len(good) > k:
            good = good[np.lexsort((self.ids[docs[good]], -score[good]))[:k]]
        for s, j in zip(score[good].tolist(), self.ids[docs[good]].tolist()):
            if len(best) < k:
                heapq.heappush(best, (s, -j))
            elif (s, -j) > best[0]:
                heapq.heapreplace(best, (s, -j))


def _of(dense: np.ndarray, terms: np.ndarray) -> np.ndarray:
    return dense[np.minimum(terms, len(dense) - 1)]


def _runs(bound: np.ndarray, least: int):
    """Places of bounds that reach ``least``, in runs, best first."""
    live = np.flatnonzero(bound >= least)
    live = live[np.argsort(-bound[live], kind="stable")]
    return (live[a:a + RUN] for a in range(0, len(live), RUN))


def _branches(shared: list[int]) -> list[tuple[int, int, int, int]]:
    """(lo, hi, depth, parent's depth) of the ranges of documents that share more than with a neighbour outside.

    In postorder; the last one is the root (all documents, depth 0).
    """
    out, stack = [], [(0, 0)]  # (lo, depth) of the open ones
    for i, depth in enumerate(shared[1:] + [0], 1):
        lo = i - 1
        while stack[-1][1] > depth:
            lo, done = stack.pop()
            out.append((lo, i, done, max(stack[-1][1], depth)))
        if stack[-1][1] < depth:
            stack.append((lo, depth))
    return [*out, (0, len(shared), 0, 0)]


def _least(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The least of values[lo:hi] of each (non-empty) range, by a table of doubling ranges."""
    table = [values]
    while 2 << (len(table) - 1) <= len(values):
        step = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-step], table[-1][step:]))
    out = np.empty(len(lo), values.dtype)
    power = np.frexp((hi - lo).astype(np.float64))[1] - 1
    for p in np.unique(power).tolist():
        at = np.flatnonzero(power == p)
        out[at] = np.minimum(table[p][lo[at]], table[p][hi[at] - (1 << p)])
    return out


# ---------------------------------------------------------------- searching all shards

def _search(sent, n_docs: int, n_terms: int, k: int):
    def run(batches):
        ids, rank, starts, terms, weights = received(sent)
        heaps: list[list] = [[] for _ in ids]
        held, docs, size = [], 0, 0

        def shard():
            doc_ids, n, term_cells, tf_cells = (np.concatenate(x) if i < 2 else [c for y in x for c in y]
                                                for i, x in enumerate(zip(*held)))
            size = np.array([len(c) // 4 for c in term_cells], np.int64)
            cut = np.concatenate([[0], np.cumsum(size)])
            term = rank[np.frombuffer(b"".join(term_cells), np.int32)]
            tf = np.frombuffer(b"".join(tf_cells), np.int32)
            order = np.lexsort((term, np.repeat(np.arange(len(size)), size)))
            tree = Tree(doc_ids, length_norm(n, n_docs, n_terms), cut, term[order], tf[order])
            for i, heap in enumerate(heaps):
                tree.search(terms[starts[i]:starts[i + 1]], weights[starts[i]:starts[i + 1]], k, heap)

        for batch in batches:
            n = np.asarray(batch.column("n"))
            cells = [batch.column(c).to_pylist() for c in ("terms", "tfs")]
            doc_ids = np.asarray(batch.column("doc_id"))
            for a in range(0, len(n), 1024):
                part = slice(a, a + 1024)
                held.append((doc_ids[part], n[part], cells[0][part], cells[1][part]))
                docs, size = docs + len(n[part]), size + sum(map(len, cells[0][part])) // 4
                if docs >= SHARD or size >= SHARD_TERMS:
                    shard()
                    held, docs, size = [], 0, 0
        if held:
            shard()
        rows = [(ids[i], -j, s) for i, heap in enumerate(heaps) for s, j in heap]
        cols = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in cols], ["item_id", "doc_id", "score"])

    return run


def _search_block(docs: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """The ``k`` best (item_id, doc_id, score) of each task for the items of one block."""
    spark = docs.sparkSession
    table = pairs.toPandas()
    item, term = table["item_id"].to_numpy(), table["term"].to_numpy().view(np.uint64)
    vocabulary = np.unique(term)
    vectors = shared_table(arrow_map(docs, _vectors(send(spark, vocabulary)), _VECTOR), "vectors")
    n_docs, n_terms = vectors.filter("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    found = vectors.filter((F.octet_length("terms") > 0) & F.col("doc_id").isNotNull())
    df = np.zeros(len(vocabulary), np.int64)
    counted = arrow_map(vectors.filter(F.octet_length("terms") > 0).select("terms"), _frequencies(len(vocabulary)), "term int, df long")
    for r in counted.groupBy("term").agg(F.sum("df").alias("df")).collect():  # at most the items' terms
        df[r["term"]] = r["df"]
    order = np.argsort(df, kind="stable")
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order))
    w = weight(df, n_docs)
    mine = np.searchsorted(vocabulary, term)
    by = np.lexsort((rank[mine], item))
    ids, starts = np.unique(item[by], return_index=True)
    sent = send(spark, (ids.tolist(), rank, np.append(starts, len(by)), rank[mine][by].astype(np.int64), w[mine][by]))
    return arrow_map(found, _search(sent, n_docs, n_terms, k), "item_id long, doc_id long, score long")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents with a score above 0 of each item.

    ``docs`` has doc_id and text, ``items`` item_id and text; ids are whole numbers.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("item_id is not null")
    pairs = shared_table(arrow_map(items, _item_terms, "item_id long, term long").distinct(), "item-terms", small=True)
    blocks = parts_for(pairs.count(), ITEM_TERMS, least=0)
    block = F.pmod(F.xxhash64("item_id"), F.lit(max(blocks, 1)))
    best = spark.createDataFrame([], "item_id long, doc_id long, score long")
    for b in range(blocks):
        mine = pairs.filter(block == b)
        if not mine.isEmpty():
            best = best.unionByName(shared_table(_search_block(docs, mine, k), "best"))
    first = W.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return (best.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))
