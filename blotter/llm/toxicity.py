"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

Terms are lower-cased words and word beginnings (``PREFIXES`` bytes): all that the
training sample holds. A term's weight is its TF-IDF, with document frequencies of
the whole corpus, times how surely it goes with label 1 in the sample (``LEAST``
for a term that doesn't, up to 1), so a text is compared by its telling terms if it
has some and by all others if not; the cosine that is reported is of these weights.
Every labelled example with a word is in the index.

Texts are searched many at once. Terms of few examples are posting lists, added up
exactly; of the others, each block of examples has the largest weight of each term. A
block's bound is what the lists gave plus the product with these maxima; only blocks whose
bound reaches a text's k-th best lower bound are multiplied, first the most promising ones,
then those that still reach what these gave. All examples near the k-th place are then
computed again in double precision, term by term in a fixed order, so neighbours and cosines
are exact and the same in any batch. Neighbours vote by cosine for their label; isotonic
calibration turns votes into a score. The votes that it learns from come from
``FOLDS`` models of the sample, each without the fold that it votes on, weights of terms included.

Training reads at most ``max_rows`` labelled texts and ``max_bytes`` of their bytes, never
a held-out one; this sample, its terms and the index are all that the driver and every task
hold. One task makes the index. A text that shares no term with any example has no neighbours and scores as
training texts without terms do.

Rows: null, empty and wordless texts have no terms. Labels follow the rules of
``quality``; equal texts of one id are one example. Without labels, or with labels of one kind
only, every score is their share (0 without any). Repeated rows score alike; result columns
replace input columns of their names. Ids are whole numbers.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quality import labelled_texts
from .shared import arrow_groups, arrow_map, received, send, shared_table
from .text import ALNUM, LOWER, chunks, mix64, prefix_hashes, words

MAX_TRAINING_ROWS = 2560
MAX_TRAINING_BYTES = 16 << 20
FOLDS = 2
PREFIXES = (3, 4, 5, 6, 7)
HALF_CHI2 = 40.0         # the chi-square at which a term counts half
LEAST = 0.02             # the weight of a term that goes with no label, against a sure one
COMMON = 1 / 32          # of the examples: terms of more have block bounds in place of posting lists
NEIGHBOURS = 15
BLOCK = 64
FIRST_BLOCKS = 4         # blocks of a text that are multiplied before the bounds are looked at again
TEXTS = 256              # searched at once
NEAR = 1e-5              # cosines this near to the k-th best are computed again in double precision
CUT = 0.7
EVIDENCE = "score double, neighbours array<struct<doc_id: long, cosine: double, label: int>>"


def _terms(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, term hash) of every word and word beginning."""
    data = LOWER[data]
    s, e, first = words(data, offs, ALNUM)
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    whole, *heads = prefix_hashes(data, s, e, PREFIXES)
    docs, terms = [doc], [whole]
    for k, head in zip(PREFIXES, heads):
        long = e - s > k
        docs.append(doc[long])
        terms.append(mix64(head[long] + np.uint64(k)))
    return np.concatenate(docs), np.concatenate(terms)


@dataclass
class Terms:
    """The sample's terms as sorted hashes, and each one's number: frequent terms have small ones, so what is read most lies together."""

    hashes: np.ndarray
    number: np.ndarray

    def counts(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, count) of the known terms, sorted by text and term."""
        doc, h = _terms(data, offs)
        if not len(self.hashes) or not len(h):
            none = np.zeros(0, np.int64)
            return none, none, none
        h, same = np.unique(h, return_inverse=True)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        at, sure = self.number[at][same], (self.hashes[at] == h)[same]
        key, n = np.unique(doc[sure] * len(self.hashes) + at[sure], return_counts=True)
        return key // len(self.hashes), key % len(self.hashes), n


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the spans, one span after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


class BlockMaxIndex:
    """Examples' unit vectors: posting lists of the rarer terms; the common ones as a matrix with each block's largest weights."""

    def __init__(self, example: np.ndarray, term: np.ndarray, weight: np.ndarray, examples: int, terms: int):
        self.examples, self.blocks, self.terms = examples, max(1, -(-examples // BLOCK)), terms
        order = np.lexsort((term, example))
        example, term, weight = example[order].astype(np.int32), term[order].astype(np.int32), weight[order].astype(np.float32)
        self.term, self.weight = term, weight
        self.cut = np.searchsorted(example, np.arange(examples + 1))
        often = np.bincount(term, minlength=terms) > max(BLOCK, COMMON * examples)
        self.common = np.where(often, np.cumsum(often) - 1, -1).astype(np.int32)
        own = often[term]
        small = np.uint16 if max(examples, int(often.sum())) <= 1 << 16 else np.int32
        self.of, self.of_example, self.of_weight = self.common[term[own]].astype(small), example[own].astype(small), weight[own]
        order = np.argsort(term[~own], kind="stable")
        self.list_example, self.list_weight = example[~own][order].astype(small), weight[~own][order]
        self.list_cut = np.concatenate([[0], np.cumsum(np.bincount(term[~own], minlength=terms))])
        self.matrix = self.top = None     # made where they are used

    def _matrices(self) -> None:
        many = int((self.common >= 0).sum())
        self.matrix = np.zeros((many, self.blocks * BLOCK), np.float32)
        self.matrix[self.of, self.of_example] = self.of_weight
        self.matrix = np.ascontiguousarray(self.matrix.reshape(many, self.blocks, BLOCK).transpose(1, 0, 2))
        self.top = self.matrix.max(2).T

    def nearest(self, doc: np.ndarray, term: np.ndarray, weight: np.ndarray, texts: int, k: int) -> list[tuple]:
        """Per text the ``k`` examples of largest cosine above 0, ties to the lower number: (examples, cosines).

        ``doc``, ``term`` and ``weight`` are the texts' unit vectors, sorted by text and term.
        """
        if self.matrix is None:
            self._matrices()
        cuts = np.searchsorted(doc, np.arange(texts + 1))
        return [row for a in range(0, texts, TEXTS)
                for row in self._nearest(cuts[a:a + TEXTS + 1], term, weight, k)]

    def _nearest(self, cuts: np.ndarray, term: np.ndarray, weight: np.ndarray, k: int) -> list[tuple]:
        texts, (a, b), width = len(cuts) - 1, cuts[[0, -1]], self.blocks * BLOCK
        doc, term, weight = np.repeat(np.arange(texts), np.diff(cuts)), term[a:b], weight[a:b]
        sizes = self.list_cut[term + 1] - self.list_cut[term]
        at = _spans(self.list_cut[term], sizes)
        place = np.repeat(doc * width, sizes) + self.list_example[at]
        score = np.bincount(place, self.list_weight[at] * np.repeat(weight, sizes), texts * width)
        score = score.reshape(texts, width).astype(np.float32)
        mine = self.common[term]
        asked = np.zeros((texts, self.matrix.shape[1]), np.float32)
        asked[doc[mine >= 0], mine[mine >= 0]] = weight[mine >= 0]
        done = np.zeros((texts, self.blocks), bool)
        # what a block can reach at most: its best list score plus the product with its largest weights
        bound = score.reshape(texts, self.blocks, BLOCK).max(2) + asked @ self.top
        kth = max(0, width - k)
        first = np.argsort(-bound, axis=1, kind="stable")[:, :FIRST_BLOCKS]
        for last in (False, True):
            # scores so far are lower bounds, exact ones where a block is done
            floor = np.partition(score, kth, axis=1)[:, kth]
            open_ = ~done & (bound > 0) & (bound >= floor[:, None] - NEAR)
            if not last:
                some = np.zeros_like(open_)
                np.put_along_axis(some, first, True, axis=1)
                open_ &= some
            for block in np.flatnonzero(open_.any(0)).tolist():
                rows = np.flatnonzero(open_[:, block])
                part = slice(block * BLOCK, (block + 1) * BLOCK)
                score[rows, part] += asked[rows] @ self.matrix[block]
            done |= open_
        score[~np.repeat(done, BLOCK, axis=1)] = 0
        floor = np.maximum(np.partition(score, kth, axis=1)[:, kth] - NEAR, 0)
        out, dense = [], np.zeros(self.terms, np.float32)
        for i in range(texts):
            ids = np.flatnonzero(score[i, :self.examples] > floor[i])
            own = slice(cuts[i] - a, cuts[i + 1] - a)
            dense[term[own]] = weight[own]
            spans = zip(self.cut[ids].tolist(), self.cut[ids + 1].tolist())
            cosine = np.array([(self.weight[x:y] * dense[self.term[x:y]]).sum(dtype=np.float64) for x, y in spans])
            dense[term[own]] = 0
            order = np.lexsort((ids, -cosine))[:k]
            order = order[cosine[order] > 0]
            out.append((ids[order], cosine[order]))
        return out


@dataclass
class Examples:
    """What every task gets: the terms, their weights and the index; bounded by the training sample."""

    terms: Terms
    idf: np.ndarray
    index: BlockMaxIndex
    doc_ids: np.ndarray
    labels: np.ndarray

    def vectors(self, data: np.ndarray, offs: np.ndarray):
        return _unit(*self.terms.counts(data, offs), self.idf, len(offs) - 1)

    def vote(self, near: np.ndarray, cosine: np.ndarray) -> float:
        return float((cosine * self.labels[near]).sum() / cosine.sum()) if len(near) else 0.0


@dataclass
class ToxicityModel:
    sent: object                             # the broadcast Examples
    steps: tuple[np.ndarray, np.ndarray]     # vote, score
    without: float                           # the score of texts without terms


def _unit(doc: np.ndarray, term: np.ndarray, n: np.ndarray, idf: np.ndarray, docs: int):
    """TF-IDF weights scaled to length one per text."""
    weight = (1 + np.log(n)) * idf[term] if len(n) else np.zeros(0)
    norm = np.sqrt(np.bincount(doc, weight * weight, docs))
    return doc, term, (weight / norm[doc] if len(n) else weight).astype(np.float32)


def _isotonic(vote: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pooled adjacent violators, a pseudo count of each kind in every pool."""
    order = np.argsort(vote, kind="stable")
    pools: list[list[float]] = []        # weight, ones, least vote, largest vote
    for v, y in zip(vote[order].tolist(), label[order].tolist()):
        pools.append([1, y, v, v])
        while len(pools) > 1 and (pools[-2][1] / pools[-2][0] >= pools[-1][1] / pools[-1][0]
                                  or pools[-2][3] == pools[-1][2]):
            w, ones, _, hi = pools.pop()
            pools[-1] = [pools[-1][0] + w, pools[-1][1] + ones, pools[-1][2], hi]
    x = np.array([p for w, ones, lo, hi in pools for p in (lo, hi)])
    y = np.array([p for w, ones, lo, hi in pools for p in [(ones + 0.5) / (w + 1)] * 2])
    return x, y


def _term_rows(batches):
    """Per row of the sample: its terms and their counts, as bytes."""
    for batch in batches:
        cols: tuple[list, list] = ([], [])
        for lo, hi, data, offs in chunks(batch, "text"):
            doc, h = _terms(data, offs)
            order = np.lexsort((h, doc))
            doc, h = doc[order], h[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
            at = np.flatnonzero(new)
            n = np.diff(np.append(at, len(h))).astype(np.int32)
            cuts = np.searchsorted(doc[at], np.arange(hi - lo + 1))
            for x, y in zip(cuts[:-1], cuts[1:]):
                cols[0].append(h[at[x:y]].tobytes())
                cols[1].append(n[x:y].tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"),
                                          *(pa.array(c, pa.binary()) for c in cols)], ["doc_id", "y", "terms", "counts"])


PIECE = 1 << 20   # bytes of the index in one row
SLICE = 1 << 16   # terms whose counts travel together


def _document_counts(sent, text_col: str):
    """(slice, counts): in how many of the task's texts each term is, for slices of terms (-1: the texts)."""

    def run(batches):
        terms = received(sent)
        total, texts = np.zeros(len(terms.hashes), np.int64), 0
        for batch in batches:
            texts += batch.num_rows
            for _, _, data, offs in chunks(batch, text_col):
                total += np.bincount(terms.counts(data, offs)[1], minlength=len(total))
        cells = [total[a:a + SLICE].tobytes() for a in range(0, len(total), SLICE)]
        yield pa.RecordBatch.from_arrays([pa.array([*range(len(cells)), -1], pa.int32()),
                                          pa.array([*cells, np.array([texts]).tobytes()], pa.binary())], ["slice", "counts"])

    return run


def _summed(key, batches):
    total = sum(np.frombuffer(c, np.int64) for batch in batches for c in batch.column("counts").to_pylist())
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                     ["slice", "counts"])


def _sureness(doc: np.ndarray, term: np.ndarray, y: np.ndarray, terms: int) -> np.ndarray:
    """How surely each term goes with label 1 in these examples (``LEAST`` to 1; a term that none has: ``LEAST``)."""
    rows, ones = len(y), int(y.sum())
    if not 0 < ones < rows:
        return np.full(terms, LEAST)
    n, a = np.bincount(term, minlength=terms).astype(float), np.bincount(term, y[doc], terms)
    share = ones / rows
    lift = np.maximum(0, a / np.maximum(n, 1) - share) / (1 - share)
    chi2 = lift ** 2 * n * rows * (1 - share) / (share * np.maximum(1, rows - n))
    return LEAST + (1 - LEAST) * (lift * chi2 / (chi2 + HALF_CHI2)) ** 2


def _examples(terms: Terms, idf: np.ndarray, ids: np.ndarray, y: np.ndarray, doc: np.ndarray, term: np.ndarray,
              n: np.ndarray) -> Examples:
    """The index of the examples; term weights learn from their labels."""
    idf = idf * _sureness(doc, term, y, len(idf))
    doc, term, weight = _unit(doc, term, n, idf, len(y))
    order = _alike(doc, term, weight, len(y), len(idf))
    place = np.empty(len(y), np.int64)
    place[order] = np.arange(len(y))
    return Examples(terms, idf, BlockMaxIndex(place[doc], term, weight, len(y), len(idf)), ids[order], y[order])


AXES = 8


def _alike(doc: np.ndarray, term: np.ndarray, weight: np.ndarray, examples: int, terms: int) -> np.ndarray:
    """An order of the examples in which those of one kind (a language, say) come together, so that blocks' bounds are low.

    By the signs along the first ``AXES`` principal directions of the common terms.
    """
    often = np.bincount(term, minlength=terms) > max(BLOCK, COMMON * examples)
    own = often[term]
    matrix = np.zeros((examples, int(often.sum())), np.float32)
    matrix[doc[own], (np.cumsum(often) - 1)[term[own]]] = weight[own]
    y = np.random.default_rng(0).normal(size=(matrix.shape[1], AXES)).astype(np.float32)
    for _ in range(4):
        y = matrix.T @ np.linalg.qr(matrix @ y)[0] if matrix.size else y
    side = (matrix @ y).T
    return np.lexsort((np.arange(examples), *(side[::-1] > np.median(side, axis=1)[::-1, None])))




def _fold_votes(terms, idf, ids, y, doc, term, n) -> tuple[np.ndarray, np.ndarray]:
    """(votes, labels): each example's vote by the examples of the other folds, with weights learnt from those.

    Rows of one id are in one fold.
    """
    fold = mix64(ids.astype(np.uint64)) % np.uint64(FOLDS)
    votes, labels = [np.zeros(0)], [np.zeros(0, np.int64)]
    for f in range(FOLDS):
        out = fold == f
        place = np.cumsum(~out) - 1
        kept = ~out[doc]
        if not out.any() or out.all():
            continue
        others = _examples(terms, idf, ids[~out], y[~out], place[doc[kept]], term[kept], n[kept])
        asked, place = out[doc], np.cumsum(out) - 1
        vectors = _unit(place[doc[asked]], term[asked], n[asked], others.idf, int(out.sum()))
        votes.append(np.array([others.vote(*near) for near in others.index.nearest(*vectors, int(out.sum()), NEIGHBOURS)]))
        labels.append(y[out])
    return np.concatenate(votes), np.concatenate(labels)


def _sample_arrays(batches) -> tuple:
    """(ids, labels, terms of each row, all rows' term hashes, their counts) of the sample, in the same order in every run."""
    found = pa.Table.from_batches(list(batches)).sort_by([("terms", "ascending"), ("doc_id", "ascending"), ("counts", "ascending")])
    ids, y = (found.column(c).to_numpy().astype(np.int64) for c in ("doc_id", "y"))
    sizes = np.array([len(c.as_buffer()) // 8 for c in found.column("terms")], np.int64)
    hashes, n = (np.frombuffer(b"".join(found.column(c).to_pylist()), kind) for c, kind in (("terms", np.uint64), ("counts", np.int32)))
    return ids, y, sizes, hashes, n


def _known_terms(key, batches):
    """One row: the sample's terms and their numbers, if it can teach anything."""
    _, y, _, hashes, _ = _sample_arrays(batches)
    known, place = np.unique(hashes, return_inverse=True)
    number = np.empty(len(known), np.int64)
    number[np.argsort(-np.bincount(place, minlength=len(known)), kind="stable")] = np.arange(len(known))
    yield pa.RecordBatch.from_arrays([pa.array([len(y)]), pa.array([int(y.sum())]), pa.array([known.tobytes()], pa.binary()),
                                      pa.array([number.tobytes()], pa.binary())], ["rows", "ones", "known", "number"])


def _trained(sent):
    """Pieces of two pickled parts: the calibration with the score of texts without terms, and the index."""

    def run(key, batches):
        terms, idf = received(sent)
        ids, y, sizes, hashes, n = _sample_arrays(batches)
        term = terms.number[np.searchsorted(terms.hashes, hashes)].astype(np.int32)
        full = sizes > 0
        sample = (ids[full], y[full], np.repeat(np.arange(int(full.sum())), sizes[full]).astype(np.int32), term, n)
        votes, labels = _fold_votes(terms, idf, *sample)
        steps = _isotonic(votes, labels) if len(votes) else (np.array([0.0]), np.array([y.mean()]))
        without = (int(y[~full].sum()) + 0.5) / (int((~full).sum()) + 1)
        parts = [pickle.dumps((steps, without)), cloudpickle.dumps(_examples(terms, idf, *sample))]
        for i, part in enumerate(parts):
            for a in range(0, len(part), PIECE):
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([a]), pa.array([part[a:a + PIECE]], pa.binary())],
                                                 ["part", "place", "bytes"])

    return run


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = MAX_TRAINING_ROWS,
          max_bytes: int = MAX_TRAINING_BYTES) -> ToxicityModel:
    """Terms, corpus statistics, index and calibration; all but the corpus counts come from the bounded sample.

    One task makes the index; the driver passes on its bytes and holds the terms and their counts.
    """
    spark = docs.sparkSession
    sample = labelled_texts(docs, labels, label, max_rows, max_bytes)
    vectors = arrow_map(sample, _term_rows, "doc_id long, y int, terms binary, counts binary")
    vectors = shared_table(vectors, "toxicity-sample").withColumn("one", F.lit(1))
    found = arrow_groups(vectors, "one", _known_terms, "rows long, ones long, known binary, number binary").first()
    rows, ones = (found["rows"], found["ones"]) if found else (0, 0)
    if not 0 < ones < rows or not found["known"]:
        nothing = [np.zeros(0, np.int64) for _ in range(5)]
        empty = Examples(Terms(np.zeros(0, np.uint64), nothing[0]), np.zeros(0), BlockMaxIndex(*nothing[:3], 0, 0), *nothing[3:])
        share = ones / rows if rows else 0.0
        return ToxicityModel(send(spark, empty), (np.array([0.0]), np.array([share])), share)
    terms = Terms(np.frombuffer(found["known"], np.uint64), np.frombuffer(found["number"], np.int64))
    counted = arrow_map(docs.select("text"), _document_counts(send(spark, terms), "text"), "slice int, counts binary")
    counted = {r["slice"]: np.frombuffer(r["counts"], np.int64)
               for r in arrow_groups(counted, "slice", _summed, "slice int, counts binary").collect()}
    texts = int(counted.pop(-1)[0])
    idf = np.log1p(texts / (1 + np.concatenate([counted[i] for i in range(len(counted))])))
    made = arrow_groups(vectors, "one", _trained(send(spark, (terms, idf))), "part int, place long, bytes binary")
    made = shared_table(made, "toxicity-index").toArrow()
    pieces = sorted(zip(made["part"].to_pylist(), made["place"].to_pylist(), (c.as_buffer() for c in made["bytes"])), key=lambda x: x[:2])
    first, index = (b"".join(c for part, _, c in pieces if part == i) for i in (0, 1))
    del made, pieces
    return ToxicityModel(spark.sparkContext.broadcast(index), *pickle.loads(first))


def _score(model: ToxicityModel, text_col: str):
    sent, steps, without = model.sent, model.steps, model.without

    def run(batches):
        known = received(sent)
        for batch in batches:
            scores, evidence = [], []
            for lo, hi, data, offs in chunks(batch, text_col):
                doc, term, weight = known.vectors(data, offs)
                has = np.zeros(hi - lo, bool)
                has[doc] = True
                for some, (near, cosine) in zip(has.tolist(), known.index.nearest(doc, term, weight, hi - lo, NEIGHBOURS)):
                    scores.append(float(np.interp(known.vote(near, cosine), *steps)) if some else without)
                    evidence.append([{"doc_id": int(known.doc_ids[i]), "cosine": float(c), "label": int(known.labels[i])}
                                     for i, c in zip(near, cosine)])
            kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("label", pa.int32())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64()), pa.array(evidence, kind)],
                                             [*batch.schema.names, "score", "neighbours"])

    return run


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` and the ``neighbours`` that it rests on."""
    docs = docs.drop("score", "neighbours")
    schema = T.StructType(docs.schema.fields + T.StructType.fromDDL(EVIDENCE).fields)
    return arrow_map(docs, _score(model, text_col), schema)
