"""Cross-entropy difference between a target and a background n-gram model.

Both models are bigram models with Dirichlet smoothing over one vocabulary: all
words that occur ``MIN_COUNT`` times or more in the background; any other word is
one unknown word. Words and bigrams are counted exactly over all texts of both
sides, however many there are. A bigram falls back on its side's unigrams, and
these, by a fixed share, on the unigrams of both sides together, so that a word
that one side lacks costs the same whatever the vocabulary's size; unigrams are
never flattened. The bigram counts of the larger side are scaled to the tokens of the
smaller, so that the models match: neither is sharper only because it has seen more
text. A text of a side is scored by that side's counts without its own (one row's),
so texts inside and outside a side compare. A text's score is the mean over its
tokens of target loss minus background loss (in nats): the lower, the closer to the target.

1. A task packs its texts into runs of about ``RUN_TOKENS`` tokens, each with its
   distinct words, and writes them.
2. Every run sends its distinct words, with counts, to parts by hash. A part sums
   them and answers each run with the totals of the words that it sent.
3. With these a run knows its unknown words, and sends its distinct bigrams to
   parts in the same way. The answers give the losses of its texts.

No task or driver holds a model; parts and runs have a size of their own, and their
number grows with the tokens. A very common word or bigram is one entry for
each run. Texts get their losses by their MD5 digest, very frequent texts (and null ones) over several tasks.

Rows: a null, empty or wordless text has no tokens, null losses and a null
score. Rows are scored one by one, repeated ones alike; columns named like a
result are replaced. Empty tables give uniform models. Texts are known to be in a side
if ``docs`` is that side's DataFrame; in another one they count as texts outside it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import salted_join
from .shared import arrow_groups, arrow_map, parts_for, shared_table
from .text import ALNUM, LOWER, chunks, mix64, span_hash, words

MIN_COUNT = 2
PRIOR = 50.0             # weight of the unigram model, in tokens
SHARED = 0.2             # share of the unigrams of both sides together in either side's unigram model
UNIFORM = 0.01           # share of the uniform distribution in those
RESULTS = ("n_tokens", "target_loss", "background_loss", "score")
RUN_TOKENS = 2_000_000   # tokens (and texts) of a run
SCORED_TOKENS = 250_000  # tokens of a run whose losses are worked out at once (or one longer text)
PART_TOKENS = 2_000_000  # tokens behind one part of the words or bigrams
LEAST_PARTS = 12
HOT_TASKS = 256          # tasks at most for the rows of one very frequent text

_TARGET, _BACKGROUND, _SCORED = 1, 2, 4   # what a run's texts are for
_OTHER, _START = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_PAYLOAD = "digests binary, sizes binary, toks binary, words binary"
_RUN = "run long, role int, n_tokens long, n_texts long, " + _PAYLOAD
_DEALT = "part int, run long, role int, keys binary, counts binary"
_FOUND = "run long, part int, found binary, stats array<long>"
_LOSSES = "digest binary, n long, one double, two double"


def _names(ddl: str) -> list[str]:
    return [f.split()[0] for f in ddl.split(", ")]


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of one length of numbers from 0, the first bytes of all numbers before the second ones, compressed.

    The first byte tells how many bytes the largest number needs.
    """
    size = max(1, -(-max(int(a.max(initial=0)) for a in arrays).bit_length() // 8))
    planes = [a.astype(np.int64).view(np.uint8).reshape(-1, 8)[:, :size].T.tobytes() for a in arrays]
    return bytes([size]) + pa.compress(b"".join(planes), "zstd", asbytes=True)


def _unpacked(data: bytes, n: int, arrays: int) -> np.ndarray:
    size = data[0]
    planes = np.frombuffer(pa.decompress(data[1:], arrays * size * n, "zstd", asbytes=True), np.uint8)
    out = np.zeros((arrays, n, 8), np.uint8)
    out[:, :, :size] = planes.reshape(arrays, size, n).transpose(0, 2, 1)
    return out.view(np.int64)[:, :, 0]


def _runs(role: int):
    """Runs of the texts: digests, tokens of each text, and tokens as places in the run's words. Run numbers begin with the role."""

    def run(batches):
        start = (role << 56) + (TaskContext.get().partitionId() << 24)
        held, size, made = [], 0, 0

        def row():
            digests, sizes, hashes = zip(*held)
            sizes, h = np.concatenate(sizes), np.concatenate(hashes)
            found, same, n = np.unique(h, return_inverse=True, return_counts=True)
            order = np.argsort(-n, kind="stable")  # common words get small numbers, which compress best
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            cells = [start + made, role, len(h), int((sizes > 0).sum()), b"".join(digests), sizes.astype(np.int64).tobytes(),
                     _packed(place[same]), found[order].tobytes()]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds)], _names(_RUN))

        for batch in batches:
            for lo, hi, data, offs in chunks(batch, "text"):
                data = LOWER[data]
                s, e, first = words(data, offs, ALNUM)
                held.append((b"".join(batch.column("digest")[lo:hi].to_pylist()), np.diff(first), span_hash(data, s, e)))
                size += len(s) + hi - lo
                if size >= RUN_TOKENS:
                    yield row()
                    held, size, made = [], 0, made + 1
        if held:
            yield row()

    return run


def _to_parts(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the keys in order of their parts, and where each part begins."""
    part = (mix64(keys) % np.uint64(parts)).astype(np.uint16 if parts <= 1 << 16 else np.int64)
    order = np.argsort(part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(parts + 1))


def _deal(run: int, role: int, keys: np.ndarray, counts: list[np.ndarray], parts: int) -> pa.RecordBatch:
    order, cuts = _to_parts(keys, parts)
    keys, counts = keys[order], [c[order] for c in counts]
    at = np.flatnonzero(np.diff(cuts))
    spans = [(cuts[p], cuts[p + 1]) for p in at]
    return pa.RecordBatch.from_arrays(
        [pa.array(at, pa.int32()), pa.array([run] * len(at), pa.int64()), pa.array([role] * len(at), pa.int32()),
         pa.array([keys[a:b].tobytes() for a, b in spans], pa.binary()),
         pa.array([_packed(*(c[a:b] for c in counts)) for a, b in spans], pa.binary())], _names(_DEALT))


def _gathered(keys: np.ndarray, found: list[tuple[int, bytes]], parts: int, rows: int) -> np.ndarray:
    """What the parts answered, in the order of the keys."""
    order, cuts = _to_parts(keys, parts)
    out = np.zeros((rows, len(keys)), np.int64)
    for p, data in found:
        out[:, order[cuts[p]:cuts[p + 1]]] = _unpacked(data, int(cuts[p + 1] - cuts[p]), rows)
    return out


@dataclass
class _Run:
    """The unpacked payload of a run."""

    role: int
    words: np.ndarray
    sizes: np.ndarray
    toks: np.ndarray

    @classmethod
    def read(cls, r: dict) -> _Run:
        sizes = np.frombuffer(r["sizes"], np.int64)
        return cls(r["role"], np.frombuffer(r["words"], np.uint64), sizes, _unpacked(r["toks"], int(sizes.sum()), 1)[0])

    def starts(self) -> np.ndarray:
        """Places of the texts' first tokens."""
        return (np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]

    def counts(self) -> list[np.ndarray]:
        """Of every word: its tokens, and those that another token follows."""
        last = (np.cumsum(self.sizes) - 1)[self.sizes > 0]
        n = np.bincount(self.toks, minlength=len(self.words))
        return [n, n - np.bincount(self.toks[last], minlength=len(self.words))]

    def before(self) -> np.ndarray:
        """The word before every token; the number after the last word is a text's start."""
        out = np.empty_like(self.toks)
        out[1:] = self.toks[:-1]
        out[self.starts()] = len(self.words)
        return out

    def bigrams(self, known: np.ndarray) -> np.ndarray:
        """A 64-bit hash of every token's bigram; ``known``: which words are in the vocabulary."""
        name = np.append(np.where(known, self.words, _OTHER), _START)
        return mix64(name[self.before()] * np.uint64(0xA24BAED4963EE407) + name[self.toks])


def _word_deals(parts: int):
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                mine = _Run.read(r)
                yield _deal(r["run"], r["role"], mine.words, mine.counts(), parts)

    return run


def _answers(words_too: bool):
    """A part: the totals of both sides for every key that a run sent, and for words the part's statistics."""

    def run(key, batches):
        rows = [r for batch in batches for r in batch.to_pylist()]
        each = [np.frombuffer(r["keys"], np.uint64) for r in rows]
        found, same = np.unique(np.concatenate(each), return_inverse=True)
        cuts = np.cumsum([0, *map(len, each)])
        total = np.zeros((2, 1 + words_too, len(found)), np.int64)
        for r, a, b in zip(rows, cuts[:-1], cuts[1:]):
            for side, role in enumerate((_TARGET, _BACKGROUND)):
                if r["role"] & role:
                    total[side][:, same[a:b]] += _unpacked(r["counts"], int(b - a), total.shape[1])  # a run's keys are distinct
        total = total.reshape(-1, len(found))
        part = key[0].as_py()
        names = _names(_FOUND)
        kind = pa.list_(pa.int64())
        for r, a, b in zip(rows, cuts[:-1], cuts[1:]):
            if words_too or r["role"] & _SCORED:
                data = _packed(*total[:, same[a:b]])
                yield pa.RecordBatch.from_arrays([pa.array([r["run"]], pa.int64()), pa.array([part], pa.int32()),
                                                  pa.array([data], pa.binary()), pa.nulls(1, kind)], names)
        if words_too:
            known = total[2] >= MIN_COUNT
            stats = [int(known.sum()), *total[:, ~known].sum(1).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int64()), pa.array([part], pa.int32()),
                                              pa.nulls(1, pa.binary()), pa.array([stats], kind)], names)

    return run


def _group(batches, parts: int):
    """A run's row, its unpacked payload, the totals of its words, and answers about its bigrams."""
    payload, word, pair = None, [], []
    for batch in batches:
        for r in batch.to_pylist():
            if r["kind"] == 0:
                payload = r
            else:
                (word if r["kind"] == 1 else pair).append((r["part"], r["found"]))
    mine = _Run.read(payload)
    return payload, mine, _gathered(mine.words, word, parts, 4), pair


def _bigram_deals(parts: int):
    def run(key, batches):
        r, mine, total, _ = _group(batches, parts)
        keys, n = np.unique(mine.bigrams(total[2] >= MIN_COUNT), return_counts=True)
        yield _deal(r["run"], r["role"], keys, [n], parts)

    return run


@dataclass
class Totals:
    """Of both sides (target, background): tokens, texts with tokens, and the unknown word's tokens and histories."""

    size: int
    tokens: tuple[int, int]
    texts: tuple[int, int]
    other: tuple[tuple[int, int], tuple[int, int]]

    def losses(self, mine: _Run, known: np.ndarray, total: np.ndarray, pair: np.ndarray, same: np.ndarray):
        """Mean losses of each text by both sides, some texts at a time; ``total``: tokens and histories of the words by
        side, ``pair``: of the bigrams by side, ``same``: each token's bigram."""
        n = len(mine.words)
        word = np.append(np.where(known, np.arange(n), n), n + 1)  # all unknown words are one; a text's start is the last
        tokens = [np.append(np.where(known, total[2 * s], 0), self.other[s][0]) for s in (0, 1)]
        history = [np.append(np.where(known, total[2 * s + 1], 0), [self.other[s][1], self.texts[s]]) for s in (0, 1)]
        tok, before = word[mine.toks], word[mine.before()]
        cuts = np.concatenate([[0], np.cumsum(mine.sizes)])
        out = np.zeros((2, len(mine.sizes)))
        lo = 0
        while lo < len(mine.sizes):
            hi = max(lo + 1, int(np.searchsorted(cuts, cuts[lo] + SCORED_TOKENS, "right")) - 1)
            at = slice(cuts[lo], cuts[hi])
            doc = np.repeat(np.arange(hi - lo), mine.sizes[lo:hi])
            seen = [(tokens[s][tok[at]], history[s][before[at]], pair[s][same[at]]) for s in (0, 1)]
            loss = list(self._by_token(mine.role, doc, mine.sizes[lo:hi], (tok[at], before[at], same[at]), seen))
            for s in (0, 1):
                out[s, lo:hi] = np.bincount(doc, loss[s], hi - lo) / np.maximum(1, mine.sizes[lo:hi])
            lo = hi
        return out

    def _by_token(self, role: int, doc: np.ndarray, sizes: np.ndarray, names: tuple, seen: list[tuple]):
        """Losses by both sides of the tokens of some texts; ``seen``: counts of each token's word, history and bigram."""
        inside = [bool(role & r) for r in (_TARGET, _BACKGROUND)]
        every = [np.full(len(doc), n) for n in self.tokens]
        if any(inside):  # a text is no part of the models that score it
            own = [_own(doc, name) for name in names]
            for s in np.flatnonzero(inside):
                seen[s] = tuple(n - mine for n, mine in zip(seen[s], own))
                every[s] = every[s] - sizes[doc]
        both = every[0] + every[1]
        base = UNIFORM / self.size + (1 - UNIFORM) * (seen[0][0] + seen[1][0]) / np.maximum(both, 1)
        base = np.where(both > 0, base, 1 / self.size)
        for s, (token, history, pair) in enumerate(seen):
            unigram = np.where(every[s] > 0, (1 - SHARED) * token / np.maximum(every[s], 1) + SHARED * base, base)
            scale = min(self.tokens) / self.tokens[s] if self.tokens[s] else 1.0
            yield -np.log((pair * scale + PRIOR * unigram) / (history * scale + PRIOR))


def _own(doc: np.ndarray, value: np.ndarray) -> np.ndarray:
    """How often each value stands in its own text."""
    _, same, n = np.unique(doc * (int(value.max(initial=0)) + 1) + value, return_inverse=True, return_counts=True)
    return n[same]


def _scored(parts: int, totals: Totals):
    def run(key, batches):
        r, mine, total, found = _group(batches, parts)
        known = total[2] >= MIN_COUNT
        keys, same = np.unique(mine.bigrams(known), return_inverse=True)
        pair = _gathered(keys, found, parts, 2)
        means = [pa.array(mean, mask=mine.sizes == 0) for mean in totals.losses(mine, known, total, pair, same)]
        digests = [r["digests"][i:i + 16] for i in range(0, len(r["digests"]), 16)]
        yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(mine.sizes), *means], _names(_LOSSES))

    return run


def _digest(text_col: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit(""))))


def _written_runs(sides: list[tuple[DataFrame, int]], text_col: str) -> DataFrame:
    """The runs of all sides; a DataFrame that stands for several is read once."""
    roles: list[list] = []
    for df, role in sides:
        same = next((x for x in roles if x[0] is df), None)
        if same:
            same[1] |= role
        else:
            roles.append([df, role])
    made = None
    for df, role in roles:
        part = arrow_map(df.select(_digest(text_col).alias("digest"), F.col(text_col).alias("text")), _runs(role), _RUN)
        made = part if made is None else made.unionByName(part)
    return shared_table(made, "lm-runs")


def _by_run(runs: DataFrame, **found: DataFrame) -> DataFrame:
    """Runs and the answers to them as rows of one table."""
    rows = runs.select("run", F.lit(0).alias("kind"), "role", *_names(_PAYLOAD))
    for kind, name in enumerate(found, 1):
        more = found[name].filter("run >= 0").select("run", F.lit(kind).alias("kind"), "part", "found")
        rows = rows.unionByName(more, allowMissingColumns=True)
    return rows


def score_texts(docs: DataFrame, target: DataFrame, background: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``, ``target_loss``, ``background_loss`` and ``score`` (their difference)."""
    runs = _written_runs([(docs, _SCORED), (target, _TARGET), (background, _BACKGROUND)], text_col)
    sums = {r["role"]: r for r in runs.groupBy("role").agg(F.sum("n_tokens").alias("tokens"),
                                                           F.sum("n_texts").alias("texts")).collect()}
    side = lambda name: tuple(sum(r[name] for k, r in sums.items() if k & role) for role in (_TARGET, _BACKGROUND))
    parts = parts_for(sum(r["tokens"] for r in sums.values()), PART_TOKENS, LEAST_PARTS)

    dealt = arrow_map(runs, _word_deals(parts), _DEALT)
    word = shared_table(arrow_groups(dealt, "part", _answers(True), _FOUND), "lm-words")
    stats = word.filter("run = -1").agg(*(F.coalesce(F.sum(F.col("stats")[i]), F.lit(0)) for i in range(5))).first()
    totals = Totals(stats[0] + 1, side("tokens"), side("texts"), ((stats[1], stats[2]), (stats[3], stats[4])))

    dealt = arrow_groups(_by_run(runs, word=word), "run", _bigram_deals(parts), _DEALT)
    pair = arrow_groups(dealt, "part", _answers(False), _FOUND)
    scored = F.shiftright("run", 56).bitwiseAND(_SCORED) != 0
    mine = _by_run(runs, word=word, pair=pair).filter(scored)
    losses = arrow_groups(mine, "run", _scored(parts, totals), _LOSSES)
    losses = losses.groupBy("digest").agg(*(F.max(c).alias(f"__{c}") for c in ("n", "one", "two")))

    docs = docs.drop(*RESULTS)
    keyed = docs.withColumn("__digest", _digest(text_col))
    found = salted_join(keyed, losses.withColumnRenamed("digest", "__digest"), "__digest", buckets=HOT_TASKS)
    return found.select(
        *docs.columns, *(F.col(f"__{c}").alias(name) for c, name in zip(("n", "one", "two"), RESULTS)),
        (F.col("__one") - F.col("__two")).alias(RESULTS[3]))
