"""N-gram Jaccard join by vertical partitioning.

Every text becomes the set of its distinct word n-grams. The n-grams have one
global order: rare before common (powers of two of the number of distinct sets
that hold them), then by hash. The order is cut into fragments; overlaps of a
pair are counted in every fragment on its own and summed per pair.

1. One pass over the texts deals packed runs of (n-gram, set) to parts by hash.
   Equal sets are one set from here on, however many rows hold them (a task that
   meets a set again sends nothing). N-grams that a noticeable share of all sets
   hold, found by a pass before, are the last in the global order and go straight
   to the sets' parts, so no part gathers all holders of a very common n-gram.
2. Each part keeps the n-grams that two or more sets hold and deals them to the
   sets' parts. A set needs a partner among its first ``n - ceil(t n) + 1``
   n-grams in the global order; unshared n-grams come first, so most sets of
   ordinary prose drop out here, exactly.
3. Round one joins each set with the least set of each of its prefix n-grams (a
   star, linear in the group). Round two looks for links between the components
   that round one left: n-grams of few sets give pairs; sets that n-grams of many
   sets hold together form a family, cut into blocks, and a task takes two blocks,
   adds up their overlaps fragment by fragment in one matrix, and writes only
   links that connect them. No link between components is lost, and no group
   writes all its pairs.

Rows: a null, empty or wordless text has no n-grams and links with nothing; a
text with fewer than ``k`` words is one n-gram. Repeated rows are rows of one
class. A null id takes part but is never a component's id (a component without
any other id has null). Sets are known by 64-bit digests.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .shared import arrow_groups, arrow_map, most, parts_for, shared_table, text_bytes
from .text import LOWER, NON_SPACE, chunks, mix64, nullable_ids, roll, span_hash, words

SHINGLE_WORDS = 5
PERCENT = 75
FRAGMENTS = 8
COMMON_SHARE = 1 / 1024     # of the sets a task has gathered
COMMON_LEAST = 8
MAX_COMMON = 1 << 20        # n-grams sent to every task as common ones: 8 MB at most
_COMMON_LEVEL = 15
SMALL_GROUP = 32            # n-grams of more sets are handled by families
BLOCK_SETS = 1024           # sets of one family handled at once, twice,
BLOCK_GRAMS = 1 << 20       # and about how many n-grams they may hold
PART_BYTES = 24 << 20       # text bytes behind one part of the n-gram space
LEAST_PARTS = 64
FLUSH_TOKENS = 1_000_000    # n-grams a task gathers before it writes packed runs
FLUSH_SETS = 60_000

_PACKED = "part int, docs binary, known binary, nodes binary, ns binary, counts binary, toks binary, levels binary"
_NAMES = [f.split()[0] for f in _PACKED.split(", ")]
_SETS = "doc_id long, node long, n int, head int, toks array<long>, cuts array<int>"


def _row(part: int, **cols: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array([part], pa.int32())]
    arrays += [pa.array([cols[n].tobytes() if n in cols else None], pa.binary()) for n in _NAMES[1:]]
    return pa.RecordBatch.from_arrays(arrays, _NAMES)


def _cells(batch: pa.RecordBatch):
    """Each row of packed columns as a function (name, type) -> array, without copying."""
    for i in range(batch.num_rows):
        yield lambda name, kind: np.frombuffer(batch.column(name)[i].as_buffer(), kind)


def _pack(sorted_tokens: np.ndarray) -> np.ndarray:
    """Differences of sorted 64-bit values, in as many bytes each as the largest needs (told by the first byte)."""
    gaps = np.diff(sorted_tokens, prepend=np.uint64(0))
    width = max(1, -(-int(gaps.max(initial=0)).bit_length() // 8))
    return np.concatenate([np.array([width], np.uint8), gaps.view(np.uint8).reshape(-1, 8)[:, :width].reshape(-1)])


def _unpack(a: np.ndarray) -> np.ndarray:
    width = int(a[0])
    raw = np.zeros(((len(a) - 1) // width, 8), np.uint8)
    raw[:, :width] = a[1:].reshape(-1, width)
    return np.cumsum(raw.reshape(-1).view(np.uint64))


def text_sets(batch: pa.RecordBatch, text_col: str, k: int):
    """Per row: the sorted distinct n-gram hashes of its text."""
    for _, _, data, offs in chunks(batch, text_col):
        data = LOWER[data]
        s, e, first = words(data, offs, NON_SPACE)
        h = span_hash(data, s, e)
        grams = roll(h, k)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= k:
                g = np.sort(grams[a:b - k + 1])
                yield g[np.concatenate([[True], g[1:] != g[:-1]])]
            elif b > a:
                yield roll(h[a:b], b - a)
            else:
                yield grams[:0]


def set_digest(grams: np.ndarray) -> int:
    """The unsigned number of a set of distinct n-grams; 0 without any."""
    n = len(grams)
    return int(mix64(grams.sum(dtype=np.uint64, keepdims=True) ^ np.uint64(n))[0]) if n else 0


class _Runs:
    """Sets gathered by one task, written as packed runs by part."""

    def __init__(self, parts: int, common: np.ndarray):
        self.parts = parts
        self.common = common
        self.flushes = 0
        self.clear()

    def clear(self):
        self.sets, self.nodes, self.ns, self.seen, self.tokens = [], [], [], set(), 0
        self.docs, self.known, self.doc_nodes, self.doc_ns = [], [], [], []

    def add(self, doc: int, known: bool, grams: np.ndarray):
        n = len(grams)
        node = set_digest(grams)
        self.docs.append(doc)
        self.known.append(known)
        self.doc_nodes.append(node)
        self.doc_ns.append(n)
        if n and node not in self.seen:
            self.seen.add(node)
            self.sets.append(grams)
            self.nodes.append(node)
            self.ns.append(n)
            self.tokens += n

    def full(self) -> bool:
        return self.tokens >= FLUSH_TOKENS or len(self.docs) >= FLUSH_SETS

    def flush(self):
        if self.docs:
            at = -1 - (hash((self.doc_nodes[0], self.flushes)) % self.parts)
            yield _row(at, docs=np.array(self.docs, np.int64), known=np.array(self.known, bool),
                       nodes=np.array(self.doc_nodes, np.uint64), ns=np.array(self.doc_ns, np.int32))
        if self.sets:
            grams = np.concatenate(self.sets)
            low = np.uint64(0xFFFF)
            part = _dealt(grams, self.parts)
            who = np.repeat(np.arange(len(self.sets), dtype=np.uint64), self.ns)
            if len(self.common):
                common = _among(grams, self.common)
                at = who[common].astype(np.int64)
                tok = _gram_id(grams[common] >> np.uint64(16), part[common])
                # numbers below -parts are set parts: these runs skip the n-grams' parts
                yield from _to_sets(at, tok, np.full(len(tok), _COMMON_LEVEL, np.uint8),
                                    np.array(self.nodes, np.uint64), np.array(self.ns, np.int32), self.parts,
                                    lambda dest: -1 - self.parts - dest)
                grams, part, who = grams[~common], part[~common], who[~common]
            packed = (grams & ~low) | who
            order = np.argsort(part, kind="stable")
            part, packed = part[order], packed[order]
            cuts = np.flatnonzero(np.diff(part)) + 1
            firsts = np.concatenate([[0], cuts])[:len(part)]
            for p, run in zip(part[firsts].tolist(), np.split(packed, cuts)):
                mine, run_who = np.unique(run & low, return_inverse=True)
                run = (run & ~low) | run_who.astype(np.uint64)
                run.sort()
                mine = mine.astype(np.int64)
                yield _row(int(p), nodes=np.array(self.nodes, np.uint64)[mine],
                           ns=np.array(self.ns, np.int32)[mine], toks=_pack(run))
        self.flushes += 1
        self.clear()


def _dealt(values: np.ndarray, parts: int) -> np.ndarray:
    """The part of each 64-bit value; 16-bit numbers, if they do, are sorted fastest."""
    return (mix64(values) % np.uint64(parts)).astype(np.uint16 if parts <= 1 << 16 else np.int64)


def _gram_id(high: np.ndarray, part: np.ndarray) -> np.ndarray:
    """An n-gram's id from the upper 48 bits of its hash and its part, which is dealt by all 64."""
    return mix64((high << np.uint64(16)) ^ mix64(part.astype(np.uint64) + np.uint64(1)))


def _among(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which values are in the sorted table."""
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return table[at] == values


def _to_sets(who: np.ndarray, tok: np.ndarray, level: np.ndarray, node: np.ndarray, n: np.ndarray, parts: int,
             number):
    """One packed row for each part of the sets ``who`` (places in ``node``) that hold ``tok``."""
    dest = _dealt(node, parts)[who]
    order = np.lexsort((who, dest))
    tok, who, level, dest = tok[order], who[order], level[order], dest[order]
    cuts = np.flatnonzero(np.diff(dest, prepend=-1, append=-1)) if len(dest) else []
    for a, b in zip(cuts[:-1], cuts[1:]):
        mine, counts = np.unique(who[a:b], return_counts=True)
        yield _row(number(int(dest[a])), nodes=node[mine], ns=n[mine], counts=counts.astype(np.int32),
                   toks=tok[a:b], levels=level[a:b])


def _common_grams(text_col: str, k: int):
    """(gram, n): n-grams that a noticeable share of the sets a task gathers hold."""

    def counted(sets):
        gram, n = np.unique(np.concatenate(list(sets.values())), return_counts=True)
        often = n >= max(COMMON_LEAST, COMMON_SHARE * len(sets))
        return pa.RecordBatch.from_arrays([pa.array(gram[often].view(np.int64)), pa.array(n[often])], ["gram", "n"])

    def run(batches):
        sets, tokens = {}, 0
        for batch in batches:
            for grams in text_sets(batch, text_col, k):
                key = (len(grams), int(grams.sum(dtype=np.uint64)))
                if len(grams) and key not in sets:
                    sets[key] = grams
                    tokens += len(grams)
                if tokens >= FLUSH_TOKENS or len(sets) >= FLUSH_SETS:
                    yield counted(sets)
                    sets, tokens = {}, 0
        if sets:
            yield counted(sets)

    return run


def _common(docs: DataFrame, k: int):
    """The most common n-grams, sorted, for every task; which ones they are changes no result."""
    counts = arrow_map(docs.select("text"), _common_grams("text", k), "gram long, n long")
    counts = shared_table(counts.groupBy("gram").agg(F.sum("n").alias("n")), "jaccard-common", small=True)
    top = most(counts, "n", MAX_COMMON).select("gram").toArrow().column("gram")
    grams = np.sort(np.asarray(top).astype(np.int64).view(np.uint64))
    return docs.sparkSession.sparkContext.broadcast(grams)


def _deal(id_col: str, text_col: str, k: int, parts: int, common):
    def run(batches):
        runs = _Runs(parts, common.value)
        for batch in batches:
            ids, known = nullable_ids(batch, id_col)
            for doc, ok, grams in zip(ids.tolist(), known.tolist(), text_sets(batch, text_col, k)):
                runs.add(doc, ok, grams)
                if runs.full():
                    yield from runs.flush()
        yield from runs.flush()

    return run


def _shared_grams(parts: int):
    """One part of the n-gram space: n-grams that two or more sets hold, dealt to the sets' parts."""

    def run(key, batches):
        part = key[0].as_py()
        if part < -parts:
            for batch in batches:
                to = pa.array(np.full(batch.num_rows, -1 - parts - part, np.int32))
                yield pa.RecordBatch.from_arrays([to, *batch.columns[1:]], _NAMES)
            return
        if part < 0:
            yield from batches
            return
        toks, whos, nodes, ns, at = [], [], [], [], 0
        low = np.uint64(0xFFFF)
        for batch in batches:
            for cell in _cells(batch):
                run = _unpack(cell("toks", np.uint8))
                nodes.append(cell("nodes", np.uint64))
                ns.append(cell("ns", np.int32))
                toks.append(run >> np.uint64(16))
                whos.append((run & low).astype(np.int32) + np.int32(at))
                at += len(nodes[-1])
        tok, who = np.concatenate(toks), np.concatenate(whos)
        del toks, whos, run
        node, n = np.concatenate(nodes), np.concatenate(ns)
        node, at_first, same = np.unique(node, return_index=True, return_inverse=True)
        n, who = n[at_first], same.astype(np.int32)[who]
        order = np.argsort(tok)
        tok, who = tok[order], who[order]
        del order
        repeat = np.zeros(len(tok), bool)
        repeat[1:] = tok[1:] == tok[:-1]
        repeat[:-1] |= repeat[1:]
        tok, who = tok[repeat], who[repeat]
        order = np.lexsort((who, tok))
        tok, who = tok[order], who[order]
        if len(tok):  # equal sets met here from several tasks
            new = np.concatenate([[True], (tok[1:] != tok[:-1]) | (who[1:] != who[:-1])])
            tok, who = tok[new], who[new]
            starts = np.flatnonzero(np.concatenate([[True], tok[1:] != tok[:-1]]))
            df = np.repeat(np.diff(np.append(starts, len(tok))), np.diff(np.append(starts, len(tok))))
            keep = df > 1
            tok, who, df = tok[keep], who[keep], df[keep]
        if not len(tok):
            return
        tok = _gram_id(tok, np.array([part]))
        level = np.minimum(np.log2(df).astype(np.uint8), _COMMON_LEVEL - 1)
        yield from _to_sets(who, tok, level, node, n, parts, lambda dest: dest)

    return run


def _candidates(percent: int):
    """Sets that can have a partner at all, their shared n-grams in the global order."""

    def prefix_len(n):
        return n - (percent * n + 99) // 100 + 1

    def out(doc, node, n, head, toks, cuts):
        return pa.RecordBatch.from_arrays(
            [doc, node, pa.array(n, pa.int32()), head, toks, cuts],
            [f.split()[0] for f in _SETS.split(", ")])

    def run(key, batches):
        if key[0].as_py() < 0:
            for batch in batches:
                for cell in _cells(batch):
                    docs, nodes = cell("docs", np.int64), cell("nodes", np.int64)
                    none = pa.nulls(len(docs))
                    yield out(pa.array(docs, mask=~cell("known", bool)), pa.array(nodes), cell("ns", np.int32),
                              none.cast(pa.int32()), none.cast(pa.list_(pa.int64())),
                              none.cast(pa.list_(pa.int32())))
            return
        kinds = (("nodes", np.uint64), ("ns", np.int32), ("counts", np.int32), ("toks", np.uint64), ("levels", np.uint8))
        rows = [[cell(*kind) for kind in kinds] for batch in batches for cell in _cells(batch)]
        node, n, count, tok, level = (np.concatenate(column) for column in zip(*rows))
        del rows
        ids, first, same = np.unique(node, return_index=True, return_inverse=True)
        n = n[first].astype(np.int64)
        who = np.repeat(same.astype(np.int32), count)
        order = np.lexsort((tok, level, who))
        who, tok, level = who[order], tok[order], level[order]
        new = np.ones(len(who), bool)  # several tasks may have sent a set's common n-grams
        new[1:] = (who[1:] != who[:-1]) | (tok[1:] != tok[:-1])
        who, tok, level = who[new], tok[new], level[new]
        total = np.bincount(who, minlength=len(ids))
        head = prefix_len(n) - (n - total)  # prefix n-grams that are shared
        keep = head[who] > 0
        who, tok, level = who[keep], tok[keep], level[keep]
        cuts = np.flatnonzero(np.diff(who, prepend=-1, append=-1)) if len(who) else np.zeros(0, np.int64)
        for a in range(0, max(0, len(cuts) - 1), 2000):
            at = cuts[a:min(a + 2001, len(cuts))]
            mine = who[at[:-1]]
            frag = [np.searchsorted(level[x:y] // 2, np.arange(FRAGMENTS + 1)) for x, y in zip(at[:-1], at[1:])]
            toks = pa.ListArray.from_arrays(pa.array(at - at[0], pa.int32()),
                                            pa.array(tok[at[0]:at[-1]].view(np.int64)))
            cut = pa.ListArray.from_arrays(pa.array(np.arange(len(mine) + 1) * (FRAGMENTS + 1), pa.int32()),
                                           pa.array(np.concatenate(frag).astype(np.int32)))
            yield out(pa.nulls(len(mine), pa.int64()), pa.array(ids[mine].view(np.int64)), n[mine],
                      pa.array(head[mine], pa.int32()), toks, cut)

    return run


def _near_size(a: str, b: str, percent: int) -> Column:
    return (F.least(a, b) * 100) >= (F.greatest(a, b) * percent)


def _linked(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, na, nb) whose sets reach the threshold: overlaps counted per fragment, then summed."""
    left = segments.select(F.col("node").alias("a"), "f", F.col("toks").alias("ta"))
    right = segments.select(F.col("node").alias("b"), "f", F.col("toks").alias("tb"))
    partial = (pairs.join(left, "a").join(right, ["b", "f"])
               .select("a", "b", "na", "nb", F.size(F.array_intersect("ta", "tb")).cast("long").alias("c")))
    total = partial.groupBy("a", "b", "na", "nb").agg(F.sum("c").alias("c"))
    return total.filter(F.col("c") * 100 >= (F.col("na") + F.col("nb") - F.col("c")) * percent).select("a", "b")


def _pair(x: DataFrame, percent: int) -> DataFrame:
    """Rows (u, nu, v, nv) as distinct pairs a < b whose sizes allow a link."""
    swap = F.col("u") < F.col("v")
    return (x.filter((F.col("u") != F.col("v")) & _near_size("nu", "nv", percent))
            .select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b"),
                    F.when(swap, F.col("nu")).otherwise(F.col("nv")).alias("na"),
                    F.when(swap, F.col("nv")).otherwise(F.col("nu")).alias("nb"))
            .distinct())


def _family_links(nodes: DataFrame, family: DataFrame, comp: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect the sets of each family (node, comp) wherever its sets reach the threshold.

    Sets of a component that fills blocks get blocks of their own, and two such
    blocks of one component are not compared.
    """
    member = (family.withColumnRenamed("comp", "family").join(comp.withColumnRenamed("comp", "now"), "node", "left")
              .withColumn("now", F.coalesce("now", "node")))
    sizes = shared_table(member.groupBy("family", "now").agg(F.count(F.lit(1)).alias("c")), "jaccard-families", small=True)
    open_ones = sizes.groupBy("family").agg(F.count(F.lit(1)).alias("parts")).filter("parts > 1").select("family")
    big = sizes.filter(F.col("c") >= BLOCK_SETS).select("family", "now", F.col("now").alias("own"))
    steps = F.log(F.col("n")) / float(np.log(100 / percent))
    sized = (nodes.join(member, "node").join(open_ones, "family").join(big, ["family", "now"], "left")
             .select("node", "n", "toks", "cuts", "family", F.floor(steps + 1e-9).cast("int").alias("size_class"),
                     F.col("own").isNotNull().alias("whole"), F.coalesce("own", F.lit(0)).alias("own")))
    key = ["size_class", "whole", "own"]
    counts = shared_table(sized.groupBy("family", *key).agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_SETS, F.sum(F.size("toks")) / BLOCK_GRAMS)).cast("int")
        .alias("blocks")), "jaccard-blocks", small=True)
    sized = sized.join(counts, ["family", *key]).withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    ids = counts.select("family", *key, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    key = [*key, "block"]
    tiles = (ids.select("family", F.struct(*key).alias("i")).join(ids.select("family", F.struct(*key).alias("j")), "family")
             .filter((F.col("i") <= F.col("j")) & (F.col("j.size_class") - F.col("i.size_class") <= 1)
                     & ~(F.col("i.whole") & F.col("j.whole") & (F.col("i.own") == F.col("j.own")))))
    sides = tiles.select("family", "i", "j", F.col("i.*")).unionByName(
        tiles.filter("i <> j").select("family", "i", "j", F.col("j.*")))
    rows = (sides.join(sized, ["family", *key])
            .select("family", "i", "j", (F.struct(*key) == F.col("i")).alias("left"),
                    "node", "n", "toks", "cuts"))
    return arrow_groups(rows, ["family", "i", "j"], _tile_links(percent), "a long, b long")


def _tile_links(percent: int):
    """Links that connect the sets of two blocks (or of one) exactly as all their links would."""

    def run(key, batches):
        nodes, ns, left, toks, cuts = [], [], [], [], []
        for b in batches:
            b = pa.Table.from_batches([b]).combine_chunks()
            nodes.append(b.column("node").to_numpy())
            ns.append(b.column("n").to_numpy())
            left.append(b.column("left").to_numpy())
            toks += [np.asarray(x.values) for x in b.column("toks")]
            cuts += [np.asarray(x.values) for x in b.column("cuts")]
        node, n, left = np.concatenate(nodes), np.concatenate(ns).astype(np.int64), np.concatenate(left)
        order = np.lexsort((node, ~left))
        node, n, left = node[order], n[order], left[order]
        toks, cuts = [toks[i] for i in order], [cuts[i] for i in order]
        rows = np.arange(len(node))
        one, two = (rows[left], rows[~left]) if not left.all() else (rows, rows)
        overlap = np.zeros((len(one), len(two)), np.float32)
        for f in range(FRAGMENTS):
            overlap += _overlaps([toks[i][cuts[i][f]:cuts[i][f + 1]] for i in one],
                                 [toks[i][cuts[i][f]:cuts[i][f + 1]] for i in two])
        linked = overlap.astype(np.int64) * (100 + percent) >= (n[one][:, None] + n[two][None, :]) * percent
        label = rows.copy()
        while True:
            now = label.copy()
            np.minimum.at(now, one, np.where(linked, label[two][None, :], len(rows)).min(1))
            np.minimum.at(now, two, np.where(linked, label[one][:, None], len(rows)).min(0))
            now = now[now]
            if (now == label).all():
                break
            label = now
        joined = label != rows
        yield pa.RecordBatch.from_arrays([pa.array(node[joined]), pa.array(node[label[joined]])], ["a", "b"])

    return run


def _overlaps(one: list[np.ndarray], two: list[np.ndarray], width: int = 2048) -> np.ndarray:
    """How many values each array of ``one`` shares with each of ``two`` (values of an array are distinct)."""
    out = np.zeros((len(one), len(two)), np.float32)
    a, b = np.concatenate(one), np.concatenate(two)
    both = np.intersect1d(a, b)
    if not len(both):
        return out
    who_a, who_b = (np.repeat(np.arange(len(x)), [len(v) for v in x]) for x in (one, two))
    at_a, at_b = np.searchsorted(both, a), np.searchsorted(both, b)
    hit_a, hit_b = both[np.minimum(at_a, len(both) - 1)] == a, both[np.minimum(at_b, len(both) - 1)] == b
    at_a, who_a, at_b, who_b = at_a[hit_a], who_a[hit_a], at_b[hit_b], who_b[hit_b]
    for lo in range(0, len(both), width):
        span = min(width, len(both) - lo)
        m, w = np.zeros((len(one), span), np.float32), np.zeros((len(two), span), np.float32)
        mine = (at_a >= lo) & (at_a < lo + span)
        m[who_a[mine], at_a[mine] - lo] = 1
        mine = (at_b >= lo) & (at_b < lo + span)
        w[who_b[mine], at_b[mine] - lo] = 1
        out += m @ w.T
    return out


@dataclass
class JaccardLinks:
    """``rows``: every input row (doc_id, n_shingles, component_id); ``links``: verified pairs of classes (node
    ids) that connect the components; ``classes``: (doc_id, node, n) of every row; ``comp``: (node, comp) of linked
    classes, comp the least node of the component."""

    rows: DataFrame
    links: DataFrame
    classes: DataFrame
    comp: DataFrame


def with_class(docs: DataFrame, name: str, text_col: str = "text", k: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with the class (node id) of each row's text as column ``name``; 0 for a text without n-grams."""

    def run(batches):
        for batch in batches:
            nodes = np.array([set_digest(grams) for grams in text_sets(batch, text_col, k)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nodes)], [*batch.schema.names, name])

    return arrow_map(docs, run, T.StructType(list(docs.schema.fields)).add(name, "long"))


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 k: int = SHINGLE_WORDS, percent: int = PERCENT) -> JaccardLinks:
    """Link texts whose n-gram sets have a Jaccard similarity of ``percent`` / 100 or more."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    parts = parts_for(text_bytes(docs), PART_BYTES, LEAST_PARTS)
    dealt = arrow_map(docs, _deal("doc_id", "text", k, parts, _common(docs, k)), _PACKED)
    common = arrow_groups(dealt, "part", _shared_grams(parts), _PACKED)
    sets = shared_table(arrow_groups(common, "part", _candidates(percent), _SETS), "jaccard-sets")
    classes = sets.filter(F.col("head").isNull()).select("doc_id", "node", "n")
    nodes = sets.filter(F.col("head").isNotNull()).select("node", "n", "head", "toks", "cuts")

    fragment = F.explode(F.transform(F.sequence(F.lit(0), F.lit(FRAGMENTS - 1)), lambda f: F.struct(
        f.alias("f"), F.slice("toks", F.element_at("cuts", f + 1) + 1,
                              F.element_at("cuts", f + 2) - F.element_at("cuts", f + 1)).alias("toks"))))
    segments = nodes.select("node", fragment.alias("s")).select("node", "s.f", "s.toks").filter(F.size("toks") > 0)
    prefix = nodes.select("node", "n", F.explode(F.slice("toks", F.lit(1), F.col("head"))).alias("t"))

    groups = shared_table(prefix.groupBy("t").agg(F.min(F.struct("node", "n")).alias("lead"),
                                                  F.count(F.lit(1)).alias("c")).filter("c > 1"), "jaccard-groups")
    heads = groups.select("t", F.col("lead.node").alias("v"), F.col("lead.n").alias("nv"))
    star = _pair(prefix.withColumnsRenamed({"node": "u", "n": "nu"}).join(heads, "t"), percent)
    links = shared_table(_linked(star, segments, percent), "jaccard-links")
    comp = components(links)

    few = prefix.join(groups.filter(F.col("c") <= SMALL_GROUP).select("t"), "t")
    few = shared_table(few.join(comp, "node", "left").select("t", "node", "n", F.coalesce("comp", "node").alias("comp")),
                       "jaccard-prefix")
    cross = few.withColumnsRenamed({"node": "u", "n": "nu", "comp": "cu"}).join(
        few.withColumnsRenamed({"node": "v", "n": "nv", "comp": "cv"}), "t").filter(
        (F.col("cu") < F.col("cv")) & _near_size("nu", "nv", percent))
    links = links.unionByName(shared_table(_linked(_pair(cross, percent), segments, percent), "jaccard-links"))

    many = groups.filter(F.col("c") > SMALL_GROUP).select("t", F.col("lead.node").alias("b"))
    if not many.isEmpty():
        family = components(prefix.join(many, "t").select(F.col("node").alias("a"), "b").distinct())
        links = links.unionByName(shared_table(_family_links(nodes, family, comp, percent), "jaccard-links"))
    comp = components(links)

    labelled = classes.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    # written, so that a component with very many rows can be split in the join
    least = shared_table(labelled.filter("n > 0").groupBy("comp").agg(F.min("doc_id").alias("component_id")),
                         "jaccard-least", small=True)
    rows = (labelled.join(least, "comp", "left")
            .select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))
    return JaccardLinks(rows, links, classes, comp)
