"""Near-duplicate vectors of one label by cross-polytope hashing.

1. Equal vectors of a label become one node with its row count.
2. A node's vector is rotated at random (three rounds of random signs and a fast
   Hadamard transform); its hash is the axis and sign nearest to the rotated
   vector. ``hashes`` of them make a bucket. In each of the tables a node has a home
   bucket and ``PROBES`` more, in which the axis that was chosen by the least margin gives
   way to a next best one. Two nodes meet in a bucket that is the home of one of them
   and the home or a probe of the other.
3. Only buckets of several nodes go on. A bucket of more than ``BLOCK`` nodes is
   cut into blocks, every pair of blocks is a tile of its own; a task takes a part of the
   tiles by hash, about ``PART`` rows of them. A tile's cosines are one
   matrix product in double precision; those next to the threshold are computed again
   component by component. A pair that meets several times counts in the first
   bucket where it does, which every tile can tell from the two nodes' buckets.
   A tile gives its nodes' sums of linked rows and as many links as connect
   what it found, never the pairs.

The number of hashes follows from the nodes of the largest label (about ``FILL``
unrelated nodes to a bucket), the number of tables from the hashes, so that a pair at
the threshold is missed with a chance of about ``MISS`` (see ``chance``). Rotations depend on
table, hash and dimension only. Pairs that are found are exact.

Rows: vectors that are null, empty, all zero or hold a null or non-finite
component, and rows with a null label or id, link with nothing: their component is
their own id, and they are kept. Vectors of different lengths don't link. Every row
counts, so equal rows link with each other, also under one id. Extra columns aren't read.
An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .nearest import _valid, cosine
from .shared import arrow_groups, arrow_map, parts_for, shared_table

THRESHOLD = 0.98
PROBES = 2
FILL = 64
MISS = 1e-6
BLOCK = 2048
PART = 50_000          # tile rows behind one part
SAFE = 1e-9            # cosines this near to the threshold are computed again

_ROW = "id long, label string, dim int, vec binary"
_NODE = "node string, label string, dim int, vec binary, many long, home array<long>, probes array<long>"
_NODES = [f.split()[0] for f in _NODE.split(", ")]


def chance(threshold: float, dim: int) -> float:
    """A low estimate of how often two vectors at the threshold agree on one hash or by its probes.

    Powers of it stay below what is measured for cosines of 0.98 and up, 8 to 768 dimensions and
    up to three hashes (tests); for much lower thresholds measure first.
    """
    tau2 = 2 - 2 * threshold
    return math.exp(-tau2 / (4 - tau2) * math.log(2 * max(2, dim))) * 0.9


def plan(nodes: int, dim: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """(hashes, tables) for labels of so many nodes at most."""
    hashes = max(1, math.ceil(math.log(max(nodes, 2) / FILL, 2 * max(dim, 2))))
    return hashes, max(4, math.ceil(math.log(MISS) / math.log(1 - chance(threshold, dim) ** hashes)))


def rotated(x: np.ndarray, seed: list[int]) -> np.ndarray:
    """Rows of ``x``, padded to a power of two (32 at least), after three rounds of signs and Hadamard transforms."""
    size = max(32, 1 << (x.shape[1] - 1).bit_length())
    y = np.zeros((len(x), size))
    y[:, :x.shape[1]] = x
    rng = np.random.default_rng([size, *seed])
    for _ in range(3):
        y *= rng.choice([-1.0, 1.0], size)
        step = 1
        while step < size:
            z = y.reshape(len(y), -1, 2, step)
            y = np.stack([z[:, :, 0] + z[:, :, 1], z[:, :, 0] - z[:, :, 1]], axis=2).reshape(len(y), size)
            step *= 2
        y /= math.sqrt(size)
    return y


def buckets(x: np.ndarray, hashes: int, tables: int) -> tuple[np.ndarray, np.ndarray]:
    """Home buckets (rows x tables) and probes (rows x tables x PROBES) of vectors, as 64-bit numbers."""
    rows = np.arange(len(x))[:, None]
    home = np.zeros((len(x), tables), np.uint64)
    probes = np.zeros((len(x), tables, PROBES), np.uint64)
    for t in range(tables):
        code = np.full(len(x), t, np.uint64)
        margins, changes = [], []          # of all single changes of an axis
        for h in range(hashes):
            y = rotated(x, [t, h])
            size = np.abs(y)
            axes = np.empty((len(x), PROBES + 1), np.int64)
            for p in range(PROBES + 1):
                axes[:, p] = size.argmax(1)
                if p:
                    margins.append(top - size[rows[:, 0], axes[:, p]])
                else:
                    top = size[rows[:, 0], axes[:, 0]].copy()
                size[rows[:, 0], axes[:, p]] = -1
            place = np.uint64(pow(0x9E3779B97F4A7C15, t * hashes + h + 1, 1 << 64))
            number = (2 * axes + (y[rows, axes] < 0) + 1).astype(np.uint64) * place
            code += number[:, 0]
            changes += [number[:, p] - number[:, 0] for p in range(1, PROBES + 1)]
        best = np.argsort(np.stack(margins, 1), axis=1, kind="stable")[:, :PROBES]
        home[:, t] = _mixed(code)
        probes[:, t] = _mixed(code[:, None] + np.stack(changes, 1)[rows, best])
    return home, probes


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


# ---------------------------------------------------------------- rows to nodes

def _rows(batches):
    """The vectors' bytes; minus zero is zero."""
    for batch in batches:
        vec = batch.column("vec")
        kind = np.float32 if pa.types.is_float32(vec.type.value_type) else np.float64
        lens = pc.list_value_length(vec).to_numpy(zero_copy_only=False).astype(np.int32)
        flat = np.asarray(vec.flatten()).astype(kind) + kind(0)
        cut = np.concatenate([[0], np.cumsum(lens)])
        cells = [flat[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(lens), pa.array(cells, pa.binary())],
                                         ["id", "label", "dim", "vec"])


def _values(cells: pa.Array, dim: int) -> np.ndarray:
    """Vectors of one length as doubles."""
    data = b"".join(cells.to_pylist())
    return np.frombuffer(data, np.float32 if len(data) == 4 * dim * len(cells) else np.float64).reshape(-1, dim).astype(np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _with_buckets(plans: dict[int, tuple[int, int]]):
    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for dim in pc.unique(batch.column("dim")).to_pylist():
                part = table.filter(pc.equal(table["dim"], dim)).combine_chunks()
                home, probes = buckets(_unit(_values(part["vec"].combine_chunks(), dim)), *plans[dim])
                lists = [pa.array(list(x.reshape(len(x), -1).view(np.int64)), pa.list_(pa.int64())) for x in (home, probes)]
                yield pa.RecordBatch.from_arrays([*(part[c].combine_chunks() for c in _NODES[:-2]), *lists], _NODES)

    return run


# ---------------------------------------------------------------- tiles

def _first_meeting(home: np.ndarray, probes: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The first bucket, by table and number, in which nodes x and y meet (they do in one at least)."""
    out = np.zeros(len(x), np.int64)
    open_ = np.arange(len(x))
    for t in range(home.shape[1]):
        a, b = home[x[open_], t], home[y[open_], t]
        least = np.iinfo(np.int64).max
        mine = np.where((a == b) | (probes[y[open_], t] == a[:, None]).any(1), a, least)
        other = np.where((probes[x[open_], t] == b[:, None]).any(1), b, least)
        first = np.minimum(mine, other)
        met = first < least
        out[open_[met]] = first[met]
        open_ = open_[~met]
        if not len(open_):
            break
    return out


def _spanning(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For n nodes and links x-y: each node's representative."""
    label = np.arange(n)
    while True:
        least = label.copy()
        np.minimum.at(least, x, label[y])
        np.minimum.at(least, y, label[x])
        least = np.minimum(least, least[least])
        if (least == label).all():
            return label
        label = least


def _tiles(threshold: float):
    """All tiles of a part; (node, up, linked) of the nodes with links, ``up`` being a node that it is connected with."""

    def run(key, batches):
        table = pa.Table.from_batches(list(batches)).combine_chunks()
        for dim in pc.unique(table["dim"]).to_pylist():
            part = table.filter(pc.equal(table["dim"], dim)).combine_chunks()
            label = part["label"].combine_chunks().dictionary_encode().indices.to_numpy()
            code, i, j, block, many = (part[c].to_numpy() for c in ("code", "i", "j", "block", "many"))
            raw = _values(part["vec"].combine_chunks(), dim)
            unit = _unit(raw)
            home, probes = (np.asarray(part[c].combine_chunks().flatten()).reshape(len(raw), -1) for c in ("home", "probes"))
            probes = probes.reshape(*home.shape, -1)
            order = np.lexsort((block, j, i, code, label))
            new = np.zeros(len(order) + 1, bool)
            new[0] = new[-1] = True
            for column in (label, code, i, j):
                new[1:-1] |= np.diff(column[order]) != 0
            cuts = np.flatnonzero(new)
            up, linked = np.arange(len(raw)), np.zeros(len(raw), np.int64)
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if b - a > 1:
                    rows = order[a:b]
                    _tile(rows, block[rows], threshold, raw, unit, home, probes, code[rows[0]], many, up, linked)
            hit = np.flatnonzero(linked)
            names = part["node"].combine_chunks()
            yield pa.RecordBatch.from_arrays([names.take(pa.array(hit)), names.take(pa.array(up[hit])), pa.array(linked[hit])],
                                             ["node", "up", "linked"])

    return run


def _tile(rows, block, threshold, raw, unit, home, probes, code, many, up, linked) -> None:
    """Links of one tile: into ``linked`` (linked rows) and ``up`` (a connected row)."""
    one = block[0] == block[-1]                      # rows come in order of their block
    middle = 0 if one else int(np.searchsorted(block, block[0], "right"))
    left, right = (rows, rows) if one else (rows[:middle], rows[middle:])
    held = np.zeros((2, 0), np.int64)
    for a in range(0, len(left), 512):
        near = unit[left[a:a + 512]] @ unit[right].T
        x, y = np.nonzero(near >= threshold - SAFE)
        if one:
            after = x + a < y
            x, y = x[after], y[after]
        if not len(x):
            continue
        value = near[x, y]
        x, y = left[x + a], right[y]
        close = np.flatnonzero(value < threshold + SAFE)
        if len(close):
            good = np.ones(len(x), bool)
            good[close] = cosine(raw[x[close]], raw[y[close]]) >= threshold
            x, y = x[good], y[good]
        first = _first_meeting(home, probes, x, y) == code
        x, y = x[first], y[first]
        np.add.at(linked, x, many[y])
        np.add.at(linked, y, many[x])
        # what connects them is enough from here on
        every, place = np.unique(np.concatenate([held, [x, y]], axis=1), return_inverse=True)
        least = every[_spanning(len(every), *place.reshape(2, -1))]
        held = np.stack([every, least])[:, every != least]
    up[held[0]] = held[1]


def _meetings(nodes: DataFrame) -> DataFrame:
    """(part, label, dim, code, i, j, block, node): the nodes of every tile, and the part that the tile belongs to."""
    places = nodes.select("label", "dim", "node", F.explode(F.concat(
        F.transform("home", lambda c: F.struct(c.alias("code"), F.lit(1).alias("at_home"))),
        F.transform("probes", lambda c: F.struct(c.alias("code"), F.lit(0).alias("at_home"))))).alias("__p"))
    places = shared_table(places.select("label", "dim", "node", "__p.*"), "places")
    busy = places.groupBy("label", "dim", "code").agg(F.count(F.lit(1)).alias("n"), F.max("at_home").alias("homes"))
    busy = busy.filter("n > 1 and homes = 1").select("label", "dim", "code", "n", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    busy = shared_table(busy, "busy")
    parts = parts_for(busy.agg(F.sum(F.col("n") * F.col("blocks"))).first()[0] or 0, PART)
    placed = places.join(busy, ["label", "dim", "code"]).withColumn(
        "block", F.pmod(F.xxhash64("node", "code"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = placed.select("label", "dim", "code", "node", "block", other.alias("other"))
    placed = placed.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other")
    return placed.withColumn("part", F.pmod(F.xxhash64("label", "dim", "code", "i", "j"), F.lit(parts)))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label") -> DataFrame:
    """(``id_col``, n_links, component_id, kept) of every row: the rows of its label within ``threshold`` by cosine,
    the smallest id it is connected with, and whether that is its own."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                          F.col(vec_col).alias("vec"))
    able = F.coalesce(F.col("id").isNotNull() & F.col("label").isNotNull() & _valid(F.col("vec")), F.lit(False))
    alone = rows.filter(~able).select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
                                      F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    node = F.md5(F.concat(F.encode(F.concat_ws(":", F.length("label"), "label", "dim"), "UTF-8"), "vec"))
    rows = arrow_map(rows.filter(able), _rows, _ROW).withColumn("node", node)
    members = shared_table(rows.select("id", "node"), "members")
    nodes = shared_table(rows.groupBy("node", "label", "dim", "vec").agg(F.count(F.lit(1)).alias("many"),
                                                                        F.min("id").alias("least")), "nodes")
    sizes = nodes.groupBy("label", "dim").count().groupBy("dim").agg(F.max("count").alias("most")).collect()
    plans = {r["dim"]: plan(r["most"], r["dim"], threshold) for r in sizes}  # a row for each length of vectors
    coded = shared_table(arrow_map(nodes.select(*_NODES[:-2]), _with_buckets(plans), _NODE), "coded")
    tiles = _meetings(coded).join(coded.drop("label", "dim"), "node")
    found = arrow_groups(tiles, "part", _tiles(threshold), "node string, up string, linked long")
    found = shared_table(found, "found")
    links = found.filter("node <> up").select(F.col("node").alias("a"), F.col("up").alias("b"))
    comp = components(links)
    least = nodes.select("node", "least").join(comp, "node").groupBy("comp").agg(F.min("least").alias("first"))
    comp = comp.join(least, "comp").select("node", "first")
    linked = found.groupBy("node").agg(F.sum("linked").alias("linked"))
    known = nodes.select("node", "many", "least").join(linked, "node", "left").join(comp, "node", "left")
    known = known.select("node", (F.col("many") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
                         F.coalesce("first", "least").alias("component_id"))
    known = shared_table(known, "linked")
    out = members.join(known, "node", "left").select(F.col("id").alias(id_col), "n_links", "component_id",
                                                     (F.col("id") == F.col("component_id")).alias("kept"))
    return out.unionByName(alone)
