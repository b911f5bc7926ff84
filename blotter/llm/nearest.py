"""Nearest neighbours by a block matrix join over int8 tiles.

Vectors are scaled to length one and quantised to int8 with a scale of their
own. A task multiplies a block of queries with a block of candidates; the exact
norms of the quantisation errors bound how far each product is from the cosine.
Pairs whose upper bound reaches the k-th best lower bound of distinct ids (or the k-th best
score met before) are recomputed in double precision on the original vectors and
kept in one heap per query; the heaps of the tasks are merged at the end. The
result is exact.

Rows: vectors that are null, empty, all zero, or hold a null or non-finite
component take no part; neither do rows with a null id. Vectors are compared
with vectors of the same length. A row is never a neighbour of rows with its own
id. Repeated rows of a query id are one query (any of equal rows; of different
ones, the least vector); repeated candidate rows count once per id and score.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import arrow_groups, arrow_map, parts_for, shared_table

K = 5
QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 4096
LANE_BLOCKS = 8

_BLOCK = "dim int, ids binary, raw binary, codes binary, scales binary, errors binary"


def _valid(vec: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vec.isNotNull() & (F.size(vec) > 0) & F.forall(vec, finite) & F.exists(vec, lambda x: x != 0)


def _quantised(raw: np.ndarray):
    unit = raw / np.abs(raw).max(1, keepdims=True)
    unit /= np.sqrt((unit * unit).sum(1, keepdims=True))
    scale = np.abs(unit).max(1) / 127
    code = np.rint(unit / scale[:, None]).astype(np.int8)
    error = np.sqrt(((unit - scale[:, None] * code) ** 2).sum(1)) + 1e-12
    return code, scale, error


def _packed(ids: np.ndarray, raw: np.ndarray) -> list[pa.Array]:
    code, scale, error = _quantised(raw)
    return [pa.array([raw.shape[1]], pa.int32()),
            *(pa.array([x.tobytes()], pa.binary()) for x in (ids, raw, code, scale, error))]


def _blocks_of(ids: np.ndarray, vectors: pa.Array, size: int):
    """Arrays of a block row for every ``size`` vectors of one length."""
    lens = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    flat = np.asarray(vectors.flatten().cast(pa.float64()))
    at = np.cumsum(lens) - lens
    for dim in np.unique(lens):
        rows = np.flatnonzero(lens == dim)
        for a in range(0, len(rows), size):
            mine = rows[a:a + size]
            yield _packed(ids[mine], flat[at[mine][:, None] + np.arange(dim)])


_BLOCK_NAMES = [f.split()[0] for f in _BLOCK.split(", ")]


def _candidate_blocks(batches):
    for batch in batches:
        ids = np.asarray(batch.column("id"))
        for block in _blocks_of(ids, batch.column("vec"), CANDIDATE_BLOCK):
            yield pa.RecordBatch.from_arrays(block, _BLOCK_NAMES)


def _query_blocks(key, batches):
    batches = list(batches)
    ids = np.concatenate([np.asarray(b.column("id")) for b in batches])
    vectors = pa.concat_arrays([b.column("vec") for b in batches])
    for block in _blocks_of(ids, vectors, len(ids)):
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), *block], ["qb", *_BLOCK_NAMES])


def _read(r: dict, side: str):
    dim = r["dim"]
    get = lambda name, kind: np.frombuffer(r[side + name], kind)
    return (get("ids", np.int64), get("raw", np.float64).reshape(-1, dim), get("codes", np.int8).reshape(-1, dim),
            get("scales", np.float64), get("errors", np.float64))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, summed component by component, so that equal vectors score equally in any batch."""
    dot, na, nb = (np.zeros(len(a)) for _ in range(3))
    for d in range(a.shape[1]):
        x, y = a[:, d], b[:, d]
        dot += x * y
        na += x * x
        nb += y * y
    return dot / np.sqrt(na * nb)


def _tile(q, c, k: int, heaps: dict) -> None:
    """Put the candidates of one tile into the queries' heaps of (score, -id)."""
    q_ids, q_raw, q_code, q_scale, q_error = q
    c_ids, c_raw, c_code, c_scale, c_error = c
    kind = np.float32 if q_raw.shape[1] <= 1000 else np.float64  # products of codes stay exact
    product = (q_code.astype(kind) @ c_code.astype(kind).T).astype(np.float64)
    near = product * q_scale[:, None] * c_scale[None, :]
    slack = q_error[:, None] + (1 + q_error[:, None]) * c_error[None, :] + 1e-12
    near[q_ids[:, None] == c_ids[None, :]] = -np.inf
    low = _by_id(near - slack, c_ids)  # k rows of fewer ids may be fewer than k neighbours
    if low.shape[1] > k:
        floor = np.partition(low, low.shape[1] - k, 1)[:, low.shape[1] - k]
    else:
        floor = np.full(len(q_ids), -np.inf)
    met = np.array([heaps[i][0][0] if len(heaps.get(i, ())) == k else -np.inf for i in q_ids.tolist()])
    at_q, at_c = np.nonzero((near + slack >= np.maximum(floor, met)[:, None]) & (near > -np.inf))
    for a in range(0, len(at_q), 200_000):
        x, y = at_q[a:a + 200_000], at_c[a:a + 200_000]
        score = cosine(q_raw[x], c_raw[y])
        order = np.lexsort((c_ids[y], -score, x))
        x, y, score = x[order], y[order], score[order]
        first = _leading(x, c_ids[y], score, k)
        for i, s, j in zip(q_ids[x[first]].tolist(), score[first].tolist(), c_ids[y[first]].tolist()):
            heap = heaps.setdefault(i, [])
            if (s, -j) in heap:
                continue
            if len(heap) < k:
                heapq.heappush(heap, (s, -j))
            elif (s, -j) > heap[0]:
                heapq.heapreplace(heap, (s, -j))


def _by_id(low: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The largest bound of each distinct id."""
    order = np.argsort(ids, kind="stable")
    first = np.flatnonzero(np.diff(ids[order], prepend=ids[order[:1]] - 1))
    return low if len(first) == len(ids) else np.maximum.reduceat(low[:, order], first, axis=1)


def _leading(x: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Of rows sorted by query, score and id: the first ``k`` distinct (score, id) of each query."""
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (ids[1:] != ids[:-1]) | (score[1:] != score[:-1])
    number = np.cumsum(new)
    return new & (number - number[np.searchsorted(x, x)] < k)


def _tiles(k: int):
    def run(key, batches):
        heaps: dict[int, list] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                _tile(_read(r, "q_"), _read(r, ""), k, heaps)
        rows = [(q, -j, s) for q, heap in heaps.items() for s, j in heap]
        q, j, s = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(j, pa.int64()), pa.array(s, pa.float64())],
                                         ["query_id", "id", "score"])

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id",
            vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, ``id_col``, score): the ``k`` rows of ``vectors`` with the largest cosine to each query."""
    def clean(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec")).filter(
            F.col("id").isNotNull() & _valid(F.col(vec_col)))

    asked = clean(queries).groupBy("id").agg(F.min("vec").alias("vec"))
    blocks = parts_for(asked.count(), QUERY_BLOCK)
    asked = asked.withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    asked = shared_table(arrow_groups(asked, "qb", _query_blocks, "qb int, " + _BLOCK), "query-blocks")
    asked = asked.withColumnsRenamed({c: f"q_{c}" for c in _BLOCK_NAMES if c != "dim"})
    # every candidate block meets every query block; lanes cut a query block's candidates into groups of few blocks
    spread = -(-vectors.sparkSession.sparkContext.defaultParallelism * 4 // blocks)
    lanes = max(spread, parts_for(vectors.count(), CANDIDATE_BLOCK * LANE_BLOCKS))
    tiles = (arrow_map(clean(vectors), _candidate_blocks, _BLOCK)
             .withColumn("lane", F.pmod(F.xxhash64("ids"), F.lit(lanes)).cast("int"))
             .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    asked = asked.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    found = arrow_groups(tiles.join(asked, ["qb", "lane", "dim"]), ["qb", "lane"], _tiles(k),
                         "query_id long, id long, score double")
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (found.distinct().withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_col), "score"))
