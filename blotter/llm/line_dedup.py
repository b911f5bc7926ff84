"""Incremental line dedup: exact reference counts behind sharded cuckoo filters.

A line's key is the line without ASCII white space at its ends, A-Z in lower
case. ``LineIndex`` keeps, in a shared folder, a log of reference-count changes
(how many documents hold a key) and one chain of cuckoo filters per shard with
the keys that ``min_docs`` or more documents hold. ``insert`` and ``delete``
change both, so removing a document takes its lines' counts back, and a line may
return to the documents that still hold it.

``apply`` probes the filters, so that only likely hits (and about one in a
thousand others) go on; the exact counts decide. Filters of up to
``BROADCAST_BYTES`` go to the tasks that scan the texts; above that, the keys go to
their shard and are probed there. Keys with more than a shard's share of all
reference counts are spread over several tasks, by those counts.

Rows: a null or empty text is one empty line and stays so (null becomes empty);
blank keys are never dropped. Rows with equal ids are one document for the
counts (null ids together are one); every row is rewritten by itself. Columns
named ``n_lines`` or ``n_dropped`` in the input are replaced.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .shared import arrow_groups, arrow_map, parts_for, text_bytes
from .text import mix64

MIN_DOCS = 10
SHARD_BYTES = 64 << 20          # text bytes behind one shard
BROADCAST_BYTES = 64 << 20      # filters above this size are not sent: the keys go to them
HOT_PARTS = (64, 1 << 20)       # a key is hot above one such part of all counts: as many as shards, within these
_SLOTS = 4
_KICKS = 200
_KEYS = "__line_keys"

_FILTER = "shard int, filter binary"
_CHANGES = "shard int, hi long, lo long, docs long"


class CuckooChain:
    """Cuckoo filters of 16-bit fingerprints, four to a bucket; a full one is followed by a larger one.

    Only keys that were added may be removed (the exact counts see to that).
    """

    def __init__(self, tables: list[np.ndarray] | None = None):
        self.tables = tables or []

    @staticmethod
    def _places(keys: np.ndarray, buckets: int):
        keys = np.asarray(keys, np.uint64)
        mark = (keys >> np.uint64(48)).astype(np.uint16) | np.uint16(1)
        at = (mix64(keys) % np.uint64(buckets)).astype(np.int64)
        other = at ^ (mix64(mark.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        return mark, at, other

    def contains(self, keys: np.ndarray) -> np.ndarray:
        found = np.zeros(len(keys), bool)
        for t in self.tables:
            mark, at, other = self._places(keys, len(t))
            found |= (t[at] == mark[:, None]).any(1) | (t[other] == mark[:, None]).any(1)
        return found

    def add(self, keys: np.ndarray) -> None:
        keys = np.asarray(keys, np.uint64)
        while len(keys):
            if self.tables:
                keys = self._fill(self.tables[-1], keys)
            if len(keys):
                need = max(len(keys) / (_SLOTS * 0.8), 2 * len(self.tables[-1]) if self.tables else 16)
                self.tables.append(np.zeros((1 << int(np.ceil(np.log2(need))), _SLOTS), np.uint16))

    def _fill(self, table: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Add keys until one finds no place; that key and the rest come back."""
        mark, at, other = self._places(keys, len(table))
        jump = (mix64(np.arange(1 << 16, dtype=np.uint64)) % np.uint64(len(table))).astype(np.int64)
        for i, (m, a, b) in enumerate(zip(mark.tolist(), at.tolist(), other.tolist())):
            path = []
            spot = a if (table[a] == 0).any() else b
            for kick in range(_KICKS):
                free = np.flatnonzero(table[spot] == 0)
                if len(free):
                    table[spot, free[0]] = m
                    break
                slot = (spot + kick) % _SLOTS
                path.append((spot, slot, m))
                m, table[spot, slot] = int(table[spot, slot]), m
                spot ^= int(jump[m])
            else:
                for spot, slot, put in reversed(path):  # undo: the displaced marks go back
                    m, table[spot, slot] = put, m
                return keys[i:]
        return keys[:0]

    def remove(self, keys: np.ndarray) -> None:
        for key in np.asarray(keys, np.uint64):
            for t in reversed(self.tables):
                mark, at, other = (x[0] for x in self._places(np.array([key]), len(t)))
                spot = next((s for s in (at, other) if (t[s] == mark).any()), None)
                if spot is not None:
                    t[spot, np.flatnonzero(t[spot] == mark)[0]] = 0
                    break

    def to_bytes(self) -> bytes:
        head = np.array([len(self.tables), *map(len, self.tables)], np.int32)
        return head.tobytes() + b"".join(t.tobytes() for t in self.tables)

    @classmethod
    def from_bytes(cls, raw: bytes) -> CuckooChain:
        count = int(np.frombuffer(raw, np.int32, 1)[0])
        sizes = np.frombuffer(raw, np.int32, count, 4).tolist()
        tables, at = [], 4 * (count + 1)
        for n in sizes:
            tables.append(np.frombuffer(raw, np.uint16, n * _SLOTS, at).reshape(n, _SLOTS).copy())
            at += 2 * n * _SLOTS
        return cls(tables)


def line_digests(text: bytes) -> tuple[list[bytes], list[bytes | None]]:
    """The lines and the 16-byte digest of each key (None for a blank one)."""
    lines = text.split(b"\n")
    out = []
    for line in lines:
        key = line.strip().lower()
        out.append(blake2b(key, digest_size=16).digest() if key else None)
    return lines, out


def _sliced(batches, rows: int = 1000):
    """Smaller batches: a task holds the lines of so many texts at once."""
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)


def _texts(batch: pa.RecordBatch, column: str):
    return (b"" if t is None else t for t in batch.column(column).cast(pa.binary()).to_pylist())


def _key_rows(id_col: str, text_col: str, filters=None, shards: int = 1):
    """(id, hi, lo) of the distinct keys of each row; with filters, only of keys that these may hold."""

    def run(batches):
        chains = None
        if filters is not None:
            chains = {s: CuckooChain.from_bytes(b) for s, b in filters.value.items()}
        for batch in _sliced(batches):
            ids = batch.column(id_col)
            rows, keys = [], []
            for i, text in enumerate(_texts(batch, text_col)):
                mine = {d for d in line_digests(text)[1] if d is not None}
                keys.extend(mine)
                rows.extend([i] * len(mine))
            both = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            rows = np.array(rows, np.int64)
            if chains is not None:
                shard = _shard(both[:, 1], shards)
                hit = np.zeros(len(rows), bool)
                for s in np.unique(shard):
                    if s in chains:
                        at = np.flatnonzero(shard == s)
                        hit[at] = chains[s].contains(both[at, 0].view(np.uint64))
                rows, both = rows[hit], both[hit]
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(rows)), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())],
                ["id", "hi", "lo"])

    return run


def _shard(lo: np.ndarray, shards: int) -> np.ndarray:
    return (np.asarray(lo) % shards).astype(np.int32)


def _update(key, batches):
    """One shard's filters with the keys that crossed the threshold."""
    shard, chain, add, drop = key[0].as_py(), CuckooChain(), [], []
    for batch in batches:
        for r in batch.to_pylist():
            if r["filter"] is not None:
                chain = CuckooChain.from_bytes(r["filter"])
            else:
                (add if r["sign"] > 0 else drop).append(r["hi"])
    chain.remove(np.sort(np.array(drop, np.int64)).view(np.uint64))
    chain.add(np.sort(np.array(add, np.int64)).view(np.uint64))
    yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([chain.to_bytes()], pa.binary())],
                                     ["shard", "filter"])


def _probe(key, batches):
    """The keys of one shard that its filters may hold; hot keys (in groups below 0) are known and go on as they are."""
    names = ["id", "hi", "lo", "lane"]
    chain, held = None, []
    for batch in batches:
        keys = batch.filter(batch.column("hi").is_valid())
        for raw in batch.column("filter").drop_null():
            chain = CuckooChain.from_bytes(raw.as_py())
        if key[0].as_py() < 0:
            yield keys.select(names)
        else:
            held.append(keys)  # a shard's keys wait for its filters
    for keys in held if chain else ():
        yield keys.filter(pa.array(chain.contains(np.asarray(keys.column("hi")).view(np.uint64)))).select(names)


class LineIndex:
    """The lines of a changing corpus. ``path`` must be in a folder that all executors share.

    Every change writes new files and a manifest under the next version, so an
    index can be opened again at any ``version``, also one before the last
    (with the same ``min_docs`` and ``shards``).
    """

    def __init__(self, spark: SparkSession, path: str, min_docs: int = MIN_DOCS, shards: int = 16,
                 id_col: str = "doc_id", text_col: str = "text", version: int = 0):
        self.spark, self.path, self.min_docs, self.shards = spark, path.rstrip("/"), min_docs, shards
        self.id_col, self.text_col = id_col, text_col
        self.version, self.logs = version, []
        if version:
            manifest = spark.read.schema("log string").parquet(f"{self.path}/manifest-{version}")
            self.logs = sorted(row["log"] for row in manifest.collect())

    def _keys(self, docs: DataFrame, filters=None) -> DataFrame:
        kind = docs.schema[self.id_col].dataType
        schema = T.StructType().add("id", kind).add("hi", "long").add("lo", "long")
        return arrow_map(docs.select(self.id_col, self.text_col),
                         _key_rows(self.id_col, self.text_col, filters, self.shards), schema)

    def counts(self) -> DataFrame:
        """(shard, hi, lo, docs): in how many documents each key is, exactly."""
        if not self.logs:
            return self.spark.createDataFrame([], _CHANGES)
        log = self.spark.read.schema(_CHANGES).parquet(*[f"{self.path}/{name}" for name in self.logs])
        if len(self.logs) > 1:
            log = log.groupBy("shard", "hi", "lo").agg(F.sum("docs").alias("docs"))
        return log.filter("docs > 0")

    def blocked(self) -> DataFrame:
        return self.counts().filter(F.col("docs") >= self.min_docs)

    def insert(self, docs: DataFrame) -> None:
        """Count the lines of documents that the index doesn't hold yet."""
        self._change(docs, 1)

    def delete(self, docs: DataFrame) -> None:
        """Take back documents (with the texts they were inserted with)."""
        self._change(docs, -1)

    def compact(self) -> None:
        """Replace the log by one table of the present counts (older versions stay readable)."""
        new = self.version + 1
        self.counts().write.parquet(f"{self.path}/changes-{new}")
        self.filters().write.parquet(f"{self.path}/filters-{new}")
        self._commit(new, [f"changes-{new}"])

    def _commit(self, version: int, logs: list[str]) -> None:
        rows = self.spark.createDataFrame([(name,) for name in logs], "log string")
        rows.coalesce(1).write.parquet(f"{self.path}/manifest-{version}")
        self.version, self.logs = version, logs

    def _change(self, docs: DataFrame, sign: int) -> None:
        shard = F.pmod(F.col("lo"), F.lit(self.shards)).cast("int").alias("shard")
        per_doc = self._keys(docs).distinct()
        change = (per_doc.groupBy("hi", "lo").agg((F.count(F.lit(1)) * sign).alias("docs"))
                  .select(shard, "hi", "lo", "docs"))
        old, old_filters = self.counts(), self.filters()
        new = self.version + 1
        change.write.parquet(f"{self.path}/changes-{new}")
        change = self.spark.read.schema(_CHANGES).parquet(f"{self.path}/changes-{new}")
        if self.version:
            was = change.join(old.withColumnRenamed("docs", "was"), ["shard", "hi", "lo"], "left")
            was = was.withColumn("was", F.coalesce("was", F.lit(0)))
        else:
            was = change.withColumn("was", F.lit(0).cast("long"))
        now = F.col("was") + F.col("docs")
        crossed = (was.withColumn("sign", F.when((F.col("was") < self.min_docs) & (now >= self.min_docs), 1)
                                  .when((F.col("was") >= self.min_docs) & (now < self.min_docs), -1))
                   .filter("sign is not null").select("shard", "hi", "sign", F.lit(None).cast("binary").alias("filter")))
        none = F.lit(None)
        rows = crossed.unionByName(old_filters.select(
            "shard", none.cast("long").alias("hi"), none.cast("int").alias("sign"), "filter"))
        arrow_groups(rows, "shard", _update, _FILTER).write.parquet(f"{self.path}/filters-{new}")
        self._commit(new, [*self.logs, f"changes-{new}"])

    def filters(self) -> DataFrame:
        """(shard, filter) of the present version."""
        if not self.version:
            return self.spark.createDataFrame([], _FILTER)
        return self.spark.read.schema(_FILTER).parquet(f"{self.path}/filters-{self.version}")

    def _sent_filters(self):
        """The filters for all tasks, if they are small enough to send; else None."""
        size = self.filters().agg(F.sum(F.octet_length("filter"))).first()[0] or 0
        if size > BROADCAST_BYTES:
            return None
        return self.spark.sparkContext.broadcast({r["shard"]: bytes(r["filter"]) for r in self.filters().collect()})

    def _lanes(self):
        """How many tasks share a key, by its count: one for each part of all counts that it fills."""
        total = None
        if self.logs:
            log = self.spark.read.schema(_CHANGES).parquet(*[f"{self.path}/{name}" for name in self.logs])
            total = log.agg(F.sum("docs")).first()[0]
        parts = min(max(self.shards, HOT_PARTS[0]), HOT_PARTS[1])
        return F.ceil(F.col("docs") * parts / F.lit(float(total or 1))).cast("int"), parts

    def _likely(self, docs: DataFrame, hot: DataFrame, parts: int) -> DataFrame:
        """(id, hi, lo, lane) of the keys that the filters may hold."""
        sent = self._sent_filters()
        keys = self._keys(docs, sent).join(F.broadcast(hot), ["hi", "lo"], "left")  # fewer than ``parts`` rows
        keys = keys.withColumn("lane", F.coalesce(F.pmod(F.xxhash64("id"), "lanes"), F.lit(0)).cast("int"))
        if sent is not None:
            return keys.select("id", "hi", "lo", "lane")
        known = -1 - F.pmod(F.xxhash64("hi", "lo", "lane"), F.lit(parts))
        shard = F.when(F.col("lanes").isNotNull(), known).otherwise(F.pmod("lo", F.lit(self.shards))).cast("int")
        rows = keys.select(shard.alias("shard"), "id", "hi", "lo", "lane").unionByName(
            self.filters(), allowMissingColumns=True)
        kind = docs.schema[self.id_col].dataType
        schema = T.StructType().add("id", kind).add("hi", "long").add("lo", "long").add("lane", "integer")
        return arrow_groups(rows, "shard", _probe, schema)

    def apply(self, docs: DataFrame) -> DataFrame:
        """``docs`` without the lines that too many documents hold, with ``n_lines`` and ``n_dropped``."""
        docs = docs.drop("n_lines", "n_dropped")
        lanes, parts = self._lanes()
        blocked = self.blocked().select("hi", "lo", lanes.alias("lanes"))
        copies = blocked.select("hi", "lo", F.explode(F.sequence(F.lit(0), F.col("lanes") - 1)).alias("lane"))
        likely = self._likely(docs, blocked.filter("lanes > 1"), parts)
        sure = likely.join(copies, ["hi", "lo", "lane"], "left_semi")
        keys = sure.groupBy("id").agg(F.collect_set(F.struct("hi", "lo")).alias(_KEYS))
        joined = docs.join(keys, docs[self.id_col].eqNullSafe(keys["id"]), "left").drop(keys["id"])
        schema = T.StructType([f if f.name != self.text_col else T.StructField(f.name, T.StringType())
                               for f in docs.schema.fields]).add("n_lines", "long").add("n_dropped", "long")
        return arrow_map(joined, _rewrite(self.text_col, docs.columns), schema)


def _rewrite(text_col: str, columns: list[str]):
    def run(batches):
        for batch in _sliced(batches):
            kept, total, gone = [], [], []
            at = batch.schema.get_field_index(_KEYS)
            for text, keys in zip(_texts(batch, text_col), batch.column(at).to_pylist()):
                if not keys:
                    kept.append(text)
                    total.append(text.count(b"\n") + 1)
                    gone.append(0)
                    continue
                drop = {np.array([k["hi"], k["lo"]], np.int64).tobytes() for k in keys}
                lines, digests = line_digests(text)
                stay = [x for x, d in zip(lines, digests) if d not in drop]
                kept.append(b"\n".join(stay))
                total.append(len(lines))
                gone.append(len(lines) - len(stay))
            out = [pa.array(kept, pa.binary()).cast(pa.string()) if c == text_col else batch.column(i)
                   for i, c in enumerate(columns)]
            yield pa.RecordBatch.from_arrays(out + [pa.array(total, pa.int64()), pa.array(gone, pa.int64())],
                                             [*columns, "n_lines", "n_dropped"])

    return run


def line_dedup(docs: DataFrame, min_docs: int = MIN_DOCS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Index ``docs`` and drop their lines found in ``min_docs`` documents or more, in every document."""
    spark = docs.sparkSession
    index = LineIndex(spark, scratch_path(spark, "line-index"), min_docs,
                      parts_for(text_bytes(docs, text_col), SHARD_BYTES, 16), id_col, text_col)
    index.insert(docs)
    return index.apply(docs)
