"""Merkle manifest of a document table, with an inclusion proof for every row.

A row's leaf is the SHA-256 (lower-case hex) of its fields, each written as its
UTF-8 byte count, ``:`` and the value, or ``-`` if null. Within a source leaves
ascend by id (nulls first, equal ids by leaf); every 16 consecutive nodes, the
last ones possibly fewer, become the hash of their digests, until one is left:
the source's subroot. Subroots, ordered by source (null first, then by UTF-8
bytes), become the root in the same way.

How: rows get their place in their source from one range sort and a small table
of row counts for each partition. ``BLOCK`` = 16 x 16 consecutive nodes are a
block; its level is one string of 64 characters a node, of which fixed-width
substrings of 16 nodes are hashed to the next level's string, twice. The blocks'
roots, at their own places, are the next round's nodes, until every source has
one; the sources' subroots go through the same rounds. A node's siblings are the
substrings on either side of it in its run of 16. Proofs are put together from
the last round down: a block hands its own path to its nodes, so the leaves
themselves are shuffled twice, however many rounds there are. No task gets more
than ``BLOCK`` nodes of one source at a time, and only the number of
rounds (from the largest source's row count) comes to the driver.

Rows: every row is a leaf, repeated ones too (they take places next to each
other). Null ids come first in their source. Null and empty texts differ: ``-``
and ``0:``. Extra columns don't matter, as only ``FIELDS`` are read. A table of
one row has the leaf as its root and an empty proof; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import shared_table

FANOUT = 16
BLOCK = FANOUT * FANOUT
HEX = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(x: Column) -> Column:
    return F.sha2(x, 256)


def leaf_of(fields: list[Column]) -> Column:
    """The digest of a row's fields."""
    def written(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return sha(F.concat(*(written(f) for f in fields)))


def _placed(rows: DataFrame, key: str, order: list[str]) -> tuple[DataFrame, int]:
    """``rows`` with ``pos``, the place (from 0) within equal ``key`` (nulls are equal) in the order of ``order``,
    and ``many``, the rows of the key; and the largest ``many``.

    One range sort over the whole table; a key of any size is spread over many
    partitions. A partition's rows of a key are consecutive, so a row's place is
    its index in the partition plus the key's rows in the partitions before.
    """
    by = [F.asc_nulls_first(c) for c in (key, *order)]
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    seat = F.monotonically_increasing_id()
    ranged = shared_table(ranged.withColumns({"__part": F.shiftright(seat, 33), "__seat": seat}), "ranged")
    parts = ranged.groupBy(key, "__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__seat").alias("__first"))
    before = W.partitionBy(key).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select(F.col(key).alias("__key"), F.col("__part").alias("__p"), "__first",
                         F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
                         F.sum("__n").over(W.partitionBy(key)).alias("many"))
    parts = shared_table(parts, "offsets", small=True)
    at = (F.col("__part") == F.col("__p")) & F.col(key).eqNullSafe(F.col("__key"))
    placed = (ranged.join(parts, at).withColumn("pos", F.col("__before") + F.col("__seat") - F.col("__first"))
              .drop("__key", "__p", "__first", "__before", "__part", "__seat"))
    return placed, parts.agg(F.max("many")).first()[0] or 0


def _slots(level: Column, start: Column, nodes: Column) -> Column:
    """``nodes`` nodes of a level's string, from node ``start`` on (from 0)."""
    return F.substring(level, (start * HEX + 1).cast("int"), (nodes * HEX).cast("int"))


def _parents(level: str) -> Column:
    """The next level's string: the digest of each fixed-width run of 16 nodes."""
    runs = F.ceil(F.octet_length(level) / (FANOUT * HEX)).cast("int")
    digests = F.transform(F.sequence(F.lit(0), runs - 1),
                          lambda i: sha(F.substring(F.col(level), i * (FANOUT * HEX) + 1, F.lit(FANOUT * HEX))))
    return F.encode(F.array_join(digests, ""), "US-ASCII")


def _siblings(level: str, i: Column) -> Column:
    """The flanking substrings of node ``i`` in its run: (before, after)."""
    run = i - i % FANOUT
    return F.struct(_slots(F.col(level), run, i - run).cast("string").alias("before"),
                    _slots(F.col(level), i + 1, run + FANOUT - 1 - i).cast("string").alias("after"))


_PATH = "array<struct<before:string,after:string>>"


def _blocks(nodes: DataFrame, carried: list[str]) -> DataFrame:
    """(key, pos, many, nodes, level0..2, top) of every block of 256 nodes of a key; ``pos`` is the block's number.

    ``many`` (nodes of the key) comes with the nodes. A key of one node is its own
    top; of at most 16, the top of one level; otherwise every block takes two.
    Levels are ASCII bytes: substrings are then found without counting characters.
    """
    node = F.struct(F.col("pos").alias("pos"), "node", *carried)
    blocks = (nodes.groupBy("key", "many", F.floor(F.col("pos") / BLOCK).cast("long").alias("block"))
              .agg(F.sort_array(F.collect_list(node)).alias("nodes")).withColumnRenamed("block", "pos"))
    blocks = blocks.withColumn("level0", F.encode(F.array_join("nodes.node", ""), "US-ASCII"))
    blocks = blocks.withColumn("level1", F.when(F.col("many") > 1, _parents("level0")))
    blocks = blocks.withColumn("level2", F.when(F.col("many") > FANOUT, _parents("level1")))
    return blocks.withColumn("top", F.coalesce("level2", "level1", "level0").cast("string"))


def _with_path(blocks: DataFrame, up: DataFrame | None, carried: list[str]) -> DataFrame:
    """(key, pos, node, subroot, carried..., path): the nodes of the blocks, with their siblings on all levels from here on.

    ``up`` has the path of each block itself, by (key, pos); None if every key is one block.
    """
    if up is not None:
        up = up.select(F.col("key").alias("__k"), F.col("pos").alias("__pos"), F.col("path").alias("__up"), "subroot")
        blocks = blocks.join(up, F.col("key").eqNullSafe(F.col("__k")) & (F.col("pos") == F.col("__pos")), "left")
        blocks = blocks.withColumns({"subroot": F.coalesce("subroot", "top"),
                                     "__up": F.coalesce("__up", F.array().cast(_PATH))})
    else:
        blocks = blocks.withColumns({"subroot": F.col("top"), "__up": F.array().cast(_PATH)})
    rows = blocks.select("key", "many", "level0", "level1", "__up", "subroot", F.explode("nodes").alias("__node"))
    rows = rows.withColumn("__i", (F.col("__node.pos") % BLOCK).cast("int"))
    mine = F.when(F.col("many") <= 1, F.array().cast(_PATH)).when(
        F.col("many") <= FANOUT, F.array(_siblings("level0", F.col("__i")))).otherwise(
        F.array(_siblings("level0", F.col("__i")),
                _siblings("level1", F.floor(F.col("__i") / FANOUT).cast("int"))))
    return rows.select("key", F.col("__node.pos").alias("pos"), F.col("__node.node").alias("node"), "subroot",
                       *(F.col(f"__node.{c}").alias(c) for c in carried),
                       F.concat(mine, F.col("__up")).alias("path"))


def _tree(nodes: DataFrame, most: int, carried: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """The tables of blocks of each round, and (key, pos, many, node) of the keys' subroots; no key has over ``most`` nodes."""
    rounds, done = [], None
    while True:
        blocks = shared_table(_blocks(nodes, carried), "blocks")
        rounds.append(blocks)
        tops = blocks.select("key", "pos", F.ceil(F.col("many") / BLOCK).cast("long").alias("many"), F.col("top").alias("node"))
        roots = tops.filter("many = 1")
        done = roots if done is None else done.unionByName(roots)
        most, carried = -(-most // BLOCK), []
        if most <= 1:
            return rounds, done
        nodes = tops.filter("many > 1")


def _paths(nodes: DataFrame, most: int, carried: list[str]) -> tuple[DataFrame, DataFrame]:
    """Every node with its path to its key's subroot; and the subroots."""
    rounds, roots = _tree(nodes, most, carried)
    up = None
    for blocks in reversed(rounds[1:]):
        up = shared_table(_with_path(blocks, up, []), "paths")
    return _with_path(rounds[0], up, carried), roots


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings, level by level, lead to."""
    return F.aggregate(path, leaf, lambda acc, s: sha(F.concat(s["before"], acc, s["after"])))


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, source, leaf, checked_leaf, subroot, root, path, pos) of every row of ``docs``.

    ``docs`` has ``FIELDS`` and may have ``checked_text``, the text as it is found
    later: ``checked_leaf`` is then the leaf of the row with that text (else
    ``leaf`` again), so ``folded(checked_leaf, path) == root`` tells if it is the
    row of the manifest. ``path`` holds the siblings (before, after) of each level.
    """
    leaf = leaf_of([F.col(c) for c in FIELDS])
    checked = leaf
    if "checked_text" in docs.columns:
        same = F.col("checked_text").eqNullSafe(F.col("text"))
        checked = F.when(~same, leaf_of([*(F.col(c) for c in FIELDS[:-1]), F.col("checked_text")])).otherwise(leaf)
    rows = docs.select(F.col("source").alias("key"), "doc_id", leaf.alias("node"),
                       F.nullif(checked, leaf).alias("other"), F.monotonically_increasing_id().alias("seat"))
    rows = shared_table(rows, "leaves")  # seats are now fixed: equal rows keep their order if a task is repeated
    leaves, roots = _paths(*_placed(rows, "key", ["doc_id", "node", "seat"]), ["doc_id", "other"])

    sources = roots.select(F.lit(0).alias("key"), F.col("key").alias("source"), "node")
    sources, _ = _paths(*_placed(sources, "key", ["source"]), ["source"])
    sources = sources.select(F.col("source").alias("__source"), F.col("path").alias("__top"),
                             F.col("subroot").alias("root"))
    sources = shared_table(sources, "source-paths", small=True)
    return leaves.join(sources, F.col("key").eqNullSafe(F.col("__source"))).select(
        "doc_id", F.col("key").alias("source"), F.col("node").alias("leaf"),
        F.coalesce("other", "node").alias("checked_leaf"), "subroot", "root",
        F.concat("path", "__top").alias("path"), "pos")


def proof_digest(path: Column) -> Column:
    """The digest of all siblings, level by level, left to right."""
    return sha(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""))


ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_case_tampering(docs: DataFrame) -> DataFrame:
    """``checked_text``: A-Z lower-cased where 5 divides the CRC-32 of the id's decimal digits."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = F.translate("text", ASCII_UPPER, ASCII_LOWER)
    return docs.withColumn("checked_text", F.when(hit, lowered).otherwise(F.col("text")))


def verify(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row, against ``checked_text``."""
    rows = manifest(docs).withColumn("folded_root", folded(F.col("checked_leaf"), F.col("path")))
    return rows.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                       "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
