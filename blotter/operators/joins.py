"""Equi-joins with an explicit strategy.

``strategy``:

* ``None`` / ``"auto"`` -- the planner decides: it broadcasts a side whose
  estimated size is under ``spark.sql.autoBroadcastJoinThreshold``, and
  with AQE it re-plans from the real size of each shuffle stage (late
  broadcast) and splits skewed partitions of a sort-merge join.
* ``"broadcast"`` -- broadcast the right side after writing it to the scratch
  folder and measuring its bytes there (one aggregation on the executors; one row
  comes back). A side over the bound raises: nothing falls back to another join unseen.
* ``"merge"`` / ``"shuffle_hash"`` -- shuffle both sides on the key
  (sort-merge or shuffled hash join).

With ``salt=N`` (any strategy but broadcast) hot keys are split over up to N
tasks each, and only they are: a mergeable heavy-hitter sketch over the left keys
(one pass over the key columns; one row comes back) finds the keys with more rows than an
average task. A left row of such a key takes a salt from its own columns and its map task,
so equal rows are split too and a repeated task gives the same salts; its
right rows are copied once a salt. All other keys are joined as they are, in the same
shuffle. Results are those of the plain join.

Joins multiply relationally: duplicate keys on either side give one output
row per matching pair, whatever the strategy.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.session import scratch_table

STRATEGIES = (None, "auto", "broadcast", "merge", "shuffle_hash")

# Default bound for a broadcast side: dimension tables (stations, ZIP codes)
# stay far below it; a fact table never does.
MAX_BROADCAST_BYTES = 64 << 20

_SALT, _SALTS, _HASH = "__salt", "__salts", "__hash"
TRACKED = 10_000  # keys that a sketch of frequent keys tracks at least


def measured_bytes(df: DataFrame) -> int:
    """Bytes of the rows of ``df``: text and binary by length, nested values
    by their JSON text, everything else eight bytes a value, plus sixteen a row.

    Summed where the rows are; one row comes to the driver.
    """
    row = F.lit(16).cast("long")
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            row = row + F.lit(8) + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            row = row + F.lit(8) + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
        else:
            row = row + F.lit(8)
    return df.agg(F.sum(row)).first()[0] or 0


def broadcast_side(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast; raises if its rows are more than ``max_bytes``.

    The side is computed once: it is written to the shared scratch folder, measured
    there and broadcast from there.
    """
    df = scratch_table(df, "broadcast-side")
    size = measured_bytes(df)
    if size > max_bytes:
        raise ValueError(f"the side to broadcast has {size} bytes, more than the bound of {max_bytes}; "
                         "use strategy=None, 'merge' or 'shuffle_hash', or raise the bound")
    return F.broadcast(df)


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def _common_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> list[T.DataType]:
    """The type in which both sides' values of each key are compared."""
    out = []
    for k in keys:
        a, b = left.schema[k].dataType, right.schema[k].dataType
        if a != b and not (isinstance(a, T.NumericType) and isinstance(b, T.NumericType)):
            raise ValueError(f"salting needs one type for key {k!r}, got {a.simpleString()} and {b.simpleString()}: cast one side")
        out.append(left.select(k).limit(0).union(right.select(k).limit(0)).schema[k].dataType)
    return out


def _key_hash(keys: list[str], types: list[T.DataType]) -> Column:
    """Equal keys of either side have one hash (minus zero is zero)."""
    def value(k: str, kind: T.DataType) -> Column:
        c = F.col(f"`{k}`").cast(kind)
        return F.when(c == 0, F.lit(0).cast(kind)).otherwise(c) if isinstance(kind, (T.FloatType, T.DoubleType)) else c

    return F.xxhash64(*(value(k, t) for k, t in zip(keys, types)))


def hot_keys(df: DataFrame, on: str | Sequence[str], least_share: float, key: Column | None = None) -> list[tuple[int, int, int]]:
    """(hash of the key, about how many rows, all rows) of keys with more than ``least_share`` of the rows.

    A frequent-items sketch: partial sketches are merged like partial sums, and at
    most ``1 / least_share`` entries come to the driver. It is exact while it tracks
    all keys (``TRACKED`` or 16 for each possible hot key); beyond, a key's count is
    low by a small part of all rows, far below the share looked for.
    """
    keys = _keys(on)
    if not 0 < least_share <= 1:
        raise ValueError("least_share must be above 0 and at most 1")
    most = int(1 / least_share) + 1
    tracked = min(1_000_000, max(TRACKED, 16 * most))
    name = "__key"
    hashed = df.select((F.xxhash64(*[F.col(f"`{k}`") for k in keys]) if key is None else key).alias(name))
    found = hashed.agg(F.count(F.lit(1)).alias("total"),
                       F.expr(f"approx_top_k({name}, {min(most, tracked)}, {tracked})").alias("top")).first()
    total = found["total"]
    return [(r["item"], r["count"], total) for r in found["top"] or [] if r["count"] > least_share * total]


def salted_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner",
                buckets: int = 16, hint: str | None = "merge", tasks: int | None = None) -> DataFrame:
    """Equi-join that spreads hot keys over up to ``buckets`` tasks each.

    A key is hot if it has more rows in ``left`` than an average one of ``tasks``
    (the session's shuffle partitions by default) and gets as many salts as average
    tasks its rows would fill. Without hot keys this is the plain join. Only
    joins that keep left rows as they are keep their meaning.
    """
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError(f"salting does not preserve {how!r} joins")
    keys = _keys(on)
    spark = left.sparkSession
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = _key_hash(keys, _common_keys(left, right, keys))
    hot = hot_keys(left, keys, min(1.0, 1 / tasks), key) if tasks > 1 else []
    hinted = right.hint(hint) if hint else right
    if not hot:
        return left.join(hinted, keys, how)
    # at most ``tasks`` rows, so the table is broadcast
    salts = spark.createDataFrame([(h, min(buckets, -(-n * tasks // total))) for h, n, total in hot],
                                  f"{_HASH} long, {_SALTS} long")
    # the row's own columns tell different rows apart, the map task equal ones; maps can't be hashed
    told = [F.col(f"`{f.name}`") for f in left.schema.fields if "map<" not in f.dataType.simpleString()]
    own = F.pmod(F.xxhash64(*told, F.spark_partition_id()), F.col(_SALTS))
    spread = left.withColumn(_HASH, key).join(F.broadcast(salts), _HASH, "left")
    spread = spread.withColumn(_SALT, F.coalesce(own, F.lit(0).cast("long"))).drop(_HASH, _SALTS)
    copies = right.withColumn(_HASH, key).join(F.broadcast(salts), _HASH, "left")
    numbers = F.sequence(F.lit(0).cast("long"), F.coalesce(F.col(_SALTS), F.lit(1).cast("long")) - 1)
    copies = copies.withColumn(_SALT, F.explode(numbers)).drop(_HASH, _SALTS)
    return spread.join(copies.hint(hint) if hint else copies, [*keys, _SALT], how).drop(_SALT)


def join(left: DataFrame, right: DataFrame, on: str | Sequence[str] | Column, how: str = "inner",
         strategy: str | None = None, max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
         salt: int | None = None) -> DataFrame:
    """Join ``left`` (the large side) with ``right`` using ``strategy``."""
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, got {strategy!r}")
    hint = strategy if strategy in ("merge", "shuffle_hash") else None
    if salt is not None and salt > 1:
        if strategy == "broadcast":
            raise ValueError("a broadcast join shuffles no keys: it takes no salt")
        if isinstance(on, Column):
            raise ValueError("salting needs join key names")
        return salted_join(left, right, on, how, buckets=salt, hint=hint)
    if strategy == "broadcast":
        return left.join(broadcast_side(right, max_broadcast_bytes), on, how)
    return left.join(right.hint(hint) if hint else right, on, how)


def lookup(left: DataFrame, right: DataFrame, on: str | Sequence[str], value_cols: Sequence[str],
           default: object = "Unknown", strategy: str | None = None) -> DataFrame:
    """Left join to a map of one value per key; ``default`` where the key is not in it.

    A key that repeats in ``right`` counts once, with its least values (nulls
    last), so no left row is multiplied; a key that is there with a null
    value stays null.
    """
    found = "__found"
    table = first_per_key(right.select(*_keys(on), *value_cols), on, value_cols).withColumn(found, F.lit(True))
    joined = join(left, table, on, "left", strategy=strategy)
    filled = {c: F.when(F.col(found), F.col(c)).otherwise(F.lit(default)) for c in value_cols}
    return joined.withColumns(filled).drop(found)


def semi_join(left: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Keep left rows whose key occurs in ``keys`` (no duplication).

    The planner broadcasts small keys by their size, with AQE by the size
    they turn out to have.
    """
    return left.join(keys.select(*_keys(on)), on, "left_semi")


def in_list(left: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    """Filter by a literal value list (an empty list keeps nothing)."""
    if not values:
        return left.filter(F.lit(False))
    return left.filter(F.col(column).isin(list(values)))


def require_unique(df: DataFrame, key: str | Sequence[str], what: str = "key") -> DataFrame:
    """Fail the query at run time if ``key`` repeats in ``df``.

    The check is part of the plan (a count over a key window), so the
    pipeline stays lazy; meant for small lookup tables. Keys with a null
    may repeat: they join with nothing.
    """
    keys = _keys(key)
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    first = keys[0]
    known = reduce(and_, [F.col(k).isNotNull() for k in keys])
    guarded = F.when((n > 1) & known, F.raise_error(F.concat(F.lit(f"duplicate {what}: "), F.col(first).cast("string"))))
    return df.withColumn(first, F.coalesce(guarded.cast(df.schema[first].dataType), F.col(first)))


def first_per_key(df: DataFrame, key: str | Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key -- the first by ``order_by`` -- giving a lookup map's
    one-value-per-key semantics deterministically (meant for small tables)."""
    keys = _keys(key)
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order_by])
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")
