from blotter.operators.aggregates import composite_reduce_mean, count_and_mean, count_by, exact_mean, in_units
from blotter.operators.joins import (
    MAX_BROADCAST_BYTES,
    broadcast_side,
    first_per_key,
    hot_keys,
    in_list,
    join,
    lookup,
    measured_bytes,
    require_unique,
    salted_join,
    semi_join,
)
from blotter.operators.ranking import rank_within, top_k_keys, top_k_rows, top_n_per_group
from blotter.operators.union import union_by_name, union_by_position

__all__ = [
    "MAX_BROADCAST_BYTES",
    "broadcast_side",
    "composite_reduce_mean",
    "count_and_mean",
    "count_by",
    "exact_mean",
    "first_per_key",
    "hot_keys",
    "in_list",
    "in_units",
    "join",
    "lookup",
    "measured_bytes",
    "rank_within",
    "require_unique",
    "salted_join",
    "semi_join",
    "top_k_keys",
    "top_k_rows",
    "top_n_per_group",
    "union_by_name",
    "union_by_position",
]
