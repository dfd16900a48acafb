"""DataFrame -> DataFrame building blocks. Column names are parameters."""

from sousflow.operators.dedup import canonical_rows, duplicate_keys, key_profile
from sousflow.operators.joins import heavy_keys, spread_join
from sousflow.operators.nearest import nearest_locations
from sousflow.operators.nested import flatten, inverted_index
from sousflow.operators.strings import sorted_string_agg
from sousflow.operators.topn import closest_per_group, pivot_ranks, top_n_with_ties
from sousflow.operators.windows import with_group_values

__all__ = [
    "canonical_rows",
    "duplicate_keys",
    "key_profile",
    "heavy_keys",
    "spread_join",
    "nearest_locations",
    "flatten",
    "inverted_index",
    "sorted_string_agg",
    "closest_per_group",
    "pivot_ranks",
    "top_n_with_ties",
    "with_group_values",
]
