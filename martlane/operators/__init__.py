"""Relational building blocks shared by the marts."""

from martlane.operators.eav import eav_pivot, eav_unpivot
from martlane.operators.joins import lookup_key
from martlane.operators.lists import ordered_join, sorted_distinct_join
from martlane.operators.merge import (assert_unique, first_wins, union_stores, update_from,
                                      upsert, with_store)

__all__ = [
    "eav_pivot", "eav_unpivot", "lookup_key",
    "ordered_join", "sorted_distinct_join", "assert_unique", "first_wins",
    "union_stores", "update_from", "upsert", "with_store",
]
