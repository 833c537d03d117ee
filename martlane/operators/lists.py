"""List-valued aggregation and explosion (GROUP_CONCAT forms and delimited lists)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sorted_distinct_join(c, sep: str = ", ", empty=None, fold=None) -> Column:
    """Aggregate: distinct values sorted by value, joined; ``empty`` when no non-null value.

    ``collect_set`` merges sets in the partial aggregate, so the per-group state is
    bounded by the number of distinct values, not by group size.  With ``fold``, values that
    fold alike are one, the least of them.
    """
    values = F.sort_array(F.collect_set(_col(c)))
    if fold is not None:
        values = F.aggregate(values, F.expr("cast(array() as array<string>)"), lambda kept, v: F.when(
            F.exists(kept, lambda k: fold(k) == fold(v)), kept).otherwise(F.array_append(kept, v)))
    joined = F.array_join(values, sep)
    if empty is None:
        return F.when(F.count(_col(c)) > 0, joined)
    return F.when(F.count(_col(c)) > 0, joined).otherwise(F.lit(empty))


def ordered_join(value, order, sep: str = ",") -> Column:
    """Aggregate: non-NULL values joined in ``order`` (ties broken by value); NULL when none."""
    v = _col(value)
    pairs = F.array_sort(F.collect_list(
        F.when(v.isNotNull(), F.struct(_col(order).alias("o"), v.alias("v")))))
    return F.when(F.size(pairs) > 0,
                  F.array_join(F.transform(pairs, lambda x: x["v"]), sep))
