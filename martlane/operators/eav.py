"""Entity-attribute-value pivot and unpivot.

The pivot is one filtered, map-side-combined aggregation: rows whose key is not
needed are dropped before the shuffle (Catalyst cannot derive that filter from the
``max(when(...))`` list), then ``groupBy(entity).agg(max(when(key = k, value)))``.
A hot entity is folded by the partial aggregate before it reaches the exchange.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def eav_pivot(df: DataFrame, entity: str | list[str], outputs: Mapping[str, str | Iterable[str]],
              key: str = "meta_key", value: str = "meta_value",
              aggregate=F.max, extra_keys: Iterable[str] = (),
              extra_aggs: Iterable[Column] = ()) -> DataFrame:
    """Long (entity, key, value) -> wide (entity, out1, out2, ...).

    ``outputs`` maps an output column to one key or to several keys feeding it
    (e.g. two cost keys -> one ``cogs``).  The aggregate is a string MAX by default,
    so a repeated key keeps the textual maximum ('9' over '10').  ``extra_aggs`` are
    further aggregates over the same (pre-filtered to needed + ``extra_keys``) rows.
    """
    entities = [entity] if isinstance(entity, str) else list(entity)
    spec = {out: ([k] if isinstance(k, str) else list(k)) for out, k in outputs.items()}
    needed = sorted({k for ks in spec.values() for k in ks} | set(extra_keys))
    aggs: list[Column] = list(extra_aggs)
    for out, ks in spec.items():
        cond = F.col(key) == ks[0] if len(ks) == 1 else F.col(key).isin(ks)
        aggs.append(aggregate(F.when(cond, F.col(value))).alias(out))
    return (df.select(*entities, key, value)
              .filter(F.col(key).isin(needed))
              .groupBy(*entities)
              .agg(*aggs))


def eav_unpivot(df: DataFrame, entity: str | list[str], columns: Iterable[str] | None = None,
                key: str = "meta_key", value: str = "meta_value",
                drop_nulls: bool = True) -> DataFrame:
    """Wide -> long (entity, key, value); values are cast to string."""
    entities = [entity] if isinstance(entity, str) else list(entity)
    cols = [c for c in (columns or df.columns) if c not in entities]
    casted = df.select(*entities, *[F.col(c).cast("string").alias(c) for c in cols])
    out = casted.unpivot(entities, cols, key, value)
    return out.filter(F.col(value).isNotNull()) if drop_nulls else out
