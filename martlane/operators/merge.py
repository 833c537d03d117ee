"""Table mutations re-expressed as DataFrame plans: union of stores, upsert, update-from."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_store(df: DataFrame, store: str, col: str = "source_store") -> DataFrame:
    return df.withColumn(col, F.lit(store))


def union_stores(frames: Mapping[str, DataFrame | None], stores: Iterable[str] | None = None,
                 col: str = "source_store") -> DataFrame:
    """Tag each store's frame and union them by name.

    Stores listed but absent (missing database) are skipped; columns missing in one
    store come out NULL (``allowMissingColumns``).
    """
    order = list(stores) if stores is not None else list(frames)
    parts = [with_store(frames[s], s, col) for s in order if frames.get(s) is not None]
    if not parts:
        raise ValueError("no store frames to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def first_wins(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """One row per key: the one with the smallest ``order_col``.

    Written as ``min_by`` over a struct so the partial aggregate folds a hot key
    map-side (no window partition holding a whole hot group in one task).
    """
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(
        F.min_by(F.struct(*[F.col(c) for c in rest]), F.col(order_col)).alias("_w"))
    return picked.select(*keys, *[F.col("_w")[c].alias(c) for c in rest])


def upsert(target: DataFrame | None, batch: DataFrame, keys: list[str],
           update_cols: list[str], order_col: str | None = None,
           touch_col: str | None = None, touch_value=None) -> DataFrame:
    """INSERT ... ON DUPLICATE KEY UPDATE as a full outer join.

    * the batch is first reduced to one row per key, first row (by ``order_col``) wins;
    * matched keys take ``update_cols`` from the batch and keep every other column;
    * new keys are inserted whole; target-only keys are unchanged;
    * a unique key says nothing about rows whose key holds a NULL: they are never matched
      and all kept, only rows equal in every column are stored once, so that applying the
      same batch twice gives the same table.
    ``touch_col`` (e.g. ``last_updated``) is set to ``touch_value`` on matched/new rows.
    """
    cols = list(target.columns) if target is not None else [
        c for c in batch.columns if c != order_col]
    whole = None
    for k in keys:
        whole = F.col(k).isNotNull() if whole is None else whole & F.col(k).isNotNull()

    def shaped(df: DataFrame) -> DataFrame:
        out = df.select(*[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in cols])
        return out.withColumn(touch_col, touch_value) if touch_col else out

    keyed = batch.filter(whole)
    b = first_wins(keyed, keys, order_col) if order_col else keyed.dropDuplicates(keys)
    if order_col and order_col not in cols:
        b = b.drop(order_col)
    loose = shaped(batch.filter(~whole))
    if target is None:
        return shaped(b).unionByName(loose.distinct())
    t = target.filter(whole).withColumn("_in_target", F.lit(True)).alias("t")
    s = b.withColumn("_in_batch", F.lit(True)).alias("s")
    joined = t.join(s, keys, "full_outer")
    in_batch = F.col("_in_batch").isNotNull()
    in_target = F.col("_in_target").isNotNull()
    exprs = []
    for c in cols:
        if c in keys:
            exprs.append(F.col(c))
        elif c == touch_col:
            exprs.append(F.when(in_batch, touch_value).otherwise(F.col(f"t.{c}")).alias(c))
        elif c in update_cols and c in b.columns:
            exprs.append(F.when(in_batch, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        elif c in b.columns:
            exprs.append(F.when(in_target, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c))
        else:
            exprs.append(F.col(f"t.{c}").alias(c))
    return joined.select(*exprs).unionByName(target.filter(~whole).unionByName(loose).distinct())


def update_from(target: DataFrame, source: DataFrame, keys: list[str],
                set_cols: Mapping[str, str] | list[str], how: str = "left") -> DataFrame:
    """UPDATE target JOIN source SET ...

    ``how="left"``: LEFT JOIN form, unmatched target rows get NULL.
    ``how="inner"``: INNER JOIN form, unmatched rows keep their value and matched rows
    take the source value even when it is NULL.
    """
    mapping = dict(set_cols) if isinstance(set_cols, Mapping) else {c: c for c in set_cols}
    src = source.select(*keys, *[F.col(s).alias(f"_src_{t}") for t, s in mapping.items()])
    if how == "inner":
        src = src.withColumn("_matched", F.lit(True))
    joined = target.join(src, keys, "left")
    out = []
    for c in target.columns:
        if c in mapping:
            if how == "inner":
                out.append(F.when(F.col("_matched").isNotNull(), F.col(f"_src_{c}"))
                           .otherwise(F.col(c)).alias(c))
            else:
                out.append(F.col(f"_src_{c}").alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Raise when a key repeats (a primary-key rule); returns the frame unchanged."""
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"duplicate key {dict((k, dup[0][k]) for k in keys)}")
    return df


def assert_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Raise when a NOT NULL column holds a NULL; returns the frame unchanged."""
    cond = None
    for c in cols:
        cond = F.col(c).isNull() if cond is None else (cond | F.col(c).isNull())
    if df.filter(cond).limit(1).count():
        raise ValueError(f"NULL in a NOT NULL column of {cols}")
    return df
