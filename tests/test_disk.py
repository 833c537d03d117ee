"""What a query leaves on disk while it runs: shuffle files, stored tables, extracts."""

from __future__ import annotations

import glob
import os
import re
import time

import pytest
from pyspark.sql import functions as F

from martlane.operators.load import QUARANTINE, LoadRule, load
from martlane.plans.orders import item_facts, item_rollup
from martlane.session import FREE_SHUFFLES, checkpoint_dir, shuffles_freed, stage
from martlane.sources.bucketed import BucketedSources, store_bucketed
from martlane.sources.landed import LandedStores
from martlane.sources.sinks import export_csv, export_json, publish
from martlane.suite import QUERIES, shapes
from tests.test_plans import IMETA, ITEMS, LOOKUP
from tests.test_refresh import land
from tests.test_stored_shapes import driver_tables, stored_names


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in (files.apply(k).getName() for k in range(files.length())) if f.startswith("shuffle_") and f.endswith(".data")}


def folders(spark, kind):
    return set(glob.glob(f"{checkpoint_dir(spark).removeprefix('file://').rstrip('/')}/{kind}/*"))


def files(top):
    return [f"{d}/{n}" for d, _, names in os.walk(top) for n in names if n.startswith("part-")]


def subtrees(plan, pattern):
    """Of each line of a plan that has the pattern, the lines below it."""
    lines = plan.splitlines()
    depth = [len(re.match(r"[ :+\-]*", line)[0]) for line in lines]
    for k, line in enumerate(lines):
        if re.search(pattern, line):
            end = next((j for j in range(k + 1, len(lines)) if depth[j] <= depth[k]), len(lines))
            yield lines[k + 1:end]


@pytest.mark.parametrize("write", [
    stage, lambda df: publish(df, f"{checkpoint_dir(df.sparkSession)}/disk/published{time.time_ns()}"),
    lambda df: store_bucketed(df, "disk", f"{checkpoint_dir(df.sparkSession)}/disk/b{time.time_ns()}", ["k"], 3),
    lambda df: export_csv(df, f"{checkpoint_dir(df.sparkSession)}/disk/c{time.time_ns()}", compression="gzip"),
    lambda df: export_json(df, f"{checkpoint_dir(df.sparkSession)}/disk/j{time.time_ns()}")])
def test_a_write_leaves_no_shuffle_files(spark, write):
    df = spark.range(3000).withColumn("k", F.col("id") % 7)
    there = shuffle_files(spark)
    write(df.repartition(5, "k").join(df.groupBy("k").count(), "k"))
    end = time.time() + 20
    while shuffle_files(spark) - there and time.time() < end:
        time.sleep(0.2)
    assert not shuffle_files(spark) - there
    assert spark.conf.get(FREE_SHUFFLES, None) is None


def test_shuffles_are_freed_within_only(spark):
    try:
        spark.conf.set(FREE_SHUFFLES, "false")
        with pytest.raises(ZeroDivisionError), shuffles_freed(spark):
            assert spark.conf.get(FREE_SHUFFLES) == "true"
            1 / 0
        assert spark.conf.get(FREE_SHUFFLES) == "false"
    finally:
        spark.conf.unset(FREE_SHUFFLES)


def test_only_references_go_to_the_lookup(spark):
    """Items that repeat, products that the lookup has twice or not at all, and missing references
    give the rows of two left joins; the items themselves are not dealt by product."""
    items = [("DE", 1, 1, "x", "line_item"), ("DE", 1, 1, "y", "line_item"), ("DE", 2, 1, "x", "line_item"), ("DE", 3, 1, "x", "fee"),
             ("DE", None, 1, "x", "line_item"), (None, 2, 1, "x", "line_item"), ("FR", 1, 2, "x", "line_item")]
    im = [("DE", 1, "_product_id", "5"), ("DE", 1, "_product_id", "4"), ("DE", 1, "_variation_id", "6"), ("DE", 2, "_product_id", "0"),
          ("DE", 2, "_variation_id", "-6"), (None, 2, "_product_id", "5"), ("FR", 1, "_product_id", "7"), ("FR", 1, "_variation_id", "x")]
    lookup = [("DE", 5, "A"), ("DE", 5, "B"), ("DE", 5, None), ("DE", 6, "V"), ("DE", 6, "W"), ("DE", 0, "Z"), ("DE", -6, "N"), (None, 5, "A"),
              ("FR", 5, "A"), ("FR", None, "A")]
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        facts = item_facts(spark.createDataFrame(items, ITEMS), spark.createDataFrame(im, IMETA), spark.createDataFrame(lookup, LOOKUP))
        plan = facts._jdf.queryExecution().executedPlan().toString()
        got = sorted((r.source_store or "", r.order_item_id or 0, r.order_item_name, r.parent_sku or "", r.variation_sku or "") for r in facts.collect())
    finally:
        spark.conf.set(key, before)
    both = [(p, v) for p in ("", "A", "B") for v in ("V", "W")]
    assert got == sorted([("DE", 1, n, p, v) for n in "xy" for p, v in both] + [
        ("DE", 2, "x", "Z", ""), ("DE", 3, "x", "", ""), ("DE", 0, "x", "", ""), ("", 2, "x", "", ""), ("FR", 1, "x", "", "")])
    dealt = list(subtrees(plan, r"Exchange hashpartitioning\(_[pv]#"))
    assert len(dealt) == 4 and not any("order_item_name" in line for lines in dealt for line in lines)


def test_orders_get_only_what_is_folded(spark):
    """A line's charges and a charge's SKUs are not dealt to the orders, nor read there."""
    cols = ("order_item_id long, order_id long, source_store string, order_item_type string, product_text string, product_id long, "
            "qty_text string, subtotal_text string, fee_text string, cost_text string, parent_sku string, variation_sku string")
    facts = spark.createDataFrame([
        (4, 10, "DE", "line_item", "7", 7, "2", "10.00", "9", "9", "", ""), (5, 10, "DE", "line_item", "8", 8, "1", "1.00", "9", "9", "P8", None),
        (6, 10, "DE", "line_item", None, None, None, None, None, None, None, None),
        (3, 10, "DE", "fee", "7", 7, "5", "5", "2.50", "9", "P7", "V7"), (2, 10, "DE", "fee", None, None, None, None, "1.50", None, None, None),
        (1, 10, "DE", "shipping", "7", 7, "5", "5", "9", None, "P7", "V7"), (2, 10, "DE", "shipping", None, None, None, None, None, "4.95", None, None),
        (0, 10, "DE", None, "7", 7, "5", "5", "9", "9", "P7", "V7")], cols)
    roll = item_rollup(facts)
    r = roll.collect()[0]
    assert (r.units_total, r.ordered_items_count, r.line_subtotal_sum, r.fee_sum, float(r.ship_sum)) == (2, 3, 11, 4, 4.95)
    assert (float(r.fee_first), float(r.shipping_first)) == (1.5, 4.95) and "P7" not in r.ordered_items_skus and "P8" in r.ordered_items_skus
    dealt = next(subtrees(roll._jdf.queryExecution().executedPlan().toString(), r"Exchange hashpartitioning\(order_id#"))
    assert "is_line#" in dealt[0] + dealt[1] and not re.search(r"_p#|product_id#\d+L?,", dealt[0])


def test_a_load_keeps_one_copy_of_its_rows(spark):
    rows = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1), (None, "d", 1)], "id long, label string, extract int")
    there = folders(spark, "stages")
    loaded = load(rows, LoadRule(("id",), ("extract",), QUARANTINE, QUARANTINE))
    left = folders(spark, "stages") - there
    assert len(left) == 1 and all(".zstd." in f for top in left for f in files(top))
    marked = spark.read.parquet(*left)
    assert sorted(r.label for r in marked.filter("first_row is not null").collect()) == ["b"]
    assert sorted(r.label for r in loaded.kept.collect()) == ["a", "c"]
    assert sorted((r.label, r.reject_reason) for r in loaded.rejects.collect()) == [("b", "duplicate key"), ("d", "NULL in key")]


def test_loads_deal_no_items_to_buckets(spark, tmp_path):
    driver_tables(spark, tmp_path)
    assert QUERIES["load_first_wins"](spark, str(tmp_path)).count() > 0
    assert stored_names(shapes(spark, str(tmp_path))) == {"_orders", "_refunds", "_lines"}


@pytest.mark.parametrize("name", ["landed_store_orders", "extracted_store_orders"])
def test_what_is_landed_is_not_kept_twice(spark, tmp_path, name):
    """Landed tables are packed; the parts that they were made of go, but for those that were there before."""
    driver_tables(spark, tmp_path)
    s = shapes(spark, str(tmp_path))
    kept = s._orders
    got = QUERIES[name](spark, str(tmp_path))
    assert stored_names(s) == {"_orders"} and os.listdir(s.root) == ["_orders"] and kept.count() == 3
    assert {(r.source_store, r.order_id % 10 ** 12) for r in got.collect()} >= {("DE", 1)}
    top, = {re.match(".*/landed/[^/]+", f)[0].removeprefix("file://") for f in got.inputFiles()}
    landed = [f for f in files(top) if "/_buckets/" not in f]
    assert landed and all(f.endswith((".zstd.parquet", ".csv.gz")) for f in landed)
    assert s._lines.count() == 4 and all(".zstd." in f for f in s._lines.inputFiles())


def test_landed_attributes_lie_packed_in_buckets(spark, tmp_path):
    land(spark, f"{tmp_path}/in", "DE", [1, 2])
    src = BucketedSources(LandedStores(spark, f"{tmp_path}/in", ["DE"]), f"{tmp_path}/buckets", 2)
    for name in ("order_meta", "item_meta", "order_items"):
        assert all(".zstd." in f for f in getattr(src, name).inputFiles()), name


def test_exports_and_order_marts_are_packed(spark, tmp_path):
    driver_tables(spark, tmp_path)
    exports, marts = folders(spark, "exports"), folders(spark, "marts")
    assert QUERIES["export_round_trip"](spark, str(tmp_path)).groupBy("format").count().count() == 3
    top, = folders(spark, "exports") - exports
    assert files(top) and all(f.endswith(".gz") for f in files(top))
    top, = folders(spark, "marts") - marts
    assert {f.split("/")[-1].split(".")[-2] for f in files(f"{top}/store_orders")} == {"zstd"}
