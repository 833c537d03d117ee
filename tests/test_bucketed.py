"""Entity-attribute-value tables in buckets: pivots and joins without an exchange or a sort."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from martlane.operators.eav import eav_pivot
from martlane.plans.orders import ITEM_META, item_facts
from martlane.plans.warehouse import Warehouse
from martlane.sources.bucketed import BUCKET_KEYS, BucketedSources, store_bucketed
from martlane.sources.landed import LandedStores
from martlane.suite import shapes
from tests.test_refresh import land, land_shared

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pivot_has_no_exchange_and_no_sort(spark, tmp_path):
    rows = [(s, i, k, f"{k}{i % 7}") for s in ("DE", "FR") for i in range(500) for k in ("a", "b", "c") if (i + len(k)) % 3]
    df = spark.createDataFrame(rows, "source_store string, id bigint, meta_key string, meta_value string")
    stored = store_bucketed(df, "meta", f"{tmp_path}/meta", ["id", "source_store"], 8)
    files = [f for f in os.listdir(f"{tmp_path}/meta") if f.startswith("part")]
    assert len(files) == 8 and stored.exceptAll(df).count() == 0
    keys = {"x": "a", "y": ["b", "c"]}
    pivot = eav_pivot(stored, ["id", "source_store"], keys)
    plan = plan_of(pivot)
    assert "Exchange" not in plan and "Sort [" not in plan
    want = eav_pivot(df, ["id", "source_store"], keys)
    assert pivot.exceptAll(want).count() == 0 and want.exceptAll(pivot).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver data not present")
def test_item_facts_meet_their_meta_without_exchange(spark):
    s = shapes(spark, SF)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for entity, table in (("order_item_id", "item_meta"), ("post_id", "order_meta")):
            assert "Exchange" not in plan_of(eav_pivot(getattr(s, table), [entity, "source_store"], ITEM_META))
        items = s.order_items.join(eav_pivot(s.item_meta, ["order_item_id", "source_store"], ITEM_META), ["order_item_id", "source_store"], "left")
        plan = plan_of(items)
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "Sort [" not in plan
        facts = plan_of(item_facts(s.order_items, s.item_meta, s.store_product_lookup))
        assert facts.count("Exchange hash") <= 4  # of the two lookups only
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for name in BUCKET_KEYS:
        assert "Bucketed: true" in plan_of(getattr(s, name).groupBy(*BUCKET_KEYS[name]).agg(F.count("*")))


def test_marts_over_bucketed_landed_stores(spark, tmp_path):
    """The same marts, from fewer shuffles; a refresh sees what was landed meanwhile."""
    root = f"{tmp_path}/in"
    land(spark, root, "DE", [1, 2, 3])
    land(spark, root, "TR", [1], status=False)
    land_shared(spark, root)
    marts = ["eur_orders", "master_order_items", "customers_eur"]
    out, shuffles = {}, {}
    for name, src in (("plain", LandedStores(spark, root)), ("bucketed", BucketedSources(LandedStores(spark, root), f"{tmp_path}/buckets", 3))):
        wh = Warehouse(spark, src, f"{tmp_path}/{name}", now=dt.datetime(2024, 5, 1))
        wh.refresh(marts)
        out[name] = [sorted(map(str, wh.table(m).collect())) for m in marts]
        shuffles[name] = sum(plan_of(wh._build(m)).count("Exchange hash") for m in ("item_facts", "store_orders", "store_customers"))
    assert out["bucketed"] == out["plain"] and out["plain"][0]
    assert shuffles["bucketed"] < shuffles["plain"]
    land(spark, root, "DE", [1, 2, 3, 4])
    wh.refresh(["master_orders"])
    assert wh.table("master_orders").count() == 5
    assert len(os.listdir(f"{tmp_path}/buckets")) <= len(BUCKET_KEYS)
