"""Refreshing: new data is seen, a failed write leaves the old table, rules are checked."""
import datetime as dt
import json
import os
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from martlane.plans.warehouse import Warehouse
from martlane.sources.landed import LandedStores
from martlane.sources.sinks import current_version, publish, read_published

T0 = dt.datetime(2024, 1, 1)


def failing(spark):
    return spark.range(5).select(F.raise_error(F.lit("this write fails")).cast("long").alias("id"))


def test_failed_write_leaves_the_published_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    with pytest.raises(FileNotFoundError):
        read_published(spark, path)
    publish(spark.range(3), path)
    first = current_version(spark, path)
    with pytest.raises(Exception, match="this write fails"):
        publish(failing(spark), path)
    assert current_version(spark, path) == first and read_published(spark, path).count() == 3

    def refuse(written):
        raise ValueError(f"{written.count()} rows refused")
    with pytest.raises(ValueError, match="4 rows refused"):
        publish(spark.range(4), path, check=refuse)
    assert read_published(spark, path).count() == 3
    reader = read_published(spark, path)
    publish(spark.range(7), path)
    assert read_published(spark, path).count() == 7 and reader.count() == 3
    publish(spark.range(8), path)
    assert sorted(os.listdir(f"{path}/versions")) == sorted(
        [current_version(spark, path), *(v for v in os.listdir(f"{path}/versions") if v != current_version(spark, path))])
    assert len(os.listdir(f"{path}/versions")) == 2


def land(spark, root, store, orders, status=True):
    def write(table, rows, schema):
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{root}/{store}/{table}")
    posts = [(k, "shop_order", T0, *(["wc-completed"] if status else []), 0) for k in orders]
    kind = "ID bigint, post_type string, post_date timestamp_ntz, " + ("post_status string, " if status else "") + "post_parent bigint"
    write("order_posts", posts, kind)
    write("order_meta", [(k, key, v) for k in orders for key, v in (
        ("_order_number_formatted", f"{store}-{k}"), ("_order_currency", "EUR"), ("_customer_user", "1"), ("_order_total", "12.00"))],
        "post_id bigint, meta_key string, meta_value string")
    write("order_items", [(k, k, "x", "line_item") for k in orders], "order_item_id bigint, order_id bigint, order_item_name string, order_item_type string")
    write("item_meta", [(k, key, v) for k in orders for key, v in (("_product_id", "5"), ("_qty", "2"), ("_line_subtotal", "10.00"))],
          "order_item_id bigint, meta_key string, meta_value string")
    write("store_product_lookup", [(5, f"{store}5")], "product_id bigint, sku string")
    write("store_product_meta", [(5, "_wc_cog_cost", "1.00")], "post_id bigint, meta_key string, meta_value string")
    write("users", [(1, f"u@{store}", "2020-01-01")], "ID bigint, user_email string, user_registered string")
    write("user_meta", [(1, "first_name", "Ann")], "user_id bigint, meta_key string, meta_value string")


def land_shared(spark, root):
    (spark.createDataFrame([(5, "PIM5", 1.0)], "product_id bigint, sku string, stock_quantity double")
          .write.mode("overwrite").parquet(f"{root}/shared/product_lookup"))


def test_two_landed_stores(spark, tmp_path):
    """One store lacks a column, the others' folders are not there."""
    root = f"{tmp_path}/in"
    land(spark, root, "DE", [1, 2])
    land(spark, root, "TR", [1], status=False)
    land_shared(spark, root)
    wh = Warehouse(spark, LandedStores(spark, root), f"{tmp_path}/out", now=T0)
    wh.refresh(["eur_orders", "master_order_items", "customers_eur"])
    got = sorted((r.source_store, r.order_id, r.order_status, r.ordered_items_skus, r.gross_total)
                 for r in read_published(spark, f"{tmp_path}/out/master_orders").collect())
    assert got == [("DE", 1, "wc-completed", "DE5", D("10.00")), ("DE", 2, "wc-completed", "DE5", D("10.00")),
                   ("TR", 1, None, "TR5", D("10.00"))]
    assert {r.sku for r in wh.table("master_order_items").collect()} == {"PIM5"}
    assert wh.counts["master_orders"] == 3
    stamped = read_published(spark, f"{tmp_path}/out/master_customers")
    assert {r.created_at for r in stamped.select("created_at").collect()} == {T0}

    # the second refresh sees what was landed meanwhile
    land(spark, root, "DE", [1, 2, 3])
    wh.refresh(["master_orders"])
    assert read_published(spark, f"{tmp_path}/out/master_orders").count() == 4

    # two rows of one key: refused, and the published table stays
    land(spark, root, "DE", [1, 1])
    with pytest.raises(ValueError, match="duplicate key"):
        wh.refresh(["store_orders"])
    assert read_published(spark, f"{tmp_path}/out/store_orders").count() == 4


def test_command_line_over_landed_stores(spark, tmp_path, capsys):
    from martlane.__main__ import main
    root = f"{tmp_path}/in"
    land(spark, root, "DE", [1, 2])
    land_shared(spark, root)
    for orders in ([1, 2], [1, 2, 3]):
        land(spark, root, "DE", orders)
        main(["--stores", root, "--out", f"{tmp_path}/out", "master_orders", "advertisements"])
        said = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
        assert said["rows"]["master_orders"] == len(orders) and said["rows"]["ads_records"] == 0
        assert read_published(spark, f"{tmp_path}/out/master_orders").count() == len(orders)


def test_shaped_tables_follow_their_input(spark, tmp_path):
    from martlane.sources.shop_shape import ShopShapes, materialize
    from martlane.suite import shapes
    for n in (3, 8):
        (spark.range(n).select(F.col("id").alias("page_id"), F.lit("http://x/a.jpg").alias("url"))
              .write.mode("overwrite").parquet(f"{tmp_path}/in/pages.parquet"))
        got = materialize(ShopShapes(spark, f"{tmp_path}/in"), f"{tmp_path}/out", names=["attachments"])
        assert got.attachments.count() == n
    sf = "/root/testdata/sf0.001"
    if os.path.isdir(sf):
        assert shapes(spark, sf) is shapes(spark, sf)


def test_ads_mart_upserts_what_was_landed(spark, tmp_path):
    record = {"campaign_name": "c", "ad_name": "a", "adset_name": "s", "impressions": "1", "clicks": "2",
              "date_start": "2024-01-01", "date_stop": "2024-01-01"}
    folder = tmp_path / "in" / "shared" / "ads_json"
    folder.mkdir(parents=True)
    wh = Warehouse(spark, LandedStores(spark, f"{tmp_path}/in"), f"{tmp_path}/out", now=T0)
    for k, clicks in enumerate(("2", "9")):
        data = [dict(record, clicks=clicks), dict(record, ad_name=f"only{k}")]
        (folder / "page.json").write_text(json.dumps({"data": data}))
        wh.refresh(["advertisements"])
    got = {r.ad_name: r.clicks for r in read_published(spark, f"{tmp_path}/out/advertisements").collect()}
    assert got == {"a": 9, "only0": 2, "only1": 2} and wh.counts["ads_records"] == 2
