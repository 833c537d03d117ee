"""Shop tables are stored when they are first read, and only those that are."""
import datetime as dt
import os

from pyspark.sql import functions as F

from martlane.sources.shop_shape import BUCKET_BYTES, EAV_TABLES, ShopShapes, StoredShapes, materialize
from martlane.suite import QUERIES, shapes
from tests.conftest import rows


def driver_tables(spark, folder):
    """Two orders and one that has no customer; the lines of the second hold no price."""
    def write(name, data, schema):
        spark.createDataFrame(data, schema).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    day = dt.datetime(2024, 1, 5)
    write("nation", [(2, "GERMANY"), (3, "FRANCE")], "n_nationkey int, n_name string")
    write("customer", [(1, "Customer#1", 2, "BUILDING"), (2, "Customer#2", 3, "MACHINERY")],
          "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string")
    write("orders", [(1, 1, "F", 10.0, day, "1-URGENT"), (2, 2, "O", None, day, "2-HIGH"), (3, 9, "P", 7.5, day, "5-LOW")],
          "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string")
    write("lineitem", [(1, 1, 7, 5, 2.0, 9.5, 0.1, 0.05, "R", "O", day), (1, 1, 7, 5, 2.0, 9.5, 0.1, 0.05, "N", "F", day),
                       (2, 1, 8, 5, None, None, 0.0, 0.0, "R", "F", day), (4, 1, 8, 5, 1.0, 1.0, 0.0, 0.0, "N", "F", day)],
          "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double, "
          "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
    write("supplier", [(5, "Supplier#5", 0, 1.0)], "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double")
    part(spark, folder)


def part(spark, folder):
    data = [(k, f"part {k}", f"Brand#{k % 3}", ["PROMO", "SMALL"][k % 2], 3 + k, 10.0 * k) for k in range(1, 7)]
    spark.createDataFrame(data, "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double") \
         .write.mode("overwrite").parquet(f"{folder}/part.parquet")


def stored_names(shaped):
    return {n for n in shaped.__dict__ if n in shaped.stored}


def test_a_query_stores_only_what_it_reads(spark, tmp_path):
    """Nothing but the parts lies in this folder: no order is looked at."""
    part(spark, tmp_path)
    got = {r.product_id: (r.categories, r.tags) for r in QUERIES["category_rollup"](spark, str(tmp_path)).collect()}
    assert got[1] == ("SMALL", "Brand 1") and len(got) == 6
    assert stored_names(shapes(spark, str(tmp_path))) == {"term_relationships", "term_taxonomy", "terms"}


def test_stored_tables_hold_the_rows_of_the_rules(spark, tmp_path):
    driver_tables(spark, tmp_path)
    plain = ShopShapes(spark, str(tmp_path))
    names = ["order_posts", "order_meta", "order_items", "item_meta", "users", "user_meta", "product_meta", "shipments", "shipment_items"]
    stored = materialize(plain, f"{tmp_path}/out", names=names)
    for n in names:
        want, got = getattr(plain, n), getattr(stored, n).select(*getattr(plain, n).columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, n
    refunds = rows(stored.order_meta.filter("meta_key = '_refund_amount'").orderBy("post_id"), "source_store", "post_id", "meta_value")
    assert refunds == [("DE", 10 ** 12 + 1, "9.50"), ("FR", 10 ** 12 + 2, None)]
    assert stored.item_meta.filter("meta_value is null").count() == 0
    assert stored.order_meta.filter("meta_value is null").count() == 1


def test_attribute_rows_are_dealt_as_entities(spark, tmp_path):
    """What is shuffled is one row for each item, not one for each of its attributes."""
    driver_tables(spark, tmp_path)
    s = StoredShapes(spark, str(tmp_path), f"{tmp_path}/out")
    for name, entity in EAV_TABLES.items():
        rows_of = getattr(s, f"{name}_rows")
        assert rows_of.select(*entity).distinct().count() == rows_of.count() < getattr(s, name).count()


def test_buckets_grow_with_the_input(spark, tmp_path):
    """Buckets of a fixed number would grow with the input until they spill."""
    part(spark, tmp_path)
    few = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert StoredShapes(spark, str(tmp_path), f"{tmp_path}/out").buckets == few
    with open(f"{tmp_path}/large.parquet", "wb") as f:
        os.truncate(f.fileno(), 40 * BUCKET_BYTES)
    shaped = StoredShapes(spark, str(tmp_path), f"{tmp_path}/out")
    assert shaped.buckets > 40 > few
    product_meta = shaped.product_meta
    assert len({f for f in product_meta.inputFiles()}) > few or product_meta.rdd.getNumPartitions() == shaped.buckets
    assert product_meta.groupBy("post_id").agg(F.count("*").alias("n")).count() == 6


def test_customers_and_landing_deal_no_items(spark, tmp_path):
    """Items that are only counted by their order, or only landed, are not dealt to buckets of their key."""
    driver_tables(spark, tmp_path)
    got = QUERIES["customers_eur"](spark, str(tmp_path))
    assert got.select("customer_id", "orders_count", "units_total").orderBy("customer_id").collect()[0][1:] == (1, 2)
    s = shapes(spark, str(tmp_path))
    assert stored_names(s) == {"_orders", "_refunds", "_lines", "users", "user_meta", "order_posts", "order_meta"}


def test_landed_customers_store_no_attribute_table(spark, tmp_path):
    driver_tables(spark, tmp_path)
    got = QUERIES["landed_store_customers"](spark, str(tmp_path))
    assert {r.source_store: (r.orders_count, r.units_total) for r in got.collect()} == {"DE": (1, 2), "FR": (1, 1)}
    assert stored_names(shapes(spark, str(tmp_path))) == {"_orders", "_refunds", "_lines"}


def test_items_and_their_meta_are_dealt_once(spark, tmp_path):
    driver_tables(spark, tmp_path)
    got = QUERIES["order_items_sku"](spark, str(tmp_path))
    assert got.count() == 4
    s = shapes(spark, str(tmp_path))
    assert stored_names(s) == {"_orders", "_items", "order_items", "item_meta", "product_lookup", "_refunds"}
    assert not os.path.exists(f"{s.root}/order_items") and not os.path.exists(f"{s.root}/_lines")
    plan = s._items.repartition(s.buckets, "order_item_id", "source_store").groupBy("order_item_id", "source_store").count()
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_a_table_read_plain_is_the_stored_one(spark, tmp_path):
    """Whether a plan reads a table in buckets or as it is made, it has the same rows; one that is
    stored is not made again."""
    driver_tables(spark, tmp_path)
    s = StoredShapes(spark, str(tmp_path), f"{tmp_path}/out")
    for name in ("order_posts", "order_meta", "order_items", "item_meta", "users", "user_meta"):
        plain = s.plain(name)
        stored = getattr(s, name)
        want = stored.select(*plain.columns)
        assert plain.exceptAll(want).count() == 0 and want.exceptAll(plain).count() == 0, name
        assert s.plain(name) is stored
