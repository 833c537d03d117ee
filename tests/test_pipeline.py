import datetime as dt
import os
import tempfile
from decimal import Decimal as D

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows

SF = "/root/testdata/sf0.001"


def test_warehouse_refresh_order(spark):
    from martlane.suite import warehouse
    wh = warehouse(spark, SF)
    order = wh.refresh(["eur_orders", "return_by_product"])
    assert order.index("store_orders") < order.index("master_orders") < order.index("eur_orders")
    assert order.index("rates") < order.index("eur_orders")
    assert order.index("products") < order.index("return_by_product")
    assert wh.table("eur_orders").count() == wh.table("master_orders").count()


def test_rates_upsert_m4(spark):
    from martlane.plans.masters import seed_rates, upsert_rates
    t1 = dt.datetime(2024, 1, 1)
    t2 = dt.datetime(2024, 2, 1)
    first = upsert_rates(None, seed_rates(spark), now=t1)
    batch = spark.createDataFrame([("TRY", D("0.030000")), ("USD", D("0.920000"))],
                                  "currency_code string, rate_to_eur decimal(12,6)")
    second = {r["currency_code"]: r for r in upsert_rates(first, batch, now=t2).collect()}
    assert second["TRY"]["rate_to_eur"] == D("0.030000") and second["TRY"]["last_updated"] == t2
    assert second["USD"]["rate_to_eur"] == D("0.920000")
    assert second["EUR"]["last_updated"] == t1 and len(second) == 9


def test_customers_eur_strict_rate_job18(spark):
    from martlane.plans.masters import customers_eur
    rates = spark.createDataFrame([("EUR", D("1.000000"))], "currency_code string, rate_to_eur decimal(12,6)")
    c = spark.createDataFrame([(1, "TR", D("100.00"), D("50.00"))],
                              "customer_id int, source_store string, ltv decimal(12,2), aov decimal(12,2)")
    for col in ("full_name", "email", "billing_country", "billing_city", "orders_count",
                "units_total", "registered_at", "last_order_date"):
        c = c.withColumn(col, F.lit(None).cast("string"))
    loose = customers_eur(c, rates).first()
    strict = customers_eur(c, rates, strict_rate=True).first()
    assert (loose["ltv_eur"], loose["rate_to_eur"]) == (D("100.00"), D("1.000000"))
    assert strict["ltv_eur"] is None


def test_tsv_and_csv_readers_s5_s6(spark):
    from martlane.sources.readers import observe_count, read_quoted_csv, read_tsv
    d = tempfile.mkdtemp(prefix="readers-")
    tsv = os.path.join(d, "x.tsv")
    with open(tsv, "w") as fh:
        fh.write("status line\n1\tA\n2\t\\N\n")
    sch = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", T.StringType())])
    got = rows(read_tsv(spark, tsv, sch, columns=["v", "id"]))
    assert got == [("A", 1), (None, 2)]
    csvp = os.path.join(d, "x.csv")
    with open(csvp, "w") as fh:
        fh.write('"a","b"\n"x, y","he said ""hi"""\n')
    sch2 = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    assert rows(read_quoted_csv(spark, csvp, sch2)) == [("x, y", 'he said "hi"')]
    df = observe_count(read_tsv(spark, tsv, sch), "extract")
    assert df.count() == 2


def test_exports_m10(spark):
    from martlane.sources.sinks import export_csv, export_json, write_table
    d = tempfile.mkdtemp(prefix="sinks-")
    df = spark.createDataFrame([(1, "DE"), (2, "TR")], "id int, source_store string")
    write_table(df, os.path.join(d, "t"), partition_by=["source_store"])
    listed = set(os.listdir(os.path.join(d, "t")))
    assert {"_SUCCESS", "source_store=DE", "source_store=TR"} <= listed
    export_csv(df, os.path.join(d, "c"), sep="\t")
    export_json(df, os.path.join(d, "j"))
    assert spark.read.json(os.path.join(d, "j")).count() == 2


def test_ads_batches_cut_lineage(spark):
    from martlane.plans.warehouse import Warehouse
    from martlane.suite import shapes
    s = shapes(spark, SF)
    wh = Warehouse(spark, s, tempfile.mkdtemp(prefix="wh-"))
    a = s.ads_records(end="2024-01-21")
    b = s.ads_records(start="2024-01-16", spend_factor="1.1")
    out = wh.ads([a, b])
    keys = out.select("ad_name", "date_start")
    assert keys.count() == keys.distinct().count()


def test_warehouse_store_partitioning(spark):
    from martlane.plans.warehouse import Warehouse
    from martlane.suite import shapes
    root = tempfile.mkdtemp(prefix="wh-part-")
    wh = Warehouse(spark, shapes(spark, SF), root, partition_stores=True)
    m = wh.table("master_orders")
    version = os.listdir(os.path.join(root, "master_orders", "versions"))
    assert any(d.startswith("source_store=") for d in os.listdir(os.path.join(root, "master_orders", "versions", *version)))
    # a store filter prunes to its partition directory
    plan = m.filter(F.col("source_store") == "DE")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source_store" in plan


def test_missing_order_numbers_can_be_filled_x4(spark):
    from martlane import schemas as S
    from martlane.plans.masters import master_orders
    o = spark.createDataFrame([("DE", 1, " DE-1 "), ("DE", 2, "  "), ("DE", 3, None), ("PL", 4, "x")],
                              "source_store string, order_id bigint, order_number_formatted string")
    o = o.select("*", *[F.lit(None).cast("string").alias(c) for c in S.ORDERS_COLUMNS if c not in o.columns])
    kept = sorted(rows(master_orders(o), "order_id", "order_number_formatted"))
    filled = sorted(rows(master_orders(o, fill_missing=True), "order_id", "order_number_formatted"))
    assert kept == [(1, "DE-1")] and filled == [(1, "DE-1"), (2, "ORD2"), (3, "ORD3")]


def test_stores_without_a_database_are_left_out_a19(spark):
    from martlane.sources.readers import existing_stores
    spark.sql("CREATE DATABASE IF NOT EXISTS woo_de")
    try:
        assert existing_stores(spark, ["DE", "XX"]) == ["DE"]
    finally:
        spark.sql("DROP DATABASE woo_de")
