"""How the items of an order are folded, and what numbers cost on the way."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlane.functions.numbers import clamped, lenient_decimal
from martlane.plans.orders import item_rollup
from martlane.session import PLAN_CONF, plan_settings

FACTS = ("order_item_id long, order_id long, source_store string, order_item_type string, product_text string, product_id long, "
         "qty_text string, subtotal_text string, fee_text string, cost_text string, parent_sku string, variation_sku string")


def _facts(spark):
    line = ("line_item", "7", 7)
    return spark.createDataFrame([
        (1, 10, "DE", *line, "2", "10.00", None, None, "P7", None), (2, 10, "DE", *line, "1", "5.50", None, None, "P7", "V1"),
        (3, 10, "DE", "shipping", None, None, None, None, None, "4.95", None, None),
        (4, 10, "DE", "fee", None, None, None, None, "2.50", None, None, None),
        (5, 11, "DE", *line, None, "abc", None, None, None, None), (6, 10, "FR", *line, "x", "1", None, None, "P7", None),
        (7, None, "FR", *line, "1", "1", None, None, "P7", None), (7, None, "FR", *line, "1", "1", None, None, "P7", None)], FACTS)


def test_items_are_folded_once(spark):
    roll = item_rollup(_facts(spark))
    plan = roll._jdf.queryExecution().executedPlan().toString()
    got = {(r.order_id, r.source_store): r for r in roll.collect()}
    assert "ObjectHashAggregate" not in plan and plan.count("SortAggregate(") == 1
    assert set(got) == {(10, "DE"), (11, "DE"), (10, "FR"), (None, "FR")}
    r = got[10, "DE"]
    assert (r.units_total, r.ordered_items_count, r.ordered_items_skus) == (2, 3, "P7, P7(V1)")
    assert (r.line_subtotal_sum, r.fee_sum, r.shipping_first) == (Decimal("15.50"), Decimal("2.50"), Decimal("4.95"))
    assert got[None, "FR"].line_subtotal_sum == 2 and got[11, "DE"].line_subtotal_sum == 0


def test_clamped_works_a_number_out_once(spark):
    texts = ["9999999999.994", "9999999999.995", "-9999999999.995", "12.345", "-12.345", "0.004999", None, "123456789012345.1"]
    want = ["9999999999.99", "9999999999.99", "-9999999999.99", "12.35", "-12.35", "0.00", None, "9999999999.99"]
    x = spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t").cast("decimal(30,10)").alias("x"))
    out = x.select(clamped("x", T.DecimalType(12, 2)).alias("y"))
    assert [r.y for r in out.collect()] == [w if w is None else Decimal(w) for w in want]
    # no rounding of its own: the cast does it
    assert "round" not in out._jdf.queryExecution().optimizedPlan().toString().lower()


def test_lenient_decimal_extracts_its_head_three_times(spark):
    plan = spark.createDataFrame([("1",)], "t string").select(lenient_decimal("t").alias("n"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_extract(") == 3


def test_plan_settings_leave_what_is_set(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "65535")
        plan_settings(spark)
        assert spark.conf.get(key) == "65535"
        spark.conf.unset(key)
        plan_settings(spark)
        assert spark.conf.get(key) == PLAN_CONF[key]
    finally:
        spark.conf.set(key, before)
