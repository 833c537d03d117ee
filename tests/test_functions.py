import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from martlane.functions.dates import lenient_datetime, month_chunks, plan_ads_window
from martlane.functions.numbers import (lenient_decimal, net_margin, net_profit, net_revenue,
                                        positive_number_text)
from martlane.functions.text import (clean_sku, currency_of_store, customer_number, full_name,
                                     order_number, pim_sku, sku_label, url_host,
                                     valid_order_number)


def one_col(spark, values, expr, schema="x string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_sku_label_fx9(spark):
    data = [("A", None), ("A", "B"), ("A", "A"), (None, "B"), ("", "B"), ("A", ""), (None, "")]
    df = spark.createDataFrame([(i, p, v) for i, (p, v) in enumerate(data)], "i int, p string, v string")
    got = [r[0] for r in df.orderBy("i").select(sku_label("p", "v")).collect()]
    assert got == ["A", "A(B)", "A", "B", "(B)", "A()", "(Unregistered SKU)"]


def test_pim_sku_fx11(spark):
    data = [(None, "P", "V"), (0, "P", "V"), (7, None, "V"), (7, "P", None), (7, "P", "V"), (7, None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "i int, vid bigint, p string, v string")
    got = [r[0] for r in df.orderBy("i").select(pim_sku("vid", "p", "v")).collect()]
    assert got == ["P", "P", "V", "P", "P(V)", None]


def test_order_number_fx12(spark):
    data = [("TR", "shop_order", 5, None), ("NL", "shop_order_refund", 7, None),
            ("OPS", "shop_order_refund", 7, None), ("DE", "shop_order", 9, "301-DE-9")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)],
                               "i int, s string, t string, id bigint, m string")
    got = [r[0] for r in df.orderBy("i").select(order_number("s", "t", "id", "m")).collect()]
    assert got == ["5", "101-REFUND-7", "-REFUND-7", "301-DE-9"]


def test_customer_number_fx13(spark):
    df = spark.createDataFrame([(0, "TR", 5), (1, "BEFRLU", 5), (2, "XX", 5)], "i int, s string, c bigint")
    got = [r[0] for r in df.orderBy("i").select(customer_number("s", "c")).collect()]
    assert got == ["5", "241-BEFRLU-5", "XX-5"]


def test_url_host_fx14(spark):
    got = one_col(spark, ["https://t.ex.com/x", "t.ex.com/a/b/c", "abc", None], url_host("x"))
    assert got == ["t.ex.com", "b", "abc", None]


def test_valid_order_number_fx16(spark):
    got = one_col(spark, ["X1", "", "  ", "NULL", None], valid_order_number("x"))
    assert [bool(g) for g in got] == [True, False, False, False, False]


def test_positive_number_text_fx17(spark):
    got = one_col(spark, ["12", "12.5", "12,5", "0", "-3", "abc", ""], positive_number_text("x"))
    assert [bool(g) for g in got] == [True, True, False, False, False, False, False]


def test_lenient_decimal_fx18(spark):
    got = one_col(spark, ["12abc", "abc", "", "-3.5", None], lenient_decimal("x", 12, 2))
    assert got == [D("12.00"), D("0.00"), D("0.00"), D("-3.50"), None]


def _metrics(spark, gross, disc, refd, cogs):
    df = spark.createDataFrame([(D(gross), D(disc), D(refd), D(cogs))],
                               "g decimal(12,2), d decimal(12,2), r decimal(12,2), c decimal(12,2)")
    z = F.lit(0).cast("decimal(12,2)")
    r = df.select(net_revenue("g", "d", "r").alias("rev"),
                  net_profit("g", "d", "r", "c", z, z, z).alias("p"),
                  net_margin("g", "d", "r", "c", z, z, z).alias("m")).first()
    return r["rev"], r["p"], r["m"]


def test_profit_metrics_fx19_21(spark):
    assert _metrics(spark, "100", "10", "5", "20") == (D("95.00"), D("75.00"), D("78.95"))
    assert _metrics(spark, "0", "0", "0", "10")[1:] == (D("-10.00"), D("0.00"))
    assert _metrics(spark, "0.01", "0", "0", "1000")[1:] == (D("-999.99"), D("-9999.99"))


def test_full_name_fx22(spark):
    data = [("", "X", None, None, None, None), ("A", "", None, None, None, None),
            (None, None, "B", None, None, None), (None, None, None, None, None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)],
                               "i int, a string, b string, c string, d string, e string, f string")
    got = [r[0] for r in df.orderBy("i").select(full_name("a", "b", "c", "d", "e", "f")).collect()]
    assert got == ["X", "A", "B", ""]


def test_lenient_datetime_fx23_24(spark):
    got = one_col(spark, ["2024-01-05 01:02:03", "0000-00-00 00:00:00", "", "junk", None,
                          "2024-01-05", "2024"], lenient_datetime("x"))
    assert got == [dt.datetime(2024, 1, 5, 1, 2, 3), None, None, None, None,
                   dt.datetime(2024, 1, 5), None]


def test_currency_of_store_fx28(spark):
    got = one_col(spark, ["TR", "BEFRLU", "SE", "UK"], currency_of_store("x"))
    assert got == ["TRY", "EUR", "SEK", "EUR"]
    assert one_col(spark, ["UK"], currency_of_store("x", uk_as_gbp=True)) == ["GBP"]


def test_clean_sku(spark):
    assert one_col(spark, [" A B\r\n", "C"], clean_sku("x")) == ["AB", "C"]


def test_plan_ads_window_fx40(spark):
    today = dt.date(2024, 5, 1)
    assert plan_ads_window(None, today)[0] == today - dt.timedelta(days=60)
    same = spark.createDataFrame([("2024-05-01",)], "date_stop string")
    assert plan_ads_window(same, today)[0] == today - dt.timedelta(days=60)
    before = spark.createDataFrame([("2024-04-28",)], "date_stop string")
    assert plan_ads_window(before, today)[0] == dt.date(2024, 4, 29)


def test_month_chunks_fx41():
    got = month_chunks(dt.date(2024, 1, 15), dt.date(2024, 3, 1))
    assert got == [(dt.date(2024, 1, 15), dt.date(2024, 2, 14)), (dt.date(2024, 2, 15), dt.date(2024, 3, 1))]


def test_ads_window_chunks_month_end_d5(spark):
    """Chunk starts are iterated month steps clipped at month ends (01-31 -> 02-29 -> 03-29)."""
    from martlane.plans.ads import ads_window_chunks
    ads = spark.createDataFrame([("2024-01-30",)], "date_stop string")
    got = [(r[0], r[1]) for r in ads_window_chunks(ads, dt.date(2024, 4, 10)).collect()]
    assert got == [(dt.date(2024, 1, 31), dt.date(2024, 2, 28)),
                   (dt.date(2024, 2, 29), dt.date(2024, 3, 28)),
                   (dt.date(2024, 3, 29), dt.date(2024, 4, 10))]
    assert [tuple(c) for c in month_chunks(dt.date(2024, 1, 31), dt.date(2024, 4, 10))] == got
    empty = spark.createDataFrame([], "date_stop string")
    first = ads_window_chunks(empty, dt.date(2024, 4, 10)).orderBy("chunk_start").first()
    assert first[0] == dt.date(2024, 4, 10) - dt.timedelta(days=60)
