import pytest
from pyspark.sql import functions as F

from martlane.operators.eav import eav_pivot, eav_unpivot
from martlane.operators.merge import assert_unique, first_wins, union_stores, update_from, upsert
from tests.conftest import rows


def test_pivot_string_max_fx1_and_missing_meta_fx2(spark):
    meta = spark.createDataFrame([(1, "k", "9"), (1, "k", "10"), (1, "z", "x")],
                                 "entity_id bigint, meta_key string, meta_value string")
    wide = eav_pivot(meta, "entity_id", {"k": "k"})
    assert rows(wide) == [(1, "9")]
    posts = spark.createDataFrame([(1,), (2,)], "entity_id bigint")
    j = posts.join(wide, "entity_id", "left").orderBy("entity_id")
    assert rows(j) == [(1, "9"), (2, None)]


def test_pivot_unpivot_round_trip(spark):
    df = spark.createDataFrame([(1, "a", "b"), (2, "c", None)], "id bigint, x string, y string")
    back = eav_pivot(eav_unpivot(df, "id"), "id", {"x": "x", "y": "y"}).orderBy("id")
    assert rows(back) == [(1, "a", "b"), (2, "c", None)]


def test_update_from_fx36(spark):
    t = spark.createDataFrame([(1, "old"), (2, "old")], "id int, v string")
    s = spark.createDataFrame([(1, None)], "id int, v string")
    left = update_from(t, s, ["id"], ["v"], how="left").orderBy("id")
    inner = update_from(t, s, ["id"], ["v"], how="inner").orderBy("id")
    assert rows(left) == [(1, None), (2, None)]
    assert rows(inner) == [(1, None), (2, "old")]


def _ads(spark, data):
    return spark.createDataFrame(data, "ad_name string, date_start string, campaign_name string, clicks int, position int")


def test_upsert_fx44_fx45(spark):
    target = _ads(spark, [("a", "d1", "c1", 1, 0)]).drop("position")
    batch = _ads(spark, [("a", "d1", "c2", 5, 1), ("a", "d1", "c3", 9, 2), ("b", "d1", "c4", 2, 3)])
    once = upsert(target, batch, ["ad_name", "date_start"], ["clicks"], order_col="position")
    expect = [("a", "d1", "c1", 5), ("b", "d1", "c4", 2)]
    assert sorted(rows(once, "ad_name", "date_start", "campaign_name", "clicks")) == expect
    twice = upsert(once, batch, ["ad_name", "date_start"], ["clicks"], order_col="position")
    assert sorted(rows(twice, "ad_name", "date_start", "campaign_name", "clicks")) == expect


def test_first_wins_hot_key(spark):
    df = spark.range(0, 3000).select(F.lit("hot").alias("k"), F.col("id").alias("pos"),
                                     (F.col("id") * 2).alias("v"))
    assert rows(first_wins(df, ["k"], "pos")) == [("hot", 0, 0)]


def test_union_stores_fx46_fx47(spark):
    tr = spark.createDataFrame([(1, "n1"), (2, "n2")], "order_item_id int, order_item_name string")
    de = spark.createDataFrame([(1,), (2,), (3,)], "order_item_id int")
    u = union_stores({"TR": tr, "DE": de, "FR": None}, ["TR", "DE", "FR"])
    assert u.count() == 5
    assert sorted(set(rows(u, "source_store"))) == [("DE",), ("TR",)]
    assert rows(u.filter("source_store = 'DE'").select("order_item_name").distinct()) == [(None,)]


def test_assert_unique(spark):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(ValueError):
        assert_unique(df, ["k"])
    assert_unique(spark.createDataFrame([(1,), (2,)], "k int"), ["k"])


def test_assert_not_null_m12(spark):
    from martlane.operators.merge import assert_not_null
    with pytest.raises(ValueError):
        assert_not_null(spark.createDataFrame([("a",), (None,)], "x string"), ["x"])


def test_existing_stores_s8(spark):
    from martlane.sources.readers import existing_stores
    spark.sql("CREATE DATABASE IF NOT EXISTS woo_de")
    try:
        assert existing_stores(spark, ["DE", "FR"]) == ["DE"]
    finally:
        spark.sql("DROP DATABASE IF EXISTS woo_de")
