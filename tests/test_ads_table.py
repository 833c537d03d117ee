"""The stored ads table: no way of spelling its path, of loading it or of failing loses history."""
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from martlane import schemas as S
from martlane.plans.ads import ADS_TABLE, apply_ads_batch, stored_ads
from martlane.streaming.ads_stream import read_ads_table, run_ads_stream

DAY = [dt.date(2024, 1, d) for d in range(1, 6)]


def ad(name, day, clicks=1, campaign="c"):
    return (campaign, name, "s", 10, clicks, None, None, None, day, day)


def frame(spark, rows):
    return spark.createDataFrame(rows, ADS_TABLE)


def stored(spark, path):
    return sorted((r.ad_name, str(r.date_start), r.clicks, r.campaign_name) for r in read_ads_table(spark, path).collect())


@pytest.mark.parametrize("scheme", ["{}", "file:{}", "file://{}"])
def test_second_batch_keeps_the_other_days(spark, tmp_path, scheme):
    path = scheme.format(f"{tmp_path}/ads")
    assert stored_ads(spark, path) is None
    assert apply_ads_batch(spark, path, frame(spark, [ad("a", DAY[0]), ad("b", DAY[0]), ad("a", DAY[1])])) == 2
    # a new call on one day: a's campaign stays, b and the other day too
    assert apply_ads_batch(spark, path, frame(spark, [ad("a", DAY[0], 7, "other")])) == 1
    assert stored(spark, path) == [("a", "2024-01-01", 7, "c"), ("a", "2024-01-02", 1, "c"), ("b", "2024-01-01", 1, "c")]
    assert apply_ads_batch(spark, path, frame(spark, [])) == 0
    assert len(stored(spark, path)) == 3


def test_rows_without_a_date_are_kept(spark, tmp_path):
    path = f"{tmp_path}/ads"
    apply_ads_batch(spark, path, frame(spark, [ad("a", None), ad("b", None), ad("c", DAY[2])]))
    for _ in range(2):  # applied twice: the same table
        apply_ads_batch(spark, path, frame(spark, [ad("d", None), ad("a", DAY[2])]))
    assert [r[:2] for r in stored(spark, path)] == [
        ("a", "2024-01-03"), ("a", "None"), ("b", "None"), ("c", "2024-01-03"), ("d", "None")]


def test_a_failing_read_is_not_an_empty_table(spark, tmp_path):
    path = tmp_path / "ads"
    (path / "date_start=2024-01-01").mkdir(parents=True)
    (path / "date_start=2024-01-01" / "part-0.parquet").write_text("no parquet at all")
    with pytest.raises(Exception, match="(?i)parquet"):
        apply_ads_batch(spark, str(path), frame(spark, [ad("a", DAY[0])]))
    assert (path / "date_start=2024-01-01" / "part-0.parquet").read_text() == "no parquet at all"


def test_session_setting_does_not_matter(spark, tmp_path):
    path = f"{tmp_path}/ads"
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    for mode in ("static", "dynamic"):
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
        apply_ads_batch(spark, path, frame(spark, [ad(mode, DAY[0]), ad("x", DAY[3])]))
        apply_ads_batch(spark, path, frame(spark, [ad("y", DAY[4])]))
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    assert [r[0] for r in stored(spark, path)] == ["dynamic", "static", "x", "y"]


@pytest.mark.parametrize("scheme", ["{}", "file:{}", "file://{}"])
def test_stream_keeps_history(spark, tmp_path, scheme):
    landing = tmp_path / "landing"
    landing.mkdir()
    path = scheme.format(f"{tmp_path}/ads")
    record = {"campaign_name": "c", "ad_name": "a", "adset_name": "s", "impressions": "1", "clicks": "2"}
    for k, days in enumerate((["2024-01-01", "2024-01-02", "not a date"], ["2024-01-02"], ["junk"])):
        data = [dict(record, ad_name=f"a{k}", date_start=d, date_stop=d) for d in days]
        (landing / f"{k}.json").write_text(json.dumps({"data": data}))
        run_ads_stream(spark, str(landing), path, checkpoint=f"{tmp_path}/ck")
    assert [r[:2] for r in stored(spark, path)] == [
        ("a0", "2024-01-01"), ("a0", "2024-01-02"), ("a0", "None"), ("a1", "2024-01-02"), ("a2", "None")]


def test_pruned_to_the_days_of_the_batch(spark, tmp_path):
    path = f"{tmp_path}/ads"
    apply_ads_batch(spark, path, frame(spark, [ad("a", d) for d in DAY]))
    plan = stored_ads(spark, path).filter(F.col("date_start").between(DAY[1], DAY[2]))
    assert "PartitionFilters: [isnotnull(date_start" in plan._jdf.queryExecution().executedPlan().toString()
    assert S.ADS_COLUMNS == [f.name for f in ADS_TABLE.fields]
