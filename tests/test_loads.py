"""Loads: documents that cannot be read, key rules, declared types, the mart kept by day, the
ledger of chunks, extracts, collation, state across micro-batches."""
import datetime as dt
import json
import os
import re
import time

import pytest
from pyspark.sql import functions as F

from martlane.functions.collation import distinct_texts, folded, like, no_case, no_case_no_accent, plain, plain_spelling
from martlane.operators.load import FAIL, KEEP, QUARANTINE, SKIP, LoadError, LoadRule, load
from martlane.plans import ads_documents as D
from martlane.plans.ads import ADS_KEYS, ads_mart, ads_window_chunks, flatten_ads, high_water_mark, load_ads, upsert_ads
from martlane.plans.ads_ledger import chunk_states, missing_chunks
from martlane.plans.mart_types import COLUMNS, SchemaError, conform, mart_type
from martlane.plans.warehouse import Warehouse
from martlane.sources.landed import LandedStores
from martlane.sources.readers import escape_tsv, read_extract, unescape_tsv, write_tsv
from martlane.sources.sinks import read_published
from martlane.streaming.ads_stream import read_ads_table, run_ads_stream, run_first_wins_stream
from tests.test_refresh import land, land_shared

T0 = dt.datetime(2024, 5, 1)
RECORD = {"campaign_name": "c", "ad_name": "a", "adset_name": "s", "impressions": "1", "clicks": "2",
          "date_start": "2024-01-01", "date_stop": "2024-01-01"}


def rec(**other):
    return dict(RECORD, **other)


def page(*records):
    return json.dumps({"data": list(records)})


DOCUMENTS = {
    "good": (page(rec(ad_name="g")), [D.OK]), "cut": (page(rec(), rec())[:-40], [D.UNREADABLE]), "empty": ("", [D.EMPTY]),
    "blank": (" \n", [D.EMPTY]), "error": ('{"error":{"code":1}}', [D.OK]), "null": ("null", [D.WRONG_SHAPE]),
    "list": (f"[{page(rec())}]", [D.WRONG_SHAPE]), "two": (page(rec()) * 2, [D.UNREADABLE]),
    "no_array": ('{"data":{"x":1}}', [D.WRONG_SHAPE]), "nulls": (page(None, rec(ad_name="n")), [D.OK]),
    "lines": (page(rec(ad_name="l1")) + "\n" + page(rec(ad_name="l2")) + "\n" + page(rec())[:-9], [D.OK, D.OK, D.UNREADABLE]),
    "pretty": (json.dumps({"data": [rec(ad_name="p")]}, indent=1), [D.OK]),
    "pretty_cut": (json.dumps({"data": [rec()]}, indent=1)[:-4], [D.UNREADABLE]),
    "bytes": (page(rec()).encode().replace(b'"a"', b'"\xff"'), [D.NOT_UTF8]),
}


def land_documents(folder, documents):
    os.makedirs(folder, exist_ok=True)
    for name, text in documents.items():
        with open(f"{folder}/{name}.json", "wb") as f:
            f.write(text if isinstance(text, bytes) else text.encode())


def test_every_document_has_an_outcome(spark, tmp_path):
    land_documents(tmp_path, {k: v[0] for k, v in DOCUMENTS.items()})
    docs = D.read_documents(spark, str(tmp_path))
    got = {}
    for r in docs.orderBy("document", "line").collect():
        got.setdefault(os.path.basename(r.document)[:-5], []).append(r.outcome)
    assert got == {k: v[1] for k, v in DOCUMENTS.items()}
    assert sorted(r.ad_name for r in D.records(docs).collect()) == ["g", "l1", "l2", "n", "p"]
    bad = {(os.path.basename(r.document)[:-5], r.line): r.reason for r in D.rejects(docs).collect()}
    assert bad["cut", 0] == D.UNREADABLE and bad["lines", 2] == D.UNREADABLE and len(bad) == 10
    counts = docs.agg(*D.document_counts()).first()
    assert (counts.documents, counts.rejects, counts.records) == (16, 10, 5)


def test_ads_load_fails_or_sets_aside(spark, tmp_path):
    folder = f"{tmp_path}/in/shared/ads_json"
    land_documents(folder, {"a": page(rec(), rec(ad_name="b")), "cut": page(rec(ad_name="c"))[:-5]})
    src = LandedStores(spark, f"{tmp_path}/in")
    with pytest.raises(ValueError, match="cut.json"):
        Warehouse(spark, src, f"{tmp_path}/out", now=T0).refresh(["advertisements"])
    assert not os.path.exists(f"{tmp_path}/out/advertisements")
    wh = Warehouse(spark, src, f"{tmp_path}/out", now=T0, on_reject=QUARANTINE)
    wh.refresh(["advertisements"])
    assert wh.counts["ads_records"] == 2 and wh.counts["ads_rejects"] == 1 and wh.counts["ads_documents"] == 2
    assert [(os.path.basename(r.document), r.reason) for r in read_published(spark, f"{tmp_path}/out/ads_rejects").collect()] == [
        ("cut.json", D.UNREADABLE)]
    # only what is new or changed is read; a document that was mended is loaded
    wh.refresh(["advertisements"])
    assert wh.counts["ads_documents"] == 0
    time.sleep(0.05)
    land_documents(folder, {"cut": page(rec(ad_name="c")), "new": page(rec(ad_name="d", date_start="2024-01-02"))})
    wh.refresh(["advertisements"])
    assert wh.counts["ads_documents"] == 2 and wh.counts["ads_records"] == 2
    assert sorted(r.ad_name for r in read_published(spark, f"{tmp_path}/out/advertisements").collect()) == ["a", "b", "c", "d"]


def data_bytes(path):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(f"{path}/data") for f in fs if f.startswith("part")}


def ads_rows(spark, day, ads, clicks=1):
    return flatten_ads(spark.createDataFrame(
        [("c", f"ad{i}", "s", "1", str(clicks), "1.00", None, [], str(day), str(day), i) for i in range(ads)],
        "campaign_name string, ad_name string, adset_name string, impressions string, clicks string, spend string, cpc string, "
        "purchase_roas array<struct<action_type:string,value:string>>, date_start string, date_stop string, position long"))


@pytest.mark.parametrize("days", [2, 12])
def test_one_day_batch_writes_one_day(spark, tmp_path, days):
    mart = ads_mart(spark, f"{tmp_path}/ads")
    start = dt.date(2024, 1, 1)
    batch = None
    for k in range(days):
        rows = ads_rows(spark, start + dt.timedelta(days=k), 40)
        batch = rows if batch is None else batch.unionByName(rows)
    assert load_ads(mart, batch, F.lit(T0).cast("timestamp_ntz")) == days
    before = data_bytes(mart.path)
    one = ads_rows(spark, start, 50, clicks=7)
    later = dt.datetime(2024, 6, 1)
    assert load_ads(mart, one, F.lit(later).cast("timestamp_ntz")) == 1
    new = {f: n for f, n in data_bytes(mart.path).items() if f not in before}
    assert {f.split("/")[-2] for f in new} == {"date_start=2024-01-01"} and sum(new.values()) < 20_000
    want = upsert_ads(upsert_ads(None, batch), one)
    got = mart.read()
    assert sorted(map(str, got.drop("created_at").collect())) == sorted(map(str, want.select(got.drop("created_at").columns).collect()))
    # rows that were there keep the time they came
    assert {r.created_at for r in got.filter("ad_name = 'ad3'").collect()} == {T0}
    assert {r.created_at for r in got.filter("ad_name = 'ad45'").collect()} == {later}
    # only the current state and the one before it stay
    load_ads(mart, one)
    load_ads(mart, one)
    assert len(os.listdir(f"{mart.path}/lists")) == 2
    assert len([f for f in data_bytes(mart.path) if "date_start=2024-01-01" in f]) <= 2 * len(new)
    assert mart.read().count() == 40 * (days - 1) + 50


def test_reader_sees_one_state_and_failure_leaves_it(spark, tmp_path):
    mart = ads_mart(spark, f"{tmp_path}/ads")
    assert mart.read().count() == 0 and mart.days().count() == 0
    load_ads(mart, ads_rows(spark, dt.date(2024, 1, 1), 3))
    held = mart.read()
    broken = ads_rows(spark, dt.date(2024, 1, 1), 5).withColumn("clicks", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        load_ads(mart, broken)
    assert mart.read().count() == 3
    load_ads(mart, ads_rows(spark, dt.date(2024, 1, 1), 6))
    assert held.count() == 3 and mart.read().count() == 6  # the older reader still finds its files
    with pytest.raises(ValueError, match="key"):
        load_ads(mart, ads_rows(spark, dt.date(2024, 1, 1), 1), keys=["ad_name"])
    no_day = ads_rows(spark, "", 2)
    load_ads(mart, no_day)
    assert mart.read().filter("date_start is null").count() == 2 and mart.read().count() == 8


def test_mark_needs_no_row(spark, tmp_path):
    mart = ads_mart(spark, f"{tmp_path}/ads")
    load_ads(mart, ads_rows(spark, dt.date(2024, 1, 5), 3).unionByName(ads_rows(spark, dt.date(2024, 2, 7), 2)))
    mark = high_water_mark(mart)
    assert mark.first()[0] == dt.date(2024, 2, 7)
    plan = mark._jdf.queryExecution().executedPlan().toString()
    assert "/lists/" in plan and "/data" not in plan
    chunks = ads_window_chunks(mark, dt.date(2024, 3, 1)).collect()
    assert [(str(a), str(b)) for a, b in chunks] == [("2024-02-08", "2024-03-01")]


def test_missing_chunks_come_back(spark):
    def chunks(*rows):
        return spark.createDataFrame([(dt.date.fromisoformat(a), dt.date.fromisoformat(b), ok) for a, b, ok in rows],
                                     "chunk_start date, chunk_end date, landed boolean")

    def missing(frame, **kw):
        return sorted((str(a), str(b)) for a, b in missing_chunks(frame, dt.date(2024, 5, 20), **kw).collect())

    states = chunks(("2024-01-01", "2024-01-31", True), ("2024-02-01", "2024-02-29", False), ("2024-03-01", "2024-03-31", True),
                    ("2024-04-01", "2024-04-30", False))
    assert missing(states) == [("2024-02-01", "2024-02-29"), ("2024-04-01", "2024-04-30"), ("2024-05-01", "2024-05-20")]
    assert missing(chunks()) == [("2024-03-21", "2024-04-20"), ("2024-04-21", "2024-05-20")]
    assert missing(chunks(("2024-05-01", "2024-05-20", True)), first=dt.date(2024, 5, 2)) == []
    assert missing(chunks(("2024-05-10", "2024-05-20", True)), first=dt.date(2024, 5, 10)) == []
    # overlapping chunks, one day open, a failed chunk that another one covers
    assert missing(chunks(("2024-05-01", "2024-05-09", True), ("2024-05-05", "2024-05-12", True), ("2024-05-06", "2024-05-08", False),
                          ("2024-05-14", "2024-05-20", True))) == [("2024-05-13", "2024-05-13")]
    # month ends: starts follow each other by a month, clipped
    assert missing(chunks(), first=dt.date(2024, 1, 31))[:2] == [("2024-01-31", "2024-02-28"), ("2024-02-29", "2024-03-28")]
    assert missing(chunks(), first=dt.date(2024, 6, 1)) == []


def test_chunk_states(spark):
    rows = [("x/ads_2024-01-01_to_2024-01-31_0.json", D.OK), ("x/ads_2024-01-01_to_2024-01-31_1.json", D.UNREADABLE),
            ("x/ads_2024-02-01_to_2024-02-29_0.json", D.OK), ("x/other.json", D.OK), ("x/ads_2024-02-31_to_2024-03-31_0.json", D.OK)]
    got = {str(r.chunk_start): (r.landed, r.documents) for r in chunk_states(spark.createDataFrame(rows, "document string, outcome string")).collect()}
    assert got == {"2024-01-01": (False, 2), "2024-02-01": (True, 1)}


def test_failed_chunks_drive_the_next_plan(spark, tmp_path, capsys):
    from martlane.__main__ import main
    folder, out = f"{tmp_path}/in/shared/ads_json", f"{tmp_path}/out"
    name = lambda a, b: f"ads_{a}_to_{b}_0"
    land_documents(folder, {name("2024-01-01", "2024-01-31"): page(rec()), name("2024-02-01", "2024-02-29"): page(rec(date_start="2024-02-03"))[:-2]})
    wh = Warehouse(spark, LandedStores(spark, f"{tmp_path}/in"), out, now=T0, on_reject=QUARANTINE)
    wh.refresh(["advertisements"])

    def planned():
        main(["--stores", f"{tmp_path}/in", "--out", out, "--plan-ads", "2024-03-10"])
        return json.loads(capsys.readouterr().out.strip().splitlines()[-1])["chunks"]

    assert planned() == [["2024-02-01", "2024-02-29"], ["2024-03-01", "2024-03-10"]]
    time.sleep(0.05)
    land_documents(folder, {name("2024-02-01", "2024-02-29"): page(rec(date_start="2024-02-03"))})
    wh.refresh(["advertisements"])
    assert planned() == [["2024-03-01", "2024-03-10"]]
    assert wh.table("advertisements").count() == 2


def test_landed_stores_by_one_scan(spark, tmp_path):
    root, flat = f"{tmp_path}/in", f"{tmp_path}/flat"
    land(spark, root, "DE", [1, 2])
    land(spark, root, "TR", [1], status=False)
    for store in ("DE", "TR"):
        for table in os.listdir(f"{root}/{store}"):
            spark.read.parquet(f"{root}/{store}/{table}").write.parquet(f"{flat}/{table}/source_store={store}")
    many, one = LandedStores(spark, root), LandedStores(spark, flat, one_scan=True)
    for table in os.listdir(f"{root}/DE"):
        a, b = getattr(many, table), getattr(one, table)
        assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect())), table
        assert b._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    own = LandedStores(spark, flat, stores=["TR"], one_scan=True).order_posts
    assert {r.source_store for r in own.collect()} == {"TR"}
    assert re.search(r"PartitionFilters: \[[^\]]*source_store", own._jdf.queryExecution().executedPlan().toString())


ROWS = [("DE", 1, "a", 2), ("DE", 1, "b", 1), ("DE", 1, "b", 1), ("DE", 2, "c", 1), (None, 3, "d", 1), ("DE", None, "e", 5), ("FR", 1, None, None)]


def load_frame(spark):
    return spark.createDataFrame(ROWS, "store string, id long, row_number string, extract int")


def test_first_row_wins(spark):
    rule = LoadRule(("store", "id"), ("extract",), SKIP, KEEP)
    loaded = load(load_frame(spark), rule)
    assert sorted(map(tuple, loaded.kept.collect()), key=str) == sorted(
        [("DE", 1, "b", 1), ("DE", 2, "c", 1), (None, 3, "d", 1), ("DE", None, "e", 5), ("FR", 1, None, None)], key=str)
    assert loaded.rejects.count() == 0 and loaded.counts == {"read": 7, "kept": 5, "duplicate": 2, "null_key": 2}


def test_rejects_name_reason_and_winner(spark):
    loaded = load(load_frame(spark), LoadRule(("store", "id"), ("extract",), QUARANTINE, QUARANTINE))
    got = sorted((r.id or 0, r.row_number, r.reject_reason, json.loads(r.winner)["extract"] if r.winner else None)
                 for r in loaded.rejects.collect())
    assert got == [(0, "e", "NULL in key", None), (1, "a", "duplicate key", 1), (1, "b", "duplicate key", 1), (3, "d", "NULL in key", None)]
    assert loaded.kept.count() == 3 and loaded.counts["kept"] == 3


def test_load_fails(spark):
    with pytest.raises(LoadError, match="duplicate key: 2 rows"):
        load(load_frame(spark), LoadRule(("store", "id"), ("extract",)))
    with pytest.raises(LoadError, match="NULL in key: 2 rows"):
        load(load_frame(spark), LoadRule(("store", "id"), ("extract",), SKIP, FAIL))
    with pytest.raises(ValueError, match="unknown outcome"):
        load(load_frame(spark), LoadRule(("store",), (), "ignore"))
    empty = load(load_frame(spark).limit(0), LoadRule(("store", "id"), ("extract",)))
    assert empty.kept.count() == 0 and empty.counts["read"] == 0


def test_warehouse_skips_or_sets_aside_duplicates(spark, tmp_path):
    root = f"{tmp_path}/in"
    land(spark, root, "DE", [1, 1, 2])
    land_shared(spark, root)
    wh = Warehouse(spark, LandedStores(spark, root), f"{tmp_path}/skip", now=T0, on_duplicate=SKIP)
    wh.refresh(["master_orders"])
    assert sorted(r.order_id for r in wh.table("master_orders").collect()) == [1, 2]
    assert wh.counts["store_orders_duplicates"] > 0 and not os.path.exists(f"{tmp_path}/skip/store_orders_rejects")
    wh = Warehouse(spark, LandedStores(spark, root), f"{tmp_path}/aside", now=T0, on_duplicate=QUARANTINE)
    wh.refresh(["store_orders"])
    assert wh.counts["store_orders"] == 2
    aside = read_published(spark, f"{tmp_path}/aside/store_orders_rejects")
    assert aside.count() == wh.counts["store_orders_duplicates"] and {r.order_id for r in aside.collect()} == {1}


def test_wrong_type_fails_before_the_pointer_moves(spark, tmp_path):
    root = f"{tmp_path}/in"
    land(spark, root, "DE", [1])
    land_shared(spark, root)
    src = LandedStores(spark, root)
    Warehouse(spark, src, f"{tmp_path}/out", now=T0).refresh(["store_orders"])
    before = os.listdir(f"{tmp_path}/out/store_orders/versions")

    def broken(change):
        wh = Warehouse(spark, src, f"{tmp_path}/out", now=T0)
        build = wh._build
        wh._build = lambda name: change(build(name)) if name == "store_orders" else build(name)
        return wh

    for change, says in ((lambda d: d.withColumn("gross_total", F.col("gross_total").cast("double")), "gross_total is double"),
                         (lambda d: d.drop("channel"), "channel is missing"), (lambda d: d.withColumn("x", F.lit(1)), "x is not declared")):
        with pytest.raises(SchemaError, match=says):
            broken(change).refresh(["store_orders"])
        assert os.listdir(f"{tmp_path}/out/store_orders/versions") == before  # nothing was written
    with pytest.raises(ValueError, match="NULL in NOT NULL columns .*order_id"):
        broken(lambda d: d.withColumn("order_id", F.lit(None).cast("long"))).refresh(["store_orders"])
    assert read_published(spark, f"{tmp_path}/out/store_orders").count() == 1


def test_declared_types(spark):
    for name in COLUMNS:
        kind = mart_type(name)
        empty = spark.createDataFrame([], kind)
        assert conform(empty.select(*reversed(kind.names)), kind, name).schema.names == kind.names
    assert mart_type("item_facts") is None
    assert not mart_type("master_orders")["order_number_formatted"].nullable


def jobs_of(spark, run):
    """How many jobs a call starts."""
    group = f"g{time.time_ns()}"
    spark.sparkContext.setJobGroup(group, "count")
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_rows_are_counted_by_the_write(spark, tmp_path):
    wh = Warehouse(spark, None, f"{tmp_path}/out", now=T0)
    rows = spark.range(7).select(F.col("id").alias("customer_id")).select(
        *[F.col("customer_id") if f.name == "customer_id" else F.lit("DE").alias(f.name) if f.name == "source_store"
          else F.lit(None).cast(f.dataType).alias(f.name) for f in mart_type("master_customers")]).coalesce(1)
    plain_write = jobs_of(spark, lambda: rows.write.parquet(f"{tmp_path}/plain"))
    published = jobs_of(spark, lambda: wh._publish("master_customers", rows))
    assert wh.counts["master_customers"] == 7 and published == plain_write


HARD = ["", "plain", "tab\there", "line\nfeed", "back\\slash", "\\t", "\\\\n", "\\N", 'quote "x"', "a,b", " pad ", "cr\r", "Ωé"]


@pytest.mark.parametrize("kind", ["tsv", "csv"])
def test_extract_round_trip(spark, tmp_path, kind):
    rows = [(i, v, dt.datetime(2024, 1, 1, 10, i)) for i, v in enumerate(HARD if kind == "tsv" else [h for h in HARD if "\r" not in h])]
    rows.append((None, None, None))
    df = spark.createDataFrame(rows, "ID bigint, v string, post_date timestamp_ntz")
    if kind == "tsv":
        write_tsv(df, f"{tmp_path}/x")
    else:
        df.write.option("header", True).option("quote", '"').option("escape", '"').option(
            "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{tmp_path}/x")
    got = read_extract(spark, f"{tmp_path}/x", ["ID bigint", "v string", "missing string", "post_date timestamp_ntz"], kind)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(a, b, None, c) for a, b, c in rows], key=str)
    assert df.select(unescape_tsv(escape_tsv("v")).alias("v")).exceptAll(df.select("v")).count() == 0


def test_stores_from_text_extracts(spark, tmp_path):
    """The marts over TSV and CSV extracts are those over the same tables as parquet."""
    roots = {k: f"{tmp_path}/{k}" for k in ("parquet", "text")}
    land(spark, roots["parquet"], "DE", [1, 2, 3])
    land(spark, roots["parquet"], "TR", [1], status=False)
    for root in roots.values():
        land_shared(spark, root)
    for store, kind in (("DE", "tsv"), ("TR", "csv")):
        for table in os.listdir(f"{roots['parquet']}/{store}"):
            df, path = spark.read.parquet(f"{roots['parquet']}/{store}/{table}"), f"{roots['text']}/{store}/{table}.{kind}"
            write_tsv(df, path) if kind == "tsv" else df.write.option("header", True).option("escape", '"').csv(path)
    marts = ["master_orders", "master_order_items", "customers_eur", "eur_orders"]
    out = {}
    for name, root in roots.items():
        wh = Warehouse(spark, LandedStores(spark, root), f"{tmp_path}/out_{name}", now=T0)
        wh.refresh(marts)
        out[name] = [sorted(map(str, wh.table(m).collect())) for m in marts]
    assert out["text"] == out["parquet"] and out["text"][0]


def _odd_texts():
    """Texts of letters that collations treat in ways of their own, alone and beside each other."""
    parts = ["", "a", "A", "é", "É", "e", "e\u0301", "P", "Ｐ", "ṕ", "ς", "σ", "Σ", "İ", "i", "I", "ı", "й", "и", "и\u0306", "\u0306",
             "a\u0363", "ß", "ss", "ẞ", "ﬁ", "fi", "²", "2", "\n", "\x00", " ", "l·", "ĺ·", "ŀ", "K", "k", "-"]
    return [x + y for x in parts for y in parts] + [x + y + "a" for x in parts for y in parts]


def test_distinct_texts_are_those_of_the_collation(spark):
    texts = [(store, t) for store in ("A", None) for t in _odd_texts() if store or len(t) < 3] + [("A", None), ("A", None), ("B", None)]
    rows = spark.createDataFrame(texts, "s string, t string").repartition(3)
    for collate in (no_case, no_case_no_accent):
        want = {r["s"]: r["n"] for r in rows.select("s", collate("t").alias("t")).distinct().groupBy("s").agg(F.count("*").alias("n")).collect()}
        found = distinct_texts(rows, ["s"], "t", collate)
        assert {r["s"]: r["n"] for r in found.groupBy("s").agg(F.count("*").alias("n")).collect()} == want
        # the column has the collation: a DISTINCT of it finds nothing more
        assert found.distinct().count() == found.count() == sum(want.values())


def test_printable_texts_have_one_spelling(spark):
    """No two printable texts are equal but by their case, so hashing their lower case is enough."""
    pairs = spark.range(95 * 95).select(F.concat(F.char(F.col("id") % 95 + 32), F.char(F.floor(F.col("id") / 95) + 32)).alias("t"))
    low = pairs.select(F.lower("t").alias("t")).distinct()
    assert low.count() == pairs.select(no_case_no_accent("t").alias("t")).distinct().count() == 69 * 69
    assert low.filter(plain_spelling("t").eqNullSafe(F.col("t"))).count() == 69 * 69


def test_plain_texts_are_not_sorted_by_a_collation(spark):
    rows = spark.createDataFrame([("A", "P1"), ("A", "p1"), ("A", "Ṕ1"), ("B", "P1")], "s string, t string")
    for collate, n in ((no_case, 3), (no_case_no_accent, 2)):
        found = distinct_texts(rows, ["s"], "t", collate)
        assert found.count() == n
        assert "Sort" not in found._jdf.queryExecution().executedPlan().toString()


def test_collation(spark):
    a = spark.createDataFrame([("ABC-é", 1), ("abc-E", 2), ("Abc-ë", 3), ("x", 4), (None, 5)], "sku string, i int")
    b = spark.createDataFrame([("aBc-E",), ("X",), (None,)], "other string")
    hit = lambda c: sorted(r.i for r in a.join(b, c("sku") == c("other")).collect())
    assert hit(lambda x: F.col(x)) == [] and hit(no_case) == [2, 4] and hit(no_case_no_accent) == [1, 2, 3, 4]
    groups = lambda c: a.select(c("sku").alias("k")).distinct().count()
    assert (groups(F.col), groups(no_case), groups(no_case_no_accent)) == (5, 5, 3)
    assert sorted(r.i for r in a.filter(like("sku", "%C-É")).collect()) == [1, 2, 3]
    assert sorted(r.i for r in a.filter(like("sku", "%C-É", accents=True)).collect()) == [1]
    joined = a.join(b, no_case_no_accent("sku") == no_case_no_accent("other"))
    assert "SortMergeJoin" in (p := joined._jdf.queryExecution().executedPlan().toString()) or "HashJoin" in p
    assert a.select(plain(no_case("sku")).alias("k")).filter("k = 'abc-e'").count() == 0
    words = spark.createDataFrame([("ÀÉÎÕÜ ñ ş İ Ṕ é ß",)], "w string")
    assert words.select(folded("w")).first()[0] == "aeiou n s i p e ß"


def test_stream_parks_or_fails_on_a_cut_document(spark, tmp_path):
    land_documents(f"{tmp_path}/in", {"good": page(rec()), "cut": page(rec(ad_name="b"))[:-3], "empty": "\n"})
    table = f"{tmp_path}/ads"
    with pytest.raises(Exception, match="cannot be read"):
        run_ads_stream(spark, f"{tmp_path}/in", table, checkpoint=f"{tmp_path}/ck")
    # nothing was committed: the same files come again
    run_ads_stream(spark, f"{tmp_path}/in", table, checkpoint=f"{tmp_path}/ck", on_reject=QUARANTINE)
    assert [r.ad_name for r in read_ads_table(spark, table).collect()] == ["a"]
    parked = spark.read.parquet(f"{table}_rejects").collect()
    assert sorted((os.path.basename(r.document), r.reason) for r in parked) == [("cut.json", D.UNREADABLE), ("empty.json", D.EMPTY)]


def test_first_row_wins_over_micro_batches(spark, tmp_path):
    """Late, repeated and too late records against a batch result."""
    landing, out = f"{tmp_path}/in", f"{tmp_path}/out"

    def day(k):
        return str(dt.date(2024, 1, 1) + dt.timedelta(days=k))

    def step(name, *records):
        land_documents(landing, {name: page(*records)})
        return run_first_wins_stream(spark, landing, out, f"{tmp_path}/ck", delay="2 days")

    def rows():
        df = spark.read.parquet(out)
        return sorted((r.ad_name, str(r.date_start), r.clicks) for r in df.collect())

    def of(ad, k, clicks):
        return rec(ad_name=ad, date_start=day(k), date_stop=day(k), clicks=str(clicks))

    first = [of("a", 0, 1), of("a", 0, 2), of("b", 0, 3), of("a", 1, 4)]
    second = [of("a", 0, 5), of("c", 0, 6), of("d", 2, 7)]          # repeated, late but in time
    third = [of("z", 9, 8)]                                           # closes the days before
    fourth = [of("a", 0, 9), of("late", 0, 10), of("a", 1, 11), of("e", 9, 12), rec(ad_name=None)]
    step("1", *first)
    step("2", *second)
    step("3", *third)
    closed = [("a", day(0), 1), ("a", day(1), 4), ("b", day(0), 3), ("c", day(0), 6), ("d", day(2), 7)]
    assert rows() == closed
    said = step("4", *fourth)
    assert said["too_late"] >= 1 and rows() == closed
    step("5", of("y", 20, 1))
    batch = upsert_ads(None, flatten_ads(D.records(D.read_documents(spark, landing))), keys=ADS_KEYS)
    want = sorted((r.ad_name, str(r.date_start), r.clicks) for r in batch.filter(
        "ad_name is not null and ad_name not in ('late', 'y')").collect())
    assert rows() == want
    assert spark.read.parquet(f"{out}_unkeyed").count() == 1
