"""Queries of the loads: landed documents and extracts, key rules, the ads mart kept by day,
collation.  Registered with the others in ``suite``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlane.suite_common import ADS_SPLIT_A, ADS_SPLIT_B, ADS_TODAY, NULLABLE_INTS, _fresh_root, as_double, shapes, warehouse

#: Event ids that one landed document spans.
PAGE = 50_000
#: First day that the ads load asked for, and the chunks whose documents came cut short.
ADS_ASKED_FROM = "2023-10-15"
CUT_CHUNKS = ["2023-11-15", "2024-01-15"]
FIRST_WINS_DELAY = 3


def _documents(records: DataFrame, *keys: str) -> DataFrame:
    """API documents, their records in order: the keys, ``page``, ``body``."""
    fields = [c for c in records.columns if c not in ("position", *set(keys) - {"date_start"})]
    page = F.floor(F.col("position") / PAGE).alias("page")
    data = F.array_sort(F.collect_list(F.struct("position", F.struct(*fields).alias("r"))))
    return records.groupBy(*keys, page).agg(
        F.to_json(F.struct(F.transform(data, lambda x: x["r"]).alias("data"))).alias("body"))


def _land(documents: DataFrame, folder: str) -> None:
    """One file for each row (``document`` its name, ``body`` its text)."""
    documents.repartition("document").write.partitionBy("document").text(folder)


def _name() -> Column:
    """The landed document's name, from its path."""
    return F.regexp_extract("document", "document=([^/]+)", 1)


def q_ads_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed documents, some cut short, blank or without data: what was read of each, and why not."""
    from martlane.plans.ads import flatten_ads
    from martlane.plans.ads_documents import read_documents, records, rejects
    from martlane.session import stage
    root = _fresh_root(spark, "ads_documents")
    docs = _documents(shapes(spark, sf_dir).ads_records(), "date_start")
    day = F.dayofmonth(F.to_date("date_start")) % 7
    body = (F.when(day == 0, F.expr("left(body, length(body) div 2)")).when(day == 3, "")
            .when(day == 5, '{"error":{"code":17}}').otherwise(F.col("body")))
    _land(docs.select(F.concat("date_start", F.lit("_"), "page").alias("document"), body.alias("body")), root)
    documents = stage(read_documents(spark, root))
    read = flatten_ads(records(documents)).groupBy(F.col("position.document").alias("document")).agg(
        F.count("*").alias("records"), F.sum("spend").alias("spend"))
    bad = rejects(documents).select("document", "reason")
    names = documents.select("document", _name().alias("name"))
    return as_double(names.join(read, "document", "left").join(bad, "document", "left").select(
        F.col("name").alias("document"), "reason", F.coalesce("records", F.lit(0).cast("long")).alias("records"), "spend"))


def q_ads_missing_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunks asked for, and again those whose documents came cut short: two months."""
    from martlane.plans.ads_documents import read_documents, records
    from martlane.plans.ads_ledger import chunk_states, document_name, missing_chunks, month_chunks
    from martlane.session import stage
    root, today = _fresh_root(spark, "ads_chunks"), dt.date.fromisoformat(ADS_TODAY)
    first = dt.date.fromisoformat(ADS_ASKED_FROM)
    chunks = spark.range(1).select(F.inline(month_chunks(F.lit(first), F.lit(today))))
    days = chunks.select("*", F.explode(F.sequence("chunk_start", "chunk_end")).alias("day")).withColumn(
        "date_start", F.col("day").cast("string")).drop("day")
    rows = shapes(spark, sf_dir).ads_records().join(days, "date_start")
    full = _documents(rows, "chunk_start", "chunk_end")
    empty = chunks.join(full, ["chunk_start", "chunk_end"], "left_anti").select(
        "*", F.lit(0).cast("long").alias("page"), F.lit('{"data":[]}').alias("body"))
    cut = F.col("chunk_start").cast("string").isin(CUT_CHUNKS)
    docs = full.unionByName(empty).select(
        document_name(F.col("chunk_start"), F.col("chunk_end"), F.col("page")).alias("document"),
        F.when(cut, F.expr("left(body, length(body) - 1)")).otherwise(F.col("body")).alias("body"))
    _land(docs, root)
    documents = stage(read_documents(spark, root).withColumn("document", _name()))
    states = chunk_states(documents)
    count = records(documents).groupBy(F.col("position.document").alias("document")).agg(F.count("*").alias("n"))
    read = (documents.join(count, "document", "left")
            .groupBy(F.to_date(F.substring("document", 5, 10)).alias("chunk_start")).agg(F.sum(F.coalesce("n", F.lit(0))).alias("records")))
    again = missing_chunks(states, today).withColumn("state", F.lit("to be asked for"))
    landed = states.filter("landed").select("chunk_start", "chunk_end", F.lit("landed").alias("state"))
    return (landed.unionByName(again).join(read, "chunk_start", "left")
            .select(F.col("chunk_start").cast("string").alias("chunk_start"), F.col("chunk_end").cast("string").alias("chunk_end"),
                    "state", F.coalesce("records", F.lit(0)).cast("long").alias("records")))


def _two_ads_batches(spark, sf_dir):
    from martlane.plans.ads import ads_mart, flatten_ads, load_ads
    s = shapes(spark, sf_dir)
    mart = ads_mart(spark, _fresh_root(spark, "ads_mart"))
    load_ads(mart, flatten_ads(s.ads_records(end=ADS_SPLIT_A)))
    load_ads(mart, flatten_ads(s.ads_records(start=ADS_SPLIT_B, spend_factor="1.1")))
    return mart


def q_ads_daily_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two batches of ``ads_upsert`` through the mart kept by day."""
    ads = _two_ads_batches(spark, sf_dir).read().drop("created_at")
    return as_double(ads.withColumns({c: F.col(c).cast("string") for c in ("date_start", "date_stop")}))


def q_ads_day_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and high-water mark of each day, from the mart's list of days."""
    return _two_ads_batches(spark, sf_dir).days().select(
        F.col("day").cast("string").alias("day"), "rows", F.col("mark").cast("string").alias("mark"))


def q_ads_first_wins_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first row of each ad and day from a stream of documents; days still open are not in it."""
    from martlane.plans.ads import ADS_TABLE
    from martlane.streaming.ads_stream import run_first_wins_stream
    root = _fresh_root(spark, "ads_first_wins")
    docs = _documents(shapes(spark, sf_dir).ads_records(), "date_start")
    name = F.concat("date_start", F.lit("_"), F.lpad(F.col("page").cast("string"), 12, "0"))
    _land(docs.select(name.alias("document"), "body"), f"{root}/landing")
    run_first_wins_stream(spark, f"{root}/landing/*", f"{root}/out", f"{root}/checkpoint", delay=f"{FIRST_WINS_DELAY} days")
    out = spark.read.schema(ADS_TABLE).parquet(f"{root}/out").select(*ADS_TABLE.names)
    return as_double(out.withColumns({c: F.col(c).cast("string") for c in ("date_start", "date_stop")}))


def q_load_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store orders and items of three extracts that overlap, under the rule "first row wins":
    the rows kept and those set aside."""
    from martlane.operators.load import QUARANTINE, LoadRule, load
    s = shapes(spark, sf_dir)

    def extracts(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("extract", F.lit(1))
        again = rows.filter("id % 3 = 0").withColumns({"label": F.lit("changed"), "extract": F.lit(2)})
        same = rows.filter("id % 5 = 0").withColumn("extract", F.lit(3))
        lost = rows.filter("id % 101 = 0").withColumns({"id": F.lit(None).cast("long"), "extract": F.lit(4)})
        return rows.unionByName(again).unionByName(same).unionByName(lost)

    # read as they are made: the rule's keys are not those of the buckets
    orders = extracts(s.plain("order_posts").select("source_store", F.col("ID").alias("id"), F.col("post_type").alias("label")))
    items = extracts(s.plain("order_items").select("source_store", F.col("order_item_id").alias("id"), F.col("order_item_type").alias("label")))
    rule = LoadRule(("source_store", "id"), ("extract",), QUARANTINE, QUARANTINE)
    out = None
    for name, rows in (("orders", orders), ("items", items)):
        loaded = load(rows, rule)
        both = loaded.kept.withColumn("outcome", F.lit("kept")).unionByName(
            loaded.rejects.withColumnRenamed("reject_reason", "outcome").drop("winner")).withColumn("tab", F.lit(name))
        out = both if out is None else out.unionByName(both)
    return as_double(out, {"id"})


def _respelled(c: Column, by: Column) -> Column:
    """A SKU in another case, or with an accent, for two thirds of the rows."""
    return F.when(by % 3 == 1, F.lower(c)).when(by % 3 == 2, F.replace(c, F.lit("P"), F.lit("Ṕ"))).otherwise(c)


def q_returns_by_product_collated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returns whose SKUs are spelled in several ways, matched without regard to case and accent."""
    from martlane.functions.collation import no_case_no_accent
    from martlane.plans.returns import returns_by_product
    wh = warehouse(spark, sf_dir)
    sku = F.col("return_requested_items_sku")
    returns = wh.table("returns").withColumn("return_requested_items_sku", _respelled(sku, F.col("return_id")))
    return returns_by_product(returns, wh.table("products"), collate=no_case_no_accent)


def q_distinct_skus_collated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct SKUs of each store under three ways to compare text, and two ways of LIKE."""
    from martlane.functions.collation import distinct_texts, like, no_case, no_case_no_accent
    from martlane.session import stage
    rows = shapes(spark, sf_dir).plain("store_product_lookup").filter("sku <> ''").select("source_store", "product_id", "sku")
    rows = rows.unionByName(rows.withColumn("sku", _respelled(F.col("sku"), F.col("product_id"))))
    # each spelling is compared once, however many rows have it
    skus = stage(rows.groupBy("source_store", "sku").agg(F.count("*").alias("n")))

    def rows_where(is_like: Column) -> Column:
        return F.sum(F.when(is_like, F.col("n")).otherwise(0))

    out = skus.groupBy("source_store").agg(
        F.count("*").alias("binary_skus"), rows_where(like("sku", "P1%")).alias("like_no_accent"),
        rows_where(like("sku", "p1%", accents=True)).alias("like_no_case"))
    for name, collate in (("no_case_skus", no_case), ("no_accent_skus", no_case_no_accent)):
        out = out.join(distinct_texts(skus, ["source_store"], "sku", collate).groupBy("source_store").agg(
            F.count("*").alias(name)), "source_store")
    return out


def q_order_units_collated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct products and labels of each order where two products in two share a SKU but for
    its case."""
    from martlane.functions.collation import folded
    from martlane.plans.orders import build_orders
    from martlane.sources.shop_shape import VARIATION_ID_BASE
    s = shapes(spark, sf_dir)
    shared = F.concat(F.lit("P"), F.floor(F.col("product_id") / 2).cast("string"), F.lit("-"), F.col("source_store"))
    shared = F.when(F.col("product_id") % 2 == 1, F.lower(shared)).otherwise(shared)
    lookup = s.store_product_lookup.withColumn(
        "sku", F.when((F.col("sku") != "") & (F.col("product_id") < VARIATION_ID_BASE), shared).otherwise(F.col("sku")))
    o = build_orders(s.order_posts, s.order_meta, s.order_items, s.item_meta, lookup, fold=folded)
    return o.select("source_store", "order_id", "units_total", "ordered_items_skus")


#: How the landed stores lie: two as text extracts, one not at all, the rest as parquet.
EXTRACTS, ABSENT = {"FR": "tsv", "IT": "csv"}, "FI"
#: Text extracts and exports are as long as their digits: they are written compressed.
TEXT_CODEC = "gzip"


def _landed_extracts(spark: SparkSession, sf_dir: str, names: list[str]):
    from martlane.session import shuffles_freed
    from martlane.sources.landed import LANDED_CODEC, LandedStores
    from martlane.sources.readers import write_tsv
    s, root = shapes(spark, sf_dir), _fresh_root(spark, "landed")
    for name in names:
        table = s.plain(name)
        rest = table.filter(~F.col("source_store").isin(*EXTRACTS, ABSENT))
        with shuffles_freed(spark):
            rest.write.partitionBy("source_store").parquet(f"{root}/{name}", compression=LANDED_CODEC)
            for store, kind in EXTRACTS.items():
                own, path = table.filter(F.col("source_store") == store).drop("source_store"), f"{root}/{name}/source_store={store}.{kind}"
                if kind == "tsv":
                    write_tsv(own, path, TEXT_CODEC)
                else:
                    own.write.option("header", True).option("quote", '"').option("escape", '"').option("quoteAll", False).csv(
                        path, compression=TEXT_CODEC)
    return LandedStores(spark, root, store_path="{root}/{table}/source_store={store}")


def q_extracted_store_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of landed stores, one of them a TSV and one a CSV extract."""
    from martlane.plans.orders import build_orders
    with shapes(spark, sf_dir).passing():
        src = _landed_extracts(spark, sf_dir, ["order_posts", "order_meta", "order_items", "item_meta", "store_product_lookup"])
    return as_double(build_orders(src.order_posts, src.order_meta, src.order_items, src.item_meta, src.store_product_lookup), NULLABLE_INTS)


def q_landed_store_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Master customers of the stores that are there: no marketplace, one store absent."""
    from martlane import schemas as S
    from martlane.plans.customers import build_customers
    from martlane.plans.masters import master_customers
    src = _landed_extracts(spark, sf_dir, ["users", "user_meta", "order_posts", "order_meta", "order_items"])
    src.stores = S.MASTER_CUSTOMER_STORES
    return as_double(master_customers(build_customers(src.users, src.user_meta, src.order_posts, src.order_meta, src.order_items)))


def q_master_orders_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Master orders where a missing order number is made from the id instead of left out."""
    from martlane.plans.masters import master_orders
    return as_double(master_orders(warehouse(spark, sf_dir).table("store_orders"), fill_missing=True), NULLABLE_INTS)


def q_export_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order mart exported as TSV, CSV and JSON, each read again with its declared types."""
    from martlane.plans.mart_types import mart_type
    from martlane.sources.readers import read_quoted_csv, read_tsv
    from martlane.sources.sinks import export_csv, export_json
    orders, root = warehouse(spark, sf_dir).table("store_orders"), _fresh_root(spark, "exports")
    names = ["source_store", "order_id", "order_date", "channel", "units_total", "gross_total", "net_margin"]
    kind = mart_type("store_orders")
    kind = type(kind)([kind[n] for n in names])
    orders = orders.select(*names)
    export_csv(orders, f"{root}/tsv", sep="\t", compression=TEXT_CODEC)
    export_csv(orders, f"{root}/csv", compression=TEXT_CODEC)
    export_json(orders, f"{root}/json", compression=TEXT_CODEC)
    read = {"tsv": read_tsv(spark, f"{root}/tsv", kind), "csv": read_quoted_csv(spark, f"{root}/csv", kind),
            "json": spark.read.schema(kind).json(f"{root}/json")}
    out = None
    for name, df in read.items():
        df = df.withColumn("format", F.lit(name))
        out = df if out is None else out.unionByName(df)
    return as_double(out)


QUERIES = {
    "ads_rejects": q_ads_rejects,
    "ads_missing_chunks": q_ads_missing_chunks,
    "ads_daily_upsert": q_ads_daily_upsert,
    "ads_day_list": q_ads_day_list,
    "ads_first_wins_stream": q_ads_first_wins_stream,
    "load_first_wins": q_load_first_wins,
    "returns_by_product_collated": q_returns_by_product_collated,
    "distinct_skus_collated": q_distinct_skus_collated,
    "order_units_collated": q_order_units_collated,
    "extracted_store_orders": q_extracted_store_orders,
    "landed_store_customers": q_landed_store_customers,
    "master_orders_filled": q_master_orders_filled,
    "export_round_trip": q_export_round_trip,
}
