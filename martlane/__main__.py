"""Refresh the marts: ``python -m martlane --stores DIR --out DIR [mart ...]``.

Reads the shop tables landed per store (``--stores``, see ``sources/landed.py``) or shapes
them from a directory of driver tables (``--tables``), then publishes the requested marts
(default: all) and everything they depend on, in dependency order.  Every refresh reads its
sources anew.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import time


def main(argv=None):
    ap = argparse.ArgumentParser(prog="martlane")
    given = ap.add_mutually_exclusive_group(required=True)
    given.add_argument("--stores", help="directory with a folder of landed tables for each store")
    given.add_argument("--tables", help="directory with <table>.parquet inputs")
    ap.add_argument("--out", required=True, help="root folder for the written marts")
    ap.add_argument("--master", default=None, help="Spark master (default: from the environment)")
    ap.add_argument("--partition-stores", action="store_true",
                    help="write store-level marts partitionBy(source_store)")
    ap.add_argument("--on-duplicate", choices=["fail", "skip", "quarantine"], default="fail",
                    help="what becomes of rows that repeat a mart's key")
    ap.add_argument("--on-reject", choices=["fail", "quarantine"], default="fail",
                    help="what becomes of ads documents that cannot be read")
    ap.add_argument("--bucketed", action="store_true",
                    help="deal landed attribute tables into buckets of their entity before the marts read them")
    ap.add_argument("--plan-ads", metavar="DAY", help="print the ads chunks still to be fetched up to a day, build nothing")
    ap.add_argument("marts", nargs="*", help="marts to build (default: all)")
    a = ap.parse_args(argv)
    from martlane.plans.warehouse import DEPENDS, Warehouse
    from martlane.session import get_spark
    from martlane.sources.bucketed import BucketedSources
    from martlane.sources.landed import LandedStores
    from martlane.sources.shop_shape import ShopShapes, materialize
    spark = get_spark(a.master)
    t0 = time.time()
    sources = (LandedStores(spark, a.stores) if a.stores
               else materialize(ShopShapes(spark, a.tables), f"{a.out.rstrip('/')}/_sources"))
    if a.bucketed:
        sources = BucketedSources(sources, f"{a.out.rstrip('/')}/_buckets")
    wh = Warehouse(spark, sources, a.out, partition_stores=a.partition_stores, on_duplicate=a.on_duplicate,
                   on_reject=a.on_reject)
    if a.plan_ads:
        chunks = wh.chunks_to_fetch(dt.date.fromisoformat(a.plan_ads)).orderBy("chunk_start").collect()
        print(json.dumps({"chunks": [[str(r["chunk_start"]), str(r["chunk_end"])] for r in chunks]}))
        return
    built = wh.refresh(a.marts or list(DEPENDS))
    print(json.dumps({"built": built, "rows": wh.counts, "root": a.out, "seconds": round(time.time() - t0, 1)}))


if __name__ == "__main__":
    main()
