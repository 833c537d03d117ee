"""martlane: e-commerce analytics marts expressed as Spark DataFrame plans.

Layout:
  functions/  column expressions (text, numbers, dates, attribute decoding)
  operators/  reusable relational building blocks (EAV pivot, upsert, update_from, lists)
  sources/    readers (JDBC, TSV, CSV, landed JSON) and the driver-table shaper
  plans/      the marts: orders, items, customers, masters, EUR, products, returns, ads
  streaming/  incremental ads ingest with Structured Streaming (availableNow)
"""

__version__ = "0.1.0"
