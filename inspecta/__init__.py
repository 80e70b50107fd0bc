"""inspecta — vehicle-inspection analytics as Spark DataFrame / SQL / ML jobs.

Sub-packages:
  sources    feed readers (NDJSON, zip), corrupt-record split, table sinks
  functions  Column-level helpers (last test, mileage, age, counts, calendar)
  operators  enrich, dedupe + merge, counts, classifier, forecaster
  plans      end-to-end jobs and registered views
  streaming  incremental ingest / upsert and budget alerts
"""

__version__ = "0.1.0"
