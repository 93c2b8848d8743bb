"""salesmart — retail sales analytics as Spark DataFrame operators.

Layout:
  sources/    table readers, driver-table bindings, file/CSV/JSON sources, sinks
  functions/  Column -> Column helpers (text, numbers, calendar)
  operators/  DataFrame -> DataFrame operators (marts, quality, upsert,
              features, statistics, forecasting, ingest)
  plans/      named queries over the driver tables and their SQL oracles
  streaming/  Structured Streaming forms of the incremental load
"""

from salesmart.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
