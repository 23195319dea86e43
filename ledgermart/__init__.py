"""ledgermart: periodic ledger marts, governed measures and controls on Spark.

Every public operator takes and returns DataFrames (or Columns) and takes its
column names as parameters, so the same operator runs on the balance domain
(monthly balance files, macro series) and on any other star schema.

Sub-packages:

* ``functions`` – Column helpers (dates, text, numbers, keys, type names).
* ``operators`` – DataFrame operators (versioning, joins, aggregates, calendar,
  population, measures, quality controls).
* ``sources``   – readers and sinks (archives, catalog / series JSON, typed CSV,
  landing, run logs, contracts).
* ``plans``     – composed models (core, star schema, reports) and the recipes
  that run them on the driver's tables.
* ``streaming`` – incremental landing with Structured Streaming.
"""

from ledgermart.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
