"""pvspark: drug-safety analytics expressed as Spark DataFrame / SQL / Structured Streaming jobs.

Layout
------
sources/    readers, raw-payload extraction, the driver-table adapters
functions/  Column-valued helpers (rules, text matching, dates, vectors)
operators/  DataFrame -> DataFrame operators (silver cleaning, dedup, marts, KPIs,
            quality suites, retrieval, models, sinks)
streaming/  Structured Streaming ingest (validate, quarantine, bounded dedup)
plans/      the named queries registered in ``__spark_entry__`` plus their DuckDB oracles
"""

__version__ = "0.1.0"
