"""ledgerlight: usage metering and cost attribution as Spark DataFrame jobs.

Layout
------
functions/  column-level helpers (safe division, unit conversion, regex, JSON maps)
operators/  generic DataFrame -> DataFrame operators (spines, slicing, allocation,
            gap fill, priority pick, type-2 history, nested flattening, checks)
sources/    source scans, staging projections, seeds and the test-table bindings
plans/      the named result tables (daily rates, hourly/daily spend, cost per query,
            enriched query log, object access, warehouse history)
streaming/  incremental maintenance (watermark, upsert, append) and a Structured
            Streaming hourly-usage job
"""

__version__ = "0.1.0"
