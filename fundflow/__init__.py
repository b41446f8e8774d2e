"""fundflow: money-flow analytics on Spark.

Entry points:

* ``fundflow.sources.loader.load_filings`` / ``read_raw_tables`` - filings to raw tables
* ``fundflow.streaming.filings.start_filing_load`` - incremental loads
* ``fundflow.plans.pipeline.Models`` - staging, tags, flow and marts as DataFrames
* ``fundflow.plans.reports`` / ``fundflow.plans.quality`` - report queries and checks
* ``fundflow.queries`` - the registered queries and their DuckDB oracles
"""
