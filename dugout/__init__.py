"""Season analytics on Spark: feeds to raw, staging and mart tables, reports and checks.

Everything is a function from DataFrames (or Columns) to DataFrames (or Columns):

* ``functions``  column helpers: parsing, rates, display text, fixed lookups
* ``operators``  table helpers: dedup, ranking, top-n, reshaping, quality, monitoring
* ``sources``    feed flatteners, message envelopes, table readers and writers
* ``streaming``  landing, incremental staging and rates on Structured Streaming
* ``plans``      staging models, marts, home-run predictions, summaries, the full run
"""
