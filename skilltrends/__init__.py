"""skilltrends — job-posting skills analytics on Spark.

Stages (each a DataFrame -> DataFrame function):
  sources/    JSON-lines scans, file-name dates, sinks, rule files
  functions/  column-expression builders (text, terms, urls)
  operators/  normalisation, passage selection, extraction, cleaning, view, planning, quality
  plans/      the registered queries over the test tables and their SQL oracles
  streaming/  incremental ingestion with Structured Streaming
"""

__all__ = ["session"]
