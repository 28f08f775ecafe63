"""sheetcraft: spreadsheet-log and program-coding analytics on Spark DataFrames.

Layout:
  functions/  Column builders (text tests, time parsing, JSON paths, URLs, regions)
  operators/  DataFrame -> DataFrame steps (referrals, programs, reshape, headers)
  sources/    workbook scan and sink, parquet/CSV, refresh-if-stale materialization
  plans/      domain adapters over the driver tables and the query catalog
  streaming/  incremental ingestion of new workbooks with an available-now trigger
"""

__version__ = "0.1.0"
