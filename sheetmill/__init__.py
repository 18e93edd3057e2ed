"""sheetmill: tidy tables and derived metrics from published spreadsheets and nested files, on Spark.

Sub-packages
  functions  scalar Column expressions: period and date parsing, text clean-up, safe arithmetic
  operators  DataFrame -> DataFrame operators: cell grids, reshape, joins, aggregates,
             period-over-period, data contracts
  sources    readers (workbooks, nested JSON, HTML pages, landing manifests) and the
             bronze/silver/gold publishing sink
  plans      end-to-end silver and gold builds composed from the operators
  streaming  incremental landing of newly arrived source files
"""

__version__ = "0.1.0"
