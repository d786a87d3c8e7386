"""quaylake: medallion lakehouse operators for Spark.

Landed JSON pages, database tables and CSV files become bronze tables, clean
silver tables, gold summaries and analyst reports. Every operator takes and
returns lazy DataFrames unless its docstring says that it runs a job.
"""
