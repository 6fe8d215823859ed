"""Table operators for record reconciliation and statistical reporting on Spark.

Every operator takes DataFrames and returns a DataFrame; nothing here runs a job
unless its docstring says so.
"""
