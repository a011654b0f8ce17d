"""Packet-table and vehicle-stream analytics on PySpark.

Every public operator takes DataFrames (or Columns) and returns a DataFrame
(or Column), so it composes with ``DataFrame.transform`` and runs on batch and
streaming input alike unless its docstring says otherwise.
"""
