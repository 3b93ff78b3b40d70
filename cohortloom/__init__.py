"""Preparing, scoring and monitoring tabular data as Spark plans.

Every public function takes and returns DataFrames or Columns; nothing whose
size follows the data leaves the executors.
"""
