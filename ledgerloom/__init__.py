"""Data pipelines and the reusable DataFrame operators they are made of.

Every operator takes DataFrames (or Columns) and returns a DataFrame (or Column);
no module keeps a session of its own.
"""
