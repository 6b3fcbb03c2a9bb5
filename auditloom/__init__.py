"""Set-based auditing of object collections scored by a model, on PySpark."""
