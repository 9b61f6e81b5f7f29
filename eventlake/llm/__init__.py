"""Training-data operators: dedup, filtering, scoring and tokenisation on Spark.

Each module holds one operator by the method its docstring names, plus the
query that applies it to a whole table. Nothing outside this package imports it.
"""
