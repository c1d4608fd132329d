"""ledgerline: order, stock and event analytics on Spark DataFrames.

Every operator takes and returns ``pyspark.sql.DataFrame`` objects so that
Catalyst sees one declarative plan per query; Python only runs inside the
keyed sequential folds (``operators.fold``) whose semantics need it.
"""

__version__ = "0.1.0"
