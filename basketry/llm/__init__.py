"""Operators of a training-data pipeline on Spark; one module per operator.

Nothing else in the library imports this package.  Python code runs only
inside tasks, on Arrow batches that Spark has partitioned; what tasks
exchange goes through Spark's shuffles and tables under
``spark.checkpoint.dir``.
"""
