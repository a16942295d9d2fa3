"""Comment analytics on Spark DataFrames.

Every public function takes DataFrames and parameters and returns a lazy
DataFrame, except where a docstring says that it runs a job.
"""
