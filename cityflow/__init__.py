"""cityflow: streaming and batch analytics for live urban data, on Spark DataFrames.

Every operator is a function ``f(df, ...) -> DataFrame`` (or a column
expression), fits ``DataFrame.transform`` and runs on batch and streaming
frames alike wherever the semantics allow it.
"""

__version__ = "0.1.0"
