"""PySpark-native data work around running machine-learning systems.

Every operator is a plain function over DataFrames and Columns; Spark does the
partitioning, shuffling, windowing and state.
"""
