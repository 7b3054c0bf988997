"""Business analytics over Spark DataFrames: every operator is ``f(DataFrame.., params) -> DataFrame``."""
