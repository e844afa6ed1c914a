"""siltlake: a config-driven lakehouse engine written on Spark DataFrames."""

__version__ = "0.1.0"
