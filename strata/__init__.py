"""strata: layered analytics over environmental observations, written as Spark DataFrames."""

__version__ = "0.1.0"
