"""Queries that apply the library to the given tables. Importing this package registers them."""

from workload import daily, functions, grids, quality, reshaping, storage, trends  # noqa: F401
from workload.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
