"""Layer tables, small in-memory tables and the metrics document."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, StructType

from strata import schemas
from strata.functions.text import plain_path
from strata.functions.values import nan_to_null
from strata.versions import current


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """One table from one or more Parquet folders or globs; rows of all paths are appended.

    Of a folder with versions the current one is read.
    """
    return spark.read.parquet(*[current(spark, path) or path for path in paths])


def read_first_parquet(spark: SparkSession, candidates: Iterable[str]) -> DataFrame:
    """The first readable of several locations, for example a near copy before a remote one."""
    tried = []
    for path in candidates:
        try:
            return read_parquet(spark, path)
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            tried.append(path)
    raise FileNotFoundError(f"no table at {', '.join(tried)}")


def with_source_file(df: DataFrame, name: str = "source_file") -> DataFrame:
    """Add the name of the file each row was read from."""
    return df.withColumn(name, plain_path("_metadata.file_name"))


def nan_columns_to_null(df: DataFrame) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, DoubleType)]
    return df.withColumns({name: nan_to_null(name) for name in doubles})


def from_records(spark: SparkSession, rows: Sequence, schema: StructType | str) -> DataFrame:
    """Small reference data as a table with an explicit schema; NaN becomes NULL."""
    return nan_columns_to_null(spark.createDataFrame(rows, schema))


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The metrics document as one row; sections it lacks are NULL."""
    return spark.read.schema(schemas.METRICS).json(path, multiLine=True)
