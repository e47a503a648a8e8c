"""catalog/table scans and small constructors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from footfall.operators.visits import VISIT_KEY
from footfall.schemas import DIM_COLUMNS, DIM_DISTRICT
from footfall.sinks.bucketed import read_bucketed


def _table(spark: SparkSession, table: str, fmt: str) -> DataFrame:
    """A catalog table, or a path (anything with a '/') in format ``fmt``."""
    return spark.read.format(fmt).load(table) if "/" in table else spark.table(table)


def read_dim(spark: SparkSession, table: str = "dim_district", fmt: str = "orc") -> DataFrame:
    """The five columns of the cell -> district dimension (a catalog table or path)."""
    return _table(spark, table, fmt).select(*DIM_COLUMNS)


def read_residence(spark: SparkSession, table: str = "residence", fmt: str = "orc") -> DataFrame:
    """(district_id, imsi) of everyone labelled resident or staff (both attrs)."""
    return _table(spark, table, fmt).select("district_id", "imsi")


def read_residence_bucketed(spark: SparkSession, path: str, buckets: int, fmt: str = "orc") -> DataFrame:
    """S6 from ``sinks.tables.save_residence_bucketed``; the number of buckets is the writer's."""
    return read_bucketed(spark, [path.rstrip("/")], VISIT_KEY, buckets, fmt).select("district_id", "imsi")


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """An empty frame with a schema."""
    return spark.createDataFrame([], schema)


def seed_dim(dim: DataFrame) -> DataFrame:
    """A dimension frame coerced to the full dimension schema, stamped update_time."""
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in DIM_DISTRICT.fields]
    return dim.select(*cols, F.current_timestamp().alias("update_time"))
