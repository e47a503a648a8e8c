"""Shared column rules of the training-data operators."""

from __future__ import annotations

import os
import shutil
import string
import tempfile
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.session import scratch_path

#: The white space between words, as a Java/RE2 class body and as characters.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    """Words between white space of a non-null text; one empty string if there are none."""
    return F.split(F.btrim(text, F.lit(SPACES)), SPACE_CLASS + "+")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again: cuts the lineage there."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, key: str, name: str) -> DataFrame:
    """``df`` as a table bucketed by ``key`` in the shared folder: joins by that key do not move it."""
    spark, n = df.sparkSession, partitions(df.sparkSession)
    path = scratch_path(spark, name)
    known = "footfall_" + path.rsplit("-", 1)[-1]
    df.repartition(n, key).write.bucketBy(n, key).option("path", path).saveAsTable(known)
    return spark.table(known)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per Spark application."""
    sc = spark.sparkContext
    if not getattr(sc, "_footfall_shipped", False):
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        sc.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="footfall-ship-"), "footfall"), "zip",
                                         os.path.dirname(package), os.path.basename(package)))
        sc._footfall_shipped = True


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000):
    """Within it, jobs hand Python workers at most so many rows at once: whole texts by the ten thousand,
    Spark's default, are held by the executor and by each worker."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if 0 < int(before) <= rows:
        yield
        return
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def map_batches(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` with this package at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def map_groups(df: DataFrame, keys: list[str], run, schema) -> DataFrame:
    """``groupBy(keys).applyInPandas`` with this package at hand in the workers."""
    ship(df.sparkSession)
    return df.groupBy(*keys).applyInPandas(run, schema)
