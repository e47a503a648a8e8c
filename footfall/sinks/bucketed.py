"""Bucketed tables in plain folders, so that joins and sums by their key move no rows.

The bucket of a row is in the name of its file, so a folder can be declared as a bucketed table
by any session that knows the keys and the number of buckets; no metastore is needed (the
declaration lives in the session's catalog).  Several folders with one layout are declared as
partitions of one table: Spark reads the same bucket of all of them in one task.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from footfall.sources import fs


def _table_name(*parts) -> str:
    return "footfall_" + hashlib.md5("\n".join(map(str, parts)).encode()).hexdigest()


def _schema_path(path: str) -> str:
    root, name = path.rsplit("/", 1)
    return f"{root}/_schemas/{name}"


def save_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int, fmt: str = "orc") -> None:
    """Writes ``df`` to the new folder ``path``, one sorted file per bucket; its schema goes beside the
    folder first (an empty bucket has no file, so an empty table would have none)."""
    spark, name = df.sparkSession, _table_name("write", path)
    fs.write_text(spark, _schema_path(path), df.schema.json())
    (df.repartition(buckets, *keys).write.format(fmt).bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", path).saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")  # the declaration only; the files are the caller's


def read_bucketed(spark: SparkSession, paths: list[str], keys: list[str], buckets: int, fmt: str = "orc") -> DataFrame:
    """The rows of folders that ``save_bucketed`` wrote with these keys and buckets."""
    name = _table_name("read", buckets, *keys, *paths)
    schema = StructType.fromJson(json.loads(fs.read_text(spark, _schema_path(paths[-1]))))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    base = paths[0].rsplit("/", 1)[0]
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, `_folder` int) USING {fmt} PARTITIONED BY (`_folder`) "
              f"CLUSTERED BY ({', '.join(keys)}) INTO {buckets} BUCKETS LOCATION '{base}/_tables/{name}'")
    for i, path in enumerate(paths):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (`_folder` = {i}) LOCATION '{path}'")
    return spark.table(name).drop("_folder")
