"""The slices that a micro-batch brought, whether or not any of their lines can be used.

A text stream hands over lines, so an empty slice file leaves no trace in the batch, and a file
of bad lines leaves none after cleaning.  But the run is named by its newest slice (T5).  The
file source logs every file it admits, empty ones too, in the stream's checkpoint before the
batch starts; ``admitted_files`` reads that log.  ``record`` keeps the files and stamps of each
batch beside the state versions.  A batch that is repeated after a crash replaces its own record.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.sources import fs

LEDGER = "ledger"
_ENTRY = "path string, timestamp bigint, batchId bigint"


def _logged(spark: SparkSession, checkpoint: str, epoch: int) -> int:
    """Number of the source log's newest entry in a micro-batch (-1: none)."""
    path = f"{checkpoint}/offsets/{epoch}"
    if epoch < 0 or not fs.exists(spark, path):
        return -1
    last = [r.value for r in spark.read.text(path).collect() if r.value.startswith("{")][-1]
    return json.loads(last)["logOffset"]


def admitted_files(spark: SparkSession, checkpoint: str, epoch: int) -> DataFrame:
    """``file`` (path) of every file that the source admitted in the micro-batch ``epoch``."""
    checkpoint = checkpoint.rstrip("/")
    first, last = _logged(spark, checkpoint, epoch - 1) + 1, _logged(spark, checkpoint, epoch)
    names = {p.rsplit("/", 1)[-1] for p, _ in fs.list_files(spark, f"{checkpoint}/sources/0")}
    whole = sorted(int(x.removesuffix(".compact")) for x in names if x.endswith(".compact"))
    logs = set()
    for n in range(first, last + 1):
        logs.add(str(n) if str(n) in names else f"{min(k for k in whole if k >= n)}.compact")
    if not logs:
        return spark.createDataFrame([], "file string")
    entries = spark.read.text([f"{checkpoint}/sources/0/{x}" for x in sorted(logs)]).where(F.col("value").startswith("{"))
    e = entries.select(F.from_json("value", _ENTRY).alias("e"))
    return e.where(F.col("e.batchId").between(first, last)).select(F.url_decode("e.path").alias("file")).distinct()


def record(files: DataFrame, state_root: str, epoch: int | None) -> DataFrame:
    """Stores the files (``file``, ``slice``, ``state_day``) of a batch and returns what was stored."""
    path = f"{state_root.rstrip('/')}/{LEDGER}/epoch={epoch if epoch is not None else 'none'}"
    files.write.mode("overwrite").parquet(path)
    return files.sparkSession.read.schema(files.schema).parquet(path)


def slices_so_far(spark: SparkSession, state_root: str) -> DataFrame:
    """``file``, ``slice``, ``state_day`` and ``epoch`` of all batches recorded."""
    return spark.read.parquet(f"{state_root.rstrip('/')}/{LEDGER}")
