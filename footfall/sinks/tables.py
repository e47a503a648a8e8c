"""K4-K6 and report sinks: ORC/parquet tables, with the audit column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.operators.visits import VISIT_KEY
from footfall.sinks.bucketed import save_bucketed


def with_audit(df: DataFrame) -> DataFrame:
    """``update_time`` = time of the write."""
    return df.withColumn("update_time", F.current_timestamp())


def write_table(df: DataFrame, target: str, mode: str = "overwrite", fmt: str = "orc",
                audit: bool = True) -> None:
    """Write a frame to a catalog table (``target`` without '/') or a path."""
    out = with_audit(df) if audit else df
    w = out.write.mode(mode).format(fmt)
    if "/" in target:
        w.save(target)
    else:
        w.saveAsTable(target)


def save_residence(residence: DataFrame, target: str, fmt: str = "orc") -> None:
    """K4/K5: the residence table, residents and staff in one overwrite (one pass)."""
    write_table(residence, target, "overwrite", fmt)


def save_residence_two_pass(residents: DataFrame, staff: DataFrame, target: str,
                            fmt: str = "orc") -> None:
    """K4 then K5, as the original job wrote them (overwrite residents, append staff)."""
    write_table(residents, target, "overwrite", fmt)
    write_table(staff, target, "append", fmt)


def save_residence_bucketed(residence: DataFrame, path: str, buckets: int, fmt: str = "orc") -> None:
    """K4: the residence table in a new folder, bucketed and sorted like the day state (same keys,
    same number of buckets), so that removing residents (J2) moves neither side."""
    save_bucketed(with_audit(residence), path, VISIT_KEY, buckets, fmt)


def save_dim(dim: DataFrame, target: str, fmt: str = "orc") -> None:
    """K6: overwrite the district dimension."""
    write_table(dim, target, "overwrite", fmt)


def append_report(report: DataFrame, path: str, fmt: str = "parquet", stamp: str | None = None) -> None:
    """Report sink that can be re-run: the rows of a run replace those of its earlier runs.

    With ``stamp`` (yyyyMMddHHmm) the partition of that run is overwritten as a folder, so a
    re-run that finds nothing leaves it empty; without, the stamps in the rows are used
    (dynamic partition overwrite), which cannot see a run without rows.
    """
    if stamp is not None:
        with_audit(report).write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/run_stamp={stamp}")
        return
    rows = with_audit(report).withColumn("run_stamp", F.date_format("timestamp", "yyyyMMddHHmm"))
    (rows.write.option("partitionOverwriteMode", "dynamic").mode("overwrite")
     .partitionBy("run_stamp").format(fmt).save(path))


def save_quarantine(bad: DataFrame, path: str, run: str, fmt: str = "parquet") -> None:
    """Lines that could not be used, under the name of the run (a replay replaces its own)."""
    with_audit(bad).write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/run={run}")
