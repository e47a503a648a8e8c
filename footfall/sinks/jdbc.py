"""K1-K3: JDBC sinks (reports appended, dimension overwritten).

Connection options (URL, user, password, driver) always come from the caller; nothing
is stored here.  The write is Spark's own ``DataFrameWriter.jdbc``; ``num_partitions``
caps the number of concurrent connections the executors open.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from footfall.sinks.tables import with_audit


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict, mode: str = "append",
               num_partitions: int = 8, audit: bool = True) -> None:
    out = with_audit(df) if audit else df
    out.coalesce(num_partitions).write.jdbc(url, table, mode=mode, properties=properties)


def append_report_jdbc(report: DataFrame, url: str, table: str, properties: dict) -> None:
    """K1/K2: append a report (visitor_flow_dur / visitor_flow_home)."""
    write_jdbc(report, url, table, properties, "append")


def overwrite_dim_jdbc(dim: DataFrame, url: str, table: str, properties: dict) -> None:
    """K3: replace the dimension table."""
    write_jdbc(dim, url, table, properties, "overwrite")
