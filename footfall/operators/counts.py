"""Counts of what a run saw and left out, taken while its own jobs run (``DataFrame.observe``).

No second pass over the data: the counts travel with the tasks of the job that reads or writes
the rows anyway.  They are for reports on a run, not for results: when executors are lost, tasks
that run again may be counted again.
"""

from __future__ import annotations

from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession

_EXCLUDED = "spark.sql.adaptive.optimizer.excludedRules"
_EMPTY = "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"


class RunCounts:
    """Observed counts of one run, by the name of the place where they were taken."""

    def __init__(self):
        self._taken: dict[str, Observation] = {}

    def observe(self, place: str, df: DataFrame, **counts: Column) -> DataFrame:
        """``df`` itself; when it is first computed, the aggregates ``counts`` are taken along."""
        self._taken[place] = Observation()
        return df.observe(self._taken[place], *[c.alias(name) for name, c in counts.items()])

    def get(self, place: str) -> dict:
        """The counts of a place.  Call it after the job that computes the frame.  Empty if nothing
        was observed, or the planner left the frame out because nothing could come of it."""
        if place not in self._taken:
            return {}
        try:
            return dict(self._taken[place].get)
        except Py4JJavaError:  # Spark has a row without columns then, which it cannot hand over
            return {}

    @contextmanager
    def kept(self, spark: SparkSession):
        """Within it, adaptive planning does not drop what turns out empty at run time, which would
        take the counts of a run without usable lines along."""
        before = spark.conf.get(_EXCLUDED, None)
        spark.conf.set(_EXCLUDED, ",".join(filter(None, (before, _EMPTY))))
        try:
            yield
        finally:
            spark.conf.unset(_EXCLUDED) if before is None else spark.conf.set(_EXCLUDED, before)
