"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is planned and run to completion with the ``noop`` sink (no collect) after one
warm-up: headline queries five times, the others three; the figure is the median.  Nothing is
kept between runs but the stored dimension and residence tables (the reports read them, as the
scheduled jobs do); writing those is timed apart, as ``setup``.  ``value`` sums the headline
queries.  The month-wide reports run over every event, and once more on a copy of the tables
with ten times the events (``x10``); ``rows`` are the input events of each figure.
"""

from __future__ import annotations

import json
import os
import shutil
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from footfall import registry  # noqa: E402
from footfall.plans import reports, residence  # noqa: E402
from footfall.session import local_session  # noqa: E402
from footfall.sources import fixtures  # noqa: E402

HEADLINE = ["visitor_flow_dur", "visitor_flow_home", "residence_table", "resident_anti_join",
            "rolling_step"]
EXTRA = ["residence_two_pass", "resident_outer_join", "rolling_raw_step", "district_join",
         "signal_scan"]
MONTH_END = "202402010000"


def month_dur(spark, sf_dir):
    """R1 over every event."""
    return reports.dwell_report(_month_visits(spark, sf_dir, reports.DWELL_ATTRS), MONTH_END)


def month_home(spark, sf_dir):
    """R2 over every event."""
    return reports.home_report(_month_visits(spark, sf_dir, reports.HOME_ATTRS), MONTH_END)


def month_residence(spark, sf_dir):
    """R5 over every event, people present on ten days or more."""
    rows = fixtures.signal(spark, sf_dir, dense=True)
    return residence.residence_table(rows, registry._dim(spark, sf_dir), 10, match="at_least", dim_broadcast=False)


def _month_visits(spark, sf_dir, attrs):
    res = registry._residence(spark, sf_dir, dense=False)
    return reports.visits(fixtures.signal(spark, sf_dir), registry._dim(spark, sf_dir), res, False, attrs)


MONTH = {"month_dur": month_dur, "month_home": month_home, "month_residence": month_residence}


def run_once(spark, fn, sf_dir) -> float:
    fixtures.forget()
    t = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def setup(spark, sf_dir) -> float:
    registry.forget()
    t = time.perf_counter()
    registry._residence(spark, sf_dir, dense=False)
    registry._residence(spark, sf_dir, dense=True)
    return time.perf_counter() - t


def tenfold(sf_dir: str) -> str:
    """A copy of the tables with ten copies of the events."""
    out = tempfile.mkdtemp(prefix="footfall-bench-")
    for name in fixtures.TABLE_SCHEMAS:
        source = f"{sf_dir}/{name}.parquet"
        if name == "events":
            os.mkdir(f"{out}/events.parquet")
            for k in range(10):
                shutil.copy(source, f"{out}/events.parquet/part-{k}.parquet")
        else:
            os.symlink(source, f"{out}/{name}.parquet")
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "5"))
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          app="footfall-bench")
    qs = {**registry.queries(), **MONTH}
    times = {"setup": round(setup(spark, sf_dir), 3)}
    run_once(spark, qs["visitor_flow_dur"], sf_dir)  # warm-up (JIT, file listing caches)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    for name in HEADLINE + EXTRA + [*MONTH]:
        n = repeat if name in HEADLINE else max(1, min(repeat, 3))
        times[name] = round(statistics.median(run_once(spark, qs[name], sf_dir) for _ in range(n)), 3)
    if os.path.isfile(f"{sf_dir}/events.parquet"):
        large = tenfold(sf_dir)
        times["setup_x10"] = round(setup(spark, large), 3)
        for name in MONTH:
            times[f"{name}_x10"] = round(min(run_once(spark, qs[name], large) for _ in range(2)), 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    out = {
        "metric": "headline_total_median",
        "value": round(sum(times[q] for q in HEADLINE), 3),
        "unit": "sec",
        "queries": times,
        "rows": {q: events * (10 if q.endswith("_x10") else 1) for q in times},
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
