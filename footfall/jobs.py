"""Command-line entry points (spark-submit) for the three scheduled jobs.

    spark-submit footfall/jobs.py visitor   --root /data --state /shared/state --as-of 202401101205 --n 3 \\
        --dim dim_district --residence residence --out-dur /out/visitor_flow_dur --out-home /out/visitor_flow_home
    spark-submit footfall/jobs.py residence --root /data --days 5 [--start 2024010723] --dim dim_district \\
        --out residence
    spark-submit footfall/jobs.py seed-dim  --cells /in/cells.orc --out dim_district

Tables are catalog names or paths (a '/' makes it a path).  JDBC output is optional; its
connection options come from the environment (FOOTFALL_JDBC_URL, FOOTFALL_JDBC_PROPS: a JSON
object with user, password, driver), so that no password stands on a command line.  The
session is the one spark-submit configures, with the SQL settings of
``session.RECOMMENDED_CONF`` wherever the submitter set none.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from footfall.constants import DEFAULT_CITY_ID, DEFAULT_LAST_N, DEFAULT_STAY_DAYS  # noqa: E402
from footfall.functions.slices import default_start, stay_range  # noqa: E402
from footfall.plans import residence as residence_plans  # noqa: E402
from footfall.plans.job import run_visitor_job  # noqa: E402
from footfall.session import RECOMMENDED_CONF  # noqa: E402
from footfall.sinks import jdbc  # noqa: E402
from footfall.sinks.tables import append_report, save_dim, save_residence  # noqa: E402
from footfall.sources.signal_text import read_signal, read_signal_partitioned, slice_outcome  # noqa: E402
from footfall.sources.tables import read_dim, read_residence, seed_dim  # noqa: E402


def _jdbc() -> tuple[str, dict] | None:
    """(url, properties) from the environment, None if no database is asked for."""
    url = os.environ.get("FOOTFALL_JDBC_URL")
    return (url, json.loads(os.environ.get("FOOTFALL_JDBC_PROPS") or "{}")) if url else None


def apply_recommended(spark: SparkSession) -> None:
    """The SQL settings that the plans are tested with, unless the submitter set them."""
    given = spark.sparkContext.getConf()
    for key, value in RECOMMENDED_CONF.items():
        if key.startswith("spark.sql.") and not given.contains(key):
            spark.conf.set(key, value)


def cmd_visitor(spark: SparkSession, args) -> None:
    """The 15-minute job: slices -> state -> dwell and home-flow reports -> sinks."""
    as_of = args.as_of or dt.datetime.now().strftime("%Y%m%d%H%M")
    dim = read_dim(spark, args.dim)
    res = read_residence(spark, args.residence) if args.residence else None
    db = _jdbc()

    def sink(dur, home, stamp):
        if args.out_dur:
            append_report(dur, args.out_dur, stamp=stamp)
        if args.out_home:
            append_report(home, args.out_home, stamp=stamp)
        if db is not None:
            jdbc.append_report_jdbc(dur, db[0], args.jdbc_dur_table, db[1])
            jdbc.append_report_jdbc(home, db[0], args.jdbc_home_table, db[1])

    out = run_visitor_job(spark, args.root, as_of, dim, res, args.state, n=args.n,
                          mode=args.mode, reset=args.reset, layout=args.layout, sink=sink)
    print(json.dumps({"stamp": out.stamp, "state": out.state_path, **out.outcome}))


def cmd_residence(spark: SparkSession, args) -> None:
    """The weekly labelling job: residents and staff of the stay range, one pass."""
    start = args.start or default_start(dt.date.today())
    stamps = stay_range(start, args.days)
    rows = (read_signal_partitioned(spark, args.root, stamps).drop("slice") if args.layout == "partitioned"
            else read_signal(spark, args.root, stamps))
    table = residence_plans.residence_table(rows, read_dim(spark, args.dim), args.days,
                                            city_id=args.city, match=args.match)
    save_residence(table, args.out)
    print(json.dumps({"start": start, "days": args.days, "out": args.out,
                      **slice_outcome(spark, args.root, stamps, args.layout)}))


def cmd_seed_dim(spark: SparkSession, args) -> None:
    """The dimension seed: a cell list (catalog table or ORC/parquet path) -> dimension."""
    src = spark.table(args.cells) if "/" not in args.cells else spark.read.format(args.format).load(args.cells)
    dim = seed_dim(src)
    save_dim(dim.drop("update_time"), args.out)
    if (db := _jdbc()) is not None:
        jdbc.overwrite_dim_jdbc(dim.drop("update_time"), db[0], args.jdbc_dim_table, db[1])


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="footfall")
    sub = p.add_subparsers(dest="cmd", required=True)

    v = sub.add_parser("visitor")
    v.add_argument("--root", required=True)
    v.add_argument("--state", required=True, help="shared folder for the day state")
    v.add_argument("--as-of", help="yyyyMMddHHmm (default: now)")
    v.add_argument("--n", type=int, default=DEFAULT_LAST_N, help="slices per run; 0 = rebuild")
    v.add_argument("--dim", required=True)
    v.add_argument("--residence")
    v.add_argument("--mode", choices=["aggregate", "raw"], default="aggregate")
    v.add_argument("--reset", choices=["window", "by_day"], default="window")
    v.add_argument("--layout", choices=["files", "partitioned"], default="files")
    v.add_argument("--out-dur")
    v.add_argument("--out-home")
    v.add_argument("--jdbc-dur-table", default="visitor_flow_dur")
    v.add_argument("--jdbc-home-table", default="visitor_flow_home")

    r = sub.add_parser("residence")
    r.add_argument("--root", required=True)
    r.add_argument("--days", type=int, default=DEFAULT_STAY_DAYS)
    r.add_argument("--start", help="yyyyMMddHH (default: Sunday 23h of the week before last)")
    r.add_argument("--dim", required=True)
    r.add_argument("--city", type=int, default=DEFAULT_CITY_ID)
    r.add_argument("--match", choices=["exact", "at_least"], default="exact")
    r.add_argument("--layout", choices=["files", "partitioned"], default="files")
    r.add_argument("--out", required=True)

    d = sub.add_parser("seed-dim")
    d.add_argument("--cells", required=True)
    d.add_argument("--format", default="orc", help="format of --cells when it is a path")
    d.add_argument("--out", required=True)
    d.add_argument("--jdbc-dim-table", default="dim_district")
    return p


def main(argv=None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"footfall-{args.cmd}").getOrCreate()
    apply_recommended(spark)
    {"visitor": cmd_visitor, "residence": cmd_residence, "seed-dim": cmd_seed_dim}[args.cmd](spark, args)


if __name__ == "__main__":
    main()
