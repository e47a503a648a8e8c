"""Projection of the driver's synthetic tables onto the visitor-flow data model.

``events`` becomes the signal stream (one event = one signalling record), customers
give the subscriber's home (nation = home city, region = home province), ``props.k``
is the base station and ``event_id % 3`` the sector.  The cell -> district dimension
is derived from the cells that occur.  Every frame here is computed by Spark from the
tables, so its work grows with them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.parse import slice_stamp
from footfall.operators.joins import bounded_broadcast
from footfall.sources import fs

# Fixed values of the projection (shared with the DuckDB oracle in footfall.oracle).
DENSE_USERS = 15          # signal_dense folds users onto so many people at least,
DENSE_SHARE = 100         # and one person for every 100 customers
FIXTURE_CITY = 200        # serving city of most records; user_id % 10 == 9 -> 201
OTHER_CITY = 201
DIM_MAX_STATION = 90      # cells with base_statn_id < 90 belong to a district ...
DISTRICT_BASE = 1001      # ... district 1001 + base_statn_id % 3


# Declared schemas of the driver's tables: reading with a schema skips the footer-reading
# inference job that every ``spark.read.parquet`` call would otherwise run.
TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TABLE_SCHEMAS.get(name)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def _ntz(t: dt.datetime):
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


# Lazily-defined frames are reused within a session: building the projection's column
# expressions costs hundreds of JVM round trips, and nothing here is cached (``forget``
# drops them, for the bench).
_FRAMES: dict = {}


def forget() -> None:
    _FRAMES.clear()


def inputs(spark: SparkSession, sf_dir: str) -> tuple:
    """What tells apart contents of the tables read here: frames and tables made of them are kept
    under it, so a changed input is read again."""
    root = sf_dir.rstrip("/")
    return tuple(fs.version(spark, f"{root}/{name}.parquet") for name in TABLE_SCHEMAS)


def _memo(spark: SparkSession, key, build):
    k = (id(spark), spark.sparkContext.applicationId, key, inputs(spark, key[1]))
    if k not in _FRAMES:
        _FRAMES[k] = build()
    return _FRAMES[k]


def _dense_people(spark: SparkSession, sf_dir: str) -> int:
    """People of ``signal_dense``: they grow with the customers."""
    return max(DENSE_USERS, _read(spark, sf_dir, "customer").count() // DENSE_SHARE)


def _signal_base(spark: SparkSession, sf_dir: str, dense: bool) -> DataFrame:
    """The projection plus hidden ``_ts`` (event time, for pushed-down windows) and
    ``slice`` (file stamp) columns."""
    ev = _read(spark, sf_dir, "events")
    uid = F.col("user_id") % _dense_people(spark, sf_dir) if dense else F.col("user_id")
    e = ev.select(
        "event_id", "event_type", "ts", uid.alias("user_id"),
        F.get_json_object("props", "$.k").try_cast("int").alias("k"),
        F.expr("timestampadd(SECOND, floor(value), ts)").alias("te"),
    )
    # subscriber -> home (nation = home city, region = home province): one lookup table,
    # so each event is probed once (a broadcast while small, one shuffle join on user_id
    # beyond that) instead of three chained joins.
    # Both joins broadcast only behind a row-count check (run once per session, as the
    # frame is reused); beyond the bound they fall back to shuffle joins.
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = _read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = _read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    r, _ = bounded_broadcast(r)
    areas, _ = bounded_broadcast(n.join(r, n.n_regionkey == r.r_regionkey)
                                 .select("n_nationkey", "r_name"))
    homes, _ = bounded_broadcast(c.join(areas, c.c_nationkey == areas.n_nationkey)
                                 .select("c_custkey", "n_nationkey", "r_name"))
    uid_s = F.col("user_id").cast("string")
    sector = (F.col("event_id") % 3).cast("int")
    start = F.date_format("ts", "yyyyMMddHHmmss")
    return (e.join(homes, e.user_id == homes.c_custkey)
            .select(
                F.col("event_type").alias("message_type"),
                sector.alias("type"),
                F.concat(F.lit("460"), F.lpad(uid_s, 12, "0")).alias("imsi"),
                F.concat(F.lit("133"), F.lpad(uid_s, 8, "0")).alias("user_number"),
                start.alias("start_time"),
                F.date_format("te", "yyyyMMddHHmmss").alias("end_time"),
                F.col("k").alias("base_statn_id"),
                sector.alias("sector_id"),
                F.col("r_name").alias("home_province"),
                F.col("n_nationkey").alias("home_latn_id"),
                F.when(F.col("user_id") % 10 == 9, F.lit(OTHER_CITY))
                 .otherwise(F.lit(FIXTURE_CITY)).cast("int").alias("latn_id"),
                F.date_format("ts", "yyyyMMddHH").cast("int").alias("hour"),
                slice_stamp(start).alias("slice"),
                F.col("ts").alias("_ts"),
            ))


def signal(spark: SparkSession, sf_dir: str, dense: bool = False,
           window: tuple[dt.datetime, dt.datetime] | None = None,
           with_stamp: bool = False) -> DataFrame:
    """The ``signal`` (or ``signal_dense``) fixture.

    ``window`` = [from, to) on the event time is pushed down to the parquet scan; callers
    still apply the exact slice predicate, so a window only prunes, never decides.
    """
    base = _memo(spark, ("signal", sf_dir, dense), lambda: _signal_base(spark, sf_dir, dense))
    if window is not None:
        base = base.where((F.col("_ts") >= _ntz(window[0])) & (F.col("_ts") < _ntz(window[1])))
    return base.drop("_ts") if with_stamp else base.drop("_ts", "slice")


# The dimension is a distinct set of (station, sector) with 0 <= station < 90 and
# sector = event_id % 3 in [-2, 2]: at most 450 rows whatever the data volume, so it is
# safe to broadcast without measuring it.
DIM_MAX_ROWS = DIM_MAX_STATION * 5


def dim_district(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5-column cell -> district dimension: the cells seen in ``signal`` with
    0 <= base_statn_id < 90, except even stations' sector 2, in city 200."""
    return _memo(spark, ("dim", sf_dir), lambda: _dim_district(spark, sf_dir))


def _dim_district(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = signal(spark, sf_dir).select("base_statn_id", "sector_id")
    district = (F.lit(DISTRICT_BASE) + F.col("base_statn_id") % 3).cast("int")
    return (s.where((F.col("base_statn_id") >= 0) & (F.col("base_statn_id") < DIM_MAX_STATION)
                    & ~((F.col("sector_id") == 2) & (F.col("base_statn_id") % 2 == 0)))
            .select(F.lit(FIXTURE_CITY).cast("int").alias("city_id"), "base_statn_id", "sector_id",
                    district.alias("district_id"),
                    F.concat(F.lit("District "), district.cast("string")).alias("district_name"))
            .distinct())


def dim_district_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full dimension (names, coordinates, flow rate) derived from the cells."""
    d = dim_district(spark, sf_dir)
    station = F.concat(F.lit("Station "), F.col("base_statn_id").cast("string"))
    return d.select(
        "city_id", "district_id", "district_name", "base_statn_id",
        station.alias("base_statn_name"), "sector_id",
        F.concat(station, F.lit("_"), F.col("sector_id").cast("string")).alias("sector_name"),
        F.lit(113.3).cast("double").alias("center_longitude_baidu"),
        F.lit(23.1).cast("double").alias("center_latitude_baidu"),
        F.lit(1).alias("flow_rate"),
    )
