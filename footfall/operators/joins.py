"""Cell -> district join and removal of residents/staff."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.operators.counts import RunCounts
from footfall.operators.keyfilter import split_by_filter
from footfall.schemas import DIM_COLUMNS, DIM_KEYS, ENRICHED_COLUMNS, SIGNAL_COLUMNS

# A cell dimension of a whole network is a few hundred thousand rows of ~5 small
# columns; above either bound the join falls back to a shuffle join (same rows, other plan).
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 256 * 2**20


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                      max_bytes: int = BROADCAST_MAX_BYTES) -> tuple[DataFrame, bool]:
    """Mark ``df`` for broadcast only if it has at most ``max_rows`` rows and ``max_bytes`` bytes
    (as JSON, which is no smaller than the rows in memory for short columns).

    The check is one distributed aggregate.  Beyond a bound the frame is returned unmarked
    and the planner uses a shuffle join (AQE may still convert it at run time from measured
    sizes).
    """
    size = F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))
    n, used = df.select(F.count("*"), size).first()
    return (F.broadcast(df), True) if n <= max_rows and used <= max_bytes else (df, False)


def district_join(signal: DataFrame, dim: DataFrame, broadcast: bool | str | None = None,
                  max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Inner equi-join of signal rows to the dimension on (city, station, sector).

    The serving city ``latn_id`` becomes ``city_id``; columns come out in the enriched
    order, followed by any extra signal columns.  ``broadcast=None`` checks the
    dimension's size (``bounded_broadcast``); True marks it for broadcast (the caller
    vouches for its size); False leaves the frame as given (no check, no hint);
    ``"salted"`` is a shuffle join that spreads hot cells (``district_join_salted``).
    """
    if broadcast == "salted":
        return district_join_salted(signal, dim)
    d = dim.select(*DIM_COLUMNS)
    if broadcast is None:
        d, _ = bounded_broadcast(d, max_rows)
    elif broadcast:
        d = F.broadcast(d)
    return _on_cell(signal, d, F.lit(True), signal.columns)


def _on_cell(signal: DataFrame, d: DataFrame, also, columns: list[str]) -> DataFrame:
    """The join on (city, station, sector) and ``also``; the enriched columns, then the extra ones of
    ``columns``."""
    s, d = signal.alias("s"), d.alias("d")
    cond = ((F.col("s.latn_id") == F.col("d.city_id"))
            & (F.col("s.base_statn_id") == F.col("d.base_statn_id"))
            & (F.col("s.sector_id") == F.col("d.sector_id")) & also)
    dim_side = set(DIM_COLUMNS)
    cols = [F.col(f"d.{c}" if c in dim_side else f"s.{c}").alias(c)
            for c in ENRICHED_COLUMNS if c in dim_side or c in columns]
    extra = [F.col(f"s.{c}") for c in columns if c not in SIGNAL_COLUMNS]
    return s.join(d, cond, "inner").select(*cols, *extra)


_SIGNAL_KEYS = ["latn_id", "base_statn_id", "sector_id"]


def hot_cells(signal: DataFrame, share: float) -> DataFrame:
    """The cells that hold more than ``share`` of the signal rows, named as in the dimension.

    One job over the three key columns, reduced before its shuffle; at most 1/share cells can qualify,
    so as many of the largest are fetched.  Rows with a null key join nothing and do not count."""
    counts, spark = RunCounts(), signal.sparkSession
    keys = signal.select(*_SIGNAL_KEYS).dropna()
    cells = counts.observe("rows", keys, n=F.count(F.lit(1))).groupBy(*_SIGNAL_KEYS).agg(F.count(F.lit(1)).alias("n"))
    largest = cells.orderBy(F.desc("n")).limit(int(1 / share)).collect()
    total = counts.get("rows").get("n") or 0
    hot = [tuple(r)[:3] for r in largest if r.n > share * total]
    return spark.createDataFrame(hot, ", ".join(f"{c} int" for c in DIM_KEYS))


def district_join_salted(signal: DataFrame, dim: DataFrame, salts: int | None = None) -> DataFrame:
    """J1 as a shuffle join for a dimension beyond the broadcast bound, with hot cells spread: the rows of
    a cell that fills more than a quarter of a shuffle partition get one of ``salts`` numbers (eight
    times the partitions, unless given), and that cell's dimension rows are repeated once per number.
    Other rows are as in the plain join, and so are the results.

    Only the list of hot cells is broadcast (at most four per shuffle partition)."""
    parts = int(signal.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = salts or 8 * parts
    hot = F.broadcast(hot_cells(signal, 1 / (4 * parts)).withColumn("_hot", F.lit(True)))
    number = F.when(F.col("_hot"), F.pmod(F.monotonically_increasing_id(), F.lit(salts))).otherwise(F.lit(0))
    numbers = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    of_signal = hot.toDF(*_SIGNAL_KEYS, "_hot")
    s = signal.join(of_signal, _SIGNAL_KEYS, "left").withColumn("_salt", number.cast("int"))
    d = dim.select(*DIM_COLUMNS).join(hot, DIM_KEYS, "left").select(*DIM_COLUMNS, F.explode(numbers).alias("_salt_d"))
    return _on_cell(s.select(*signal.columns, "_salt"), d, F.col("_salt") == F.col("_salt_d"), signal.columns)


def drop_residents(df: DataFrame, residence: DataFrame, broadcast: bool | str | None = False,
                   max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Keep rows whose (district_id, imsi) is not in the residence table.

    A left anti join: null imsi or district never match, so such rows stay.  Works on
    signal rows or on per-visitor summaries (same keys, same result); the reports use
    the summaries, which are already partitioned on the key.

    ``broadcast=False`` (default) leaves the strategy to the planner and AQE;
    ``None`` checks the residence size first (``bounded_broadcast``) — worth it for
    row-level removal against a stored residence table, so the rows never shuffle;
    True marks it for broadcast unchecked; ``"filtered"`` broadcasts a key filter in its place
    (``drop_residents_filtered``), for rows against a residence beyond the bound.
    """
    if broadcast == "filtered":
        return drop_residents_filtered(df, residence)
    keys = residence.select("district_id", "imsi")
    if broadcast is None:
        keys, _ = bounded_broadcast(keys, max_rows)
    elif broadcast:
        keys = F.broadcast(keys)
    return df.join(keys, ["district_id", "imsi"], "left_anti").select(*df.columns)


def drop_residents_filtered(df: DataFrame, residence: DataFrame) -> DataFrame:
    """J2 on rows against a residence too large to broadcast: rows whose key a Bloom filter of the
    residence does not know pass around the join; only the others, the residents' own rows and about
    one in a hundred more, are shuffled and decided exactly.  Same rows as ``drop_residents``.

    ``df`` is read twice, so it should be a scan with narrow steps (J1 with a broadcast dimension is)."""
    keys = residence.select("district_id", "imsi")
    may, surely_not = split_by_filter(df, keys, ["district_id", "imsi"])
    return surely_not.unionByName(drop_residents(may, residence))


def drop_residents_outer(df: DataFrame, residence: DataFrame) -> DataFrame:
    """J2 as the original job wrote it: left outer join + null filter (for comparison)."""
    r = residence.select(F.col("district_id").alias("district_id_r"), F.col("imsi").alias("imsi_r"))
    j = df.join(r, (df.district_id == r.district_id_r) & (df.imsi == r.imsi_r), "left_outer")
    return j.where(F.col("district_id_r").isNull()).drop("district_id_r", "imsi_r")
