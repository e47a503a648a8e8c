"""Tolerant scan of pipe-delimited signal slices.

Lines are read with ``spark.read.text`` and split on a literal pipe; the twelve signal
columns are picked by position and typed with the int-or-zero rule.  Lines with fewer
than 29 fields are *quarantined* (kept apart, countable) and unreadable integers become
null, instead of failing the job.  Several slices are one scan: Spark lists the files and
drops those of other slices by their names, without a driver loop; files that vanish or
cannot be read are skipped, and ``slice_outcome`` reports them with the counts of bad lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.constants import FIELD_DELIMITER, MIN_FIELDS, SIGNAL_FIELD_POSITIONS
from footfall.functions.parse import epoch_seconds, int_or_zero, slice_stamp
from footfall.functions.slices import prefix_predicate, stamps_predicate
from footfall.operators.counts import RunCounts
from footfall.operators.joins import bounded_broadcast
from footfall.schemas import SIGNAL, SIGNAL_COLUMNS
from footfall.sources import fs

#: Fixed value: the folder of the slice files.
SLICE_SUBDIR = "AGG/AGG_3G_BSSAP"
_INT_COLUMNS = [f.name for f in SIGNAL.fields if f.dataType.typeName() == "integer"]


def _fields(value: Column) -> Column:
    return F.split(value, "\\" + FIELD_DELIMITER)


def parse_signal_lines(lines: DataFrame, value_col: str = "value", keep=()) -> DataFrame:
    """Parse a DataFrame of text lines into the signal schema plus ``_n_fields``.

    Unreadable integers come out null (``int_or_zero``).  ``keep`` names extra input
    columns to carry along (e.g. the source file name).

    Plan note: filters on parsed columns are pushed below this projection and would
    re-split the line once per referenced field, so the only filter applied on the
    hot path (``clean``) is the field count, which costs one extra split.
    """
    f = F.col("_f")
    typed = []
    for name in SIGNAL_COLUMNS:
        raw = F.get(f, SIGNAL_FIELD_POSITIONS[name])
        typed.append((int_or_zero(raw) if name in _INT_COLUMNS else raw).alias(name))
    return (lines.select(_fields(F.col(value_col)).alias("_f"), *keep)
            .select(*typed, *keep, F.size(f).alias("_n_fields")))


def clean(parsed: DataFrame) -> DataFrame:
    """Lines with enough fields; drops the helper column."""
    return parsed.where(F.col("_n_fields") >= MIN_FIELDS).drop("_n_fields")


def bad_reason() -> Column:
    """Why a parsed line cannot be used in full, null if it can: ``short`` (too few fields),
    ``integer`` or ``time`` (unreadable text)."""
    no_int = F.lit(False)
    for name in _INT_COLUMNS:
        no_int = no_int | F.col(name).isNull()
    no_time = epoch_seconds("start_time").isNull() | epoch_seconds("end_time").isNull()
    return (F.when(F.col("_n_fields") < MIN_FIELDS, F.lit("short")).when(no_int, F.lit("integer"))
            .when(no_time, F.lit("time")))


def quarantine(parsed: DataFrame) -> DataFrame:
    """Lines that cannot be used in full, with the ``reason``."""
    return parsed.withColumn("reason", bad_reason()).where(F.col("reason").isNotNull()).drop("_n_fields")


#: Values of ``bad_reason``.
REASONS = ("short", "integer", "time")


def counted(parsed: DataFrame, counts: RunCounts | None) -> DataFrame:
    """Parsed lines; ``counts`` gets their number, the bad ones by reason, and the files they are from."""
    if counts is None:
        return parsed
    rows = parsed.withColumn("_reason", bad_reason())
    by = {reason: F.count_if(F.col("_reason") == reason) for reason in REASONS}
    if "file_name" in parsed.columns:
        by["files"] = F.collect_set("file_name")
    return counts.observe("lines", rows, lines=F.count(F.lit(1)), **by).drop("_reason")


def empty_signal(spark: SparkSession, extra=()) -> DataFrame:
    df = spark.createDataFrame([], SIGNAL)
    for name in extra:
        df = df.withColumn(name, F.lit(None).cast("string"))
    return df


def _listed(spark: SparkSession, root: str, stamps, fmt: str) -> DataFrame | None:
    """The slice files of the stamps' days, read as ``fmt``; None without any slice folder."""
    base = f"{root.rstrip('/')}/{SLICE_SUBDIR}"
    days = sorted({s[:8] for s in stamps})
    if not days or not fs.exists(spark, base):
        return None
    return (spark.read.format(fmt).option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*{" + ",".join(days) + "}*.txt")
            .option("ignoreMissingFiles", "true").option("ignoreCorruptFiles", "true").load(base))


def slice_files(spark: SparkSession, root: str, stamps) -> DataFrame:
    """S3: ``file_name``, ``length`` and ``stamp`` of the files whose name contains a stamp, one
    row per match.  Only names are listed; no file is opened.  Files without any content are
    not listed by Spark: a stamp that has no other file counts as missing."""
    found = _listed(spark, root, stamps, "binaryFile")
    if found is None:
        return spark.createDataFrame([], "file_name string, length long, stamp string")
    name = F.element_at(F.split("path", "/"), -1)
    hits = F.filter(F.array(*map(F.lit, stamps)), lambda s: F.contains(F.col("file_name"), s))
    return found.select(name.alias("file_name"), "length").select(
        "file_name", "length", F.explode(hits).alias("stamp"))


def missing_stamps(spark: SparkSession, root: str, stamps) -> list[str]:
    """The stamps without a file (a run has a few hundred stamps at most)."""
    wanted = spark.createDataFrame([(s,) for s in stamps], "stamp string")
    return sorted(r.stamp for r in wanted.join(slice_files(spark, root, stamps), "stamp", "left_anti").collect())


def read_slice_lines(spark: SparkSession, root: str, stamps, missing: str = "empty") -> DataFrame | None:
    """One text read over the files of all stamps that exist.

    ``missing='empty'`` skips stamps with no file (the run goes on); ``'fail'`` raises.
    Returns None when there is no slice folder.  Each line carries its file name.  The
    predicate on the name is applied to the listing, so other files are never opened.
    """
    stamps = list(stamps)
    if missing == "fail" and stamps and (absent := missing_stamps(spark, root, stamps)):
        raise FileNotFoundError(absent)
    lines = _listed(spark, root, stamps, "text")
    if lines is None:
        return None
    named = F.col("_metadata.file_name").rlike("|".join(stamps))
    return lines.where(named).select("value", F.col("_metadata.file_name").alias("file_name"))


_REPORTED = 100


def slice_outcome(spark: SparkSession, root: str, stamps, layout: str = "files") -> dict:
    """What a run over ``stamps`` did not use: ``bad`` (lines by reason), and in the file layout
    ``missing`` (stamps without a file), ``unread`` (number of files that have content but gave
    no line: vanished or unreadable) and the first ``unread_files``."""
    stamps = list(stamps)
    if layout == "partitioned":
        return {"bad": _by_reason(read_partitioned_quarantine(spark, root, stamps))}
    lines = read_slice_lines(spark, root, stamps)
    if lines is None:
        return {"missing": sorted(stamps), "unread": 0, "unread_files": [], "bad": {}}
    files = slice_files(spark, root, stamps).select("file_name", "length").distinct()
    unread = files.where("length > 0").join(lines.select("file_name").distinct(), "file_name", "left_anti")
    names = [r.file_name for r in unread.orderBy("file_name").limit(_REPORTED).collect()]
    return {"missing": missing_stamps(spark, root, stamps), "unread": unread.count() if names else 0,
            "unread_files": names, "bad": _by_reason(quarantine(parse_signal_lines(lines)))}


def _by_reason(bad: DataFrame) -> dict[str, int]:
    return {r.reason: r["count"] for r in bad.groupBy("reason").count().collect()}


def observed_outcome(spark: SparkSession, root: str, stamps, counts: RunCounts, layout: str = "files") -> dict:
    """``slice_outcome`` of a read that took ``counts`` along: the lines are not read again.  The names
    of the files that gave lines are as many as the slices' files, which the driver lists anyway.
    Where no counts were taken (an empty dimension: the lines were not read), they are read here."""
    stamps, seen = list(stamps), counts.get("lines")
    if not seen:
        return slice_outcome(spark, root, stamps, layout)
    bad = {reason: seen[reason] for reason in REASONS if seen.get(reason)}
    if layout == "partitioned":
        return {"bad": bad | _by_reason(_lost_lines(spark, root))}
    files = slice_files(spark, root, stamps).where("length > 0").select("file_name").distinct()
    unread = sorted({r.file_name for r in files.collect()} - set(seen.get("files", ())))
    return {"missing": missing_stamps(spark, root, stamps), "unread": len(unread),
            "unread_files": unread[:_REPORTED], "bad": bad}


def read_signal(spark: SparkSession, root: str, stamps, missing: str = "empty",
                with_file: bool = False, bad: str = "quarantine", counts: RunCounts | None = None) -> DataFrame:
    """Signal rows of the given slice stamps under ``root``.

    ``bad='quarantine'`` drops short lines and leaves unreadable integers null (both are
    listed by ``read_signal_quarantine``); ``bad='fail'`` fails the job on the first
    such line, as the original job did.  ``counts`` gets the numbers of lines (``counted``).
    """
    lines = read_slice_lines(spark, root, stamps, missing)
    if lines is None:
        return empty_signal(spark, ("file_name",) if with_file else ())
    parsed = counted(parse_signal_lines(lines, keep=("file_name",)), counts)
    if not with_file:
        parsed = parsed.drop("file_name")
    if bad == "fail":
        broken = F.col("_n_fields") < MIN_FIELDS
        for name in _INT_COLUMNS:
            broken = broken | F.col(name).isNull()
        parsed = parsed.where(F.when(broken, F.raise_error(F.lit("unparsable signal line")))
                              .otherwise(F.lit(True)))
    return clean(parsed)


def read_signal_quarantine(spark: SparkSession, root: str, stamps) -> DataFrame:
    lines = read_slice_lines(spark, root, stamps)
    if lines is None:
        return empty_signal(spark, ("value", "file_name", "reason"))
    return quarantine(parse_signal_lines(lines, keep=("value", "file_name")))


def format_signal_lines(signal: DataFrame, width: int = MIN_FIELDS + 1, keep=()) -> DataFrame:
    """Inverse of the scan: write signal rows as ``width``-field pipe lines (unused
    fields empty) in column ``value``, plus the ``keep`` columns.  Used for round trips,
    the partitioned writer and the streaming tests."""
    by_pos = {p: n for n, p in SIGNAL_FIELD_POSITIONS.items()}
    parts = [F.coalesce(F.col(by_pos[i]).cast("string"), F.lit("")) if i in by_pos else F.lit("")
             for i in range(width)]
    return signal.select(F.concat_ws(FIELD_DELIMITER, *parts).alias("value"), *keep)


# --- partitioned layout -------------------------------------------------------------
# A Spark-native alternative to one-file-per-slice names: lines under
# <root>/AGG/AGG_3G_BSSAP/latn=<city>/day=<yyyyMMdd>/slice=<yyyyMMddHHmm>/.  A run lists the
# folders of its days and opens those of its slices.  As with file names, the folder's stamp
# selects, not the record's own time, so late records select alike in both layouts.

PARTITIONED_SCHEMA = "value string, latn string, day string, slice string"
_NO_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def write_slices(signal: DataFrame, root: str, mode: str = "append") -> None:
    """Write signal rows as pipe text partitioned by serving city, day and slice.

    The slice is the column ``slice`` if there is one (the stamp of the file a record came
    in), else that of the record's start time.  Rows meet by partition first, so a slice is a
    few files; a large one (a hot city) is split by its measured size.
    """
    stamp = F.col("slice") if "slice" in signal.columns else slice_stamp("start_time")
    out = format_signal_lines(signal, keep=(F.col("latn_id").cast("string").alias("latn"),
                                            F.substring(stamp, 1, 8).alias("day"), stamp.alias("slice")))
    (out.hint("rebalance", "latn", "day", "slice").write.mode(mode).partitionBy("latn", "day", "slice")
     .text(f"{root.rstrip('/')}/{SLICE_SUBDIR}"))


def _read_days(spark: SparkSession, root: str, days) -> DataFrame | None:
    base = f"{root.rstrip('/')}/{SLICE_SUBDIR}"
    paths = [p for p in (f"{base}/latn=*/day={d}" for d in days) if fs.any_match(spark, p)]
    if not paths:
        return None
    return (spark.read.schema(PARTITIONED_SCHEMA).option("basePath", base)
            .option("ignoreMissingFiles", "true").option("ignoreCorruptFiles", "true").text(paths))


def read_partitioned_lines(spark: SparkSession, root: str, stamps) -> DataFrame | None:
    """Lines of the stamps (slices, or hour and day prefixes as in T3); None if no day exists."""
    lines = _read_days(spark, root, sorted({s[:8] for s in stamps}))
    if lines is None:
        return None
    whole = all(len(s) == 12 for s in stamps)
    return lines.where(stamps_predicate("slice", stamps) if whole else prefix_predicate("slice", stamps))


def read_signal_partitioned(spark: SparkSession, root: str, stamps, counts: RunCounts | None = None) -> DataFrame:
    """Signal rows of the given stamps from the partitioned layout, with ``slice``.
    Missing days or slices simply contribute no rows.  ``counts`` as in ``read_signal``."""
    lines = read_partitioned_lines(spark, root, list(stamps))
    if lines is None:
        return empty_signal(spark, ("slice",))
    return clean(counted(parse_signal_lines(lines, keep=("slice",)), counts))


def read_signal_sliced(spark: SparkSession, root: str, slices: DataFrame, counts: RunCounts | None = None) -> DataFrame:
    """``read_signal_partitioned`` for slices given as a table (column ``slice``, ``slice_table`` or a
    filtered table of slices) in place of a list: the scan opens the folders whose slice the table
    has, found when it runs (dynamic partition pruning), however long the range.

    The folders of the table's days are listed.  The table is broadcast behind a check of its size;
    beyond the bound the rows are the same, but the listed folders are all opened.  A table without a
    filter of its own is not used for pruning by Spark either."""
    wanted, _ = bounded_broadcast(slices.select("slice"))
    days = slices.select(F.substring("slice", 1, 8).alias("day")).distinct().collect()
    lines = _read_days(spark, root, sorted(r.day for r in days if r.day))
    if lines is None:
        return empty_signal(spark, ("slice",))
    lines = lines.join(wanted, "slice", "left_semi").select("value", "slice")
    return clean(counted(parse_signal_lines(lines, keep=("slice",)), counts))


def read_partitioned_quarantine(spark: SparkSession, root: str, stamps) -> DataFrame:
    """Bad lines of the given stamps, and every line in a folder without a stamp."""
    cols = ("value", "slice")
    out = empty_signal(spark, (*cols, "reason"))
    lines = read_partitioned_lines(spark, root, list(stamps))
    if lines is not None:
        out = quarantine(parse_signal_lines(lines, keep=cols))
    return out.unionByName(_lost_lines(spark, root))


def _lost_lines(spark: SparkSession, root: str) -> DataFrame:
    """The lines in folders without a stamp."""
    cols = ("value", "slice")
    lost = _read_days(spark, root, [_NO_PARTITION])
    if lost is None:
        return empty_signal(spark, (*cols, "reason"))
    parsed = parse_signal_lines(lost, keep=cols).drop("_n_fields").withColumn("reason", F.lit("stamp"))
    return parsed.where(F.col("slice").isNull())
