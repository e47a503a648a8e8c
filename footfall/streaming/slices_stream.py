"""I4: the cron + file-drop pattern as a Structured Streaming query.

New slice files are picked up by the file source; every micro-batch is merged into the
day state exactly like a batch run (``foreachBatch``), and the reports of the batch's
newest stamp go to the sink.  ``trigger(availableNow=True)`` processes what is there and
stops, which is the scheduled-run equivalent; a processing-time trigger keeps it running.

Replays are safe: the state merge is min/max (idempotent), state versions are new folders
ordered by commit, and report sinks should replace by stamp (``sinks.tables.append_report``).
Every batch merges into the newest version of its state day, and the report stamp of a day
never moves back: a late batch is merged and reported under the newest stamp so far.  The
stamp comes from the slices that arrived, not from rows: an empty slice file and one without
a usable line count (``streaming.ledger``).  Lines that cannot be used (too few fields,
unreadable numbers, times or stamps) never stop the stream; they go to ``bad_sink``.
The state resets by day (a stream has no "first run of the day"); the 00:00 slice
closes the previous day, as in the batch job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.slices import state_day_col
from footfall.plans import rolling
from footfall.plans.reports import dwell_rows, home_rows, save_reports
from footfall.sinks.state import latest_state, prune_states, read_state, reports_path
from footfall.functions.parse import slice_stamp
from footfall.sources.signal_text import (
    PARTITIONED_SCHEMA,
    SLICE_SUBDIR,
    bad_reason,
    clean,
    parse_signal_lines,
)
from footfall.streaming.ledger import admitted_files, record

# every place in a file name where a stamp could start (S3 is a substring match)
_STAMPS_IN_NAME = r"(?=((?:19|20)\d{10}))"


def stamp_in_name(name) -> Column:
    """The first yyyyMMddHHmm in a file name that is a time; null if there is none."""
    found = F.regexp_extract_all(name, F.lit(_STAMPS_IN_NAME), 1)
    return F.get(F.filter(found, lambda s: state_day_col(s).isNotNull()), F.lit(0))


def stamped_files(files: DataFrame, layout: str = "files") -> DataFrame:
    """``file`` paths with the ``slice`` they belong to and its ``state_day``; files that name no
    slice are left out (their lines go by their own time)."""
    parts = F.split("file", "/")
    named = (stamp_in_name(F.element_at(parts, -1)) if layout == "files" else
             F.regexp_extract(F.element_at(parts, -2), r"^slice=(\d{12})$", 1))
    return (files.withColumn("slice", named).withColumn("state_day", state_day_col("slice"))
            .where(F.col("state_day").isNotNull()))


def slice_lines_stream(spark: SparkSession, root: str, max_files: int | None = None,
                       layout: str = "files") -> DataFrame:
    """Streaming lines of new slice files, with the stamp they came under.

    ``layout='files'``: ``<root>/AGG/AGG_3G_BSSAP/*/*.txt``, the stamp taken from each file
    name.  ``'partitioned'``: the ``latn=/day=/slice=`` folders written by ``write_slices``.
    """
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    base = f"{root.rstrip('/')}/{SLICE_SUBDIR}"
    if layout == "partitioned":
        return reader.schema(PARTITIONED_SCHEMA).load(base).select("value", "slice")
    if layout != "files":
        raise ValueError(layout)
    lines = reader.load(f"{base}/*/*.txt")
    return lines.select("value", stamp_in_name(F.col("_metadata.file_name")).alias("slice"))


def merge_batch(batch: DataFrame, dim: DataFrame, residence: DataFrame | None, state_root: str,
                sink=None, keep_days: int = 2, epoch: int | None = None, bad_sink=None,
                files: DataFrame | None = None) -> list[str]:
    """Merge one micro-batch of lines into the day state(s); returns the stamps reported.

    A batch normally holds slices of one state day; one that spans midnight is merged
    day by day (oldest first), so yesterday's rows never enter today's state.  Lines whose
    file or folder names no stamp go by their own start time.  ``files`` (``file``, ``slice``,
    ``state_day``; see ``stamped_files``) lists the slices of the batch, with or without
    lines; it is recorded beside the state.  ``bad_sink(lines, epoch)`` gets the lines that
    cannot be used, with the ``reason``.
    """
    spark = batch.sparkSession
    batch = batch.persist()
    done, written = [], []
    try:
        parsed = parse_signal_lines(batch, keep=("value", "slice"))
        # file stamp when the layout names it, else the record's own slice
        parsed = (parsed.withColumn("slice", F.coalesce(F.when(state_day_col("slice").isNotNull(), F.col("slice")),
                                                        slice_stamp("start_time")))
                  .withColumn("state_day", state_day_col("slice")))
        if bad_sink is not None:
            reason = F.coalesce(bad_reason(), F.when(F.col("state_day").isNull(), F.lit("stamp")))
            bad_sink(parsed.select("value", "slice", reason.alias("reason")).where(F.col("reason").isNotNull()), epoch)
        # the slices of all lines, usable or not, and of all files, with or without lines
        arrived = parsed.where(F.col("state_day").isNotNull()).select("state_day", "slice")
        if files is not None:
            arrived = arrived.unionByName(record(files, state_root, epoch).select("state_day", "slice"))
        rows = clean(parsed.drop("value")).where(F.col("state_day").isNotNull())
        # one row per state day in the batch (normally one, two across midnight)
        days = arrived.groupBy("state_day").agg(F.max("slice").alias("newest")).collect()
        for r in sorted(days, key=lambda r: r["state_day"]):
            found = latest_state(spark, state_root, day=r["state_day"])
            stamp = max(r["newest"], found[0]) if found else r["newest"]
            part = rows.where(F.col("state_day") == r["state_day"]).drop("slice", "state_day")
            saved = rolling.save_step(found and found[1], part, dim, residence, state_root, stamp, epoch=epoch)
            written.append(saved)
            visits = rolling.state_visits(read_state(spark, saved))
            if sink is not None:
                both = save_reports(visits, stamp, reports_path(saved))
                sink(dwell_rows(both), home_rows(both), stamp)
            done.append(stamp)
    finally:
        batch.unpersist()
    if keep_days:
        prune_states(spark, state_root, keep_days, protect=tuple(written))
    return done


def start_visitor_stream(spark: SparkSession, root: str, dim: DataFrame,
                         residence: DataFrame | None, state_root: str, checkpoint: str,
                         sink=None, available_now: bool = True, max_files: int | None = None,
                         processing_time: str = "5 minutes", layout: str = "files", bad_sink=None):
    """Start the stream; returns the StreamingQuery (call ``awaitTermination``)."""

    def merge(lines: DataFrame, epoch: int) -> None:
        files = stamped_files(admitted_files(lines.sparkSession, checkpoint, epoch), layout)
        merge_batch(lines, dim, residence, state_root, sink, epoch=epoch, bad_sink=bad_sink, files=files)

    lines = slice_lines_stream(spark, root, max_files, layout)
    writer = lines.writeStream.option("checkpointLocation", checkpoint).foreachBatch(merge)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=processing_time)
    return writer.start()
