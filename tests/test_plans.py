"""Plan-shape checks: the properties the scale design relies on."""

import re

from footfall import registry
from footfall.operators.joins import bounded_broadcast, district_join
from footfall.sources import fixtures
from tests.conftest import SF_SMALL
from tests.helpers import dim_df, sig_row, signal_df


class _conf:
    """Temporarily set session options, restoring the previous values."""

    def __init__(self, spark, **kv):
        self.spark, self.kv = spark, {k.replace("__", "."): v for k, v in kv.items()}

    def __enter__(self):
        self.old = {k: self.spark.conf.get(k, None) for k in self.kv}
        for k, v in self.kv.items():
            self.spark.conf.set(k, v)

    def __exit__(self, *exc):
        for k, v in self.old.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)


NO_AUTO = {"spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__enabled": "false"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_dwell_report_is_hash_aggregated_with_window_pushdown(spark):
    df = registry.queries()["visitor_flow_dur"](spark, SF_SMALL)
    plan = _plan(df)
    assert "SortAggregate" not in plan
    assert "partial_min" in plan or "partial_max" in plan          # map-side combine
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts", plan)
    assert "BroadcastHashJoin" in plan


def test_home_report_sorts_only_reduced_rows(spark):
    df = registry.queries()["visitor_flow_home"](spark, SF_SMALL)
    plan = _plan(df)
    # every SortAggregate sits above the hash aggregate that reduced the raw rows
    for m in re.finditer(r"SortAggregate", plan):
        assert "HashAggregate" in plan[m.end():]
    lines = [ln for ln in plan.splitlines() if "Scan parquet" in ln or "FileScan" in ln]
    assert lines


def test_text_parse_splits_once(spark):
    df = registry.queries()["signal_scan"](spark, SF_SMALL)
    opt = _optimized(df)
    # the field-count filter may repeat the split once; per-field filters would repeat it 12+ times
    assert opt.count("split(") <= 3


def test_bounded_broadcast_falls_back_above_the_bound(spark):
    dim = dim_df(spark, [(200, b, 0, 1001) for b in range(20)])
    marked, ok = bounded_broadcast(dim, max_rows=100)
    assert ok
    unmarked, ok2 = bounded_broadcast(dim, max_rows=5)
    assert not ok2
    sig = signal_df(spark, [sig_row("a", "20240110000000", base=b) for b in range(20)])
    with _conf(spark, **NO_AUTO):
        plan = _plan(district_join(sig, dim, broadcast=None, max_rows=5))
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        plan = _plan(district_join(sig, dim, broadcast=None, max_rows=100))
        assert "BroadcastHashJoin" in plan


def test_residence_removal_moves_only_the_residence_side(spark):
    df = registry.queries()["visitor_flow_dur"](spark, SF_SMALL)
    with _conf(spark, spark__sql__adaptive__enabled="false"):
        plan = df._jdf.queryExecution().executedPlan().toString()
    join = plan[plan.index("LeftAnti"):] if "LeftAnti" in plan else ""
    assert join
    # directly under the anti join: the visit aggregate (no exchange in between)
    first_child = join.split("\n")[1]
    assert "Sort" in first_child or "HashAggregate" in first_child


def test_no_estimate_based_broadcast(spark):
    """The session never broadcasts on size estimates; the fixture's home lookup is a
    checked broadcast, so the event side is always the streamed side."""
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
    plan = _plan(registry.queries()["signal_scan"](spark, SF_SMALL))
    for line in plan.splitlines():
        if "BroadcastHashJoin" in line and "user_id" in line:
            assert "BuildRight" in line


def test_hot_visitor_is_exact(spark):
    """One visitor with a third of the rows: the result is whole and exact."""
    from footfall.plans import reports
    dim = dim_df(spark, [(200, 1, 0, 1001)])
    hot = [sig_row("hot", f"20240110{h:02d}{m:02d}00") for h in range(12) for m in range(0, 60, 2)]
    cold = [sig_row(f"c{i}", "20240110100000") for i in range(2 * len(hot) // 100)]
    df = signal_df(spark, hot + cold).repartition(8)
    out = {(r.section_id): r.visitor_number
           for r in reports.visitor_flow_dur(df, dim, None, "202401101205", False).collect()}
    assert out == {6: 1, 0: len(cold)}  # 00:00 -> 11:58 is 43080 s > 41400
    assert fixtures.DIM_MAX_ROWS == 450


def test_row_level_removal_broadcasts_a_checked_residence(spark):
    from footfall.operators.joins import drop_residents
    dim = dim_df(spark, [(200, 1, 0, 1001)])
    rows = district_join(signal_df(spark, [sig_row("a", "20240110000000"),
                                           sig_row("b", "20240110000000")]), dim, False)
    res = spark.createDataFrame([(1001, "a")], "district_id int, imsi string")
    with _conf(spark, **NO_AUTO):
        checked = drop_residents(rows, res, broadcast=None)
        assert "BroadcastHashJoin" in _plan(checked)
        assert [r.imsi for r in checked.collect()] == ["b"]
        assert "BroadcastHashJoin" not in _plan(drop_residents(rows, res, broadcast=None, max_rows=0))


def test_report_plans_scan_the_events_of_their_window_only(spark):
    for name in ("visitor_flow_dur", "visitor_flow_home", "rolling_rebuild"):
        scans = [ln for ln in _plan(registry.queries()[name](spark, SF_SMALL)).splitlines() if "events.parquet" in ln]
        assert scans and all("GreaterThanOrEqual(ts" in ln for ln in scans), name
        assert len(scans) == 1, name


def test_the_last_band_occurs_over_the_whole_signal(spark):
    from tests.conftest import SF_MID
    sections = {r.section_id for r in registry.queries()["dwell_section"](spark, SF_MID).select("section_id").distinct().collect()}
    assert 6 in sections


def test_bounded_broadcast_counts_bytes_too(spark):
    wide = spark.range(10).selectExpr("id", "repeat('x', 1000) AS s")
    assert bounded_broadcast(wide, max_bytes=20_000)[1] and not bounded_broadcast(wide, max_bytes=5_000)[1]


def test_dense_people_grow_with_the_customers(spark, tmp_root):
    spark.range(9000).selectExpr("id AS c_custkey").write.parquet(f"{tmp_root}/customer.parquet")
    assert fixtures._dense_people(spark, tmp_root) == 90 and fixtures._dense_people(spark, SF_SMALL) == 15


def test_copartitioned_removal_moves_neither_side(spark):
    with _conf(spark, **NO_AUTO):
        plan = _plan(registry.queries()["report_copartitioned"](spark, SF_SMALL))
    join = plan[plan.index("LeftAnti"):]
    assert "SortMergeJoin" in plan and "Exchange" not in join and join.count("Bucketed: true") == 2


def test_both_reports_scan_the_state_once(spark):
    plan = _plan(registry.queries()["reports_one_pass"](spark, SF_SMALL))
    assert plan.count("Scan orc") == 1 and "SortAggregate" not in plan and "Expand" in plan


def test_a_job_reads_its_slices_and_its_state_once(spark, tmp_root, monkeypatch):
    """Besides the job's own read, nothing parses the slices, and the reports read their saved rows."""
    from footfall.plans import job
    from footfall.sources import signal_text
    from tests.slice_files import signal_rows, write_slice_files

    write_slice_files(signal_rows(fixtures.signal(spark, SF_SMALL).where("start_time like '2024011011%'")), tmp_root)
    parses, parse = [], signal_text.parse_signal_lines
    monkeypatch.setattr(signal_text, "parse_signal_lines", lambda *a, **k: parses.append(a) or parse(*a, **k))
    out = job.run_visitor_job(spark, tmp_root, "202401101205", fixtures.dim_district(spark, SF_SMALL), None,
                              f"{tmp_root}/state", n=0)
    assert len(parses) == 1 and out.outcome["lines"] > 0 and out.outcome["residents"] == 0
    for report in (out.dwell, out.home):
        plan = _plan(report)
        assert plan.count("Scan ") == 1 and "_reports" in plan


def test_a_hot_cell_is_spread_over_the_tasks(spark):
    """One cell holds a third of the rows: the same rows as the plain join, and no large task."""
    from pyspark.sql import functions as F

    from footfall.operators.joins import hot_cells

    dim = spark.range(4000).selectExpr("200 AS city_id", "CAST(id AS int) AS base_statn_id", "0 AS sector_id",
                                       "CAST(id % 7 AS int) AS district_id", "'D' AS district_name")
    dim = dim.unionByName(dim.where("base_statn_id = 5").withColumn("district_id", F.lit(99)))  # a cell in two districts
    cell = F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 50 == 1, None).otherwise(F.pmod(F.xxhash64("id"), F.lit(4000)))
    sig = signal_df(spark, [sig_row("a", "20240110000000")]).drop("base_statn_id").crossJoin(
        F.broadcast(spark.range(60000).withColumn("base_statn_id", cell.cast("int"))))
    assert [tuple(r) for r in hot_cells(sig, 1 / 32).collect()] == [(200, 5, 0)]
    assert hot_cells(sig.where("false"), 1 / 32).count() == 0
    with _conf(spark, **NO_AUTO):
        salted, plain = district_join(sig, dim, "salted"), district_join(sig, dim, False)
        assert "SortMergeJoin" in _plan(salted)
        assert salted.columns == plain.columns and salted.count() == plain.count()
        assert salted.exceptAll(plain).count() == 0
        sizes = lambda df: sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())
        spread, lumped = sizes(salted), sizes(plain)
    assert spread[-1] < 2 * spread[len(spread) // 2] and lumped[-1] > 2 * lumped[len(lumped) // 2]


def _nodes(plan):
    """The nodes of an executed plan, exchanges' and stages' inside included."""
    yield plan
    if plan.nodeName() == "AdaptiveSparkPlan":
        yield from _nodes(plan.executedPlan())
    if plan.nodeName().endswith("QueryStage"):
        yield from _nodes(plan.plan())
    for i in range(plan.children().size()):
        yield from _nodes(plan.children().apply(i))


def _metric(df, node: str, name: str) -> list[int]:
    """A metric of all nodes of a kind, after the frame was collected."""
    found = [n for n in _nodes(df._jdf.queryExecution().executedPlan()) if n.nodeName().startswith(node)]
    return [n.metrics().apply(name).value() for n in found if n.metrics().contains(name)]


def test_rows_unknown_to_the_key_filter_are_not_shuffled(spark):
    """The residence is beyond the broadcast bound; one resident holds a tenth of all rows."""
    from pyspark.sql import functions as F

    from footfall.operators.joins import bounded_broadcast, drop_residents

    n = 40000
    who = F.when(F.col("id") % 10 == 0, F.lit("hot")).when(F.col("id") % 10 == 1, None).otherwise(F.concat(F.lit("p"), F.col("id")))
    rows = spark.range(n).select(F.when(F.col("id") % 13 > 0, 1001).alias("district_id"), who.alias("imsi"), F.col("id").alias("block"))
    res = spark.range(3000).selectExpr("1001 AS district_id", "concat('r', id) AS imsi").unionByName(
        spark.createDataFrame([(1001, "hot"), (1001, "p2"), (1002, "p3"), (1001, None), (None, "p4")], "district_id int, imsi string"))
    assert not bounded_broadcast(res, max_rows=1000)[1]
    with _conf(spark, **NO_AUTO):
        filtered, plain = drop_residents(rows, res, "filtered"), drop_residents(rows, res)
        assert filtered.columns == rows.columns
        assert sorted(map(str, filtered.collect())) == sorted(map(str, plain.collect()))
        moved = [sum(_metric(df, "Exchange", "shuffleRecordsWritten")) for df in (filtered, plain)]
        assert _plan(filtered).count("ReusedExchange") >= 1  # one filter for both uses
    # the plain join moves all rows and the residence; here: the filter's words, the residence, the hits
    own, words = rows.where("imsi = 'hot' AND district_id = 1001").count(), 2 * 64 * 12
    assert moved[1] == n + 3003 and moved[0] < 3003 + words + own + 0.03 * n


def test_a_full_key_filter_is_still_exact(spark):
    from footfall.operators.joins import drop_residents
    from footfall.operators.keyfilter import blocks_for, split_by_filter

    rows = spark.range(5000).selectExpr("CAST(id % 5 AS int) AS district_id", "concat('p', id) AS imsi", "id")
    keys = rows.where("id % 2 = 0").select("district_id", "imsi")
    may, surely_not = split_by_filter(rows, keys, ["district_id", "imsi"], max_bytes=512)  # two bits a key
    assert may.count() + surely_not.count() == 5000
    assert drop_residents(may, keys).unionByName(surely_not).select("id").exceptAll(rows.where("id % 2 = 1").select("id")).count() == 0
    assert surely_not.join(keys, ["district_id", "imsi"]).count() == 0
    assert blocks_for(0) == 1 and blocks_for(10**12) * 512 == 64 * 2**20
    none = keys.where("false")
    assert drop_residents(rows, none, "filtered").count() == 5000 and drop_residents(rows.where("false"), keys, "filtered").count() == 0


def test_key_filter_refuses_other_key_types(spark):
    import pytest

    from footfall.operators.keyfilter import split_by_filter

    with pytest.raises(ValueError, match="district_id"):
        split_by_filter(spark.range(3).selectExpr("id AS district_id"), spark.range(3).selectExpr("CAST(id AS int) AS district_id"),
                        ["district_id"])


def test_a_slice_table_prunes_the_folders_when_the_scan_runs(spark, tmp_root):
    """A range of five days: the plan holds its two ends, and the opened files are its slices."""
    from pyspark.sql import functions as F

    from footfall.functions import stay_range
    from footfall.functions.slices import slice_table, stamp_window
    from footfall.sources.signal_text import read_signal_partitioned, read_signal_sliced, write_slices

    sig = signal_df(spark, [sig_row(f"p{d}{h}", f"202401{d:02d}{h:02d}{m}00") for d in range(6, 15) for h in (0, 12, 23) for m in (10, 55)])
    write_slices(sig, tmp_root)
    wanted = stay_range("2024010723", 5)
    window = stamp_window(wanted)
    rows = read_signal_sliced(spark, tmp_root, slice_table(spark, window))
    plan = _plan(rows)
    assert "dynamicpruning" in plan and "202401081200" not in plan
    got = rows.collect()
    assert sorted(map(str, got)) == sorted(map(str, read_signal_partitioned(spark, tmp_root, wanted).collect()))
    assert len(got) == 2 + 5 * 6
    assert _metric(rows, "Scan text", "numFiles") == [len({r.slice for r in got})]
    assert read_signal_sliced(spark, tmp_root, slice_table(spark, None)).count() == 0
    stored = slice_table(spark, window).unionByName(spark.createDataFrame([(None,), ("202401110010",), ("209912310000",)], "slice string"))
    stored.write.parquet(f"{tmp_root}/table")  # repeated, unknown and null slices add nothing
    some = spark.read.parquet(f"{tmp_root}/table").where(F.col("slice") >= "20240111")
    assert read_signal_sliced(spark, tmp_root, some).count() == 2 * 6


def test_slice_table_equals_the_lists(spark):
    from footfall.functions import last_n_slices, until_now_slices
    from footfall.functions.slices import slice_table, stamp_window

    for stamps in (last_n_slices("202402290003", 7), until_now_slices("202401101207"), []):
        assert [r.slice for r in slice_table(spark, stamp_window(stamps)).orderBy("slice").collect()] == sorted(stamps)
