"""Day state, the 15-minute job, the availableNow stream and the sinks."""

import itertools
import os

import pytest
from pyspark.sql import functions as F

from footfall.plans import rolling
from footfall.plans.job import run_visitor_job
from footfall.plans.reports import dwell_report, home_report, visits
from footfall.sinks.state import StatePruned, compaction_due, latest_state, latest_state_path, load_state, prune_states, read_state, save_state
from footfall.sinks.tables import append_report, save_quarantine, save_residence, save_residence_two_pass
from footfall.sources import fixtures, fs
from footfall.sources.signal_text import clean, parse_signal_lines, read_signal
from footfall.sources.tables import read_residence
from footfall.functions.slices import until_now_slices
from footfall.streaming.ledger import admitted_files, slices_so_far
from footfall.streaming.slices_stream import merge_batch, stamp_in_name, start_visitor_stream
from tests.conftest import SF_MID
from tests.slice_files import signal_rows, write_slice_files


def _rows(r):
    return sorted(tuple(x) for x in r.collect())


def _day_files(spark, root):
    sig = fixtures.signal(spark, SF_MID).where("start_time like '20240110%'")
    write_slice_files(signal_rows(sig), root)
    return F.broadcast(fixtures.dim_district(spark, SF_MID))


def test_state_versions(spark, tmp_root):
    df = spark.createDataFrame([("a", 1)], "imsi string, district_id int")
    root = os.path.join(tmp_root, "state")
    p1 = save_state(df, root, "202401100015")
    p2 = save_state(df, root, "202401100030")
    os.makedirs(os.path.join(root, "run=202401100045-0000000003-deadbeef"))  # crashed run: no _SUCCESS
    assert latest_state_path(spark, root) == p2
    assert latest_state_path(spark, root, before="202401100030") == p1
    assert latest_state_path(spark, root, day="20240111") is None
    assert load_state(spark, os.path.join(tmp_root, "absent")) is None
    # of two versions with one stamp, the later commit is the newer, whatever the ids
    for _ in range(4):
        last = save_state(df, root, "202401100030")
        assert latest_state(spark, root) == ("202401100030", last)


def test_pruning_keeps_days_and_marks_what_is_gone(spark, tmp_root):
    df = spark.createDataFrame([("a", 1)], "imsi string, district_id int")
    root = os.path.join(tmp_root, "state")
    old = [save_state(df, root, f"202401{d:02d}1200") for d in (9, 10, 11)]
    assert prune_states(spark, root, keep_days=2) == 1
    assert latest_state_path(spark, root, before="202401101300") == old[1]
    with pytest.raises(StatePruned):
        latest_state_path(spark, root, before="202401101200")
    with pytest.raises(StatePruned):
        latest_state_path(spark, root, day="20240109")
    assert latest_state_path(spark, root, before="202401091200") is None  # nothing before was pruned
    late = save_state(df, root, "202401091215")
    assert prune_states(spark, root, keep_days=2, protect=(late,)) == 0
    assert read_state(spark, late).count() == 1
    assert prune_states(spark, os.path.join(tmp_root, "none")) == 0


def _summary(spark, people):
    return spark.createDataFrame([(i, d, 200, "P", 7, t, t + 100) for i, d, t in people],
                                 "imsi string, district_id int, city_id int, home_province string, home_city int, "
                                 "min_end_time long, max_end_time long")


def test_delta_versions_merge_on_read(spark, tmp_root):
    root = os.path.join(tmp_root, "state")
    base = save_state(_summary(spark, [(f"p{i}", 1, 20240110100000) for i in range(3000)]), root, "202401101200")
    one = save_state(_summary(spark, [("p1", 1, 20240110090000), ("new", 1, 20240110100000)]), root, "202401101205", on=base)
    os.makedirs(os.path.join(root, "run=202401101207-0000000003-dead-on0000000002"))  # crashed delta
    two = save_state(_summary(spark, [("p1", 1, 20240110113000)]), root, "202401101210", on=one)
    assert latest_state(spark, root) == ("202401101210", two) and fs.size(spark, two) < fs.size(spark, base) / 4
    rows = {r.imsi: (r.min_end_time, r.max_end_time) for r in read_state(spark, two).collect()}
    assert len(rows) == 3001 and rows["p1"] == (20240110090000, 20240110113100) and rows["p2"] == (20240110100000, 20240110100100)
    assert read_state(spark, one).where("imsi = 'p1'").first().max_end_time == 20240110100100  # a late run's view
    assert read_state(spark, base).count() == 3000 and not compaction_due(spark, two)
    assert compaction_due(spark, two, max_deltas=2)
    plan = read_state(spark, two)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # the chain is merged bucket by bucket
    # a chain that crosses into the days that go keeps what it needs
    later = save_state(_summary(spark, [("x", 1, 20240114100000)]), root, "202401141200", on=two)
    save_state(_summary(spark, [("y", 1, 20240113100000)]), root, "202401131200")
    assert prune_states(spark, root, keep_days=2) == 1  # the crashed delta only
    assert read_state(spark, later).count() == 3002


def test_runs_write_in_proportion_to_their_slices(spark, tmp_root):
    dim = _day_files(spark, tmp_root)
    state_root, sizes, paths = os.path.join(tmp_root, "state"), [], []
    for as_of, n in (("202401101200", 0), ("202401101205", 1), ("202401101210", 1), ("202401101200", 0)):
        paths.append(run_visitor_job(spark, tmp_root, as_of, dim, None, state_root, n=n).state_path)
        sizes.append(fs.size(spark, paths[-1]))
    assert max(sizes[1:3]) < sizes[0] / 4 and "-on" in paths[1] and "-on" not in paths[3]


def test_chains_are_compacted(spark, tmp_root):
    root, path = os.path.join(tmp_root, "state"), None
    for k in range(6):
        rows = _lines(spark, [("s", f"p{k}", 5, "20500")]).select("value")
        path = rolling.save_step(path, clean(parse_signal_lines(rows)), _cells(spark), None, root, f"2024011012{k:02d}")
    assert sorted(r.imsi for r in read_state(spark, path).collect()) == [f"p{k}" for k in range(6)]
    whole = [n for n in os.listdir(root) if n.startswith("run=") and "-on" not in n]
    assert 2 <= len(whole) <= 4  # deltas as large as the whole version make the next one whole


def test_older_run_again_and_readable_reports(spark, tmp_root):
    dim = _day_files(spark, tmp_root)
    state_root = os.path.join(tmp_root, "state")
    first = {}
    for as_of, n in (("202401100900", 0), ("202401101200", 36), ("202401101500", 36), ("202401101800", 36)):
        out = run_visitor_job(spark, tmp_root, as_of, dim, None, state_root, n=n)
        first[as_of] = _rows(out.dwell)
    again = run_visitor_job(spark, tmp_root, "202401101500", dim, None, state_root, n=36)
    assert _rows(again.dwell) == first["202401101500"] and first["202401101500"]


def _lines(spark, stamp_rows):
    """Lines of (imsi, station, end minute) under a file stamp."""
    return spark.createDataFrame([("|".join(["m", "1", imsi, f"202401101{m}", f"202401101{m}", "P", "7", "200", "", str(st),
                                             "1", "", "", "133"] + [""] * 14 + ["2024011012", ""]), stamp)
                                  for stamp, imsi, st, m in stamp_rows], "value string, slice string")


def _cells(spark):
    return spark.createDataFrame([(200, 5, 1, 1001, "D")], "city_id int, base_statn_id int, sector_id int, "
                                                           "district_id int, district_name string")


def test_batches_in_any_order_lose_nothing(spark, tmp_root):
    parts = [[("202401101205", "a", 5, "20500")], [("202401101205", "b", 5, "20501")],
             [("202401101150", "c", 5, "15000")], [("202401101210", "d", 5, "21000")]]
    want = None
    for k, order in enumerate(itertools.islice(itertools.permutations(range(4)), 0, 24, 5)):
        root, got = os.path.join(tmp_root, f"s{k}"), []
        for epoch, i in enumerate(order):
            merge_batch(_lines(spark, parts[i]), _cells(spark), None, root,
                        sink=lambda d, h, s: got.append((s, _rows(d))), epoch=epoch)
        # a replay of the last epoch changes nothing
        merge_batch(_lines(spark, parts[order[-1]]), _cells(spark), None, root, epoch=3)
        stamp, path = latest_state(spark, root)
        people = sorted(r.imsi for r in read_state(spark, path).collect())
        assert stamp == "202401101210" and people == ["a", "b", "c", "d"]
        assert [s for s, _ in got] == sorted(s for s, _ in got)  # never back
        want = want or got[-1]
        assert got[-1] == want


def test_poison_lines_do_not_stop_a_batch(spark, tmp_root):
    good = _lines(spark, [("202401101205", "a", 5, "20500")])
    bad = spark.createDataFrame([("short|line", "202401101205"), ("short", None),
                                 (good.first().value.replace("20240110120500", "20249910120500"), ""),
                                 (good.first().value.replace("|5|1|", "|x|1|"), "202401101205")],
                                "value string, slice string")
    seen = []
    merge_batch(good.unionByName(bad), _cells(spark), None, os.path.join(tmp_root, "s"), epoch=0,
                bad_sink=lambda df, epoch: seen.extend(r.reason for r in df.collect()))
    assert sorted(seen) == ["integer", "short", "short", "time"]
    assert read_state(spark, latest_state_path(spark, os.path.join(tmp_root, "s"))).count() == 1


def test_stamp_in_name(spark):
    names = [("sig_202401101205.txt", "202401101205"), ("x1234202401101205_2.txt", "202401101205"),
             ("sig_20240110120500.txt", "202401101205"), ("part-0001.txt", None), ("n_209999999999.txt", None)]
    df = spark.createDataFrame(names, "name string, want string")
    assert all(r.got == r.want for r in df.withColumn("got", stamp_in_name(F.col("name"))).collect())


def test_incremental_runs_equal_rebuild(spark, tmp_root):
    dim = _day_files(spark, tmp_root)
    n = 36  # 3 hours per run: reset window is [180, 360) minutes after midnight
    for mode in ("aggregate", "raw"):
        state_root = os.path.join(tmp_root, f"state-{mode}")
        res = None
        for as_of in ("202401100300", "202401100600", "202401100900", "202401101200"):
            out = run_visitor_job(spark, tmp_root, as_of, dim, res, state_root, n=n, mode=mode)
        rebuild = run_visitor_job(spark, tmp_root, "202401101200", dim, None,
                                  os.path.join(tmp_root, f"rebuild-{mode}"), n=0)
        assert out.stamp == rebuild.stamp == "202401101200"
        assert _rows(out.dwell) == _rows(rebuild.dwell)
        assert _rows(out.home) == _rows(rebuild.home)
        assert out.dwell.count() > 0


def test_empty_run_and_reset(spark, tmp_root):
    dim = _day_files(spark, tmp_root)
    out = run_visitor_job(spark, tmp_root, "202401100003", dim, None, os.path.join(tmp_root, "s"), n=0)
    assert out.stamp is None and out.dwell.count() == 0 and out.home.count() == 0
    # a run in the reset window ignores the old state
    state_root = os.path.join(tmp_root, "s2")
    run_visitor_job(spark, tmp_root, "202401101200", dim, None, state_root, n=0)
    fresh = run_visitor_job(spark, tmp_root, "202401100015", dim, None, state_root, n=3)
    only = visits(read_signal(spark, tmp_root, ["202401100015", "202401100010", "202401100005"]),
                  dim, None, False)
    assert _rows(fresh.dwell) == _rows(dwell_report(only, "202401100015"))


def test_empty_and_bad_slices_name_the_report(spark, tmp_root):
    root, got = os.path.join(tmp_root, "in"), []
    folder = os.path.join(root, "AGG", "AGG_3G_BSSAP", "200")
    os.makedirs(folder)

    def put(stamp, content):
        with open(os.path.join(folder, f"sig_{stamp}.txt"), "w") as f:
            f.write(content)

    def go():
        start_visitor_stream(spark, root, _cells(spark), None, os.path.join(tmp_root, "state"), os.path.join(tmp_root, "ckpt"),
                             sink=lambda d, h, s: got.append((s, d.count())), max_files=1).awaitTermination(600)

    put("202401101205", _lines(spark, [("s", "a", 5, "20500")]).first().value + "\n")
    go()
    assert got == [("202401101205", 1)]
    put("202401101210", "cut|off\n")
    go()  # a restart from the checkpoint, with a slice of bad lines
    put("202401101215", "")
    go()  # and one with an empty slice only
    put("202401101150", "")
    go()  # an early empty slice does not move the stamp back
    assert got == [("202401101205", 1), ("202401101210", 1), ("202401101215", 1), ("202401101215", 1)]
    seen = {r.slice: r.epoch for r in slices_so_far(spark, os.path.join(tmp_root, "state")).collect()}
    assert sorted(seen) == ["202401101150", "202401101205", "202401101210", "202401101215"] and len(set(seen.values())) == 4


def test_files_of_a_batch_after_the_source_log_is_compacted(spark, tmp_root):
    ckpt = os.path.join(tmp_root, "ckpt")
    os.makedirs(os.path.join(ckpt, "sources", "0"))
    os.makedirs(os.path.join(ckpt, "offsets"))
    entry = lambda n: '{"path":"file:///in/sig%%20%d.txt","timestamp":1,"batchId":%d}' % (n, n)
    for name, ids in (("2.compact", (0, 1, 2)), ("3", (3,)), ("4", (4,))):
        with open(os.path.join(ckpt, "sources", "0", name), "w") as f:
            f.write("\n".join(["v1", *map(entry, ids)]))
    for epoch, last in ((0, 0), (1, 2), (2, 3)):
        with open(os.path.join(ckpt, "offsets", str(epoch)), "w") as f:
            f.write('v1\n{"batchWatermarkMs":0}\n{"logOffset":%d}' % last)
    files = lambda epoch: sorted(r.file for r in admitted_files(spark, ckpt, epoch).collect())
    assert files(0) == ["file:///in/sig 0.txt"] and files(1) == ["file:///in/sig 1.txt", "file:///in/sig 2.txt"]
    assert files(2) == ["file:///in/sig 3.txt"]


def test_available_now_stream_equals_batch(spark, tmp_root):
    dim = _day_files(spark, tmp_root)
    # keep only today's slices up to 12:05 so the stream and the batch see the same files
    stamps = until_now_slices("202401101205")
    for latn in os.listdir(os.path.join(tmp_root, "AGG", "AGG_3G_BSSAP")):
        folder = os.path.join(tmp_root, "AGG", "AGG_3G_BSSAP", latn)
        for f in os.listdir(folder):
            if f[4:16] not in stamps:
                os.rename(os.path.join(folder, f), os.path.join(folder, f + ".later"))
    got = {}

    def sink(dur, home, stamp):
        got[stamp] = (_rows(dur), _rows(home))

    q = start_visitor_stream(spark, tmp_root, dim, None, os.path.join(tmp_root, "state"),
                             os.path.join(tmp_root, "ckpt"), sink=sink, max_files=40)
    q.awaitTermination(600)
    assert len(got) >= 2
    last = max(got)
    v = visits(read_signal(spark, tmp_root, stamps), dim, None, False)
    assert got[last] == (_rows(dwell_report(v, last)), _rows(home_report(v, last)))


def test_table_sinks(spark, tmp_root):
    res = spark.createDataFrame([("a", "u", 200, 1001, "D", 1), ("b", "v", 200, 1002, "E", 2)],
                                "imsi string, user_number string, city_id int, district_id int, "
                                "district_name string, user_attr int")
    path = os.path.join(tmp_root, "residence")
    save_residence(res, path)
    back = spark.read.orc(path)
    assert "update_time" in back.columns
    assert _rows(back.drop("update_time")) == _rows(res)
    rep = spark.createDataFrame([(1001, 0, 5)], "district_id int, section_id int, visitor_number bigint") \
        .withColumn("timestamp", F.to_timestamp_ntz(F.lit("202401101205"), F.lit("yyyyMMddHHmm")))
    out = os.path.join(tmp_root, "report")
    append_report(rep, out)
    append_report(rep, out)  # a re-run replaces its own stamp
    assert spark.read.parquet(out).count() == 1
    append_report(rep.limit(0), out, stamp="202401101205")  # nor does an empty re-run leave the old rows
    assert spark.read.parquet(out).count() == 0


def test_catalog_tables_and_two_pass_residence(spark):
    res = spark.createDataFrame([("a", 1001, 1), ("b", 1002, 2)], "imsi string, district_id int, user_attr int")
    spark.sql("DROP TABLE IF EXISTS footfall_residence_test")
    save_residence_two_pass(res.where("user_attr = 1"), res.where("user_attr = 2"), "footfall_residence_test")
    assert _rows(read_residence(spark, "footfall_residence_test")) == [(1001, "a"), (1002, "b")]
    spark.sql("DROP TABLE footfall_residence_test")


def test_quarantine_sink_replaces_its_own_run(spark, tmp_root):
    bad = spark.createDataFrame([("x", "short")], "value string, reason string")
    for _ in range(2):
        save_quarantine(bad, os.path.join(tmp_root, "bad"), "7")
    assert spark.read.parquet(os.path.join(tmp_root, "bad")).count() == 1


def test_stream_batch_across_midnight(spark, tmp_root):
    sig = fixtures.signal(spark, SF_MID).where(
        "start_time >= '20240110200000' and start_time < '20240111040000'")
    write_slice_files(signal_rows(sig), tmp_root)
    dim = F.broadcast(fixtures.dim_district(spark, SF_MID))
    got = {}

    def sink(dur, home, stamp):
        got[stamp] = _rows(dur)

    q = start_visitor_stream(spark, tmp_root, dim, None, os.path.join(tmp_root, "state"),
                             os.path.join(tmp_root, "ckpt"), sink=sink)  # one batch
    q.awaitTermination(600)
    stamps = sorted(got)
    assert len(stamps) == 2 and stamps[0].startswith("20240111") and stamps[0] <= "202401110000"
    old_day = [s for s in until_now_slices("202401110000")]  # empty: 00:00 has no same-day slices
    assert old_day == []
    day1 = [f"20240110{h:02d}{m:02d}" for h in range(20, 24) for m in range(0, 60, 5)] + \
        ["202401110000"]
    day2 = [s for s in until_now_slices(stamps[1])]
    for stamp, slices in ((stamps[0], day1), (stamps[1], day2)):
        v = visits(read_signal(spark, tmp_root, slices), dim, None, False)
        assert got[stamp] == _rows(dwell_report(v, stamp))


def test_stream_partitioned_layout(spark, tmp_root):
    from footfall.sources.signal_text import read_signal_partitioned, write_slices
    sig = fixtures.signal(spark, SF_MID).where(
        "start_time >= '20240110000500' and start_time < '20240110121000'")
    write_slices(sig, tmp_root)
    dim = F.broadcast(fixtures.dim_district(spark, SF_MID))
    got = {}

    def sink(dur, home, stamp):
        got[stamp] = _rows(dur)

    q = start_visitor_stream(spark, tmp_root, dim, None, os.path.join(tmp_root, "state"),
                             os.path.join(tmp_root, "ckpt"), sink=sink, layout="partitioned")
    q.awaitTermination(600)
    last = max(got)
    rows = read_signal_partitioned(spark, tmp_root, until_now_slices("202401101205")).drop("slice")
    assert got[last] == _rows(dwell_report(visits(rows, dim, None, False), last))


def test_outcome_counts_what_a_run_leaves_out(spark, tmp_root):
    """Bad lines by reason, residents, and visitors without a dwell band, in both layouts and modes."""
    from footfall.sources.signal_text import format_signal_lines, write_slices
    from tests.helpers import dim_df, sig_row, signal_df

    rows = signal_df(spark, [sig_row("home", "20240110120000"), sig_row("guest", "20240110120000"),
                             sig_row("guest", "20240110120100"), sig_row("wide", "2024011012000", "20240110120000"),
                             sig_row("late", "20249910120000", "20240110120000")])
    dim = dim_df(spark, [(200, 1, 0, 1001)])
    res = spark.createDataFrame([(1001, "home")], "district_id int, imsi string")
    folder = f"{tmp_root}/files/AGG/AGG_3G_BSSAP/200"
    os.makedirs(folder)
    lines = [r.value for r in format_signal_lines(rows).collect()] + ["a|b"]
    with open(f"{folder}/sig_202401101205.txt", "w") as f:
        f.write("\n".join(lines) + "\n")
    write_slices(rows, f"{tmp_root}/parts")
    for layout, root, bad, n in (("files", "files", {"short": 1, "time": 2}, 6), ("partitioned", "parts", {"time": 2}, 5)):
        for mode in ("aggregate", "raw"):
            out = run_visitor_job(spark, f"{tmp_root}/{root}", "202401101205", dim, res, f"{tmp_root}/{layout}-{mode}",
                                  n=3, layout=layout, mode=mode).outcome
            assert (out["bad"], out["lines"]) == (bad, n)
            assert (out["found"], out["residents"]) == ((4, 1) if mode == "aggregate" else (5, 1))
            assert (out["dwell_negative"], out["dwell_unknown"]) == (0, 2)
    # all lines bad or of residents: nothing comes of the run, and the counts are there
    with open(f"{folder}/sig_202401101210.txt", "w") as f:
        f.write("a|b\n" + lines[0] + "\n")
    poor = run_visitor_job(spark, f"{tmp_root}/files", "202401101211", dim, res, f"{tmp_root}/poor", n=1).outcome
    assert (poor["bad"], poor["lines"], poor["found"], poor["residents"], poor["dwell_unknown"]) == ({"short": 1}, 2, 1, 1, 0)
    blank = run_visitor_job(spark, f"{tmp_root}/files", "202401101211", dim.where("false"), res, f"{tmp_root}/blank", n=1).outcome
    assert blank["bad"] == {"short": 1} and blank["found"] == 0
    nothing = run_visitor_job(spark, f"{tmp_root}/none", "202401101205", dim, res, f"{tmp_root}/none-state", n=3)
    assert nothing.outcome["lines"] is None and nothing.outcome["found"] in (0, None) and len(nothing.outcome["missing"]) == 3
    assert nothing.dwell.count() == 0 and nothing.home.count() == 0
