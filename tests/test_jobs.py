"""The spark-submit entry points end to end on files written from the fixture."""

import os

from footfall import jobs
from footfall.plans.reports import dwell_report, visits
from footfall.plans.residence import residence_table
from footfall.functions.slices import stay_range, until_now_slices
from footfall.sources import fixtures
from footfall.sources.signal_text import read_signal
from tests.conftest import SF_MID
from tests.slice_files import signal_rows, write_slice_files


def test_seed_residence_and_visitor_commands(spark, tmp_root):
    sig = fixtures.signal(spark, SF_MID).where(
        "start_time >= '20240107230000' and start_time < '20240110130000'")
    write_slice_files(signal_rows(sig), tmp_root)
    cells = os.path.join(tmp_root, "cells")
    fixtures.dim_district_full(spark, SF_MID).write.orc(cells)
    dim_path = os.path.join(tmp_root, "dim")
    jobs.main(["seed-dim", "--cells", cells, "--out", dim_path])
    res_path = os.path.join(tmp_root, "residence")
    jobs.main(["residence", "--root", tmp_root, "--days", "1", "--start", "2024010723",
               "--dim", dim_path, "--out", res_path])
    dim = spark.read.orc(dim_path)
    expected_res = residence_table(read_signal(spark, tmp_root, stay_range("2024010723", 1)), dim, 1)
    got_res = spark.read.orc(res_path).drop("update_time")
    assert sorted(map(tuple, got_res.collect())) == sorted(map(tuple, expected_res.collect()))
    out_dur = os.path.join(tmp_root, "dur")
    jobs.main(["visitor", "--root", tmp_root, "--state", os.path.join(tmp_root, "state"),
               "--as-of", "202401101205", "--n", "0", "--dim", dim_path, "--residence", res_path,
               "--out-dur", out_dur, "--out-home", os.path.join(tmp_root, "home")])
    v = visits(read_signal(spark, tmp_root, until_now_slices("202401101205")), dim,
               spark.read.orc(res_path), False)
    want = sorted(map(tuple, dwell_report(v, "202401101205").collect()))
    got = spark.read.parquet(out_dur).select("timestamp", "city_id", "district_id", "section_id",
                                              "visitor_number")
    assert sorted(map(tuple, got.collect())) == want and want


def test_commands_set_the_tested_options_unless_given(spark):
    from footfall.session import RECOMMENDED_CONF
    new = spark.newSession()
    new.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    jobs.apply_recommended(new)
    given = spark.sparkContext.getConf()
    for key, value in RECOMMENDED_CONF.items():
        if key.startswith("spark.sql.") and not given.contains(key):
            assert new.conf.get(key) == value


def test_jdbc_options_come_from_the_environment(monkeypatch):
    assert jobs._jdbc() is None
    monkeypatch.setenv("FOOTFALL_JDBC_URL", "jdbc:x")
    monkeypatch.setenv("FOOTFALL_JDBC_PROPS", '{"user": "u"}')
    assert jobs._jdbc() == ("jdbc:x", {"user": "u"})
