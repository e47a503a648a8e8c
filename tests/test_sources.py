"""Scan round trips: reference file layout, missing slices, quarantine, partitioned layout."""

from pyspark.sql import functions as F

from footfall.functions.slices import until_now_slices
from footfall.schemas import SIGNAL_COLUMNS
from footfall.sources import fixtures
from footfall.sources.signal_text import (
    missing_stamps,
    read_partitioned_quarantine,
    read_signal,
    read_signal_partitioned,
    read_signal_quarantine,
    slice_files,
    slice_outcome,
    write_slices,
)
from tests.conftest import SF_SMALL
from tests.slice_files import signal_rows, write_slice_files


def _key(r):
    return tuple(str(r[c]) for c in SIGNAL_COLUMNS)


def test_text_round_trip_and_missing_slices(spark, tmp_root):
    sig = fixtures.signal(spark, SF_SMALL)
    rows = signal_rows(sig.where("start_time like '20240110%'"))
    stamps = write_slice_files(rows, tmp_root)
    wanted = until_now_slices("202401101205")
    back = read_signal(spark, tmp_root, wanted)
    expected = [r for r in rows if r["start_time"][:12] >= "202401100005"
                and r["start_time"][:12] <= "202401101209"]
    assert sorted(map(_key, back.collect())) == sorted(map(_key, expected))
    assert len(expected) > 0
    # stamps with no file are skipped; none at all gives an empty frame
    assert read_signal(spark, tmp_root, ["209901010000"]).count() == 0
    assert read_signal(spark, tmp_root, wanted + ["209901010000"]).count() == len(expected)
    assert set(stamps) & set(wanted)


def _files_read(df) -> int:
    """Files that the scans of an executed frame opened."""
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size())]
    return sum(s.metrics().apply("numFiles").value() for s in scans if s.metrics().contains("numFiles"))


def test_files_of_other_slices_are_not_opened(spark, tmp_root):
    rows = signal_rows(fixtures.signal(spark, SF_SMALL).where("start_time like '20240110%'"))
    stamps = write_slice_files(rows, tmp_root)
    df = read_signal(spark, tmp_root, stamps[:3])
    assert df.collect()
    assert 0 < _files_read(df) <= 6 < len(stamps)


def test_outcome_reports_what_was_not_used(spark, tmp_root):
    import gzip
    import os
    good = "|".join(["m", "1", "460x", "20240110000500", "20240110000600", "P", "7", "200", "",
                     "5", "1", "", "", "133x"] + [""] * 14 + ["2024011000", ""])
    late = good.replace("20240110000600", "20249910000600")
    write_slice_files([], tmp_root, {(200, "202401100005"): [good, "m|1", good.replace("|5|1|", "|5x|1|"), late]})
    broken = os.path.join(tmp_root, "AGG", "AGG_3G_BSSAP", "200", "sig_202401100010.txt.gz.txt")
    with open(broken, "wb") as f:
        f.write(gzip.compress(b"x" * 100)[:20])
    out = slice_outcome(spark, tmp_root, ["202401100005", "202401100010", "202401100015"])
    assert out["bad"]["short"] >= 1 and out["bad"]["integer"] == 1 and out["bad"]["time"] == 1
    assert out["missing"] == ["202401100015"]
    assert slice_outcome(spark, os.path.join(tmp_root, "none"), ["202401100005"])["missing"] == ["202401100005"]
    write_slices(read_signal(spark, tmp_root, ["202401100005"]).where("base_statn_id is not null").unionByName(
        read_signal(spark, tmp_root, ["202401100005"]).limit(1).withColumn("start_time", F.lit("?"))), tmp_root + "/p")
    bad = read_partitioned_quarantine(spark, tmp_root + "/p", ["202401100005"])
    assert {r.reason for r in bad.collect()} == {"time", "stamp"}
    assert slice_outcome(spark, tmp_root + "/p", ["202401100005"], "partitioned")["bad"] == {"time": 1, "stamp": 1}


def test_partitioned_layout_selects_by_the_files_stamp_and_prefix(spark, tmp_root):
    sig = fixtures.signal(spark, SF_SMALL).where("start_time like '20240110%'").withColumn("slice", F.lit("202401110005"))
    write_slices(sig, tmp_root)
    n = sig.count()
    assert read_signal_partitioned(spark, tmp_root, ["202401110005"]).count() == n  # late records and all
    assert read_signal_partitioned(spark, tmp_root, ["2024011100", "20240112"]).count() == n  # T3 prefixes
    assert read_signal_partitioned(spark, tmp_root, ["202401100005"]).count() == 0


def test_listing_ten_thousand_names(spark, tmp_root):
    import os
    folder = os.path.join(tmp_root, "AGG", "AGG_3G_BSSAP", "200")
    os.makedirs(folder)
    for i in range(10_000):
        with open(os.path.join(folder, f"sig_202401{10 + i % 2}{i // 2 // 60 % 24:02d}{i // 2 % 60:02d}_{i}.txt"), "w") as f:
            f.write("x")
    stamps = ["202401100005", "202401100010"]
    names = {r.file_name for r in slice_files(spark, tmp_root, stamps).collect()}
    assert names == {n for n in os.listdir(folder) if any(s in n for s in stamps)} and names


def test_quarantine_short_and_bad_lines(spark, tmp_root):
    good = "|".join(["m", "1", "460x", "20240110000500", "20240110000600", "P", "7", "200", "",
                     "5", "1", "", "", "133x"] + [""] * 14 + ["2024011000", ""])
    short = "m|1|460y|20240110000500"
    bad_int = good.replace("|5|1|", "|5x|1|")
    write_slice_files([], tmp_root, {(200, "202401100005"): [good, short, bad_int]})
    back = read_signal(spark, tmp_root, ["202401100005"]).collect()
    assert len(back) == 2
    assert {r.base_statn_id for r in back} == {5, None}
    q = read_signal_quarantine(spark, tmp_root, ["202401100005"]).collect()
    assert {r.reason for r in q} == {"short", "integer"} and all(r.file_name.startswith("sig_") for r in q)


def test_partitioned_layout_round_trip(spark, tmp_root):
    sig = fixtures.signal(spark, SF_SMALL).where("start_time like '20240110%'")
    write_slices(sig, tmp_root)
    wanted = until_now_slices("202401101205")
    df = read_signal_partitioned(spark, tmp_root, wanted)
    assert df.count() > 0
    have = sorted(r.slice for r in df.select("slice").distinct().collect())
    three = read_signal_partitioned(spark, tmp_root, have[:3])
    three.collect()
    files = read_signal_partitioned(spark, tmp_root, have[:3]).select("slice", "latn_id").distinct().count()
    assert 0 < _files_read(three) <= files and len(have) > 3
    expected = [r for r in signal_rows(sig) if "202401100005" <= r["start_time"][:12] <= "202401101209"]
    assert sorted(map(_key, df.drop("slice").collect())) == sorted(map(_key, expected))


def test_slice_files_substring_semantics(spark, tmp_root):
    import os
    from footfall.sources.signal_text import read_slice_lines
    folder = os.path.join(tmp_root, "AGG", "AGG_3G_BSSAP", "200")
    os.makedirs(folder)
    for name in ["sig_202401100005.txt", "x_202401100010_v2.txt", "sig_202401100015.csv",
                 "sig_202401110005.txt"]:
        with open(os.path.join(folder, name), "w") as f:
            f.write("line\n")
    stamps = ["202401100005", "202401100010", "202401100015", "2024011100"]
    files = sorted({r.file_name for r in slice_files(spark, tmp_root, stamps).collect()})
    assert files == ["sig_202401100005.txt", "sig_202401110005.txt", "x_202401100010_v2.txt"]
    assert missing_stamps(spark, tmp_root, stamps) == ["202401100015"]
    import pytest
    with pytest.raises(FileNotFoundError):
        read_slice_lines(spark, tmp_root, ["202401100015"], missing="fail")
    assert read_slice_lines(spark, tmp_root, ["209901010000"]).count() == 0
    assert read_slice_lines(spark, os.path.join(tmp_root, "none"), ["209901010000"]) is None


def test_strict_mode_fails_on_broken_lines(spark, tmp_root):
    import pytest
    good = "|".join(["m", "1", "460x", "20240110000500", "20240110000600", "P", "7", "200", "",
                     "5", "1", "", "", "133x"] + [""] * 14 + ["2024011000", ""])
    write_slice_files([], tmp_root, {(200, "202401100005"): [good, "m|1|460y"]})
    with pytest.raises(Exception):
        read_signal(spark, tmp_root, ["202401100005"], bad="fail").collect()
    assert read_signal(spark, tmp_root, ["202401100005"]).count() == 1


def test_tables_kept_between_queries_follow_the_input(spark, tmp_root):
    from footfall import registry

    for name in ("customer", "nation", "region", "events"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(f"{tmp_root}/{name}.parquet")
    seen = registry._dim_path(spark, tmp_root)
    assert registry._dim_path(spark, tmp_root) == seen and registry._dim(spark, tmp_root).count() > 0
    (spark.read.parquet(f"{SF_SMALL}/events.parquet").limit(0).write.mode("overwrite").parquet(f"{tmp_root}/events.parquet"))
    assert registry._dim_path(spark, tmp_root) != seen and registry._dim(spark, tmp_root).count() == 0
