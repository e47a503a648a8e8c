"""Equivalent DuckDB SQL for every registered query (the correctness oracle).

Only the driver's base tables exist as views there, so every statement inlines the
projection of ``events`` onto the signal model (see footfall.sources.fixtures).
"""

from __future__ import annotations

from footfall.constants import DWELL_BAND_UPPER, RECENCY_MINUTES

# The run parameters of footfall.params and the slices they stand for, spelled
# out so that no code under test computes them.
AS_OF = "202401101205"
UNTIL = "{c} BETWEEN '202401100005' AND '202401101205'"
LAST_N = "{c} BETWEEN '202401092320' AND '202401100015'"
RANGE_SIGNAL = "(substr({c}, 1, 10) = '2024010723' OR substr({c}, 1, 8) = '20240108')"
RANGE_DENSE = ("(substr({c}, 1, 10) = '2024010723' "
               "OR substr({c}, 1, 8) IN ('20240108', '20240109', '20240110'))")
EVERYTHING = "TRUE"
WEEK = "hour >= 2023123123 AND hour < 2024010523"
RES_DAYS_SIGNAL, RES_DAYS_DENSE, ROLLING_N = 1, 3, 3
CELL_LOAD_HOUR, X_STAY_SECONDS = 2024011018, 14400

_FMT = "'%Y%m%d%H%M%S'"


def _signal(name: str, dense: bool) -> str:
    uid = "user_id % (SELECT greatest(15, count(*) // 100) FROM customer)" if dense else "user_id"
    return f"""{name}_ev AS (
  SELECT event_id, event_type, ts, {uid} AS user_id,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         ts + to_seconds(CAST(floor(value) AS BIGINT)) AS te
  FROM events),
{name} AS (
  SELECT e.event_type AS message_type, CAST(e.event_id % 3 AS INTEGER) AS type,
         '460' || lpad(CAST(e.user_id AS VARCHAR), 12, '0') AS imsi,
         '133' || lpad(CAST(e.user_id AS VARCHAR), 8, '0') AS user_number,
         strftime(e.ts, '%Y%m%d%H%M%S') AS start_time, strftime(e.te, '%Y%m%d%H%M%S') AS end_time,
         e.k AS base_statn_id, CAST(e.event_id % 3 AS INTEGER) AS sector_id,
         r.r_name AS home_province, n.n_nationkey AS home_latn_id,
         CAST(CASE WHEN e.user_id % 10 = 9 THEN 201 ELSE 200 END AS INTEGER) AS latn_id,
         CAST(strftime(e.ts, '%Y%m%d%H') AS INTEGER) AS hour,
         substr(strftime(e.ts, '%Y%m%d%H%M%S'), 1, 10)
           || lpad(CAST(CAST(strftime(e.ts, '%M') AS INTEGER) // 5 * 5 AS VARCHAR), 2, '0') AS slice_stamp
  FROM {name}_ev e JOIN customer c ON e.user_id = c.c_custkey
       JOIN nation n ON c.c_nationkey = n.n_nationkey
       JOIN region r ON n.n_regionkey = r.r_regionkey)"""


_DIM = """dim AS (
  SELECT DISTINCT CAST(200 AS INTEGER) AS city_id, base_statn_id, sector_id,
         CAST(1001 + base_statn_id % 3 AS INTEGER) AS district_id,
         'District ' || CAST(1001 + base_statn_id % 3 AS VARCHAR) AS district_name
  FROM sig0 WHERE base_statn_id >= 0 AND base_statn_id < 90 AND NOT (sector_id = 2 AND base_statn_id % 2 = 0))"""


def _with(*ctes: str, dense: bool = False) -> str:
    parts = [_signal("sig0", False)]
    if dense:
        parts.append(_signal("sigd", True))
    parts.append(_DIM)
    parts.extend(ctes)
    return "WITH " + ",\n".join(parts) + "\n"


def _sig(dense: bool) -> str:
    return "sigd" if dense else "sig0"


def _range_pred(col: str, which: str) -> str:
    """One of the slice selections above on a stamp column."""
    return which.format(c=col)


def _epoch(x: str) -> str:
    return f"CAST(epoch(try_strptime({x}, {_FMT})) AS BIGINT)"


def _stamp_ts(stamp: str) -> str:
    return f"CAST(strptime('{stamp}', '%Y%m%d%H%M') AS TIMESTAMP)"


def _enriched(name: str, src: str, where: str = "TRUE") -> str:
    return f"""{name} AS (
  SELECT s.message_type, s.type, s.imsi, s.user_number, s.start_time, s.end_time,
         s.home_province, s.home_latn_id, s.hour, d.city_id, d.base_statn_id, d.sector_id,
         d.district_id, d.district_name, s.slice_stamp
  FROM {src} s JOIN dim d
    ON s.latn_id = d.city_id AND s.base_statn_id = d.base_statn_id AND s.sector_id = d.sector_id
  WHERE {where})"""


def _section(d: str) -> str:
    b = DWELL_BAND_UPPER
    parts = [f"WHEN {d} = {b[0]} THEN 0"]
    parts += [f"WHEN {d} > {b[k - 1]} AND {d} <= {b[k]} THEN {k}" for k in range(1, len(b))]
    parts.append(f"WHEN {d} > {b[-1]} THEN {len(b)}")
    return "CASE " + " ".join(parts) + " END"


# --- residence -----------------------------------------------------------------------

def _residence_ctes(src: str, stamps, days: int, night=True, work=True, rollover=True,
                    min_stay=4, match="exact", prefix="r") -> str:
    attr = []
    if night:
        attr.append("WHEN hod >= 23 OR hod <= 6 THEN 1")
    if work:
        attr.append("WHEN hod >= 8 AND hod <= 17 THEN 2")
    stay_date = "CASE WHEN hod = 23 THEN date + 1 ELSE date END" if rollover else "date"
    cmp = "=" if match == "exact" else ">="
    return f"""{prefix}_ppl AS (
  SELECT s.imsi, s.user_number, s.end_time,
         TRY_CAST(substr(CAST(s.hour AS VARCHAR), 9, 2) AS INTEGER) AS hod,
         CAST(try_strptime(substr(CAST(s.hour AS VARCHAR), 1, 8), '%Y%m%d') AS DATE) AS date,
         d.city_id, d.district_id, d.district_name
  FROM {src} s JOIN dim d
    ON s.latn_id = d.city_id AND s.base_statn_id = d.base_statn_id AND s.sector_id = d.sector_id
  WHERE s.latn_id = 200 AND {_range_pred('s.slice_stamp', stamps)}),
{prefix}_tag AS (
  SELECT *, CASE {' '.join(attr)} END AS user_attr, {stay_date} AS stay_date FROM {prefix}_ppl),
{prefix}_daily AS (
  SELECT imsi, district_id, user_attr, stay_date, min(user_number) AS user_number,
         min(city_id) AS city_id, min(district_name) AS district_name,
         {_epoch('max(end_time)')} - {_epoch('min(end_time)')} AS duration
  FROM {prefix}_tag WHERE user_attr IS NOT NULL
  GROUP BY imsi, district_id, user_attr, stay_date),
{prefix}_days AS (
  SELECT imsi, district_id, user_attr, min(user_number) AS user_number, min(city_id) AS city_id,
         min(district_name) AS district_name, count(*) AS stay_days
  FROM {prefix}_daily WHERE duration >= {min_stay}
  GROUP BY imsi, district_id, user_attr),
{prefix}_res AS (
  SELECT imsi, user_number, city_id, district_id, district_name, user_attr
  FROM {prefix}_days WHERE stay_days {cmp} {days})"""


def _residence_query(dense: bool, stamps, days: int, **kw) -> str:
    return _with(_residence_ctes(_sig(dense), stamps, days, **kw), dense=dense) + "SELECT * FROM r_res"


# --- visits and reports ---------------------------------------------------------------

def _visits_ctes(src_rows: str, remove: str | None) -> str:
    anti = ""
    if remove:
        anti = (f"WHERE NOT EXISTS (SELECT 1 FROM {remove} x "
                "WHERE x.district_id = v.district_id AND x.imsi = v.imsi)")
    return f"""v_all AS (
  SELECT imsi, district_id, min(user_number) AS user_number, min(city_id) AS city_id,
         min(district_name) AS district_name,
         min(struct_pack(p := home_province, c := home_latn_id)) AS home,
         min(end_time) AS min_end_time, max(end_time) AS max_end_time
  FROM {src_rows} GROUP BY imsi, district_id),
vis AS (SELECT * FROM v_all v {anti})"""


def _dwell_select(stamp: str) -> str:
    return f"""dw AS (
  SELECT imsi, district_id, user_number, city_id, district_name,
         {_epoch('max_end_time')} - {_epoch('min_end_time')} AS duration FROM vis),
sec AS (SELECT *, {_section('duration')} AS section_id FROM dw)
SELECT {_stamp_ts(stamp)} AS timestamp, min(city_id) AS city_id, district_id, section_id,
       count(imsi) AS visitor_number
FROM sec GROUP BY district_id, section_id"""


def _home_select(stamp: str) -> str:
    m1, m2, m3 = RECENCY_MINUTES
    return f"""rc AS (
  SELECT imsi, district_id, city_id, home.p AS home_province, home.c AS home_city,
         CAST(epoch(strptime('{stamp}', '%Y%m%d%H%M')) AS BIGINT) - {_epoch('max_end_time')} AS duration
  FROM vis)
SELECT {_stamp_ts(stamp)} AS timestamp, min(city_id) AS city_id, district_id, home_province,
       home_city,
       CAST(sum(CASE WHEN duration <= {m1 * 60} THEN 1 ELSE 0 END) AS BIGINT) AS visitor_number1,
       CAST(sum(CASE WHEN duration <= {m2 * 60} THEN 1 ELSE 0 END) AS BIGINT) AS visitor_number2,
       CAST(sum(CASE WHEN duration <= {m3 * 60} THEN 1 ELSE 0 END) AS BIGINT) AS visitor_number3
FROM rc GROUP BY district_id, home_province, home_city"""


def _report(kind: str, stamps, stamp: str, dense=False, res_stamps=None, res_days=None) -> str:
    ctes = [_enriched("enr", _sig(dense), _range_pred("s.slice_stamp", stamps))]
    remove = None
    if res_days is not None:
        ctes.append(_residence_ctes(_sig(dense), res_stamps, res_days))
        remove = "r_res"
    ctes.append(_visits_ctes("enr", remove))
    body = _dwell_select(stamp) if kind == "dur" else _home_select(stamp)
    return _with(*ctes, dense=dense) + "," + body


# --- queries -------------------------------------------------------------------------

_SIGNAL_COLS = ("message_type, type, imsi, user_number, start_time, end_time, base_statn_id, "
                "sector_id, home_province, home_latn_id, latn_id, hour")


def _variant(col: str) -> str:
    """Text variant of an int field in the int_or_zero query: 3, 4, 5 -> zero markers."""
    return (f"CASE WHEN (base_statn_id + sector_id + {len(col)}) % 6 IN (3, 4, 5) THEN 0 "
            f"ELSE {col} END AS {col}")


def _int_or_zero_sql() -> str:
    ints = ["type", "base_statn_id", "sector_id", "home_latn_id", "latn_id", "hour"]
    cols = []
    for c in _SIGNAL_COLS.split(", "):
        cols.append(_variant(c) if c in ints else c)
    return _with() + f"SELECT {', '.join(cols)} FROM sig0"


def _rolling_reset_sql() -> str:
    n = ROLLING_N
    m = "CAST(substr(slice_stamp, 9, 2) AS INTEGER) * 60 + CAST(substr(slice_stamp, 11, 2) AS INTEGER)"
    return _with() + (f"SELECT DISTINCT slice_stamp, ({m} >= {5 * n} AND {m} < {10 * n}) AS reset "
                      f"FROM sig0")


def _job_counts_sql(until: str, sig_range: str) -> str:
    broken = "substr(end_time, 1, 4) || '99' || substr(end_time, 7)"
    missing = ROLLING_N - 1  # of the run's slices only the newest has a file
    return _with(
        f"lined AS (SELECT *, (base_statn_id + home_latn_id) % 7 AS v FROM sig0 WHERE {_range_pred('slice_stamp', until)})",
        f"""usable AS (SELECT * REPLACE (CASE WHEN v = 3 THEN {broken} ELSE end_time END AS end_time)
  FROM lined WHERE v NOT IN (0, 1))""",
        _enriched("enr", "usable"), _residence_ctes("sig0", sig_range, RES_DAYS_SIGNAL), _visits_ctes("enr", "r_res"),
        f"dw AS (SELECT {_epoch('max_end_time')} - {_epoch('min_end_time')} AS duration FROM vis)") + f"""
SELECT name, CAST(n AS BIGINT) AS n FROM (
  SELECT 'lines' AS name, count(*) AS n FROM lined
  UNION ALL SELECT 'short', count(*) FROM lined WHERE v = 0 HAVING count(*) > 0
  UNION ALL SELECT 'integer', count(*) FROM lined WHERE v = 1 HAVING count(*) > 0
  UNION ALL SELECT 'time', count(*) FROM lined WHERE v IN (2, 3) HAVING count(*) > 0
  UNION ALL SELECT 'found', count(*) FROM v_all
  UNION ALL SELECT 'residents', (SELECT count(*) FROM v_all) - (SELECT count(*) FROM vis)
  UNION ALL SELECT 'dwell_negative', count(*) FROM dw WHERE duration < 0
  UNION ALL SELECT 'dwell_unknown', count(*) FROM dw WHERE duration IS NULL
  UNION ALL SELECT 'missing_slices', {missing})"""


def queries() -> dict[str, str]:
    until, dense_range, sig_range = UNTIL, RANGE_DENSE, RANGE_SIGNAL
    enr_all = _enriched("enr", "sig0")
    people_cols = ("imsi, user_number, end_time, hod AS hour, city_id, district_id, district_name, "
                   "date")
    res_d = _residence_ctes("sigd", dense_range, RES_DAYS_DENSE)
    all_d = _residence_ctes("sigd", EVERYTHING, RES_DAYS_DENSE)
    out = {
        "signal_scan": _with() + f"SELECT {_SIGNAL_COLS} FROM sig0",
        "int_or_zero": _int_or_zero_sql(),
        "district_dim": _with() + "SELECT * FROM dim",
        "dim_seed": _with() + """SELECT city_id, district_id, district_name, base_statn_id,
       'Station ' || CAST(base_statn_id AS VARCHAR) AS base_statn_name, sector_id,
       'Station ' || CAST(base_statn_id AS VARCHAR) || '_' || CAST(sector_id AS VARCHAR) AS sector_name,
       CAST(113.3 AS DOUBLE) AS center_longitude_baidu, CAST(23.1 AS DOUBLE) AS center_latitude_baidu,
       CAST(1 AS INTEGER) AS flow_rate FROM dim""",
        "residence_scan": _residence_query(False, sig_range, RES_DAYS_SIGNAL).replace(
            "SELECT * FROM r_res", "SELECT district_id, imsi FROM r_res"),
        "slices_last_n": _with() + f"SELECT {_SIGNAL_COLS}, slice_stamp FROM sig0 "
                                   f"WHERE {_range_pred('slice_stamp', LAST_N)}",
        "slices_until_now": _with() + f"SELECT {_SIGNAL_COLS}, slice_stamp FROM sig0 "
                                      f"WHERE {_range_pred('slice_stamp', until)}",
        "slices_stay_range": _with() + f"SELECT {_SIGNAL_COLS}, slice_stamp FROM sig0 "
                                       f"WHERE {_range_pred('slice_stamp', dense_range)}",
        "default_start": _with() + """SELECT DISTINCT CAST(ts AS DATE) AS run_date,
       strftime(CAST(date_trunc('week', CAST(ts AS DATE)) AS DATE) - 8, '%Y%m%d') || '23' AS default_start
FROM sig0_ev""",
        "city_filter": _with() + f"SELECT {_SIGNAL_COLS} FROM sig0 WHERE latn_id = 200",
        "calendar_split": _with() + """SELECT imsi, user_number, latn_id, base_statn_id, sector_id, end_time,
       TRY_CAST(substr(CAST(hour AS VARCHAR), 9, 2) AS INTEGER) AS hour,
       CAST(try_strptime(substr(CAST(hour AS VARCHAR), 1, 8), '%Y%m%d') AS DATE) AS date
FROM sig0 WHERE latn_id = 200""",
        "night_rows": _with(all_d, dense=True)
        + f"SELECT {people_cols}, user_attr, stay_date FROM r_tag WHERE user_attr = 1",
        "workday_rows": _with(all_d, dense=True)
        + f"SELECT {people_cols}, user_attr, stay_date FROM r_tag WHERE user_attr = 2",
        "night_stays": _with(all_d, dense=True)
        + "SELECT * FROM r_daily WHERE user_attr = 1 AND duration >= 4",
        "workday_stays": _with(all_d, dense=True)
        + "SELECT * FROM r_daily WHERE user_attr = 2 AND duration >= 4",
        "stay_days": _with(all_d, dense=True) + "SELECT * FROM r_days",
        "residents": _with(res_d, dense=True) + "SELECT * FROM r_res WHERE user_attr = 1",
        "staff": _with(res_d, dense=True) + "SELECT * FROM r_res WHERE user_attr = 2",
        "residence_table": _with(res_d, dense=True) + "SELECT * FROM r_res",
        "district_join": _with(enr_all) + "SELECT * EXCLUDE (slice_stamp) FROM enr",
        "resident_anti_join": _with(
            _enriched("enr", "sigd"), res_d, dense=True)
        + """SELECT * EXCLUDE (slice_stamp) FROM enr e WHERE NOT EXISTS (
  SELECT 1 FROM r_res x WHERE x.district_id = e.district_id AND x.imsi = e.imsi)""",
        "dwell": _with(_enriched("enr", "sig0"),
                       _visits_ctes("enr", None))
        + f"""SELECT imsi, district_id, user_number, city_id, district_name,
       {_epoch('max_end_time')} - {_epoch('min_end_time')} AS duration FROM vis""",
        "dwell_section": _with(_enriched("enr", "sig0"),
                               _visits_ctes("enr", None))
        + f"""SELECT imsi, district_id, user_number, city_id, district_name, duration,
       {_section('duration')} AS section_id FROM (
  SELECT *, {_epoch('max_end_time')} - {_epoch('min_end_time')} AS duration FROM vis)""",
        "visitor_flow_dur": _report("dur", until, AS_OF, res_stamps=sig_range,
                                    res_days=RES_DAYS_SIGNAL),
        "recency": _with(_enriched("enr", "sig0"),
                         _visits_ctes("enr", None))
        + f"""SELECT imsi, district_id, user_number, city_id, district_name,
       home.p AS home_province, home.c AS home_city,
       CAST(epoch(strptime('{AS_OF}', '%Y%m%d%H%M')) AS BIGINT) - {_epoch('max_end_time')} AS duration
FROM vis""",
        "visitor_flow_home": _report("home", until, AS_OF, res_stamps=sig_range,
                                     res_days=RES_DAYS_SIGNAL),
        "rolling_step": _report("dur", until, AS_OF, res_stamps=sig_range,
                                res_days=RES_DAYS_SIGNAL),
        "rolling_step_home": _report("home", until, AS_OF, res_stamps=sig_range,
                                     res_days=RES_DAYS_SIGNAL),
        "rolling_raw_step": _report("dur", until, AS_OF, res_stamps=sig_range,
                                    res_days=RES_DAYS_SIGNAL),
        "rolling_reset": _rolling_reset_sql(),
        "rolling_rebuild": _report("dur", until, AS_OF, res_stamps=sig_range,
                                   res_days=RES_DAYS_SIGNAL),
        "x_week_range": _with() + f"SELECT {_SIGNAL_COLS} FROM sig0 WHERE " + WEEK,
        "x_residents_unshifted": _with(_residence_ctes("sigd", dense_range, RES_DAYS_DENSE,
                                                       work=False, rollover=False), dense=True)
        + "SELECT * FROM r_res",
        "x_stay_4h": _with(_residence_ctes("sigd", EVERYTHING, RES_DAYS_DENSE, work=False,
                                           rollover=False, min_stay=X_STAY_SECONDS), dense=True)
        + """SELECT imsi, district_id, user_number, city_id, district_name, stay_days,
       CASE WHEN stay_days = 1 THEN 1 END AS user_attr FROM r_days""",
        "x_sector_rollup": _with() + """SELECT city_id, district_id, base_statn_id, sector_id,
       min(district_name) AS district_name,
       min('Station ' || CAST(base_statn_id AS VARCHAR)) AS base_statn_name,
       min('Station ' || CAST(base_statn_id AS VARCHAR) || '_' || CAST(sector_id AS VARCHAR)) AS sector_name
FROM dim WHERE city_id = 200 GROUP BY city_id, district_id, base_statn_id, sector_id""",
        "x_cell_multiplicity": _with() + """SELECT city_id, base_statn_id, sector_id, count(*) AS n
FROM dim WHERE city_id = 200 GROUP BY city_id, base_statn_id, sector_id""",
        "x_hour_coverage": _with(_residence_ctes("sigd", EVERYTHING, RES_DAYS_DENSE, work=False,
                                                 rollover=False), dense=True)
        + """SELECT imsi, date, district_id, min(hod) AS first_hour, min(user_number) AS user_number,
       count(DISTINCT hod) AS cd_hour,
       string_agg(DISTINCT CAST(hod AS VARCHAR), ';' ORDER BY CAST(hod AS VARCHAR)) AS hours
FROM r_tag WHERE user_attr = 1 GROUP BY imsi, date, district_id""",
        "x_cell_load": _with() + f"""SELECT latn_id, base_statn_id, sector_id, count(*) AS n
FROM sig0 WHERE latn_id = 200 AND hour = {CELL_LOAD_HOUR}
GROUP BY latn_id, base_statn_id, sector_id""",
    }
    out["visitor_job"] = out["visitor_flow_dur"]
    out["visitor_job_home"] = out["visitor_flow_home"]
    for name in ("visitor_job_files", "job_rerun_older", "stream_same_stamp", "stream_late_batch"):
        out[name] = out["visitor_flow_dur"]
    out["report_copartitioned"] = out["visitor_flow_dur"]
    # the newest slice is empty: the rows are those until 12:05, the stamp is its own
    out["stream_restarted"] = _report("dur", until, "202401101215", res_stamps=sig_range, res_days=RES_DAYS_SIGNAL)
    out["signal_quarantine"] = _with() + """SELECT
  CASE v WHEN 0 THEN 'short' WHEN 1 THEN 'integer' ELSE 'time' END AS reason, message_type, imsi,
  CASE v WHEN 2 THEN substr(start_time, 1, 4) || '99' || substr(start_time, 7) ELSE start_time END AS start_time
FROM (SELECT *, (base_statn_id + home_latn_id) % 5 AS v FROM sig0) WHERE v IN (0, 1, 2)"""
    out["slices_missing"] = out["slices_until_now"]
    out["slices_pruned"] = out["slices_until_now"]
    out["residence_two_pass"] = out["residence_table"]
    out["district_join_salted"] = out["district_join"]
    out["resident_outer_join"] = out["resident_anti_join"]
    out["resident_filtered_join"] = out["resident_anti_join"]
    out["sink_table"] = out["residence_daily"] = out["residence_table"]
    out["state_roundtrip"] = _with(
        _enriched("enr", "sig0", _range_pred("s.slice_stamp", until)),
        _residence_ctes("sig0", sig_range, RES_DAYS_SIGNAL), _visits_ctes("enr", "r_res")) + """
SELECT imsi, district_id, user_number, city_id, district_name, home.p AS home_province,
       home.c AS home_city, CAST(min_end_time AS BIGINT) AS min_end_time,
       CAST(max_end_time AS BIGINT) AS max_end_time
FROM vis"""
    out["state_deltas"] = out["state_roundtrip"]
    numbers = "visitor_number1, visitor_number2, visitor_number3"
    out["reports_one_pass"] = f"""SELECT 'dwell' AS report, timestamp, city_id, district_id, section_id,
       NULL AS home_province, NULL AS home_city, visitor_number, {', '.join(f'NULL AS {n}' for n in numbers.split(', '))}
FROM ({out['visitor_flow_dur']})
UNION ALL SELECT 'home', timestamp, city_id, district_id, NULL, home_province, home_city, NULL, {numbers}
FROM ({out['visitor_flow_home']})"""
    out["job_counts"] = _job_counts_sql(until, sig_range)
    return out
