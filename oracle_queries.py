"""Independent DuckDB SQL for every checked query.

Written from the definitions, not generated from the Spark code. Rules shared
with ``meterlake.plans.queries.checked``: every DOUBLE result is rounded to 9
digits (DuckDB's ``round(x, 9)`` rounds the scaled binary value; the Spark
side computes ``round(x * 10^9) / 10^9`` to match, and ``+ 0.0`` here turns a
rounded -0.0 into 0.0), calendar parts are INT, counts BIGINT, Spark
``dayofweek`` equals DuckDB ``dayofweek + 1``, and ``try_divide(a, b)`` is
``a / NULLIF(b, 0)``.
"""

from __future__ import annotations

D = 9
MEASURES = (
    "global_active_power",
    "global_reactive_power",
    "voltage",
    "global_intensity",
    "sub_metering_1",
    "sub_metering_2",
    "sub_metering_3",
)


def rd(expr: str) -> str:
    """Round to D digits; ``+ 0.0`` turns a rounded -0.0 into 0.0 as Spark's
    decimal rounding does."""
    return f"(round({expr}, {D}) + CAST(0 AS DOUBLE))"


def r(expr: str, alias: str) -> str:
    return f"{rd(expr)} AS {alias}"


def rounded_measures(prefix: str = "") -> str:
    return ", ".join(r(f"{prefix}{m}", m) for m in MEASURES)


READINGS = """
readings AS (
  SELECT event_id,
    date_trunc('minute', ts) AS datetime,
    CASE WHEN event_type = 'error' AND k % 7 = 0 THEN NULL
         ELSE (value - 5) / 1e1 END AS global_active_power,
    (k - 10) / 1e2 AS global_reactive_power,
    CAST(220 + user_id % 21 AS DOUBLE) AS voltage,
    CASE WHEN event_type = 'view' AND k % 11 = 0 THEN NULL
         ELSE k / 5e0 END AS global_intensity,
    CAST(k % 40 AS DOUBLE) AS sub_metering_1,
    CAST(user_id % 40 AS DOUBLE) AS sub_metering_2,
    CAST(event_id % 20 AS DOUBLE) AS sub_metering_3,
    user_id AS meter_id
  FROM (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e
)"""

_NOT_MISSING = " AND ".join(
    ["datetime IS NOT NULL"]
    + [f"{m} IS NOT NULL AND NOT isnan({m})" for m in MEASURES]
)

CLEAN = f"""
clean AS (
  SELECT event_id, datetime,
    CASE WHEN global_active_power < 0 THEN CAST(0 AS DOUBLE) ELSE global_active_power END AS global_active_power,
    CASE WHEN global_reactive_power < 0 THEN CAST(0 AS DOUBLE) ELSE global_reactive_power END AS global_reactive_power,
    voltage, global_intensity, sub_metering_1, sub_metering_2, sub_metering_3,
    CAST(year(datetime) AS INTEGER) AS year,
    CAST(month(datetime) AS INTEGER) AS month,
    CAST(day(datetime) AS INTEGER) AS day,
    CAST(hour(datetime) AS INTEGER) AS hour,
    CASE WHEN greatest(sub_metering_1, sub_metering_2, sub_metering_3) = sub_metering_1 THEN 'zone1'
         WHEN greatest(sub_metering_1, sub_metering_2, sub_metering_3) = sub_metering_2 THEN 'zone2'
         ELSE 'zone3' END AS zone,
    meter_id
  FROM readings
  WHERE {_NOT_MISSING}
)"""

BASE = f"WITH {READINGS},{CLEAN}"

CLEAN_COLUMNS = (
    f"event_id, datetime, {rounded_measures()}, year, month, day, hour, zone"
)

SQL: dict[str, str] = {}

SQL["readings"] = f"""{BASE}
SELECT event_id, datetime, {rounded_measures()} FROM readings"""

SQL["clean_stream"] = f"""{BASE}
SELECT {CLEAN_COLUMNS} FROM clean"""

# NULLs in columns that are neither the time nor a measure drop nothing
SQL["clean_stream_extras"] = f"""{BASE}
SELECT {CLEAN_COLUMNS}, CAST(NULL AS VARCHAR) AS note,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE meter_id END AS meter_id FROM clean"""

SQL["clean_batch"] = f"""{BASE}
SELECT event_id, datetime, {rounded_measures()} FROM readings
WHERE global_active_power IS NOT NULL AND NOT isnan(global_active_power)
  AND global_active_power > 0"""

SQL["hour_profile"] = f"""{BASE}
SELECT hour, {r('avg(global_active_power)', 'avg_active_power')},
  {r('avg(voltage)', 'avg_voltage')}, count(*) AS record_count
FROM clean WHERE hour IS NOT NULL GROUP BY hour ORDER BY hour"""

SQL["statistics"] = f"""{BASE}
SELECT count(*) AS total_records,
  {r('avg(global_active_power)', 'avg_active_power')},
  {r('max(global_active_power)', 'max_active_power')},
  {r('min(global_active_power)', 'min_active_power')},
  {r('avg(voltage)', 'avg_voltage')},
  {r('avg(global_intensity)', 'avg_intensity')},
  {r('sum(sub_metering_1 + sub_metering_2 + sub_metering_3)', 'total_sub_metering')}
FROM clean"""

SQL["timeseries"] = f"""{BASE}
SELECT * FROM (
  SELECT datetime,
    {r('avg(global_active_power)', 'avg_active_power')},
    {r('avg(voltage)', 'avg_voltage')},
    {r('avg(global_intensity)', 'avg_intensity')},
    {r('avg(sub_metering_1)', 'sub_metering_1')},
    {r('avg(sub_metering_2)', 'sub_metering_2')},
    {r('avg(sub_metering_3)', 'sub_metering_3')}
  FROM clean WHERE datetime IS NOT NULL
  GROUP BY datetime ORDER BY datetime DESC LIMIT 100
) ORDER BY datetime"""

SQL["latest"] = f"""{BASE}
SELECT datetime, {rounded_measures()} FROM clean
ORDER BY datetime DESC, event_id DESC LIMIT 100"""

SQL["latest_text"] = f"""{BASE}
SELECT strftime(datetime, '%Y-%m-%d %H:%M:%S') AS datetime, {rounded_measures()} FROM clean
ORDER BY clean.datetime DESC, event_id DESC LIMIT 100"""

SQL["zone_counts"] = f"""{BASE}
SELECT zone, count(*) AS record_count FROM clean GROUP BY zone"""

SQL["month_counts"] = f"""{BASE}
SELECT year, month, count(*) AS record_count FROM clean GROUP BY year, month"""

SQL["record_count"] = f"""{BASE}
SELECT count(*) AS record_count FROM clean"""

SQL["year_slice"] = f"""{BASE}
SELECT {CLEAN_COLUMNS} FROM clean WHERE year = 2024"""

SQL["submeter_latest"] = f"""{BASE},
newest AS (SELECT * FROM clean ORDER BY datetime DESC, event_id DESC LIMIT 1)
SELECT 'sub_metering_1' AS submeter, 'zone1' AS zone, {r('sub_metering_1', 'value_wh')} FROM newest
UNION ALL
SELECT 'sub_metering_2', 'zone2', {r('sub_metering_2', 'value_wh')} FROM newest
UNION ALL
SELECT 'sub_metering_3', 'zone3', {r('sub_metering_3', 'value_wh')} FROM newest"""

SQL["submeter_share"] = f"""{BASE},
t AS (SELECT sum(sub_metering_1) AS s1, sum(sub_metering_2) AS s2, sum(sub_metering_3) AS s3 FROM clean),
g AS (SELECT *, coalesce(s1, 0) + coalesce(s2, 0) + coalesce(s3, 0) AS grand FROM t)
SELECT 'sub_metering_1' AS submeter, 'zone1' AS zone, {r('s1', 'total_wh')}, {r('s1 / NULLIF(grand, 0)', 'share')} FROM g
UNION ALL
SELECT 'sub_metering_2', 'zone2', {r('s2', 'total_wh')}, {r('s2 / NULLIF(grand, 0)', 'share')} FROM g
UNION ALL
SELECT 'sub_metering_3', 'zone3', {r('s3', 'total_wh')}, {r('s3 / NULLIF(grand, 0)', 'share')} FROM g"""


def raw_roundtrip(m: str) -> str:
    return r(f"CAST(printf('%.3f', {m}) AS DOUBLE)", m)


SQL["parse_raw"] = f"""{BASE}
SELECT datetime, {", ".join(raw_roundtrip(m) for m in MEASURES)} FROM readings"""

SQL["parse_raw_lines"] = SQL["parse_raw"]

SQL["parse_json"] = f"""{BASE}
SELECT datetime, {rounded_measures()} FROM readings"""

SQL["parse_json_zone"] = f"""{BASE}
SELECT strftime(datetime, '%Y-%m-%d %H:%M:%S') AS timestamp, zone,
  {r('global_active_power', 'power')} FROM clean"""

_WIRE_FIELDS = ", ".join(f"{m} := {rd(m)}" for m in MEASURES)

SQL["emit_json"] = f"""{BASE}
SELECT CAST(to_json(struct_pack(datetime := strftime(datetime, '%Y-%m-%d %H:%M:%S'), {_WIRE_FIELDS})) AS VARCHAR) AS value
FROM readings WHERE {_NOT_MISSING}"""

_RESULT_FIELDS = ", ".join(f"{m} := {rd(m)}" for m in MEASURES)

SQL["result_json"] = f"""{BASE}
SELECT CAST(to_json(struct_pack(datetime := strftime(datetime, '%Y-%m-%dT%H:%M:%S'), {_RESULT_FIELDS})) AS VARCHAR) AS json
FROM (SELECT * FROM clean ORDER BY datetime DESC, event_id DESC LIMIT 100)"""

WEEKDAY = "CAST(dayofweek(datetime) + 1 AS INTEGER)"

SQL["row_features"] = f"""{BASE}
SELECT {CLEAN_COLUMNS},
  {WEEKDAY} AS weekday,
  CASE WHEN {WEEKDAY} IN (1, 7) THEN 1 ELSE 0 END AS is_weekend,
  {r('sub_metering_1 + sub_metering_2 + sub_metering_3', 'sub_total')},
  {r('global_active_power - global_reactive_power', 'power_diff')},
  {r('global_active_power / NULLIF(voltage, 0)', 'power_per_voltage')},
  {r('global_reactive_power / NULLIF(global_active_power, 0)', 'reactive_ratio')}
FROM clean"""

SQL["weekday_flags"] = f"""{BASE}
SELECT event_id, datetime, {WEEKDAY} AS weekday,
  CASE WHEN {WEEKDAY} IN (1, 7) THEN 1 ELSE 0 END AS is_weekend
FROM clean"""

SQL["hourly_features"] = f"""{BASE}
SELECT year, month, day, hour,
  {r('avg(global_active_power)', 'avg_power_hourly')},
  {r('avg(voltage)', 'avg_voltage_hourly')},
  {r('avg(global_intensity)', 'avg_intensity_hourly')},
  {r('sum(sub_metering_1 + sub_metering_2 + sub_metering_3)', 'total_sub_hourly')}
FROM clean GROUP BY year, month, day, hour"""

SQL["daily_features"] = f"""{BASE}
SELECT year, month, day,
  {r('avg(global_active_power)', 'avg_power_daily')},
  {r('stddev_samp(voltage)', 'voltage_stability_daily')},
  {r('sum(sub_metering_1 + sub_metering_2 + sub_metering_3)', 'total_submetering_daily')},
  {r('avg(global_intensity)', 'avg_intensity_daily')}
FROM clean GROUP BY year, month, day"""


STORED_COLUMNS = f"datetime, {rounded_measures()}, zone, year, month, day, hour"

SQL["stream_ingest"] = f"""{BASE}
SELECT {STORED_COLUMNS} FROM clean"""

SQL["stream_zone"] = SQL["parse_json_zone"]

SQL["stream_ingest_by_meter"] = f"""{BASE}
SELECT {STORED_COLUMNS}, meter_id FROM clean"""

SQL["stream_hourly"] = f"""{BASE},
h AS (
  SELECT date_trunc('hour', datetime) AS window_start,
    avg(global_active_power) AS a, max(global_active_power) AS mx,
    sum(global_active_power) AS s, count(*) AS n
  FROM clean GROUP BY 1
)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end,
  {r('a', 'avg_active_power')}, {r('mx', 'max_active_power')},
  {r('s', 'sum_active_power')}, n AS record_count
FROM h
WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(datetime) FROM clean) - INTERVAL 1 HOUR"""

SQL["catalog_count"] = SQL["record_count"]
SQL["catalog_hour_profile"] = SQL["hour_profile"]
SQL["sql_passthrough"] = SQL["statistics"]


# --- insights -------------------------------------------------------------------

_MISSING = ", ".join(
    f"CAST(count_if({m} IS NULL OR isnan({m})) AS BIGINT) AS missing_{m}" for m in MEASURES
)

SQL["quality"] = f"""{BASE}
SELECT count(*) AS total_records,
  CAST(count_if(datetime IS NULL) AS BIGINT) AS missing_datetime,
  {_MISSING},
  CAST(count_if(global_active_power < 0) AS BIGINT) AS negative_active_power,
  CAST(count_if(global_reactive_power < 0) AS BIGINT) AS negative_reactive_power,
  CAST(count_if(global_active_power = 0) AS BIGINT) AS zero_active_power
FROM readings"""

SQL["timeseries_hours"] = f"""{BASE}
SELECT datetime,
  {r('avg(global_active_power)', 'avg_active_power')},
  {r('avg(voltage)', 'avg_voltage')},
  {r('avg(global_intensity)', 'avg_intensity')},
  {r('avg(sub_metering_1)', 'sub_metering_1')},
  {r('avg(sub_metering_2)', 'sub_metering_2')},
  {r('avg(sub_metering_3)', 'sub_metering_3')}
FROM clean
WHERE datetime > (SELECT max(datetime) FROM clean) - INTERVAL 24 HOUR
  AND datetime <= (SELECT max(datetime) FROM clean)
GROUP BY datetime ORDER BY datetime"""

SQL["weekday_profile"] = f"""{BASE}
SELECT {WEEKDAY} AS weekday, CAST(hour(datetime) AS INTEGER) AS hour,
  {r('avg(global_active_power)', 'avg_active_power')}, count(*) AS record_count,
  CASE WHEN {WEEKDAY} IN (1, 7) THEN 1 ELSE 0 END AS is_weekend
FROM clean GROUP BY 1, 2"""

SQL["weekend_profile"] = f"""{BASE}
SELECT CASE WHEN {WEEKDAY} IN (1, 7) THEN 1 ELSE 0 END AS is_weekend,
  CAST(hour(datetime) AS INTEGER) AS hour,
  {r('avg(global_active_power)', 'avg_active_power')}, count(*) AS record_count
FROM clean GROUP BY 1, 2"""

_PIVOT = ", ".join(
    r(f"avg(global_active_power) FILTER (WHERE {WEEKDAY} = {d})", f"day_{d}") for d in range(1, 8)
)

SQL["weekday_pivot"] = f"""{BASE}
SELECT CAST(hour(datetime) AS INTEGER) AS hour, {_PIVOT}
FROM clean GROUP BY 1"""

HOURLY = """hourly AS (
  SELECT date_trunc('hour', datetime) AS hour_start, avg(global_active_power) AS load
  FROM clean GROUP BY 1
)"""

SQL["peaks"] = f"""{BASE}, {HOURLY},
stats AS (
  SELECT CAST(hour(hour_start) AS INTEGER) AS hour, avg(load) AS m, stddev_samp(load) AS s
  FROM hourly GROUP BY 1
)
SELECT h.hour_start, stats.hour, {r('h.load', 'avg_active_power')},
  {r('stats.m', 'profile_mean')}, {r('stats.s', 'profile_std')},
  {r('stats.m + 2.0 * stats.s', 'threshold')}
FROM hourly h JOIN stats ON CAST(hour(h.hour_start) AS INTEGER) = stats.hour
WHERE h.load > stats.m + 2.0 * stats.s"""

SQL["day_compare"] = f"""{BASE},
daily AS (SELECT CAST(datetime AS DATE) AS day, avg(global_active_power) AS a FROM clean GROUP BY 1)
SELECT c.day, {r('c.a', 'avg_active_power')}, {r('p.a', 'prev_avg_active_power')},
  {r('(c.a - p.a) / NULLIF(p.a, 0)', 'relative_change')}
FROM daily c JOIN daily p ON p.day = CAST(c.day - INTERVAL 7 DAY AS DATE)"""

SQL["forecast_profile"] = f"""{BASE},
profile AS (
  SELECT {WEEKDAY} AS weekday, CAST(hour(datetime) AS INTEGER) AS hour,
    avg(global_active_power) AS f
  FROM clean GROUP BY 1, 2
),
future AS (
  SELECT date_trunc('hour', (SELECT max(datetime) FROM clean)) + INTERVAL (i) HOUR AS hour_start
  FROM range(1, 25) t(i)
)
SELECT future.hour_start,
  CAST(dayofweek(future.hour_start) + 1 AS INTEGER) AS weekday,
  CAST(hour(future.hour_start) AS INTEGER) AS hour,
  {r('profile.f', 'forecast_active_power')}
FROM future LEFT JOIN profile
  ON profile.weekday = CAST(dayofweek(future.hour_start) + 1 AS INTEGER)
 AND profile.hour = CAST(hour(future.hour_start) AS INTEGER)"""

PRICES = """
prices AS (
  SELECT ts, value AS price, user_id AS meter_id FROM events WHERE event_type = 'purchase' AND value IS NOT NULL),
hourly_prices AS (SELECT date_trunc('hour', ts) AS h, avg(price) AS price FROM prices GROUP BY 1)"""

SQL["weather_impact"] = f"""{BASE}, {HOURLY}, {PRICES}
SELECT count(*) AS hours, count(price) AS hours_with_price, {r('corr(price, load)', 'corr_price_load')}
FROM hourly LEFT JOIN hourly_prices ON h = hourly.hour_start"""


def _asof(seconds: int, key: str = "") -> str:
    """The last price at or before each reading; of equal times the greatest."""
    own, on = (f"{key}, ", f"c.{key} = s.{key} AND ") if key else ("", "")
    near = f"epoch_us(c.datetime) - epoch_us(s.ts) <= {seconds * 1_000_000}"
    return f"""{BASE}, {PRICES},
s AS (SELECT {own}ts, max(price) AS price FROM prices GROUP BY ALL)
SELECT {f"c.{key}, " if key else ""}event_id, datetime, {r("global_active_power", "global_active_power")},
  CASE WHEN {near} THEN {rd("s.price")} END AS price,
  CASE WHEN {near} THEN {rd("(epoch_us(c.datetime) - epoch_us(s.ts)) / 1e6")} END AS age_seconds
FROM clean c ASOF LEFT JOIN s ON {on}c.datetime >= s.ts"""


SQL["asof_price"] = _asof(3600)


# --- dashboard presentation -------------------------------------------------------

SQL["chart_series"] = f"""{BASE}
SELECT CAST(hour AS VARCHAR) || ':00' AS label, hour,
  {r("coalesce(CASE WHEN isnan(avg(global_active_power)) THEN 0.0 ELSE avg(global_active_power) END, 0.0)", "value")}
FROM clean WHERE hour IS NOT NULL GROUP BY hour"""

SQL["statistic_cards"] = f"""{BASE}
SELECT count(*) AS total_records,
  round(avg(global_active_power), 2) AS avg_active_power,
  round(avg(voltage), 1) AS avg_voltage,
  round(avg(global_intensity), 2) AS avg_intensity
FROM clean"""

_TABLE_DIGITS = dict(zip(MEASURES, (3, 3, 2, 2, 1, 1, 1)))

SQL["latest_table"] = f"""{BASE}
SELECT strftime(datetime, '%Y-%m-%d %H:%M:%S') AS datetime,
  {", ".join(f"round({m}, {d}) + CAST(0 AS DOUBLE) AS {m}" for m, d in _TABLE_DIGITS.items())}
FROM clean ORDER BY clean.datetime DESC, event_id DESC LIMIT 100"""


# --- per meter ----------------------------------------------------------------------

SQL["statistics_by_meter"] = f"""{BASE}
SELECT meter_id, count(*) AS total_records,
  {r('avg(global_active_power)', 'avg_active_power')},
  {r('max(global_active_power)', 'max_active_power')},
  {r('min(global_active_power)', 'min_active_power')},
  {r('avg(voltage)', 'avg_voltage')},
  {r('avg(global_intensity)', 'avg_intensity')},
  {r('sum(sub_metering_1 + sub_metering_2 + sub_metering_3)', 'total_sub_metering')}
FROM clean GROUP BY meter_id"""

SQL["hour_profile_by_meter"] = f"""{BASE}
SELECT meter_id, hour, {r('avg(global_active_power)', 'avg_active_power')},
  {r('avg(voltage)', 'avg_voltage')}, count(*) AS record_count
FROM clean WHERE hour IS NOT NULL GROUP BY meter_id, hour"""

SQL["latest_by_meter"] = f"""{BASE}
SELECT meter_id, datetime, {rounded_measures()} FROM (
  SELECT *, row_number() OVER (PARTITION BY meter_id ORDER BY datetime DESC, event_id DESC) AS rn FROM clean
) WHERE rn <= 5"""

SQL["timeseries_by_meter"] = f"""{BASE},
g AS (
  SELECT meter_id, datetime,
    avg(global_active_power) AS a, avg(voltage) AS v, avg(global_intensity) AS i,
    avg(sub_metering_1) AS s1, avg(sub_metering_2) AS s2, avg(sub_metering_3) AS s3
  FROM clean WHERE datetime IS NOT NULL GROUP BY meter_id, datetime
)
SELECT meter_id, datetime, {r('a', 'avg_active_power')}, {r('v', 'avg_voltage')},
  {r('i', 'avg_intensity')}, {r('s1', 'sub_metering_1')}, {r('s2', 'sub_metering_2')},
  {r('s3', 'sub_metering_3')}
FROM (SELECT *, row_number() OVER (PARTITION BY meter_id ORDER BY datetime DESC) AS rn FROM g)
WHERE rn <= 10"""

SQL["daily_features_by_meter"] = f"""{BASE}
SELECT meter_id, year, month, day,
  {r('avg(global_active_power)', 'avg_power_daily')},
  {r('stddev_samp(voltage)', 'voltage_stability_daily')},
  {r('sum(sub_metering_1 + sub_metering_2 + sub_metering_3)', 'total_submetering_daily')},
  {r('avg(global_intensity)', 'avg_intensity_daily')}
FROM clean GROUP BY meter_id, year, month, day"""

SQL["peaks_by_meter"] = f"""{BASE},
hourly AS (
  SELECT meter_id, date_trunc('hour', datetime) AS hour_start, avg(global_active_power) AS load
  FROM clean GROUP BY 1, 2
),
stats AS (
  SELECT meter_id, CAST(hour(hour_start) AS INTEGER) AS hour, avg(load) AS m, stddev_samp(load) AS s
  FROM hourly GROUP BY 1, 2
)
SELECT h.meter_id, h.hour_start, stats.hour, {r('h.load', 'avg_active_power')},
  {r('stats.m', 'profile_mean')}, {r('stats.s', 'profile_std')},
  {r('stats.m + 1.0 * stats.s', 'threshold')}
FROM hourly h JOIN stats
  ON h.meter_id = stats.meter_id AND CAST(hour(h.hour_start) AS INTEGER) = stats.hour
WHERE h.load > stats.m + 1.0 * stats.s"""

SQL["day_compare_by_meter"] = f"""{BASE},
daily AS (
  SELECT meter_id, CAST(datetime AS DATE) AS day, avg(global_active_power) AS a
  FROM clean GROUP BY 1, 2
)
SELECT c.meter_id, c.day, {r('c.a', 'avg_active_power')}, {r('p.a', 'prev_avg_active_power')},
  {r('(c.a - p.a) / NULLIF(p.a, 0)', 'relative_change')}
FROM daily c JOIN daily p
  ON p.meter_id = c.meter_id AND p.day = CAST(c.day - INTERVAL 7 DAY AS DATE)"""

SQL["forecast_by_meter"] = f"""{BASE},
profile AS (
  SELECT meter_id, {WEEKDAY} AS weekday, CAST(hour(datetime) AS INTEGER) AS hour,
    avg(global_active_power) AS f
  FROM clean GROUP BY 1, 2, 3
),
last AS (SELECT meter_id, date_trunc('hour', max(datetime)) AS l FROM clean GROUP BY 1),
future AS (
  SELECT meter_id, l + INTERVAL (i) HOUR AS hour_start FROM last, range(1, 25) t(i)
)
SELECT future.meter_id, future.hour_start,
  CAST(dayofweek(future.hour_start) + 1 AS INTEGER) AS weekday,
  CAST(hour(future.hour_start) AS INTEGER) AS hour,
  {r('profile.f', 'forecast_active_power')}
FROM future LEFT JOIN profile
  ON profile.meter_id = future.meter_id
 AND profile.weekday = CAST(dayofweek(future.hour_start) + 1 AS INTEGER)
 AND profile.hour = CAST(hour(future.hour_start) AS INTEGER)"""


_BY_MEASURES = ", ".join(f"{m} DESC" for m in MEASURES)

SQL["catalog_latest"] = f"""{BASE}
SELECT datetime, {rounded_measures()} FROM clean
ORDER BY datetime DESC, {_BY_MEASURES} LIMIT 100"""

SQL["catalog_timeseries"] = SQL["timeseries"]
SQL["catalog_last_hours"] = SQL["timeseries_hours"]
SQL["catalog_month_counts"] = SQL["month_counts"]


# --- from the hourly rollup: the same answers as the direct queries ---------------

SQL["rollup_statistics"] = SQL["statistics"]
SQL["rollup_hour_profile"] = SQL["hour_profile"]
SQL["rollup_month_counts"] = SQL["month_counts"]
SQL["rollup_submeter_share"] = SQL["submeter_share"]
SQL["rollup_weekday_profile"] = SQL["weekday_profile"]
SQL["rollup_daily_features"] = SQL["daily_features"]
SQL["stream_rollup"] = SQL["daily_features"]
SQL["catalog_zone_counts"] = SQL["zone_counts"]
SQL["sql_over_files"] = SQL["statistics"]

SQL["csv_export"] = SQL["hour_profile"]
SQL["compacted_month_counts"] = SQL["month_counts"]
SQL["stream_landing"] = SQL["stream_ingest"]
SQL["snapshot_landing"] = SQL["stream_ingest"]
SQL["snapshot_rollup"] = SQL["daily_features"]
SQL["compacted_readings"] = f"""{BASE}
SELECT datetime, {rounded_measures()}, zone, year, month FROM clean"""
SQL["catalog_between"] = f"""{BASE}
SELECT {STORED_COLUMNS} FROM clean
WHERE datetime > TIMESTAMP '2024-01-09 22:30:00' AND datetime <= TIMESTAMP '2024-01-11 03:15:00'"""

SQL["stream_dedup"] = f"""{BASE}
SELECT event_id AS message_id, meter_id, datetime, {rounded_measures()}
FROM readings WHERE datetime IS NOT NULL"""


_LACKS = ", ".join(
    ["CASE WHEN datetime IS NULL THEN 'missing_datetime' END"]
    + [f"CASE WHEN {m} IS NULL OR isnan({m}) THEN 'missing_{m}' END" for m in MEASURES]
)
_REJECTED = f"""rejected AS (
  SELECT *, concat_ws(',', {_LACKS}) AS reasons FROM readings WHERE NOT ({_NOT_MISSING})
)"""

SQL["stream_screened"] = f"""{BASE}, {_REJECTED}
SELECT event_id, datetime, {rounded_measures()}, '' AS reasons, zone, 'stored' AS outcome, year, month, day, hour FROM clean
UNION ALL
SELECT event_id, datetime, {rounded_measures()}, reasons, NULL, 'rejected',
  CAST(year(datetime) AS INTEGER), CAST(month(datetime) AS INTEGER), CAST(day(datetime) AS INTEGER), CAST(hour(datetime) AS INTEGER)
FROM rejected"""

SQL["stream_reject_counts"] = f"""{BASE}, {_REJECTED}
SELECT reason, count(*) AS rejected
FROM (SELECT unnest(string_split(reasons, ',')) AS reason FROM rejected) GROUP BY reason"""

SQL["stream_late_rows"] = f"""{BASE}
SELECT event_id, datetime, {rounded_measures()},
  coalesce(event_id % 2 <> 0
    AND datetime <= (SELECT max(datetime) FROM readings WHERE event_id % 2 = 0) - INTERVAL 1 DAY, false) AS late
FROM readings"""

SQL["stream_live_hours"] = f"""{BASE},
h AS (
  SELECT date_trunc('hour', datetime) AS window_start,
    avg(global_active_power) AS a, max(global_active_power) AS mx, sum(global_active_power) AS s, count(*) AS n
  FROM clean GROUP BY 1
)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end,
  {r('a', 'avg_active_power')}, {r('mx', 'max_active_power')}, {r('s', 'sum_active_power')}, n AS record_count
FROM h"""

SQL["stream_alerts"] = f"""{BASE},
loads AS (
  SELECT event_id % 3 AS b, date_trunc('hour', datetime) AS hour_start, avg(global_active_power) AS load
  FROM clean GROUP BY 1, 2
),
base AS (
  SELECT now.b, hour(l.hour_start) AS hour, count(*) AS n, avg(l.load) AS m, stddev_samp(l.load) AS s
  FROM (VALUES (1), (2)) now(b) JOIN loads l ON l.b < now.b GROUP BY 1, 2
)
SELECT l.hour_start, CAST(base.hour AS INTEGER) AS hour, {r('l.load', 'load')}, base.n AS baseline_n,
  {r('base.m', 'baseline_mean')}, {r('base.s', 'baseline_std')}, {r('base.m + 1.5 * base.s', 'threshold')},
  CAST(l.b AS BIGINT) AS batch
FROM loads l JOIN base ON base.b = l.b AND base.hour = hour(l.hour_start)
WHERE base.n >= 2 AND l.load > base.m + 1.5 * base.s"""

SQL["publish_twice"] = SQL["parse_raw"]

SQL["quality_by_meter"] = f"""{BASE}
SELECT meter_id, count(*) AS total_records,
  CAST(count_if(datetime IS NULL) AS BIGINT) AS missing_datetime,
  {_MISSING},
  CAST(count_if(global_active_power < 0) AS BIGINT) AS negative_active_power,
  CAST(count_if(global_reactive_power < 0) AS BIGINT) AS negative_reactive_power,
  CAST(count_if(global_active_power = 0) AS BIGINT) AS zero_active_power
FROM readings GROUP BY meter_id"""

SQL["zone_counts_by_meter"] = f"""{BASE}
SELECT meter_id, zone, count(*) AS record_count FROM clean GROUP BY meter_id, zone"""

SQL["submeter_share_by_meter"] = f"""{BASE},
t AS (SELECT meter_id, sum(sub_metering_1) AS s1, sum(sub_metering_2) AS s2, sum(sub_metering_3) AS s3
      FROM clean GROUP BY meter_id),
g AS (SELECT *, coalesce(s1, 0) + coalesce(s2, 0) + coalesce(s3, 0) AS grand FROM t)
SELECT meter_id, 'sub_metering_1' AS submeter, 'zone1' AS zone, {r('s1', 'total_wh')}, {r('s1 / NULLIF(grand, 0)', 'share')} FROM g
UNION ALL
SELECT meter_id, 'sub_metering_2', 'zone2', {r('s2', 'total_wh')}, {r('s2 / NULLIF(grand, 0)', 'share')} FROM g
UNION ALL
SELECT meter_id, 'sub_metering_3', 'zone3', {r('s3', 'total_wh')}, {r('s3 / NULLIF(grand, 0)', 'share')} FROM g"""

SQL["weather_impact_by_meter"] = f"""{BASE},
hourly AS (
  SELECT meter_id, date_trunc('hour', datetime) AS hour_start, avg(global_active_power) AS load
  FROM clean GROUP BY 1, 2
), {PRICES}
SELECT meter_id, count(*) AS hours, count(price) AS hours_with_price, {r('corr(price, load)', 'corr_price_load')}
FROM hourly LEFT JOIN hourly_prices ON h = hourly.hour_start
GROUP BY meter_id"""

SQL["asof_price_by_meter"] = _asof(2 * 86400, "meter_id")


# --- regression forecast: normal equations in SQL ----------------------------------


def _det(m: list[list[str]]) -> str:
    """Determinant of a matrix of expressions, expanded along its first row."""
    if len(m) == 1:
        return m[0][0]
    terms = [f"({m[0][j]}) * ({_det([row[:j] + row[j + 1:] for row in m[1:]])})" for j in range(len(m))]
    return " ".join(("-" if j % 2 else "+") + t for j, t in enumerate(terms))


def _forecast(features: list[str], lags: bool, by: str = "") -> str:
    """Cramer's rule on the centred moments; with two features, one that does
    not vary (or only with the first) has the coefficient 0."""
    k, key = len(features), f"{by}, " if by else ""
    on = f"USING ({by})" if by else "ON TRUE"
    group = f"GROUP BY {by}" if by else ""
    joins = ""
    if lags:
        joins = """JOIN hourly p ON p.hour_start = h.hour_start - INTERVAL 1 HOUR
  JOIN hourly q ON q.hour_start = h.hour_start - INTERVAL 24 HOURS"""
    cov = lambda a, b: f"covar_pop({a}, {b})"
    mat = [[f"c{min(i, j)}{max(i, j)}" for j in range(k)] for i in range(k)]
    if k == 2:
        d = "(c11 - c01 * c01 / c00)"
        second = f"CASE WHEN c00 > 0 THEN (CASE WHEN {d} > 1e-9 * c11 THEN (y1 - c01 * y0 / c00) / {d} ELSE 0 END) WHEN c11 > 0 THEN y1 / c11 ELSE 0 END"
        coefs = [f"CASE WHEN c00 > 0 THEN (y0 - c01 * ({second})) / c00 ELSE 0 END", second]
    else:
        whole = _det(mat)
        coefs = [f"({_det([[f'y{i}' if j == p else mat[i][j] for j in range(k)] for i in range(k)])}) / ({whole})" for p in range(k)]
    return f"""{BASE},
hourly AS (
  SELECT {key}date_trunc('hour', datetime) AS hour_start, avg(global_active_power) AS load
  FROM clean GROUP BY ALL),
feats AS (
  SELECT h.*, {"p.load AS lag_1h, q.load AS lag_24h, " if lags else ""}CAST(hour(h.hour_start) AS DOUBLE) AS hour,
    CASE WHEN dayofweek(h.hour_start) IN (0, 6) THEN 1e0 ELSE 0e0 END AS is_weekend
  FROM hourly h {joins}
  WHERE h.load IS NOT NULL),
bound AS (SELECT max(hour_start) - INTERVAL 7 DAYS AS cutoff FROM feats),
train AS (SELECT feats.* FROM feats, bound WHERE hour_start <= cutoff),
test AS (SELECT feats.* FROM feats, bound WHERE hour_start > cutoff),
m AS (
  SELECT {key}avg(load) AS mean_y, {", ".join(f"avg({f}) AS mean_{i}" for i, f in enumerate(features))},
    {", ".join(f"{cov(features[i], features[j])} AS c{i}{j}" for i in range(k) for j in range(i, k))},
    {", ".join(f"{cov(f, 'load')} AS y{i}" for i, f in enumerate(features))}
  FROM train {group}),
fit AS (SELECT *, {", ".join(f"{c} AS b{i}" for i, c in enumerate(coefs))} FROM m),
linear AS (
  SELECT {key}'linear_regression' AS model,
    {r("avg(abs(mean_y + " + " + ".join(f"b{i} * ({f} - mean_{i})" for i, f in enumerate(features)) + " - load))", "mae")},
    count(*) AS test_hours
  FROM test LEFT JOIN fit {on} {group}),
profile AS (
  SELECT {key}dayofweek(hour_start) AS wd, hour(hour_start) AS hr, avg(load) AS profile FROM train GROUP BY ALL),
seasonal AS (
  SELECT {key}'seasonal_profile' AS model, {r("avg(abs(profile - load))", "mae")}, count(*) AS test_hours
  FROM (SELECT *, dayofweek(hour_start) AS wd, hour(hour_start) AS hr FROM test)
    LEFT JOIN profile USING ({key}wd, hr) {group})
SELECT * FROM linear UNION ALL SELECT * FROM seasonal"""


SQL["ml_forecast"] = _forecast(["lag_1h", "lag_24h", "hour", "is_weekend"], lags=True)
SQL["ml_forecast_daily"] = SQL["ml_forecast"]
SQL["ml_forecast_by_meter"] = _forecast(["hour", "is_weekend"], lags=False, by="meter_id")
