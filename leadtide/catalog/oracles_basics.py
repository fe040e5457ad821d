"""Oracle SQL of the queries in ``basics``, and the common table expressions all oracles share."""

from __future__ import annotations

H = 7
TARGETS = [f"target_t{h}" for h in range(1, H + 1)]
KEY = "series_id, datetime"

OBS_HOURLY = """
obs_hourly AS (
  SELECT event_type AS series_id, date_trunc('hour', ts) AS datetime,
    avg(value) AS temp, max(value) AS tempmax, min(value) AS tempmin,
    avg(value) - 1e-1 * count(*) AS dew,
    CAST(count(DISTINCT user_id) AS DOUBLE) AS humidity,
    1e3 + avg(CAST(event_id % 50 AS DOUBLE)) AS sealevelpressure,
    1e2 * avg(CASE WHEN value > 50 THEN 1e0 ELSE 0e0 END) AS cloudcover,
    sum(value) AS solarradiation, 864e-4 * sum(value) AS solarenergy,
    CAST(max(user_id % 17) AS DOUBLE) AS visibility,
    CASE WHEN count(*) > 1 THEN stddev_samp(value) END AS windspeed,
    max(value) - min(value) AS windgust,
    coalesce(sum(CASE WHEN value > 150 THEN value END), 0e0) AS precip,
    CASE WHEN count(*) % 5 = 0 THEN 'n/a'
      ELSE concat(CAST(CAST(min(ts) AS DATE) AS VARCHAR), ' 05:30:00') END AS sunrise,
    concat(CAST(CAST(min(ts) AS DATE) AS VARCHAR), ' 18:', lpad(CAST(day(min(ts)) AS VARCHAR), 2, '0'), ':00') AS sunset
  FROM events GROUP BY event_type, date_trunc('hour', ts))"""

OBS_DAILY = """
obs_daily AS (
  SELECT 'all' AS series_id, CAST(l_shipdate AS TIMESTAMP) AS datetime,
    avg(l_quantity) AS temp, max(l_quantity) AS tempmax, min(l_quantity) AS tempmin,
    avg(l_quantity) - 1e2 * avg(l_tax) AS dew, 1e3 * avg(l_discount) AS humidity,
    1e3 + avg(CAST(l_partkey % 50 AS DOUBLE)) AS sealevelpressure,
    1e2 * avg(CASE WHEN l_returnflag = 'A' THEN 1e0 ELSE 0e0 END) AS cloudcover,
    avg(l_extendedprice) AS solarradiation, 864e-4 * avg(l_extendedprice) AS solarenergy,
    CAST(max(l_suppkey % 17) AS DOUBLE) AS visibility,
    CASE WHEN count(*) > 20 THEN stddev_samp(l_quantity) END AS windspeed,
    max(l_quantity) - min(l_quantity) AS windgust,
    coalesce(sum(CASE WHEN l_quantity > 49 AND l_returnflag = 'R' THEN l_tax END), 0e0) AS precip,
    CASE WHEN count(*) % 5 = 0 THEN 'n/a'
      ELSE concat(CAST(CAST(min(l_shipdate) AS DATE) AS VARCHAR), ' 05:30:00') END AS sunrise,
    concat(CAST(CAST(min(l_shipdate) AS DATE) AS VARCHAR), ' 18:', lpad(CAST(day(min(l_shipdate)) AS VARCHAR), 2, '0'), ':00') AS sunset
  FROM lineitem GROUP BY CAST(l_shipdate AS TIMESTAMP))"""

MEASURES = ["temp", "tempmax", "tempmin", "dew", "humidity", "sealevelpressure", "cloudcover", "solarradiation",
            "solarenergy", "visibility", "windspeed", "windgust", "precip"]
MODEL_MEASURES = ["humidity", "sealevelpressure", "dew", "cloudcover", "solarradiation", "visibility", "windspeed",
                  "windgust", "precip"]


def r(expr: str, name: str = "", digits: int = 6) -> str:
    return f"round(({expr}) + 1.7e-8, {digits}) AS {name or expr}"


def rs(names: list[str], digits: int = 6) -> str:
    return ", ".join(r(n, n, digits) for n in names)


def leads(table: str, horizons=range(1, H + 1)) -> str:
    cols = ", ".join(f"lead(temp, {h}) OVER w AS target_t{h}" for h in horizons)
    return f"SELECT *, {cols} FROM {table} WINDOW w AS (PARTITION BY series_id ORDER BY datetime)"


def split_cte(table: str, name: str) -> str:
    return f"""
{name}_t AS ({leads(table)}),
{name}_i AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY datetime) - 1 AS _i,
  count(*) OVER (PARTITION BY series_id) AS _n FROM {name}_t),
{name} AS (SELECT * EXCLUDE (_i, _n), CASE
  WHEN _i < CAST(floor(_n * CAST(0.7 AS DOUBLE)) AS BIGINT) THEN 'train'
  WHEN _i < CAST(floor(_n * CAST(0.7 AS DOUBLE)) AS BIGINT) + CAST(floor(_n * CAST(0.15 AS DOUBLE)) AS BIGINT) THEN 'val'
  ELSE 'test' END AS split FROM {name}_i)"""


SPLIT_HOURLY = OBS_HOURLY + "," + split_cte("obs_hourly", "split_hourly")
SPLIT_DAILY = OBS_DAILY + "," + split_cte("obs_daily", "split_daily")

DAYLIGHT = "date_diff('microsecond', TRY_CAST(sunrise AS TIMESTAMP), TRY_CAST(sunset AS TIMESTAMP)) / 3.6e9"
ROW_FEATURES = f"""{DAYLIGHT} AS daylight_hours, solarenergy / ({DAYLIGHT} + 1e-6) AS solar_per_hour,
  tempmax - tempmin AS temp_range, temp - dew AS dewpoint_depression"""
YEAR_CYCLE = """sin(2 * pi() * month(datetime) / 12) AS month_sin, cos(2 * pi() * month(datetime) / 12) AS month_cos,
  sin(2 * pi() * dayofyear(datetime) / 365) AS day_sin, cos(2 * pi() * dayofyear(datetime) / 365) AS day_cos"""
HOUR_CYCLE = "sin(2 * pi() * hour(datetime) / 24) AS hour_sin, cos(2 * pi() * hour(datetime) / 24) AS hour_cos"
WINDOW_DAILY = "coalesce(sealevelpressure - lag(sealevelpressure) OVER w, 0) AS sealevelpressure_change"
WINDOW_HOURLY = WINDOW_DAILY + """, coalesce(lag(temp, 24) OVER w, 0) AS temp_lag_24h,
  coalesce(lag(humidity, 24) OVER w, 0) AS humidity_lag_24h,
  coalesce(avg(temp) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING), 0) AS temp_rolling_avg_24h,
  coalesce(sum(precip) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING), 0) AS precip_rolling_sum_24h"""
DAILY_COLUMNS = MODEL_MEASURES + ["month_sin", "month_cos", "day_sin", "day_cos", "daylight_hours", "solar_per_hour",
                                  "temp_range", "dewpoint_depression", "sealevelpressure_change"]
HOURLY_COLUMNS = (MODEL_MEASURES + ["month_sin", "month_cos", "day_sin", "day_cos", "hour_sin", "hour_cos",
                                    "daylight_hours", "solar_per_hour", "temp_range", "dewpoint_depression",
                                    "sealevelpressure_change", "temp_lag_24h", "humidity_lag_24h",
                                    "temp_rolling_avg_24h", "precip_rolling_sum_24h"])


def filled(column: str, part: str) -> str:
    run = f"PARTITION BY {part} ORDER BY datetime ROWS BETWEEN"
    return (f"coalesce(last_value({column} IGNORE NULLS) OVER ({run} UNBOUNDED PRECEDING AND CURRENT ROW), "
            f"first_value({column} IGNORE NULLS) OVER ({run} CURRENT ROW AND UNBOUNDED FOLLOWING), 0e0) AS {column}")


def features_cte(source: str, name: str, variant: str, part: str) -> str:
    """Features of ``source``; windows restart at each new value of ``part``."""
    cols = HOURLY_COLUMNS if variant == "hourly" else DAILY_COLUMNS
    cycles = YEAR_CYCLE + (", " + HOUR_CYCLE if variant == "hourly" else "")
    windows = WINDOW_HOURLY if variant == "hourly" else WINDOW_DAILY
    fills = ", ".join(filled(c, part) for c in cols)
    return f"""
{name}_raw AS (SELECT *, {cycles}, {ROW_FEATURES}, {windows} FROM {source}
  WINDOW w AS (PARTITION BY {part} ORDER BY datetime)),
{name} AS (SELECT * EXCLUDE ({', '.join(cols)}), {fills} FROM {name}_raw)"""


def part_of(source: str, name: str) -> str:
    return f"{name} AS (SELECT *, CASE WHEN split = 'test' THEN 'test' ELSE 'fit' END AS part FROM {source})"


FEATURES_HOURLY = (SPLIT_HOURLY + ", " + part_of("split_hourly", "parted") + ","
                   + features_cte("parted", "features", "hourly", "series_id, part"))
FEATURES_DAILY = (SPLIT_DAILY + ", " + part_of("split_daily", "parted") + ","
                  + features_cte("parted", "features", "daily", "series_id, part"))


def _features_query(cte: str, columns: list[str]) -> str:
    return f"WITH {cte} SELECT {KEY}, part, split, {rs(['temp', *TARGETS, *columns])} FROM features"


FOLDED = SPLIT_HOURLY + """,
kept AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY datetime) - 1 AS idx,
  count(*) OVER (PARTITION BY series_id) // 6 AS sz, count(*) OVER (PARTITION BY series_id) AS n
  FROM split_hourly WHERE split <> 'test' AND target_t1 IS NOT NULL),
folded AS (SELECT * FROM (
  SELECT k.* EXCLUDE (sz, n), f.fold, CASE WHEN idx < f.fold * sz THEN 'train'
    WHEN idx >= f.fold * sz + 7 AND idx < f.fold * sz + 7 + sz THEN 'val' END AS role
  FROM kept k, (VALUES (1), (2), (3), (4), (5)) f(fold)
  WHERE f.fold * sz + 7 + sz <= n) WHERE role IS NOT NULL)"""

NAIVE = SPLIT_HOURLY + f""",
naive_w AS (SELECT *, coalesce(avg(temp) OVER (PARTITION BY series_id ORDER BY datetime ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING), 0) AS m24 FROM split_hourly),
naive_h AS (SELECT series_id, datetime, split, temp, m24, h AS horizon,
  CASE {' '.join(f'WHEN h = {h} THEN target_t{h}' for h in range(1, H + 1))} END AS y
  FROM naive_w, (VALUES {', '.join(f'({h})' for h in range(1, H + 1))}) t(h)),
naive AS (
  SELECT 'last_value' AS model, series_id, datetime, split, horizon, y, temp AS pred FROM naive_h
  UNION ALL SELECT 'lag_mean_24', series_id, datetime, split, horizon, y, m24 FROM naive_h
  UNION ALL SELECT 'half_way', series_id, datetime, split, horizon, y, 5e-1 * temp + 5e-1 * m24 FROM naive_h),
metrics AS (SELECT model, CASE WHEN split = 'test' THEN 'Test' ELSE 'Train' END AS metric_type, horizon,
  count(*) AS n_rows, sqrt(avg((y - pred) * (y - pred))) AS rmse, avg(abs(y - pred)) AS mae,
  1 - sum((y - pred) * (y - pred)) / (count(*) * var_pop(y)) AS r2,
  avg(abs(y - pred) / greatest(abs(y), 2.220446049250313e-16)) AS mape
  FROM naive WHERE y IS NOT NULL GROUP BY ALL)"""

LAST_FORECASTS = SPLIT_HOURLY + f""",
wide AS (SELECT *, coalesce(avg(temp) OVER (PARTITION BY series_id ORDER BY datetime ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING), 0) AS m24 FROM split_hourly),
last AS (SELECT * FROM wide QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY datetime DESC) = 1),
forecasts AS (SELECT series_id, datetime, temp AS last_value, h AS horizon,
  (1 - CAST(0.1 AS DOUBLE) * h) * temp + CAST(0.1 AS DOUBLE) * h * m24 AS pred
  FROM last, (VALUES {', '.join(f'({h})' for h in range(1, H + 1))}) t(h))"""

CYCLE_W = "WINDOW w AS (PARTITION BY series_id ORDER BY datetime)"


def half_up(x: str, digits: int) -> str:
    """Rounded as a decimal, once the noise in the last digits of a double is gone."""
    return f"round(round({x}, 9)::DECIMAL(38, 9), {digits})"


def _simple(cte: str, select: str, source: str, tail: str = "") -> str:
    return f"WITH {cte} SELECT {select} FROM {source} {tail}"


def _windowed(cte: str, source: str, expr: str, name: str) -> str:
    return _simple(cte, f"{KEY}, {r(f'({expr})', name)}", source, CYCLE_W)


def _leads_query(horizons) -> str:
    names = [f"target_t{h}" for h in horizons]
    return f"WITH {OBS_HOURLY}, t AS ({leads('obs_hourly', horizons)}) SELECT {KEY}, {rs(names)} FROM t"


def _fill_query(cte: str, source: str) -> str:
    cols = ["windspeed", "daylight_hours", "solar_per_hour"]
    return (f"WITH {cte}, d AS (SELECT {KEY}, windspeed, {ROW_FEATURES} FROM {source}), "
            f"f AS (SELECT {KEY}, {', '.join(filled(c, 'series_id') for c in cols)} FROM d) SELECT {KEY}, {rs(cols)} FROM f")


_BAND = f"""WITH {OBS_DAILY}, b AS (SELECT {KEY},
  CASE WHEN count(temp) OVER f = 30 THEN avg(temp) OVER f END AS rolling_mean,
  CASE WHEN count(temp) OVER f = 30 THEN stddev_samp(temp) OVER f END AS rolling_std
  FROM obs_daily WINDOW f AS (PARTITION BY series_id ORDER BY datetime ROWS BETWEEN 15 PRECEDING AND 14 FOLLOWING))
SELECT {KEY}, {rs(['rolling_mean', 'rolling_std'])}, {r('rolling_mean + rolling_std', 'upper_bound')},
  {r('rolling_mean - rolling_std', 'lower_bound')} FROM b"""
_FOLD_ENDS = """fold_ends AS (SELECT series_id, fold, max(CASE WHEN role = 'train' THEN datetime END) AS train_end,
  min(CASE WHEN role = 'val' THEN datetime END) AS val_start FROM folded GROUP BY series_id, fold)"""
_RANGE = "min(datetime) AS first_time, max(datetime) AS last_time, count(*) AS n_rows"


def _idx(cte: str, source: str) -> str:
    return _simple(cte, f"{KEY}, row_number() OVER (PARTITION BY series_id ORDER BY datetime) - 1 AS idx, "
                        "count(*) OVER (PARTITION BY series_id) AS n_series", source)


ORACLES = {
    "a1_read_observations": _simple(OBS_HOURLY, f"{KEY}, {rs(MEASURES)}, sunrise, sunset", "obs_hourly"),
    "a1_read_daily_observations": _simple(OBS_DAILY, f"{KEY}, {rs(MEASURES)}, sunrise, sunset", "obs_daily"),
    "a2_read_split": _simple(SPLIT_DAILY, f"{KEY}, split, {rs(['temp', *TARGETS])}", "split_daily", "WHERE split <> 'test'"),
    "a3_write_splits": _simple(SPLIT_HOURLY, "series_id, split, count(*) AS n_rows", "split_hourly", "GROUP BY ALL"),
    "a8_parse_timestamps": "SELECT strftime(ts, '%Y-%m-%d') AS day, min(ts) AS first_time, max(ts) AS last_time, count(*) AS n_rows FROM events GROUP BY 1",
    "a9_parse_or_null": _simple(OBS_HOURLY, f"{KEY}, TRY_CAST(sunrise AS TIMESTAMP) AS sunrise, TRY_CAST(sunset AS TIMESTAMP) AS sunset", "obs_hourly"),
    "b1_calendar_parts": _simple(OBS_HOURLY, f"{KEY}, CAST(year(datetime) AS INTEGER) AS year, CAST(month(datetime) AS INTEGER) AS month, CAST(dayofyear(datetime) AS INTEGER) AS day_of_year, CAST(isodow(datetime) - 1 AS INTEGER) AS day_of_week, CAST(hour(datetime) AS INTEGER) AS hour", "obs_hourly"),
    "b2_cyclic_year": f"WITH {OBS_DAILY}, c AS (SELECT {KEY}, {YEAR_CYCLE} FROM obs_daily) SELECT {KEY}, {rs(['month_sin', 'month_cos', 'day_sin', 'day_cos'])} FROM c",
    "b3_cyclic_hour": f"WITH {OBS_HOURLY}, c AS (SELECT {KEY}, {HOUR_CYCLE} FROM obs_hourly) SELECT {KEY}, {rs(['hour_sin', 'hour_cos'])} FROM c",
    "b4_season": _simple(OBS_DAILY, f"{KEY}, CASE WHEN month(datetime) BETWEEN 5 AND 11 THEN 'Rainy' ELSE 'Dry' END AS season", "obs_daily"),
    **{
        f"{b}_{c}": f"WITH {OBS_DAILY}, d AS (SELECT {KEY}, {ROW_FEATURES} FROM obs_daily) SELECT {KEY}, {r(c)} FROM d"
        for b, c in (("b5", "daylight_hours"), ("b6", "solar_per_hour"), ("b7", "temp_range"), ("b8", "dewpoint_depression"))
    },
    "b9_select_features": f"WITH {OBS_DAILY}, d AS (SELECT *, {ROW_FEATURES} FROM obs_daily) SELECT {KEY}, {rs([m for m in MODEL_MEASURES if m != 'windgust'] + ['daylight_hours', 'solar_per_hour', 'temp_range', 'dewpoint_depression'])} FROM d",
    "b10_drop_helpers": _simple(OBS_HOURLY, f"{KEY}, {rs(MEASURES)}, CAST(hour(datetime) AS INTEGER) AS hour", "obs_hourly"),
    "b11_fill_zero": _simple(OBS_HOURLY, f"{KEY}, {r('coalesce(windspeed, 0)', 'windspeed')}", "obs_hourly"),
    "b12_drop_any_missing": f"WITH {OBS_HOURLY}, d AS (SELECT {KEY}, temp, windspeed, {DAYLIGHT} AS daylight_hours FROM obs_hourly) SELECT {KEY}, {rs(['temp', 'windspeed', 'daylight_hours'])} FROM d WHERE temp IS NOT NULL AND windspeed IS NOT NULL AND daylight_hours IS NOT NULL",
    "b13_drop_missing_target": f"WITH {OBS_HOURLY}, t AS ({leads('obs_hourly')}) SELECT {KEY}, {r('target_t7')} FROM t WHERE target_t7 IS NOT NULL",
    "b14_filter_test_metrics": _simple(NAIVE, f"model, metric_type, horizon, n_rows, {rs(['rmse', 'mae', 'r2', 'mape'])}", "metrics", "WHERE metric_type = 'Test'"),
    "b16_numeric_columns": _simple(OBS_HOURLY, ", ".join(f"count({c}) AS {c}" for c in MEASURES), "obs_hourly"),
    "b17_horizon_from_name": f"WITH {OBS_HOURLY}, t AS ({leads('obs_hourly', (24, 48, 168))}), u AS (" + " UNION ALL ".join(
        f"SELECT 'target_t{h}' AS target, {h} AS steps, {h} / 24e0 AS n_days, target_t{h} AS y FROM t" for h in (24, 48, 168)
    ) + f") SELECT target, steps, {r('n_days')}, count(y) AS n_known, {r('avg(y)', 'mean_y')} FROM u GROUP BY target, steps, n_days",
    "b20_forecast_date": _simple(LAST_FORECASTS, "series_id, horizon, datetime + to_days(horizon) AS day_ahead, datetime + to_hours(horizon) AS hour_ahead", "forecasts"),
    "b21_trend_sign": _simple(LAST_FORECASTS, f"series_id, horizon, {r('pred - last_value', 'delta')}, CASE WHEN pred - last_value >= 0 THEN 'up' ELSE 'down' END AS trend", "forecasts"),
    "b22_temperature_band": _simple(OBS_DAILY, f"{KEY}, {r('temp')}, CASE WHEN temp >= 35 THEN 1 WHEN temp >= 31 THEN 2 WHEN temp >= 28 THEN 3 WHEN temp >= 25 THEN 4 WHEN temp >= 22 THEN 5 ELSE 6 END AS band", "obs_daily"),
    "b23_round_tenth": _simple(OBS_DAILY, f"{KEY}, {half_up('temp', 1)}::DOUBLE AS temp_plot, {half_up('windspeed', 1)}::DOUBLE AS wind_plot", "obs_daily"),
    "b24_number_text": _simple(NAIVE, f"model, metric_type, horizon, {half_up('rmse', 4)}::VARCHAR AS rmse, {half_up('mae', 3)}::VARCHAR AS mae, {half_up('round(mape, 9) * 100', 2)}::VARCHAR || '%' AS mape", "metrics"),
    "b25_map_labels": _simple(NAIVE, "upper(model) AS model_upper, CASE model WHEN 'last_value' THEN 'Last Value' WHEN 'lag_mean_24' THEN 'Lag Mean 24' ELSE 'Half Way' END AS model_title, horizon, metric_type || ' R²' AS label", "metrics"),
    "b27_label_columns": _simple(OBS_DAILY, "CAST(year(datetime) AS INTEGER) AS year, count(*) AS n_rows, 'Linear' AS model_type, 'Train' AS metric_type", "obs_daily", "GROUP BY 1"),
    "b28_rename": _simple(NAIVE, 'model AS "Model", metric_type AS "Kind", horizon AS "Horizon", n_rows AS "N"', "metrics"),
    "b29_date_text": _simple(OBS_DAILY, f"{KEY}, strftime(datetime, '%A') AS day_name, strftime(datetime, '%d %b %Y') AS day_text, strftime(datetime, '%b %d') AS short_text", "obs_daily"),
    "a3_stored_series": _leads_query(range(1, 8)),
    "a3_stored_series_blocked": _leads_query(range(1, 8)),
    "w1_lead_targets": _leads_query(range(1, 8)),
    "w1_lead_targets_blocked": _leads_query(range(1, 8)),
    "w1_lead_targets_weekly": _leads_query((24, 48, 72, 96, 120, 144, 168)),
    "w1_lead_targets_next_day": _leads_query(range(1, 25)),
    "w2_difference": _windowed(OBS_HOURLY, "obs_hourly", "coalesce(sealevelpressure - lag(sealevelpressure) OVER w, 0)", "sealevelpressure_change"),
    "w3_lag_24": _windowed(OBS_HOURLY, "obs_hourly", "coalesce(lag(temp, 24) OVER w, 0)", "temp_lag_24h"),
    "w3_lag_24_humidity": _windowed(OBS_HOURLY, "obs_hourly", "coalesce(lag(humidity, 24) OVER w, 0)", "humidity_lag_24h"),
    "w4_trailing_mean": _windowed(OBS_HOURLY, "obs_hourly", "coalesce(avg(temp) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING), 0)", "temp_rolling_avg_24h"),
    "w4_trailing_mean_blocked": _windowed(OBS_DAILY, "obs_daily", "coalesce(avg(temp) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING), 0)", "temp_rolling_avg_24h"),
    "w5_trailing_sum": _windowed(OBS_HOURLY, "obs_hourly", "coalesce(sum(precip) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING), 0)", "precip_rolling_sum_24h"),
    "w6_forward_fill": _windowed(OBS_HOURLY, "obs_hourly", "last_value(windspeed IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)", "windspeed"),
    "w6_forward_fill_blocked": _windowed(OBS_HOURLY, "obs_hourly", "last_value(windspeed IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)", "windspeed"),
    "w7_fill_both_ways": _fill_query(OBS_HOURLY, "obs_hourly"),
    "w7_fill_both_ways_blocked": _fill_query(OBS_DAILY, "obs_daily"),
    "w8_w9_centred_band": _BAND,
    "w8_w9_centred_band_blocked": _BAND,
    "w11_row_index": _idx(OBS_HOURLY, "obs_hourly"),
    "w11_row_index_blocked": _idx(OBS_DAILY, "obs_daily"),
    "d1_split_by_time": _simple(SPLIT_HOURLY, f"{KEY}, split", "split_hourly"),
    "d1_split_daily_blocked": _simple(SPLIT_DAILY, f"{KEY}, split", "split_daily"),
    "d2_purged_folds": _simple(FOLDED, f"{KEY}, idx, fold, role", "folded"),
    "d2_purged_folds_blocked": _simple(FOLDED, f"{KEY}, idx, fold, role", "folded"),
    "d3_leakage_check": f"WITH {FOLDED}, {_FOLD_ENDS} SELECT * FROM fold_ends WHERE train_end >= val_start",
    "d4_split_ranges": _simple(SPLIT_HOURLY, f"series_id, split, {_RANGE}", "split_hourly", "GROUP BY ALL"),
    "d4_fold_ranges": _simple(FOLDED, f"series_id, fold, role, {_RANGE}", "folded", "GROUP BY ALL"),
    "d4_fold_gaps": f"WITH {FOLDED}, {_FOLD_ENDS} SELECT *, date_diff('hour', train_end, val_start) // 24 AS gap_days FROM fold_ends",
    "m1_features_hourly": _features_query(FEATURES_HOURLY, HOURLY_COLUMNS),
    "m1_features_hourly_blocked": _features_query(FEATURES_HOURLY, HOURLY_COLUMNS),
    "m1_features_daily": _features_query(FEATURES_DAILY, DAILY_COLUMNS),
    "m1_features_daily_blocked": _features_query(FEATURES_DAILY, DAILY_COLUMNS),
    "m1_features_whole_table": f"WITH {OBS_HOURLY}, t AS ({leads('obs_hourly')}), {features_cte('t', 'features', 'hourly', 'series_id')} SELECT {KEY}, {rs(['temp', *TARGETS, *HOURLY_COLUMNS])} FROM features WHERE target_t7 IS NOT NULL",
}
