"""Oracle SQL of the queries in ``reports``."""

from __future__ import annotations

from leadtide.catalog.oracles_basics import (
    FEATURES_DAILY, FOLDED, KEY, LAST_FORECASTS, MEASURES, NAIVE, OBS_DAILY, OBS_HOURLY, SPLIT_HOURLY, TARGETS, H, r, rs,
)

METRIC_NAMES = ["rmse", "mae", "r2", "mape"]
BESIDE = NAIVE + """,
tr AS (SELECT * FROM metrics WHERE metric_type = 'Train'),
te AS (SELECT * FROM metrics WHERE metric_type = 'Test'),
beside AS (SELECT tr.model, tr.horizon, tr.rmse AS rmse_train, tr.mae AS mae_train, tr.r2 AS r2_train,
  te.rmse AS rmse_test, te.mae AS mae_test, te.r2 AS r2_test, te.mape
  FROM tr LEFT JOIN te ON tr.model = te.model AND tr.horizon = te.horizon)"""

BLEND = FOLDED + f""",
m AS (SELECT {KEY}, coalesce(avg(temp) OVER (PARTITION BY series_id ORDER BY datetime ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING), 0) AS m24 FROM obs_hourly),
blend_rows AS (SELECT t.trial, h.horizon, f.fold,
  CASE {' '.join(f'WHEN h.horizon = {h} THEN f.target_t{h}' for h in range(1, H + 1))} END
  - ((1 - CAST(0.2 AS DOUBLE) * t.trial) * f.temp + CAST(0.2 AS DOUBLE) * t.trial * m.m24) AS e
  FROM folded f JOIN m USING (series_id, datetime), (VALUES (1), (2), (3), (4), (5)) t(trial),
  (VALUES {', '.join(f'({h})' for h in range(1, H + 1))}) h(horizon) WHERE f.role = 'val'),
blend AS (SELECT trial, horizon, fold, sqrt(avg(e * e)) AS rmse, count(*) FILTER (WHERE abs(e) < 20) AS best_iteration
  FROM blend_rows WHERE e IS NOT NULL GROUP BY ALL),
trials AS (SELECT trial, horizon, avg(rmse) AS val_rmse, count(rmse) AS n_folds,
  CAST(floor(avg(best_iteration)) AS INTEGER) AS avg_best_iteration FROM blend GROUP BY ALL),
best AS (SELECT * FROM trials QUALIFY row_number() OVER (PARTITION BY horizon ORDER BY val_rmse, trial) = 1)"""

CALENDAR = """cal AS (SELECT *, CAST(month(datetime) AS INTEGER) AS month, CAST(year(datetime) AS INTEGER) AS year,
  CASE WHEN month(datetime) BETWEEN 5 AND 11 THEN 'Rainy' ELSE 'Dry' END AS season FROM obs_daily)"""
HOURS = f"(VALUES {', '.join(f'({h})' for h in range(1, H + 1))}) t(h)"


def q(cte: str, select: str, source: str, tail: str = "") -> str:
    return f"WITH {cte} SELECT {select} FROM {source} {tail}"


def _mean(by: str, columns=("temp",)) -> str:
    return q(OBS_DAILY + ", " + CALENDAR, f"{by}, " + ", ".join(r(f"avg({c})", f"mean_{c}") for c in columns), "cal", f"GROUP BY {by}")


def _correlations() -> str:
    parts = [f"SELECT '{a}' AS a, '{b}' AS b, {r(f'corr({a}, {b})', 'corr')} FROM obs_hourly" for a in MEASURES for b in MEASURES]
    return f"WITH {OBS_HOURLY} " + " UNION ALL ".join(parts)


def _box(measure: str) -> str:
    return f"""SELECT c.season, '{measure}' AS measure, count({measure}) AS n, {r('min(q25)', 'q25')}, {r('min(q50)', 'q50')}, {r('min(q75)', 'q75')},
      {r(f'least(min({measure}) FILTER (WHERE {measure} >= q25 - 1.5e0 * (q75 - q25)), min(q25))', 'low')},
      {r(f'greatest(max({measure}) FILTER (WHERE {measure} <= q75 + 1.5e0 * (q75 - q25)), min(q75))', 'high')},
      count(*) FILTER (WHERE {measure} < q25 - 1.5e0 * (q75 - q25) OR {measure} > q75 + 1.5e0 * (q75 - q25)) AS outliers
      FROM cal c JOIN (SELECT season, quantile_cont({measure}, 0.25) AS q25, quantile_cont({measure}, 0.5) AS q50,
        quantile_cont({measure}, 0.75) AS q75 FROM cal GROUP BY season) b ON c.season = b.season GROUP BY c.season"""


def _line(x: str, y: str) -> str:
    return (f"SELECT '{x}' AS x, '{y}' AS y, {r(f'regr_slope({y}, {x})', 'slope')}, {r(f'regr_intercept({y}, {x})', 'intercept')}, "
            f"CAST(regr_count({y}, {x}) AS BIGINT) AS n_rows FROM obs_hourly")


HISTOGRAM = f"""WITH {OBS_DAILY}, s AS (SELECT min(temp) AS lo, (max(temp) - min(temp)) / 30 AS w FROM obs_daily)
SELECT CAST(i.bin AS INTEGER) AS bin, {r('any_value(lo) + (i.bin - 1) * any_value(w)', 'left')}, {r('any_value(lo) + i.bin * any_value(w)', 'right')},
  count(*) FILTER (WHERE temp >= lo + (i.bin - 1) * w AND (temp < lo + i.bin * w OR i.bin = 30)) AS n_rows
FROM range(1, 31) i(bin), s, obs_daily GROUP BY i.bin"""

DENSITY = f"""WITH {OBS_DAILY}, s AS (SELECT min(temp) AS lo, (max(temp) - min(temp)) / 199 AS step, count(temp) AS n,
  pow(count(temp), CAST(-0.2 AS DOUBLE)) * stddev_samp(temp) AS bw FROM obs_daily),
g AS (SELECT CAST(i AS INTEGER) AS point, lo + i * step AS x, n, bw FROM range(0, 200) t(i), s)
SELECT point, {r('x')}, {r('sum(exp(-0.5e0 * pow((x - temp) / bw, 2))) / (min(n) * min(bw) * sqrt(2 * pi()))', 'density')}
FROM g, obs_daily WHERE temp IS NOT NULL GROUP BY point, x"""

METRIC_SQL = f"""count(*) AS n_rows, {r('sqrt(avg((y - pred) * (y - pred)))', 'rmse')}, {r('avg(abs(y - pred))', 'mae')},
  {r('1 - sum((y - pred) * (y - pred)) / (count(*) * var_pop(y))', 'r2')},
  {r('avg(abs(y - pred) / greatest(abs(y), 2.220446049250313e-16))', 'mape')}"""

ROLLING = NAIVE + """,
base AS (SELECT horizon, sqrt(avg((y - pred) * (y - pred))) AS baseline_rmse FROM naive
  WHERE model = 'half_way' AND y IS NOT NULL AND split = 'train' GROUP BY horizon),
rolling AS (SELECT DISTINCT series_id, horizon, date_trunc('day', datetime) AS day,
  sqrt(avg((y - pred) * (y - pred)) OVER (PARTITION BY series_id, horizon ORDER BY date_trunc('day', datetime)
    RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW)) AS rolling_rmse
  FROM naive WHERE model = 'half_way' AND y IS NOT NULL AND split <> 'train'),
drifted AS (SELECT r.*, baseline_rmse, rolling_rmse > 1.2e0 * baseline_rmse AS drifted FROM rolling r JOIN base USING (horizon))"""

_BOXES = f"WITH {OBS_DAILY}, {CALENDAR} " + " UNION ALL ".join(_box(m) for m in ("temp", "humidity", "precip"))

ORACLES = {
    "a4_predictions_table": q(NAIVE, f"{KEY}, {r('max(CASE WHEN horizon = 1 THEN y END)', 'target_t1')}, {r('max(CASE WHEN horizon = 1 THEN pred END)', 'pred_target_t1')}, {r('max(CASE WHEN horizon = 7 THEN y END)', 'target_t7')}, {r('max(CASE WHEN horizon = 7 THEN pred END)', 'pred_target_t7')}", "naive", f"WHERE model = 'half_way' AND split = 'test' GROUP BY {KEY}"),
    "a5_metrics_table": q(NAIVE, f"model, metric_type, horizon, {rs(METRIC_NAMES)}", "metrics"),
    "a6_parameters_table": f"WITH {BLEND} SELECT 'Blend' AS model, horizon, 'trial' AS name, CAST(trial AS VARCHAR) AS value FROM best UNION ALL SELECT 'Blend', horizon, 'kind', 'lean' FROM best WHERE trial > 1",
    "a10_small_table": q(NAIVE, "model, " + ", ".join(r(f"sqrt(avg((y - pred) * (y - pred)) FILTER (WHERE split = '{s}'))", f"{s}_rmse") for s in ("train", "val", "test")), "naive", "WHERE horizon = 1 AND y IS NOT NULL GROUP BY model"),
    "b15_keys_in_both": q(BESIDE, f"model, horizon, {rs(['mae_train', 'mae_test', 'r2_train', 'r2_test'])}", "beside", "WHERE horizon <= 4"),
    "b18_overfit_gap": q(BESIDE, f"model, horizon, {r('(rmse_test - rmse_train) / rmse_train * 100', 'gap_pct')}", "beside"),
    "b19_residual": q(NAIVE, f"model, {KEY}, horizon, {r('y - pred', 'residual')}", "naive", "WHERE y IS NOT NULL"),
    "b26_band": f"""WITH {OBS_HOURLY}, b AS (SELECT {KEY}, count(temp) OVER f AS c, avg(temp) OVER f AS m, stddev_samp(temp) OVER f AS s FROM obs_hourly
      WINDOW f AS (PARTITION BY series_id ORDER BY datetime ROWS BETWEEN 15 PRECEDING AND 14 FOLLOWING))
      SELECT {KEY}, {r('m + s', 'upper_bound')}, {r('m - s', 'lower_bound')} FROM b WHERE c = 30""",
    "j1_actual_with_predicted": q(NAIVE, f"{KEY}, {r('y', 'target_t1')}, {r('pred', 'pred_target_t1')}, {r('y - pred', 'residual')}", "naive", "WHERE model = 'half_way' AND horizon = 1 AND split = 'test'"),
    "j2_train_beside_test": q(BESIDE, f"model, horizon, {rs(['rmse_train', 'mae_train', 'r2_train', 'rmse_test', 'mae_test', 'r2_test', 'mape'])}", "beside"),
    "j3_align_features_target": q(FEATURES_DAILY, f"{KEY}, {rs(['target_t3', 'humidity', 'windspeed', 'precip'])}", "features", "WHERE part = 'fit' AND target_t3 IS NOT NULL"),
    "j4_align_prediction": q(NAIVE, f"model, {KEY}, horizon, {rs(['y', 'pred'])}", "naive", "WHERE split = 'test' AND y IS NOT NULL"),
    "j5_labels_by_time": q(SPLIT_HOURLY, f"{KEY}, {rs(['humidity', 'target_t7'])}", "split_hourly", "WHERE split = 'val' AND target_t7 IS NOT NULL"),
    "j6_fixed_categories": f"WITH {OBS_HOURLY}, m AS (SELECT CASE WHEN month(datetime) BETWEEN 5 AND 11 THEN 'Rainy' ELSE 'Dry' END AS season, avg(temp) AS t FROM obs_hourly GROUP BY 1) SELECT s.season, {r('t', 'mean_temp')} FROM (VALUES ('Dry'), ('Rainy')) s(season) LEFT JOIN m ON m.season = s.season",
    "j7_parameters_with_defaults": q(BLEND, f"horizon, {r('CASE WHEN horizon % 2 = 1 THEN trial * 2e-1 ELSE 1e0 END', 'alpha')}, {r('CASE WHEN horizon % 2 = 1 AND trial > 1 THEN trial * 1e-1 ELSE 5e-1 END', 'l1_ratio')}", "best"),
    "g1_mean_by_month": _mean("month"),
    "g2_mean_by_year": _mean("year"),
    "g3_mean_by_season": _mean("season"),
    "g4_climograph": _mean("month", ("temp", "precip", "humidity")),
    "g5_correlations": _correlations(),
    "g6_histogram": HISTOGRAM,
    "g7_density": DENSITY,
    "g8_overall_mean": q(OBS_DAILY, r("avg(temp)", "mean_temp"), "obs_daily"),
    "g8_mean_residual": q(NAIVE, f"model, horizon, {r('avg(y - pred)', 'mean_residual')}", "naive", "WHERE split = 'test' GROUP BY model, horizon"),
    "g9_box_statistics": _BOXES,
    "g9_box_statistics_bracketed": _BOXES,
    "g9_outliers": f"WITH {OBS_DAILY}, {CALENDAR} SELECT c.season, datetime, {r('precip')} FROM cal c JOIN (SELECT season, quantile_cont(precip, 0.25) AS q1, quantile_cont(precip, 0.75) AS q3 FROM cal GROUP BY season) b ON b.season = c.season WHERE precip < q1 - 1.5e0 * (q3 - q1) OR precip > q3 + 1.5e0 * (q3 - q1)",
    "g10_lines": f"WITH {OBS_HOURLY} " + " UNION ALL ".join(_line(x, y) for x, y in (("temp", "precip"), ("solarradiation", "temp"), ("temp", "humidity"))),
    "g11_point_pairs": q(OBS_HOURLY, rs(["humidity", "precip"]), "obs_hourly", "WHERE humidity IS NOT NULL AND precip IS NOT NULL"),
    "g12_g15_metrics": q(NAIVE, f"model, split, horizon, {METRIC_SQL}", "naive", "WHERE y IS NOT NULL GROUP BY model, split, horizon"),
    "m13_evaluate_per_horizon": q(NAIVE, f"horizon, {METRIC_SQL}", "naive", "WHERE y IS NOT NULL AND model = 'last_value' AND split = 'test' GROUP BY horizon"),
    "g17_mean_over_folds": q(BLEND, f"trial, horizon, {r('val_rmse')}, n_folds", "trials"),
    "g18_mean_best_iteration": q(BLEND, "trial, horizon, avg_best_iteration", "trials"),
    "g19_mean_metric_per_model": q(NAIVE, "model, " + ", ".join(r(f"avg({c})", f"mean_{c}") for c in METRIC_NAMES), "metrics", "WHERE metric_type = 'Test' GROUP BY model"),
    "g20_forecast_summary": f"""WITH {LAST_FORECASTS}, g AS (SELECT series_id, min(datetime) AS d, avg(pred) AS mean_pred, max(pred) AS max_pred, min(pred) AS min_pred,
      first(horizon ORDER BY pred DESC, horizon) AS warmest_horizon, first(horizon ORDER BY pred, horizon) AS coolest_horizon FROM forecasts GROUP BY series_id)
      SELECT series_id, {rs(['mean_pred', 'max_pred', 'min_pred'])}, warmest_horizon, coolest_horizon, {r('max_pred - min_pred', 'spread')},
      strftime(d + to_days(warmest_horizon), '%b %d') AS warmest_date, strftime(d + to_days(coolest_horizon), '%b %d') AS coolest_date FROM g""",
    "g21_missing_counts": q(SPLIT_HOURLY, "series_id, split, count(*) AS n_rows, " + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}_missing" for c in ["windspeed", *TARGETS]), "split_hourly", "GROUP BY series_id, split"),
    "s1_sort_by_time": q(OBS_DAILY, f"{KEY}, {r('temp')}", "obs_daily", "ORDER BY datetime, series_id"),
    "s2_rank_benchmark": f"WITH {NAIVE}, b AS (SELECT model, " + ", ".join(f"sqrt(avg((y - pred) * (y - pred)) FILTER (WHERE split = '{s}')) AS {s}_rmse" for s in ("train", "val", "test")) + f" FROM naive WHERE horizon = 1 AND y IS NOT NULL GROUP BY model) SELECT model, {rs(['train_rmse', 'val_rmse', 'test_rmse'])}, {r('(val_rmse - train_rmse) / train_rmse * 100', 'gap_val_pct')}, {r('(test_rmse - train_rmse) / train_rmse * 100', 'gap_test_pct')} FROM b ORDER BY test_rmse",
    "s3_sort_by_horizon": q(NAIVE, f"model, metric_type, horizon, {r('mae')}", "metrics", "ORDER BY horizon, model, metric_type"),
    "s4_last_rows": q(OBS_HOURLY, f"{KEY}, {r('temp')}", "obs_hourly", "QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY datetime DESC) <= 40"),
    "s4_last_row": q(OBS_HOURLY, f"{KEY}, {rs(['temp', 'windspeed'])}", "obs_hourly", "QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY datetime DESC) = 1"),
    "s5_first_horizons": q(LAST_FORECASTS, f"series_id, datetime, horizon, {rs(['last_value', 'pred'])}", "forecasts", "WHERE horizon <= 3"),
    "s6_best_trial": q(BLEND, f"trial, horizon, {r('val_rmse')}, n_folds, avg_best_iteration", "best"),
    "s7_order_models": q(NAIVE, f"model, {r('avg(r2)', 'mean_metric')}", "metrics", "WHERE metric_type = 'Test' GROUP BY model ORDER BY avg(r2) DESC"),
    "u1_union_fit_parts": q(SPLIT_HOURLY, f"{KEY}, split, {r('temp')}", "split_hourly", "WHERE split IN ('train', 'val')"),
    "u2_union_metric_tables": q(NAIVE, f"model, metric_type, horizon, {rs(['rmse', 'mae', 'r2'])}, {r('''CASE WHEN metric_type = 'Test' THEN mape END''', 'mape')}", "metrics"),
    "u3_unpivot": f"WITH {BESIDE} SELECT model, horizon, 'r2_train' AS metric, {r('r2_train', 'score')} FROM beside UNION ALL SELECT model, horizon, 'r2_test', {r('r2_test', 'score')} FROM beside",
    "u4_pivot": q(BESIDE, f"""model, horizon, {r('rmse_train', '"Train"')}, {r('rmse_test', '"Test"')}, {r('(rmse_test - rmse_train) / rmse_train * 100', 'gap_pct')}""", "beside"),
    "u5_nested_to_rows": f"WITH {NAIVE} " + " UNION ALL ".join(f"SELECT model, 'target_t' || horizon AS target, '{m.upper()}' AS metric, {r(m, 'score')} FROM metrics WHERE metric_type = 'Test'" for m in ("rmse", "mae", "r2")),
    "u6_forecast_rows": q(LAST_FORECASTS, f"series_id, datetime, horizon, {rs(['last_value', 'pred'])}", "forecasts"),
    "w10_rolling_rmse": q(ROLLING, f"series_id, horizon, day, {r('rolling_rmse')}", "rolling"),
    "w10_drift": q(ROLLING, f"series_id, horizon, day, {rs(['rolling_rmse', 'baseline_rmse'])}, drifted", "drifted"),
    "w10_retrain_days": q(ROLLING, "series_id, day, bool_or(drifted) AS any_drift, day >= TIMESTAMP '2023-07-27' + INTERVAL 6 MONTH AS too_old, bool_or(drifted) OR day >= TIMESTAMP '2023-07-27' + INTERVAL 6 MONTH AS retrain", "drifted", "GROUP BY series_id, day"),
}
