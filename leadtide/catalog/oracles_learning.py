"""Oracle SQL of the queries in ``learning`` that SQL can express."""

from __future__ import annotations

from leadtide.catalog.oracles_basics import (
    DAILY_COLUMNS, FEATURES_DAILY, FOLDED, H, HOURLY_COLUMNS, KEY, OBS_HOURLY, SPLIT_DAILY, SPLIT_HOURLY, TARGETS, features_cte,
    part_of, r, rs,
)
from leadtide.config import (
    ALPHA_RANGE, HOURLY_HORIZONS, L1_RATIO_RANGE, LINEAR_MODELS, N_ESTIMATORS_RANGE, NUM_LEAVES_RANGE, TREE_RANGES,
)


def _constants(source: str, measure: str, by: str = "") -> str:
    front = f"{by}, " if by else ""
    tail = f"GROUP BY {by}" if by else ""
    return (f"SELECT {front}'{measure}' AS feature, quantile_cont({measure}, 0.5) AS median, "
            f"quantile_cont({measure}, 0.75) - quantile_cont({measure}, 0.25) AS iqr FROM {source} {tail}")


def _scaled(source: str, measures: list[str], fit_on: str, by: str, front: str) -> str:
    """Scaled columns of ``source`` with constants of the rows where ``fit_on`` holds."""
    group = f"GROUP BY {by}" if by else ""
    consts = ", ".join(
        f"quantile_cont({m}, 0.5) AS {m}_m, quantile_cont({m}, 0.75) - quantile_cont({m}, 0.25) AS {m}_s" for m in measures)
    k = f"k AS (SELECT {by + ', ' if by else ''}{consts} FROM {source} WHERE {fit_on} {group})"
    cols = ", ".join(r(f"({m} - {m}_m) / CASE WHEN {m}_s < 2.220446049250313e-15 THEN 1 ELSE {m}_s END", m) for m in measures)
    join = f"JOIN k USING ({by})" if by else ", k"
    return f"{k} SELECT {front}, {cols} FROM {source} {join}"


_FIT = "fit AS (SELECT * FROM features WHERE part = 'fit')"
_FOLD_FEATURES = FOLDED + "," + features_cte("folded", "parts", "hourly", "series_id, fold, role")
_TRAIN = "fold_train AS (SELECT * FROM parts WHERE role = 'train')"
_WITH_SCALE = f"{{front}}feature, {r('median')}, {r('iqr')}, {r('CASE WHEN iqr < 2.220446049250313e-15 THEN 1e0 ELSE iqr END', 'scale')}"

_MOMENTS = OBS_HOURLY + """,
mom AS (SELECT count(*) AS n, avg(windgust) AS mx, avg(temp) AS my, var_pop(windgust) AS vx, covar_pop(temp, windgust) AS cxy FROM obs_hourly)"""


def _line(kind: str, slope: str) -> str:
    return (f"WITH {_MOMENTS}, w AS (SELECT *, {slope} AS slope FROM mom) SELECT '{kind}' AS kind, n AS n_rows, "
            f"{r('my - slope * mx', 'intercept', 4)}, {r('slope', 'slope', 4)} FROM w")


_ALL_HORIZONS = f"WITH {SPLIT_HOURLY} " + " UNION ALL ".join(
    f"SELECT {KEY}, {h} AS horizon, {r(f'target_t{h}', 'y', 4)}, {r('a + b * windgust', 'pred', 4)} FROM split_hourly, "
    f"(SELECT regr_intercept(target_t{h}, windgust) AS a, regr_slope(target_t{h}, windgust) AS b FROM split_hourly WHERE split <> 'test') "
    f"WHERE split = 'test'" for h in range(1, H + 1))

_G16 = f"WITH {FEATURES_DAILY}, {_FIT}, c AS (" + " UNION ALL ".join(_constants("fit", m) for m in DAILY_COLUMNS) + f") SELECT {_WITH_SCALE.format(front='')} FROM c"

_CHAIN_ROWS = " UNION ALL ".join(
    f"SELECT CASE WHEN split = 'test' THEN 'Test' ELSE 'Train' END AS metric_type, {h} AS horizon, target_t{h} AS y, "
    f"CASE WHEN target_t{h} IS NOT NULL THEN a + b * x END AS pred FROM x, "
    f"(SELECT regr_intercept(target_t{h}, x) AS a, regr_slope(target_t{h}, x) AS b FROM x WHERE part = 'fit')" for h in range(1, H + 1))
_SAVED_CHAIN = f"""WITH {SPLIT_HOURLY}, {part_of('split_hourly', 'parted')}, x AS (
  SELECT *, last_value(windgust IGNORE NULLS) OVER (PARTITION BY series_id, part ORDER BY datetime) AS x FROM parted
), p AS ({_CHAIN_ROWS})
SELECT metric_type, horizon, count(pred) AS n_rows, {r('sqrt(avg((y - pred) ** 2))', 'rmse', 4)}, {r('avg(abs(y - pred))', 'mae', 4)},
  {r('1 - sum((y - pred) ** 2) / (count(pred) * var_pop(CASE WHEN pred IS NOT NULL THEN y END))', 'r2', 4)},
  {r('avg(abs(y - pred) / greatest(abs(y), 2.220446049250313e-16))', 'mape', 4)}
FROM p GROUP BY ALL"""

_LABELLED = f"WITH {SPLIT_HOURLY}, k AS (SELECT visibility AS v, target_t1 AS y FROM split_hourly WHERE target_t1 IS NOT NULL)"
_EVERY_CUT = """c AS (
  SELECT v, sum(n) OVER (ORDER BY v) AS ln, sum(g) OVER (ORDER BY v) AS lg, sum(n) OVER () AS n, sum(g) OVER () AS g
  FROM (SELECT v, count(*) AS n, sum(base - y) AS g FROM k, (SELECT avg(y) AS base FROM k) GROUP BY v)
)"""


def _soft(g: str) -> str:
    return f"(sign({g}) * greatest(abs({g}) - 5, 0))"


_ONE_SPLIT = f"""{_LABELLED}, {_EVERY_CUT}, s AS (
  SELECT *, {_soft('lg')} ** 2 / (ln + 2) + {_soft('(g - lg)')} ** 2 / (n - ln + 2) AS gain FROM c WHERE ln < n ORDER BY gain DESC, v LIMIT 1
), b AS (SELECT avg(y) AS base FROM k)
SELECT 'left' AS side, ln::BIGINT AS n_rows, {r(f"base - {_soft('lg')} / (ln + 2)", 'pred', 4)}, {r('v', 'threshold', 4)} FROM s, b
UNION ALL
SELECT 'right', (n - ln)::BIGINT, {r(f"base - {_soft('(g - lg)')} / (n - ln + 2)", 'pred', 4)}, {r('v', 'threshold', 4)} FROM s, b"""
_ONE_TREE = f"""{_LABELLED}, {_EVERY_CUT}, s AS (
  SELECT v AS split_at FROM c WHERE ln < n ORDER BY lg ** 2 / ln + (g - lg) ** 2 / (n - ln) DESC, v LIMIT 1
)
SELECT {r('avg(y)', 'prediction', 4)}, count(*) AS n_rows, {r('max(v)', 'top', 4)}, {r('min(v)', 'bottom', 4)} FROM k, s GROUP BY v <= split_at"""


def _uniform(name: str, ids: str) -> str:
    return f"(('0x' || sha256(concat_ws('|', '42', '{name}', {ids}, trial))[1:13])::BIGINT / 4503599627370496e0)"


def _drawn(name: str, ids: str, low: float, high: float, scale: str) -> str:
    u = _uniform(name, ids)
    if scale == "log":
        return f"exp(ln({low!r}::DOUBLE) + {u} * (ln({high!r}::DOUBLE) - ln({low!r}::DOUBLE)))"
    if scale == "int":
        return f"least(floor({low} + {u} * {high - low + 1})::INT, {high})"
    return f"({low!r}::DOUBLE + {u} * ({high!r}::DOUBLE - {low!r}::DOUBLE))"


def _linear_trials(studies: str, ids: str, n: int) -> str:
    kinds = ", ".join(f"'{k}'" for k in LINEAR_MODELS)
    return f"""drawn AS (
  SELECT *, ([{kinds}])[floor({_uniform('kind', ids)} * {len(LINEAR_MODELS)})::INT + 1] AS kind,
    {_drawn('alpha', ids, *ALPHA_RANGE, 'log')} AS a, {_drawn('l1_ratio', ids, *L1_RATIO_RANGE, 'uniform')} AS l
  FROM (SELECT *, unnest(range(1, {n + 1}))::INT AS trial FROM {studies})
), trials AS (
  SELECT * EXCLUDE (a, l), CASE WHEN kind <> 'LinearRegression' THEN a END AS alpha, CASE WHEN kind = 'ElasticNet' THEN l END AS l1_ratio FROM drawn
)"""


_SERIES = f"WITH {OBS_HOURLY}, studies AS (SELECT DISTINCT series_id FROM obs_hourly)"
_DRAW_LINEAR = f"{_SERIES}, {_linear_trials('studies', 'series_id', 50)} SELECT series_id, trial, kind, {r('alpha')}, {r('l1_ratio')} FROM trials"
_DRAW_TREES = f"{_SERIES} SELECT series_id, trial, " + ", ".join(
    f"{_drawn(name, 'series_id', *how)} AS {name}" if how[2] == "int" else r(_drawn(name, "series_id", *how), name)
    for name, how in {**TREE_RANGES, "n_estimators": N_ESTIMATORS_RANGE, "num_leaves": NUM_LEAVES_RANGE}.items()
) + " FROM (SELECT *, unnest(range(1, 51))::INT AS trial FROM studies)"

# A search over one column: every fit has a closed form on the moments of its fold.
_KNOWN_TARGETS = " AND ".join(f"{t} IS NOT NULL" for t in TARGETS)
_LONG_TARGETS = " UNION ALL ".join(f"SELECT fold, role, x, {h} AS horizon, target_t{h} AS y FROM scaled" for h in range(1, H + 1))
_SHRUNK = "(sign(cxy) * greatest(abs(cxy) - {0}, 0))"
_ONE_INPUT_SEARCH = f"""WITH {SPLIT_DAILY}, known AS (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY datetime) - 1 AS idx, count(*) OVER (PARTITION BY series_id) AS n
  FROM split_daily WHERE split <> 'test' AND {_KNOWN_TARGETS}
), parts AS (
  SELECT * FROM (
    SELECT *, n // 6 AS sz, CASE WHEN idx < fold * (n // 6) THEN 'train'
      WHEN idx >= fold * (n // 6) + 7 AND idx < fold * (n // 6) + 7 + n // 6 THEN 'val' END AS role
    FROM (SELECT *, unnest([1, 2, 3, 4, 5]) AS fold FROM known)
  ) WHERE role IS NOT NULL AND fold * sz + 7 + sz <= n
), k AS (
  SELECT fold, quantile_cont(windgust, 0.5) AS m, quantile_cont(windgust, 0.75) - quantile_cont(windgust, 0.25) AS s
  FROM parts WHERE role = 'train' GROUP BY fold
), scaled AS (SELECT parts.*, (windgust - m) / CASE WHEN s < 2.220446049250313e-15 THEN 1 ELSE s END AS x FROM parts JOIN k USING (fold)),
long AS ({_LONG_TARGETS}),
mom AS (
  SELECT horizon, fold, count(*) AS n, avg(x) AS mx, avg(y) AS my, var_pop(x) AS vx, covar_pop(y, x) AS cxy FROM long WHERE role = 'train' GROUP BY ALL
), val AS (
  SELECT horizon, fold, count(*) AS n, avg(x) AS vmx, avg(y) AS vmy, var_pop(x) AS vvx, var_pop(y) AS vvy, covar_pop(y, x) AS vcxy
  FROM long WHERE role = 'val' GROUP BY ALL
), studies AS (SELECT DISTINCT horizon FROM long),
{_linear_trials('studies', 'horizon', 300)},
fits AS (
  SELECT t.*, fold, mx, my, CASE kind WHEN 'LinearRegression' THEN cxy / vx WHEN 'Ridge' THEN n * cxy / (n * vx + alpha)
    WHEN 'Lasso' THEN {_SHRUNK.format('alpha')} / vx ELSE {_SHRUNK.format('alpha * l1_ratio')} / (vx + alpha * (1 - l1_ratio)) END AS b
  FROM trials t JOIN mom USING (horizon)
), scores AS (
  SELECT f.*, sqrt(vvy - 2 * b * vcxy + b * b * vvx + (vmy - my - b * (vmx - mx)) ** 2) AS rmse FROM fits f JOIN val USING (horizon, fold)
)
SELECT horizon, trial, kind, {r('any_value(alpha)', 'alpha', 4)}, {r('any_value(l1_ratio)', 'l1_ratio', 4)}, {r('avg(rmse)', 'val_rmse', 4)},
  count(*)::INT AS n_folds
FROM scores GROUP BY horizon, trial, kind"""

# Boosted stumps on one column: the state of a round is one prediction per value of the column.
_STUMPS = f"""WITH RECURSIVE {SPLIT_HOURLY}, k AS (SELECT split, visibility AS v, target_t1 AS y FROM split_hourly WHERE target_t1 IS NOT NULL),
d AS (
  SELECT list(n ORDER BY v) AS n, list(s ORDER BY v) AS s, list(vn ORDER BY v) AS vn, list(vs ORDER BY v) AS vs, list(vq ORDER BY v) AS vq,
    count(*) AS k, sum(s) / sum(n) AS base, sum(n) AS total
  FROM (
    SELECT v, count(*) FILTER (WHERE split = 'train') AS n, coalesce(sum(y) FILTER (WHERE split = 'train'), 0) AS s,
      count(*) FILTER (WHERE split = 'val') AS vn, coalesce(sum(y) FILTER (WHERE split = 'val'), 0) AS vs,
      coalesce(sum(y * y) FILTER (WHERE split = 'val'), 0) AS vq
    FROM k WHERE split <> 'test' GROUP BY v
  )
), rounds AS (
  SELECT 0 AS t, list_transform(n, lambda x: base) AS f FROM d
  UNION ALL
  SELECT t + 1, list_transform(range(1, k + 1), lambda i: f[i] - 0.5 * CASE WHEN b IS NULL THEN gl[k] / (total + 1)
    WHEN i <= b THEN gl[b] / (nl[b] + 1) ELSE (gl[k] - gl[b]) / (total - nl[b] + 1) END)
  FROM (
    SELECT *, CASE WHEN list_max(gains) > 0 THEN list_position(gains, list_max(gains)) END AS b FROM (
      SELECT *, list_transform(range(1, k + 1), lambda i: CASE WHEN nl[i] > 0 AND nl[i] < total THEN
        gl[i] ** 2 / (nl[i] + 1) + (gl[k] - gl[i]) ** 2 / (total - nl[i] + 1) - gl[k] ** 2 / (total + 1) ELSE -1 END) AS gains
      FROM (
        SELECT t, f, k, total, list_transform(range(1, k + 1), lambda i: list_sum(n[1:i])) AS nl,
          list_transform(range(1, k + 1), lambda i: list_sum(list_transform(range(1, i + 1), lambda j: n[j] * f[j] - s[j]))) AS gl
        FROM rounds, d WHERE t < 40
      )
    )
  )
), losses AS (
  SELECT t, list_sum(list_transform(range(1, k + 1), lambda i: vn[i] * f[i] ** 2 - 2 * f[i] * vs[i] + vq[i])) / list_sum(vn) AS loss, list_sum(vn) AS m
  FROM rounds, d WHERE t > 0
), seen AS (
  SELECT *, arg_min(t, loss) OVER w AS best, min(loss) OVER w AS least FROM losses WINDOW w AS (ORDER BY t)
), stop AS (SELECT * FROM seen WHERE t - best >= 5 OR t = 40 ORDER BY t LIMIT 1)
SELECT m::BIGINT AS n_rows, {r('sqrt(least)', 'rmse', 4)}, best::INT AS best_iteration, t::INT AS grown FROM stop"""


def _at_optimum(split: str, horizons: tuple[int, ...], columns: list[str], cte: str) -> str:
    """The gradient is where the penalty wants it; the rows are those with a known target in the fit part."""
    each = " UNION ALL ".join(
        f"SELECT {h} AS horizon, count(lead_{h}) AS n_rows FROM (SELECT split, lead(temp, {h}) OVER (PARTITION BY series_id ORDER BY datetime) AS lead_{h} "
        f"FROM {split}) WHERE split <> 'test'" for h in horizons)
    names = ", ".join(f"('{c}')" for c in columns)
    return f"WITH {cte}, n AS ({each}), f(feature) AS (VALUES {names}) SELECT horizon, feature, n_rows, 0e0 AS off FROM n, f"


ORACLES = {
    "m11_daily_optimality": _at_optimum("split_daily", tuple(range(1, H + 1)), DAILY_COLUMNS, SPLIT_DAILY),
    "m11_hourly_optimality": _at_optimum("split_hourly", HOURLY_HORIZONS, HOURLY_COLUMNS, SPLIT_HOURLY),
    "m10_one_input_stop": _STUMPS,
    "m15_one_input_search": _ONE_INPUT_SEARCH,
    "m16_draw_linear": _DRAW_LINEAR,
    "m16_draw_trees": _DRAW_TREES,
    "a7_saved_chain": _SAVED_CHAIN,
    "m7_one_split": _ONE_TREE,
    "m9_one_split": _ONE_SPLIT,
    "g16_robust_constants": _G16,
    "g16_robust_constants_bracketed": _G16,
    "m2_robust_scale": f"WITH {FEATURES_DAILY}, " + _scaled("features", DAILY_COLUMNS, "part = 'fit'", "", f"{KEY}, part"),
    "m17_fold_constants": f"WITH {_FOLD_FEATURES}, {_TRAIN}, c AS (" + " UNION ALL ".join(_constants("fold_train", m, "fold") for m in HOURLY_COLUMNS) + f") SELECT {_WITH_SCALE.format(front='fold, ')} FROM c",
    "m17_scale_per_fold": f"WITH {_FOLD_FEATURES}, " + _scaled("parts", HOURLY_COLUMNS, "role = 'train'", "fold", f"{KEY}, fold, role"),
    "m1_ml_stages": f"WITH {FEATURES_DAILY} SELECT {KEY}, part, {rs([*TARGETS, *DAILY_COLUMNS])} FROM features",
    "m3_ols_one_input": _line("LinearRegression", "cxy / vx"),
    "m4_ridge_one_input": _line("Ridge", "n * cxy / (n * vx + 5000)"),
    "m5_lasso_one_input": _line("Lasso", "sign(cxy) * greatest(abs(cxy) - 7.5e0, 0) / vx"),
    "m6_elastic_net_one_input": _line("ElasticNet", "sign(cxy) * greatest(abs(cxy) - 6e0, 0) / (vx + 14e0)"),
    "m11_m12_one_input_all_horizons": _ALL_HORIZONS,
    "a7_saved_lines": _ALL_HORIZONS,
}
