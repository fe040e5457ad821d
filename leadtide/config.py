"""Fixed values of the forecasting jobs: names, horizons, ratios, feature lists, search ranges."""

from __future__ import annotations

from dataclasses import dataclass

KEYS = ("series_id",)
TIME = "datetime"
TARGET = "temp"

# Horizons (in rows), split ratios and fold settings of the three job variants.
DAILY_HORIZONS = (1, 2, 3, 4, 5, 6, 7)
HOURLY_HORIZONS = (24, 48, 72, 96, 120, 144, 168)
NEXT_DAY_HORIZONS = tuple(range(1, 25))
TRAIN_RATIO = 0.7
VAL_RATIO = 0.15
FOLDS = 5
DAILY_GAP_ROWS = 7
HOURLY_GAP_ROWS = 168

# Model columns in their order.
MEASURES = (
    "humidity", "sealevelpressure", "dew", "cloudcover", "solarradiation",
    "visibility", "windspeed", "windgust", "precip",
)
YEAR_CYCLE = ("month_sin", "month_cos", "day_sin", "day_cos")
HOUR_CYCLE = ("hour_sin", "hour_cos")
ROW_DERIVED = (
    "daylight_hours", "solar_per_hour", "temp_range", "dewpoint_depression",
    "sealevelpressure_change",
)
ROLLING_DERIVED = (
    "temp_lag_24h", "humidity_lag_24h", "temp_rolling_avg_24h", "precip_rolling_sum_24h",
)

# Search ranges (low, high, scale).
LINEAR_MODELS = ("LinearRegression", "Ridge", "Lasso", "ElasticNet")
ALPHA_RANGE = (1e-5, 1e2)
L1_RATIO_RANGE = (0.1, 0.9)
DEFAULT_ALPHA = 1.0
DEFAULT_L1_RATIO = 0.5
TREE_RANGES = {
    "learning_rate": (1e-3, 1e-1, "log"),
    "max_depth": (3, 10, "int"),
    "subsample": (0.6, 1.0, "uniform"),
    "colsample_bytree": (0.6, 1.0, "uniform"),
    "reg_alpha": (1e-5, 1e2, "log"),
    "reg_lambda": (1e-5, 1e2, "log"),
}
N_ESTIMATORS_RANGE = (200, 2000, "int")
NUM_LEAVES_RANGE = (20, 150, "int")
MAX_ROUNDS = 2000
PATIENCE = 100

# Defaults of growth by best leaf.
LEAVES = 31
LEAST_LEAF_ROWS = 20
LEAF_RATE = 0.1


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns one job variant derives, and how many rows back its windows look.

    ``only`` names the model columns of a job that takes fewer.
    """

    name: str
    hour_cycle: bool
    rolling: bool
    lag_rows: int = 24
    only: tuple[str, ...] = ()

    @property
    def columns(self) -> tuple[str, ...]:
        if self.only:
            return self.only
        cols = MEASURES + YEAR_CYCLE
        if self.hour_cycle:
            cols += HOUR_CYCLE
        cols += ROW_DERIVED
        if self.rolling:
            cols += ROLLING_DERIVED
        return cols

    @property
    def rows_back(self) -> int:
        return self.lag_rows if self.rolling else 1


DAILY = FeatureSpec("daily", hour_cycle=False, rolling=False)
HOURLY = FeatureSpec("hourly", hour_cycle=True, rolling=True)


def target_name(horizon: int) -> str:
    return f"target_t{horizon}"


def pred_name(horizon: int) -> str:
    return f"pred_target_t{horizon}"
