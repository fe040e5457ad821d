"""The feature jobs of the daily and the hourly variant, and their ML pipeline stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from leadtide.config import DAILY, HOURLY, TIME, FeatureSpec, target_name
from leadtide.functions.calendar import hour_cycle, year_cycle
from leadtide.functions.weather import row_features
from leadtide.operators.blocks import SeriesLayout, enter, lay_out, leave, over_series
from leadtide.operators.splits import split_inside
from leadtide.operators.windows import (
    difference, fill_gaps, fill_inside, lagged, targets_inside, trailing_mean, trailing_sum,
)

SPECS = {s.name: s for s in (DAILY, HOURLY)}


def time_features(df: DataFrame, spec: FeatureSpec, time: str = TIME) -> DataFrame:
    cols = year_cycle(time)
    if spec.hour_cycle:
        cols |= hour_cycle(time)
    return df.withColumns(cols)


def window_features(df: DataFrame, w: WindowSpec, spec: FeatureSpec) -> DataFrame:
    """Change, lag and rolling features; each exists only if its input does."""
    have, n = set(df.columns), spec.lag_rows
    cols = {}
    if "sealevelpressure" in have:
        cols["sealevelpressure_change"] = difference("sealevelpressure", w)
    if spec.rolling:
        if "temp" in have:
            cols["temp_lag_24h"] = lagged("temp", n, w)
            cols["temp_rolling_avg_24h"] = trailing_mean("temp", n, w)
        if "humidity" in have:
            cols["humidity_lag_24h"] = lagged("humidity", n, w)
        if "precip" in have:
            cols["precip_rolling_sum_24h"] = trailing_sum("precip", n, w)
    return df.withColumns(cols) if cols else df


def final_columns(available: Sequence[str], spec: FeatureSpec) -> list[str]:
    """The model columns that exist, in their fixed order. The target is never among them."""
    return [c for c in spec.columns if c in set(available)]


def build_features(
    df: DataFrame,
    layout: SeriesLayout,
    spec: FeatureSpec,
    scope: Sequence[str] = (),
    keep: Sequence[str] = (),
) -> DataFrame:
    """All features of a variant in one pass: one shuffle by series feeds every window.

    Returns keys, time, ``scope``, ``keep`` and the final feature columns without gaps.
    """
    wide = enter(row_features(time_features(df, spec)), layout, back=spec.rows_back)
    return leave(features_inside(wide, layout, spec, scope, keep), layout)


def features_inside(
    wide: DataFrame, layout: SeriesLayout, spec: FeatureSpec, scope: Sequence[str], keep: Sequence[str]
) -> DataFrame:
    """Window features, fills and column choice for a frame that has its blocks already."""
    wide = window_features(wide, layout.window(scope), spec)
    columns = final_columns(wide.columns, spec)
    filled = fill_inside(wide, layout, columns, scope)
    front = dict.fromkeys([*layout.keys, layout.time, *scope, *keep, *layout.helpers])
    return filled.select(*[c for c in front if c not in columns], *columns)


def targets_and_features(
    df: DataFrame, layout: SeriesLayout, spec: FeatureSpec, horizons: Sequence[int], keep: Sequence[str] = ()
) -> DataFrame:
    """Targets over the whole series, split labels, and features that restart at the test part.

    Everything a training and a scoring job read, from one shuffle of the observations: ``part``
    is ``fit`` for train and val, which are one run, and ``test`` for the rest.
    """
    wide = enter(row_features(time_features(df, spec)), layout, back=spec.rows_back, ahead=max(horizons))
    wide = split_inside(targets_inside(wide, layout.window(), horizons), layout)
    wide = wide.withColumn("part", F.when(F.col("split") == "test", "test").otherwise("fit"))
    targets = [target_name(h) for h in horizons]
    return leave(features_inside(wide, layout, spec, ["part"], ["split", *keep, *targets]), layout)


# ML stages: the same steps for users who want a fitted, savable pipeline.


class _SeriesStage(Params):
    variant = Param(Params._dummy(), "variant", "daily or hourly", TypeConverters.toString)
    keys = Param(Params._dummy(), "keys", "series key columns", TypeConverters.toListString)
    scope = Param(Params._dummy(), "scope", "columns that restart windows", TypeConverters.toListString)
    blockRows = Param(Params._dummy(), "blockRows", "rows above which a series is cut", TypeConverters.toInt)

    def _defaults(self) -> None:
        self._setDefault(variant="daily", keys=["series_id"], scope=[], blockRows=4_000_000)

    @property
    def _spec(self) -> FeatureSpec:
        return SPECS[self.getOrDefault("variant")]

    def _layout(self, df: DataFrame) -> SeriesLayout:
        return lay_out(df, self.getOrDefault("keys"), TIME, self.getOrDefault("blockRows"))


class TimeFeatures(_SeriesStage, Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Cyclic encodings of month, day of year and, for hourly data, hour."""

    @keyword_only
    def __init__(self, *, variant="daily", keys=None, scope=None, blockRows=None):
        super().__init__()
        self._defaults()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return time_features(dataset, self._spec)


class DerivedFeatures(_SeriesStage, Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Row-wise and window features."""

    @keyword_only
    def __init__(self, *, variant="daily", keys=None, scope=None, blockRows=None):
        super().__init__()
        self._defaults()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return over_series(
            row_features(dataset),
            self._layout(dataset),
            lambda d, w: window_features(d, w, self._spec),
            back=self._spec.rows_back,
            scope=self.getOrDefault("scope"),
        )


class SelectFeatures(_SeriesStage, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Learns which model columns exist."""

    @keyword_only
    def __init__(self, *, variant="daily", keys=None, scope=None, blockRows=None):
        super().__init__()
        self._defaults()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> SelectFeaturesModel:
        model = SelectFeaturesModel(columns=final_columns(dataset.columns, self._spec))
        return self._copyValues(model)


class SelectFeaturesModel(_SeriesStage, Model, DefaultParamsReadable, DefaultParamsWritable):
    """Fills the learned columns and drops all measures that are no model column."""

    columns = Param(Params._dummy(), "columns", "fitted feature columns", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, columns=None):
        super().__init__()
        self._defaults()
        self._setDefault(columns=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        columns, scope = self.getOrDefault("columns"), self.getOrDefault("scope")
        front = [*self.getOrDefault("keys"), TIME, *scope]
        targets = [c for c in dataset.columns if c.startswith("target_t")]
        narrow = dataset.select(*front, *targets, *columns)
        return fill_gaps(narrow, self._layout(narrow), columns, scope)


def feature_pipeline(
    spec: FeatureSpec,
    keys: Sequence[str] = ("series_id",),
    scope: Sequence[str] = (),
    block_rows: int = 4_000_000,
) -> Pipeline:
    """Time features, derived features, column selection with filling."""
    args = {"variant": spec.name, "keys": list(keys), "scope": list(scope), "blockRows": block_rows}
    return Pipeline(stages=[TimeFeatures(**args), DerivedFeatures(**args), SelectFeatures(**args)])
