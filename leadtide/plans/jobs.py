"""A fitted job as a folder of tables: feature columns with their scaler, lines, trees, version.

All that scoring needs is stored: another session reads the folder and gives the same predictions.
The tables are as wide as the features and as long as the models, whatever they were fitted on.
"""

from __future__ import annotations

from dataclasses import asdict

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from leadtide.operators.boosting import Boost, Fitted
from leadtide.operators.models import LinearModel, as_linear_model, linear_model_rows, linear_models_from_rows
from leadtide.plans.chain import Trained
from leadtide.sources.stores import LINES, read_table, write_table

VERSION = 1
COLUMNS = "place int, name string, median double, scale double"
CUTS = "horizon int, place int, cuts array<double>"
TREES = (
    "horizon int, base double, best int, grown int, loss double, parameters map<string,string>, sizes array<bigint>, "
    "feature array<bigint>, cut array<bigint>, left array<bigint>, value array<double>"
)
NOTES = "version int, kind string, horizon int"


def _models(trained: Trained, kind: type) -> dict[int, Fitted]:
    return {h: m for h, m in trained.models.items() if isinstance(m, kind)}


def save_job(spark: SparkSession, trained: Trained, path: str) -> None:
    """Write all tables of the job; the notes come last, so a folder without them is not a whole job."""
    rows = [(i, c, *map(float, trained.scaler.get(c, (0.0, 1.0)))) for i, c in enumerate(trained.columns)]
    write_table(spark.createDataFrame(rows, COLUMNS), f"{path}/columns")
    trees = _models(trained, Fitted)
    lines = {h: as_linear_model(m) for h, m in trained.models.items() if h not in trees and m is not None}
    if lines:
        write_table(linear_model_rows(spark, lines, trained.columns), f"{path}/lines")
    if trees:
        cuts = [(h, i, c.tolist()) for h, m in trees.items() for i, c in enumerate(m.cuts)]
        write_table(spark.createDataFrame(cuts, CUTS), f"{path}/cuts")
        rows = [
            (h, m.base, m.best, m.grown, m.loss, {k: str(v) for k, v in asdict(m.boost).items()},
             *[getattr(m, c).tolist() for c in ("sizes", "feature", "cut", "left", "value")])
            for h, m in trees.items()
        ]
        write_table(spark.createDataFrame(rows, TREES), f"{path}/trees")
    kinds = {h: "trees" if h in trees else "line" if h in lines else "none" for h in trained.models}
    write_table(spark.createDataFrame([(VERSION, k, h) for h, k in kinds.items()], NOTES), f"{path}/notes")


def _boost(said: dict[str, str]) -> Boost:
    plain = Boost(said["label"])
    values = {}
    for name, text in said.items():
        default = getattr(plain, name)
        values[name] = text if name == "label" else None if text == "None" else int(text) if isinstance(default, int) or default is None else float(text)
    return Boost(**values)


def load_job(spark: SparkSession, path: str) -> Trained:
    """The job as it was fitted; a folder of another version is refused."""
    notes = read_table(spark, f"{path}/notes", NOTES).collect()
    if {r["version"] for r in notes} != {VERSION}:
        raise ValueError(f"{path} is not a job of version {VERSION}")
    columns = sorted(read_table(spark, f"{path}/columns", COLUMNS).collect(), key=lambda r: r["place"])
    names = [r["name"] for r in columns]
    models: dict[int, LinearModel | Fitted | None] = {r["horizon"]: None for r in sorted(notes, key=lambda r: r["horizon"])}
    kinds = {r["kind"] for r in notes}
    if "line" in kinds:
        lines, order = linear_models_from_rows(read_table(spark, f"{path}/lines", LINES))
        at = [order.index(c) for c in names]
        models |= {h: LinearModel(m.intercept, tuple(m.weights[i] for i in at)) for h, m in lines.items()}
    if "trees" in kinds:
        cuts: dict[int, dict[int, np.ndarray]] = {}
        for r in read_table(spark, f"{path}/cuts", CUTS).collect():
            cuts.setdefault(r["horizon"], {})[r["place"]] = np.array(r["cuts"], float)
        for r in read_table(spark, f"{path}/trees", TREES).collect():
            arrays = {c: np.array(r[c], float if c == "value" else np.int64) for c in ("sizes", "feature", "cut", "left", "value")}
            own = [cuts[r["horizon"]][i] for i in range(len(names))]
            models[r["horizon"]] = Fitted(_boost(r["parameters"]), r["base"], names, own, r["best"], r["grown"], r["loss"], **arrays)
    return Trained(names, {r["name"]: (r["median"], r["scale"]) for r in columns}, models)


def score_stored(spark: SparkSession, ready: DataFrame, path: str) -> DataFrame:
    """Predictions of a stored job for rows with its features."""
    from leadtide.plans.chain import score

    return score(ready, load_job(spark, path))
