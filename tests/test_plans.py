"""Properties of physical plans that matter at scale."""

from __future__ import annotations

import io
import re
from contextlib import redirect_stdout

import pytest

from __spark_entry__ import queries
from leadtide.catalog import worked

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_features_need_one_shuffle_after_the_view(spark):
    text = plan(queries()["m1_features_whole_table"](spark, SF))
    by_series = re.findall(r"Arguments: hashpartitioning\(([^,]*)#\d+L?, \d+\), ENSURE_REQUIREMENTS", text)
    assert len(by_series) == 1
    assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("name", ["w1_lead_targets", "m1_features_hourly", "b19_residual", "m13_evaluate_per_horizon", "w10_drift", "g5_correlations"])
def test_no_python_and_no_cross_join(spark, name):
    text = plan(queries()[name](spark, SF))
    for bad in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


def test_only_needed_columns_are_read(spark):
    text = plan(queries()["w1_lead_targets"](spark, SF))
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"ts", "event_type", "value"}


def test_split_read_is_pruned(spark, tmp_path):
    from leadtide.sources.stores import read_split, write_splits

    write_splits(worked.split_hourly(spark, SF)[0], str(tmp_path / "s"))
    text = plan(read_split(spark, str(tmp_path / "s"), "train", "val").select("temp"))
    assert re.search(r"PartitionFilters: \[.*split", text)


def test_last_rows_are_cut_before_the_shuffle(spark):
    text = plan(queries()["s4_last_rows"](spark, SF))
    assert "WindowGroupLimit" in text


@pytest.mark.parametrize("block_rows", [None, 100])
def test_windows_over_a_stored_series_need_no_shuffle(spark, tmp_path, block_rows):
    from leadtide.operators.windows import lead_targets
    from leadtide.sources.stores import read_series, write_series

    df, layout = worked.hourly(spark, SF, block_rows)
    assert layout.blocked == (block_rows is not None)
    name = f"stored_{block_rows or 'whole'}"
    write_series(df, layout, name, str(tmp_path / "s"), ahead=7)
    rows, known = read_series(spark, name, str(tmp_path / "s"))
    targets = lead_targets(rows, known, (1, 7))
    assert "Exchange" not in plan(targets) and "Window" in plan(targets)
    assert sorted(map(repr, targets.collect())) == sorted(map(repr, lead_targets(df, layout, (1, 7)).select(targets.columns).collect()))
    if block_rows:
        with pytest.raises(ValueError, match="copied"):
            lead_targets(rows, known, (8,))
    spark.sql(f"DROP TABLE {name}")
