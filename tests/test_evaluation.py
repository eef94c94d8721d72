import json
import math

import pytest

from shelftide.operators import evaluation


def by_scope(df):
    return {(r.scope, r.category): r for r in df.collect()}


def test_measures_overall_and_per_category(scored):
    df = scored(
        ("Toys", 10, 12.0, 9.0),
        ("Toys", 20, -1.0, 26.0),
        ("Furniture", 0, 1.0, 2.0),
        ("Furniture", 5, None, 5.0),
    )
    got = by_scope(evaluation.evaluate(df))
    assert set(got) == {("global", None), ("category", "Toys"), ("category", "Furniture")}
    total = got["global", None]
    assert (total.total_rows, total.model_eval_rows, total.baseline_eval_rows) == (4, 4, 2)
    assert (total.baseline_anomaly_rows, total.mape_excluded_rows_model, total.mape_excluded_rows_baseline) == (2, 1, 1)
    assert total.model_rmse == round(math.sqrt((1 + 36 + 4 + 0) / 4), 4)
    assert total.model_mae == 2.25
    assert total.model_mape == round(100 * (0.1 + 0.3 + 0.0) / 3, 4)
    assert (total.baseline_rmse, total.baseline_mae, total.baseline_mape) == (1.5811, 1.5, 20.0)
    assert total.rmse_delta == round(1.5811 - total.model_rmse, 4)
    assert got["category", "Toys"].model_rmse == round(math.sqrt(37 / 2), 4)


def test_undefined_measures_are_null(scored):
    got = by_scope(evaluation.evaluate(scored(("Toys", 0, 1.0, 2.0), ("Groceries", 5, -1.0, 4.0))))
    toys, groceries = got["category", "Toys"], got["category", "Groceries"]
    assert toys.model_mape is None and toys.mape_delta is None and toys.mape_excluded_rows_model == 1
    assert (groceries.baseline_rmse, groceries.baseline_mae, groceries.baseline_mape) == (None, None, None)
    assert groceries.rmse_delta is None and groceries.model_rmse == 1.0


def test_rows_without_category_count_in_the_total_only(scored):
    got = by_scope(evaluation.evaluate(scored((None, 1, 1.0, 1.0), ("Toys", 1, 1.0, 1.0))))
    assert set(got) == {("global", None), ("category", "Toys")}
    assert got["global", None].total_rows == 2


def test_categories_come_in_order(scored):
    df = evaluation.evaluate_by_category(scored(("Toys", 1, 1.0, 1.0), ("Clothing", 1, 1.0, 1.0)))
    assert [r.category for r in df.collect()] == ["Clothing", "Toys"]


def test_stockout_is_a_forecast_below_the_sales(scored):
    df = scored(("Toys", 10, 12.0, 9.0), ("Toys", 10, -1.0, 10.0), ("Toys", 10, 9.0, 11.0), ("Toys", 10, 10.0, 3.0))
    total = by_scope(evaluation.stockout_rate(df))["global", None]
    assert (total.model_stockout_pct, total.baseline_stockout_pct, total.stockout_pct_difference) == (50.0, 50.0, 0.0)
    valid = by_scope(evaluation.stockout_rate(df, valid_baseline_only=True))["global", None]
    assert valid.baseline_stockout_pct == pytest.approx(100 / 3)


def test_forecast_errors(scored):
    r = evaluation.forecast_errors(scored(("Toys", 10, 12.5, 9.0))).first()
    assert (r.model_absolute_error, r.baseline_absolute_error, r.actual_units_sold) == (1.0, 2.5, 10)


def test_report_lines_are_nested_json(scored):
    lines = evaluation.report_lines(evaluation.evaluate(scored(("Toys", 0, 1.0, 2.0)))).collect()
    documents = {d["scope"]: d for d in (json.loads(r.value) for r in lines)}
    assert documents["global"]["model"] == {"rmse": 2.0, "mae": 2.0, "mape": None}
    assert documents["global"]["improvement"]["rmse_delta"] == -1.0
    assert documents["global"]["evaluation_timestamp"].startswith("20")
    assert documents["category"]["row_counts"]["total_rows"] == 1


def test_missing_column_is_named(scored):
    with pytest.raises(ValueError, match="predicted_units_sold"):
        evaluation.evaluate(scored(("Toys", 0, 1.0, 2.0)).drop("predicted_units_sold"))
