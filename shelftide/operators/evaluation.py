"""Model forecast and shipped baseline against what was sold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelftide.functions.errors import DECIMALS, error_sums, improvement, mae, mape, rmse, with_totals
from shelftide.functions.exact import round_columns
from shelftide.operators.checks import require_columns
from shelftide.params import PanelColumns

MEASURES = ("rmse", "mae", "mape")


def _sums_by_scope(scored: DataFrame, panel: PanelColumns, sums: dict[str, Column]) -> DataFrame:
    """Sums per category in one pass over the rows, then per category and over all of them.
    Rows without a category count in the total only."""
    per_category = scored.groupBy(F.col(panel.category).alias("category")).agg(
        *[c.alias(name) for name, c in sums.items()]
    )
    return (
        per_category.rollup("category")
        .agg(F.grouping("category").alias("is_total"), *[F.sum(name).alias(name) for name in sums])
        .filter((F.col("is_total") == 1) | F.col("category").isNotNull())
        .withColumn("scope", F.when(F.col("is_total") == 1, "global").otherwise("category"))
    )


def _valid_baseline(panel: PanelColumns) -> Column:
    return F.coalesce(F.col(panel.baseline) >= 0, F.lit(False))


def evaluate(scored: DataFrame, panel: PanelColumns = PanelColumns()) -> DataFrame:
    """RMSE, MAE and MAPE of model and baseline with their difference, overall (scope
    ``global``) and per category (scope ``category``).

    The baseline is measured where it is not negative; the model on all rows. Undefined
    measures are NULL. For the holdout alone, filter the scored rows first.
    """
    require_columns(scored, [panel.target, panel.prediction, panel.baseline, panel.category], "evaluate")
    actual = F.col(panel.target).cast("double")
    valid = _valid_baseline(panel)
    sums = {
        "total_rows": F.count(F.lit(1)),
        "baseline_anomaly_rows": F.count_if(~valid),
        **error_sums("model", actual, F.col(panel.prediction)),
        **error_sums("baseline", actual, F.col(panel.baseline), valid),
    }
    totals = with_totals(_sums_by_scope(scored, panel, sums), ("model", "baseline"))
    figures = totals.select(
        "scope",
        "category",
        "total_rows",
        F.col("model_rows").alias("model_eval_rows"),
        F.col("baseline_rows").alias("baseline_eval_rows"),
        "baseline_anomaly_rows",
        F.col("model_zero").alias("mape_excluded_rows_model"),
        F.col("baseline_zero").alias("mape_excluded_rows_baseline"),
        *[
            measure(side).alias(f"{side}_{name}")
            for side in ("model", "baseline")
            for name, measure in zip(MEASURES, (rmse, mae, mape))
        ],
    )
    figures = round_columns(figures, [f"{side}_{m}" for side in ("model", "baseline") for m in MEASURES], DECIMALS)
    deltas = figures.withColumns({f"{m}_delta": improvement(m) for m in MEASURES})
    return round_columns(deltas, [f"{m}_delta" for m in MEASURES], DECIMALS)


def evaluate_by_category(scored: DataFrame, panel: PanelColumns = PanelColumns()) -> DataFrame:
    """The category lines of ``evaluate`` in category order."""
    return evaluate(scored, panel).filter(F.col("scope") == "category").drop("scope").orderBy("category")


def stockout_rate(
    scored: DataFrame, panel: PanelColumns = PanelColumns(), valid_baseline_only: bool = False
) -> DataFrame:
    """Share of rows (percent) whose forecast is below the actual sales, for model and
    baseline, and the difference in percentage points; overall and per category."""
    require_columns(scored, [panel.target, panel.prediction, panel.baseline, panel.category], "stock-out rate")
    actual, model, baseline = F.col(panel.target), F.col(panel.prediction), F.col(panel.baseline)
    counted = _valid_baseline(panel) if valid_baseline_only else F.lit(True)
    sums = {
        "total_rows": F.count(F.lit(1)),
        "model_rows": F.count(model - actual),
        "model_stockouts": F.count_if(model < actual),
        "baseline_rows": F.count(F.when(counted, baseline - actual)),
        "baseline_stockouts": F.count_if(counted & (baseline < actual)),
    }
    rates = _sums_by_scope(scored, panel, sums).select(
        "scope",
        "category",
        *sums,
        *[
            (100 * F.try_divide(f"{side}_stockouts", f"{side}_rows")).alias(f"{side}_stockout_pct")
            for side in ("model", "baseline")
        ],
    )
    return rates.withColumn(
        "stockout_pct_difference", F.col("model_stockout_pct") - F.col("baseline_stockout_pct")
    )


def forecast_errors(scored: DataFrame, panel: PanelColumns = PanelColumns()) -> DataFrame:
    """Per row: the forecasts under their published names and their absolute errors."""
    actual = F.col(panel.target)
    return scored.select(
        *panel.entity,
        panel.category,
        panel.region,
        F.col(panel.date).alias("forecast_date"),
        panel.prediction,
        actual.alias("actual_units_sold"),
        F.col(panel.baseline).alias("dataset_demand_forecast"),
        F.abs(F.col(panel.prediction) - actual).alias("model_absolute_error"),
        F.abs(F.col(panel.baseline) - actual).alias("baseline_absolute_error"),
    )


def report_lines(metrics: DataFrame) -> DataFrame:
    """The metric table as JSON text, one nested document per scope, with the time."""

    def group(prefix: str, suffix: str = "") -> Column:
        return F.struct(*[F.col(f"{prefix}{m}{suffix}").alias(f"{m}{suffix}") for m in MEASURES])

    document = F.struct(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("evaluation_timestamp"),
        "scope",
        "category",
        F.struct(
            "total_rows",
            "model_eval_rows",
            "baseline_eval_rows",
            "baseline_anomaly_rows",
            "mape_excluded_rows_model",
            "mape_excluded_rows_baseline",
        ).alias("row_counts"),
        group("model_").alias("model"),
        group("baseline_").alias("baseline"),
        group("", "_delta").alias("improvement"),
    )
    return metrics.select(F.to_json(document, {"ignoreNullFields": "false"}).alias("value"))


ROW_COUNTS = (
    "total_rows",
    "model_eval_rows",
    "baseline_eval_rows",
    "baseline_anomaly_rows",
    "mape_excluded_rows_model",
    "mape_excluded_rows_baseline",
)


def report_document(metrics: DataFrame) -> DataFrame:
    """One row of JSON text for the whole report: the time, the counts and figures over all rows, and under
    ``by_category`` those of every category in order. Categories are few and configured; each is one row here."""

    def figures() -> list[Column]:
        parts = (("model", "model_", ""), ("baseline", "baseline_", ""), ("improvement", "", "_delta"))
        return [F.struct(*[F.col(f"{before}{m}{after}").alias(f"{m}{after}") for m in MEASURES]).alias(name) for name, before, after in parts]

    whole = F.col("scope") == "global"
    group = F.struct(*ROW_COUNTS, *figures())
    folded = metrics.agg(
        F.max(F.when(whole, F.struct(*ROW_COUNTS))).alias("row_counts"),
        F.max(F.when(whole, F.struct(*figures()))).alias("global"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(~whole, F.struct("category", group.alias("group")))))).alias("by_category"),
    )
    time = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("evaluation_timestamp")
    return folded.select(F.to_json(F.struct(time, "row_counts", "global", "by_category"), {"ignoreNullFields": "false"}).alias("value"))
