"""Named queries over the star tables, one per operator.

Each takes (spark, folder of Parquet tables) and returns a DataFrame over the whole
tables. Doubles whose last digits depend on the order of addition are rounded to six
places here, at the comparison boundary; the operators themselves do not round.

Tree forecasts cannot be written in SQL, so the queries downstream of a forecast use one
that can: the shipped forecast floored at 0, or the target seven rows earlier.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelftide.operators import boosting, checks, cleaning, encoding, evaluation, features, inventory, modelling, splitting
from shelftide.params import FeatureParams, Settings, SplitParams, TreeParams
from shelftide.plans.full_run import run_from_csv
from shelftide.schemas import CLEAN_SCHEMA, PREDICTION_COLUMNS
from shelftide.sources import sinks
from shelftide.sources.sales_csv import read_sales_csv, read_sales_csv_quarantined
from shelftide.sources.shared import fresh_path
from shelftide.sources.star_tables import STAR_ENCODING, many_series_panel, raw_panel, sale_lines

Query = Callable[[SparkSession, str], DataFrame]

# Few trees, of the published depth and settings otherwise. The library default is 300; the README has a run of those.
SMALL_TREES = TreeParams(n_estimators=10, learning_rate=0.2)
MODEL_SETTINGS = Settings(encoding=STAR_ENCODING, trees=SMALL_TREES)
KEYS = ("date", "store_id", "product_id")
ROLLING_28 = FeatureParams(rolling=(28,))


def rounded(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def rounded_like(df: DataFrame, *prefixes: str, digits: int = 6) -> DataFrame:
    return rounded(df, [c for c in df.columns if c.startswith(prefixes)], digits)


# Inputs shared by the queries


def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean(raw_panel(spark, folder))


def encoded(spark: SparkSession, folder: str) -> DataFrame:
    return encoding.encode(cleaned(spark, folder), STAR_ENCODING)


def feature_frame(spark: SparkSession, folder: str) -> DataFrame:
    """The panel is staged: ids and features read it each, and the order lines are added up once."""
    rows = sinks.stage(cleaned(spark, folder), fresh_path(spark, "cleaned"))
    return features.feature_table(rows, STAR_ENCODING)


def scored_baseline(spark: SparkSession, folder: str) -> DataFrame:
    """The shipped forecast, floored at 0, as the forecast."""
    return modelling.clip_prediction(cleaned(spark, folder), raw="demand_forecast").select(*PREDICTION_COLUMNS)


def scored_last_week(spark: SparkSession, folder: str) -> DataFrame:
    """The target seven rows earlier, else 0, as the forecast."""
    lagged = features.add_lags(cleaned(spark, folder), FeatureParams(lags=(7,)))
    return lagged.withColumn("predicted_units_sold", F.coalesce("lag_7", F.lit(0.0))).select(*PREDICTION_COLUMNS)


def recommendations(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.recommend(scored_baseline(spark, folder), cleaned(spark, folder))


# Sources and sinks


def scan_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = sinks.write_csv(raw_panel(spark, folder), fresh_path(spark, "raw_csv"))
    return read_sales_csv(spark, path)


def scan_csv_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Rows with a discount of 7 are written with a word for the discount; rows and rejected
    lines come back apart."""
    panel = raw_panel(spark, folder)
    broken = F.when(F.col("Discount") == 7, "seven").otherwise(F.col("Discount").cast("string"))
    path = sinks.write_csv(panel.withColumn("Discount", broken), fresh_path(spark, "raw_csv"))
    rows, lines = read_sales_csv_quarantined(spark, path)
    good = rows.select(F.lit("row").alias("kind"), F.col("Date").cast("string").alias("date"), F.col("Store ID").alias("store_id"), F.col("Product ID").alias("product_id"))
    fields = F.split("line", ",")
    bad = lines.select(F.lit("reject").alias("kind"), fields[0].alias("date"), fields[1].alias("store_id"), fields[2].alias("product_id"))
    return good.unionByName(bad)


def load_audit(spark: SparkSession, folder: str) -> DataFrame:
    return checks.load_audit(raw_panel(spark, folder))


def sink_parquet(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(sinks.write_parquet(cleaned(spark, folder), fresh_path(spark, "cleaned")))


def sink_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = sinks.write_csv(cleaned(spark, folder), fresh_path(spark, "cleaned_csv"))
    return read_sales_csv(spark, path, CLEAN_SCHEMA)


def write_forecast(spark: SparkSession, folder: str) -> DataFrame:
    scored = scored_baseline(spark, folder)
    written = sinks.write_forecast(scored, fresh_path(spark, "predictions"))
    return read_sales_csv(spark, written["csv"], scored.schema)


def write_inventory(spark: SparkSession, folder: str) -> DataFrame:
    written = sinks.write_inventory(recommendations(spark, folder), fresh_path(spark, "predictions"))
    return spark.read.parquet(written["parquet"])


def metrics_json(spark: SparkSession, folder: str) -> DataFrame:
    metrics = evaluation.evaluate(scored_last_week(spark, folder))
    return spark.read.schema(metrics.schema).json(sinks.write_json(metrics, fresh_path(spark, "metrics")))


def stage_features(spark: SparkSession, folder: str) -> DataFrame:
    staged = sinks.stage(feature_frame(spark, folder), fresh_path(spark, "features"), ["store_id"])
    return rounded_like(staged, "rolling_")


def training_metadata(spark: SparkSession, folder: str) -> DataFrame:
    facts = modelling.training_metadata(cleaned(spark, folder), Settings(), use_baseline=True)
    parameters = F.array_sort(F.transform(F.map_entries("model_parameters"), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return facts.withColumns(
        {
            "feature_columns": F.array_join("feature_columns", ","),
            "parameters_not_applied": F.array_join("parameters_not_applied", ","),
            "model_parameters": F.array_join(parameters, ","),
        }
    )


# Cleaning and checks


def anomaly_count(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.anomaly_count(cleaned(spark, folder))


def drop_negative_sales(spark: SparkSession, folder: str) -> DataFrame:
    """On sales net of returns, which are negative on days with more returns than sales."""
    net = cleaned(spark, folder).withColumn("units_sold", 2 * F.col("units_sold") - F.col("units_ordered"))
    return cleaning.drop_negative(net)


def quality_report(spark: SparkSession, folder: str) -> DataFrame:
    return checks.quality_report(cleaned(spark, folder))


def domain_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Against the default value lists, whose region names are not those of the tables."""
    return checks.domain_violations(cleaned(spark, folder))


def duplicate_grain(spark: SparkSession, folder: str) -> DataFrame:
    return checks.duplicate_grain(sale_lines(spark, folder), KEYS)


def latest_ties(spark: SparkSession, folder: str) -> DataFrame:
    return checks.latest_ties(sale_lines(spark, folder))


def unmatched_entities(spark: SparkSession, folder: str) -> DataFrame:
    """Products of a store that were not sold there before the holdout."""
    lines = sale_lines(spark, folder)
    before, _ = splitting.time_split(lines)
    return checks.unmatched_entities(lines, before)


# Encoding


def encode_fixed(spark: SparkSession, folder: str) -> DataFrame:
    labels = STAR_ENCODING.label_outputs
    return encoding.encode_labels(cleaned(spark, folder), STAR_ENCODING).select(*KEYS, *labels, *labels.values())


def encode_dynamic(spark: SparkSession, folder: str) -> DataFrame:
    df = cleaned(spark, folder)
    dimensions = encoding.id_dimensions(df, STAR_ENCODING)
    return encoding.encode_ids(df, dimensions).select(*KEYS, *STAR_ENCODING.id_outputs.values())


def encode_dynamic_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """The path for many ids, taken here for every product of the order lines. Lines are
    added up per store and product before the labels are joined."""
    params = encoding.EncodingParams(labels=STAR_ENCODING.labels, broadcast_ids=0)
    totals = (
        sale_lines(spark, folder)
        .groupBy("store_id", "product_id")
        .agg(F.count(F.lit(1)).alias("line_count"), F.sum("units_ordered").alias("units_ordered"))
    )
    return encoding.encode_ids(totals, encoding.id_dimensions(totals, params))


def encode_null_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The path for many ids on lines that lack the store, the product or both."""
    params = encoding.EncodingParams(labels=STAR_ENCODING.labels, broadcast_ids=0)
    units = F.col("units_ordered")
    lines = sale_lines(spark, folder).withColumns(
        {"store_id": F.when(units % 7 != 0, F.col("store_id")), "product_id": F.when(units % 3 != 0, F.col("product_id"))}
    )
    totals = lines.groupBy("store_id", "product_id").agg(F.count(F.lit(1)).alias("line_count"))
    return encoding.encode_ids(totals, encoding.id_dimensions(totals, params))


def one_hot(spark: SparkSession, folder: str) -> DataFrame:
    df = encoding.one_hot(cleaned(spark, folder), STAR_ENCODING.labels)
    return df.select(*KEYS, *[c for c in df.columns if "_is_" in c])


# Features


def _with_keys(df: DataFrame, *prefixes: str) -> DataFrame:
    return df.select(*KEYS, *[c for c in df.columns if c.startswith(prefixes)])


def lag_features(spark: SparkSession, folder: str) -> DataFrame:
    return _with_keys(features.add_lags(cleaned(spark, folder)), "lag_", "units_sold")


def rolling_features(spark: SparkSession, folder: str) -> DataFrame:
    return rounded_like(_with_keys(features.add_rolling(cleaned(spark, folder)), "rolling_"), "rolling_")


def rolling_large(spark: SparkSession, folder: str) -> DataFrame:
    """Targets of up to two thousand million, whose squares do not add up in 64 bits."""
    large = (F.col("units_sold").cast("bigint") * 7919000 % 2000000000 + 100000000).cast("int")
    df = features.add_rolling(cleaned(spark, folder).withColumn("units_sold", large))
    return rounded_like(_with_keys(df, "rolling_"), "rolling_", digits=3)


def rolling_past(spark: SparkSession, folder: str) -> DataFrame:
    df = features.add_rolling(cleaned(spark, folder), FeatureParams(include_current=False))
    return rounded_like(_with_keys(df, "rolling_"), "rolling_")


def rolling_minmax(spark: SparkSession, folder: str) -> DataFrame:
    return _with_keys(features.add_rolling(cleaned(spark, folder), stats=("min", "max")), "rolling_")


def rolling_calendar(spark: SparkSession, folder: str) -> DataFrame:
    df = features.add_calendar_rolling(cleaned(spark, folder), stats=("mean", "std", "min", "max"))
    return rounded_like(_with_keys(df, "rolling_"), "rolling_")


def lag_calendar(spark: SparkSession, folder: str) -> DataFrame:
    return _with_keys(features.add_calendar_lags(cleaned(spark, folder)), "lag_")


def calendar_features(spark: SparkSession, folder: str) -> DataFrame:
    df = features.add_calendar(cleaned(spark, folder))
    return df.select(*KEYS, *df.columns[len(CLEAN_SCHEMA) :])


def price_features(spark: SparkSession, folder: str) -> DataFrame:
    df = features.add_prices(cleaned(spark, folder))
    return df.select(*KEYS, *df.columns[len(CLEAN_SCHEMA) :])


def all_features(spark: SparkSession, folder: str) -> DataFrame:
    return rounded_like(feature_frame(spark, folder), "rolling_")


# Split and model


def cutoff_date(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.cutoff_date(cleaned(spark, folder))


def percentile_split(spark: SparkSession, folder: str) -> DataFrame:
    """Cutoff at the 80th percentile date, with the rows on both sides."""
    return splitting.split_counts(cleaned(spark, folder), SplitParams(rule="percentile"))


def time_split(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.with_holdout(cleaned(spark, folder)).select(*KEYS, "units_sold", "is_holdout")


def split_counts(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.split_counts(cleaned(spark, folder))


def model_projection(spark: SparkSession, folder: str) -> DataFrame:
    return rounded_like(modelling.project(feature_frame(spark, folder), use_baseline=True), "rolling_")


def clip_prediction(spark: SparkSession, folder: str) -> DataFrame:
    return modelling.clip_prediction(cleaned(spark, folder), raw="demand_forecast").select(
        *KEYS, "demand_forecast", "predicted_units_sold"
    )


def _staged_features(spark: SparkSession, folder: str) -> DataFrame:
    return sinks.stage(feature_frame(spark, folder), fresh_path(spark, "features"))


def train_gbt(spark: SparkSession, folder: str) -> DataFrame:
    """Validation error after each tree, for both variants."""
    staged = _staged_features(spark, folder)
    fitted = [modelling.train(staged, MODEL_SETTINGS, use_baseline=b) for b in (False, True)]
    fair, enhanced = [m.validation.withColumn("model_variant", F.lit(m.variant)) for m in fitted]
    return fair.unionByName(enhanced)


def predict_gbt(spark: SparkSession, folder: str) -> DataFrame:
    """Saved, loaded and applied to every row."""
    staged = _staged_features(spark, folder)
    models = fresh_path(spark, "models")
    modelling.save_model(modelling.train(staged, MODEL_SETTINGS), models)
    return modelling.predict(staged, modelling.load_model(spark, models))


def fit_stump(spark: SparkSession, folder: str) -> DataFrame:
    """One tree of one split on the discount, without subsampling: saved, loaded and applied. The
    best split and the two means can be computed in SQL."""
    trees = TreeParams(n_estimators=1, max_depth=1, learning_rate=1.0, subsample=1.0, colsample_bytree=1.0, min_child_weight=1)
    rows = sinks.stage(cleaned(spark, folder).select("discount", "units_sold"), fresh_path(spark, "stump_rows"))
    path = fresh_path(spark, "stump")
    modelling.estimator(["discount"], Settings(trees=trees)).fit(rows).write().save(path)
    scored = PipelineModel.load(path).transform(rows)
    return rounded(scored.select("discount", F.col("raw_prediction").alias("prediction")).distinct(), ["prediction"])


def fit_trees(spark: SparkSession, folder: str) -> DataFrame:
    """Two trees of two levels with both penalties over features of few values, two of them absent in places: trained, saved,
    loaded, compiled and applied to all rows. Every step can be written in SQL."""
    trees = TreeParams(n_estimators=2, max_depth=2, learning_rate=0.3, subsample=1.0, colsample_bytree=1.0, min_child_weight=5)
    rows = feature_frame(spark, folder).select(
        *KEYS, "units_sold", "discount", "month", F.floor(F.col("lag_28") / 25).alias("lag_band"), F.floor("price_to_competitor_ratio").alias("ratio_band")
    )
    rows = sinks.stage(rows, fresh_path(spark, "tree_rows"))
    names = ("discount", "month", "lag_band", "ratio_band")
    model, _ = boosting.boost(rows, None, names, "units_sold", KEYS, trees, seed=1)
    path = sinks.write_parquet(boosting.node_table(spark, model), fresh_path(spark, "trees"))
    raw = boosting.scored(rows, boosting.from_nodes(spark.read.parquet(path), names), "raw_prediction")
    return modelling.clip_prediction(raw).select(*KEYS, "predicted_units_sold")


def full_run(spark: SparkSession, folder: str) -> DataFrame:
    """Every step from a CSV file to all written outputs, with a trained model; returns the rows that
    are in the files of each output. Those of the report are its figures over all rows and of every category."""
    source = sinks.write_csv(raw_panel(spark, folder), fresh_path(spark, "raw_csv"))
    paths = run_from_csv(spark, source, fresh_path(spark, "run"), MODEL_SETTINGS, use_baseline=True, run_id="catalog")
    report = spark.read.schema("`global` string, by_category map<string, string>").json(paths["metrics"])
    files = {
        "forecast_csv": spark.read.option("header", True).csv(paths["forecast"]["csv"]),
        "forecast_parquet": spark.read.parquet(paths["forecast"]["parquet"]),
        "inventory_csv": spark.read.option("header", True).csv(paths["inventory"]["csv"]),
        "inventory_parquet": spark.read.parquet(paths["inventory"]["parquet"]),
        "metrics": report.select(F.explode(F.concat(F.array("global"), F.map_values("by_category"))).alias("figures")).where("figures IS NOT NULL"),
        **{name: spark.read.parquet(paths[name]) for name in ("errors", "stockouts", "summary")},
    }
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("artefact"), "row_count") for name, df in files.items()]
    return reduce(DataFrame.unionByName, counts)


# Evaluation and inventory


def evaluate(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.evaluate(scored_last_week(spark, folder))


def evaluate_by_category(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.evaluate_by_category(scored_last_week(spark, folder))


def stockout_rate(spark: SparkSession, folder: str) -> DataFrame:
    rates = evaluation.stockout_rate(scored_last_week(spark, folder))
    return rounded_like(rates, "model_stockout_pct", "baseline_stockout_pct", "stockout_pct")


def forecast_errors(spark: SparkSession, folder: str) -> DataFrame:
    return rounded_like(evaluation.forecast_errors(scored_last_week(spark, folder)), "model_abs", "baseline_abs")


def demand_stats(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.demand_stats(scored_baseline(spark, folder))


def latest_inventory(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.latest_stock(cleaned(spark, folder))


def inventory_policy(spark: SparkSession, folder: str) -> DataFrame:
    """Policy for every day of every series, on the demand of the last 28 rows."""
    df = features.add_rolling(cleaned(spark, folder), ROLLING_28).select(
        *KEYS,
        F.col("rolling_mean_28").alias("avg_daily_demand"),
        F.coalesce("rolling_std_28", F.lit(0.0)).alias("demand_std_dev"),
        F.col("inventory_level").alias("current_inventory_level"),
    )
    return inventory.apply_policy(df)


def recommend(spark: SparkSession, folder: str) -> DataFrame:
    return recommendations(spark, folder)


def run_summary(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.run_summary(scored_baseline(spark, folder), recommendations(spark, folder))


def demand_stats_moving(spark: SparkSession, folder: str) -> DataFrame:
    """Large forecasts of entities that change their category and region every month."""
    turn = F.month("date") % 3
    moved = scored_baseline(spark, folder).withColumns(
        {
            "category": F.concat("category", turn.cast("string")),
            "region": F.concat("region", (turn % 2).cast("string")),
            "predicted_units_sold": F.col("predicted_units_sold") + 1e8,
        }
    )
    return inventory.demand_stats(moved)


# The same operators over a series per store and part


def many_series(spark: SparkSession, folder: str) -> DataFrame:
    return sinks.stage(many_series_panel(spark, folder), fresh_path(spark, "many_series"))


def _scored_many(panel: DataFrame) -> DataFrame:
    return modelling.clip_prediction(panel, raw="demand_forecast").select(*PREDICTION_COLUMNS)


def lag_many_series(spark: SparkSession, folder: str) -> DataFrame:
    return _with_keys(features.add_lags(many_series(spark, folder)), "lag_", "units_sold")


def rolling_many_series(spark: SparkSession, folder: str) -> DataFrame:
    return rounded_like(_with_keys(features.add_rolling(many_series(spark, folder)), "rolling_"), "rolling_")


def demand_stats_many_series(spark: SparkSession, folder: str) -> DataFrame:
    stats = inventory.demand_stats(_scored_many(many_series(spark, folder)))
    return stats


def latest_inventory_many_series(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.latest_stock(many_series(spark, folder))


def recommend_many_series(spark: SparkSession, folder: str) -> DataFrame:
    panel = many_series(spark, folder)
    return inventory.recommend(_scored_many(panel), panel)


def encode_many_series(spark: SparkSession, folder: str) -> DataFrame:
    panel = many_series(spark, folder)
    return encoding.encode_ids(panel, encoding.id_dimensions(panel, STAR_ENCODING)).select(*KEYS, *STAR_ENCODING.id_outputs.values())


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        scan_csv,
        load_audit,
        sink_parquet,
        sink_csv,
        write_forecast,
        write_inventory,
        metrics_json,
        stage_features,
        training_metadata,
        anomaly_count,
        drop_negative_sales,
        quality_report,
        domain_violations,
        duplicate_grain,
        latest_ties,
        unmatched_entities,
        encode_fixed,
        encode_dynamic,
        encode_dynamic_ranges,
        one_hot,
        lag_features,
        rolling_features,
        rolling_past,
        rolling_minmax,
        rolling_calendar,
        lag_calendar,
        calendar_features,
        price_features,
        all_features,
        cutoff_date,
        percentile_split,
        time_split,
        split_counts,
        model_projection,
        clip_prediction,
        train_gbt,
        predict_gbt,
        full_run,
        evaluate,
        evaluate_by_category,
        stockout_rate,
        forecast_errors,
        demand_stats,
        latest_inventory,
        inventory_policy,
        recommend,
        run_summary,
        scan_csv_quarantine,
        encode_null_ids,
        rolling_large,
        fit_stump,
        fit_trees,
        demand_stats_moving,
        lag_many_series,
        rolling_many_series,
        demand_stats_many_series,
        latest_inventory_many_series,
        recommend_many_series,
        encode_many_series,
    )
}
QUERIES |= {"clean": cleaned, "encode": encoded}
