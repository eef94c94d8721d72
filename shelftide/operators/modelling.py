"""Boosted-tree demand model: training, metadata, scoring, storage.

Trees grow by second-order histograms (``boosting``): absent values have a learned side, leaves are penalised, columns
are drawn for each tree. The driver sees the cutoff date, row counts, the best cuts of a level and one validation
error per tree. Scoring is a column expression. ``estimator`` is the pipeline of Spark ML's own trees, which has none of
the three and remains for comparison.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from shelftide.operators import boosting
from shelftide.operators.checks import require_columns
from shelftide.operators.encoding import IdDimension
from shelftide.operators.splitting import split_counts
from shelftide.params import FeatureParams, PanelColumns, Settings
from shelftide.sources.shared import shared_folder
from shelftide.sources.sinks import write_json, write_parquet

# Model inputs in training order. Lag and rolling columns follow them, and
# with the baseline variant the shipped forecast comes last.
STATIC_FEATURES: tuple[str, ...] = (
    "inventory_level",
    "units_ordered",
    "price",
    "discount",
    "competitor_pricing",
    "effective_price",
    "price_to_competitor_ratio",
    "has_discount",
    "is_holiday_or_promo",
    "day_of_week",
    "month",
    "week_of_year",
    "quarter",
    "day_of_month",
    "is_weekend",
    "category_encoded",
    "region_encoded",
    "weather_encoded",
    "seasonality_encoded",
    "store_id_encoded",
    "product_id_encoded",
)

# The trees of Spark ML take no NULL or NaN. An absent value becomes this number, and a 0/1
# column next to it says so.
ABSENT = -1.0
VARIANTS = {False: "fair", True: "enhanced"}


def feature_columns(
    use_baseline: bool = False,
    params: FeatureParams = FeatureParams(),
    panel: PanelColumns = PanelColumns(),
) -> list[str]:
    lags = [f"lag_{n}" for n in params.lags]
    rolling = [f"rolling_{stat}_{n}" for n in params.rolling for stat in ("mean", "std")]
    return [*STATIC_FEATURES, *lags, *rolling, *([panel.baseline] if use_baseline else [])]


def variant_name(use_baseline: bool) -> str:
    return VARIANTS[use_baseline]


def project(
    df: DataFrame,
    use_baseline: bool = False,
    params: FeatureParams = FeatureParams(),
    panel: PanelColumns = PanelColumns(),
) -> DataFrame:
    """Keys and features, each column once at its first place."""
    wanted = list(dict.fromkeys([*prediction_keys(panel), *feature_columns(use_baseline, params, panel)]))
    require_columns(df, wanted, "model input")
    return df.select(*wanted)


def _fill_statement(features: Sequence[str]) -> str:
    filled = [f"coalesce(nanvl(CAST(`{c}` AS DOUBLE), NULL), {ABSENT}D) AS `x_{c}`" for c in features]
    absent = [
        f"CAST(`{c}` IS NULL OR isnan(CAST(`{c}` AS DOUBLE)) AS DOUBLE) AS `absent_{c}`"
        for c in features
        if _may_be_absent(c)
    ]
    return f"SELECT *, {', '.join(filled + absent)} FROM __THIS__"


def _may_be_absent(feature: str) -> bool:
    return feature.startswith(("lag_", "rolling_")) or feature.endswith(("_encoded", "_ratio"))


def estimator(features: Sequence[str], settings: Settings = Settings()) -> Pipeline:
    """Spark ML's trees: filling, assembling and boosting as one pipeline, so that they are saved together."""
    trees, panel = settings.trees, settings.panel
    inputs = [f"x_{c}" for c in features] + [f"absent_{c}" for c in features if _may_be_absent(c)]
    return Pipeline(
        stages=[
            SQLTransformer(statement=_fill_statement(features)),
            VectorAssembler(inputCols=inputs, outputCol="features"),
            GBTRegressor(
                featuresCol="features",
                labelCol=panel.target,
                predictionCol="raw_prediction",
                lossType="squared",
                maxIter=trees.n_estimators,
                maxDepth=trees.max_depth,
                stepSize=trees.learning_rate,
                subsamplingRate=trees.subsample,
                featureSubsetStrategy=str(trees.colsample_bytree),
                minInstancesPerNode=trees.min_child_weight,
                maxBins=trees.max_bins,
                checkpointInterval=trees.checkpoint_interval,
                seed=settings.split.seed,
            ),
        ]
    )


@dataclass(frozen=True)
class DemandModel:
    ensemble: boosting.Ensemble
    features: tuple[str, ...]
    use_baseline: bool
    panel: PanelColumns
    # One row; see ``training_metadata``.
    metadata: DataFrame
    # One row per tree: (iteration, validation_rmse); no rows without a holdout.
    validation: DataFrame

    @property
    def variant(self) -> str:
        return variant_name(self.use_baseline)


def training_metadata(
    df: DataFrame, settings: Settings = Settings(), use_baseline: bool = False
) -> DataFrame:
    """One row that says what a model was trained on and how. Lazy: the cutoff and the row
    counts are part of the plan."""
    features = feature_columns(use_baseline, settings.features, settings.panel)
    tree = asdict(settings.trees)
    return split_counts(df, settings.split, settings.panel).select(
        "cutoff_date",
        F.lit(settings.split.rule).alias("split_rule"),
        F.lit(settings.split.holdout_days).alias("holdout_days"),
        F.col("train_rows").alias("train_row_count"),
        F.col("holdout_rows").alias("val_row_count"),
        F.lit(len(features)).alias("feature_count"),
        F.array(*[F.lit(c) for c in features]).alias("feature_columns"),
        F.lit(settings.panel.target).alias("target_column"),
        F.create_map(*[F.lit(x) for k, v in tree.items() for x in (k, str(v))]).alias("model_parameters"),
        F.array().cast("array<string>").alias("parameters_not_applied"),
        F.lit(settings.split.seed).alias("random_seed"),
        F.lit(variant_name(use_baseline)).alias("model_variant"),
        F.lit(use_baseline).alias("use_baseline_feature"),
    )


def _spark_day(value: date):
    return F.lit(value).cast("date")


def train(df: DataFrame, settings: Settings = Settings(), use_baseline: bool = False) -> DemandModel:
    """Fits on the rows up to the cutoff and measures each tree on the rows after it.

    Rows without a target are left out. The input is read twice or three times: pass a staged table, not a plan that
    would compute the windows again each time.
    """
    panel = settings.panel
    features = feature_columns(use_baseline, settings.features, panel)
    require_columns(df, [*features, panel.target, panel.date], "train")
    spark = df.sparkSession
    shared_folder(spark)

    facts = training_metadata(df, settings, use_baseline)
    known = facts.first()
    if not known["train_row_count"]:
        raise ValueError(
            f"training set is empty: no rows up to {known['cutoff_date']} "
            f"({settings.split.holdout_days} holdout days)"
        )
    metadata = spark.createDataFrame([known], facts.schema).withColumn("training_timestamp", F.current_timestamp())

    # The cutoff is a value here, so the date filter reaches the scan of a staged table.
    cutoff = _spark_day(known["cutoff_date"])
    wanted = dict.fromkeys([*panel.grain, panel.target, *features])
    inputs = df.select(*wanted)
    after = inputs.filter(F.col(panel.date) > cutoff) if known["val_row_count"] else None
    ensemble, errors = boosting.boost(
        inputs.filter(F.col(panel.date) <= cutoff), after, features, panel.target, panel.grain, settings.trees, settings.split.seed
    )
    validation = spark.createDataFrame(
        [(i + 1, float(mse) ** 0.5) for i, mse in enumerate(errors)], "iteration int, validation_rmse double"
    )
    return DemandModel(ensemble, tuple(features), use_baseline, panel, metadata, validation)


def clip_prediction(df: DataFrame, raw: str = "raw_prediction", prediction: str = "predicted_units_sold") -> DataFrame:
    """A forecast below 0 becomes 0; a NULL stays NULL."""
    return df.withColumn(prediction, F.when(F.col(raw) < 0, 0.0).otherwise(F.col(raw)))


def prediction_keys(panel: PanelColumns) -> tuple[str, ...]:
    """The key columns of a forecast under the names of the panel."""
    return (*panel.grain, panel.category, panel.region, panel.target, panel.baseline)


def predict(df: DataFrame, model: DemandModel) -> DataFrame:
    """All rows scored: the key columns and the forecast, 0 or more. Lazy, and one narrow projection: the trees are a
    column expression. Features and column names are those the model was trained with."""
    keys = prediction_keys(model.panel)
    wanted = list(dict.fromkeys([*keys, *model.features]))
    require_columns(df, wanted, "predict")
    raw = boosting.scored(df.select(*wanted), model.ensemble, "raw_prediction")
    scored = clip_prediction(raw, prediction=model.panel.prediction)
    return scored.select(*keys, model.panel.prediction)


def stamp(df: DataFrame, run_id: str, model_version: str) -> DataFrame:
    """Adds the run, the model version and the time of writing."""
    return df.withColumns(
        {
            "run_id": F.lit(run_id),
            "model_version": F.lit(model_version),
            "generated_at": F.current_timestamp(),
        }
    )


def model_path(folder: str, use_baseline: bool) -> str:
    return f"{folder}/{variant_name(use_baseline)}_demand_model"


def save_model(
    model: DemandModel, folder: str, dimensions: Mapping[str, IdDimension] | None = None
) -> str:
    """Writes the nodes of the trees, their metadata and validation errors, and the id dimensions."""
    path = model_path(folder, model.use_baseline)
    write_parquet(boosting.node_table(model.metadata.sparkSession, model.ensemble), f"{path}/trees")
    write_json(model.metadata, f"{path}/metadata")
    write_parquet(model.metadata, f"{path}/metadata_table")
    write_parquet(model.validation, f"{path}/validation")
    names = {k: list(v) if isinstance(v, tuple) else v for k, v in asdict(model.panel).items()}
    write_parquet(model.metadata.sparkSession.createDataFrame([Row(**names)]), f"{path}/panel")
    for d in (dimensions or {}).values():
        write_parquet(d.frame.withColumn("small", F.lit(d.small)), f"{path}/ids/{d.column}")
    return path


def load_model(spark: SparkSession, folder: str, use_baseline: bool = False) -> DemandModel:
    path = model_path(folder, use_baseline)
    try:
        metadata = spark.read.parquet(f"{path}/metadata_table")
        validation = spark.read.parquet(f"{path}/validation")
    except AnalysisException as problem:
        raise FileNotFoundError(f"no trained model at {path}; train and save one first") from problem
    features = tuple(metadata.select("feature_columns").first()[0])
    names = spark.read.parquet(f"{path}/panel").first().asDict()
    panel = PanelColumns(**{k: tuple(v) if isinstance(v, list) else v for k, v in names.items()})
    ensemble = boosting.from_nodes(spark.read.parquet(f"{path}/trees"), features)
    return DemandModel(ensemble, features, use_baseline, panel, metadata, validation)


def load_id_dimensions(
    spark: SparkSession, folder: str, use_baseline: bool, settings: Settings = Settings()
) -> dict[str, IdDimension]:
    """The id dimensions saved with a model, for encoding new rows with the same labels."""
    path = model_path(folder, use_baseline)
    found = {}
    for column, output in settings.encoding.id_outputs.items():
        saved = spark.read.parquet(f"{path}/ids/{column}")
        # The size check of training decides here too.
        checked = saved.select("small").first()
        found[column] = IdDimension(column, output, saved.drop("small"), checked is None or checked["small"])
    return found
