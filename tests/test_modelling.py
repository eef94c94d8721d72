import math
import random

import pytest
from conftest import day

from shelftide.operators import boosting, modelling, splitting
from shelftide.operators.checks import DuplicateGrainError
from shelftide.operators.encoding import encode, id_dimensions
from shelftide.operators.features import build_features
from shelftide.params import FeatureParams, PanelColumns, Settings, SplitParams, TreeParams
from shelftide.plans.full_run import run, run_from_csv
from shelftide.schemas import PREDICTION_COLUMNS, RAW_TO_CLEAN
from shelftide.sources import sinks

SETTINGS = Settings(split=SplitParams(holdout_days=10), trees=TreeParams(n_estimators=4, max_depth=3, learning_rate=0.3))


def panel_rows(days=50):
    pick = random.Random(3)
    return [
        {"store_id": f"S00{s}", "product_id": f"P000{p}", "date": day(d), "units_sold": 20 * s + d % 7 + pick.randint(0, 3),
         "demand_forecast": 20.0 * s + d % 7, "inventory_level": 100 + d}
        for s in (1, 2) for p in (1, 2) for d in range(days)
    ]


@pytest.fixture(scope="module")
def feature_frame(spark, tmp_path_factory):
    from conftest import ROW
    from shelftide.schemas import CLEAN_SCHEMA

    schema = type(CLEAN_SCHEMA)([type(f)(f.name, f.dataType, True) for f in CLEAN_SCHEMA.fields])
    df = spark.createDataFrame([tuple({**ROW, **c}[n] for n in schema.names) for c in panel_rows()], schema)
    return sinks.stage(build_features(encode(df)), str(tmp_path_factory.mktemp("features") / "t"))


@pytest.fixture(scope="module")
def fair(feature_frame):
    return modelling.train(feature_frame, SETTINGS)


def test_cutoff_and_split(feature_frame):
    r = splitting.cutoff_date(feature_frame, SETTINGS.split).first()
    assert (r.last_date, r.cutoff_date) == (day(49), day(39))
    train, holdout = splitting.time_split(feature_frame, SETTINGS.split)
    assert (train.count(), holdout.count()) == (160, 40)
    assert train.intersect(holdout).isEmpty()
    counts = splitting.split_counts(feature_frame, SETTINGS.split).first()
    assert (counts.cutoff_date, counts.train_rows, counts.holdout_rows) == (day(39), 160, 40)


def test_rows_without_a_date_are_in_neither_part(cleaned):
    df = cleaned({"date": None}, {"date": day(0)}, {"date": day(30)})
    params = SplitParams(holdout_days=5)
    train, holdout = splitting.time_split(df, params)
    assert (train.count(), holdout.count()) == (1, 1)
    flags = {r.date: r.is_holdout for r in splitting.with_holdout(df, params).collect()}
    assert flags == {None: None, day(0): False, day(30): True}


def test_percentile_cutoff(cleaned):
    df = cleaned(*[{"date": day(i)} for i in range(11)], {"date": None})
    params = SplitParams(rule="percentile")
    assert splitting.cutoff_date(df, params).first().cutoff_date == day(8)
    train, holdout = splitting.time_split(df, params)
    assert (train.count(), holdout.count()) == (9, 2)
    with pytest.raises(ValueError, match="unknown split rule"):
        SplitParams(rule="random")


def test_training_with_the_percentile_rule(feature_frame):
    settings = Settings(split=SplitParams(rule="percentile"), trees=TreeParams(n_estimators=1, max_depth=2))
    facts = modelling.train(feature_frame, settings).metadata.first()
    assert (facts.split_rule, facts.cutoff_date) == ("percentile", day(39))
    assert (facts.train_row_count, facts.val_row_count) == (160, 40)


def test_feature_lists():
    assert len(modelling.feature_columns()) == 31
    enhanced = modelling.feature_columns(use_baseline=True)
    assert enhanced[:-1] == modelling.feature_columns() and enhanced[-1] == "demand_forecast"


def test_projection_has_each_column_once(feature_frame):
    out = modelling.project(feature_frame, use_baseline=True)
    assert len(out.columns) == len(set(out.columns)) == 38
    assert out.columns.index("demand_forecast") == 6
    with pytest.raises(ValueError, match="lag_7"):
        modelling.project(feature_frame.drop("lag_7"))


def test_training_reports_each_tree(fair):
    rows = fair.validation.orderBy("iteration").collect()
    assert [r.iteration for r in rows] == [1, 2, 3, 4]
    assert all(r.validation_rmse > 0 for r in rows)
    assert rows[-1].validation_rmse < rows[0].validation_rmse
    facts = fair.metadata.first()
    assert (facts.train_row_count, facts.val_row_count, facts.feature_count) == (160, 40, 31)
    assert facts.model_parameters["n_estimators"] == "4" and facts.model_variant == "fair"
    assert facts.parameters_not_applied == []


def test_prediction_covers_every_row_and_is_not_negative(feature_frame, fair):
    out = modelling.predict(feature_frame, fair)
    assert tuple(out.columns) == PREDICTION_COLUMNS
    assert out.count() == 200
    assert out.filter("predicted_units_sold IS NULL OR predicted_units_sold < 0").isEmpty()


def test_clip(spark):
    df = spark.createDataFrame([(-2.0,), (0.0,), (3.5,), (None,)], "raw_prediction double")
    assert [r.predicted_units_sold for r in modelling.clip_prediction(df).collect()] == [0.0, 0.0, 3.5, None]


def test_saved_model_predicts_the_same(spark, feature_frame, fair, tmp_path):
    ids = id_dimensions(feature_frame)
    modelling.save_model(fair, str(tmp_path), ids)
    back = modelling.load_model(spark, str(tmp_path))
    assert back.features == fair.features
    assert back.metadata.first().cutoff_date == day(39)
    before, after = modelling.predict(feature_frame, fair), modelling.predict(feature_frame, back)
    assert before.exceptAll(after).isEmpty()
    again = modelling.load_id_dimensions(spark, str(tmp_path), False)
    assert sorted(map(tuple, again["store_id"].frame.collect())) == [("S001", 0), ("S002", 1)]


def test_a_model_is_applied_by_its_own_features_and_names(spark, feature_frame, tmp_path):
    """Other lags than the default, on renamed columns, after saving and loading."""
    panel = PanelColumns(target="sold", prediction="expected")
    renamed = feature_frame.withColumnRenamed("units_sold", "sold")
    own = Settings(panel=panel, features=FeatureParams(lags=(7,), rolling=(7,)), split=SplitParams(holdout_days=10), trees=TreeParams(n_estimators=1, max_depth=2))
    modelling.save_model(modelling.train(renamed, own), str(tmp_path))
    out = modelling.predict(renamed, modelling.load_model(spark, str(tmp_path)))
    assert out.columns[-3:] == ["sold", "demand_forecast", "expected"] and out.count() == 200


def test_unknown_settings_are_named():
    with pytest.raises(ValueError, match="gamma"):
        Settings.from_mapping({"model": {"xgboost": {"gamma": 1}}})
    with pytest.raises(ValueError, match="lead"):
        Settings.from_mapping({"inventory": {"lead": 1}})


def test_missing_model_is_a_clear_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no trained model"):
        modelling.load_model(spark, str(tmp_path / "none"))


def test_holdout_longer_than_the_data(feature_frame):
    with pytest.raises(ValueError, match="training set is empty"):
        modelling.train(feature_frame, Settings(split=SplitParams(holdout_days=50)))


def test_no_holdout(feature_frame):
    model = modelling.train(feature_frame, Settings(split=SplitParams(holdout_days=0), trees=TreeParams(n_estimators=1, max_depth=2)))
    assert model.validation.isEmpty()


def test_absent_features_are_scored(feature_frame, fair):
    from pyspark.sql import functions as F

    unknown = feature_frame.withColumns({"lag_1": F.lit(None).cast("double"), "store_id_encoded": F.lit(None).cast("int"),
                                         "rolling_mean_7": F.lit(math.nan)})
    assert modelling.predict(unknown, fair).filter("predicted_units_sold IS NULL").isEmpty()


def test_stamp(scored):
    r = modelling.stamp(scored(("Toys", 1, 1.0, 1.0)), "run-1", "v1").first()
    assert (r.run_id, r.model_version) == ("run-1", "v1") and r.generated_at is not None


def raw_rows(cleaned):
    df = cleaned(*panel_rows(30))
    back = {v: k for k, v in RAW_TO_CLEAN.items()}
    df = df.withColumn("is_holiday_or_promo", df.is_holiday_or_promo.cast("int"))
    return df.drop("is_forecast_anomaly").withColumnsRenamed(back)


def test_run_from_csv_writes_everything(spark, cleaned, tmp_path):
    source = sinks.write_csv(raw_rows(cleaned), str(tmp_path / "raw"))
    paths = run_from_csv(spark, source, str(tmp_path / "out"), SETTINGS, use_baseline=True)
    assert set(paths) == {"model", "metrics", "forecast", "inventory", "errors", "stockouts", "summary", "quality"}
    assert spark.read.parquet(paths["forecast"]["parquet"]).count() == 120
    advice = spark.read.parquet(paths["inventory"]["parquet"])
    assert advice.count() == 4 and len(advice.columns) == 16
    assert spark.read.text(paths["metrics"]).count() == 1
    assert "enhanced" in paths["model"]


def test_variants_share_a_folder(cleaned, tmp_path):
    raw = raw_rows(cleaned)
    small = Settings(split=SplitParams(holdout_days=10), trees=TreeParams(n_estimators=1, max_depth=2))
    fair, enhanced = (run(raw, str(tmp_path), small, use_baseline=b) for b in (False, True))
    # The first result can still be read after the second run.
    assert fair.recommendations.count() == enhanced.recommendations.count() == 4
    assert fair.metrics.filter("scope = 'global'").first().total_rows == 120
    assert fair.stockouts.count() == 2 and fair.summary.count() == 11
    assert fair.model_path != enhanced.model_path


def test_run_stops_on_a_repeated_day(cleaned, tmp_path):
    raw = raw_rows(cleaned)
    with pytest.raises(DuplicateGrainError):
        run(raw.unionAll(raw.limit(1)), str(tmp_path), SETTINGS)


# Histogram trees


def tree_frame(spark, rows, features=("a", "b")):
    return spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, " + ", ".join(f"{f} double" for f in features) + ", y double")


def boosted(df, features=("a", "b"), holdout=None, **more):
    settings = {"n_estimators": 1, "max_depth": 1, "learning_rate": 1.0, "subsample": 1.0, "colsample_bytree": 1.0, "min_child_weight": 1, "reg_alpha": 0.0, "reg_lambda": 0.0, **more}
    return boosting.boost(df, holdout, features, "y", ["k"], TreeParams(**settings), seed=3)


def predictions(df, model):
    return [r.p for r in boosting.scored(df, model, "p").orderBy("k").collect()]


def test_absent_values_go_where_they_gain_more(spark):
    rows = [(1.0, None, 0.0), (2.0, None, 0.0), (3.0, None, 10.0), (4.0, None, 10.0), (None, None, 10.0), (math.nan, None, 10.0)]
    df = tree_frame(spark, rows)
    model, _ = boosted(df)
    assert predictions(df, model) == pytest.approx([0, 0, 10, 10, 10, 10], abs=1e-6)
    low = tree_frame(spark, [(a, b, 10.0 - y if a is not None and not math.isnan(a) else 10.0) for a, b, y in rows])
    model, _ = boosted(low)
    assert predictions(low, model) == pytest.approx([10, 10, 0, 0, 10, 10], abs=1e-6)


def test_penalties_shrink_the_leaves(spark):
    df = tree_frame(spark, [(0.0, 0.0, 0.0), (0.0, 0.0, 0.0), (1.0, 0.0, 12.0), (1.0, 0.0, 12.0)])
    assert predictions(df, boosted(df)[0]) == pytest.approx([0, 0, 12, 12], abs=1e-6)
    # Gradients of 12 a side, two rows: (12 - 3) / (2 + 1).
    assert predictions(df, boosted(df, reg_alpha=3.0, reg_lambda=1.0)[0]) == pytest.approx([3, 3, 9, 9])
    assert predictions(df, boosted(df, min_child_weight=3)[0]) == pytest.approx([6, 6, 6, 6])


def test_trees_do_not_depend_on_the_partitioning(spark):
    pick = random.Random(8)
    rows = [(a := pick.random(), pick.choice([None, 1.0, 2.0]), pick.gauss(20 * a, 3)) for _ in range(3000)]
    df = tree_frame(spark, rows)
    found = set()
    for p in (1, 7, 50):
        model, errors = boosted(df.repartition(p), holdout=df.where("k % 5 = 0"), n_estimators=3, max_depth=3, subsample=0.7, colsample_bytree=0.5, max_bins=20)
        found.add(str([(t.feature.tolist(), t.bin.tolist(), t.absent_left.tolist(), t.value.tolist()) for t in model.trees]))
        assert len(errors) == 3 and errors[2] < errors[0]
    assert len(found) == 1


def test_saved_trees_and_their_sql_predict_the_same(spark, tmp_path):
    import duckdb

    pick = random.Random(4)
    df = tree_frame(spark, [(pick.choice([None, *map(float, range(9))]), pick.random(), pick.gauss(0, 9)) for _ in range(500)])
    model, _ = boosted(df, n_estimators=12, max_depth=4, learning_rate=0.3, checkpoint_interval=5)
    path = sinks.write_parquet(boosting.node_table(spark, model), str(tmp_path / "trees"))
    back = boosting.from_nodes(spark.read.parquet(path), model.features)
    want = predictions(df, model)
    assert predictions(df, back) == want
    table = df.toPandas()  # noqa: F841
    con = duckdb.connect()
    con.register("rows", table)
    got = con.execute(f"SELECT {boosting.ensemble_sql(back)} FROM rows ORDER BY k").fetchall()
    assert [r[0] for r in got] == want


def test_trees_without_rows_targets_or_spread(spark):
    empty = tree_frame(spark, [])
    model, errors = boosted(empty, holdout=empty)
    assert model.trees == () and errors == [] and predictions(tree_frame(spark, [(1.0, 1.0, None)]), model) == [0.0]
    flat = tree_frame(spark, [(1.0, 2.0, 4.0), (2.0, 1.0, 4.0), (2.0, 1.0, None)])
    assert predictions(flat, boosted(flat)[0]) == [4.0, 4.0, 4.0]


def test_many_values_have_quantile_cuts(spark):
    df = tree_frame(spark, [(float(k), float(k % 3), float(k)) for k in range(2000)])
    cuts = boosting.find_cuts(df, ["a", "b"], 32)
    assert len(cuts[0]) == 30 and cuts[0][-1] == 1999 and cuts[1].tolist() == [0, 1, 2]
    assert abs(cuts[0][14] - 1000) < 30


def test_unknown_tree_settings_are_errors():
    for wrong in ({"objective": "count:poisson"}, {"tree_method": "exact"}, {"eval_metric": "mae"}, {"max_bins": 500}):
        with pytest.raises(ValueError):
            TreeParams(**wrong)


def test_tasks_of_a_level_are_bounded_by_the_cores(spark, monkeypatch):
    asked, level = [], boosting._level
    monkeypatch.setattr(boosting, "TASK_ROWS", 1)
    monkeypatch.setattr(boosting, "_level", lambda *a: asked.append(a[-1]) or level(*a))
    rows = spark.range(500).selectExpr("id", "id % 7 AS x", "CAST(id % 7 AS DOUBLE) AS y")
    boosting.boost(rows, None, ["x"], "y", ["id"], TreeParams(n_estimators=1, max_depth=1), seed=1)
    assert asked == [boosting.CORE_TASKS * spark.sparkContext.defaultParallelism]
