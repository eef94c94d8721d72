import pytest
from conftest import day
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelftide.operators import encoding
from shelftide.params import LABEL_VALUES, EncodingParams, Settings

MANY = EncodingParams(broadcast_ids=0)


def test_labels_follow_the_configured_order(cleaned):
    values = LABEL_VALUES["category"]
    df = cleaned(*[{"category": v, "date": day(i)} for i, v in enumerate([*values, "Garden", None])])
    labels = [r.category_encoded for r in encoding.encode_labels(df).orderBy("date").collect()]
    assert labels == [0, 1, 2, 3, 4, None, None]
    assert dict(encoding.encode_labels(df).dtypes)["category_encoded"] == "int"


@pytest.mark.parametrize("params", [EncodingParams(), MANY], ids=["few", "many"])
def test_id_label_is_the_rank_of_the_id(cleaned, params):
    df = cleaned({"store_id": "S003"}, {"store_id": "S001", "date": day(1)}, {"store_id": "S001", "date": day(2)})
    # S002 does not occur, so S003 is the second id.
    labels = {r.store_id: r.store_id_encoded for r in encoding.encode(df, params).collect()}
    assert labels == {"S003": 1, "S001": 0}


@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_ranking_by_ranges_equals_dense_rank(spark, ranges):
    ids = spark.range(500).select(F.concat(F.lit("P"), F.col("id") * 37 % 211).alias("product_id"))
    got = encoding._rank_by_ranges(encoding._distinct_ids(ids, "product_id"), "product_id", "label", ranges)
    expected = ids.distinct().withColumn("label", F.dense_rank().over(Window.orderBy("product_id")) - 1)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    assert dict(got.dtypes)["label"] == "int"


def test_both_id_paths_agree(cleaned):
    df = cleaned(*[{"store_id": f"S{i % 7:03d}", "product_id": f"P{i % 11:04d}", "date": day(i)} for i in range(80)])
    few, many = encoding.encode(df), encoding.encode(df, MANY)
    assert few.columns == many.columns
    assert few.exceptAll(many).isEmpty() and many.exceptAll(few).isEmpty()


def test_a_null_id_leaves_the_other_label_alone_on_both_paths(cleaned):
    df = cleaned({"store_id": "S1"}, {"store_id": "S2", "product_id": "P2"})
    gaps = df.selectExpr("*").withColumns(
        {"store_id": F.when(F.col("product_id") != "P2", F.col("store_id")), "product_id": F.when(F.col("store_id") != "S1", F.col("product_id"))}
    )
    gaps = gaps.unionByName(df)
    few, many = encoding.encode(gaps), encoding.encode(gaps, MANY)
    assert few.exceptAll(many).isEmpty() and many.exceptAll(few).isEmpty()
    got = {(r.store_id, r.product_id): (r.store_id_encoded, r.product_id_encoded) for r in many.collect()}
    assert got["S1", None] == (0, None) and got[None, "P2"] == (None, 1)


@pytest.mark.parametrize("params", [EncodingParams(), MANY], ids=["few", "many"])
def test_unseen_id_keeps_its_row_without_a_label(cleaned, params):
    known = encoding.id_dimensions(cleaned({}), params)
    rows = encoding.encode(cleaned({}, {"store_id": "S009"}), params, known).collect()
    assert {r.store_id: r.store_id_encoded for r in rows} == {"S001": 0, "S009": None}
    assert {r.product_id_encoded for r in rows} == {0}


def test_encode_appends_six_columns(cleaned):
    df = cleaned({})
    out = encoding.encode(df)
    assert out.columns[:16] == df.columns and len(out.columns) == 22
    assert out.columns[16:] == [
        "category_encoded", "region_encoded", "weather_encoded", "seasonality_encoded",
        "store_id_encoded", "product_id_encoded",
    ]


def test_one_hot_drops_the_last_value(cleaned):
    df = cleaned({"region": "East"}, {"region": "West", "date": day(1)}, {"region": None, "date": day(2)})
    out = encoding.one_hot(df, {"region": LABEL_VALUES["region"]}).orderBy("date")
    assert out.columns[16:] == ["region_is_east", "region_is_north", "region_is_south"]
    assert [tuple(r)[16:] for r in out.collect()] == [(1, 0, 0), (0, 0, 0), (0, 0, 0)]
    assert "region_is_west" in encoding.one_hot(df, {"region": LABEL_VALUES["region"]}, drop_last=False).columns


def test_missing_label_list_is_an_error():
    with pytest.raises(KeyError, match="seasonality"):
        Settings.from_mapping({"encoding": {"category": {"values": ["A"]}, "region": {"values": ["B"]},
                                            "weather_condition": {"values": ["C"]}}})


def test_settings_from_a_config_mapping():
    got = Settings.from_mapping({
        "feature_engineering": {"lag_windows": [2], "rolling_windows": [3], "enable_price_features": False},
        "training": {"holdout_days": 5, "random_seed": 1},
        "model": {"xgboost": {"n_estimators": 9, "max_depth": 2}},
        "inventory": {"lead_time_days": 1, "order_cycle_days": 2, "service_level_z": 1.28},
        "output": {"write_csv": False},
    })
    assert got.features.lags == (2,) and got.features.rolling == (3,) and not got.features.price
    assert (got.split.holdout_days, got.split.seed) == (5, 1)
    assert (got.trees.n_estimators, got.trees.max_depth, got.trees.learning_rate) == (9, 2, 0.05)
    assert got.policy.service_level_z == 1.28 and not got.output.write_csv and got.output.write_parquet
    assert Settings.from_mapping({}) == Settings()
    with pytest.raises(ValueError, match="positive"):
        Settings.from_mapping({"feature_engineering": {"lag_windows": [0]}})
