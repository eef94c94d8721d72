"""Every query with a SQL counterpart gives exactly its result; plans keep their shape."""

import re

import pytest

import __spark_entry__ as entry_module
from compare import differences, duck
from shelftide.operators import encoding, features, inventory
from shelftide.plans import catalog
from shelftide.plans.catalog import QUERIES
from shelftide.plans.sql import SQL
from shelftide.params import LABEL_VALUES, EncodingParams, FeatureParams
from shelftide.sources import sinks
from shelftide.sources.star_tables import STAR_ENCODING, STAR_REGIONS

FOLDER = "/root/testdata/sf0.001"
MANY = EncodingParams(labels={**LABEL_VALUES, "region": STAR_REGIONS}, broadcast_ids=0)


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_result_as_sql(spark, con, name):
    assert differences(QUERIES[name](spark, FOLDER), con, SQL[name]) == []


def test_only_tree_models_lack_sql():
    assert set(QUERIES) - set(SQL) == {"train_gbt", "predict_gbt"}


def test_entry(spark):
    assert entry_module.entry(spark).count() == 100
    assert entry_module.queries().keys() >= entry_module.oracle_sql().keys()


@pytest.mark.parametrize("name, rows", [("predict_gbt", 5910), ("full_run", 8)])
def test_model_queries(spark, name, rows):
    assert QUERIES[name](spark, FOLDER).count() == rows


def test_the_full_run_counts_the_figures_of_its_report(spark):
    found = {r.artefact: r.row_count for r in QUERIES["full_run"](spark, FOLDER).collect()}
    assert found["metrics"] == found["stockouts"] == len(LABEL_VALUES["category"]) + 1


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df) -> list[str]:
    return re.findall(r"Exchange (\w+)", plan(df))


def test_features_read_the_staged_panel_and_no_order_lines(spark):
    assert "lineitem" not in plan(catalog.feature_frame(spark, FOLDER))


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    return sinks.stage(catalog.cleaned(spark, FOLDER), str(tmp_path_factory.mktemp("staged") / "t"))


@pytest.mark.parametrize("running, windows", [(True, 2), (False, 1)])
def test_features_take_one_shuffle_and_one_sort(staged, running, windows):
    df = features.build_features(encoding.encode_labels(staged), FeatureParams(running_sums=running))
    assert shuffles(df) == ["hashpartitioning"]
    assert (plan(df).count("+- Window "), plan(df).count("+- Sort ")) == (windows, 1)


@pytest.mark.parametrize("params", [STAR_ENCODING, MANY], ids=["few", "many"])
def test_windows_first_gives_the_same_table(staged, params):
    dims = encoding.id_dimensions(staged, params)
    plain = features.build_features(encoding.encode(staged, params, dims))
    table = features.feature_table(staged, params, dimensions=dims)
    assert table.dtypes == plain.dtypes
    assert table.exceptAll(plain).isEmpty() and plain.exceptAll(table).isEmpty()


def test_few_ids_are_joined_without_moving_rows(staged):
    df = encoding.encode_ids(staged, encoding.id_dimensions(staged))
    moved = [s for s in shuffles(df) if s == "hashpartitioning"]
    # One distinct per id column; the rows themselves stay where they are.
    assert len(moved) == 2 and "SortMergeJoin" not in plan(df)


def test_many_ids_share_the_shuffle_of_the_windows(spark, staged):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dims = encoding.id_dimensions(staged, MANY)
        with_ids = features.feature_table(staged, MANY, dimensions=dims)
        ids_alone = encoding.encode_ids(staged, dims)
        # Labels are joined null-safely, on other keys than the windows: one shuffle more.
        assert len(shuffles(with_ids)) == len(shuffles(ids_alone)) + 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filters_on_entities_reach_the_scan(staged):
    text = plan(features.add_lags(staged).filter("store_id = 'S001'"))
    assert "EqualTo(store_id,S001)" in text


def test_stock_and_demand_are_aggregated_before_the_shuffle_without_sorting_rows(spark):
    scored = catalog.scored_baseline(spark, FOLDER)
    text = plan(inventory.latest_stock(catalog.cleaned(spark, FOLDER)))
    assert "SortAggregate" not in text and "partial_max_by" in text
    # Rows go through a hash aggregate; only the few groups per entity are sorted.
    below = plan(inventory.demand_stats(scored)).split("SortAggregate")[-1]
    assert "HashAggregate" in below and "partial_sum(" in below
