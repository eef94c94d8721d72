"""Runs that are taken up again, reports counted by a write, and rows kept by entity."""

import random
import shutil

import pytest
from conftest import day
from test_modelling import panel_rows, raw_rows

from shelftide.operators import checks, cleaning, features, inventory
from shelftide.params import FeatureParams, Settings, SplitParams, TreeParams
from shelftide.plans import full_run
from shelftide.plans.steps import Steps, source_fingerprint
from shelftide.sources import sinks

SMALL = Settings(split=SplitParams(holdout_days=10), trees=TreeParams(n_estimators=2, max_depth=2, learning_rate=0.3))


@pytest.fixture
def source(cleaned, tmp_path):
    return sinks.write_csv(raw_rows(cleaned), str(tmp_path / "raw"))


def read(spark, paths):
    tables = {k: spark.read.parquet(paths[k]) for k in ("errors", "stockouts", "summary", "quality")}
    tables |= {k: spark.read.parquet(paths[k]["parquet"]) for k in ("forecast", "inventory")}
    csv = {f"{k}_csv": spark.read.option("header", True).csv(paths[k]["csv"]) for k in ("forecast", "inventory")}
    report = spark.read.text(paths["metrics"]).first().value
    return {k: sorted(map(str, df.collect())) for k, df in {**tables, **csv}.items()} | {"report": report.split('"row_counts"')[1]}


def test_a_stopped_run_is_taken_up_after_training(spark, source, tmp_path, monkeypatch):
    whole = read(spark, full_run.run_from_csv(spark, source, str(tmp_path / "whole"), SMALL))
    folder = str(tmp_path / "stopped")
    with monkeypatch.context() as m:
        m.setattr(full_run, "predict", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            full_run.run_from_csv(spark, source, folder, SMALL)
    with monkeypatch.context() as m:
        m.setattr(full_run, "train", lambda *a: (_ for _ in ()).throw(AssertionError("trained again")))
        m.setattr(full_run, "feature_table", lambda *a: (_ for _ in ()).throw(AssertionError("features made again")))
        again = read(spark, full_run.run_from_csv(spark, source, folder, SMALL, resume=True))
    assert again == whole


def test_other_settings_or_files_are_made_anew(spark, source, tmp_path):
    from shelftide.sources.sales_csv import read_sales_csv

    folder = str(tmp_path / "out")
    run = lambda settings=SMALL, **more: full_run.run(read_sales_csv(spark, source), folder, settings, **more)
    assert run().reused == ()
    everything = run(resume=True).reused
    assert everything[:2] == ("cleaned", "load_audit") and {"features", "model", "scored", "recommendations"} <= {*everything}
    other = Settings(split=SMALL.split, trees=TreeParams(n_estimators=1, max_depth=2, learning_rate=0.3))
    assert set(run(other, resume=True).reused) == {"cleaned", "load_audit", "quality_report", "anomaly_count", "features"}
    assert run(resume=False).reused == ()
    before = source_fingerprint(read_sales_csv(spark, source))
    rows = read_sales_csv(spark, source)
    sinks.write_csv(rows.limit(50), str(tmp_path / "fewer"))
    shutil.rmtree(source)
    shutil.copytree(tmp_path / "fewer", source)
    spark.catalog.refreshByPath(source)
    assert source_fingerprint(read_sales_csv(spark, source)) != before
    assert run(resume=True).reused == ()


def test_steps_without_a_manifest_are_not_taken(spark, tmp_path):
    steps = Steps(spark, str(tmp_path / "s"), resume=True)
    with pytest.raises(ZeroDivisionError):
        steps.table("a", lambda: 1 / 0)
    one = Steps(spark, str(tmp_path / "s"), resume=True).table("a", lambda: spark.range(3), 1)
    two = Steps(spark, str(tmp_path / "s"), resume=True).table("a", lambda: spark.range(9), 1)
    assert one.count() == two.count() == 3
    assert Steps(spark, str(tmp_path / "s"), resume=True).table("a", lambda: spark.range(9), 2).count() == 9
    assert source_fingerprint(spark.range(3)) != source_fingerprint(spark.range(3))


def test_raw_rows_are_read_once_and_reports_stay_equal(spark, source, tmp_path, monkeypatch):
    from shelftide.sources.sales_csv import read_sales_csv

    raw = cleaning.clean(read_sales_csv(spark, source))
    want = [sorted(map(tuple, f(raw).collect())) for f in (checks.load_audit, checks.quality_report, cleaning.anomaly_count)]
    first = Steps.table

    def then_gone(self, name, *a, **k):
        out = first(self, name, *a, **k)
        if name == "cleaned":
            shutil.rmtree(source)
        return out

    monkeypatch.setattr(Steps, "table", then_gone)
    result = full_run.run(read_sales_csv(spark, source), str(tmp_path / "out"), SMALL)
    assert [sorted(map(tuple, df.collect())) for df in (result.audit, result.quality, result.anomalies)] == want
    assert result.summary.count() == 11


def test_observed_counts_of_a_task_that_fails_once(spark, cleaned, tmp_path):
    """A task of the write that is tried again counts once."""
    rows, counts = checks.observe_rows(cleaned(*panel_rows(30)).repartition(4))
    rows.write.parquet(str(tmp_path / "rows"))
    assert counts.load_audit().first().total_rows == 120
    with pytest.raises(checks.SchemaValidationError, match="price in_range"):
        bad, counts = checks.observe_rows(cleaned({"price": 1.0}))
        bad.write.parquet(str(tmp_path / "bad"))
        checks.require_quality(counts.quality_report())


def test_rows_kept_by_entity_need_no_shuffle(spark, cleaned, tmp_path):
    rows = cleaned(*panel_rows(40))
    kept = sinks.stage_by_entity(rows, "kept_rows", str(tmp_path / "kept"), buckets=4)
    try:
        scored = kept.withColumn("predicted_units_sold", kept.units_sold.cast("double"))
        frames = {
            "lags and rolling": features.add_series_features(kept),
            "rolling extremes": features.add_rolling(kept, FeatureParams(rolling=(7, 365)), stats=("min", "max")),
            "calendar": features.add_calendar_rolling(kept, stats=("mean", "std", "min", "max")),
            "demand": inventory.demand_stats(scored),
            "stock": inventory.latest_stock(kept),
            "both": inventory.demand_stats(scored).join(inventory.latest_stock(kept), ["store_id", "product_id"]),
        }
        for name, df in frames.items():
            plan = df._jdf.queryExecution().executedPlan().toString()
            plain = plan if name != "both" else plan.replace("BroadcastExchange", "")
            assert "Exchange hashpartitioning" not in plain and "Exchange Single" not in plain, name
        spread = features.add_series_features(rows)
        assert frames["lags and rolling"].exceptAll(spread).isEmpty() and spread.exceptAll(frames["lags and rolling"]).isEmpty()
    finally:
        spark.sql("DROP TABLE kept_rows")


@pytest.mark.parametrize("size", [2, 7, 365])
@pytest.mark.parametrize("include_current", [True, False])
def test_block_extremes_equal_walked_frames(cleaned, monkeypatch, size, include_current):
    pick = random.Random(size)
    days = sorted(pick.sample(range(900), 300))
    rows = [{"store_id": f"S{k % 2}", "date": day(d), "units_sold": pick.choice([None, *range(-50, 50)])} for k, d in enumerate(days)]
    df = cleaned(*rows)
    params = FeatureParams(rolling=(size,), include_current=include_current)
    both = []
    for walked in (1000, 1):
        monkeypatch.setattr(features.series, "WALKED", walked)
        out = features.add_rolling(df, params, stats=("min", "max"))
        out = features.add_calendar_rolling(out, params, stats=("min", "max", "mean"))
        both.append((out.columns, sorted(map(str, out.collect()))))
    assert both[0] == both[1]


def test_block_extremes_of_rows_on_one_day(spark, cleaned, monkeypatch):
    df = cleaned({"units_sold": 1}, {"units_sold": 9}, {"date": day(1), "units_sold": 4}, {"date": day(5), "units_sold": 2})
    both = []
    for walked in (1000, 1):
        monkeypatch.setattr(features.series, "WALKED", walked)
        out = features.add_calendar_rolling(df, FeatureParams(rolling=(3,)), stats=("min", "max"))
        both.append(sorted(map(str, out.collect())))
    assert both[0] == both[1]
