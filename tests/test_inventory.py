import statistics

import pytest
from conftest import day

from shelftide.functions.stock import service_level_percent
from shelftide.operators import inventory
from shelftide.params import PolicyParams


def entity(spark, mean, std, stock):
    return spark.createDataFrame(
        [(mean, std, stock)], "avg_daily_demand double, demand_std_dev double, current_inventory_level int"
    )


def test_policy_figures(spark):
    r = inventory.apply_policy(entity(spark, 10.0, 2.0, 50)).first()
    assert (r.safety_stock, r.reorder_point, r.target_stock_level) == (8.7310, 78.7310, 308.7310)
    assert (r.recommended_order_qty, r.days_of_supply, r.reorder_recommendation) == (258.7310, 5.0, True)
    assert (r.lead_time_days, r.order_cycle_days, r.service_level_z) == (7, 30, 1.65)


def test_enough_stock(spark):
    r = inventory.apply_policy(entity(spark, 1.0, 0.0, 400)).first()
    assert (r.recommended_order_qty, r.reorder_recommendation) == (0.0, False)


def test_stock_at_the_reorder_point_is_flagged(spark):
    assert inventory.apply_policy(entity(spark, 10.0, 0.0, 70)).first().reorder_recommendation is True
    assert inventory.apply_policy(entity(spark, 10.0, 0.0, 71)).first().reorder_recommendation is False


def test_no_demand_has_no_days_of_supply(spark):
    assert inventory.apply_policy(entity(spark, 0.0, 0.0, 70)).first().days_of_supply is None


def test_longer_cycle_never_lowers_the_target(spark):
    r = inventory.apply_policy(entity(spark, 3.0, 1.0, 0), PolicyParams(lead_time_days=5, order_cycle_days=5)).first()
    assert r.reorder_point == r.target_stock_level


def test_demand_stats(scored):
    df = scored(
        ("Toys", 1, 1.0, 2.0, "S001", "P0001", 1),
        ("Clothing", 1, 1.0, 7.0, "S001", "P0001", 0),
        ("Toys", 1, 1.0, 3.0, "S001", "P0001", 2),
        ("Toys", 1, 1.0, 5.0, "S002", "P0001", 0),
        ("Toys", 1, 1.0, 5.0, None, "P0001", 0),
    )
    got = {r.store_id: r for r in inventory.demand_stats(df).collect()}
    assert set(got) == {"S001", "S002"}
    # The first category in date order, although the category changes.
    assert got["S001"].category == "Clothing"
    assert got["S001"].avg_daily_demand == pytest.approx(4.0)
    assert got["S001"].demand_std_dev == pytest.approx(statistics.stdev([2, 7, 3]))
    assert (got["S002"].avg_daily_demand, got["S002"].demand_std_dev) == (5.0, 0.0)


def test_latest_stock_ignores_row_order(cleaned):
    df = cleaned({"date": day(2), "inventory_level": 7}, {"date": day(5), "inventory_level": 9}, {"date": day(1)})
    assert [r.inventory_level for r in inventory.latest_stock(df).collect()] == [9]


def test_recommend_drops_and_counts_entities_without_stock(scored, cleaned):
    forecasts = scored(("Toys", 1, 1.0, 4.0, "S001", "P0001", 0), ("Toys", 1, 1.0, 4.0, "S002", "P0001", 0))
    out = inventory.recommend(forecasts, cleaned({}))
    assert len(out.columns) == 16
    assert [(r.store_id, r.current_inventory_level) for r in out.collect()] == [("S001", 100)]
    assert inventory.unmatched_count(forecasts, cleaned({})).first().unmatched == 1


def test_recommend_orders_by_entity(scored, cleaned):
    keys = [("S002", "P0001"), ("S001", "P0002"), ("S001", "P0001")]
    forecasts = scored(*[("Toys", 1, 1.0, 4.0, s, p, 0) for s, p in keys])
    stock = cleaned(*[{"store_id": s, "product_id": p} for s, p in keys])
    assert [(r.store_id, r.product_id) for r in inventory.recommend(forecasts, stock).collect()] == sorted(keys)


def test_two_latest_rows_raise(scored, cleaned):
    forecasts = scored(("Toys", 1, 1.0, 4.0))
    tied = cleaned({}, {"inventory_level": 5})
    with pytest.raises(Exception, match="more than one latest stock row, for example S001"):
        inventory.recommend(forecasts, tied).collect()
    assert inventory.recommend(forecasts, tied, check_ties=False).count() == 1


def test_deviation_of_large_forecasts_over_two_categories(scored):
    values = [1e8 + x for x in (0.0, 0.5, 1.0, 1.5, 0.25, 0.75, 1.25, 0.1, 0.9, 1.4)]
    rows = scored(*[("Toys" if i % 2 else "Books", 1, 1.0, v) for i, v in enumerate(values)])
    got = inventory.demand_stats(rows).first()
    assert got.demand_std_dev == pytest.approx(statistics.stdev(values), rel=1e-6)
    assert got.avg_daily_demand == pytest.approx(statistics.mean(values), rel=1e-12)


def test_missing_column_is_named(scored, cleaned):
    with pytest.raises(ValueError, match="region"):
        inventory.recommend(scored(("Toys", 1, 1.0, 4.0)).drop("region"), cleaned({}))


def test_service_level():
    assert service_level_percent(1.65) == pytest.approx(95.05, abs=0.01)
    assert service_level_percent(0.0) == 50.0


def test_run_summary(scored, cleaned):
    forecasts = scored(("Toys", 1, 1.0, 4.0), ("Toys", 1, 1.0, 6.0))
    lines = inventory.run_summary(forecasts, inventory.recommend(forecasts, cleaned({}))).collect()
    got = {(r.subject, r.measure): r.value for r in lines}
    assert got["category_rows", "Toys"] == 2.0
    assert (got["forecast", "min"], got["forecast", "max"], got["forecast", "mean"]) == (4.0, 6.0, 5.0)
    assert (got["entities", "count"], got["entities", "mean_daily_demand"]) == (1.0, 5.0)
