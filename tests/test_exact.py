"""Sums that are the same for any order and partitioning, and rounding of the binary value."""

import json
import math
import random
import statistics
from fractions import Fraction

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelftide.functions import exact
from shelftide.operators import evaluation, inventory

numbers = st.floats(min_value=1e-20, max_value=1e15) | st.floats(min_value=0, max_value=1e3)


def values_frame(spark, values):
    return spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v double")


def limb_sum(df):
    parts = exact.limb_sums("x", F.col("v"))
    return exact.limb_totals(df.agg(*[c.alias(n) for n, c in parts.items()]), ["x"]).first().x


def test_limbs_add_up_exactly(spark):
    pick = random.Random(1)
    for scale in (1e-12, 1.0, 1e9):
        values = [pick.random() * scale * 10 ** pick.randint(0, 8) for _ in range(3000)]
        total = limb_sum(values_frame(spark, values))
        assert abs(Fraction(total) - sum(map(Fraction, values))) <= Fraction(math.ulp(total))


def test_limbs_are_the_same_for_any_partitioning(spark):
    pick = random.Random(2)
    df = values_frame(spark, [pick.random() * 10 ** pick.randint(-9, 9) for _ in range(5000)])
    assert len({limb_sum(df.orderBy(F.rand(p)).repartition(p)) for p in (1, 8, 200)}) == 1
    plain = {df.orderBy(F.rand(p)).repartition(p).agg(F.sum("v")).first()[0] for p in (1, 3, 8, 50, 200)}
    assert len(plain) > 1


def test_numbers_without_limbs(spark):
    assert limb_sum(values_frame(spark, [1.0, math.inf])) == math.inf
    assert math.isnan(limb_sum(values_frame(spark, [1.0, math.nan])))
    assert limb_sum(values_frame(spark, [None])) is None and limb_sum(values_frame(spark, [])) is None
    assert limb_sum(values_frame(spark, [None, 2.5, 1e300])) == 1e300


def test_moments_merge_exactly(spark):
    values = [1e8 + k / 7 for k in range(4000)]
    df = values_frame(spark, values)
    found = set()
    for p in (1, 8, 200):
        groups = df.repartition(p).groupBy((F.col("k") % 13).alias("g")).agg(*[c.alias(n) for n, c in exact.moments(F.col("v")).items()])
        one = groups.agg(*[c.alias(n) for n, c in exact.merged().items()]).select(exact.mean_of(), exact.deviation_of()).first()
        found.add(tuple(one))
    (mean, deviation), = found
    whole = [Fraction(round(v * 10**6), 10**6) for v in values]
    assert mean == pytest.approx(float(sum(whole) / len(whole)), rel=3e-16)
    assert deviation == pytest.approx(statistics.stdev(values), rel=1e-9)


def test_moments_of_few_and_negative_values(spark):
    def figures(values):
        one = values_frame(spark, values).agg(*[c.alias(n) for n, c in exact.moments(F.col("v")).items()])
        return tuple(one.select(exact.mean_of(), exact.deviation_of()).first())

    assert figures([]) == (None, None) and figures([None]) == (None, None) and figures([-2.5]) == (-2.5, None)
    mean, deviation = figures([-3.0, 1.0, -5.5])
    assert mean == -2.5 and deviation == pytest.approx(statistics.stdev([-3.0, 1.0, -5.5]), rel=1e-15)


@settings(max_examples=30, deadline=None)
@given(st.lists(numbers | numbers.map(lambda x: -x), min_size=1, max_size=40))
def test_rounding_of_any_number(spark, values):
    got = exact.round_columns(values_frame(spark, values).orderBy("k"), ["v"]).collect()
    # Numbers whose product with the power of ten has no fraction in 53 bits stay as they are.
    assert [r.v for r in got] == [round(v, 4) if abs(v) * 1e4 < 2**53 else v for v in values]


def test_rounding_of_ties_and_near_ties(spark):
    ties = [0.00015, 0.00025, 0.03125, 0.09375, 2.5, 1.00005, 29.331249999999997, -0.00015, -0.03125, 0.0, 1234567.00005]
    ties += [k / 2**5 + 1e-4 for k in range(64)] + [(2 * k + 1) / 20000 for k in range(400)]
    got = exact.round_columns(values_frame(spark, ties).orderBy("k"), ["v"]).collect()
    assert [r.v for r in got] == [round(v, 4) for v in ties]
    assert got[0].v == 0.0001
    con = duckdb.connect()
    assert [r.v for r in got] == [con.execute(f"SELECT CAST(format('{{:.4f}}', CAST({v!r} AS DOUBLE)) AS DOUBLE)").fetchone()[0] for v in ties]


def test_figures_have_the_same_digits_for_any_partitioning(scored):
    pick = random.Random(3)
    rows = [(pick.choice(["Toys", "Books", "Games"]), pick.randint(0, 50), pick.gauss(20, 9), pick.expovariate(0.05), f"S{k % 7}", f"P{k % 5}", k) for k in range(2000)]
    df = scored(*rows)
    reports = {tuple(sorted(map(str, evaluation.evaluate(df.repartition(p)).collect()))) for p in (1, 8, 200)}
    stats = {tuple(sorted(map(str, inventory.demand_stats(df.repartition(p)).collect()))) for p in (1, 8, 200)}
    assert len(reports) == len(stats) == 1


def test_figures_compile(spark, scored, cleaned):
    """No generated method grows too long, which would leave the figures to interpreted expressions."""
    df = scored(("Toys", 0, 1.0, 2.0), ("Books", 4, 5.0, 2.0))
    spark.conf.set("spark.sql.codegen.fallback", "false")
    spark.conf.set("spark.sql.codegen.factoryMode", "CODEGEN_ONLY")
    try:
        assert evaluation.evaluate(df).count() == 3 and len(evaluation.evaluate(df).collect()) == 3
        advice = inventory.recommend(df, cleaned({}))
        assert len(advice.collect()) == 1 and len(inventory.run_summary(df, advice).collect()) > 5
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")
        spark.conf.unset("spark.sql.codegen.factoryMode")


def test_one_nested_report(scored):
    df = scored(("Toys", 0, 1.0, 2.0), ("Books", 4, 5.0, 2.0), (None, 1, 1.0, 1.0))
    (row,) = evaluation.report_document(evaluation.evaluate(df)).collect()
    report = json.loads(row.value)
    assert list(report) == ["evaluation_timestamp", "row_counts", "global", "by_category"]
    assert report["row_counts"]["total_rows"] == 3 and list(report["by_category"]) == ["Books", "Toys"]
    assert report["by_category"]["Books"]["model"] == {"rmse": 2.0, "mae": 2.0, "mape": 50.0}
    assert report["by_category"]["Toys"]["model"]["mape"] is None and report["by_category"]["Books"]["baseline_eval_rows"] == 1
    assert report["global"]["improvement"].keys() == {"rmse_delta", "mae_delta", "mape_delta"}


def test_report_without_rows(scored):
    report = json.loads(evaluation.report_document(evaluation.evaluate(scored().limit(0))).first().value)
    assert report["by_category"] == {} and report["row_counts"] is None
