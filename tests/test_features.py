import datetime
import random
import statistics

import pytest
from conftest import day

from shelftide.operators import features
from shelftide.operators.encoding import encode
from shelftide.params import FeatureParams

SMALL = FeatureParams(lags=(1, 7), rolling=(7,))


def series(n, store="S001", start=0, skip=()):
    return [{"store_id": store, "date": day(i), "units_sold": start + i} for i in range(n) if i not in skip]


def by_date(df, store="S001"):
    return df.filter(f"store_id = '{store}'").orderBy("date").collect()


def test_lags_and_rolling_on_a_gap_free_series(cleaned):
    df = cleaned(*series(30))
    rows = by_date(features.add_rolling(features.add_lags(df)))
    for i, r in enumerate(rows):
        for n in (1, 7, 14, 28):
            assert r[f"lag_{n}"] == (float(i - n) if i >= n else None)
        for n in (7, 14, 28):
            frame = list(range(max(0, i - n + 1), i + 1))
            assert r[f"rolling_mean_{n}"] == pytest.approx(statistics.mean(frame))
            if len(frame) > 1:
                assert r[f"rolling_std_{n}"] == pytest.approx(statistics.stdev(frame))
            else:
                assert r[f"rolling_std_{n}"] is None


def test_one_row_series(cleaned):
    r = features.add_rolling(features.add_lags(cleaned({"units_sold": 4}))).first()
    assert r.lag_1 is None and r.rolling_mean_7 == 4.0 and r.rolling_std_7 is None


def test_series_do_not_mix_and_row_order_does_not_matter(cleaned):
    rows = [x for pair in zip(series(12), series(12, "S002", start=1000)) for x in pair]
    alone = features.build_features(encode(cleaned(*series(12))), SMALL).select("date", "lag_7", "rolling_mean_7")
    mixed = features.build_features(encode(cleaned(*reversed(rows))), SMALL)
    one = mixed.filter("store_id = 'S001'").select("date", "lag_7", "rolling_mean_7")
    assert alone.exceptAll(one).isEmpty() and one.exceptAll(alone).isEmpty()
    assert by_date(mixed, "S002")[1].lag_1 == 1000.0


def test_frame_without_the_current_row(cleaned):
    past = FeatureParams(rolling=(3,), include_current=False)
    rows = by_date(features.add_rolling(cleaned(*series(6)), past))
    assert [r.rolling_mean_3 for r in rows] == [None, 0.0, 0.5, 1.0, 2.0, 3.0]


@pytest.mark.parametrize("include_current", [True, False])
def test_running_sums_equal_frames(cleaned, include_current):
    pick = random.Random(5)
    rows = [
        {"store_id": f"S{i % 3}", "date": day(i), "units_sold": pick.choice([None, 0, 3, 499, 15_000_000, -7])}
        for i in range(150)
    ]
    df = cleaned(*rows)
    fast, plain = (
        features.add_rolling(df, FeatureParams(rolling=(2, 7, 28), include_current=include_current, running_sums=r))
        for r in (True, False)
    )
    assert fast.columns == plain.columns
    for store in ("S0", "S1", "S2"):
        for a, b in zip(by_date(fast, store), by_date(plain, store)):
            for name in fast.columns[16:]:
                assert a[name] == (None if b[name] is None else pytest.approx(b[name], rel=1e-12, abs=1e-6)), name


@pytest.mark.parametrize("value, days", [(2_000_000_000, 4), (110_000_000, 28), (2**31 - 1, 40), (-(2**31), 40)])
def test_rolling_of_any_32_bit_value(cleaned, value, days):
    """Squares and products beyond 64 bits: exact, like the statistics module."""
    values = [value - (i % 3) * (1 if value > 0 else -1) for i in range(days)]
    df = cleaned(*[{"date": day(i), "units_sold": v} for i, v in enumerate(values)])
    rows = by_date(features.add_rolling(df, FeatureParams(rolling=(28,))))
    for i in (1, days - 1):
        frame = values[max(0, i - 27) : i + 1]
        assert rows[i].rolling_mean_28 == pytest.approx(statistics.mean(frame), rel=1e-15)
        assert rows[i].rolling_std_28 == pytest.approx(statistics.stdev(frame), rel=1e-12)


def test_days_equal_rows_only_without_gaps(cleaned):
    def both(df):
        out = features.add_calendar_rolling(features.add_calendar_lags(features.add_rolling(features.add_lags(df, SMALL), SMALL), SMALL), SMALL)
        return by_date(out)

    for r in both(cleaned(*series(20))):
        assert (r.lag_7, r.rolling_mean_7, r.rolling_std_7) == (r.lag_7d, r.rolling_mean_7d, r.rolling_std_7d)
    gappy = {r.date: r for r in both(cleaned(*series(20, skip=(3, 8, 9))))}
    r = gappy[day(10)]
    assert (r.lag_7, r.lag_7d) == (0.0, None)  # days 0 1 2 4 5 6 7 10
    assert r.rolling_mean_7 == statistics.mean([1, 2, 4, 5, 6, 7, 10])
    assert r.rolling_mean_7d == statistics.mean([4, 5, 6, 7, 10])


def test_min_and_max(cleaned):
    rows = by_date(features.add_rolling(cleaned(*series(10)), SMALL, stats=("min", "max")))
    assert (rows[9].rolling_min_7, rows[9].rolling_max_7) == (3.0, 9.0)


@pytest.mark.parametrize(
    "date, weekday, week, weekend",
    [
        ((2020, 1, 6), 0, 2, False),
        ((2020, 1, 11), 5, 2, True),
        ((2020, 1, 12), 6, 2, True),
        ((2021, 1, 1), 4, 53, False),
        ((2020, 12, 31), 3, 53, False),
    ],
)
def test_calendar(cleaned, date, weekday, week, weekend):
    d = datetime.date(*date)
    r = features.add_calendar(cleaned({"date": d})).first()
    assert (r.day_of_week, r.week_of_year, r.is_weekend) == (weekday, week, weekend)
    assert (r.month, r.day_of_month, r.quarter) == (d.month, d.day, (d.month + 2) // 3)


def test_prices(cleaned):
    df = cleaned(
        {"price": 50.0, "discount": 10, "competitor_pricing": 25.0},
        {"price": 30.0, "discount": 20, "competitor_pricing": 0.0, "date": day(1)},
        {"price": 30.0, "discount": 0, "competitor_pricing": None, "date": day(2)},
    )
    rows = features.add_prices(df).orderBy("date").collect()
    assert [r.effective_price for r in rows] == [45.0, 24.0, 30.0]
    assert [r.price_to_competitor_ratio for r in rows] == [2.0, None, None]
    assert [r.has_discount for r in rows] == [True, True, False]


def test_all_features_append_and_keep_rows(cleaned):
    df = encode(cleaned(*series(9), *series(5, "S002")))
    out = features.build_features(df)
    assert out.columns[:22] == df.columns and len(out.columns) == 41
    assert out.columns[22:26] == ["lag_1", "lag_7", "lag_14", "lag_28"]
    assert out.columns[26:28] == ["rolling_mean_7", "rolling_std_7"]
    assert out.count() == 14
    short = features.build_features(df, FeatureParams(calendar=False, price=False))
    assert len(short.columns) == 32


def test_missing_column_is_named(cleaned):
    with pytest.raises(ValueError, match="units_sold"):
        features.add_lags(cleaned({}).drop("units_sold"))


def test_any_panel_columns(spark):
    from shelftide.params import PanelColumns

    panel = PanelColumns(entity=("site",), date="day", target="load")
    df = spark.createDataFrame([("a", day(i), float(i)) for i in range(4)], "site string, day date, load double")
    rows = features.add_lags(df, FeatureParams(lags=(1,)), panel).orderBy("day").collect()
    assert [r.lag_1 for r in rows] == [None, 0.0, 1.0, 2.0]
