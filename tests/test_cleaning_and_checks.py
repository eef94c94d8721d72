import pytest
from conftest import day

from shelftide.operators import checks, cleaning
from shelftide.schemas import CLEAN_SCHEMA, RAW_SCHEMA, RAW_TO_CLEAN


def raw_of(cleaned_df):
    back = {v: k for k, v in RAW_TO_CLEAN.items()}
    df = cleaned_df.withColumn("is_holiday_or_promo", cleaned_df.is_holiday_or_promo.cast("int"))
    return df.withColumnsRenamed(back).select(*RAW_SCHEMA.names)


def test_clean_renames_casts_orders_and_keeps_every_row(cleaned):
    raw = raw_of(cleaned({"demand_forecast": -0.01}, {"demand_forecast": 0.0, "date": day(1)},
                         {"demand_forecast": None, "date": day(2), "is_holiday_or_promo": True}))
    out = cleaning.clean(raw)
    assert out.columns == CLEAN_SCHEMA.names
    assert dict(out.dtypes)["is_holiday_or_promo"] == "boolean"
    rows = out.orderBy("date").collect()
    assert [r.is_forecast_anomaly for r in rows] == [True, False, None]
    assert [r.is_holiday_or_promo for r in rows] == [False, False, True]
    assert cleaning.anomaly_count(out).first().asDict() == {"total_rows": 3, "anomaly_rows": 1}


def test_clean_names_missing_columns(cleaned):
    with pytest.raises(ValueError, match="Seasonality"):
        cleaning.clean(raw_of(cleaned({})).drop("Seasonality"))


def test_drop_negative_keeps_zero_and_null(cleaned):
    df = cleaned({"units_sold": -1}, {"units_sold": 0}, {"units_sold": None})
    assert {r.units_sold for r in cleaning.drop_negative(df).collect()} == {0, None}


def test_schema_check_reports_type_and_absence(cleaned):
    df = cleaned({})
    checks.require_schema(df)
    broken = df.withColumn("price", df.price.cast("string")).drop("region")
    with pytest.raises(checks.SchemaValidationError, match="region: absent.*price: string, not double"):
        checks.require_schema(broken)


def test_quality_report_counts_nulls_and_ranges(cleaned):
    df = cleaned({"inventory_level": None}, {"inventory_level": 20}, {"price": 5.0}, {"price": 100.0})
    report = {(r.column_name, r.check_name): (r.violations, r.total_rows) for r in checks.quality_report(df).collect()}
    assert report["inventory_level", "not_null"] == (1, 4)
    assert report["inventory_level", "in_range"] == (1, 4)
    assert report["price", "in_range"] == (1, 4)
    assert report["date", "not_null"] == (0, 4)
    with pytest.raises(checks.SchemaValidationError, match="inventory_level not_null: 1 of 4"):
        checks.require_quality(checks.quality_report(df))
    checks.require_quality(checks.quality_report(cleaned({})))


def test_domain_violations(cleaned):
    df = cleaned({"region": "Centre"}, {"region": "Centre"}, {"region": None}, {"seasonality": "Monsoon"})
    found = {(r.column_name, r.value): r.violations for r in checks.domain_violations(df).collect()}
    assert found == {("region", "Centre"): 2, ("seasonality", "Monsoon"): 1}


def test_duplicate_grain(cleaned):
    df = cleaned({}, {}, {"date": day(1)})
    assert [r.row_count for r in checks.duplicate_grain(df).collect()] == [2]
    with pytest.raises(checks.DuplicateGrainError):
        checks.require_unique_grain(df)
    checks.require_unique_grain(df.dropDuplicates())


def test_latest_ties_look_at_the_latest_date_only(cleaned):
    early = cleaned({}, {}, {"date": day(1)})
    late = cleaned({}, {"date": day(1)}, {"date": day(1)})
    assert checks.latest_ties(early).count() == 0
    assert [r.row_count for r in checks.latest_ties(late).collect()] == [2]


def test_unmatched_entities(cleaned):
    demand = cleaned({}, {"store_id": "S002"}, {"store_id": "S002", "date": day(1)}, {"store_id": None})
    assert [tuple(r) for r in checks.unmatched_entities(demand, cleaned({})).collect()] == [("S002", "P0001")]


def test_load_audit(cleaned):
    audit = checks.load_audit(cleaned({}, {})).first()
    assert (audit.total_rows, audit.column_count) == (2, 16)
    assert audit.column_names.startswith("date,store_id,product_id,category")
