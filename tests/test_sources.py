import csv

import pytest
from pyspark.errors import PySparkException

from shelftide.operators import checks, cleaning
from shelftide.params import OutputParams
from shelftide.schemas import RAW_SCHEMA
from shelftide.sources import sinks
from shelftide.sources.sales_csv import read_sales_csv, read_sales_csv_quarantined
from shelftide.sources.shared import fresh_path, shared_folder

LINE = ["2022-01-01", "S001", "P0001", "Toys", "North", "231", "127", "55", "135.47", "33.5", "20", "Rainy", "0", "29.69", "Autumn"]


def write(path, *lines, header=RAW_SCHEMA.names):
    with open(path, "w", newline="") as f:
        csv.writer(f).writerows([header, *lines])
    return str(path)


def changed(position, value):
    return [value if i == position else v for i, v in enumerate(LINE)]


def test_reads_declared_types(spark, tmp_path):
    df = read_sales_csv(spark, write(tmp_path / "a.csv", LINE))
    assert df.columns == RAW_SCHEMA.names
    assert [t for _, t in df.dtypes] == [f.dataType.simpleString() for f in RAW_SCHEMA.fields]
    assert cleaning.clean(df).first().units_sold == 127


@pytest.mark.parametrize("position, value", [(6, "5.5"), (0, "01/02/2022"), (8, "many")])
def test_a_malformed_value_fails_the_read(spark, tmp_path, position, value):
    df = read_sales_csv(spark, write(tmp_path / "a.csv", LINE, changed(position, value)))
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        df.collect()


def test_a_header_in_another_order_fails_the_read(spark, tmp_path):
    header = [RAW_SCHEMA.names[1], RAW_SCHEMA.names[0], *RAW_SCHEMA.names[2:]]
    with pytest.raises(Exception, match="header does not conform"):
        read_sales_csv(spark, write(tmp_path / "a.csv", LINE, header=header)).collect()


def test_an_empty_field_is_null_and_found_by_the_quality_report(spark, tmp_path):
    cleaned = cleaning.clean(read_sales_csv(spark, write(tmp_path / "a.csv", LINE, changed(6, ""))))
    with pytest.raises(checks.SchemaValidationError, match="units_sold not_null: 1 of 2"):
        checks.require_quality(checks.quality_report(cleaned))


def test_quarantine_keeps_good_rows_and_shows_bad_lines(spark, tmp_path):
    bad = changed(6, "5.5")
    rows, malformed = read_sales_csv_quarantined(spark, write(tmp_path / "a.csv", LINE, bad))
    assert rows.count() == 1 and rows.columns == RAW_SCHEMA.names
    assert [r.line for r in malformed.collect()] == [",".join(bad)]
    assert rows.select("Region").count() == malformed.count() == 1


def test_quarantine_refuses_a_header_in_another_order(spark, tmp_path):
    names = list(RAW_SCHEMA.names)
    names[6], names[7] = names[7], names[6]
    with pytest.raises(Exception, match="header|Header"):
        read_sales_csv_quarantined(spark, write(tmp_path / "a.csv", LINE, header=names))[0].collect()


def test_missing_file(spark, tmp_path):
    with pytest.raises(PySparkException):
        read_sales_csv(spark, str(tmp_path / "none.csv")).count()


def test_both_formats_round_trip(spark, tmp_path, scored):
    df = scored(("Toys", 10, 12.0, 9.25), ("Toys", 3, None, 0.0))
    written = sinks.write_forecast(df, str(tmp_path))
    assert set(written) == {"parquet", "csv"} and written["csv"].endswith("demand_forecast.csv")
    for back in (spark.read.parquet(written["parquet"]), read_sales_csv(spark, written["csv"], df.schema)):
        assert back.columns == df.columns
        assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()


def test_inventory_is_in_entity_order_across_files(spark, tmp_path):
    df = spark.range(300).selectExpr("concat('S', id % 3) AS store_id", "concat('P', 999 - id) AS product_id", "id").repartition(5)
    written = sinks.write_inventory(df, str(tmp_path))
    parts = sorted((tmp_path / "inventory_recommendations.csv").glob("part-*.csv"))
    lines = [line for p in parts for line in p.read_text().splitlines()[1:]]
    assert len(lines) == 300 and lines == sorted(lines) and len(parts) >= 1
    assert spark.read.parquet(written["parquet"]).count() == 300


def test_format_switches(tmp_path, scored):
    df = scored(("Toys", 10, 12.0, 9.25))
    only = sinks.write_forecast(df, str(tmp_path), OutputParams(write_parquet=False))
    assert set(only) == {"csv"} and not (tmp_path / "demand_forecast.parquet").exists()
    with pytest.raises(ValueError, match="no output format"):
        sinks.write_forecast(df, str(tmp_path), OutputParams(write_parquet=False, write_csv=False))


def test_writing_again_overwrites(spark, tmp_path, scored):
    for n in (1, 2):
        path = sinks.write_parquet(scored(*[("Toys", 1, 1.0, 1.0)] * n), str(tmp_path / "t"))
    assert spark.read.parquet(path).count() == 2


def test_partitioned_stage_keeps_types_and_order(spark, tmp_path):
    df = spark.createDataFrame([("007", 1, "a"), ("010", 2, "b")], "store_id string, n int, x string")
    back = sinks.stage(df, str(tmp_path / "t"), ["store_id"])
    assert back.dtypes == df.dtypes
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()
    assert sorted(p.name for p in (tmp_path / "t").glob("store_id=*")) == ["store_id=007", "store_id=010"]


def test_shared_folder_is_the_one_the_session_names(spark):
    folder = shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    first, second = fresh_path(spark, "x"), fresh_path(spark, "x")
    assert first != second and first.startswith(folder)
