import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmart import schemas
from starmart.sources import landing, readers
from starmart.sources.sinks import write_report_csv
from tests.conftest import BATCH_1, BATCH_2, as_rows, raw_items, raw_orders


def test_csv_types_and_switch_of_extract(spark, tmp_path):
    header = "base_currency,quote_currency,rate_date,rate\n"
    (tmp_path / "raw_fx_rates.csv").write_text(header + "EUR,USD,2024-06-01,1.077\n")
    (tmp_path / "early.csv").write_text(header + "GBP,USD,2024-06-01,1.2641\n")
    full = readers.read_raw(spark, str(tmp_path), "raw_fx_rates")
    assert full.dtypes[2:] == [("rate_date", "date"), ("rate", "decimal(18,6)")]
    assert as_rows(full) == [("EUR", "USD", date(2024, 6, 1), Decimal("1.077000"))]
    early = readers.read_raw(spark, str(tmp_path), "raw_fx_rates", extract="early")
    assert as_rows(early, "base_currency") == [("GBP",)]


def test_malformed_csv_row_fails(spark, tmp_path):
    text = "base_currency,quote_currency,rate_date,rate\nEUR,USD,yesterday,1.0\n"
    (tmp_path / "raw_fx_rates.csv").write_text(text)
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        readers.read_raw(spark, str(tmp_path), "raw_fx_rates").collect()


def test_fx_json(spark, tmp_path):
    document = {
        "responses": [
            {"base": "USD", "date": "2024-06-01", "rates": {"USD": 1.0, "EUR": 0.9285}},
            {"base": "EUR", "date": "2024-06-01", "rates": {"USD": 1.077}},
        ]
    }
    (tmp_path / "rates.json").write_text(json.dumps(document, indent=2))
    rates = readers.flatten_fx_responses(readers.read_fx_responses(spark, str(tmp_path)))
    assert as_rows(rates) == [
        ("EUR", "USD", date(2024, 6, 1), Decimal("1.077000")),
        ("USD", "EUR", date(2024, 6, 1), Decimal("0.928500")),
        ("USD", "USD", date(2024, 6, 1), Decimal("1.000000")),
    ]
    assert rates.columns == schemas.RAW_FX_RATES.fieldNames()


def test_contract_counts_nulls_of_required_columns(spark):
    items = raw_items(spark, [(1, 1, 1, 1, "1.00", None), (2, None, 1, 1, "1.00", None)])
    found = dict(as_rows(readers.contract_violations(items, schemas.RAW_ORDER_ITEMS)))
    assert found["currency"] == 2 and found["order_id"] == 1 and found["id"] == 0


def test_stamps_and_batch_split(spark):
    orders = raw_orders(spark, [(i, 1, datetime(2024, 1, 1)) for i in (1, 2, 3, 5)])
    items = raw_items(spark, [(i, o, 1, 1, "1.00", "USD") for i, o in enumerate([1, 2, 2, 3, 4, 5])])
    stamped = landing.stamp_loaded_at(orders.drop("_loaded_at"), "id", 2)
    assert as_rows(stamped, "id", "_loaded_at") == [
        (1, BATCH_1), (2, BATCH_1), (3, BATCH_2), (5, BATCH_2)
    ]
    early, lines = landing.first_batch(orders, items, 4)
    assert as_rows(early, "id") == [(1,), (2,), (3,)]
    # order 4 is below the cutoff but has not landed
    assert as_rows(lines, "order_id") == [(1,), (2,), (2,), (3,)]


def test_report_file_is_sorted_and_has_a_header(spark, tmp_path):
    report = spark.range(100).select((99 - F.col("id")).alias("a"), F.lit("x").alias("b"))
    write_report_csv(report, str(tmp_path / "out"), ["a"], [F.col("a")])
    parts = sorted((tmp_path / "out").glob("part-*.csv"))
    lines = [line for p in parts for line in p.read_text().splitlines() if line != "a"]
    assert lines == [str(i) for i in range(100)]
    write_report_csv(report, str(tmp_path / "one"), ["a"], [F.col("a")], one_file=True)
    (only,) = (tmp_path / "one").glob("part-*.csv")
    assert only.read_text().splitlines() == ["a", *map(str, range(100))]
