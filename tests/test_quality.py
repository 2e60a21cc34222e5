import datetime as dt

import pytest
from test_silver import bronze

from candleforge.operators import quality, silver

DAY = dt.date(2024, 3, 1)


def typed(spark, rows):
    return silver.with_audit(
        silver.with_validity(silver.typed(bronze(spark, rows))), "run"
    )


def test_single_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), (None, 3)], "s string, n int")
    assert quality.not_null(df, "n").collect() == [("b", None)]
    assert quality.accepted_values(df, "s", ["a"]).collect() == [("b", None)]
    assert quality.unique(df, "s").collect() == [("a", 2)]
    assert quality.unique(df, "n").collect() == [(1, 2)]
    assert quality.unique_combination(df, ["s", "n"]).collect() == [("a", 1, 2)]


def test_suite_has_25_checks_and_scans_each_table_once_for_row_checks(spark):
    checks = quality.trade_suite(["A"])
    assert len(checks) == 25 and len({c.name for c in checks}) == 25
    df = spark.createDataFrame([("a", 1), ("b", None)], "s string, n int")
    mine = [
        quality.Check("t", "not_null", ("n",)),
        quality.Check("t", "accepted_values", ("s",), ("a",)),
        quality.Check("t", "unique", ("s", "n")),
    ]
    found = {r.check: (r.failing_rows, r.passed) for r in quality.run_suite({"t": df}, mine).collect()}
    assert found == {
        "not_null_t_n": (1, False),
        "accepted_values_t_s": (1, False),
        "unique_t_s_n": (0, True),
    }
    row_checks = quality.run_suite({"t": df}, mine[:2])
    assert row_checks._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1


@pytest.mark.parametrize(
    "cells, broken",
    [
        ({}, []),
        ({"price": ""}, ["price"]),
        ({"price": None, "quantity": ""}, ["price", "quantity"]),
        ({"is_buyer_maker": None}, ["is_buyer_maker"]),
        ({"is_best_match": None}, []),
        ({"symbol": "btc"}, ["symbol"]),
        ({"symbol": "BTC\n"}, ["symbol"]),
        ({"batch_date": None}, ["batch_date"]),
        ({"_ingested_at": "2024-03-01T10:00:00Z"}, []),
        ({"_ingested_at": "noon"}, ["_ingested_at"]),
    ],
)
def test_bronze_contract(spark, cells, broken):
    row = {"_source_file_sha256": "0" * 64, **cells}
    found = quality.bronze_violations(bronze(spark, [row])).collect()
    assert [r.violations for r in found] == ([broken] if broken else [])


def test_silver_contract(spark):
    rows = typed(spark, [{}, {"price": "x"}, {"is_best_match": None}])
    assert [r.violations for r in quality.silver_violations(rows).collect()] == [["price"]]
    assert quality.silver_type_violations(rows.select("*")) == []
    assert quality.silver_type_violations(rows.drop("price")) == ["missing price"]


def test_gates(spark):
    landed = bronze(spark, [{}] * 19 + [{"price": "0"}] + [{"symbol": "ETHX", "price": "0"}] * 2)
    rows = silver.with_validity(silver.typed(landed))
    gate = {r.symbol: (float(r.pct_invalid), r.passed) for r in quality.rejection_gate(rows).collect()}
    assert gate == {"BTCX": (5.0, True), "ETHX": (100.0, False)}
    floor = quality.row_floor_gate(landed, rows.filter("symbol = 'BTCX'")).collect()
    assert {(r.symbol, r.bronze_rows, r.silver_rows, r.passed) for r in floor} == {
        ("BTCX", 20, 20, True), ("ETHX", 2, 0, False),
    }


def test_percent_rounds_half_up(spark):
    rows = silver.with_validity(silver.typed(bronze(spark, [{}] * 799 + [{"price": "0"}])))
    assert str(quality.validity_counts(rows).first().pct_invalid).startswith("0.13")


def test_temporal(spark):
    rows = typed(
        spark,
        [{}, {"transact_time": "1502841600000"}, {"transact_time": "1709337600000"}],
    )
    assert sorted(r.reason for r in quality.temporal_violations(rows).collect()) == [
        "after_batch_day", "before_earliest_day",
    ]


def test_quarantine(spark, folder):
    rows = bronze(
        spark,
        [{"_source_file_sha256": "0" * 64, **cells} for cells in
         ({}, {"price": "n/a"}, {"quantity": None}, {"transact_time": "1.5"})],
    )
    bad = quality.quarantine(rows)
    assert sorted((r.violations, r.malformed) for r in bad.collect()) == [
        ([], ["price"]), ([], ["transact_time"]), (["quantity"], []),
    ]
    for _ in range(2):
        quality.write_quarantine(bad, f"{folder}/bad", "run1")
    assert spark.read.parquet(f"{folder}/bad").count() == 3
