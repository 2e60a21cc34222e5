import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from candleforge import schema
from candleforge.functions import parsing
from candleforge.operators import bronze as operators_bronze
from candleforge.operators import silver
from candleforge.sources import tables

DAY = dt.date(2024, 3, 1)
UTC = dt.timezone.utc


def bronze(spark, rows):
    """Rows given as dicts over a good default."""
    default = {
        "agg_trade_id": "1", "price": "10.5", "quantity": "2", "first_trade_id": "1",
        "last_trade_id": "1", "transact_time": "1709251200123", "is_buyer_maker": "true",
        "is_best_match": None, "_source_file_name": "f", "_source_file_sha256": "s",
        "_pipeline_run_id": "r", "_ingested_at": "2024-03-02T00:00:00.000000+00:00",
        "symbol": "BTCX", "batch_date": DAY,
    }
    full = [tuple({**default, **row}[name] for name in schema.BRONZE.names) for row in rows]
    return spark.createDataFrame(full, schema.BRONZE)


def one(spark, **cells):
    return silver.from_bronze(bronze(spark, [cells]), "run").first()


def test_schema_is_the_declared_one(spark):
    assert not schema.schema_differences(
        silver.from_bronze(bronze(spark, [{}]), "run"), schema.SILVER
    )


def test_sub_second_time_is_kept(spark):
    assert one(spark).transact_time == dt.datetime(2024, 3, 1, 0, 0, 0, 123000)


@pytest.mark.parametrize(
    "epoch, unit, want",
    [
        (1709251200123, "auto", "2024-03-01 00:00:00.123"),
        (1709251200123456, "auto", "2024-03-01 00:00:00.123456"),
        (1709251200123, "ms", "2024-03-01 00:00:00.123"),
        (1709251200123456, "us", "2024-03-01 00:00:00.123456"),
        (-1000, "auto", "1969-12-31 23:59:59"),
        (1709251200123456, "ms", None),
        (9223372036854775807, "auto", None),
        (9223372036854775807, "ms", None),
        (None, "auto", None),
    ],
)
def test_epoch_units(spark, epoch, unit, want):
    df = spark.createDataFrame([(epoch,)], "e bigint")
    found = df.select(parsing.epoch_to_timestamp(F.col("e"), unit).cast("string")).first()[0]
    assert found == want


def test_unknown_epoch_unit(spark):
    with pytest.raises(ValueError):
        parsing.epoch_to_timestamp(F.lit(1), "ns")


@pytest.mark.parametrize(
    "cells",
    [
        {"agg_trade_id": None}, {"agg_trade_id": "x"}, {"price": None}, {"price": "n/a"},
        {"price": "0"}, {"price": "-1"}, {"quantity": ""}, {"quantity": "0"},
        {"transact_time": "soon"}, {"transact_time": None},
    ],
)
def test_invalid_rows_are_kept_and_flagged_false(spark, cells):
    assert one(spark, **cells).is_valid is False


def test_flags(spark):
    row = one(spark, is_buyer_maker="TRUE", is_best_match="no")
    assert row.is_buyer_maker is True and row.is_best_match is False
    assert one(spark, is_buyer_maker=None).is_buyer_maker is None


def test_latest_copy_survives(spark):
    late = {"_ingested_at": "2024-03-03T00:00:00+00:00"}
    rows = [{"price": "3"}, {"price": "1", **late}, {"price": "2", **late}, {"price": "9"}]
    kept = silver.from_bronze(bronze(spark, rows), "run").collect()
    assert [float(r.price) for r in kept] == [2.0]


def test_rows_without_an_id_stay_unless_equal(spark):
    rows = [{"agg_trade_id": None, "price": str(p)} for p in (1, 2, 3, 3)] + [{}]
    assert silver.from_bronze(bronze(spark, rows), "run").count() == 4


def test_repeated_upserts_keep_rows_without_an_id(spark, folder):
    first = bronze(spark, [{"agg_trade_id": None, "price": str(p)} for p in (1, 2)] + [{}])
    second = bronze(spark, [{"agg_trade_id": "x", "price": str(p)} for p in (2, 3)])
    for rows in (first, second, second):
        silver.upsert(spark, f"{folder}/s", rows, "run")
    prices = [float(r.price) for r in silver.read(spark, f"{folder}/s").collect() if not r.is_valid]
    assert sorted(prices) == [1.0, 2.0, 3.0]


@pytest.mark.parametrize("text", ["12:30", "2024", "2024-01", "2024-01-01"])
def test_only_full_instants_parse(spark, text):
    assert one(spark, _ingested_at=text)._ingested_at is None


def test_the_unit_follows_the_day(spark):
    assert one(spark, transact_time="94000000000000").transact_time.year == 1972


def test_dedup_reduces_before_the_shuffle(spark):
    plan = silver.from_bronze(bronze(spark, [{}, {}]), "run")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_without_repeats_are_not_shuffled(spark, folder):
    """The path of a new day; with repeats, only their partitions reach the window."""
    other = {"symbol": "ETHX"}
    operators_bronze.write(bronze(spark, [{}, {"agg_trade_id": "2"}, other]), f"{folder}/b")
    rows = operators_bronze.read(spark, f"{folder}/b")
    assert silver.repeated_in(rows) is tables.NO_PARTITION
    clean = plan_of(silver.from_bronze(rows, "run", "auto", tables.NO_PARTITION))
    assert "Exchange" not in clean and "Window" not in clean and "Sort" not in clean
    repeats = tables.partition_filter(rows.filter("symbol = 'ETHX'"), schema.PARTITION)
    mixed = plan_of(silver.from_bronze(rows, "run", "auto", repeats))
    assert mixed.count("Exchange hashpartitioning") == 1
    scans = [line for line in mixed.splitlines() if "PartitionFilters" in line]
    assert len(scans) == 2 and all("PartitionFilters: []" not in line for line in scans)


def stored(spark, target):
    rows = silver.read(spark, target).select(
        "symbol", "batch_date", "agg_trade_id", "price", "_silver_run_id"
    )
    return sorted(
        (r.symbol, r.batch_date.day, r.agg_trade_id or 0, float(r.price), r[4])
        for r in rows.collect()
    )


def test_upsert_inserts_updates_and_repeats(spark, folder):
    target = f"{folder}/silver"
    first = [{"agg_trade_id": i, "price": "1"} for i in ("1", "2", None)]
    first.append({"agg_trade_id": "1", "batch_date": dt.date(2024, 3, 2), "price": "1"})
    silver.upsert(spark, target, bronze(spark, first), "run1")
    second = [{"agg_trade_id": i, "price": "5"} for i in ("2", "3", None)]
    second.append({"agg_trade_id": "1", "price": "7", "symbol": "ETHX"})
    want = sorted(
        [
            # Rows without an id are different trades unless all is equal.
            ("BTCX", 1, 0, 1.0, "run1"), ("BTCX", 1, 0, 5.0, "run2"), ("BTCX", 1, 1, 1.0, "run1"), ("BTCX", 1, 2, 5.0, "run2"),
            ("BTCX", 1, 3, 5.0, "run2"), ("BTCX", 2, 1, 1.0, "run1"), ("ETHX", 1, 1, 7.0, "run2"),
        ]
    )
    for _ in range(2):
        silver.upsert(spark, target, bronze(spark, second), "run2")
        assert stored(spark, target) == want


def test_upsert_dedups_only_where_keys_repeat(spark, folder):
    rows = bronze(spark, [{}, {}, {"symbol": "ETHX"}])
    chosen = silver.repeated_in(rows)
    assert rows.filter(chosen).select("symbol").distinct().collect() == [("BTCX",)]
    silver.upsert(spark, f"{folder}/s", rows, "run")
    assert silver.read(spark, f"{folder}/s").count() == 2
    assert silver.repeated_in(bronze(spark, [{}])) is tables.NO_PARTITION


def test_many_copies_of_one_key(spark, folder):
    copies = [{"price": str(1 + i % 7)} for i in range(3000)]
    for run, rows in enumerate(([{"price": "0.5"}], copies, copies)):
        silver.upsert(spark, f"{folder}/s", bronze(spark, rows), f"run{run}")
    assert [float(r.price) for r in silver.read(spark, f"{folder}/s").collect()] == [7.0]
    repeats = silver.repeated_in(bronze(spark, copies))
    assert silver.distinct_keys_of(bronze(spark, copies), repeats).count() == 1


def test_untouched_partition_keeps_its_files(spark, folder):
    target = f"{folder}/silver"
    other = {"batch_date": dt.date(2024, 3, 2)}
    silver.upsert(spark, target, bronze(spark, [{}, other]), "run1")

    def files():
        names = silver.read(spark, target, "2024-03-02").select(F.input_file_name())
        return {row[0] for row in names.collect()}

    before = files()
    silver.upsert(spark, target, bronze(spark, [{}]), "run2")
    assert files() == before


def test_long_partition_lists_still_prune(spark, folder):
    silver.upsert(spark, f"{folder}/silver", bronze(spark, [{}]), "run1")
    day = F.date_add(F.lit(dt.date(2000, 1, 1)), F.col("id").cast("int"))
    many = spark.range(10_000).select(F.lit("BTCX").alias("symbol"), day.alias("batch_date"))
    chosen = tables.in_partitions(silver.read(spark, f"{folder}/silver"), many, schema.PARTITION)
    scan = next(line for line in plan_of(chosen).splitlines() if "PartitionFilters" in line)
    assert "PartitionFilters: []" not in scan and chosen.count() == 1


def test_upsert_of_several_days(spark, folder):
    target = f"{folder}/silver"
    days = [{"batch_date": dt.date(2024, 3, d), "price": "1"} for d in (1, 2, 3)]
    silver.upsert(spark, target, bronze(spark, days + days), "run1")
    changed = [{**day, "price": "2"} for day in days[:2]]
    silver.upsert(spark, target, bronze(spark, changed), "run2")
    assert [row[3] for row in stored(spark, target)] == [2.0, 2.0, 1.0]


def test_duplicate_source_keys_are_rejected(spark, folder):
    rows = spark.createDataFrame([(1, 1), (1, 2)], "k int, p int").withColumn("d", F.lit(0))
    with pytest.raises(tables.DuplicateKeys):
        tables.upsert(spark, f"{folder}/t", rows, ["k"], ["d"])


def test_upsert_into_catalog_table(spark):
    rows = silver.from_bronze(bronze(spark, [{"agg_trade_id": "1"}, {"agg_trade_id": "2"}]), "r1")
    tables.upsert(spark, "silver_cat", rows, schema.TRADE_KEY, schema.PARTITION)
    more = silver.from_bronze(bronze(spark, [{"agg_trade_id": "2", "price": "4"}]), "r2")
    for _ in range(2):
        tables.upsert(spark, "silver_cat", more, schema.TRADE_KEY, schema.PARTITION)
    assert sorted(float(r.price) for r in spark.table("silver_cat").collect()) == [4.0, 10.5]
    assert tables.read(spark, "silver_cat", batch_date="2024-03-01").count() == 2


def test_upsert_adds_a_column(spark, folder):
    old = spark.createDataFrame([(1, "a", "2024"), (2, "b", "2024")], "k int, v string, y string")
    new = spark.createDataFrame([(2, "c", "x", "2024")], "k int, v string, w string, y string")
    for rows in (old, new):
        tables.upsert(spark, f"{folder}/t", rows, ["y", "k"], ["y"])
    found = spark.read.parquet(f"{folder}/t").select("k", "v", "w").orderBy("k").collect()
    assert found == [(1, "a", None), (2, "c", "x")]


def test_batch_filter_prunes_folders(spark, folder):
    silver.upsert(spark, f"{folder}/s", bronze(spark, [{}]), "run")
    plan = silver.read(spark, f"{folder}/s", "2024-03-01")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(batch_date" in plan


def test_align_pads_and_refuses_drift(spark):
    df = spark.createDataFrame([("1",)], "price string")
    aligned = schema.align(df, schema.BRONZE)
    assert aligned.columns == schema.BRONZE.names and aligned.first().price == "1"
    with pytest.raises(schema.SchemaMismatch):
        schema.align(df, schema.SILVER)
    with pytest.raises(schema.SchemaMismatch):
        schema.assert_schema(df, schema.BRONZE)
    with pytest.raises(AnalysisException):
        df.select("absent")
