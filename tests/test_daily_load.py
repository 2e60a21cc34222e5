import datetime as dt

from pyspark.sql import functions as F
from test_landing import HEADER, land, zipped

from candleforge import schema
from candleforge.operators import bronze, quality, runlog, silver
from candleforge.plans import daily_load
from candleforge.sources import tables
from candleforge.streaming import silver_stream

DAY = dt.date(2024, 3, 1)
SYMBOLS = ["AAA", "BBB", "CCC"]
MS = 1709251200000


def rows(*prices, first_id=1):
    return "".join(
        f"{first_id + i},{p},2,1,1,{MS + 1000 * i},true,true\n" for i, p in enumerate(prices)
    )


def daily(spark, lake):
    found = tables.read(spark, lake.daily, schema.GOLD_DAILY).collect()
    return {r.symbol: (float(r.open_price), float(r.close_price), r.trade_count) for r in found}


def test_runs_follow_the_files(spark, folder):
    landing, lake = f"{folder}/landing", daily_load.Lake(f"{folder}/lake")

    def run(run_id):
        return daily_load.run(spark, landing, lake, run_id, SYMBOLS, [DAY])

    # Two good files, one missing.
    land(landing, "AAA", zipped(f"{HEADER}\n" + rows(1, 2)))
    land(landing, "BBB", zipped(rows(5, 6, 7, 7, "bad")))
    first = run("20240302_010000_a")
    assert (first["status"], first["processed"], first["missing_source"]) == ("SUCCESS", 2, 1)
    assert daily(spark, lake) == {"AAA": (1, 2, 2), "BBB": (5, 7, 4)}
    assert spark.read.parquet(lake.bad_rows).count() == 1
    log = {r.stage: r for r in runlog.read(spark, lake.run_log).collect()}
    assert (log["bronze"].rows_in, log["bronze"].rows_out) == (7, 7)
    assert (log["silver"].rows_in, log["silver"].rows_out) == (7, 7)
    assert log["silver"].duplicates_dropped == 0 and log["run"].status == "SUCCESS"

    # Nothing changed.
    files = set(bronze.read(spark, lake.bronze).inputFiles())
    assert run("20240302_020000_b")["status"] == "SKIPPED"
    assert set(bronze.read(spark, lake.bronze).inputFiles()) == files

    # One file is published again with a repeat, one arrives unreadable.
    land(landing, "AAA", zipped(rows(1, 9) + rows(9, first_id=2) + rows(4, first_id=3)))
    land(landing, "CCC", zipped("x", "readme.txt"))
    third = run("20240302_030000_c")
    assert (third["status"], third["processed"]) == ("PARTIAL", 1)
    assert (third["skipped_unchanged"], third["errors"]) == (1, 1)
    assert daily(spark, lake) == {"AAA": (1, 9, 3), "BBB": (5, 7, 4)}
    assert [r.symbol for r in spark.read.parquet(lake.bad_files).collect()] == ["CCC"]
    log = [r for r in runlog.read(spark, lake.run_log).collect() if r.run_id.endswith("c")]
    assert {r.stage: r.duplicates_dropped for r in log}["silver"] == 1

    # The unreadable file is tried again and is good now.
    land(landing, "CCC", zipped(rows(3)))
    fourth = run("20240302_040000_d")
    assert (fourth["status"], fourth["processed"]) == ("SUCCESS", 1)
    assert daily(spark, lake)["CCC"] == (3, 3, 1)

    # Processing everything again changes nothing.
    before = sorted(silver.read(spark, lake.silver).drop("_silver_at", "_silver_run_id").collect(), key=str)
    candles = daily(spark, lake)
    daily_load.backfill(spark, lake, "20240303_000000_e")
    daily_load.backfill(spark, lake, "20240303_000001_f", [DAY])
    after = sorted(silver.read(spark, lake.silver).drop("_silver_at", "_silver_run_id").collect(), key=str)
    assert before == after and daily(spark, lake) == candles


def test_emptied_and_half_bad_days(spark, folder):
    landing, lake = f"{folder}/landing", daily_load.Lake(f"{folder}/lake")

    def run(run_id):
        return daily_load.run(spark, landing, lake, run_id, SYMBOLS[:2], [DAY])["status"]

    def stored(path):
        found = spark.read.parquet(path).groupBy("symbol").count().collect()
        return {r.symbol: r["count"] for r in found}

    second = f"{landing}/symbol=BBB/batch_date={DAY}/BBB-aggTrades-{DAY}-2.zip"
    land(landing, "AAA", zipped(rows(1, 2)))
    land(landing, "BBB", zipped(rows(5, 6)))
    with open(second, "wb") as out:
        out.write(zipped(rows(7, first_id=3).replace(",true\n", ",true,more\n")))
    assert run("r1") == "SUCCESS"
    assert stored(lake.bronze) == stored(lake.silver) == {"AAA": 2, "BBB": 3}
    flagged = spark.read.parquet(lake.checks).filter("_has_extra_cells").collect()
    assert [r.path.rsplit("/", 1)[1] for r in flagged] == [second.rsplit("/", 1)[1]]

    def reason(run_id):
        log = runlog.read(spark, lake.run_log).filter(F.col("run_id") == run_id)
        return {r.stage: r.reason for r in log.collect()}["bronze"]

    assert reason("r1") == "files with surplus cells: 1"

    # A file without rows empties its day; a bad part leaves the other day as it was.
    land(landing, "AAA", zipped(f"{HEADER}\n"))
    with open(second, "wb") as out:
        out.write(b"no zip")
    assert run("r2") == "PARTIAL"
    assert stored(lake.bronze) == stored(lake.silver) == {"BBB": 3}
    assert daily(spark, lake) == {"BBB": (5, 6, 3)} and reason("r2") == "unreadable files: 1"

    # All days of the table are emptied.
    land(landing, "BBB", zipped(f"{HEADER}\n"))
    with open(second, "wb") as out:
        out.write(zipped(f"{HEADER}\n"))
    assert run("r3") == "SUCCESS"
    assert daily(spark, lake) == {}


def test_only_bad_and_only_missing_files(spark, folder):
    landing, lake = f"{folder}/landing", daily_load.Lake(f"{folder}/lake")
    land(landing, "AAA", zipped("x", "readme.txt"))
    failed = daily_load.run(spark, landing, lake, "r1", SYMBOLS, [DAY])
    assert failed["status"] == "FAILED"
    waiting = daily_load.run(spark, landing, lake, "r2", SYMBOLS, today=dt.date(2024, 3, 3))
    assert waiting["status"] == "WAITING_SOURCE"


def test_gates_hold_a_day_back(spark, folder):
    landing, lake = f"{folder}/landing", daily_load.Lake(f"{folder}/lake")

    def run(run_id):
        status = daily_load.run(
            spark, landing, lake, run_id, SYMBOLS, [DAY], gates=quality.Gates(rejection_limit_pct=30)
        )
        log = {r.stage: r for r in runlog.read(spark, lake.run_log).collect() if r.run_id == run_id}
        return status["status"], log["audit"].status, log["audit"].reason

    def trades():
        found = silver.read(spark, lake.silver).groupBy("symbol").count().collect()
        return {r.symbol: r["count"] for r in found}

    # CCC has too many bad rows; the others are published.
    land(landing, "AAA", zipped(rows(1, 2)))
    land(landing, "BBB", zipped(rows(5, 6, 7, "bad")))
    land(landing, "CCC", zipped(rows(5, "bad")))
    assert run("r1") == ("PARTIAL", "PARTIAL", "rejection: 1")
    assert trades() == {"AAA": 2, "BBB": 4} and set(daily(spark, lake)) == {"AAA", "BBB"}

    # A changed file that fails leaves its day as it was published before; a good one replaces its.
    land(landing, "AAA", zipped(rows(9, "bad", "worse")))
    late = MS + 5 * 86_400_000
    land(landing, "BBB", zipped(rows(8).replace(str(MS), str(late))))
    land(landing, "CCC", zipped(rows(3, 4)))
    assert run("r2") == ("PARTIAL", "PARTIAL", "rejection: 1, temporal: 1")
    assert trades() == {"AAA": 2, "BBB": 4, "CCC": 2}
    assert daily(spark, lake) == {"AAA": (1, 2, 2), "BBB": (5, 7, 3), "CCC": (3, 4, 2)}
    verdicts = spark.read.parquet(lake.gates).filter("run_id = 'r2'").collect()
    assert {r.symbol: (r.passed, r.reasons) for r in verdicts} == {
        "AAA": (False, ["rejection"]), "BBB": (False, ["temporal"]), "CCC": (True, []),
    }
    # Nothing is left in staging, and an unchanged file is not audited again.
    assert not tables.exists(spark, f"{folder}/lake/staging/silver")
    assert daily_load.run(spark, landing, lake, "r3", SYMBOLS, [DAY], gates=quality.Gates())["status"] == "SKIPPED"


def test_audit_counts_both_sides(spark):
    bronze_rows = [("A", DAY)] * 10 + [("B", DAY)] * 2
    landed = spark.createDataFrame(bronze_rows, "symbol string, batch_date date")
    at = dt.datetime(2024, 3, 1, 12)
    kept = spark.createDataFrame(
        [("A", DAY, True, at)] * 7 + [("A", DAY, False, None)], "symbol string, batch_date date, is_valid boolean, transact_time timestamp"
    )
    found = {r.symbol: r for r in quality.audit(landed, kept, quality.Gates(row_floor_pct=81)).collect()}
    assert found["A"].reasons == ["rejection", "row_floor"] and not found["A"].passed
    assert (found["A"].bronze_rows, found["A"].silver_rows, found["A"].valid_rows) == (10, 8, 7)
    assert found["B"].reasons == ["row_floor"]


def test_promotion_can_be_repeated(spark, folder):
    staged, target = f"{folder}/staged", f"{folder}/t"
    old = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    new = spark.createDataFrame([(3, "a"), (4, "c=/"), (5, None)], "v int, p string")
    tables.replace_partitions(old, target, ["p"])
    tables.replace_partitions(new, staged, ["p"])
    for _ in range(2):
        tables.promote(spark, staged, target, tables.listed_partitions(new, ["p"]))
        found = sorted(tables.read(spark, target, old.schema).collect())
        assert [tuple(r) for r in found] == [(2, "b"), (3, "a"), (4, "c=/"), (5, None)]


def test_backfill_goes_on_after_a_failure(spark, folder, monkeypatch):
    landing, lake = f"{folder}/landing", daily_load.Lake(f"{folder}/lake")
    for n, symbol in enumerate(SYMBOLS):
        land(landing, symbol, zipped(rows(n + 1, n + 2)))
    daily_load.run(spark, landing, lake, "r1", SYMBOLS, [DAY])
    candles, refresh, calls = daily(spark, lake), daily_load.refresh_from_bronze, []

    def failing(spark, lake, partitions, *more):
        calls.append([r.symbol for r in partitions.collect()])
        if len(calls) == 2:
            raise RuntimeError("lost")
        return refresh(spark, lake, partitions, *more)

    monkeypatch.setattr(daily_load, "refresh_from_bronze", failing)
    for _ in range(3):
        try:
            daily_load.backfill(spark, lake, "r2", group_size=1)
        except RuntimeError:
            pass
    assert calls == [["AAA"], ["BBB"], ["BBB"], ["CCC"]]
    done = daily_load.backfilled(spark, lake, "r2").collect()
    assert {r.symbol: r.group for r in done} == {"AAA": 1, "BBB": 2, "CCC": 3}
    assert daily(spark, lake) == candles


def test_stream_picks_up_new_files_once(spark, folder):
    bronze_path, target = f"{folder}/bronze", f"{folder}/silver"
    touched = []

    def step(run_id):
        silver_stream.stream_upsert(
            spark, bronze_path, target, f"{folder}/checkpoint", run_id,
            after_batch=lambda partitions: touched.append(partitions.count()),
        ).awaitTermination()

    from test_silver import bronze as bronze_rows

    bronze.write(bronze_rows(spark, [{}, {"agg_trade_id": "2"}]), bronze_path)
    step("s1")
    assert silver.read(spark, target).count() == 2 and touched == [1]
    step("s2")
    assert touched == [1]
    bronze.write(bronze_rows(spark, [{"agg_trade_id": "3", "symbol": "ETHX"}]), bronze_path)
    step("s3")
    assert silver.read(spark, target).count() == 3 and touched == [1, 1]
