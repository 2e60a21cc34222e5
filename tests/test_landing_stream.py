import datetime as dt
import os

from test_landing import zipped

from candleforge import schema
from candleforge.operators import silver
from candleforge.plans import daily_load
from candleforge.sources import tables
from candleforge.streaming import landing_stream

DAY = dt.date(2024, 3, 1)
MS = 1709251200000


def rows(*prices, first_id=1):
    return "".join(f"{first_id + i},{p},2,1,1,{MS + 1000 * i},true,true\n" for i, p in enumerate(prices))


def arrive(root, batch, symbol, content, part=0):
    os.makedirs(f"{root}/{batch}", exist_ok=True)
    with open(f"{root}/{batch}/{symbol}-aggTrades-{DAY}-{part}.zip", "wb") as out:
        out.write(content)


def test_files_are_loaded_as_they_arrive(spark, folder):
    root, lake, loaded = f"{folder}/landing", daily_load.Lake(f"{folder}/lake"), []

    def step(run_id):
        loaded.clear()
        landing_stream.stream_load(
            spark, root, lake, f"{folder}/checkpoint", run_id,
            after_batch=lambda files: loaded.extend((r.symbol, r.file_name[-5]) for r in files.collect()),
        ).awaitTermination()
        return sorted(loaded)

    def candles():
        found = tables.read(spark, lake.daily, schema.GOLD_DAILY).collect()
        return {r.symbol: (float(r.open_price), float(r.close_price), r.trade_count) for r in found}

    # Two parts of a day, one other symbol, a file that is no zip, and one with a foreign name.
    first, part = zipped(rows(1, 2)), zipped(rows(3, first_id=9))
    arrive(root, "a", "AAA", first)
    arrive(root, "a", "AAA", part, part=1)
    arrive(root, "a", "BBB", zipped(rows(5)))
    arrive(root, "a", "CCC", b"no zip")
    with open(f"{root}/a/other.zip", "wb") as out:
        out.write(zipped(rows(1)))
    assert step("s1") == [("AAA", "0"), ("AAA", "1"), ("BBB", "0"), ("CCC", "0")]
    assert candles() == {"AAA": (1, 2, 3), "BBB": (5, 5, 1)}
    assert [r.symbol for r in spark.read.parquet(lake.bad_files).collect()] == ["CCC"]

    # The same content again is skipped, also from another folder; nothing new is no batch.
    arrive(root, "b", "AAA", first)
    assert step("s2") == [] and step("s3") == []

    # Of two versions in one batch the later counts. Other content replaces the rows of its file.
    arrive(root, "c", "BBB", zipped(rows(7)))
    arrive(root, "d", "BBB", zipped(rows(8, 9)))
    os.utime(f"{root}/c/BBB-aggTrades-{DAY}-0.zip", (1, 1))
    arrive(root, "d", "CCC", zipped(rows(4)))
    assert step("s4") == [("BBB", "0"), ("CCC", "0")]
    assert candles() == {"AAA": (1, 2, 3), "BBB": (8, 9, 2), "CCC": (4, 4, 1)}
    runs = {r.symbol: r._silver_run_id for r in silver.read(spark, lake.silver).select("symbol", "_silver_run_id").collect()}
    assert runs["AAA"].startswith("s1-") and runs["BBB"].startswith("s4-")

    # A changed part leaves the other part of its day, and going back to a former content counts.
    arrive(root, "e", "AAA", zipped(rows(6, first_id=9)), part=1)
    assert step("s5") == [("AAA", "1")]
    assert candles()["AAA"] == (1, 2, 3)
    arrive(root, "f", "AAA", part, part=1)
    assert step("s6") == [("AAA", "1")]
    bronze = spark.read.parquet(lake.bronze).filter("symbol = 'AAA'")
    assert sorted(r.price for r in bronze.collect()) == ["1", "2", "3"]
