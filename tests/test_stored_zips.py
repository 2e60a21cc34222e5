"""The zips that loads over the test tables read: made once, stored, the same rows."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from candleforge.plans import daily_load
from candleforge.registry import adapters, queries
from candleforge.sources import landing, manifest


@pytest.fixture
def events(spark, folder):
    rows = spark.range(60).select(
        F.col("id").alias("event_id"),
        F.expr("timestamp_ntz'2024-01-14 22:00:00' + make_interval(0, 0, 0, 0, cast(id as int))").alias("ts"),
        (F.col("id") % 7).alias("user_id"),
        F.when(F.col("id") % 3 == 0, "click").when(F.col("id") != 7, "view").alias("event_type"),
        (F.col("id") * 1.5).alias("value"),
        F.concat(F.lit('{"k": '), F.col("id").cast("string"), F.lit("}")).alias("props"),
    )
    rows.write.parquet(f"{folder}/events.parquet")
    return folder


def held(zips):
    return sorted(zips.select("path", "file_name", "batch_date", F.sha2("content", 256)).collect())


def test_a_load_makes_its_zips_once(spark, events, monkeypatch):
    seen = []
    monkeypatch.setattr(daily_load, "load", lambda spark, files, *a, **k: seen.append(files(None)))
    first = adapters.landed_zips(spark, events).agg(F.min("file_name")).first()[0]
    queries._loaded_lake(spark, events, "once", spoiled=first)
    (zips,) = seen
    plan = zips._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" not in plan and "Aggregate" not in plan
    made = adapters.landed_zips(spark, events)
    spoiled = F.when(F.col("file_name") == first, F.lit(b"no zip")).otherwise(F.col("content"))
    assert held(zips) == held(made.withColumn("content", spoiled))


def test_no_entries_need_no_python(spark, folder):
    none = manifest.read_manifest(spark, f"{folder}/absent")
    assert none.schema == manifest.MANIFEST and none.count() == 0
    assert "ExistingRDD" not in none._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("lines, block", [(3, landing.LEAST_BLOCK_BYTES), (20_000, None)])
def test_a_short_member_takes_a_short_block(monkeypatch, lines, block):
    text = "".join(f"{n},1.5,2,{n},{n},1705270000000,true\n" for n in range(lines))
    buffer, asked, opened = io.BytesIO(), [], landing.pacsv.open_csv
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("a.csv", text)

    def watched(stream, read_options, **more):
        asked.append(read_options.block_size)
        return opened(stream, read_options=read_options, **more)

    monkeypatch.setattr(landing.pacsv, "open_csv", watched)
    assert sum(b.num_rows for b in landing.member_batches(io.BytesIO(buffer.getvalue()))) == lines
    assert asked == [block or len(text) + 1] and asked[0] < landing.BLOCK_BYTES
