import datetime as dt
import hashlib
import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from candleforge.schema import TRADE_FILE_COLUMNS
from candleforge.sources import landing, manifest

DAY = dt.date(2024, 3, 1)
HEADER = ",".join(TRADE_FILE_COLUMNS)
ROW = "7,1.5,2,70,71,1709251200000,true,True"


def zipped(text, member="trades.csv"):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        archive.writestr(member, text)
    return buffer.getvalue()


def land(root, symbol, content, day=DAY):
    path = f"{root}/symbol={symbol}/batch_date={day}"
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{symbol}-aggTrades-{day}.zip", "wb") as out:
        out.write(content)


def parse(spark, text, member="trades.csv"):
    content = text if isinstance(text, bytes) else zipped(text, member)
    files = spark.createDataFrame([("f.zip", bytearray(content))], "path string, content binary")
    return [row.asDict() for row in landing.parse_zipped_csv(files).collect()]


def cells(row):
    return [row[name] for name in TRADE_FILE_COLUMNS]


FULL = ["7", "1.5", "2", "70", "71", "1709251200000", "true", "True"]


@pytest.mark.parametrize(
    "text",
    [
        f"{ROW}\n",
        ROW,
        f"{HEADER}\n{ROW}\n",
        f"\n{HEADER}\n{ROW}\n",
        f"\n\n{ROW}\n",
        f"{HEADER}\n\n{ROW}\n\n",
        f'"7",{ROW[2:]}\n',
        f"{HEADER}\r\n{ROW}\r\n",
        f"﻿{HEADER}\n{ROW}\n",
    ],
)
def test_header_and_blank_lines(spark, text):
    rows = parse(spark, text)
    assert [cells(r) for r in rows] == [FULL]
    assert not rows[0]["_has_extra_cells"] and rows[0]["_parse_error"] is None


def test_narrow_file_is_padded(spark):
    rows = parse(spark, "7,1.5,2,70,71,1709251200000,true\n")
    assert [cells(r) for r in rows] == [FULL[:7] + [None]]


def test_extra_cells_are_cut_and_marked(spark):
    rows = parse(spark, f"{ROW},x,y\n{ROW},x,y\n")
    assert [cells(r) for r in rows] == [FULL, FULL]
    assert all(r["_has_extra_cells"] for r in rows)


def test_ragged_rows_are_kept(spark):
    rows = parse(spark, f"{ROW}\n8,2.5\n{ROW},x\n9,,3,90,91,1709251200001,false,\n")
    found = {(r["agg_trade_id"], r["_has_extra_cells"]): cells(r) for r in rows}
    assert len(rows) == 4
    assert found["8", False] == ["8", "2.5"] + [None] * 6
    assert found["7", True] == FULL
    assert found["9", False] == ["9", None, "3", "90", "91", "1709251200001", "false", None]


def test_empty_member_gives_no_rows(spark):
    assert parse(spark, "") == []


@pytest.mark.parametrize("content", [b"not a zip", zipped("a", "readme.txt"), zipped(ROW)[:-30]])
def test_unreadable_file_is_one_error_row(spark, content):
    rows = parse(spark, content)
    assert len(rows) == 1
    assert rows[0]["_parse_error"] and cells(rows[0]) == [None] * 8


def test_bad_bytes_late_in_a_file_leave_no_rows(spark):
    text = (ROW + "\n").encode() * 5 + b"8,\xff\xfe,2,70,71,1,true,true\n"
    rows = parse(spark, zipped(text))
    assert [r["_parse_error"] is not None for r in rows] == [True]


def test_large_member_is_checked_before_it_is_emitted(spark, monkeypatch):
    monkeypatch.setattr(landing, "BLOCK_BYTES", 4096)
    good = "".join(f"{i},{ROW[2:]}\n" for i in range(1000))
    assert len(parse(spark, good)) == 1000
    bad = good.encode() + b"8,\xff,2,70,71,1,true,true\n"
    assert len(parse(spark, zipped(bad))) == 1


def test_scan_takes_keys_from_folders(spark, folder):
    land(folder, "BTCX", zipped(f"{HEADER}\n{ROW}\n"))
    land(folder, "ETHX", zipped(f"{ROW}\n{ROW}\n"), dt.date(2024, 3, 2))
    rows = landing.read_zipped_csv(spark, folder)
    assert rows.groupBy("symbol", "batch_date").count().orderBy("symbol").collect() == [
        ("BTCX", DAY, 1),
        ("ETHX", dt.date(2024, 3, 2), 2),
    ]
    one_day = landing.landed_files(spark, folder, [DAY])
    assert [r.file_name for r in one_day.collect()] == [f"BTCX-aggTrades-{DAY}.zip"]
    assert landing.landed_files(spark, folder, [dt.date(2020, 1, 1)]).count() == 0
    chosen = spark.createDataFrame([("ETHX", dt.date(2024, 3, 2))], "symbol string, batch_date date")
    assert landing.landed_files(spark, folder, partitions=chosen).count() == 1


def test_listing_does_not_read_content(spark, folder):
    land(folder, "BTCX", zipped(ROW))
    plan = landing.landed_files(spark, folder, with_content=False)
    assert "content" not in plan.columns


def test_fingerprint_is_sha256_of_the_bytes(spark, folder):
    content = zipped(ROW)
    land(folder, "BTCX", content)
    found = landing.with_fingerprint(landing.landed_files(spark, folder)).first()
    assert found.sha256 == hashlib.sha256(content).hexdigest()


def test_manifest_remembers_every_day(spark, folder):
    schema = "symbol string, batch_date date, file_name string, sha256 string"
    target = f"{folder}/manifest"
    first = [("A", DAY, "a1", "h1"), ("A", dt.date(2024, 3, 2), "a2", "h2")]
    stamped = spark.createDataFrame(first, schema).withColumn("ingested_at", F.current_timestamp())
    manifest.record(spark, target, stamped)
    scan = [("A", DAY, "a1", "h1"), ("A", dt.date(2024, 3, 2), "a2", "new"), ("B", DAY, "b", "h3")]
    scanned = spark.createDataFrame(scan, schema)
    found = manifest.detect_changes(scanned, manifest.read_manifest(spark, target))
    assert {(r.file_name, r.change) for r in found.collect()} == {
        ("a1", "unchanged"), ("a2", "changed"), ("b", "new"),
    }
    left = manifest.skip_unchanged(scanned, manifest.read_manifest(spark, target))
    assert {r.file_name for r in left.collect()} == {"a2", "b"}


def test_missing_days(spark):
    symbols = spark.createDataFrame([("A",), ("B",)], "symbol string")
    expected = manifest.expected_days(symbols, DAY, dt.date(2024, 3, 2))
    present = spark.createDataFrame([("A", DAY), ("B", DAY)], "symbol string, batch_date date")
    missing = manifest.missing_sources(expected, present)
    assert {(r.symbol, r.batch_date.day) for r in missing.collect()} == {("A", 2), ("B", 2)}
