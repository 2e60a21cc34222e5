import datetime as dt
import hashlib
import os
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_landing import HEADER, ROW, land, zipped

from candleforge.schema import TRADE_FILE_COLUMNS
from candleforge.sources import landing, zip_source

DAY, NEXT = dt.date(2024, 3, 1), dt.date(2024, 3, 2)


def filled(root):
    land(root, "AAA", zipped(f"{HEADER}\n{ROW}\n{ROW}\n"))
    land(root, "BBB", zipped(f"{ROW},more\n{ROW}\n"), NEXT)
    land(root, "C C", b"no zip")
    land(root, "DDD", zipped("x", "readme.txt"), NEXT)
    land(root, "EEE", zipped(""))
    whole = zipped(f"{ROW}\n" * 5000)
    land(root, "FFF", whole[: len(whole) // 2])
    return root


COLUMNS = [*TRADE_FILE_COLUMNS, landing.EXTRA_CELLS, "file_name", "symbol", "batch_date", "sha256"]


def test_source_gives_what_the_scan_gives(spark, folder):
    root = filled(f"{folder}/landing")
    scanned = landing.read_zipped_csv(spark, root)
    for bin_bytes in (1, 1 << 30):
        found = zip_source.read(spark, root, bin_bytes=bin_bytes)
        for wanted, kept in ((True, landing.readable), (False, landing.unreadable)):
            columns = COLUMNS if wanted else COLUMNS[-4:]
            assert sorted(map(str, kept(found).select(columns).collect())) == sorted(
                map(str, kept(scanned).select(columns).collect())
            )


def test_source_lists_the_wanted_days(spark, folder):
    root = filled(f"{folder}/landing")
    found = zip_source.read(spark, root, [NEXT]).select("symbol").distinct().collect()
    assert sorted(r.symbol for r in found) == ["BBB", "DDD"]
    assert zip_source.read(spark, root, [dt.date(2020, 1, 1)]).isEmpty()
    os.makedirs(f"{folder}/empty")
    assert zip_source.read(spark, f"{folder}/empty").isEmpty()
    assert zip_source.read(spark, f"file://{root}", [DAY]).filter("symbol = 'AAA'").count() == 2


def test_bins(folder):
    for n, size in enumerate([10, 40, 60, 5, 200, 1]):
        land(folder, f"S{n}", b"x" * size)
    reader = zip_source.ZippedTradesReader({"path": folder, "bin_bytes": "100"})
    bins = [[size for _, size in part.files] for part in reader.partitions()]
    assert bins == [[10, 40], [60, 5], [200], [1]]


def test_keys_from_names(folder):
    assert zip_source.keys_of("/a/ABC-aggTrades-2024-03-01-2.zip") == ("ABC-aggTrades-2024-03-01-2.zip", "ABC", DAY)
    assert zip_source.keys_of("/a/other.zip") == ("other.zip", None, None)
    assert zip_source.keys_of("/symbol=X%20Y/batch_date=2024-13-41/f.zip")[1:] == ("X Y", None)


@pytest.mark.parametrize("reads", [(0, 7), (0, 3, 3, 10), (5, 2, 0, 100), (90, 20, 0, 50, 0, 20)])
def test_hash_of_a_file_read_in_any_order(folder, reads):
    content = bytes(range(100))
    with open(f"{folder}/f", "wb") as out:
        out.write(content)
    with pa.OSFile(f"{folder}/f") as source:
        hashed = zip_source.HashedFile(source)
        for at, size in zip(reads[::2], reads[1::2]):
            hashed.seek(at)
            assert hashed.read(size) == content[at : at + size]
        assert hashed.hexdigest() == hashlib.sha256(content).hexdigest()


def test_a_large_member_is_never_held_whole(folder):
    line = "{0},1.5,2,{0},{0},1709251200000,true,true\n"
    size = 0
    with zipfile.ZipFile(f"{folder}/BIG-aggTrades-2024-03-01.zip", "w", zipfile.ZIP_DEFLATED) as archive:
        with archive.open("big.csv", "w") as member:
            for start in range(0, 3_000_000, 100_000):
                size += member.write("".join(line.format(n) for n in range(start, start + 100_000)).encode())
    path = f"{folder}/BIG-aggTrades-2024-03-01.zip"
    assert size > 120 << 20
    before, rows, largest = pa.total_allocated_bytes(), 0, 0
    for batch in zip_source.file_rows(path, os.path.getsize(path)):
        rows += batch.num_rows
        largest = max(largest, pa.total_allocated_bytes() - before)
    assert rows == 3_000_000
    # A few blocks and their cells, far below the member.
    assert largest < 90 << 20


def test_rows_carry_their_file(spark, folder):
    root = filled(folder)
    found = zip_source.read(spark, root).filter("symbol = 'AAA'").select("path", "length", "sha256").distinct()
    row = found.collect()[0]
    with open(row.path.removeprefix("file:"), "rb") as file:
        content = file.read()
    assert (row.length, row.sha256) == (len(content), hashlib.sha256(content).hexdigest())
    assert zip_source.read(spark, root).filter(F.col(landing.PARSE_ERROR).isNotNull()).count() == 3
