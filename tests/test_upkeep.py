import datetime as dt
import glob
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from candleforge import schema
from candleforge.operators import governance, layout, runlog
from candleforge.sources import tables


def status(spark, processed, skipped, missing, errors):
    outcomes = (
        [runlog.PROCESSED] * processed + [runlog.SKIPPED_UNCHANGED] * skipped
        + [runlog.MISSING_SOURCE] * missing + [runlog.ERROR] * errors
    )
    df = spark.createDataFrame([("r", o) for o in outcomes], "run_id string, outcome string")
    return runlog.run_status(df).first().status


@pytest.mark.parametrize(
    "counts, want",
    [
        ((3, 0, 0, 0), "SUCCESS"), ((1, 0, 0, 2), "PARTIAL"), ((0, 1, 0, 2), "PARTIAL"),
        ((0, 0, 2, 1), "FAILED"), ((0, 0, 3, 0), "WAITING_SOURCE"), ((0, 1, 2, 0), "SKIPPED"),
        ((1, 0, 2, 0), "SUCCESS"),
    ],
)
def test_status(spark, counts, want):
    assert status(spark, *counts) == want


def test_run_log_and_retention(spark, folder):
    log = f"{folder}/log"
    ids = ["20240301_000000_a", "20240110_000000_b", "manual", "20241399_0_c", "20240111_1_d"]
    for run_id in ids:
        runlog.append(spark, log, [{"run_id": run_id, "stage": "run", "status": "SUCCESS"}])
    as_of = dt.date(2024, 3, 1)
    found = runlog.retention(runlog.read(spark, log), as_of)
    assert {r.run_id: r.retention for r in found.collect()} == {
        ids[0]: "keep", ids[1]: "delete", ids[2]: "skip", ids[3]: "skip", ids[4]: "keep",
    }
    want = set(ids) - {ids[1]}
    assert {r.run_id for r in runlog.retained(runlog.read(spark, log), as_of).collect()} == want
    runlog.expire(spark, log, as_of)
    assert {r.run_id for r in runlog.read(spark, log).collect()} == want


def test_write_metrics(spark, folder):
    metrics = runlog.WriteMetrics(rows=F.count("*"), even=F.count_if(F.col("id") % 2 == 0))
    metrics.attach(spark.range(11)).write.parquet(f"{folder}/t")
    assert metrics.values() == {"rows": 11, "even": 6}


@pytest.mark.parametrize(
    "path, days, want",
    [
        ("bronze/raw/a", 730, "hot"), ("bronze/raw/a", 731, "cool"), ("bronze/delta/a", 1825, "cool"),
        ("bronze/delta/a", 1826, "archive"), ("archive/a", 1000, "hot"), ("archive/a", 1826, "archive"),
        ("bad-records/a", 90, "hot"), ("bad-records/a", 91, "delete"), ("silver/a", 9999, "hot"),
    ],
)
def test_tiers(spark, path, days, want):
    as_of = dt.date(2024, 3, 1)
    objects = spark.createDataFrame(
        [(path, as_of - dt.timedelta(days=days))], "path string, modificationTime date"
    )
    assert layout.tier_report(objects, as_of).first().tier == want


def many_files(spark, target):
    rows = spark.range(4000).select(
        F.col("id"), (F.col("id") * 7919 % 4000).alias("v"), (F.col("id") % 2).alias("p")
    )
    rows.repartition(10).write.partitionBy("p").parquet(target)
    return sorted(spark.read.parquet(target).collect())


def files_in(target, partition):
    return glob.glob(f"{target}/{partition}/*.parquet")


def test_compact(spark, folder):
    target = f"{folder}/t"
    before = many_files(spark, target)
    assert len(files_in(target, "p=0")) > 1
    chosen = spark.createDataFrame([(0,)], "p int")
    untouched = set(files_in(target, "p=1"))
    layout.compact(spark, target, ["p"], chosen)
    assert len(files_in(target, "p=0")) == 1 and set(files_in(target, "p=1")) == untouched
    assert sorted(spark.read.parquet(target).collect()) == before


@pytest.mark.parametrize("work", ["compact", "cluster"])
def test_rewriting_keeps_partition_values(spark, folder, work):
    rows = spark.createDataFrame([("007", 1), ("07", 2), ("1", 3)], "p string, v int")
    rows.write.partitionBy("p").parquet(f"{folder}/t")
    if work == "compact":
        layout.compact(spark, f"{folder}/t", ["p"])
    else:
        layout.cluster_by(spark, f"{folder}/t", ["p"], ["v"])
    read = spark.read.schema("v int, p string").parquet(f"{folder}/t")
    assert sorted((r.p, r.v) for r in read.collect()) == [("007", 1), ("07", 2), ("1", 3)]


def test_compact_splits_a_large_partition(spark, folder):
    target = f"{folder}/t"
    rows = spark.range(400_000).select(F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit(1).alias("p"))
    rows.write.partitionBy("p").parquet(target)
    layout.compact(spark, target, ["p"], file_bytes=1 << 20)
    assert len(files_in(target, "p=1")) > 4
    assert spark.read.parquet(target).distinct().count() == 400_000


def test_cluster_by_orders_the_files(spark, folder):
    target = f"{folder}/t"
    before = many_files(spark, target)
    layout.cluster_by(spark, target, ["p"], ["v"])
    assert sorted(spark.read.parquet(target).collect()) == before
    for path in files_in(target, "p=0"):
        values = [r.v for r in spark.read.parquet(path).collect()]
        assert values == sorted(values)


def test_compact_leaves_well_laid_partitions_alone(spark, folder):
    target = f"{folder}/t"
    rows = spark.range(4000).select("id", F.when(F.col("id") < 2000, "a b=%").otherwise("p/q").alias("p"))
    rows.filter("id < 2000").coalesce(1).write.partitionBy("p").parquet(target)
    rows.filter("id >= 2000").repartition(6).write.mode("append").partitionBy("p").parquet(target)
    listed = layout.file_sizes(spark, target, ["p"])
    assert [r.files for r in layout.crowded(listed).collect()] == [6]
    before = set(glob.glob(f"{target}/p=a*/*.parquet"))
    assert layout.compact(spark, target, ["p"]) == 1
    assert set(glob.glob(f"{target}/p=a*/*.parquet")) == before
    files = set(glob.glob(f"{target}/*/*.parquet"))
    assert len(files) == 2
    assert layout.compact(spark, target, ["p"]) == 0
    assert set(glob.glob(f"{target}/*/*.parquet")) == files
    assert spark.read.parquet(target).distinct().count() == 4000


def test_packing(spark):
    sizes = [("a", "f1", 100), ("a", "f2", 60), ("a", "f3", 50), ("a", "f4", 30), ("a", "f5", 10), ("b", "g", 5)]
    files = spark.createDataFrame(sizes, "partition string, file string, bytes long")
    found = {r.file: r.bin for r in layout.packed(files, 100).collect()}
    assert found == {"f1": None, "f2": 0, "f3": 0, "f4": 1, "f5": 1, "g": 0}
    assert layout.crowded(files, 100).count() == 0
    assert [tuple(r) for r in layout.crowded(files, 300).collect()] == [("a", 5, 250, 1)]


def test_interleaved(spark):
    frame = spark.createDataFrame([(0, 0), (1, 0), (0, 1), (3, 1), (2, 3)], "a int, b int")
    found = frame.select(layout.interleaved([F.col("a"), F.col("b")], 2)).collect()
    assert [r[0] for r in found] == [0, 2, 1, 11, 13]


@pytest.mark.parametrize(
    "kind, values",
    [
        ("double", [None, -1.5, 0.0, 0.0, 2.0, 9.0, 1e300]), ("string", [None, "", "a", "ab", "b", "z", "\xe9"]),
        ("date", [None, *(dt.date(2024, 1, d) for d in range(1, 7))]),
        ("decimal(38,8)", [None, 1, 2, 3, 4, 5, 6]), ("boolean", [None, False, True, True]),
    ],
)
def test_ranges_follow_the_order(spark, kind, values):
    values = [Decimal(v) if kind.startswith("decimal") and v is not None else v for v in values]
    frame = spark.createDataFrame([(n, v) for n, v in enumerate(values)], f"n int, v {kind}")
    placed = layout.with_curve(frame, ["v"], bits=3).orderBy("n").collect()
    numbers = [r[layout.CURVE] for r in placed]
    assert numbers == sorted(numbers) and numbers[0] == 0
    empty = layout.with_curve(frame.filter("n < 1"), ["v"], bits=3)
    assert [r[layout.CURVE] for r in empty.collect()] == [0]


def test_files_along_the_curve_are_narrow_in_both_columns(spark, folder):
    rows = spark.range(40_000).select(
        (F.col("id") * 7919 % 40_009).alias("a"), (F.col("id") * 104_729 % 40_013).alias("b"), F.lit(1).alias("p")
    )
    shares = {}
    for curve in (False, True):
        target = f"{folder}/{curve}"
        rows.write.partitionBy("p").parquet(target)
        layout.cluster_by(spark, target, ["p"], ["a", "b"], curve=curve, ranges=16)
        spread = layout.column_spread(spark.read.parquet(target), ["a", "b"]).collect()
        assert len(spread) >= 2 * 8
        mean = {c: [r.share for r in spread if r.column == c] for c in ("a", "b")}
        shares[curve] = {c: sum(v) / len(v) for c, v in mean.items()}
        assert spark.read.parquet(target).exceptAll(rows).isEmpty()
    assert shares[False]["b"] > 0.9
    assert shares[True]["a"] < 0.6 and shares[True]["b"] < 0.6


def test_list_objects(spark, folder):
    many_files(spark, f"{folder}/t")
    listed = layout.list_objects(spark, f"{folder}/t")
    assert listed.filter(F.col("path").endswith(".parquet")).count() > 2


def test_table_properties_and_comments(spark):
    rows = spark.createDataFrame([("A", "it's")], "symbol string, price string")
    tables.rebuild(rows, "governed", ["symbol"])
    wanted = {"domain": "markets", "contains_pii": "false", "note": "it's"}
    governance.set_properties(spark, "governed", wanted)
    assert wanted.items() <= governance.get_properties(spark, "governed").items()
    with pytest.raises(ValueError):
        governance.set_properties(spark, "governed", {"owner": "me"})
    governance.set_comments(spark, "governed", schema.BRONZE)
    comments = {r.col_name: r.comment for r in spark.sql("DESCRIBE governed").collect()}
    assert comments["price"] == "price as text"


def test_dictionary(spark):
    rows = governance.dictionary(spark)
    assert rows.count() == sum(len(t) for t in schema.TABLES.values())
    by_class = {(r.column_name.startswith("_"), r.sensitivity) for r in rows.collect()}
    assert by_class == {(True, "INTERNAL"), (False, "PUBLIC")}


def test_partitions_with_odd_values_are_dropped(spark, folder):
    target = f"{folder}/odd"
    values = [None, "a b", "x=1", "50%", "p/q", "c:d", "[e]", "stay"]
    frame = spark.createDataFrame([(1, v) for v in values], "n int, k string")
    tables.replace_partitions(frame, target, ["k"])
    tables.drop_partitions(spark, target, [{"k": v} for v in values[:-1]])
    assert [r.k for r in tables.read(spark, target, frame.schema).collect()] == ["stay"]


@pytest.mark.parametrize(
    "values",
    [
        [None, 5], [7] * 3000 + [n % 20 for n in range(2000)], [n * 7919 % 40_009 for n in range(40_009)],
        # As doubles these are all the same.
        [2**62 + n * 7 % 100 for n in range(3000)],
    ],
)
def test_exact_bounds_need_no_long_summary(spark, monkeypatch, values):
    asked, summary = [], F.percentile_approx
    monkeypatch.setattr(layout.F, "percentile_approx", lambda *a: asked.append(a[2]) or summary(*a))
    frame = spark.createDataFrame([(v,) for v in values], "v long").repartition(5)
    bounds = layout.range_bounds(frame, ["v"], bits=4, accuracy=100_000_000)
    found = frame.select(bounds["v"]).first()[0]
    held = sorted(v for v in values if v is not None)
    assert found == [held[max(1, -(-n * len(held) // 16)) - 1] for n in range(1, 16)]
    assert max(asked) <= layout.CURVE_ACCURACY


def test_intervals_that_miss_a_rank_are_widened(spark, monkeypatch):
    frame = spark.range(5000).select(F.col("id").alias("value")).repartition(3)
    intervals, slacks = layout._intervals, []

    def missing(values, shares, slack):
        slacks.append(slack)
        return [(0, 1)] if len(slacks) == 1 else intervals(values, shares, slack)

    monkeypatch.setattr(layout, "_intervals", missing)
    assert layout.exact_quantiles(frame, [0.25, 0.5, 1.0]) == [1249, 2499, 4999]
    assert len(slacks) == 2


def test_compact_writes_without_a_sort_of_its_rows(spark, folder, monkeypatch):
    target = f"{folder}/t"
    before = many_files(spark, target)
    writers, replace = [], tables.replace_partitions

    def watched(df, *args, **more):
        writers.append(int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")))
        replace(df, *args, **more)

    monkeypatch.setattr(tables, "replace_partitions", watched)
    assert layout.compact(spark, target, ["p"]) == 2
    assert len(writers) == 1 and writers[0] >= 2
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    assert sorted(spark.read.parquet(target).collect()) == before
