"""Data-quality checks: offending rows, a suite of checks, row contracts, gates."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candleforge.functions import measures, parsing
from candleforge.schema import PARTITION, SILVER, schema_differences
from candleforge.sources import tables

# Thresholds and first plausible trading day.
REJECTION_LIMIT_PCT = 5.0
ROW_FLOOR_PCT = 80.0
EARLIEST_DAY = dt.date(2017, 8, 17)

# Patterns of the row contracts.
SYMBOL_PATTERN = r"^[A-Z0-9]+\z"
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}\z"
SHA256_LENGTH = 64


# Single checks: each returns the offending rows, so no row means passed.


def is_missing(column: str) -> Column:
    return F.col(column).isNull()


def is_unaccepted(column: str, values: list) -> Column:
    """Value outside the list; null passes (it is the business of ``not_null``)."""
    return F.coalesce(~F.col(column).isin(list(values)), F.lit(False))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(is_missing(column))


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.filter(is_unaccepted(column, values))


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values occurring more than once, with their count; nulls are ignored."""
    return unique_combination(df.filter(F.col(column).isNotNull()), [column])


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    """Key combinations occurring more than once, with their count ``n``."""
    counts = df.groupBy(*columns).agg(F.count("*").alias("_repeats"))
    return counts.filter(F.col("_repeats") > 1).withColumnRenamed("_repeats", "n")


# Suites.


@dataclass(frozen=True)
class Check:
    """One declared expectation about ``table``."""

    table: str
    kind: str  # not_null | accepted_values | unique
    columns: tuple[str, ...]
    values: tuple = ()

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.table}_{'_'.join(self.columns)}"

    def row_predicate(self) -> Column | None:
        """Condition of an offending row, or None for a check across rows."""
        if self.kind == "not_null":
            return is_missing(self.columns[0])
        if self.kind == "accepted_values":
            return is_unaccepted(self.columns[0], list(self.values))
        return None

    def offending(self, df: DataFrame) -> DataFrame:
        predicate = self.row_predicate()
        if predicate is not None:
            return df.filter(predicate)
        if len(self.columns) == 1:
            return unique(df, self.columns[0])
        return unique_combination(df, list(self.columns))


def not_null_checks(table: str, columns: list[str]) -> list[Check]:
    return [Check(table, "not_null", (c,)) for c in columns]


def trade_suite(symbols: list[str]) -> list[Check]:
    """The 25 expectations on the silver and gold tables; symbols are a parameter."""
    accepted = tuple(symbols)
    return [
        *not_null_checks("silver", ["symbol", "agg_trade_id", "batch_date", "is_valid"]),
        Check("silver", "accepted_values", ("symbol",), accepted),
        *not_null_checks(
            "daily",
            ["symbol", "batch_date", "open_price", "high_price", "low_price", "close_price",
             "volume", "notional", "trade_count"],
        ),
        Check("daily", "accepted_values", ("symbol",), accepted),
        *not_null_checks(
            "hourly", ["symbol", "batch_date", "hour_bucket", "open_price", "close_price"]
        ),
        Check("hourly", "accepted_values", ("symbol",), accepted),
        Check("summary", "unique", ("symbol",)),
        *not_null_checks("summary", ["symbol", "days_observed"]),
        Check("daily", "unique", ("symbol", "batch_date")),
    ]


def run_suite(frames: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """One row per check: name, number of failing rows, passed.

    All checks of a table share one aggregation, hence one scan: counts by each unique key and
    the counts over all rows are grouping sets of it.
    """
    parts = []
    for table in dict.fromkeys(check.table for check in checks):
        parts.append(_checked(frames[table], [c for c in checks if c.table == table]))
    return reduce(DataFrame.unionAll, parts).withColumn("passed", F.col("failing_rows") == 0)


def _checked(df: DataFrame, checks: list[Check]) -> DataFrame:
    """check and failing_rows of all checks of one table."""
    by_row = {c: p for c in checks if (p := c.row_predicate()) is not None}
    counts = {c: f"_rows{n}" for n, c in enumerate(by_row)}
    per_row = [F.count_if(p).alias(counts[c]) for c, p in by_row.items()]
    across = [c for c in checks if c not in by_row]
    if not across:
        counted = df.agg(*per_row)
        failing = {c: F.col(counts[c]) for c in by_row}
    else:
        columns = list(dict.fromkeys(name for c in across for name in c.columns))
        # Copies, so that a key column may also be counted in the set of all rows.
        keys = {name: f"_key_{name}" for name in columns}
        sets = [[keys[name] for name in c.columns] for c in across] + [[]]
        grouped = df.withColumns({key: F.col(name) for name, key in keys.items()}).groupingSets(
            sets, *keys.values()
        )
        found = grouped.agg(
            F.count("*").alias("_n"), F.grouping_id().alias("_set"), *per_row
        )
        failing = {}
        for check, kept in zip(across, sets):
            repeated = (F.col("_set") == _set_number(kept, list(keys.values()))) & (F.col("_n") > 1)
            if len(kept) == 1:
                repeated &= F.col(kept[0]).isNotNull()
            failing[check] = F.count_if(repeated)
        whole = F.col("_set") == _set_number([], list(keys.values()))
        for check, name in counts.items():
            failing[check] = F.coalesce(F.sum(F.when(whole, F.col(name))), F.lit(0))
        names = {check: f"_failing{n}" for n, check in enumerate(failing)}
        counted = found.agg(*[column.alias(names[c]) for c, column in failing.items()])
        failing = {c: F.col(names[c]) for c in failing}
    results = [
        F.struct(F.lit(c.name).alias("check"), failing[c].alias("failing_rows")) for c in checks
    ]
    return counted.select(F.inline(F.array(*results)))


def _set_number(kept: list[str], columns: list[str]) -> int:
    """What ``grouping_id`` gives for a grouping set: a bit for each column that it leaves out."""
    return sum(1 << n for n, name in enumerate(reversed(columns)) if name not in kept)


# Row contracts.


def _broken(rules: dict[str, Column]) -> dict[str, Column]:
    """Per rule, whether a row breaks it; a rule that is null counts as broken."""
    return {name: ~F.coalesce(ok, F.lit(False)) for name, ok in rules.items()}


def _any(conditions: dict[str, Column]) -> Column:
    return reduce(Column.__or__, conditions.values())


def _names(conditions: dict[str, Column]) -> Column:
    """Names of the conditions that hold, in declared order."""
    listed = [F.when(holds, F.lit(name)) for name, holds in conditions.items()]
    return F.array_compact(F.array(*listed))


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows breaking a rule, with ``violations``; names are listed for those rows only."""
    broken = _broken(rules)
    return df.filter(_any(broken)).withColumn("violations", _names(broken))


def bronze_rules() -> dict[str, Column]:
    filled = ["agg_trade_id", "price", "quantity", "first_trade_id", "last_trade_id",
              "transact_time", "_source_file_name", "_pipeline_run_id"]
    rules = {name: F.length(name) >= 1 for name in filled}
    rules["is_buyer_maker"] = F.col("is_buyer_maker").isNotNull()
    rules["symbol"] = F.col("symbol").rlike(SYMBOL_PATTERN)
    rules["batch_date"] = F.col("batch_date").cast("string").rlike(DATE_PATTERN)
    rules["_source_file_sha256"] = F.length("_source_file_sha256") == SHA256_LENGTH
    rules["_ingested_at"] = parsing.to_instant(F.col("_ingested_at")).isNotNull()
    return rules


def bronze_violations(bronze: DataFrame) -> DataFrame:
    """Rows breaking the bronze contract, with ``violations`` (rule names, fixed order)."""
    return violations(bronze, bronze_rules())


def silver_rules() -> dict[str, Column]:
    rules = {f.name: F.col(f.name).isNotNull() for f in SILVER if not f.nullable}
    rules["symbol"] = F.col("symbol").rlike(SYMBOL_PATTERN)
    return rules


def silver_violations(silver: DataFrame) -> DataFrame:
    """Rows breaking the silver contract; the types are a matter of the schema."""
    return violations(silver, silver_rules())


def silver_type_violations(silver: DataFrame) -> list[str]:
    return schema_differences(silver, SILVER)


# Gates.


def validity_counts(silver: DataFrame, keys: list[str] = PARTITION) -> DataFrame:
    counts = silver.groupBy(*keys).agg(
        F.count("*").alias("rows_total"), F.count_if("is_valid").alias("rows_valid")
    )
    invalid = F.col("rows_total") - F.col("rows_valid")
    return counts.withColumn("rows_invalid", invalid).withColumn(
        "pct_invalid", measures.percent(invalid, F.col("rows_total"))
    )


def rejection_gate(silver: DataFrame, limit_pct: float = REJECTION_LIMIT_PCT) -> DataFrame:
    """Per (symbol, batch_date): share of invalid rows, and whether it is within the limit.

    The unrounded share is compared.
    """
    share = F.lit(100) * F.col("rows_invalid") / F.col("rows_total")
    return validity_counts(silver).withColumn("passed", share <= F.lit(limit_pct))


def row_floor_gate(
    bronze: DataFrame, silver: DataFrame, floor_pct: float = ROW_FLOOR_PCT
) -> DataFrame:
    """Per (symbol, batch_date): silver rows against bronze rows.

    A partition present on one side only is reported with zero rows on the other.
    """
    landed = bronze.groupBy(*PARTITION).agg(F.count("*").alias("bronze_rows"))
    kept = silver.groupBy(*PARTITION).agg(F.count("*").alias("silver_rows"))
    both = landed.join(kept, PARTITION, "full").na.fill(0, ["bronze_rows", "silver_rows"])
    bronze_rows, silver_rows = F.col("bronze_rows"), F.col("silver_rows")
    pct = F.when(bronze_rows > 0, measures.percent(silver_rows, bronze_rows))
    return both.withColumn("pct_kept", pct).withColumn(
        "passed", F.lit(100) * silver_rows >= F.lit(floor_pct) * bronze_rows
    )


def temporal_violations(silver: DataFrame, earliest: dt.date = EARLIEST_DAY) -> DataFrame:
    """Trades before the first plausible day or after the day of their batch."""
    day = F.to_date("transact_time")
    reason = F.when(day < F.lit(earliest), "before_earliest_day").when(
        day > F.col("batch_date"), "after_batch_day"
    )
    return silver.withColumn("reason", reason).filter(F.col("reason").isNotNull())


@dataclass(frozen=True)
class Gates:
    """What a (symbol, batch_date) must meet to be published."""

    rejection_limit_pct: float = REJECTION_LIMIT_PCT
    row_floor_pct: float = ROW_FLOOR_PCT
    earliest_day: dt.date = EARLIEST_DAY


def audit(bronze: DataFrame, silver: DataFrame, gates: Gates = Gates()) -> DataFrame:
    """Per (symbol, batch_date) all gates at once: the counts, ``reasons`` and ``passed``.

    One pass over three columns of silver, one over the row counts of bronze. The reasons are
    the gates that stop it, in declared order; a day without any silver row passes none.
    """
    day = F.to_date("transact_time")
    outside = (day < F.lit(gates.earliest_day)) | (day > F.col("batch_date"))
    kept = silver.groupBy(*PARTITION).agg(
        F.count("*").alias("silver_rows"),
        F.count_if("is_valid").alias("valid_rows"),
        F.count_if(outside).alias("untimely_rows"),
    )
    landed = bronze.groupBy(*PARTITION).agg(F.count("*").alias("bronze_rows"))
    counts = landed.join(kept, PARTITION, "full").na.fill(0)
    rejected = F.lit(100) * (F.col("silver_rows") - F.col("valid_rows"))
    stops = {
        "rejection": rejected > F.lit(gates.rejection_limit_pct) * F.col("silver_rows"),
        "row_floor": F.lit(100) * F.col("silver_rows") < F.lit(gates.row_floor_pct) * F.col("bronze_rows"),
        "temporal": F.col("untimely_rows") > 0,
    }
    return counts.withColumn("reasons", _names(stops)).withColumn("passed", F.size("reasons") == 0)


# Quarantine.


def malformed_cells() -> dict[str, Column]:
    """Per text column, whether the cell is present but does not parse."""
    parsers = {
        "agg_trade_id": parsing.to_id,
        "price": parsing.to_amount,
        "quantity": parsing.to_amount,
        "first_trade_id": parsing.to_id,
        "last_trade_id": parsing.to_id,
        "transact_time": parsing.to_id,
    }
    return {
        name: F.col(name).isNotNull() & parse(F.col(name)).isNull()
        for name, parse in parsers.items()
    }


def quarantine(bronze: DataFrame) -> DataFrame:
    """Copies of the rows that break the contract or do not parse, with the reasons.

    The rows themselves stay in bronze and reach silver as invalid.
    """
    broken, malformed = _broken(bronze_rules()), malformed_cells()
    bad = bronze.filter(_any(broken) | _any(malformed))
    return bad.withColumns({"violations": _names(broken), "malformed": _names(malformed)})


def write_quarantine(bad: DataFrame, target: str, run_id: str) -> None:
    """Store bad rows or bad files under their run; a repeated run replaces its own."""
    tables.replace_partitions(bad.withColumn("run_id", F.lit(run_id)), target, ["run_id"])
