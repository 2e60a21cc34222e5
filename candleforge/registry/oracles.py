"""The registered queries as SQL over the same tables (DuckDB dialect)."""

from __future__ import annotations

# The 31 shares that cut a column into 32 ranges.
_SHARES = ", ".join(str(k / 32) for k in range(1, 32))

# ``events`` as typed trades.
TRADES = """
trades AS (
  SELECT event_id AS agg_trade_id,
         CAST(value AS DECIMAL(38,8)) AS price,
         CAST(json_extract_string(props, '$.k') AS DECIMAL(38,8)) AS quantity,
         ts AS transact_time,
         upper(event_type) AS symbol,
         CAST(ts AS DATE) AS batch_date,
         value > 0 AND CAST(json_extract_string(props, '$.k') AS INTEGER) > 0 AS is_valid
  FROM events
)"""

# ``events`` as bronze text with faults, and the same rows typed.
TEXT = """
faulty AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         upper(event_type) AS sym,
         upper(event_type) || '-aggTrades-' || CAST(CAST(ts AS DATE) AS VARCHAR) || '.zip' AS fname
  FROM events
),
bronze AS (
  SELECT CASE WHEN k = 3 THEN '' ELSE CAST(event_id AS VARCHAR) END AS agg_trade_id,
         CASE WHEN k = 5 THEN 'n/a' WHEN k = 6 THEN NULL
              ELSE CAST(CAST(value AS DECIMAL(38,8)) AS VARCHAR) END AS price,
         CASE WHEN k = 8 THEN '-1.00000000'
              ELSE CAST(CAST(k AS DECIMAL(38,8)) AS VARCHAR) END AS quantity,
         CAST(event_id AS VARCHAR) AS first_trade_id,
         CASE WHEN k = 9 THEN 'x9' ELSE CAST(event_id AS VARCHAR) END AS last_trade_id,
         CASE WHEN k = 10 THEN 'later'
              WHEN event_type IN ('click', 'view') THEN CAST(epoch_us(ts) // 1000 AS VARCHAR)
              ELSE CAST(epoch_us(ts) AS VARCHAR) END AS transact_time,
         CASE WHEN user_id % 2 = 0 THEN 'TRUE' ELSE 'False' END AS is_buyer_maker,
         CASE WHEN k > 50 THEN 'true' END AS is_best_match,
         fname AS _source_file_name,
         CASE WHEN k = 11 THEN 'short' ELSE sha256(fname) END AS _source_file_sha256,
         '20240201_000000_run' AS _pipeline_run_id,
         CASE WHEN k = 12 THEN 'yesterday'
              ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END AS _ingested_at,
         CASE WHEN k = 13 THEN lower(sym) ELSE sym END AS symbol,
         CAST(ts AS DATE) AS batch_date
  FROM faulty
),
typed_rows AS (
  SELECT symbol, batch_date,
         TRY_CAST(agg_trade_id AS BIGINT) AS agg_trade_id,
         TRY_CAST(price AS DECIMAL(38,8)) AS price,
         TRY_CAST(quantity AS DECIMAL(38,8)) AS quantity,
         TRY_CAST(first_trade_id AS BIGINT) AS first_trade_id,
         TRY_CAST(last_trade_id AS BIGINT) AS last_trade_id,
         make_timestamp(CASE WHEN length(transact_time) < 15
                             THEN TRY_CAST(transact_time AS BIGINT) * 1000
                             ELSE TRY_CAST(transact_time AS BIGINT) END) AS transact_time,
         lower(is_buyer_maker) = 'true' AS is_buyer_maker,
         lower(is_best_match) = 'true' AS is_best_match,
         TRY_CAST(replace(_ingested_at, '+00:00', '') AS TIMESTAMP) AS _ingested_at
  FROM bronze
),
typed AS (
  SELECT *, coalesce(agg_trade_id IS NOT NULL AND price > 0 AND quantity > 0
                     AND transact_time IS NOT NULL, false) AS is_valid
  FROM typed_rows
),
latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
             PARTITION BY symbol, batch_date, agg_trade_id,
                          CASE WHEN agg_trade_id IS NULL THEN
                            concat_ws('|', coalesce(CAST(price AS VARCHAR), '-'),
                              coalesce(CAST(quantity AS VARCHAR), '-'),
                              coalesce(CAST(first_trade_id AS VARCHAR), '-'),
                              coalesce(CAST(last_trade_id AS VARCHAR), '-'),
                              coalesce(CAST(transact_time AS VARCHAR), '-'),
                              coalesce(CAST(is_buyer_maker AS VARCHAR), '-'),
                              coalesce(CAST(is_best_match AS VARCHAR), '-')) END
             ORDER BY _ingested_at DESC NULLS LAST, price DESC NULLS LAST,
                      quantity DESC NULLS LAST, first_trade_id DESC) AS rn
    FROM typed)
  WHERE rn = 1
)"""


def _units(amount: str) -> str:
    """An amount with 8 decimals as a whole number."""
    return f"CAST({amount} * 100000000 AS HUGEINT)"


def _ratio(notional: str, volume: str, decimals: int = 8) -> str:
    """Quotient in units of the last decimal, rounded half up, in whole numbers."""
    return (
        f"((2 * {_units(notional)} * {10**decimals} + {_units(volume)})"
        f" // (2 * {_units(volume)}))"
    )


def _vwap(notional: str, volume: str, decimals: int = 8) -> str:
    quotient = _ratio(notional, volume, decimals)
    return f"CASE WHEN {volume} > 0 THEN CAST({quotient} AS DOUBLE) / {10**decimals} END"


def _pct(part: str, whole: str) -> str:
    """Two decimals, half up, in whole numbers."""
    return f"CAST((20000 * ({part}) + ({whole})) // (2 * ({whole})) AS DOUBLE) / 100"


def _candles(source: str, name: str, keys: str, extra: str = "") -> str:
    return f"""
{name} AS (
  SELECT {keys}{extra},
         min(transact_time) AS session_open_at, max(transact_time) AS session_close_at,
         arg_min(price, row(transact_time, agg_trade_id)) AS open_price,
         max(price) AS high_price, min(price) AS low_price,
         arg_max(price, row(transact_time, agg_trade_id)) AS close_price,
         sum(quantity) AS volume,
         sum(CAST(CAST(price AS DECIMAL(18,4)) * CAST(quantity AS DECIMAL(18,4)) AS DECIMAL(38,8)))
           AS notional,
         count(*) AS trade_count
  FROM {source} WHERE is_valid GROUP BY ALL
)"""


DAILY = _candles("trades", "daily", "symbol, batch_date")
HOURLY = _candles(
    "trades", "hourly", "symbol, batch_date", ", date_trunc('hour', transact_time) AS hour_bucket"
)

PRICES = ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}"
    for c in ["open_price", "high_price", "low_price", "close_price"]
)
TOTALS = (
    "CAST(volume AS DOUBLE) AS volume, CAST(notional AS DOUBLE) AS notional, "
    f"{_vwap('notional', 'volume')} AS vwap, trade_count"
)

SELECT_DAILY = (
    "SELECT symbol, CAST(batch_date AS VARCHAR) AS batch_date, session_open_at, "
    f"session_close_at, {PRICES}, {TOTALS} FROM daily"
)
SELECT_HOURLY = (
    "SELECT symbol, CAST(batch_date AS VARCHAR) AS batch_date, "
    f"CAST(hour_bucket AS TIMESTAMP) AS hour_bucket, {PRICES}, {TOTALS} FROM hourly"
)

SUMMARY = f"""
WITH {TRADES}, {DAILY},
day_vwap AS (
  SELECT *, {_ratio("notional", "volume")} AS v8 FROM daily
),
summed AS (
  SELECT symbol, count(DISTINCT batch_date) AS days_observed, sum(volume) AS tv,
         sum(notional) AS tn, sum(v8) AS sv, count(v8) AS nv,
         min(session_open_at) AS first_trade_at, max(session_close_at) AS last_trade_at
  FROM day_vwap GROUP BY symbol
)
SELECT symbol, days_observed, CAST(tv AS DOUBLE) AS total_volume,
       CAST(tn AS DOUBLE) AS total_notional, {_vwap("tn", "tv")} AS overall_vwap,
       CAST((2 * CAST(sv AS HUGEINT) * 10000 + nv) // (2 * nv) AS DOUBLE) / 1000000000000
         AS avg_daily_vwap,
       first_trade_at, last_trade_at
FROM summed"""


def _intraday(symbol: str, day: str) -> str:
    return (
        f"WITH {TRADES}, {DAILY}, {HOURLY} "
        "SELECT symbol, CAST(batch_date AS VARCHAR) AS batch_date, "
        f"CAST(hour_bucket AS TIMESTAMP) AS hour_bucket, {PRICES}, "
        f"CAST(volume AS DOUBLE) AS volume, {_vwap('notional', 'volume')} AS vwap, trade_count "
        f"FROM hourly WHERE symbol = '{symbol}' AND batch_date = {day} ORDER BY hour_bucket"
    )


VALIDITY = """
SELECT symbol, CAST(batch_date AS VARCHAR) AS batch_date, rows_total, rows_valid,
       rows_total - rows_valid AS rows_invalid, {pct} AS pct_invalid {more}
FROM (SELECT symbol, batch_date, count(*) AS rows_total,
             CAST(sum(CAST(is_valid AS INTEGER)) AS BIGINT) AS rows_valid
      FROM trades GROUP BY symbol, batch_date)"""

_PCT_INVALID = _pct("rows_total - rows_valid", "rows_total")

SILVER_SHOWN = (
    "symbol, CAST(batch_date AS VARCHAR) AS batch_date, agg_trade_id, "
    "CAST(price AS DOUBLE) AS price, CAST(quantity AS DOUBLE) AS quantity, first_trade_id, "
    "last_trade_id, transact_time, is_buyer_maker, is_best_match, is_valid, _ingested_at"
)

BRONZE_SHOWN = (
    "agg_trade_id, price, quantity, first_trade_id, last_trade_id, transact_time, "
    "is_buyer_maker, is_best_match, _source_file_name, _source_file_sha256, _pipeline_run_id, "
    "_ingested_at, symbol, CAST(batch_date AS VARCHAR) AS batch_date"
)

_BRONZE_RULES = [
    *[(c, f"length({c}) >= 1") for c in [
        "agg_trade_id", "price", "quantity", "first_trade_id", "last_trade_id", "transact_time",
        "_source_file_name", "_pipeline_run_id"]],
    ("is_buyer_maker", "is_buyer_maker IS NOT NULL"),
    ("symbol", "regexp_matches(symbol, '^[A-Z0-9]+$')"),
    ("batch_date", "batch_date IS NOT NULL"),
    ("_source_file_sha256", "length(_source_file_sha256) = 64"),
    ("_ingested_at", "TRY_CAST(replace(_ingested_at, '+00:00', '') AS TIMESTAMP) IS NOT NULL"),
]


def _broken(rules: list[tuple[str, str]]) -> str:
    cases = ", ".join(
        f"CASE WHEN coalesce({ok}, false) THEN NULL ELSE '{name}' END" for name, ok in rules
    )
    return f"concat_ws(',', {cases})"


_MALFORMED = "concat_ws(',', {})".format(
    ", ".join(
        f"CASE WHEN {c} IS NOT NULL AND TRY_CAST({c} AS {t}) IS NULL THEN '{c}' END"
        for c, t in [
            ("agg_trade_id", "BIGINT"), ("price", "DECIMAL(38,8)"), ("quantity", "DECIMAL(38,8)"),
            ("first_trade_id", "BIGINT"), ("last_trade_id", "BIGINT"), ("transact_time", "BIGINT"),
        ]
    )
)


def _suite() -> str:
    """The checks one by one, each as its own count."""
    accepted = "('CLICK', 'ERROR', 'PURCHASE', 'SIGNUP', 'VIEW')"
    parts = []

    def add(name: str, source: str) -> None:
        parts.append(f"SELECT '{name}' AS \"check\", count(*) AS failing_rows FROM {source}")

    columns = {
        "silver": ["symbol", "agg_trade_id", "batch_date", "is_valid"],
        "daily": ["symbol", "batch_date", "open_price", "high_price", "low_price", "close_price",
                  "volume", "notional", "trade_count"],
        "hourly": ["symbol", "batch_date", "hour_bucket", "open_price", "close_price"],
        "summary": ["symbol", "days_observed"],
    }
    for name, listed in columns.items():
        for column in listed:
            add(f"not_null_{name}_{column}", f"{name} WHERE {column} IS NULL")
    for name in ["silver", "daily", "hourly"]:
        add(f"accepted_values_{name}_symbol", f"{name} WHERE symbol NOT IN {accepted}")
    add("unique_summary_symbol",
        "(SELECT symbol FROM summary GROUP BY symbol HAVING count(*) > 1)")
    add("unique_daily_symbol_batch_date",
        "(SELECT 1 FROM daily GROUP BY symbol, batch_date HAVING count(*) > 1)")
    hourly = _candles("typed", "hourly", "symbol, batch_date",
                      ", date_trunc('hour', transact_time) AS hour_bucket")
    return (
        f"WITH {TEXT}, silver AS (SELECT * FROM typed), "
        f"{_candles('typed', 'daily', 'symbol, batch_date')}, {hourly}, "
        "summary AS (SELECT symbol, count(DISTINCT batch_date) AS days_observed "
        "FROM daily GROUP BY symbol) "
        f"SELECT *, failing_rows = 0 AS passed FROM ({' UNION ALL '.join(parts)})"
    )


_DOCUMENT_VERSIONS = """
scanned AS (SELECT doc_id, sha256(text) AS sha256 FROM documents),
known AS (SELECT doc_id, sha256(CASE WHEN lang = 'fr' THEN upper(text) ELSE text END) AS sha256
          FROM documents WHERE source <> 'src3')"""

_ORDERS_MERGED = """
WITH batch AS (
  SELECT * REPLACE (o_totalprice * 2 AS o_totalprice),
         CAST(year(o_orderdate) AS INTEGER) AS order_year
  FROM orders WHERE o_orderpriority = '1-URGENT' OR o_orderstatus = 'P'
),
stored AS (
  SELECT *, CAST(year(o_orderdate) AS INTEGER) AS order_year
  FROM orders WHERE o_orderpriority <> '1-URGENT'
)
SELECT * FROM batch
UNION ALL BY NAME
SELECT * FROM stored s WHERE NOT EXISTS
  (SELECT 1 FROM batch b WHERE b.o_orderkey = s.o_orderkey)"""

_ZIP_SCAN = f"""
WITH {TRADES}
SELECT CAST(agg_trade_id AS VARCHAR) AS agg_trade_id, CAST(price AS VARCHAR) AS price,
       CAST(quantity AS VARCHAR) AS quantity, CAST(agg_trade_id AS VARCHAR) AS first_trade_id,
       CAST(agg_trade_id AS VARCHAR) AS last_trade_id,
       CAST(epoch_us(transact_time) AS VARCHAR) AS transact_time,
       CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END AS is_buyer_maker,
       CASE WHEN day(batch_date) > 15 THEN 'true' END AS is_best_match,
       false AS _has_extra_cells,
       symbol || '-aggTrades-' || CAST(batch_date AS VARCHAR) || '-'
         || CAST(agg_trade_id // 20000 AS VARCHAR) || '.zip' AS file_name,
       symbol, CAST(batch_date AS VARCHAR) AS batch_date
FROM trades JOIN events ON event_id = agg_trade_id"""

ORACLES: dict[str, str] = {
    "ohlcv_hourly": f"WITH {TRADES}, {HOURLY} {SELECT_HOURLY}",
    "ohlcv_daily": f"WITH {TRADES}, {DAILY} {SELECT_DAILY}",
    "ohlcv_daily_from_hourly": f"WITH {TRADES}, {DAILY} {SELECT_DAILY}",
    "ohlcv_daily_rounded_products": f"WITH {TRADES}, {DAILY} {SELECT_DAILY}",
    "symbol_summary": SUMMARY,
    "symbol_overview": f"{SUMMARY} ORDER BY total_notional DESC",
    "daily_volume_trend": (
        f"WITH {TRADES}, {DAILY} SELECT symbol, CAST(batch_date AS VARCHAR) AS batch_date, "
        f"{TOTALS} FROM daily ORDER BY symbol, batch_date"
    ),
    "intraday_price_path": _intraday("CLICK", "(SELECT max(batch_date) FROM daily)"),
    "intraday_price_path_on_day": _intraday("VIEW", "DATE '2024-01-15'"),
    "data_freshness": f"""
WITH {TRADES}
SELECT symbol, max(transact_time) AS latest_trade_at,
       count(DISTINCT batch_date) AS days_observed,
       date_sub('hour', max(transact_time), TIMESTAMP '2024-02-01') AS hours_behind_now,
       max(transact_time) AS latest_silver_load_at
FROM trades WHERE is_valid GROUP BY symbol ORDER BY hours_behind_now""",
    "dq_summary": (
        f"WITH {TRADES} {VALIDITY.format(pct=_PCT_INVALID, more='')} "
        "ORDER BY symbol, batch_date DESC"
    ),
    "symbol_rollup": f"""
WITH {TRADES}
SELECT symbol, count(*) AS rows, min(transact_time) AS first_trade,
       max(transact_time) AS last_trade,
       CAST((2 * CAST(sum(price) * 100000000 AS HUGEINT) * 100 + count(*)) // (2 * count(*))
            AS DOUBLE) / 10000000000 AS avg_price,
       CAST(sum(quantity) AS DOUBLE) AS day_volume
FROM trades GROUP BY symbol ORDER BY symbol""",
    "ohlcv_wide_amounts": f"""
WITH {TRADES}, units AS (
  SELECT symbol, batch_date,
         ({_units("price")} + 10000000000000000000 + CAST(agg_trade_id AS HUGEINT))
         * ({_units("quantity")} + CAST(agg_trade_id AS HUGEINT)) AS product
  FROM trades WHERE is_valid),
sums AS (
  SELECT symbol, batch_date, CAST(sum(product) AS HUGEINT) AS total, count(*) AS trade_count
  FROM units GROUP BY symbol, batch_date)
SELECT symbol, CAST(batch_date AS VARCHAR) AS batch_date,
       CAST(total // 10000000000000000 AS VARCHAR) || '.'
       || lpad(CAST(total % 10000000000000000 AS VARCHAR), 16, '0') AS notional, trade_count
FROM sums""",
    "silver_typed": f"WITH {TEXT} SELECT {SILVER_SHOWN} FROM typed",
    "silver_from_bronze": f"WITH {TEXT} SELECT {SILVER_SHOWN} FROM latest",
    "stream_upsert": f"WITH {TEXT} SELECT {SILVER_SHOWN} FROM latest",
    "silver_dedup": """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
             l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
             l_linestatus DESC) AS rn
  FROM lineitem)
WHERE rn = 1""",
    "silver_upsert": _ORDERS_MERGED,
    "upsert_match": _ORDERS_MERGED,
    "dq_not_null": f"""
WITH {TEXT} SELECT first_trade_id, symbol, CAST(batch_date AS VARCHAR) AS batch_date
FROM typed WHERE agg_trade_id IS NULL""",
    "dq_accepted_values": f"""
WITH {TRADES} SELECT agg_trade_id, symbol FROM trades
WHERE symbol NOT IN ('CLICK', 'ERROR', 'PURCHASE')""",
    "dq_unique": """
SELECT o_custkey, count(*) AS n FROM orders WHERE o_custkey IS NOT NULL
GROUP BY o_custkey HAVING count(*) > 1""",
    "dq_unique_combination": """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "dq_suite": _suite(),
    "contract_violations_bronze": f"""
WITH {TEXT} SELECT * FROM (
  SELECT first_trade_id, {_broken(_BRONZE_RULES)} AS violations FROM bronze)
WHERE violations <> ''""",
    "contract_violations_silver": f"""
WITH {TEXT} SELECT * FROM (
  SELECT first_trade_id, {_broken([
      *[(c, f"{c} IS NOT NULL") for c in [
          "agg_trade_id", "price", "quantity", "first_trade_id", "last_trade_id",
          "transact_time", "is_buyer_maker", "is_valid", "_ingested_at"]],
      ("symbol", "regexp_matches(symbol, '^[A-Z0-9]+$')"),
      ("batch_date", "batch_date IS NOT NULL"),
  ])} AS violations FROM typed)
WHERE violations <> ''""",
    "rejection_gate": f"WITH {TRADES} "
    + VALIDITY.format(
        pct=_PCT_INVALID, more=", 100 * (rows_total - rows_valid) <= rows_total AS passed"
    ),
    "row_floor_gate": f"""
WITH {TEXT},
landed AS (SELECT symbol, batch_date, count(*) AS n FROM bronze GROUP BY ALL),
kept AS (SELECT symbol, batch_date, count(*) AS n FROM typed WHERE is_valid GROUP BY ALL),
sides AS (
  SELECT symbol, batch_date, coalesce(landed.n, 0) AS bronze_rows,
         coalesce(kept.n, 0) AS silver_rows
  FROM landed FULL JOIN kept USING (symbol, batch_date)
)
SELECT symbol, CAST(batch_date AS VARCHAR) AS batch_date, bronze_rows, silver_rows,
       {_pct("silver_rows", "bronze_rows")} AS pct_kept,
       100 * silver_rows >= 96 * bronze_rows AS passed
FROM sides""",
    "temporal_violations": f"""
WITH {TRADES},
moved AS (
  SELECT * REPLACE (CASE WHEN quantity = 0 THEN batch_date - 1 ELSE batch_date END AS batch_date)
  FROM trades
),
judged AS (
  SELECT agg_trade_id, symbol, CAST(batch_date AS VARCHAR) AS batch_date, transact_time,
         CASE WHEN CAST(transact_time AS DATE) < DATE '2024-01-05' THEN 'before_earliest_day'
              WHEN CAST(transact_time AS DATE) > batch_date THEN 'after_batch_day' END AS reason
  FROM moved
)
SELECT * FROM judged WHERE reason IS NOT NULL""",
    "quarantine": f"""
WITH {TEXT} SELECT * FROM (
  SELECT first_trade_id, {_broken(_BRONZE_RULES)} AS violations, {_MALFORMED} AS malformed
  FROM bronze)
WHERE violations <> '' OR malformed <> ''""",
    "fingerprint": "SELECT doc_id, sha256(text) AS sha256 FROM documents",
    "change_detection": f"""
WITH {_DOCUMENT_VERSIONS}
SELECT s.doc_id, s.sha256,
       CASE WHEN k.sha256 IS NULL THEN 'new' WHEN k.sha256 = s.sha256 THEN 'unchanged'
            ELSE 'changed' END AS change
FROM scanned s LEFT JOIN known k ON s.doc_id = k.doc_id""",
    "skip_unchanged": f"""
WITH {_DOCUMENT_VERSIONS}
SELECT * FROM scanned s WHERE NOT EXISTS
  (SELECT 1 FROM known k WHERE k.doc_id = s.doc_id AND k.sha256 = s.sha256)""",
    "missing_sources": """
WITH slots AS (
  SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 23:00:00',
                                INTERVAL 1 HOUR)) AS slot
),
symbols AS (SELECT DISTINCT upper(event_type) AS symbol FROM events),
present AS (SELECT DISTINCT upper(event_type) AS symbol, date_trunc('hour', ts) AS slot FROM events)
SELECT symbol, slot FROM symbols, slots
EXCEPT SELECT symbol, slot FROM present""",
    "file_keys": """
SELECT o_orderkey,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'x y' ELSE 'ST' || o_orderstatus END
         || '-aggTrades-' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || '.zip' AS file_name,
       CASE WHEN o_orderpriority <> '5-LOW' THEN 'ST' || o_orderstatus END AS symbol,
       CASE WHEN o_orderpriority <> '5-LOW'
            THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS batch_date
FROM orders""",
    "zip_scan": _ZIP_SCAN,
    "zip_source_scan": _ZIP_SCAN,
    "bronze_round_trip": f"WITH {TEXT} SELECT {BRONZE_SHOWN} FROM bronze",
    "bronze_one_batch": f"""
WITH {TEXT} SELECT symbol, CAST(batch_date AS VARCHAR) AS batch_date, first_trade_id, price
FROM bronze WHERE batch_date = DATE '2024-01-07'""",
    "schema_align": """
SELECT * EXCLUDE (o_orderpriority) FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
UNION ALL BY NAME
SELECT *, 'web' AS o_channel FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'""",
    "run_status": """
WITH counts AS (
  SELECT strftime(ts, '%Y%m%d') || '_' || CAST(user_id AS VARCHAR) AS run_id,
         count(*) AS expected,
         count(*) FILTER (event_type = 'click') AS processed,
         count(*) FILTER (event_type = 'view') AS skipped_unchanged,
         count(*) FILTER (event_type IN ('purchase', 'signup')) AS missing_source,
         count(*) FILTER (event_type = 'error') AS errors
  FROM events GROUP BY 1
)
SELECT *, CASE
    WHEN errors > 0 AND processed = 0 AND skipped_unchanged = 0 THEN 'FAILED'
    WHEN errors > 0 THEN 'PARTIAL'
    WHEN processed = 0 AND missing_source = expected THEN 'WAITING_SOURCE'
    WHEN processed = 0 THEN 'SKIPPED'
    ELSE 'SUCCESS' END AS status
FROM counts""",
    "run_retention": """
WITH log AS (
  SELECT CASE WHEN o_orderpriority = '5-LOW' THEN 'manual'
              WHEN o_orderpriority = '3-MEDIUM' THEN '19981399'
              ELSE strftime(o_orderdate, '%Y%m%d') END
           || '_000000_' || CAST(o_orderkey AS VARCHAR) AS run_id,
         CASE WHEN o_orderpriority NOT IN ('5-LOW', '3-MEDIUM')
              THEN CAST(o_orderdate AS DATE) END AS run_day
  FROM orders
)
SELECT run_id, CAST(run_day AS VARCHAR) AS run_date,
       CASE WHEN run_day IS NULL THEN 'skip'
            WHEN run_day < DATE '1998-08-01' - 50 THEN 'delete' ELSE 'keep' END AS retention
FROM log""",
    "tier_report": """
WITH aged AS (
  SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'bad-records/' WHEN '2-HIGH' THEN 'archive/'
              WHEN '3-MEDIUM' THEN 'bronze/delta/' WHEN '5-LOW' THEN 'silver/'
              ELSE 'bronze/raw/' END AS folder,
         o_orderkey, o_orderdate AS modified,
         CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-02') AS INTEGER) AS age_days
  FROM orders
)
SELECT folder || CAST(o_orderkey AS VARCHAR) AS path, modified, age_days,
       CASE WHEN folder = 'bad-records/' AND age_days > 90 THEN 'delete'
            WHEN folder IN ('bronze/raw/', 'bronze/delta/', 'archive/') AND age_days > 1825
              THEN 'archive'
            WHEN folder IN ('bronze/raw/', 'bronze/delta/') AND age_days > 730 THEN 'cool'
            ELSE 'hot' END AS tier
FROM aged""",
    "compact": "SELECT * FROM lineitem",
    "cluster_by": "SELECT * FROM lineitem",
    "compaction_choice": """
WITH files AS (
  SELECT o_orderpriority || '-' || CAST(year(o_orderdate) AS VARCHAR) AS "partition",
         CAST(o_orderkey AS VARCHAR) AS file, CAST(round(o_totalprice) AS BIGINT) AS bytes
  FROM orders
), ahead AS (
  SELECT *, coalesce(sum(bytes) OVER (
      PARTITION BY "partition" ORDER BY bytes < 400000 DESC, bytes DESC, file
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM files
), binned AS (
  SELECT "partition", file, bytes,
         CASE WHEN bytes < 400000 THEN CAST(start // 400000 AS BIGINT) END AS bin
  FROM ahead
), chosen AS (
  SELECT "partition", count(*) AS files,
         count(DISTINCT bin) + count(*) FILTER (bin IS NULL) AS bins
  FROM binned GROUP BY 1
)
SELECT b."partition", b.file, b.bytes, b.bin, c.files, c.bins
FROM binned b JOIN chosen c USING ("partition") WHERE c.files >= 2 * c.bins""",
    "compact_twice": """
SELECT count(DISTINCT year(o_orderdate)) - 1 AS "first", 0 AS "second",
       count(DISTINCT year(o_orderdate)) AS files, count(*) AS n, sum(o_orderkey)::BIGINT AS keys
FROM orders""",
    "curve_key": f"""
WITH bounds AS (
  SELECT list(s ORDER BY k) AS dates, list(o ORDER BY k) AS orders FROM (
    SELECT unnest(range(1, 32)) AS k, unnest(quantile_disc(l_shipdate, [{_SHARES}])) AS s,
           unnest(quantile_disc(l_orderkey, [{_SHARES}])) AS o
    FROM lineitem)
), placed AS (
  SELECT l_orderkey, l_linenumber,
         len(list_filter(dates, lambda d: d < l_shipdate)) AS a,
         len(list_filter(orders, lambda d: d < l_orderkey)) AS b
  FROM lineitem, bounds
)
SELECT l_orderkey, l_linenumber,
       CAST(list_sum(list_transform(range(0, 5), lambda j:
         (((a >> j) & 1) << (2 * j + 1)) + (((b >> j) & 1) << (2 * j)))) AS BIGINT) AS place
FROM placed""",
    "cluster_by_curve": """
SELECT unnest(['l_shipdate', 'l_orderkey']) AS "column", count(*) AS n, true AS narrow
FROM lineitem""",
    "daily_load_to_gold": f"WITH {TRADES}, {DAILY} {SELECT_DAILY}",
    "backfill_hourly": f"WITH {TRADES}, {HOURLY} {SELECT_HOURLY}",
    "run_log_of_load": f"""
WITH {TRADES}, parts AS (
  SELECT symbol || '-aggTrades-' || CAST(batch_date AS VARCHAR) || '-'
           || CAST(agg_trade_id // 20000 AS VARCHAR) AS name, count(*) AS n
  FROM trades GROUP BY 1
), good AS (
  SELECT CAST(sum(n) AS BIGINT) AS n FROM parts WHERE name || '.zip' <> (SELECT min(name || '.zip') FROM parts)
), stages AS (
  SELECT 'bronze' AS stage, 'PARTIAL' AS status, n + 1 AS rows_in, n AS rows_out, NULL AS dropped FROM good
  UNION ALL SELECT 'silver', 'SUCCESS', n, n, 0 FROM good
  UNION ALL SELECT unnest(['audit', 'gold']), 'SUCCESS', NULL, NULL, NULL
  UNION ALL SELECT 'run', 'PARTIAL', NULL, NULL, NULL
)
SELECT '20240201_000000_first' AS run_id, stage, status, rows_in, rows_out,
       dropped AS duplicates_dropped, true AS timed
FROM stages""",
    "audit_columns": f"""
WITH {TRADES}
SELECT symbol, CAST(batch_date AS VARCHAR) AS batch_date,
       count(DISTINCT agg_trade_id // 20000) AS files,
       '20240201_000000_first' AS bronze_run, '20240201_000000_first' AS silver_run,
       CASE WHEN bool_or(is_valid) THEN '20240201_000000_first' END AS gold_run, 0 AS untimely,
       true AS hashes_carried, CASE WHEN bool_or(is_valid) THEN true END AS gold_after_silver
FROM trades GROUP BY symbol, trades.batch_date""",
    "summary_view": SUMMARY,
    "stream_from_landing": f"""
WITH {TRADES}, {DAILY}, candles AS ({SELECT_DAILY})
SELECT *, CASE WHEN symbol = 'CLICK' THEN 'arrival-1' ELSE 'arrival-0' END AS loaded FROM candles""",
    "gated_load": f"""
WITH {TRADES}, days AS (
  SELECT symbol, batch_date, count(*) AS n, count(*) FILTER (is_valid) AS valid
  FROM trades GROUP BY ALL
), judged AS (SELECT *, 100 * (n - valid) > 1.0 * n AS stopped FROM days)
SELECT symbol, CAST(batch_date AS VARCHAR) AS batch_date,
       CASE WHEN stopped THEN 'error' ELSE 'processed' END AS outcome,
       CASE WHEN stopped THEN 'rejection' ELSE '' END AS reasons,
       CASE WHEN NOT stopped THEN n END AS silver_rows,
       CASE WHEN NOT stopped AND valid > 0 THEN valid END AS trade_count
FROM judged""",
    "backfill_resumed": f"""
WITH {TRADES}, {HOURLY}, days AS (
  SELECT symbol, batch_date,
         CAST(1 + (row_number() OVER (ORDER BY batch_date, symbol) - 1) // 60 AS INTEGER) AS "group"
  FROM (SELECT DISTINCT symbol, batch_date FROM trades)
), rebuilt AS (
  SELECT symbol, batch_date, count(*) AS hours, CAST(sum(volume) AS DOUBLE) AS volume,
         sum(trade_count)::BIGINT AS trades
  FROM hourly GROUP BY ALL
)
SELECT symbol, CAST(batch_date AS VARCHAR) AS batch_date, "group", hours, volume, trades
FROM days LEFT JOIN rebuilt USING (symbol, batch_date)""",
}
