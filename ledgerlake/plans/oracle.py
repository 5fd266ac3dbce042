"""SQL counterparts of the queries, over the given tables, for DuckDB.

Written independently of the Spark code: plain windows and aggregates over whole tables.
"""

from __future__ import annotations

_SOURCE = """CASE WHEN (day(ts) - 1) // 5 + 1 = 6 THEN 'validation.csv'
  ELSE '2024-' || ((day(ts) - 1) // 5 + 1) || '.csv' END"""

_TX = f"""tx AS (SELECT event_id, ts, value AS price, 'user_' || user_id AS user_id,
  {_SOURCE} AS source_file FROM events)"""

_DIRTY = f"""dirty AS (
  SELECT event_id, copy,
    CASE WHEN event_id % 127 = 0 THEN NULL ELSE ts END AS ts,
    CASE WHEN event_id % 127 = 0 THEN 'not a time'
         WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS ts_text,
    CASE WHEN event_id % 97 = 0 OR event_id % 193 = 0 THEN NULL
         WHEN event_id % 89 = 0 THEN -value
         WHEN event_id % 101 = 0 THEN round(value * 100, 2) ELSE value END AS price,
    CASE WHEN event_id % 97 <> 0 AND event_id % 193 = 0 THEN 'abc' END AS bad_price,
    CASE WHEN event_id % 83 <> 0 THEN 'user_' || user_id
         WHEN (event_id // 83) % 4 = 0 THEN 'USER_' || user_id
         WHEN (event_id // 83) % 4 = 1 THEN ' user_' || user_id || ' '
         WHEN (event_id // 83) % 4 = 2 THEN CAST(user_id AS VARCHAR) END AS user_raw,
    CASE WHEN event_id % 83 = 0 AND (event_id // 83) % 4 = 3 THEN NULL
         ELSE 'user_' || user_id END AS user_std,
    {_SOURCE} AS source_file,
    (day(ts) - 1) // 5 + 1 AS feed_no
  FROM events, (SELECT unnest([0, 1]) AS copy)
  WHERE copy = 0 OR event_id % 50 = 0),
judged AS (
  SELECT *, CASE WHEN bad_price IS NOT NULL THEN 'price_not_numeric' WHEN price IS NULL THEN 'price_null'
    WHEN isinf(price) THEN 'price_not_finite' WHEN price <= 0 THEN 'price_not_positive'
    WHEN price > 1e13 THEN 'price_out_of_range' END AS reject_reason FROM dirty),
kept AS (SELECT * FROM judged WHERE reject_reason IS NULL)"""

_WILD = _DIRTY.replace(
    "CASE WHEN event_id % 97 = 0 OR event_id % 193 = 0 THEN NULL",
    "CASE WHEN event_id % 307 = 0 THEN 'inf'::DOUBLE WHEN event_id % 311 = 0 THEN '-inf'::DOUBLE WHEN event_id % 313 = 0 THEN 1e17 "
    "WHEN event_id % 97 = 0 OR event_id % 193 = 0 THEN NULL",
).replace(
    "CASE WHEN event_id % 97 <> 0 AND event_id % 193 = 0",
    "CASE WHEN event_id % 307 <> 0 AND event_id % 311 <> 0 AND event_id % 313 <> 0 AND event_id % 97 <> 0 AND event_id % 193 = 0",
)

_SUM = "CAST(SUM(CAST({0} AS DECIMAL(18,2))) AS DOUBLE)"


def _money(column: str) -> str:
    return _SUM.format(column)


def _partials(size: int = 1000) -> str:
    kept_price = "CASE WHEN reject_reason IS NULL THEN price END"
    return f"""{_DIRTY},
numbered AS (
  SELECT *, (row_number() OVER (PARTITION BY source_file ORDER BY event_id, copy) - 1) // {size} + 1 AS batch_number
  FROM judged),
partials AS (
  SELECT source_file, feed_no, batch_number, count(*) AS rows_in, count(reject_reason) AS rows_rejected,
    count({kept_price}) AS rows_processed, SUM(CAST({kept_price} AS DECIMAL(18,2))) AS batch_total,
    MIN({kept_price}) AS batch_min, MAX({kept_price}) AS batch_max
  FROM numbered GROUP BY ALL)"""


def _history(size: int = 1000) -> str:
    return f"""{_partials(size)},
running AS (
  SELECT *, row_number() OVER o AS batch_seq, md5(source_file || '/' || batch_number) AS batch_id,
    CAST(batch_total AS DOUBLE) / rows_processed AS batch_avg,
    CAST(coalesce(SUM(rows_processed) OVER b, 0) AS BIGINT) AS running_count_before,
    CAST(SUM(rows_processed) OVER a AS BIGINT) AS running_count_after,
    CAST(SUM(batch_total) OVER b AS DOUBLE) AS running_sum_before,
    CAST(SUM(batch_total) OVER a AS DOUBLE) AS running_sum_after,
    MIN(batch_min) OVER b AS running_min_before, MIN(batch_min) OVER a AS running_min_after,
    MAX(batch_max) OVER b AS running_max_before, MAX(batch_max) OVER a AS running_max_after
  FROM partials
  WINDOW o AS (ORDER BY feed_no, batch_number),
    b AS (ORDER BY feed_no, batch_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    a AS (ORDER BY feed_no, batch_number ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
history AS (
  SELECT *, running_sum_before / nullif(running_count_before, 0) AS running_avg_before,
    running_sum_after / nullif(running_count_after, 0) AS running_avg_after FROM running)"""


def _state(source: str, price: str = "price", group: str = "") -> str:
    keys, tail = (f"{group}, ", f" GROUP BY {group}") if group else ("", "")
    return f"""SELECT {keys}count(*) AS "count", {_money(price)} AS "sum", {_money(price)} / count(*) AS "avg",
  MIN({price}) AS "min", MAX({price}) AS "max" FROM {source}{tail}"""


_STATE_JSON = """'{"count":' || CAST("count" AS VARCHAR) || ',"sum":' || coalesce(CAST("sum" AS VARCHAR), 'null')
  || ',"min":' || coalesce(CAST("min" AS VARCHAR), 'null') || ',"max":' || coalesce(CAST("max" AS VARCHAR), 'null')
  || ',"avg":' || coalesce(CAST("avg" AS VARCHAR), 'null') || '}'"""

_METRICS = ("count", "sum", "avg", "min", "max")


def _long(state: str, value: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{m}' AS metric, CAST("{m}" AS DOUBLE) AS {value} FROM {state}""" for m in _METRICS
    )


def _match(a: str, b: str) -> str:
    return f"CASE WHEN {a} IS NULL AND {b} IS NULL THEN true WHEN {a} IS NULL OR {b} IS NULL THEN false ELSE abs({a} - {b}) < 1e-6 END"


def _period(level: str, ts: str = "ts") -> str:
    unit = {"daily": "day", "weekly": "week", "monthly": "month"}[level]
    return f"CAST(date_trunc('{unit}', {ts}) AS DATE)"


def _price_metrics(level: str, source: str = "tx") -> str:
    wide = f"""SELECT {_period(level)} AS date_partition, count(*) AS transaction_count, {_money('price')} AS price_sum,
      {_money('price')} / count(*) AS price_avg, MIN(price) AS price_min, MAX(price) AS price_max
      FROM {source} GROUP BY 1"""
    names = ("transaction_count", "price_sum", "price_avg", "price_min", "price_max")
    return " UNION ALL ".join(
        f"""SELECT '{n}' AS metric_name, CAST({n} AS DOUBLE) AS metric_value,
        '{'transaction_count' if n == 'transaction_count' else 'price_statistics'}' AS metric_type,
        date_partition, '{level}' AS aggregation_level FROM ({wide})"""
        for n in names
    )


def _user_metrics(level: str, source: str = "tx") -> str:
    wide = f"""SELECT {_period(level)} AS date_partition, count(DISTINCT user_id) AS unique_users,
      {_money('price')} / count(DISTINCT user_id) AS spend_per_user,
      count(*) / count(DISTINCT user_id) AS transactions_per_user FROM {source} GROUP BY 1"""
    return " UNION ALL ".join(
        f"""SELECT '{n}' AS metric_name, CAST({n} AS DOUBLE) AS metric_value, 'user_analytics' AS metric_type,
        date_partition, '{level}' AS aggregation_level FROM ({wide})"""
        for n in ("unique_users", "spend_per_user", "transactions_per_user")
    )


def _temporal_metrics(level: str, source: str = "tx") -> str:
    parts = []
    for prefix, slot in (("hour", "hour(ts)"), ("weekday", "isodow(ts)")):
        wide = f"""SELECT {_period(level)} AS date_partition, {slot} AS slot, count(*) AS n,
          {_money('price')} / count(*) AS a FROM {source} GROUP BY 1, 2"""
        for name, col in (("count", "n"), ("avg_price", "a")):
            parts.append(
                f"""SELECT '{prefix}_' || lpad(CAST(slot AS VARCHAR), 2, '0') || '_{name}' AS metric_name,
                CAST({col} AS DOUBLE) AS metric_value, 'temporal_patterns' AS metric_type, date_partition,
                '{level}' AS aggregation_level FROM ({wide})"""
            )
    return " UNION ALL ".join(parts)


def _gold(level: str, source: str = "tx") -> str:
    return f"{_price_metrics(level, source)} UNION ALL {_user_metrics(level, source)} UNION ALL {_temporal_metrics(level, source)}"


_ORDERS = """tx AS (SELECT o_orderkey AS event_id, o_orderdate AS ts, o_totalprice AS price,
  'user_' || o_custkey AS user_id, year(o_orderdate) || '.csv' AS source_file FROM orders)"""

_LINEITEMS = """tx AS (SELECT l_shipdate AS ts, l_extendedprice AS price, 'user_' || l_suppkey AS user_id FROM lineitem)"""

_ISO = "strftime({0}, '%Y-%m-%dT%H:%M:%S.%f')"

_RULES = """coalesce(ts IS NOT NULL, false) AS r1,
  coalesce(ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-29', false) AS r2,
  coalesce(price BETWEEN 0.01 AND 10000.0, false) AS r3, user_std IS NOT NULL AS r4"""

_DRIFT = f"""SELECT count(*) FILTER (source_file <> 'validation.csv') AS count_before,
    CAST(SUM(CAST(price AS DECIMAL(18,2))) FILTER (source_file <> 'validation.csv') AS DOUBLE)
      / count(*) FILTER (source_file <> 'validation.csv') AS avg_before,
    MIN(price) FILTER (source_file <> 'validation.csv') AS min_before,
    MAX(price) FILTER (source_file <> 'validation.csv') AS max_before,
    count(*) AS count_after, {_money('price')} / count(*) AS avg_after,
    MIN(price) AS min_after, MAX(price) AS max_after FROM kept"""

_DRIFT_QUERY = f"""WITH {_DIRTY}, d AS ({_DRIFT})
SELECT *, count_after - count_before AS count_added, avg_after - avg_before AS avg_change,
  min_after < min_before AS new_min, max_after > max_before AS new_max FROM d"""

_QUALITY = {
    "null_timestamp": ("ts IS NULL", 0.01),
    "null_price": ("price IS NULL", 0.01),
    "null_user_id": ("user_std IS NULL", 0.01),
    "timestamp_range": ("ts < TIMESTAMP '2024-01-01' OR ts >= TIMESTAMP '2024-01-29'", 0.0),
    "price_range": ("price < 0.01 OR price > 50000.0", 0.0),
    "user_id_pattern": ("NOT regexp_full_match(user_std, 'user_[0-9]+')", 0.0),
}


def _quality(bad_result: str, nulls: float = 0.01, highest: str = "50000.0") -> str:
    parts = [
        f"""SELECT source_file, '{name}' AS check_type, count(*) FILTER ({test.replace('50000.0', highest)}) AS bad, count(*) AS total,
        {nulls if limit else 0.0} AS lim FROM dirty GROUP BY source_file"""
        for name, (test, limit) in _QUALITY.items()
    ]
    parts.append(
        """SELECT source_file, 'duplicates', CAST(SUM(CASE WHEN ts IS NULL OR user_std IS NULL OR price IS NULL THEN 0 ELSE n - 1 END) AS BIGINT),
        CAST(SUM(n) AS BIGINT), 0.0 FROM (SELECT source_file, ts, user_std, price, count(*) AS n FROM dirty GROUP BY ALL) GROUP BY source_file"""
    )
    return f"""WITH {_DIRTY}, checks AS ({' UNION ALL '.join(parts)})
SELECT source_file AS batch_id, check_type, CASE WHEN bad / total <= lim THEN 'passed' ELSE '{bad_result}' END AS check_result,
  bad || ' of ' || total || ' rows' AS details FROM checks"""


def _neighbour_fill(direction: str) -> str:
    frame = {
        "forward": "last_value(price IGNORE NULLS) OVER (PARTITION BY source_file ORDER BY event_id, copy ROWS UNBOUNDED PRECEDING)",
        "backward": "first_value(price IGNORE NULLS) OVER (PARTITION BY source_file ORDER BY event_id, copy "
        "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)",
    }[direction]
    return f"""WITH {_DIRTY} SELECT event_id, copy, source_file, round({frame}, 6) AS filled_price,
  coalesce(user_std, 'unknown') AS user_id FROM dirty"""


def _middle_fill(function: str) -> str:
    return f"""WITH {_DIRTY}, m AS (SELECT source_file, {function} AS fill FROM dirty GROUP BY source_file)
SELECT event_id, copy, source_file, round(coalesce(price, fill), 6) AS filled_price,
  coalesce(user_std, 'unknown') AS user_id FROM dirty JOIN m USING (source_file)"""


def _reconciled(extra: str = "") -> str:
    return f"""s AS ({_state('kept')}), l AS ({_long('s', 'v')})
SELECT metric, v AS incremental, v AS direct, 0.0::DOUBLE AS difference, true AS matches,
  metric <> 'sum' AS compared{extra} FROM l"""


ORACLE: dict[str, str] = {
    "running_stats_reconcile": f"""WITH {_TX}, kept AS (SELECT * FROM tx WHERE price > 0), {_reconciled()}""",
    "batch_history": f"""WITH {_history()} SELECT source_file, batch_number, batch_seq, batch_id, rows_in, rows_rejected,
  rows_processed, batch_min, batch_max, batch_avg, running_count_before, running_count_after, running_sum_after,
  running_min_after, running_max_after, running_avg_after FROM history""",
    "batch_snapshots": f"""WITH {_history()}, s AS (SELECT batch_id, source_file, batch_number,
  running_count_before AS "count", running_sum_before AS "sum", running_min_before AS "min",
  running_max_before AS "max", running_avg_before AS "avg" FROM history)
SELECT batch_id, source_file, batch_number, {_STATE_JSON} AS stats_snapshot FROM s""",
    "last_batch": f"""WITH {_history()} SELECT batch_seq, source_file, batch_number, rows_processed, batch_min, batch_max,
  running_count_after, running_avg_after FROM history ORDER BY batch_seq DESC LIMIT 1""",
    "progress_every_5": f"""WITH {_history(100)} SELECT source_file, batch_number, running_count_after,
  source_file || ': batch ' || batch_number || ', ' || format('{{:,}}', running_count_after) || ' rows so far' AS line
FROM history WHERE batch_number % 5 = 0""",
    "history_cap": f"""WITH {_history(100)} SELECT batch_seq, source_file, batch_number, rows_processed FROM
  (SELECT *, row_number() OVER (ORDER BY batch_seq DESC) AS back FROM history) WHERE back <= 50""",
    "engine_metrics": f"""WITH {_partials()} SELECT count(*) AS total_batches_processed,
  CAST(SUM(rows_processed) AS BIGINT) AS total_rows_processed, avg(rows_processed) AS avg_batch_size,
  count(*) / count(DISTINCT source_file) AS batches_per_file FROM partials WHERE rows_processed > 0""",
    "file_rollup": f"""WITH {_partials()} SELECT source_file, count(DISTINCT source_file) AS files,
  CAST(SUM(rows_in) AS BIGINT) AS rows_in, CAST(SUM(rows_processed) AS BIGINT) AS rows_processed,
  CAST(SUM(rows_rejected) AS BIGINT) AS rows_filtered, count(*) AS batches FROM partials GROUP BY ROLLUP (source_file)""",
    "stored_batches": f"""WITH {_partials()} SELECT source_file, batch_number, rows_in FROM partials""",
    "update_per_file": f"""WITH {_DIRTY} SELECT source_file, count(*) AS rows_in, count(reject_reason) AS rows_rejected,
  count(*) FILTER (reject_reason IS NULL) AS rows_processed,
  CAST(SUM(CAST(price AS DECIMAL(18,2))) FILTER (reject_reason IS NULL) AS DOUBLE) AS batch_sum,
  MIN(price) FILTER (reject_reason IS NULL) AS batch_min, MAX(price) FILTER (reject_reason IS NULL) AS batch_max
FROM judged GROUP BY source_file""",
    "batch_status_latest": f"""WITH {_DIRTY}, l AS (SELECT feed_no - 1 AS ingest_batch, count(*) FILTER (reject_reason IS NULL) AS k,
  count(reject_reason) AS r FROM judged GROUP BY 1)
SELECT 'main' AS phase, ingest_batch, CASE WHEN ingest_batch IN (2, 3) THEN 'failed' ELSE 'completed' END AS status,
  CASE WHEN ingest_batch NOT IN (2, 3) THEN k END AS rows_processed, CASE WHEN ingest_batch NOT IN (2, 3) THEN r END AS rows_rejected,
  ingest_batch IN (2, 3) AS says_why FROM l""",
    "batch_summary": f"""WITH {_DIRTY}, l AS (SELECT feed_no - 1 AS n, count(*) AS k FROM kept GROUP BY 1)
SELECT count(*) AS total_batches, CAST(SUM(k) FILTER (n NOT IN (2, 3)) AS BIGINT) AS total_rows,
  avg(k) FILTER (n NOT IN (2, 3)) AS avg_batch_size, count(*) FILTER (n NOT IN (2, 3)) AS completed_batches,
  count(*) FILTER (n IN (2, 3)) AS failed_batches, count(*) FILTER (n NOT IN (2, 3)) * 100.0::DOUBLE / count(*) AS success_rate FROM l""",
    "direct_stats": f"""WITH {_DIRTY} {_state('kept')}""",
    "lineitem_stats": f"""WITH t AS (SELECT lower(l_returnflag) || '.csv' AS source_file, l_extendedprice AS price FROM lineitem)
{_state('t', group='source_file')}""",
    "lineitem_incremental": f"""WITH t AS (SELECT lower(l_returnflag) || '.csv' AS source_file, l_extendedprice AS price
  FROM lineitem WHERE l_extendedprice > 0) {_state('t', group='source_file')}""",
    "lineitem_history": f"""WITH t AS (SELECT lower(l_returnflag) || '.csv' AS source_file, l_extendedprice AS price,
  (row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1) // 1000 + 1
  AS batch_number FROM lineitem),
p AS (SELECT source_file, batch_number, count(*) AS rows_processed, SUM(CAST(price AS DECIMAL(18,2))) AS s, MIN(price) AS lo,
  MAX(price) AS hi FROM t GROUP BY ALL),
r AS (SELECT source_file, batch_number, row_number() OVER w AS batch_seq, rows_processed,
  CAST(SUM(rows_processed) OVER w AS BIGINT) AS running_count_after, CAST(SUM(s) OVER w AS DOUBLE) AS running_sum_after,
  MIN(lo) OVER w AS running_min_after, MAX(hi) OVER w AS running_max_after FROM p
  WINDOW w AS (ORDER BY source_file, batch_number ROWS UNBOUNDED PRECEDING))
SELECT *, running_sum_after / running_count_after AS running_avg_after FROM r""",
    "lineitem_describe": """SELECT lower(l_returnflag) || '.csv' AS source_file, count(*) AS "count", round(avg(l_extendedprice), 6) AS mean,
  round(stddev_samp(l_extendedprice), 6) AS std, MIN(l_extendedprice) AS "min", round(quantile_cont(l_extendedprice, 0.25), 6) AS q25,
  round(quantile_cont(l_extendedprice, 0.5), 6) AS q50, round(quantile_cont(l_extendedprice, 0.75), 6) AS q75,
  MAX(l_extendedprice) AS "max" FROM lineitem GROUP BY 1""",
    "report_stats": f"""WITH {_DIRTY} SELECT count(*) AS "count", round({_money('price')} / count(*), 2) AS avg_price,
  round(MIN(price), 2) AS min_price, round(MAX(price), 2) AS max_price, count(DISTINCT user_raw) AS unique_users,
  count(DISTINCT source_file) AS unique_files FROM kept""",
    "record_count": f"""WITH {_DIRTY} SELECT count(*) AS total_records FROM kept""",
    "price_describe": f"""WITH {_DIRTY} SELECT source_file, count(price) AS "count", round(avg(price), 6) AS mean,
  round(stddev_samp(price), 6) AS std, MIN(price) AS "min", round(quantile_cont(price, 0.25), 6) AS q25,
  round(quantile_cont(price, 0.5), 6) AS q50, round(quantile_cont(price, 0.75), 6) AS q75, MAX(price) AS "max"
FROM dirty GROUP BY source_file""",
    "std_median": f"""WITH {_DIRTY} SELECT source_file, round(stddev_samp(price), 6) AS std,
  round(quantile_cont(price, 0.5), 6) AS median FROM dirty GROUP BY source_file""",
    "users_per_file": f"""WITH {_DIRTY} SELECT source_file, count(DISTINCT user_raw) AS unique_users FROM dirty GROUP BY source_file""",
    "stats_text": f"""WITH {_partials()}, b AS (SELECT source_file, count(*) AS batches FROM partials GROUP BY 1),
s AS (SELECT * FROM ({_state('kept', group='source_file')}) JOIN b USING (source_file))
SELECT source_file, format('Count: {{:,}}, Avg: ${{:.2f}}, Min: ${{:.2f}}, Max: ${{:.2f}}', "count", "avg", "min", "max") AS line,
  format('Records: {{:,}}' || chr(10) || 'Total: ${{:,.2f}}' || chr(10) || 'Average: ${{:.2f}}' || chr(10) || 'Minimum: ${{:.2f}}'
   || chr(10) || 'Maximum: ${{:.2f}}' || chr(10) || 'Batches: {{}}', "count", "sum", "avg", "min", "max", batches) AS block FROM s""",
    "clean_kept": f"""WITH {_DIRTY} SELECT event_id, copy, price, user_raw AS user_id, source_file FROM kept""",
    "clean_rejects": f"""WITH {_DIRTY} SELECT event_id, copy, price, bad_price, source_file, reject_reason FROM judged
WHERE reject_reason IS NOT NULL""",
    "clean_counts": f"""WITH {_DIRTY} SELECT source_file, count(*) AS rows_in, count(*) FILTER (reject_reason IS NULL) AS rows_kept,
  count(*) FILTER (reject_reason = 'price_null') AS rejected_null, count(*) FILTER (reject_reason = 'price_not_positive') AS rejected_not_positive,
  count(*) FILTER (reject_reason = 'price_not_numeric') AS rejected_not_numeric, count(*) FILTER (reject_reason = 'price_not_finite')
  AS rejected_not_finite, count(*) FILTER (reject_reason = 'price_out_of_range') AS rejected_out_of_range FROM judged GROUP BY source_file""",
    "wild_counts": f"""WITH {_WILD} SELECT source_file, count(*) AS rows_in, count(*) FILTER (reject_reason IS NULL) AS rows_kept,
  count(*) FILTER (reject_reason = 'price_null') AS rejected_null, count(*) FILTER (reject_reason = 'price_not_positive') AS rejected_not_positive,
  count(*) FILTER (reject_reason = 'price_not_numeric') AS rejected_not_numeric, count(*) FILTER (reject_reason = 'price_not_finite')
  AS rejected_not_finite, count(*) FILTER (reject_reason = 'price_out_of_range') AS rejected_out_of_range FROM judged GROUP BY source_file""",
    "wild_rejects": f"""WITH {_WILD} SELECT event_id, copy, source_file, reject_reason FROM judged WHERE reject_reason IS NOT NULL""",
    "wild_stats": f"""WITH {_WILD} {_state('kept', group='source_file')}""",
    "reconcile_detects_loss": """SELECT * FROM (VALUES ('whole', true), ('lost', false), ('doubled', false)) v(store, overall_match)
WHERE (SELECT count(*) FROM events) > 0""",
    "customer_balances": """SELECT CAST(c_nationkey AS VARCHAR) AS source_file, count(*) AS rows_in,
  count(*) FILTER (c_acctbal > 0) AS rows_kept, count(*) FILTER (c_acctbal <= 0) AS rejected_not_positive FROM customer GROUP BY 1""",
    "null_profile": f"""WITH {_DIRTY}, n AS (
  SELECT source_file, 'timestamp' AS column_name, count(*) FILTER (ts_text IS NULL) AS null_count, count(*) AS total_rows FROM dirty GROUP BY 1
  UNION ALL SELECT source_file, 'price', count(*) FILTER (price IS NULL), count(*) FROM dirty GROUP BY 1
  UNION ALL SELECT source_file, 'user_id', count(*) FILTER (user_raw IS NULL), count(*) FROM dirty GROUP BY 1)
SELECT source_file, total_rows, column_name, null_count, round(null_count * 100.0::DOUBLE / total_rows, 6) AS null_percent FROM n""",
    "safe_float": f"""WITH {_DIRTY} SELECT event_id, copy, coalesce(price, 0.0) AS price,
  CAST(bad_price IS NOT NULL AS INTEGER) AS not_numeric FROM dirty""",
    "transactions_table": f"""WITH {_DIRTY} SELECT ts_text AS "timestamp", price, user_raw AS user_id, source_file,
  md5(source_file) AS batch_id, CAST(NULL AS VARCHAR) AS processing_metadata, reject_reason FROM judged""",
    "format_sizes": """WITH s AS (SELECT o_orderkey, CAST(o_orderkey * o_orderkey * 997 AS DOUBLE) AS n FROM orders)
SELECT o_orderkey,
  CASE WHEN n < 1024.0 THEN printf('%.1f B', n) WHEN n < 1048576.0 THEN printf('%.1f KB', n / 1024.0)
    WHEN n < 1073741824.0 THEN printf('%.1f MB', n / 1048576.0) WHEN n < 1099511627776.0 THEN printf('%.1f GB', n / 1073741824.0)
    ELSE printf('%.1f TB', n / 1099511627776.0) END AS one_decimal,
  CASE WHEN n = 0 THEN '0 B' WHEN n < 1024.0 THEN CAST(round_even(n, 2) AS VARCHAR) || ' B'
    WHEN n < 1048576.0 THEN CAST(round_even(n / 1024.0, 2) AS VARCHAR) || ' KB'
    WHEN n < 1073741824.0 THEN CAST(round_even(n / 1048576.0, 2) AS VARCHAR) || ' MB'
    WHEN n < 1099511627776.0 THEN CAST(round_even(n / 1073741824.0, 2) AS VARCHAR) || ' GB'
    ELSE CAST(round_even(n / 1099511627776.0, 2) AS VARCHAR) || ' TB' END AS two_decimals FROM s""",
    "batch_ids": f"""WITH {_TX}, n AS (SELECT *, (row_number() OVER (PARTITION BY source_file ORDER BY ts, event_id) - 1) // 100 + 1
  AS batch_number FROM tx), b AS (SELECT source_file, batch_number, MIN(ts) AS first_ts FROM n GROUP BY ALL)
SELECT source_file, batch_number, replace(source_file, '.csv', '') AS file_stem,
  replace(source_file, '.csv', '') || '_batch_' || printf('%04d', batch_number) || '_' || strftime(first_ts, '%Y%m%d_%H%M%S') AS stamped_id,
  md5(source_file || '/' || batch_number) AS batch_id, {_ISO.format('first_ts')} AS started_at FROM b""",
    "state_json": f"""WITH {_DIRTY} {_state('kept', group='source_file')}""",
    "snapshot_values": f"""WITH {_history()} SELECT batch_id, running_count_before AS "count", running_sum_before AS "sum",
  running_min_before AS "min", running_max_before AS "max", running_avg_before AS "avg" FROM history""",
    "compare_sources": f"""WITH {_DIRTY}, s AS ({_state('kept')}), u AS ({_state('(SELECT * FROM dirty WHERE price IS NOT NULL)')}),
b AS ({_long('s', 'reference_value')}), c AS (
  SELECT 'incremental' AS source, metric, v AS compare_value FROM ({_long('s', 'v')})
  UNION ALL SELECT 'uncleaned', metric, v FROM ({_long('u', 'v')}))
SELECT source, metric, reference_value, compare_value, abs(reference_value - compare_value) AS difference,
  {_match('reference_value', 'compare_value')} AS matches FROM c JOIN b USING (metric) WHERE metric <> 'sum'""",
    "per_file_reconcile": f"""WITH {_DIRTY} SELECT DISTINCT source_file, true AS overall_match, 0::BIGINT AS mismatches FROM kept""",
    "heldout_drift": _DRIFT_QUERY,
    "audit_record": f"""WITH {_DIRTY}, s AS ({_state('kept')}), j AS (SELECT '{{"count":' || "count" || ',"sum":' || "sum"
  || ',"avg":' || "avg" || ',"min":' || "min" || ',"max":' || "max" || '}}' AS j FROM s)
SELECT 'run-1' AS run_id, j AS incremental_stats, j AS database_stats, 1::INTEGER AS verification_passed, 'final' AS notes
FROM j, range(2)""",
    "bronze_roundtrip": f"""WITH {_DIRTY} SELECT ts_text AS "timestamp", price, user_raw AS user_id, bad_price,
  'bronze_converter' AS bronze_created_by, source_file FROM dirty""",
    "csv_profile": f"""WITH {_DIRTY} SELECT source_file, count(*) AS row_count, 'event_id,copy,timestamp,price,user_id' AS columns,
  1::BIGINT AS n_layouts, true AS valid, true AS has_bytes FROM dirty GROUP BY source_file""",
    "csv_samples": f"""WITH {_DIRTY} SELECT source_file, event_id, copy,
  CASE WHEN event_id % 97 = 0 THEN 'NA' WHEN event_id % 193 = 0 THEN 'abc' ELSE CAST(price AS VARCHAR) END AS price, sample_no
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY source_file ORDER BY event_id, copy) AS INTEGER) AS sample_no FROM dirty)
WHERE sample_no <= 3""",
    "parquet_profile": f"""WITH {_DIRTY} SELECT source_file, count(*) AS row_count, 7::INTEGER AS column_count,
  'SNAPPY' AS compression, 0::BIGINT AS corrupt_files FROM dirty GROUP BY source_file""",
    "conversion_totals": f"""WITH {_DIRTY}, f AS (SELECT source_file, count(*) AS n FROM dirty GROUP BY 1)
SELECT count(*) AS total_files, count(*) AS converted_files, 0::BIGINT AS failed_files, CAST(SUM(n) AS BIGINT) AS total_rows,
  CAST(SUM((n + 999) // 1000) AS BIGINT) AS total_batches, CAST(SUM(n) AS DOUBLE) / CAST(SUM((n + 999) // 1000) AS DOUBLE) AS avg_batch_size,
  true AS success FROM f""",
    "size_compare": f"""WITH {_DIRTY} SELECT replace(source_file, '.csv', '') AS file_stem, true AS csv_exists, true AS parquet_exists,
  CAST(length('event_id,copy,timestamp,price,user_id') + 1 + SUM(length(CAST(event_id AS VARCHAR)) + 1 + 1 + 1 + length(ts_text) + 1
    + length(CASE WHEN event_id % 97 = 0 THEN 'NA' ELSE coalesce(bad_price, CAST(price AS VARCHAR)) END) + 1
    + length(coalesce(user_raw, 'null')) + 1) AS BIGINT) AS csv_size,
  true AS parquet_has_bytes, true AS consistent FROM dirty GROUP BY source_file""",
    "missing_files": """SELECT source_file, feed_no::INTEGER AS feed_no FROM (VALUES ('2024-1.csv', 1), ('2024-2.csv', 2), ('2024-3.csv', 3),
  ('2024-4.csv', 4), ('2024-5.csv', 5), ('validation.csv', 6), ('2024-6.csv', 7), ('2024-7.csv', 8)) e(source_file, feed_no)
WHERE source_file NOT IN (SELECT """ + _SOURCE + """ FROM events)""",
    "layer_totals": f"""WITH {_DIRTY} SELECT 7::BIGINT AS files_expected, count(DISTINCT source_file) AS files_found,
  7 - count(DISTINCT source_file) AS missing, 0::BIGINT AS corrupt, count(*) AS total_rows, false AS valid FROM dirty""",
    "layer_status": f"""WITH {_TX}, c AS (SELECT count(DISTINCT source_file) AS n FROM tx) SELECT 'bronze' AS component,
  CASE WHEN n >= 5 THEN 'success' WHEN n > 0 THEN 'warning' ELSE 'error' END AS status, n AS sources, n >= 6 AS gate_open FROM c""",
    "source_selection": f"""WITH {_DIRTY} SELECT DISTINCT CAST(feed_no AS INTEGER) AS feed_no, source_file,
  source_file <> 'validation.csv' AS in_main FROM dirty""",
    "feed_folder": f"""WITH {_TX} SELECT true AS is_the_feed, count(DISTINCT source_file) AS n_sources, false AS is_root FROM tx""",
    "latest_report": """SELECT 'daily_report_' || strftime(MAX(ts), '%Y%m%d') || '.txt' AS report,
  strftime(MAX(ts), '%Y%m%d') AS report_date FROM events""",
    "schema_evolution": f"""WITH {_DIRTY}
SELECT 'event_id' AS field, 'bigint' AS old_type, 'bigint' AS new_type, 'same' AS change, count(event_id) AS rows_with_value FROM dirty
UNION ALL SELECT 'copy', 'int', 'int', 'same', count(copy) FROM dirty
UNION ALL SELECT 'price', 'double', 'double', 'same', count(price) FROM dirty
UNION ALL SELECT 'source_file', 'string', 'string', 'same', count(source_file) FROM dirty
UNION ALL SELECT 'user_id', NULL, 'string', 'added', count(user_raw) FILTER (source_file = 'validation.csv') FROM dirty""",
    "schema_checks": f"""WITH {_DIRTY}, c AS (
  SELECT source_file, 'missing_columns' AS check_type, 0::BIGINT AS affected_rows, count(*) AS row_count FROM judged GROUP BY 1
  UNION ALL SELECT source_file, 'non_numeric_price', count(*) FILTER (reject_reason = 'price_not_numeric'), count(*) FROM judged GROUP BY 1
  UNION ALL SELECT source_file, 'null_price', count(*) FILTER (reject_reason = 'price_null'), count(*) FROM judged GROUP BY 1
  UNION ALL SELECT source_file, 'null_timestamp', count(*) FILTER (ts_text IS NULL), count(*) FROM judged GROUP BY 1
  UNION ALL SELECT source_file, 'null_user_id', count(*) FILTER (user_raw IS NULL), count(*) FROM judged GROUP BY 1)
SELECT source_file, row_count, check_type, affected_rows, CASE WHEN affected_rows = 0 THEN 'passed' ELSE 'warning' END AS check_result,
  round(affected_rows * 100.0::DOUBLE / row_count, 2) AS percent FROM c""",
    "silver_clean": f"""WITH {_DIRTY}, r AS (SELECT *, {_RULES} FROM dirty)
SELECT DISTINCT md5(coalesce({_ISO.format('ts')}, '') || '|' || coalesce(user_std, '') || '|' || coalesce(CAST(price AS VARCHAR), '')
  || '|' || source_file || CASE WHEN ts IS NULL OR user_std IS NULL OR price IS NULL
    THEN '|' || ts_text || '|' || coalesce(user_raw, '') || '|' || coalesce(bad_price, '') ELSE '' END) AS transaction_id, {_ISO.format('ts')} AS "timestamp", price, user_std AS user_id, source_file,
  r1 AND r2 AND r3 AND r4 AS is_valid, (r1::INT + r2::INT + r3::INT + r4::INT) / 4.0::DOUBLE AS quality_score FROM r""",
    "invalid_records": f"""WITH {_DIRTY}, r AS (SELECT *, {_RULES} FROM dirty)
SELECT event_id, copy, price, source_file FROM r WHERE NOT (r1 AND r2 AND r3 AND r4)""",
    "dedup": f"""WITH {_DIRTY} SELECT event_id, copy, price, user_std AS user_id, source_file, copies FROM (
  SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY ts, user_std, price, source_file, own) AS copies
  FROM (SELECT *, CASE WHEN ts IS NULL OR user_std IS NULL OR price IS NULL THEN event_id || '/' || copy END AS own FROM dirty)
  WINDOW w AS (PARTITION BY ts, user_std, price, source_file, own ORDER BY event_id, copy)) WHERE rn = 1""",
    "duplicate_report": f"""WITH {_DIRTY}, k AS (SELECT source_file, ts, user_std, price, count(*) AS n FROM dirty GROUP BY ALL),
x AS (SELECT *, CASE WHEN ts IS NULL OR user_std IS NULL OR price IS NULL THEN 0 ELSE n - 1 END AS extra FROM k)
SELECT source_file, CAST(SUM(n) AS BIGINT) AS total_rows, count(*) FILTER (extra > 0) AS repeated_keys, CAST(SUM(extra) AS BIGINT) AS duplicate_rows,
  round(CAST(SUM(extra) AS DOUBLE) / CAST(SUM(n) AS DOUBLE), 6) AS duplicate_share, SUM(extra) = 0 AS tolerated FROM x GROUP BY 1""",
    "null_fill_median": _middle_fill("quantile_cont(price, 0.5)"),
    "null_fill_mean": _middle_fill("avg(price)"),
    "null_fill_forward": _neighbour_fill("forward"),
    "null_fill_backward": _neighbour_fill("backward"),
    "null_fill_timestamps": f"""WITH {_DIRTY},
p AS (SELECT *, row_number() OVER (PARTITION BY source_file ORDER BY event_id, copy) AS p FROM dirty),
n AS (SELECT *, MAX(CASE WHEN ts IS NOT NULL THEN p END) OVER (PARTITION BY source_file ORDER BY p ROWS UNBOUNDED PRECEDING) AS pb,
  MIN(CASE WHEN ts IS NOT NULL THEN p END) OVER (PARTITION BY source_file ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS pa FROM p),
j AS (SELECT n.event_id, n.copy, n.source_file, n.p, n.pb, n.pa, epoch_us(b.ts) AS ub, epoch_us(a.ts) AS ua FROM n
  LEFT JOIN p b ON b.source_file = n.source_file AND b.p = n.pb LEFT JOIN p a ON a.source_file = n.source_file AND a.p = n.pa)
SELECT event_id, copy, source_file, {_ISO.format('''make_timestamp(CASE WHEN ub IS NULL THEN ua WHEN ua IS NULL OR pa = pb THEN ub
  ELSE ub + ((ua - ub) * (p - pb)) // (pa - pb) END)''')} AS filled_timestamp FROM j""",
    "outliers": f"""WITH {_DIRTY}, s AS (SELECT avg(price) AS m, stddev_samp(price) AS d FROM dirty)
SELECT event_id, copy, price, coalesce(abs(price - m) > d * 3.0, false) AS is_outlier FROM dirty, s""",
    "quality_checks": _quality("warning"),
    "quality_checks_silver": _quality("warning", 0.0, "10000.0"),
    "quality_gate": f"""SELECT count(*) FILTER (check_result = 'passed') AS passed, 0::BIGINT AS warnings,
  count(*) FILTER (check_result = 'failed') AS failed, count(*) FILTER (check_result = 'failed') = 0 AS may_continue FROM ({_quality('failed')})""",
    "gold_daily": f"WITH {_TX} {_price_metrics('daily')}",
    "gold_weekly": f"WITH {_TX} {_price_metrics('weekly')}",
    "gold_monthly": f"WITH {_TX} {_price_metrics('monthly')}",
    "gold_orders_monthly": f"WITH {_ORDERS} {_gold('monthly')}",
    "gold_lineitem_monthly": f"WITH {_LINEITEMS} {_gold('monthly')}",
    "user_analytics": f"WITH {_TX} {_user_metrics('daily')}",
    "temporal_patterns": f"WITH {_TX} {_temporal_metrics('daily')}",
    "hourly_prices": f"""WITH {_TX} SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS "hour", count(*) AS transaction_count,
  {_money('price')} / count(*) AS price_avg, MIN(price) AS price_min, MAX(price) AS price_max FROM tx GROUP BY 1""",
    "gold_refresh": f"WITH {_TX} {_gold('weekly')}",
    "gold_rules": f"""WITH {_ORDERS}, g AS ({_gold('monthly')}), k AS (SELECT metric_type, metric_name, date_partition, count(*) AS n,
  count(*) FILTER (metric_value IS NULL) AS nulls, count(*) FILTER (metric_value < -1e6 OR metric_value > 1e6) AS outside FROM g GROUP BY ALL)
SELECT metric_type, CAST(SUM(n) AS BIGINT) AS total_rows, CAST(SUM(nulls) AS BIGINT) AS null_values,
  CAST(SUM(outside) AS BIGINT) AS out_of_range, CAST(SUM(n - 1) AS BIGINT) AS duplicates FROM k GROUP BY 1""",
    "price_spikes": f"""WITH {_history(20)} SELECT source_file, batch_number, batch_avg, running_avg_before,
  coalesce(batch_avg > running_avg_before * 2.0, false) AS is_spike FROM history""",
    "count_anomalies": f"""WITH {_TX}, d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS transactions FROM tx GROUP BY 1),
c AS (SELECT *, CAST(transactions AS DOUBLE) / lag(transactions) OVER (ORDER BY day) - 1 AS change FROM d)
SELECT day, transactions, change, coalesce(abs(change) > 0.1, false) AS is_anomaly FROM c""",
    "degradation_flags": f"""WITH {_DIRTY}, l AS (SELECT feed_no - 1 AS n, count(*) AS k, count(reject_reason) AS r FROM judged GROUP BY 1),
x AS (SELECT n, n IN (2, 3) AS failed, CASE WHEN n NOT IN (2, 3) THEN r::DOUBLE / k END AS rs FROM l)
SELECT CAST(n AS VARCHAR) AS run_id, failed::INT::DOUBLE AS failed_share, rs AS reject_share, failed AS processing_failure,
  coalesce(rs > lag(rs) OVER (ORDER BY n) * 1.1::DOUBLE, false) AS quality_degraded, true AS timed FROM x""",
    "retention_split": """SELECT o_orderkey AS event_id, o_totalprice AS price,
  CASE WHEN date_diff('day', CAST(o_orderdate AS DATE), CAST(as_of AS DATE)) > 730 THEN 'warm' ELSE 'keep' END AS tier, as_of
FROM orders, (VALUES ('2001-08-01'), ('1999-08-01')) d(as_of)""",
    "retention_move": f"""WITH {_TX}, d AS (SELECT event_id, price, CAST(ts AS DATE) AS day FROM tx)
SELECT event_id, price, strftime(day, '%Y-%m-%d') AS day, CASE WHEN date_diff('day', day, DATE '2024-01-20') > 10 THEN 'cold first'
  WHEN date_diff('day', day, DATE '2024-01-25') > 10 THEN 'cold second' ELSE 'live' END AS side FROM d""",
    "lineage": f"""WITH {_DIRTY}, r AS (SELECT *, {_RULES} FROM dirty)
SELECT 'bronze' AS layer, source_file, count(*) AS rows_in, count(*) AS rows_out, 'bronze_converter' AS created_by,
  'csv_files' AS data_source, '1.0' AS processing_version, 'raw' AS quality_tier FROM dirty GROUP BY source_file
UNION ALL SELECT 'silver', source_file, count(*), count(*) FILTER (r1 AND r2 AND r3 AND r4), 'silver_processor', 'bronze_layer', '1.0', 'clean'
FROM r GROUP BY source_file""",
    "stream_stats": f"""WITH {_DIRTY} {_state('kept')}""",
    "stream_restart": f"""WITH {_DIRTY}, {_reconciled(', true AS all_completed')}""",
    "stream_rejects": f"""WITH {_DIRTY} SELECT source_file, reject_reason, count(*) AS n_rows FROM judged
WHERE reject_reason IS NOT NULL GROUP BY ALL""",
    "stream_history": f"""WITH {_DIRTY}, p AS (SELECT feed_no, count(*) AS rows_in, count(reject_reason) AS rows_rejected,
  count(*) FILTER (reject_reason IS NULL) AS rows_processed,
  SUM(CAST(price AS DECIMAL(18,2))) FILTER (reject_reason IS NULL) AS s FROM judged GROUP BY 1)
SELECT 'main' AS phase, 'completed' AS status, feed_no - 1 AS ingest_batch, rows_in, rows_rejected, rows_processed,
  CAST(SUM(rows_processed) OVER w - rows_processed AS BIGINT) AS running_count_before,
  CAST(SUM(rows_processed) OVER w AS BIGINT) AS running_count_after,
  CAST(SUM(s) OVER w AS DOUBLE) / CAST(SUM(rows_processed) OVER w AS BIGINT) AS running_avg_after
FROM p WINDOW w AS (ORDER BY feed_no ROWS UNBOUNDED PRECEDING)""",
    "load_speed": f"""WITH {_DIRTY} SELECT count(*) AS rows_processed, true AS measured FROM kept""",
    "statistics_table": f"""WITH {_DIRTY}, s AS ({_state('kept')}) SELECT *, true AS dated, '1.0' AS version FROM s""",
    "two_phase_run": _DRIFT_QUERY,
    "run_steps": f"""WITH {_DIRTY}
SELECT 1::INTEGER AS step_no, 'raw_data' AS step, true AS critical, 'completed' AS status, count(DISTINCT source_file) AS rows,
  'all expected sources are there' AS message FROM dirty
UNION ALL SELECT 2, 'bronze', true, 'completed', count(*), 'bronze is complete' FROM dirty
UNION ALL SELECT 3, 'ingestion', true, 'completed', count(*), 'statistics match' FROM kept WHERE source_file <> 'validation.csv'
UNION ALL SELECT 4, 'validation', false, 'completed', count(*), 'statistics match' FROM kept WHERE source_file = 'validation.csv'
UNION ALL SELECT 5, 'report', false, 'completed', count(*), 'report written' FROM kept""",
    "run_report": f"""WITH {_DIRTY}, s AS (SELECT count(*) AS n, round({_money('price')} / count(*), 2) AS a, round(MIN(price), 2) AS lo,
  round(MAX(price), 2) AS hi, count(DISTINCT user_raw) AS u, count(DISTINCT source_file) AS f FROM kept),
l AS (SELECT unnest(['TRANSACTION LOAD REPORT', 'Batch size: 1,000', 'Bronze sources: ' || f, format('Records in store: {{:,}}', n),
  format('Average price: ${{:,.2f}}', a), format('Minimum price: ${{:,.2f}}', lo), format('Maximum price: ${{:,.2f}}', hi),
  format('Distinct users: {{:,}}', u), 'Sources loaded: ' || f, format('Incremental count: {{:,}}', n)]) AS line,
  unnest(range(1, 11)) AS line_no FROM s)
SELECT CAST(line_no AS INTEGER) AS line_no, line FROM l""",
    "stream_live_stats": f"""WITH {_DIRTY} {_state('kept')}""",
    "stream_daily_prices": f"""WITH {_DIRTY} SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS transaction_count,
  {_money('price')} AS price_sum, MIN(price) AS price_min, MAX(price) AS price_max FROM kept WHERE ts IS NOT NULL GROUP BY 1""",
    "stream_dedup": f"""WITH {_DIRTY} SELECT source_file, count(*) AS n_rows FROM (SELECT DISTINCT ts, user_std, price, source_file,
  CASE WHEN ts IS NULL OR user_std IS NULL OR price IS NULL THEN event_id || '/' || copy END AS own FROM dirty) GROUP BY 1""",
    "stream_late_rows": f"""WITH {_DIRTY}, m AS (SELECT MAX(ts) FILTER (source_file = 'validation.csv') AS seen FROM kept)
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS transaction_count,
  count(*) FILTER (source_file <> 'validation.csv' AND ts < seen - INTERVAL 2 DAYS) AS late_rows
FROM kept, m WHERE ts IS NOT NULL GROUP BY 1""",
    "approx_metrics": f"""WITH {_DIRTY} SELECT count(DISTINCT user_raw) AS users, round(quantile_cont(price, 0.5), 6) AS median,
  true AS users_close, true AS median_close FROM kept""",
    "header_only_source": f"""WITH {_DIRTY} SELECT source_file, count(*) AS row_count, true AS run_completed FROM dirty GROUP BY 1
UNION ALL SELECT '2024-9.csv', 0, true""",
    "source_emptied": f"""WITH {_DIRTY} SELECT source_file, CASE WHEN source_file = '2024-2.csv' THEN 0 ELSE count(*) END AS n_bronze,
  CASE WHEN source_file = '2024-2.csv' THEN 0 ELSE count(*) FILTER (reject_reason IS NULL) END AS n_stored, true AS run_completed
FROM judged GROUP BY source_file""",
    "conversion_results": f"""WITH {_DIRTY} SELECT source_file, true AS converted, CAST(NULL AS VARCHAR) AS reason, count(*) AS row_count,
  true AS sized, true AS batched FROM dirty GROUP BY 1
UNION ALL SELECT '2024-8.csv', false, 'missing columns: price', 0, true, true
UNION ALL SELECT '2024-7.csv', false, 'header is not UTF-8', 0, true, true
UNION ALL SELECT '2024-6.csv', false, 'not UTF-8 in rows', 0, true, true
UNION ALL SELECT '2024-5.csv.gz', false, 'unreadable', 0, true, true
UNION ALL SELECT '2024-10.csv', false, 'missing columns', 0, true, true""",
    "manifest_follows_files": f"""WITH {_DIRTY}, n AS (SELECT source_file, count(*) AS b, count(*) FILTER (reject_reason IS NULL AND source_file <> 'validation.csv') AS s
  FROM judged WHERE source_file <> '2024-3.csv' GROUP BY 1)
SELECT source_file, CASE source_file WHEN '2024-1.csv' THEN b + 1 WHEN '2024-2.csv' THEN 1 ELSE b END AS n_bronze,
  CASE source_file WHEN '2024-1.csv' THEN s + 1 WHEN '2024-2.csv' THEN 1 ELSE s END AS n_stored, 2 AS files_looked_at FROM n""",
    "compacted_history": f"""WITH {_DIRTY}, p AS (SELECT source_file, CASE WHEN source_file = 'validation.csv' THEN 5
    ELSE CAST(source_file[6:6] AS INTEGER) - 1 END AS ingest_batch, count(*) AS rows_in, count(reject_reason) AS rows_rejected,
    count(*) FILTER (reject_reason IS NULL) AS rows_processed, sum(CAST(price AS DECIMAL(18, 2))) FILTER (reject_reason IS NULL) AS s
  FROM judged GROUP BY 1)
SELECT CAST(ingest_batch AS BIGINT) AS ingest_batch, rows_in, rows_rejected, rows_processed,
  CAST(sum(rows_processed) OVER (ORDER BY ingest_batch) AS BIGINT) AS running_count_after,
  CAST(sum(s) OVER (ORDER BY ingest_batch) AS DOUBLE) AS running_sum_after, 'completed' AS status FROM p""",
    "batch_sketches": f"""WITH {_DIRTY} SELECT count(DISTINCT user_raw) AS users, count(*) AS n_prices, true AS all_prices, true AS users_close,
  true AS price_5_close, true AS price_25_close, true AS price_50_close, true AS price_75_close, true AS price_95_close,
  CAST(0.04875 AS DOUBLE) AS users_bound, CAST(0.02 AS DOUBLE) AS rank_bound FROM kept""",
    "hourly_refresh": f"""WITH {_TX} SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS "hour", count(*) AS transaction_count,
  {_money('price')} / count(*) AS price_avg, MIN(price) AS price_min, MAX(price) AS price_max FROM tx GROUP BY 1""",
    "bronze_layouts": f"""WITH {_DIRTY} SELECT ts_text AS "timestamp", price, user_raw AS user_id, bad_price, source_file FROM dirty""",
}
