"""SQL for DuckDB with the same results as the queries of the catalog.

Written from the tables' definitions, not from the Spark code; only the fixed value lists of
the test data are shared.
"""

from __future__ import annotations

from eventmart.sources import canonical as data


def _pick(values: tuple, index: str) -> str:
    return f"({list(values)!r})[1 + ({index}) % {len(values)}]"


def _number(field: str) -> str:
    return f"CAST(('0x' || substr(md5(order_id || ':{field}'), 25, 8)) AS UBIGINT)::BIGINT"


def _digits(value: str) -> str:
    return f"regexp_replace(CAST(CAST({value} AS DECIMAL(38,6)) AS VARCHAR), '\\.?0+$', '')"


def _time(name: str) -> str:
    return f"strftime({name}, '%Y-%m-%d %H:%M:%S') AS {name}"


_TIMES = ("event_time", "kafka_timestamp", "_ingested_at", "order_created_at", "paid_at",
          "created_at", "updated_at", "day", "hour", "_backfilled_at", "timestamp",
          "min_event_time", "max_event_time")

_ENRICHED = ("event_time", "user_id", "session_id", "event_type", "channel", "premium_amount",
             "city", "device_type", "signup_date", "kafka_topic", "kafka_partition",
             "kafka_offset", "kafka_timestamp", "_ingested_at", "ingest_lag_sec")
_FACT = ("event_time", "user_id", "session_id", "channel", "event_premium", "city",
         "device_type", "signup_date", "order_id", "product_line", "order_premium",
         "order_created_at", "attributes", "payment_method", "installments", "discount_amount",
         "tax_amount", "net_amount", "payment_status", "paid_at")
_RAW = ("event_time", "user_id", "session_id", "event_type", "channel", "premium_amount")
_DAILY = "event_date, channel, city, device_type, event_type"


def _list(names, prefix: str = "") -> str:
    return ", ".join(_time(n) if n in _TIMES else prefix + n for n in names)


def _product(line: str, attributes: str, columns: str = "") -> str:
    return (f"SELECT order_id, user_id, session_id, premium, created_at, k, "
            f"'{line}' AS product_line, {attributes} AS attributes{columns} "
            f"FROM purchase_orders WHERE product_line = '{line}'")


_VALUE = f"(premium * (800 + {_number('vehicle_value')} % 1201) / 100)"
_COVER = f"(premium * (2000 + {_number('coverage_amount')} % 4001) / 100)"
_FRANCHISE = f"CAST(({_number('franchise_pct')} % 1001) / 100.0 AS DECIMAL(4,2))"
_BRAND = _pick(data.VEHICLE_BRANDS, _number("vehicle_brand"))

_LINES = " UNION ALL ".join([
    _product("third", "'coverage_tier=' || " + _pick(data.COVERAGE_TIERS, _number("coverage_tier"))
             + " || ',no_claim_years=' || (" + _number("no_claim_years") + " % 11)"
             + " || ',vehicle_type=' || " + _pick(data.VEHICLE_TYPES, _number("vehicle_type"))),
    _product("body", "'franchise_pct=' || " + _digits(_FRANCHISE) + " || ',vehicle_brand=' || "
             + _BRAND + " || ',vehicle_value=' || " + _digits(_VALUE)),
    _product("medical", "'has_dental=' || (" + _number("has_dental") + " % 2)"
             + " || ',insured_count=' || (1 + " + _number("insured_count") + " % 6)"
             + " || ',plan_tier=' || " + _pick(data.PLAN_TIERS, _number("plan_tier"))),
    _product("fire", "'building_area=' || (40 + " + _number("building_area") + " % 461)"
             + " || ',coverage_amount=' || " + _digits(_COVER)
             + " || ',property_type=' || " + _pick(data.PROPERTY_TYPES, _number("property_type"))),
])


def _fact(where: str) -> str:
    return f"""
  SELECT e.event_time, e.user_id, e.session_id, e.channel, e.premium_amount AS event_premium,
         e.city, e.device_type, e.signup_date, p.order_id, p.product_line,
         p.premium AS order_premium, p.created_at AS order_created_at, p.attributes,
         coalesce(f.payment_method, '') AS payment_method,
         coalesce(f.installments, 0) AS installments,
         coalesce(f.discount_amount, 0) AS discount_amount,
         coalesce(f.tax_amount, 0) AS tax_amount, coalesce(f.net_amount, 0) AS net_amount,
         coalesce(f.payment_status, '') AS payment_status,
         coalesce(f.paid_at, TIMESTAMP '1970-01-01 00:00:00') AS paid_at
  FROM {{source}} e JOIN product_orders p ON e.user_id = p.user_id AND e.session_id = p.session_id
  LEFT JOIN payments f ON p.order_id = f.order_id
  WHERE e.event_type = 'purchase' AND {where}"""


def _enriched(source: str) -> str:
    return f"""
  SELECT e.*, coalesce(u.city, 'UNKNOWN') AS city, coalesce(u.device_type, 'UNKNOWN') AS device_type,
         coalesce(u.signup_date, DATE '1970-01-01') AS signup_date,
         e.event_time + to_seconds(e.event_id % 7) AS _ingested_at,
         e.event_id % 7 AS ingest_lag_sec
  FROM {source} e LEFT JOIN people u ON e.user_id = u.user_id"""


def _checks(source: str, facts: str, name: str = "") -> str:
    """The ten checks over some events and facts, as tables ``ranges``, ``duplicates`` and ``checks``."""
    return f"""{name}ranges AS (
  SELECT kafka_partition, max(kafka_offset) - min(kafka_offset) + 1 AS expected,
         count(DISTINCT kafka_offset) AS actual FROM {source} GROUP BY 1),
{name}duplicates AS (
  SELECT CAST(sum(c) - count(*) AS BIGINT) AS extra FROM (
    SELECT count(*) AS c FROM {source} GROUP BY event_time, user_id, session_id, event_type)),
{name}checks AS (
  SELECT 'row_count_parity' AS check_name,
         CASE WHEN (SELECT count(*) FROM {source}) = (SELECT count(*) FROM events)
              THEN 'PASS' ELSE 'FAIL' END AS status,
         'clickhouse=' || (SELECT count(*) FROM {source}) || ' expected='
           || (SELECT count(*) FROM events) AS metric
  UNION ALL SELECT 'referential_integrity_users',
         CASE WHEN count(*) FILTER (city = 'UNKNOWN') = 0 THEN 'PASS' ELSE 'FAIL' END,
         'unmatched_users=' || count(*) FILTER (city = 'UNKNOWN') FROM {source}
  UNION ALL SELECT 'null_premium_on_purchase',
         CASE WHEN count(*) FILTER (event_type = 'purchase' AND premium_amount IS NULL) = 0
              THEN 'PASS' ELSE 'FAIL' END,
         'null_purchase_premiums='
           || count(*) FILTER (event_type = 'purchase' AND premium_amount IS NULL) FROM {source}
  UNION ALL SELECT 'premium_on_non_purchase',
         CASE WHEN count(*) FILTER (event_type <> 'purchase' AND premium_amount IS NOT NULL) = 0
              THEN 'PASS' ELSE 'WARN' END,
         'non_purchase_with_premium='
           || count(*) FILTER (event_type <> 'purchase' AND premium_amount IS NOT NULL) FROM {source}
  UNION ALL SELECT 'duplicate_events', CASE WHEN extra = 0 THEN 'PASS' ELSE 'FAIL' END,
         'extra_duplicate_rows=' || extra FROM {name}duplicates
  UNION ALL SELECT 'ingestion_freshness',
         CASE WHEN max(_ingested_at) >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 1 DAY
              THEN 'PASS' ELSE 'FAIL' END,
         'max_event_time=' || strftime(max(event_time), '%Y-%m-%d %H:%M:%S')
           || ' max_ingested_at=' || strftime(max(_ingested_at), '%Y-%m-%d %H:%M:%S') FROM {source}
  UNION ALL SELECT 'denorm_purchase_coverage',
         CASE WHEN (SELECT count(*) FROM {facts})
                   <= (SELECT count(*) FROM {source} WHERE event_type = 'purchase')
              THEN 'PASS' ELSE 'FAIL' END,
         'fact_rows=' || (SELECT count(*) FROM {facts}) || ' purchase_events='
           || (SELECT count(*) FROM {source} WHERE event_type = 'purchase')
  UNION ALL SELECT 'kafka_consumer_errors', 'PASS',
         'assignments=' || count(DISTINCT kafka_partition) FROM {source}
  UNION ALL SELECT 'offset_continuity',
         CASE WHEN sum(expected) = sum(actual) THEN 'PASS' ELSE 'FAIL' END,
         'missing_in_offset_ranges=' || CAST(sum(expected) - sum(actual) AS BIGINT) FROM {name}ranges
  UNION ALL SELECT 'ingestion_lag',
         CASE WHEN quantile_cont(ingest_lag_sec, 0.95) < 600 THEN 'PASS' ELSE 'WARN' END,
         'p95_lag_sec=' || CAST(round_even(quantile_cont(ingest_lag_sec, 0.95), 0) AS BIGINT)
           || ' max_lag_sec=' || max(ingest_lag_sec) FROM {source})"""


_BASE = f"""WITH source_events AS (
  SELECT event_id, date_trunc('second', ts) AS event_time, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
ev AS (
  SELECT event_id, k, event_time, user_id, 's-' || event_id AS session_id, event_type,
         {_pick(data.CHANNELS, 'k')} AS channel,
         CASE WHEN event_type = 'purchase' AND value < 1 THEN NULL
              ELSE round(value * 100000) END AS premium_amount,
         'user_events' AS kafka_topic, event_id % 4 AS kafka_partition,
         event_id // 4 AS kafka_offset, event_time AS kafka_timestamp
  FROM source_events),
all_people AS (
  SELECT c_custkey AS user_id,
         CAST(DATE '2023-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE) AS signup_date,
         n_name AS city, {_pick(data.DEVICES, 'c_custkey')} AS device_type,
         TIMESTAMP '2024-01-01 00:00:00' AS updated_at, c_acctbal, c_mktsegment
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
people AS (SELECT * FROM all_people WHERE c_acctbal >= 0),
landed_ev AS (
  SELECT * FROM ev WHERE k <> 0 UNION ALL SELECT * FROM ev WHERE k = 50),
enriched AS ({_enriched('ev')}),
landed AS ({_enriched('landed_ev')}),
purchase_orders AS (
  SELECT event_id + 1 AS order_id, user_id, session_id, coalesce(premium_amount, 0) AS premium,
         event_time AS created_at, k,
         (['third', 'body', 'medical', 'fire'])[1 + CAST(
           ('0x' || substr(md5(user_id || ':' || session_id), 25, 8)) AS UBIGINT)::BIGINT % 4]
           AS product_line
  FROM ev WHERE event_type = 'purchase'),
product_orders AS ({_LINES}),
priced AS (
  SELECT order_id, created_at, CAST(premium AS DECIMAL(18,2)) AS gross,
         {_pick(data.PAYMENT_METHODS, _number('payment_method'))} AS payment_method,
         {_pick(data.INSTALLMENTS, _number('installments'))} AS installments,
         {_pick(data.PAYMENT_STATUS, _number('payment_status'))} AS payment_status,
         CAST(round(CAST(premium AS DECIMAL(18,2)) * CAST(
           ({_number('discount_rate')} % 1501) / 10000.0 AS DECIMAL(6,4)), 2)
           AS DECIMAL(18,2)) AS discount
  FROM purchase_orders WHERE k < 90),
taxed AS (
  SELECT *, CAST(round((gross - discount) * CAST(0.09 AS DECIMAL(3,2)), 2) AS DECIMAL(18,2)) AS tax
  FROM priced),
payments AS (
  SELECT order_id, payment_method, installments, CAST(discount AS DOUBLE) AS discount_amount,
         CAST(tax AS DOUBLE) AS tax_amount, CAST(gross - discount + tax AS DOUBLE) AS net_amount,
         payment_status, created_at AS paid_at FROM taxed),
facts AS ({_fact('true').format(source='enriched')}),
early_facts AS ({_fact('p.k >= 4').format(source='enriched')}),
late_facts AS ({_fact('p.k < 4').format(source='enriched')}),
sent_facts AS (SELECT * FROM facts WHERE session_id IN (SELECT session_id FROM landed_ev)),
landed_facts AS ({_fact('true').format(source='landed')}),
parted AS (
  SELECT *, CASE WHEN k < 2 THEN part + 1 WHEN k < 4 THEN 3 WHEN k < 6 THEN greatest(part - 1, 1)
                 ELSE part END AS arrival
  FROM (SELECT event_id + 1 AS order_id, event_time, k,
               CASE WHEN event_time < TIMESTAMP '2024-01-11' THEN 1
                    WHEN event_time < TIMESTAMP '2024-01-21' THEN 2 ELSE 3 END AS part
        FROM ev WHERE event_type = 'purchase')),
marks AS (
  SELECT run, least((SELECT max(event_time) FROM parted WHERE part <= run),
                    (SELECT max(event_time) FROM parted WHERE arrival <= run)) - INTERVAL 12 DAY AS mark
  FROM (VALUES (1), (2), (3)) runs(run)),
met AS (
  SELECT p.*, arrival <= 3 AND NOT (arrival > 1 AND event_time <= coalesce(mark, TIMESTAMP '1970-01-01')) AS in_stream
  FROM parted p LEFT JOIN marks ON run = arrival - 1),
daily AS (
  SELECT CAST(event_time AS DATE) AS event_date, channel, city, device_type, event_type,
         count(*) AS events_count, count(DISTINCT user_id) AS unique_users,
         sum(coalesce(premium_amount, 0)) AS premium_sum,
         avg(coalesce(premium_amount, 0)) AS premium_avg
  FROM enriched GROUP BY ALL),
window_rows AS (
  SELECT DISTINCT l.event_time, l.user_id, l.session_id, l.event_type, l.channel,
         l.premium_amount, l.city, l.device_type, u.signup_date
  FROM landed l LEFT JOIN people u ON l.user_id = u.user_id
  WHERE CAST(l.event_time AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'),
{_checks('landed', 'facts')},
hours AS (
  SELECT h.hour, coalesce(c.events, 0) AS events FROM (
    SELECT unnest(generate_series(date_trunc('hour', min(event_time)),
                                  date_trunc('hour', max(event_time)), INTERVAL 1 HOUR)) AS hour
    FROM ev) h LEFT JOIN (
    SELECT date_trunc('hour', event_time) AS hour, count(*) AS events FROM ev GROUP BY 1) c
    ON h.hour = c.hour),
scored AS (
  SELECT hour, events, avg(events) OVER (ORDER BY hour RANGE BETWEEN INTERVAL 7 DAY PRECEDING
         AND INTERVAL 1 SECOND PRECEDING) AS baseline FROM hours),
subjects AS (SELECT user_id FROM all_people WHERE c_mktsegment = 'FURNITURE'),
message_rows AS (
  SELECT *, '{{"event_time":"' || strftime(event_time, '%Y-%m-%d %H:%M:%S') || '","user_id":'
    || CASE k WHEN 3 THEN '"u' || user_id || '"' WHEN 1 THEN '"' || user_id || '"'
              ELSE CAST(user_id AS VARCHAR) END
    || ',"session_id":"' || session_id || '"'
    || CASE WHEN k = 4 THEN '' ELSE ',"event_type":"' || event_type || '"' END
    || ',"channel":"' || channel || '","premium_amount":'
    || coalesce(CAST(CAST(premium_amount AS BIGINT) AS VARCHAR), 'null')
    || CASE WHEN k = 2 THEN ',"campaign":"spring"' ELSE '' END || '}}' AS text FROM ev),
good AS (SELECT * FROM ev WHERE k NOT IN (0, 3, 4, 5)),
good_enriched AS (SELECT * FROM enriched WHERE k NOT IN (0, 3, 4, 5)),
cycle AS (
  SELECT * REPLACE (TIMESTAMP '2024-01-31 00:00:00' AS _ingested_at,
                    CAST(epoch(TIMESTAMP '2024-01-31 00:00:00' - kafka_timestamp) AS BIGINT) AS ingest_lag_sec)
  FROM good_enriched),
live_facts AS ({_fact('p.k >= 4').format(source='good_enriched')}),
good_daily AS (
  SELECT CAST(event_time AS DATE) AS event_date, channel, city, device_type, event_type,
         count(*) AS events_count, count(DISTINCT user_id) AS unique_users,
         sum(coalesce(premium_amount, 0)) AS premium_sum,
         avg(coalesce(premium_amount, 0)) AS premium_avg
  FROM good_enriched GROUP BY ALL)
"""

_CHANGED_USERS = f"""
SELECT user_id, signup_date,
       CASE WHEN c_mktsegment = 'BUILDING' AND c_acctbal >= 0 THEN 'NEW-' || city
            ELSE city END AS city, device_type,
       strftime(CASE WHEN c_acctbal < 0 THEN TIMESTAMP '2024-03-01 00:00:00'
            WHEN c_mktsegment = 'BUILDING' THEN TIMESTAMP '2024-02-01 00:00:00'
            ELSE updated_at END, '%Y-%m-%d %H:%M:%S') AS updated_at
FROM all_people WHERE c_acctbal < 0 OR c_mktsegment <> 'MACHINERY'"""

_MONEY_SUM = "CAST(sum(CAST(net_amount AS DECIMAL(18,2))) AS DOUBLE)"
_RETAINED = "event_time + INTERVAL 18 MONTH > TIMESTAMP '2025-07-12 00:00:00'"
_MASKED = ("event_time", "user_id", "city", "device_type", "channel", "product_line",
           "attributes")

_BODIES = {
    "typed_events": f"SELECT {_list(_RAW)} FROM ev",
    "enriched_events": f"SELECT {_list(_ENRICHED)} FROM enriched",
    "loaded_users": f"SELECT user_id, signup_date, city, device_type, {_time('updated_at')} "
                    "FROM people",
    "published_messages": f"""SELECT CAST(user_id AS VARCHAR) AS key, {_time('event_time')},
        CAST(user_id AS VARCHAR) AS user_id, session_id, event_type, channel, premium_amount
        FROM ev""",
    "csv_round_trip": f"SELECT {_list(_RAW)} FROM ev",
    "expected_source_rows": "SELECT count(*) AS rows, count(*) AS expected FROM ev",
    "stored_events_in_range": f"""SELECT {_list(_ENRICHED)} FROM enriched
        WHERE event_time >= TIMESTAMP '2024-01-08' AND event_time < TIMESTAMP '2024-01-14'""",
    "order_split_counts": "SELECT product_line, count(*) AS orders FROM purchase_orders GROUP BY 1",
    "order_pricing": f"""SELECT order_id, payment_method, installments, discount_amount,
        tax_amount, net_amount, payment_status, {_time('paid_at')} FROM payments""",
    "product_orders_all": f"""SELECT order_id, user_id, session_id, premium,
        {_time('created_at')}, product_line, attributes FROM product_orders""",
    "orders_latest_version": f"""SELECT order_id, user_id, session_id, premium,
        {_time('created_at')}, {_VALUE} AS vehicle_value, {_BRAND} AS vehicle_brand,
        {_FRANCHISE} AS franchise_pct FROM purchase_orders WHERE product_line = 'body'""",
    "fact_purchases": f"SELECT {_list(_FACT)} FROM facts",
    "fact_purchases_all_matches": f"SELECT {_list(_FACT)} FROM landed_facts",
    "reconcile_missing": f"SELECT {_list(_FACT)} FROM late_facts",
    "late_order_cycle": """SELECT (SELECT count(*) FROM early_facts) AS facts_before,
        (SELECT count(*) FROM late_facts) AS first_added, CAST(0 AS BIGINT) AS second_added,
        (SELECT count(*) FROM facts) AS facts_after,
        (SELECT count(DISTINCT order_id) FROM facts) AS orders_after""",
    "users_after_changes": _CHANGED_USERS,
    "agg_daily": "SELECT * FROM daily",
    # Sketches of so few users per group hold them all, so their estimates are exact.
    "agg_daily_sketch": "SELECT * FROM daily",
    "stream_agg_daily": "SELECT * FROM good_daily",
    "agg_daily_purchases_by_channel": """SELECT event_date, channel,
        CAST(sum(events_count) AS BIGINT) AS c FROM daily WHERE event_type = 'purchase'
        GROUP BY 1, 2 ORDER BY event_date, c DESC""",
    "report_table_counts": """SELECT 'users' AS name, count(*) AS rows FROM people
        UNION ALL SELECT 'events_enriched', count(*) FROM enriched
        UNION ALL SELECT 'fact_purchases', count(*) FROM facts""",
    "report_enriched_profile": """SELECT count(*) AS rows, count(DISTINCT user_id) AS users,
        strftime(min(event_time), '%Y-%m-%d %H:%M:%S') AS min_event_time,
        strftime(max(event_time), '%Y-%m-%d %H:%M:%S') AS max_event_time FROM enriched""",
    "report_coverage": """SELECT count(*) FILTER (city = 'UNKNOWN') AS unmatched,
        count(*) AS total FROM enriched""",
    "report_by_event_type": """SELECT event_type, CAST(sum(events_count) AS BIGINT) AS events,
        CAST(sum(unique_users) AS BIGINT) AS approx_users,
        round_even(avg(premium_avg), 0) AS avg_premium FROM daily GROUP BY 1
        ORDER BY events DESC""",
    "report_channels": """SELECT channel, CAST(sum(events_count) AS BIGINT) AS purchases,
        round_even(sum(premium_sum), 0) AS premium_sum FROM daily
        WHERE event_type = 'purchase' GROUP BY 1 ORDER BY purchases DESC""",
    "report_product_lines": """SELECT product_line, count(*) AS orders,
        round_even(avg(net_amount), 0) AS avg_net,
        round_even(avg(installments), 1) AS avg_installments FROM facts GROUP BY 1
        ORDER BY orders DESC""",
    "revenue_by_line_day": f"""SELECT product_line,
        strftime(date_trunc('day', event_time), '%Y-%m-%d %H:%M:%S') AS day,
        {_MONEY_SUM} AS revenue, count(*) AS orders FROM facts GROUP BY 1, 2""",
    "revenue_by_line_since": f"""SELECT product_line, {_MONEY_SUM} AS revenue FROM facts
        WHERE event_time >= TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1""",
    "first_events": f"""SELECT {_list(_ENRICHED)} FROM (SELECT * FROM enriched
        ORDER BY event_time, user_id, session_id LIMIT 5)""",
    "backfill_window": """SELECT strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time,
        user_id, session_id, event_type, channel, premium_amount, city, device_type, signup_date
        FROM window_rows""",
    "backfill_counts": """SELECT (SELECT count(*) FROM landed) AS source_rows,
        (SELECT count(*) FROM window_rows) AS window_rows,
        (SELECT count(*) FROM window_rows WHERE city = 'UNKNOWN') AS unmatched""",
    "backfill_reloaded": """SELECT strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time,
        user_id, session_id, event_type, channel, premium_amount, city, device_type,
        CAST(signup_date AS VARCHAR) AS signup_date, '2024-02-02 00:00:00' AS _backfilled_at
        FROM window_rows""",
    "purchases_masked": f"""SELECT {_list(_MASKED)},
        round_even(net_amount, -5) AS net_amount_bucket, payment_method, payment_status
        FROM facts""",
    "purchases_region": f"SELECT {_list(_FACT)} FROM facts WHERE city = 'NATION_7'",
    "audience_tables": """WITH n AS (
          SELECT (SELECT count(*) FROM daily WHERE city = 'NATION_7') AS d,
                 (SELECT count(*) FROM facts WHERE city = 'NATION_7') AS f,
                 (SELECT count(*) FROM enriched WHERE city = 'NATION_7') AS e,
                 (SELECT count(*) FROM payments) AS p)
        SELECT 'analyst' AS audience, 'events_agg_daily_v' AS name,
               CAST(9 AS BIGINT) AS n_columns, d AS rows FROM n
        UNION ALL SELECT 'analyst', 'fact_purchases_masked', 10, f FROM n
        UNION ALL SELECT 'data_scientist', 'events_agg_daily_v', 9, d FROM n
        UNION ALL SELECT 'data_scientist', 'fact_purchases_masked', 10, f FROM n
        UNION ALL SELECT 'data_scientist', 'events_enriched', 15, e FROM n
        UNION ALL SELECT 'finance', 'fact_purchases', 20, f FROM n
        UNION ALL SELECT 'finance', 'financial_order', 8, p FROM n""",
    "retained_events": f"SELECT {_list(_ENRICHED)} FROM enriched WHERE {_RETAINED}",
    "stored_events_after_retention":
        f"SELECT {_list(_ENRICHED)} FROM enriched WHERE {_RETAINED}",
    "events_after_erasure": f"""SELECT {_list(_ENRICHED)} FROM enriched
        WHERE user_id NOT IN (SELECT user_id FROM subjects)""",
    "stored_events_after_erasure": f"""SELECT {_list(_ENRICHED)} FROM enriched
        WHERE user_id NOT IN (SELECT user_id FROM subjects)""",
    "dq_report": "SELECT check_name, status, metric FROM checks",
    "dq_gate": """SELECT count(*) FILTER (status = 'FAIL') AS failures,
        count(*) FILTER (status = 'WARN') AS warnings FROM checks""",
    "duplicate_count": "SELECT extra FROM duplicates",
    "offset_ranges": "SELECT kafka_partition, expected, actual FROM ranges",
    "ingest_lag": """SELECT quantile_cont(ingest_lag_sec, 0.95) AS p95_lag,
        max(ingest_lag_sec) AS max_lag FROM enriched""",
    "consumer_progress": """SELECT kafka_partition, count(*) AS num_messages_read,
        max(kafka_offset) AS last_offset FROM landed_ev GROUP BY 1""",
    "offset_gaps": """SELECT kafka_partition, kafka_offset + 1 AS from_offset,
        next_offset - 1 AS to_offset, next_offset - kafka_offset - 1 AS missing FROM (
          SELECT kafka_partition, kafka_offset, lead(kafka_offset) OVER (
            PARTITION BY kafka_partition ORDER BY kafka_offset) AS next_offset FROM landed_ev)
        WHERE next_offset - kafka_offset > 1""",
    "partition_lag": """SELECT kafka_partition, latest_offset, last_offset,
        latest_offset - coalesce(last_offset, -1) AS lag,
        CASE WHEN latest_offset - coalesce(last_offset, -1) > 10 THEN 'LAGGING' ELSE 'OK' END
          AS status
        FROM (SELECT kafka_partition, max(kafka_offset) AS latest_offset,
              max(kafka_offset) FILTER (event_time < TIMESTAMP '2024-01-29 00:00:00')
                AS last_offset FROM ev GROUP BY 1)""",
    "hourly_anomaly": f"""SELECT {_time('hour')}, events, baseline,
        CASE WHEN baseline = 0 THEN 'OK' WHEN events / baseline < 0.5 THEN 'LOW'
             WHEN events / baseline > 2.0 THEN 'HIGH' ELSE 'OK' END AS flag FROM scored""",
    "daily_gap_counts": """SELECT event_date, expected, actual, expected - actual AS missing,
        expected > actual AS backfill FROM (
          SELECT a.event_date, a.n AS expected, coalesce(b.n, 0) AS actual FROM (
            SELECT CAST(event_time AS DATE) AS event_date, count(*) AS n FROM ev GROUP BY 1) a
          LEFT JOIN (SELECT CAST(event_time AS DATE) AS event_date, count(*) AS n
                     FROM landed_ev GROUP BY 1) b ON a.event_date = b.event_date)""",
    "purchases_without_fact": f"""SELECT {_list(_ENRICHED)} FROM enriched
        WHERE event_type = 'purchase' AND session_id NOT IN (SELECT session_id FROM early_facts)""",
    "field_drift": """WITH m AS (SELECT k FROM ev WHERE k NOT IN (0, 5)),
        f AS (SELECT unnest(['event_time', 'user_id', 'session_id', 'event_type', 'channel',
                             'premium_amount']) AS field)
        SELECT field, count(*) FILTER (NOT (field = 'event_type' AND k = 4)) AS present_rows,
               count(*) FILTER (field = 'event_type' AND k = 4) AS missing_rows,
               CASE WHEN count(*) FILTER (field = 'event_type' AND k = 4) > 0
                    THEN 'MISSING_FIELD' ELSE 'OK' END AS status
        FROM m, f GROUP BY field
        UNION ALL SELECT 'campaign', count(*), 0, 'UNKNOWN_FIELD' FROM m WHERE k = 2
        HAVING count(*) > 0""",
    "dead_letters": f"""SELECT CASE k WHEN 5 THEN NULL WHEN 0 THEN substr(text, 1, 40)
            ELSE text END AS value, kafka_topic AS topic,
        CAST(kafka_partition AS INTEGER) AS partition, kafka_offset AS "offset",
        strftime(kafka_timestamp, '%Y-%m-%d %H:%M:%S') AS "timestamp",
        CASE k WHEN 0 THEN 'malformed message' WHEN 5 THEN 'no value'
               WHEN 3 THEN 'user_id: u' || user_id ELSE 'event_type: missing' END AS error
        FROM message_rows WHERE k IN (0, 3, 4, 5)""",
    "parsed_events": f"""SELECT {_list(_RAW)}, kafka_topic,
        CAST(kafka_partition AS INTEGER) AS kafka_partition, kafka_offset,
        {_time('kafka_timestamp')} FROM good""",
    "stream_enriched": f"""SELECT {_list([c for c in _ENRICHED if c not in (
            '_ingested_at', 'ingest_lag_sec')])}, '2024-01-31 00:00:00' AS _ingested_at,
        CAST(epoch(TIMESTAMP '2024-01-31 00:00:00' - kafka_timestamp) AS BIGINT)
          AS ingest_lag_sec FROM good_enriched""",
    "stream_facts": f"SELECT {_list(_FACT)} FROM live_facts",
    "stream_raw_sink": f"SELECT {_list(_RAW)} FROM good",
    "consumer_totals": """SELECT kafka_topic AS topic,
        CAST(kafka_partition AS BIGINT) AS partition, count(*) AS num_messages_read,
        max(kafka_offset) AS last_offset FROM message_rows GROUP BY ALL""",
    "stored_user_changes": _CHANGED_USERS,
}
_BODIES["facts_by_ledger"] = f"""SELECT {_list(_FACT)}, CAST(run AS BIGINT) AS run
    FROM facts JOIN (SELECT order_id, greatest(part, arrival) AS run FROM parted) USING (order_id)"""
_BODIES["stream_joined_facts"] = f"""SELECT {_list(_FACT)},
        CASE WHEN in_stream THEN 'stream' ELSE 'reconcile' END AS way
    FROM facts JOIN (SELECT order_id, in_stream FROM met) USING (order_id)"""
_BODIES["stream_join_state"] = """SELECT CAST(run AS BIGINT) AS run,
        (SELECT count(*) FROM met WHERE arrival = run AND NOT in_stream) AS dropped,
        (SELECT count(*) FROM parted WHERE part <= run AND event_time > mark - INTERVAL 1 HOUR)
          + (SELECT count(*) FROM met WHERE arrival <= run AND in_stream
             AND event_time > mark - INTERVAL 1 HOUR) AS held
    FROM marks"""
_BODIES["stored_revenue_rollup"] = f"""SELECT product_line,
        CAST(event_time - CASE WHEN k = 50 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS DATE) AS day,
        {_MONEY_SUM} AS revenue, count(*) AS orders
    FROM facts JOIN (SELECT event_id + 1 AS order_id, k FROM ev) USING (order_id)
    WHERE user_id NOT IN (SELECT user_id FROM subjects) GROUP BY ALL"""
_BODIES["users_from_csv"] = _BODIES["loaded_users"]
_BODIES["appended_csv"] = _BODIES["csv_round_trip"]
_BODIES["sessions_by_bloom_filter"] = _BODIES["enriched_events"] + """
    WHERE session_id IN (SELECT arg_max(session_id, (event_time, session_id)) FROM ev
                         GROUP BY event_type, kafka_partition)"""
_BODIES["stream_lag_quantiles"] = """SELECT event_type, count(*) AS n,
        max(CAST(epoch(TIMESTAMP '2024-01-31 00:00:00' - kafka_timestamp) AS BIGINT)) AS max_lag,
        count(*) AS events, TRUE AS p50_lag, TRUE AS p95_lag, TRUE AS p99_lag FROM good GROUP BY 1"""
_BODIES["change_log_dead_letters"] = """SELECT user_id AS "offset",
    CASE user_id % 10 WHEN 3 THEN 'user_id: u' || user_id ELSE 'updated_at: soon' END AS error
    FROM all_people WHERE user_id % 10 IN (3, 7) AND (
        c_acctbal < 0 OR c_mktsegment IN ('BUILDING', 'MACHINERY'))"""
_BODIES["raw_sink_dead_letters"] = _BODIES["dead_letters"]
_BODIES["first_published_messages"] = """SELECT CAST(user_id AS VARCHAR) AS key,
        strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, session_id
    FROM ev ORDER BY ev.event_time, user_id, session_id LIMIT 100"""
_BODIES["stream_after_user_refresh"] = f"""WITH moved AS ({_CHANGED_USERS}),
    known AS (SELECT 1 AS run, user_id, signup_date, city, device_type FROM people
              UNION ALL SELECT 2, user_id, signup_date, city, device_type FROM moved)
    SELECT {_list([c for c in _RAW])}, coalesce(u.city, 'UNKNOWN') AS city,
        coalesce(u.device_type, 'UNKNOWN') AS device_type, coalesce(u.signup_date, DATE '1970-01-01') AS signup_date,
        kafka_topic, kafka_partition, kafka_offset, {_time('kafka_timestamp')},
        '2024-01-31 00:00:00' AS _ingested_at,
        CAST(epoch(TIMESTAMP '2024-01-31 00:00:00' - kafka_timestamp) AS BIGINT) AS ingest_lag_sec
    FROM (SELECT *, CASE WHEN event_time < TIMESTAMP '2024-01-11' THEN 1 ELSE 2 END AS run FROM good) g
    LEFT JOIN known u USING (run, user_id)"""
_BODIES["full_run_report"] = """SELECT product_line, count(*) AS orders,
        round_even(avg(net_amount), 0) AS avg_net, round_even(avg(installments), 1) AS avg_installments
    FROM facts JOIN (SELECT session_id FROM good) USING (session_id) GROUP BY 1"""
_BODIES["ingest_cycle_gate"] = f"""WITH {_checks('cycle', 'live_facts', 'cycle_')}
    SELECT check_name, status, metric FROM cycle_checks"""
_BODIES["monitoring_gate"] = f"""WITH {_checks('landed', 'sent_facts', 'sent_')}
    SELECT check_name, status, metric FROM sent_checks"""
_BODIES["truncated_tables"] = """SELECT 'users' AS name, count(*) AS rows FROM people
    UNION ALL SELECT unnest(['events_enriched', 'fact_purchases', 'product_orders']), 0
    UNION ALL SELECT 'financial_order', count(*) FROM payments"""
_BODIES["users_from_change_stream"] = _CHANGED_USERS
_BODIES["stream_without_copies"] = f"""WITH delivered AS (
        SELECT * FROM good_enriched UNION ALL BY NAME
        SELECT * REPLACE (kafka_timestamp + INTERVAL 20 DAY AS kafka_timestamp) FROM good_enriched
        WHERE k = 52 AND event_time < TIMESTAMP '2024-01-11')
    SELECT {_list([c for c in _ENRICHED if c not in ('_ingested_at', 'ingest_lag_sec')])},
        '2024-01-31 00:00:00' AS _ingested_at,
        CAST(epoch(TIMESTAMP '2024-01-31 00:00:00' - kafka_timestamp) AS BIGINT) AS ingest_lag_sec
    FROM delivered"""
_BODIES["stream_agg_daily_compacted"] = _BODIES["stream_agg_daily"]
_BODIES["stream_progress"] = """SELECT CAST(3 AS BIGINT) AS batches, count(*) AS input_rows,
    count(*) AS counted_rows FROM ev"""
_BODIES["stream_facts_in_buckets"] = _BODIES["stream_facts"]
_BODIES["stream_two_runs"] = _BODIES["stream_enriched"]


# Sessions of several purchases and orders: the same definitions over one session per user and week.
_VISITS = _BASE.replace(
    "'s-' || event_id AS session_id",
    "'v-' || user_id || '-' || strftime(date_trunc('week', event_time), '%Y%m%d') AS session_id")
_VISIT_BODIES = {
    "visit_matches": f"SELECT {_list(_FACT)} FROM facts",
    "visit_facts": f"""SELECT {_list(_FACT)} FROM (SELECT *, row_number() OVER (PARTITION BY order_id
        ORDER BY facts.event_time, channel, event_premium NULLS LAST) AS place FROM facts) f WHERE place = 1""",
}


def _statement(body: str, base: str = _BASE) -> str:
    """The shared definitions with a query; a query's own WITH joins their list."""
    body = body.strip()
    if body.startswith("WITH "):
        return base.rstrip() + ",\n" + body[len("WITH "):]
    return base + body


ORACLE: dict[str, str] = {name: _statement(body) for name, body in _BODIES.items()} | {
    name: _statement(body, _VISITS) for name, body in _VISIT_BODIES.items()}
