"""The registered queries in plain SQL, written independently of the operators."""

from __future__ import annotations

TRADES = """trades AS (
  SELECT event_id, ts AS event_time, event_type AS symbol, value AS price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume
  FROM events)"""

MILLIS = """trades AS (
  SELECT event_id, date_trunc('millisecond', ts) AS event_time, event_type AS symbol,
         value AS price, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume
  FROM events)"""


def tidy(expr: str, name: str | None = None) -> str:
    return f"round({expr} + 1e-9, 6) AS {name or expr}"


def tidied(*names: str) -> str:
    return ", ".join(tidy(n) for n in names)


STATS = tidied("mean_price", "stddev_price")


def spread(symbol: str = "symbol") -> str:
    return f"""spread AS (
  SELECT TIMESTAMP '1970-01-01'
         + to_hours(CAST(floor(epoch(event_time) / 3600) AS BIGINT) - k) AS window_start,
         {symbol} AS symbol, price, volume, event_time, event_id
  FROM trades, range(6) r(k))"""


WINDOWS = """windows AS (
  SELECT window_start, window_start + INTERVAL 6 HOUR AS window_end, symbol,
         count(price) AS count_trades, avg(price) AS mean_price,
         stddev_samp(price) AS stddev_price
  FROM spread GROUP BY window_start, symbol)"""

RATED = """rated AS (
  SELECT *, stddev_price / mean_price AS volatility_ratio FROM windows
  WHERE count_trades >= 2 AND stddev_price > 0)"""

VOLATILE = f"{TRADES}, {spread()}, {WINDOWS}, {RATED}"
V_COLUMNS = ("window_start, window_end, symbol, count_trades, "
             + tidied("mean_price", "stddev_price", "volatility_ratio"))

REVISIONS = f"""{TRADES}, {spread()}, batches AS (
  SELECT *, CAST(floor(epoch(event_time) / 7200) AS BIGINT) AS batch_id FROM spread),
so_far AS (
  SELECT DISTINCT batch_id, window_start, window_start + INTERVAL 6 HOUR AS window_end, symbol,
         count(price) OVER w AS count_trades, avg(price) OVER w AS mean_price,
         stddev_samp(price) OVER w AS stddev_price
  FROM batches
  WINDOW w AS (PARTITION BY window_start, symbol ORDER BY batch_id
               RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
revised AS (
  SELECT *, stddev_price / mean_price AS volatility_ratio FROM so_far
  WHERE count_trades >= 2 AND stddev_price > 0 AND stddev_price / mean_price > 1.0),
revisions AS (
  SELECT DISTINCT batch_id, {V_COLUMNS} FROM revised)"""


def scored(keys: str, source: str = TRADES, extra: str = "") -> str:
    return f"""{source}, grouped AS (
  SELECT *, avg(price) OVER w AS mean_price, stddev_samp(price) OVER w AS stddev_price,
         count(price) OVER w AS count_trades {extra}
  FROM trades WINDOW w AS (PARTITION BY {keys})),
scored AS (
  SELECT *, (price - mean_price) / stddev_price AS z_score FROM grouped
  WHERE count_trades >= 5 AND stddev_price > 0)"""


DAY = "date_trunc('day', event_time), symbol"
Z_DAY = scored(DAY, extra=", CAST(date_trunc('day', event_time) AS TIMESTAMP) AS day")
Z_ALERTS = f"{Z_DAY}, alerts AS (SELECT * FROM scored WHERE abs(z_score) > 3)"
Z_COLUMNS = ("event_time, symbol, price, volume, count_trades, "
             + tidied("mean_price", "stddev_price", "z_score"))

SLIDING = f"""{TRADES}, {spread()}, grouped AS (
  SELECT *, window_start + INTERVAL 6 HOUR AS window_end, avg(price) OVER w AS mean_price,
         stddev_samp(price) OVER w AS stddev_price, count(price) OVER w AS count_trades
  FROM spread WINDOW w AS (PARTITION BY window_start, symbol)),
scored AS (
  SELECT *, (price - mean_price) / stddev_price AS z_score FROM grouped
  WHERE count_trades >= 5 AND stddev_price > 0),
sliding AS (SELECT * FROM scored WHERE abs(z_score) > 3)"""

CHOSEN = "('click', 'purchase', 'view')"


def box(source: str, value: str) -> str:
    return f"""{source}, quartiles AS (
  SELECT symbol, quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS median,
         quantile_cont({value}, 0.75) AS q3 FROM facts GROUP BY symbol),
boxed AS (
  SELECT f.symbol, f.{value} AS x, q1, median, q3,
         f.{value} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
  FROM facts f JOIN quartiles q ON f.symbol = q.symbol)
SELECT symbol, count(*) AS alerts, {tidy("max(q1)", "q1")}, {tidy("max(median)", "median")},
       {tidy("max(q3)", "q3")}, {tidy("min(x) FILTER (WHERE inside)", "whisker_low")},
       {tidy("max(x) FILTER (WHERE inside)", "whisker_high")},
       count(*) FILTER (WHERE NOT inside) AS outliers
FROM boxed GROUP BY symbol"""


ORACLES: dict[str, str] = {
    "trades_projection": f"WITH {MILLIS} SELECT * FROM trades",
    "envelope_flatten": f"WITH {MILLIS} SELECT * FROM trades WHERE symbol <> 'error'",
    "malformed_skip": f"""WITH {MILLIS}
SELECT event_id, event_time, symbol, price, CASE WHEN volume >= 20 THEN volume END AS volume
FROM trades WHERE volume >= 15""",
    "malformed_quarantine": f"""WITH {TRADES}
SELECT CASE WHEN volume < 5 THEN 16 WHEN volume < 10 THEN 1 ELSE 9 END::BIGINT AS line_length,
       count(*) AS lines FROM trades WHERE volume < 15 GROUP BY 1""",
    "watchlist_semi": f"""WITH {TRADES} SELECT * FROM trades WHERE symbol IN {CHOSEN}
AND symbol IN (SELECT symbol FROM trades GROUP BY symbol HAVING max(price) > 300)""",
    "first_n": f"WITH {TRADES} SELECT * FROM trades ORDER BY event_time, event_id LIMIT 20",
    "quote_snapshot": f"""WITH {TRADES}, days AS (
  SELECT symbol, CAST(date_trunc('day', event_time) AS TIMESTAMP) AS day, arg_max(price, (event_time, event_id)) AS c,
         arg_min(price, (event_time, event_id)) AS o, max(price) AS h, min(price) AS l
  FROM trades GROUP BY 1, 2),
lagged AS (SELECT *, lag(c) OVER (PARTITION BY symbol ORDER BY day) AS pc FROM days)
SELECT symbol, day, c, pc, o, h, l, {tidy("c - pc", "d")},
       {tidy("100 * (c - pc) / nullif(pc, 0)", "dp")} FROM lagged""",
    "json_roundtrip": f"WITH {MILLIS} SELECT event_time, symbol, price, volume FROM trades",
    "file_census": f"""WITH {TRADES}
SELECT CAST(date_trunc('day', event_time) AS TIMESTAMP) AS lot, true AS has_files, count(*) AS trades,
       true AS all_counted
FROM trades GROUP BY 1""",
    "symbol_sequence": f"""WITH {TRADES}
SELECT event_id, symbol, row_number() OVER (PARTITION BY symbol ORDER BY event_time, event_id) AS sequence
FROM trades""",
    "keyed_layout": f"""WITH {MILLIS}
SELECT symbol AS key, count(*) AS messages, count(*) AS own_key, 0::BIGINT AS out_of_order,
       min(event_time) AS first_time, max(event_time) AS last_time FROM trades GROUP BY 1""",

    "window_stats": f"""WITH {TRADES}, {spread()}, {WINDOWS}
SELECT window_start, window_end, symbol, count_trades, {STATS} FROM windows""",
    "window_stats_by_user": f"""WITH trades AS (
  SELECT event_id, ts AS event_time, CAST(user_id AS VARCHAR) AS symbol, value AS price,
         0 AS volume FROM events), {spread()}, {WINDOWS}
SELECT window_start, window_end, symbol, count_trades, {STATS} FROM windows""",
    "volatility_sliding": f"""WITH {VOLATILE}
SELECT {V_COLUMNS} FROM rated WHERE volatility_ratio > 1.0""",
    "volatility_revisions": f"WITH {REVISIONS} SELECT * FROM revisions",
    "volatility_batch_summary": f"""WITH {VOLATILE}
SELECT CAST(date_trunc('day', window_start) AS TIMESTAMP) AS batch, count(*) AS analysed,
       count(*) FILTER (WHERE volatility_ratio > 1.0) AS alerts,
       CASE WHEN count(*) FILTER (WHERE volatility_ratio > 1.0) = 0
            THEN round(max(volatility_ratio) + 1e-9, 6) END AS max_measure
FROM rated GROUP BY 1""",
    "zscore_batch": f"""WITH {scored("symbol")}
SELECT event_id, {Z_COLUMNS} FROM scored WHERE abs(z_score) > 3""",
    "zscore_bucketed": f"WITH {Z_ALERTS} SELECT event_id, day, {Z_COLUMNS} FROM alerts",
    "zscore_batch_summary": f"""WITH {Z_DAY}
SELECT day AS batch, count(*) AS analysed,
       count(*) FILTER (WHERE abs(z_score) > 3) AS alerts,
       CASE WHEN count(*) FILTER (WHERE abs(z_score) > 3) = 0
            THEN round(max(abs(z_score)) + 1e-9, 6) END AS max_measure
FROM scored GROUP BY 1""",
    "zscore_sliding": f"""WITH {SLIDING}
SELECT event_id, window_start, window_end, {Z_COLUMNS} FROM sliding""",
    "zscore_trailing": f"""WITH {TRADES}, grouped AS (
  SELECT *, avg(price) OVER w AS mean_price, stddev_samp(price) OVER w AS stddev_price,
         count(price) OVER w AS count_trades
  FROM trades WINDOW w AS (PARTITION BY symbol ORDER BY event_time
       RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW)),
scored AS (
  SELECT *, (price - mean_price) / stddev_price AS z_score FROM grouped
  WHERE count_trades >= 5 AND stddev_price > 0)
SELECT event_id, {Z_COLUMNS} FROM scored WHERE abs(z_score) > 3""",

    "alerts_union": f"""WITH {VOLATILE}, volatile AS (
  SELECT 'volatility' AS family, {V_COLUMNS}, NULL::TIMESTAMP AS event_time,
         NULL::DOUBLE AS price, NULL::DOUBLE AS volume, NULL::DOUBLE AS z_score
  FROM rated WHERE volatility_ratio > 1.0),
{scored(DAY, source="unused AS (SELECT 1)")}
SELECT * FROM volatile
UNION ALL BY NAME
SELECT 'zscore' AS family, {Z_COLUMNS} FROM scored WHERE abs(z_score) > 3""",
    "alert_files_flat": f"""WITH {Z_ALERTS}, {spread()}, {WINDOWS}, {RATED}
SELECT 'volatility' AS family, CASE WHEN symbol IN {CHOSEN} THEN 1 ELSE 2 END::BIGINT AS batch_id,
       window_start, window_end, symbol, CASE WHEN symbol IN {CHOSEN} THEN count_trades END AS count_trades,
       {tidied("mean_price", "stddev_price", "volatility_ratio")}, NULL::TIMESTAMP AS event_time,
       NULL::DOUBLE AS price, NULL::DOUBLE AS volume, NULL::DOUBLE AS z_score
FROM rated WHERE volatility_ratio > 1.0
UNION ALL
SELECT 'zscore', CASE WHEN symbol IN {CHOSEN} THEN 3 ELSE 4 END, NULL, NULL, symbol, count_trades,
       {tidied("mean_price", "stddev_price")}, NULL, event_time, price, volume, {tidy("z_score")}
FROM alerts""",
    "alert_dedup_volatility": f"""WITH {REVISIONS}
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start, window_end, symbol, mean_price
                               ORDER BY batch_id, count_trades, stddev_price) AS rn
  FROM revisions) WHERE rn = 1""",
    "alert_dedup_zscore": f"""WITH {SLIDING}
SELECT window_start, window_end, {Z_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY event_time, symbol, price
                               ORDER BY window_start, volume, mean_price) AS rn
  FROM sliding) WHERE rn = 1""",
    "alert_latest_revision": f"""WITH {REVISIONS}
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start, symbol ORDER BY batch_id DESC) AS rn
  FROM revisions) WHERE rn = 1""",
    "alert_latest_maintained": f"""WITH {REVISIONS}
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start, symbol ORDER BY batch_id DESC) AS rn
  FROM revisions) WHERE rn = 1""",
    "price_sketch_ranges": f"""WITH {TRADES}, ranges("first", "last") AS (
  VALUES ('2024-01-01', '2024-01-31'), ('2024-01-05', '2024-01-05'), ('2024-01-10', '2024-01-19'))
SELECT "first", "last", symbol, count(*) AS n, {tidy("min(price)", "low")}, {tidy("max(price)", "high")},
       true AS q1_near, true AS median_near, true AS q3_near
FROM trades JOIN ranges ON CAST(event_time AS DATE) BETWEEN CAST("first" AS DATE) AND CAST("last" AS DATE)
GROUP BY ALL""",
    "sketch_distinct_users": """SELECT event_type AS symbol, count(DISTINCT user_id) AS users, true AS near
FROM events GROUP BY 1""",
    "alert_kpis": f"""WITH {Z_ALERTS}
SELECT count(*) AS alerts, count(DISTINCT symbol) AS symbols,
       {tidy("max(abs(z_score))", "max_abs_z")},
       printf('%.2f', max(abs(z_score))) AS max_abs_z_text FROM alerts""",
    "alert_bounds": f"""WITH {REVISIONS}, z AS (WITH {Z_ALERTS} SELECT * FROM alerts)
SELECT 'volatility' AS family, {tidy("min(volatility_ratio)", "low")},
       {tidy("max(volatility_ratio)", "high")} FROM revised
UNION ALL
SELECT 'zscore', {tidy("min(abs(z_score))", "low")}, {tidy("max(abs(z_score))", "high")} FROM z""",
    "alert_symbols": f"WITH {Z_ALERTS} SELECT DISTINCT symbol FROM alerts",
    "alert_filter": f"""WITH {Z_ALERTS}
SELECT event_time, symbol, price, volume, {tidied("mean_price", "stddev_price", "z_score")}
FROM alerts WHERE symbol IN {CHOSEN} AND abs(z_score) >= 3.2 AND abs(z_score) <= 4.5
ORDER BY event_time DESC""",
    "alert_filter_volatility": f"""WITH {VOLATILE}
SELECT {V_COLUMNS} FROM rated
WHERE volatility_ratio > 1.0 AND symbol IN {CHOSEN}
  AND volatility_ratio BETWEEN 1.05 AND 1.4
ORDER BY window_start DESC""",
    "alert_store_range": f"""WITH {Z_ALERTS}
SELECT CASE WHEN event_time < TIMESTAMP '2024-01-16' THEN 0 ELSE 1 END::BIGINT AS batch_id, {Z_COLUMNS}
FROM alerts WHERE symbol IN {CHOSEN} AND abs(z_score) BETWEEN 3.2 AND 4.5
  AND event_time BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-25 18:00:00'""",
    "alert_shown_of_total": f"""WITH {Z_ALERTS}
SELECT count(*) FILTER (WHERE symbol IN {CHOSEN} AND abs(z_score) BETWEEN 3.2 AND 4.5) AS shown,
       count(*) AS total FROM alerts""",
    "alert_count_by_symbol": f"""WITH {Z_ALERTS}
SELECT symbol, count(*) AS alerts FROM alerts GROUP BY symbol ORDER BY alerts DESC, symbol""",
    "alert_box_stats": "WITH " + box(
        f"{VOLATILE}, facts AS (SELECT * FROM rated WHERE volatility_ratio > 1.0)",
        "volatility_ratio"),
    "price_box_stats": "WITH " + box(f"{TRADES}, facts AS (SELECT * FROM trades)", "price"),
    "alert_histogram": f"""WITH {Z_ALERTS}, ends AS (
  SELECT min(z_score) AS low, max(z_score) AS high FROM alerts),
placed AS (
  SELECT symbol, low, (high - low) / 30 AS width,
         CAST(CASE WHEN low = high THEN 1
              ELSE least(30, floor((z_score - low) / ((high - low) / 30)) + 1) END AS BIGINT) AS bin
  FROM alerts, ends)
SELECT symbol, bin, count(*) AS alerts, {tidy("min(low + (bin - 1) * width)", "bin_from")},
       {tidy("min(low + bin * width)", "bin_to")} FROM placed GROUP BY symbol, bin""",
    "alert_band": f"""WITH {Z_ALERTS}
SELECT event_id, {Z_COLUMNS}, {tidy("mean_price - 3 * stddev_price", "band_low")},
       {tidy("mean_price + 3 * stddev_price", "band_high")}
FROM alerts ORDER BY symbol, event_time""",
    "alert_freshness": f"""WITH {VOLATILE}, kpis AS (
  SELECT count(*) AS alerts, count(DISTINCT symbol) AS symbols, max(window_end) AS latest,
         CAST(floor(epoch(TIMESTAMP '2024-01-31 12:00:00')) - floor(epoch(max(window_end)))
              AS BIGINT) AS age_s
  FROM rated WHERE volatility_ratio > 1.0)
SELECT alerts, symbols, latest,
       CASE WHEN age_s < 60 THEN age_s || 's' WHEN age_s < 3600 THEN (age_s // 60) || 'min'
            ELSE (age_s // 3600) || 'h' END AS age FROM kpis""",
    "csv_export_roundtrip": f"""WITH {Z_ALERTS}
SELECT {Z_COLUMNS}, '20240131_120000' AS stamp FROM alerts
WHERE symbol IN {CHOSEN} AND abs(z_score) >= 3.0""",

    "stream_volatility_update": f"""WITH {MILLIS}, {spread()}, batches AS (
  SELECT *, event_id % 3 AS batch_id FROM spread),
so_far AS (
  SELECT DISTINCT batch_id, window_start, window_start + INTERVAL 6 HOUR AS window_end, symbol,
         count(price) OVER w AS count_trades, avg(price) OVER w AS mean_price,
         stddev_samp(price) OVER w AS stddev_price
  FROM batches
  WINDOW w AS (PARTITION BY window_start, symbol ORDER BY batch_id
               RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
alerts AS (
  SELECT *, stddev_price / mean_price AS volatility_ratio FROM so_far
  WHERE count_trades >= 2 AND stddev_price > 0 AND stddev_price / mean_price > 1.0),
emitted AS (
  SELECT window_start, symbol, max(batch_id) AS batch_id, count(DISTINCT batch_id) AS emitted
  FROM alerts GROUP BY 1, 2)
SELECT DISTINCT batch_id, {V_COLUMNS}, emitted
FROM alerts JOIN emitted USING (window_start, symbol, batch_id)""",
    "stream_zscore_foreachbatch": f"""WITH {scored("symbol")}
SELECT 0::BIGINT AS batch_id, {Z_COLUMNS} FROM scored WHERE abs(z_score) > 3""",
    "stream_zscore_sliding": f"""WITH {SLIDING}
SELECT event_id, window_start, window_end, {Z_COLUMNS} FROM sliding
WHERE window_end <= (SELECT date_trunc('millisecond', max(event_time)) - INTERVAL 1 HOUR
                     FROM trades)""",
    "stream_late_drop": f"""WITH {MILLIS}, {spread()}, {WINDOWS}
SELECT window_start, window_end, symbol, count_trades, {STATS} FROM windows
WHERE symbol <> 'error' OR window_end > (
  SELECT max(event_time) - INTERVAL 1 HOUR FROM trades WHERE symbol <> 'error')""",
    "stream_restart_idempotent": f"""WITH {scored(
        "event_time >= TIMESTAMP '2024-01-16', symbol", MILLIS,
        ", CAST(event_time >= TIMESTAMP '2024-01-16' AS BIGINT) AS batch_id")}
SELECT batch_id, {Z_COLUMNS} FROM scored WHERE abs(z_score) > 3 AND batch_id = 1""",
    "stream_zscore_trailing": f"""WITH {TRADES}, grouped AS (
  SELECT *, avg(price) OVER w AS mean_price, stddev_samp(price) OVER w AS stddev_price,
         count(price) OVER w AS count_trades
  FROM trades WINDOW w AS (PARTITION BY symbol ORDER BY event_time
       RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW)),
scored AS (
  SELECT *, (price - mean_price) / stddev_price AS z_score FROM grouped
  WHERE count_trades >= 5 AND stddev_price > 0)
SELECT event_id, {Z_COLUMNS} FROM scored WHERE abs(z_score) > 3
  AND date_trunc('hour', event_time) + INTERVAL 1 HOUR
      <= (SELECT date_trunc('millisecond', max(event_time)) - INTERVAL 1 HOUR FROM trades)""",
    "stream_late_routed": f"""WITH {MILLIS}
SELECT event_time, symbol, price, volume, CAST(symbol = 'error' AS BIGINT) AS batch_id,
       CASE WHEN symbol = 'error' AND event_time < (
         SELECT max(event_time) - INTERVAL 1 HOUR FROM trades WHERE symbol <> 'error')
       THEN 'late' ELSE 'kept' END AS side FROM trades""",
    "message_log_replay": f"""WITH {MILLIS}
SELECT 'TRIM_HORIZON' AS "start", event_time, symbol, price, volume FROM trades
UNION ALL
SELECT 'LATEST', event_time, symbol, price, volume FROM trades WHERE event_id IN (
  SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-16')""",
    "stream_json_lots": f"WITH {MILLIS} SELECT event_time, symbol, price, volume FROM trades",
    "lots_compacted": f"WITH {MILLIS} SELECT event_time, symbol, price, volume FROM trades",
    "stream_dedup_zscore": f"""WITH {SLIDING}
SELECT DISTINCT event_time, symbol, price, volume FROM sliding""",
}
