"""Independent SQL for the registered queries, over the raw tables alone."""

from __future__ import annotations

BARS = """
bars AS (
  SELECT 'S' || user_id AS stock, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS date,
         arg_min(value, ts) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, ts) AS close, CAST(count(*) AS DOUBLE) AS volume
  FROM events GROUP BY 1, 2
)"""

DAILY = """
daily AS (
  SELECT stock, CAST(date AS DATE) AS date_only,
         arg_min(open, date) AS daily_open, arg_max(close, date) AS daily_close
  FROM bars GROUP BY 1, 2
),
moves AS (
  SELECT *, CASE WHEN daily_close > daily_open THEN 1
                 WHEN daily_close < daily_open THEN -1 ELSE 0 END AS daily_change
  FROM daily
)"""

BREADTH_SELECT = """
SELECT date_only,
       CAST(sum(CASE WHEN daily_change = 1 THEN 1 ELSE 0 END) AS BIGINT) AS num_stocks_increased,
       CAST(sum(CASE WHEN daily_change = -1 THEN 1 ELSE 0 END) AS BIGINT) AS num_stocks_decreased,
       CAST(sum(CASE WHEN daily_change = 0 THEN 1 ELSE 0 END) AS BIGINT) AS num_stocks_unchanged
FROM moves GROUP BY date_only"""

STATS_SELECT = """
SELECT stock, round(avg(open), 10) AS avg_open, round(avg(high), 10) AS avg_high,
       round(avg(low), 10) AS avg_low, round(avg(close), 10) AS avg_close,
       round(avg(volume), 10) AS avg_volume,
       round(stddev_samp(close), 8) AS std_dev_close,
       max(high) AS historical_high, min(low) AS historical_low
FROM bars GROUP BY stock"""

WITH_PREVIOUS = """
prev AS (
  SELECT *, lag(close) OVER (PARTITION BY stock ORDER BY date) AS prev_day_close FROM bars
)"""

UNIVERSE = """
universe AS (
  SELECT DISTINCT unnest(string_split('S' || (user_id - user_id % 2) || ',S' || (user_id + 1000000), ',')) AS stock
  FROM events
)"""

RESENT = """
bars AS (
  SELECT 'S' || user_id AS stock, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS date,
         value AS open, value AS high, value AS low, value AS close,
         CAST(event_id AS DOUBLE) AS volume
  FROM events
)"""

SETTLED = """
bars AS (
  SELECT 'S' || user_id AS stock, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS date,
         arg_max(value, ts) AS open, arg_max(value, ts) AS close
  FROM events GROUP BY 1, 2
)"""

LINE = """'stock-price-v1,stock=' || stock || ' open=' || CAST(open AS VARCHAR)
       || ',high=' || CAST(high AS VARCHAR) || ',low=' || CAST(low AS VARCHAR)
       || ',close=' || CAST(close AS VARCHAR) || ',volume=' || CAST(volume AS VARCHAR)
       || ' ' || CAST(CAST(epoch(date) AS BIGINT) AS VARCHAR)"""

JSON = """'{"stock":"' || stock || '","date":"' || strftime(date, '%Y-%m-%dT%H:%M:%SZ')
       || '","open":' || CAST(open AS VARCHAR) || ',"high":' || CAST(high AS VARCHAR)
       || ',"low":' || CAST(low AS VARCHAR) || ',"close":' || CAST(close AS VARCHAR)
       || ',"volume":' || CAST(volume AS VARCHAR) || '}'"""

# The seconds of an instant are cut off, not rounded.
TICKS = """
ticks AS (
  SELECT event_id, event_type, 'S' || user_id AS stock, ts AS date, value
  FROM events
)"""

REASON = """CASE event_type WHEN 'error' THEN 'malformed' WHEN 'purchase' THEN 'no date'
            WHEN 'signup' THEN 'bad date' WHEN 'view' THEN 'no stock' END"""

ALL_BARS = f"WITH {BARS} SELECT * FROM bars"
BREADTH = f"WITH {BARS}, {DAILY} {BREADTH_SELECT}"
STATS = f"WITH {BARS} {STATS_SELECT}"
POINT_COLUMNS = "'stock-price-v1' AS measurement, stock, open, high, low, close, volume, date AS time"
LATEST = """
SELECT * FROM bars
QUALIFY row_number() OVER (PARTITION BY stock ORDER BY date DESC) = 1"""
LAST_DAY = """
last_day AS (
  SELECT * FROM bars
  WHERE date >= (SELECT max(date) FROM bars) - INTERVAL 1 DAY
    AND date < (SELECT max(date) FROM bars)
)"""

# Parts of a feed: ranges of time of one length, some rows a part late.
PARTS = """
ends AS (SELECT CAST(floor(epoch(min({time}))) AS BIGINT) AS lo, CAST(floor(epoch(max({time}))) AS BIGINT) AS hi FROM {rows}),
parts AS (
  SELECT r.*, least(({parts} * (CAST(floor(epoch({time})) AS BIGINT) - lo)) // (hi - lo + 1)
                    + CASE WHEN {late} THEN 1 ELSE 0 END, {parts} - 1) AS part
  FROM {rows} r, ends
)"""

SQL: dict[str, str] = {
    "bars": ALL_BARS,
    "basic_stats": STATS,
    "bar_returns": f"""
        WITH {BARS}, {WITH_PREVIOUS}
        SELECT *, (close - prev_day_close) / nullif(prev_day_close, 0) AS daily_return
        FROM prev""",
    "return_series": f"""
        WITH {BARS}, {WITH_PREVIOUS}
        SELECT stock, date,
               (close - prev_day_close) / nullif(prev_day_close, 0) AS daily_return,
               close AS moving_avg_1d
        FROM prev""",
    "moving_avg_1": f"""
        WITH {BARS}
        SELECT stock, date, avg(close) OVER (PARTITION BY stock ORDER BY date
                 ROWS BETWEEN CURRENT ROW AND CURRENT ROW) AS moving_avg_1d
        FROM bars""",
    "moving_avg_5": f"""
        WITH {BARS}
        SELECT stock, date, round(avg(close) OVER (PARTITION BY stock ORDER BY date
                 ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 10) AS moving_avg
        FROM bars""",
    "moving_avg_50": f"""
        WITH {BARS}
        SELECT stock, date, round(avg(close) OVER (PARTITION BY stock ORDER BY date
                 ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 10) AS moving_avg
        FROM bars""",
    "daily_prices": f"WITH {BARS}, {DAILY} SELECT * FROM moves",
    "market_breadth": BREADTH,
    "union_bars": f"WITH {BARS} SELECT * FROM bars UNION ALL SELECT * FROM bars",
    "dedup_bars": f"""
        WITH {BARS}
        SELECT DISTINCT * FROM (SELECT * FROM bars UNION ALL SELECT * FROM bars)""",
    "revised_bars": """
        SELECT 'S' || user_id AS stock, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS date,
               arg_max(value, ts) AS open, arg_max(value, ts) AS high,
               arg_max(value, ts) AS low, arg_max(value, ts) AS close,
               CAST(arg_max(event_id, ts) AS DOUBLE) AS volume
        FROM events GROUP BY 1, 2""",
    "point_upsert": """
        SELECT event_type, CAST(date_trunc('minute', ts) AS TIMESTAMP) AS minute,
               max(event_id) AS event_id, arg_max(value, event_id) AS value
        FROM events GROUP BY 1, 2""",
    "latest_bar": f"WITH {BARS} {LATEST}",
    "universe": f"WITH {UNIVERSE} SELECT stock FROM universe",
    "universe_latest": f"""
        WITH {BARS}, {UNIVERSE}, newest AS ({LATEST})
        SELECT * FROM newest WHERE stock IN (SELECT stock FROM universe)""",
    "lookback_1d": f"WITH {BARS}, {LAST_DAY} SELECT * FROM last_day",
    "ingest_latest": f"""
        WITH {BARS}, {LAST_DAY}, {UNIVERSE}
        SELECT * FROM last_day WHERE stock IN (SELECT stock FROM universe)
        QUALIFY row_number() OVER (PARTITION BY stock ORDER BY date DESC) = 1""",
    "points": f"""
        WITH {BARS}
        SELECT 'stock-price-v1' AS measurement, stock AS tag_stock, open AS field_open,
               high AS field_high, low AS field_low, close AS field_close,
               volume AS field_volume, CAST(epoch(date) AS BIGINT) AS time
        FROM bars""",
    "line_protocol": f"WITH {BARS} SELECT {LINE} AS line FROM bars",
    "line_protocol_maps": f"WITH {BARS} SELECT {LINE} AS line FROM bars",
    "keyed_messages": f"WITH {BARS} SELECT stock AS key, {JSON} AS value FROM bars",
    "json_roundtrip": ALL_BARS,
    "dead_letter": f"""
        WITH {TICKS}
        SELECT event_id, {REASON} AS reject_reason FROM ticks WHERE event_type <> 'click'""",
    "accepted_bars": f"""
        WITH {TICKS}
        SELECT stock, date, value AS open, value AS high, value AS low, value AS close,
               value AS volume, event_id
        FROM ticks WHERE event_type = 'click'""",
    "archive_roundtrip": ALL_BARS,
    "raw_dump": f"""
        WITH {BARS} SELECT CAST(date AS DATE) AS day, {JSON} AS value FROM bars""",
    "archive_compacted": ALL_BARS,
    "points_recent": f"""
        WITH {BARS} SELECT {POINT_COLUMNS} FROM bars
        WHERE date >= (SELECT max(date) FROM bars) - INTERVAL 1 HOUR""",
    "results_sink": BREADTH,
    "results_sink_json": STATS,
    "batch_layer_breadth": BREADTH,
    "batch_layer_compacted": BREADTH,
    "batch_layer_summary": f"WITH {RESENT} {STATS_SELECT}",
    "batch_layer_returns": f"""
        WITH {SETTLED}, {WITH_PREVIOUS}
        SELECT stock, date,
               (close - prev_day_close) / nullif(prev_day_close, 0) AS daily_return,
               close AS moving_avg_1d
        FROM prev""",
    "batch_layer_daily": f"WITH {SETTLED}, {DAILY} SELECT * FROM moves",
    "batch_layer_rejects": f"""
        WITH {TICKS}
        SELECT {REASON} AS reject_reason, count(*) AS texts
        FROM ticks WHERE event_type <> 'click' GROUP BY 1""",
    "sorted_bars": f"WITH {BARS} SELECT * FROM bars ORDER BY stock, date",
    "sorted_preview": f"WITH {BARS} SELECT * FROM bars ORDER BY stock, date LIMIT 20",
    "topic_replay": f"WITH {BARS} SELECT stock AS key, {JSON} AS value FROM bars",
    "stream_decode": ALL_BARS,
    "stream_fanout": f"""
        WITH {TICKS}
        SELECT 'points' AS sink, 'stock-price-v1,stock=' || stock
               || ' open=' || CAST(value AS VARCHAR) || ',high=' || CAST(value AS VARCHAR)
               || ',low=' || CAST(value AS VARCHAR) || ',close=' || CAST(value AS VARCHAR)
               || ',volume=' || CAST(value AS VARCHAR) || ' '
               || CAST(CAST(epoch(date_trunc('second', date)) AS BIGINT) AS VARCHAR) AS text
        FROM (SELECT * FROM ticks WHERE event_type = 'click'
              QUALIFY row_number() OVER (PARTITION BY stock, date_trunc('second', date)
                                         ORDER BY date DESC) = 1)
        UNION ALL
        SELECT 'archive', stock || '|' || replace(CAST(date AS VARCHAR), ' ', 'T') || 'Z|'
               || CAST(value AS VARCHAR)
        FROM ticks WHERE event_type = 'click'
        UNION ALL
        SELECT 'rejects', {REASON} FROM ticks WHERE event_type <> 'click'""",
    "stream_progress": """
        SELECT count(*) AS rows_read,
               count(*) FILTER (WHERE event_type <> 'click') AS rows_rejected
        FROM events""",
    "stream_dedup": ALL_BARS,
    "stream_upsert": f"WITH {BARS} SELECT {POINT_COLUMNS} FROM bars",
    "stream_ingest": f"""
        WITH {BARS}, {UNIVERSE}, newest AS ({LATEST})
        SELECT * FROM newest WHERE stock IN (SELECT stock FROM universe)""",
    "cluster_features": f"""
        WITH {BARS}, stats AS ({STATS_SELECT})
        SELECT stock, avg_open, avg_high, avg_low, avg_close, avg_volume FROM stats""",
    "cluster_checks": """
        SELECT count(DISTINCT user_id) AS stocks, 3::BIGINT AS groups, 0::BIGINT AS astray
        FROM events""",
    "stream_revisions": f"""
        WITH {PARTS.format(time="ts", parts=4, late="event_id % 5 = 0", rows="events")}, latest AS (
          SELECT 'S' || user_id AS stock, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS date, part, max(ts) AS newest
          FROM parts GROUP BY 1, 2, 3
        ), sends AS (
          SELECT *, max(newest) OVER (PARTITION BY stock, date ORDER BY part
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
          FROM latest
        ), times AS (
          SELECT stock, date, count(*) AS times_sent FROM sends WHERE before IS NULL OR newest > before GROUP BY 1, 2
        ), last AS (
          SELECT 'S' || user_id AS stock, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS date,
                 arg_max(value, ts) AS open, arg_max(value, ts) AS high, arg_max(value, ts) AS low,
                 arg_max(value, ts) AS close, CAST(arg_max(event_id, ts) AS DOUBLE) AS volume
          FROM events GROUP BY 1, 2
        )
        SELECT last.*, times_sent FROM last JOIN times USING (stock, date)""",
    "stream_returns": f"""
        WITH {BARS}, {WITH_PREVIOUS}
        SELECT stock, date, prev_day_close,
               (close - prev_day_close) / nullif(prev_day_close, 0) AS daily_return,
               round(avg(close) OVER (PARTITION BY stock ORDER BY date
                 ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 10) AS moving_avg
        FROM prev""",
    "archive_tail_compacted": ALL_BARS,
    "summary_incremental": STATS,
    "stream_dedup_any_delay": ALL_BARS,
    "stream_poll": ALL_BARS,
    "empty_archive": ALL_BARS,
    "stream_commit": f"WITH {BARS} SELECT {LINE} AS line FROM bars",
    "tombstones": """
        SELECT event_type AS key,
               count(CASE WHEN event_type <> 'view' THEN props END) AS messages,
               count(*) - count(CASE WHEN event_type <> 'view' THEN props END) AS tombstones
        FROM events GROUP BY 1""",
    "poll_replay": f"""
        WITH {BARS}, polls AS (
          SELECT stock, unnest(generate_series((SELECT min(date) FROM bars), (SELECT max(date) FROM bars), INTERVAL 6 HOUR)) AS polled_at
          FROM (SELECT DISTINCT stock FROM bars)
        )
        SELECT p.stock, p.polled_at, b.* EXCLUDE (stock)
        FROM polls p ASOF JOIN bars b ON p.stock = b.stock AND p.polled_at >= b.date
        WHERE b.date >= p.polled_at - INTERVAL 1 DAY""",
    "stream_audit": f"""
        WITH {TICKS}, told AS (
          SELECT 'read' AS sink, count(*) AS rows FROM ticks
          UNION ALL SELECT 'archive', count(*) FROM ticks WHERE event_type = 'click'
          UNION ALL SELECT 'rejects', count(*) FROM ticks WHERE event_type <> 'click'
          UNION ALL SELECT 'points', count(DISTINCT (stock, date_trunc('second', date))) FROM ticks WHERE event_type = 'click'
        )
        SELECT sink, rows, 0::BIGINT AS batches_off FROM told""",
    "settled_any_order": """
        SELECT user_id, CAST(ts AS DATE) AS day, event_type,
               CAST(floor(value / 10) AS BIGINT) AS price_band, 'e' || event_id AS name, value
        FROM events
        QUALIFY row_number() OVER (
          PARTITION BY user_id, day ORDER BY event_type DESC, price_band DESC, name DESC) = 1""",
    "clusters_coreset": """
        SELECT count(DISTINCT user_id) AS stocks, 3::BIGINT AS groups, true AS near FROM events""",
}
