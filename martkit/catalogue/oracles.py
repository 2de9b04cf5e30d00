"""The same queries in SQL over the given tables, for an independent check."""

SALES = """sales AS (
  SELECT CAST(event_id // 1000 + 1 AS BIGINT) AS page,
         CAST(user_id % 20 AS INTEGER) AS store_id,
         CAST(event_id AS VARCHAR) AS purchase_id,
         CASE event_type WHEN 'purchase' THEN 'us_doller' WHEN 'click' THEN 'pound'
                         WHEN 'error' THEN NULL ELSE 'yen' END AS scale,
         'Store ' || chr(CAST(65 + user_id % 20 AS INTEGER)) AS store_name,
         ts AS time,
         value AS sales,
         strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d') AS retrieval_date
  FROM events)"""

RATES = """rates AS (
  SELECT c.currency,
         CAST(CASE c.currency
                WHEN 'JPY' THEN 150 + CAST(substr(d.retrieval_date, 9, 2) AS INTEGER) * 0.25
                WHEN 'EUR' THEN 0.9375 ELSE 1 END AS DOUBLE) AS rates,
         d.retrieval_date
  FROM (SELECT DISTINCT retrieval_date FROM sales WHERE retrieval_date <> '2024-01-07') d
  CROSS JOIN (VALUES ('JPY'), ('EUR'), ('USD')) AS c(currency))"""

PRICED = """priced AS (
  SELECT s.*, r.currency, r.rates,
         CASE WHEN s.scale = 'yen' THEN s.sales
              WHEN s.scale = 'us_doller' THEN s.sales * r.rates
              ELSE s.sales END AS sales_jpy
  FROM sales s JOIN rates r
    ON s.retrieval_date = r.retrieval_date AND r.currency = 'JPY')"""

MART = """mart AS (
  SELECT CAST(page AS INTEGER) AS page, purchase_id, scale, store_name, time, sales, sales_jpy,
         strftime(time + INTERVAL 9 HOUR, '%Y-%m-%d') AS ymd,
         CAST(hour(time + INTERVAL 9 HOUR) AS VARCHAR) AS hh,
         retrieval_date, CAST(store_id AS VARCHAR) AS store_id
  FROM priced)"""

# The day a snapshot was taken, as its text has it, decides how it is damaged.
DAMAGED = f"""WITH {SALES}, {RATES}, taken AS (
  SELECT day, strftime(CAST(day AS TIMESTAMP) + INTERVAL 16 HOUR, '%Y-%m-%d') AS taken,
         day(CAST(day AS TIMESTAMP) + INTERVAL 16 HOUR) % 4 AS kind,
         CAST(jpy AS VARCHAR) AS jpy
  FROM (SELECT retrieval_date AS day, max(rates) AS jpy FROM rates GROUP BY ALL))"""

ARRIVED = f"""WITH {SALES}, arrived AS (
  SELECT * REPLACE (
    CASE WHEN CAST(purchase_id AS BIGINT) % 4 < 2 THEN '2024-02-01' ELSE '2024-02-02' END
      AS retrieval_date) FROM sales)"""

TO_RATES = f"WITH {SALES}, {RATES}"
TO_PRICED = f"{TO_RATES}, {PRICED}"
TO_MART = f"{TO_PRICED}, {MART}"

TOTAL = 'CAST(sum(CAST(sales_jpy AS DECIMAL(18,4))) AS DOUBLE) AS "売り上げ"'
DAILY = f"{TO_MART} SELECT ymd, store_id, {TOTAL} FROM mart GROUP BY ymd, store_id"
PARTITIONS = f"{TO_MART} SELECT DISTINCT retrieval_date, store_id FROM mart"

CHANGES = """changes AS (
  SELECT user_id, event_type, value, ts, event_id, event_type = 'error' AS _deleted,
         strftime(ts, '%Y%m%d') AS _commit_time
  FROM events)"""


def _versions(condition: str, value: str = "value") -> str:
    return f"""WITH {CHANGES}, ranked AS (
      SELECT *, row_number() OVER (
        PARTITION BY user_id ORDER BY _commit_time DESC, ts DESC, event_id DESC) AS place
      FROM changes WHERE {condition})
    SELECT user_id, event_type, {value} AS value, ts, event_id, _commit_time
    FROM ranked WHERE place = 1 AND NOT _deleted"""


COMMITTED = """batches AS (
  SELECT user_id, event_type, event_id, strftime(ts, '%Y-%m-%d') AS day, value,
         CASE WHEN day <= '2024-01-10' THEN '20240110000000000'
              WHEN day <= '2024-01-20' THEN '20240120000000000'
              ELSE '20240130000000000' END AS _commit_time
  FROM events),
written AS (
  SELECT *, row_number() OVER (
    PARTITION BY user_id ORDER BY _commit_time DESC, event_id DESC) AS place
  FROM batches WHERE _commit_time <= '{last}'),
gone AS (
  SELECT DISTINCT user_id FROM batches
  WHERE _commit_time > '20240120000000000' AND event_type = 'error' AND value > 30)"""
EVERY = COMMITTED.replace("{last}", "20240130000000000")
EARLY = COMMITTED.replace("{last}", "20240120000000000")

COMMITTED_COLUMNS = """_commit_time, CAST(user_id AS VARCHAR) AS _record_key,
    day AS _partition_path, user_id, event_type, event_id, day,
    CASE WHEN _commit_time > '20240110000000000' THEN value END AS value"""

SNAPSHOT = f"""WITH {EVERY} SELECT {COMMITTED_COLUMNS} FROM written
  WHERE place = 1 AND user_id NOT IN (SELECT user_id FROM gone)"""

POINTS = """points AS (
  SELECT c_custkey,
         CAST(c_custkey % 180 - 90 + 0.5 AS DOUBLE) AS lat,
         CAST(c_custkey * 7 % 360 - 180 + 0.5 AS DOUBLE) AS lon
  FROM customer)"""

PLACES = """places AS (
  SELECT n_nationkey, n_name,
         CAST(-90 + (n_nationkey % 5) * 36 AS DOUBLE) AS south, south + 40 AS north,
         CAST(-180 + (n_nationkey // 5) * 72 AS DOUBLE) AS west,
         west + 72 + 8 * (n_nationkey % 3) AS east
  FROM nation)"""

INSIDE = "lat BETWEEN south AND north AND lon BETWEEN west AND east"

ORACLES = {
    "page_range": f"""WITH {SALES}, counted AS (
          SELECT page, count(*) AS sales_rows FROM sales GROUP BY page)
        SELECT r.page, c.sales_rows
        FROM range(1, (SELECT max(page) + 1 FROM counted)) AS r(page) LEFT JOIN counted c
          ON r.page = c.page""",
    "fetched_pages": """SELECT c_custkey + 1 AS page,
          CAST((c_custkey + 1) % 20 AS INTEGER) AS store_id,
          k.kind || CAST(c_custkey + 1 AS VARCHAR) AS purchase_id,
          CASE k.kind WHEN 'A' THEN 'yen' ELSE 'us_doller' END AS scale,
          'Store API' AS store_name,
          TIMESTAMP '2024-06-12 19:15:30.123' AS time,
          CAST((c_custkey + 1) * CASE k.kind WHEN 'A' THEN 1 ELSE 0.5 END AS DOUBLE) AS sales
        FROM customer CROSS JOIN (VALUES ('A'), ('B')) AS k(kind)""",
    "json_pages_explode": f"""WITH {SALES}
        SELECT page, store_id, purchase_id, scale, store_name,
               time, sales FROM sales""",
    "malformed_pages": """SELECT c_custkey AS page,
          CASE c_custkey % 7 WHEN 1 THEN 'missing' WHEN 2 THEN 'empty' WHEN 4 THEN 'no data'
                             WHEN 5 THEN 'bad field' ELSE 'unparsable' END AS reason
        FROM customer WHERE c_custkey % 7 <> 6""",
    "raw_land_read": f"WITH {SALES} SELECT * FROM sales",
    "ingest_hours": f"{ARRIVED} SELECT * FROM arrived",
    "mart_days": f"""{ARRIVED}, {RATES}, highest AS (
          SELECT max(rates) AS rates FROM rates WHERE currency = 'JPY')
        SELECT CAST(page AS INTEGER) AS page, purchase_id, scale, store_name, time, a.sales,
          CASE WHEN scale = 'yen' THEN a.sales WHEN scale = 'us_doller' THEN a.sales * rates
               ELSE a.sales END AS sales_jpy,
          strftime(time + INTERVAL 9 HOUR, '%Y-%m-%d') AS ymd,
          CAST(hour(time + INTERVAL 9 HOUR) AS VARCHAR) AS hh,
          a.retrieval_date, CAST(store_id AS VARCHAR) AS store_id,
          CAST(0 AS INTEGER) AS rows_before
        FROM arrived a CROSS JOIN highest""",
    "bad_rate_documents": f"""{DAMAGED}
        SELECT currency, reason, count(DISTINCT value) AS found FROM (
          SELECT 'EUR' AS currency, 'bad rate' AS reason, taken AS value FROM taken WHERE kind = 1
          UNION ALL
          SELECT c.currency, 'no timestamp', jpy
          FROM taken CROSS JOIN (VALUES ('JPY'), ('EUR'), ('USD')) AS c(currency) WHERE kind = 2
          UNION ALL SELECT NULL, 'unparsable', '{{bad' FROM taken WHERE kind = 3)
        GROUP BY currency, reason""",
    "rates_partly_damaged": f"""{DAMAGED}
        SELECT r.* FROM rates r JOIN taken t ON r.retrieval_date = t.day
        WHERE kind = 0 OR kind = 1 AND currency <> 'EUR'""",
    "rates_map_explode": f"{TO_RATES} SELECT * FROM rates",
    "rates_land_read": f"{TO_RATES} SELECT * FROM rates",
    "sales_rate_join": f"""{TO_RATES} SELECT s.*, r.currency, r.rates
        FROM sales s JOIN rates r
          ON s.retrieval_date = r.retrieval_date AND r.currency = 'JPY'""",
    "sales_unmatched": f"""{TO_RATES} SELECT * FROM sales s WHERE NOT EXISTS (
          SELECT 1 FROM rates r
          WHERE r.retrieval_date = s.retrieval_date AND r.currency = 'JPY')""",
    "sales_jpy": f"""{TO_PRICED}
        SELECT purchase_id, scale, sales, rates, sales_jpy FROM priced""",
    "jst_split": f"""WITH {SALES}
        SELECT purchase_id, time + INTERVAL 9 HOUR AS time_jst,
               strftime(time + INTERVAL 9 HOUR, '%Y-%m-%d') AS ymd,
               CAST(hour(time + INTERVAL 9 HOUR) AS VARCHAR) AS hh,
               CAST(store_id AS VARCHAR) AS store_id
        FROM sales""",
    "sales_mart": f"{TO_MART} SELECT * FROM mart",
    "mart_write_read": f"{TO_MART} SELECT * FROM mart",
    "mart_day_rewrite": f"""{TO_MART} SELECT * REPLACE ('2024-02-01' AS retrieval_date)
        FROM mart WHERE store_name < 'Store K'""",
    "mart_partitions": PARTITIONS,
    "partition_registration": PARTITIONS,
    "sales_hourly": f"""{TO_MART}
        SELECT hh, store_id, {TOTAL} FROM mart GROUP BY ymd, hh, store_id""",
    "sales_hourly_with_day": f"""{TO_MART}
        SELECT ymd, hh, store_id, {TOTAL} FROM mart GROUP BY ymd, hh, store_id""",
    "sales_daily": DAILY,
    "stored_sales_daily": DAILY,
    "stored_sales_daily_of_days": f"""{TO_MART}
        SELECT ymd, store_id, retrieval_date AS day, {TOTAL} FROM mart
        GROUP BY ymd, store_id, retrieval_date""",
    "key_counts": """SELECT event_id, nullif(event_type, 'error') AS event_type,
          count(nullif(event_type, 'error')) OVER (
            PARTITION BY nullif(event_type, 'error')) AS count
        FROM events""",
    "duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "unknown_scales": f"""WITH {SALES} SELECT scale, count(*) AS rows FROM sales
        WHERE scale IS NULL OR scale NOT IN ('yen', 'us_doller') GROUP BY scale""",
    "vt_snapshot": _versions("true"),
    "vt_as_of": _versions("_commit_time <= '20240115'"),
    "vt_incremental": _versions("_commit_time > '20240110' AND _commit_time <= '20240120'"),
    "vt_evolved": _versions("true", "CASE WHEN _commit_time > '20240115' THEN value END"),
    "vt_table": SNAPSHOT,
    "vt_table_as_of": f"WITH {EARLY} SELECT {COMMITTED_COLUMNS} FROM written WHERE place = 1",
    "vt_table_incremental": f"""WITH {EARLY} SELECT {COMMITTED_COLUMNS} FROM written
        WHERE place = 1 AND _commit_time = '20240120000000000'""",
    "vt_table_compacted": SNAPSHOT,
    "latlon_parse": f"""WITH {POINTS}
        SELECT c_custkey, 'lat=' || CAST(lat AS VARCHAR) || '&lon=' || CAST(lon AS VARCHAR) AS latlon,
               lat, lon FROM points""",
    "point_in_box": f"""WITH {POINTS}, {PLACES}, ranked AS (
          SELECT c_custkey, lat, lon, n_nationkey, n_name, row_number() OVER (
            PARTITION BY c_custkey
            ORDER BY (north - south) * (east - west), n_nationkey) AS place
          FROM points LEFT JOIN places ON {INSIDE})
        SELECT c_custkey, lat, lon, n_nationkey, n_name FROM ranked WHERE place = 1""",
    "boxes_around": f"""WITH {POINTS}, {PLACES}
        SELECT c_custkey, lat, lon, n_nationkey FROM points JOIN places ON {INSIDE}""",
    "enrich_points": f"""WITH {POINTS}, asked AS (
          SELECT c_custkey,
                 'lat=' || CAST(lat AS VARCHAR) || '&lon=' || CAST(lon AS VARCHAR) AS latlon,
                 floor(lat) >= -80 AS found, floor(lat) AS south, floor(lon) AS west,
                 CAST((floor(lat) + 90) * 360 + floor(lon) + 180 AS BIGINT) AS place_id
          FROM points)
        SELECT c_custkey, latlon,
               CAST(CASE WHEN found THEN 200 ELSE 404 END AS INTEGER) AS status,
               false AS malformed,
               CASE WHEN found THEN place_id END AS place_id,
               CASE WHEN found THEN 'cell ' || CAST(place_id AS VARCHAR) END AS name,
               CASE WHEN found THEN south END AS south,
               CASE WHEN found THEN south + 1 END AS north,
               CASE WHEN found THEN west END AS west,
               CASE WHEN found THEN west + 1 END AS east
        FROM asked""",
}
