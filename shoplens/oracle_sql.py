"""DuckDB SQL that states each registered query independently of Spark.

The driver runs these against the given tables (pre-registered as views)
and compares row count, schema and an order-insensitive value hash with the
Spark result. Every text starts with the shop-table derivation of
FIXTURES.md §B as CTEs. Aggregates are cast to BIGINT / DOUBLE so the
column types match Spark's.
"""

from __future__ import annotations

from shoplens.params import (ADS_MOD, BATCH_SECONDS, BL_ADS_MOD, BL_BATCH_SECONDS,  # noqa: F401
                             BL_THRESHOLD, END_AGE, END_DATE, NATIVE_BATCH_SECONDS, PAGE_FLOW,
                             SAMPLE_SEED, SLIDE, SLIDE_LATENESS, START_AGE, START_DATE,
                             STREAM_BATCH_SECONDS, STREAM_BL_ADS_MOD, STREAM_BL_THRESHOLD, TASK_ID,
                             THRESHOLD, TOTALS_LATENESS)

# Shop tables over the given ones (FIXTURES.md §B), DuckDB dialect.
SHOP_CTES = """
ev AS (
  SELECT e.*, CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS k,
         strftime(e.ts, '%Y-%m-%d') AS d
  FROM events e
),
user_visit_action AS (
  SELECT d AS date, user_id,
         CAST(user_id AS VARCHAR) || '-' || d AS session_id,
         k % 10 + 1 AS page_id,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS action_time,
         CASE WHEN event_type = 'view' THEN 'kw_' || CAST(k % 6 AS VARCHAR) END AS search_keyword,
         CAST(CASE WHEN event_type IN ('click', 'signup') THEN k % 20 + 1 ELSE -1 END AS BIGINT)
           AS click_category_id,
         CAST(CASE WHEN event_type IN ('click', 'signup') THEN event_id % 100 ELSE -1 END AS BIGINT)
           AS click_product_id,
         CASE WHEN event_type = 'purchase'
              THEN CAST(k % 20 + 1 AS VARCHAR) || ',' || CAST((k + 7) % 20 + 1 AS VARCHAR) END
           AS order_category_ids,
         CASE WHEN event_type = 'purchase'
              THEN CAST(event_id % 100 AS VARCHAR) || ',' || CAST((event_id + 7) % 100 AS VARCHAR) END
           AS order_product_ids,
         CASE WHEN event_type = 'error'
              THEN CAST(k % 20 + 1 AS VARCHAR) || ',' || CAST((k + 11) % 20 + 1 AS VARCHAR) END
           AS pay_category_ids,
         CASE WHEN event_type = 'error' THEN CAST(event_id % 100 AS VARCHAR) END AS pay_product_ids,
         (user_id + k) % 25 AS city_id,
         event_id
  FROM ev
),
user_info AS (
  SELECT c_custkey AS user_id, c_name AS username, c_name AS name,
         CAST(10 + c_custkey % 50 AS INTEGER) AS age, c_mktsegment AS professional,
         CASE WHEN c_custkey % 5 < 3 THEN 'M' ELSE 'F' END AS gender
  FROM customer
),
city_info AS (
  SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
product_info AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS extend_info FROM part
)"""


def with_shop(body_ctes: str, final_select: str) -> str:
    """``WITH <shop tables>, <body_ctes> <final_select>``."""
    ctes = SHOP_CTES + ("," + body_ctes if body_ctes.strip() else "")
    return "WITH " + ctes + "\n" + final_select


# --- Q6 ---------------------------------------------------------------------

_Q6_CTES = """
detail AS (
  SELECT c.area, p.product_id, p.product_name, c.city_name
  FROM user_visit_action v
  JOIN city_info c ON v.city_id = c.city_id
  JOIN product_info p ON p.product_id = v.click_product_id
),
city_counts AS (
  SELECT area, product_id, product_name, city_name, COUNT(*) AS n
  FROM detail GROUP BY area, product_id, product_name, city_name
),
totals AS (
  SELECT area, product_id, product_name, CAST(SUM(n) AS BIGINT) AS clickcount,
         SUM(CASE WHEN city_name IS NOT NULL AND city_name <> '' THEN n END) AS named_total,
         COUNT(CASE WHEN city_name IS NOT NULL AND city_name <> '' THEN 1 END) AS n_cities
  FROM city_counts GROUP BY area, product_id, product_name
),
ranked AS (
  SELECT cc.area, cc.product_id, cc.product_name, cc.city_name, t.n_cities,
         CAST(floor(round(CAST(cc.n AS DOUBLE) / CAST(t.named_total AS DOUBLE) * 1000) / 10) AS DOUBLE)
           AS pct,
         row_number() OVER (PARTITION BY cc.area, cc.product_id, cc.product_name
                            ORDER BY cc.n DESC, cc.city_name) AS rn
  FROM city_counts cc JOIN totals t USING (area, product_id, product_name)
  WHERE cc.city_name IS NOT NULL AND cc.city_name <> ''
),
remarks AS (
  SELECT t.area, t.product_id, t.product_name, t.clickcount,
         COALESCE(string_agg(r.city_name || ':' || CAST(r.pct AS VARCHAR) || '%', ','
                             ORDER BY r.rn), '')
         || CASE WHEN max(t.n_cities) > 2
                 THEN ',其他:' || CAST(100.0 - SUM(r.pct) AS VARCHAR) || '%' ELSE '' END
           AS cityremark
  FROM totals t
  LEFT JOIN ranked r ON r.area = t.area AND r.product_id = t.product_id
       AND r.product_name = t.product_name AND r.rn <= 2
  GROUP BY t.area, t.product_id, t.product_name, t.clickcount
)"""

AREA_PRODUCT_CLICKS = with_shop(_Q6_CTES, """
SELECT area, product_id, product_name, clickcount FROM totals""")

CITY_REMARK = with_shop(_Q6_CTES, """
SELECT area, product_id, product_name, clickcount, cityremark FROM remarks""")

AREA_TOP3_PRODUCT = with_shop(_Q6_CTES, """
SELECT area, product_id, product_name, clickcount, cityremark FROM (
  SELECT *, rank() OVER (PARTITION BY area ORDER BY clickcount DESC) AS rk FROM remarks
) WHERE rk <= 3""")



# --- Q1-Q5 (filtered visit log) ----------------------------------------------


def _filtered_cte(conditions_json: str) -> str:
    return f"""
filtered AS (
  SELECT v.* FROM user_visit_action v JOIN user_info u ON v.user_id = u.user_id
  WHERE v.date >= '{START_DATE}' AND v.date <= '{END_DATE}'
    AND u.age >= {START_AGE} AND u.age <= {END_AGE}
),
kinds AS (
  SELECT *, CASE WHEN search_keyword IS NOT NULL THEN 'search'
                 WHEN click_product_id <> -1 THEN 'click'
                 WHEN order_product_ids IS NOT NULL THEN 'order'
                 WHEN pay_product_ids IS NOT NULL THEN 'pay' END AS kind
  FROM filtered
),
bounds AS (
  SELECT session_id, min(action_time) AS start_time, COUNT(*) AS step_length,
         CAST(round((epoch(strptime(max(action_time), '%Y-%m-%d %H:%M:%S'))
                   - epoch(strptime(min(action_time), '%Y-%m-%d %H:%M:%S'))) * 1000) AS BIGINT)
           AS visit_length
  FROM filtered GROUP BY session_id
),
lists AS (
  SELECT session_id,
    COALESCE(string_agg(CASE WHEN kind = 'search' THEN search_keyword END, ','
                         ORDER BY action_time, event_id), '') AS search_keywords,
    COALESCE(string_agg(CASE WHEN kind = 'click' THEN CAST(click_product_id AS VARCHAR) END, ','
                         ORDER BY action_time, event_id), '') AS click_product_ids,
    COALESCE(string_agg(CASE WHEN kind = 'order' THEN order_product_ids END, ','
                         ORDER BY action_time, event_id), '') AS order_product_ids,
    COALESCE(string_agg(CASE WHEN kind = 'pay' THEN pay_product_ids END, ','
                         ORDER BY action_time, event_id), '') AS pay_product_ids
  FROM kinds GROUP BY session_id
),
summary AS (
  SELECT b.session_id, b.start_time, b.step_length, b.visit_length, l.search_keywords,
         l.click_product_ids, l.order_product_ids, l.pay_product_ids
  FROM bounds b JOIN lists l USING (session_id)
),
quota AS (
  SELECT day_hour, session_count,
         CAST(round(CAST(session_count AS DOUBLE) / CAST(SUM(session_count) OVER () AS DOUBLE)
                    * 1000) AS BIGINT) AS quota
  FROM (SELECT substr(start_time, 1, 13) AS day_hour, COUNT(*) AS session_count
        FROM bounds GROUP BY 1)
),
drawn AS (
  SELECT session_id FROM (
    SELECT b.session_id, q.quota, q.session_count,
           row_number() OVER (PARTITION BY q.day_hour
                              ORDER BY md5(b.session_id || ':' || '{SAMPLE_SEED}')) AS rn
    FROM bounds b JOIN quota q ON substr(b.start_time, 1, 13) = q.day_hour)
  WHERE rn <= least(quota, session_count)
),
cat_items AS (
  SELECT unnest(CASE
           WHEN click_category_id <> -1 THEN [CAST(click_category_id AS VARCHAR)]
           WHEN order_category_ids IS NOT NULL AND length(order_category_ids) > 0 THEN
             CASE WHEN regexp_replace(order_category_ids, ',+$', '') = '' THEN []::VARCHAR[]
                  ELSE string_split(regexp_replace(order_category_ids, ',+$', ''), ',') END
           WHEN pay_category_ids IS NOT NULL AND length(pay_category_ids) > 0 THEN
             CASE WHEN regexp_replace(pay_category_ids, ',+$', '') = '' THEN []::VARCHAR[]
                  ELSE string_split(regexp_replace(pay_category_ids, ',+$', ''), ',') END
         END) AS category_id,
         CASE WHEN click_category_id <> -1 THEN 'click'
              WHEN order_category_ids IS NOT NULL AND length(order_category_ids) > 0 THEN 'order'
              WHEN pay_category_ids IS NOT NULL AND length(pay_category_ids) > 0 THEN 'pay' END
           AS action
  FROM filtered
),
cat_counts AS (
  SELECT category_id,
         COUNT(*) FILTER (WHERE action = 'click') AS click_count,
         COUNT(*) FILTER (WHERE action = 'order') AS order_count,
         COUNT(*) FILTER (WHERE action = 'pay') AS pay_count
  FROM cat_items GROUP BY category_id
),
top10 AS (
  SELECT * FROM cat_counts
  ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10
),
steps AS (
  SELECT * FROM (VALUES {", ".join(f"({a}, {b})" for a, b in zip(PAGE_FLOW[:-1], PAGE_FLOW[1:]))})
    AS s(from_page, to_page)
),
visits AS (
  SELECT page_id AS from_page, COUNT(*) AS visit_count FROM filtered
  WHERE page_id IN ({", ".join(str(p) for p in sorted(set(PAGE_FLOW[:-1])))})
  GROUP BY page_id
),
jumps AS (
  SELECT page_id AS from_page, to_page, COUNT(*) AS jump_count FROM (
    SELECT page_id, lead(page_id) OVER (PARTITION BY session_id ORDER BY action_time, event_id)
             AS to_page
    FROM filtered) p
  WHERE (page_id, to_page) IN (SELECT (from_page, to_page) FROM steps)
  GROUP BY page_id, to_page
)"""


def session_queries(conditions_json: str) -> dict[str, str]:
    f = _filtered_cte(conditions_json)
    pct = ("round(1000.0::DOUBLE * CAST(COUNT(*) FILTER (WHERE {c}) AS DOUBLE) "
           "/ CAST(COUNT(*) AS DOUBLE)) / 10.0")
    return {
        "filter_actions": with_shop(f, "SELECT * FROM filtered"),
        "session_summary": with_shop(f, "SELECT * FROM summary"),
        "session_stat": with_shop(f, f"""
SELECT '{TASK_ID}' AS task_id, '{conditions_json}' AS conditions, COUNT(*) AS session_count,
       {pct.format(c="visit_length > 10000")} AS visit_length_gt_10_ratio,
       {pct.format(c="visit_length <= 10000")} AS visit_length_le_10_ratio,
       {pct.format(c="step_length > 5")} AS step_length_gt_5_ratio,
       {pct.format(c="step_length <= 5")} AS step_length_le_5_ratio
FROM bounds"""),
        "session_quota": with_shop(f, """
SELECT day_hour, session_count, quota, least(quota, session_count) AS taken FROM quota"""),
        "session_sample": with_shop(f, f"""
SELECT '{TASK_ID}' AS task_id, s.* FROM summary s WHERE s.session_id IN (SELECT session_id FROM drawn)"""),
        "category_action_counts": with_shop(f, """
SELECT category_id, action, COUNT(*) AS n FROM cat_items WHERE action IS NOT NULL
GROUP BY category_id, action"""),
        "category_top10": with_shop(f, f"SELECT '{TASK_ID}' AS task_id, * FROM top10"),
        "category_session_top10": with_shop(f, f"""
SELECT '{TASK_ID}' AS task_id, category_id, session_id, click_count FROM (
  SELECT category_id, session_id, click_count,
         row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id) AS rn
  FROM (SELECT CAST(click_category_id AS VARCHAR) AS category_id, session_id,
               COUNT(*) AS click_count
        FROM filtered WHERE CAST(click_category_id AS VARCHAR) IN (SELECT category_id FROM top10)
        GROUP BY 1, 2))
WHERE rn <= 10"""),
        "action_grains": with_shop(f, """
SELECT 'session' AS grain, session_id AS key, CAST(NULL AS VARCHAR) AS action, COUNT(*) AS n,
       min(epoch_ms(CAST(action_time AS TIMESTAMP))) AS first_ms,
       max(epoch_ms(CAST(action_time AS TIMESTAMP))) AS last_ms
FROM filtered GROUP BY session_id
UNION ALL SELECT 'category', category_id, action, COUNT(*), NULL, NULL
FROM cat_items WHERE action IS NOT NULL GROUP BY category_id, action
UNION ALL SELECT 'page', CAST(from_page AS VARCHAR), NULL, visit_count, NULL, NULL FROM visits"""),
        "page_visits": with_shop(f, "SELECT from_page AS page_id, visit_count FROM visits"),
        "page_transitions": with_shop(f, "SELECT from_page, to_page, jump_count FROM jumps"),
        "page_convert_rate": with_shop(f, f"""
SELECT '{TASK_ID}' AS task_id,
       CAST(j.from_page AS VARCHAR) || '-' || CAST(j.to_page AS VARCHAR) AS page_jump,
       round(CAST(j.jump_count * 1000 AS DOUBLE) / CAST(COALESCE(v.visit_count, 1) AS DOUBLE)) / 10.0
         AS rate
FROM jumps j LEFT JOIN visits v USING (from_page)"""),
    }


# --- Q7-Q10 (ad clicks) -------------------------------------------------------


def _ads_ctes(mod: int, batch_seconds: int, threshold: int) -> str:
    return f"""
ads AS (
  SELECT e.event_id, e.user_id, e.k % {mod} + 1 AS ads_id, c.area, c.city_name AS city,
         e.ts, epoch_us(e.ts) // 1000 AS ts_ms, strftime(e.ts, '%Y-%m-%d') AS day,
         (epoch_us(e.ts) // 1000) // {batch_seconds * 1000} AS batch
  FROM ev e JOIN city_info c ON (e.user_id + e.k) % 25 = c.city_id
),
per_batch AS (
  SELECT user_id, ads_id, day, batch, COUNT(*) AS n FROM ads GROUP BY ALL
),
blacklist AS (
  SELECT user_id, min(batch) AS blocked_batch FROM (
    SELECT user_id, batch,
           COALESCE(SUM(n) OVER (PARTITION BY user_id, ads_id, day ORDER BY batch
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM per_batch)
  WHERE before > {threshold}
  GROUP BY user_id
),
kept AS (
  SELECT a.* FROM ads a LEFT JOIN blacklist b USING (user_id)
  WHERE b.blocked_batch IS NULL OR a.batch <= b.blocked_batch
),
totals AS (
  SELECT day, area, city, ads_id, COUNT(*) AS clicks FROM kept GROUP BY ALL
),
area_top AS (
  SELECT * FROM (
    SELECT day, area, ads_id, CAST(SUM(clicks) AS BIGINT) AS clicks,
           CAST(row_number() OVER (PARTITION BY day, area ORDER BY SUM(clicks) DESC, ads_id)
                AS INTEGER) AS rank
    FROM totals GROUP BY day, area, ads_id)
  WHERE rank <= 3
),
last_hour AS (
  SELECT ads_id, date_trunc('minute', ts) AS minute_start, strftime(ts, '%H:%M') AS minute,
         COUNT(*) AS clicks
  FROM kept
  WHERE ts_ms > (SELECT max(ts_ms) FROM kept) - 3600000 AND ts_ms <= (SELECT max(ts_ms) FROM kept)
  GROUP BY ALL
)"""


TOP_JSON_SELECT = """
SELECT day, area,
       '[' || string_agg('{"' || CAST(ads_id AS VARCHAR) || '":' || CAST(clicks AS VARCHAR) || '}',
                         ',' ORDER BY rank) || ']' AS top_ads
FROM area_top GROUP BY day, area"""


LAST_HOUR_SELECT = "SELECT ads_id, minute, clicks FROM last_hour"
LAST_HOUR_JSON_SELECT = """
SELECT ads_id,
       '[' || string_agg('{"' || minute || '":' || CAST(clicks AS VARCHAR) || '}', ','
                         ORDER BY minute_start) || ']' AS minutes
FROM last_hour GROUP BY ads_id"""


def ads_queries() -> dict[str, str]:
    bl = _ads_ctes(BL_ADS_MOD, BL_BATCH_SECONDS, BL_THRESHOLD)
    d = _ads_ctes(ADS_MOD, BATCH_SECONDS, THRESHOLD)
    return {
        "ads_parse": with_shop(d, """
SELECT CAST(split_part(value, ' ', 1) AS BIGINT) AS ts_ms, split_part(value, ' ', 2) AS area,
       split_part(value, ' ', 3) AS city, CAST(split_part(value, ' ', 4) AS BIGINT) AS user_id,
       CAST(split_part(value, ' ', 5) AS BIGINT) AS ads_id
FROM (SELECT concat_ws(' ', CAST(ts_ms AS VARCHAR), replace(area, ' ', '_'),
                       replace(city, ' ', '_'), CAST(user_id AS VARCHAR),
                       CAST(ads_id AS VARCHAR)) AS value FROM ads)"""),
        "ads_parse_bad": with_shop(d, """
SELECT reason, COUNT(*) AS n, COUNT(line) AS n_lines FROM (
  SELECT CASE event_id % 6 WHEN 1 THEN 'fewer than 5 fields' WHEN 2 THEN 'time is not an integer'
              WHEN 3 THEN 'user is not an integer' WHEN 4 THEN 'ad is not an integer'
              WHEN 5 THEN 'null line' END AS reason,
         CASE WHEN event_id % 6 <> 5 THEN 'line' END AS line
  FROM ads)
WHERE reason IS NOT NULL GROUP BY reason"""),
        "ads_daily_totals_blocking": with_shop(bl, "SELECT * FROM totals"),
        "ads_area_top3_blocking": with_shop(bl, "SELECT * FROM area_top"),
        "ads_area_top3_json_blocking": with_shop(bl, TOP_JSON_SELECT),
        "ads_last_hour_blocking": with_shop(bl, LAST_HOUR_SELECT),
        "ads_last_hour_json_blocking": with_shop(bl, LAST_HOUR_JSON_SELECT),
        "ads_blacklist": with_shop(bl, "SELECT user_id, blocked_batch FROM blacklist"),
        "ads_kept_clicks": with_shop(bl, """
SELECT event_id, user_id, ads_id, area, city, day, ts_ms, batch FROM kept"""),
        "ads_daily_totals": with_shop(d, "SELECT * FROM totals"),
        "ads_grains": with_shop(d, """
SELECT day, area, city, ads_id, true AS by_city, clicks FROM totals
UNION ALL SELECT day, area, NULL, ads_id, false, CAST(SUM(clicks) AS BIGINT) FROM totals GROUP BY day, area, ads_id"""),
        "ads_area_top3": with_shop(d, "SELECT * FROM area_top"),
        "ads_area_top3_json": with_shop(d, TOP_JSON_SELECT),
        "ads_last_hour": with_shop(d, LAST_HOUR_SELECT),
        "ads_last_hour_json": with_shop(d, LAST_HOUR_JSON_SELECT),
    }




def stream_queries() -> dict[str, str]:
    # one replayed pipeline for all stream twins (blocks do happen in it)
    bl = d = _ads_ctes(STREAM_BL_ADS_MOD, STREAM_BATCH_SECONDS, STREAM_BL_THRESHOLD)
    return {
        "stream_ads_blacklist": with_shop(bl, f"""
SELECT user_id, strftime(make_timestamp(blocked_batch * {STREAM_BATCH_SECONDS * 1000000}),
                         '%Y-%m-%d') AS blocked_day
FROM blacklist"""),
        "stream_ads_kept_clicks": with_shop(bl, """
SELECT event_id, user_id, ads_id, area, city, day FROM kept"""),
        "stream_state_ads_kept_clicks": with_shop(bl, """
SELECT event_id, user_id, ads_id, area, city, day FROM kept"""),
        "stream_ads_user_counts": with_shop(bl, """
SELECT user_id, ads_id, day, COUNT(*) AS n FROM kept GROUP BY ALL"""),
        "stream_ads_daily_totals": with_shop(d, "SELECT * FROM totals"),
        "stream_ads_area_top3": with_shop(d, "SELECT * FROM area_top"),
        "stream_ads_area_top3_json": with_shop(d, TOP_JSON_SELECT),
        "stream_ads_last_hour": with_shop(d, LAST_HOUR_SELECT),
        "stream_ads_last_hour_json": with_shop(d, LAST_HOUR_JSON_SELECT),
    }


def native_queries() -> dict[str, str]:
    n = _ads_ctes(STREAM_BL_ADS_MOD, NATIVE_BATCH_SECONDS, STREAM_BL_THRESHOLD)
    return {
        "stream_native_blacklist": with_shop(n, """
SELECT b.user_id, max(a.day) AS blocked_day
FROM blacklist b JOIN ads a ON a.user_id = b.user_id AND a.batch = b.blocked_batch GROUP BY b.user_id"""),
        "stream_native_kept_clicks": with_shop(n, """
SELECT event_id, user_id, ads_id, area, city, day FROM kept"""),
        "stream_native_user_counts": with_shop(n, """
SELECT user_id, ads_id, day, COUNT(*) AS n FROM kept GROUP BY ALL"""),
        "stream_native_daily_totals": with_shop(n, "SELECT * FROM totals"),
        "stream_native_open_totals": with_shop(n, f"""
SELECT * FROM totals
WHERE CAST(day AS DATE) + INTERVAL 1 DAY > (SELECT max(ts) FROM kept) - INTERVAL '{TOTALS_LATENESS}'"""),
        "stream_native_area_top3": with_shop(n, "SELECT * FROM area_top"),
        "stream_native_sliding_hour": with_shop(n, f"""
SELECT ads_id, slide_ms, strftime(make_timestamp(minute_ms * 1000), '%H:%M') AS minute, SUM(n)::BIGINT AS clicks
FROM (SELECT ads_id, minute_ms, n, unnest(range(
               (minute_ms + 60000 + step - 1) // step * step, minute_ms + 3600000 + 1, step)) AS slide_ms, over_ms
      FROM (SELECT ads_id, ts_ms // 60000 * 60000 AS minute_ms, COUNT(*) AS n,
                   CAST(epoch(INTERVAL '{SLIDE}') * 1000 AS BIGINT) AS step,
                   (SELECT epoch_ms(max(ts) - INTERVAL '{SLIDE_LATENESS}') FROM kept) AS over_ms
            FROM kept GROUP BY ALL))
WHERE slide_ms <= over_ms GROUP BY ads_id, slide_ms, minute_ms"""),
    }


def build_oracle(conditions_json: str) -> dict[str, str]:
    out = {
        "area_product_clicks": AREA_PRODUCT_CLICKS,
        "city_remark": CITY_REMARK,
        "area_top3_product": AREA_TOP3_PRODUCT,
        "area_top3_product_sql": AREA_TOP3_PRODUCT,
    }
    out.update(session_queries(conditions_json))
    out["table_overwrite"] = out["filter_actions"]
    out["session_sample_buckets"] = out["session_sample"]
    out.update(ads_queries())
    out["ads_kept_clicks_filtered"] = out["ads_kept_clicks"]
    out.update(stream_queries())
    out.update(native_queries())
    out["stream_lines_ads_parse"] = out["ads_parse"]
    return out
