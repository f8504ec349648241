"""DuckDB oracle SQL for every registered query.

Each text runs on DuckDB against the raw fixture views (``events``,
``customer``, ``part``, ``nation``, ``region``).  The shared prefix below maps
those tables onto the shop schema (the adapter in FIXTURES.md) and applies the
default conditions from ``shoplens.params``; each query body then states the
same semantics the Spark operators implement, in plain SQL.

Rounding is written in the operation order the Spark side uses
(``floor(a / b * 1000 + 0.5) / 10``) so that doubles agree bit for bit.
"""

from __future__ import annotations

from shoplens.params import DEFAULT_CONDITIONS, Conditions
from shoplens.plans.replay import STRETCH_DAYS


def _adapter(c: Conditions) -> str:
    """Fixture tables -> shop tables, plus the Q0 filtered actions."""
    where = []
    if c.start_date:
        where.append(f"v.date >= '{c.start_date}'")
    if c.end_date:
        where.append(f"v.date <= '{c.end_date}'")
    if c.start_age is not None:
        where.append(f"u.age >= {int(c.start_age)}")
    if c.end_age is not None:
        where.append(f"u.age <= {int(c.end_age)}")
    cond = " AND ".join(where) if where else "TRUE"
    return f"""
WITH e AS (SELECT event_id, ts, user_id, event_type, cast(props->>'k' AS int) AS k FROM events),
user_visit_action AS (
  SELECT event_id,
    strftime(ts, '%Y-%m-%d') AS date, user_id,
    cast(user_id AS varchar) || '-' || strftime(ts, '%Y-%m-%d') AS session_id,
    cast(k % 10 + 1 AS bigint) AS page_id,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS action_time,
    CASE WHEN event_type = 'view' THEN 'kw' || cast(k % 6 AS varchar) END AS search_keyword,
    cast(CASE WHEN event_type IN ('click','error') THEN k % 20 + 1 ELSE -1 END AS bigint) AS click_category_id,
    cast(CASE WHEN event_type IN ('click','error') THEN k + 1 ELSE -1 END AS bigint) AS click_product_id,
    CASE WHEN event_type = 'signup' THEN cast(k % 20 + 1 AS varchar) || ',' || cast((k + 3) % 20 + 1 AS varchar) END AS order_category_ids,
    CASE WHEN event_type = 'signup' THEN cast(k + 1 AS varchar) || ',' || cast((k + 7) % 100 + 1 AS varchar) END AS order_product_ids,
    CASE WHEN event_type = 'purchase' THEN cast(k % 20 + 1 AS varchar) END AS pay_category_ids,
    CASE WHEN event_type = 'purchase' THEN cast(k + 1 AS varchar) END AS pay_product_ids,
    user_id % 25 AS city_id
  FROM e),
user_info AS (
  SELECT c_custkey AS user_id, c_name AS username, c_name AS name,
    cast(10 + c_custkey % 50 AS int) AS age, c_mktsegment AS professional,
    CASE WHEN c_custkey % 5 < 3 THEN 'M' ELSE 'F' END AS gender
  FROM customer),
city_info AS (
  SELECT cast(n_nationkey AS bigint) AS city_id, n_name AS city_name, r_name AS area
  FROM nation JOIN region ON n_regionkey = r_regionkey),
product_info AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS extend_info FROM part),
ads_click AS (
  SELECT e.event_id, e.ts, c.area, c.city_name AS city, cast(e.user_id AS varchar) AS user_id, cast(e.k % 6 + 1 AS varchar) AS ads_id
  FROM e JOIN city_info c ON e.user_id % 25 = c.city_id),
actions AS (
  SELECT v.* FROM user_visit_action v JOIN user_info u ON v.user_id = u.user_id
  WHERE {cond})"""


def _split_ids(expr: str) -> str:
    # Comma list -> ids: trailing empty parts dropped, a text of only commas
    # gives no id, an empty text gives one empty id.
    return (f"CASE WHEN regexp_full_match({expr}, ',+') THEN []::varchar[] "
            f"ELSE string_split(regexp_replace({expr}, ',+$', ''), ',') END")


_PROFILE = """
profile AS (
  SELECT session_id,
    min(action_time) AS start_time,
    count(*) AS step_length,
    (epoch_ms(strptime(max(action_time), '%Y-%m-%d %H:%M:%S'))
      - epoch_ms(strptime(min(action_time), '%Y-%m-%d %H:%M:%S'))) AS visit_length,
    coalesce(string_agg(search_keyword, ',' ORDER BY action_time, event_id), '') AS search_keywords,
    coalesce(string_agg(CASE WHEN click_product_id <> -1 THEN cast(click_product_id AS varchar) END,
                        ',' ORDER BY action_time, event_id), '') AS click_product_ids,
    coalesce(string_agg(order_product_ids, ',' ORDER BY action_time, event_id), '') AS order_product_ids,
    coalesce(string_agg(pay_product_ids, ',' ORDER BY action_time, event_id), '') AS pay_product_ids
  FROM actions GROUP BY session_id)"""

_PROFILE_COLS = ("session_id, start_time, step_length, visit_length, search_keywords, "
                 "click_product_ids, order_product_ids, pay_product_ids")


def _quota(c: Conditions) -> str:
    return f"""
hours AS (SELECT substr(start_time, 1, 13) AS day_hour, count(*) AS sessions FROM profile GROUP BY 1),
quota AS (
  SELECT day_hour, sessions,
    least(cast(floor(sessions / (SELECT sum(sessions) FROM hours) * {int(c.sample_size)} + 0.5) AS bigint),
          sessions) AS quota
  FROM hours)"""


def _category_top(c: Conditions) -> str:
    return f"""
cat_events AS (
  SELECT cast(click_category_id AS varchar) AS category_id, 'click' AS kind
    FROM actions WHERE click_category_id <> -1
  UNION ALL
  SELECT unnest({_split_ids('order_category_ids')}) AS category_id, 'order' AS kind
    FROM actions WHERE click_category_id = -1 AND order_category_ids IS NOT NULL
  UNION ALL
  SELECT unnest({_split_ids('pay_category_ids')}) AS category_id, 'pay' AS kind
    FROM actions WHERE click_category_id = -1 AND order_category_ids IS NULL AND pay_category_ids IS NOT NULL),
top_categories AS (
  SELECT category_id,
    cast(count_if(kind = 'click') AS bigint) AS click_count,
    cast(count_if(kind = 'order') AS bigint) AS order_count,
    cast(count_if(kind = 'pay') AS bigint) AS pay_count
  FROM cat_events GROUP BY category_id
  ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id
  LIMIT {int(c.top_categories)})"""


def _city_share(c: Conditions) -> str:
    other = c.other_label.replace("'", "''")
    return f"""
area_clicks AS (
  SELECT ci.area, v.click_product_id AS product_id, ci.city_name, count(*) AS n
  FROM user_visit_action v JOIN city_info ci ON v.city_id = ci.city_id
  WHERE v.click_product_id > 0
  GROUP BY ci.area, v.click_product_id, ci.city_name),
ranked_cities AS (
  SELECT area, product_id, city_name, n,
    cast(sum(n) OVER (PARTITION BY area, product_id) AS bigint) AS cnt,
    count(*) OVER (PARTITION BY area, product_id) AS n_cities,
    row_number() OVER (PARTITION BY area, product_id ORDER BY n DESC, city_name) AS r
  FROM area_clicks),
top_cities AS (
  SELECT area, product_id, any_value(cnt) AS cnt, any_value(n_cities) AS n_cities,
    max(CASE WHEN r = 1 THEN city_name END) AS city1,
    max(CASE WHEN r = 1 THEN floor(n / cnt * 1000 + 0.5) / 10.0::DOUBLE END) AS ratio1,
    max(CASE WHEN r = 2 THEN city_name END) AS city2,
    max(CASE WHEN r = 2 THEN floor(n / cnt * 1000 + 0.5) / 10.0::DOUBLE END) AS ratio2
  FROM ranked_cities WHERE r <= 2 GROUP BY area, product_id),
city_share AS (
  SELECT area, product_id, cnt,
    city1 || ':' || cast(ratio1 AS varchar)
    || CASE WHEN city2 IS NOT NULL THEN ',' || city2 || ':' || cast(ratio2 AS varchar) ELSE '' END
    || CASE WHEN n_cities > 2
         THEN ',{other}:' || cast(floor((100.0::DOUBLE - ratio1 - ratio2) * 10 + 0.5) / 10.0::DOUBLE AS varchar)
         ELSE '' END AS remark
  FROM top_cities)"""


def _clean_clicks(c: Conditions) -> str:
    return f"""
click_days AS (
  SELECT event_id, ts, area, city, user_id, ads_id, strftime(ts, '%Y-%m-%d') AS day,
    row_number() OVER (PARTITION BY user_id, ads_id, strftime(ts, '%Y-%m-%d') ORDER BY ts, event_id) AS nth
  FROM ads_click),
cutoff AS (
  SELECT user_id, ts AS cut_ts, event_id AS cut_id FROM (
    SELECT user_id, ts, event_id,
      row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS first_hit
    FROM click_days WHERE nth = {int(c.blacklist_limit)}) WHERE first_hit = 1),
clean AS (
  SELECT a.event_id, a.ts, a.area, a.city, a.user_id, a.ads_id
  FROM ads_click a LEFT JOIN cutoff x ON a.user_id = x.user_id
  WHERE x.user_id IS NULL OR a.ts < x.cut_ts OR (a.ts = x.cut_ts AND a.event_id <= x.cut_id)),
ads_day AS (
  SELECT strftime(ts, '%Y-%m-%d') AS day, area, city, ads_id, count(*) AS n
  FROM clean GROUP BY 1, 2, 3, 4)"""


def oracle_queries(c: Conditions = DEFAULT_CONDITIONS) -> dict[str, str]:
    head = _adapter(c)
    flow = list(c.page_flow or ())
    pre_pages = ", ".join(str(int(p)) for p in flow[:-1]) or "NULL"
    pairs = ", ".join(f"({int(a)}, {int(b)})" for a, b in zip(flow, flow[1:])) or "(NULL, NULL)"
    out: dict[str, str] = {}

    out["q0_filtered_actions"] = head + "\nSELECT * FROM actions"

    out["q1_session_lengths"] = head + "," + _PROFILE + """
SELECT session_id, step_length, start_time, visit_length FROM profile"""

    out["q1_session_stats"] = head + "," + _PROFILE + f"""
SELECT count(*) AS session_count,
  coalesce(floor(cast(count_if(visit_length <= {int(c.visit_length_ms)}) AS bigint) / count(*) * 1000 + 0.5) / 10.0::DOUBLE, 0.0::DOUBLE) AS visit_length_le_ratio,
  coalesce(floor(cast(count_if(visit_length > {int(c.visit_length_ms)}) AS bigint) / count(*) * 1000 + 0.5) / 10.0::DOUBLE, 0.0::DOUBLE) AS visit_length_gt_ratio,
  coalesce(floor(cast(count_if(step_length <= {int(c.step_length)}) AS bigint) / count(*) * 1000 + 0.5) / 10.0::DOUBLE, 0.0::DOUBLE) AS step_length_le_ratio,
  coalesce(floor(cast(count_if(step_length > {int(c.step_length)}) AS bigint) / count(*) * 1000 + 0.5) / 10.0::DOUBLE, 0.0::DOUBLE) AS step_length_gt_ratio
FROM profile"""

    out["q2_session_profile"] = head + "," + _PROFILE + f"\nSELECT {_PROFILE_COLS} FROM profile"

    out["q2_hourly_quota"] = head + "," + _PROFILE + "," + _quota(c) + "\nSELECT day_hour, sessions, quota FROM quota"

    out["q2_session_sample"] = head + "," + _PROFILE + "," + _quota(c) + f"""
SELECT {_PROFILE_COLS} FROM (
  SELECT p.*, q.quota,
    row_number() OVER (PARTITION BY substr(p.start_time, 1, 13)
                       ORDER BY md5(p.session_id || '-' || '{c.sample_seed}'), p.session_id) AS pick
  FROM profile p JOIN quota q ON substr(p.start_time, 1, 13) = q.day_hour)
WHERE pick <= quota"""

    out["q3_category_top10"] = head + "," + _category_top(c) + """
SELECT category_id, click_count, order_count, pay_count FROM top_categories"""

    out["q4_category_top_sessions"] = head + "," + _category_top(c) + f""",
cat_sessions AS (
  SELECT cast(click_category_id AS varchar) AS category_id, session_id, count(*) AS click_count
  FROM actions
  WHERE cast(click_category_id AS varchar) IN (SELECT category_id FROM top_categories)
  GROUP BY 1, 2)
SELECT category_id, session_id, click_count FROM (
  SELECT *, row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id) AS r
  FROM cat_sessions) WHERE r <= {int(c.top_sessions)}"""

    def conversion(session: str) -> str:
        return f""",
visits AS (SELECT page_id, count(*) AS visits FROM actions WHERE page_id IN ({pre_pages}) GROUP BY page_id),
steps AS (
  SELECT page_id AS pre_page,
    lead(page_id) OVER (PARTITION BY {session} ORDER BY action_time, event_id) AS post_page
  FROM actions),
targets AS (SELECT * FROM (VALUES {pairs}) AS t(a, b)),
jumps AS (
  SELECT pre_page, post_page, count(*) AS jumps
  FROM steps JOIN targets ON pre_page = a AND post_page = b
  GROUP BY pre_page, post_page)
SELECT cast(pre_page AS varchar) || '-' || cast(post_page AS varchar) AS page_jump,
  floor(jumps / visits * 1000 + 0.5) / 10.0::DOUBLE AS rate
FROM jumps JOIN visits ON pre_page = page_id"""

    out["q5_page_conversion"] = head + conversion("session_id")
    out["q5_conversion_from_days"] = head + conversion("user_id")

    out["q1_lengths_from_days"] = head + """
SELECT cast(user_id AS varchar) AS session_id, count(*) AS step_length, min(action_time) AS start_time,
  epoch_ms(strptime(max(action_time), '%Y-%m-%d %H:%M:%S')) - epoch_ms(strptime(min(action_time), '%Y-%m-%d %H:%M:%S')) AS visit_length
FROM actions GROUP BY user_id"""

    out["q5_page_pairs"] = head + """,
steps AS (
  SELECT page_id AS pre_page,
    lead(page_id) OVER (PARTITION BY session_id ORDER BY action_time, event_id) AS post_page,
    row_number() OVER (PARTITION BY session_id ORDER BY action_time DESC, event_id DESC) AS from_end
  FROM actions)
SELECT pre_page, post_page, count(*) AS n FROM steps WHERE from_end > 1 GROUP BY pre_page, post_page"""

    out["q6_area_top3_products"] = head + "," + _city_share(c) + f"""
SELECT t.area, p.product_name, t.cnt, t.rk, t.remark FROM (
  SELECT area, product_id, cnt, remark,
    cast(rank() OVER (PARTITION BY area ORDER BY cnt DESC) AS int) AS rk
  FROM city_share) t
JOIN product_info p ON t.product_id = p.product_id
WHERE t.rk <= {int(c.top_products)}"""

    out["q6_city_share"] = head + "," + _city_share(c) + """
SELECT area, product_id, remark FROM city_share"""

    out["q4_top_sessions_one_scan"] = out["q4_category_top_sessions"]
    out["q3_top10_from_days"] = out["q3_category_top10"]
    out["q6_share_from_days"] = out["q6_city_share"]

    out["q7_blacklist"] = head + f"""
SELECT DISTINCT user_id FROM ads_click
GROUP BY user_id, ads_id, strftime(ts, '%Y-%m-%d')
HAVING count(*) >= {int(c.blacklist_limit)}"""

    out["q7_clean_clicks"] = head + "," + _clean_clicks(c) + """
SELECT event_id, ts, area, city, user_id, ads_id FROM clean"""

    out["q7_unbanned_clicks"] = head + f""",
banned AS (
  SELECT user_id FROM ads_click GROUP BY user_id, ads_id, strftime(ts, '%Y-%m-%d') HAVING count(*) >= {int(c.blacklist_limit)})
SELECT event_id, ts, area, city, user_id, ads_id FROM ads_click WHERE user_id NOT IN (SELECT user_id FROM banned)"""

    out["q8_ads_per_day"] = head + "," + _clean_clicks(c) + """
SELECT day, area, city, ads_id, n FROM ads_day"""

    out["q9_area_top3_ads"] = head + "," + _clean_clicks(c) + f""",
area_ads AS (SELECT day, area, ads_id, cast(sum(n) AS bigint) AS n FROM ads_day GROUP BY day, area, ads_id)
SELECT day, area, ads_id, n, rn FROM (
  SELECT *, cast(row_number() OVER (PARTITION BY day, area ORDER BY n DESC, ads_id) AS int) AS rn
  FROM area_ads) WHERE rn <= {int(c.top_ads)}"""

    out["q9_area_top3_ads_json"] = head + "," + _clean_clicks(c) + f""",
area_ads AS (SELECT day, area, ads_id, cast(sum(n) AS bigint) AS n FROM ads_day GROUP BY day, area, ads_id),
top AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY day, area ORDER BY n DESC, ads_id) AS rn
    FROM area_ads) WHERE rn <= {int(c.top_ads)})
SELECT day, area,
  '[' || string_agg('{{"' || cast(ads_id AS varchar) || '":' || cast(n AS varchar) || '}}', ',' ORDER BY rn) || ']' AS ads_json
FROM top GROUP BY day, area"""

    out["q10_minute_counts"] = head + "," + _clean_clicks(c) + """
SELECT ads_id, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M') AS minute, count(*) AS n FROM clean GROUP BY 1, 2"""

    out["q_ad_lines_parsed"] = head + """,
l AS (
  SELECT event_id, event_id % 16 AS k, cast(epoch_us(ts) // 1000 AS varchar) AS ms, replace(area, ' ', '_') AS a,
    replace(city, ' ', '_') AS c, user_id AS u, ads_id AS d FROM ads_click),
f AS (
  SELECT event_id, k,
    CASE k WHEN 1 THEN 'x' WHEN 2 THEN '9223372036854775807' WHEN 3 THEN '92233720368547758079' WHEN 4 THEN '253402300800000'
      WHEN 5 THEN '+' || ms ELSE ms END AS t,
    CASE k WHEN 10 THEN '' ELSE a END AS a, c,
    CASE k WHEN 6 THEN 'u' || u WHEN 7 THEN '00' || u ELSE u END AS u,
    CASE k WHEN 8 THEN '9999999999' WHEN 9 THEN 'ad-' || d ELSE d END AS d,
    CASE k WHEN 11 THEN ' sixth field' WHEN 12 THEN '   ' ELSE '' END AS tail
  FROM l),
v AS (
  SELECT event_id, CASE WHEN k = 0 THEN t || ' ' || a || ' ' || c || ' ' || u ELSE t || ' ' || a || ' ' || c || ' ' || u || ' ' || d || tail END AS value FROM f),
p AS (SELECT event_id, value, string_split(rtrim(value, ' '), ' ') AS p FROM v),
n AS (SELECT *, CASE WHEN regexp_full_match(p[1], '[+-]?[0-9]+') THEN try_cast(p[1] AS bigint) END AS ms FROM p),
r AS (
  SELECT *, CASE WHEN len(p) < 5 THEN 'fewer than 5 fields' WHEN NOT regexp_full_match(p[1], '[+-]?[0-9]+') THEN 'bad ts'
    WHEN ms IS NULL OR ms NOT BETWEEN -62135596800000 AND 253402300799999 THEN 'ts out of range' END AS reason FROM n)
SELECT event_id, value, CASE WHEN reason IS NULL THEN ms END AS ts_ms, p[2] AS area, p[3] AS city, p[4] AS user_id,
  CASE WHEN len(p) >= 5 THEN p[5] END AS ads_id, reason FROM r"""

    last_hour = f""",
minutes AS (SELECT ads_id, date_trunc('minute', ts) AS m FROM clean),
recent AS (
  SELECT ads_id, m FROM minutes
  WHERE m > (SELECT max(m) FROM minutes) - INTERVAL {int(c.window_minutes)} MINUTE),
per_minute AS (SELECT ads_id, m, count(*) AS n FROM recent GROUP BY ads_id, m)"""

    length, slide = f"INTERVAL {int(c.window_minutes)} MINUTE", f"INTERVAL {int(c.slide_seconds)} SECOND"
    out["q10_sliding_hour"] = head + "," + _clean_clicks(c) + f""",
ends AS (SELECT DISTINCT ads_id, time_bucket({slide}, ts) + {slide} AS e FROM clean),
changes AS (SELECT ads_id, e AS t FROM ends UNION SELECT ads_id, e + {length} FROM ends)
SELECT c.ads_id, strftime(c.t, '%Y-%m-%d %H:%M:%S') AS window_end, count(k.ads_id) AS n
FROM changes c LEFT JOIN clean k ON k.ads_id = c.ads_id AND k.ts >= c.t - {length} AND k.ts < c.t
GROUP BY c.ads_id, c.t"""

    out["q10_last_hour"] = head + "," + _clean_clicks(c) + last_hour + """
SELECT ads_id, strftime(m, '%Y-%m-%d %H:%M') AS minute, n FROM per_minute"""

    out["q10_last_hour_json"] = head + "," + _clean_clicks(c) + last_hour + """
SELECT ads_id,
  '[' || string_agg('{"' || strftime(m, '%H:%M') || '":' || cast(n AS varchar) || '}', ',' ORDER BY m) || ']' AS minutes_json
FROM per_minute GROUP BY ads_id"""

    # The stream: clicks come in stretches of whole days of the month; the stretch in
    # which a user reaches the limit passes, later ones don't.
    stream = head + f""",
lines AS (
  SELECT ts, replace(area, ' ', '_') AS area, replace(city, ' ', '_') AS city, user_id, ads_id,
    strftime(ts, '%Y-%m-%d') AS day, (day(ts) - 1) // {STRETCH_DAYS} AS b FROM ads_click),
bans AS (
  SELECT user_id, min(b) AS b FROM (
    SELECT user_id, ads_id, day, b FROM lines GROUP BY user_id, ads_id, day, b HAVING count(*) >= {int(c.blacklist_limit)})
  GROUP BY user_id),
clean AS (SELECT l.* FROM lines l LEFT JOIN bans USING (user_id) WHERE bans.b IS NULL OR l.b <= bans.b),
totals AS (SELECT day, area, city, ads_id, count(*) AS n FROM clean GROUP BY day, area, city, ads_id)"""
    out["q7_stream_blacklist"] = stream + " SELECT user_id FROM bans"
    out["q7_stream_clean_clicks"] = stream + " SELECT epoch_us(ts) // 1000 AS ts_ms, area, city, user_id, ads_id FROM clean"
    out["q8_stream_ads_per_day"] = stream + " SELECT day, area, city, ads_id, n FROM totals"
    out["q9_stream_top3_ads"] = stream + f""",
area_ads AS (SELECT day, area, ads_id, sum(n)::BIGINT AS n FROM totals GROUP BY day, area, ads_id)
SELECT day, area, ads_id, n, rn FROM (
  SELECT *, row_number() OVER (PARTITION BY day, area ORDER BY n DESC, ads_id)::INT AS rn FROM area_ads) WHERE rn <= {int(c.top_ads)}"""
    out["q10_stream_last_hour"] = stream + last_hour + """
SELECT ads_id, strftime(m, '%Y-%m-%d %H:%M') AS minute, n FROM per_minute"""
    return out
