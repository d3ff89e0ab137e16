"""Independent DuckDB SQL for every registered query.

The driver registers the raw parquet tables as views; the derived views of the
data model (FIXTURES.md §3) are restated here as CTEs so every oracle query is
self-contained ANSI-ish SQL.  Integer sums are cast to BIGINT (DuckDB widens
them to HUGEINT), ratios use the exact integer half-up rule.
"""

from __future__ import annotations

# Fixed values of the fixture (FIXTURES.md §3), written out so that a wrong constant in the library shows.
EPOCH_2024 = 1704067200
SEARCH_KEYWORDS = ["火锅", "蛋糕", "重庆辣子鸡", "重庆小面", "呷哺呷哺", "新辣道鱼火锅", "国贸大厦", "太古商场", "日本料理", "温泉"]
SESSION_WINDOWS = [86400, 259200, 864000, 2592000]
SESSION_SPANS = [2, 5, 8, 20, 50, 150, 500, 1500, 5000, 40000]


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


FIXTURE_CTES = f"""
_ev AS (
  SELECT event_id, user_id, event_type, ts,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         epoch_us(ts) // 1000000 - {EPOCH_2024} AS o,
         {_list(SESSION_WINDOWS)}[user_id % 4 + 1] AS win,
         {_list(SESSION_SPANS)}[user_id % 10 + 1] AS span
  FROM events),
_ev2 AS (
  SELECT *, o // win AS sn,
         {EPOCH_2024} + (o // win) * win + (user_id % 23) * 3600 + ((o % win) * span) // win AS a
  FROM _ev),
visits AS (
  SELECT event_id AS action_id,
         strftime(make_timestamp(a * 1000000), '%Y-%m-%d') AS date,
         user_id,
         CAST(user_id AS VARCHAR) || '-' || CAST(sn AS VARCHAR) AS session_id,
         k % 10 AS page_id,
         strftime(make_timestamp(a * 1000000), '%Y-%m-%d %H:%M:%S') AS action_time,
         CASE WHEN event_type = 'signup' THEN {_list(SEARCH_KEYWORDS)}[k % 10 + 1] END AS search_keyword,
         CASE WHEN event_type = 'click' THEN k % 20 END AS click_category_id,
         CASE WHEN event_type = 'click' THEN k END AS click_product_id,
         CASE WHEN event_type = 'purchase' THEN CAST(k % 20 AS VARCHAR)
              || CASE WHEN k % 2 = 0 THEN ',' || CAST((k + 7) % 20 AS VARCHAR) ELSE '' END END
           AS order_category_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(k AS VARCHAR) END AS order_product_ids,
         CASE WHEN event_type = 'error' THEN CAST(k % 20 AS VARCHAR) END AS pay_category_ids,
         CASE WHEN event_type = 'error' THEN CAST(k AS VARCHAR) END AS pay_product_ids,
         (user_id * 3 + k) % 25 AS city_id
  FROM _ev2),
users AS (
  SELECT c_custkey AS user_id, 'user' || CAST(c_custkey AS VARCHAR) AS username, c_name AS name,
         CAST((c_custkey * 7) % 60 AS INTEGER) AS age, c_mktsegment AS professional,
         'city' || CAST(c_nationkey AS VARCHAR) AS city,
         CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer),
products AS (
  SELECT p_partkey AS product_id, p_name AS product_name,
         '{{"product_status": ' || CAST(p_size % 2 AS VARCHAR) || '}}' AS extend_info
  FROM part),
cities AS (
  SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
  FROM nation JOIN region ON n_regionkey = r_regionkey),
ad_clicks AS (
  SELECT epoch_us(ts) // 1000 AS ts_ms, strftime(ts, '%Y-%m-%d') AS date,
         'P' || CAST(n_regionkey AS VARCHAR) AS province, n_name AS city,
         user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS ad_id
  FROM events JOIN nation ON n_nationkey = user_id % 25)
"""


def with_fixtures(body: str) -> str:
    """Prefix the fixture CTEs; ``body`` may start with its own ``name AS (...)``
    CTE list (without WITH) followed by the final SELECT."""
    body = body.strip()
    if body.upper().startswith("SELECT"):
        return f"WITH {FIXTURE_CTES}\n{body}"
    return f"WITH {FIXTURE_CTES},\n{body}"


# ---------------------------------------------------------------- shared fragments

def session_agg_sql(src: str = "visits") -> str:
    return f"""
SELECT session_id, min(user_id) AS user_id,
       coalesce(array_to_string(list_sort(list_distinct(list(
           CASE WHEN search_keyword <> '' THEN search_keyword END))), ','), '') AS search_keywords,
       coalesce(array_to_string(list_sort(list_distinct(list(click_category_id))), ','), '')
           AS click_category_ids,
       date_diff('second', min(CAST(action_time AS TIMESTAMP)), max(CAST(action_time AS TIMESTAMP)))
           AS visit_length,
       count(*) AS step_length,
       min(action_time) AS start_time
FROM {src} GROUP BY session_id"""


def full_info_sql(src: str = "visits") -> str:
    return f"""
SELECT s.session_id, s.user_id, s.search_keywords, s.click_category_ids, s.visit_length,
       s.step_length, s.start_time, u.age, u.professional, u.city, u.sex
FROM ({session_agg_sql(src)}) s JOIN users u ON s.user_id = u.user_id"""


def ratio_sql(n: str, d: str) -> str:
    return f"CASE WHEN {d} <> 0 THEN CAST(({n} * 200 + {d}) // (2 * {d}) AS DOUBLE) / 100 END"


VISIT_BUCKETS_SQL = [("1s_3s", "BETWEEN 1 AND 3"), ("4s_6s", "BETWEEN 4 AND 6"), ("7s_9s", "BETWEEN 7 AND 9"),
                     ("10s_30s", "BETWEEN 10 AND 30"), ("30s_60s", "> 30 AND visit_length <= 60"),
                     ("1m_3m", "> 60 AND visit_length <= 180"), ("3m_10m", "> 180 AND visit_length <= 600"),
                     ("10m_30m", "> 600 AND visit_length <= 1800"), ("30m", "> 1800")]
STEP_BUCKETS_SQL = [("1_3", "BETWEEN 1 AND 3"), ("4_6", "BETWEEN 4 AND 6"), ("7_9", "BETWEEN 7 AND 9"),
                    ("10_30", "BETWEEN 10 AND 30"), ("30_60", "> 30 AND step_length <= 60"), ("60", "> 60")]


def aggr_counts_sql(src: str) -> str:
    cols = ["count(*) AS session_count"]
    cols += [f"count(*) FILTER (WHERE visit_length {c}) AS visit_length_{n}" for n, c in VISIT_BUCKETS_SQL]
    cols += [f"count(*) FILTER (WHERE step_length {c}) AS step_length_{n}" for n, c in STEP_BUCKETS_SQL]
    return f"SELECT {', '.join(cols)} FROM ({src}) x"


def aggr_stat_sql(src: str) -> str:
    cols = ["session_count"]
    cols += [f"{ratio_sql('visit_length_' + n, 'session_count')} AS visit_length_{n}_ratio" for n, _ in VISIT_BUCKETS_SQL]
    cols += [f"{ratio_sql('step_length_' + n, 'session_count')} AS step_length_{n}_ratio" for n, _ in STEP_BUCKETS_SQL]
    return f"SELECT {', '.join(cols)} FROM ({aggr_counts_sql(src)}) c"


# ---------------------------------------------------------------- oracle per key

def _kw(words: str) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words.split(",")) + "]"


def _sessions_filtered(date_lo, date_hi, extra_where: str) -> str:
    src = f"(SELECT * FROM visits WHERE date BETWEEN '{date_lo}' AND '{date_hi}')"
    return f"SELECT * FROM ({full_info_sql(src)}) f WHERE {extra_where}"


def _session_oracles() -> dict[str, str]:
    o = {}
    o["action_date_range"] = "SELECT * FROM visits WHERE date BETWEEN '2024-01-05' AND '2024-01-25'"
    o["session_agg"] = session_agg_sql("visits")
    o["session_full_info"] = full_info_sql("visits")
    o["filter_between"] = f"SELECT * FROM ({full_info_sql()}) f WHERE age BETWEEN 10 AND 50"
    o["filter_in"] = (f"SELECT * FROM ({full_info_sql()}) f WHERE professional IN ('BUILDING', 'MACHINERY') "
                      f"AND list_has_any(string_split(click_category_ids, ','), ['1', '11', '15'])")
    o["filter_equal"] = f"SELECT * FROM ({full_info_sql()}) f WHERE sex = 'female'"
    o["session_filter"] = _sessions_filtered(
        "2024-01-03", "2024-01-28",
        "age BETWEEN 10 AND 50 AND professional IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') "
        f"AND sex = 'male' AND list_has_any(string_split(search_keywords, ','), {_kw('火锅,蛋糕,温泉')})")
    stat_src = _sessions_filtered("2024-01-01", "2024-01-31", "age BETWEEN 10 AND 50")
    o["session_aggr_counts"] = aggr_counts_sql(stat_src)
    o["session_aggr_stat"] = o["session_stat_observed"] = aggr_stat_sql(stat_src)
    det = _sessions_filtered("2024-01-01", "2024-01-31", "age BETWEEN 10 AND 50 AND sex = 'male'")
    o["session_detail"] = o["session_detail_stored"] = f"""
SELECT user_id, session_id, page_id, action_time, search_keyword, click_category_id, click_product_id,
       order_category_ids, order_product_ids, pay_category_ids, pay_product_ids
FROM visits WHERE date BETWEEN '2024-01-01' AND '2024-01-31'
  AND session_id IN (SELECT session_id FROM ({det}) d)"""
    o["task_params"] = """
SELECT CAST(r_regionkey AS BIGINT) AS task_id,
       strftime(DATE '2024-01-01' + CAST(r_regionkey * 2 AS INTEGER), '%Y-%m-%d') AS start_date,
       strftime(DATE '2024-01-20' + CAST(r_regionkey * 2 AS INTEGER), '%Y-%m-%d') AS end_date,
       CAST(r_regionkey * 5 + 10 AS VARCHAR) AS start_age,
       CAST(r_regionkey * 5 + 40 AS VARCHAR) AS end_age,
       CASE WHEN r_regionkey % 2 = 0 THEN 'BUILDING,MACHINERY,HOUSEHOLD' END AS professionals,
       CASE WHEN r_regionkey = 3 THEN 'city1,city2,city3,city4,city5,city6,city7' END AS cities,
       CASE WHEN r_regionkey % 2 = 0 THEN 'male' END AS sex,
       CASE WHEN r_regionkey = 1 THEN '火锅,蛋糕,重庆辣子鸡,重庆小面' END AS keywords,
       CASE WHEN r_regionkey = 1 THEN '1,3,5,11,13' END AS category_ids,
       concat_ws(',', r_regionkey + 1, r_regionkey + 2, r_regionkey + 3, r_regionkey + 4) AS target_page_flow
FROM region"""
    return o


AREA_LEVEL_SQL = ("CASE area WHEN 'AFRICA' THEN 'A level' WHEN 'AMERICA' THEN 'A level' "
                  "WHEN 'ASIA' THEN 'B level' WHEN 'EUROPE' THEN 'C level' ELSE 'D level' END")
PRODUCT_STATUS_SQL = ("CASE WHEN json_extract_string(extend_info, '$.product_status') = '0' "
                      "THEN 'self' ELSE 'Third Party' END")


def _product_oracles() -> dict[str, str]:
    o = {}
    clicks = ("SELECT city_id, click_product_id AS product_id FROM visits "
              "WHERE click_product_id IS NOT NULL AND date BETWEEN '2024-01-01' AND '2024-01-31'")
    basic = (f"SELECT c.city_id, ci.city_name, ci.area, c.product_id FROM ({clicks}) c "
             f"JOIN cities ci ON c.city_id = ci.city_id")
    area_clicks = f"""
SELECT area, product_id, count(*) AS click_count,
       array_to_string(list_sort(list_distinct(list(CAST(city_id AS VARCHAR) || ':' || city_name))), ',')
         AS city_infos
FROM ({basic}) b GROUP BY area, product_id"""
    full = f"""
SELECT a.product_id, a.area, a.click_count, a.city_infos, p.product_name, {PRODUCT_STATUS_SQL} AS product_status
FROM ({area_clicks}) a JOIN products p ON a.product_id = p.product_id"""
    o["click_actions"] = clicks
    o["click_product_basic"] = basic
    o["area_product_clicks"] = area_clicks
    o["area_product_full"] = full
    o["area_top3_product"] = f"""
SELECT area, {AREA_LEVEL_SQL} AS area_level, product_id, city_infos, click_count, product_name, product_status
FROM (SELECT *, row_number() OVER (PARTITION BY area ORDER BY click_count DESC, product_id) AS rn
      FROM ({full}) f) r
WHERE rn <= 3"""
    o["area_top3_product_sql"] = o["area_top3_product"]
    o["area_level_map"] = f"SELECT city_id, area, {AREA_LEVEL_SQL} AS area_level FROM cities"
    o["product_status"] = f"SELECT product_id, {PRODUCT_STATUS_SQL} AS product_status FROM products"
    o["group_concat_distinct"] = (f"SELECT area, array_to_string(list_sort(list_distinct(list(city_name))), ',') "
                                  f"AS city_names FROM ({basic}) b GROUP BY area")
    return o


DETAIL_COLS_SQL = ("user_id, session_id, page_id, action_time, search_keyword, click_category_id, "
                   "click_product_id, order_category_ids, order_product_ids, pay_category_ids, pay_product_ids")


def _detail_src() -> str:
    sess = _sessions_filtered("2024-01-01", "2024-01-31", "age BETWEEN 10 AND 50 AND sex = 'male'")
    return (f"(SELECT * FROM visits WHERE date BETWEEN '2024-01-01' AND '2024-01-31' "
            f"AND session_id IN (SELECT session_id FROM ({sess}) d))")


def _unnest_ids(col: str, src: str, kind: int) -> str:
    return (f"SELECT CAST(x AS BIGINT) AS category_id, {kind} AS kind FROM "
            f"(SELECT unnest(string_split({col}, ',')) AS x FROM {src} WHERE {col} IS NOT NULL) u WHERE x <> ''")


def _category_oracles() -> dict[str, str]:
    o = {}
    d = _detail_src()
    ev = (f"SELECT click_category_id AS category_id, 0 AS kind FROM {d} d0 WHERE click_category_id IS NOT NULL "
          f"UNION ALL {_unnest_ids('order_category_ids', d, 1)} "
          f"UNION ALL {_unnest_ids('pay_category_ids', d, 2)}")
    counts = (f"SELECT category_id, count(*) FILTER (WHERE kind = 0) AS click_count, "
              f"count(*) FILTER (WHERE kind = 1) AS order_count, count(*) FILTER (WHERE kind = 2) AS pay_count "
              f"FROM ({ev}) e GROUP BY category_id")
    top10 = f"SELECT * FROM ({counts}) c ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10"
    scc = (f"SELECT session_id, click_category_id AS category_id, count(*) AS click_count FROM {d} d1 "
           f"WHERE click_category_id IS NOT NULL GROUP BY session_id, click_category_id")
    top_sess = f"""
SELECT category_id, session_id, click_count FROM (
  SELECT s.*, row_number() OVER (PARTITION BY s.category_id ORDER BY s.click_count DESC, s.session_id) AS rn
  FROM ({scc}) s WHERE s.category_id IN (SELECT category_id FROM ({top10}) t)) r
WHERE rn <= 10"""
    o["explode_category_ids"] = f"""
SELECT action_id, session_id, CAST(x AS BIGINT) AS category_id FROM
  (SELECT action_id, session_id, unnest(string_split(order_category_ids, ',')) AS x
   FROM visits WHERE order_category_ids IS NOT NULL) u WHERE x <> ''"""
    o["visited_categories"] = f"SELECT DISTINCT category_id FROM ({ev}) e"
    o["category_counts"] = counts
    o["category_counts_join"] = counts
    o["top10_category"] = top10
    o["session_category_clicks"] = scc
    o["top10_session"] = top_sess
    o["top10_session_detail"] = (f"SELECT {DETAIL_COLS_SQL} FROM {d} d2 "
                                 f"WHERE session_id IN (SELECT session_id FROM ({top_sess}) t)")
    return o


def _funnel_oracles() -> dict[str, str]:
    o = {}
    acts = "(SELECT * FROM visits WHERE date BETWEEN '2024-01-01' AND '2024-01-31')"
    pairs = (f"SELECT session_id, lag(page_id) OVER (PARTITION BY session_id ORDER BY action_time, action_id) "
             f"AS prev_page, page_id FROM {acts} a")
    flow = ("SELECT * FROM (VALUES (1, '1_2', 1, 2), (2, '2_3', 2, 3), (3, '3_4', 3, 4), (4, '4_5', 4, 5)) "
            "f(position, page_split, from_page, to_page)")
    split_pv = f"""
SELECT f.position, f.page_split, coalesce(c.pv, 0) AS pv
FROM ({flow}) f LEFT JOIN (
  SELECT f2.position, count(*) AS pv FROM ({pairs}) p JOIN ({flow}) f2
    ON p.prev_page = f2.from_page AND p.page_id = f2.to_page GROUP BY f2.position) c
  ON f.position = c.position"""
    start = f"SELECT count(*) FILTER (WHERE page_id = 1) AS start_page_pv FROM {acts} a"
    rates = f"""
SELECT position, page_split, pv, {ratio_sql('pv', 'prev')} AS convert_rate FROM (
  SELECT *, lag(pv) OVER (ORDER BY position) AS prev FROM (
    SELECT 0 AS position, NULL AS page_split, start_page_pv AS pv FROM ({start}) s
    UNION ALL SELECT position, page_split, pv FROM ({split_pv}) sp) u) r
WHERE position >= 1"""
    o["page_split_pv"] = split_pv
    o["start_page_pv"] = start
    o["page_convert_rate"] = rates
    o["page_convert_string"] = (f"SELECT string_agg(concat_ws('=', page_split, CAST(convert_rate AS VARCHAR)), '|' "
                                f"ORDER BY position) AS convert_rate FROM ({rates}) r")
    return o


def _sampling_oracles(n: int = 900, seed: int = 42) -> dict[str, str]:
    o = {}
    sess = _sessions_filtered("2024-01-01", "2024-01-31", "age BETWEEN 10 AND 50")
    hours = f"""
SELECT date, hour, hour_count, CAST(sum(hour_count) OVER (PARTITION BY date) AS BIGINT) AS day_count FROM (
  SELECT substr(start_time, 1, 10) AS date, substr(start_time, 12, 2) AS hour, count(*) AS hour_count
  FROM ({sess}) s GROUP BY 1, 2) h"""
    quotas = f"""
SELECT date, hour, least(hour_count, hour_count * ({n} // (SELECT count(DISTINCT date) FROM ({hours}) h2)) // day_count)
  AS quota FROM ({hours}) h"""
    extract = f"""
SELECT session_id, start_time, search_keywords, click_category_ids FROM (
  SELECT s.*, row_number() OVER (PARTITION BY substr(start_time, 1, 10), substr(start_time, 12, 2)
                                 ORDER BY md5('{seed}' || session_id), session_id) AS rn
  FROM ({sess}) s) r
JOIN ({quotas}) q ON substr(r.start_time, 1, 10) = q.date AND substr(r.start_time, 12, 2) = q.hour
WHERE rn <= quota"""
    o["sessions_per_hour"] = hours
    o["sessions_rollup"] = f"""
SELECT substr(start_time, 1, 10) AS date, substr(start_time, 12, 2) AS hour, count(*) AS sessions, 0 AS level
FROM ({sess}) s GROUP BY 1, 2
UNION ALL SELECT substr(start_time, 1, 10), NULL, count(*), 1 FROM ({sess}) s GROUP BY 1
UNION ALL SELECT NULL, NULL, count(*), 3 FROM ({sess}) s"""
    o["session_random_extract"] = extract
    o["extracted_session_detail"] = (f"SELECT {DETAIL_COLS_SQL} FROM visits WHERE date BETWEEN '2024-01-01' AND "
                                     f"'2024-01-31' AND session_id IN (SELECT session_id FROM ({extract}) e)")
    return o


def _expr_oracles() -> dict[str, str]:
    o = {}
    o["date_exprs"] = """
SELECT action_id, action_time,
       substr(action_time, 1, 10) || '_' || substr(action_time, 12, 2) AS date_hour,
       strftime(CAST(action_time AS TIMESTAMP), '%Y-%m-%d') AS date_fmt,
       strftime(CAST(action_time AS TIMESTAMP), '%Y%m%d') AS date_key,
       strftime(CAST(action_time AS TIMESTAMP), '%Y%m%d%H%M') AS minute_key,
       strftime(CAST(strptime(strftime(CAST(action_time AS TIMESTAMP), '%Y%m%d'), '%Y%m%d') AS DATE), '%Y-%m-%d')
         AS parsed_date,
       CAST(action_time AS TIMESTAMP) < TIMESTAMP '2024-01-15 00:00:00' AS is_before,
       CAST(action_time AS TIMESTAMP) > TIMESTAMP '2024-01-15 00:00:00' AS is_after,
       date_diff('second', CAST(date AS TIMESTAMP), CAST(action_time AS TIMESTAMP)) AS secs_into_day,
       CAST(0 AS BIGINT) AS bad_minus,
       strftime(CAST(date AS DATE) - 1, '%Y-%m-%d') AS prev_date,
       date AS same_date
FROM visits"""
    rec = ("'sessionid=' || session_id || '|searchKeywords=' || search_keywords || '|clickCategoryIds=' || "
           "click_category_ids || '|visitLength=' || CAST(visit_length AS VARCHAR) || '|stepLength=' || "
           "CAST(step_length AS VARCHAR)")
    o["string_exprs"] = f"""
SELECT session_id, record,
       nullif(regexp_extract(record, '(?:^|\\|)clickCategoryIds=([^=|]*)(?:\\||$)', 1), '') AS category_field,
       nullif(regexp_extract(record, '(?:^|\\|)searchKeywords=([^=|]*)(?:\\||$)', 1), '') AS keyword_field,
       array_to_string(list_transform(string_split(record, '|'),
           lambda x: CASE WHEN split_part(x, '=', 1) = 'visitLength'
                     THEN 'visitLength=' || CAST(visit_length * 2 AS VARCHAR) ELSE x END), '|') AS record_updated,
       regexp_replace(',' || click_category_ids || ',', '^,|,$', '', 'g') AS trimmed,
       (search_keywords IS NULL OR search_keywords = '') AS no_keywords,
       CAST(step_length % 10 AS VARCHAR) || '_' || session_id AS salted_id,
       session_id AS unsalted_id,
       CAST(user_id AS VARCHAR) || ':' || session_id AS user_session
FROM (SELECT *, {rec} AS record FROM ({session_agg_sql()}) s) r"""
    return o


def _skew_oracles() -> dict[str, str]:
    o = {}
    plain = ("SELECT v.action_id, v.user_id, v.session_id, v.page_id, u.age, u.sex "
             "FROM visits v JOIN users u ON v.user_id = u.user_id")
    o["join_broadcast"] = full_info_sql()
    o["join_salted"] = plain
    o["join_skew_isolate"] = plain
    o["heavy_keys"] = """
SELECT user_id, count(*) AS sample_count FROM visits
WHERE substr(md5('9-' || CAST(action_id AS VARCHAR)), 1, 8) < '19999999'
GROUP BY user_id ORDER BY sample_count DESC, user_id LIMIT 5"""
    o["heavy_keys_sketch"] = """
SELECT user_id, count(*) AS n FROM visits WHERE user_id IS NOT NULL GROUP BY user_id ORDER BY n DESC, user_id LIMIT 5"""
    o["agg_two_stage"] = """
SELECT ci.area, v.click_product_id AS product_id, count(*) AS click_count
FROM visits v JOIN cities ci ON v.city_id = ci.city_id
WHERE v.click_product_id IS NOT NULL AND v.date BETWEEN '2024-01-01' AND '2024-01-31'
GROUP BY ci.area, v.click_product_id"""
    o["agg_two_stage_sql"] = """
SELECT ci.area, v.click_product_id AS product_id, count(*) AS click_count,
       array_to_string(list_sort(list_distinct(list(CAST(ci.city_id AS VARCHAR) || ':' || ci.city_name))), ',') AS city_infos
FROM visits v JOIN cities ci ON v.city_id = ci.city_id
WHERE v.click_product_id IS NOT NULL AND v.date BETWEEN '2024-01-01' AND '2024-01-31'
GROUP BY ci.area, v.click_product_id"""
    o["join_salted_sql"] = f"""
SELECT a.area, a.product_id, a.click_count, p.product_name, {PRODUCT_STATUS_SQL} AS product_status
FROM ({o["agg_two_stage"]}) a JOIN products p ON a.product_id = p.product_id"""
    return o


def _ad_stat_sql(lo: str, hi: str) -> str:
    return (f"SELECT date, province, city, ad_id, count(*) AS click_count FROM ad_clicks "
            f"WHERE date BETWEEN '{lo}' AND '{hi}' GROUP BY date, province, city, ad_id")


def _daily_sql(lo: str = "2000-01-01", hi: str = "2999-12-31") -> str:
    return (f"SELECT date, user_id, ad_id, count(*) AS click_count FROM ad_clicks "
            f"WHERE date BETWEEN '{lo}' AND '{hi}' GROUP BY date, user_id, ad_id")


def _top3_sql(stat: str) -> str:
    return f"""
SELECT date, province, ad_id, click_count FROM (
  SELECT *, row_number() OVER (PARTITION BY date, province ORDER BY click_count DESC, ad_id) AS rn FROM (
    SELECT date, province, ad_id, CAST(sum(click_count) AS BIGINT) AS click_count FROM ({stat}) s
    GROUP BY date, province, ad_id) p) r
WHERE rn <= 3"""


def _ad_oracles(threshold: int = 3) -> dict[str, str]:
    o = {}
    all_stat = _ad_stat_sql("2000-01-01", "2999-12-31")
    bl = f"SELECT DISTINCT user_id FROM ({_daily_sql()}) d WHERE click_count >= {threshold}"
    o["ad_log_parse"] = "SELECT ts_ms, date, province, city, user_id, ad_id FROM ad_clicks"
    o["daily_user_ad_clicks"] = _daily_sql()
    o["blacklist_users"] = bl
    o["blacklist_filter"] = (f"SELECT ts_ms, date, province, city, user_id, ad_id FROM ad_clicks "
                             f"WHERE user_id NOT IN ({bl})")
    o["ad_stat"] = all_stat
    o["ad_stat_rollup"] = f"""
SELECT *, 0 AS level FROM ({all_stat}) s
UNION ALL SELECT date, province, NULL, ad_id, CAST(sum(click_count) AS BIGINT), 2 FROM ({all_stat}) s
GROUP BY date, province, ad_id"""
    o["province_ad_clicks"] = (f"SELECT date, province, ad_id, CAST(sum(click_count) AS BIGINT) AS click_count "
                               f"FROM ({all_stat}) s GROUP BY date, province, ad_id")
    o["ad_province_top3"] = _top3_sql(all_stat)
    o["ad_click_trend"] = """
SELECT strftime(m, '%Y-%m-%d') AS date, strftime(m, '%H') AS hour, strftime(m, '%M') AS minute, ad_id, click_count
FROM (SELECT date_trunc('minute', make_timestamp(ts_ms * 1000)) AS m, ad_id, count(*) AS click_count
      FROM ad_clicks GROUP BY 1, 2) t"""
    old, new = _ad_stat_sql("2024-01-01", "2024-01-20"), _ad_stat_sql("2024-01-11", "2024-01-30")
    o["merge_replace"] = f"""
SELECT * FROM ({old}) o WHERE NOT EXISTS (
  SELECT 1 FROM ({new}) n WHERE n.date = o.date AND n.province = o.province AND n.city = o.city AND n.ad_id = o.ad_id)
UNION ALL SELECT * FROM ({new}) n2"""
    o["merge_add"] = f"""
SELECT date, user_id, ad_id, CAST(sum(click_count) AS BIGINT) AS click_count FROM (
  SELECT * FROM ({_daily_sql('2024-01-01', '2024-01-15')}) a UNION ALL
  SELECT * FROM ({_daily_sql('2024-01-10', '2024-01-30')}) b) u
GROUP BY date, user_id, ad_id"""
    t_old = _top3_sql(_ad_stat_sql("2024-01-01", "2024-01-20"))
    t_new = _top3_sql(_ad_stat_sql("2024-01-15", "2024-01-30"))
    o["replace_group"] = f"""
SELECT * FROM ({t_old}) o WHERE NOT EXISTS (
  SELECT 1 FROM ({t_new}) n WHERE n.date = o.date AND n.province = o.province)
UNION ALL SELECT * FROM ({t_new}) n2"""
    o["lookup_total"] = f"""
SELECT b.date, b.user_id, b.ad_id, b.click_count AS batch_count, coalesce(t.click_count, 0) AS prior_total
FROM ({_daily_sql('2024-01-16', '2024-01-31')}) b
LEFT JOIN ({_daily_sql('2024-01-01', '2024-01-20')}) t
  ON b.date = t.date AND b.user_id = t.user_id AND b.ad_id = t.ad_id"""
    o["sink_append"] = _daily_sql("2024-01-01", "2024-01-31")

    # Streams, replayed one day per micro-batch: closed form of the dynamic blacklist.
    block = (f"SELECT user_id, min(date) AS block_day FROM ({_daily_sql()}) d "
             f"WHERE click_count >= {threshold} GROUP BY user_id")
    kept = (f"SELECT c.* FROM ad_clicks c LEFT JOIN ({block}) b ON c.user_id = b.user_id "
            f"WHERE b.block_day IS NULL OR c.date <= b.block_day")
    o["stream_parse"] = o["ad_log_parse"]
    o["stream_blacklist"] = f"""
SELECT k.user_id, count(*) AS kept_clicks, bool_or(b.user_id IS NOT NULL) AS blacklisted
FROM ({kept}) k LEFT JOIN ({block}) b ON k.user_id = b.user_id GROUP BY k.user_id"""
    kept_stat = (f"SELECT date, province, city, ad_id, count(*) AS click_count FROM ({kept}) k "
                 f"GROUP BY date, province, city, ad_id")
    o["stream_ad_stat"] = kept_stat
    o["stream_province_top3"] = _top3_sql(kept_stat)
    o["stream_click_trend"] = o["ad_click_trend"]
    # Every window by itself: each 10-second pane is in 360 windows; equal neighbours of a day become one row.
    o["trend_sliding_hour"] = o["stream_sliding_hour"] = """
SELECT strftime(make_timestamp(min(e) * 1000), '%Y-%m-%d') AS date, ad_id,
       strftime(make_timestamp(min(e) * 1000), '%Y-%m-%d %H:%M:%S') AS first_end,
       strftime(make_timestamp(max(e) * 1000), '%Y-%m-%d %H:%M:%S') AS last_end, any_value(n) AS click_count
FROM (SELECT *, sum(CASE WHEN n = before AND e = e_before + 10000 AND e % 86400000 <> 0 THEN 0 ELSE 1 END)
                  OVER (PARTITION BY ad_id ORDER BY e ROWS UNBOUNDED PRECEDING) AS island
      FROM (SELECT *, lag(n) OVER (PARTITION BY ad_id ORDER BY e) AS before,
                   lag(e) OVER (PARTITION BY ad_id ORDER BY e) AS e_before
            FROM (SELECT ad_id, (ts_ms // 10000) * 10000 + k * 10000 AS e, count(*) AS n
                  FROM ad_clicks, range(1, 361) w(k) GROUP BY 1, 2) windows) l) i
GROUP BY ad_id, island"""
    o["stream_ad_job"] = f"SELECT ts_ms, date, province, city, user_id, ad_id FROM ({kept}) k"
    minute = "CAST(date || ' ' || hour || ':' || minute AS TIMESTAMP)"
    newest = "(SELECT make_timestamp((max(ts_ms) // 1000) * 1000000) FROM ad_clicks)"
    o["trend_last_hour"] = f"""
SELECT * FROM ({o["ad_click_trend"]}) t
WHERE {minute} > {newest} - INTERVAL 60 MINUTE AND {minute} <= {newest}"""
    o["ad_log_rejects"] = """
SELECT CASE WHEN event_type = 'click' THEN 'no_time' ELSE 'no_user' END AS reason, count(*) AS lines
FROM events GROUP BY 1"""
    return o


def build_oracle() -> dict[str, str]:
    raw = {}
    raw.update(_session_oracles())
    raw.update(_product_oracles())
    raw.update(_category_oracles())
    raw.update(_funnel_oracles())
    raw.update(_sampling_oracles())
    raw.update(_expr_oracles())
    raw.update(_skew_oracles())
    raw.update(_ad_oracles())
    return {k: with_fixtures(v) for k, v in raw.items()}
