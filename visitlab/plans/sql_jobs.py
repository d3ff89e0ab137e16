"""SQL-text forms of the jobs the original wrote in SQL.

They run over the temp views of :meth:`Tables.register_views` and the SQL
functions of :func:`register_sql_functions`; Catalyst plans them exactly like
the DataFrame forms (same partial aggregates, same partial WindowGroupLimit).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from visitlab.functions.sql_functions import register_sql_functions
from visitlab.plans.products import AREA_LEVELS, OTHER_LEVEL
from visitlab.sources.tables import Tables


def _prepare(spark: SparkSession, tables: Tables, prefix: str) -> None:
    register_sql_functions(spark)
    tables.register_views(prefix)


def level_case(area: str = "area") -> str:
    whens = " ".join(f"WHEN '{a}' THEN '{level}'" for a, level in AREA_LEVELS.items())
    return f"CASE {area} {whens} ELSE '{OTHER_LEVEL}' END"


def area_top3_product_sql(spark: SparkSession, tables: Tables, start_date: str, end_date: str,
                          prefix: str = "vl_") -> DataFrame:
    """C7 in SQL: clicks -> city join -> (area, product) counts with city list ->
    product join -> row_number per area <= 3 -> area level."""
    _prepare(spark, tables, prefix)
    return spark.sql(f"""
        WITH clicks AS (
          SELECT city_id, click_product_id AS product_id
          FROM {prefix}visits
          WHERE date >= '{start_date}' AND date <= '{end_date}' AND click_product_id IS NOT NULL),
        per_city AS (
          SELECT city_id, product_id, count(*) AS n FROM clicks GROUP BY city_id, product_id),
        area_clicks AS (
          SELECT c.area, p.product_id, sum(p.n) AS click_count,
                 array_join(array_sort(collect_set(concat_long_string(c.city_id, c.city_name, ':'))), ',')
                   AS city_infos
          FROM per_city p JOIN {prefix}cities c ON p.city_id = c.city_id
          GROUP BY c.area, p.product_id),
        full AS (
          SELECT a.*, pr.product_name,
                 if(get_json_field(pr.extend_info, 'product_status') = '0', 'self', 'Third Party')
                   AS product_status
          FROM area_clicks a JOIN {prefix}products pr ON a.product_id = pr.product_id),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY area ORDER BY click_count DESC, product_id) AS rn
          FROM full)
        SELECT area,
               {level_case()} AS area_level,
               product_id, city_infos, click_count, product_name, product_status
        FROM ranked WHERE rn <= 3""")


def agg_two_stage_sql(spark: SparkSession, tables: Tables, start_date: str, end_date: str,
                      salts: int = 10, prefix: str = "vl_") -> DataFrame:
    """A9 in SQL: count and city set per salted "area:product" key, strip the salt, merge both."""
    _prepare(spark, tables, prefix)
    return spark.sql(f"""
        WITH salted AS (
          SELECT random_prefix(concat_ws(':', c.area, CAST(v.click_product_id AS STRING)), {salts},
                               CAST(v.action_id AS STRING)) AS salted_key,
                 concat_long_string(c.city_id, c.city_name, ':') AS city
          FROM {prefix}visits v JOIN {prefix}cities c ON v.city_id = c.city_id
          WHERE v.date >= '{start_date}' AND v.date <= '{end_date}' AND v.click_product_id IS NOT NULL),
        partial AS (
          SELECT salted_key, count(*) AS n, collect_set(city) AS cities FROM salted GROUP BY salted_key)
        SELECT substring_index(remove_random_prefix(salted_key), ':', 1) AS area,
               CAST(substring_index(remove_random_prefix(salted_key), ':', -1) AS BIGINT) AS product_id,
               sum(n) AS click_count,
               array_join(array_sort(array_distinct(flatten(collect_list(cities)))), ',') AS city_infos
        FROM partial GROUP BY remove_random_prefix(salted_key)""")


def join_salted_sql(spark: SparkSession, tables: Tables, start_date: str, end_date: str,
                    salts: int = 10, prefix: str = "vl_") -> DataFrame:
    """JN13 in SQL: (area, product) counts, salted by the area, meet products replicated once per salt.

    The salt hashes the row's key without the product, so a product counted in many areas
    spreads over the salts; each row meets exactly one copy, so the join equals the plain one.
    The copies are shuffled: Spark estimates them at the size of the products, without the
    copies, and would send them all to the driver to broadcast them."""
    _prepare(spark, tables, prefix)
    return spark.sql(f"""
        WITH per_city AS (
          SELECT city_id, click_product_id AS product_id, count(*) AS n FROM {prefix}visits
          WHERE date >= '{start_date}' AND date <= '{end_date}' AND click_product_id IS NOT NULL
          GROUP BY city_id, click_product_id),
        area_clicks AS (
          SELECT c.area, p.product_id, sum(p.n) AS click_count
          FROM per_city p JOIN {prefix}cities c ON p.city_id = c.city_id GROUP BY c.area, p.product_id),
        salted_clicks AS (
          SELECT *, random_prefix(CAST(product_id AS STRING), {salts}, area) AS salted_id FROM area_clicks),
        salted_products AS (
          SELECT p.product_name, p.extend_info,
                 concat(CAST(s.salt AS STRING), '_', CAST(p.product_id AS STRING)) AS salted_id
          FROM {prefix}products p LATERAL VIEW explode(sequence(0, {salts} - 1)) s AS salt)
        SELECT /*+ MERGE(p) */
               c.area, CAST(remove_random_prefix(c.salted_id) AS BIGINT) AS product_id, c.click_count, p.product_name,
               if(get_json_field(p.extend_info, 'product_status') = '0', 'self', 'Third Party') AS product_status
        FROM salted_clicks c JOIN salted_products p ON c.salted_id = p.salted_id""")
