"""The library's column functions as SQL functions, for users who write SQL.

``register_sql_functions(spark)`` creates session-scoped SQL functions whose
bodies are SQL expressions.  Spark inlines them into the plan, so they run
inside whole-stage codegen like any built-in (no Python UDF involved).
The aggregate ``group_concat_distinct`` has no scalar form; in SQL write
``array_join(array_sort(collect_set(x)), ',')``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# name -> (parameters, return type, body)
SQL_FUNCTIONS = {
    # v1 + sep + v2 (a null part is skipped)
    "concat_long_string": ("v1 BIGINT, v2 STRING, sep STRING", "STRING",
                           "concat_ws(sep, CAST(v1 AS STRING), v2)"),
    # JSON field by bare name; null on bad JSON
    "get_json_field": ("json STRING, field STRING", "STRING",
                       "get_json_object(json, concat('$.', field))"),
    # Salt prefix in [0, n) by a row id, so equal values spread over all n and a
    # re-run task draws the same prefix for a row
    "random_prefix": ("val STRING, n INT, row_id STRING", "STRING",
                      "concat(CAST(pmod(xxhash64(row_id), n) AS STRING), '_', val)"),
    # U4: strip a salt prefix
    "remove_random_prefix": ("val STRING", "STRING", "regexp_replace(val, '^[0-9]+_', '')"),
    # F7
    "trim_comma": ("s STRING", "STRING", "regexp_replace(s, '^,|,$', '')"),
    # F8: field of a "k=v|k=v" record; null if absent or empty
    "get_field": ("s STRING, field STRING", "STRING",
                  "nullif(regexp_extract(s, concat('(?:^|[|])', field, '=([^=|]*)(?:[|]|$)'), 1), '')"),
    # 'yyyy-MM-dd HH:mm:ss' -> 'yyyy-MM-dd_HH'
    "date_hour": ("t STRING", "STRING", "concat(substr(t, 1, 10), '_', substr(t, 12, 2))"),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    for name, (params, returns, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {returns} RETURN {body}")
    return list(SQL_FUNCTIONS)
