"""Top-3 products per area (click counts, city list, area level, product status).

Scale-aware plan: clicks are first counted per (city_id, product_id) -- a
partial + final hash aggregate, so a hot city or product is combined map-side --
and only those counts meet the city dimension.  The (area, product) aggregate
then sums counts and collects the distinct city labels (bounded by the number
of cities).  The product join happens on the aggregated rows, and the top-3 per
area uses row_number with a partial WindowGroupLimit before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlab.functions import filters
from visitlab.functions.aggregates import group_concat_distinct
from visitlab.functions.strings import concat_sep
from visitlab.operators.topk import top_k_per_group
from visitlab.sources.params import TaskParams

# Area -> level; anything else is "D level".
AREA_LEVELS = {"AFRICA": "A level", "AMERICA": "A level", "ASIA": "B level", "EUROPE": "C level"}
OTHER_LEVEL = "D level"
SELF_PRODUCT = "self"
THIRD_PARTY_PRODUCT = "Third Party"

TOP3_COLUMNS = ["area", "area_level", "product_id", "city_infos", "click_count", "product_name",
                "product_status"]


def click_actions(visits: DataFrame, params: TaskParams | None) -> DataFrame:
    """(city_id, product_id) of click actions in the date range."""
    df = visits.filter(F.col("click_product_id").isNotNull())
    if params is not None:
        df = filters.apply(df, [filters.between("date", params.start_date, params.end_date)])
    return df.select("city_id", F.col("click_product_id").alias("product_id"))


def click_product_basic(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """JN6: each click with its city name and area (unknown cities drop out)."""
    return clicks.join(cities, "city_id", "inner").select("city_id", "city_name", "area", "product_id")


def area_level(area_col="area"):
    """CASE over the fixed area map, ELSE 'D level'."""
    c = F.col(area_col) if isinstance(area_col, str) else area_col
    expr = None
    for area, level in AREA_LEVELS.items():
        expr = F.when(c == area, level) if expr is None else expr.when(c == area, level)
    return expr.otherwise(OTHER_LEVEL)


def product_status(extend_info="extend_info"):
    """P10: 'self' when the JSON field product_status is '0', else 'Third Party'
    (null or unparsable JSON included)."""
    c = F.col(extend_info) if isinstance(extend_info, str) else extend_info
    return F.when(F.get_json_object(c, "$.product_status") == "0", SELF_PRODUCT).otherwise(THIRD_PARTY_PRODUCT)


def area_product_clicks(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks per (area, product) with the distinct ``city_id:city_name`` list."""
    per_city = clicks.groupBy("city_id", "product_id").agg(F.count(F.lit(1)).alias("n"))
    return (per_city.join(cities, "city_id", "inner")
            .groupBy("area", "product_id")
            .agg(F.sum("n").alias("click_count"),
                 group_concat_distinct(concat_sep("city_id", "city_name", ":")).alias("city_infos")))


def area_product_full(area_clicks: DataFrame, products: DataFrame) -> DataFrame:
    """JN7: add product name and status."""
    p = products.select("product_id", "product_name", product_status().alias("product_status"))
    return area_clicks.join(p, "product_id", "inner")


def area_top3_product(visits: DataFrame, cities: DataFrame, products: DataFrame,
                      params: TaskParams | None, k: int = 3) -> DataFrame:
    """The k most clicked products of each area (ties: lower product_id first)."""
    full = area_product_full(area_product_clicks(click_actions(visits, params), cities), products)
    top = top_k_per_group(full, ["area"], [F.col("click_count").desc(), F.col("product_id").asc()], k)
    return top.withColumn("area_level", area_level("area")).select(*TOP3_COLUMNS)
