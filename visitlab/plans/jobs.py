"""Whole jobs driven by a task id, writing task-tagged result tables.

These are the entry points a user of the original application calls: load the
task's parameters, compute every output of the job, and append each one (with
``task_id``) to its table under ``out_root``.  Outputs that share an
intermediate (the filtered sessions, the session detail) read it from one
reliable checkpoint instead of recomputing it per output.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlab.operators.merge import append
from visitlab.plans import categories as C
from visitlab.plans import funnel as FN
from visitlab.plans import products as PR
from visitlab.plans import sampling as SM
from visitlab.plans import sessions as S
from visitlab.session import checkpoint_root
from visitlab.sources.params import load_task
from visitlab.sources.tables import Tables
from visitlab.streaming import ad_streams as AS


def tag_task(df: DataFrame, task_id: int) -> DataFrame:
    """Prepend the ``task_id`` column of the result tables."""
    return df.select(F.lit(task_id).cast("long").alias("task_id"), *df.columns)


def _write_all(outputs: dict[str, DataFrame], task_id: int, out_root: str) -> dict[str, str]:
    paths = {}
    for name, df in outputs.items():
        paths[name] = f"{out_root.rstrip('/')}/{name}"
        append(tag_task(df, task_id), paths[name])
    return paths


def session_job_outputs(tables: Tables, task_id: int, sample_n: int = 100, seed: int = 42) -> dict[str, DataFrame]:
    """Histogram ratios, stratified sample and its detail, top-10 categories,
    top-10 sessions per category and their detail."""
    p = load_task(tables.tasks(), task_id)
    visits = tables.visits()
    actions = S.actions_in_range(visits, p)
    checkpoint_root(tables.spark)
    # Several outputs read the filtered sessions and their detail: store each once.  The write of the sessions gives
    # the histogram too.
    sessions, stat = S.stored_sessions(S.filtered_sessions(visits, tables.users(), p))
    detail = S.session_detail(actions, sessions, stored=True).checkpoint(eager=True)
    extract = SM.session_random_extract(sessions, sample_n, seed)
    top_cats, top_sess = C.top_categories_and_sessions(detail)
    return {
        "session_aggr_stat": stat,
        "session_random_extract": extract,
        "session_detail": SM.extracted_session_detail(detail, extract, sample_n)
        .unionByName(C.top10_session_detail(detail, top_sess)),
        "top10_category": top_cats,
        "top10_session": top_sess,
    }


def page_job_outputs(tables: Tables, task_id: int) -> dict[str, DataFrame]:
    """Conversion rate per split, and the joined string form."""
    p = load_task(tables.tasks(), task_id)
    checkpoint_root(tables.spark)
    # Both forms come from one computation (a handful of rows).
    rates = FN.page_convert_rate(tables.spark, tables.visits(), p).checkpoint(eager=True)
    return {"page_convert_rate": rates, "page_split_convert_rate": FN.convert_string(rates)}


def product_job_outputs(tables: Tables, task_id: int) -> dict[str, DataFrame]:
    """Top-3 products per area."""
    p = load_task(tables.tasks(), task_id)
    return {"area_top3_product": PR.area_top3_product(tables.visits(), tables.cities(), tables.products(), p)}


def run_session_job(tables: Tables, task_id: int, out_root: str, **kw) -> dict[str, str]:
    return _write_all(session_job_outputs(tables, task_id, **kw), task_id, out_root)


def run_page_job(tables: Tables, task_id: int, out_root: str) -> dict[str, str]:
    return _write_all(page_job_outputs(tables, task_id), task_id, out_root)


def run_product_job(tables: Tables, task_id: int, out_root: str) -> dict[str, str]:
    return _write_all(product_job_outputs(tables, task_id), task_id, out_root)


@dataclass
class AdJob:
    """The streaming queries of J4 and the tables they write."""
    tables: AS.AdTables
    queries: list


def start_ad_job(spark: SparkSession, lines: DataFrame, out_root: str, threshold: int = 100,
                 trigger: dict | None = None) -> AdJob:
    """J4 in production: blacklist and kept clicks, running totals with top 3 per province, trend panes and rejects on
    ``lines`` (a streaming DataFrame with a ``value`` column, e.g. Kafka) with ``trigger`` (default 5 s)."""
    root = out_root.rstrip("/")
    return AdJob(*AS.run_ad_stream(lines, f"{root}/ads", f"{root}/_ck", threshold,
                                   trigger or {"processingTime": "5 seconds"}))
