"""Job parameters stored as JSON in a task table.

``task_param`` is a JSON object whose every value is an array of strings; a
parameter is the first element of its array, and a missing key or an empty
array means "not given".
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Parameter names inside task_param.
PARAM_NAMES = {
    "start_date": "startDate",
    "end_date": "endDate",
    "start_age": "startAge",
    "end_age": "endAge",
    "professionals": "professionals",
    "cities": "cities",
    "sex": "sex",
    "keywords": "keywords",
    "category_ids": "categoryIds",
    "target_page_flow": "targetPageFlow",
}

PARAM_SCHEMA = "map<string,array<string>>"


@dataclass(frozen=True)
class TaskParams:
    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    professionals: str | None = None
    cities: str | None = None
    sex: str | None = None
    keywords: str | None = None
    category_ids: str | None = None
    target_page_flow: str | None = None

    @property
    def page_flow(self) -> list[int]:
        if not self.target_page_flow:
            return []
        return [int(x) for x in self.target_page_flow.split(",") if x != ""]


def parse_task_params(tasks: DataFrame) -> DataFrame:
    """One row per task with each parameter as its own (string) column."""
    m = F.from_json(F.col("task_param"), PARAM_SCHEMA)
    cols = [F.col("task_id")]
    for py_name, json_name in PARAM_NAMES.items():
        cols.append(F.nullif(F.get(m.getItem(json_name), 0), F.lit("")).alias(py_name))
    return tasks.select(*cols)


def load_task(tasks: DataFrame, task_id: int) -> TaskParams:
    """Parameters of one task (a single-row read; fails clearly if absent)."""
    rows = parse_task_params(tasks.filter(F.col("task_id") == task_id)).limit(2).collect()
    if len(rows) != 1:
        raise LookupError(f"task {task_id} not found (or not unique)")
    r = rows[0].asDict()
    for k in ("start_age", "end_age"):
        if r.get(k) is not None:
            r[k] = int(r[k])
    r.pop("task_id")
    return TaskParams(**r)
