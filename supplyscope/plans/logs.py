"""Collector log and operational issue counts over the last six months."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import date_text, flag, months_ago, to_day, week_monday

WINDOW_MONTHS = 6


def logs_by_week(tables: Mapping[str, DataFrame], as_of: dt.date | None = None) -> DataFrame:
    """Requests per day and outcome, for the Mondays of the window.

    Only entries made on the Monday itself are counted.
    """
    day = to_day(F.col("entry_date"))
    log = tables["log"].filter((day >= months_ago(as_of, WINDOW_MONTHS)) & (day <= week_monday(day)))
    counted = log.groupBy(
        date_text(F.col("entry_date")).alias("entrydate"),
        week_monday(day).alias("week_start"),
        flag(F.col("status") == 200, "200", "FAIL").alias("status_group"),
    ).agg(F.count("endpoint").alias("total_requests"))
    ordered = counted.orderBy(F.desc("entrydate"), "status_group")
    return ordered.select("total_requests", "entrydate", "week_start", "status_group")


def operational_issues(tables: Mapping[str, DataFrame], as_of: dt.date | None = None) -> DataFrame:
    """Operational issues per entry date."""
    recent = tables["operational_issue"].filter(to_day(F.col("entry_date")) >= months_ago(as_of, WINDOW_MONTHS))
    return recent.groupBy("entry_date").agg(F.count(F.lit(1)).alias("issue_count"))
