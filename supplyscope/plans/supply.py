"""Expected against actual supply: status grids and issue listings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import remove_text
from ..operators import coverage_grid, left_on, representative, spread_join
from .constants import (
    COUNTRY_SUFFIX,
    LOCAL_PLAN,
    NO_ENDPOINT,
    ODP_COLLECTIONS,
    ODP_DATASETS,
    ODP_PROJECT,
    PLAN_COLLECTIONS,
    PLAN_DATASETS,
    members,
)

# Columns of the reports.
_STATUS_COLUMNS = {
    "endpoint": "endpoint",
    "endpoint_url": "endpoint_url",
    "licence": "licence",
    "latest_status": "status",
    "days_since_200": "days_since_200",
    "latest_exception": "exception",
    "resource": "resource",
    "latest_log_entry_date": "latest_log_entry_date",
    "endpoint_entry_date": "endpoint_entry_date",
    "endpoint_end_date": "endpoint_end_date",
    "resource_start_date": "resource_start_date",
    "resource_end_date": "resource_end_date",
}
_ISSUE_COLUMNS = [
    "severity",
    "responsibility",
    "count_issues",
    "collection",
    "endpoint",
    "endpoint_url",
    "latest_status",
    "latest_exception",
    "resource",
    "latest_log_entry_date",
    "endpoint_entry_date",
    "endpoint_end_date",
    "resource_start_date",
    "resource_end_date",
]


def cohort_provisions(tables: Mapping[str, DataFrame], keys: Sequence[str] = ("organisation", "cohort")) -> DataFrame:
    """Organisations expected to supply, with name and cohort: one row per ``keys``.

    Where an organisation has several cohorts or names, the earliest cohort and first name stand.
    """
    expected = tables["provision"].filter(
        (F.col("provision_reason") == "expected") & (F.col("project") == ODP_PROJECT)
    )
    cohort = tables["cohort"].select("cohort", F.col("start_date").alias("cohort_start_date"))
    organisation = tables["organisation"].select("organisation", "name")
    # Distinct first: an organisation has a provision for each of its datasets.
    pairs = expected.select("organisation", "cohort").distinct()
    rows = pairs.join(cohort, "cohort").join(organisation, "organisation")
    return representative(rows, keys, ["cohort_start_date", "cohort", "name"])


def plan_provisions(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Organisations with a statutory duty to supply plans, one row each."""
    statutory = tables["provision"].filter(
        (F.col("specification") == LOCAL_PLAN) & (F.col("provision_reason") == "statutory")
    )
    codes = statutory.select("organisation").distinct()
    rows = codes.join(tables["organisation"].select("organisation", "name"), "organisation")
    return representative(rows, ["organisation"], ["name"])


def _endpoints(tables: Mapping[str, DataFrame]) -> DataFrame:
    latest = tables["latest_endpoint"]
    return latest.select(
        remove_text(F.col("organisation"), COUNTRY_SUFFIX).alias("organisation"),
        "pipeline",
        *[F.col(old).alias(new) for old, new in _STATUS_COLUMNS.items()],
    )


def _status(expected: DataFrame, collections: dict[str, list[str]], endpoints: DataFrame) -> DataFrame:
    texts = [f.name for f in endpoints.schema if f.dataType.simpleString() == "string"]
    defaults = {c: "" for c in texts} | {"endpoint": NO_ENDPOINT}
    return coverage_grid(expected, members(collections), endpoints, ["organisation", "pipeline"], defaults)


def odp_status(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Each expected dataset of each cohort member, with its endpoints or a line saying there is none."""
    grid = _status(cohort_provisions(tables), ODP_COLLECTIONS, _endpoints(tables))
    front = ["organisation", "cohort", "name", "collection", "pipeline"]
    return grid.select(*front, *_STATUS_COLUMNS.values(), "cohort_start_date")


def plan_status(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The same for plan datasets."""
    grid = _status(plan_provisions(tables), PLAN_COLLECTIONS, _endpoints(tables))
    return grid.select("organisation", "name", "collection", "pipeline", *_STATUS_COLUMNS.values())


def _with_state(issues: DataFrame, tables: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Issue rows with the state of their endpoint, looked up by ``keys``.

    An endpoint may serve several datasets: looked up by endpoint alone, an issue row appears once
    for each of them.
    """
    state = tables["endpoint_dataset_summary"].select(
        *keys,
        F.col("end_date").alias("endpoint_end_date"),
        F.col("entry_date").alias("endpoint_entry_date"),
        "latest_status",
        "latest_exception",
    )
    return left_on(issues, state, keys)


def odp_issue(tables: Mapping[str, DataFrame], datasets: Sequence[str] = tuple(ODP_DATASETS)) -> DataFrame:
    """Issues in what the expected organisations supply."""
    provisions = cohort_provisions(tables).select("organisation", "cohort", F.col("name").alias("organisation_name"))
    issues = tables["issue_summary"].filter(F.col("dataset").isin(list(datasets)))
    merged = _with_state(spread_join(issues, provisions, ["organisation", "cohort"], "inner"), tables, ["endpoint"])
    return merged.select("organisation", "cohort", "organisation_name", "pipeline", "issue_type", *_ISSUE_COLUMNS)


def plan_issue(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Issues in what the organisations with a plan duty supply."""
    provisions = plan_provisions(tables).withColumnRenamed("name", "organisation_name")
    issues = tables["issue_summary"].filter(F.col("dataset").isin(PLAN_DATASETS))
    coded = issues.withColumn("organisation", remove_text(F.col("organisation"), COUNTRY_SUFFIX))
    merged = _with_state(spread_join(coded, provisions, ["organisation"], "inner"), tables, ["endpoint", "dataset"])
    return merged.select("organisation", "organisation_name", "pipeline", "issue_type", "field", *_ISSUE_COLUMNS)
