"""Entity counts: what the resources held against what the platform shows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import guarded_ratio, is_blank, to_number_or_zero
from ..operators import (
    dedupe,
    group_count,
    left_on,
    missing,
    outer_compare,
    sort_report,
)
from ..sources import Shared, shared
from .constants import COUNTED_DATASETS

_OWNER = ["dataset", "name", "organisation"]
_COUNTS = ["entity_count", "entry_count", "line_count"]


def resource_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Historic endpoint rows of the counted datasets: the first for each (resource, dataset), once
    among active and once among ended resources."""
    history = tables["historic_endpoint"]
    counted = history.filter(F.col("dataset").isin(COUNTED_DATASETS) & ~is_blank(F.col("resource")))
    marked = counted.select(
        "rowid",
        *_OWNER,
        "endpoint",
        "endpoint_entry_date",
        "resource",
        "resource_start_date",
        missing(history, "resource_end_date").alias("is_active"),
    )
    return dedupe(marked, ["dataset", "resource", "is_active"], ["rowid"], "first")


def counted_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Active resources with their counts, and ended resources. Active ones without counts are left out.

    The last count given for a (dataset, resource) stands. One de-duplication serves active and ended rows.
    """
    return shared(tables, "counted-rows", (), lambda: _counted_rows(tables))


def _counted_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = dedupe(tables["dataset_resource"], ["dataset", "resource"], ["rowid"], "last").select(
        "dataset",
        "resource",
        F.lit(True).alias("is_active"),
        to_number_or_zero(F.col("entity_count")).alias("entity_count"),
        to_number_or_zero(F.col("entry_count"), "bigint").alias("entry_count"),
        to_number_or_zero(F.col("line_count"), "bigint").alias("line_count"),
        F.lit(True).alias("is_counted"),
    )
    rows = left_on(resource_rows(tables).drop("rowid"), counts, ["dataset", "resource", "is_active"])
    return rows.filter("is_counted OR NOT is_active").drop("is_counted")


def resource_detailed_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Counts per owner, endpoint and resource.

    A (dataset, resource) occurs once among the active rows, so each row already is its own group.
    """
    columns = [*_OWNER, "endpoint", "endpoint_entry_date", "resource", "resource_start_date", *_COUNTS]
    return sort_report(counted_rows(tables).filter("is_active").select(*columns), ["dataset", "name"], ["organisation", "resource"])


def _blank_owner(df: DataFrame) -> DataFrame:
    """Owner names as text, blank if unknown, so that both sides agree on what unknown looks like."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in ("name", "organisation")})


def endpoint_sums(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Sums over the resources of each owner and endpoint, active and ended ones apart.

    A row is one endpoint, an unknown one included, so endpoints are counted exactly by counting rows, and an owner with most of
    the resources is spread over its endpoints.
    """
    rows = _blank_owner(counted_rows(tables)).groupBy(*_OWNER, "is_active", "endpoint")
    # (dataset, resource) is unique in each half, so a row count is the number of resources.
    return rows.agg(*[F.sum(c).alias(c) for c in _COUNTS], F.count(F.lit(1)).alias("resources")).drop("endpoint")


def platform_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Entities on the platform, counted per organisation before the names are looked up, so a large supplier
    is one row by then. An owner has a row for each of its organisations."""
    entity = tables["entity"].filter(F.col("dataset").isin(COUNTED_DATASETS))
    counted = group_count(entity, ["dataset", "organisation_entity"], name="entities", dropna=False)
    organisation = tables["organisation"].select(
        F.col("entity").alias("organisation_entity"), "organisation", "name"
    )
    lookup = dedupe(organisation, ["organisation_entity"], ["organisation"], "last")
    return _blank_owner(left_on(counted, lookup, ["organisation_entity"])).select(*_OWNER, "entities")


def resource_vs_platform(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Both counts side by side, with the ratio of platform entities to resource lines.

    An owner with ended resources only has zero sums; one without any resources has none.
    """
    active, ended = F.col("is_active"), ~F.col("is_active")
    has_resources = F.count("is_active") > 0
    measures = {c: F.sum(c) for c in _COUNTS} | {
        "endpoint_count": F.count_if(active),
        "resource_count": F.sum(F.when(active, F.col("resources"))),
        "inactive_endpoint_count": F.count_if(ended),
        "inactive_resource_count": F.sum(F.when(ended, F.col("resources"))),
    }
    names = {c: f"dataset_resource_{c}" for c in measures}
    merged = outer_compare(
        platform_rows(tables),
        endpoint_sums(tables),
        _OWNER,
        F.sum("entities").alias("platform_entity_count"),
        *[F.when(has_resources, F.coalesce(m, F.lit(0))).alias(names[c]) for c, m in measures.items()],
    )
    ratio = guarded_ratio(F.col("platform_entity_count"), F.col("dataset_resource_line_count"))
    report = merged.select(
        *_OWNER, "platform_entity_count", *names.values(), ratio.alias("platform_divided_by_dr_line_count")
    )
    return sort_report(report, _OWNER)


def resource_reports(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Both reports of one run, by name. Their resource rows are made and counted once."""
    tables = Shared(tables)
    return {r.__name__: r(tables) for r in (resource_detailed_counts, resource_vs_platform)}
