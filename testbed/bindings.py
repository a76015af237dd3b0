"""Registered queries: each report over the domain views of a test-data directory."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyscope import plans
from supplyscope.operators import group_distinct, page, page_count, page_numbers, read_page, store_ordered, union_datasets
from supplyscope.sources import (
    TABLES,
    dataset_slugs,
    export_table,
    read_csv_strings,
    read_csv_table,
    read_entities,
    read_json_records,
    read_pages,
    scratch_dir,
    write_report,
    write_reports,
    write_split,
)

from .views import SPATIAL, tables

LOG_DAY = dt.date(2024, 7, 10)
HISTORY_DAY = dt.date(2024, 1, 31)
ENDPOINT_DAY = dt.date(2001, 8, 2)

CRITERIA = ["1 - unknown entity", "2 - duplicate reference values", "3 - invalid geometry", "3 - missing value"]
LPA_CRITERIA = sorted([*CRITERIA, "3 - entities within LPA boundary", "3 - entity count matches LPA"])

#: Group and measure of each report's totals.
RESOURCE_TOTALS = {
    "resource_detailed_counts": ("dataset", "sum(line_count)"),
    "resource_vs_platform": ("dataset", "sum(coalesce(dataset_resource_line_count, 0) + coalesce(platform_entity_count, 0))"),
}
QUALITY_TOTALS = {
    "quality_detail": ("quality_level_label", "count(DISTINCT organisation)"),
    "quality_scores": ("`ready_for_ODP_adoption`", "count(DISTINCT organisation)"),
}
CONFORMANCE_TOTALS = {
    "conformance": ("cohort", "sum(field_supplied)"),
    "conformance_display": ("field_matched_band", "count(DISTINCT organisation)"),
    "conformance_overview": ("dataset", "sum(`> 80%`)"),
    "conformance_full_match": ("CAST(NULL AS STRING)", "round(sum(percent_100_field_match * 10))"),
}

Query = Callable[[SparkSession, str], DataFrame]


def _report(report: Callable[..., DataFrame], *names: str, views: dict[str, str] | None = None, **options) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return report(tables(spark, sf_dir, *names, **(views or {})), **options)

    return run


def _plain_number_column(query: Query) -> Query:
    """The report's column is called ``endpoint_no.``; the dot is dropped for tools that read a dot in
    a column name as access to a field."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(spark, sf_dir).withColumnRenamed("endpoint_no.", "endpoint_no")

    return run


def _export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "export")
    export_table(tables(spark, sf_dir, "issue_summary")["issue_summary"], path)
    return read_csv_table(spark, path, TABLES["issue_summary"])


def _csv_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlines written with hyphenated names and read back as text, those with an organisation only."""
    path = scratch_dir(spark, "strings")
    outlines = tables(spark, sf_dir, "listed_building_outline")["listed_building_outline"]
    write_report(outlines.toDF(*[c.replace("_", "-") for c in outlines.columns]), path)
    return read_csv_strings(
        spark, path, ["listed-building", "reference", "organisation-entity"], "organisation-entity"
    )


def _json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "records")
    tables(spark, sf_dir, "entity")["entity"].write.option("ignoreNullFields", False).json(path)
    return read_json_records(spark, f"{path}/*.json", TABLES["entity"], lines=True)


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of endpoint rows written as page documents of columns and rows, one per 1000 row ids."""
    path = scratch_dir(spark, "pages")
    history = tables(spark, sf_dir, "historic_endpoint")["historic_endpoint"]
    cells = F.array(*[F.col(c).cast("string") for c in history.columns])
    numbered = history.select(F.floor(F.col("rowid") / 1000).alias("page"), cells.alias("row"))
    # A page holds at most 1000 rows: row ids are unique.
    documents = numbered.groupBy("page").agg(F.collect_list("row").alias("rows"))
    names = F.array(*[F.lit(c) for c in history.columns])
    text = F.to_json(F.struct(names.alias("columns"), "rows"), {"ignoreNullFields": "false"})
    documents.select(text.alias("value")).write.text(path)
    return read_pages(spark, path, TABLES["historic_endpoint"], "columnar", lines=True)


def _ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One Parquet table per dataset, with hyphenated names, some without a reference column."""
    path = scratch_dir(spark, "entities")
    entity = tables(spark, sf_dir, "entity")["entity"]
    paths = {}
    for i, dataset in enumerate(SPATIAL):
        part = entity.filter(F.col("dataset") == dataset)
        part = part.drop("reference") if i % 2 else part
        part.toDF(*[c.replace("_", "-") for c in part.columns]).write.parquet(f"{path}/{dataset}")
        paths[dataset] = f"{path}/{dataset}"
    columns = {"entity": "bigint", "name": "string", "reference": "string", "organisation_entity": "bigint"}
    return read_entities(spark, paths, columns, {"reference": ""})


def _union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tables of different shape as one."""
    t = tables(spark, sf_dir, "entity", "listed_building_outline", "lookup")
    wanted = ["dataset", "entity", "reference", "name", "organisation_entity"]
    return union_datasets(
        {
            "entity": t["entity"],
            "listed-building-outline": t["listed_building_outline"],
            "lookup": t["lookup"].withColumn("dataset", F.lit(None).cast("string")),
        },
        wanted,
    )


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Endpoints without provision, written to one report for PDF links and one for the rest."""
    path = scratch_dir(spark, "split")
    gaps = plans.endpoints_no_provision(_provision_tables(spark, sf_dir))
    is_pdf = F.coalesce(F.lower("endpoint_url").endswith(".pdf"), F.lit(False))
    write_split(gaps, {f"{path}/pdf": (is_pdf, None), f"{path}/other": (~is_pdf, None)})
    schema = gaps.schema
    pdf = read_csv_table(spark, f"{path}/pdf", schema).withColumn("part", F.lit("pdf"))
    return pdf.unionByName(read_csv_table(spark, f"{path}/other", schema).withColumn("part", F.lit("other")))


def _empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report without rows still has its header."""
    path = scratch_dir(spark, "empty")
    registry = tables(spark, sf_dir, "dataset_registry")["dataset_registry"]
    write_report(registry.filter(F.col("dataset") == "no such dataset"), path)
    return read_csv_table(spark, path, TABLES["dataset_registry"])


def _page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup written as pages of JSON objects, one page for each 1000 row ids."""
    path = scratch_dir(spark, "record-pages")
    lookup = tables(spark, sf_dir, "lookup")["lookup"]
    paged = lookup.withColumn("page", F.floor(F.col("rowid") / 1000)).repartition("page")
    paged.write.partitionBy("page").option("ignoreNullFields", False).json(path)
    return read_pages(spark, f"{path}/page=*", TABLES["lookup"], "records", lines=True)


def _page_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The resources of datasets written as CSV pages, one for each 1000 row ids, and read back with their types."""
    path = scratch_dir(spark, "csv-pages")
    rows = tables(spark, sf_dir, "resource_dataset")["resource_dataset"]
    paged = rows.withColumn("page", F.floor(F.col("rowid") % 16000 / 1000)).repartition("page")
    paged.write.partitionBy("page").option("header", True).csv(path)
    return read_pages(spark, f"{path}/page=*", TABLES["resource_dataset"], "csv")


def _owner_distincts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct endpoints, resources and collections of each organisation, unknown ones counted as one."""
    history = tables(spark, sf_dir, "historic_endpoint")["historic_endpoint"]
    names = {"endpoint": "endpoints", "resource": "resources", "organisation_name": "names"}
    return group_distinct(history, ["dataset", "organisation"], names)


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = tables(spark, sf_dir, "historic_endpoint")["historic_endpoint"]
    return history.select("rowid", "endpoint", "endpoint_entry_date")


def _newest() -> list:
    return [F.desc("endpoint_entry_date"), F.col("rowid")]


def _page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second page of 1000 endpoint rows, newest first."""
    return page(_history(spark, sf_dir), _newest(), 1000, 1)


def _page_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last page of 700 endpoint rows, from a stored order."""
    path = scratch_dir(spark, "ordered")
    store_ordered(_history(spark, sf_dir), _newest(), path)
    return read_page(spark, path, 700, page_count(spark, path, 700) - 1)


def _page_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All endpoint rows with the number of their page of 700."""
    path = scratch_dir(spark, "ordered")
    store_ordered(_history(spark, sf_dir), _newest(), path)
    return page_numbers(spark, path, 700)


def _written_pair(reports: Callable[..., dict[str, DataFrame]], measures: dict[str, str], *names: str, **options) -> Query:
    """Reports of one run written to their sinks, and read back for a line of totals by report and group.

    ``measures`` has SQL for the group and the measure of each report.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = scratch_dir(spark, "reports")
        made = reports(tables(spark, sf_dir, *names), **options)
        write_reports(made, folder)
        lines = []
        for name, df in made.items():
            group, measure = measures[name]
            back = read_csv_table(spark, f"{folder}/{name}", df.schema)
            lines.append(
                back.groupBy(F.expr(group).cast("string").alias("part")).agg(
                    F.lit(name).alias("report"), F.count(F.lit(1)).alias("n"), F.expr(measure).cast("bigint").alias("measure")
                )
            )
        return reduce(DataFrame.unionByName, lines).select("report", "part", "n", "measure")

    return run


_PROVISION = ["endpoint", "source", "organisation", "resource_endpoint", "resource_dataset", "provision"]


def _provision_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return tables(spark, sf_dir, *_PROVISION)


_STATUS = ["provision", "cohort", "organisation", "latest_endpoint"]
_ISSUE = ["provision", "cohort", "organisation", "issue_summary", "endpoint_dataset_summary"]
_DUPLICATES = ["expectation", "entity", "organisation", "lookup", "provision"]
_DOCUMENTATION = ["endpoint", "source", "source_pipeline", "organisation"]
_FAILED = ["converted_resource", "resource", "resource_endpoint", "endpoint", "source", "url_probe"]
_QUALITY = [
    "issue_type",
    "provision_rule",
    "quality",
    "historic_endpoint",
    "issue_summary",
    "organisation",
    "entity",
]
_LPA_QUALITY = [*_QUALITY, "provision", "expectation", "planning_authority"]
_CONFORMANCE = [
    "field_summary",
    "latest_endpoint",
    "endpoint_dataset_summary",
    "provision",
    "cohort",
    "organisation",
    "issue_summary",
    "specification",
]
_COUNTS = ["historic_endpoint", "dataset_resource", "entity", "organisation"]


def queries() -> dict[str, Query]:
    return {
        "logs_by_week": _report(plans.logs_by_week, "log", as_of=LOG_DAY),
        "operational_issues": _report(plans.operational_issues, "operational_issue", as_of=LOG_DAY),
        "runaway_resources": _report(
            plans.runaway_resources, views={"historic_endpoint": "resource_history"}, as_of=HISTORY_DAY
        ),
        "ended_orgs_active_endpoints": _report(
            plans.ended_orgs_active_endpoints, "organisation", "historic_endpoint"
        ),
        "entities_with_ended_orgs": _report(plans.entities_with_ended_orgs, "entity", "organisation"),
        "dataset_slugs": lambda spark, d: dataset_slugs(tables(spark, d, "dataset_registry")["dataset_registry"]),
        "odp_status": _report(plans.odp_status, *_STATUS),
        "plan_status": _report(plans.plan_status, *_STATUS),
        "odp_issue": _report(plans.odp_issue, *_ISSUE),
        "plan_issue": _report(plans.plan_issue, *_ISSUE),
        "listed_building_end_date": _report(
            plans.listed_building_end_date, "listed_building", "listed_building_outline", "organisation"
        ),
        "deleted_entities": _report(plans.deleted_entities, "expectation", "entity", "organisation"),
        "duplicate_pairs": _report(plans.duplicate_pairs, *_DUPLICATES),
        "duplicate_pairs_geo": _report(plans.duplicate_pairs_geo, *_DUPLICATES),
        "endpoints_documentation": _report(plans.endpoints_documentation, *_DOCUMENTATION),
        "documentation_stats": _report(plans.documentation_stats, *_DOCUMENTATION),
        "documentation_top": _report(plans.documentation_top, *_DOCUMENTATION, k=3),
        "endpoints_no_provision": _report(plans.endpoints_no_provision, *_PROVISION),
        "endpoints_pdf_only": _report(plans.endpoints_pdf_only, *_PROVISION),
        "flagged_failed_resources": _report(plans.flagged_failed_resources, *_FAILED, newest=100),
        "flagged_failed_resources_all": _report(plans.flagged_failed_resources, *_FAILED),
        "resource_detailed_counts": _report(plans.resource_detailed_counts, *_COUNTS),
        "resource_vs_platform": _report(plans.resource_vs_platform, *_COUNTS),
        "dataset_scope": _report(plans.dataset_scope, "provision_rule"),
        "authoritative_lookup": _report(
            plans.authoritative_lookup, "entity", "quality", "organisation", "historic_endpoint"
        ),
        "quality_single_source": _report(
            plans.quality_single_source, *_QUALITY, as_of=ENDPOINT_DAY, criteria=CRITERIA
        ),
        "quality_scores": _report(plans.quality_scores, *_LPA_QUALITY),
        "quality_detail": _report(plans.quality_detail, *_LPA_QUALITY, criteria=LPA_CRITERIA),
        "conformance": _plain_number_column(_report(plans.conformance, *_CONFORMANCE)),
        "conformance_display": _plain_number_column(_report(plans.conformance_display, *_CONFORMANCE)),
        "conformance_headed": lambda spark, d: _report(plans.conformance_headed, *_CONFORMANCE)(spark, d).withColumnRenamed(
            "Endpoint No.", "Endpoint No"
        ),
        "resource_reports": _written_pair(plans.resource_reports, RESOURCE_TOTALS, *_COUNTS),
        "quality_reports": _written_pair(plans.quality_reports, QUALITY_TOTALS, *_LPA_QUALITY, criteria=LPA_CRITERIA),
        "conformance_reports": _written_pair(plans.conformance_reports, CONFORMANCE_TOTALS, *_CONFORMANCE),
        "conformance_overview": _report(plans.conformance_overview, *_CONFORMANCE),
        "conformance_full_match": _report(plans.conformance_full_match, *_CONFORMANCE),
        "issue_fields": _report(plans.issue_fields, "issue_summary", "specification"),
        "export_table": _export,
        "io_roundtrip_csv": _csv_strings,
        "io_roundtrip_json": _json,
        "io_pages": _pages,
        "io_entities": _ragged,
        "io_ragged_union": _union,
        "io_split": _split,
        "io_empty": _empty,
        "io_pages_records": _page_records,
        "io_pages_csv": _page_csv,
        "owner_distincts": _owner_distincts,
        "page": _page,
        "page_last": _page_last,
        "page_numbers": _page_numbers,
    }
