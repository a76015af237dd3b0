"""Endpoint monitoring: documentation, provisions, failures, runaways and ended suppliers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    as_of_column,
    days_ago,
    ends_with_ci,
    first_match,
    join_code,
    json_value,
    strip_prefix,
    to_day,
    true_only,
    yes_no,
)
from ..operators import (
    active,
    covers_days,
    dedupe,
    dedupe_by_id,
    ended,
    first_non_null,
    in_set,
    inner_on,
    latest,
    left_many,
    left_on,
    missing,
    missing_in,
    missing_stats,
    sort_desc,
    spread_join,
    timestamp_of,
    top_groups,
)
from ..sources import materialise
from .constants import (
    DOCUMENT_LINKS,
    DOCUMENT_TYPES,
    JSON_REFUSAL,
    KNOWN_PDF,
    NAMED_IN_URL,
    PDF_FINDING,
    PDF_URLS,
    TEXT_REFUSAL,
    WRONG_TYPE,
    XLS_FINDING,
    ZIP_FINDING,
)

# --- documentation -----------------------------------------------------------------------------


def endpoint_catalogue(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Endpoints with source, pipeline and organisation, by inner joins."""
    endpoint = tables["endpoint"].select("endpoint", "endpoint_url")
    source = tables["source"].select(
        "source", "endpoint", "organisation", "documentation_url", "entry_date", "end_date"
    )
    pipeline = tables["source_pipeline"].select("source", F.col("pipeline").alias("pipeline/dataset"))
    organisation = tables["organisation"].select("organisation", "name")
    joined = inner_on(inner_on(source, endpoint, ["endpoint"]), pipeline, ["source"])
    return inner_on(joined, organisation, ["organisation"])


def endpoints_documentation(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All endpoints, newest first by the text of their date, flagged where documentation is missing
    and where the source is active."""
    catalogue = endpoint_catalogue(tables)
    rows = sort_desc(catalogue, "entry_date", ["endpoint", "organisation", "`pipeline/dataset`"])
    return rows.select(
        "name",
        "organisation",
        "pipeline/dataset",
        "endpoint_url",
        "documentation_url",
        timestamp_of(rows, "entry_date").alias("entry_date"),
        "end_date",
        "endpoint",
        missing(rows, "documentation_url").alias("documentation_missing"),
        missing(rows, "end_date").alias("is_active"),
    )


def documentation_stats(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row of counts over :func:`endpoints_documentation`."""
    rows = endpoint_catalogue(tables)
    gap = missing(rows, "documentation_url")
    is_active = missing(rows, "end_date")
    counted = rows.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(gap).alias("missing_count"),
        F.count_if(gap & is_active).alias("active_missing"),
        F.count_if(gap & ~is_active).alias("ended_missing"),
        to_day(F.max(F.when(gap, timestamp_of(rows, "entry_date")))).alias("most_recent_missing_entry_date"),
    )
    percent = F.round(missing_stats(F.col("total"), F.col("missing_count")), 2)
    return counted.select(
        "total",
        "missing_count",
        percent.alias("percent_missing"),
        "active_missing",
        "ended_missing",
        "most_recent_missing_entry_date",
    )


def documentation_top(tables: Mapping[str, DataFrame], k: int = 10) -> DataFrame:
    """The pipelines with most endpoints lacking documentation."""
    rows = endpoint_catalogue(tables)
    return top_groups(rows.filter(missing(rows, "documentation_url")), "pipeline/dataset", k, "missing_count")


# --- provisions --------------------------------------------------------------------------------


def endpoints_without_provision(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Active endpoints whose dataset and organisation no provision asks for.

    Codes are reduced to the part after the prefix, then matched by organisation name, as provisions
    and sources may use different prefixes. Unknown organisations match each other.
    """
    # The endpoint code is the key of its table: one row per endpoint on this side.
    endpoint = active(tables["endpoint"]).select("endpoint", "endpoint_url")
    source = tables["source"].select(
        "endpoint", "source", "collection", strip_prefix(F.col("organisation")).alias("organisation_ref")
    )
    organisation = active(tables["organisation"]).select(
        F.col("name").alias("organisation"), F.col("reference").alias("organisation_ref")
    )
    newest_resource = dedupe_by_id(tables["resource_endpoint"], ["endpoint"], "rowid", "last").drop("rowid")
    newest_dataset = dedupe_by_id(tables["resource_dataset"], ["resource"], "rowid", "last").drop("rowid")
    provided = (
        tables["provision"]
        .select("dataset", strip_prefix(F.col("organisation")).alias("organisation_ref"))
        .distinct()
    )
    provided = left_on(provided, organisation, ["organisation_ref"], null_safe=True)

    # Each endpoint's dataset is looked up while there is one row for each; then its sources take it over. An endpoint without any
    # resource has the dataset of the unknown resource.
    newest_resource = materialise(newest_resource, "endpoint-resources")
    traced = spread_join(newest_resource, newest_dataset, ["resource"], "left", null_safe=True)
    traced = traced.select("endpoint", "dataset", F.lit(True).alias("is_traced"))
    unknown = newest_dataset.filter(F.col("resource").isNull()).agg(F.max("dataset").alias("dataset")).scalar()
    owned = left_on(left_many(endpoint, source, ["endpoint"]), traced, ["endpoint"])
    owned = owned.withColumn("dataset", F.when(F.col("is_traced"), F.col("dataset")).otherwise(unknown)).drop("is_traced")
    named = left_on(owned, organisation, ["organisation_ref"], null_safe=True)
    gaps = missing_in(named, provided, ["dataset", "organisation"])
    return gaps.select("endpoint", "source", "collection", "endpoint_url", "organisation", "dataset")


def is_pdf_link() -> Column:
    return ends_with_ci(F.col("endpoint_url"), ".pdf")


def endpoints_no_provision(tables: Mapping[str, DataFrame], include_pdf: bool = True) -> DataFrame:
    gaps = endpoints_without_provision(tables)
    return gaps if include_pdf else gaps.filter(~is_pdf_link())


def endpoints_pdf_only(tables: Mapping[str, DataFrame]) -> DataFrame:
    return endpoints_without_provision(tables).filter(is_pdf_link())


# --- failed resources --------------------------------------------------------------------------


def _finding(group: str | None, details: str) -> Column:
    return F.struct(F.lit(group).cast("string").alias("group"), F.lit(details).alias("details"))


def probe_findings(url_probe: DataFrame) -> DataFrame:
    """What each captured probe says about its URL, one row per URL.

    The answers are read off the page bodies where they lie, so that no body has to be shuffled.
    """
    content_type = F.coalesce(F.lower("content_type"), F.lit(""))
    body = F.lower("body")
    is_json = content_type.startswith("application/json")
    refused = (F.trim(json_value(F.col("body"), "$.error.code")) == "499") | F.lower(
        json_value(F.col("body"), "$.error.message")
    ).contains("token")
    findings = url_probe.select(
        F.trim("url").alias("probe_url"),
        true_only(F.lower("head_content_type").contains("application/pdf")).alias("is_pdf"),
        true_only(is_json & refused).alias("refused_json"),
        true_only(~is_json & body.contains("token required")).alias("refused_text"),
        true_only(
            (F.col("status") == 200) & body.contains("serviceexception") & body.contains("feature")
        ).alias("refused_feature"),
    )
    return dedupe(findings, ["probe_url"], ["is_pdf", "refused_json", "refused_text", "refused_feature"], "last")


def classify_failed(df: DataFrame) -> DataFrame:
    """Why a resource failed, from its URL and the findings of a probe; adds ``group`` and ``details``.

    Rules are tried in order and the first that applies wins. They look for parts of the URL, so a
    ``.docx`` link is reported by the earlier rule for ``.doc``.
    """
    url = F.lower(F.coalesce(F.trim("endpoint_url"), F.lit("")))
    by_name = [(".zip", _finding(*ZIP_FINDING))]
    for lead, how in NAMED_IN_URL:
        for kind in DOCUMENT_TYPES:
            finding = _finding(*XLS_FINDING) if kind == "xls" else _finding(DOCUMENT_LINKS, f"{kind} {how}")
            by_name.append((lead + kind, finding))

    asks_feature = url.contains("getfeature") | url.contains("wfs")
    by_probe = (
        F.when(F.col("is_pdf"), _finding(*PDF_FINDING))
        .when(F.col("refused_json"), _finding(*JSON_REFUSAL))
        .when(F.col("refused_text"), _finding(*TEXT_REFUSAL))
        .when(asks_feature & F.col("refused_feature"), _finding(*WRONG_TYPE))
        .otherwise(_finding(None, ""))
    )
    found = first_match(url, by_name, by_probe)
    known_pdf = F.col("endpoint_url").isin(PDF_URLS)
    patched = F.when(known_pdf, _finding(*KNOWN_PDF)).otherwise(found)
    return df.withColumn("__found", patched).select(*df.columns, "__found.*")


def failed_resources(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Resources that failed to convert and have not ended."""
    failed = tables["converted_resource"].filter(F.col("status") == "failed").select("resource", "dataset")
    current = active(tables["resource"]).select("resource", "start_date")
    return inner_on(failed, current, ["resource"])


def flagged_failed_resources(tables: Mapping[str, DataFrame], newest: int | None = None) -> DataFrame:
    """All failed resources, or the ``newest`` so many, classified, with advice on retiring.

    The probes it consults are captured beforehand in ``url_probe``.
    """
    failed = failed_resources(tables)
    chosen = failed if newest is None else latest(failed, "start_date", newest, ["resource", "dataset"])
    newest_endpoint = dedupe_by_id(tables["resource_endpoint"], ["resource"], "rowid", "last").drop("rowid")
    traced = materialise(left_on(chosen, newest_endpoint, ["resource"], null_safe=True), "failed-resources")

    # A failure is explained per endpoint, however many of its resources failed.
    endpoint = in_set(tables["endpoint"].select("endpoint", "endpoint_url"), traced, ["endpoint"], null_safe=True)
    addressed = endpoint.withColumn("probe_url", F.trim("endpoint_url"))
    probed = spread_join(addressed, probe_findings(tables["url_probe"]), ["probe_url"], "left")
    newest_source = dedupe_by_id(
        tables["source"].select("rowid", "endpoint", "source", "collection"), ["endpoint"], "rowid", "last"
    ).drop("rowid")
    sourced = left_on(classify_failed(probed), newest_source, ["endpoint"], null_safe=True)

    report = spread_join(traced, sourced, ["endpoint"], "left", null_safe=True)
    unknown = report.withColumn("details", F.coalesce("details", F.lit("")))
    flagged = unknown.withColumn("recommend_retirement", yes_no(F.col("group") == DOCUMENT_LINKS))
    return flagged.select(
        "resource", "source", "collection", "endpoint_url", "group", "details", "recommend_retirement"
    )


# --- runaway endpoints -------------------------------------------------------------------------


def runaway_resources(tables: Mapping[str, DataFrame], as_of: dt.date | None = None) -> DataFrame:
    """Active endpoints with more than one resource, and signs that they make too many.

    Every measure is an aggregate of one grouping.
    """
    history = active(tables["historic_endpoint"], "endpoint_end_date").dropna(subset=["endpoint"])
    meta = ["organisation_name", "dataset", "collection", "pipeline", "endpoint_entry_date"]
    rows = history.select(
        "rowid",
        "endpoint",
        *meta,
        timestamp_of(history, "resource_start_date", strict=True).alias("start"),
        timestamp_of(history, "resource_end_date", strict=True).alias("end"),
    )
    start, end = F.col("start"), F.col("end")
    summary = rows.groupBy("endpoint").agg(
        to_day(F.min(start)).alias("first_resource_start_date"),
        to_day(F.max(start)).alias("last_resource_start_date"),
        F.count(F.lit(1)).alias("resource_count"),
        *[first_non_null(c, "rowid").alias(c) for c in meta],
        F.count_if(start == end).alias("single_day_resources"),
        yes_no(covers_days(to_day(start), as_of_column(as_of), 7)).alias("daily_for_7_days"),
        yes_no(F.count_if(to_day(start) >= days_ago(as_of, 30)) > 20).alias(">20_instances_in_30_day_period"),
        yes_no(to_day(F.max(end)) < days_ago(as_of, 30)).alias("stale_resource"),
    )
    return sort_desc(summary.filter(F.col("resource_count") > 1), "resource_count", ["endpoint"])


# --- ended suppliers ---------------------------------------------------------------------------


def ended_organisations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Organisations that have ended, with their code. Without a dataset or reference the code is null."""
    return ended(tables["organisation"]).select(
        F.col("name").alias("organisation_name"),
        F.col("entity").alias("organisation_entity"),
        F.col("end_date").alias("organisation_end_date"),
        join_code(F.col("dataset"), ":", F.col("reference")).alias("organisation_code"),
    )


def ended_orgs_active_endpoints(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Endpoints still active although their organisation has ended."""
    history = active(tables["historic_endpoint"], "endpoint_end_date")
    endpoints = history.select(
        F.col("organisation").alias("organisation_code"),
        F.col("dataset").alias("dataset_name"),
        "endpoint_url",
        timestamp_of(history, "endpoint_entry_date").alias("endpoint_entry_date"),
        timestamp_of(history, "endpoint_end_date").alias("endpoint_end_date"),
        F.col("latest_status").alias("status"),
        timestamp_of(history, "latest_log_entry_date").alias("latest_log_entry_date"),
    )
    organisations = ended_organisations(tables).drop("organisation_end_date")
    merged = inner_on(endpoints, organisations, ["organisation_code"], null_safe=True)
    return merged.select(
        "organisation_name",
        "organisation_entity",
        "organisation_code",
        "dataset_name",
        "endpoint_url",
        "endpoint_entry_date",
        "endpoint_end_date",
        "status",
        "latest_log_entry_date",
    )
