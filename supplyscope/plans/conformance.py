"""Conformance: how many of the specified fields each supply provides, and how many without error."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    decile_band,
    fraction,
    is_blank,
    minus_one_to_zero,
    n_of_total,
    percent_label,
    pretty,
    pretty_text,
    recode,
)
from ..operators import (
    array_len,
    band_counts,
    inner_on,
    isin,
    left_on,
    missing_stats,
    number_within,
    row_multiplicity,
    sort_report,
    spec_fields,
    spread_join,
)
from ..sources import Shared, materialise, read_specification, shared
from .constants import AUTO_FIELDS, AUTO_FIELDS_UNLESS_TREE, ODP_DATASETS, SPATIAL_DATASETS
from .supply import cohort_provisions

# Columns of the reports.
_KEYS = [
    "organisation",
    "organisation_name",
    "cohort",
    "dataset",
    "licence",
    "endpoint",
    "endpoint_no.",
    "resource",
    "latest_log_entry_date",
    "cohort_start_date",
]
_CONFORMANCE_COLUMNS = [
    *_KEYS[:-1],
    "field",
    "field_supplied",
    "field_matched",
    "field_errors",
    "field_error_free",
    "field_supplied_pct",
    "field_error_free_pct",
    "field_matched_pct",
]
_DISPLAY_COLUMNS = [
    "cohort",
    "organisation_name",
    "organisation",
    "dataset",
    "licence",
    "endpoint_no.",
    "field_supplied_count",
    "field_supplied_pct",
    "field_matched_count",
    "field_matched_pct",
]

# Bands of the overview.
BAND_EDGES = [0.5, 0.8]
BAND_NAMES = ["< 50%", "50% - 80%", "> 80%"]


def supplier_fields(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(dataset, field) rows of the specification that a supplier can be expected to provide."""
    spec = read_specification(tables["specification"])
    is_tree = F.col("dataset") == "tree"
    added = F.col("field").isin(AUTO_FIELDS) | (~is_tree & F.col("field").isin(AUTO_FIELDS_UNLESS_TREE))
    return spec.filter(~added)


def spec_by_dataset(tables: Mapping[str, DataFrame], datasets: Sequence[str]) -> DataFrame:
    """Expected fields and their number for each dataset: at most one row for each of ``datasets``."""
    fields = isin(supplier_fields(tables), "dataset", datasets)
    # The state of a group is the distinct field names of one dataset's specification.
    return fields.groupBy("dataset").agg(
        F.collect_set("field").alias("spec_fields"), F.count(F.lit(1)).alias("field")
    )


def field_rows(tables: Mapping[str, DataFrame], datasets: Sequence[str]) -> DataFrame:
    """Field summaries of active endpoints, with licence."""
    summary = isin(tables["field_summary"], "pipeline", datasets)
    summary = summary.filter(~is_blank(F.col("resource")))
    state = tables["endpoint_dataset_summary"].filter(F.col("end_date").isNull()).select("endpoint", "dataset")
    licence = tables["latest_endpoint"].select("endpoint", "dataset", "licence")
    # The two small lookups meet first, so the field summaries are shuffled once.
    return spread_join(summary, left_on(state, licence, ["endpoint", "dataset"]), ["endpoint", "dataset"], "inner")


def issue_fields(tables: Mapping[str, DataFrame], datasets: Sequence[str] = tuple(ODP_DATASETS)) -> DataFrame:
    """Issue rows with the specified field they concern.

    Issues of the entity as a whole count against its reference. A field that is not specified for the
    dataset is set to null; the row stays.
    """
    issues = isin(tables["issue_summary"], "pipeline", datasets)
    recoded = issues.withColumn("field", recode(F.col("field"), {"entity": "reference"}))
    spec = spec_by_dataset(tables, datasets).select("dataset", "spec_fields")
    # Safe to broadcast: one row for each of a fixed list of datasets.
    joined = left_on(recoded, F.broadcast(spec), ["dataset"])
    return joined.withColumn("field", keep_if_in_spec(F.col("field"), F.col("spec_fields"))).drop("spec_fields")


def keep_if_in_spec(c: Column, allowed: Column) -> Column:
    return F.when(F.array_contains(allowed, c), c)


def scored_fields(tables: Mapping[str, DataFrame], datasets: Sequence[str] = tuple(ODP_DATASETS)) -> DataFrame:
    """All supplies with their field counts and ratios: one table for all reports of a run."""
    return shared(tables, "scored-fields", tuple(datasets), lambda: _scored_fields(tables, datasets))


def _scored_fields(tables: Mapping[str, DataFrame], datasets: Sequence[str]) -> DataFrame:
    """All supplies with their field counts and ratios.

    Errors are counted per resource, times the number of rows sharing that resource. Rows are numbered
    before those with an unknown key are left out.
    """
    # Numbering and counting each need the rows twice.
    rows = materialise(field_rows(tables, datasets), "field-rows")
    provisions = cohort_provisions(tables, ["organisation"]).select("organisation", "cohort", "cohort_start_date")
    numbered = number_within(rows, ["organisation", "dataset"], "rowid", "endpoint_no.", ["licence"])
    placed = left_on(numbered, provisions, ["organisation", "cohort"], null_safe=True)
    # Safe to broadcast: one row for each of a fixed list of datasets.
    specified = left_on(placed, F.broadcast(spec_by_dataset(tables, datasets)), ["dataset"])

    errors = isin(tables["issue_summary"], "pipeline", datasets).filter(F.col("severity") == "error")
    per_resource = row_multiplicity(rows, errors, "resource", "field_errors")
    counted = spread_join(specified, per_resource, ["resource"], "left", counted=rows.select("resource"))

    matched = array_len(spec_fields(F.col("mapping_field"), F.col("spec_fields")))
    unmatched = array_len(spec_fields(F.col("non_mapping_field"), F.col("spec_fields")))
    facts = counted.select(
        "organisation",
        F.coalesce("organisation_name", F.lit("Unknown")).alias("organisation_name"),
        "cohort",
        "dataset",
        "licence",
        "endpoint",
        F.col("`endpoint_no.`").cast("string").alias("endpoint_no."),
        "resource",
        "latest_log_entry_date",
        F.coalesce(F.col("cohort_start_date").cast("string"), F.lit("")).alias("cohort_start_date"),
        F.coalesce("field", F.lit(0)).cast("bigint").alias("field"),
        (matched + unmatched).cast("bigint").alias("field_supplied"),
        matched.cast("bigint").alias("field_matched"),
        F.coalesce("field_errors", F.lit(0)).cast("bigint").alias("field_errors"),
    )
    # The number within organisation and dataset makes each row its own group: nothing to sum up, but
    # rows with an unknown grouping key are left out.
    known = facts.dropna(subset=[f"`{k}`" for k in _KEYS])
    with_free = known.withColumn(
        "field_error_free", minus_one_to_zero(F.col("field_supplied") - F.col("field_errors")).cast("bigint")
    )
    shares = ["field_supplied", "field_error_free", "field_matched"]
    return with_free.withColumns(
        {f"{c}_count": n_of_total(F.col(c), F.col("field")) for c in shares}
        | {f"{c}_pct": fraction(F.col(c).cast("double"), F.col("field").cast("double")) for c in shares}
    )


_ORDER = ["cohort_start_date", "cohort", "organisation_name", "dataset"]
_TIES = ["organisation", "endpoint_no."]


def conformance(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Field counts, errors and ratios for every supply of a cohort member."""
    scored = scored_fields(tables).filter(~is_blank(F.col("cohort")))
    ordered = sort_report(scored, _ORDER, _TIES)
    return ordered.select(*[F.col(f"`{c}`") for c in _CONFORMANCE_COLUMNS])


def conformance_display(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The table as shown to readers: ratios as whole percentages, with the band that colours them."""
    shown = sort_report(scored_fields(tables), _ORDER, _TIES)
    cells = []
    for c in _DISPLAY_COLUMNS:
        col = F.col(f"`{c}`")
        cells.append((percent_label(col) if c.endswith("_pct") else pretty_text(col)).alias(c))
    bands = [decile_band(F.col(f"{c}_pct")).alias(f"{c}_band") for c in ("field_supplied", "field_matched")]
    return shown.select(*cells, *bands)


def conformance_headed(tables: Mapping[str, DataFrame]) -> DataFrame:
    """:func:`conformance_display` under the headings that readers see, without the bands."""
    shown = conformance_display(tables)
    return shown.select(*[F.col(f"`{c}`").alias(pretty(c)) for c in _DISPLAY_COLUMNS])


def conformance_overview(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Supplies per band of fields supplied, for each area dataset."""
    return band_counts(
        scored_fields(tables), "dataset", "field_supplied_pct", BAND_EDGES, BAND_NAMES, SPATIAL_DATASETS
    )


def conformance_full_match(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Percentage of supplies that match every specified field."""
    counted = scored_fields(tables).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("field_matched_pct") == 1.0).alias("full")
    )
    return counted.select(
        F.bround(missing_stats(F.col("total"), F.col("full")), 1).alias("percent_100_field_match")
    )


def conformance_reports(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All reports of one run, by name. Supplies are scored once."""
    tables = Shared(tables)
    reports = (conformance, conformance_display, conformance_overview, conformance_full_match)
    return {r.__name__: r(tables) for r in reports}
