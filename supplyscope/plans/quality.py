"""Quality of supply: levels 0 to 6 per organisation and dataset, and the criteria behind them.

The reports need, for each supply, only which criteria failed and the worst severity. So the two large
inputs are reduced before they meet: historic endpoints to one row per supply and resource, issues to
one row per resource and criterion.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import age_days, bool_text, cap, join_code, like_ci
from ..operators import (
    active,
    criteria_flags,
    distinct_values,
    exclude,
    exists_flag,
    fill_pivot,
    group_any,
    grouped,
    in_set,
    inner_on,
    isin,
    left_on,
    map_column,
    minus,
    missing,
    missing_in,
    order_columns,
    pivot_labels,
    sort_report,
    sorted_distinct,
    union_all,
)
from ..sources import Shared, materialise, shared
from .constants import (
    AUTHORITATIVE_STEP,
    BOUNDARY_CRITERION,
    COUNT_CRITERION,
    COUNT_EXPECTATION,
    EXPECTATION_LEVEL,
    LPA_ROLE,
    NO_ISSUE_SEVERITY,
    ODP_DATASETS,
    ODP_PROJECT,
    QUALITY_LABELS,
    READY_LEVEL,
    SPATIAL_DATASETS,
    STALE_AFTER_DAYS,
    STALE_RUNG,
    UNSCORED_ORGANISATION,
)

_SUPPLY = ["pipeline", "organisation"]
_OWNER = ["pipeline", "organisation", "organisation_name"]
_CHECKS = ["is_authoritative", "authoritative_check_available", "has_zero_entities"]
_SCORED = ["lpa_code", *_OWNER]


# --- scope -------------------------------------------------------------------------------------


def _mandated(rules: DataFrame) -> DataFrame:
    for_lpas = (F.col("provision_reason") == "encouraged") & (F.col("role") == LPA_ROLE)
    return sorted_distinct(rules.filter((F.col("provision_reason") == "statutory") | for_lpas), "dataset")


def dataset_scope(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Which datasets each quality report covers, as (scope, dataset).

    Mandated datasets are statutory, or encouraged for planning authorities. Single-source datasets
    are those of any rule that are neither mandated nor part of the ODP project.
    """
    rules = tables["provision_rule"]
    mandated = _mandated(rules)
    odp = rules.filter(F.col("project") == ODP_PROJECT).select("dataset")
    single = minus(minus(rules.select("dataset").dropna(), odp), mandated)
    return union_all(
        mandated.select(F.lit("mandated").alias("scope"), "dataset"),
        single.select(F.lit("single-source").alias("scope"), "dataset"),
    )


def detail_datasets(tables: Mapping[str, DataFrame]) -> list[str]:
    """Datasets of the scores and detail reports. They become columns, so the rules are read here."""
    return sorted({*ODP_DATASETS, *distinct_values(_mandated(tables["provision_rule"]), "dataset")})


def single_source_datasets(tables: Mapping[str, DataFrame]) -> list[str]:
    return distinct_values(dataset_scope(tables).filter(F.col("scope") == "single-source"), "dataset")


# --- inputs ------------------------------------------------------------------------------------


def scored_organisations(tables: Mapping[str, DataFrame]) -> DataFrame:
    named = exclude(tables["organisation"], "name", UNSCORED_ORGANISATION)
    return named.select(
        F.col("entity").alias("organisation_entity"),
        F.col("name").alias("organisation_name"),
        "organisation",
        "end_date",
        F.col("local_planning_authority").alias("lpa_code"),
    )


def live_lpas(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Planning authorities with a boundary, and the organisations that have not ended."""
    authority = tables["planning_authority"].filter(F.col("geometry").isNotNull())
    codes = authority.select(F.col("reference").alias("lpa_code")).distinct()
    return inner_on(
        active(scored_organisations(tables)).select("lpa_code", "organisation", "organisation_name"), codes, ["lpa_code"]
    ).distinct()


def current_endpoints(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Endpoint rows in use: neither endpoint nor resource ended, and last collected successfully."""
    collected = tables["historic_endpoint"].filter(F.col("latest_status") == 200)
    return active(active(collected, "endpoint_end_date"), "resource_end_date")


def supplied_resources(
    tables: Mapping[str, DataFrame], datasets: Sequence[str] | None = None, as_of: dt.date | None = None
) -> DataFrame:
    """Current, successfully collected resources, of some pipelines or of all: one row per supply and
    resource, with the resource's greatest age."""
    current = current_endpoints(tables)
    if datasets is not None:
        current = isin(current, "pipeline", datasets)
    return current.groupBy(
        "collection", "pipeline", "organisation", F.col("name").alias("organisation_name"), "resource"
    ).agg(F.max(age_days(F.col("resource_start_date"), as_of)).alias("resource_age_days"))


def criterion_of(issue_type: DataFrame) -> DataFrame:
    """Issue types with the criterion they count against."""
    criterion = join_code(F.col("quality_criteria_level"), " - ", F.col("quality_criteria"))
    return issue_type.select(
        "issue_type",
        criterion.alias("quality_criteria"),
        F.col("quality_criteria_level").alias("quality_level"),
    )


def issue_marks(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Criteria that each resource fails. Issues of unknown or unrated type leave no mark."""
    rated = criterion_of(tables["issue_type"]).filter(F.col("quality_level").isNotNull())
    # The types are a short list, so this join leaves the issues where they are and thins them out
    # before the one shuffle.
    found = inner_on(tables["issue_summary"].select("resource", "issue_type"), rated, ["issue_type"])
    return found.select("resource", "quality_criteria", "quality_level").distinct()


def expectation_marks(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Failed expectations of live planning authorities, as marks against two fixed criteria."""
    # The first name does not contain the second's text, so a row counts against one of them.
    is_count = F.col("name") == COUNT_EXPECTATION
    is_outside = like_ci(F.col("name"), "%outside%") & ~like_ci(F.col("message"), "%error%")
    failed = tables["expectation"].filter((F.col("passed") == "False") & (is_count | is_outside))
    marks = failed.select(
        "organisation",
        F.when(is_count, "conservation-area").otherwise(F.col("dataset")).alias("pipeline"),
        F.when(is_count, COUNT_CRITERION).otherwise(F.lit(BOUNDARY_CRITERION)).alias("quality_criteria"),
        F.lit(EXPECTATION_LEVEL).alias("quality_level"),
    ).distinct()
    return inner_on(marks, live_lpas(tables), ["organisation"])


# --- rules -------------------------------------------------------------------------------------


def entity_ratings(
    tables: Mapping[str, DataFrame], pipelines: DataFrame, datasets: Sequence[str] | None = None
) -> DataFrame:
    """Per pipeline and organisation: whether any entity is of authoritative quality or better.

    Null where no entity has a known quality. Only the given pipelines are looked at; ``datasets``, a
    list that holds them all, lets the scan skip the entities of others.
    """
    quality = tables["quality"].select("quality", "priority")
    authoritative = quality.filter(F.col("quality") == "authoritative").select("priority").scalar()
    entity = tables["entity"] if datasets is None else isin(tables["entity"], "dataset", datasets)
    owned = entity.filter(~missing(entity, "organisation_entity")).select(
        F.col("dataset").alias("pipeline"), "organisation_entity", "quality"
    )
    # Reduced to distinct qualities per supply before anything is looked up.
    qualities = owned.groupBy("pipeline", "organisation_entity", "quality").agg(F.count(F.lit(1)).alias("n"))
    rated = left_on(in_set(qualities, pipelines, ["pipeline"]), quality, ["quality"])
    return group_any(
        rated, ["pipeline", "organisation_entity"], F.col("priority") >= authoritative, "is_authoritative"
    )


def _with_codes(ratings: DataFrame, organisations: DataFrame) -> DataFrame:
    names = organisations.select("organisation_entity", "organisation", "organisation_name")
    return left_on(ratings, names, ["organisation_entity"])


def authoritative_rows(ratings: DataFrame, organisations: DataFrame) -> DataFrame:
    """Supplies whose entities were rated, with the answer. Others are absent: not checked."""
    checked = _with_codes(ratings.filter(F.col("is_authoritative").isNotNull()), organisations)
    return checked.select(*_OWNER, "is_authoritative", F.lit(True).alias("authoritative_check_available"))


def authoritative_lookup(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The authoritative answers for all pipelines with a current, collected endpoint."""
    pipelines = current_endpoints(tables).select("pipeline").distinct()
    return authoritative_rows(entity_ratings(tables, pipelines), scored_organisations(tables))


def label_of(level: Column) -> Column:
    return map_column(level.cast("int"), QUALITY_LABELS)


def with_levels(summary: DataFrame, ratings: DataFrame, organisations: DataFrame) -> DataFrame:
    """Add the level to supplies that carry ``severity_level``.

    The rung is one below the worst severity (no issue counts as severity 4); authoritative supplies
    stand three levels higher. A supply without entities has level 0, if its pipeline has any entities
    to look at.
    """
    checked = authoritative_rows(ratings, organisations).drop("organisation_name")
    joined = left_on(summary, checked, _SUPPLY, null_safe=True)
    present = _with_codes(ratings, organisations)
    joined = exists_flag(joined, present, _SUPPLY, "__has_entities", null_safe=True)
    joined = exists_flag(joined, ratings, ["pipeline"], "__queryable")

    rung = F.coalesce(F.col("severity_level"), F.lit(NO_ISSUE_SEVERITY)) - 1
    is_authoritative = F.coalesce(F.col("is_authoritative"), F.lit(False))
    zero = F.col("__queryable") & ~F.col("__has_entities")
    level = F.when(zero, F.lit(0)).when(is_authoritative, rung + AUTHORITATIVE_STEP).otherwise(rung)
    return joined.withColumns(
        {
            "quality_level": level,
            "is_authoritative": is_authoritative,
            "authoritative_check_available": F.coalesce(F.col("authoritative_check_available"), F.lit(False)),
            "has_zero_entities": zero,
        }
    ).drop("severity_level", "__has_entities", "__queryable")


def staleness_cap(level: Column, is_authoritative: Column, is_stale: Column) -> Column:
    """A stale supply keeps at most rung 2 of its branch; level 0 stays."""
    step = F.when(is_authoritative, F.lit(AUTHORITATIVE_STEP)).otherwise(F.lit(0))
    return F.when(is_stale & (level > 0), cap(level - step, STALE_RUNG) + step).otherwise(level)


def readiness(levels: DataFrame, area_datasets: Sequence[str] = tuple(SPATIAL_DATASETS)) -> DataFrame:
    """Organisations that supply all area datasets at an authoritative level.

    It counts rows, so a dataset supplied under two names counts twice.
    """
    rows = levels.filter(F.col("pipeline").isin(list(area_datasets)))
    counted = grouped(
        rows, ["organisation"], F.count("pipeline").alias("n"), F.min("quality_level").alias("least")
    )
    ready = (F.col("n") == len(area_datasets)) & (F.col("least") >= READY_LEVEL)
    return counted.select("organisation", F.when(ready, "yes").otherwise("no").alias("ready_for_ODP_adoption"))


# --- reports -----------------------------------------------------------------------------------


def _flag_texts(criteria: Sequence[str]) -> dict[str, Column]:
    """Criteria columns as TRUE where the issue occurred, the checks as they are."""
    texts = {c: bool_text(F.col(f"`{c}`"), invert=True) for c in criteria}
    return texts | {c: bool_text(F.col(c)) for c in _CHECKS}


def supply_summary(marks: DataFrame, keys: Sequence[str], criteria: Sequence[str], *extra: Column) -> DataFrame:
    """One row per supply with all that the reports need of its marks. Written once, used several times."""
    summary = marks.groupBy(*keys).agg(
        F.min("quality_level").alias("severity_level"),
        *criteria_flags("quality_criteria", "quality_level", criteria),
        *extra,
    )
    return materialise(summary, "supply-summary")


def only_listed(marks: DataFrame, criteria: Sequence[str] | None) -> DataFrame:
    """The same rows; the job stops, naming it, at a mark against a criterion that is not listed."""
    if criteria is None:
        return marks
    named = F.col("quality_criteria")
    stop = F.raise_error(F.concat(F.lit("criterion is not listed: "), named)).cast("boolean")
    return marks.filter(F.when(named.isNotNull() & ~named.isin(list(criteria)), stop).otherwise(F.lit(True)))


def criteria_matrix(summary: DataFrame, criteria: Sequence[str]) -> DataFrame:
    """One row per owner; a criterion holds if it holds in all of the owner's summary rows, or if the owner's
    pipeline, organisation or name is unknown."""
    if not criteria:
        return summary.select(*_OWNER).distinct()
    # Issues are counted by owner, and counting leaves out owners of which a key is unknown.
    unknown = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in _OWNER])
    return summary.groupBy(*_OWNER).agg(*[(F.bool_and(f"`{c}`") | F.first(unknown)).alias(c) for c in criteria])


def quality_single_source(
    tables: Mapping[str, DataFrame], as_of: dt.date | None = None, criteria: Sequence[str] | None = None
) -> DataFrame:
    """Criteria and level of each supply of the single-source datasets.

    ``criteria`` lists the criterion columns, and an issue against another stops the job; without it those
    that occur are looked up first.
    """
    datasets = single_source_datasets(tables)
    resources = supplied_resources(tables, datasets, as_of)
    marked = only_listed(left_on(resources, issue_marks(tables), ["resource"]), criteria)
    names = list(criteria) if criteria is not None else distinct_values(marked, "quality_criteria")
    oldest = F.max("resource_age_days").alias("resource_age_days")
    summary = supply_summary(marked, ["collection", *_OWNER], names, oldest)

    # Used for three checks.
    ratings = materialise(entity_ratings(tables, summary.select("pipeline"), datasets), "entity-ratings")
    levels = with_levels(
        summary.select("collection", *_OWNER, "severity_level"), ratings, scored_organisations(tables)
    )
    ages = grouped(summary, _SUPPLY, oldest, dropna=False)
    levels = left_on(levels, ages, _SUPPLY, null_safe=True)
    is_stale = F.coalesce(F.col("resource_age_days") > STALE_AFTER_DAYS, F.lit(False))
    capped = staleness_cap(F.col("quality_level"), F.col("is_authoritative"), is_stale)
    known_supply = F.col("pipeline").isNotNull() & F.col("organisation").isNotNull()
    levels = levels.select(
        *_SUPPLY,
        *_CHECKS,
        F.when(known_supply, F.col("resource_age_days")).alias("resource_age_days"),
        is_stale.alias("is_stale"),
        label_of(capped).alias("quality_level_label"),
    )
    report = _attach(criteria_matrix(summary, names), levels, [*_CHECKS, "resource_age_days", "is_stale"])
    texts = _flag_texts(names) | {"is_stale": bool_text(F.col("is_stale"))}
    return order_columns(
        report.withColumns(texts), [*_OWNER, *names, *_CHECKS, "resource_age_days", "is_stale"], ["quality_level_label"]
    )


def _attach(matrix: DataFrame, levels: DataFrame, checks: Sequence[str]) -> DataFrame:
    """Criteria rows with each label of their supply, and each distinct set of checks.

    The two are looked up separately: a supply scored under two names gets every combination.
    """
    labelled = left_on(matrix, levels.select(*_SUPPLY, "quality_level_label"), _SUPPLY, null_safe=True)
    return left_on(labelled, levels.select(*_SUPPLY, *checks).distinct(), _SUPPLY, null_safe=True)


def _odp_provisions(tables: Mapping[str, DataFrame]) -> DataFrame:
    odp = tables["provision"].filter(F.col("project") == ODP_PROJECT)
    return odp.select("organisation", F.col("dataset").alias("pipeline"), "cohort", "start_date")


def _named_provisions(tables: Mapping[str, DataFrame], columns: Sequence[str]) -> DataFrame:
    names = scored_organisations(tables).select("organisation", "organisation_name").distinct()
    provisions = _odp_provisions(tables).select(*columns).distinct()
    return left_on(provisions, names, ["organisation"], null_safe=True).distinct()


def scored_marks(tables: Mapping[str, DataFrame], datasets: Sequence[str] | None = None) -> DataFrame:
    """Marks of all supplies, of some datasets or of all, with the planning authority's code.

    ``has_endpoint`` tells marks of a current endpoint from those of an expectation.
    """
    codes = live_lpas(tables).select("lpa_code", "organisation").distinct()
    marked = left_on(supplied_resources(tables, datasets), issue_marks(tables), ["resource"])
    # Down to distinct marks per supply before the code is looked up.
    distinct_marks = marked.select(*_OWNER, "quality_criteria", "quality_level").distinct()
    from_issues = left_on(distinct_marks, codes, ["organisation"], null_safe=True)
    from_expectations = expectation_marks(tables)
    if datasets is not None:
        from_expectations = isin(from_expectations, "pipeline", datasets)
    return union_all(
        from_issues.withColumn("has_endpoint", F.lit(True)), from_expectations.withColumn("has_endpoint", F.lit(False))
    )


def _marks(tables: Mapping[str, DataFrame], datasets: Sequence[str]) -> DataFrame:
    return shared(tables, "scored-marks", tuple(datasets), lambda: scored_marks(tables, datasets))


def _scored_levels(tables: Mapping[str, DataFrame], datasets: Sequence[str], summary: DataFrame | None = None) -> DataFrame:
    """The level of every supply of the datasets, from a summary of its marks."""

    def levels() -> DataFrame:
        rows = summary
        if rows is None:
            rows = supply_summary(_marks(tables, datasets), _SCORED, [], F.bool_or("has_endpoint").alias("has_endpoint"))
        supplied = rows.filter("has_endpoint").select("pipeline")
        # Used for three checks.
        ratings = shared(
            tables, "entity-ratings", tuple(datasets), lambda: entity_ratings(tables, supplied, datasets), write=True
        )
        found = with_levels(rows.select(*_SCORED, "severity_level"), ratings, scored_organisations(tables))
        return found.withColumn("quality_level_label", label_of(F.col("quality_level")))

    return shared(tables, "scored-levels", tuple(datasets), levels)


def quality_scores(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One line per organisation: its level for every dataset in scope, and its readiness.

    Organisations expected to supply but without any supply are added as lines without data. Cohort and
    start date are blank for organisations outside the ODP project.
    """
    datasets = detail_datasets(tables)
    levels = _scored_levels(tables, datasets)

    cohorts = _odp_provisions(tables).select("organisation", "cohort", "start_date").distinct()
    index = ["cohort", "start_date", "organisation", "organisation_name"]
    placed = left_on(levels, cohorts, ["organisation"], null_safe=True)
    wide = pivot_labels(placed, index, "pipeline", "quality_level_label", datasets)
    wide = materialise(left_on(wide, readiness(levels), ["organisation"]), "quality-scores")

    expected = _named_provisions(tables, ["organisation", "cohort", "start_date"])
    absent = missing_in(expected, wide, ["cohort", "organisation"])
    combined = fill_pivot(union_all(wide, absent), datasets, QUALITY_LABELS[0])
    report = fill_pivot(combined, ["ready_for_ODP_adoption"], "no")
    ordered = order_columns(report, [*index, *datasets], ["ready_for_ODP_adoption"])
    return sort_report(ordered, ["cohort", "organisation_name"], ["organisation", "start_date"])


def quality_detail(tables: Mapping[str, DataFrame], criteria: Sequence[str] | None = None) -> DataFrame:
    """One line per supply: which criteria it fails, the checks, and its level.

    Expected supplies that do not exist are added as lines without data. ``criteria`` lists the
    criterion columns, and a mark against another stops the job; without it those that occur in any dataset
    are looked up first.
    """
    datasets = detail_datasets(tables)
    names = list(criteria) if criteria is not None else distinct_values(scored_marks(tables), "quality_criteria")
    summary = supply_summary(only_listed(_marks(tables, datasets), criteria), _SCORED, names, F.bool_or("has_endpoint").alias("has_endpoint"))
    matrix = criteria_matrix(summary, names)
    report = _attach(matrix, _scored_levels(tables, datasets, summary), _CHECKS)
    placed = left_on(report, _odp_provisions(tables), _SUPPLY, null_safe=True)

    expected = _named_provisions(tables, ["organisation", "pipeline", "cohort", "start_date"])
    absent = missing_in(expected, summary, _SUPPLY).withColumn("quality_level_label", F.lit(QUALITY_LABELS[0]))
    combined = union_all(placed.withColumns(_flag_texts(names)), absent)
    front = ["pipeline", "cohort", "start_date", "organisation", "organisation_name", *names, *_CHECKS]
    ordered = order_columns(combined, front, ["quality_level_label"])
    return sort_report(ordered, ["pipeline", "organisation"], ["organisation_name"])


def quality_reports(tables: Mapping[str, DataFrame], criteria: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The scores and the detail of one run, by name. Marks, ratings and levels are made once."""
    tables = Shared(tables)
    return {"quality_detail": quality_detail(tables, criteria), "quality_scores": quality_scores(tables)}
