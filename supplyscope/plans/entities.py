"""Entity reports: deleted, duplicated, ended and orphaned entities."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import same, to_long
from ..operators import (
    dedupe,
    ended,
    enrich_roles,
    exists_flag,
    explode_entities,
    explode_matches,
    in_set,
    inner_on,
    join_coerced,
    left_join_m1,
    left_on,
    lookup_by_dataset,
    sort_report,
    union_keys,
)
from ..sources import materialise
from .constants import ODP_PROJECT, SPATIAL_DATASETS
from .endpoints import ended_organisations


def deleted_entities(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Entities that a failed expectation reports as deleted, with what is known of them."""
    failed = tables["expectation"].filter(
        (F.col("passed") == "False") & (F.col("operation") == "count_deleted_entities")
    )
    listed = explode_entities(failed.select("dataset", "organisation", "details"))
    listed = materialise(listed.withColumn("entity", to_long(F.col("entity"))), "deleted-entities")
    organisation = tables["organisation"].select(
        "organisation", F.col("entity").alias("organisation_entity"), F.col("name").alias("organisation_name")
    )
    # Only entities that some row asks for need to be kept and tested for repeats.
    known = in_set(tables["entity"].select("dataset", "entity", "name", "reference"), listed, ["dataset", "entity"])
    named = left_on(listed, organisation, ["organisation"], null_safe=True)
    found = left_join_m1(named, known, ["dataset", "entity"], what="entity")
    return found.select(
        "dataset", "entity", "organisation", "organisation_name", "organisation_entity", "name", "reference"
    )


def entity_details(tables: Mapping[str, DataFrame], wanted: DataFrame, geometry: bool) -> DataFrame:
    """The wanted (dataset, entity) keys with the entity's own details, its organisation's name, and
    the organisation that the dataset's lookup gives for it, marked if that is in the ODP project."""
    keys = ["dataset", "entity"]
    columns = [*keys, "name", "organisation_entity", "entry_date", "end_date", *(["geometry"] if geometry else [])]
    spatial = tables["entity"].filter(F.col("dataset").isin(SPATIAL_DATASETS)).select(*columns)
    known = in_set(spatial, wanted, keys)
    organisation = tables["organisation"].select(
        F.col("entity").alias("organisation_entity"), F.col("name").alias("organisation_name")
    )
    lookup = tables["lookup"].filter(F.col("dataset").isin(SPATIAL_DATASETS))
    first = dedupe(in_set(lookup, wanted, keys), keys, ["rowid"], "first")

    found = left_join_m1(wanted, known, keys, what="entity")
    owned = left_join_m1(found, organisation, ["organisation_entity"], what="organisation")
    looked_up = lookup_by_dataset(owned, first, "organisation", "lookup_organisation")

    odp = tables["provision"].filter(F.col("project") == ODP_PROJECT)
    members = odp.select(F.col("organisation").alias("lookup_organisation"))
    owners = lookup.select(F.col("organisation").alias("lookup_organisation"))
    return exists_flag(looked_up, members, ["lookup_organisation"], "in_odp", counted=owners)


def duplicate_pairs(tables: Mapping[str, DataFrame], geometry: bool = False) -> DataFrame:
    """Pairs of entities with the same geometry, with both sides' details and owners.

    The organisation's name belongs to the entity's own organisation; the organisation id falls back
    to the one the check reported. Details are gathered once per entity, however many pairs it is in,
    and then looked up in two roles.
    """
    checks = tables["expectation"].filter(F.col("operation") == "duplicate_geometry_check")
    ids = ["entity_a", "organisation_entity_a", "entity_b", "organisation_entity_b"]
    pairs = explode_matches(checks.select("dataset", "operation", "details"))
    pairs = materialise(pairs.withColumns({c: to_long(F.col(c)) for c in ids}), "duplicate-pairs")

    wanted = union_keys(
        pairs.select("dataset", F.col("entity_a").alias("entity")),
        pairs.select("dataset", F.col("entity_b").alias("entity")),
        ["dataset", "entity"],
    )
    details = materialise(entity_details(tables, wanted, geometry), "duplicate-details")
    roles = {side: f"entity_{side}_" for side in ("a", "b")}
    found = enrich_roles(pairs, details, {"dataset": "dataset", "entity": "entity_{role}"}, roles)
    found = found.withColumnsRenamed({f"entity_{side}_lookup_organisation": f"lookup_org_{side}" for side in roles})
    owner = {
        f"entity_{side}_organisation": F.coalesce(f"entity_{side}_organisation_entity", f"organisation_entity_{side}")
        for side in roles
    }
    found = found.withColumns(owner)

    found = found.withColumnRenamed("entity_b_in_odp", "in_odp")
    flagged = found.withColumn("lookup_same_org", same(F.col("lookup_org_a"), F.col("lookup_org_b")))
    shown = ["name", "organisation", "organisation_name", "entry_date", "end_date", *(["geometry"] if geometry else [])]
    sides = [c for side in ("a", "b") for c in (f"entity_{side}", *[f"entity_{side}_{x}" for x in shown])]
    return flagged.select(
        "dataset", "operation", "message", *sides, "lookup_org_a", "lookup_org_b", "lookup_same_org", "in_odp"
    )


def duplicate_pairs_geo(tables: Mapping[str, DataFrame]) -> DataFrame:
    """:func:`duplicate_pairs` with the geometry of both sides."""
    return duplicate_pairs(tables, geometry=True)


def listed_building_end_date(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Outlines whose listed building has ended, with the organisation that supplied them."""
    building = ended(tables["listed_building"]).select(F.col("reference").alias("building_reference"), "end_date")
    outline = tables["listed_building_outline"]
    merged = join_coerced(
        outline, building, to_long(F.col("listed_building")), to_long(F.col("building_reference"))
    )
    organisation = tables["organisation"].select(F.col("entity").alias("organisation_entity"), "organisation")
    owned = left_on(merged, organisation, ["organisation_entity"], null_safe=True)
    report = owned.select("reference", "entity", "end_date", "organisation_entity", "organisation")
    return sort_report(report, ["organisation"], ["reference", "entity"])


def entities_with_ended_orgs(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Entities of all datasets that belong to an organisation that has ended."""
    wanted = ["dataset", "entity", "entry_date", "reference", "name", "organisation_entity"]
    merged = inner_on(
        tables["entity"].select(*wanted), ended_organisations(tables), ["organisation_entity"], null_safe=True
    )
    return merged.select(
        "organisation_name",
        "organisation_entity",
        "organisation_end_date",
        "organisation_code",
        "dataset",
        "entity",
        "entry_date",
        "reference",
        "name",
    )
