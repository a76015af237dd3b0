"""Rules that the generated tables cannot show, on small hand-written tables."""

import datetime as dt
import sys

import pytest
from pyspark.sql import functions as F

from supplyscope import plans
from supplyscope import sources as S
from supplyscope.plans import quality
from supplyscope.plans.endpoints import classify_failed, probe_findings
from supplyscope.sources import TABLES

LABEL = {
    0: "0. no data",
    1: "1. non-authoritative/some data",
    2: "2. non-authoritative usable data",
    3: "3. non-authoritative trustworthy data",
    4: "4. authoritative data",
    5: "5. authoritative usable data",
    6: "6. authoritative trustworthy data",
}


@pytest.fixture
def table(spark):
    def make(name, *records):
        schema = spark.createDataFrame([], TABLES[name]).schema
        data = [tuple(r.get(f.name) for f in schema) for r in records]
        return spark.createDataFrame(data, schema)

    return make


def day(text):
    return dt.date.fromisoformat(text)


# --- quality -----------------------------------------------------------------------------------


def quality_tables(table, endpoints, entities=(), issues=(), organisations=(), rules=(), provisions=(), expectations=()):
    names = {e["organisation"] for e in endpoints} - {o["organisation"] for o in organisations}
    orgs = list(organisations) + [
        {"entity": 100 + i, "organisation": o, "name": o.upper()} for i, o in enumerate(sorted(names))
    ]
    history = [
        {"rowid": i, "latest_status": 200, "name": e["organisation"].upper(), "collection": "c", **e}
        for i, e in enumerate(endpoints)
    ]
    return {
        "historic_endpoint": table("historic_endpoint", *history),
        "entity": table("entity", *entities),
        "issue_summary": table("issue_summary", *issues),
        "organisation": table("organisation", *orgs),
        "provision_rule": table("provision_rule", *rules),
        "provision": table("provision", *provisions),
        "expectation": table("expectation", *expectations),
        "planning_authority": table("planning_authority", *[
            {"reference": o["local_planning_authority"], "geometry": "POINT (0 0)"}
            for o in orgs if o.get("local_planning_authority")
        ]),
        "quality": table("quality", {"quality": "some", "priority": 1}, {"quality": "authoritative", "priority": 2}),
        "issue_type": table("issue_type", *[
            {"issue_type": f"t{n}", "quality_criteria": f"crit{n}", "quality_criteria_level": n} for n in (1, 2, 3)
        ], {"issue_type": "free"}),
    }


SINGLE_RULE = [{"dataset": "single", "provision_reason": "alternative"}]


@pytest.mark.parametrize("authoritative", [True, False])
def test_levels_follow_severity_and_authority(table, authoritative):
    """No issue, then severity 1, 2 and 3: rungs 3, 0, 1 and 2, and three more if authoritative."""
    cases = {"none": None, "free": "free", "one": "t1", "two": "t2", "three": "t3"}
    orgs = [{"entity": i, "organisation": o, "name": o.upper()} for i, o in enumerate(cases)]
    t = quality_tables(
        table,
        [{"organisation": o, "pipeline": "single", "resource": f"r-{o}", "resource_start_date": day("2024-01-01")} for o in cases],
        [{"entity": i, "dataset": "single", "organisation_entity": i, "quality": "authoritative" if authoritative else "some"} for i in range(5)],
        [{"resource": f"r-{o}", "issue_type": x} for o, x in cases.items() if x],
        orgs,
        SINGLE_RULE,
    )
    report = plans.quality_single_source(t, day("2024-02-01"))
    got = {r.organisation: r.quality_level_label for r in report.collect()}
    plain = {"none": 3, "free": 3, "one": 0, "two": 1, "three": 2}
    assert got == {o: LABEL[n + (3 if authoritative else 0)] for o, n in plain.items()}
    # Criteria that occur become columns, TRUE where the issue occurred.
    assert report.columns[3:6] == ["1 - crit1", "2 - crit2", "3 - crit3"]
    flags = {r.organisation: r["2 - crit2"] for r in report.collect()}
    assert flags == {"none": "FALSE", "free": "FALSE", "one": "FALSE", "two": "TRUE", "three": "FALSE"}


def test_one_authoritative_entity_is_enough_and_unrated_is_unchecked(table):
    t = quality_tables(
        table,
        [{"organisation": o, "pipeline": "single", "resource": o, "resource_start_date": day("2024-01-01")} for o in "abc"],
        [
            {"dataset": "single", "organisation_entity": 100, "quality": "some"},
            {"dataset": "single", "organisation_entity": 100, "quality": "authoritative"},
            {"dataset": "single", "organisation_entity": 101, "quality": "unheard of"},
            {"dataset": "other", "organisation_entity": 102, "quality": "authoritative"},
        ],
        rules=SINGLE_RULE,
    )
    got = {
        r.organisation: (r.is_authoritative, r.authoritative_check_available, r.has_zero_entities, r.quality_level_label)
        for r in plans.quality_single_source(t, day("2024-02-01")).collect()
    }
    assert got == {
        "a": ("TRUE", "TRUE", "FALSE", LABEL[6]),
        "b": ("FALSE", "FALSE", "FALSE", LABEL[3]),
        # The pipeline has entities, but none of this organisation.
        "c": ("FALSE", "FALSE", "TRUE", LABEL[0]),
    }


def test_a_pipeline_without_any_entities_is_not_overridden(table):
    t = quality_tables(
        table,
        [{"organisation": "a", "pipeline": "single", "resource": "r", "resource_start_date": day("2024-01-01")}],
        rules=SINGLE_RULE,
    )
    (row,) = plans.quality_single_source(t, day("2024-02-01")).collect()
    assert (row.has_zero_entities, row.quality_level_label) == ("FALSE", LABEL[3])


def test_only_more_than_365_days_is_stale_and_caps_the_rung(table):
    as_of = day("2024-12-31")
    ages = {"a": 364, "b": 365, "c": 366}
    t = quality_tables(
        table,
        [
            {"organisation": o, "pipeline": "single", "resource": o, "resource_start_date": as_of - dt.timedelta(days=n)}
            for o, n in ages.items()
        ],
        [{"dataset": "single", "organisation_entity": 100 + i, "quality": "authoritative"} for i in range(3)],
        rules=SINGLE_RULE,
    )
    got = {r.organisation: (r.resource_age_days, r.is_stale, r.quality_level_label) for r in plans.quality_single_source(t, as_of).collect()}
    assert got == {
        "a": (364, "FALSE", LABEL[6]),
        "b": (365, "FALSE", LABEL[6]),
        "c": (366, "TRUE", LABEL[5]),
    }


def test_staleness_never_raises_a_level(spark):
    cases = [(level, auth, stale) for level in range(7) for auth in (True, False) for stale in (True, False)]
    cases = [c for c in cases if c[0] == 0 or c[1] == (c[0] > 3) or (c[1] and c[0] == 3)]
    df = spark.createDataFrame(cases, "level int, auth boolean, stale boolean")
    capped = quality.staleness_cap(F.col("level"), F.col("auth"), F.col("stale"))
    for r in df.withColumn("capped", capped).collect():
        assert r.capped <= r.level
        assert r.capped == r.level or r.stale
        assert r.level != 0 or r.capped == 0


def test_scope(table, rows):
    rules = [
        {"dataset": "odp", "project": "open-digital-planning", "provision_reason": "expected"},
        {"dataset": "law", "provision_reason": "statutory"},
        {"dataset": "lpa", "provision_reason": "encouraged", "role": "local-planning-authority"},
        {"dataset": "one", "provision_reason": "encouraged", "role": "other"},
        {"dataset": "one", "provision_reason": "alternative"},
        {"provision_reason": "statutory"},
    ]
    got = rows(plans.dataset_scope({"provision_rule": table("provision_rule", *rules)}))
    assert got == [("mandated", "law"), ("mandated", "lpa"), ("single-source", "one")]


AREAS = ["article-4-direction-area", "conservation-area", "listed-building-outline", "tree", "tree-preservation-zone"]


def lpa_tables(table, **extra):
    endpoints = [{"organisation": "a", "pipeline": p, "resource": f"a-{p}"} for p in AREAS]
    endpoints += [{"organisation": "b", "pipeline": p, "resource": f"b-{p}"} for p in AREAS[:4]]
    orgs = [
        {"entity": 1, "organisation": "a", "name": "A", "local_planning_authority": "E1"},
        {"entity": 2, "organisation": "b", "name": "B", "local_planning_authority": "E2", "end_date": day("2020-01-01")},
        {"entity": 3, "organisation": "z", "name": "Z"},
    ]
    entities = [{"dataset": p, "organisation_entity": e, "quality": "authoritative"} for p in AREAS for e in (1, 2)]
    odp = {"project": "open-digital-planning", "start_date": day("2021-01-01")}
    provisions = [
        {"organisation": "a", "dataset": "tree", "cohort": "c1", **odp},
        {"organisation": "z", "dataset": "tree", "cohort": "c2", **odp},
        {"organisation": "y", "dataset": "tree", "cohort": "c2", "project": "other"},
    ]
    return quality_tables(table, endpoints, entities, organisations=orgs, provisions=provisions,
                          rules=[{"dataset": "brownfield-land", "provision_reason": "statutory"}], **extra)


def test_scores_fill_gaps_and_judge_readiness(table):
    report = plans.quality_scores(lpa_tables(table)).collect()
    assert [(r.cohort, r.organisation, r.ready_for_ODP_adoption) for r in report] == [
        ("c1", "a", "yes"), ("c2", "z", "no"), (None, "b", "no"),
    ]
    a, z, b = report
    assert (a.tree, a["brownfield-land"], b["tree-preservation-zone"]) == (LABEL[6], LABEL[0], LABEL[0])
    assert (z.organisation_name, z.tree) == ("Z", LABEL[0])


def test_failed_expectations_lower_live_authorities_only(table):
    failed = [
        {"organisation": o, "dataset": "tree", "name": "Entities OUTSIDE boundary", "message": m, "passed": p}
        for o, m, p in (("a", "found", "False"), ("b", "found", "False"), ("z", "found", "False"))
    ] + [
        {"organisation": "a", "dataset": "conservation-area", "name": "outside", "message": "An ERROR", "passed": "False"},
        {"organisation": "a", "dataset": "conservation-area", "name": "outside", "message": "found", "passed": "True"},
    ]
    t = lpa_tables(table, expectations=failed)
    detail = {(r.organisation, r.pipeline): r for r in plans.quality_detail(t).collect()}
    assert detail["a", "tree"].quality_level_label == LABEL[5]
    assert detail["a", "conservation-area"].quality_level_label == LABEL[6]
    assert detail["b", "tree"].quality_level_label == LABEL[6]
    column = "3 - entities within LPA boundary"
    assert (detail["a", "tree"][column], detail["b", "tree"][column]) == ("TRUE", "FALSE")
    # An expected supply that does not exist.
    gap = detail["z", "tree"]
    assert (gap.cohort, gap.quality_level_label, gap[column], gap.is_authoritative) == ("c2", LABEL[0], None, None)


# --- other reports -----------------------------------------------------------------------------


def test_runaway_flags(table):
    as_of = day("2024-01-31")

    def starts(endpoint, days, end=None):
        return [{"endpoint": endpoint, "resource_start_date": as_of - dt.timedelta(days=n), "resource_end_date": end} for n in days]

    records = (
        starts("week", range(1, 8), as_of)
        + starts("gap", [1, 2, 3, 5, 6, 7, 8])
        + starts("many", [1] * 21)
        + starts("stale", [90, 91], day("2023-12-31"))
        + starts("single", [3])
        + starts(None, [1, 2])
    )
    records += [{"endpoint": "closed", "resource_start_date": as_of, "endpoint_end_date": as_of}] * 3
    history = table("historic_endpoint", *[{"rowid": i, **r} for i, r in enumerate(records)])
    got = {
        r.endpoint: (r.resource_count, r.daily_for_7_days, r[">20_instances_in_30_day_period"], r.stale_resource)
        for r in plans.runaway_resources({"historic_endpoint": history}, as_of).collect()
    }
    assert got == {
        "many": (21, "no", "yes", "no"),
        "week": (7, "yes", "no", "no"),
        "gap": (7, "no", "no", "no"),
        "stale": (2, "no", "no", "yes"),
    }
    assert list(got) == ["many", "gap", "week", "stale"]


def test_logs_count_mondays_only(spark):
    data = [("e", dt.datetime(2024, 1, 1, 5), 200), (None, dt.datetime(2024, 1, 1, 6), 200), ("e", dt.datetime(2024, 1, 1, 7), None),
            ("e", dt.datetime(2024, 1, 2), 200), ("e", dt.datetime(2023, 6, 26), 200)]
    log = spark.createDataFrame(data, "endpoint string, entry_date timestamp_ntz, status int")
    got = plans.logs_by_week({"log": log}, day("2024-01-10")).collect()
    assert [tuple(r) for r in got] == [(1, "2024-01-01", day("2024-01-01"), "200"), (1, "2024-01-01", day("2024-01-01"), "FAIL")]


@pytest.mark.parametrize(
    ("url", "probe", "group", "details"),
    [
        ("http://x/a.zip.pdf", {}, "zipped file", "file needs to be unzipped first"),
        ("http://x/A.DOCX", {}, "active document links", "doc file in URL"),
        ("http://x/a.xlsx", {}, "XLS files", "Possible issues with opening xls file"),
        ("http://x/a-pptx", {}, "active document links", "ppt inferred from slug"),
        ("http://x/a-pdf.xls", {}, "XLS files", "Possible issues with opening xls file"),
        ("http://x/1", {"head_content_type": "Application/PDF"}, "active document links", "confirmed via Content-Type check"),
        ("http://x/2", {"content_type": "application/json", "body": '{"error": {"code": 499}}'}, "auth error", "Token or authentication required (JSON error response)"),
        ("http://x/3", {"content_type": "application/json", "body": '{"error": {"message": "Bad Token"}}'}, "auth error", "Token or authentication required (JSON error response)"),
        ("http://x/4", {"content_type": "application/json", "body": "token required"}, None, ""),
        ("http://x/5", {"content_type": "text/html", "body": "Token Required"}, "auth error", "Token or authentication required (text body)"),
        ("http://x/WFS", {"content_type": "text/xml", "body": "ServiceException feature", "status": 200}, "wfs error", "Likely invalid typeName - check WFS GetCapabilities"),
        ("http://x/wfs", {"content_type": "text/xml", "body": "ServiceException feature", "status": 500}, None, ""),
        ("http://x/6", {}, None, ""),
        (None, {}, None, ""),
        ("https://www.bolton.gov.uk/downloads/file/3212/infrastructure-funding-statement", {}, "active document links", "manually flagged as pdf"),
    ],
)
def test_failed_resource_rules(spark, table, url, probe, group, details):
    df = spark.createDataFrame([(url,)], "endpoint_url string")
    probes = table("url_probe", {"url": url, **probe}) if probe else table("url_probe")
    probed = df.join(probe_findings(probes), F.col("endpoint_url") == F.col("probe_url"), "left")
    row = classify_failed(probed).first()
    assert (row.group, row.details) == (group, details)


def conformance_tables(table, summaries, issues):
    return {
        "field_summary": table("field_summary", *[
            {"rowid": i, "organisation": "o", "cohort": "c1", "dataset": "tree", "pipeline": "tree", "endpoint": "e",
             "latest_log_entry_date": "2024-01-01", **s} for i, s in enumerate(summaries)
        ]),
        "latest_endpoint": table("latest_endpoint", {"endpoint": "e", "dataset": "tree", "licence": "ogl3"}),
        "endpoint_dataset_summary": table("endpoint_dataset_summary", {"endpoint": "e", "dataset": "tree"},
                                          {"endpoint": "old", "dataset": "tree", "end_date": day("2020-01-01")}),
        "provision": table("provision", {"organisation": "o", "cohort": "c1", "provision_reason": "expected", "project": "open-digital-planning"}),
        "cohort": table("cohort", {"cohort": "c1", "start_date": day("2021-01-01")}),
        "organisation": table("organisation", {"entity": 1, "organisation": "o", "name": "O"}),
        "issue_summary": table("issue_summary", *[{"pipeline": "tree", "dataset": "tree", "severity": "error", **i} for i in issues]),
        "specification": table("specification", {"json": '[{"dataset": "tree", "fields": [{"field": "entity"}, {"field": "point"}, {"field": "name"}, {"field": "notes"}]}]'}),
    }


def test_conformance_counts_errors_per_row_sharing_a_resource(table):
    t = conformance_tables(
        table,
        [
            {"resource": "r", "mapping_field": "name;x;point", "non_mapping_field": "notes"},
            {"resource": "r", "mapping_field": "name"},
            {"resource": "s", "mapping_field": "", "cohort": ""},
            {"resource": "q", "endpoint": "old"},
            {"resource": ""},
            {"resource": "u", "latest_log_entry_date": None},
            {"resource": "v", "mapping_field": "name;notes;point"},
        ],
        [{"resource": "r", "field": f} for f in ("name", "unlisted", None)] + [{"resource": "r", "severity": "warning"}],
    )
    report = plans.conformance(t)
    assert report.columns[6] == "endpoint_no."
    got = {
        (r.resource, r["endpoint_no."]): (r.field, r.field_supplied, r.field_matched, r.field_errors, r.field_error_free)
        for r in report.collect()
    }
    # Row 4 (no log date) is left out after numbering, the blank cohort only from this report.
    assert got == {("r", "1"): (3, 3, 2, 6, -3), ("r", "2"): (3, 1, 1, 6, -5), ("v", "5"): (3, 3, 3, 0, 3)}
    (row,) = [r for r in report.collect() if r.resource == "v"]
    assert (row.organisation_name, row.licence, row.field_matched_pct) == ("Unknown", "ogl3", 1.0)
    assert [tuple(r) for r in plans.conformance_overview(t).collect()][3] == ("tree", 2, 0, 2)
    assert plans.conformance_full_match(t).first()[0] == 25.0
    shown = {r["endpoint_no."]: (r.field_supplied_count, r.field_supplied_pct, r.field_supplied_band) for r in plans.conformance_display(t).collect()}
    assert shown == {
        "1": ("3/3", "100%", "100"), "2": ("1/3", "33%", "30-40"), "3": ("0/3", "0%", "00-10"), "5": ("3/3", "100%", "100"),
    }


def test_conformance_of_nothing(table):
    t = conformance_tables(table, [], [])
    assert plans.conformance(t).collect() == []
    assert plans.conformance_full_match(t).first()[0] == 0.0


def test_unprovisioned_endpoints_match_unknown_organisations(table):
    t = {
        "endpoint": table("endpoint", *[{"endpoint": e, "endpoint_url": f"http://x/{e}.PDF"} for e in "abc"],
                          {"endpoint": "d", "end_date": day("2020-01-01")}),
        "source": table("source", {"rowid": 1, "endpoint": "a", "organisation": "x:1"}, {"rowid": 2, "endpoint": "b", "organisation": "x:9"},
                        {"rowid": 3, "endpoint": "d", "organisation": "x:1"}),
        "organisation": table("organisation", {"name": "One", "reference": "1"}),
        "resource_endpoint": table("resource_endpoint", {"rowid": 1, "endpoint": "a", "resource": "old"}, {"rowid": 2, "endpoint": "a", "resource": "new"},
                                   {"rowid": 3, "endpoint": "b", "resource": "new"}),
        "resource_dataset": table("resource_dataset", {"rowid": 1, "resource": "new", "dataset": "t"}, {"rowid": 2, "resource": "old", "dataset": "u"}),
        # The second provision's organisation is unknown, as is the one of endpoint b.
        "provision": table("provision", {"dataset": "u", "organisation": "y:1"}, {"dataset": "t", "organisation": "y:8"}),
    }
    got = plans.endpoints_no_provision(t).collect()
    assert sorted((r.endpoint, r.organisation or "", r.dataset or "") for r in got) == [("a", "One", "t"), ("c", "", "")]
    assert plans.endpoints_pdf_only(t).count() == 2
    assert plans.endpoints_no_provision(t, include_pdf=False).count() == 0


def test_duplicate_entities_stop_the_deleted_report(table):
    t = {
        "expectation": table("expectation", {"dataset": "t", "organisation": "o", "operation": "count_deleted_entities",
                                             "passed": "False", "details": '{"entities": ["1"]}'}),
        "entity": table("entity", {"dataset": "t", "entity": 1, "name": "a"}, {"dataset": "t", "entity": 1, "name": "b"}),
        "organisation": table("organisation", {"entity": 7, "organisation": "o", "name": "O"}),
    }
    with pytest.raises(Exception, match="entity: more than one row for key t, 1"):
        plans.deleted_entities(t).collect()


def test_ended_organisations_match_null_codes(table):
    t = {
        "organisation": table("organisation", {"entity": 1, "name": "A", "dataset": "d", "reference": "1", "end_date": day("2020-01-01")},
                              {"entity": 2, "name": "B", "end_date": day("2020-01-01")}, {"entity": 3, "name": "C", "dataset": "d", "reference": "3"}),
        "historic_endpoint": table("historic_endpoint", {"organisation": "d:1"}, {"organisation": "d:3"}, {"organisation": None, "latest_log_entry_date": "x"}),
    }
    got = plans.ended_orgs_active_endpoints(t).collect()
    assert sorted((r.organisation_name, r.organisation_code or "") for r in got) == [("A", "d:1"), ("B", "")]


# --- several reports of one run ----------------------------------------------------------------


def written(monkeypatch):
    """Names of the intermediate tables that are written from now on."""
    names, write = [], S.materialise

    def noted(df, name):
        names.append(name)
        return write(df, name)

    for module in ("sources.shared", "plans.conformance", "plans.quality"):
        monkeypatch.setattr(sys.modules[f"supplyscope.{module}"], "materialise", noted)
    return names


def test_reports_of_one_run_share_what_they_have_in_common(spark, monkeypatch):
    from testbed import bindings as b
    from testbed.views import tables

    small = "/root/testdata/sf0.001"
    names = written(monkeypatch)
    made = plans.resource_reports(tables(spark, small, *b._COUNTS))
    assert names == ["counted-rows"]
    for df in made.values():
        # The log of endpoint rows and the counts are in the written table.
        assert "orders" not in (text := df._jdf.queryExecution().executedPlan().toString()) and "lineitem" not in text

    names.clear()
    made = plans.conformance_reports(tables(spark, small, *b._CONFORMANCE))
    assert names == ["field-rows", "scored-fields"] and len(made) == 4
    for df in made.values():
        assert "orders" not in df._jdf.queryExecution().executedPlan().toString()

    names.clear()
    plans.quality_reports(tables(spark, small, *b._LPA_QUALITY), b.LPA_CRITERIA)
    assert [names.count(n) for n in ("scored-marks", "entity-ratings", "scored-levels")] == [1, 1, 1]
    assert len(names) == 5

    names.clear()
    plans.quality_scores(tables(spark, small, *b._LPA_QUALITY))
    assert "scored-marks" not in names and "scored-levels" not in names


def test_shared_results_are_kept_by_name_and_parameters(spark):
    from supplyscope.sources import Shared, shared

    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    tables = Shared({"t": spark.range(1)})
    assert list(tables) == ["t"] and len(tables) == 1 and tables["t"].count() == 1
    for _ in range(2):
        assert shared(tables, "x", ("a",), build).count() == 3
    shared(tables, "x", ("b",), build)
    assert len(calls) == 2
    shared({}, "x", ("a",), build)
    shared({}, "x", ("a",), build, write=True)
    assert len(calls) == 4


def test_the_unscored_organisation_is_left_out(table):
    names = [{"entity": 1, "organisation": "a", "name": "Waveney District Council"}, {"entity": 2, "organisation": "b", "name": "B"}]
    found = quality.scored_organisations({"organisation": table("organisation", *names)})
    assert [r.organisation for r in found.collect()] == ["b"]


def test_headings():
    from supplyscope.functions import pretty

    assert [pretty(x) for x in ("field_supplied_pct", "field_matched_count", "endpoint_no.", "cohort")] == [
        "Field Supplied %", "Field Matched ", "Endpoint No.", "Cohort",
    ]
