"""The results the registered queries must give, as DuckDB SQL over the same domain views.

Written from the report definitions, with joins and windows as plainly as possible, not from the plans.
"""

from __future__ import annotations

from .bindings import CONFORMANCE_TOTALS, CRITERIA, LPA_CRITERIA, QUALITY_TOTALS, RESOURCE_TOTALS
from .views import PLANS, SPATIAL, with_views

# Names, labels and texts of the reports, here and in the SQL below.
DOCUMENT = ["article-4-direction", "conservation-area-document", "tree-preservation-order"]
ODP = SPATIAL + DOCUMENT
COUNTED = [*ODP, "local-plan", "plan-timetable"]
COLLECTIONS = [
    ("article-4-direction", "article-4-direction"),
    ("article-4-direction", "article-4-direction-area"),
    ("conservation-area", "conservation-area"),
    ("conservation-area", "conservation-area-document"),
    ("listed-building", "listed-building-outline"),
    ("tree-preservation-order", "tree-preservation-order"),
    ("tree-preservation-order", "tree-preservation-zone"),
    ("tree-preservation-order", "tree"),
]
PLAN_COLLECTIONS = [("local-plan", p) for p in PLANS]
SCOPED = sorted({*ODP, "conservation-area", "brownfield-land"})
SINGLE = ["article-4-direction-area", "listed-building-outline"]


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _pairs(values) -> str:
    return ", ".join(f"('{c}', '{p}')" for c, p in values)


_LABEL = """CASE {level} WHEN 0 THEN '0. no data' WHEN 1 THEN '1. non-authoritative/some data'
    WHEN 2 THEN '2. non-authoritative usable data' WHEN 3 THEN '3. non-authoritative trustworthy data'
    WHEN 4 THEN '4. authoritative data' WHEN 5 THEN '5. authoritative usable data'
    WHEN 6 THEN '6. authoritative trustworthy data' END"""

_ODP_PROVISIONS = """odp_provisions AS (
  SELECT organisation, cohort, min(start_date) AS cohort_start_date, min(name) AS name FROM (
    SELECT p.organisation, p.cohort, c.start_date, o.name
    FROM provision p JOIN cohort c ON c.cohort = p.cohort JOIN organisation o ON o.organisation = p.organisation
    WHERE p.provision_reason = 'expected' AND p.project = 'open-digital-planning')
  GROUP BY organisation, cohort)"""

_PLAN_PROVISIONS = """plan_provisions AS (
  SELECT p.organisation, min(o.name) AS name
  FROM provision p JOIN organisation o ON o.organisation = p.organisation
  WHERE p.specification = 'local-plan' AND p.provision_reason = 'statutory' GROUP BY p.organisation)"""

_STATUS_VALUES = """CASE WHEN e.pipeline IS NULL THEN 'No endpoint added' ELSE e.endpoint END AS endpoint,
       CASE WHEN e.pipeline IS NULL THEN '' ELSE e.endpoint_url END AS endpoint_url,
       CASE WHEN e.pipeline IS NULL THEN '' ELSE e.licence END AS licence,
       e.latest_status AS status, e.days_since_200,
       CASE WHEN e.pipeline IS NULL THEN '' ELSE e.latest_exception END AS exception,
       CASE WHEN e.pipeline IS NULL THEN '' ELSE e.resource END AS resource,
       CASE WHEN e.pipeline IS NULL THEN '' ELSE e.latest_log_entry_date END AS latest_log_entry_date,
       e.endpoint_entry_date, e.endpoint_end_date, e.resource_start_date, e.resource_end_date"""

_ISSUE_VALUES = """i.severity, i.responsibility, i.count_issues, i.collection, i.endpoint, i.endpoint_url,
       s.latest_status, s.latest_exception, i.resource, i.latest_log_entry_date,
       s.entry_date AS endpoint_entry_date, s.end_date AS endpoint_end_date,
       i.resource_start_date, i.resource_end_date"""

_CATALOGUE = """catalogue AS (
  SELECT o.name, s.organisation, sp.pipeline, e.endpoint_url, s.documentation_url, s.entry_date, s.end_date,
         e.endpoint, trim(coalesce(s.documentation_url, '')) = '' AS documentation_missing,
         s.end_date IS NULL AS is_active
  FROM endpoint e JOIN source s ON e.endpoint = s.endpoint JOIN source_pipeline sp ON s.source = sp.source
  JOIN organisation o ON o.organisation = s.organisation)"""

_NO_PROVISION = """last_resource AS (
  SELECT endpoint, resource FROM (SELECT *, row_number() OVER (PARTITION BY endpoint ORDER BY rowid DESC) AS nr
                                  FROM resource_endpoint) WHERE nr = 1),
last_dataset AS (
  SELECT resource, dataset FROM (SELECT *, row_number() OVER (PARTITION BY resource ORDER BY rowid DESC) AS nr
                                 FROM resource_dataset) WHERE nr = 1),
live AS (SELECT name, reference FROM organisation WHERE end_date IS NULL),
provided AS (
  SELECT p.dataset, o.name AS organisation
  FROM provision p LEFT JOIN live o ON o.reference IS NOT DISTINCT FROM regexp_replace(p.organisation, '^.*?:', '')),
candidates AS (
  SELECT e.endpoint, s.source, s.collection, e.endpoint_url, o.name AS organisation, d.dataset
  FROM endpoint e LEFT JOIN source s ON s.endpoint = e.endpoint
  LEFT JOIN live o ON o.reference IS NOT DISTINCT FROM regexp_replace(s.organisation, '^.*?:', '')
  LEFT JOIN last_resource r ON r.endpoint = e.endpoint
  LEFT JOIN last_dataset d ON d.resource IS NOT DISTINCT FROM r.resource
  WHERE e.end_date IS NULL),
gaps AS (
  SELECT * FROM candidates c WHERE NOT EXISTS (
    SELECT 1 FROM provided p WHERE p.dataset IS NOT DISTINCT FROM c.dataset
      AND p.organisation IS NOT DISTINCT FROM c.organisation))"""


def _failed(limit: str) -> str:
    types = [("pdf", 0), ("doc", 0), ("docx", 0), ("xls", 1), ("xlsx", 0), ("ppt", 0), ("pptx", 0)]
    group, details = "WHEN contains(u, '.zip') THEN 'zipped file' ", "WHEN contains(u, '.zip') THEN 'file needs to be unzipped first' "
    for lead, how in ((".", "file in URL"), ("-", "inferred from slug")):
        for kind, xls in types:
            hit = f"WHEN contains(u, '{lead}{kind}') THEN "
            group += hit + ("'XLS files' " if xls else "'active document links' ")
            details += hit + ("'Possible issues with opening xls file' " if xls else f"'{kind} {how}' ")
    pdf = "WHEN contains(lower(p.head_content_type), 'application/pdf') THEN "
    auth_json = """WHEN starts_with(lower(p.content_type), 'application/json')
        AND (json_extract_string(try_cast(p.body AS JSON), '$.error.code') = '499'
             OR contains(lower(json_extract_string(try_cast(p.body AS JSON), '$.error.message')), 'token')) THEN """
    auth_text = """WHEN NOT starts_with(lower(p.content_type), 'application/json')
        AND contains(lower(p.body), 'token required') THEN """
    wfs = """WHEN (contains(u, 'getfeature') OR contains(u, 'wfs')) AND p.status = 200
        AND contains(lower(p.body), 'serviceexception') AND contains(lower(p.body), 'feature') THEN """
    group += pdf + "'active document links' " + auth_json + "'auth error' " + auth_text + "'auth error' " + wfs + "'wfs error' "
    details += (
        pdf + "'confirmed via Content-Type check' "
        + auth_json + "'Token or authentication required (JSON error response)' "
        + auth_text + "'Token or authentication required (text body)' "
        + wfs + "'Likely invalid typeName - check WFS GetCapabilities' "
    )
    return f"""
WITH failed AS (
  SELECT c.resource FROM converted_resource c JOIN resource r ON r.resource = c.resource
  WHERE c.status = 'failed' AND r.end_date IS NULL ORDER BY r.start_date DESC, c.resource, c.dataset {limit}),
last_endpoint AS (
  SELECT resource, endpoint FROM (SELECT *, row_number() OVER (PARTITION BY resource ORDER BY rowid DESC) AS nr
                                  FROM resource_endpoint) WHERE nr = 1),
last_source AS (
  SELECT endpoint, source, collection FROM (
    SELECT *, row_number() OVER (PARTITION BY endpoint ORDER BY rowid DESC) AS nr FROM source) WHERE nr = 1),
traced AS (
  SELECT f.resource, s.source, s.collection, e.endpoint_url, lower(trim(coalesce(e.endpoint_url, ''))) AS u
  FROM failed f LEFT JOIN last_endpoint l ON l.resource = f.resource LEFT JOIN endpoint e ON e.endpoint = l.endpoint
  LEFT JOIN last_source s ON s.endpoint = l.endpoint),
classified AS (
  SELECT t.*, CASE {group} END AS g, CASE {details} ELSE '' END AS d
  FROM traced t LEFT JOIN url_probe p ON p.url = trim(t.endpoint_url))
SELECT resource, source, collection, endpoint_url, g AS "group", d AS details,
       CASE WHEN g = 'active document links' THEN 'yes' ELSE 'no' END AS recommend_retirement
FROM classified"""


_RESOURCE_ROWS = f"""first_rows AS (
  SELECT * FROM (
    SELECT *, resource_end_date IS NULL AS is_active,
           row_number() OVER (PARTITION BY resource, dataset, resource_end_date IS NULL ORDER BY rowid) AS nr
    FROM historic_endpoint WHERE dataset IN ({_list(COUNTED)}) AND resource IS NOT NULL AND resource <> '') WHERE nr = 1),
last_counts AS (
  SELECT dataset, resource, coalesce(try_cast(entity_count AS DOUBLE), 0.0) AS entity_count,
         CASE WHEN regexp_full_match(entry_count, '[0-9]+') THEN CAST(entry_count AS BIGINT) ELSE 0 END AS entry_count,
         CASE WHEN regexp_full_match(line_count, '[0-9]+') THEN CAST(line_count AS BIGINT) ELSE 0 END AS line_count
  FROM (SELECT *, row_number() OVER (PARTITION BY dataset, resource
                                     ORDER BY rowid DESC, entity_count DESC, entry_count DESC, line_count DESC) AS nr
        FROM dataset_resource) WHERE nr = 1),
counted AS (
  SELECT f.*, c.entity_count, c.entry_count, c.line_count
  FROM first_rows f JOIN last_counts c ON c.dataset = f.dataset AND c.resource = f.resource WHERE f.is_active)"""

_DUPLICATES = f"""checks AS (
  SELECT dataset, operation, try_cast(details AS JSON) AS j FROM expectation WHERE operation = 'duplicate_geometry_check'),
matches AS (
  SELECT dataset, operation, 'complete_match' AS message, unnest(CAST(j->'complete_matches' AS JSON[])) AS m FROM checks
  UNION ALL
  SELECT dataset, operation, 'single_match', unnest(CAST(j->'single_matches' AS JSON[])) FROM checks),
pairs AS (
  SELECT dataset, operation, message, CAST(m->>'entity_a' AS BIGINT) AS entity_a, CAST(m->>'entity_b' AS BIGINT) AS entity_b,
         CAST(m->>'organisation_entity_a' AS BIGINT) AS org_a, CAST(m->>'organisation_entity_b' AS BIGINT) AS org_b
  FROM matches),
first_lookup AS (
  SELECT dataset, entity, organisation FROM (
    SELECT *, row_number() OVER (PARTITION BY dataset, entity ORDER BY rowid) AS nr FROM lookup) WHERE nr = 1),
enriched AS (
  SELECT p.dataset, p.operation, p.message,
         p.entity_a, a.name AS entity_a_name, coalesce(a.organisation_entity, p.org_a) AS entity_a_organisation,
         oa.name AS entity_a_organisation_name, a.entry_date AS entity_a_entry_date, a.end_date AS entity_a_end_date,
         a.geometry AS entity_a_geometry,
         p.entity_b, b.name AS entity_b_name, coalesce(b.organisation_entity, p.org_b) AS entity_b_organisation,
         ob.name AS entity_b_organisation_name, b.entry_date AS entity_b_entry_date, b.end_date AS entity_b_end_date,
         b.geometry AS entity_b_geometry,
         la.organisation AS lookup_org_a, lb.organisation AS lookup_org_b,
         coalesce(la.organisation = lb.organisation, false) AS lookup_same_org,
         coalesce(lb.organisation IN (SELECT organisation FROM provision WHERE project = 'open-digital-planning'), false) AS in_odp
  FROM pairs p
  LEFT JOIN entity a ON a.dataset = p.dataset AND a.entity = p.entity_a
  LEFT JOIN organisation oa ON oa.entity = a.organisation_entity
  LEFT JOIN entity b ON b.dataset = p.dataset AND b.entity = p.entity_b
  LEFT JOIN organisation ob ON ob.entity = b.organisation_entity
  LEFT JOIN first_lookup la ON la.dataset = p.dataset AND la.entity = p.entity_a
  LEFT JOIN first_lookup lb ON lb.dataset = p.dataset AND lb.entity = p.entity_b)"""

# --- quality -----------------------------------------------------------------------------------

_CURRENT = """current_rows AS (
  SELECT * FROM historic_endpoint
  WHERE endpoint_end_date IS NULL AND resource_end_date IS NULL AND latest_status = 200),
rated_types AS (
  SELECT issue_type, CAST(quality_criteria_level AS STRING) || ' - ' || quality_criteria AS quality_criteria,
         quality_criteria_level AS quality_level FROM issue_type),
org AS (SELECT * FROM organisation WHERE name <> 'Waveney District Council'),
entity_quality AS (
  SELECT dataset AS pipeline, organisation_entity, quality FROM entity
  WHERE organisation_entity IS NOT NULL AND dataset IN (SELECT pipeline FROM current_rows {scope})),
auth AS (
  SELECT e.pipeline, o.organisation, o.name AS organisation_name, e.is_authoritative FROM (
    SELECT q.pipeline, q.organisation_entity, bool_or(r.priority >= 2) AS is_authoritative
    FROM entity_quality q JOIN quality r ON r.quality = q.quality GROUP BY q.pipeline, q.organisation_entity) e
  LEFT JOIN org o ON o.entity = e.organisation_entity),
present AS (
  SELECT DISTINCT q.pipeline, o.organisation FROM entity_quality q LEFT JOIN org o ON o.entity = q.organisation_entity)"""

_LEVELS = """levels AS (
  SELECT s.*, coalesce(a.is_authoritative, false) AS is_authoritative, a.pipeline IS NOT NULL AS authoritative_check_available,
         s.pipeline IN (SELECT pipeline FROM entity_quality) AND NOT EXISTS (
           SELECT 1 FROM present p WHERE p.pipeline = s.pipeline AND p.organisation IS NOT DISTINCT FROM s.organisation)
           AS has_zero_entities,
         coalesce(s.severity_level, 4) - 1 AS rung
  FROM severities s LEFT JOIN auth a ON a.pipeline = s.pipeline AND a.organisation IS NOT DISTINCT FROM s.organisation),
scored AS (
  SELECT *, CASE WHEN has_zero_entities THEN 0 WHEN is_authoritative THEN rung + 3 ELSE rung END AS quality_level FROM levels)"""


def _flags(criteria, name: str) -> str:
    return ",\n    ".join(
        f"""CASE WHEN count(*) FILTER (WHERE quality_criteria = '{c}' AND quality_level IS NOT NULL
          AND pipeline IS NOT NULL AND organisation IS NOT NULL AND {name} IS NOT NULL) > 0
        THEN 'TRUE' ELSE 'FALSE' END AS "{c}\""""
        for c in criteria
    )


def _bool(col: str, table: str) -> str:
    return f"CASE WHEN {table}.{col} THEN 'TRUE' WHEN NOT {table}.{col} THEN 'FALSE' END AS {col}"


def _single_source() -> str:
    scope = f"WHERE pipeline IN ({_list(SINGLE)})"
    columns = ", ".join(f'm."{c}"' for c in CRITERIA)
    return f"""
WITH {_CURRENT.format(scope=scope)},
base AS (
  SELECT h.*, CAST(DATE '2001-08-02' - h.resource_start_date AS INT) AS age, i.issue_type
  FROM current_rows h LEFT JOIN issue_summary i ON i.resource = h.resource {scope.replace('pipeline', 'h.pipeline')}),
marked AS (SELECT b.*, t.quality_criteria, t.quality_level FROM base b LEFT JOIN rated_types t ON t.issue_type = b.issue_type),
severities AS (
  SELECT collection, pipeline, organisation, name AS organisation_name, min(quality_level) AS severity_level
  FROM marked GROUP BY ALL),
{_LEVELS},
ages AS (SELECT pipeline, organisation, max(age) AS resource_age_days FROM base GROUP BY ALL),
capped AS (
  SELECT s.*, g.resource_age_days, coalesce(g.resource_age_days > 365, false) AS is_stale,
         CASE WHEN g.resource_age_days > 365 AND quality_level > 0 THEN
           CASE WHEN is_authoritative THEN least(quality_level - 3, 2) + 3 ELSE least(quality_level, 2) END
         ELSE quality_level END AS final_level
  FROM scored s LEFT JOIN ages g ON g.pipeline = s.pipeline AND g.organisation IS NOT DISTINCT FROM s.organisation),
matrix AS (
  SELECT pipeline, organisation, name AS organisation_name,
    {_flags(CRITERIA, 'name')}
  FROM marked GROUP BY pipeline, organisation, name)
SELECT m.pipeline, m.organisation, m.organisation_name, {columns},
       {_bool('is_authoritative', 'd')}, {_bool('authoritative_check_available', 'd')}, {_bool('has_zero_entities', 'd')},
       d.resource_age_days, {_bool('is_stale', 'd')}, {_LABEL.format(level='c.final_level')} AS quality_level_label
FROM matrix m
LEFT JOIN (SELECT pipeline, organisation, final_level FROM capped) c
  ON c.pipeline = m.pipeline AND c.organisation IS NOT DISTINCT FROM m.organisation
LEFT JOIN (SELECT DISTINCT pipeline, organisation, is_authoritative, authoritative_check_available, has_zero_entities,
                  resource_age_days, is_stale FROM capped) d
  ON d.pipeline = m.pipeline AND d.organisation IS NOT DISTINCT FROM m.organisation"""


_LPA_MARKS = """lpa AS (
  SELECT DISTINCT o.local_planning_authority AS lpa_code, o.organisation, o.name AS organisation_name
  FROM org o JOIN planning_authority p ON p.reference = o.local_planning_authority
  WHERE p.geometry IS NOT NULL AND o.end_date IS NULL),
marks AS (
  SELECT l.lpa_code, h.pipeline, h.organisation, h.name AS organisation_name, t.quality_criteria, t.quality_level
  FROM current_rows h LEFT JOIN issue_summary i ON i.resource = h.resource
  LEFT JOIN rated_types t ON t.issue_type = i.issue_type
  LEFT JOIN (SELECT DISTINCT lpa_code, organisation FROM lpa) l ON l.organisation = h.organisation
  UNION ALL
  SELECT lpa_code, 'conservation-area', organisation, organisation_name, '3 - entity count matches LPA', 3
  FROM lpa WHERE organisation IN (
    SELECT organisation FROM expectation WHERE passed = 'False' AND name =
      'Check number of conservation-area entities inside the local planning authority boundary matches the manual count')
  UNION ALL
  SELECT l.lpa_code, e.dataset, l.organisation, l.organisation_name, '3 - entities within LPA boundary', 3
  FROM lpa l JOIN (SELECT DISTINCT organisation, dataset FROM expectation
                   WHERE passed = 'False' AND name ILIKE '%outside%' AND message NOT ILIKE '%error%') e
    ON e.organisation = l.organisation),
severities AS (
  SELECT lpa_code, pipeline, organisation, organisation_name, min(quality_level) AS severity_level
  FROM marks GROUP BY ALL)"""

_ODP_ROWS = """odp_rows AS (
  SELECT organisation, dataset AS pipeline, cohort, start_date FROM provision WHERE project = 'open-digital-planning')"""


def _scores() -> str:
    cells = ", ".join(
        f"coalesce(max({_LABEL.format(level='s.quality_level')}) FILTER (WHERE s.pipeline = '{d}'), '0. no data') AS \"{d}\""
        for d in SCOPED
    )
    blanks = ", ".join(f"'0. no data' AS \"{d}\"" for d in SCOPED)
    return f"""
WITH {_CURRENT.format(scope='')}, {_LPA_MARKS}, {_LEVELS}, {_ODP_ROWS},
cohorts AS (SELECT DISTINCT organisation, cohort, start_date FROM odp_rows),
wide AS (
  SELECT c.cohort, c.start_date, s.organisation, s.organisation_name, {cells}
  FROM scored s LEFT JOIN cohorts c ON c.organisation = s.organisation
  WHERE s.pipeline IN ({_list(SCOPED)}) GROUP BY c.cohort, c.start_date, s.organisation, s.organisation_name),
ready AS (
  SELECT organisation, CASE WHEN count(*) = 5 AND min(quality_level) >= 4 THEN 'yes' ELSE 'no' END AS r
  FROM scored WHERE pipeline IN ({_list(SPATIAL)}) GROUP BY organisation),
expected AS (
  SELECT DISTINCT c.cohort, c.start_date, c.organisation, o.name AS organisation_name
  FROM odp_rows c LEFT JOIN org o ON o.organisation = c.organisation)
SELECT w.*, coalesce(r.r, 'no') AS "ready_for_ODP_adoption"
FROM wide w LEFT JOIN ready r ON r.organisation = w.organisation
UNION ALL
SELECT cohort, start_date, organisation, organisation_name, {blanks}, 'no' FROM expected e
WHERE NOT EXISTS (SELECT 1 FROM wide w WHERE w.cohort IS NOT DISTINCT FROM e.cohort AND w.organisation = e.organisation)"""


def _detail() -> str:
    columns = ", ".join(f'm."{c}"' for c in LPA_CRITERIA)
    blanks = ", ".join("NULL" for _ in LPA_CRITERIA)
    return f"""
WITH {_CURRENT.format(scope='')}, {_LPA_MARKS}, {_LEVELS}, {_ODP_ROWS},
matrix AS (
  SELECT pipeline, organisation, organisation_name,
    {_flags(LPA_CRITERIA, 'organisation_name')}
  FROM marks WHERE pipeline IN ({_list(SCOPED)}) GROUP BY pipeline, organisation, organisation_name),
checks AS (
  SELECT DISTINCT pipeline, organisation, is_authoritative, authoritative_check_available, has_zero_entities FROM scored),
expected AS (
  SELECT DISTINCT p.organisation, p.pipeline, p.cohort, p.start_date, o.name AS organisation_name
  FROM odp_rows p LEFT JOIN org o ON o.organisation = p.organisation)
SELECT m.pipeline, p.cohort, p.start_date, m.organisation, m.organisation_name, {columns},
       {_bool('is_authoritative', 'k')}, {_bool('authoritative_check_available', 'k')}, {_bool('has_zero_entities', 'k')},
       {_LABEL.format(level='s.quality_level')} AS quality_level_label
FROM matrix m LEFT JOIN scored s ON s.pipeline = m.pipeline AND s.organisation = m.organisation
LEFT JOIN checks k ON k.pipeline = m.pipeline AND k.organisation = m.organisation
LEFT JOIN odp_rows p ON p.organisation = m.organisation AND p.pipeline = m.pipeline
UNION ALL
SELECT e.pipeline, e.cohort, e.start_date, e.organisation, e.organisation_name, {blanks}, NULL, NULL, NULL, '0. no data'
FROM expected e
WHERE NOT EXISTS (SELECT 1 FROM matrix m WHERE m.pipeline IS NOT DISTINCT FROM e.pipeline AND m.organisation = e.organisation)
"""


# --- conformance -------------------------------------------------------------------------------

_SPEC = """spec AS (
  SELECT d->>'dataset' AS dataset, f->>'field' AS field
  FROM (SELECT d, unnest(CAST(d->'fields' AS JSON[])) AS f
        FROM (SELECT unnest(CAST(CAST(json AS JSON) AS JSON[])) AS d FROM specification))),
wanted AS (
  SELECT dataset, field FROM spec WHERE field NOT IN ('entity', 'organisation', 'prefix')
    AND NOT (field = 'point' AND dataset <> 'tree'))"""

_SCORED_FIELDS = f"""{_SPEC},
provisions AS (
  SELECT organisation, arg_min(cohort, (start_date, cohort)) AS cohort, min(start_date) AS cohort_start_date FROM (
    SELECT p.organisation, p.cohort, c.start_date
    FROM provision p JOIN cohort c ON c.cohort = p.cohort JOIN organisation o ON o.organisation = p.organisation
    WHERE p.provision_reason = 'expected' AND p.project = 'open-digital-planning')
  GROUP BY organisation),
field_rows AS (
  SELECT f.*, l.licence, row_number() OVER (PARTITION BY f.organisation, f.dataset ORDER BY f.rowid, l.licence NULLS FIRST) AS nr
  FROM field_summary f
  LEFT JOIN latest_endpoint l ON l.endpoint = f.endpoint AND l.dataset = f.dataset
  LEFT JOIN (SELECT endpoint, dataset, end_date, true AS known FROM endpoint_dataset_summary) s
    ON s.endpoint = f.endpoint AND s.dataset = f.dataset
  WHERE f.resource <> '' AND s.known AND s.end_date IS NULL AND f.pipeline IN ({_list(ODP)})),
errors AS (
  SELECT resource, count(*) AS n FROM issue_summary
  WHERE severity = 'error' AND pipeline IN ({_list(ODP)}) GROUP BY resource),
facts AS (
  SELECT f.organisation, coalesce(f.organisation_name, 'Unknown') AS organisation_name, f.cohort, f.dataset, f.licence,
         f.endpoint, CAST(f.nr AS STRING) AS endpoint_no, f.resource, f.latest_log_entry_date,
         coalesce(CAST(p.cohort_start_date AS STRING), '') AS cohort_start_date,
         coalesce(w.n, 0) AS field,
         len(list_filter(string_split(coalesce(f.mapping_field, ''), ';'), lambda x: list_contains(w.fields, x))) AS field_matched,
         len(list_filter(string_split(coalesce(f.non_mapping_field, ''), ';'), lambda x: list_contains(w.fields, x))) AS unmatched,
         coalesce(e.n, 0) * count(*) OVER (PARTITION BY f.resource) AS field_errors
  FROM field_rows f LEFT JOIN provisions p ON p.organisation = f.organisation AND p.cohort = f.cohort
  LEFT JOIN errors e ON e.resource = f.resource
  LEFT JOIN (SELECT dataset, list(field) AS fields, count(*) AS n FROM wanted GROUP BY dataset) w ON w.dataset = f.dataset),
scored AS (
  SELECT *, field_matched + unmatched AS field_supplied,
         CASE WHEN field_matched + unmatched - field_errors = -1 THEN 0 ELSE field_matched + unmatched - field_errors END AS field_error_free
  FROM facts
  WHERE organisation IS NOT NULL AND cohort IS NOT NULL AND dataset IS NOT NULL AND licence IS NOT NULL
    AND endpoint IS NOT NULL AND resource IS NOT NULL AND latest_log_entry_date IS NOT NULL),
ratios AS (
  SELECT *, CASE WHEN field > 0 THEN field_supplied / field END AS field_supplied_pct,
         CASE WHEN field > 0 THEN field_error_free / field END AS field_error_free_pct,
         CASE WHEN field > 0 THEN field_matched / field END AS field_matched_pct
  FROM scored)"""


def _band(col: str) -> str:
    group = f"floor({col} * 100 / 10)"
    return (
        f"CASE WHEN {group} = 10 THEN '100' ELSE CAST(CAST({group} AS BIGINT) AS STRING) || '0-' "
        f"|| CAST(CAST({group} AS BIGINT) + 1 AS STRING) || '0' END AS {col.replace('_pct', '_band')}"
    )


def _pretty(col: str) -> str:
    return (
        f"CASE WHEN contains({col}, '_') THEN replace(replace(replace({col}, '_', ' '), 'pct', '%'), 'count', '') "
        f"ELSE {col} END"
    )


def _percent(col: str) -> str:
    return f"CAST(CAST(round_even({col} * 100, 0) AS BIGINT) AS STRING) || '%' AS {col}"


def _oracles() -> dict[str, str]:
    return {
        "logs_by_week": """
SELECT count(endpoint) AS total_requests, substr(CAST(entry_date AS STRING), 1, 10) AS entrydate,
       CAST(date_trunc('week', entry_date) AS DATE) AS week_start,
       CASE WHEN status = 200 THEN '200' ELSE 'FAIL' END AS status_group
FROM log WHERE CAST(entry_date AS DATE) >= DATE '2024-01-10' AND dayofweek(entry_date) = 1
GROUP BY 2, 3, 4""",
        "operational_issues": """
SELECT entry_date, count(*) AS issue_count FROM operational_issue WHERE entry_date >= DATE '2024-01-10' GROUP BY entry_date""",
        "runaway_resources": """
WITH live AS (SELECT * FROM resource_history WHERE endpoint_end_date IS NULL AND endpoint IS NOT NULL)
SELECT endpoint, min(resource_start_date) AS first_resource_start_date, max(resource_start_date) AS last_resource_start_date,
       count(*) AS resource_count,
       arg_min(organisation_name, rowid) FILTER (WHERE organisation_name IS NOT NULL) AS organisation_name,
       arg_min(dataset, rowid) FILTER (WHERE dataset IS NOT NULL) AS dataset,
       arg_min(collection, rowid) FILTER (WHERE collection IS NOT NULL) AS collection,
       arg_min(pipeline, rowid) FILTER (WHERE pipeline IS NOT NULL) AS pipeline,
       arg_min(endpoint_entry_date, rowid) FILTER (WHERE endpoint_entry_date IS NOT NULL) AS endpoint_entry_date,
       count(*) FILTER (WHERE resource_start_date = resource_end_date) AS single_day_resources,
       CASE WHEN count(DISTINCT resource_start_date) FILTER (
              WHERE resource_start_date BETWEEN DATE '2024-01-24' AND DATE '2024-01-30') = 7 THEN 'yes' ELSE 'no' END AS daily_for_7_days,
       CASE WHEN count(*) FILTER (WHERE resource_start_date >= DATE '2024-01-01') > 20 THEN 'yes' ELSE 'no' END
         AS ">20_instances_in_30_day_period",
       CASE WHEN max(resource_end_date) < DATE '2024-01-01' THEN 'yes' ELSE 'no' END AS stale_resource
FROM live GROUP BY endpoint HAVING count(*) > 1""",
        "ended_orgs_active_endpoints": """
SELECT o.name AS organisation_name, o.entity AS organisation_entity, o.dataset || ':' || o.reference AS organisation_code,
       h.dataset AS dataset_name, h.endpoint_url, CAST(h.endpoint_entry_date AS TIMESTAMP) AS endpoint_entry_date,
       CAST(h.endpoint_end_date AS TIMESTAMP) AS endpoint_end_date, h.latest_status AS status,
       try_cast(h.latest_log_entry_date AS TIMESTAMP) AS latest_log_entry_date
FROM organisation o JOIN historic_endpoint h ON h.organisation IS NOT DISTINCT FROM o.dataset || ':' || o.reference
WHERE o.end_date IS NOT NULL AND h.endpoint_end_date IS NULL""",
        "entities_with_ended_orgs": """
SELECT o.name AS organisation_name, o.entity AS organisation_entity, o.end_date AS organisation_end_date,
       o.dataset || ':' || o.reference AS organisation_code, e.dataset, e.entity, e.entry_date, e.reference, e.name
FROM entity e JOIN organisation o ON o.entity = e.organisation_entity WHERE o.end_date IS NOT NULL""",
        "dataset_slugs": """
SELECT DISTINCT dataset FROM dataset_registry WHERE dataset IS NOT NULL ORDER BY dataset""",
        "odp_status": f"""
WITH {_ODP_PROVISIONS},
dim AS (SELECT * FROM (VALUES {_pairs(COLLECTIONS)}) AS t(collection, pipeline))
SELECT p.organisation, p.cohort, p.name, d.collection, d.pipeline, {_STATUS_VALUES}, p.cohort_start_date
FROM odp_provisions p CROSS JOIN dim d
LEFT JOIN latest_endpoint e ON replace(e.organisation, '-eng', '') = p.organisation AND e.pipeline = d.pipeline""",
        "plan_status": f"""
WITH {_PLAN_PROVISIONS},
dim AS (SELECT * FROM (VALUES {_pairs(PLAN_COLLECTIONS)}) AS t(collection, pipeline))
SELECT p.organisation, p.name, d.collection, d.pipeline, {_STATUS_VALUES}
FROM plan_provisions p CROSS JOIN dim d
LEFT JOIN latest_endpoint e ON replace(e.organisation, '-eng', '') = p.organisation AND e.pipeline = d.pipeline""",
        "odp_issue": f"""
WITH {_ODP_PROVISIONS}
SELECT p.organisation, p.cohort, p.name AS organisation_name, i.pipeline, i.issue_type, {_ISSUE_VALUES}
FROM issue_summary i LEFT JOIN endpoint_dataset_summary s ON s.endpoint = i.endpoint
JOIN odp_provisions p ON p.organisation = i.organisation AND p.cohort = i.cohort
WHERE i.dataset IN ({_list(ODP)})""",
        "plan_issue": f"""
WITH {_PLAN_PROVISIONS}
SELECT p.organisation, p.name AS organisation_name, i.pipeline, i.issue_type, i.field, {_ISSUE_VALUES}
FROM issue_summary i LEFT JOIN endpoint_dataset_summary s ON s.endpoint = i.endpoint AND s.dataset = i.dataset
JOIN plan_provisions p ON p.organisation = replace(i.organisation, '-eng', '')
WHERE i.dataset IN ({_list(PLANS)})""",
        "listed_building_end_date": """
SELECT l.reference, l.entity, b.end_date, l.organisation_entity, o.organisation
FROM listed_building b JOIN listed_building_outline l
  ON CAST(b.reference AS BIGINT) = CAST(try_cast(l.listed_building AS DOUBLE) AS BIGINT)
LEFT JOIN organisation o ON o.entity = l.organisation_entity
WHERE b.end_date <> ''""",
        "deleted_entities": """
WITH failed AS (
  SELECT dataset, organisation, CAST(CAST(details AS JSON)->'entities' AS VARCHAR[]) AS entities FROM expectation
  WHERE passed = 'False' AND operation = 'count_deleted_entities'),
listed AS (
  SELECT dataset, organisation, try_cast(e AS BIGINT) AS entity FROM (
    SELECT dataset, organisation, unnest(CASE WHEN len(entities) = 0 THEN [NULL] ELSE entities END) AS e FROM failed))
SELECT l.dataset, l.entity, l.organisation, o.name AS organisation_name, o.entity AS organisation_entity, e.name, e.reference
FROM listed l LEFT JOIN organisation o ON o.organisation = l.organisation
LEFT JOIN entity e ON e.dataset = l.dataset AND e.entity = l.entity""",
        "duplicate_pairs": f"""
WITH {_DUPLICATES} SELECT * EXCLUDE (entity_a_geometry, entity_b_geometry) FROM enriched""",
        "duplicate_pairs_geo": f"""
WITH {_DUPLICATES} SELECT * FROM enriched""",
        "endpoints_documentation": f"""
WITH {_CATALOGUE}
SELECT name, organisation, pipeline AS "pipeline/dataset", endpoint_url, documentation_url,
       try_cast(entry_date AS TIMESTAMP) AS entry_date, end_date, endpoint, documentation_missing, is_active
FROM catalogue""",
        "documentation_stats": f"""
WITH {_CATALOGUE}
SELECT count(*) AS total, count(*) FILTER (WHERE documentation_missing) AS missing_count,
       round(100.0 * count(*) FILTER (WHERE documentation_missing) / count(*), 2) AS percent_missing,
       count(*) FILTER (WHERE documentation_missing AND is_active) AS active_missing,
       count(*) FILTER (WHERE documentation_missing AND NOT is_active) AS ended_missing,
       CAST(max(try_cast(entry_date AS TIMESTAMP)) FILTER (WHERE documentation_missing) AS DATE) AS most_recent_missing_entry_date
FROM catalogue""",
        "documentation_top": f"""
WITH {_CATALOGUE}
SELECT pipeline AS "pipeline/dataset", count(*) AS missing_count FROM catalogue
WHERE documentation_missing AND pipeline IS NOT NULL GROUP BY pipeline ORDER BY 2 DESC, 1 LIMIT 3""",
        "endpoints_no_provision": f"""
WITH {_NO_PROVISION} SELECT endpoint, source, collection, endpoint_url, organisation, dataset FROM gaps""",
        "endpoints_pdf_only": f"""
WITH {_NO_PROVISION} SELECT endpoint, source, collection, endpoint_url, organisation, dataset FROM gaps
WHERE ends_with(lower(coalesce(endpoint_url, '')), '.pdf')""",
        "flagged_failed_resources": _failed("LIMIT 100"),
        "flagged_failed_resources_all": _failed(""),
        "resource_detailed_counts": f"""
WITH {_RESOURCE_ROWS}
SELECT dataset, name, organisation, endpoint, endpoint_entry_date, resource, resource_start_date,
       sum(entity_count) AS entity_count, CAST(sum(entry_count) AS BIGINT) AS entry_count, CAST(sum(line_count) AS BIGINT) AS line_count
FROM counted GROUP BY ALL""",
        "resource_vs_platform": f"""
WITH {_RESOURCE_ROWS},
act AS (
  SELECT dataset, coalesce(name, '') AS name, coalesce(organisation, '') AS organisation, sum(entity_count) AS a, CAST(sum(entry_count) AS BIGINT) AS b,
         CAST(sum(line_count) AS BIGINT) AS c, count(DISTINCT endpoint) AS d, count(DISTINCT resource) AS e
  FROM counted GROUP BY ALL),
ina AS (
  SELECT dataset, coalesce(name, '') AS name, coalesce(organisation, '') AS organisation, count(DISTINCT endpoint) AS f, count(DISTINCT resource) AS g
  FROM first_rows WHERE NOT is_active GROUP BY ALL),
summary AS (
  SELECT dataset, name, organisation, coalesce(a, 0) AS a, coalesce(b, 0) AS b, coalesce(c, 0) AS c, coalesce(d, 0) AS d,
         coalesce(e, 0) AS e, coalesce(f, 0) AS f, coalesce(g, 0) AS g
  FROM act FULL JOIN ina USING (dataset, name, organisation)),
platform AS (
  SELECT e.dataset, coalesce(o.name, '') AS name, coalesce(o.organisation, '') AS organisation, count(*) AS n
  FROM entity e LEFT JOIN organisation o ON o.entity = e.organisation_entity
  WHERE e.dataset IN ({_list(COUNTED)}) GROUP BY ALL)
SELECT dataset, name, organisation, n AS platform_entity_count, a AS dataset_resource_entity_count,
       b AS dataset_resource_entry_count, c AS dataset_resource_line_count, d AS dataset_resource_endpoint_count,
       e AS dataset_resource_resource_count, f AS dataset_resource_inactive_endpoint_count,
       g AS dataset_resource_inactive_resource_count, CASE WHEN c > 0 THEN n / c END AS platform_divided_by_dr_line_count
FROM platform FULL JOIN summary USING (dataset, name, organisation)""",
        "dataset_scope": """
WITH mandated AS (
  SELECT DISTINCT dataset FROM provision_rule WHERE dataset IS NOT NULL AND (provision_reason = 'statutory'
    OR (provision_reason = 'encouraged' AND role = 'local-planning-authority')))
SELECT 'mandated' AS scope, dataset FROM mandated
UNION ALL
SELECT DISTINCT 'single-source', dataset FROM provision_rule
WHERE dataset IS NOT NULL AND dataset NOT IN (SELECT dataset FROM mandated)
  AND dataset NOT IN (SELECT dataset FROM provision_rule WHERE project = 'open-digital-planning' AND dataset IS NOT NULL)""",
        "authoritative_lookup": f"""
WITH {_CURRENT.format(scope='')}
SELECT pipeline, organisation, organisation_name, is_authoritative, true AS authoritative_check_available FROM auth""",
        "quality_single_source": _single_source(),
        "quality_scores": _scores(),
        "quality_detail": _detail(),
        "conformance": f"""
WITH {_SCORED_FIELDS}
SELECT organisation, organisation_name, cohort, dataset, licence, endpoint, endpoint_no, resource, latest_log_entry_date,
       field, field_supplied, field_matched, field_errors, field_error_free, field_supplied_pct, field_error_free_pct,
       field_matched_pct
FROM ratios WHERE trim(cohort) <> ''""",
        "conformance_display": f"""
WITH {_SCORED_FIELDS}
SELECT {_pretty('cohort')} AS cohort, {_pretty('organisation_name')} AS organisation_name,
       {_pretty('organisation')} AS organisation, {_pretty('dataset')} AS dataset, {_pretty('licence')} AS licence, endpoint_no,
       CAST(field_supplied AS STRING) || '/' || CAST(field AS STRING) AS field_supplied_count, {_percent('field_supplied_pct')},
       CAST(field_matched AS STRING) || '/' || CAST(field AS STRING) AS field_matched_count, {_percent('field_matched_pct')},
       {_band('field_supplied_pct')}, {_band('field_matched_pct')}
FROM ratios""",
        "conformance_headed": f"""
WITH {_SCORED_FIELDS}
SELECT {_pretty('cohort')} AS "Cohort", {_pretty('organisation_name')} AS "Organisation Name",
       {_pretty('organisation')} AS "Organisation", {_pretty('dataset')} AS "Dataset", {_pretty('licence')} AS "Licence",
       endpoint_no AS "Endpoint No",
       CAST(field_supplied AS STRING) || '/' || CAST(field AS STRING) AS "Field Supplied ",
       field_supplied_pct AS "Field Supplied %",
       CAST(field_matched AS STRING) || '/' || CAST(field AS STRING) AS "Field Matched ",
       field_matched_pct AS "Field Matched %"
FROM (SELECT * REPLACE ({_percent('field_supplied_pct')}, {_percent('field_matched_pct')}) FROM ratios)""",
        "conformance_overview": f"""
WITH {_SCORED_FIELDS},
dim AS (SELECT * FROM (VALUES {", ".join(f"('{d}')" for d in SPATIAL)}) AS t(dataset))
SELECT d.dataset, count(*) FILTER (WHERE r.field_supplied_pct < 0.5) AS "< 50%",
       count(*) FILTER (WHERE r.field_supplied_pct >= 0.5 AND r.field_supplied_pct < 0.8) AS "50% - 80%",
       count(*) FILTER (WHERE r.field_supplied_pct >= 0.8) AS "> 80%"
FROM dim d LEFT JOIN ratios r ON r.dataset = d.dataset GROUP BY d.dataset""",
        "conformance_full_match": f"""
WITH {_SCORED_FIELDS}
SELECT round_even(100.0 * count(*) FILTER (WHERE field_matched_pct = 1) / count(*), 1) AS percent_100_field_match FROM ratios""",
        "issue_fields": f"""
WITH {_SPEC}
SELECT i.* REPLACE (w.field AS field) FROM issue_summary i
LEFT JOIN (SELECT DISTINCT dataset, field FROM wanted) w ON w.dataset = i.dataset
  AND w.field = CASE i.field WHEN 'entity' THEN 'reference' ELSE i.field END
WHERE i.pipeline IN ({_list(ODP)})""",
        "export_table": "SELECT * FROM issue_summary",
        "io_roundtrip_csv": """
SELECT CASE WHEN listed_building <> 'n/a' THEN listed_building END AS listed_building, reference,
       CAST(organisation_entity AS STRING) AS organisation_entity
FROM listed_building_outline WHERE organisation_entity IS NOT NULL""",
        "io_roundtrip_json": "SELECT * FROM entity",
        "io_pages": "SELECT * FROM historic_endpoint",
        "io_entities": """
SELECT dataset, entity, name, organisation_entity,
       CASE WHEN dataset IN ('article-4-direction-area', 'tree') THEN '' ELSE reference END AS reference
FROM entity""",
        "io_ragged_union": """
SELECT dataset, entity, reference, name, organisation_entity FROM entity
UNION ALL
SELECT 'listed-building-outline', entity, reference, NULL, organisation_entity FROM listed_building_outline
UNION ALL
SELECT 'lookup', entity, NULL, NULL, NULL FROM lookup""",
        "io_split": f"""
WITH {_NO_PROVISION}
SELECT endpoint, source, collection, endpoint_url, organisation, dataset,
       CASE WHEN ends_with(lower(coalesce(endpoint_url, '')), '.pdf') THEN 'pdf' ELSE 'other' END AS part FROM gaps""",
        "io_empty": "SELECT dataset FROM dataset_registry WHERE dataset = 'no such dataset'",
        "io_pages_records": "SELECT * FROM lookup",
        "io_pages_csv": "SELECT rowid, dataset, nullif(resource, '') AS resource FROM resource_dataset",
        "owner_distincts": """
SELECT dataset, organisation, count(DISTINCT endpoint) + CAST(bool_or(endpoint IS NULL) AS INT) AS endpoints,
       count(DISTINCT resource) + CAST(bool_or(resource IS NULL) AS INT) AS resources,
       count(DISTINCT organisation_name) + CAST(bool_or(organisation_name IS NULL) AS INT) AS names
FROM historic_endpoint GROUP BY dataset, organisation""",
        "page_last": """
SELECT rowid, endpoint, endpoint_entry_date FROM (
  SELECT *, row_number() OVER (ORDER BY endpoint_entry_date DESC, rowid) - 1 AS nr, count(*) OVER () AS total FROM historic_endpoint)
WHERE nr // 700 = (total - 1) // 700""",
        "page_numbers": """
SELECT rowid, endpoint, endpoint_entry_date,
       (row_number() OVER (ORDER BY endpoint_entry_date DESC, rowid) - 1) // 700 AS page
FROM historic_endpoint""",
        "page": """
SELECT rowid, endpoint, endpoint_entry_date FROM historic_endpoint
ORDER BY endpoint_entry_date DESC, rowid LIMIT 1000 OFFSET 1000""",
    }


def _totals(reports: dict[str, str], measures: dict[str, tuple[str, str]]) -> str:
    """A line of totals by report and group, from the SQL of the reports."""
    lines = []
    for name, (group, measure) in measures.items():
        group, measure = (x.replace("`", '"') for x in (group, measure))
        lines.append(
            f"""SELECT '{name}' AS report, nullif(CAST({group} AS STRING), '') AS part, count(*) AS n,
                CAST({measure} AS BIGINT) AS measure FROM ({reports[name]}) AS r GROUP BY ALL"""
        )
    return " UNION ALL ".join(lines)


def oracle_sql() -> dict[str, str]:
    reports = _oracles()
    for name, measures in (
        ("resource_reports", RESOURCE_TOTALS),
        ("quality_reports", QUALITY_TOTALS),
        ("conformance_reports", CONFORMANCE_TOTALS),
    ):
        reports[name] = _totals(reports, measures)
    return {name: with_views(sql) for name, sql in reports.items()}
