"""Domain tables derived from the generated test tables.

The SQL is plain enough to run unchanged in Spark and in DuckDB, so a report and its oracle see the same
input. Every view keeps all rows of the table it reads. Keys without a match, nulls, repeats and shared
keys come from the projection, never from leaving rows out.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ["customer", "orders", "lineitem", "part", "events", "documents", "labels", "pages"]

SPATIAL = [
    "conservation-area",
    "article-4-direction-area",
    "listed-building-outline",
    "tree",
    "tree-preservation-zone",
]
PLANS = ["local-plan", "minerals-plan", "plan-timetable", "supplementary-plan", "waste-plan"]


def _pick(expr: str, names: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names[:-1]))
    return f"CASE {expr} {whens} ELSE '{names[-1]}' END"


def _text(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def _kind(key: str) -> str:
    return f"CASE WHEN {key} % 5 = 0 THEN 'national-park-authority' ELSE 'local-authority' END"


def _code(key: str) -> str:
    """Organisation code; some keys give a code that no organisation has."""
    return f"CASE WHEN {key} % 29 = 3 THEN 'unregistered' ELSE {_kind(key)} END || ':' || {_text(key)}"


def _name(key: str) -> str:
    return f"'Customer#' || lpad({_text(key)}, 9, '0')"


_DIGIT = "CAST(substr(o_orderpriority, 1, 1) AS INT)"
_SPATIAL_PIPELINE = _pick(_DIGIT + " - 1", SPATIAL)
_ENDPOINT = f"'ep' || {_text('o_custkey')} || '-' || substr(o_orderpriority, 1, 1)"
_DOC_DATASET = _pick("doc_id % 5", SPATIAL)
_ISSUE_DATASET = f"CASE WHEN l_linenumber % 3 = 0 THEN {_pick('l_orderkey % 5', PLANS)} ELSE {_pick('l_orderkey % 5', SPATIAL)} END"

VIEWS: dict[str, str] = {
    "organisation": f"""
SELECT c_custkey AS entity, {_kind('c_custkey')} || ':' || {_text('c_custkey')} AS organisation,
       CASE WHEN c_custkey % 43 = 11 THEN 'Waveney District Council' ELSE c_name END AS name,
       {_text('c_custkey')} AS reference,
       CASE WHEN c_custkey % 31 = 7 THEN NULL ELSE {_kind('c_custkey')} END AS dataset,
       CASE WHEN c_custkey % 10 = 0 THEN DATE '2000-01-01' END AS end_date,
       CASE WHEN c_nationkey < 20 THEN 'E' || {_text('c_custkey')} END AS local_planning_authority
FROM customer""",
    "planning_authority": f"""
SELECT 'E' || {_text('c_custkey')} AS reference, c_name AS name,
       CASE WHEN c_custkey % 6 <> 1 THEN 'MULTIPOLYGON EMPTY' END AS geometry
FROM customer""",
    "historic_endpoint": f"""
SELECT o_orderkey AS rowid, {_code('o_custkey')} AS organisation,
       CASE WHEN o_custkey % 19 != 7 THEN {_name('o_custkey')} END AS name,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE {_name('o_custkey')} END AS organisation_name,
       {_SPATIAL_PIPELINE} AS dataset, {_SPATIAL_PIPELINE} AS pipeline,
       'c-' || substr(o_orderpriority, 1, 1) AS collection,
       {_ENDPOINT} AS endpoint,
       'https://data.example.org/' || {_text('o_custkey')} || '/' || substr(o_orderpriority, 1, 1)
         || CASE WHEN o_custkey % 6 = 0 THEN '.PDF' ELSE '' END AS endpoint_url,
       CAST(o_orderdate AS DATE) AS endpoint_entry_date,
       CASE WHEN o_custkey % 13 = 0 THEN DATE '2001-12-31' END AS endpoint_end_date,
       CASE WHEN o_orderkey % 97 = 5 THEN '' ELSE 'r' || {_text('o_orderkey - o_orderkey % 2')} END AS resource,
       CAST(o_orderdate AS DATE) AS resource_start_date,
       CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END AS resource_end_date,
       CASE WHEN o_orderstatus = 'P' AND o_orderkey % 3 = 0 THEN 404 ELSE 200 END AS latest_status,
       CASE WHEN o_orderkey % 8 = 1 THEN 'unknown' ELSE substr({_text('o_orderdate')}, 1, 10) END AS latest_log_entry_date
FROM orders""",
    "resource_history": f"""
SELECT event_id AS rowid,
       CASE WHEN user_id % 37 = 4 THEN NULL
            ELSE 'ep' || {_text('user_id')} || '-' || {_text('event_id % (1 + user_id % 40)')} END AS endpoint,
       CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_type END AS collection,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE {_name('user_id')} END AS organisation_name,
       {_pick('user_id % 5', SPATIAL)} AS dataset, {_pick('user_id % 5', SPATIAL)} AS pipeline,
       CAST(ts AS DATE) AS endpoint_entry_date, CAST(ts AS DATE) AS resource_start_date,
       CASE WHEN user_id % 7 = 2 THEN NULL
            WHEN user_id % 7 = 3 THEN DATE '2023-12-01'
            WHEN event_type = 'purchase' THEN CAST(ts AS DATE)
            WHEN event_type = 'signup' THEN CAST(ts + INTERVAL '5' DAY AS DATE) END AS resource_end_date,
       CASE WHEN user_id % 9 = 0 THEN DATE '2024-01-31' END AS endpoint_end_date
FROM events""",
    "log": f"""
SELECT CASE WHEN user_id % 17 = 0 THEN NULL ELSE 'ep' || {_text('user_id')} END AS endpoint,
       ts AS entry_date,
       CASE WHEN event_type = 'error' THEN 500 WHEN event_type = 'signup' AND user_id % 5 = 0 THEN NULL
            ELSE 200 END AS status
FROM events""",
    "operational_issue": """
SELECT CAST(entry_date AS DATE) AS entry_date FROM log""",
    "latest_endpoint": f"""
SELECT CASE WHEN o_custkey % 4 = 1 THEN 'former:' || {_text('o_custkey')} ELSE {_code('o_custkey')} END
         || CASE WHEN o_custkey % 3 = 0 THEN '-eng' ELSE '' END AS organisation,
       CASE WHEN o_orderkey % 2 = 0 THEN 'spatial' ELSE 'plan' END AS collection,
       CASE WHEN o_orderkey % 2 = 0 THEN {_SPATIAL_PIPELINE} ELSE {_pick(_DIGIT + ' - 1', PLANS)} END AS pipeline,
       CASE WHEN o_orderkey % 2 = 0 THEN {_SPATIAL_PIPELINE} ELSE {_pick(_DIGIT + ' - 1', PLANS)} END AS dataset,
       {_ENDPOINT} AS endpoint, 'https://data.example.org/' || {_text('o_custkey')} AS endpoint_url,
       CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE 'ogl3' END AS licence,
       CASE WHEN max(o_totalprice) > 400000 THEN 404 ELSE 200 END AS latest_status,
       CASE WHEN max(o_totalprice) > 400000 THEN CAST(o_custkey % 60 AS INT) END AS days_since_200,
       CASE WHEN max(o_totalprice) > 400000 THEN 'not found' END AS latest_exception,
       'r' || {_text('max(o_orderkey)')} AS resource,
       substr({_text('max(o_orderdate)')}, 1, 10) AS latest_log_entry_date,
       CAST(min(o_orderdate) AS DATE) AS endpoint_entry_date,
       CASE WHEN o_custkey % 13 = 0 THEN DATE '2001-12-31' END AS endpoint_end_date,
       CAST(max(o_orderdate) AS DATE) AS resource_start_date, CAST(NULL AS DATE) AS resource_end_date
FROM orders GROUP BY o_custkey, o_orderpriority, o_orderkey % 2""",
    "endpoint_dataset_summary": """
SELECT endpoint, dataset, endpoint_end_date AS end_date, endpoint_entry_date AS entry_date, latest_status,
       latest_exception
FROM latest_endpoint""",
    "field_summary": f"""
SELECT rowid, organisation,
       CASE WHEN rowid % 11 = 0 THEN NULL ELSE name END AS organisation_name,
       CASE WHEN rowid % 23 = 0 THEN '' WHEN rowid % 29 = 0 THEN NULL
            ELSE 'cohort-' || substr(endpoint, length(endpoint), 1) END AS cohort,
       dataset, pipeline, endpoint, resource,
       CASE rowid % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'reference;name;geometry;notes'
            ELSE 'reference;name;unlisted' END AS mapping_field,
       CASE rowid % 4 WHEN 0 THEN 'notes;start-date' WHEN 1 THEN NULL ELSE 'unlisted' END AS non_mapping_field,
       latest_log_entry_date
FROM historic_endpoint""",
    "specification": """
SELECT '[{"dataset": "tree", "fields": [{"field": "entity"}, {"field": "point"}, {"field": "reference"}, {"field": "name"}, {"field": "notes"}]}, {"dataset": "conservation-area", "fields": [{"field": "entity"}, {"field": "point"}, {"field": "reference"}, {"field": "name"}, {"field": "geometry"}, {"field": "start-date"}]}, {"dataset": "article-4-direction-area", "fields": [{"field": "prefix"}, {"field": "reference"}, {"field": "name"}, {"field": "geometry"}, {"field": "notes"}]}, {"dataset": "listed-building-outline", "fields": [{"field": "reference"}]}]' AS json""",
    "issue_summary": f"""
SELECT {_code('l_suppkey')} || CASE WHEN l_suppkey % 3 = 0 AND l_linenumber % 3 = 0 THEN '-eng' ELSE '' END AS organisation,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE 'cohort-' || {_text('1 + l_suppkey % 5')} END AS cohort,
       {_ISSUE_DATASET} AS dataset, {_ISSUE_DATASET} AS pipeline,
       'ep' || {_text('l_suppkey')} || '-' || {_text('1 + l_orderkey % 5')} AS endpoint,
       'https://data.example.org/' || {_text('l_suppkey')} AS endpoint_url,
       CASE WHEN l_orderkey % 5 = 0 THEN 'x' ELSE 'r' END || {_text('l_orderkey')} AS resource,
       CASE WHEN l_linenumber = 6 THEN 'other' ELSE l_returnflag || l_linestatus END AS issue_type,
       CASE l_returnflag WHEN 'R' THEN 'error' WHEN 'A' THEN 'warning' ELSE 'info' END AS severity,
       CASE l_linestatus WHEN 'O' THEN 'external' ELSE 'internal' END AS responsibility,
       CASE l_linenumber % 4 WHEN 0 THEN 'entity' WHEN 1 THEN 'name' WHEN 2 THEN 'geometry' ELSE 'unlisted' END AS field,
       CAST(l_quantity AS BIGINT) AS count_issues, 'c-' || {_text('1 + l_orderkey % 5')} AS collection,
       substr({_text('l_shipdate')}, 1, 10) AS latest_log_entry_date,
       CAST(l_shipdate AS DATE) AS resource_start_date,
       CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS resource_end_date
FROM lineitem""",
    "issue_type": """
SELECT * FROM (VALUES ('RO', 'duplicate reference values', 2), ('RF', 'invalid geometry', 3),
  ('AO', 'unknown entity', 1), ('AF', 'missing value', 3), ('NO', NULL, NULL))
  AS t(issue_type, quality_criteria, quality_criteria_level)""",
    "quality": """
SELECT * FROM (VALUES ('some', 1), ('authoritative', 2)) AS t(quality, priority)""",
    "entity": f"""
SELECT doc_id AS entity, {_DOC_DATASET} AS dataset, source || '-' || {_text('doc_id')} AS name,
       'ref-' || {_text('doc_id')} AS reference,
       CASE WHEN doc_id % 50 = 49 THEN NULL ELSE doc_id % 61 END AS organisation_entity,
       CASE q WHEN 1 THEN 'authoritative' WHEN 0 THEN 'some' END AS quality,
       DATE '2020-01-01' AS entry_date,
       CASE WHEN doc_id % 12 = 0 THEN DATE '2021-01-01' END AS end_date,
       'POINT (' || {_text('doc_id')} || ' ' || {_text('n_chars')} || ')' AS geometry
FROM documents LEFT JOIN (SELECT doc_id AS label_id, quality AS q FROM labels) AS l ON label_id = doc_id""",
    "lookup": f"""
SELECT doc_id AS rowid, {_DOC_DATASET} AS dataset,
       {_code('(doc_id % 61)')} AS organisation,
       CASE WHEN doc_id % 10 >= 5 THEN doc_id - 5 ELSE doc_id END AS entity
FROM documents""",
    "cohort": """
SELECT * FROM (VALUES ('cohort-1', DATE '2021-04-01'), ('cohort-2', DATE '2022-04-01'),
  ('cohort-3', DATE '2023-04-01'), ('cohort-4', DATE '2023-10-01')) AS t(cohort, start_date)""",
    "provision": f"""
SELECT DISTINCT {_code('o_custkey')} AS organisation, {_pick('o_orderkey % 5', SPATIAL)} AS dataset,
       'cohort-' || {_text('1 + o_custkey % 5')} AS cohort,
       CASE WHEN o_custkey % 2 = 0 THEN DATE '2021-04-01' ELSE DATE '2022-04-01' END AS start_date,
       CASE WHEN o_custkey % 7 = 0 THEN 'other' ELSE 'open-digital-planning' END AS project,
       CASE WHEN o_custkey % 4 = 0 THEN 'statutory' WHEN o_custkey % 9 = 1 THEN 'encouraged' ELSE 'expected' END AS provision_reason,
       CASE WHEN o_custkey % 8 = 0 THEN 'local-plan' ELSE 'data-standard' END AS specification
FROM orders""",
    "provision_rule": """
SELECT CASE k WHEN 0 THEN 'tree' WHEN 1 THEN 'conservation-area' WHEN 2 THEN 'listed-building-outline'
              WHEN 3 THEN 'brownfield-land' WHEN 4 THEN 'article-4-direction-area' END AS dataset,
       CASE WHEN k < 2 THEN 'open-digital-planning' END AS project,
       CASE k WHEN 1 THEN 'encouraged' WHEN 2 THEN 'encouraged' WHEN 3 THEN 'statutory' WHEN 4 THEN 'alternative'
              ELSE 'expected' END AS provision_reason,
       CASE WHEN k < 2 THEN 'local-planning-authority' WHEN k = 2 THEN 'other' END AS role
FROM (SELECT o_custkey % 6 AS k FROM orders) AS numbered""",
    "expectation": f"""
SELECT p_partkey * 4 AS rowid, {_pick('p_partkey % 5', SPATIAL)} AS dataset, {_code('p_partkey')} AS organisation,
       'count_deleted_entities' AS operation, 'deleted' AS name, '' AS message,
       CASE WHEN p_partkey % 6 = 5 THEN 'True' ELSE 'False' END AS passed,
       CASE WHEN p_partkey % 7 = 0 THEN '{{"entities": []}}'
            ELSE '{{"entities": ["' || {_text('p_partkey')} || '", "' || {_text('p_partkey + 1')} || '", "x"]}}' END AS details
FROM part
UNION ALL
SELECT p_partkey * 4 + 1, {_pick('p_partkey % 5', SPATIAL)}, {_code('p_partkey')},
       'duplicate_geometry_check', 'duplicates', '', 'False',
       CASE WHEN p_partkey % 11 = 0 THEN 'not parseable' ELSE
       '{{"complete_matches": [{{"entity_a": ' || {_text('p_partkey')} || ', "organisation_entity_a": ' || {_text('p_partkey % 61')}
       || ', "entity_b": ' || {_text('p_partkey + 5')} || ', "organisation_entity_b": null}}], "single_matches": '
       || CASE WHEN p_partkey % 3 = 0 THEN '[{{"entity_a": ' || {_text('p_partkey')} || ', "entity_b": ' || {_text('p_partkey + 2')} || '}}]' ELSE '[]' END
       || '}}' END
FROM part
UNION ALL
SELECT p_partkey * 4 + 2, {_pick('p_partkey % 5', SPATIAL)}, {_code('p_partkey')}, 'count_lpa_boundary',
       CASE WHEN p_partkey % 3 = 0
            THEN 'Check number of conservation-area entities inside the local planning authority boundary matches the manual count'
            ELSE 'Check no entities are OUTSIDE the boundary' END,
       CASE WHEN p_partkey % 4 = 1 THEN 'Error: no boundary' ELSE 'found' END,
       CASE WHEN p_partkey % 2 = 0 THEN 'False' ELSE 'True' END, '{{}}'
FROM part""",
    "page_endpoint": """
SELECT page_id, 'pe' || CAST(page_id AS STRING) AS endpoint, 'p' || CAST(page_id AS STRING) AS resource,
       url || CASE page_id % 10 WHEN 0 THEN '.zip' WHEN 1 THEN '.docx' WHEN 2 THEN '.xlsx' WHEN 3 THEN '/plan-pdf'
                                WHEN 4 THEN '/wfs' WHEN 8 THEN '/sheet-xlsx' ELSE '' END AS url
FROM pages""",
    "url_probe": """
SELECT url || CASE page_id % 10 WHEN 0 THEN '.zip' WHEN 1 THEN '.docx' WHEN 2 THEN '.xlsx' WHEN 3 THEN '/plan-pdf'
                                WHEN 4 THEN '/wfs' WHEN 8 THEN '/sheet-xlsx' ELSE '' END AS url,
       CASE page_id % 10 WHEN 5 THEN 'Application/PDF' ELSE 'text/html' END AS head_content_type,
       CASE page_id % 10 WHEN 6 THEN 'application/json; charset=utf-8' ELSE 'text/html' END AS content_type,
       200 AS status,
       CASE page_id % 10 WHEN 4 THEN '<ServiceException>unknown feature</ServiceException>'
            WHEN 6 THEN '{"error": {"code": 499, "message": "x"}}' WHEN 7 THEN 'Token Required' ELSE html END AS body
FROM pages""",
    "converted_resource": """
SELECT 'p' || CAST(page_id AS STRING) AS resource, 'tree' AS dataset, 1.0 AS elapsed, 'unreadable' AS exception,
       CASE WHEN page_id % 13 = 12 THEN 'converted' ELSE 'failed' END AS status
FROM pages""",
    "resource": """
SELECT 'p' || CAST(page_id AS STRING) AS resource, DATE '2024-01-01' AS start_date,
       CASE WHEN page_id % 17 = 16 THEN DATE '2024-02-01' END AS end_date
FROM pages""",
    "endpoint": """
SELECT endpoint, min(endpoint_url) AS endpoint_url, max(endpoint_end_date) AS end_date
FROM historic_endpoint GROUP BY endpoint
UNION ALL SELECT endpoint, url, CAST(NULL AS DATE) FROM page_endpoint""",
    "source": f"""
SELECT min(rowid) AS rowid, endpoint || '-s1' AS source, endpoint, min(organisation) AS organisation,
       min(collection) AS collection,
       CASE min(rowid) % 4 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE 'https://docs.example.org/' || endpoint END AS documentation_url,
       CASE WHEN min(rowid) % 6 = 5 THEN 'undated' ELSE substr({_text('min(endpoint_entry_date)')}, 1, 10) END AS entry_date,
       max(endpoint_end_date) AS end_date
FROM historic_endpoint GROUP BY endpoint
UNION ALL
SELECT max(rowid) + 1000000000, endpoint || '-s2', endpoint,
       CASE WHEN max(rowid) % 5 = 2 THEN NULL ELSE max(organisation) END, max(collection) || '-b', NULL,
       substr({_text('max(endpoint_entry_date)')}, 1, 10), max(endpoint_end_date)
FROM historic_endpoint GROUP BY endpoint
UNION ALL
SELECT page_id + 2000000000, endpoint || '-s1', endpoint, NULL, 'pages', url, '2024-01-01', CAST(NULL AS DATE)
FROM page_endpoint""",
    "source_pipeline": """
SELECT endpoint || '-s1' AS source, min(pipeline) AS pipeline FROM historic_endpoint GROUP BY endpoint
UNION ALL
SELECT endpoint || '-s2', CASE WHEN max(rowid) % 3 = 0 THEN NULL ELSE max(pipeline) END
FROM historic_endpoint GROUP BY endpoint""",
    "resource_endpoint": """
SELECT rowid, endpoint, resource FROM historic_endpoint
UNION ALL SELECT page_id + 2000000000, endpoint, resource FROM page_endpoint""",
    "resource_dataset": """
SELECT rowid, dataset, resource FROM historic_endpoint
UNION ALL SELECT page_id + 2000000000, 'tree', resource FROM page_endpoint""",
    "dataset_resource": f"""
SELECT l_orderkey * 10 + l_linenumber AS rowid, {_pick('(l_orderkey + l_linenumber) % 5', SPATIAL)} AS dataset,
       'r' || {_text('l_orderkey')} AS resource, {_text('CAST(l_quantity AS BIGINT)')} AS entity_count,
       CASE WHEN l_orderkey % 8 = 0 THEN '' WHEN l_orderkey % 8 = 4 THEN '7.0' ELSE {_text('l_suppkey')} END AS entry_count,
       CASE WHEN l_orderkey % 16 = 0 THEN 'n/a' ELSE {_text('l_partkey')} END AS line_count
FROM lineitem""",
    "listed_building": f"""
SELECT {_text('p_partkey')} AS reference,
       CASE p_partkey % 3 WHEN 0 THEN '2020-01-01' WHEN 1 THEN '' END AS end_date
FROM part""",
    "listed_building_outline": f"""
SELECT CASE l_linenumber WHEN 3 THEN 'n/a' WHEN 4 THEN {_text('l_partkey')} || '.0' ELSE {_text('l_partkey')} END AS listed_building,
       'lbo-' || {_text('l_orderkey')} || '-' || {_text('l_linenumber')} AS reference, l_orderkey AS entity,
       CASE WHEN l_linenumber = 5 THEN NULL ELSE l_suppkey END AS organisation_entity
FROM lineitem""",
    "dataset_registry": """
SELECT DISTINCT dataset FROM entity UNION ALL SELECT DISTINCT dataset FROM issue_summary UNION ALL SELECT NULL""",
}


def _needed(sql: str) -> list[str]:
    """Views that a text reads, each after the views it reads itself."""
    found: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", text):
            if name in VIEWS and name not in found:
                visit(VIEWS[name])
                found.append(name)

    visit(sql)
    return found


def with_views(sql: str) -> str:
    """The query with the views it reads put in front as common table expressions."""
    parts = [f"{name} AS ({VIEWS[name].strip()})" for name in _needed(sql)]
    if not parts:
        return sql
    lead = "WITH " + ",\n".join(parts)
    body = sql.strip()
    return f"{lead},\n{body[5:]}" if body.upper().startswith("WITH ") else f"{lead}\n{body}"


def tables(spark: SparkSession, sf_dir: str, *names: str, **renamed: str) -> dict[str, DataFrame]:
    """The named domain tables; ``renamed`` offers a view under another table's name."""
    chosen = {n: n for n in names} | renamed
    queries = {table: with_views(f"SELECT * FROM {view}") for table, view in chosen.items()}
    for base in BASE_TABLES:
        if any(re.search(rf"\b(?:FROM|JOIN)\s+{base}\b", sql) for sql in queries.values()):
            spark.read.parquet(f"{sf_dir}/{base}.parquet").createOrReplaceTempView(base)
    return {table: spark.sql(sql) for table, sql in queries.items()}
