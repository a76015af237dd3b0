"""Columns and types of the tables the reports read.

Dates are nullable: a blank end date means that the thing has not ended. Texts that a report itself
has to coerce (counts in a resource table, log dates) are declared as strings.
"""

from __future__ import annotations

TABLES: dict[str, str] = {
    "organisation": """entity bigint, organisation string, name string, reference string, dataset string,
        end_date date, local_planning_authority string""",
    "provision": """organisation string, dataset string, cohort string, start_date date, project string,
        provision_reason string, specification string""",
    "provision_rule": "dataset string, project string, provision_reason string, role string",
    "cohort": "cohort string, start_date date",
    "endpoint": "endpoint string, endpoint_url string, end_date date",
    "source": """rowid bigint, source string, endpoint string, organisation string, collection string,
        documentation_url string, entry_date string, end_date date""",
    "source_pipeline": "source string, pipeline string",
    "resource": "resource string, start_date date, end_date date",
    "converted_resource": "resource string, dataset string, elapsed double, exception string, status string",
    "resource_endpoint": "rowid bigint, endpoint string, resource string",
    "resource_dataset": "rowid bigint, dataset string, resource string",
    "historic_endpoint": """rowid bigint, organisation string, name string, organisation_name string,
        dataset string, collection string, pipeline string, endpoint string, endpoint_url string,
        endpoint_entry_date date, endpoint_end_date date, resource string, resource_start_date date,
        resource_end_date date, latest_status int, latest_log_entry_date string""",
    "latest_endpoint": """organisation string, collection string, pipeline string, dataset string,
        endpoint string, endpoint_url string, licence string, latest_status int, days_since_200 int,
        latest_exception string, resource string, latest_log_entry_date string, endpoint_entry_date date,
        endpoint_end_date date, resource_start_date date, resource_end_date date""",
    "endpoint_dataset_summary": """endpoint string, dataset string, end_date date, entry_date date,
        latest_status int, latest_exception string""",
    "field_summary": """rowid bigint, organisation string, organisation_name string, cohort string,
        dataset string, pipeline string, endpoint string, resource string, mapping_field string,
        non_mapping_field string, latest_log_entry_date string""",
    "issue_summary": """organisation string, cohort string, dataset string, pipeline string,
        endpoint string, endpoint_url string, resource string, issue_type string, severity string,
        responsibility string, field string, count_issues bigint, collection string,
        latest_log_entry_date string, resource_start_date date, resource_end_date date""",
    "issue_type": "issue_type string, quality_criteria string, quality_criteria_level int",
    "quality": "quality string, priority int",
    "expectation": """rowid bigint, dataset string, organisation string, operation string, name string,
        message string, passed string, details string""",
    "entity": """entity bigint, dataset string, name string, reference string, organisation_entity bigint,
        quality string, entry_date date, end_date date, geometry string""",
    "lookup": "rowid bigint, dataset string, organisation string, entity bigint",
    "dataset_resource": """rowid bigint, dataset string, resource string, entity_count string,
        entry_count string, line_count string""",
    "dataset_registry": "dataset string",
    "log": "endpoint string, entry_date timestamp_ntz, status int",
    "operational_issue": "entry_date date",
    "specification": "json string",
    "planning_authority": "reference string, name string, geometry string",
    "listed_building": "reference string, end_date string",
    "listed_building_outline": """listed_building string, reference string, entity bigint,
        organisation_entity bigint""",
    "url_probe": """url string, head_content_type string, content_type string, status int, body string""",
}
