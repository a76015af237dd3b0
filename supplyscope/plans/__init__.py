"""The reports. Each takes a mapping of table names to DataFrames (``sources.TABLES`` lists them) and
returns a lazy DataFrame; reports that depend on the clock take ``as_of``."""

from .conformance import (
    conformance,
    conformance_display,
    conformance_full_match,
    conformance_headed,
    conformance_overview,
    conformance_reports,
    issue_fields,
)
from .counts import resource_detailed_counts, resource_reports, resource_vs_platform
from .endpoints import (
    documentation_stats,
    documentation_top,
    ended_orgs_active_endpoints,
    endpoints_documentation,
    endpoints_no_provision,
    endpoints_pdf_only,
    flagged_failed_resources,
    runaway_resources,
)
from .entities import (
    deleted_entities,
    duplicate_pairs,
    duplicate_pairs_geo,
    entities_with_ended_orgs,
    listed_building_end_date,
)
from .logs import logs_by_week, operational_issues
from .quality import (
    authoritative_lookup,
    dataset_scope,
    quality_detail,
    quality_reports,
    quality_scores,
    quality_single_source,
)
from .supply import odp_issue, odp_status, plan_issue, plan_status

__all__ = [name for name in dir() if not name.startswith("_")]
