"""Fixed values that decide which rows and columns the reports hold."""

from __future__ import annotations

# Project, cohort and provision codes.
ODP_PROJECT = "open-digital-planning"
LOCAL_PLAN = "local-plan"
LPA_ROLE = "local-planning-authority"

# Dataset names.
SPATIAL_DATASETS = [
    "article-4-direction-area",
    "conservation-area",
    "listed-building-outline",
    "tree",
    "tree-preservation-zone",
]
DOCUMENT_DATASETS = ["article-4-direction", "conservation-area-document", "tree-preservation-order"]
ODP_DATASETS = sorted(SPATIAL_DATASETS + DOCUMENT_DATASETS)
PLAN_DATASETS = ["local-plan", "minerals-plan", "plan-timetable", "supplementary-plan", "waste-plan"]
COUNTED_DATASETS = sorted([*ODP_DATASETS, "local-plan", "plan-timetable"])

# Datasets by the collection they are gathered in.
ODP_COLLECTIONS = {
    "article-4-direction": ["article-4-direction", "article-4-direction-area"],
    "conservation-area": ["conservation-area", "conservation-area-document"],
    "listed-building": ["listed-building-outline"],
    "tree-preservation-order": ["tree", "tree-preservation-order", "tree-preservation-zone"],
}
PLAN_COLLECTIONS = {"local-plan": PLAN_DATASETS}

# Quality levels.
QUALITY_LABELS = {
    0: "0. no data",
    1: "1. non-authoritative/some data",
    2: "2. non-authoritative usable data",
    3: "3. non-authoritative trustworthy data",
    4: "4. authoritative data",
    5: "5. authoritative usable data",
    6: "6. authoritative trustworthy data",
}
NO_ISSUE_SEVERITY = 4
AUTHORITATIVE_STEP = 3
STALE_AFTER_DAYS = 365
STALE_RUNG = 2
READY_LEVEL = 4

# Criteria that come from failed expectations instead of issues.
COUNT_CRITERION = "3 - entity count matches LPA"
BOUNDARY_CRITERION = "3 - entities within LPA boundary"
EXPECTATION_LEVEL = 3
COUNT_EXPECTATION = (
    "Check number of conservation-area entities inside the local planning authority boundary matches the manual count"
)
UNSCORED_ORGANISATION = "Waveney District Council"

# Fields that the processing adds itself and no supplier has to give.
AUTO_FIELDS = ["entity", "organisation", "prefix"]
AUTO_FIELDS_UNLESS_TREE = ["point"]

# Document types looked for in a failed URL, in order of precedence.
DOCUMENT_TYPES = ["pdf", "doc", "docx", "xls", "xlsx", "ppt", "pptx"]
PDF_URLS = [
    "https://www.bolton.gov.uk/downloads/file/3212/infrastructure-funding-statement",
    "https://www.bolton.gov.uk/downloads/file/4045/infrastructure-funding-statement-2019-20",
]
DOCUMENT_LINKS = "active document links"

# What is reported of a failed URL, as group and details.
ZIP_FINDING = ("zipped file", "file needs to be unzipped first")
XLS_FINDING = ("XLS files", "Possible issues with opening xls file")
NAMED_IN_URL = [(".", "file in URL"), ("-", "inferred from slug")]
PDF_FINDING = (DOCUMENT_LINKS, "confirmed via Content-Type check")
JSON_REFUSAL = ("auth error", "Token or authentication required (JSON error response)")
TEXT_REFUSAL = ("auth error", "Token or authentication required (text body)")
WRONG_TYPE = ("wfs error", "Likely invalid typeName - check WFS GetCapabilities")
KNOWN_PDF = (DOCUMENT_LINKS, "manually flagged as pdf")

NO_ENDPOINT = "No endpoint added"
COUNTRY_SUFFIX = "-eng"


def members(collections: dict[str, list[str]]) -> list[dict[str, str]]:
    return [{"collection": c, "pipeline": p} for c, pipelines in collections.items() for p in pipelines]
