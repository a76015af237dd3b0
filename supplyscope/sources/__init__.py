"""Readers, writers and table schemas."""

from .readers import (
    dataset_slugs,
    read_columnar_json,
    read_csv_strings,
    read_csv_table,
    read_entities,
    read_json_records,
    read_pages,
    read_specification,
)
from .schemas import TABLES
from .scratch import materialise, scratch_dir
from .shared import Shared, shared
from .writers import export_table, write_report, write_reports, write_split

__all__ = [name for name in dir() if not name.startswith("_")]
