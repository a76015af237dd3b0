"""DataFrame operators."""

from .filters import (
    active,
    ended,
    exclude,
    isin,
    missing,
    order_columns,
    timestamp_of,
    with_prefix,
)
from .groups import (
    band_counts,
    covers_days,
    first_non_null,
    group_any,
    group_count,
    group_distinct,
    group_min_max,
    grouped,
    known_keys,
    missing_stats,
    representative,
    row_multiplicity,
)
from .joins import (
    coverage_grid,
    enrich_roles,
    exists_flag,
    in_set,
    inner_on,
    join_coerced,
    join_on,
    left_join_m1,
    left_many,
    left_on,
    lookup_by_dataset,
    map_column,
    missing_in,
    outer_compare,
    repeated,
    spread_join,
    unique_on,
)
from .ordered import dedupe, dedupe_by_id, latest, number_within, sort_desc, sort_report, top_groups
from .paging import page, page_count, page_numbers, read_page, rows_between, store_ordered
from .reshape import (
    array_len,
    criteria_flags,
    distinct_values,
    explode_entities,
    explode_matches,
    fill_pivot,
    pivot_labels,
    spec_fields,
)
from .sets import minus, sorted_distinct, union_all, union_datasets, union_keys

__all__ = [name for name in dir() if not name.startswith("_")]
