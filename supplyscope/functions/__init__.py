"""Column expressions. Everything here stays inside Catalyst: no Python UDFs."""

from .coerce import parse_ts, to_day, to_long, to_number_or_zero
from .dates import age_days, as_of_column, date_text, days_ago, months_ago, week_monday
from .flags import (
    bool_text,
    cap,
    flag,
    fraction,
    guarded_ratio,
    is_blank,
    minus_one_to_zero,
    recode,
    same,
    true_only,
    yes_no,
)
from .text import (
    decile_band,
    ends_with_ci,
    first_match,
    join_code,
    json_value,
    like_ci,
    n_of_total,
    parse_details,
    percent_label,
    pretty,
    pretty_text,
    remove_text,
    strip_prefix,
)

__all__ = [name for name in dir() if not name.startswith("_")]
