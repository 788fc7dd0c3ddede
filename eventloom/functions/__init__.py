"""Column helpers: strings, dates, conditionals and numbers."""

from eventloom.functions.conditional import (
    channel_group,
    if_else,
    not_in,
    page_section,
    position_in,
    recode,
    safe_divide,
    user_type,
)
from eventloom.functions.dates import (
    day_suffix,
    event_time,
    month_floor,
    parse_day,
    period_label,
    to_integer,
    with_date_parts,
    with_partition_columns,
)
from eventloom.functions.text import (
    bracket_label,
    comma,
    dollar,
    extract_day,
    is_blank,
    percent,
    remove_all,
    remove_first,
    title_case,
    truncate_label,
    url_path,
    url_path_keep_fragment,
    url_path_one_pass,
)

__all__ = [name for name in dir() if not name.startswith("_")]
