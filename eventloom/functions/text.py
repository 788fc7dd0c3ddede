"""String helpers. Each one is a built-in expression, so plans stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The host patterns of the page analyses.
HOST_PATTERN = r"^https?://[^/]+"
UNANCHORED_HOST_PATTERN = r"https?://[^/]+"


def remove_all(text: Column, pattern: str) -> Column:
    """Drop every match of ``pattern``."""
    return F.regexp_replace(text, pattern, "")


def remove_first(text: Column, pattern: str) -> Column:
    """Drop the first match of ``pattern`` only (the pattern must not start with ``^``)."""
    return F.regexp_replace(text, f"(?s)^(.*?)(?:{pattern})", "$1")


def before(text: Column, mark: str) -> Column:
    """Everything ahead of the first ``mark``; the whole text without one. Much cheaper than a pattern."""
    return F.substring_index(text, mark, 1)


def url_path(url: Column) -> Column:
    """Path of a URL without host, query and fragment; ``/`` when nothing is left or the URL is NULL."""
    path = before(before(remove_all(url, HOST_PATTERN), "?"), "#")
    return F.when(path.isNull() | (path == ""), F.lit("/")).otherwise(path)


def url_path_keep_fragment(url: Column) -> Column:
    """Query dropped, then the first host-like part; fragment and empty path are kept as they are."""
    return remove_first(before(url, "?"), UNANCHORED_HOST_PATTERN)


def url_path_one_pass(url: Column) -> Column:
    """Host and query dropped; fragment and empty path are kept as they are."""
    return before(remove_all(url, HOST_PATTERN), "?")


def extract_day(text: Column) -> Column:
    """First run of eight digits, NULL when there is none."""
    return F.nullif(F.regexp_extract(text, r"(\d{8})", 1), F.lit(""))


def title_case(text: Column) -> Column:
    """Capital first letter and small rest for each word, where punctuation also separates words."""
    pieces = F.regexp_extract_all(text, F.lit(r"([\p{L}\p{N}_]+|[^\p{L}\p{N}_]+)"), F.lit(1))
    return F.array_join(F.transform(pieces, lambda piece: F.initcap(piece)), "")


def truncate_label(text: Column, width: int) -> Column:
    """At most ``width`` characters including a closing ``...``."""
    if width < 4:
        raise ValueError("width must be at least 4")
    return F.when(F.length(text) > width, F.concat(F.substring(text, 1, width - 3), F.lit("..."))).otherwise(text)


def bracket_label(text: Column) -> Column:
    """``[text]``"""
    return F.concat(F.lit("["), text, F.lit("]"))


def is_blank(text: Column) -> Column:
    """TRUE for NULL, empty and whitespace-only text."""
    return F.coalesce(F.length(F.trim(text)) == 0, F.lit(True))


def comma(number: Column) -> Column:
    """Whole number with thousands separators."""
    return F.format_number(number, 0)


def percent(share: Column, digits: int = 1) -> Column:
    """Share as a percentage text."""
    return F.concat(F.format_number(share * 100, digits), F.lit("%"))


def dollar(amount: Column) -> Column:
    """Amount as US dollars with cents."""
    return F.concat(F.lit("$"), F.format_number(amount, 2))
