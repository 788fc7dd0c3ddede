"""Conditional and arithmetic helpers with the NULL rules of the analyses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from eventloom.functions.dates import to_integer
from eventloom.functions.text import title_case


def if_else(condition: Column, yes: Column, no: Column) -> Column:
    """Like ``when/otherwise``, but a NULL condition gives NULL."""
    return F.when(condition, yes).when(~condition, no)


def not_in(value: Column, options: Sequence) -> Column:
    """TRUE unless ``value`` is one of ``options``; NULL counts as not contained."""
    return ~F.coalesce(value.isin(*options), F.lit(False))


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Ratio as a double, NULL for a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def recode(value: Column, labels: dict[str, str]) -> Column:
    """Replace the values named in ``labels``; others stay."""
    result = None
    for old, new in labels.items():
        branch = (value == old, F.lit(new))
        result = F.when(*branch) if result is None else result.when(*branch)
    return value if result is None else result.otherwise(value)


def position_in(value: Column, options: Sequence[str]) -> Column:
    """One-based position of ``value`` in ``options``, NULL when absent."""
    position = F.array_position(F.array(*[F.lit(option) for option in options]), value)
    return F.nullif(position, F.lit(0).cast("long")).cast("int")


def channel_group(medium: Column) -> Column:
    """Marketing channel of a traffic medium; the first matching rule wins."""
    return (
        F.when(medium.isNull() | (medium == "(none)"), F.lit("Direct"))
        .when(medium == "organic", F.lit("Organic Search"))
        .when(medium.isin("cpc", "ppc"), F.lit("Paid Search"))
        .when(medium.contains("email"), F.lit("Email"))
        .when(medium.contains("social"), F.lit("Social"))
        .otherwise(title_case(medium))
    )


def page_section(path: Column) -> Column:
    """Site section of a page path; the first matching rule wins. ``/store`` and ``/cart`` count anywhere in it."""
    return (
        F.when(path == "/", F.lit("Home"))
        .when(path.startswith("/google+re") | path.contains("/store"), F.lit("Store"))
        .when(path.startswith("/product"), F.lit("Products"))
        .when(path.startswith("/basket") | path.contains("/cart"), F.lit("Cart"))
        .when(path.startswith("/checkout"), F.lit("Checkout"))
        .otherwise(F.lit("Other"))
    )


def user_type(session_number: Column) -> Column:
    """New or returning, from the session number of the user; NULL when that is not a number."""
    return if_else(to_integer(session_number) == 1, F.lit("New User"), F.lit("Returning User"))
