"""Prices, ids and constants as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

CURRENCY = "DOP"


def _amount(text: Column) -> Column:
    token = F.regexp_extract(text, r"[0-9][0-9.,\s\u00a0]*", 0)
    amount = F.rtrim(F.translate(token, " \t\n\x0b\x0c\r\u00a0", ""), F.lit(".,"))
    marked = F.regexp_replace(amount, r"[.,]([0-9]{1,2}|[0-9]{4,})\z", "_$1")
    return F.translate(marked, "_.,", ".")


def parse_price(text: Column) -> Column:
    """First amount in a text as ``decimal(18,4)``, NULL if there is none.

    A last separator with exactly three digits behind it groups thousands; with
    one, two, or more than three it is the decimal point. All others group. The
    type holds 14 whole digits; a larger amount is NULL and ``too_large``.
    """
    return _amount(text).try_cast("decimal(18,4)")


def too_large(text: Column) -> Column:
    """True for a text whose amount has more whole digits than the type holds."""
    whole = F.ltrim(F.substring_index(_amount(text), ".", 1), F.lit("0"))
    return F.coalesce(F.length(whole) > 14, F.lit(False))


def is_priced(price: Column) -> Column:
    """True for a price that is neither missing nor zero."""
    return F.coalesce(price != 0, F.lit(False))


def currency() -> Column:
    return F.lit(CURRENCY)


def observation_id(*parts: Column | str) -> Column:
    """Id that a retry, a replay or a reload reproduces.

    Each part goes in with its length, a NULL as a dash: so no two lists of
    parts are written alike, whatever is in them.
    """
    columns = [(F.col(part) if isinstance(part, str) else part).cast("string") for part in parts]
    told = [F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")) for text in columns]
    return F.md5(F.concat_ws(",", *told))
