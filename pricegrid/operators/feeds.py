"""HTML price tables as feed records."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, functions as F

from pricegrid import schemas
from pricegrid.functions.prices import currency, parse_price, too_large
from pricegrid.functions.text import fold, null_token, squeeze
from pricegrid.operators.html import FEES_DATE, FLOWERS_DATE, parsed_rows

# What the cells of a table row are, from left to right.
FLOWER_CELLS = ["vendor", "description", "unit", "price"]
FEE_CELLS = [
    "province", "town", "route", "company", "phone_number", "representative",
    "stop", "line", "cost",
]


def run_date(day: datetime.date | None = None) -> Column:
    return F.lit(day) if day else F.current_date()


def positional_records(rows: DataFrame, names: list[str], day: datetime.date | None = None) -> DataFrame:
    """Name the leading cells of each row; rows with too few cells are headers."""
    keep = [c for c in ("page_id", "row_no") if c in rows.columns]
    return rows.filter(F.size("cells") >= len(names)).select(
        *keep,
        *[F.get("cells", F.lit(i)).alias(name) for i, name in enumerate(names)],
        currency().alias("currency"),
        "last_published_at",
        run_date(day).alias("last_updated_at"),
    )


def flowers(pages: DataFrame, day: datetime.date | None = None) -> DataFrame:
    """Flower prices in feed order, with the price text as found."""
    rows = parsed_rows(pages.filter(F.col("html").contains("table-striped")), FLOWERS_DATE)
    return positional_records(rows, FLOWER_CELLS, day).select(*schemas.FLOWERS.names)


def transport_fees(pages: DataFrame, day: datetime.date | None = None) -> DataFrame:
    """Bus fares in feed order, with the cost text as found."""
    rows = parsed_rows(pages.filter(F.col("html").contains("table-striped")), FEES_DATE)
    return positional_records(rows, FEE_CELLS, day).select(*schemas.TRANSPORT_FEES.names)


def typed(feed: DataFrame, amount: str) -> DataFrame:
    """Keep the text as ``<amount>_text`` and make the column a number.

    An amount that the type cannot hold is NULL and flagged ``<amount>_too_large``.
    """
    return feed.withColumns(
        {f"{amount}_text": F.col(amount), f"{amount}_too_large": too_large(F.col(amount))}
    ).withColumn(amount, parse_price(F.col(amount)))


def cleaned(feed: DataFrame, amount: str, folded: tuple[str, ...] = ()) -> DataFrame:
    """Tidy a raw feed: single spaces, NULL for "missing", a typed amount.

    Columns in ``folded`` get a copy without case and accents, ``<name>_folded``,
    to compare and join by. Every row stays. One without an amount has NULL and is flagged
    ``<amount>_missing``; an amount of zero is an amount.
    """
    texts = [f.name for f in feed.schema if f.dataType.typeName() == "string"]
    tidy = feed.withColumns({name: null_token(squeeze(F.col(name))) for name in texts})
    tidy = tidy.withColumns({f"{name}_folded": fold(F.col(name)) for name in folded})
    return typed(tidy, amount).withColumn(f"{amount}_missing", F.col(amount).isNull())
