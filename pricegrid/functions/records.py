"""JSON in feed records: read once, taken apart by path and type, nothing dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def with_fields(feed: DataFrame, column: str, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """Add typed ``fields``, given as ``name: (path, type)``, out of a column of JSON text.

    The text is read once for each row into a variant. ``<column>_broken`` marks
    text that is no JSON, ``<name>_mistyped`` a value that is there and does not
    fit the type; both leave NULL and keep the row. A path that is not there, a
    JSON null and a missing text are NULL and neither.
    """
    variant = f"{column}_variant"
    read = feed.withColumn(variant, F.try_parse_json(F.col(column)))
    typed = {name: F.try_variant_get(F.col(variant), path, kind) for name, (path, kind) in fields.items()}
    out = read.withColumn(f"{column}_broken", F.col(column).isNotNull() & F.col(variant).isNull()).withColumns(typed)
    for name, (path, _) in fields.items():
        found = F.try_variant_get(F.col(variant), path, "variant")
        there = F.coalesce(found.isNotNull() & ~F.is_variant_null(found), F.lit(False))
        out = out.withColumn(f"{name}_mistyped", there & F.col(name).isNull())
    return out.drop(variant)
