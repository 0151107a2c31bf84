"""Medicine grids: four attributes, and pages that hold two reports at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pricegrid.functions.prices import observation_id
from pricegrid.functions.text import null_token, strip
from pricegrid.operators.grid import (
    any_of,
    attach_layout,
    number_columns,
    observation_columns,
    page_layouts,
    unpivot,
    with_report,
)

ATTRIBUTES = ["medication_name", "dosage", "maker", "unit"]
VARIANTS = ["generic", "commercial", "single"]

# Terms for columns that are no vendors, and for the columns of
# the generic and the commercial half; the last are cut out of labels.
MEDICINE_EXCLUDED = (
    "n0", "no", "Orden", "Resumen", "General", "Media", "Promedio", "Global",
    "Mínimo", "Máximo", "Moda", "Mediana", "Desviación", "Estándar",
)
GENERIC_TERMS = ("Genérico", "Principio", "Activo", "Concentrac")
COMMERCIAL_TERMS = ("Marca", "Concentrac")
GENERIC_WORDS = "Genérico|Principio|Activo"


def is_generic(column: Column) -> Column:
    return column["label"].rlike(any_of(GENERIC_TERMS))


def is_commercial(column: Column) -> Column:
    return column["label"].rlike(any_of(COMMERCIAL_TERMS))


def _relabel(column: Column, label: Column, plain: Column) -> Column:
    return F.struct(column["gcol"].alias("gcol"), label.alias("label"), plain.alias("plain"))


def split_variants(pages: DataFrame) -> DataFrame:
    """Column layouts of the variants a page holds, as ``slots``.

    A page with more than one generic and more than one commercial column is
    two reports. Each half drops the other's columns; a column that counts as
    both is in neither. If the halves are equally wide the commercial one takes
    over the generic labels.
    """
    generic = F.transform(
        F.filter("columns", lambda column: ~is_commercial(column)),
        lambda column: _relabel(
            column,
            F.regexp_replace(column["label"], GENERIC_WORDS, ""),
            F.regexp_replace(column["plain"], GENERIC_WORDS, ""),
        ),
    )
    same_width = F.size("generic") == F.size("commercial")
    commercial = F.transform(
        "commercial",
        lambda column, i: F.when(
            same_width,
            _relabel(
                column, F.get("generic", i)["label"], F.get("generic", i)["plain"]
            ),
        ).otherwise(column),
    )
    dual = (F.size(F.filter("columns", is_generic)) > 1) & (
        F.size(F.filter("columns", is_commercial)) > 1
    )
    return (
        pages.withColumn("dual", dual)
        .withColumn("generic", generic)
        .withColumn("commercial", F.filter("columns", lambda column: ~is_generic(column)))
        .withColumn("commercial", commercial)
        .withColumn(
            "slots",
            F.when(
                F.col("dual"),
                F.concat(
                    number_columns(F.col("generic"), "generic"),
                    number_columns(F.col("commercial"), "commercial"),
                ),
            ).otherwise(number_columns(F.col("columns"), "single")),
        )
    )


def medicine_prices(
    cells: DataFrame,
    dataset: str | DataFrame = "medicines",
    excluded: tuple[str, ...] = MEDICINE_EXCLUDED,
) -> DataFrame:
    """Price observations of medicine grids, all variants in one relation.

    Attribute i exists from i + 2 columns on. Only a row whose attributes are
    all blank is dropped, one with missing attributes is kept.
    """
    layouts = with_report(page_layouts(cells, excluded, clean=False), dataset)
    rows = unpivot(attach_layout(cells, split_variants(layouts)), n_attributes=len(ATTRIBUTES))
    present = [F.col("n_cols") > i + 1 for i in range(len(ATTRIBUTES))]
    values = [strip(null_token(F.col(f"attr_{i}"))) for i in range(len(ATTRIBUTES))]
    some_text = F.lit(False)
    for there, value in zip(present, values):
        some_text = some_text | (there & (F.coalesce(value, F.lit("?")) != ""))
    return rows.filter(some_text).select(
        observation_id("dataset", "file_url", "variant", "page_no", "row_no", "gcol").alias("id"),
        "dataset",
        "variant",
        "file_id",
        *[
            F.when(there, value).alias(name)
            for there, value, name in zip(present, values, ATTRIBUTES)
        ],
        *observation_columns(),
    )


def written_variants(observations: DataFrame) -> DataFrame:
    """Manifest of the outputs a run really has: one row per dataset, report and variant."""
    return observations.select("dataset", "file_id", "variant").distinct()
