"""Fixed schemas. Nothing in the package infers types from data."""

from pyspark.sql import types as T

PRICE = T.DecimalType(18, 4)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


PAGES = _schema(page_id=T.LongType(), url=T.StringType(), html=T.StringType())

# One row per grid cell. The key is everything but ``cell``; an empty cell is a
# row whose ``cell`` is NULL. ``row_no`` and ``col_no`` restart in every table.
CELLS = _schema(
    file_url=T.StringType(),
    page_no=T.IntegerType(),
    table_no=T.IntegerType(),
    row_no=T.IntegerType(),
    col_no=T.IntegerType(),
    cell=T.StringType(),
)

PRICE_OBS = _schema(
    id=T.StringType(),
    dataset=T.StringType(),
    file_id=T.StringType(),
    description=T.StringType(),
    unit=T.StringType(),
    vendor=T.StringType(),
    price=PRICE,
    currency=T.StringType(),
    start_date=T.DateType(),
    end_date=T.DateType(),
)

MEDICINE_OBS = _schema(
    id=T.StringType(),
    variant=T.StringType(),
    file_id=T.StringType(),
    medication_name=T.StringType(),
    dosage=T.StringType(),
    maker=T.StringType(),
    unit=T.StringType(),
    vendor=T.StringType(),
    price=PRICE,
    currency=T.StringType(),
    start_date=T.DateType(),
    end_date=T.DateType(),
)

FLOWERS = _schema(
    description=T.StringType(),
    unit=T.StringType(),
    vendor=T.StringType(),
    price=T.StringType(),
    currency=T.StringType(),
    last_published_at=T.StringType(),
    last_updated_at=T.DateType(),
)

TRANSPORT_FEES = _schema(
    province=T.StringType(),
    town=T.StringType(),
    route=T.StringType(),
    company=T.StringType(),
    phone_number=T.StringType(),
    representative=T.StringType(),
    stop=T.StringType(),
    line=T.StringType(),
    cost=T.StringType(),
    currency=T.StringType(),
    last_published_at=T.StringType(),
    last_updated_at=T.DateType(),
)
