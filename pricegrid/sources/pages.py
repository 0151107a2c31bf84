"""Pages as fetched."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricegrid import schemas

# The index page of each dataset.
SEEDS = (
    ("basic_baskets", "https://proconsumidor.gob.do/sondeos-de-canasta-basica-2017/", False),
    ("basic_baskets", "https://proconsumidor.gob.do/sondeos-de-canasta-basica-2018/", False),
    ("basic_baskets", "https://proconsumidor.gob.do/sondeos-de-canasta-basica-2019/", False),
    ("basic_baskets", "https://proconsumidor.gob.do/sondeos-de-canasta-basica-2020/", True),
    ("dairy_products", "https://proconsumidor.gob.do/monitoreos-diferentes-tipos-de-leches-2017/", False),
    ("dairy_products", "https://proconsumidor.gob.do/monitoreos-diferentes-tipos-de-leches-2018/", False),
    ("dairy_products", "https://proconsumidor.gob.do/monitoreos-diferentes-tipos-de-leches-2019/", False),
    ("dairy_products", "https://proconsumidor.gob.do/monitoreos-diferentes-tipos-de-leches-2020/", True),
    ("hardware_products", "https://proconsumidor.gob.do/monitoreo-de-ferreterias-2017/", False),
    ("hardware_products", "https://proconsumidor.gob.do/monitoreo-de-ferreterias-2018/", False),
    ("hardware_products", "https://proconsumidor.gob.do/monitoreos-de-ferreterias-2019/", False),
    ("hardware_products", "https://proconsumidor.gob.do/monitoreos-de-ferreterias-2020/", True),
    ("medicines", "https://proconsumidor.gob.do/monitoreos-farmacias-2017/", False),
    ("medicines", "https://proconsumidor.gob.do/consulta-de-precios-de-medicamentos-2018/", False),
    ("medicines", "https://proconsumidor.gob.do/consulta-de-precios-de-medicamentos-2019/", False),
    ("medicines", "https://proconsumidor.gob.do/consulta-de-precios-de-medicamentos-2020/", True),
    ("text_books", "https://proconsumidor.gob.do/monitoreo-de-libros-de-textos/", True),
    ("flowers", "http://proconsumidor.gob.do/precios-de-flores.php", True),
    ("transportation_fees", "https://proconsumidor.gob.do/precio-de-pasajes-autobus.php", True),
)


def seeds(spark: SparkSession, rows: tuple = SEEDS) -> DataFrame:
    return spark.createDataFrame(list(rows), "dataset string, url string, active boolean")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PAGES).parquet(path)


def read_page_files(spark: SparkSession, path: str) -> DataFrame:
    """Raw pages, one file each; the id is a hash of the file's path.

    Bytes that are no UTF-8 become replacement characters.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(
        F.xxhash64("path").alias("page_id"),
        F.col("path").alias("url"),
        F.make_valid_utf8(F.col("content").cast("string")).alias("html"),
    )
