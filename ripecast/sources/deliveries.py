"""CSV deliveries: routing by file name, a dated raw zone, and reading one snapshot back as text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ripecast import constants as K
from ripecast.sources import split_csv
from ripecast.sources.files import found

# logical tables and the raw folder and delivered file each is read from; None means every file of the folder
RAW_TABLES = {
    "sales": ("sales", "train.csv"),
    "items": ("misc", "items.csv"),
    "stores": ("stores", None),
    "holidays": ("holidays", None),
    "oil_prices": ("oil_prices", None),
    "transactions": ("transactions", None),
}

# The columns of each delivery, in file order.
RAW_COLUMNS = {
    "sales": "id date store_nbr item_nbr unit_sales onpromotion",
    "items": "item_nbr family class perishable",
    "stores": "store_nbr city state type cluster",
    "holidays": "date type locale locale_name description transferred",
    "oil_prices": "date dcoilwtico",
    "transactions": "date store_nbr transactions",
}

# Quotes inside a quoted field are doubled, as spreadsheets and most exporters write them.
CSV = {"header": "true", "quote": '"', "escape": '"'}


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def route(name: Column) -> Column:
    """Logical table of a delivered file name."""
    routes = F
    for delivered, table in K.FILE_ROUTES.items():
        routes = routes.when(name == delivered, F.lit(table))
    return routes.otherwise(F.lit(K.FILE_ROUTE_DEFAULT))


def list_deliveries(spark: SparkSession, landing: str) -> DataFrame:
    """Delivered CSV files with their logical table. Only file listings are read, never contents."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(landing)
    name = file_name(F.col("path"))
    return files.select("path", name.alias("file"), route(name).alias("table_name"), "length")


def read_csv(spark: SparkSession, *paths: str, columns: str | None = None, multi_line: bool | str = False) -> DataFrame:
    """CSV with a header; every column is text, so that later casts see the raw value.

    With ``columns`` the header must have exactly these names in this order; else the read fails rather than shift
    values. ``multi_line`` allows line breaks inside quoted fields: ``True`` reads a file in one task, ``"split"`` by
    many, for files that have quotes in quoted fields only (see ``split_csv``).
    """
    if multi_line == "split":
        names = columns.split() if columns is not None else spark.read.options(**CSV).csv(list(paths)).columns
        return split_csv.read(spark, paths, names, CSV)
    reader = spark.read.options(**CSV).option("multiLine", multi_line)
    if columns is not None:
        reader = reader.schema(_text_schema(columns)).option("enforceSchema", False)
    return reader.csv(list(paths))


def _text_schema(columns: str) -> str:
    return ", ".join(f"`{c}` STRING" for c in columns.split())


def ingest(spark: SparkSession, path: str, raw: str, ingest_date: str, multi_line: bool | str = False) -> None:
    """Copy one delivered file into the raw zone at <table>/ingest_date=<d>/source_file=<name>; a rerun replaces it."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    table = K.FILE_ROUTES.get(name, K.FILE_ROUTE_DEFAULT)
    target = f"{raw}/{table}/ingest_date={ingest_date}/source_file={name}"
    read_csv(spark, path, multi_line=multi_line).write.mode("overwrite").options(**CSV).csv(target)


def read_raw(spark: SparkSession, raw: str, table: str, ingest_date: str, multi_line: bool | str = False) -> DataFrame:
    """One snapshot of one logical table, without rows where it was not delivered.

    The date and, where one is named, the file are part of the path, so nothing else is listed or opened.
    """
    folder, only_file = RAW_TABLES[table]
    columns = RAW_COLUMNS[table]
    path = f"{raw}/{folder}/ingest_date={ingest_date}/source_file={only_file or '*'}"
    if not found(spark, path):
        return spark.createDataFrame([], _text_schema(columns))
    return read_csv(spark, path, columns=columns, multi_line=multi_line)
