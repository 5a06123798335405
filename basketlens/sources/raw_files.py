"""Raw retail export files: schemas, readers and writers.

Schemas are explicit; nothing is inferred. Dates and prices stay text here and
are parsed by the cleaning plans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.sources.quoted_lines import quoted_cells

def _schema(spec: str) -> T.StructType:
    kinds = {
        "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
        "text": T.StringType(),
    }
    fields = [part.strip().rsplit(":", 1) for part in spec.split(",")]
    return T.StructType([T.StructField(n, kinds[k]) for n, k in fields])


RAW_SCHEMAS = {
    "sales": _schema(
        "Order Number:long, Line Item:long, Order Date:text, Delivery Date:text, "
        "CustomerKey:long, StoreKey:long, ProductKey:long, Quantity:int, Currency Code:text"
    ),
    "customers": _schema(
        "CustomerKey:long, Gender:text, Name:text, City:text, State Code:text, State:text, "
        "Zip Code:text, Country:text, Continent:text, Birthday:text"
    ),
    "products": _schema(
        "ProductKey:long, Product Name:text, Brand:text, Color:text, Unit Cost USD:text, "
        "Unit Price USD:text, SubcategoryKey:text, Subcategory:text, CategoryKey:text, "
        "Category:text"
    ),
    "stores": _schema(
        "StoreKey:long, Country:text, State:text, Square Meters:double, Open Date:text"
    ),
    "exchange_rates": _schema("Date:text, Currency:text, Exchange:double"),
    "data_dictionary": _schema("Table:text, Field:text, Description:text"),
}

RAW_FILES = {
    "sales": "Sales.csv",
    "customers": "Customers.csv",
    "products": "Products.csv",
    "stores": "Stores.csv",
    "exchange_rates": "Exchange_Rates.csv",
    "data_dictionary": "Data_Dictionary.csv",
}

# The customer file is Windows-1252; the rest are UTF-8.
WINDOWS_1252 = {"customers"}


def _windows_1252_pairs() -> tuple[str, str]:
    """Characters 0x80-0x9F as Latin-1 reads them, and what they stand for."""
    seen, meant = [], []
    for code in range(0x80, 0xA0):
        try:
            meant.append(bytes([code]).decode("cp1252"))
        except UnicodeDecodeError:
            continue
        seen.append(chr(code))
    return "".join(seen), "".join(meant)


def fix_windows_1252(col: Column) -> Column:
    """Turn text read as ISO-8859-1 into the Windows-1252 text it was."""
    seen, meant = _windows_1252_pairs()
    return F.translate(col, seen, meant)


# Cells that stand for no value.
NULL_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Free text in these files may hold line breaks.
LINE_BREAKS = {"customers", "products"}

# Record whose number of cells is not that of the header.
BROKEN = "_broken_record"


def read_cells(
    spark: SparkSession,
    path: str,
    names: list[str],
    windows_1252: bool = False,
    line_breaks: bool = False,
) -> DataFrame:
    """Every cell of a CSV file as text, and BROKEN for records of another width.

    The header must carry ``names`` in their order; anything else is an error
    when the file is read. Quotes inside quoted cells are doubled.

    Spark has no Windows-1252 reader. ISO-8859-1 keeps every byte, so the few
    characters that differ are replaced afterwards.
    """
    texts = T.StructType([T.StructField(n, T.StringType()) for n in [*names, BROKEN]])
    if line_breaks:
        cells = quoted_cells(spark, path, names, BROKEN, latin_1=windows_1252)
    else:
        cells = (
            spark.read.schema(texts)
            .option("header", True)
            .option("enforceSchema", False)
            .option("escape", '"')
            .option("columnNameOfCorruptRecord", BROKEN)
            .option("encoding", "ISO-8859-1" if windows_1252 else "UTF-8")
            .csv(path)
        )
    if not windows_1252:
        return cells
    return cells.select(*[fix_windows_1252(F.col(f"`{n}`")).alias(n) for n in texts.names])


def _typed(field: T.StructField, date_format: str | None) -> Column:
    cell = F.col(f"`{field.name}`")
    present = F.when(~cell.isin(NULL_WORDS), cell)
    if isinstance(field.dataType, T.StringType):
        return present
    if isinstance(field.dataType, T.DateType) and date_format:
        return F.try_to_timestamp(present, F.lit(date_format)).cast("date")
    return present.try_cast(field.dataType)


def typed_cells(cells: DataFrame, schema: T.StructType, date_format: str | None = None) -> DataFrame:
    """The columns of ``schema`` from text cells; what can't be read is null."""
    return cells.select(*[_typed(f, date_format).alias(f.name) for f in schema.fields])


def unreadable(cells: DataFrame, schema: T.StructType, date_format: str | None = None) -> DataFrame:
    """One row, ``n``: cells that hold something but not their type, and broken records."""
    found = [
        (~F.col(f"`{f.name}`").isin(NULL_WORDS) & _typed(f, date_format).isNull()).cast("bigint")
        for f in schema.fields
    ]
    if BROKEN in cells.columns:
        found.append(F.col(BROKEN).isNotNull().cast("bigint"))
    counts = [F.coalesce(c, F.lit(0)) for c in found]
    return cells.agg(F.coalesce(F.sum(sum(counts, F.lit(0))), F.lit(0)).alias("n"))


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    windows_1252: bool = False,
    date_format: str | None = None,
    line_breaks: bool = False,
) -> DataFrame:
    """CSV with a header row under an explicit schema."""
    cells = read_cells(spark, path, schema.names, windows_1252, line_breaks)
    return typed_cells(cells, schema, date_format)


def read_raw_folder(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All files of an export under their table names."""
    cells = read_raw_cells(spark, folder)
    return {name: typed_cells(cells[name], RAW_SCHEMAS[name]) for name in RAW_FILES}


def read_raw_cells(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All files of an export as text cells, for checks before they are typed."""
    root = folder.rstrip("/")
    return {
        name: read_cells(
            spark, f"{root}/{file}", RAW_SCHEMAS[name].names, name in WINDOWS_1252, name in LINE_BREAKS
        )
        for name, file in RAW_FILES.items()
    }


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace a stored table; Parquet by default, CSV for exchange."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.format(fmt).save(path)
