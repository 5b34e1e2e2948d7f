"""Readers for delivered files and for published tables."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import schemas
from starloom.sources.blocks import CsvRecords, JsonItems, read_records

# Every file's header is held against the columns read: files of another column order stop the read instead of mixing up cells.
_CSV_TEXT = {"header": True, "encoding": "UTF-8", "escape": '"', "enforceSchema": False}
_FILE_PLACE = ("_metadata.file_path as _fichier", "_metadata.file_block_start as _bloc")


def read_text_csv(
    spark: SparkSession, path: str, required: Sequence[str] = (), multi_line: bool = False
) -> DataFrame:
    """CSV with header, every cell as text, empty cells as ''.

    Words such as NULL or NA stay text. Header names are trimmed. The arrival
    column orders rows by file, block and row. Quoted line breaks need
    multi_line; files are still read by many tasks (see blocks).
    """
    cells = spark.read.options(**_CSV_TEXT).csv(path)
    if multi_line:
        named = _quoted_text_csv(spark, path, cells.columns)
    else:
        named = with_arrival(cells.selectExpr(*[f"`{c}` as `{c.strip()}`" for c in cells.columns], *_FILE_PLACE))
    missing = [c for c in required if c not in named.columns]
    if missing:
        raise ValueError(f"{path}: missing columns {missing}")
    return named


def _quoted_text_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Cells of files whose quoted cells may hold line breaks; blank lines go, header lines are checked."""
    schema = ", ".join(f"_c{k} string" for k in range(len(columns)))
    options = {"escape": '"', "multiLine": "true"}
    records = read_records(spark, path, CsvRecords())
    row = records.withColumn("_cellules", F.from_csv(F.regexp_replace("_texte", r"\r$", ""), schema, options))
    cells = [F.coalesce(F.col(f"_cellules._c{k}"), F.lit("")) for k in range(len(columns))]
    header = F.array(*[F.trim(F.translate(cell, "\ufeff", "")) for cell in cells])
    expected = F.array(*[F.lit(c.replace("\ufeff", "").strip()) for c in columns])
    is_header = (F.col("_bloc") == 0) & (F.col("_ligne") == 0)
    wrong = F.raise_error(F.concat(F.lit("header differs in "), F.col("_fichier"))).cast("boolean")
    blank = F.trim(F.translate("_texte", "\t\r\n", "")) == ""
    rows = row.filter(F.when(is_header & (header != expected), wrong).otherwise(~is_header & ~blank))
    arrival = F.struct("_fichier", "_bloc", "_ligne")
    return rows.select(
        *[cell.alias(c.replace("\ufeff", "").strip()) for cell, c in zip(cells, columns, strict=True)],
        arrival.alias(schemas.ARRIVAL),
    )


def stream_text_csv(
    spark: SparkSession, folder: str, columns: Sequence[str], files_per_batch: int = 1000
) -> DataFrame:
    """The same files as a stream, with the columns in the given order.

    Row numbers exist only inside a batch: pass each batch through with_arrival.
    """
    cells = (
        spark.readStream.schema(", ".join(f"{c} string" for c in columns))
        .options(**_CSV_TEXT, maxFilesPerTrigger=files_per_batch)
        .csv(folder)
    )
    return cells.selectExpr("*", *_FILE_PLACE)


def stream_files(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """The files that come into a folder, as a stream of their places and names; what they hold is not read."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    listed = spark.readStream.format("binaryFile").schema(schema).option("maxFilesPerTrigger", files_per_batch).load(folder)
    return listed.selectExpr("path", "_metadata.file_path as fichier")


def read_listed_csv(spark: SparkSession, paths: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The rows of the named files, with the columns in the given order and their arrival."""
    plain = [re.sub(r"[{}\[\]*?\\]", r"\\\g<0>", path) for path in paths]  # names, not patterns
    cells = spark.read.schema(", ".join(f"{c} string" for c in columns)).options(**_CSV_TEXT).csv(plain)
    return with_arrival(cells.selectExpr("*", *_FILE_PLACE))


def with_arrival(cells: DataFrame) -> DataFrame:
    """Empty cells as '', and the file place of each row folded into the arrival column."""
    names = [c for c in cells.columns if c not in ("_fichier", "_bloc")]
    arrival = F.struct("_fichier", "_bloc", F.monotonically_increasing_id().alias("_ligne"))
    return cells.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in names], arrival.alias(schemas.ARRIVAL))


def read_orders(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_text_csv(spark, path, schemas.ORDER_COLUMNS, **options)


def read_clients(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_text_csv(spark, path, schemas.CLIENT_COLUMNS, **options)


def read_regions(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_text_csv(spark, path, schemas.REGION_COLUMNS, **options)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    """Products from documents of the form {"produits": [...]}, one row per item.

    A document may be of any length and layout: it is cut at its items and read
    by many tasks. A cell of another type is null, as in any JSON read.
    """
    item = spark.createDataFrame([], schemas.PRODUCT_JSON).schema["produits"].dataType.elementType
    items = read_records(spark, path, JsonItems("produits"))
    products = items.withColumn("p", F.from_json("_texte", item))
    return products.select("p.*", F.struct("_fichier", "_bloc", "_ligne").alias(schemas.ARRIVAL))


def read_published_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A published CSV table with its declared types."""
    return (
        spark.read.schema(schemas.TABLES[table])
        .option("header", True)
        .option("escape", '"')
        .option("enforceSchema", False)
        .csv(path)
    )


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A stored Parquet table of the star, without the extra columns of its storage."""
    return spark.read.schema(schemas.TABLES[table]).parquet(path).select(*schemas.columns_of(table))


def read_published(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Every published CSV table found in a folder; missing ones are left out."""
    found = {}
    for table in schemas.TABLES:
        try:
            found[table] = read_published_csv(spark, f"{folder.rstrip('/')}/{table}", table)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return found
