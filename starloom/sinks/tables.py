"""Writing whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, table: str, folder: str) -> str:
    """Write one table as a folder of CSV files with headers; returns the path."""
    path = f"{folder.rstrip('/')}/{table}"
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("ignoreLeadingWhiteSpace", False)  # writers trim cells by default
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def publish_csv(tables: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """Write every table as CSV; returns name -> path."""
    return {name: write_csv(df, name, folder) for name, df in tables.items()}


def replace_table(df: DataFrame, path: str) -> str:
    """Replace a stored Parquet table. df must not read from path."""
    df.write.mode("overwrite").parquet(path)
    return path
