"""Catalog metadata as DataFrames. Its size follows the number of tables, never their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_inventory(spark: SparkSession, database: str = "default") -> DataFrame:
    """Tables of a database with location and provider."""
    rows = []
    for table in spark.catalog.listTables(database):
        if table.isTemporary:
            continue
        described = spark.sql(f"DESCRIBE EXTENDED `{database}`.`{table.name}`")
        details = {r["col_name"]: r["data_type"] for r in described.collect()}
        rows.append((table.name, details.get("Location"), details.get("Provider")))
    return spark.createDataFrame(rows, "tableName STRING, location STRING, provider STRING")


def columns_metadata(spark: SparkSession, databases) -> DataFrame:
    """Columns of the tables of some databases, with type and comment."""
    catalog = spark.catalog.currentCatalog()
    rows = [
        (catalog, database, table.name, column.name, column.dataType, column.description)
        for database in databases
        for table in spark.catalog.listTables(database)
        if not table.isTemporary
        for column in spark.catalog.listColumns(f"`{database}`.`{table.name}`")
    ]
    return spark.createDataFrame(
        rows,
        "catalog_name STRING, schema_name STRING, table_name STRING, column_name STRING, data_type STRING, comment STRING",
    )
