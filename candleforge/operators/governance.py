"""Table properties, column comments, and the dictionary of columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from candleforge.schema import PUBLIC, TABLES

# Reserved by the catalog; it always names the creator.
RESERVED_PROPERTIES = {"owner"}


def _quoted(text: str) -> str:
    return "'" + str(text).replace("\\", "\\\\").replace("'", "\\'") + "'"


def set_properties(spark: SparkSession, table: str, properties: dict[str, str]) -> None:
    """Attach descriptive properties (domain, data_source, contains_pii, ...) to a table."""
    reserved = RESERVED_PROPERTIES & set(properties)
    if reserved:
        raise ValueError(f"reserved table properties: {sorted(reserved)}")
    listed = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in properties.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({listed})")


def get_properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def set_comments(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """Copy the column comments of ``schema`` onto the catalog table.

    Spark fixes partition columns when the table is created, so those are left out.
    """
    present = {c.name for c in spark.catalog.listColumns(table) if not c.isPartition}
    for field in schema:
        if field.name in present and "comment" in field.metadata:
            comment = _quoted(field.metadata["comment"])
            spark.sql(f"ALTER TABLE {table} ALTER COLUMN `{field.name}` COMMENT {comment}")


def dictionary(
    spark: SparkSession, tables: dict[str, T.StructType] | None = None
) -> DataFrame:
    """One row per table column: position, type, nullability, comment, sensitivity."""
    rows = [
        (
            table,
            position,
            field.name,
            field.dataType.simpleString(),
            field.nullable,
            field.metadata.get("comment"),
            field.metadata.get("sensitivity", PUBLIC),
        )
        for table, schema in (TABLES if tables is None else tables).items()
        for position, field in enumerate(schema, start=1)
    ]
    return spark.createDataFrame(
        rows,
        "table_name string, position int, column_name string, data_type string, "
        "nullable boolean, comment string, sensitivity string",
    )
