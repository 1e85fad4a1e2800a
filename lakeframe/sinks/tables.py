"""Batch table sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def create_at_path(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Create a table folder; fails if the path exists (K4).  ``fmt="delta"`` needs the package."""
    df.write.format(fmt).mode("errorifexists").option("path", path).save()


def append_at_path(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append to a table folder (K5)."""
    df.write.format(fmt).mode("append").option("path", path).save()


def append_table(df: DataFrame, table: str, fmt: str | None = None) -> None:
    """Append to a catalog table, creating it if absent; columns match by name (K6)."""
    w = df.write.mode("append")
    if fmt:
        w = w.format(fmt)
    w.saveAsTable(table)


def insert_by_position(df: DataFrame, table: str) -> None:
    """Insert by column position with checked casts (K7): a value that does not fit the
    column raises ``CAST_OVERFLOW_IN_TABLE_INSERT``; a wrong column count raises
    ``INSERT_COLUMN_ARITY_MISMATCH``."""
    df.write.insertInto(table)


def schema_rows(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``printSchema`` as rows ``(ordinal, name, type, nullable)``."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "ordinal int, name string, type string, nullable boolean")


def first_row(df: DataFrame, *order: str) -> DataFrame:
    """The first row in ``order`` (O2, K15): a top-1 that Spark runs as TakeOrderedAndProject,
    so only one row per task reaches the final merge."""
    return df.orderBy(*order).limit(1)
