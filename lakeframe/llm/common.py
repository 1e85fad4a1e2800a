"""Helpers shared by the corpus operators: landing, row identity, run counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeframe.session import scratch

# Names of helper columns; the prefix keeps them clear of columns a table may bring along.
KEY1, KEY2, NTH, COPIES = "__lf_key1", "__lf_key2", "__lf_nth", "__lf_copies"


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    This cuts lineage and fixes the rows (a lost executor rereads files instead of
    recomputing), which also makes ids such as ``monotonically_increasing_id`` stable."""
    spark = df.sparkSession
    path = scratch(spark, f"llm/{name}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hashable(value: Column, kind: T.DataType) -> Column:
    """``value`` in a form that Spark hashes: maps, at any depth, as their entries by key, variants as
    JSON."""
    name = kind.simpleString()
    if "map<" not in name and "variant" not in name:
        return value
    if isinstance(kind, T.MapType):
        keys = F.array_sort(F.map_keys(value))
        return F.transform(keys, lambda k: F.struct(k.alias("k"), hashable(F.element_at(value, k), kind.valueType).alias("v")))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: hashable(x, kind.elementType))
    if isinstance(kind, T.StructType):
        return F.when(value.isNotNull(), F.struct(*[hashable(value.getField(f.name), f.dataType).alias(f"f{i}") for i, f in enumerate(kind.fields)]))
    return F.to_json(value)


def row_keys(df: DataFrame) -> tuple[Column, Column]:
    """Two 64-bit hashes over all columns of a row.  Rows with equal keys are identical rows,
    hence interchangeable; ids need not be unique and may be NULL."""
    cols = [hashable(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
    return F.xxhash64(*cols), F.xxhash64(F.lit(1), *cols)


def keyed(df: DataFrame) -> DataFrame:
    k1, k2 = row_keys(df)
    return df.withColumns({KEY1: k1, KEY2: k2})


def emit_copies(docs: DataFrame, copies: DataFrame) -> DataFrame:
    """Rows of ``docs`` repeated as often as ``copies`` (KEY1, KEY2, COPIES; one row per key)
    says; rows without an entry go.  COPIES counts all identical rows together.  One shuffle
    of the rows serves the numbering of identical rows and the join."""
    first = Window.partitionBy(KEY1, KEY2).orderBy(KEY1)
    rows = keyed(docs).withColumn(NTH, F.row_number().over(first)).where(F.col(NTH) == 1)
    out = rows.join(copies.select(KEY1, KEY2, COPIES), [KEY1, KEY2])
    out = out.withColumn(NTH, F.explode(F.sequence(F.lit(1).cast("long"), F.col(COPIES).cast("long"))))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(col: str) -> Column:
    """The text, NULL as empty."""
    return F.coalesce(F.col(f"`{col}`"), F.lit(""))


def schema_ddl(fields: list[tuple[str, str]]) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in fields)
