"""File and table sources."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakeframe.sinks.objects import qualify, resolve_fs


def read_delimited(spark: SparkSession, path: str, *, delimiter: str = ";", header: bool = True,
                   schema: StructType | str | None = None, infer: bool = True,
                   sampling_ratio: float | None = None) -> DataFrame:
    """Delimited text with a header (S4).  Pass ``schema`` to skip the inference pass,
    which reads the data once more; ``sampling_ratio`` bounds that pass on large inputs."""
    reader = spark.read.option("delimiter", delimiter).option("header", header)
    if schema is not None:
        return reader.schema(schema).csv(path)
    if infer:
        reader = reader.option("inferSchema", True)
        if sampling_ratio:
            reader = reader.option("samplingRatio", sampling_ratio)
    return reader.csv(path)


def split_delimited(spark: SparkSession, path: str, schema: StructType, *, delimiter: str = ";", header: bool = True) -> tuple[DataFrame, DataFrame]:
    """Delimited text -> ``(rows, rejected)`` (S4, F3): a line with too few or too many cells or a
    cell that is not of its column's type is not a row but a rejected one, with the line, its file
    and the reason (``bad_arity``, or ``bad_cell`` and the columns).  Empty cells are NULL.

    All columns are parsed as text, so that the parser reports the number of cells alone; types
    are casts in the same scan."""
    raw = StructType([StructField(f.name, StringType()) for f in schema.fields] + [StructField("__line", StringType())])
    lines = (spark.read.option("delimiter", delimiter).option("header", header).option("mode", "PERMISSIVE")
             .option("columnNameOfCorruptRecord", "__line").option("columnPruning", "false").schema(raw).csv(path))
    cells = [F.col(f"`{f.name}`") for f in schema.fields]
    typed = [c.try_cast(f.dataType) for c, f in zip(cells, schema.fields)]
    wrong = F.concat_ws(",", *[F.when(c.isNotNull() & t.isNull(), F.lit(f.name)) for c, t, f in zip(cells, typed, schema.fields)])
    reason = F.when(F.col("__line").isNotNull(), F.lit("bad_arity")).when(wrong != "", F.concat(F.lit("bad_cell: "), wrong))
    rows = lines.where(reason.isNull()).select(*[t.alias(f.name) for t, f in zip(typed, schema.fields)])
    line = F.coalesce("__line", F.to_csv(F.struct(*cells), {"sep": delimiter}))
    return rows, lines.where(reason.isNotNull()).select(folder_file(F.col("_metadata.file_path")).alias("file"), line.alias("line"), reason.alias("reason"))


def folder_file(path: Column) -> Column:
    """The file name of a ``_metadata.file_path``, as it is on disk."""
    return on_disk(F.substring_index(path, "/", -1))


def write_delimited(df: DataFrame, path: str, delimiter: str = ";") -> None:
    df.write.option("delimiter", delimiter).option("header", True).mode("errorifexists").csv(path)


def literal_rows(spark: SparkSession, rows: Iterable[tuple], schema: StructType | None = None) -> DataFrame:
    """Rows from the client (S5 with ``schema``; S6 without: columns ``_1.._n``, ints as bigint)."""
    return spark.createDataFrame(list(rows), schema) if schema is not None else spark.createDataFrame(list(rows))


def scan_path(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A table folder by path (S8); in SQL: ``SELECT * FROM parquet.`path` ``."""
    return spark.read.format(fmt).load(path)


def on_disk(path: Column) -> Column:
    """A ``_metadata.file_path``, which is URL-encoded, as it is on disk."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def literal(paths: Iterable[str]) -> list[str]:
    """Paths for a reader, which would take some characters for a pattern."""
    return [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths]


def folder_of(path: Column) -> Column:
    """The folder of a ``_metadata.file_path``, as it is on disk (the column is URL-encoded)."""
    return F.regexp_replace(on_disk(path), "/[^/]*$", "")


def _folders_there(root: str):
    """Which of the bare paths are folders at or below ``root`` (qualified); as URIs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs as pafs

        top = root.rstrip("/")
        scheme = _SCHEME.match(top)[0]
        for batch in batches:
            found = []
            for path in batch.column(0).to_pylist():
                uri = scheme + path
                if uri == top or uri.startswith(top + "/"):
                    fs, at = resolve_fs(uri)
                    if fs.get_file_info(at).type == pafs.FileType.Directory:
                        found.append(uri)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["folder"])
    return run


_SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?")


def read_paths(paths: DataFrame, root: str, column: str = "path", fmt: str = "parquet") -> DataFrame:
    """Rows of every folder named in a table of paths, with ``source_path`` per row.

    Tasks look up which of the distinct paths are folders below ``root``; only those are listed and
    opened, in one scan with the partition columns that their names carry.  What the driver
    holds are the folders to scan, as for any scan.  Paths are folders as they are on disk, with or
    without scheme; NULL paths and folders that are not there name nothing, repeated ones count
    once.  The look-up runs in this call."""
    spark = paths.sparkSession
    bare = lambda c: F.regexp_replace(F.regexp_replace(c, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", ""), "/+$", "")
    wanted = paths.select(bare(F.col(column)).alias("folder")).where("folder IS NOT NULL").distinct()
    there = sorted(r.folder for r in wanted.mapInArrow(_folders_there(qualify(spark, root)), "folder string").collect())
    reader = spark.read.format(fmt).option("recursiveFileLookup", "false").option("basePath", root)
    folder = folder_of(F.col("_metadata.file_path"))
    if not there:
        return spark.read.format(fmt).load(root).withColumn("source_path", folder).where("false")
    rows = reader.load(literal(there))
    named = spark.createDataFrame([(_SCHEME.sub("", f),) for f in there], "__folder string")  # not the folders below them
    return rows.withColumns({"source_path": folder, "__folder": bare(folder)}).join(named, "__folder", "left_semi").drop("__folder")


def read_people(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The people table at ``path`` (U1 with the path as its parameter): name, age, city.  A plain
    scan, so a caller's filters and columns reach it."""
    return spark.read.format(fmt).load(path).select(F.col("Name").alias("name"), F.col("Age").alias("age"), F.col("City").alias("city"))


def live_files(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Data files of a table folder with their sizes and row counts (S13, U3), empty ones too.

    The files come from the folder's listing, the counts from a scan of the file metadata
    column alone, so no column data is read."""
    key = lambda c: F.regexp_replace(c, "^file:/+", "file:/")  # noqa: E731  both spellings of a local file
    listing = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("file_size"))
    plain = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    counts = spark.read.format(fmt).load(path).select(key(plain).alias("file_path")).groupBy("file_path").agg(F.count(F.lit(1)).alias("n_rows"))
    return (listing.withColumn("file_path", key(F.col("path"))).join(counts, "file_path", "left")
            .select("file_path", "file_size", F.coalesce("n_rows", F.lit(0)).alias("n_rows")))
