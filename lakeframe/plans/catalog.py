"""Catalog, DDL and the SQL surface (D1-D9, U1, U3) and the table queries built on them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeframe.schemas import EMPLOYEE
from lakeframe.session import note_database, read_table, scratch, table_path
from lakeframe.sinks.tables import (
    append_at_path, append_table, create_at_path, first_row, insert_by_position, schema_rows,
)
from lakeframe.sources.files import folder_of, live_files, read_delimited, read_paths, read_people, scan_path, split_delimited, write_delimited


def _ident(name: str) -> str:
    if not name.replace("_", "").isalnum():
        raise ValueError(f"bad identifier {name!r}")
    return f"`{name}`"


def _literal(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _unique(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` (D1); ``location`` keeps managed tables in shared storage."""
    loc = f" LOCATION {_literal(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_ident(name)}{loc}")


def list_databases(spark: SparkSession) -> DataFrame:
    """``SHOW DATABASES`` (D2): column ``namespace``."""
    return spark.sql("SHOW DATABASES")


def use_database(spark: SparkSession, name: str) -> None:
    """``USE db`` (D3)."""
    spark.catalog.setCurrentDatabase(name)


def register_external(spark: SparkSession, table: str, path: str, fmt: str = "parquet",
                      database: str = "default") -> str:
    """Register an existing folder as a table, idempotently (D4).  Returns the three-part name."""
    full = f"spark_catalog.{_ident(database)}.{_ident(table)}"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {full} USING {_ident(fmt)} LOCATION {_literal(path)}")
    return full


def create_table_function(spark: SparkSession, name: str, returns: str, body_sql: str,
                          temporary: bool = True) -> None:
    """SQL table function ``name()`` (U1).  Catalyst inlines its body, so filters and
    column pruning on a caller's query reach the scan inside it.  A permanent function
    must be called unqualified from its own database."""
    kind = "TEMPORARY FUNCTION" if temporary else "FUNCTION"
    spark.sql(f"CREATE OR REPLACE {kind} {_ident(name)}() RETURNS TABLE ({returns}) RETURN {body_sql}")


def create_view(spark: SparkSession, name: str, select_sql: str, temporary: bool = True) -> None:
    """View over any query, e.g. a table function."""
    kind = "TEMPORARY VIEW" if temporary else "VIEW"
    spark.sql(f"CREATE OR REPLACE {kind} {_ident(name)} AS {select_sql}")


def run_sql(spark: SparkSession, text: str, **params) -> DataFrame:
    """Ad-hoc SQL with named parameters (D7, D8): ``:name`` markers for values and
    ``IDENTIFIER(:t)`` for names; no text templating, so values cannot inject SQL."""
    return spark.sql(text, args=params or None)


def ctas(spark: SparkSession, table: str, select_sql: str, fmt: str = "parquet") -> None:
    """``CREATE TABLE ... AS SELECT`` without a row limit."""
    spark.sql(f"CREATE TABLE {table} USING {fmt} AS {select_sql}")


# ---------------------------------------------------------------- queries


def _db(spark: SparkSession, label: str) -> tuple[str, str]:
    root = scratch(spark, label)
    db = _unique(f"lf_{label}")
    ensure_database(spark, db, f"{root}/{db}.db")
    note_database(db)
    return root, db


def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """';'-delimited text with header and inferred types -> table at a path."""
    root = scratch(spark, "csv_inferred")
    write_delimited(read_table(spark, sf_dir, "customer"), f"{root}/csv")
    create_at_path(read_delimited(spark, f"{root}/csv"), f"{root}/table")
    return scan_path(spark, f"{root}/table")


# Fixed value: the columns of the delimited customer lines.
CUSTOMER_LINE = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"


def delimited_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited lines of which some have a cell that is no number, a cell too few or one too many:
    landed rows and rejected lines by reason, with the lines' length (S4, F3, K4)."""
    root = scratch(spark, "delimited_outcomes")
    cust = read_table(spark, sf_dir, "customer")
    kind = F.pmod("c_custkey", F.lit(10))
    cells = ["c_custkey", "c_name", F.when(kind == 0, F.lit("n/a")).otherwise(F.col("c_nationkey").cast("string")), F.col("c_acctbal").cast("decimal(18,2)"),
             F.when(kind != 1, F.col("c_mktsegment")), F.when(kind == 2, F.lit("more"))]
    cust.select(F.concat_ws(";", *cells).alias("line")).write.text(f"{root}/lines")
    schema = StructType.fromDDL(CUSTOMER_LINE)
    rows, rejected = split_delimited(spark, f"{root}/lines", schema, header=False)
    create_at_path(rows, f"{root}/table")
    landed = spark.read.parquet(f"{root}/table").groupBy(F.lit("landed").alias("outcome")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("total"))
    refused = rejected.groupBy(F.col("reason").alias("outcome")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.substring_index("line", ";", 1).cast("long")).alias("total"))
    return landed.unionByName(refused)


def csv_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inferred schema of the delimited customer file as rows."""
    root = scratch(spark, "csv_schema")
    write_delimited(read_table(spark, sf_dir, "customer"), f"{root}/csv")
    return schema_rows(spark, read_delimited(spark, f"{root}/csv")).drop("nullable")


def table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create a table at a path, append a second write, scan it by path in SQL."""
    root = scratch(spark, "table_append")
    cust = read_table(spark, sf_dir, "customer")
    first = F.coalesce(F.col("c_acctbal") >= 0, F.lit(False))
    create_at_path(cust.where(first), f"{root}/people")
    append_at_path(cust.where(~first), f"{root}/people")
    return spark.sql(f"SELECT * FROM parquet.`{root}/people`")


def insert_by_position_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with inferred names ``_1.._4`` (bigint) inserted by position into typed columns."""
    _, db = _db(spark, "insert_by_position")
    table = f"{_ident(db)}.suppliers"
    spark.sql(f"CREATE TABLE {table} (id INT, name STRING, nation INT, balance DOUBLE) USING parquet")
    sup = read_table(spark, sf_dir, "supplier")
    insert_by_position(sup.select("s_suppkey", "s_name", "s_nationkey", "s_acctbal").toDF("_1", "_2", "_3", "_4"), table)
    return spark.table(table)


def append_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append to a managed table created by the first append; the second append has its
    columns in another order and is matched by name (S5, K6)."""
    _, db = _db(spark, "append_by_name")
    table = f"{_ident(db)}.suppliers"
    sup = read_table(spark, sf_dir, "supplier")
    first = F.coalesce(F.col("s_acctbal") >= 0, F.lit(False))
    append_table(sup.where(first), table, "parquet")
    append_table(sup.where(~first).select("s_acctbal", "s_name", "s_suppkey", "s_nationkey"), table)
    return spark.table(table)


def register_external_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Register an existing folder as a table, query it by its three-part name."""
    _, db = _db(spark, "register_external")
    full = register_external(spark, "orders_ext", table_path(sf_dir, "orders"), database=db)
    register_external(spark, "orders_ext", table_path(sf_dir, "orders"), database=db)  # idempotent
    return spark.sql(f"SELECT * FROM {full}")


def people_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People rows behind a SQL table function and a view over it."""
    root = scratch(spark, "people_function")
    cust = read_table(spark, sf_dir, "customer")
    people = cust.select(F.col("c_name").alias("Name"), F.col("c_nationkey").cast("int").alias("Age"),
                         F.col("c_mktsegment").alias("City"))
    create_at_path(people, f"{root}/people")
    fn, view = _unique("read_people"), _unique("people_view")
    create_table_function(spark, fn, "name STRING, age INT, city STRING",
                          f"SELECT Name, Age, City FROM parquet.`{root}/people`")
    create_view(spark, view, f"SELECT * FROM {_ident(fn)}()")
    return spark.table(view)


def people_by_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The people table function with its path as a parameter, filtered by its caller."""
    root = scratch(spark, "people_by_path")
    cust = read_table(spark, sf_dir, "customer")
    create_at_path(cust.select(F.col("c_name").alias("Name"), F.col("c_nationkey").cast("int").alias("Age"),
                               F.col("c_mktsegment").alias("City")), f"{root}/people")
    return read_people(spark, f"{root}/people").where("age >= 10")


def zip_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parallel arrays zipped into rows, shortest length wins as in Python's zip."""
    part = read_table(spark, sf_dir, "part")
    a, b = F.split("p_name", " "), F.split("p_type", " ")
    n = F.least(F.size(a), F.size(b))
    zipped = F.arrays_zip(F.slice(a, 1, n).alias("name_part"), F.slice(b, 1, n).alias("type_part"))
    return part.select("p_partkey", F.inline(F.transform(
        zipped, lambda z, i: F.struct((i + 1).cast("int").alias("pos"), z["name_part"].alias("name_part"),
                                      z["type_part"].alias("type_part")))))


def live_files_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data files of the given table with sizes and row counts, summed up."""
    files = live_files(spark, table_path(sf_dir, "lineitem"))
    return files.agg(F.sum("n_rows").alias("n_rows"), (F.min("file_size") > 0).alias("all_sized"), (F.min("n_rows") >= 0).alias("all_counted"))


def sql_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named parameters for a value and a table name."""
    view = _unique("orders")
    read_table(spark, sf_dir, "orders").createOrReplaceTempView(view)
    return run_sql(spark, "SELECT o_orderkey, o_custkey, o_orderpriority FROM IDENTIFIER(:t) "
                          "WHERE o_orderstatus = :status", t=view, status="F")


def ctas_no_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CTAS of a whole table, then counted."""
    _, db = _db(spark, "ctas")
    view = _unique("lineitem")
    read_table(spark, sf_dir, "lineitem").createOrReplaceTempView(view)
    table = f"{_ident(db)}.lineitem_copy"
    ctas(spark, table, f"SELECT * FROM {_ident(view)}")
    return spark.sql(f"SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_orders FROM {table}")


def first_row_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First row in key order."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return first_row(orders, "o_orderkey")


def catalog_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create a database, use it, append typed rows, insert positional rows, then read the
    table from another session sharing the catalog (D1, D2, D3, D6, S5, S6, K6, K7)."""
    root = scratch(spark, "catalog_roundtrip")
    db = _unique("lf_emp")
    work = spark.newSession()  # USE must not change the caller's current database
    ensure_database(work, db, f"{root}/{db}.db")
    note_database(db)
    use_database(work, db)
    sup = work.read.parquet(f"{sf_dir}/supplier.parquet")
    gender = F.when(F.coalesce(F.col("s_acctbal") >= 0, F.lit(False)), F.lit("M")).otherwise(F.lit("F"))
    rows = sup.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                      F.col("s_nationkey").alias("age"), gender.alias("gender"))
    first = F.col("gender") == "M"
    append_table(rows.where(first).to(EMPLOYEE), "employee", "parquet")
    insert_by_position(rows.where(~first).toDF("_1", "_2", "_3", "_4"), "employee")
    other = spark.newSession()
    listed = other.sql("SHOW DATABASES").where(F.col("namespace") == db).count() == 1
    return other.sql(f"SELECT * FROM {_ident(db)}.employee").withColumn("db_listed", F.lit(listed))


def read_many_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written as one folder per segment, read back from a table of folder paths."""
    root = f"{scratch(spark, 'read_many_paths')}/customers"
    cust = read_table(spark, sf_dir, "customer")
    cust.write.partitionBy("c_mktsegment").parquet(root)
    paths = scan_path(spark, root).select(folder_of(F.col("_metadata.file_path")).alias("path"))
    return read_paths(paths, root).select("c_custkey", "c_name", "c_nationkey", "c_acctbal", F.col("c_mktsegment").alias("segment"))


def sql_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence that landed tables are queryable with any Spark SQL: join + aggregate."""
    o, li = _unique("orders"), _unique("lineitem")
    read_table(spark, sf_dir, "orders").createOrReplaceTempView(o)
    read_table(spark, sf_dir, "lineitem").createOrReplaceTempView(li)
    return spark.sql(f"""
        SELECT o.o_orderstatus, count(*) AS n_lines, count(DISTINCT l.l_orderkey) AS n_orders,
               CAST(sum(l.l_quantity) AS BIGINT) AS total_qty
        FROM {_ident(li)} l JOIN {_ident(o)} o ON l.l_orderkey = o.o_orderkey
        GROUP BY o.o_orderstatus""")


QUERIES = {
    "csv_inferred": csv_inferred,
    "csv_schema": csv_schema,
    "delimited_outcomes": delimited_outcomes,
    "table_append": table_append,
    "insert_by_position": insert_by_position_q,
    "append_by_name": append_by_name,
    "register_external": register_external_q,
    "people_function": people_function,
    "people_by_path": people_by_path,
    "zip_columns": zip_columns,
    "live_files": live_files_q,
    "sql_parameters": sql_parameters,
    "ctas_no_limit": ctas_no_limit,
    "first_row": first_row_q,
    "catalog_roundtrip": catalog_roundtrip,
    "read_many_paths": read_many_paths,
    "sql_passthrough": sql_passthrough,
}

ORACLES = {
    "csv_inferred": """
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""",
    "delimited_outcomes": """
SELECT CASE c_custkey % 10 WHEN 0 THEN 'bad_cell: c_nationkey' WHEN 1 THEN 'bad_arity' WHEN 2 THEN 'bad_arity' ELSE 'landed' END AS outcome,
       count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS total
FROM customer GROUP BY 1""",
    "csv_schema": """
SELECT * FROM (VALUES (0, 'c_custkey', 'int'), (1, 'c_name', 'string'), (2, 'c_nationkey', 'int'), (3, 'c_acctbal', 'double'),
                      (4, 'c_mktsegment', 'string')) t(ordinal, name, type)""",
    "live_files": "SELECT count(*) AS n_rows, true AS all_sized, true AS all_counted FROM lineitem",
    "people_by_path": """
SELECT c_name AS name, c_nationkey AS age, c_mktsegment AS city FROM customer WHERE c_nationkey >= 10""",
    "table_append": "SELECT * FROM customer",
    "insert_by_position": """
SELECT CAST(s_suppkey AS INTEGER) AS id, s_name AS name, s_nationkey AS nation, s_acctbal AS balance FROM supplier""",
    "append_by_name": "SELECT * FROM supplier",
    "register_external": "SELECT * FROM orders",
    "people_function": """
SELECT c_name AS name, c_nationkey AS age, c_mktsegment AS city FROM customer""",
    "zip_columns": """
SELECT p_partkey, CAST(i AS INTEGER) AS pos,
       string_split(p_name, ' ')[i] AS name_part, string_split(p_type, ' ')[i] AS type_part
FROM part, LATERAL (SELECT unnest(range(1, least(len(string_split(p_name, ' ')),
                                                 len(string_split(p_type, ' '))) + 1)) AS i)""",
    "sql_parameters": """
SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F'""",
    "ctas_no_limit": """
SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_orders FROM lineitem""",
    "first_row": """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 1""",
    "catalog_roundtrip": """
SELECT CAST(s_suppkey AS INTEGER) AS id, s_name AS name, s_nationkey AS age,
       CASE WHEN COALESCE(s_acctbal >= 0, false) THEN 'M' ELSE 'F' END AS gender, true AS db_listed
FROM supplier""",
    "read_many_paths": """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment AS segment FROM customer""",
    "sql_passthrough": """
SELECT o.o_orderstatus, count(*) AS n_lines, count(DISTINCT l.l_orderkey) AS n_orders,
       CAST(sum(l.l_quantity) AS BIGINT) AS total_qty
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
GROUP BY o.o_orderstatus""",
}
