import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lakeframe.plans.catalog import (
    create_table_function, create_view, ensure_database, list_databases, register_external, run_sql, use_database,
)
from lakeframe.schemas import EMPLOYEE, PEOPLE
from lakeframe.sinks.tables import append_at_path, append_table, create_at_path, first_row, insert_by_position, schema_rows
from lakeframe.sources.files import literal_rows, read_delimited, scan_path, write_delimited

# The literal rows of the reference's notebooks.
EMPLOYEES = [(1, "James", 30, "M"), (2, "Ann", 40, "F"), (3, "Jeff", 41, "M"), (4, "Jennifer", 20, "F")]
EMPLOYEES_MORE = [(5, "Sky", 30, "M"), (6, "Anna", 40, "F")]
PEOPLE_ROWS = [("Alice", 30, "New York"), ("Bob", 25, "San Francisco"), ("Charlie", 35, "Los Angeles")]
PEOPLE_MORE = [("David", 28, "Chicago"), ("Eve", 22, "Boston")]


def test_employee_roundtrip_six_rows(spark, tmp_path):
    work = spark.newSession()
    ensure_database(work, "emp_t", str(tmp_path / "emp_t.db"))
    assert list_databases(work).where(F.col("namespace") == "emp_t").count() == 1
    use_database(work, "emp_t")
    append_table(literal_rows(work, EMPLOYEES, EMPLOYEE), "employee", "parquet")
    inferred = literal_rows(work, EMPLOYEES_MORE)
    assert [f.dataType.simpleString() for f in inferred.schema.fields] == ["bigint", "string", "bigint", "string"]
    insert_by_position(inferred, "employee")
    other = spark.newSession()
    rows = other.sql("SELECT * FROM emp_t.employee ORDER BY id").collect()
    assert [r.id for r in rows] == [1, 2, 3, 4, 5, 6]
    assert other.table("emp_t.employee").schema == EMPLOYEE


def test_insert_overflow_and_arity_errors(spark, tmp_path):
    ensure_database(spark, "emp_err", str(tmp_path / "emp_err.db"))
    spark.sql("CREATE TABLE emp_err.e (id INT, name STRING) USING parquet")
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        insert_by_position(spark.createDataFrame([(2**40, "x")]), "emp_err.e")
    with pytest.raises(AnalysisException, match="INSERT_COLUMN_ARITY_MISMATCH"):
        insert_by_position(spark.createDataFrame([(1,)]), "emp_err.e")


def test_people_create_append_and_function_view(spark, tmp_path):
    path = str(tmp_path / "people")
    create_at_path(literal_rows(spark, PEOPLE_ROWS, PEOPLE), path)
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        create_at_path(literal_rows(spark, PEOPLE_ROWS, PEOPLE), path)
    append_at_path(literal_rows(spark, PEOPLE_MORE, PEOPLE), path)
    assert scan_path(spark, path).count() == 5
    create_table_function(spark, "read_people_t", "name STRING, age INT, city STRING",
                          f"SELECT Name, Age, City FROM parquet.`{path}`")
    create_view(spark, "people_view_t", "SELECT * FROM read_people_t()")
    view = spark.table("people_view_t")
    assert view.columns == ["name", "age", "city"]
    filtered = view.where("age > 26").select("name")
    assert sorted(r.name for r in filtered.collect()) == ["Alice", "Charlie", "David"]
    plan = filtered._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(Age), GreaterThan(Age,26)]" in plan


def test_register_external_idempotent_and_three_part_name(spark, tmp_path):
    path = str(tmp_path / "apartment")
    create_at_path(spark.range(3).withColumnRenamed("id", "rooms"), path)
    name = register_external(spark, "apartment_t", path)
    register_external(spark, "apartment_t", path)
    assert name == "spark_catalog.`default`.`apartment_t`"
    assert spark.sql("SELECT * FROM spark_catalog.default.apartment_t").count() == 3
    assert first_row(spark.table("apartment_t"), "rooms").collect()[0].rooms == 0


def test_delimited_inferred_and_schema_rows(spark, tmp_path):
    path = str(tmp_path / "csv")
    write_delimited(literal_rows(spark, PEOPLE_ROWS, PEOPLE), path)
    df = read_delimited(spark, path)
    rows = [(r.name, r.type) for r in schema_rows(spark, df).orderBy("ordinal").collect()]
    assert rows == [("Name", "string"), ("Age", "int"), ("City", "string")]


def test_parameters_are_not_text(spark):
    spark.range(5).createOrReplaceTempView("nums_t")
    out = run_sql(spark, "SELECT id FROM IDENTIFIER(:t) WHERE id >= :lo", t="nums_t", lo=3)
    assert sorted(r.id for r in out.collect()) == [3, 4]
    assert run_sql(spark, "SELECT :v AS v", v="1; DROP TABLE x").first().v == "1; DROP TABLE x"


def test_literal_escapes_quotes(spark, tmp_path):
    from lakeframe.plans.catalog import _literal
    assert spark.sql(f"SELECT {_literal(chr(39) + 'x' + chr(92))} AS v").first().v == "'x\\"
    path = str(tmp_path / "it's here")
    create_at_path(spark.range(2), path)
    assert spark.table(register_external(spark, "quoted_t", path)).count() == 2


def test_connector_pass_throughs_fail_clearly_without_packages(spark, tmp_path):
    from lakeframe.sources.envelopes import read_envelopes
    with pytest.raises(Exception, match="(?i)kafka"):
        read_envelopes(spark, kind="kafka", servers="localhost:9", topic="t")
    with pytest.raises(Exception, match="(?i)delta"):
        create_at_path(spark.range(1), str(tmp_path / "d"), fmt="delta")


def test_cluster_defaults_respect_explicit_settings(spark):
    from lakeframe.session import CLUSTER_CONF, apply_cluster_defaults
    s = spark.newSession()
    s.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "9")
    applied = apply_cluster_defaults(s)
    assert "spark.sql.adaptive.skewJoin.skewedPartitionFactor" not in applied
    assert s.conf.get("spark.sql.adaptive.skewJoin.skewedPartitionFactor") == "9"
    assert set(applied) <= set(CLUSTER_CONF)


def test_paths_table_with_null_and_escaped_folders(spark, tmp_path):
    from lakeframe.sources.files import folder_of, read_paths
    root = str(tmp_path / "t")
    rows = [(1, "A:B"), (2, "c d"), (3, "p%q"), (4, None), (5, "left out"), (6, "+x")]
    spark.createDataFrame(rows, "id int, segment string").write.partitionBy("segment").parquet(root)
    folders = spark.read.parquet(root).select("segment", folder_of(F.col("_metadata.file_path")).alias("path")).distinct()
    wanted = folders.where("segment IS NULL OR segment <> 'left out'").select("path")
    wanted = wanted.unionByName(wanted).unionByName(spark.createDataFrame([(None,), ("/nowhere",)], "path string"))
    got = read_paths(wanted, root)
    assert sorted((r.id, r.segment) for r in got.collect()) == [r for r in rows if r[0] != 5]
    assert got.select("source_path").distinct().count() == 5
    assert not any("left" in f for f in got.inputFiles())  # only the named folders are opened
    assert read_paths(wanted.where("path = '/nowhere'"), root).count() == 0


def test_named_folders_alone_are_read_not_those_below_them(spark, tmp_path):
    from lakeframe.sources.files import read_paths
    root = tmp_path / "t"
    for folder, n in (("a", 1), ("b[1]", 2), ("b1", 4), ("a/deep", 8)):
        spark.range(n).coalesce(1).write.parquet(str(root / folder))
    named = spark.createDataFrame([(f"{root}/a/",), (f"file:{root}/b[1]",), (f"{root}/a",), (str(tmp_path),)], "path string")
    assert read_paths(named, str(root)).count() == 3


def test_malformed_lines_are_rejected_with_file_and_reason(spark, tmp_path):
    from pyspark.sql.types import StructType

    from lakeframe.sources.files import split_delimited
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.csv").write_text('id;name;score;day\n1;a;1.5;2024-01-02\nx;b;2;2024-01-02\n3;c;3\n')
    (tmp_path / "in" / "two +.csv").write_text('id;name;score;day\n4;"d;e";;\n5;f;five;never\n6;g;1;2024-01-01;more\n')
    rows, rejected = split_delimited(spark, str(tmp_path / "in"), StructType.fromDDL("id INT, name STRING, score DOUBLE, day DATE"))
    assert sorted((r.id, r.name, r.score, str(r.day)) for r in rows.collect()) == [(1, "a", 1.5, "2024-01-02"), (4, "d;e", None, "None")]
    assert sorted((r.file, r.line, r.reason) for r in rejected.collect()) == [
        ("one.csv", "3;c;3", "bad_arity"), ("one.csv", "x;b;2;2024-01-02", "bad_cell: id"),
        ("two +.csv", "5;f;five;never", "bad_cell: score,day"), ("two +.csv", "6;g;1;2024-01-01;more", "bad_arity")]
    assert rows.count() == 2 and rejected.count() == 4


def test_live_files_count_empty_files(spark, tmp_path):
    from lakeframe.sources.files import live_files
    path = str(tmp_path / "a b")
    spark.range(0, 10, 1, 2).write.parquet(path)
    spark.range(0).coalesce(1).write.mode("append").parquet(path)
    got = sorted((r.n_rows, r.file_size > 0) for r in live_files(spark, path).collect())
    assert got == [(0, True), (5, True), (5, True)]


def test_people_by_path_pushes_its_callers_filter(spark, tmp_path):
    from lakeframe.sources.files import read_people
    path = str(tmp_path / "people")
    create_at_path(literal_rows(spark, PEOPLE_ROWS, PEOPLE), path)
    df = read_people(spark, path).where("age > 26").select("name")
    assert sorted(r.name for r in df.collect()) == ["Alice", "Charlie"]
    assert "GreaterThan(Age,26)" in df._jdf.queryExecution().executedPlan().toString()


def test_work_folder_must_be_shared_on_a_cluster(monkeypatch):
    from lakeframe import session

    class Conf:
        def get(self, name, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.work_root(Session())


def test_databases_made_by_queries_can_be_dropped(spark):
    import __spark_entry__ as E
    from lakeframe.session import drop_temporary
    assert E.queries()["append_by_name"](spark, "/root/testdata/sf0.001").count() > 0
    assert list_databases(spark).where("namespace LIKE 'lf_append_by_name%'").count() >= 1
    drop_temporary(spark)
    assert list_databases(spark).where("namespace LIKE 'lf\\_%'").count() == 0
