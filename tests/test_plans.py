"""Plan shape: pruning, codegen, hash aggregation, no payload in shuffles, skew-safe windows."""

import __spark_entry__ as E

from .conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_is_one_codegen_stage_reading_three_columns(spark):
    plan = _plan(E.queries()["media_metadata"](spark, SF_SMALL))
    assert "Exchange" not in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string,n_chars:bigint>" in plan
    assert "*(1) Project" in plan and "lambdafunction" not in plan


def test_assembly_hash_aggregates_without_payload_in_shuffle(spark):
    df = E.queries()["assemble_batch"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    final = df._jdf.queryExecution().optimizedPlan().toString()
    # the digest is computed before the first aggregate: no binary payload column reaches it
    agg_inputs = [line for line in final.splitlines() if "Aggregate" in line]
    assert agg_inputs and not any("payload" in line for line in agg_inputs)


def test_frame_numbering_window_is_bucketed(spark):
    from lakeframe.operators.frames import number_frames
    df = spark.range(100).selectExpr("id % 2 AS k", "id AS o")
    plan = _plan(number_frames(df, "k", "o", bucket_width=8))
    window_lines = [line for line in plan.splitlines() if "Window [" in line and "row_number" in line]
    assert window_lines and "__at#" in window_lines[0]  # (key, bucket), not the key alone


def test_start_position_broadcasts_only_the_marks(spark, tmp_path):
    from lakeframe.sources.envelopes import start_position
    env = spark.createDataFrame([("t", 0, 1), ("t", 1, 5)], "topic string, partition int, offset long")
    marks = spark.createDataFrame([("t", 0, 0)], "topic string, partition int, high_water long")
    out = start_position(env, marks)
    assert "BroadcastHashJoin" in _plan(out)
    assert sorted((r.partition, r.offset) for r in out.collect()) == [(0, 1), (1, 5)]


def test_table_function_view_pushes_filter_to_scan(spark):
    df = E.queries()["people_function"](spark, SF_SMALL).where("age = 3").select("name")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(Age), EqualTo(Age,3)]" in plan
    assert "ReadSchema: struct<Name:string,Age:int>" in plan


def test_latest_per_name_is_a_hash_aggregate_without_payload(spark):
    df = E.queries()["latest_object"](spark, SF_SMALL)
    plan = _plan(df)
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    assert not any("value" in line.split("Aggregate", 1)[1] for line in optimized.splitlines() if "Aggregate [" in line)
