from pyspark.sql import functions as F

from lakeframe.functions.headers import (
    build_headers, header_bytes, header_int, header_text, headers_map, media_columns,
)
from lakeframe.schemas import HEADERS


def _rows(spark, headers_list):
    return spark.createDataFrame([(i, h) for i, h in enumerate(headers_list)], f"i int, headers {HEADERS.simpleString()}")


def test_last_duplicate_wins_missing_and_null(spark):
    df = _rows(spark, [
        [("a", b"1"), ("a", b"2")],
        [("b", b"x")],
        None,
        [],
    ])
    got = {r.i: r.v for r in df.select("i", header_text("a").alias("v")).collect()}
    assert got == {0: "2", 1: None, 2: None, 3: None}


def test_invalid_utf8_is_replaced(spark):
    df = _rows(spark, [[("media_name", b"\xffA")]])
    assert df.select(header_text("media_name")).first()[0] == "�A"


def test_int_headers_malformed_give_null(spark):
    df = _rows(spark, [[("n", v)] for v in (b"12", b"x1", b"99999999999", b"", b"-7", b"12.7")])
    got = [r[0] for r in df.orderBy("i").select(header_int("n")).collect()]
    assert got == [12, None, None, None, -7, None]


def test_headers_map_last_wins(spark):
    df = _rows(spark, [[("a", b"1"), ("b", b"2"), ("a", b"3")]])
    m = df.select(headers_map().alias("m")).first().m
    assert m == {"b": bytearray(b"2"), "a": bytearray(b"3")}


def test_build_headers_omits_nulls_and_keeps_duplicates(spark):
    df = spark.range(1).select(build_headers([("a", F.lit(1)), ("b", F.lit(None).cast("string")), ("a", F.lit("z"))]).alias("headers"))
    h = df.first().headers
    assert [(e.key, bytes(e.value)) for e in h] == [("a", b"1"), ("a", b"z")]
    assert df.select(header_text("a")).first()[0] == "z"


def test_media_columns_defaults(spark):
    df = _rows(spark, [None, [("type", b"video"), ("frame_id", b"3"), ("last_frame", b"yes"), ("fps", b"25")]])
    rows = media_columns(df).orderBy("i").collect()
    assert (rows[0].type, rows[0].media_name, rows[0].frame_id, rows[0].last_frame, rows[0].fps) == ("unknown", "unknown", 0, "unknown", 0)
    assert (rows[1].type, rows[1].frame_id, rows[1].last_frame, rows[1].fps) == ("video", 3, "yes", 25)


def test_header_bytes_raw(spark):
    df = _rows(spark, [[("k", b"\x00\x01")]])
    assert bytes(df.select(header_bytes("k")).first()[0]) == b"\x00\x01"
