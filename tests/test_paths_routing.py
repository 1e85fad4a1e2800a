import os

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeframe.functions.paths import basename, extension, format_name, parse_extensions
from lakeframe.operators.routing import reject_reason, route_by_extension, split_by_type, split_valid

NAMES = ["a.jpg", "a", ".bashrc", "x.tar.GZ", "..a", "a.", "a..b", "...", ".", "photo.JPEG", "dir.v1/clip", "a.b.c.mp4"]


def test_extension_matches_python(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "name string")
    got = dict(df.select("name", extension(F.col("name")).alias("e")).collect())
    assert got == {n: os.path.splitext(n)[1] for n in NAMES}


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="ab.X", min_size=0, max_size=7), min_size=1, max_size=15))
def test_extension_property(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = [r[0] for r in df.select(extension(F.col("name"))).collect()]
    assert got == [os.path.splitext(n)[1] for n in names]


def test_basename_and_format_name(spark):
    df = spark.createDataFrame([("/in/a/b.jpg", ".jpg"), ("c.png", ".png"), ("x", ".TIF")], "p string, e string")
    rows = df.select(basename("p").alias("b"), format_name("e").alias("f")).collect()
    assert [(r.b, r.f) for r in rows] == [("b.jpg", "JPEG"), ("c.png", "PNG"), ("x", "TIFF")]


def test_extension_list_is_a_set_not_a_substring():
    assert parse_extensions("jpg, .PNG,,") == [".jpg", ".png"]
    # the reference's substring test would accept '' and '.jp'
    assert "" not in parse_extensions(".jpg,.png") and ".jp" not in parse_extensions(".jpg,.png")


def test_route_both_sets_independent(spark):
    df = spark.createDataFrame([("a.JPG",), ("b.mp4",), ("c.txt",), ("d",), ("e.gif",)], "name string")
    out = {r.name: (r.is_image, r.is_video) for r in route_by_extension(df, "name", ".jpg", ".mp4,.gif").collect()}
    assert out == {"a.JPG": (True, False), "b.mp4": (False, True), "c.txt": (False, False), "d": (False, False), "e.gif": (False, True)}
    both = route_by_extension(df, "name", ".gif", ".gif").where("is_image and is_video").count()
    assert both == 1


def test_split_by_type_anything_else_is_video(spark):
    df = spark.createDataFrame([("image",), ("video",), (None,), ("IMAGE",)], "type string")
    img, vid = split_by_type(df)
    assert img.count() == 1 and vid.count() == 3


def test_reject_reasons(spark):
    rows = [(None, "a.jpg", 1, 1), (b"", "a.jpg", 1, 1), (b"x", None, 1, 1), (b"x", "a.jpg", 0, 1),
            (b"x", "a.jpg", 1, None), (b"x", "a.gif", 1, 1), (b"x", "a.jpg", 2, 2)]
    df = spark.createDataFrame(rows, "value binary, media_name string, original_height int, original_width int")
    got = [r[0] for r in df.select(reject_reason()).collect()]
    assert got == ["null_payload", "empty_payload", "missing_name", "bad_height", "bad_width", "unsupported_format", None]
    ok, bad = split_valid(df)
    assert ok.count() == 1 and bad.count() == 6
