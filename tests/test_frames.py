import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeframe.operators.frames import (
    assemble_batch, explode_frames, frame_digest, latest_per_name, number_frames, ordered_frames,
)

FRAME_SCHEMA = ("media_name string, frame_id int, last_frame string, fps int, height int, width int, "
                "payload binary, partition int, offset long")


def _frames(spark, rows):
    return spark.createDataFrame(rows, FRAME_SCHEMA)


def _video(name, n, fps=25, h=4, w=6, start_offset=0):
    return [(name, i, "yes" if i == n - 1 else "no", fps, h, w, f"{name}:{i}".encode(), 0, start_offset + i)
            for i in range(n)]


def _brute_digest(rows):
    import hashlib
    seen = {}
    for r in rows:
        seen.setdefault(r[1], r[6])
    return str(sum(int(hashlib.md5(f"{fid}:".encode() + p).hexdigest()[:15], 16) for fid, p in seen.items()))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 50)), min_size=1, max_size=60, unique=True))
def test_number_frames_matches_brute_force(spark, pairs):
    df = spark.createDataFrame(pairs, "k int, o int")
    got = {(r.k, r.o): (r.frame_seq, r.is_last) for r in number_frames(df, "k", "o", bucket_width=4).collect()}
    want = {}
    for k in {p[0] for p in pairs}:
        os_ = sorted(o for kk, o in pairs if kk == k)
        for i, o in enumerate(os_):
            want[(k, o)] = (i, i == len(os_) - 1)
    assert got == want


def test_explode_frames_and_reject_empty(spark):
    videos = spark.createDataFrame(
        [("v.mp4", 29.97, 4, 6, [b"a", b"b", b"c"]), ("empty.mp4", 25.0, 4, 6, []), ("null.mp4", 25.0, 4, 6, None)],
        "media_name string, fps double, height int, width int, frames array<binary>")
    frames, rejected = explode_frames(videos)
    rows = frames.orderBy("frame_id").collect()
    assert [(r.frame_id, r.last_frame) for r in rows] == [(0, "no"), (1, "no"), (2, "yes")]
    fps = {bytes(h.value) for h in rows[0].headers if h.key == "fps"}
    assert fps == {b"29"}
    assert sorted(r.media_name for r in rejected.collect()) == ["empty.mp4", "null.mp4"]


def test_assemble_shuffled_duplicated_interleaved(spark):
    a, b = _video("a.mp4", 5), _video("b.mp4", 3, fps=30)
    rows = a + b + [a[2], a[4]]  # redelivered frames, last frame twice
    random.Random(3).shuffle(rows)
    out = {r.media_name: r for r in assemble_batch(_frames(spark, rows)).collect()}
    assert set(out) == {"a.mp4", "b.mp4"}
    assert (out["a.mp4"].n_frames, out["a.mp4"].last_frame_id, out["a.mp4"].fps) == (5, 4, 25)
    assert (out["b.mp4"].n_frames, out["b.mp4"].fps) == (3, 30)
    assert out["a.mp4"].digest == _brute_digest(a)


def test_assemble_missing_frame_and_no_last(spark):
    a = _video("a.mp4", 4)
    missing = [r for r in a if r[1] != 1]
    no_last = a[:-1]
    single = _video("s.mp4", 1)
    out = {r.media_name for r in assemble_batch(_frames(spark, missing + single + [
        (n, *r[1:]) for n, r in (("c.mp4", x) for x in no_last)])).collect()}
    assert out == {"s.mp4"}
    loose = {r.media_name: r.n_frames for r in assemble_batch(_frames(spark, missing), strict=False).collect()}
    assert loose == {"a.mp4": 3}


def test_digest_is_order_aware(spark):
    df = spark.createDataFrame([(0, b"x"), (1, b"y")], "frame_id int, payload binary")
    swapped = spark.createDataFrame([(0, b"y"), (1, b"x")], "frame_id int, payload binary")
    s1 = df.select(F.sum(frame_digest(F.col("frame_id"), F.col("payload")))).first()[0]
    s2 = swapped.select(F.sum(frame_digest(F.col("frame_id"), F.col("payload")))).first()[0]
    assert s1 != s2


def test_ordered_frames_sorted(spark):
    rows = _video("a.mp4", 20) + _video("b.mp4", 7)
    random.Random(1).shuffle(rows)
    out = [(r.media_name, r.frame_id) for r in ordered_frames(_frames(spark, rows)).collect()]
    assert out == sorted(out)


def test_latest_per_name_ties_broken_by_partition_offset(spark):
    df = spark.createDataFrame([("x", 1, 0, 5, "old"), ("x", 2, 0, 1, "new"), ("x", 2, 1, 0, "newest"), ("y", 1, 0, 0, "only")],
                               "media_name string, timestamp long, partition int, offset long, v string")
    got = {r.media_name: r.v for r in latest_per_name(df).collect()}
    assert got == {"x": "newest", "y": "only"}


def test_latest_rows_keeps_whole_winning_rows(spark):
    from lakeframe.operators.frames import latest_rows
    df = spark.createDataFrame([("x", 1, 0, 5, b"old"), ("x", 2, 0, 1, b"new"), ("x", 2, 1, 0, b"newest"),
                                ("y", 1, 0, 0, b"only")],
                               "media_name string, timestamp long, partition int, offset long, image_data binary")
    got = {r.media_name: bytes(r.image_data) for r in latest_rows(df).collect()}
    assert got == {"x": b"newest", "y": b"only"}


def test_write_ordered_frames(spark, tmp_path):
    from lakeframe.operators.frames import write_ordered_frames
    rows = _video("a.mp4", 12) + _video("b.mp4", 5)
    random.Random(5).shuffle(rows)
    path = str(tmp_path / "frames")
    write_ordered_frames(_frames(spark, rows), path)
    files = sorted(p for p in __import__("os").listdir(path) if p.endswith(".parquet"))
    seen = []
    for f in files:
        seen += [(r.media_name, r.frame_id) for r in spark.read.parquet(f"{path}/{f}").collect()]
    assert seen == sorted(seen) and len(seen) == 17


def test_hot_media_is_split_across_buckets(spark):
    from pyspark.sql import functions as F

    n = 300_000
    hot = spark.range(n).select(F.lit("hot.mp4").alias("media_name"), F.col("id").cast("int").alias("frame_id"))
    cold = spark.range(10).select(F.lit("cold.mp4").alias("media_name"), F.col("id").cast("int").alias("frame_id"))
    frames = hot.unionByName(cold)
    numbered = number_frames(frames, "media_name", "frame_id", bucket_width=65_536)
    bad = numbered.where((F.col("frame_seq") != F.col("frame_id"))
                         | (F.col("is_last") != (F.col("frame_id") == F.when(F.col("media_name") == "hot.mp4", n - 1).otherwise(9))))
    assert bad.count() == 0
    buckets = frames.where("media_name = 'hot.mp4'").selectExpr("frame_id div 65536 AS b").distinct().count()
    assert buckets == 5  # the hot media is ranked in 5 independent window partitions

    as_frames = numbered.select(
        "media_name", "frame_id", F.when(F.col("is_last"), "yes").otherwise("no").alias("last_frame"),
        F.lit(25).alias("fps"), F.lit(4).alias("height"), F.lit(6).alias("width"),
        F.encode(F.col("frame_id").cast("string"), "UTF-8").alias("payload"),
        F.lit(0).alias("partition"), F.col("frame_id").cast("long").alias("offset"))
    out = {r.media_name: r.n_frames for r in assemble_batch(as_frames).collect()}
    assert out == {"hot.mp4": n, "cold.mp4": 10}


def test_dedupe_frames_keeps_earliest_whole_row(spark):
    from lakeframe.operators.frames import dedupe_frames
    a = _video("a.mp4", 3)
    late_copy = (a[1][0], a[1][1], a[1][2], a[1][3], a[1][4], a[1][5], b"late", 2, 0)
    early = (a[1][0], a[1][1], a[1][2], a[1][3], a[1][4], a[1][5], b"early", 0, 0)
    rows = [a[0], a[2], late_copy, early]
    out = {r.frame_id: bytes(r.payload) for r in dedupe_frames(_frames(spark, rows)).collect()}
    assert out == {0: b"a.mp4:0", 1: b"early", 2: b"a.mp4:2"}


def test_numbering_keeps_rows_with_null_key_or_order(spark):
    rows = [("a", 1), ("a", None), (None, 3), (None, 4), ("b", None)]
    got = sorted(((r.k or "", r.o or 0, r.frame_seq, r.is_last) for r in number_frames(spark.createDataFrame(rows, "k string, o long"), "k", "o").collect()))
    assert got == [("", 3, 0, False), ("", 4, 1, True), ("a", 0, 0, False), ("a", 1, 1, True), ("b", 0, 0, True)]


def test_latest_rows_keep_null_names_and_positions(spark):
    from lakeframe.operators.frames import latest_rows
    rows = [("x", 5, 0, 1, "x"), (None, 3, 0, 2, "null name"), (None, 2, 0, 1, "older"), ("y", None, None, None, "no position")]
    df = spark.createDataFrame(rows, "media_name string, timestamp long, partition int, offset long, v string")
    assert {r.v for r in latest_rows(df).collect()} == {"x", "null name", "no position"}


def test_positions_order_like_their_parts_or_raise(spark):
    from lakeframe.operators.frames import position_order
    edge = [None, 0, 1, (1 << 17) - 2]
    rows = [(t, p, o) for t in (None, -(1 << 55), -1, 0, 7, (1 << 55) - 1) for p in edge for o in (None, 0, 5, (1 << 53) - 2)]
    schema = "timestamp long, partition int, offset long"
    df = spark.createDataFrame(rows, schema).withColumn("n", position_order(fields={"timestamp": "bigint"}))
    got = [tuple(r)[:3] for r in df.orderBy("n").collect()]
    low = lambda v, least: least if v is None else v
    key = lambda r: (low(r[0], -(1 << 55)), low(r[1], -1), low(r[2], -1))
    assert [key(r) for r in got] == sorted(key(r) for r in rows)
    for bad in ((0, 1 << 17, 0), (0, 0, 1 << 53), (1 << 60, 0, 0)):
        with __import__("pytest").raises(Exception, match="out of range"):
            spark.createDataFrame([bad], schema).select(position_order(fields={"timestamp": "bigint"}).alias("n")).collect()


def test_records_without_name_id_or_payload_are_rejected_not_merged(spark):
    from lakeframe.functions.headers import build_headers
    from lakeframe.operators.frames import split_frames
    rows = [("a", "0", b"1"), (None, "0", b"2"), ("a", None, b"3"), ("a", "x", b"4"), ("a", "-1", b"5"), ("a", "1", None), ("", "1", b"7")]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "m string, f string, value binary, offset long")
    env = df.select("value", F.lit(0).alias("partition"), "offset", F.lit(None).cast("timestamp").alias("timestamp"),
                    build_headers([("media_name", F.col("m")), ("frame_id", F.col("f"))]).alias("headers"))
    frames, rejected = split_frames(env)
    assert [r.offset for r in frames.collect()] == [0]
    assert {r.offset: r.reason for r in rejected.collect()} == {
        1: "missing_name", 2: "missing_frame_id", 3: "missing_frame_id", 4: "bad_frame_id", 5: "null_payload", 6: "missing_name"}


def test_assembled_frames_are_the_sequence(spark):
    from lakeframe.operators.frames import assembled_frames
    a, b = _video("a.mp4", 5), _video("b.mp4", 3)
    copy = (*a[1][:6], b"copy", 3, 99)
    rows = a + [copy] + [r for r in b if r[1] != 1]
    random.Random(2).shuffle(rows)
    got = sorted((r.media_name, r.pos, bytes(r.payload), r.fps) for r in assembled_frames(_frames(spark, rows)).collect())
    assert got == [("a.mp4", i, f"a.mp4:{i}".encode(), 25) for i in range(5)]
    loose = sorted((r.media_name, r.pos, r.frame_id) for r in assembled_frames(_frames(spark, rows), strict=False).collect())
    assert loose[-2:] == [("b.mp4", 0, 0), ("b.mp4", 1, 2)]
