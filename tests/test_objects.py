import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeframe.functions.pixels import bgr_to_rgb, resize_bilinear
from lakeframe.operators.images import image_dimensions, resize_images
from lakeframe.plans.pngs import encode_png
from lakeframe.sinks.objects import check_name, copy_objects, list_objects, read_objects, write_objects


def test_object_sink_writes_and_overwrites(spark, tmp_path):
    root = str(tmp_path / "objs")
    write_objects(spark.createDataFrame([("a.jpg", b"one"), ("sub/b.png", b"two")], "name string, content binary"), root)
    write_objects(spark.createDataFrame([("a.jpg", b"three")], "name string, content binary"), root)
    got = {r.name: bytes(r.content) for r in read_objects(spark, root, recursive=True).collect()}
    assert got == {"a.jpg": b"three", "sub/b.png": b"two"}
    assert (tmp_path / "objs" / "sub" / "b.png").read_bytes() == b"two"


def test_bad_object_names():
    for bad in ("", "/abs", "a/../b", "a//b", "."):
        with pytest.raises(ValueError):
            check_name(bad)
    assert check_name("x/y.jpg") == "x/y.jpg"


def test_objects_without_name_or_content_fail_the_write(spark, tmp_path):
    for bad in ((None, b"x"), ("a", None)):
        with pytest.raises(Exception, match="needs a name and content"):
            write_objects(spark.createDataFrame([bad], "name string, content binary"), str(tmp_path / "objs"))


ODD = ["_a.jpg", ".b.jpg", "c d.jpg", "e%20f.jpg", "g#h?.jpg", "i+j.jpg", "x/a.jpg", "y/a.jpg", "x/_z/.k", "é.jpg"]


def test_odd_names_and_equal_base_names_survive_write_list_read_and_copy(spark, tmp_path):
    root, dest = str(tmp_path / "in put"), str(tmp_path / "out%20put")
    write_objects(spark.createDataFrame([(n, n.encode()) for n in ODD], "name string, content binary"), root)
    assert {r.name: bytes(r.content) for r in read_objects(spark, root, recursive=True).collect()} == {n: n.encode() for n in ODD}
    status = copy_objects(list_objects(spark, root, recursive=True), dest, str(tmp_path / "status"))
    assert {(r.name, r.n_bytes, r.status) for r in status.collect()} == {(n, len(n.encode()), "ok") for n in ODD}
    for n in ODD:
        assert (tmp_path / "out%20put" / n).read_bytes() == n.encode()


def test_copy_reports_failures_and_collisions_without_stopping(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "ok.bin").write_bytes(b"x" * 1000)
    (src / "other.bin").write_bytes(b"y")
    listing = list_objects(spark, str(src)).select("path", "name").where("name = 'ok.bin'")
    more = spark.createDataFrame([(f"file:{src}/missing.bin", "missing.bin"), (f"file:{src}/other.bin", "ok.bin"), (f"file:{src}/ok.bin", "../bad"),
                                  ("no scheme", "odd.bin")], "path string, name string")
    rows = copy_objects(listing.unionByName(more), str(tmp_path / "dst"), str(tmp_path / "status"), part_bytes=64).collect()
    out = {(r.name, r.status): r for r in rows}
    assert len(rows) == 5 and out["ok.bin", "ok"].n_bytes == 1000
    assert "is taken by" in out["ok.bin", "failed"].error
    assert "FileNotFoundError" in out["missing.bin", "failed"].error and "bad object name" in out["../bad", "failed"].error
    assert "not a qualified path" in out["odd.bin", "failed"].error
    assert (tmp_path / "dst" / "ok.bin").read_bytes() == b"x" * 1000
    assert sorted(p.name for p in (tmp_path / "dst").iterdir()) == ["ok.bin"]  # nothing half written


def test_a_failed_copy_leaves_no_object_and_a_retry_completes_it(spark, tmp_path, monkeypatch):
    from lakeframe.sinks import objects
    fs, base = objects.resolve_fs(f"file:{tmp_path}")

    def breaking():
        yield b"half"
        raise OSError("cut")
    with pytest.raises(OSError):
        objects._put(fs, f"{base}/o.bin", breaking())
    assert list(tmp_path.iterdir()) == []
    assert objects._put(fs, f"{base}/o.bin", iter([b"half", b"whole"])) == 9
    assert (tmp_path / "o.bin").read_bytes() == b"halfwhole"


def test_paths_without_scheme_are_in_the_default_file_system(spark, tmp_path):
    from lakeframe.sinks.objects import qualify, resolve_fs
    assert qualify(spark, "/a b/c%20d") == "file:/a b/c%20d"
    assert resolve_fs("file:///a b/#c%20")[1] == "/a b/#c%20"
    with pytest.raises(ValueError):
        resolve_fs("/a/b")


def test_png_dimensions_and_bad_file_dropped(spark, tmp_path):
    d = tmp_path / "imgs"
    d.mkdir()
    (d / "g.png").write_bytes(encode_png(np.arange(12, dtype=np.uint8).reshape(3, 4)))
    (d / "c.png").write_bytes(encode_png(np.zeros((2, 5, 3), dtype=np.uint8)))
    (d / "bad.png").write_bytes(b"not a png")
    got = {r.name: (r.height, r.width, r.n_channels) for r in image_dimensions(spark, str(d)).collect()}
    assert got == {"g.png": (3, 4, 1), "c.png": (2, 5, 3)}


def test_resize_matches_brute_force(spark, tmp_path):
    rng = np.random.default_rng(0)
    rgb = rng.integers(0, 255, size=(6, 8, 3), dtype=np.uint8)
    d = tmp_path / "imgs"
    d.mkdir()
    (d / "x.png").write_bytes(encode_png(rgb))
    row = resize_images(spark, str(d), 0.5).first()
    # the image source hands BGR; the operator resizes and returns RGB
    want = resize_bilinear(rgb[:, :, ::-1], 3, 4)[:, :, ::-1]
    assert (row.height, row.width) == (3, 4)
    assert (row.r_sum, row.g_sum, row.b_sum) == tuple(int(want[:, :, i].sum()) for i in range(3))
    assert row.md5 == hashlib.md5(np.ascontiguousarray(want).tobytes()).hexdigest()


def test_resize_2x_down_is_block_mean_and_identity():
    img = np.array([[0, 4, 8, 8], [4, 8, 8, 8]], dtype=np.uint8)
    assert resize_bilinear(img, 1, 2).tolist() == [[4, 8]]
    assert (resize_bilinear(img, 2, 4) == img).all()
    three = np.zeros((1, 1, 3), dtype=np.uint8)
    three[0, 0] = [1, 2, 3]
    assert bgr_to_rgb(three)[0, 0].tolist() == [3, 2, 1]


def test_resize_to_header_size_and_rejects(spark, tmp_path):
    from lakeframe.operators.images import resize_to_headers

    d = tmp_path / "imgs"
    d.mkdir()
    (d / "a.png").write_bytes(encode_png(np.full((4, 6, 3), 9, dtype=np.uint8)))
    (d / "b.jpg").write_bytes(b"\xff\xd8 truncated")
    meta = spark.createDataFrame([("a.png", 2, 3), ("b.jpg", 2, 3), ("gone.png", 1, 1), ("a.png", 0, 3), ("a.png", None, 3)],
                                 "media_name string, original_height int, original_width int")
    resized, rejected = resize_to_headers(spark, str(d), meta)
    row = resized.collect()
    assert [(r.height, r.width, r.r_sum) for r in row] == [(2, 3, 9 * 6)]
    assert sorted((r.media_name, r.reason) for r in rejected.collect()) == [
        ("a.png", "bad_size"), ("a.png", "bad_size"), ("b.jpg", "no_image"), ("gone.png", "no_image")]


def test_every_image_file_is_an_envelope_or_rejected(spark, tmp_path):
    from lakeframe.functions.headers import metadata_projection
    from lakeframe.operators.images import image_envelopes
    d = tmp_path / "im gs"
    d.mkdir()
    png = encode_png(np.zeros((3, 4), dtype=np.uint8))
    files = {"i0.png": png, "a b%20+#.png": encode_png(np.zeros((5, 2, 3), dtype=np.uint8)), "cut.png": png[:30], "empty.jpg": b"", "junk.png": b"junk",
             ".hidden.png": png, "_under.png": png, "no.txt": b"text"}
    for name, data in files.items():
        (d / name).write_bytes(data)
    envelopes, rejected = image_envelopes(spark, str(d))
    assert sorted(tuple(r) for r in metadata_projection(envelopes).collect()) == [
        (".hidden.png", 3, 4), ("_under.png", 3, 4), ("a b%20+#.png", 5, 2), ("i0.png", 3, 4)]
    assert {bytes(r.value) for r in envelopes.collect()} == {png, files["a b%20+#.png"]}
    assert {r.name: r.reason for r in rejected.collect()} == {"cut.png": "undecodable", "empty.jpg": "empty_payload", "junk.png": "undecodable"}
    for df in image_envelopes(spark, str(d)):  # bytes are read last: names and sizes alone are shuffled
        shuffled = [line for line in df._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange" in line]
        assert not any("content" in line or "value" in line for line in shuffled)


def test_images_of_hidden_names_are_decoded(spark, tmp_path):
    from lakeframe.functions.headers import metadata_projection
    from lakeframe.operators.images import image_envelopes, resize_to_headers
    d = tmp_path / "im gs"
    d.mkdir()
    png = encode_png(np.full((4, 6, 3), 9, dtype=np.uint8))
    names = [".h.png", "_u.png", "_a=b.png", "._é %20+#.png", "x.png", "x.h.png"]
    for name in names:
        (d / name).write_bytes(png)
    (d / ".cut.png").write_bytes(png[:30])
    (d / "_empty.png").write_bytes(b"")
    (d / ".no.txt").write_bytes(b"text")
    assert sorted(r.name for r in image_dimensions(spark, str(d)).collect()) == sorted(names)
    meta = spark.createDataFrame([(n, 2, 3) for n in [*names, ".cut.png"]], "media_name string, original_height int, original_width int")
    resized, rejected = resize_to_headers(spark, str(d), meta)
    assert sorted((r.name, r.height, r.r_sum) for r in resized.collect()) == sorted((n, 2, 9 * 6) for n in names)
    assert [(r.media_name, r.reason) for r in rejected.collect()] == [(".cut.png", "no_image")]
    envelopes, rejected = image_envelopes(spark, str(d))
    assert sorted(tuple(r) for r in metadata_projection(envelopes).collect()) == sorted((n, 4, 6) for n in names)
    assert {r.name: r.reason for r in rejected.collect()} == {".cut.png": "undecodable", "_empty.png": "empty_payload"}


def test_a_write_that_fails_half_way_shows_no_object(spark, tmp_path):
    root = tmp_path / "objs"
    rows = [(f"ok{i}", b"x") for i in range(20)] + [("bad", None)]
    with pytest.raises(Exception, match="needs a name and content"):
        write_objects(spark.createDataFrame(rows, "name string, content binary").repartition(4), str(root))
    assert not root.exists() and not list((tmp_path / "objs.staged").iterdir())


def test_an_interrupted_publish_is_finished_by_the_replay(spark, tmp_path, monkeypatch):
    from lakeframe.sinks import objects
    root, places = str(tmp_path / "objs"), objects.Places(spark, str(tmp_path / "places"))
    df = spark.createDataFrame([(f"d/o{i}", b"%d" % i, 5) for i in range(12)], "name string, content binary, place long")

    def crash(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(objects, "publish_objects", crash)
        with pytest.raises(RuntimeError, match="lost"):
            write_objects(df, root, place="place", places=places, folder="batch_id=0")
    assert not (tmp_path / "objs").exists() and places.committed("batch_id=0")
    one = next(p for p in (tmp_path / "objs.staged" / "batch_id=0").iterdir())
    held = {r.staged.rsplit("/", 1)[1]: r.name for r in spark.read.parquet(places.manifest("batch_id=0")).collect()}
    (tmp_path / "objs" / "d").mkdir(parents=True)
    one.rename(tmp_path / "objs" / held[one.name])  # moved before the crash
    write_objects(df.limit(0), root, place="place", places=places, folder="batch_id=0")  # the replay's rows are not looked at
    assert {r.name: bytes(r.content) for r in read_objects(spark, root, recursive=True).collect()} == {f"d/o{i}": b"%d" % i for i in range(12)}
    assert not (tmp_path / "objs.staged" / "batch_id=0").exists()


def test_latest_write_wins_over_compacted_manifests(spark, tmp_path, monkeypatch):
    from lakeframe.sinks import objects
    monkeypatch.setattr(objects, "COMPACT_AFTER", 3)
    root, places = str(tmp_path / "objs"), objects.Places(spark, str(tmp_path / "places"))
    for batch, (name, place) in enumerate([("a", 5), ("b", 1), ("a", 3), ("a", 9), ("b", 0), ("a", 8), ("c", 1), ("a", 7), ("b", 2)]):
        df = spark.createDataFrame([(name, str(place).encode(), place)], "name string, content binary, place long")
        write_objects(df, root, place="place", places=places, folder=f"batch_id={batch}")
    assert {r.name: bytes(r.content) for r in read_objects(spark, root).collect()} == {"a": b"9", "b": b"2", "c": b"1"}
    assert len(list((tmp_path / "places" / "compacted").iterdir())) == 1 and len(list((tmp_path / "places" / "batches").iterdir())) <= 3
    files = [p.name for p in (tmp_path / "places").rglob("*") if p.is_file() and not p.name.endswith(".crc")]
    assert all(n == "_SUCCESS" or n.endswith(".parquet") for n in files)  # no file per object


def test_listing_is_files_only_one_level(spark, tmp_path):
    (tmp_path / "sub" / "deep").mkdir(parents=True)
    (tmp_path / "a.jpg").write_bytes(b"a")
    (tmp_path / "sub" / "b.png").write_bytes(b"b")
    (tmp_path / "sub" / "deep" / "c").write_bytes(b"")
    (tmp_path / ".hidden").write_bytes(b"h")
    assert sorted(r.name for r in list_objects(spark, str(tmp_path)).collect()) == [".hidden", "a.jpg"]
    assert sorted((r.name, r.length) for r in list_objects(spark, str(tmp_path), recursive=True).collect()) == [
        (".hidden", 1), ("a.jpg", 1), ("sub/b.png", 1), ("sub/deep/c", 0)]


def test_daily_copy_takes_what_is_new_changed_or_failed_before(spark, tmp_path):
    from lakeframe.sinks.objects import copy_new_objects
    src, dst, ledger = tmp_path / "src", tmp_path / "dst", str(tmp_path / "ledger")
    src.mkdir()

    def day(run, extra=()):
        listing = list_objects(spark, str(src))
        if extra:
            listing = listing.unionByName(spark.createDataFrame(list(extra), listing.schema))
        return sorted((r.name, r.status) for r in copy_new_objects(listing, str(dst), ledger, run).collect())
    (src / "a").write_bytes(b"1")
    (src / ".b").write_bytes(b"22")
    gone = (f"file:{src}/gone", "gone", 3, None)
    assert day("1", [gone]) == [(".b", "ok"), ("a", "ok"), ("gone", "failed")]
    (src / "a").write_bytes(b"333")  # changed
    (src / "gone").write_bytes(b"444")
    assert day("2") == [("a", "ok"), ("gone", "ok")]
    assert day("2") == [("a", "ok"), ("gone", "ok")]  # that run has been made
    assert day("3") == [] and (dst / "a").read_bytes() == b"333"


def test_sequences_are_found_through_their_index(spark, tmp_path):
    from lakeframe.operators.frames import index_sequences, read_sequences, write_ordered_frames
    path = str(tmp_path / "seq a%20")
    frames = spark.range(4000).selectExpr("concat('m', lpad(id div 100, 3, '0')) media_name", "cast(id % 100 as int) frame_id", "cast(cast(id as string) as binary) payload")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files, as large tables have
    try:
        write_ordered_frames(frames, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    index_sequences(spark, path)
    wanted = spark.createDataFrame([("m007",), ("m007",), (None,), ("none",)], "media_name string")
    got = read_sequences(wanted, path)
    assert sorted(r.frame_id for r in got.collect()) == list(range(100)) and set(got.columns) == set(frames.columns)
    assert len(got.inputFiles()) < len(spark.read.parquet(path).inputFiles())
    assert read_sequences(wanted.where("media_name = 'none'"), path).count() == 0
