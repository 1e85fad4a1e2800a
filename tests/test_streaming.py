import random

import pytest

from lakeframe.operators.frames import assemble_batch
from lakeframe.streaming.landing import append_stream, await_all
from lakeframe.streaming.reassembly import assemble_stream

from .test_frames import FRAME_SCHEMA, _video


def _run(spark, tmp_path, batches, mode):
    src = str(tmp_path / "src")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, FRAME_SCHEMA).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(FRAME_SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    await_all([append_stream(assemble_stream(stream, mode), out, ckpt)])
    return {r.media_name: r for r in spark.read.parquet(out).collect()}


def _plain(row):
    return {k: v for k, v in row.asDict().items() if not k.startswith("published_")}


def _split(rows, n, seed):
    rows = list(rows)
    random.Random(seed).shuffle(rows)
    return [rows[i::n] for i in range(n)]


def test_complete_mode_is_permutation_invariant_and_equals_batch(spark, tmp_path):
    a, b, c = _video("a.mp4", 9), _video("b.mp4", 4, fps=30), _video("c.mp4", 1)
    rows = a + b + c + [a[0], a[8], b[3]]  # redelivery, including last frames
    got = _run(spark, tmp_path, _split(rows, 3, seed=7), "complete")
    batch = {r.media_name: r for r in assemble_batch(spark.createDataFrame(rows, FRAME_SCHEMA)).collect()}
    assert set(got) == {"a.mp4", "b.mp4", "c.mp4"}
    for k in got:
        assert _plain(got[k]) == batch[k].asDict()


def test_complete_mode_waits_for_missing_frame(spark, tmp_path):
    a = _video("a.mp4", 5)
    first = [r for r in a if r[1] != 2]
    got = _run(spark, tmp_path, [first, [a[2]]], "complete")
    assert got["a.mp4"].n_frames == 5


def test_incomplete_media_is_not_emitted(spark, tmp_path):
    a = _video("a.mp4", 5)
    got = _run(spark, tmp_path, [[r for r in a if r[1] != 2]], "complete")
    assert got == {}


def test_on_last_in_order_equals_complete(spark, tmp_path):
    a = _video("a.mp4", 6)
    got = _run(spark, tmp_path, [a[:3], a[3:]], "on_last")
    assert got["a.mp4"].n_frames == 6 and got["a.mp4"].last_frame_id == 5


def test_on_last_emits_early_when_last_frame_overtakes(spark, tmp_path):
    a = _video("a.mp4", 4)
    # last frame arrives first (earlier offset) -> the reference emits a truncated video
    reordered = [(r[0], r[1], r[2], r[3], r[4], r[5], r[6], 0, 10 if r[1] != 3 else 0) for r in a]
    got = _run(spark, tmp_path, [reordered], "on_last")
    assert got["a.mp4"].n_frames == 1


def test_a_sink_that_fails_is_repeated_alone(spark, tmp_path):
    from lakeframe.sinks.objects import read_objects, write_objects
    from lakeframe.streaming.landing import batch_table, fan_out_batches

    schema = "media_name string, image_data binary, n int"
    src, table, objs = (str(tmp_path / n) for n in ("src", "table", "objs"))
    rows = [(f"m{i}.jpg", f"payload-{i}".encode(), i) for i in range(30)]
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(src)
    calls, fails = [], [True]

    def to_table(batch, folder):
        calls.append(("table", folder))
        batch_table(table)(batch.select("media_name", "n"), folder)

    def to_objects(batch, folder):
        calls.append(("objects", folder))
        if len([c for c in calls if c[0] == "objects"]) == 2 and fails:
            raise OSError("not there")
        write_objects(batch, objs, "media_name", "image_data")

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        await_all([fan_out_batches(stream, str(tmp_path / "ckpt"), {"table": to_table, "objects": to_objects}, str(tmp_path / "ledger"))])
    with pytest.raises(RuntimeError, match="not there"):
        run()
    fails.clear()
    run()
    assert spark.read.parquet(table).count() == 30
    assert {r.name: bytes(r.content) for r in read_objects(spark, objs).collect()} == {n: p for n, p, _ in rows}
    assert len([c for c in calls if c[0] == "table"]) == 3 and len([c for c in calls if c[0] == "objects"]) == 4


def test_tws_engine_matches_group_state(spark, tmp_path):
    from lakeframe.streaming import reassembly

    a, b = _video("a.mp4", 6), _video("b.mp4", 3)
    rows = a + b + [a[1]]
    batches = _split(rows, 2, seed=11)
    got = {}
    for engine in ("group_state", "tws"):
        src = str(tmp_path / engine / "src")
        for part in batches:
            spark.createDataFrame(part, FRAME_SCHEMA).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(FRAME_SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
        out = str(tmp_path / engine / "out")
        await_all([append_stream(reassembly.assemble_stream(stream, "complete", engine), out, str(tmp_path / engine / "ck"))])
        got[engine] = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert got["group_state"] == got["tws"] and len(got["tws"]) == 2


def test_ttl_evicts_idle_incomplete_media(spark, tmp_path):
    import json
    import time

    from lakeframe.streaming import reassembly

    a = _video("a.mp4", 3)
    src, out, ck = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "ck")

    def drop(rows):
        spark.createDataFrame(rows, FRAME_SCHEMA).coalesce(1).write.mode("append").parquet(src)

    def progress(q):
        return [json.loads(p.json) if hasattr(p, "json") else p for p in q.recentProgress]

    def wait_for(cond, limit=120):
        end = time.time() + limit
        while time.time() < end:
            if cond():
                return True
            time.sleep(0.3)
        return False

    def state_rows(q):
        last = progress(q)
        return sum(o["numRowsTotal"] for o in last[-1]["stateOperators"]) if last else None

    drop([a[0], a[2]])
    stream = spark.readStream.schema(FRAME_SCHEMA).parquet(src)
    q = append_stream(reassembly.assemble_stream(stream, "complete", ttl_ms=800), out, ck, trigger="300 milliseconds")
    try:
        assert wait_for(lambda: any(p["numInputRows"] > 0 for p in progress(q)))
        assert state_rows(q) == 1  # a.mp4 is waiting for frame 1
        assert wait_for(lambda: state_rows(q) == 0)  # idle past its TTL: evicted by a timeout batch
        drop([a[1]])  # too late: a.mp4 starts over and stays incomplete until it is evicted too
        drop([_video("z.mp4", 1)[0]])
        assert wait_for(lambda: sum(p["numInputRows"] for p in progress(q)) >= 4)
        drop([a[0], a[1], a[2]])  # sent again after the eviction: now it completes
        assert wait_for(lambda: sum(p["numInputRows"] for p in progress(q)) >= 7 and state_rows(q) == 0)
    finally:
        q.stop()
    assert {r.media_name for r in spark.read.parquet(out).collect()} == {"a.mp4", "z.mp4"}





@pytest.mark.parametrize("seed", [1, 2, 3])
def test_complete_mode_permutation_property(spark, tmp_path, seed):
    """Shuffle, duplicate and split frames over micro-batches: the output never changes."""
    rng = random.Random(seed)
    videos = [_video(f"m{i}.mp4", rng.randint(1, 12), fps=20 + i) for i in range(5)]
    rows = [r for v in videos for r in v]
    rows += rng.sample(rows, k=len(rows) // 3)  # redelivered copies
    # give every copy its own arrival position
    rows = [(r[0], r[1], r[2], r[3], r[4], r[5], r[6], rng.randint(0, 3), i) for i, r in enumerate(rows)]
    got = _run(spark, tmp_path, _split(rows, rng.randint(2, 4), seed), "complete")
    want = {r.media_name: r.asDict() for r in assemble_batch(spark.createDataFrame(rows, FRAME_SCHEMA)).collect()}
    assert {k: _plain(v) for k, v in got.items()} == want
    assert set(want) == {f"m{i}.mp4" for i in range(5)}


OBJECTS = "media_name string, image_data binary, timestamp long, partition int, offset long, original_width int"


def _objects(spark, tmp_path, batches, ckpt="ck", **kw):
    from lakeframe.sinks.objects import read_objects
    from lakeframe.streaming.landing import object_stream

    src, objs = str(tmp_path / "src"), str(tmp_path / "objs")
    for part in batches:
        spark.createDataFrame(part, OBJECTS).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(OBJECTS).option("maxFilesPerTrigger", 1).parquet(src)
    q = object_stream(stream, objs, str(tmp_path / ckpt), metadata=("original_width",), sidecar=str(tmp_path / "side"), **kw)
    await_all([q], 300)
    return {r.name: bytes(r.content) for r in read_objects(spark, objs).collect()}, q


def test_object_stream_replay_is_idempotent(spark, tmp_path):
    import os

    rows = [(f"m{i % 7}.jpg", f"v{i}".encode(), i, 0, i, i) for i in range(21)]  # 3 writes per name
    first, _ = _objects(spark, tmp_path, [rows[:10], rows[10:]])
    ck = str(tmp_path / "ck")
    commits = sorted(int(f) for f in os.listdir(os.path.join(ck, "commits")) if f.isdigit())
    for f in (str(commits[-1]), f".{commits[-1]}.crc"):  # as if the run died before committing
        if os.path.exists(os.path.join(ck, "commits", f)):
            os.remove(os.path.join(ck, "commits", f))
    again, _ = _objects(spark, tmp_path, [])  # the last batch is replayed
    assert again == first == {f"m{k}.jpg": f"v{14 + k}".encode() for k in range(7)}
    side_rows = spark.read.parquet(str(tmp_path / "side"))
    assert side_rows.count() == side_rows.select("name", "batch_id").distinct().count()
    assert max(r.batch_id for r in side_rows.collect()) == commits[-1]


def test_an_older_record_in_a_later_batch_replaces_nothing(spark, tmp_path):
    got, _ = _objects(spark, tmp_path, [[("a", b"new", 9, 0, 9, 1)], [("a", b"old", 3, 1, 50, 1), ("b", b"b", 1, 0, 0, 1)], [("a", b"newest", 10, 0, 10, 1)],
                                        [("a", b"late", 10, 0, 4, 1)]])
    assert got == {"a": b"newest", "b": b"b"}


def test_sidecar_of_a_new_checkpoint_keeps_the_old_one(spark, tmp_path):
    _objects(spark, tmp_path, [[("a", b"1", 1, 0, 1, 11)]])
    side = str(tmp_path / "side")
    assert {r.name for r in spark.read.parquet(side).collect()} == {"a"}
    _objects(spark, tmp_path, [[("b", b"2", 2, 0, 2, 12)]], ckpt="ck2")
    rows = spark.read.parquet(side).collect()
    assert {r.name for r in rows} == {"a", "b"} and len({r.run_id for r in rows}) == 2


def test_records_that_are_no_objects_are_rejected_with_a_reason(spark, tmp_path):
    rows = [("a", b"1", 1, 0, 1, 1), (None, b"2", 2, 0, 2, 1), ("c", None, 3, 0, 3, 1), ("", b"4", 4, 0, 4, 1)]
    got, _ = _objects(spark, tmp_path, [rows], rejected=str(tmp_path / "rejects"))
    assert got == {"a": b"1"}
    rejects = spark.read.parquet(str(tmp_path / "rejects")).collect()
    assert sorted((r.offset, r.reason) for r in rejects) == [(2, "missing_name"), (3, "null_payload"), (4, "missing_name")]


def test_without_a_rejected_table_such_a_record_fails_the_query(spark, tmp_path):
    with pytest.raises(RuntimeError, match="needs a name and content"):
        _objects(spark, tmp_path, [[("a", None, 1, 0, 1, 1)]])


def test_a_batch_is_read_from_its_source_once(spark, tmp_path):
    rows = [(f"m{i}.jpg", b"x", i, 0, i, i) for i in range(40)]
    _, q = _objects(spark, tmp_path, [rows])
    assert [p["numInputRows"] for p in map(_progress, q.recentProgress) if p["numInputRows"]] == [40]


def _progress(p):
    import json

    return json.loads(p.json) if hasattr(p, "json") else p


def test_replay_is_cut_into_micro_batches_by_bytes_in_the_order_of_the_topic(spark, tmp_path):
    from pyspark.sql import functions as F

    from lakeframe.functions.headers import build_headers
    from lakeframe.sources.envelopes import publish_in_order, read_envelopes, to_envelopes

    df = spark.range(0, 4000, 1, 3)
    env = to_envelopes(df, topic="t", seq=F.col("id"), value=F.encode(F.repeat(F.md5(F.col("id").cast("string")), 30), "UTF-8"),
                       headers=build_headers([("type", F.lit("image"))]))
    topic, seen = str(tmp_path / "topic"), []
    assert list(publish_in_order(env.orderBy(F.rand(1)), topic, 5)) == [0, 1, 2, 3, 4]
    assert spark.read.parquet(topic).count() == 4000
    stream = read_envelopes(spark, path=topic, bytes_per_trigger=1)  # at least one file each

    def note(batch, _):
        seen.append(batch.agg(F.min("offset"), F.max("offset"), F.count(F.lit(1))).first())
    q = stream.select("partition", "offset").writeStream.foreachBatch(note).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    await_all([q])
    assert len(seen) >= 5 and sum(r[2] for r in seen) == 4000
    assert [min(r[0] for r in seen[i:]) for i in range(len(seen))] == sorted(min(r[0] for r in seen[i:]) for i in range(len(seen)))


def test_start_of_a_replay_is_applied_or_refused(spark, tmp_path):
    from lakeframe.functions.headers import build_headers
    from lakeframe.sources.envelopes import publish, read_envelopes, to_envelopes
    from pyspark.sql import functions as F

    def env(lo, hi):
        return to_envelopes(spark.range(lo, hi), topic="t", seq=F.col("id"), value=F.encode(F.lit("v"), "UTF-8"), headers=build_headers([("type", F.lit("x"))]))
    topic = str(tmp_path / "topic")
    publish(env(0, 40), topic)
    late = read_envelopes(spark, path=topic, starting="latest")
    publish(env(40, 60), topic)
    for name, stream, want in (("late", late, 20), ("all", read_envelopes(spark, path=topic), 60)):
        await_all([append_stream(stream.select("offset"), str(tmp_path / name), str(tmp_path / f"ck-{name}"))])
        assert spark.read.parquet(str(tmp_path / name)).count() == want
    with pytest.raises(ValueError):
        read_envelopes(spark, path=topic, starting="yesterday")


# --- several queries --------------------------------------------------------------------

def _never_ending(spark, tmp_path, name):
    stream = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return append_stream(stream, str(tmp_path / name), str(tmp_path / f"ck-{name}"), trigger="1 second", name=name)


def test_a_failure_surfaces_at_once_and_stops_the_others(spark, tmp_path):
    import time

    from pyspark.sql import functions as F

    healthy = _never_ending(spark, tmp_path, "healthy")
    src = str(tmp_path / "src")
    spark.range(3).write.parquet(src)
    broken = append_stream(spark.readStream.schema("id long").parquet(src).select(F.raise_error(F.lit("broken")).alias("x")),
                           str(tmp_path / "broken"), str(tmp_path / "ck-broken"), name="broken")
    began = time.time()
    with pytest.raises(RuntimeError, match="broken"):
        await_all([healthy, broken])  # the failing one is not the first
    assert time.time() - began < 30 and not healthy.isActive


def test_a_timeout_names_and_stops_what_still_runs(spark, tmp_path):
    q = _never_ending(spark, tmp_path, "endless")
    with pytest.raises(TimeoutError, match="endless"):
        await_all([q], timeout_s=2)
    assert not q.isActive


# --- reassembly: state and publications -------------------------------------------------

STAMPED = FRAME_SCHEMA + ", timestamp timestamp"


def _stamped(rows, second):
    import datetime

    return [(*r, datetime.datetime(2024, 1, 1, 0, 0, second)) for r in rows]


def _run_stamped(spark, tmp_path, batches, mode="complete", engine="group_state"):
    src = str(tmp_path / "src")
    for rows in batches:
        spark.createDataFrame(rows, STAMPED).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(STAMPED).option("maxFilesPerTrigger", 1).parquet(src)
    q = append_stream(assemble_stream(stream, mode, engine), str(tmp_path / "out"), str(tmp_path / "ck"))
    await_all([q])
    states = [sum(o["numRowsTotal"] for o in _progress(p)["stateOperators"]) for p in q.recentProgress if _progress(p)["numInputRows"]]
    return spark.read.parquet(str(tmp_path / "out")).collect(), states, spark.read.schema(STAMPED).parquet(src)


@pytest.mark.parametrize("mode", ["complete", "on_last"])
def test_a_name_published_twice_is_emitted_twice(spark, tmp_path, mode):
    from lakeframe.streaming.reassembly import published_frames

    old, new = _video("a.mp4", 5), [(*r[:6], f"new:{r[1]}".encode(), 0, 100 + r[1]) for r in _video("a.mp4", 7)]
    batches = [_stamped(old[:3], 1), _stamped(old[3:], 1), _stamped(new[:4], 9), _stamped(new[4:], 9)]
    got, states, frames = _run_stamped(spark, tmp_path, batches, mode)
    assert sorted(r.n_frames for r in got) == [5, 7]
    # complete: the time spans of what was emitted stay, to tell copies
    assert states == ([1, 1, 1, 1] if mode == "complete" else [1, 0, 1, 0])
    rows = published_frames(frames, spark.read.parquet(str(tmp_path / "out"))).collect()
    assert sorted((r.publication, r.pos, bytes(r.payload)) for r in rows) == sorted(
        [(1, r[1], r[6]) for r in old] + [(2, r[1], r[6]) for r in new])


def test_two_publications_inside_one_micro_batch(spark, tmp_path):
    old, new = _video("a.mp4", 5), [(*r[:7], 0, 100 + r[1]) for r in _video("a.mp4", 5)]
    got, states, _ = _run_stamped(spark, tmp_path, [_stamped(old[:2], 1), _stamped(old[2:], 1) + _stamped(new[:4], 9), _stamped(new[4:], 9)])
    assert [r.n_frames for r in got] == [5, 5] and states[-1] == 1


def test_copies_in_the_completing_batch_start_nothing(spark, tmp_path):
    a = _video("a.mp4", 4)
    copies = [(*r[:7], 1, 50 + r[1]) for r in a]
    got, states, _ = _run_stamped(spark, tmp_path, [_stamped(a[:3], 1), _stamped(a[3:] + copies, 1)])
    assert len(got) == 1 and states[-1] == 1


@pytest.mark.parametrize("engine", ["group_state", "tws"])
def test_copies_after_completion_start_nothing_and_stay_out_of_the_next_publication(spark, tmp_path, engine):
    from lakeframe.streaming.reassembly import published_frames

    def later(rows):
        return [(*r[:7], 1, 500 + r[8]) for r in rows]
    one, a = _video("one.mp4", 1), _video("a.mp4", 4)
    new = [(*r[:6], f"new:{r[1]}".encode(), 0, 100 + r[1]) for r in _video("a.mp4", 5)]
    batches = [_stamped(one + a, 1), _stamped(later(one + a[:2]), 1), _stamped(later(a), 1) + _stamped(new[1:3], 9),
               _stamped(later(a[:1]), 1), _stamped(new[:1] + new[3:], 9), _stamped(later(new), 9)]
    got, states, frames = _run_stamped(spark, tmp_path, batches, engine=engine)
    once, _, _ = _run_stamped(spark, tmp_path / "once", [_stamped(one + a, 1), _stamped(new, 9)])
    key = ["media_name", "n_frames", "digest", "published_until"]
    assert sorted([r[k] for k in key] for r in got) == sorted([r[k] for k in key] for r in once)
    assert sorted((r.media_name, r.n_frames) for r in got) == [("a.mp4", 4), ("a.mp4", 5), ("one.mp4", 1)]
    assert states[0] == states[-1] == 2  # the time spans of each media
    rows = published_frames(frames, spark.read.parquet(str(tmp_path / "out"))).where("media_name = 'a.mp4'").collect()
    assert sorted((r.publication, r.pos, bytes(r.payload)) for r in rows) == sorted(
        [(1, r[1], r[6]) for r in a] + [(2, r[1], r[6]) for r in new])


def test_publications_that_overlap_in_arrival_are_both_emitted(spark, tmp_path):
    """Publication 1 lacks a frame while publication 2 begins; the younger one completes first."""
    old, new = _video("a.mp4", 3), [(*r[:6], f"new:{r[1]}".encode(), 0, 100 + r[1]) for r in _video("a.mp4", 3)]
    batches = [_stamped(old[:2], 1), _stamped(new[:2], 41), _stamped(new[2:], 41), _stamped(old[2:], 1)]
    got, _, _ = _run_stamped(spark, tmp_path, batches)
    want, _, _ = _run_stamped(spark, tmp_path / "apart", [_stamped(old, 1), _stamped(new, 41)])
    key = ["n_frames", "digest", "published_since", "published_until"]
    assert len(got) == 2 and sorted([r[k] for k in key] for r in got) == sorted([r[k] for k in key] for r in want)


def _publications(rng, many):
    """Publications of one name, each frame with its own producer time, and redelivered copies."""
    at, rows, sizes = 1_000_000_000, [], []
    for _ in range(many):
        n = rng.randint(1, 9)
        sizes.append(n)
        for i in range(n):
            rows.append({"frame_id": i, "last_frame": "yes" if i == n - 1 else "no", "fps": 25 + len(sizes), "height": 4, "width": 6, "part": rng.getrandbits(59), "time": at})
            at += rng.choice([0, 1000, 900_000])
        at += 6_000_000  # further than APART_MS
    return rows, sizes


def test_any_arrival_order_gives_the_same_publications():
    """The folds alone: overlapping publications in random batches, against one batch in order."""
    import pandas as pd

    from lakeframe.streaming import reassembly

    for seed in range(150):
        rng = random.Random(seed)
        rows, sizes = _publications(rng, rng.randint(1, 4))
        sent = rows + rng.sample(rows, len(rows) // 2)
        rng.shuffle(sent)
        sent = [{**r, "partition": rng.randint(0, 3), "offset": i} for i, r in enumerate(sent)]
        state, out, at = None, [], 0
        while at < len(sent):
            step = rng.randint(1, 6)
            state, found = reassembly.fold_bucket(("a", 0), state, pd.DataFrame(sent[at:at + step]))
            assert state[2] * reassembly.RUN.itemsize >= len(state[0])
            out, at = out + found, at + step
        media = sorted((r for r in out if r[0] == "assembled"), key=lambda r: r[8])
        assert [r[2] for r in media] == sizes and [r[4] for r in media] == [26 + i for i in range(len(sizes))]
        assert sum(int(r[7]) for r in media) == sum(r["part"] for r in rows)
        assert sum(r[2] for r in out if r[0] == "copies") == len(sent) - len(rows) and state[2] == 0


def test_state_of_a_short_media_is_small():
    import pandas as pd

    from lakeframe.streaming import reassembly

    rows = [{"frame_id": i, "last_frame": "no", "fps": 25, "height": 4, "width": 6, "part": 7, "time": 1000 + i, "partition": 0, "offset": i} for i in range(2)]
    state, _ = reassembly.fold_bucket(("a", 0), None, pd.DataFrame(rows))
    assert len(state[0]) + len(state[1]) < 100
    state, out = reassembly.fold_bucket(("a", 0), state, pd.DataFrame([{**rows[0], "frame_id": 2, "last_frame": "yes", "time": 1002}]))
    assert out[0][0] == "assembled" and len(state[0]) == 0 and len(state[1]) == 16


def test_many_runs_find_their_copies():
    import numpy as np

    from lakeframe.streaming import reassembly

    rng = random.Random(2)
    runs = []
    for k in range(300):
        low = rng.randrange(1000)
        runs.append((low, low + rng.choice([0, 1, 5, 400]), 100 * k, 100 * k + rng.randrange(90)))
    table = np.zeros(len(runs), reassembly.RUN)
    table["low"], table["high"], table["since"], table["until"] = np.array(runs).T
    ids, time = np.array([rng.randrange(1500) for _ in range(3000)]), np.array([rng.randrange(31_000) for _ in range(3000)])
    want = [any(r[0] <= i <= r[1] and r[2] <= t <= r[3] for r in runs) for i, t in zip(ids, time)]
    assert reassembly._seen(table, ids, time).tolist() == want


def test_evicted_frames_land_with_a_reason_and_none_is_lost(spark, tmp_path):
    import os
    import time

    from lakeframe.streaming.reassembly import OUTCOME, reassemble_stream

    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    a, b, long = _video("a.mp4", 5), _video("b.mp4", 2), _video("long.mp4", 65_540)

    def drop(rows):
        spark.createDataFrame(rows, STAMPED).coalesce(1).write.mode("append").parquet(src)
    # a: frame 2 is missing; b: complete, with a copy; long: its first bucket is full, its second one is not
    drop(_stamped(a[:2] + a[3:] + b + b[:1] + long[:-2], 1))
    stream = spark.readStream.schema(STAMPED).parquet(src)
    q = append_stream(reassemble_stream(stream, ttl_ms=1500), out, str(tmp_path / "ck"), trigger="500 milliseconds")

    def landed():
        return [(r.outcome, r.media_name, r.n_frames, r.reason) for r in spark.read.schema(OUTCOME).parquet(out).collect()] if os.path.exists(out) else []
    try:
        end = time.time() + 120
        while time.time() < end and sum(r[2] for r in landed()) < 4 + 3 + 65_538:
            time.sleep(1)
    finally:
        q.stop()
    got = landed()
    assert sum(r[2] for r in got) == 4 + 3 + 65_538
    assert sorted(r[:3] for r in got) == [("assembled", "b.mp4", 2), ("copies", "b.mp4", 1), ("evicted", "a.mp4", 2), ("evicted", "a.mp4", 2),
                                          ("evicted", "long.mp4", 2), ("evicted", "long.mp4", 65_536)]
    assert all("arrived without the others" in r[3] for r in got if r[0] == "evicted")


def test_eviction_joins_what_only_a_stall_has_parted():
    import pandas as pd

    from lakeframe.streaming import reassembly

    rows = [{"frame_id": i, "last_frame": "yes" if i == 3 else "no", "fps": 25, "height": 4, "width": 6, "part": 7, "time": t, "partition": 0, "offset": i}
            for i, t in enumerate([0, 1, 60_000_000, 60_000_001])]
    state, out = reassembly.fold_bucket(("a", 0), None, pd.DataFrame(rows))
    assert not out and state[2] == 4
    state, out = reassembly.fold_bucket(("a", 0), state, None)
    assert state is None and [r[:3] for r in out] == [("assembled", "a", 4)]


@pytest.mark.parametrize("engine", ["group_state", "tws"])
def test_a_long_media_is_kept_in_several_states(spark, tmp_path, monkeypatch, engine):
    from lakeframe.streaming import reassembly

    rows = _video("long.mp4", 130_000)
    halves = [_stamped(rows[::2], 1), _stamped(rows[1::2], 1)]
    got, states, _ = _run_stamped(spark, tmp_path, halves, engine=engine)
    assert [(r.n_frames, r.last_frame_id) for r in got] == [(130_000, 129_999)]
    assert states[0] == states[-1] == -(-130_000 // reassembly.BUCKET_IDS)


def test_records_that_are_no_frames_fail_the_assembly(spark, tmp_path):
    with pytest.raises(RuntimeError, match="not a frame"):
        _run_stamped(spark, tmp_path, [_stamped([(None, 0, "no", 25, 4, 6, b"x", 0, 0)], 1)])


def test_state_store_setting_of_the_caller_is_left_alone(spark, tmp_path):
    from lakeframe.session import ROCKSDB_PROVIDER, rocksdb_state

    s, name = spark.newSession(), "spark.sql.streaming.stateStore.providerClass"
    before = s.conf.get(name)
    with rocksdb_state(s):
        assert s.conf.get(name) == ROCKSDB_PROVIDER
    assert s.conf.get(name) == before


def test_delivery_records_come_from_what_was_stored(spark, tmp_path):
    from lakeframe.schemas import ENVELOPE
    from lakeframe.sources.envelopes import delivery_records, publish, publish_observed, split_publishable
    rows = [(None, b"v", "t", 0, 5, None, 0, []), (None, None, "t", 1, 6, None, 0, []), (None, b"v", "t", None, None, None, 0, []), (None, b"w", "t", 1, 9, None, 0, [])]
    env, topic = spark.createDataFrame(rows, ENVELOPE), str(tmp_path / "topic")
    publish(split_publishable(env)[0].where("offset < 9"), topic)  # one record is lost on its way
    got = {(r.partition, r.offset): r.status for r in delivery_records(env, topic).collect()}
    assert got == {(0, 5): "delivered", (1, 6): "failed: no value", (None, None): "failed: no position", (1, 9): "failed: not stored"}
    seen = publish_observed(split_publishable(env)[0], str(tmp_path / "other"), "t", 2).collect()
    assert sorted(tuple(r) for r in seen) == [("t", 0, 1, 5, 5), ("t", 1, 1, 9, 9)]
    for bad in (env.where("partition IS NULL"), env.where("partition = 1")):
        with pytest.raises(Exception, match="no position in the topic"):
            publish_observed(bad, str(tmp_path / "bad"), "t", 1)


def test_delivery_records_broadcast_no_positions(spark, tmp_path):
    from lakeframe.schemas import ENVELOPE
    from lakeframe.sources.envelopes import delivery_records, publish
    env, topic = spark.createDataFrame([(None, b"v", "t", i % 2, i, None, 0, []) for i in range(20)], ENVELOPE), str(tmp_path / "topic")
    publish(env.where("offset < 15"), topic)
    publish(env.where("offset = 3"), topic)  # a record stored twice is one record
    records = delivery_records(env, topic)
    assert sorted((r.offset, r.status) for r in records.collect()) == [(i, "delivered" if i < 15 else "failed: not stored") for i in range(20)]
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("mode", ["complete", "on_last"])
def test_shelves_hold_many_media_and_match_the_other_engines(spark, tmp_path, monkeypatch, mode):
    from lakeframe.streaming import reassembly

    monkeypatch.setattr(reassembly, "SHELVES", 3)
    media = [_video(f"v{i}.mp4", 1 + i % 7) for i in range(40)]
    media[5] = media[5][:-1]  # never complete
    first = [r for i, m in enumerate(media) for r in _stamped(m[:len(m) // 2] if i % 2 else m, i)]
    second = [r for i, m in enumerate(media) for r in _stamped(m[len(m) // 2:] if i % 2 else m[:1], i)]  # even ones: a copy
    got = {}
    for engine in (None, "group_state"):
        home = tmp_path / str(engine)
        rows, states, _ = _run_stamped(spark, home, [first, second], mode, engine)
        got[engine] = sorted(map(tuple, rows), key=str), states
        if mode == "complete":
            got[engine] += (sorted(map(tuple, reassembly.pending_frames(spark, str(home / "ck")).collect())),)
    assert got[None] == got["group_state"]
    if mode == "complete":
        assert len(got[None][0]) == 39 and got[None][2] == [("v5.mp4", 5)]
    shelves = spark.read.format("statestore").option("stateVarName", "state").load(str(tmp_path / "None" / "ck"))
    assert shelves.select("key").distinct().count() <= 3 and "user_map_key" in shelves.columns


def test_shelves_join_the_buckets_of_a_long_media(spark, tmp_path):
    from lakeframe.streaming import reassembly

    rows, short = _video("long.mp4", 130_000), _video("short.mp4", 3)
    got, states, _ = _run_stamped(spark, tmp_path, [_stamped(rows[::2] + short, 1), _stamped(rows[1::2] + short[:1], 1)], engine="shelves")
    assert sorted((r.media_name, r.n_frames) for r in got) == [("long.mp4", 130_000), ("short.mp4", 3)]
    assert states[-1] == -(-130_000 // reassembly.BUCKET_IDS) + 1
    with pytest.raises(ValueError, match="shelves"):
        reassembly.reassemble_stream(spark.readStream.schema(STAMPED).parquet(str(tmp_path / "src")), engine="shelves", ttl_ms=5)
