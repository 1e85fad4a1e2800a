"""Streaming queries: envelopes are published to a stored topic, consumed with Structured
Streaming (``availableNow``), landed, and the landed table is returned for checking.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeframe.functions.headers import (
    header_int, header_text, key_value_text, metadata_projection,
)
from lakeframe.operators.frames import latest_per_name, split_frames, write_ordered_frames
from lakeframe.plans.standins import document_envelopes, event_envelopes, frame_envelopes, keyed_frame_envelopes
from lakeframe.session import scratch
from lakeframe.sinks.objects import read_objects
from lakeframe.sources.envelopes import high_water_marks, publish, publish_in_order, read_envelopes, start_position
from lakeframe.streaming.landing import append_stream, await_all, batch_table, fan_out_batches, object_stream
from lakeframe.streaming.reassembly import assemble_stream as assemble_frames
from lakeframe.streaming.reassembly import pending_frames, published_frames, reassemble_stream

# Fixed value: the instant that splits the events into a first and a second drop.
SECOND_DROP_FROM = "2024-01-16 00:00:00"
# Parts in which frame topics are published, each followed by a run of the stream.
DROPS, ORDERED_DROPS = 2, 4
# Fixed value: frames with fewer payload bytes lose their payload in ``frame_outcomes``.
SHORT_PAYLOAD = 100


def _replay(spark: SparkSession, topic: str) -> DataFrame:
    return read_envelopes(spark, path=topic)


def _first_drop():
    ntz = F.col("timestamp").cast("timestamp_ntz")
    return F.coalesce(ntz < F.to_timestamp_ntz(F.lit(SECOND_DROP_FROM)), F.lit(False))


def _kv(stream: DataFrame) -> DataFrame:
    return stream.select("partition", "offset", F.col("key").cast("string").alias("key"),
                         F.col("value").cast("string").alias("value"))


def kv_text_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream -> key/value text -> Parquet with checkpoint."""
    root = scratch(spark, "kv_text_landing")
    publish(event_envelopes(spark, sf_dir), f"{root}/topic")
    stream = _replay(spark, f"{root}/topic")
    q = append_stream(key_value_text(stream), f"{root}/table", f"{root}/checkpoints/table")
    await_all([q])
    return spark.read.parquet(f"{root}/table")


def metadata_stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream -> media metadata -> table with checkpoint (S1r, K1, T2, T3, T6)."""
    root = scratch(spark, "metadata_stream_landing")
    publish(document_envelopes(spark, sf_dir), f"{root}/topic")
    stream = _replay(spark, f"{root}/topic")
    q = append_stream(metadata_projection(stream), f"{root}/table", f"{root}/checkpoints/table")
    await_all([q])
    return spark.read.parquet(f"{root}/table")


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops; the query is stopped after the first and restarted on its checkpoint:
    every record is landed exactly once (T3, T4)."""
    root = scratch(spark, "stream_restart")
    env = event_envelopes(spark, sf_dir)
    topic, table, ckpt = f"{root}/topic", f"{root}/table", f"{root}/checkpoints/table"
    publish(env.where(_first_drop()), topic)
    for drop in (1, 2):
        if drop == 2:
            publish(env.where(~_first_drop()), topic)
        stream = _replay(spark, topic)
        await_all([append_stream(_kv(stream), table, ckpt)])
    return spark.read.parquet(table)


def start_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``startingOffsets=latest``: records already in the topic when the query starts are
    skipped, later ones are read (S3)."""
    root = scratch(spark, "start_latest")
    env = event_envelopes(spark, sf_dir)
    topic = f"{root}/topic"
    publish(env.where(_first_drop()), topic)
    # The snapshot is written, so a restarted query keeps the start position it began with.
    marks_path = f"{root}/marks"
    high_water_marks(spark, topic).write.parquet(marks_path)
    marks = spark.read.parquet(marks_path)
    publish(env.where(~_first_drop()), topic)
    stream = start_position(_replay(spark, topic), marks)
    await_all([append_stream(_kv(stream), f"{root}/table", f"{root}/checkpoints/table")])
    return spark.read.parquet(f"{root}/table")


def _run_topic(spark: SparkSession, root: str, envelopes: DataFrame, drops: int, outputs) -> None:
    """Publishes the envelopes in the topic's order, a part at a time, and after each part runs
    the streams ``outputs(frames)`` (name -> stream) on their checkpoints; records that are no
    frames land as ``rejected``."""
    for _ in publish_in_order(envelopes, f"{root}/topic", drops):
        frames, rejected = split_frames(_replay(spark, f"{root}/topic"))
        sinks = outputs(frames) | {"rejected": rejected}
        await_all([append_stream(df, f"{root}/{name}", f"{root}/checkpoints/{name}") for name, df in sinks.items()])


def _assembled(spark: SparkSession, root: str, envelopes: DataFrame, mode: str, drops: int, land_frames: bool = False) -> DataFrame:
    """The media assembled from the envelopes; with ``land_frames`` the frames land as a table."""
    _run_topic(spark, root, envelopes, drops,
               lambda frames: {"assembled": assemble_frames(frames, mode)} | ({"frames": frames} if land_frames else {}))
    return spark.read.parquet(f"{root}/assembled")


def assemble_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Permuted, partly redelivered frames over several micro-batches -> assembled media
    (T1, K11): same result as the batch assembly."""
    envelopes = frame_envelopes(spark, sf_dir, redeliver_role="user")
    return _assembled(spark, scratch(spark, "assemble_stream"), envelopes, "complete", DROPS).drop("published_since", "published_until")


def frame_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of every published frame, by media: assembled, a copy, rejected (its payload
    was lost) or pending in the state (T1, F3)."""
    root = scratch(spark, "frame_outcomes")
    whole = F.octet_length("value") >= SHORT_PAYLOAD
    envelopes = frame_envelopes(spark, sf_dir, redeliver_role="user").withColumn("value", F.when(whole, F.col("value")))
    _run_topic(spark, root, envelopes, DROPS, lambda frames: {"outcomes": reassemble_stream(frames)})
    count = lambda df, outcome: df.select("media_name", F.lit(outcome).alias("outcome"), F.col("n_frames").alias("n"))
    outcomes = spark.read.parquet(f"{root}/outcomes").select("media_name", "outcome", F.col("n_frames").alias("n"))
    rejected = spark.read.parquet(f"{root}/rejected").withColumn("n_frames", F.lit(1).cast("long"))
    every = outcomes.unionByName(count(rejected, "rejected")).unionByName(count(pending_frames(spark, f"{root}/checkpoints/outcomes"), "pending"))
    kinds = ("assembled", "copies", "rejected", "pending")
    return every.groupBy("media_name").agg(*[F.sum(F.when(F.col("outcome") == k, F.col("n")).otherwise(0)).alias(k) for k in kinds],
                                           F.sum("n").alias("published"))


def assembled_sequences_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The media assembled by the stream: every frame of each emitted media, landed in order and
    read back (T1, K11, A1, O1)."""
    root = scratch(spark, "assembled_sequences_stream")
    envelopes = frame_envelopes(spark, sf_dir, redeliver_role="user")
    media = _assembled(spark, root, envelopes, "complete", DROPS, land_frames=True)
    write_ordered_frames(published_frames(spark.read.parquet(f"{root}/frames"), media), f"{root}/sequences")
    return spark.read.parquet(f"{root}/sequences").select(
        "media_name", F.col("publication").cast("int").alias("publication"), "pos", "frame_id", F.md5("payload").alias("md5"),
        "fps", "height", "width")


def assemble_stream_on_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference consumer's rule (T1 ``on_last``): emit a media when its last frame
    arrives.  With frames keyed by media (one partition, in order), over several micro-batches
    in the topic's order, it equals the complete assembly."""
    root = scratch(spark, "assemble_stream_on_last")
    return _assembled(spark, root, keyed_frame_envelopes(spark, sf_dir), "on_last", ORDERED_DROPS).drop("published_since", "published_until")


def object_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stream, two sinks: image objects written by the executors and the metadata
    table (K3, K10, K13, T5); objects are read back as files (F4, S12)."""
    root = scratch(spark, "object_sink_roundtrip")
    publish(document_envelopes(spark, sf_dir), f"{root}/topic")
    stream = _replay(spark, f"{root}/topic")
    images = stream.where(header_text("type") == F.lit("image")).select(
        header_text("media_name").alias("media_name"), F.col("value").alias("image_data"),
        header_int("original_height").alias("original_height"), header_int("original_width").alias("original_width"),
        "timestamp", "partition", "offset")
    q_objects = object_stream(images, f"{root}/objects", f"{root}/checkpoints/objects",
                              metadata=("media_name", "original_height", "original_width"),
                              sidecar=f"{root}/object_metadata", rejected=f"{root}/object_rejects")
    q_table = append_stream(metadata_projection(stream), f"{root}/table", f"{root}/checkpoints/table")
    await_all([q_objects, q_table])
    objs = read_objects(spark, f"{root}/objects").select(
        "name", F.col("length").cast("int").alias("n_bytes"), F.md5("content").alias("md5"))
    meta = spark.read.parquet(f"{root}/table")
    sidecar = latest_per_name(spark.read.parquet(f"{root}/object_metadata"), "name", ("place",)).select(
        "name", F.col("metadata")["original_width"].cast("int").alias("object_width"))
    return (meta.join(objs, meta["media_name"] == objs["name"]).drop("name")
            .join(sidecar, F.col("media_name") == sidecar["name"], "left")
            .select("media_name", "original_height", "original_width", "n_bytes", "md5", "object_width"))


def fan_out_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stream, two tables of one ledger; the second one fails at first, and after the restart each
    record is in both exactly once (K13, T4)."""
    root = scratch(spark, "fan_out_landing")
    publish(event_envelopes(spark, sf_dir), f"{root}/topic")
    fails = [True]

    def broken_once(batch: DataFrame, folder: str) -> None:
        if fails:
            raise OSError("the second sink is not there yet")
        batch_table(f"{root}/values")(batch.select("partition", "offset", F.col("value").cast("string").alias("value")), folder)

    def run() -> None:
        sinks = {"keys": lambda batch, folder: batch_table(f"{root}/keys")(batch.select("partition", "offset", F.col("key").cast("string").alias("key")), folder),
                 "values": broken_once}
        await_all([fan_out_batches(_replay(spark, f"{root}/topic"), f"{root}/checkpoints/both", sinks, f"{root}/ledger")])

    try:
        run()
    except RuntimeError:
        fails.clear()
        run()
    keys, values = (spark.read.parquet(f"{root}/{t}").select("partition", "offset", c) for t, c in (("keys", "key"), ("values", "value")))
    return keys.join(values, ["partition", "offset"], "full")


QUERIES = {
    "fan_out_landing": fan_out_landing,
    "kv_text_landing": kv_text_landing,
    "metadata_stream_landing": metadata_stream_landing,
    "stream_restart": stream_restart,
    "start_latest": start_latest,
    "assemble_stream": assemble_stream,
    "frame_outcomes": frame_outcomes,
    "assembled_sequences_stream": assembled_sequences_stream,
    "assemble_stream_on_last": assemble_stream_on_last,
    "object_sink_roundtrip": object_sink_roundtrip,
}

_EVENTS_KV = """CAST(event_id % 4 AS INTEGER) AS partition, event_id // 4 AS "offset",
       CAST(user_id AS VARCHAR) AS key, concat_ws(':', event_type, props) AS value"""

ORACLES = {
    "fan_out_landing": f"""
SELECT {_EVENTS_KV} FROM events""",
    "kv_text_landing": """
SELECT CAST(user_id AS VARCHAR) AS key, concat_ws(':', event_type, props) AS value FROM events""",
    "metadata_stream_landing": """
SELECT 'doc-' || CAST(doc_id AS VARCHAR) || '.jpg' AS media_name,
       CAST(n_chars AS INTEGER) AS original_height,
       CAST(strlen(text) AS INTEGER) AS original_width
FROM documents""",
    "stream_restart": f"""
SELECT {_EVENTS_KV} FROM events""",
    "start_latest": f"""
WITH env AS (
  SELECT {_EVENTS_KV}, COALESCE(ts < TIMESTAMP '{SECOND_DROP_FROM}', false) AS first_drop FROM events),
marks AS (SELECT partition AS p, max("offset") AS high_water FROM env WHERE first_drop GROUP BY partition)
SELECT partition, "offset", key, value
FROM env LEFT JOIN marks ON partition = p
WHERE NOT first_drop AND (high_water IS NULL OR "offset" > high_water)""",
    "assemble_stream": """
SELECT 'conv-' || CAST(conv_id AS VARCHAR) || '.mp4' AS media_name,
       count(*) AS n_frames, CAST(max(turn) AS INTEGER) AS last_frame_id,
       CAST((conv_id % 3) * 5 + 20 AS INTEGER) AS fps, 48 AS height, 64 AS width,
       CAST(sum(CAST(('0x' || substr(md5(CAST(turn AS VARCHAR) || ':' || text), 1, 15)) AS BIGINT)) AS VARCHAR) AS digest
FROM conversations GROUP BY conv_id""",
    "frame_outcomes": f"""
WITH f AS (SELECT conv_id, strlen(text) >= {SHORT_PAYLOAD} AS whole, CASE WHEN role = 'user' THEN 1 ELSE 0 END AS again FROM conversations)
SELECT 'conv-' || CAST(conv_id AS VARCHAR) || '.mp4' AS media_name,
       CASE WHEN bool_and(whole) THEN count(*) ELSE 0 END AS assembled,
       CAST(sum(CASE WHEN whole THEN again ELSE 0 END) AS BIGINT) AS copies,
       CAST(sum(CASE WHEN whole THEN 0 ELSE 1 + again END) AS BIGINT) AS rejected,
       CASE WHEN bool_and(whole) THEN 0 ELSE count(*) FILTER (whole) END AS pending,
       CAST(sum(1 + again) AS BIGINT) AS published
FROM f GROUP BY conv_id""",
    "assembled_sequences_stream": """
SELECT 'conv-' || CAST(conv_id AS VARCHAR) || '.mp4' AS media_name, 1 AS publication, CAST(turn AS INTEGER) AS pos,
       CAST(turn AS INTEGER) AS frame_id, md5(text) AS md5, CAST((conv_id % 3) * 5 + 20 AS INTEGER) AS fps, 48 AS height, 64 AS width
FROM conversations""",
    "assemble_stream_on_last": """
SELECT 'conv-' || CAST(conv_id AS VARCHAR) || '.mp4' AS media_name,
       count(*) AS n_frames, CAST(max(turn) AS INTEGER) AS last_frame_id,
       CAST((conv_id % 3) * 5 + 20 AS INTEGER) AS fps, 48 AS height, 64 AS width,
       CAST(sum(CAST(('0x' || substr(md5(CAST(turn AS VARCHAR) || ':' || text), 1, 15)) AS BIGINT)) AS VARCHAR) AS digest
FROM conversations GROUP BY conv_id""",
    "object_sink_roundtrip": """
SELECT 'doc-' || CAST(doc_id AS VARCHAR) || '.jpg' AS media_name,
       CAST(n_chars AS INTEGER) AS original_height,
       CAST(strlen(text) AS INTEGER) AS original_width,
       CAST(strlen(text) AS INTEGER) AS n_bytes,
       md5(text) AS md5,
       CAST(strlen(text) AS INTEGER) AS object_width
FROM documents""",
}
