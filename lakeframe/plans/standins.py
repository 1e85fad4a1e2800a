"""How the driver's tables stand in for media streams (FIXTURES.md section 2).

Each function is a narrow projection of one table into message envelopes, so the
envelope stream grows with the table and every derived value can be recomputed in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeframe.functions.headers import TYPE_IMAGE, build_headers
from lakeframe.session import read_table
from lakeframe.sources.envelopes import to_envelopes

# Fixed value: 2024-01-01T00:00:00Z, the epoch second documents are "published" from.
DOCUMENT_EPOCH = 1704067200


def document_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> image envelopes: payload = UTF-8 text, height = n_chars, width = bytes."""
    docs = read_table(spark, sf_dir, "documents")
    return to_envelopes(
        docs,
        topic="documents",
        seq=F.col("doc_id"),
        value=F.encode("text", "UTF-8"),
        timestamp=F.timestamp_seconds(F.col("doc_id") + F.lit(DOCUMENT_EPOCH)),
        headers=build_headers([
            ("type", F.lit(TYPE_IMAGE)),
            ("media_name", F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".jpg"))),
            ("original_height", F.col("n_chars")),
            ("original_width", F.octet_length("text")),
        ]),
    )


def event_envelopes(spark: SparkSession, sf_dir: str, headers=None) -> DataFrame:
    """events -> envelopes keyed by user_id, value = 'event_type:props', time = ts."""
    ev = read_table(spark, sf_dir, "events")
    if headers is None:
        headers = build_headers([("type", F.col("event_type"))])
    return to_envelopes(
        ev,
        topic="events",
        seq=F.col("event_id"),
        key=F.encode(F.col("user_id").cast("string"), "UTF-8"),
        value=F.encode(F.concat_ws(":", "event_type", "props"), "UTF-8"),
        timestamp=F.col("ts"),
        headers=headers,
    )


def conversation_media_name(conv_id) -> F.Column:
    return F.concat(F.lit("conv-"), conv_id.cast("string"), F.lit(".mp4"))


def frame_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations -> frame rows: media = conv, frame_id = turn, payload = UTF-8 text.

    fps, height and width are per-media constants derived from the conversation id.
    """
    conv = read_table(spark, sf_dir, "conversations")
    return conv.select(
        conversation_media_name(F.col("conv_id")).alias("media_name"),
        F.col("conv_id"),
        F.col("turn").cast("int").alias("frame_id"),
        F.col("role"),
        F.encode("text", "UTF-8").alias("payload"),
        (F.pmod(F.col("conv_id"), F.lit(3)) * 5 + 20).cast("int").alias("fps"),
        F.lit(48).alias("height"),
        F.lit(64).alias("width"),
    )


# Fixed value: frame arrival order is a hash permutation; copies are re-published after it.
ARRIVAL_SPACE = 1 << 50


def frame_envelopes(spark: SparkSession, sf_dir: str, *, redeliver_role: str | None = None,
                    min_payload_bytes: int | None = None) -> DataFrame:
    """conversations -> video-frame envelopes in a permuted arrival order.

    Frames are numbered in read order (turn) per media first, as the producer does, so
    ``frame_id``/``last_frame`` headers are right even when frames are later lost.
    ``redeliver_role`` publishes the frames of that role a second time (at-least-once
    redelivery); ``min_payload_bytes`` loses frames with shorter payloads.
    """
    from lakeframe.operators.frames import frame_headers, number_frames

    frames = number_frames(frame_rows(spark, sf_dir), "conv_id", "frame_id")
    copies = F.array(F.lit(0))
    if redeliver_role is not None:
        copies = F.when(F.col("role") == redeliver_role, F.array(F.lit(0), F.lit(1))).otherwise(copies)
    frames = frames.withColumn("__copy", F.explode(copies))
    if min_payload_bytes is not None:
        frames = frames.where(F.octet_length("payload") >= min_payload_bytes)
    arrival = F.pmod(F.xxhash64("conv_id", "frame_id"), F.lit(ARRIVAL_SPACE)) + F.col("__copy") * F.lit(ARRIVAL_SPACE)
    return to_envelopes(
        frames,
        topic="frames",
        seq=arrival,
        value=F.col("payload"),
        timestamp=F.timestamp_seconds(F.lit(DOCUMENT_EPOCH) + F.col("conv_id")),
        headers=frame_headers(F.col("media_name"), F.col("frame_seq"), F.col("is_last"), F.col("fps"),
                              F.col("height"), F.col("width")),
    )


def keyed_frame_envelopes(spark: SparkSession, sf_dir: str, partitions: int = 4) -> DataFrame:
    """conversations -> frame envelopes published with the media as key: all frames of a
    media land in one topic partition in frame order (offset = conv_id * 2^20 + turn)."""
    from lakeframe.operators.frames import frame_headers, number_frames

    frames = number_frames(frame_rows(spark, sf_dir), "conv_id", "frame_id")
    in_order = F.col("conv_id") * F.lit(1 << 20) + F.col("frame_seq")
    return to_envelopes(
        frames,
        topic="frames",
        seq=in_order * F.lit(partitions) + F.pmod(F.col("conv_id"), F.lit(partitions)),
        key=F.encode(F.col("media_name"), "UTF-8"),
        value=F.col("payload"),
        timestamp=F.timestamp_seconds(F.lit(DOCUMENT_EPOCH) + F.col("conv_id")),
        headers=frame_headers(F.col("media_name"), F.col("frame_seq"), F.col("is_last"), F.col("fps"),
                              F.col("height"), F.col("width")),
        partitions=partitions,
    )
