"""Batch media queries over the driver tables (media landing, headers, routing, frames).

Each query is ``fn(spark, sf_dir) -> DataFrame``; ``ORACLES`` holds the equivalent SQL
over the raw tables for the DuckDB check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeframe.functions.headers import (
    build_headers, header_int, header_text, headers_map, media_columns, metadata_projection, payload_projection,
)
from lakeframe.functions.paths import format_name
from lakeframe.operators.frames import (
    assemble_batch, assembled_frames, explode_frames, index_sequences, latest_per_name, number_frames, read_sequences, split_frames,
    write_ordered_frames,
)
from lakeframe.operators.routing import branch_of, reject_reason, route_by_extension
from lakeframe.plans.standins import conversation_media_name, document_envelopes, event_envelopes, frame_envelopes
from lakeframe.session import read_table, scratch
from lakeframe.sources.envelopes import delivery_records, delivery_report, publish, publish_observed, split_publishable, to_envelopes
from lakeframe.schemas import ENVELOPE


def media_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: envelopes -> media metadata table."""
    return metadata_projection(document_envelopes(spark, sf_dir))


def media_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes -> payload projection, reported as size and md5."""
    p = payload_projection(document_envelopes(spark, sf_dir))
    return p.select("media_name", "original_height", "original_width",
                    F.octet_length("image_data").alias("n_bytes"), F.md5("image_data").alias("md5"))


def _uid(suffix: str):
    return F.concat(F.lit("user-"), F.col("user_id").cast("string"), F.lit(suffix))


# Separators of the compact header text the variant builder splits.
_ENTRY_SEP, _KV_SEP = "\u001e", "\u001f"


def _kv(key: str, value) -> F.Column:
    return F.concat(F.lit(key + _KV_SEP), value.cast("string"))


def _variant_headers():
    """Event headers with the malformed shapes consumers meet: image records, video
    records, duplicated keys (last wins), missing keys and a NULL header array.

    Built as one delimited text per record (``concat_ws`` drops entries whose value is
    NULL, i.e. omitted headers) split into entries: far less generated code than a CASE
    over header arrays, which matters for whole-stage codegen."""
    et = F.col("event_type")
    fps = F.col("value").cast("int")
    uid = F.col("user_id")
    text = (F.when(et == "signup", F.concat_ws(_ENTRY_SEP, _kv("type", F.lit("image")), _kv("media_name", _uid(".jpg")),
                                                _kv("original_height", uid), _kv("original_width", uid * 2)))
            .when(et == "click", F.concat_ws(_ENTRY_SEP, _kv("type", F.lit("video")), _kv("media_name", _uid(".mp4")),
                                              _kv("original_height", F.lit(48)), _kv("original_width", F.lit(64)),
                                              _kv("fps", fps), _kv("frame_id", F.expr("event_id div 4")),
                                              _kv("last_frame", F.lit("no"))))
            .when(et == "view", F.concat_ws(_ENTRY_SEP, _kv("type", F.lit("image")), _kv("type", F.lit("video")),
                                             _kv("media_name", _uid(".mp4")), _kv("frame_id", F.lit("x")),
                                             _kv("frame_id", uid), _kv("last_frame", F.lit("yes"))))
            .when(et == "purchase", F.concat_ws(_ENTRY_SEP, _kv("original_height", uid), _kv("fps", fps))))
    entries = F.filter(F.split(text, _ENTRY_SEP), lambda e: e != F.lit(""))

    def entry(e):
        key = F.substring_index(e, _KV_SEP, 1)
        return F.struct(key.alias("key"), F.encode(F.substring(e, F.length(key) + 2, F.length(e)), "UTF-8").alias("value"))
    return F.transform(entries, entry)


def header_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed media/frame fields with defaults for missing headers."""
    env = event_envelopes(spark, sf_dir, headers=_variant_headers())
    return media_columns(env).select(
        "partition", "offset", F.col("type").alias("media_type"), "media_name", "original_height",
        "fps", "frame_id", "last_frame")


def headers_as_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header arrays with duplicated, missing and NULL entries as a map, last value wins."""
    env = event_envelopes(spark, sf_dir, headers=_variant_headers())
    m = headers_map("headers")
    return env.select(
        "partition", "offset",
        F.when(m.isNull(), F.lit(0)).otherwise(F.size(m)).alias("n_keys"),
        F.make_valid_utf8(m["frame_id"].cast("string")).alias("frame_id"),
        F.make_valid_utf8(m["type"].cast("string")).alias("media_type"),
    )


def _int_text():
    et = F.col("event_type")
    uid = F.col("user_id").cast("string")
    return (F.when(et == "signup", uid).when(et == "click", F.concat(F.lit("x"), uid))
            .when(et == "view", F.concat(uid, F.lit("0000000000"))).when(et == "purchase", F.lit(""))
            .otherwise(F.concat(F.lit("-"), uid)))


def header_int_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integer headers with digits, letters, overflow, empty and negative text."""
    env = event_envelopes(spark, sf_dir, headers=build_headers([("original_height", _int_text())]))
    return env.select("partition", "offset", header_text("original_height").alias("raw"),
                      header_int("original_height").alias("parsed"))


# Name shapes for the extension test, chosen by page_id mod 8.
NAME_SHAPES = [("page-", ".jpg"), ("page-", ".PNG"), ("page-", ".mp4"), ("page-", ".tar.GZ"),
               ("page-", ".txt"), (".page-", ""), ("page-", "."), ("page.", ".MOV")]


def page_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    idx = F.pmod(F.col("page_id"), F.lit(len(NAME_SHAPES))).cast("int") + 1
    prefix = F.element_at(F.array(*[F.lit(p) for p, _ in NAME_SHAPES]), idx)
    suffix = F.element_at(F.array(*[F.lit(s) for _, s in NAME_SHAPES]), idx)
    return pages.select("page_id", F.concat(prefix, F.col("page_id").cast("string"), suffix).alias("name"), "html")


def route_by_extension_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Route names to the image and video paths by extension, with the writer format
    name the extension maps to (F1, X6-X10)."""
    routed = route_by_extension(page_names(spark, sf_dir).drop("html"), "name")
    return routed.withColumn("format", format_name(F.col("ext")))


def split_by_type_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dispatch on the ``type`` header: 'image' or anything else = video (F2)."""
    et = F.col("event_type")
    mtype = (F.when(et.isin("view", "signup"), F.lit("image")).when(et.isin("click", "purchase"), F.lit("video")))
    env = event_envelopes(spark, sf_dir, headers=build_headers([("type", mtype)]))
    typed = media_columns(env)
    return (typed.groupBy(branch_of("type").alias("branch"), F.col("type").alias("media_type"))
            .agg(F.count(F.lit(1)).alias("n")))


# Extension per document language for the validation query.
LANG_EXT = {"en": ".jpg", "fr": ".png", "de": ".tiff", "es": ".jpeg"}


def reject_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Media split into valid and rejected with a reason, counted."""
    docs = read_table(spark, sf_dir, "documents")
    ext = F.coalesce(*[F.when(F.col("lang") == k, F.lit(v)) for k, v in LANG_EXT.items()], F.lit(""))
    env = to_envelopes(docs, topic="documents", seq=F.col("doc_id"), value=F.encode("text", "UTF-8"),
                       headers=build_headers([
                           ("type", F.lit("image")),
                           ("media_name", F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), ext)),
                           ("original_height", F.size(F.split("text", "\n")) - 1),
                           ("original_width", F.octet_length("text")),
                       ]))
    typed = media_columns(env)
    return (typed.groupBy(F.coalesce(reject_reason(), F.lit("ok")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("n")))


def latest_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last write wins per object name (A3)."""
    env = event_envelopes(spark, sf_dir, headers=build_headers([("media_name", _uid(".jpg"))]))
    named = env.select(header_text("media_name").alias("media_name"), "timestamp", "partition", "offset",
                       F.col("value").cast("string").alias("value"))
    return latest_per_name(named).select("media_name", "partition", "offset", "value")


def delivery_report_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish envelopes to a stored topic (K8) and report per partition (K9)."""
    path = scratch(spark, "delivery_report")
    publish(event_envelopes(spark, sf_dir), path)
    return delivery_report(spark.read.schema(ENVELOPE).parquet(path))


def delivery_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The figures of ``delivery_report`` as the write itself has counted them."""
    return publish_observed(event_envelopes(spark, sf_dir), scratch(spark, "delivery_observed"), "events", 4)


def delivery_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of which some lack a value or a position: what can be stored is published, and every
    record is reported by what the topic then holds (K8, K9)."""
    path = scratch(spark, "delivery_outcomes")
    kind = F.pmod("user_id", F.lit(7))
    env = event_envelopes(spark, sf_dir, headers=build_headers([("user", F.col("user_id"))])).withColumn("user_id", F.col("key").cast("string").cast("long"))
    env = env.withColumns({"value": F.when(F.coalesce(kind != 1, F.lit(True)), F.col("value")),
                           "offset": F.when(F.coalesce(kind != 2, F.lit(True)), F.col("offset"))}).drop("user_id")
    publish(split_publishable(env)[0], path)
    return delivery_records(env, path).groupBy("partition", "status").agg(F.count(F.lit(1)).alias("n"))


def frame_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """0-based frame number in read order and the last-frame flag."""
    conv = read_table(spark, sf_dir, "conversations")
    n = number_frames(conv.select("conv_id", "turn"), "conv_id", "turn")
    return n.select("conv_id", "turn", F.col("frame_seq").cast("int").alias("frame_id"),
                    F.when(F.col("is_last"), F.lit("yes")).otherwise(F.lit("no")).alias("last_frame"))


def frame_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frame rows -> one envelope per frame with its headers, read back as text."""
    env = frame_envelopes(spark, sf_dir)
    return env.select(*[header_text(k).alias(k) for k in
                        ("type", "media_name", "original_height", "original_width", "fps", "frame_id", "last_frame")],
                      F.md5("value").alias("md5"))


def _line_videos(spark: SparkSession, sf_dir: str, empty: bool = False) -> DataFrame:
    """Each document is a video whose frames are its lines, at 29.97 fps; with ``empty`` every
    seventh has no frames."""
    docs = read_table(spark, sf_dir, "documents")
    lines = F.split("text", "\\n").cast("array<binary>")  # UTF-8 bytes per line
    if empty:
        lines = F.when(F.pmod("doc_id", F.lit(7)) == 0, F.array().cast("array<binary>")).otherwise(lines)
    return docs.select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".mp4")).alias("media_name"),
        F.lit(29.97).alias("fps"), F.lit(48).alias("height"), F.lit(64).alias("width"), lines.alias("frames"))


def lines_as_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded videos as frame arrays -> one record per frame (R2 array form, W1, W2, X11)."""
    frames, _ = explode_frames(_line_videos(spark, sf_dir))
    return frames.select("media_name", "frame_id", "last_frame", header_text("fps").alias("fps"),
                         F.md5("payload").alias("md5"))


def video_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every video is exploded into frames or rejected with a reason (R2, F3): both are landed as
    tables and counted per outcome, with the number of frames."""
    root = scratch(spark, "video_outcomes")
    frames, rejected = explode_frames(_line_videos(spark, sf_dir, empty=True))
    frames.write.parquet(f"{root}/frames")
    rejected.write.parquet(f"{root}/rejected")
    landed = spark.read.parquet(f"{root}/frames").agg(
        F.lit("landed").alias("outcome"), F.sum(F.when(F.col("frame_id") == 0, 1)).alias("n_videos"), F.count(F.lit(1)).alias("n_frames"))
    refused = spark.read.parquet(f"{root}/rejected").groupBy(F.col("reason").alias("outcome")).agg(
        F.count(F.lit(1)).alias("n_videos"), F.lit(0).cast("long").alias("n_frames"))
    return landed.unionByName(refused)


def record_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with malformed headers: each is landed as a frame or rejected with a reason; both
    are landed as tables, and input = landed + rejected (F3, P4)."""
    root = scratch(spark, "record_outcomes")
    publish(event_envelopes(spark, sf_dir, headers=_variant_headers()), f"{root}/topic")
    frames, rejected = split_frames(spark.read.schema(ENVELOPE).parquet(f"{root}/topic"))
    frames.write.parquet(f"{root}/frames")
    rejected.write.parquet(f"{root}/rejected")
    outcome = spark.read.parquet(f"{root}/frames").select(F.lit("landed").alias("outcome")).unionByName(
        spark.read.parquet(f"{root}/rejected").select(F.col("reason").alias("outcome")))
    return outcome.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def assemble_batch_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reassemble permuted, partly redelivered frames per media (A1, A2, A4, O1)."""
    return assemble_batch(split_frames(frame_envelopes(spark, sf_dir, redeliver_role="user"))[0])


def assemble_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames with short payloads are lost; only complete media are assembled (A2)."""
    return assemble_batch(split_frames(frame_envelopes(spark, sf_dir, min_payload_bytes=40))[0])


def assembled_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The assembled media themselves: every frame of each complete media, landed in order and
    read back (K11, A1, A4, O1)."""
    root = scratch(spark, "assembled_sequences")
    frames, _ = split_frames(frame_envelopes(spark, sf_dir, redeliver_role="user"))
    write_ordered_frames(assembled_frames(frames), f"{root}/sequences")
    return spark.read.parquet(f"{root}/sequences").select(
        "media_name", "pos", "frame_id", F.md5("payload").alias("md5"), "fps", "height", "width")


def sequence_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of the media that a table names, from landed and indexed sequences: only the files that
    the index gives are opened (K11, O1)."""
    root = scratch(spark, "sequence_lookup")
    frames, _ = split_frames(frame_envelopes(spark, sf_dir, redeliver_role="user"))
    write_ordered_frames(assembled_frames(frames), f"{root}/sequences")
    index_sequences(spark, f"{root}/sequences")
    wanted = read_table(spark, sf_dir, "conversations").where(F.col("role") == "assistant").groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    wanted = wanted.where("n >= 3").select(conversation_media_name(F.col("conv_id")).alias("media_name"))
    return read_sequences(wanted, f"{root}/sequences").select("media_name", "pos", F.md5("payload").alias("md5"))


QUERIES = {
    "delivery_observed": delivery_observed,
    "delivery_outcomes": delivery_outcomes,
    "sequence_lookup": sequence_lookup,
    "media_metadata": media_metadata,
    "media_payload": media_payload,
    "header_defaults": header_defaults,
    "header_int_malformed": header_int_malformed,
    "headers_as_map": headers_as_map,
    "route_by_extension": route_by_extension_q,
    "split_by_type": split_by_type_q,
    "reject_empty": reject_empty,
    "latest_object": latest_object,
    "delivery_report": delivery_report_q,
    "frame_numbering": frame_numbering,
    "frame_explode": frame_explode,
    "lines_as_frames": lines_as_frames,
    "assemble_batch": assemble_batch_q,
    "assemble_incomplete": assemble_incomplete,
    "assembled_sequences": assembled_sequences,
    "record_outcomes": record_outcomes,
    "video_outcomes": video_outcomes,
}

_DIGEST = "CAST(sum(CAST(('0x' || substr(md5(CAST(turn AS VARCHAR) || ':' || text), 1, 15)) AS BIGINT)) AS VARCHAR)"

_ASSEMBLY_COLUMNS = f"""'conv-' || CAST(conv_id AS VARCHAR) || '.mp4' AS media_name,
       count(*) AS n_frames, CAST(max(turn) AS INTEGER) AS last_frame_id,
       CAST((conv_id % 3) * 5 + 20 AS INTEGER) AS fps, 48 AS height, 64 AS width,
       {_DIGEST} AS digest"""

ORACLES = {
    "media_metadata": """
SELECT 'doc-' || CAST(doc_id AS VARCHAR) || '.jpg' AS media_name,
       CAST(n_chars AS INTEGER) AS original_height,
       CAST(strlen(text) AS INTEGER) AS original_width
FROM documents""",
    "media_payload": """
SELECT 'doc-' || CAST(doc_id AS VARCHAR) || '.jpg' AS media_name,
       CAST(n_chars AS INTEGER) AS original_height,
       CAST(strlen(text) AS INTEGER) AS original_width,
       CAST(strlen(text) AS INTEGER) AS n_bytes,
       md5(text) AS md5
FROM documents""",
    "header_defaults": """
SELECT CAST(event_id % 4 AS INTEGER) AS partition, event_id // 4 AS "offset",
       CASE WHEN event_type = 'signup' THEN 'image' WHEN event_type IN ('click', 'view') THEN 'video'
            ELSE 'unknown' END AS media_type,
       COALESCE(CASE WHEN event_type = 'signup' THEN 'user-' || CAST(user_id AS VARCHAR) || '.jpg'
                     WHEN event_type IN ('click', 'view') THEN 'user-' || CAST(user_id AS VARCHAR) || '.mp4' END,
                'unknown') AS media_name,
       COALESCE(CAST(CASE WHEN event_type IN ('signup', 'purchase') THEN user_id
                          WHEN event_type = 'click' THEN 48 END AS INTEGER), 0) AS original_height,
       COALESCE(CASE WHEN event_type IN ('click', 'purchase') THEN CAST(trunc(value) AS INTEGER) END, 0) AS fps,
       COALESCE(CAST(CASE WHEN event_type = 'click' THEN event_id // 4
                          WHEN event_type = 'view' THEN user_id END AS INTEGER), 0) AS frame_id,
       CASE WHEN event_type = 'click' THEN 'no' WHEN event_type = 'view' THEN 'yes' ELSE 'unknown' END AS last_frame
FROM events""",
    "headers_as_map": """
SELECT CAST(event_id % 4 AS INTEGER) AS partition, event_id // 4 AS "offset",
       CAST(CASE event_type
              WHEN 'signup' THEN 1 + 3 * (user_id IS NOT NULL)::INTEGER
              WHEN 'click' THEN 5 + (user_id IS NOT NULL)::INTEGER + (value IS NOT NULL)::INTEGER
              WHEN 'view' THEN 3 + (user_id IS NOT NULL)::INTEGER
              WHEN 'purchase' THEN (user_id IS NOT NULL)::INTEGER + (value IS NOT NULL)::INTEGER
              ELSE 0 END AS INTEGER) AS n_keys,
       CASE WHEN event_type = 'click' THEN CAST(event_id // 4 AS VARCHAR)
            WHEN event_type = 'view' THEN COALESCE(CAST(user_id AS VARCHAR), 'x') END AS frame_id,
       CASE WHEN event_type IN ('signup') THEN 'image' WHEN event_type IN ('click', 'view') THEN 'video' END AS media_type
FROM events""",
    "header_int_malformed": """
SELECT partition, "offset", raw, TRY_CAST(raw AS INTEGER) AS parsed FROM (
  SELECT CAST(event_id % 4 AS INTEGER) AS partition, event_id // 4 AS "offset",
         CASE WHEN event_type = 'signup' THEN CAST(user_id AS VARCHAR)
              WHEN event_type = 'click' THEN 'x' || CAST(user_id AS VARCHAR)
              WHEN event_type = 'view' THEN CAST(user_id AS VARCHAR) || '0000000000'
              WHEN event_type = 'purchase' THEN ''
              ELSE '-' || CAST(user_id AS VARCHAR) END AS raw
  FROM events)""",
    "route_by_extension": """
SELECT page_id, name, ext,
       lower(ext) IN ('.jpg', '.jpeg', '.png', '.bmp') AS is_image,
       lower(ext) IN ('.mp4', '.avi', '.mov', '.mkv') AS is_video,
       CASE page_id % 8 WHEN 0 THEN 'JPEG' WHEN 1 THEN 'PNG' WHEN 2 THEN 'MP4' WHEN 3 THEN 'GZ'
            WHEN 4 THEN 'TXT' WHEN 5 THEN '' WHEN 6 THEN '' ELSE 'MOV' END AS format
FROM (
  SELECT page_id,
         CASE page_id % 8 WHEN 0 THEN 'page-' || page_id || '.jpg' WHEN 1 THEN 'page-' || page_id || '.PNG'
              WHEN 2 THEN 'page-' || page_id || '.mp4' WHEN 3 THEN 'page-' || page_id || '.tar.GZ'
              WHEN 4 THEN 'page-' || page_id || '.txt' WHEN 5 THEN '.page-' || page_id
              WHEN 6 THEN 'page-' || page_id || '.' ELSE 'page.' || page_id || '.MOV' END AS name,
         CASE page_id % 8 WHEN 0 THEN '.jpg' WHEN 1 THEN '.PNG' WHEN 2 THEN '.mp4' WHEN 3 THEN '.GZ'
              WHEN 4 THEN '.txt' WHEN 5 THEN '' WHEN 6 THEN '.' ELSE '.MOV' END AS ext
  FROM pages)""",
    "split_by_type": """
SELECT CASE WHEN event_type IN ('view', 'signup') THEN 'image' ELSE 'video' END AS branch,
       CASE WHEN event_type IN ('view', 'signup') THEN 'image'
            WHEN event_type IN ('click', 'purchase') THEN 'video' ELSE 'unknown' END AS media_type,
       count(*) AS n
FROM events GROUP BY 1, 2""",
    "reject_empty": """
SELECT reason, count(*) AS n FROM (
  SELECT CASE WHEN len(string_split(text, chr(10))) - 1 <= 0 THEN 'bad_height'
              WHEN strlen(text) <= 0 THEN 'bad_width'
              WHEN lang = 'de' OR lang NOT IN ('en', 'fr', 'de', 'es') OR lang IS NULL THEN 'unsupported_format'
              ELSE 'ok' END AS reason
  FROM documents)
GROUP BY reason""",
    "latest_object": """
SELECT media_name, partition, "offset", value FROM (
  SELECT 'user-' || CAST(user_id AS VARCHAR) || '.jpg' AS media_name,
         CAST(event_id % 4 AS INTEGER) AS partition, event_id // 4 AS "offset",
         concat_ws(':', event_type, props) AS value,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id % 4 DESC, event_id // 4 DESC) AS rn
  FROM events)
WHERE rn = 1""",
    "delivery_report": """
SELECT 'events' AS topic, CAST(event_id % 4 AS INTEGER) AS partition, count(*) AS n_records,
       min(event_id // 4) AS first_offset, max(event_id // 4) AS last_offset
FROM events GROUP BY event_id % 4""",
    "delivery_observed": """
SELECT 'events' AS topic, CAST(event_id % 4 AS INTEGER) AS partition, count(*) AS n_records,
       min(event_id // 4) AS first_offset, max(event_id // 4) AS last_offset
FROM events GROUP BY event_id % 4""",
    "delivery_outcomes": """
SELECT CAST(event_id % 4 AS INTEGER) AS partition,
       CASE WHEN user_id % 7 = 1 THEN 'failed: no value' WHEN user_id % 7 = 2 THEN 'failed: no position' ELSE 'delivered' END AS status, count(*) AS n
FROM events GROUP BY 1, 2""",
    "sequence_lookup": """
SELECT 'conv-' || CAST(conv_id AS VARCHAR) || '.mp4' AS media_name, CAST(turn AS INTEGER) AS pos, md5(text) AS md5
FROM conversations WHERE conv_id IN (SELECT conv_id FROM conversations WHERE role = 'assistant' GROUP BY conv_id HAVING count(*) >= 3)""",

    "frame_numbering": """
SELECT conv_id, turn,
       CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS frame_id,
       CASE WHEN turn = max(turn) OVER (PARTITION BY conv_id) THEN 'yes' ELSE 'no' END AS last_frame
FROM conversations""",
    "frame_explode": """
SELECT 'video' AS type, 'conv-' || CAST(conv_id AS VARCHAR) || '.mp4' AS media_name,
       '48' AS original_height, '64' AS original_width,
       CAST((conv_id % 3) * 5 + 20 AS VARCHAR) AS fps, CAST(turn AS VARCHAR) AS frame_id,
       CASE WHEN turn = max(turn) OVER (PARTITION BY conv_id) THEN 'yes' ELSE 'no' END AS last_frame,
       md5(text) AS md5
FROM conversations""",
    "lines_as_frames": """
SELECT 'doc-' || CAST(doc_id AS VARCHAR) || '.mp4' AS media_name,
       CAST(i - 1 AS INTEGER) AS frame_id,
       CASE WHEN i = len(lines) THEN 'yes' ELSE 'no' END AS last_frame,
       '29' AS fps,
       md5(lines[i]) AS md5
FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
     LATERAL (SELECT unnest(range(1, len(lines) + 1)) AS i)""",
    "assemble_batch": f"""
SELECT {_ASSEMBLY_COLUMNS}
FROM conversations GROUP BY conv_id""",
    "assemble_incomplete": f"""
WITH last AS (SELECT conv_id AS c, max(turn) AS last_turn FROM conversations GROUP BY conv_id)
SELECT {_ASSEMBLY_COLUMNS}
FROM conversations JOIN last ON conv_id = c
WHERE strlen(text) >= 40
GROUP BY conv_id, last_turn
HAVING count(*) = last_turn + 1""",
    "assembled_sequences": """
SELECT 'conv-' || CAST(conv_id AS VARCHAR) || '.mp4' AS media_name, CAST(turn AS INTEGER) AS pos, CAST(turn AS INTEGER) AS frame_id,
       md5(text) AS md5, CAST((conv_id % 3) * 5 + 20 AS INTEGER) AS fps, 48 AS height, 64 AS width
FROM conversations""",
    "record_outcomes": """
SELECT CASE WHEN event_type IN ('signup', 'click', 'view') AND user_id IS NOT NULL
            THEN CASE WHEN event_type = 'signup' THEN 'missing_frame_id' ELSE 'landed' END
            ELSE 'missing_name' END AS outcome, count(*) AS n
FROM events GROUP BY 1""",
    "video_outcomes": """
SELECT CASE WHEN doc_id % 7 = 0 THEN 'no_frames' ELSE 'landed' END AS outcome, count(*) AS n_videos,
       CAST(sum(CASE WHEN doc_id % 7 = 0 THEN 0 ELSE len(string_split(text, chr(10))) END) AS BIGINT) AS n_frames
FROM documents GROUP BY 1""",
}
