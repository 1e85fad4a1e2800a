"""Frame sequences in batch: numbering, explode, de-duplication, assembly.

Scale notes.  A single media may hold a third of all rows, so nothing here collects a
media's frames into one row or one task:
  * numbering splits each media into buckets of ``bucket_width`` consecutive order values,
    ranks inside a bucket with a window, and adds the counts of earlier buckets, which
    come from a small per-(media, bucket) aggregate;
  * assembly is a partial (map-side) aggregation per media over per-frame digests; the
    frames themselves stay rows (:func:`assembled_frames`), written range-partitioned and
    sorted (:func:`write_ordered_frames`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeframe.functions.headers import LAST_NO, LAST_YES, TYPE_VIDEO, build_headers, header_int, header_text, media_columns
from lakeframe.sources.files import literal, on_disk

DEFAULT_BUCKET_WIDTH = 1 << 16


def number_frames(
    df: DataFrame,
    key: str,
    order: str,
    *,
    tiebreak: tuple[str, ...] = (),
    bucket_width: int = DEFAULT_BUCKET_WIDTH,
    seq_col: str = "frame_seq",
    last_col: str = "is_last",
) -> DataFrame:
    """0-based position of each row inside its ``key`` in ``order`` (W1) and a flag for
    the final row (W2), without putting a whole key into one window partition.

    ``order`` must be integral; ``(key, order, *tiebreak)`` should be unique so that
    the numbering is deterministic on recomputation.  No row is lost: NULL keys form one
    sequence of their own and NULL orders come first in theirs.
    """
    # A struct equals another where its NULL fields meet, and is itself never NULL.
    staged = df.withColumn("__at", F.struct(F.col(f"`{key}`").alias("k"), F.expr(f"`{order}` div {int(bucket_width)}").alias("b")))
    stats = staged.groupBy("__at").agg(F.count(F.lit(1)).alias("__n"))
    stats = stats.select(
        "__at",
        (F.sum("__n").over(Window.partitionBy("__at.k").orderBy("__at.b")) - F.col("__n")).alias("__before"),
        F.sum("__n").over(Window.partitionBy("__at.k")).alias("__total"),
    )
    local = staged.withColumn("__local", F.row_number().over(Window.partitionBy("__at").orderBy(order, *tiebreak)) - 1)
    seq = F.col("__before") + F.col("__local")
    return (local.join(stats, "__at")
            .withColumn(seq_col, seq)
            .withColumn(last_col, seq == F.col("__total") - 1)
            .drop("__at", "__before", "__total", "__local"))


def frame_headers(media_name: Column, frame_id: Column, is_last: Column, fps: Column,
                  height: Column, width: Column) -> Column:
    """Headers of one video frame record (P10): fps is truncated to int (X11)."""
    return build_headers([
        ("type", F.lit(TYPE_VIDEO)),
        ("media_name", media_name),
        ("original_height", height),
        ("original_width", width),
        ("fps", fps.cast("int")),
        ("frame_id", frame_id),
        ("last_frame", F.when(is_last, F.lit(LAST_YES)).otherwise(F.lit(LAST_NO))),
    ])


def explode_frames(videos: DataFrame, frames_col: str = "frames") -> tuple[DataFrame, DataFrame]:
    """Decoded videos ``(media_name, fps, height, width, frames array<binary>)`` -> one row
    per frame with its headers (R2, W1, W2).

    Returns ``(frames, rejected)``; a video with no frames is rejected with a reason
    instead of failing the job.
    """
    n = F.size(F.col(frames_col))
    rejected = videos.where(F.coalesce(n, F.lit(-1)) <= 0).select(
        "media_name", F.lit("no_frames").alias("reason"))
    exploded = videos.where(n > 0).select(
        "media_name", "fps", "height", "width", n.alias("__n"),
        F.posexplode(frames_col).alias("frame_id", "payload"))
    is_last = F.col("frame_id") == F.col("__n") - 1
    frames = exploded.select(
        "media_name",
        F.col("frame_id").cast("int").alias("frame_id"),
        F.when(is_last, F.lit(LAST_YES)).otherwise(F.lit(LAST_NO)).alias("last_frame"),
        "payload",
        frame_headers(F.col("media_name"), F.col("frame_id"), is_last, F.col("fps"),
                      F.col("height"), F.col("width")).alias("headers"),
    )
    return frames, rejected


def split_frames(envelopes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Frame envelopes -> ``(frames, rejected)``: the columns assembly works on, and the records
    that are no frames with a reason (``partition, offset, media_name, reason``).

    A frame needs a payload, a media name and an id of 0 or more; without this split the typed
    defaults (X13) would merge unrelated records into frame 0 of one media."""
    name, frame_id = header_text("media_name"), header_int("frame_id")
    reason = (F.when(F.col("value").isNull(), F.lit("null_payload"))
              .when(F.coalesce(name, F.lit("")) == "", F.lit("missing_name"))
              .when(frame_id.isNull(), F.lit("missing_frame_id"))
              .when(frame_id < 0, F.lit("bad_frame_id")))
    frames = media_columns(envelopes.where(reason.isNull())).select(
        "media_name", "frame_id", "last_frame", "fps", F.col("original_height").alias("height"),
        F.col("original_width").alias("width"), F.col("value").alias("payload"), "partition", "offset", "timestamp")
    rejected = envelopes.where(reason.isNotNull()).select("partition", "offset", name.alias("media_name"), reason.alias("reason"))
    return frames, rejected


def frame_digest(frame_id: Column, payload: Column) -> Column:
    """Per-frame 60-bit digest of ``'<frame_id>:' || payload``.

    Summing it over a media gives an order-aware, combinable fingerprint of the
    assembled sequence (a frame moved to another position changes the sum), so
    assembly can be checked without concatenating a media into one value.
    """
    prefix = F.encode(F.concat(frame_id.cast("string"), F.lit(":")), "UTF-8")
    return F.conv(F.substring(F.md5(F.concat(prefix, payload)), 1, 15), 16, 10).cast("long")


def arrival_order(partition: str = "partition", offset: str = "offset") -> Column:
    """(partition, offset) as one exact ``decimal(38,0)`` (partition * 10^19 + offset).

    Orders like the pair, and as a single numeric value it lets ``min``/``min_by`` run
    in hash aggregation instead of the sort-based path a struct ordering needs."""
    arrival = (F.col(partition).cast("decimal(38,0)") * F.lit("10000000000000000000").cast("decimal(38,0)")
               + F.col(offset).cast("decimal(38,0)")).cast("decimal(38,0)")
    # rows without a position (not from a topic) still take part; copies then tie
    return F.coalesce(arrival, F.lit(0).cast("decimal(38,0)"))


def dedupe_frames(frames: DataFrame, key: str = "media_name") -> DataFrame:
    """One row per (media, frame_id), whole rows kept: the earliest arrival by
    (partition, offset) wins (e.g. before landing the ordered frame table, K11).

    The winner per frame is a hash aggregate over a numeric arrival key only, grouped on
    the frame (a hot media spreads over all tasks); rows with their payloads are then
    selected with a semi-join, so no payload enters an aggregation buffer.
    ``(key, frame_id, partition, offset)`` must identify a row.
    """
    tagged = frames.withColumns({"__frame": F.struct(F.col(key), F.col("frame_id")), "__arrival": arrival_order()})
    winners = tagged.groupBy("__frame").agg(F.min("__arrival").alias("__arrival"))
    return tagged.join(winners, ["__frame", "__arrival"], "left_semi").drop("__frame", "__arrival")


def assemble_batch(frames: DataFrame, *, key: str = "media_name", strict: bool = True) -> DataFrame:
    """Per-media assembly summary (A1, A2, A4, O1).

    Input columns: ``key, frame_id, last_frame, fps, height, width, payload,
    partition, offset``.  Frames are de-duplicated by ``frame_id`` (earliest arrival
    wins); a media is complete when its last frame was seen and every id ``0..last`` is
    present (``strict``), or as soon as its last frame was seen (``strict=False``).
    fps/height/width come from the completing frame.  Output: ``key, n_frames,
    last_frame_id, fps, height, width, digest``.

    The payload is reduced to its 60-bit digest before any shuffle, and every aggregate
    buffer is numeric, so both aggregations run as partial hash aggregates.
    """
    slim = frames.select(
        key, "frame_id",
        (F.col("last_frame") == F.lit(LAST_YES)).alias("is_last"),
        "fps", "height", "width",
        frame_digest(F.col("frame_id"), F.col("payload")).alias("part"),
        arrival_order().alias("arrival"),
    )
    arrival = F.col("arrival")
    uniq = slim.groupBy(key, "frame_id").agg(
        *[F.min_by(c, arrival).alias(c) for c in ("is_last", "fps", "height", "width", "part")])
    last_order = F.when(F.col("is_last"), F.col("frame_id"))
    summary = uniq.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_frames"),
        F.min("frame_id").alias("__min"),
        F.max("frame_id").alias("__max"),
        F.max(last_order).alias("last_frame_id"),
        *[F.max_by(c, last_order).alias(f"__{c}") for c in ("fps", "height", "width")],
        F.sum(F.col("part").cast("decimal(38,0)")).alias("__digest"),
    )
    seen_last = F.col("last_frame_id").isNotNull()
    if strict:
        done = (seen_last & (F.col("__min") == 0) & (F.col("__max") == F.col("last_frame_id"))
                & (F.col("n_frames") == F.col("last_frame_id").cast("long") + 1))
    else:
        done = seen_last
    return summary.where(done).select(
        key,
        "n_frames",
        F.col("last_frame_id").cast("int").alias("last_frame_id"),
        F.col("__fps").cast("int").alias("fps"),
        F.col("__height").cast("int").alias("height"),
        F.col("__width").cast("int").alias("width"),
        F.col("__digest").cast("string").alias("digest"),
    )


def assembled_frames(frames: DataFrame, *, key: str = "media_name", strict: bool = True) -> DataFrame:
    """The frames of every complete media, one row each: ``key, pos, frame_id, payload, fps,
    height, width`` (A1, O1); ``pos`` is the place in the sequence and fps, height and width
    are those of the media's completing frame.  A media is never gathered: its frames stay
    rows, spread by (media, frame).  Write them in order with :func:`write_ordered_frames`."""
    media = assemble_batch(frames, key=key, strict=strict).select(
        F.col(key).alias("__media"), F.col("fps").alias("__fps"), F.col("height").alias("__height"), F.col("width").alias("__width"))
    rows = dedupe_frames(frames, key).join(media, F.col(key) == F.col("__media"))
    rows = rows.select(key, "frame_id", "payload", F.col("__fps").alias("fps"), F.col("__height").alias("height"),
                       F.col("__width").alias("width"))
    if strict:  # complete: ids are 0..last, so an id is its place
        rows = rows.withColumn("pos", F.col("frame_id"))
    else:
        rows = number_frames(rows, key, "frame_id", seq_col="pos", last_col="__last")
    return rows.select(key, F.col("pos").cast("int").alias("pos"), "frame_id", "payload", "fps", "height", "width")


def ordered_frames(frames: DataFrame, key: str = "media_name") -> DataFrame:
    """Frames range-partitioned and sorted by (media, frame_id) for writing the assembled
    sequence (K11): a long media spans several sorted files instead of one task."""
    return frames.repartitionByRange(key, "frame_id").sortWithinPartitions(key, "frame_id")


def write_ordered_frames(frames: DataFrame, path: str, key: str = "media_name") -> None:
    """Land the assembled frame sequences as a table (K11): files are range-partitioned
    and sorted by (media, frame_id), so a reader streams each media in order."""
    ordered_frames(frames, key).write.mode("errorifexists").parquet(path)


def index_sequences(spark: SparkSession, path: str, key: str = "media_name") -> None:
    """Write the index of landed sequences (K11, O1) to ``<path>.index``: ``key, file, first, last`` (frame
    ids), a row per media and file.  Only the key and the id are read."""
    rows = spark.read.parquet(path).select(key, "frame_id", on_disk(F.col("_metadata.file_path")).alias("file"))
    index = rows.groupBy(key, "file").agg(F.min("frame_id").alias("first"), F.max("frame_id").alias("last"))
    index.repartitionByRange(key, "first").sortWithinPartitions(key, "first").write.mode("overwrite").parquet(f"{path.rstrip('/')}.index")


def read_sequences(wanted: DataFrame, path: str, key: str = "media_name") -> DataFrame:
    """Frames of the media named in ``wanted`` (column ``key``), from a landed and indexed table: the
    index says which files hold them, and only those are opened.  The look-up runs in this call; the
    driver holds the names of the files to scan, as for any scan."""
    spark = wanted.sparkSession
    names = wanted.select(key).where(F.col(key).isNotNull()).distinct()
    index = spark.read.parquet(f"{path.rstrip('/')}.index")
    files = [r.file for r in index.join(names, key, "left_semi").select("file").distinct().collect()]
    rows = spark.read.parquet(path)
    if not files:
        return rows.where("false")
    return spark.read.schema(rows.schema).parquet(*literal(sorted(files))).join(names, key, "left_semi")


def position_order(timestamp: str = "timestamp", partition: str = "partition", offset: str = "offset",
                   fields: dict[str, str] | None = None) -> Column:
    """(timestamp, partition, offset) as one exact number, for hash aggregates with ``max``.

    ``(micros + 2^55) * 2^70 + (partition + 1) * 2^53 + offset + 1``: 126 bits in a
    ``decimal(38,0)``.  A NULL part sorts before all others.  A part beyond its range (years
    beyond 3000, 2^17 partitions, 2^53 offsets) raises instead of sorting wrongly."""
    kind = (fields or {}).get(timestamp, "timestamp")
    micros = F.unix_micros(F.col(timestamp)) if kind == "timestamp" else F.col(timestamp).cast("long")
    t = F.coalesce(micros + F.lit(1 << 55), F.lit(0).cast("long"))
    p = F.coalesce(F.col(partition).cast("long") + 1, F.lit(0).cast("long"))
    o = F.coalesce(F.col(offset).cast("long") + 1, F.lit(0).cast("long"))
    inside = t.between(0, (1 << 56) - 1) & p.between(0, (1 << 17) - 1) & o.between(0, (1 << 53) - 1)
    wide = lambda c: c.cast("decimal(38,0)")
    shift = lambda bits: F.lit(str(1 << bits)).cast("decimal(17,0)")
    low = wide(p.cast("decimal(6,0)") * shift(53)) + wide(o)
    high = wide((t.cast("decimal(17,0)") * F.lit(str(1 << 17)).cast("decimal(6,0)"))).cast("decimal(22,0)") * F.lit(str(1 << 53)).cast("decimal(16,0)")
    return F.when(inside, wide(high) + low).otherwise(F.raise_error(F.lit("timestamp, partition or offset out of range")))


def latest_rows(df: DataFrame, name: str = "media_name",
                order: tuple[str, ...] = ("timestamp", "partition", "offset")) -> DataFrame:
    """Last write wins per name (A3), whole rows.

    The winning position per name is a partial hash aggregate over the key columns only, so a
    name that receives a third of all writes shrinks on the map side; the winning rows are
    then selected with a semi-join.  Nothing is lost: a NULL name is a name, a NULL part of a
    position the lowest.  ``(name, *order)`` must be unique; ``order`` is a triple (timestamp
    or number, partition, offset) or one numeric column."""
    kinds = dict(df.dtypes)
    place = F.col(order[0]) if len(order) == 1 else position_order(*order, fields=kinds)
    tagged = df.withColumns({"__name": F.struct(F.col(name)), "__place": place})
    if len(order) == 1:
        tagged = tagged.withColumn("__place", F.coalesce(F.col("__place").cast("decimal(38,0)"), F.lit(str(-(10 ** 30))).cast("decimal(38,0)")))
    winners = tagged.groupBy("__name").agg(F.max("__place").alias("__place"))
    return tagged.join(winners, ["__name", "__place"], "left_semi").drop("__name", "__place")


def latest_per_name(df: DataFrame, name: str = "media_name",
                    order: tuple[str, ...] = ("timestamp", "partition", "offset")) -> DataFrame:
    """The latest row per object name (A3), name first."""
    latest = latest_rows(df, name, order)
    return latest.select(name, *[c for c in df.columns if c != name])
