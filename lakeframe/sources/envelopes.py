"""Message-envelope sources (S1, S1r, S2, S3) and the envelope publisher used as K8's stand-in.

The Kafka source is used when its connector is on the classpath; this container has none,
so every test runs on *stored envelopes*: Parquet files with the Kafka source schema,
replayed with the file stream source.  Envelopes are built from tables with
:func:`to_envelopes` so that the same rows can be checked against SQL.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeframe.schemas import ENVELOPE

DEFAULT_PARTITIONS = 4


def to_envelopes(
    df: DataFrame,
    *,
    topic: str,
    seq: Column,
    value: Column,
    headers: Column,
    key: Column | None = None,
    timestamp: Column | None = None,
    partitions: int = DEFAULT_PARTITIONS,
) -> DataFrame:
    """Rows -> M1 envelopes, a narrow projection (no shuffle).

    ``seq`` is a unique non-negative integer per row giving publish order; it is spread
    over ``partitions`` topic partitions as ``partition = seq mod n`` and
    ``offset = seq div n``, so offsets increase with publish order inside a partition
    (gaps are allowed, as in a compacted topic).
    """
    staged = df.withColumn("__seq", seq.cast("long"))
    return staged.select(
        (key.cast("binary") if key is not None else F.lit(None).cast("binary")).alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.col("__seq"), F.lit(partitions)).cast("int").alias("partition"),
        F.expr(f"__seq div {int(partitions)}").cast("long").alias("offset"),
        (timestamp if timestamp is not None else F.timestamp_seconds(F.col("__seq"))).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        headers.alias("headers"),
    )


DEFAULT_TRIGGER_BYTES = 1 << 30  # a micro-batch of a replay, whatever the topic's size
DEFAULT_TRIGGER_OFFSETS = 10_000_000  # a micro-batch of a Kafka topic


def publish(envelopes: DataFrame, path: str) -> None:
    """Append envelopes to a stored topic (K8 stand-in when Kafka is absent), in ranges of
    (partition, offset), so that a file holds consecutive records."""
    _in_topic_order(envelopes).write.mode("append").parquet(path)


def _in_topic_order(envelopes: DataFrame) -> DataFrame:
    out = envelopes.select(*[F.col(f.name).cast(f.dataType) for f in ENVELOPE.fields])
    return out.repartitionByRange("partition", "offset").sortWithinPartitions("partition", "offset")


def publish_in_order(envelopes: DataFrame, path: str, drops: int) -> Iterator[int]:
    """Publish the envelopes in ``drops`` consecutive ranges of offsets, one each time the
    iterator is advanced, so that they arrive in the topic's order (a stored topic is replayed by
    file time).  The envelopes are computed once, into ``<path>.staged``; a drop reads its range of it."""
    spark, staged = envelopes.sparkSession, f"{path.rstrip('/')}.staged"
    out = envelopes.select(*[F.col(f.name).cast(f.dataType) for f in ENVELOPE.fields])
    out.repartitionByRange("offset").sortWithinPartitions("offset").write.parquet(staged)
    rows = spark.read.schema(ENVELOPE).parquet(staged)
    cuts = sorted(set(rows.agg(F.percentile_approx("offset", [i / drops for i in range(1, drops)])).first()[0] or [])) if drops > 1 else []
    for i, low in enumerate([None, *cuts]):
        part = rows if low is None else rows.where(F.col("offset") > low)
        publish(part.where(F.col("offset") <= cuts[i]) if i < len(cuts) else part, path)
        yield i


def publish_kafka(envelopes: DataFrame, servers: str, topic: str) -> None:
    """K8 with the Kafka connector: ``value`` and ``headers``, no key.

    Not verifiable in this container (no connector, no broker).
    """
    (envelopes.select("value", "headers").write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).option("includeHeaders", "true").save())


def read_envelopes(
    spark: SparkSession,
    *,
    kind: str = "replay",
    path: str | None = None,
    servers: str | None = None,
    topic: str | None = None,
    starting: str | None = None,
    include_headers: bool = True,
    bytes_per_trigger: int = DEFAULT_TRIGGER_BYTES,
    offsets_per_trigger: int = DEFAULT_TRIGGER_OFFSETS,
) -> DataFrame:
    """Streaming envelopes (S1, S2, S1r).

    ``kind="kafka"`` passes the reference's options to the Kafka source (needs the
    connector; not verifiable here), from ``latest`` unless told otherwise; a micro-batch takes
    ``offsets_per_trigger`` records at most, so ``earliest`` does not take a whole topic at
    once.  ``kind="replay"`` streams stored envelopes from the earliest unless told
    ``latest``, which skips the records that are there when this is called; a micro-batch takes
    files of about ``bytes_per_trigger``.
    """
    if kind not in ("kafka", "replay") or starting not in (None, "earliest", "latest"):
        raise ValueError(f"unknown source {kind!r} or start {starting!r}")
    if kind == "kafka":
        reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
                  .option("subscribe", topic).option("startingOffsets", starting or "latest")
                  .option("maxOffsetsPerTrigger", offsets_per_trigger))
        if include_headers:
            reader = reader.option("includeHeaders", "true")
        return reader.load()
    stream = spark.readStream.schema(ENVELOPE).option("maxBytesPerTrigger", bytes_per_trigger).parquet(path)
    if starting == "latest":  # one row per topic partition, fixed now
        marks = spark.createDataFrame(high_water_marks(spark, path).collect(), "topic string, partition int, high_water long")
        stream = start_position(stream, marks)
    return stream


def high_water_marks(spark: SparkSession, path: str) -> DataFrame:
    """Latest offset per (topic, partition) in a stored topic right now (S3 snapshot).

    One row per topic partition: bounded by the topic's partition count, not by data.
    Only ``topic, partition, offset`` are read from the files.
    """
    return (spark.read.schema(ENVELOPE).parquet(path)
            .groupBy("topic", "partition").agg(F.max("offset").alias("high_water")))


def start_position(stream: DataFrame, marks: DataFrame | None) -> DataFrame:
    """Apply ``startingOffsets``: ``marks=None`` is *earliest*; a snapshot from
    :func:`high_water_marks` taken at query start is *latest* (S3).

    Stream-static left join with the snapshot broadcast: its size is the number of topic
    partitions.  Partitions absent from the snapshot are new and read from the start.
    """
    if marks is None:
        return stream
    joined = stream.join(F.broadcast(marks), ["topic", "partition"], "left")
    return joined.where(F.col("high_water").isNull() | (F.col("offset") > F.col("high_water"))).drop("high_water")


def delivery_report(envelopes: DataFrame) -> DataFrame:
    """Per topic partition: records written and the offset range (K9)."""
    return (envelopes.groupBy("topic", "partition")
            .agg(F.count(F.lit(1)).alias("n_records"), F.min("offset").alias("first_offset"),
                 F.max("offset").alias("last_offset")))


def publish_observed(envelopes: DataFrame, path: str, topic: str, partitions: int) -> DataFrame:
    """Publish, and report per topic partition what the write itself has counted (K9, T6): the rows
    of :func:`delivery_report` without reading the topic again.  ``partitions`` is the topic's number
    of partitions; a record of another one fails the publish before anything is stored."""
    spark, seen = envelopes.sparkSession, Observation()
    known = F.col("partition").between(0, partitions - 1) & F.col("offset").isNotNull()
    checked = envelopes.withColumn("partition", F.when(known, F.col("partition")).otherwise(
        F.raise_error(F.lit("a record has no position in the topic")).cast("int")))
    figures = []
    for i in range(partitions):
        own = F.when(F.col("partition") == i, F.col("offset"))
        figures += [F.count(own).alias(f"n{i}"), F.min(own).alias(f"first{i}"), F.max(own).alias(f"last{i}")]
    _in_topic_order(checked).observe(seen, *figures).write.mode("append").parquet(path)
    got = seen.get
    rows = [(topic, i, got[f"n{i}"], got[f"first{i}"], got[f"last{i}"]) for i in range(partitions) if got[f"n{i}"]]
    return spark.createDataFrame(rows, "topic string, partition int, n_records long, first_offset long, last_offset long")


def split_publishable(envelopes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(publishable, refused)``: a record without a value or a position cannot be stored."""
    reason = (F.when(F.col("value").isNull(), F.lit("no value"))
              .when(F.col("partition").isNull() | F.col("offset").isNull(), F.lit("no position")))
    return envelopes.where(reason.isNull()), envelopes.where(reason.isNotNull()).withColumn("reason", reason)


def delivery_records(envelopes: DataFrame, path: str) -> DataFrame:
    """Per-record delivery report (K9): ``topic, partition, offset, status`` of every record meant for
    the stored topic at ``path``, by what is found there: ``delivered``, or ``failed`` and why.

    Both sides are dealt by position and merged: the positions of a topic are many rows of few bytes,
    which by the size of its files look small enough to broadcast."""
    sent, refused = split_publishable(envelopes)
    key = ["topic", "partition", "offset"]
    stored = sent.sparkSession.read.schema(ENVELOPE).parquet(path).select(*key).repartition("partition", "offset").distinct()
    stored = stored.withColumn("stored", F.lit(True)).hint("merge")
    status = F.when(F.col("stored"), F.lit("delivered")).otherwise(F.lit("failed: not stored"))
    return (sent.select(*key).join(stored, key, "left").select(*key, status.alias("status"))
            .unionByName(refused.select(*key, F.concat(F.lit("failed: "), "reason").alias("status"))))
