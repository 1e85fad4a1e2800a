"""Image operators.

Whether a file is an image, and its dimensions, come from Spark's built-in ``image`` source
(JVM decoder) alone; resizing and the channel swap run in ``mapInPandas`` over decoded rows,
one Arrow batch at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeframe.functions.headers import TYPE_IMAGE, build_headers
from lakeframe.functions.pixels import bgr_to_rgb, resize_bilinear
from lakeframe.operators.routing import route_by_extension
from lakeframe.session import scratch
from lakeframe.sinks.objects import copy_objects, list_objects, qualify, with_content


def _listed(spark: SparkSession, root: str) -> DataFrame:
    """What the image source reads directly under ``root``: decodable files whose names do not
    begin with ``.`` or ``_``."""
    img = spark.read.format("image").option("dropInvalid", True).load(qualify(spark, root))
    # an origin is URL-encoded
    name = F.url_decode(F.replace(F.substring_index("image.origin", "/", -1), F.lit("+"), F.lit("%2B")))
    return img.withColumn("name", name)


def _decoded(spark: SparkSession, root: str) -> DataFrame:
    """Decodable image files directly under ``root``, by name.  Those whose names begin with ``.``
    or ``_`` are copied, in this call, under escaped names to a scratch folder and read there."""
    hidden = F.col("name").rlike("^[._]")
    files = route_by_extension(list_objects(spark, root), "name").where(F.col("is_image") & hidden)
    seen = _listed(spark, root)
    if files.isEmpty():
        return seen
    copies = scratch(spark, "hidden_images")
    escaped = files.select("path", F.concat(F.lit("x"), "name").alias("name"))
    failed = copy_objects(escaped, f"{copies}/files", f"{copies}/status").where("status <> 'ok'").first()
    if failed:
        raise OSError(f"{failed.name[1:]}: {failed.error}")
    return seen.where(~hidden).unionByName(_listed(spark, f"{copies}/files").withColumn("name", F.expr("substring(name, 2)")))


def image_dimensions(spark: SparkSession, root: str) -> DataFrame:
    """``name, height, width, n_channels`` of every decodable image file directly under ``root``
    (S10, S14).  Files that cannot be decoded are skipped; :func:`image_files` reports them."""
    return _dimensions(_decoded(spark, root))


def _dimensions(images: DataFrame) -> DataFrame:
    return images.select("name", F.col("image.height").alias("height"), F.col("image.width").alias("width"),
                         F.col("image.nChannels").alias("n_channels"))


def image_files(spark: SparkSession, root: str) -> DataFrame:
    """Image-named files directly under ``root`` (R1, F3): ``path, name, n_bytes, height, width,
    reason``; the reason is NULL for those that the decoder takes.  Only names, sizes and
    dimensions are joined, never bytes."""
    files = route_by_extension(list_objects(spark, root), "name").where("is_image").select("path", "name", F.col("length").alias("n_bytes"))
    sized = files.join(_dimensions(_decoded(spark, root)).drop("n_channels"), "name", "left")
    reason = F.when(F.col("height").isNotNull(), F.lit(None)).when(F.col("n_bytes") == 0, F.lit("empty_payload")).otherwise(F.lit("undecodable"))
    return sized.select("path", "name", "n_bytes", "height", "width", reason.cast("string").alias("reason"))


def split_images(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(envelopes, rejected)`` of :func:`image_files`.  The stored bytes, which are the payload, are
    read in the last stage, by the tasks that make the envelopes."""
    envelopes = with_content(files.where("reason IS NULL")).select(
        F.lit(None).cast("binary").alias("key"),
        F.col("content").alias("value"),
        build_headers([("type", F.lit(TYPE_IMAGE)), ("media_name", F.col("name")),
                       ("original_height", F.col("height")), ("original_width", F.col("width"))]).alias("headers"),
    )
    return envelopes, files.where("reason IS NOT NULL").select("name", "n_bytes", "reason")


def image_envelopes(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Image files -> ``(envelopes, rejected)`` (R1, F3): listing, routing by extension (F1),
    dimensions from the decoder, the stored bytes as the payload.

    ``rejected`` has every image-named file that the decoder does not take, with a reason
    (``name, n_bytes, reason``); each such file is in exactly one of the two, whatever its name
    begins with.  Who acts on both lands :func:`image_files` first and splits that
    (:func:`split_images`), so that images are decoded once."""
    return split_images(image_files(spark, root))


RESIZED_SCHEMA = "name string, height int, width int, n_channels int, r_sum long, g_sum long, b_sum long, md5 string"


def _resizer():
    import hashlib

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for name, h, w, c, data, oh, ow in zip(pdf["name"], pdf["height"], pdf["width"], pdf["n_channels"],
                                                    pdf["data"], pdf["target_height"], pdf["target_width"]):
                px = np.frombuffer(data, dtype=np.uint8).reshape(int(h), int(w), int(c))
                if c == 4:
                    px = px[:, :, :3]
                oh, ow = max(1, int(oh)), max(1, int(ow))
                rgb = bgr_to_rgb(resize_bilinear(px, oh, ow))
                sums = [int(rgb[:, :, i].sum()) for i in range(3)] if rgb.shape[2] >= 3 else [int(rgb.sum())] * 3
                out.append((name, oh, ow, int(rgb.shape[2]), *sums, hashlib.md5(rgb.tobytes()).hexdigest()))
            yield pd.DataFrame(out, columns=["name", "height", "width", "n_channels", "r_sum", "g_sum", "b_sum", "md5"])
    return run


def decoded_images(spark: SparkSession, root: str) -> DataFrame:
    return _decoded(spark, root).select("name", F.col("image.height").alias("height"), F.col("image.width").alias("width"),
                                        F.col("image.nChannels").alias("n_channels"), F.col("image.data").alias("data"))


def resize_rows(rows: DataFrame) -> DataFrame:
    """Resize decoded rows (``name, height, width, n_channels, data, target_height,
    target_width``) bilinearly (X14) and reorder BGR to RGB (X15), reported per image.
    Identity when the target equals the decoded size, as for the producer's own images."""
    return rows.mapInPandas(_resizer(), RESIZED_SCHEMA)


def resize_images(spark: SparkSession, root: str, scale: float = 0.5) -> DataFrame:
    """Decode every image under ``root`` and resize it by ``scale``."""
    rows = decoded_images(spark, root)
    half = lambda c: F.round(F.col(c) * scale).cast("int")
    return resize_rows(rows.withColumns({"target_height": half("height"), "target_width": half("width")}))


def resize_to_headers(spark: SparkSession, root: str, metadata: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(resized, rejected)``: each stored image at the ``original_height`` x ``original_width``
    its metadata row carries, matched on ``media_name`` = file name (X14 as the consumer does);
    rejected are metadata rows without a decodable image or with a size below one
    (``media_name, reason``)."""
    targets = metadata.select(F.col("media_name").alias("name"), F.col("original_height").alias("target_height"),
                              F.col("original_width").alias("target_width"))
    sized: Column = F.coalesce((F.col("target_height") > 0) & (F.col("target_width") > 0), F.lit(False))
    joined = targets.join(decoded_images(spark, root), "name", "left")
    reason = F.when(~sized, F.lit("bad_size")).otherwise(F.lit("no_image"))
    rejected = joined.where(~sized | F.col("data").isNull()).select(F.col("name").alias("media_name"), reason.alias("reason"))
    return resize_rows(joined.where(sized & F.col("data").isNotNull())), rejected
