"""Routing and validation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeframe.functions.headers import TYPE_IMAGE
from lakeframe.functions.paths import extension, has_extension

# Default extension sets.  The reference reads them from its environment;
# these are this build's defaults and can be overridden per call.
DEFAULT_IMAGE_EXTENSIONS = (".jpg", ".jpeg", ".png", ".bmp")
DEFAULT_VIDEO_EXTENSIONS = (".mp4", ".avi", ".mov", ".mkv")


def route_by_extension(
    df: DataFrame,
    name: str = "name",
    image_exts: str | Iterable[str] = DEFAULT_IMAGE_EXTENSIONS,
    video_exts: str | Iterable[str] = DEFAULT_VIDEO_EXTENSIONS,
) -> DataFrame:
    """Adds ``ext``, ``is_image``, ``is_video`` (F1).  The two tests are independent,
    as in the producer: a name in both sets goes down both paths."""
    ext = extension(F.col(name))
    return df.withColumns({
        "ext": ext,
        "is_image": has_extension(ext, image_exts),
        "is_video": has_extension(ext, video_exts),
    })


def split_by_type(df: DataFrame, type_col: str = "type") -> tuple[DataFrame, DataFrame]:
    """``type = 'image'`` goes to images, anything else (including missing) to videos (F2)."""
    is_image = F.coalesce(F.col(type_col) == F.lit(TYPE_IMAGE), F.lit(False))
    return df.where(is_image), df.where(~is_image)


def branch_of(type_col: str = "type") -> Column:
    return F.when(F.coalesce(F.col(type_col) == F.lit(TYPE_IMAGE), F.lit(False)), F.lit("image")).otherwise(F.lit("video"))


def reject_reason(
    payload: str = "value",
    name: str = "media_name",
    height: str = "original_height",
    width: str = "original_width",
    image_exts: str | Iterable[str] = DEFAULT_IMAGE_EXTENSIONS,
) -> Column:
    """Why a media record cannot be landed, NULL when it can (F3).  First failing check wins."""
    size = F.octet_length(F.col(payload))
    return (F.when(F.col(payload).isNull(), F.lit("null_payload"))
            .when(size == 0, F.lit("empty_payload"))
            .when(F.col(name).isNull() | (F.col(name) == ""), F.lit("missing_name"))
            .when(F.coalesce(F.col(height), F.lit(0)) <= 0, F.lit("bad_height"))
            .when(F.coalesce(F.col(width), F.lit(0)) <= 0, F.lit("bad_width"))
            .when(~has_extension(extension(F.col(name)), image_exts), F.lit("unsupported_format")))


def split_valid(df: DataFrame, **kw) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)``; rejected rows carry a ``reason`` column."""
    tagged = df.withColumn("reason", reject_reason(**kw))
    return tagged.where(F.col("reason").isNull()).drop("reason"), tagged.where(F.col("reason").isNotNull())


def in_folder(df: DataFrame, folder_id: str, parents: str = "parents") -> DataFrame:
    """Entries whose ``parents`` contain the folder."""
    return df.where(F.array_contains(F.col(parents), folder_id))
