"""Header helpers.

All of these are native Catalyst expressions: no Python runs per row.

Decisions for inputs the Spark 3.2 reference and Spark 4 disagree on:
  * duplicate header key: the last one wins (no DUPLICATED_MAP_KEY error),
  * a missing key or a NULL header array gives NULL,
  * bytes that are not UTF-8 are replaced with U+FFFD instead of raising,
  * integer text that is malformed or out of range gives NULL instead of raising.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Header keys and values the producer writes.
TYPE_IMAGE = "image"
TYPE_VIDEO = "video"
LAST_YES = "yes"
LAST_NO = "no"
MEDIA_HEADERS = ("type", "media_name", "original_height", "original_width")
FRAME_HEADERS = ("fps", "frame_id", "last_frame")
TEXT_DEFAULT = "unknown"
INT_DEFAULT = 0


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def header_bytes(key: str, headers: str | Column = "headers") -> Column:
    """Value bytes of header ``key``; the last duplicate wins; NULL if absent.

    Built from array expressions that generate code (no lambda), so header parsing stays
    inside whole-stage codegen: the last match is the first match in the reversed keys.
    """
    h = _col(headers)
    pos = F.array_position(F.reverse(h.getField("key")), F.lit(key))
    return F.when(pos > 0, F.element_at(F.reverse(h.getField("value")), pos.cast("int")))


def utf8_text(b: Column) -> Column:
    """UTF-8 decode that replaces malformed bytes, as Spark 3 ``decode`` did."""
    return F.make_valid_utf8(b.cast("string"))


def header_text(key: str, headers: str | Column = "headers") -> Column:
    return utf8_text(header_bytes(key, headers))


def text_to_int(text: Column) -> Column:
    """Decimal text to int; malformed or overflowing text gives NULL."""
    return text.try_cast("int")


def header_int(key: str, headers: str | Column = "headers") -> Column:
    return text_to_int(header_text(key, headers))


def headers_map(headers: str | Column = "headers") -> Column:
    """Header array as ``map<string,binary>`` with last-wins duplicates.

    ``map_from_entries`` raises on duplicate keys under Spark 4 defaults, so the map is
    built from the distinct keys of the reversed array (first there = last in the
    original), each paired with its last value.
    """
    h = _col(headers)
    rkeys, rvals = F.reverse(h.getField("key")), F.reverse(h.getField("value"))
    keys = F.array_distinct(rkeys)
    values = F.transform(keys, lambda k: F.element_at(rvals, F.array_position(rkeys, k).cast("int")))
    return F.map_from_arrays(keys, values)


def build_headers(pairs: Iterable[tuple[str, Column | str | int | None]]) -> Column:
    """Header array from ``(key, value)`` pairs.

    Values are rendered as text and UTF-8 encoded; a pair whose value is NULL is left
    out, which is how a producer omits a header.  Repeating a key keeps both entries.
    """
    entries = []
    for key, value in pairs:
        v = value if isinstance(value, Column) else F.lit(value)
        encoded = F.encode(v.cast("string"), "UTF-8")
        one = F.array(F.struct(F.lit(key).alias("key"), encoded.alias("value")))
        # zero or one entry, without a lambda so the expression generates code
        entries.append(F.slice(one, 1, F.when(encoded.isNull(), F.lit(0)).otherwise(F.lit(1))))
    return F.concat(*entries) if len(entries) > 1 else entries[0]


def media_columns(df: DataFrame, headers: str = "headers") -> DataFrame:
    """Typed media fields from the headers with the consumer's defaults."""
    return df.withColumns({
        "type": F.coalesce(header_text("type", headers), F.lit(TEXT_DEFAULT)),
        "media_name": F.coalesce(header_text("media_name", headers), F.lit(TEXT_DEFAULT)),
        "original_height": F.coalesce(header_int("original_height", headers), F.lit(INT_DEFAULT)),
        "original_width": F.coalesce(header_int("original_width", headers), F.lit(INT_DEFAULT)),
        "fps": F.coalesce(header_int("fps", headers), F.lit(INT_DEFAULT)),
        "frame_id": F.coalesce(header_int("frame_id", headers), F.lit(INT_DEFAULT)),
        "last_frame": F.coalesce(header_text("last_frame", headers), F.lit(TEXT_DEFAULT)),
    })


def metadata_projection(df: DataFrame, headers: str = "headers") -> DataFrame:
    """Envelope -> media metadata table (P1-P3, P6).  The payload is never read."""
    return df.select(
        header_text("media_name", headers).alias("media_name"),
        header_int("original_height", headers).alias("original_height"),
        header_int("original_width", headers).alias("original_width"),
    )


def payload_projection(df: DataFrame, headers: str = "headers") -> DataFrame:
    """Envelope -> (media_name, original_height, original_width, image_data)."""
    return df.select(
        header_text("media_name", headers).alias("media_name"),
        header_int("original_height", headers).alias("original_height"),
        header_int("original_width", headers).alias("original_width"),
        F.col("value").cast("binary").alias("image_data"),
    )


def key_value_text(df: DataFrame) -> DataFrame:
    """Key and value bytes as text (P7): ``CAST(key AS STRING), CAST(value AS STRING)``."""
    return df.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
