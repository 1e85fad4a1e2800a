"""Schemas shared by sources, sinks and tests (data model M1-M16)."""

from pyspark.sql import types as T

HEADER = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())])
HEADERS = T.ArrayType(HEADER)

# M1: the message envelope as the Kafka source delivers it with includeHeaders=true.
ENVELOPE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
    T.StructField("headers", HEADERS),
])

# M5: media metadata table.
MEDIA_METADATA = T.StructType([
    T.StructField("media_name", T.StringType()),
    T.StructField("original_height", T.IntegerType()),
    T.StructField("original_width", T.IntegerType()),
])

# M8 / M10 / M11 / M13 / M14
EMPLOYEE = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("gender", T.StringType()),
])
PEOPLE = T.StructType([
    T.StructField("Name", T.StringType()),
    T.StructField("Age", T.IntegerType()),
    T.StructField("City", T.StringType()),
])
FILE_ENTRY = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("parents", T.ArrayType(T.StringType())),
])
STORED_OBJECT = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("content", T.BinaryType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
])

# T1 output: one row per assembled media and publication; ``published_since`` and
# ``published_until`` are the earliest and latest producer timestamp among its frames.
ASSEMBLED = T.StructType([
    T.StructField("media_name", T.StringType()),
    T.StructField("n_frames", T.LongType()),
    T.StructField("last_frame_id", T.IntegerType()),
    T.StructField("fps", T.IntegerType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("digest", T.StringType()),
    T.StructField("published_since", T.TimestampType()),
    T.StructField("published_until", T.TimestampType()),
])
