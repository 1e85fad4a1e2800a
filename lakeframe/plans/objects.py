"""Object-store queries: folder listing, bulk copy with status, image files."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from lakeframe.functions.headers import metadata_projection
from lakeframe.operators.images import image_envelopes, image_files, resize_images, resize_to_headers, split_images
from lakeframe.operators.routing import in_folder
from lakeframe.plans.pngs import encode_png
from lakeframe.session import read_table, scratch
from lakeframe.sinks.objects import copy_new_objects, copy_objects, list_objects, write_objects

# Image shape per embedding label (label mod 3), 64 values each.
LABEL_SHAPES = [(8, 8), (4, 16), (16, 4)]


def list_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries whose ``parents`` contain a folder id, fields ``id, name``."""
    part = read_table(spark, sf_dir, "part")
    entries = part.select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"),
                          F.array(F.concat(F.lit("brand/"), "p_brand"), F.concat(F.lit("type/"), "p_type")).alias("parents"))
    return in_folder(entries, "brand/Brand#2").select("id", "name")


def bulk_copy_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copy a folder of objects with a status per object, kept as a status table."""
    root = scratch(spark, "bulk_copy_status")
    pages = read_table(spark, sf_dir, "pages")
    write_objects(pages.select(F.concat(F.lit("page-"), F.col("page_id").cast("string"), F.lit(".html")).alias("name"),
                               F.encode("html", "UTF-8").alias("content")), f"{root}/source")
    status = copy_objects(list_objects(spark, f"{root}/source"), f"{root}/copy", f"{root}/status")
    copied = list_objects(spark, f"{root}/copy").select("name", F.col("length").alias("copied_bytes"))
    out = status.join(copied, "name", "left")
    return out.select("name", "n_bytes", "status",
                      (F.col("copied_bytes") == F.col("n_bytes")).alias("verified"))


def incremental_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three daily copies of a folder that grows and changes in between: each takes what is new or
    changed, and the last one, made twice, nothing (R3, S10, K12)."""
    root = scratch(spark, "incremental_copy")
    pages = read_table(spark, sf_dir, "pages")
    name, body = F.concat(F.lit("page-"), F.col("page_id").cast("string"), F.lit(".html")), F.encode("html", "UTF-8")
    rows = pages.select("page_id", name.alias("name"), body.alias("content"))
    days = [rows.where("page_id % 3 <> 0"),
            rows.where("page_id % 3 = 0").unionByName(rows.where("page_id % 15 = 1").withColumn("content", F.concat("content", F.encode(F.lit("!"), "UTF-8")))),
            rows.where("false"), rows.where("false")]
    for day, change in zip((1, 2, 3, 3), days):
        write_objects(change, f"{root}/source")
        copy_new_objects(list_objects(spark, f"{root}/source"), f"{root}/copy", f"{root}/ledger", f"day{day}")
    taken = spark.read.parquet(f"{root}/ledger").where("status = 'ok'")
    held = list_objects(spark, f"{root}/copy").select("name", F.col("length").alias("held_bytes"))
    out = taken.join(held, "name")
    return out.groupBy(F.col("run")).agg(F.count(F.lit(1)).alias("n"), F.sum("n_bytes").alias("n_bytes"), F.sum("held_bytes").alias("held_bytes"))


@F.pandas_udf(BinaryType())
def _png(values: pd.Series, label: pd.Series) -> pd.Series:
    out = []
    for v, lab in zip(values, label):
        h, w = LABEL_SHAPES[int(lab) % len(LABEL_SHAPES)]
        p = np.clip(np.rint((np.asarray(v, dtype=np.float64) + 1.0) * 127.5), 0, 255).astype(np.uint8).reshape(h, w)
        out.append(encode_png(np.stack([p, 255 - p, p // 2], axis=-1)))
    return pd.Series(out)


def _write_pngs(spark: SparkSession, sf_dir: str, root: str) -> None:
    emb = read_table(spark, sf_dir, "embeddings")
    write_objects(emb.select(F.concat(F.lit("vec-"), F.col("vec_id").cast("string"), F.lit(".png")).alias("name"),
                             _png("embedding", "label").alias("content")), root)


def image_dimensions_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PNG files rendered from ``embeddings`` -> decoded sizes -> image envelopes -> metadata."""
    root = scratch(spark, "image_dimensions")
    _write_pngs(spark, sf_dir, f"{root}/images")
    envelopes, _ = image_envelopes(spark, f"{root}/images")
    return metadata_projection(envelopes)


def image_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image files of which some are cut short, empty or hidden by their name: every file is an
    envelope or a rejected row with a reason, counted (R1, F3)."""
    root = scratch(spark, "image_outcomes")
    emb = read_table(spark, sf_dir, "embeddings")
    shape = F.pmod("vec_id", F.lit(10))
    png = _png("embedding", "label")
    content = F.when(shape == 0, F.substring(png, 1, 30)).when(shape == 1, F.lit(b"")).otherwise(png)
    name = F.concat(F.when(shape == 2, F.lit(".")).when(shape == 3, F.lit("a b+%20#")).otherwise(F.lit("")), F.lit("vec-"), F.col("vec_id").cast("string"), F.lit(".png"))
    write_objects(emb.select(name.alias("name"), content.alias("content")), f"{root}/images")
    image_files(spark, f"{root}/images").write.parquet(f"{root}/files")
    envelopes, rejected = split_images(spark.read.parquet(f"{root}/files"))
    whole = F.octet_length("value") > 0
    outcome = envelopes.select(F.when(whole, F.lit("landed")).otherwise(F.lit("empty")).alias("outcome")).unionByName(rejected.select(F.col("reason").alias("outcome")))
    return outcome.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def resize_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decode the rendered PNGs, halve them bilinearly and swap BGR to RGB."""
    root = scratch(spark, "resize_pixels")
    _write_pngs(spark, sf_dir, f"{root}/images")
    out = resize_images(spark, f"{root}/images", 0.5)
    return out.select("name", "height", "width", "n_channels", "r_sum", "g_sum", "b_sum")


def resize_to_header_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each rendered PNG at the size its metadata row names: the square ones as they are, the
    others halved (X14 as the consumer does, X15)."""
    root = scratch(spark, "resize_to_header_size")
    _write_pngs(spark, sf_dir, f"{root}/images")
    emb = read_table(spark, sf_dir, "embeddings")
    kind = F.pmod("label", F.lit(len(LABEL_SHAPES)))
    size = [F.when(kind == 0, F.lit(8)).when(kind == 1, F.lit(a)).otherwise(F.lit(b)) for a, b in ((2, 8), (8, 2))]
    meta = emb.select(F.concat(F.lit("vec-"), F.col("vec_id").cast("string"), F.lit(".png")).alias("media_name"),
                      size[0].alias("original_height"), size[1].alias("original_width"))
    out, _ = resize_to_headers(spark, f"{root}/images", meta)
    return out.select("name", "height", "width", "n_channels", "r_sum", "g_sum", "b_sum")


QUERIES = {
    "list_folder": list_folder,
    "bulk_copy_status": bulk_copy_status,
    "incremental_copy": incremental_copy,
    "image_dimensions": image_dimensions_q,
    "image_outcomes": image_outcomes,
    "resize_pixels": resize_pixels,
    "resize_to_header_size": resize_to_header_size,
}

def _pixel_sql(identity_for_square: bool) -> str:
    """Channel sums of the rendered images; halving is the mean of 2 x 2 values, rounded half to
    even as the resize does."""
    def halved(channel: str) -> str:
        at = "[1 + {y} * w + {x}]"
        y, x = "(2 * (j // (w // 2)) + {})", "(2 * (j % (w // 2)) + {})"
        four = " + ".join(channel.replace("P", "p" + at.format(y=y.format(a), x=x.format(b))) for a in (0, 1) for b in (0, 1))
        return f"list_sum(list_transform(range(0, 16), lambda j: CAST(round_even(({four}) / 4.0, 0) AS BIGINT)))"
    sums = []
    for name, channel in (("r_sum", "P"), ("g_sum", "(255 - P)"), ("b_sum", "(P // 2)")):
        half = halved(channel)
        if identity_for_square:
            same = f"list_sum(list_transform(p, lambda v: {channel.replace('P', 'v')}))"
            half = f"CASE WHEN kind = 0 THEN {same} ELSE {half} END"
        sums.append(f"CAST({half} AS BIGINT) AS {name}")
    scale = "CASE WHEN kind = 0 THEN 1 ELSE 2 END" if identity_for_square else "2"
    return f"""
WITH px AS (
  SELECT vec_id, label % 3 AS kind,
         CASE label % 3 WHEN 0 THEN 8 WHEN 1 THEN 4 ELSE 16 END AS h, CASE label % 3 WHEN 0 THEN 8 WHEN 1 THEN 16 ELSE 4 END AS w,
         list_transform(embedding, lambda v: CAST(greatest(0, least(255, round_even((CAST(v AS DOUBLE) + 1.0) * 127.5, 0))) AS BIGINT)) AS p
  FROM embeddings)
SELECT 'vec-' || CAST(vec_id AS VARCHAR) || '.png' AS name, CAST(h // ({scale}) AS INTEGER) AS height, CAST(w // ({scale}) AS INTEGER) AS width,
       3 AS n_channels, {', '.join(sums)}
FROM px"""


ORACLES = {
    "list_folder": """
SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name FROM part
WHERE list_contains(['brand/' || p_brand, 'type/' || p_type], 'brand/Brand#2')""",
    "bulk_copy_status": """
SELECT 'page-' || CAST(page_id AS VARCHAR) || '.html' AS name, strlen(html) AS n_bytes, 'ok' AS status,
       true AS verified
FROM pages""",
    "incremental_copy": """
WITH p AS (SELECT page_id, strlen(html) AS first, CASE WHEN page_id % 15 = 1 THEN strlen(html) + 1 ELSE strlen(html) END AS last FROM pages),
d AS (SELECT 'day1' AS run, first AS n, last FROM p WHERE page_id % 3 <> 0
      UNION ALL SELECT 'day2', last, last FROM p WHERE page_id % 3 = 0 OR page_id % 15 = 1)
SELECT run, count(*) AS n, CAST(sum(n) AS BIGINT) AS n_bytes, CAST(sum(last) AS BIGINT) AS held_bytes FROM d GROUP BY run""",
    "image_dimensions": """
SELECT 'vec-' || CAST(vec_id AS VARCHAR) || '.png' AS media_name,
       CAST(CASE label % 3 WHEN 0 THEN 8 WHEN 1 THEN 4 ELSE 16 END AS INTEGER) AS original_height,
       CAST(CASE label % 3 WHEN 0 THEN 8 WHEN 1 THEN 16 ELSE 4 END AS INTEGER) AS original_width
FROM embeddings""",
    "image_outcomes": """
SELECT CASE vec_id % 10 WHEN 0 THEN 'undecodable' WHEN 1 THEN 'empty_payload' ELSE 'landed' END AS outcome,
       count(*) AS n
FROM embeddings GROUP BY 1""",
    "resize_pixels": _pixel_sql(False),
    "resize_to_header_size": _pixel_sql(True),
}
