"""Exact dedup: tree merge of sorted digest runs (DataFrame operations only).

Every row joins one of ``radix ** rounds`` runs by a hash of its row number.  A run is the
sorted list of its distinct digests, each with the best identifier seen so far and a count.
In round ``r`` runs whose numbers differ in digit ``r`` only exchange their entries: an entry
moves to the run whose digit ``r`` is that of its digest.  The receiver merges its ``radix``
sorted inputs; entries merge only when SHA-256, byte length and a second hash all agree.
After the last round an entry lies in the run its digest names, with the answer for all rows.
The answers then go back down the same tree, so a digest that a third of all rows share is
never gathered: no merge or join meets it more than ``radix`` times per run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import COPIES, KEY1, KEY2, keyed, land, shuffle_partitions, text_of

WHITE_SPACE = r"[\x20\x09-\x0D]+"
RADIX_BITS = 3
DIGEST = ["sha", "n_bytes", "second"]


def _rounds(partitions: int) -> int:
    rounds = 1
    while 2 ** (RADIX_BITS * rounds) < partitions:
        rounds += 1
    return rounds


def _merge(entries: DataFrame, runs: int, key: str) -> DataFrame:
    """Multiway merge of the sorted runs that meet in ``key``: smallest identifier, count."""
    together = entries.repartition(runs, key).sortWithinPartitions(key, *DIGEST)
    return together.groupBy(key, *DIGEST).agg(F.min("best").alias("best"), F.sum("n").alias("n"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256`` and the
    row keys.

    Texts are equal when identical without the characters ``[\\x20\\x09-\\x0D]``; NULL is the
    empty text, and all empty texts form one group.  Of a group the row with the most code
    points stays, then the smallest id (NULL ids last), then, among repeated rows, any one of
    them.  Columns other than the two named are carried in the row keys only.  An empty table
    gives an empty result."""
    spark = docs.sparkSession
    rounds = _rounds(shuffle_partitions(spark))
    runs, mask = 2 ** (RADIX_BITS * rounds), 2 ** RADIX_BITS - 1

    plain = F.regexp_replace(text_of(text_col), WHITE_SPACE, "")
    rows = keyed(docs).select(
        KEY1, KEY2, F.col(f"`{id_col}`").alias("doc_id"), F.length(text_of(text_col)).alias("size"), plain.alias("plain"))
    rows = rows.select(
        KEY1, KEY2, "doc_id", "size", F.unhex(F.sha2("plain", 256)).alias("sha"),
        F.octet_length("plain").alias("n_bytes"), F.xxhash64("plain").alias("second"),
        F.monotonically_increasing_id().alias("row"))
    rows = land(rows, "exact_dedup_rows").withColumn("run0", F.pmod(F.xxhash64("row"), F.lit(runs)))

    best = F.struct((-F.col("size")).alias("size"), F.isnull("doc_id").alias("no_id"), F.col("doc_id"), F.col("row"))
    level = rows.select("run0", *DIGEST, best.alias("best"), F.lit(1).cast("long").alias("n"))
    level = level.groupBy("run0", *DIGEST).agg(F.min("best").alias("best"), F.sum("n").alias("n"))
    levels = []
    for r in range(rounds):
        digit = F.lit(mask << (RADIX_BITS * r))
        to = F.col(f"run{r}").bitwiseAND(F.bitwise_not(digit)).bitwiseOR(F.col("second").bitwiseAND(digit))
        level = land(level.withColumn(f"run{r + 1}", to), f"exact_dedup_run{r}")
        levels.append(level)
        level = _merge(level, runs, f"run{r + 1}")

    answer = level.select(f"run{rounds}", *DIGEST, "best", "n")
    for r in reversed(range(rounds)):
        below = levels[r].select(f"run{r}", f"run{r + 1}", *DIGEST)
        answer = below.join(answer, [f"run{r + 1}", *DIGEST]).select(f"run{r}", *DIGEST, "best", "n")
    out = rows.join(answer, ["run0", *DIGEST])
    return out.select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"), KEY1, KEY2)


def kept_copies(found: DataFrame) -> DataFrame:
    """Row keys of the rows that stay, one copy each, for ``emit_copies``."""
    return found.where("kept").groupBy(KEY1, KEY2).agg(F.lit(1).cast("long").alias(COPIES))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS size,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER best = 1 AS kept, text_sha256
FROM d WINDOW best AS (PARTITION BY text_sha256 ORDER BY size DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
"""
