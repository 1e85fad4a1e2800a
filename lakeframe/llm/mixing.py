"""Mixing sources to target weights (DataFrame operations only).

A source with token share ``p`` gets the weight ``p**a / sum(p**a)``; a = 1 keeps the shares,
a = 0 makes sources equal.  ``a`` is found by sectioning the grid ``0, 1/GRID, .. 1``: each
pass evaluates all section points in one aggregate over the table of sources, so sources are
never gathered on the driver.  The weights are then realised as a sequence of blocks: each
source is walked in a hash permutation, a new one each epoch, until its quota of tokens is
met; a block takes the same share of every quota, and a second permutation shuffles it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import COPIES, KEY1, KEY2, keyed, land, text_of

GRID = 65536
SECTIONS = 16
BLOCK_TOKENS = 1 << 20
PART_TOKENS = 1 << 24  # a window of prefix sums holds about so many at most
WORD = r"[^\x20\x09-\x0D]+"
EXACT = "decimal(38,0)"  # sums that do not depend on the order of their terms
SCALE = 10 ** 15


def token_count(text_col: str) -> Column:
    """Words of a text; a NULL or wordless text still counts one token, so that it has a place."""
    return F.greatest(F.regexp_count(text_of(text_col), F.lit(WORD)), F.lit(1)).cast("long")


def _sum(value: Column) -> Column:
    return F.sum((value * SCALE).cast(EXACT)).cast("double") / SCALE


def _turn(seed: int, *parts: Column | str) -> Column:
    """Place of a row in a permutation: a hash of its id, or of the landed row where that is NULL."""
    row = F.concat_ws(":", F.lit("null"), KEY1, KEY2, "row")
    return F.md5(F.concat_ws(":", F.lit(seed), *parts, F.coalesce(F.col("doc_id").cast("string"), row)).cast("binary"))


def part_digits(tokens: int) -> int:
    """Hex digits of a place that cut a source of so many tokens into parts of ``PART_TOKENS``."""
    return next(d for d in range(3, 33) if tokens <= PART_TOKENS << 4 * d or d == 32)


def _section(holds, rising: bool) -> int | None:
    """The grid point at the edge of a monotone condition: the smallest point that holds if
    ``rising``, else the largest; None if no point holds.  ``holds`` maps points to booleans."""
    low, high = 0, GRID
    edge = high if rising else low
    if not holds([edge])[0]:
        return None
    while high > low:
        step = max(1, -(-(high - low) // SECTIONS))
        points = sorted({*range(low, high, step), high})
        good = holds(points)
        if rising:
            i = good.index(True)
            low, high = (points[i - 1] + 1 if i else points[0]), points[i]
        else:
            i = len(good) - 1 - good[::-1].index(True)
            low, high = points[i], (points[i + 1] - 1 if i + 1 < len(points) else points[i])
    return low


def find_exponent(sources: DataFrame, target_entropy: float | None, max_repetition: float | None,
                  budget: int | None) -> int:
    """Grid numerator of the exponent.  ``target_entropy`` is a fraction of the greatest
    entropy ``ln(sources)``: the exponent is the largest that reaches it.  ``max_repetition``
    bounds how often any source is walked: the exponent is the smallest that keeps to it.
    With both, the entropy is met as far as the repetition limit lets it."""
    total, largest, smallest, n = sources.agg(F.sum("total"), F.max("total"), F.min("total"), F.count(F.lit(1))).first()
    share = F.col("total") / F.lit(total)

    def entropy(points: list[int]) -> list[bool]:
        parts = []
        for k in points:
            power = F.pow(share, F.lit(k / GRID))
            parts += [_sum(power), _sum(power * F.log(share))]
        row = sources.agg(*[p.alias(f"c{i}") for i, p in enumerate(parts)]).first()
        found = [math.log(row[2 * i]) - k / GRID * row[2 * i + 1] / row[2 * i] for i, k in enumerate(points)]
        return [h >= target_entropy * math.log(n) - 1e-9 for h in found]

    def repetition(points: list[int]) -> list[bool]:
        if budget is None:  # the largest source once, the smallest most often
            return [(largest / smallest) ** (1 - k / GRID) <= max_repetition + 1e-9 for k in points]
        row = sources.agg(*[_sum(F.pow(share, F.lit(k / GRID))).alias(f"c{i}") for i, k in enumerate(points)]).first()
        p = smallest / total
        return [budget * p ** (k / GRID) / row[i] / smallest <= max_repetition + 1e-9 for i, k in enumerate(points)]

    exponent = None
    if target_entropy is not None:
        exponent = _section(entropy, rising=False) or 0
    if max_repetition is not None:
        least = _section(repetition, rising=True)
        if least is None:
            raise ValueError("the budget cannot be met within the repetition limit at any exponent")
        exponent = least if exponent is None else max(exponent, least)
    return GRID if exponent is None else exponent


def mix_sources(docs: DataFrame, target_entropy: float | None = None, max_repetition: float | None = None,
                budget: int | None = None, block_tokens: int = BLOCK_TOKENS, seed: int = 0,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per emitted copy of a document: ``doc_id, source, tokens, weight, epoch, block,
    slot`` and the row keys.  ``(block, slot)`` is the training order, slots from 0.

    ``budget`` is the number of tokens to emit; without one it is the least at which every
    document is emitted once, so nothing is lost and small sources repeat.  A source's last
    epoch stops with the document that meets its quota.  NULL is a source of its own; a NULL,
    empty or wordless text counts one token; repeated rows are documents of their own.  Rows of
    NULL id are permuted by their contents, identical ones by where they were read; rows that
    share an id share a place and go by their contents there.  A very long text is one row, and
    its block may exceed ``block_tokens`` by it; columns beyond the three named only tell rows
    apart, whatever their names.  An empty table gives an empty result."""
    rows = keyed(docs).select(
        KEY1, KEY2, F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"),
        token_count(text_col).alias("tokens"), F.monotonically_increasing_id().alias("row"))
    rows = land(rows, "mixing_rows")
    sources = rows.groupBy("source").agg(F.sum("tokens").alias("total"))
    sources = land(sources.withColumn("sid", F.monotonically_increasing_id()), "mixing_sources")
    if sources.isEmpty():
        exponent, total, largest = GRID, 1, 1
    else:
        exponent = find_exponent(sources, target_entropy, max_repetition, budget)
        total, largest = sources.agg(F.sum("total"), F.max("total")).first()
    a = exponent / GRID
    if budget is None:
        wanted = F.col("total") * F.pow(F.lit(largest) / F.col("total"), F.lit(1 - a))
    else:
        power = F.pow(F.col("total") / F.lit(total), F.lit(a))
        wanted = power / F.lit(sources.agg(_sum(power)).first()[0] or 1.0) * F.lit(budget)
    quotas = land(sources.withColumn("quota", F.greatest(F.floor(wanted + F.lit(0.5)), F.lit(0)).cast("long")), "mixing_quotas")
    emitted = quotas.agg(F.sum("quota")).first()[0] or 1
    blocks = max(1, -(-emitted // block_tokens))
    quotas = quotas.withColumn("weight", F.round(F.col("quota") / F.lit(emitted), 9))

    drawn = rows.join(quotas, rows["source"].eqNullSafe(quotas["source"])).select(rows["*"], "sid", "total", "quota", "weight")
    epochs = F.sequence(F.lit(0).cast("long"), F.ceil(F.col("quota") / F.col("total")) - 1)
    drawn = drawn.where("quota > 0").withColumn("epoch", F.explode(epochs))
    drawn = drawn.withColumn("place", _turn(seed, "epoch")).withColumn("part", F.substring("place", 1, part_digits(int(largest))))
    # Prefix sums in two steps, so that no window holds a whole source.
    parts = drawn.groupBy("sid", "epoch", "part").agg(F.sum("tokens").alias("part_tokens"))
    before = Window.partitionBy("sid", "epoch").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("sid", "epoch", "part", F.coalesce(F.sum("part_tokens").over(before), F.lit(0)).alias("parts_before"))
    inside = (Window.partitionBy("sid", "epoch", "part").orderBy("place", F.isnull("doc_id"), "doc_id", KEY1, KEY2, "row")
              .rowsBetween(Window.unboundedPreceding, -1))
    drawn = drawn.withColumn("inside", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).join(parts, ["sid", "epoch", "part"])
    drawn = drawn.withColumn("at", F.col("epoch") * F.col("total") + F.col("parts_before") + F.col("inside"))
    drawn = drawn.where(F.col("at") < F.col("quota"))
    drawn = drawn.withColumn("block", F.expr(
        f"(CAST(at AS DECIMAL(19,0)) * CAST({blocks} AS DECIMAL(18,0))) div CAST(quota AS DECIMAL(19,0))"))
    shuffled = Window.partitionBy("block").orderBy("turn", "epoch", F.isnull("doc_id"), "doc_id", KEY1, KEY2, "row")
    drawn = drawn.withColumn("turn", _turn(seed, F.lit("slot"), "epoch")).withColumn("slot", F.row_number().over(shuffled).cast("long") - 1)
    return drawn.select("doc_id", "source", "tokens", "weight", "epoch", "block", "slot", KEY1, KEY2)


def copies(mixed: DataFrame) -> DataFrame:
    """How often each row of the input is emitted, for ``emit_copies``."""
    return mixed.groupBy(KEY1, KEY2).agg(F.count(F.lit(1)).alias(COPIES))


# Parameters of the registered query, repeated in its SQL.
QUERY = {"target_entropy": 0.95, "max_repetition": 4.0}

ORACLE = rf"""
WITH d AS MATERIALIZED (
  SELECT doc_id, source, greatest(len(regexp_extract_all(coalesce(text, ''), '{WORD}')), 1) AS tokens FROM documents),
s AS MATERIALIZED (SELECT source, sum(tokens)::DOUBLE AS total FROM d GROUP BY source),
t AS MATERIALIZED (SELECT sum(total) AS total, max(total) AS largest, min(total) AS smallest, count(*) AS n FROM s),
grid AS (SELECT range AS k, range / {GRID}::DOUBLE AS a FROM range(0, {GRID} + 1)),
e AS (SELECT k, ln(sum(pow(s.total / t.total, a))) - any_value(a) * sum(pow(s.total / t.total, a) * ln(s.total / t.total))
             / sum(pow(s.total / t.total, a)) AS h, any_value(t.n) AS n FROM grid, s, t GROUP BY k),
pick AS MATERIALIZED (
  SELECT greatest((SELECT coalesce(max(k), 0) FROM e WHERE h >= {QUERY["target_entropy"]} * ln(n) - 1e-9),
                  (SELECT min(k) FROM grid, t WHERE pow(largest / smallest, 1 - a) <= {QUERY["max_repetition"]} + 1e-9)) / {GRID}::DOUBLE AS a),
q AS MATERIALIZED (
  SELECT s.source, s.total::BIGINT AS total, floor(s.total * pow(t.largest / s.total, 1 - pick.a) + 0.5)::BIGINT AS quota FROM s, t, pick),
b AS MATERIALIZED (SELECT sum(quota)::BIGINT AS emitted, greatest(1, -((-sum(quota)::BIGINT) // {BLOCK_TOKENS})) AS blocks FROM q),
w AS (
  SELECT d.doc_id, d.source, d.tokens, q.total, q.quota, unnest(range(0, CAST(ceil(q.quota / q.total) AS BIGINT))) AS epoch
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
p AS (
  SELECT *, epoch * total + coalesce(sum(tokens) OVER (
    PARTITION BY source, epoch ORDER BY md5('0:' || epoch || ':' || doc_id), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM w),
z AS (SELECT p.*, (pos::HUGEINT * blocks) // quota AS block, round(quota / emitted, 9) AS weight FROM p, b WHERE pos < quota)
SELECT doc_id, source, tokens::BIGINT AS tokens, weight, epoch, block::BIGINT AS block,
       row_number() OVER (PARTITION BY block ORDER BY md5('0:slot:' || epoch || ':' || doc_id), epoch, doc_id) - 1 AS slot
FROM z
"""
