"""Document fingerprints: threshold-scaled sketches (DataFrame operations only).

A sketch keeps every shingle hash below a fixed fraction of the hash range, so its size follows
the text's and sketches of very unequal texts stay comparable: the share of one sketch's hashes
found in another estimates containment.  Sketches merge by union.  A text whose hashes all lie
above the threshold keeps its smallest one, so that only wordless texts have an empty sketch;
``merged`` drops such a stand-in as soon as a hash below the threshold is there.  Another sketch
says nothing about a stand-in, so ``contained`` looks it up in all hashes of the other text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import KEY1, KEY2, keyed, land, shuffle_partitions, text_of

SPLIT = r"[\x20\x09-\x0D]+"
WORDS, SCALE = 5, 4
ROWS_PER_RANGE, MOST_CUTS = 2000, 65536


def _limit(scale: int) -> Column:
    return F.lit((1 << 63) // scale)  # hashes have 63 bits, so that they sort as they compare


def word_hashes(text: Column) -> Column:
    return F.transform(F.filter(F.split(text, SPLIT), lambda w: w != ""), lambda w: F.xxhash64(w))


def shingle_hashes(each: str, words: int) -> Column:
    """Hashes of all shingles of a column of word hashes; fewer words are one shingle."""
    many = F.size(each)
    shingles = F.transform(
        F.sequence(F.lit(0), many - words),
        lambda i: F.shiftrightunsigned(F.xxhash64(*[F.get(F.col(each), i + j) for j in range(words)]), 1))
    whole = F.array(F.shiftrightunsigned(F.xxhash64(F.col(each)), 1))
    return F.when(many == 0, F.array().cast("array<bigint>")).when(many < words, whole).otherwise(shingles)


def with_sketch(df: DataFrame, text: str, out: str, words: int = WORDS, scale: int = SCALE) -> DataFrame:
    """Adds the sketch of column ``text`` (never NULL) as a sorted array of longs.  Word case in
    A-Z counts; a text of fewer words is one shingle."""
    each, hashes = f"__lf_{out}_words", f"__lf_{out}_all"
    df = df.withColumn(each, word_hashes(F.col(text))).withColumn(hashes, shingle_hashes(each, words))
    low = F.filter(hashes, lambda h: h < _limit(scale))
    df = df.withColumn(out, F.sort_array(F.array_distinct(low)))
    df = df.withColumn(out, F.when((F.size(out) == 0) & (F.size(hashes) > 0), F.array(F.array_min(hashes))).otherwise(F.col(out)))
    return df.drop(each, hashes)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the first text's shingles that are in the second (0 to 1); two empty
    sketches contain each other, an empty one and another do not.  Of stand-ins it knows only
    whether they are equal: where the texts are at hand use ``contained``."""
    both = F.size(F.array_intersect(a, b)) / F.size(a)
    return F.when(F.size(a) == 0, F.when(F.size(b) == 0, F.lit(1.0)).otherwise(F.lit(0.0))).otherwise(both)


def contained(df: DataFrame, sketch: str, text: str, other_sketch: str, other_text: str, out: str,
              words: int = WORDS, scale: int = SCALE) -> DataFrame:
    """Adds ``out``: ``containment`` of a text in another one.  A stand-in is looked up in all
    hashes of the other text, and a text of fewer words than a shingle as a run of its words, so
    a text that lies wholly inside another one never has 0.  The other text is split for such
    rows only."""
    own, other, all_hashes = (f"__lf_{out}_{c}" for c in ("own", "other", "all"))
    none = F.array().cast("array<bigint>")
    df = df.withColumn(own, F.when(F.size(sketch) == 1, word_hashes(F.col(text))).otherwise(none))
    few = (F.size(own) > 0) & (F.size(own) < words)
    looked_up = few | ((F.size(own) > 0) & (F.get(F.col(sketch), F.lit(0)) >= _limit(scale)))
    df = df.withColumn(other, F.when(looked_up, word_hashes(F.col(other_text))).otherwise(none))
    df = df.withColumn(all_hashes, F.when(looked_up & ~few, shingle_hashes(other, words)).otherwise(none))
    room = F.size(other) - F.size(own)
    run = F.when(room < 0, F.lit(False)).otherwise(
        F.exists(F.sequence(F.lit(0), F.greatest(room, F.lit(0))), lambda i: F.slice(F.col(other), i + 1, F.size(own)) == F.col(own)))
    found = F.when(few, run).otherwise(F.array_contains(F.col(all_hashes), F.get(F.col(sketch), F.lit(0))))
    inside = F.when(looked_up, found.cast("double")).otherwise(containment(F.col(sketch), F.col(other_sketch)))
    return df.withColumn(out, inside).drop(own, other, all_hashes)


def merged(a: Column, b: Column, scale: int = SCALE) -> Column:
    """Sketch of two texts together."""
    both = F.sort_array(F.array_union(a, b))
    low = F.filter(both, lambda h: h < _limit(scale))
    return F.when(F.size(low) > 0, low).otherwise(F.slice(both, 1, 1))


def as_text(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.hex(h))), ",")


# --- neighbours by id -------------------------------------------------------------------

def last_not_above(lows: Column, value: Column, n: Column, steps: int) -> Column:
    """Index of the last of ``n`` ascending ``lows`` that is not above ``value`` (0 if none is),
    by a binary search of ``steps`` halvings."""
    strides = F.lit([1 << b for b in reversed(range(max(steps, 1)))])
    return F.aggregate(strides, F.lit(0), lambda at, step: F.when(
        (at + step < n) & F.coalesce(F.get(lows, at + step) <= value, F.lit(False)), at + step).otherwise(at))


def cut(values: DataFrame, least: int) -> tuple[list, bool]:
    """Lowest and highest value of each of at most ``MOST_CUTS`` ranges of the column ``at``, and
    whether that is too few."""
    ranges = max(least, -(-values.count() // ROWS_PER_RANGE))
    parts = (values.repartitionByRange(min(ranges, MOST_CUTS), "at").groupBy(F.spark_partition_id().alias("p"))
             .agg(F.min("at").alias("low"), F.max("at").alias("high")).orderBy("low").collect())
    return parts, ranges > MOST_CUTS


def place(rows: DataFrame, ids: list, ties: list) -> DataFrame:
    """Adds ``__lf_range``, the range a row's position lies in (those of NULL ids first), and
    ``__lf_head``, whether it is the highest position there."""
    def search(parts: list, value: Column, first: int) -> tuple[Column, Column]:
        if not parts:
            return F.lit(0), F.lit(False)
        lows, highs = (F.lit([p[c] for p in parts]) for c in ("low", "high"))
        at = last_not_above(lows, value, F.lit(len(parts)), (len(parts) - 1).bit_length())
        return at + first, F.get(highs, F.col("__lf_range") - first) == value

    at_id, head_id = search(ids, F.col("doc_id"), len(ties))
    at_tie, head_tie = search(ties, F.col("__lf_tie"), 0)
    null = F.isnull("doc_id")
    return (rows.withColumn("__lf_range", F.when(null, at_tie).otherwise(at_id))
            .withColumn("__lf_head", F.coalesce(F.when(null, head_tie).otherwise(head_id), F.lit(False))))


def refine(rows: DataFrame) -> DataFrame:
    """Cuts the ranges of ``place`` again, each into pieces of ``ROWS_PER_RANGE`` positions:
    adds ``__lf_piece``, ``__lf_pieces`` (how many the range has) and the head of each piece.
    The bounds stay a table, joined by range."""
    order = Window.partitionBy("__lf_range").orderBy("doc_id", "__lf_tie")
    spots = rows.select("__lf_range", "doc_id", "__lf_tie").distinct()
    spots = spots.withColumn("piece", F.floor((F.row_number().over(order) - 1) / ROWS_PER_RANGE).cast("int"))
    spot = F.struct("doc_id", "__lf_tie")
    bounds = spots.groupBy("__lf_range", "piece").agg(F.min(spot).alias("low"), F.max(spot).alias("high"))
    bounds = bounds.groupBy("__lf_range").agg(F.sort_array(F.collect_list(F.struct("low", "high"))).alias("__lf_bounds"))
    rows = rows.join(land(bounds, "sketch_bounds"), "__lf_range")
    pieces = F.size("__lf_bounds")
    rows = rows.withColumn("__lf_piece", last_not_above(F.col("__lf_bounds.low"), spot, pieces, 31))
    return rows.withColumns({"__lf_pieces": pieces, "__lf_head": F.get(F.col("__lf_bounds.high"), F.col("__lf_piece")) == spot}).drop("__lf_bounds")


def with_next(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Adds ``next_<column>`` of the next row by descending ``doc_id`` (after the last: the
    first).  NULL ids come last; ties and NULL ids go by the row keys.

    Positions (ids, and the row keys of NULL ids) are cut into ranges; a window runs inside a
    range, and the first row of each range also visits the range before it, as the neighbour of
    the last row there.  So rows move once, and no window holds more than a range.  Beyond
    ``MOST_CUTS * ROWS_PER_RANGE`` rows the ranges are cut a second time.  Only rows of one id,
    or identical ones, always share a range."""
    spark = rows.sparkSession
    rows = rows.withColumn("__lf_tie", F.when(F.isnull("doc_id"), F.bitwise_not(F.col(KEY1))))  # descending ties are ascending keys
    spread = 4 * shuffle_partitions(spark)
    ids, many_ids = cut(rows.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("at")), spread)
    ties, many_ties = cut(rows.where("doc_id IS NULL").select(F.col("__lf_tie").alias("at")), spread)
    names, n = [f"next_{c}" for c in columns], len(ids) + len(ties)
    rows = place(rows, ids, ties)
    if many_ids or many_ties:
        rows = refine(rows)
    else:
        rows = rows.withColumns({"__lf_piece": F.lit(0), "__lf_pieces": F.lit(1)})
    last_piece = F.col("__lf_piece") + 1 == F.col("__lf_pieces")
    home = F.struct(F.col("__lf_range").alias("r"), F.col("__lf_piece").alias("p"), F.lit(False).alias("g"))
    visit = F.struct(F.when(last_piece, F.pmod(F.col("__lf_range") + 1, F.lit(max(n, 1)))).otherwise(F.col("__lf_range")).alias("r"),
                     F.when(last_piece, F.lit(0)).otherwise(F.col("__lf_piece") + 1).alias("p"), F.lit(True).alias("g"))
    rows = rows.withColumn("__lf_at", F.explode(F.when(F.col("__lf_head"), F.array(home, visit)).otherwise(F.array(home))))
    rows = rows.withColumns({"__lf_range": F.col("__lf_at.r"), "__lf_piece": F.col("__lf_at.p"), "__lf_guest": F.col("__lf_at.g")}).drop("__lf_at")
    window = Window.partitionBy("__lf_range", "__lf_piece").orderBy("__lf_guest", F.isnull("doc_id"), F.desc("doc_id"), KEY1, KEY2)
    # Plain columns: a struct of them would be one more copy of each row in the shuffle.
    rows = rows.withColumns({name: F.lead(c).over(window) for name, c in zip(names, columns)})
    return rows.where("NOT __lf_guest").drop("__lf_range", "__lf_piece", "__lf_pieces", "__lf_head", "__lf_tie", "__lf_guest")


def fingerprints(docs: DataFrame, words: int = WORDS, scale: int = SCALE,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, sketch`` and the row keys; NULL is the empty text, with an empty sketch."""
    rows = keyed(docs).select(KEY1, KEY2, F.col(f"`{id_col}`").alias("doc_id"), text_of(text_col).alias("text"))
    return with_sketch(rows, "text", "sketch", words, scale)


def edited_fingerprints(docs: DataFrame, words: int = WORDS, scale: int = SCALE,
                        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of each text, of its edited form and their likeness.

    The edited text has its last ``floor(n / 2)`` code points replaced by the first as many (or
    all) of the next document's, by descending id.  ``near_edited`` and ``near_next`` are the
    containment of the text in the edited one and in the next document.  A lone row is its own
    neighbour; an empty table gives an empty result; ties and NULL ids go by the row keys.  A very
    long text is one row, with a sketch in proportion; columns other than the two named only count
    for the row keys, whatever their names."""
    rows = with_next(fingerprints(docs, words, scale, id_col, text_col), ["text", "sketch"])
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    kept = F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half)
    rows = rows.withColumn("edited", F.concat(kept, F.substring("next_text", F.lit(1), half)))
    rows = with_sketch(rows, "edited", "edited_sketch", words, scale)
    rows = contained(rows, "sketch", "text", "edited_sketch", "edited", "near_edited", words, scale)
    rows = contained(rows, "sketch", "text", "next_sketch", "next_text", "near_next", words, scale)
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"), "near_edited", "near_next")
