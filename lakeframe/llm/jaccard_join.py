"""N-gram Jaccard join with adaptive multi-match prefixes.

Two sets whose Jaccard similarity is t or more share at least l of the first
``n - ceil(t n) + l`` tokens of each, in any order common to both; the smaller l of the two counts.
Tokens go rarest first.  Each document lengthens its prefix by estimated cost: a longer prefix
visits more lists but asks for more shared tokens before a pair is verified.

1. Shingle counts are estimated over all documents in ``CELLS`` counters (a table of fixed size
   that only orders tokens and weighs costs; whether a pair is found does not depend on it).
2. Equal sets become one node: its size, l, prefix and a bitmap of 512 parities.
3. Lists of nodes by prefix token; what has no neighbour of fitting size goes.  Sorting by
   range cuts a frequent token's list over many tasks, and long lists are compared in blocks.
4. First round: each node and its nearest plausible predecessor in each list (the differing
   parities bound the differing tokens).  Plausible pairs that share l prefix tokens are
   verified on the whole sets, and components taken.
5. Second round: all plausible pairs of a list between different components.  So a group of
   copies costs as many pairs as it has members, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import KEY1, KEY2, keyed, land, shuffle_partitions, text_of
from .simhash import components

CELL_BITS = 20
LEVELS = (1, 2, 3, 4, 6, 8)  # l to choose from
VERIFY = 4.0  # cost of verifying a pair, in list entries
PARITY_WORDS = 8  # of 64 bits
BLOCK = 4096  # entries of a list that are compared in one piece
_BITS = [f"b{i}" for i in range(PARITY_WORDS)]


# --- sets -------------------------------------------------------------------------------

def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class _WordHashes(dict):
    """Hashes of words seen lately."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1 << 18:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word, 11)
        return found


_HASH_OF = _WordHashes()


def shingle_stream(text: str | None, words: int = 3) -> np.ndarray:
    """64-bit hashes of the shingles, repeats included; a text of fewer words is one shingle,
    one without words has none."""
    each = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII white space
    h = np.fromiter(map(_HASH_OF.__getitem__, each), np.uint64, len(each))
    size = min(words, len(h))
    if not size:
        return h
    out = np.full(len(h) - size + 1, size, np.uint64)
    for i in range(size):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i:i + len(out)])
    return out


def shingle_set(text: str | None, words: int = 3) -> np.ndarray:
    return np.unique(shingle_stream(text, words))


def least_own(n, percent: int):
    """Fewest tokens a set of ``n`` shares with any partner: ceil(percent n / 100)."""
    return -(-percent * n // 100)


def linked(both: int, n_a: int, n_b: int, percent: int) -> bool:
    return 100 * both >= percent * (n_a + n_b - both)


# --- counts and prefixes ----------------------------------------------------------------

def _cell_batches(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, fresh, held = np.zeros(1 << CELL_BITS, np.int64), [], 0

        def fold() -> None:
            if fresh:
                total[:] += np.bincount(np.concatenate(fresh) >> np.uint64(64 - CELL_BITS), minlength=1 << CELL_BITS)
                fresh.clear()

        for batch in batches:
            for text in batch.column(0):
                found = shingle_stream(text.as_py(), words)
                fresh.append(found)
                held += len(found)
                if held > 1 << 21:
                    fold()
                    held = 0
        fold()
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(total[cells])], names=["cell", "n"])
    return run


def token_counts(rows: DataFrame, words: int) -> np.ndarray:
    """Counters of all shingles by the upper bits of their hash; a table of fixed size."""
    found = rows.select("text").mapInArrow(_cell_batches(words), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << CELL_BITS, np.int64)
    out[found["cell"].to_numpy()] = found["n"].to_numpy()
    return out


def choose_prefix(tokens: np.ndarray, counts: np.ndarray, usual: float, percent: int) -> tuple[int, np.ndarray]:
    """``(l, prefix)`` of least estimated cost.  The prefix's list entries are all visited, and at
    most a share of 1 / l of them are candidates that share l tokens."""
    n = len(tokens)
    free = n - int(least_own(n, percent))
    found = counts[(tokens >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
    order = np.lexsort((tokens, found))
    visited = np.cumsum(np.maximum(found[order[:free + LEVELS[-1]]] - usual, 1.0))
    fit = [x for x in LEVELS if free + x <= n] or [1]
    level = min(fit, key=lambda x: visited[min(free + x, n) - 1] * (1 + VERIFY / x))
    return level, tokens[order[:free + level]]


def parities(tokens: np.ndarray) -> np.ndarray:
    """Parity of the number of tokens in each of 512 classes: sets that differ in d tokens differ
    in at most d parities."""
    many = np.bincount((tokens & np.uint64(64 * PARITY_WORDS - 1)).astype(np.int64), minlength=64 * PARITY_WORDS)
    return np.packbits((many & 1).astype(np.uint8), bitorder="little").view("<u8")


def _node_batches(words: int, percent: int, table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = table.value
        usual = float(counts.mean())
        for batch in batches:
            n, d1, d2, level, prefix, bits = [], [], [], [], [], []
            for text in batch.column("text"):
                s = shingle_set(text.as_py(), words)
                n.append(len(s))
                d1.append(int(_mix(s).sum(dtype=np.uint64)))
                d2.append(int(_mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)))
                own, tokens = choose_prefix(s, counts, usual, percent) if len(s) else (0, s)
                level.append(own), prefix.append(tokens.view("<i8")), bits.append(parities(s))
            bits = np.array(bits, dtype="<u8").reshape(-1, PARITY_WORDS).view("<i8")
            signed = [pa.array(np.array(d, dtype="<u8").view("<i8")) for d in (d1, d2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(KEY1), batch.column(KEY2), batch.column("doc_id"), pa.array(n, pa.int64()), *signed, pa.array(level, pa.int32()),
                 pa.array(prefix, pa.list_(pa.int64())), *(pa.array(np.ascontiguousarray(bits[:, i])) for i in range(PARITY_WORDS))],
                names=[KEY1, KEY2, "doc_id", "n", "d1", "d2", "level", "prefix", *_BITS])
    return run


# --- lists ------------------------------------------------------------------------------

def _neighbour_batches(percent: int):
    """Input sorted by (token, n, node) inside the partition; keeps entries with a neighbour of
    fitting size in the same list, and those at the partition's edges."""
    names = ["token", "node", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows: the entry whose right neighbour is still to come, behind one that has been decided
        rows, decided, first = [np.empty(0, "<i8")] * 3, 0, True
        for batch in batches:
            rows = [np.concatenate([r, batch.column(c).to_numpy()]) for r, c in zip(rows, names)]
            token, _, n = rows
            if len(token) < 2:
                continue
            near = (token[1:] == token[:-1]) & (100 * n[:-1] >= percent * n[1:])
            kept = np.append(first, near) | np.append(near, False)
            kept[:decided], kept[-1], first = False, False, False
            yield pa.RecordBatch.from_arrays([pa.array(r[kept]) for r in rows], names=names)
            rows, decided = [r[-2:] for r in rows], 1
        if len(rows[0]):
            yield pa.RecordBatch.from_arrays([pa.array(r[-1:]) for r in rows], names=names)
    return run


def _differing(bits: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    out = np.zeros(len(i), np.int64)
    for word in bits:
        out += np.bitwise_count(word[i] ^ word[j])
    return out


def _plausible(bucket: np.ndarray, n: np.ndarray, bits: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (later, earlier) of entries of a bucket, sorted by n, whose sizes and parities allow a
    link; nearest first."""
    at, step = np.arange(1, len(bucket)), 1
    while len(at):
        before = at - step
        fits = (before >= 0) & (bucket[at] == bucket[before]) & (100 * n[before] >= percent * n[at])
        at, before = at[fits], before[fits]  # sizes fall, so who fails now fails from here on
        near = _differing(bits, at, before) * (100 + percent) <= (n[at] + n[before]) * (100 - percent)
        if near.any():
            yield at[near], before[near]
        step += 1


def _distinct(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    low, high = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((high, low))
    low, high = low[order], high[order]
    fresh = np.append(True, (low[1:] != low[:-1]) | (high[1:] != high[:-1]))[:len(low)]
    return pa.RecordBatch.from_arrays([pa.array(low[fresh]), pa.array(high[fresh])], names=["a", "b"])


def _list_batches(percent: int, rooted: bool):
    """Input sorted by (bucket, n).  Unrooted: each entry with a plausible partner, beside its
    nearest plausible predecessor or else itself.  Rooted: all plausible pairs between different roots."""
    names = ["bucket", "node", "n", *_BITS] + (["root"] if rooted else [])

    def pairs(rows: list[np.ndarray]) -> pa.RecordBatch:
        bucket, node, n = rows[:3]
        bits = [b.view("<u8") for b in rows[3:3 + PARITY_WORDS]]
        if rooted:
            root, a, b = rows[-1], [], []
            for i, j in _plausible(bucket, n, bits, percent):
                other = root[i] != root[j]
                a.append(node[j][other]), b.append(node[i][other])
            return _distinct(*(np.concatenate([np.empty(0, "<i8"), *x]) for x in (a, b)))
        partner, touched = np.full(len(node), -1, np.int64), np.zeros(len(node), bool)
        for i, j in _plausible(bucket, n, bits, percent):
            fresh = partner[i] < 0
            partner[i[fresh]] = j[fresh]
            touched[i], touched[j] = True, True
        none = partner < 0
        return _distinct(node[touched], np.where(none, node, node[partner])[touched])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, "<i8")] * len(names)
        for batch in batches:
            held = [np.concatenate([h, batch.column(c).to_numpy()]) for h, c in zip(held, names)]
            stop = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0  # an open bucket waits for its end
            if stop:
                yield pairs([h[:stop] for h in held])
                held = [h[stop:] for h in held]
        if len(held[0]):
            yield pairs(held)
    return run


def _in_buckets(lists: DataFrame) -> DataFrame:
    """Adds ``bucket``.  A list of over ``BLOCK`` entries is cut by a hash of the node, and every two
    of its slices meet in a bucket."""
    long = lists.groupBy("token").count().where(F.col("count") > BLOCK).withColumn("slices", F.ceil(F.col("count") / (BLOCK // 2)).cast("int"))
    marked = lists.join(long.select("token", "slices"), "token", "left")
    own = F.pmod(F.xxhash64("node"), F.col("slices").cast("long")).cast("int")
    keys = F.transform(F.sequence(F.lit(0), F.col("slices") - 1), lambda j: F.xxhash64("token", F.least(own, j), F.greatest(own, j)))
    marked = marked.withColumn("bucket", F.explode(F.when(F.col("slices").isNull(), F.array(F.xxhash64("token"))).otherwise(keys)))
    return marked.select("bucket", "node", "n", *_BITS)


# --- verification -----------------------------------------------------------------------

def _verify_batches(words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[str, tuple[int, np.ndarray]] = {}

        def set_of(side: str, node: int, text) -> np.ndarray:
            if last.get(side, (None, None))[0] != node:
                last[side] = node, shingle_set(text.as_py(), words)
            return last[side][1]

        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            good = []
            for i in range(batch.num_rows):
                x, y = set_of("a", a[i], batch.column("text_a")[i]), set_of("b", b[i], batch.column("text_b")[i])
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(linked(both, len(x), len(y), percent))
            kept = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(kept) for c in ("a", "b")], names=["a", "b"])
    return run


def verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs that share enough prefix tokens and whose whole sets are similar enough."""
    side = {s: texts.select(F.col("node").alias(s), F.col("text").alias(f"text_{s}"), F.col("prefix").alias(f"prefix_{s}"), F.col("level").alias(f"level_{s}"))
            for s in ("a", "b")}
    both = pairs.join(side["a"], "a").join(side["b"], "b")
    shared: Column = F.size(F.array_intersect("prefix_a", "prefix_b"))
    both = both.where(shared >= F.least("level_a", "level_b")).select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_verify_batches(words, percent), "a long, b long")


def _nodes(spark: SparkSession, rows: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    table = spark.sparkContext.broadcast(token_counts(rows, words))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    bits = ", ".join(f"{b} long" for b in _BITS)
    sets = land(rows.mapInArrow(_node_batches(words, percent, table), (
        f"{KEY1} long, {KEY2} long, doc_id {id_type}, n long, d1 long, d2 long, level int, prefix array<long>, {bits}")), "jaccard_sets")
    first = F.min(F.struct(F.isnull("doc_id").alias("no_id"), F.col("doc_id"), F.col(KEY1), F.col(KEY2))).alias("best")
    # Equal sets have equal prefixes and parities, so any will do.
    nodes = sets.where("n > 0").groupBy("n", "d1", "d2").agg(first, *[F.first(c).alias(c) for c in ("level", "prefix", *_BITS)])
    return sets, land(nodes.withColumn("node", F.monotonically_increasing_id()), "jaccard_nodes")


def jaccard_links(rows: DataFrame, nodes: DataFrame, words: int, percent: int) -> DataFrame:
    """``(a, b)``: verified links between nodes, enough of them to connect whatever is linked."""
    spark = rows.sparkSession
    entries = nodes.select(F.explode("prefix").alias("token"), "node", "n")
    entries = entries.repartitionByRange(shuffle_partitions(spark), "token", "n", "node").sortWithinPartitions("token", "n", "node")
    lists = land(entries.mapInArrow(_neighbour_batches(percent), "token long, node long, n long"), "jaccard_lists")
    lists = land(_in_buckets(lists.join(nodes.select("node", *_BITS), "node")), "jaccard_buckets")
    by_bucket = lambda df: df.repartition(shuffle_partitions(spark), "bucket").sortWithinPartitions("bucket", "n", "node")
    near = land(by_bucket(lists).mapInArrow(_list_batches(percent, False), "a long, b long").distinct(), "jaccard_near")
    wanted = near.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(
        nodes.select("node", "level", "prefix", F.col(f"best.{KEY1}").alias(KEY1), F.col(f"best.{KEY2}").alias(KEY2)), "node")
    texts = land(rows.select(KEY1, KEY2, "text").join(wanted, [KEY1, KEY2]).dropDuplicates(["node"])
                 .select("node", "level", "prefix", "text"), "jaccard_texts")
    first = land(verified(near.where("a < b"), texts, words, percent), "jaccard_first")
    tree = components(first, name="jaccard_first_components")
    rooted = lists.join(tree.withColumnRenamed("node", "own"), F.col("node") == F.col("own"), "left")
    rooted = rooted.select("bucket", "node", "n", *_BITS, F.coalesce("root", "node").alias("root"))
    across = by_bucket(rooted).mapInArrow(_list_batches(percent, True), "a long, b long").distinct()
    across = across.join(near, ["a", "b"], "left_anti")  # what the first round has looked at
    second = land(verified(across, texts, words, percent), "jaccard_second")
    return first.unionByName(second)


def jaccard_join(docs: DataFrame, words: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id`` and the row keys.

    A-Z is lower-cased, words are ``[^\\x20\\x09-\\x0D]+``, a set holds the distinct shingles of
    ``words`` words (fewer words: the whole sequence).  Sets link when 100 times the intersection
    is ``percent`` times the union or more.  ``component_id`` is the smallest id reachable (NULL ids
    last), the row's own where it links with nothing.  NULL, empty and wordless texts have an
    empty set and link with nothing, each other included.  Very long texts count whole.  Repeated
    rows are equal sets.  Extra columns play no part, whatever their names.  An empty table
    gives an empty result.  Shingles are told apart by 64-bit hashes, equal sets by their size and
    two 64-bit sums."""
    if not 50 <= percent <= 100:
        raise ValueError("percent is 50 to 100")
    rows = keyed(docs).select(KEY1, KEY2, F.col(f"`{id_col}`").alias("doc_id"), text_of(text_col).alias("text"))
    sets, nodes = _nodes(docs.sparkSession, rows, words, percent)
    tree = components(jaccard_links(rows, nodes, words, percent), name="jaccard_components")
    named = nodes.select("n", "d1", "d2", "node", "best").join(tree.withColumnRenamed("node", "own"), F.col("node") == F.col("own"), "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    firsts = named.groupBy("root").agg(F.min("best").alias("first"))
    named = named.join(firsts, "root").select("n", "d1", "d2", F.col("first.doc_id").alias("component_id"), "root")
    out = sets.select(KEY1, KEY2, "doc_id", "n", "d1", "d2").join(named, ["n", "d1", "d2"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), KEY1, KEY2)


ORACLE = r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS MATERIALIZED (
  SELECT r, doc_id, CASE WHEN len(words) = 0 THEN []
    ELSE list_distinct([array_to_string(words[i:i + 2], ' ') FOR i IN range(1, greatest(len(words) - 2, 1) + 1)]) END AS tokens FROM w),
t AS MATERIALIZED (SELECT r, len(tokens) AS n, unnest(tokens) AS token FROM s),
links AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b FROM t a JOIN t b ON a.token = b.token AND a.r < b.r
  WHERE 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(r, other) AS (SELECT r, r FROM s UNION SELECT reach.r, both_ways.b FROM reach JOIN both_ways ON reach.other = both_ways.a)
SELECT s.doc_id, len(s.tokens) AS n_shingles, min(o.doc_id) AS component_id
FROM s JOIN reach USING (r) JOIN s o ON o.r = reach.other GROUP BY s.r, s.doc_id, s.tokens
"""
