"""SimHash near-dedup by bit-sliced comparison.

1. Each text becomes one 64-bit fingerprint (word shingles, XXH64 seed 42, majority per bit).
2. Equal fingerprints collapse to one node.
3. Two fingerprints within 2 bits agree on at least two of four 16-bit blocks, so each node
   goes to six buckets (one per pair of blocks).  A bucket beyond ``BUCKET_ROWS`` nodes is
   split again by the 32 bits that are left (two of four 8-bit blocks), after which at most
   2**16 different fingerprints can share a bucket.  No pair is lost.
4. Inside a bucket bit planes are stored vertically: bit b of 64 fingerprints is one machine
   word.  A query XORs its bit into each plane and adds the result to carry-save counters;
   lanes beyond the radius are marked, and a block (a word and a query) is abandoned once all
   its lanes are, the query's own lane and those before it aside.
5. Components of the links by alternating large-star / small-star rounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import COPIES, KEY1, KEY2, keyed, land, shuffle_partitions

SEED = 42
BUCKET_ROWS = 4096
QUERY_BLOCK = 256


# --- fingerprints -----------------------------------------------------------------------

def shingle_hashes(text: str | None, words_per_shingle: int) -> list[int]:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes.lower/split: ASCII only
    if not words:
        return []
    joined, n = b" ".join(words), words_per_shingle
    if len(words) <= n:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    ends = list(accumulate(map(len, words), lambda at, size: at + size + 1))
    starts = [0, *(e + 1 for e in ends)]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[s:e], SEED) for s, e in zip(starts, ends[n - 1:])]


def fingerprint(text: str | None, words_per_shingle: int = 3) -> int:
    """Bit is 1 if set in over half of the shingle hashes; no word at all gives 0."""
    hashes = shingle_hashes(text, words_per_shingle)
    if not hashes:
        return 0
    planes = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    counts = np.unpackbits(planes, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def _fingerprint_batches(words_per_shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), words_per_shingle) for t in batch.column("text")]
            values = pa.array(np.array(found, dtype="<u8").view("<i8"))
            yield pa.RecordBatch.from_arrays([batch.column(KEY1), batch.column(KEY2), batch.column("doc_id"), values],
                                             names=[KEY1, KEY2, "doc_id", "fp"])
    return run


# --- bit-sliced comparison --------------------------------------------------------------

def bit_planes(values: np.ndarray) -> np.ndarray:
    """(64, words) uint64: row b holds bit b of all values, 64 values to a word."""
    bits = np.unpackbits(np.ascontiguousarray(values, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    pad = -packed.shape[1] % 8
    return np.ascontiguousarray(np.pad(packed, ((0, 0), (0, pad)))).view("<u8")


def _beyond(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose bit-sliced count exceeds ``radius``."""
    above, equal = np.zeros_like(counters[0]), ~np.zeros_like(counters[0])
    for i in reversed(range(len(counters))):
        if radius >> i & 1:
            equal &= counters[i]
        else:
            above |= equal & counters[i]
            equal &= ~counters[i]
    return above


FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
LOOK_EVERY = 4  # planes after which dead blocks are looked for


def lanes_up_to(last: np.ndarray, words: int, n: int) -> np.ndarray:
    """(queries, words) uint64 of the lanes 0 to ``last`` of each query and of those from ``n`` on."""
    first = np.arange(words, dtype=np.int64) * 64
    count = np.clip(last[:, None] + 1 - first[None, :], 0, 64).astype(np.uint64)
    low = np.where(count == 64, FULL, (np.uint64(1) << (count & np.uint64(63))) - np.uint64(1))
    held = np.clip(n - first, 0, 64).astype(np.uint64)
    return low | ~np.where(held == 64, FULL, (np.uint64(1) << (held & np.uint64(63))) - np.uint64(1))


def within(planes: np.ndarray, queries: np.ndarray, radius: int, skip: np.ndarray | None = None, worked: list | None = None) -> np.ndarray:
    """(queries, words) uint64 of lanes within ``radius`` bits of each query, without those of ``skip``.

    A block is 64 lanes and one query; it is abandoned once all its lanes are beyond the radius
    or skipped.  Planes in which all lanes and queries agree say nothing and are passed over.
    ``worked`` gets the number of blocks left at each plane worked through."""
    shape = (len(queries), planes.shape[1])
    dead = np.zeros(shape, "<u8") if skip is None else skip.copy()
    q, w = np.nonzero(dead != FULL)
    dead = dead[q, w]
    counters = [np.zeros(len(q), "<u8") for _ in range((radius + 1).bit_length())]
    bits = [queries >> np.uint64(b) & np.uint64(1) for b in range(64)]
    looked = 0
    for b in range(64):
        if not len(q):
            break
        ones = int(bits[b].sum())
        if (ones == 0 and not planes[b].any()) or (ones == len(queries) and (planes[b] == FULL).all()):
            continue
        if worked is not None:
            worked.append(len(q))
        carry = planes[b][w] ^ np.where(bits[b][q] == 1, FULL, np.uint64(0))
        for i, c in enumerate(counters):
            counters[i], carry = c ^ carry, c & carry
        dead |= carry | _beyond(counters, radius)
        looked += 1
        if looked % LOOK_EVERY == 0:
            left = dead != FULL
            if not left.all():
                q, w, dead = q[left], w[left], dead[left]
                counters = [c[left] for c in counters]
    out = np.zeros(shape, "<u8")
    out[q, w] = ~dead
    return out


def _lanes(mask: np.ndarray, n: int) -> np.ndarray:
    return np.unpackbits(mask.view(np.uint8), axis=1, bitorder="little")[:, :n]


def _bucket_links(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links inside one bucket (so its size is that of the bucket)."""
    planes, parent = bit_planes(values), list(range(len(values)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    for at in range(0, len(values), QUERY_BLOCK):
        queries = values[at:at + QUERY_BLOCK]
        # a query is a lane itself, and links to lanes before it have been looked for
        known = lanes_up_to(at + np.arange(len(queries)), planes.shape[1], len(values))
        near = _lanes(within(planes, queries, radius, known), len(values))
        for q, j in zip(*np.nonzero(near)):
            a, b = find(at + int(q)), find(int(j))
            if a != b:
                parent[b] = a
                out.append((at + int(q), int(j)))
    return out


def _short_run_links(values: np.ndarray, run: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links inside many short runs at once: lane i compares value i with value i + step."""
    step = 1
    while True:
        left = np.nonzero(run[step:] == run[:-step])[0] if step < len(run) else np.array([], dtype=int)
        if not len(left):
            return
        a, b = values[left], values[left + step]
        lanes = _lanes(within(bit_planes(a ^ b), np.zeros(1, "<u8"), radius), len(left))[0].astype(bool)
        yield a[lanes], b[lanes]
        step += 1


def _compare_batches(radius: int):
    """Input: (bucket, fp) sorted by bucket inside the partition; output: links."""
    def links(bucket: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
        cuts = np.nonzero(np.diff(bucket))[0] + 1
        starts, ends = np.append(0, cuts), np.append(cuts, len(bucket))
        size = ends - starts
        short = np.repeat((size > 1) & (size <= 32), size)
        run = np.repeat(np.arange(len(size)), size)
        pairs = list(_short_run_links(values[short], run[short], radius))
        for s, e in zip(starts[size > 32], ends[size > 32]):
            part = values[s:e]
            found = np.array(_bucket_links(part, radius), dtype=int).reshape(-1, 2)
            pairs.append((part[found[:, 0]], part[found[:, 1]]))
        if pairs:
            a, b = (np.concatenate([p[i] for p in pairs]).view("<i8") for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, values = np.array([], "<i8"), np.array([], "<u8")
        for batch in batches:
            bucket = np.concatenate([bucket, batch.column("bucket").to_numpy()])
            values = np.concatenate([values, batch.column("fp").to_numpy().view("<u8")])
            last = np.searchsorted(bucket, bucket[-1]) if len(bucket) else 0  # an open run waits for its end
            if last:
                yield from links(bucket[:last], values[:last])
                bucket, values = bucket[last:], values[last:]
        if len(bucket):
            yield from links(bucket, values)
    return run


def _pair_keys(bits: list[int], width: int) -> list:
    """Bucket keys of a fingerprint: each two of the blocks that start at ``bits``."""
    mask = F.lit((1 << width) - 1).cast("long")
    block = [F.shiftrightunsigned("fp", b).bitwiseAND(mask) for b in bits]
    return [F.struct(F.lit(i).alias("pair"), (F.shiftleft(block[x], width).bitwiseOR(block[y])).alias("key"))
            for i, (x, y) in enumerate(combinations(range(len(bits)), 2))]


BLOCKS = [0, 16, 32, 48]


def simhash_links(nodes: DataFrame, radius: int = 2) -> DataFrame:
    """Links ``(a, b)`` between the distinct fingerprints of ``nodes`` (column ``fp``), enough
    of them to connect whatever lies within ``radius`` bits; radius is 2 at most, which is
    what two of four equal blocks guarantee."""
    if not 0 <= radius <= 2:
        raise ValueError("the bucket scheme covers a radius of 0 to 2 bits")
    spark = nodes.sparkSession
    wide = nodes.select("fp", F.explode(F.array(*_pair_keys(BLOCKS, 16))).alias("k")).select("fp", "k.pair", "k.key")
    hot = wide.groupBy("pair", "key").count().where(F.col("count") > BUCKET_ROWS).withColumnRenamed("count", "many")
    marked = wide.join(hot, ["pair", "key"], "left")
    flat = marked.where("many IS NULL").select("fp", F.xxhash64("pair", "key").alias("bucket"))
    # Split a large bucket by two of the four 8-bit blocks its key leaves open.
    split = None
    for i, (x, y) in enumerate(combinations(range(4), 2)):
        rest = [b + s for j, b in enumerate(BLOCKS) if j not in (x, y) for s in (0, 8)]
        part = (marked.where((F.col("pair") == i) & F.col("many").isNotNull())
                .select("fp", "pair", "key", F.explode(F.array(*_pair_keys(rest, 8))).alias("k")))
        split = part if split is None else split.unionByName(part)
    flat = flat.unionByName(split.select("fp", F.xxhash64("pair", "key", "k.pair", "k.key").alias("bucket")))
    n = shuffle_partitions(spark)
    return flat.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(_compare_batches(radius), "a long, b long")


# --- components -------------------------------------------------------------------------

def components(links: DataFrame, a: str = "a", b: str = "b", name: str = "components") -> DataFrame:
    """``(node, root)`` for every node that has a link; root is the smallest node of its
    component.  Alternates large-star and small-star rounds until no link changes; each round
    is landed, so lineage stays short and a lost executor costs one round at most."""
    links = links.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).where("v > u").distinct()
    links, before = land(links, name), None
    while True:
        both = links.unionByName(links.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = both.groupBy("v").agg(F.min("u").alias("low")).withColumn("low", F.least("v", "low"))
        large = both.join(low, "v").where("u > v").select(F.col("u").alias("v"), F.col("low").alias("u")).distinct()
        large = land(large, name)
        low = large.groupBy("v").agg(F.min("u").alias("low"))
        small = large.join(low, "v").select("u", "low").where("u > low").select(F.col("u").alias("v"), F.col("low").alias("u"))
        links = land(small.unionByName(low.select("v", F.col("low").alias("u"))).distinct(), name)
        now = tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())
        if now == before:
            return links.select(F.col("v").alias("node"), F.col("u").alias("root"))
        before = now


def simhash_dedup(docs: DataFrame, words_per_shingle: int = 3, radius: int = 2,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint`` (16 hex digits), ``component_id``,
    ``group_size``, ``kept`` and the row keys.

    A-Z is lower-cased, words are ``[^\\x20\\x09-\\x0D]+``.  NULL and empty texts have
    fingerprint zero and link like any other.  ``component_id`` is the smallest id reachable
    (NULL ids last); one row of each component is ``kept``: the one with the smallest id, then,
    of repeated rows, any one.  An empty table gives an empty result."""
    rows = keyed(docs).select(KEY1, KEY2, F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    rows = rows.mapInArrow(_fingerprint_batches(words_per_shingle), f"{KEY1} long, {KEY2} long, doc_id {id_type}, fp long")
    rows = land(rows.withColumn("row", F.monotonically_increasing_id()), "simhash_rows")
    best = F.struct(F.isnull("doc_id").alias("no_id"), F.col("doc_id"), F.col("row"))
    nodes = land(rows.groupBy("fp").agg(F.min(best).alias("best"), F.count(F.lit(1)).alias("n")), "simhash_nodes")
    tree = components(simhash_links(nodes, radius), name="simhash_components")
    rooted = nodes.join(tree, nodes["fp"] == tree["node"], "left").select("fp", "best", "n", F.coalesce("root", "fp").alias("root"))
    groups = rooted.groupBy("root").agg(F.min("best").alias("first"), F.sum("n").alias("group_size"))
    named = rooted.select("fp", "root").join(groups, "root").select("fp", "first", "group_size")
    return rows.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first.doc_id").alias("component_id"),
        "group_size", (F.col("row") == F.col("first.row")).alias("kept"), KEY1, KEY2)


def kept_copies(found: DataFrame) -> DataFrame:
    """Row keys of the rows that stay, one copy each, for ``emit_copies``."""
    return found.where("kept").groupBy(KEY1, KEY2).agg(F.lit(1).cast("long").alias(COPIES))
