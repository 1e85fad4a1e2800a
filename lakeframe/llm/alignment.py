"""Cross-tokenizer alignment by pointer jumping.

Two tokenizations of the same bytes overlap in components.  Every token points to its
farthest-right overlapping token; doubling the successors (``p = p[p]``) until nothing changes
leaves every token at its component's terminal token, which labels the group.  Texts are
encoded once, in Arrow batches, and their ids landed; the links' id pairs are counted over the
corpus by Spark, and a second pass over the landed ids looks the counts up: the most frequent
``TABLE`` pairs in a broadcast table, all others through a join.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import land, text_of
from .packing import _byte_alphabet, tokenizer

TABLE = 1 << 20  # id pairs in the broadcast table: 16 MB at most
CHUNK_BYTES = 1 << 20  # texts are worked on together up to this many bytes, a longer one alone
FLUSH = 1 << 21  # distinct id pairs that a counting task holds


# --- vocabularies -----------------------------------------------------------------------

class Vocabularies:
    """Encoders and token bytes of the byte-level vocabulary (A) and the piece vocabulary (B)."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a = tokenizer(a_path).fast  # plain text only: strings of special tokens are text
        plain = _byte_alphabet()
        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)["model"]["vocab"]
        self.a_bytes = [b""] * (max(spec.values()) + 1)
        for piece, i in spec.items():
            self.a_bytes[i] = bytes(plain[c] for c in piece) if all(c in plain for c in piece) else piece.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.a_length = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_length = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        self.a_flat, self.b_flat = (np.frombuffer(b"".join(x), np.uint8) for x in (self.a_bytes, self.b_bytes))
        self.a_start, self.b_start = (np.cumsum(x) - x for x in (self.a_length, self.b_length))
        most = max(len(self.a_bytes), len(self.b_bytes))
        decimal = [str(i).encode() for i in range(most)]
        self.shown = [d + end for end in (b",", b"|", b";") for d in decimal]
        self.most = most
        if most > 1 << 16:
            raise ValueError("ids are kept in 16 bits")

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both, one text after the other, and their numbers per text; a text has none where
        their bytes differ from space and text."""
        spaced = [" " + t if t else "" for t in texts]
        wholes = [x.encode() for x in spaced]
        a = [self.a.encode_ordinary(x) if x else () for x in spaced]
        b = [self.b.encode(t) if t else () for t in texts]
        a_ids, b_ids = (np.fromiter(chain.from_iterable(ids), np.int64, sum(map(len, ids))) for ids in (a, b))
        n_a, n_b = (np.array([len(x) for x in ids], dtype=np.int64) for ids in (a, b))
        size, whole = np.array([len(x) for x in wholes], dtype=np.int64), np.frombuffer(b"".join(wholes), np.uint8)
        good = np.ones(len(texts), bool)
        for ids, n, length, start, flat in ((a_ids, n_a, self.a_length, self.a_start, self.a_flat),
                                            (b_ids, n_b, self.b_length, self.b_start, self.b_flat)):
            good &= _same_bytes(ids, n, length[ids], start, flat, whole, size)
        if not good.all():
            a_ids, b_ids = a_ids[np.repeat(good, n_a)], b_ids[np.repeat(good, n_b)]
            n_a, n_b = n_a * good, n_b * good
        return a_ids, b_ids, n_a, n_b


def _same_bytes(ids: np.ndarray, n: np.ndarray, length: np.ndarray, start: np.ndarray, flat: np.ndarray, whole: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which texts' joined token bytes are the text's own: ``n`` tokens and ``size`` bytes of ``whole`` each."""
    ends = np.append(0, np.cumsum(length))
    stop = np.cumsum(n)
    good = ends[stop] - ends[stop - n] == size
    if not good.all():  # the others are compared without them
        ids, length = (x[np.repeat(good, n)] for x in (ids, length))
        whole = whole[np.repeat(good, size)]
    first = np.cumsum(length) - length
    differs = np.flatnonzero(flat[np.repeat(start[ids] - first, length) + np.arange(len(whole))] != whole)
    if len(differs):
        kept = np.flatnonzero(good)
        good[kept[np.searchsorted(np.cumsum(size[kept]), differs, "right")]] = False
    return good


_LOADED: dict[tuple[str, str], Vocabularies] = {}


def vocabularies(a_path: str, b_path: str) -> Vocabularies:
    if (a_path, b_path) not in _LOADED:
        _LOADED[a_path, b_path] = Vocabularies(a_path, b_path)
    return _LOADED[a_path, b_path]


# --- alignment --------------------------------------------------------------------------

@dataclass
class Spans:
    """Token ends of two tilings of the same bytes, and for each byte offset how many tokens of
    either end before it (so: the token that covers the byte before the offset)."""

    a_end: np.ndarray
    b_end: np.ndarray
    a_mark: np.ndarray
    b_mark: np.ndarray
    a_before: np.ndarray
    b_before: np.ndarray

    @classmethod
    def of(cls, a_length: np.ndarray, b_length: np.ndarray) -> Spans:
        a_end, b_end = np.cumsum(a_length), np.cumsum(b_length)
        size = int(a_end[-1]) + 1 if len(a_end) else 1
        marks = []
        for end in (a_end, b_end):
            mark = np.zeros(size, dtype=bool)
            mark[end] = True
            marks.append(mark)
        a_before, b_before = (np.cumsum(m, dtype=np.int64) - m for m in marks)
        return cls(a_end, b_end, *marks, a_before, b_before)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """All overlapping pairs (a token, b token), left to right: one for each stretch between
        neighbouring ends of either tiling."""
        at = np.flatnonzero(self.a_mark | self.b_mark)
        return self.a_before[at], self.b_before[at]


def pointer_groups(spans: Spans) -> tuple[np.ndarray, np.ndarray]:
    """Group number of each A and each B token, from 0, by pointer jumping."""
    n = len(spans.a_end)
    from_a = spans.b_before[spans.a_end]  # the B token over the last byte of the A token
    points = np.empty(n + len(spans.b_end), dtype=np.int64)
    points[:n] = np.where(spans.b_end[from_a] > spans.a_end, n + from_a, np.arange(n))
    points[n:] = spans.a_before[spans.b_end]  # reaches at least as far, so it is the farthest
    while True:
        farther = points[points]
        if np.array_equal(farther, points):
            break
        points = farther
    rank = np.cumsum(points[:n] == np.arange(n)) - 1  # terminal tokens are A tokens, in order
    label = rank[points]
    return label[:n], label[n:]


def _group_codes(voc: Vocabularies, a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes into ``voc.shown`` in the order A tokens, B tokens of each group, and the place of
    the first code of each group."""
    groups = int(a_group[-1]) + 1 if len(a_group) else 0
    n_a, n_b = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
    a_first, b_first = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    codes = np.empty(len(a) + len(b), dtype=np.int64)
    a_last, b_last = np.append(a_group[1:] != a_group[:-1], True), np.append(b_group[1:] != b_group[:-1], True)
    codes[np.arange(len(a)) + b_first[a_group]] = a + np.where(a_last, voc.most, 0)
    codes[np.arange(len(b)) + (a_first + n_a)[b_group]] = b + np.where(b_last, 2 * voc.most, 0)
    return codes, a_first + b_first


def _chunks(batch: pa.RecordBatch, size) -> Iterator[pa.RecordBatch]:
    start = total = 0
    for i in range(batch.num_rows):
        total += size(i)
        if total >= CHUNK_BYTES:
            yield batch.slice(start, i + 1 - start)
            start, total = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def _encode_batches(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = vocabularies(a_path, b_path)
        for batch in batches:
            length = batch.column("length").to_pylist()
            for part in _chunks(batch, lambda i: length[i] or 0):
                yield _align_part(voc, part)
    return run


def _packed(counts: np.ndarray, ids: np.ndarray) -> pa.Array:
    """Ids of each row as a binary of little-endian unsigned 16-bit numbers."""
    ends = np.append(0, np.cumsum(2 * counts)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(ids.astype("<u2"))])


def _unpacked(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2")


def _align_part(voc: Vocabularies, part: pa.RecordBatch) -> pa.RecordBatch:
    a, b, n_a, n_b = voc.encode(part.column("text").to_pylist())
    n_groups, n_links, digests = np.zeros(len(n_a), np.int64), np.zeros(len(n_a), np.int64), [""] * len(n_a)
    if len(a):
        spans = Spans.of(voc.a_length[a], voc.b_length[b])
        a_group, b_group = pointer_groups(spans)
        codes, first = _group_codes(voc, a, b, a_group, b_group)
        link_a, _ = spans.links()
        a_stop = np.cumsum(n_a)
        full = n_a > 0
        stop_group = a_group[a_stop[full] - 1] + 1  # documents end where both tokenizations end
        n_groups[full] = np.diff(stop_group, prepend=0)
        n_links[full] = np.diff(np.searchsorted(link_a, a_stop[full], "left"), prepend=0)
        edge = np.append(first, len(codes))[stop_group]
        listed, at = codes.tolist(), 0
        for i, stop in zip(np.flatnonzero(full), edge.tolist()):
            shown = b"".join(map(voc.shown.__getitem__, listed[at:stop]))
            digests[i] = hashlib.sha256(shown[:-1]).hexdigest()
            at = stop
    lists = [_packed(n, x) for n, x in ((n_a, a), (n_b, b))]
    return pa.RecordBatch.from_arrays(
        [part.column("doc_id"), part.column("row"), *(pa.array(x) for x in (n_a, n_b, n_groups, n_links)), pa.array(digests), *lists],
        names=["doc_id", "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a_ids", "b_ids"])


def encode(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, row, n_a, n_b, n_groups, n_links, groups_sha256, a_ids, b_ids`` per row; ids as
    little-endian unsigned 16-bit numbers, so vocabularies have 65536 ids at most."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
                       F.octet_length(text_of(text_col)).alias("length"), F.monotonically_increasing_id().alias("row"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_encode_batches(a_path, b_path), (
        f"doc_id {kind}, row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, a_ids binary, b_ids binary"))


# --- counts of id pairs -----------------------------------------------------------------

def _link_keys(voc: Vocabularies, part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Keys ``a << 16 | b`` of all links of the rows, and the end of each row's links."""
    a, b = (_unpacked(part.column(c)) for c in ("a_ids", "b_ids"))
    ends = np.cumsum(part.column("n_links").to_numpy())
    if not len(a):
        return np.empty(0, "<u4"), ends
    i, j = Spans.of(voc.a_length[a], voc.b_length[b]).links()
    return (a.astype("<u4")[i] << np.uint32(16)) | b.astype("<u4")[j], ends


def _add(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, int)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _count_batches(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = vocabularies(a_path, b_path)
        keys, counts, fresh = np.empty(0, "<u4"), np.empty(0, "<i8"), []

        def fold() -> tuple[np.ndarray, np.ndarray]:
            own, many = np.unique(np.concatenate([np.empty(0, "<u4"), *fresh]), return_counts=True)
            fresh.clear()
            return _add(np.concatenate([keys, own]), np.concatenate([counts, many]))

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys.astype("<i8")), pa.array(counts)], names=["key", "n"])

        for batch in batches:
            links = batch.column("n_links").to_pylist()
            for part in _chunks(batch, links.__getitem__):
                fresh.append(_link_keys(voc, part)[0])
                if sum(map(len, fresh)) >= 4 * FLUSH:
                    keys, counts = fold()
                    if len(keys) >= FLUSH:
                        yield out()
                        keys, counts = keys[:0], counts[:0]
        keys, counts = fold()
        if len(keys):
            yield out()
    return run


def pair_counts(tokens: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``key, a_id, b_id, n``: how many links of the landed ``tokens`` hold each id pair."""
    parts = tokens.where("n_links > 0").select("n_links", "a_ids", "b_ids").mapInArrow(_count_batches(a_path, b_path), "key long, n long")
    out = parts.groupBy("key").agg(F.sum("n").alias("n"))
    return out.select("key", F.shiftright("key", 16).cast("int").alias("a_id"), F.col("key").bitwiseAND(F.lit(65535)).cast("int").alias("b_id"), "n")


def _lookup_batches(a_path: str, b_path: str, table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = vocabularies(a_path, b_path)
        keys, counts, best = table.value
        for batch in batches:
            links = batch.column("n_links").to_pylist()
            for part in _chunks(batch, links.__getitem__):
                own, ends = _link_keys(voc, part)
                at = np.minimum(np.searchsorted(keys, own), max(len(keys) - 1, 0))
                known = keys[at] == own if len(keys) else np.zeros(len(own), bool)
                n = np.where(known, counts[at], 0) if len(keys) else np.zeros(len(own), np.int64)
                is_best = known & (n == best[own & np.uint32(65535)])
                sums, bests, rare = (np.append(0, np.cumsum(x, dtype=np.int64)) for x in (n, is_best, ~known))
                starts = np.append(0, ends[:-1]) if len(ends) else ends
                rare_lists = pa.ListArray.from_arrays(pa.array(np.append(0, rare[ends]).astype(np.int32)), pa.array(own[~known].astype("<i8")))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in OUT), pa.array(bests[ends] - bests[starts]), pa.array(sums[ends] - sums[starts]), rare_lists],
                    names=[*OUT, "n_best", "count_sum", "rare"])
    return run


OUT = ["doc_id", "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", table: int = TABLE) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, row, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256``.

    A text is encoded by A behind a space and by B, which adds one; strings of special tokens
    are plain text.  NULL and empty texts, and texts whose joined token bytes differ from space
    and text, have no tokens: zeros and ''.  Very long texts are worked on whole, each alone in
    its chunk.  Repeated rows are rows of their own and their links count as often as they
    occur; NULL ids stay; other columns play no part, whatever their names.  Ties for the highest
    count of a B id are all best.  An empty table gives an empty result.  ``table`` bounds the broadcast
    table of pairs; results do not depend on it."""
    spark = docs.sparkSession
    tokens = land(encode(docs, a_path, b_path, id_col, text_col), "alignment_tokens")
    pairs = land(pair_counts(tokens, a_path, b_path), "alignment_pairs")
    best = pairs.groupBy("b_id").agg(F.max("n").alias("most"))  # as many rows as B has ids, at most
    tops = {r["b_id"]: r["most"] for r in best.collect()}
    highest = np.zeros(65536, dtype=np.int64)
    highest[list(tops)] = list(tops.values())
    # The least count that the table takes: whole classes of eighths of a power of two.
    level = F.floor(F.log2("n") * 8).cast("int")
    classes = sorted(((r["level"], r["count"]) for r in pairs.groupBy(level.alias("level")).count().collect()), reverse=True)
    least, held = None, 0
    for k, many in classes:
        if held + many > table:
            break
        least, held = k, held + many
    kept = pairs.where(level >= least) if least is not None else pairs.where("false")
    frame = kept.select("key", "n").toArrow().sort_by("key")  # at most ``table`` rows
    shared = spark.sparkContext.broadcast((frame["key"].to_numpy().astype("<u4"), frame["n"].to_numpy(), highest))
    kind = tokens.schema["doc_id"].dataType.simpleString()
    found = tokens.select(*OUT, "a_ids", "b_ids").mapInArrow(_lookup_batches(a_path, b_path, shared), (
        f"doc_id {kind}, row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long, rare array<long>"))
    if held < sum(many for _, many in classes):
        found = land(found, "alignment_found")
        rest = pairs.where(level < least) if least is not None else pairs
        rest = rest.join(F.broadcast(best), "b_id").select("key", "n", (F.col("n") == F.col("most")).cast("long").alias("is_best"))
        more = found.select("row", F.explode("rare").alias("key")).join(rest, "key")
        more = more.groupBy("row").agg(F.sum("is_best").alias("more_best"), F.sum("n").alias("more_sum"))
        found = found.join(more, "row", "left").withColumns({
            "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0))})
    return found.select("doc_id", "row", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
