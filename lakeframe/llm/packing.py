"""Best-fit packing: tokenised documents into sequences by vector best fit.

Texts are tokenised in Arrow batches; a document longer than a sequence is cut into whole
sequences, of which only the first may be shorter.  Whole pieces are sequences of their own.
The rest is dealt by a hash into groups of about ``GROUP_PIECES`` pieces; inside a group each
piece, longest first, goes to the open sequence that fits it best under three capacities at
once (tokens, documents, attention cost).  Sequences that stay rather empty are opened again
and dealt into fewer groups, until one group is left or no sequence is poorly filled, so the
waste does not grow with the number of groups.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import land

GROUP_PIECES = 8192
POOR = 0.98  # sequences filled below this share are packed again
END_ID = 0


@dataclass(frozen=True)
class Capacity:
    """Limits of one sequence.  Attention cost is the sum of squared piece lengths."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048

    @property
    def longest(self) -> int:
        """The longest piece that a sequence can hold."""
        return min(self.tokens, math.isqrt(self.attention))

    def check(self, longest: int) -> None:
        if self.documents < 1 or longest > self.longest:
            raise ValueError(f"a piece of {longest} tokens is beyond a capacity of {self}")

    def of(self, lengths: np.ndarray) -> np.ndarray:
        """Demand of each piece as a share of each capacity."""
        n = lengths.astype(np.float64)
        return np.stack([n / self.tokens, np.full(len(n), 1.0 / self.documents), n * n / self.attention], axis=1)


# --- tokens -----------------------------------------------------------------------------

class ByteBpe:
    """Ids of a byte-level BPE vocabulary file.  The ranks of the file drive ``tiktoken``, which
    yields the ids of ``tokenizers`` several times faster; a text that contains one of the
    file's added tokens goes to ``tokenizers`` itself."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.whole = Tokenizer.from_file(path)
        plain = _byte_alphabet()
        ranks = {bytes(plain[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in self.added}
        # The usual split of byte-level BPE; a fixed value of the vocabulary family.
        split = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.fast = tiktoken.Encoding("byte_bpe", pat_str=split, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if any(a in text for a in self.added):
            found = self.whole.encode(text, add_special_tokens=False).ids
        else:
            found = self.fast.encode_ordinary(text)
        return np.array([*found, END_ID], dtype="<u4")


def _byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of byte-level BPE: printable Latin-1 bytes stand for themselves, the
    others for the code points from 256 on, in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


_LOADED: dict[str, ByteBpe] = {}


def tokenizer(path: str) -> ByteBpe:
    if path not in _LOADED:
        _LOADED[path] = ByteBpe(path)
    return _LOADED[path]


def cut(n: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids."""
    first = n % most or most
    return [(0, first), *((s, most) for s in range(first, n, most))]


def _pieces(path: str, most: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path).ids
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                take, piece, start, length, crc, ids = [], [], [], [], [], []
                for i, text in enumerate(part.column("text").to_pylist()):
                    own = encode(text or "")
                    for p, (s, n) in enumerate(cut(len(own), most)):
                        take.append(i), piece.append(p), start.append(s), length.append(n)
                        crc.append(zlib.crc32(own[s:s + n].tobytes()))
                        if keep_ids:
                            ids.append(own[s:s + n].astype("<i4"))
                columns = [part.column("doc_id").take(pa.array(take)), part.column("row").take(pa.array(take)),
                           pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
                names = ["doc_id", "row", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)
    return run


def pieces(docs: DataFrame, tokenizer_path: str, most: int = 2048, keep_ids: bool = False,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenised pieces: ``doc_id, row, piece, start, length, ids_crc32`` and, if asked for, the
    ``ids`` themselves.  NULL is the empty text, which is the end id alone."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, row long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")
    return rows.mapInArrow(_pieces(tokenizer_path, most, keep_ids), out)


# --- packing ----------------------------------------------------------------------------

def vector_best_fit(demand: np.ndarray, score: str = "norm") -> np.ndarray:
    """Bin of each item.  ``demand`` is (items, dimensions) as shares of the capacities, none over 1
    (else ValueError).  Items
    go longest first into the fitting bin with the smallest weighted residual norm, or the
    largest weighted dot product of demand and residual; weights are the mean demands."""
    n, dims = demand.shape
    if (demand > 1 + 1e-9).any():
        raise ValueError("an item is beyond a capacity")
    weight = demand.mean(axis=0) / demand.mean(axis=0).sum()
    left = np.ones((n, dims))
    used, where = 0, np.empty(n, dtype=np.int64)
    open_bins = np.empty(0, dtype=np.int64)
    tiny = 1e-9
    for turn, i in enumerate(np.lexsort((-demand[:, 2], -demand[:, 0]))):
        room = left[open_bins] - demand[i]
        fits = (room >= -tiny).all(axis=1)
        if fits.any():
            if score == "dot":
                value = np.where(fits, -(left[open_bins] * (weight * demand[i])).sum(axis=1), np.inf)
            else:
                value = np.where(fits, (room * room * weight).sum(axis=1), np.inf)
            bin_ = open_bins[int(value.argmin())]
        else:
            bin_, used = used, used + 1
            open_bins = np.append(open_bins, bin_)
        left[bin_] -= demand[i]
        where[i] = bin_
        if turn % 256 == 255:  # full bins need not be looked at again
            open_bins = open_bins[(left[open_bins] > tiny).all(axis=1)]
    return where


def _fill(capacity: Capacity, score: str, poor: float):
    def run(group: tuple, table: pa.Table) -> pa.Table:
        order = np.lexsort((table.column("piece").to_numpy(), table.column("row").to_numpy()))
        table = table.take(pa.array(order))
        length = table.column("length").to_numpy()
        where = vector_best_fit(capacity.of(length), score)
        total = np.bincount(where, weights=length)
        by_bin = np.argsort(where, kind="stable")
        run_before = np.cumsum(length[by_bin]) - length[by_bin]
        first = np.append(True, where[by_bin][1:] != where[by_bin][:-1])
        offset = np.empty(len(length), dtype=np.int64)
        offset[by_bin] = run_before - np.maximum.accumulate(np.where(first, run_before, 0))
        columns = table.drop_columns(["grp"])
        return (columns.append_column("grp", pa.array(np.full(len(length), group[0].as_py(), dtype=np.int64)))
                .append_column("bin", pa.array(where)).append_column("offset", pa.array(offset))
                .append_column("poor", pa.array(total[where] < poor * capacity.tokens)))
    return run


def pack(found: DataFrame, capacity: Capacity = Capacity(), score: str = "norm") -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to landed pieces (``row, piece, length, ..``).  A piece that no
    sequence can hold raises ValueError."""
    names = found.columns
    capacity.check(found.agg(F.max("length")).first()[0] or 0)
    whole = found.where(F.col("length") == capacity.tokens)
    done = land(whole.withColumn("sequence_id", -1 - F.monotonically_increasing_id())
                .withColumn("offset", F.lit(0).cast("long")), "packing_whole")
    rest, passed = found.where(F.col("length") < capacity.tokens), 0
    many = rest.count()
    while many:
        groups = -(-many // GROUP_PIECES)
        dealt = rest.withColumn("grp", F.pmod(F.xxhash64(F.lit(passed), "row", "piece"), F.lit(groups)))
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema.fields)
        last = groups == 1
        filled = dealt.groupBy("grp").applyInArrow(
            _fill(capacity, score, 0.0 if last else POOR), f"{kinds}, grp long, bin long, offset long, poor boolean")
        filled = land(filled, f"packing_round{passed}")
        number = F.lit(passed << 56) + F.shiftleft("grp", 24) + F.col("bin")
        done = done.unionByName(filled.where("NOT poor").withColumn("sequence_id", number).select(*names, "sequence_id", "offset"))
        rest, before, passed = filled.where("poor").select(*names), many, passed + 1
        many = rest.count()
        if many > 0.9 * before:  # nearly nothing fills a sequence any better: take it as it is
            done = done.unionByName(filled.where("poor").withColumn("sequence_id", number).select(*names, "sequence_id", "offset"))
            break
    return done.select(*names, "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: Capacity = Capacity(), score: str = "norm",
                   keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``) per piece.

    NULL counts as the empty text, of one end id.  Repeated rows are documents of their own
    (``row`` tells them apart).  Pieces of equal length go in the order of their rows.  Very long
    texts are encoded whole and cut into pieces that keep to every capacity, so every capacity holds in
    every sequence.  Other columns play no part, whatever their names; an empty table gives an
    empty result."""
    found = land(pieces(docs, tokenizer_path, capacity.longest, keep_ids, id_col, text_col), "packing_pieces")
    return pack(found, capacity, score)
