"""Suffix-array dedup: remove bytes covered by a string of ``LENGTH`` bytes seen before.

Suffixes are sharded by content, so that equal strings meet without comparing all shards:

1. Texts are packed into compressed bundles of about a megabyte.
2. The smallest hash of all ``GRAM``-byte substrings of a window of LENGTH bytes is the window's
   anchor; equal windows have equal anchors.  Consecutive windows with one anchor form a run.
   Anchors are counted over all bundles (one entry per bundle and anchor); a run whose anchor
   occurs at one place only holds no repeated window.  Nothing is lost: anchors only decide where to look.
3. The bytes of the other runs go to the shard their anchor names.  A shard gets a suffix array
   by Larsson-Sadakane refinement, Kasai's common prefixes tell which neighbours share LENGTH
   bytes, and the earliest window of such a group stays.  An anchor that goes on in the next
   shard is merged by binary search in the sorted hashes of the first windows of the shards
   before; a hit is compared byte by byte.
4. An anchor in more than ``HOT_BUNDLES`` bundles or with more than ``HOT_WINDOWS`` windows is split
   into parts of at most so many (or one bundle); the windows each part kept are merged in a last
   round, spread by their own bytes.
5. The spans go back to the bundles, which are cut and unpacked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import land, shuffle_partitions

LENGTH, GRAM = 100, 32
BUNDLE_BYTES = 1 << 20
SHARD_BYTES = 1 << 18
BUCKET_BYTES = 1 << 27  # of text whose anchors, or repeated segments, one task holds at once
HOT_BUNDLES, HOT_WINDOWS = 4096, 1 << 20
END = 0xFF  # never a byte of UTF-8, so no common prefix of LENGTH text bytes reaches over it


# --- bundles ----------------------------------------------------------------------------

def _bundle_batches(bundle_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, orders, data, size, kind = [], [], [], 0, None
        pack = zstandard.ZstdCompressor(level=5).compress

        def out() -> pa.RecordBatch:
            columns = [pa.array([ids], pa.list_(kind)), pa.array([orders], pa.list_(pa.int64())),
                       pa.array([[len(d) for d in data]], pa.list_(pa.int64())), pa.array([pack(b"".join(data))], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["ids", "orders", "sizes", "data"])

        for batch in batches:
            kind = batch.column("doc_id").type
            for i, o, t in zip(batch.column("doc_id").to_pylist(), batch.column("ord").to_pylist(), batch.column("text").to_pylist()):
                ids.append(i), orders.append(o), data.append((t or "").encode("utf-8", "surrogatepass"))
                size += len(data[-1])
                if size >= bundle_bytes or len(ids) >= 10_000:
                    yield out()
                    ids, orders, data, size = [], [], [], 0
        if ids:
            yield out()
    return run


def _bytes(packed: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype=np.uint8)


# --- anchors ----------------------------------------------------------------------------

def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    so_far, covered = values, 1
    while covered * 2 <= width:
        so_far = np.minimum(so_far[:-covered], so_far[covered:])
        covered *= 2
    rest = width - covered
    return np.minimum(so_far[:len(so_far) - rest], so_far[rest:]) if rest else so_far


def _gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of each substring of ``size`` bytes, from hashes of 1, 2, 4, .. bytes."""
    n, base, mask = len(data) - size + 1, 0x9E3779B97F4A7C15, (1 << 64) - 1
    part, covered = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93), 1
    hashes, at = np.zeros(n, dtype=np.uint64), 0
    while True:
        if size & covered:
            hashes *= np.uint64(base)
            hashes += part[at:at + n]
            at += covered
        if covered * 2 > size:
            break
        part = part[:-covered] * np.uint64(base) + part[covered:]
        base, covered = base * base & mask, covered * 2
    hashes ^= hashes >> np.uint64(32)
    hashes *= np.uint64(0xD6E8FEB86659FD93)
    hashes ^= hashes >> np.uint64(29)
    return hashes


BLOCK, PLACE_BITS = 1 << 15, 16  # windows worked on at once (they fit a cache); bits that hold a place in a block


def _anchors(data: np.ndarray) -> np.ndarray:
    """Of each window the smallest hash of its substrings, its last bits replaced by the place of
    the substring inside the block of windows."""
    width, n = LENGTH - GRAM + 1, len(data) - LENGTH + 1
    place, mask = np.arange(BLOCK + width, dtype=np.uint64), ~np.uint64((1 << PLACE_BITS) - 1)
    out = np.empty(n, dtype=np.uint64)
    for at in range(0, n, BLOCK):
        part = data[at:at + BLOCK + LENGTH - 1]
        hashes = _gram_hashes(part, GRAM)
        hashes &= mask
        hashes |= place[:len(hashes)]
        out[at:at + BLOCK] = _smallest(hashes, width)
    return out


def runs(data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, text, first window inside the text, number of windows, whether the anchor may
    stand at more than one place in it) of all runs.

    Of two equal windows in one run the smallest hash stands at different places, so a run in
    which the place never changes holds no repeated window."""
    empty = np.empty(0, np.int64)
    if len(data) < LENGTH:
        return np.empty(0, np.uint64), empty, empty, empty, np.empty(0, bool)
    low = _anchors(data)
    fresh = np.empty(len(low), dtype=bool)  # a window that starts a run
    fresh[0] = True
    np.not_equal(low[1:] >> np.uint64(PLACE_BITS), low[:-1] >> np.uint64(PLACE_BITS), out=fresh[1:])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    fresh[starts[starts < len(low)]] = True
    first = np.nonzero(fresh)[0]
    text = np.searchsorted(ends, first, side="right")
    count = np.minimum(np.append(first[1:], len(low)), ends[text] - LENGTH + 1) - first
    moved = np.empty(len(low), dtype=bool)
    moved[0] = False
    np.not_equal(low[1:], low[:-1], out=moved[1:])
    moved[first] = False
    again = np.add.reduceat(moved, first, dtype=np.int64) > 0
    keep = count > 0  # the last windows of a text reach into the next one
    first, text, count, again = first[keep], text[keep], count[keep], again[keep]
    return low[first] >> np.uint64(PLACE_BITS), text, first - starts[text], count, again


def _bucket(anchor: np.ndarray, salt: np.ndarray | int, buckets: int) -> np.ndarray:
    mixed = anchor * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xC2B2AE3D27D4EB4F) * np.asarray(salt, dtype=np.uint64)
    return ((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def _by(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(key, its rows) for each distinct key."""
    order = np.argsort(keys, kind="stable")
    cuts = np.nonzero(np.diff(keys[order]))[0] + 1
    for part in np.split(order, cuts) if len(order) else []:
        yield int(keys[part[0]]), part


def _buckets(bundles: DataFrame, least: int, bucket_bytes: int) -> int:
    """Buckets for all anchors, so that the part of the text a bucket stands for is of a fixed size."""
    held = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    return max(least, -(-(bundles.agg(F.sum(held)).first()[0] or 0) // bucket_bytes))


def _anchor_batches(buckets: int):
    """Of each bundle, its distinct anchors by bucket, with their numbers of windows; the lowest
    bit tells that it occurs again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bundle, sizes, packed in zip(*(batch.column(c).to_pylist() for c in ("bundle", "sizes", "data"))):
                found, _, _, windows, again = runs(_bytes(packed), np.array(sizes, dtype=np.int64))
                found, of, count = np.unique(found, return_inverse=True, return_counts=True)
                windows = np.bincount(of, weights=windows, minlength=len(found)).astype("<u4")
                again = (np.bincount(of, weights=again, minlength=len(found)) > 0) | (count > 1)
                parts = list(_by(_bucket(found, 0, buckets)))
                found = found << np.uint64(1) | again.astype(np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b for b, _ in parts], pa.int64()), pa.array([bundle] * len(parts), pa.int64()),
                     pa.array([found[rows].tobytes() + windows[rows].tobytes() for _, rows in parts], pa.binary())], names=["bucket", "bundle", "blob"])
    return run


def _parts(of: np.ndarray, owner: np.ndarray, windows: np.ndarray, hot_bundles: int, hot_windows: int) -> np.ndarray:
    """Of each (anchor, bundle) the part of its anchor, from 1; 0 where the anchor is not split.  A
    part has at most ``hot_bundles`` bundles, and at most ``hot_windows`` windows or one bundle."""
    order = np.lexsort((owner, of))
    of, windows = of[order], windows[order].astype(np.int64)
    start = np.nonzero(np.append(True, of[1:] != of[:-1]))[0]
    size = np.diff(np.append(start, len(of)))
    total = np.add.reduceat(windows, start)
    found = np.zeros(len(of), dtype=np.uint32)
    for i in np.nonzero((size > hot_bundles) | (total > hot_windows))[0]:
        part, bundles, held = 1, 0, 0
        for at in range(start[i], start[i] + size[i]):
            if bundles and (bundles == hot_bundles or held + windows[at] > hot_windows):
                part, bundles, held = part + 1, 0, 0
            found[at], bundles, held = part, bundles + 1, held + int(windows[at])
    out = np.empty_like(found)
    out[order] = found
    return out


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[int], list[bytes]]]:
    """Rows (bucket, bundle, blob), sorted by bucket, a bucket at a time."""
    now, bundles, blobs = None, [], []
    for batch in batches:
        for bucket, bundle, blob in zip(*(batch.column(c).to_pylist() for c in ("bucket", "bundle", "blob"))):
            if bucket != now:
                if bundles:
                    yield now, bundles, blobs
                now, bundles, blobs = bucket, [], []
            bundles.append(bundle), blobs.append(blob)
    if bundles:
        yield now, bundles, blobs


def _repeated_batches(hot_bundles: int, hot_windows: int):
    """For each bundle its anchors that occur again somewhere, with the part of a split anchor
    that the bundle belongs to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, bundles, blobs in _groups(batches):
            sizes = [len(b) // 12 for b in blobs]
            every = np.concatenate([np.frombuffer(b, "<u8", n) for b, n in zip(blobs, sizes)])
            windows = np.concatenate([np.frombuffer(b, "<u4", n, 8 * n) for b, n in zip(blobs, sizes)])
            owner = np.repeat(np.array(bundles, dtype=np.int64), sizes)
            anchor, of, count = np.unique(every >> np.uint64(1), return_inverse=True, return_counts=True)
            again = count > 1
            again[of[(every & np.uint64(1)) == 1]] = True
            keep = again[of]
            owner, of, windows = owner[keep], of[keep], windows[keep]
            if not len(of):
                continue
            parts = _parts(of, owner, windows, hot_bundles, hot_windows)
            own = list(_by(owner))
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in own], pa.int64()), pa.array([anchor[of[r]].astype("<u8").tobytes() for _, r in own], pa.binary()),
                 pa.array([parts[r].astype("<u4").tobytes() for _, r in own], pa.binary())], names=["bundle", "anchors", "parts"])
    return run


# --- segments ---------------------------------------------------------------------------

SEGMENT = np.dtype([("anchor", "<u8"), ("order", "<i8"), ("text", "<u4"), ("first", "<u4"), ("count", "<u4"), ("part", "<u4"), ("again", "u1")])


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of all elements of the given stretches, one stretch after the other."""
    total = int(sizes.sum())
    before = np.cumsum(sizes) - sizes
    return np.arange(total) + np.repeat(starts - before, sizes)


def _segment_batches(buckets: int):
    """Of each bundle the runs with a repeated anchor, their bytes beside them, by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        names = ("bundle", "sizes", "orders", "data", "anchors", "parts")
        for batch in batches:
            for bundle, sizes, orders, packed, anchors, parts in zip(*(batch.column(c).to_pylist() for c in names)):
                known = np.concatenate([np.frombuffer(a, "<u8") for a in anchors])
                split = np.concatenate([np.frombuffer(p, "<u4") for p in parts])
                order = np.argsort(known)
                known, split = known[order], split[order]
                data, sizes = _bytes(packed), np.array(sizes, dtype=np.int64)
                anchor, text, first, count, twice = runs(data, sizes)
                at = np.minimum(np.searchsorted(known, anchor), len(known) - 1)
                keep = known[at] == anchor
                anchor, text, first, count, part, twice = anchor[keep], text[keep], first[keep], count[keep], split[at[keep]], twice[keep]
                rows = np.zeros(len(anchor), dtype=SEGMENT)
                rows["anchor"], rows["text"], rows["first"], rows["count"] = anchor, text, first, count
                rows["order"], rows["part"], rows["again"] = np.array(orders, dtype=np.int64)[text], part, twice
                begin = (np.cumsum(sizes) - sizes)[text] + first
                out = []
                for bucket, r in _by(_bucket(anchor, part, buckets)):
                    body = data[_ragged(begin[r], count[r] + LENGTH - 1)].tobytes()
                    out.append((bucket, pack(len(r).to_bytes(8, "little") + rows[r].tobytes() + body)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b for b, _ in out], pa.int64()), pa.array([bundle] * len(out), pa.int64()),
                     pa.array([blob for _, blob in out], pa.binary())], names=["bucket", "bundle", "blob"])
    return run


# --- suffix arrays ----------------------------------------------------------------------

def suffix_array(data: np.ndarray) -> np.ndarray:
    """All suffixes in order (Larsson-Sadakane: each round doubles the sorted depth and touches
    only groups that are not single yet)."""
    n = len(data)
    wide = np.append(data, np.zeros(8, np.uint8)).astype(np.uint64)
    covered, bits = 5, np.uint64(24)
    key = np.zeros(n, dtype=np.uint64)
    for i in range(covered):
        key = key << np.uint64(8) | wide[i:i + n]
    if n < 1 << 24:
        both = np.sort(key << bits | np.arange(n, dtype=np.uint64))
        sa, key = (both & np.uint64((1 << 24) - 1)).astype(np.int64), both >> bits
    else:
        sa = np.argsort(key, kind="stable")
        key = key[sa]
    group = np.maximum.accumulate(np.where(np.append(True, key[1:] != key[:-1]), np.arange(n), 0))
    rank = np.zeros(n, dtype=np.int64)
    rank[sa] = group
    open_slots = np.arange(n)
    while True:
        alike = group[open_slots[1:]] == group[open_slots[:-1]]
        open_slots = open_slots[np.append(alike, False) | np.append(False, alike)]
        if not len(open_slots):
            break
        at = sa[open_slots]
        follow = np.where(at + covered < n, rank[np.minimum(at + covered, n - 1)] + 1, 0)
        own = group[open_slots]
        if n < 1 << 21:  # three numbers of 21 bits in one word sort several times faster
            both = np.sort(own.astype(np.uint64) << np.uint64(42) | follow.astype(np.uint64) << np.uint64(21) | at.astype(np.uint64))
            at, key = (both & np.uint64((1 << 21) - 1)).astype(np.int64), both >> np.uint64(21)
            fresh = np.append(True, key[1:] != key[:-1])
        else:
            order = np.lexsort((follow, own))
            at, follow, own = at[order], follow[order], own[order]
            fresh = np.append(True, (own[1:] != own[:-1]) | (follow[1:] != follow[:-1]))
        sa[open_slots] = at
        group[open_slots] = np.maximum.accumulate(np.where(fresh, open_slots, 0))
        rank[at] = group[open_slots]
        covered *= 2
    return sa


def common_prefixes(data: np.ndarray, sa: np.ndarray, most: int = LENGTH, lane: int = 64) -> np.ndarray:
    """Kasai: ``[r]`` is the common prefix of suffixes r - 1 and r, up to ``most``.  Stretches of
    ``lane`` positions advance in step, each carrying its prefix from one position to the next."""
    n = len(data)
    wide = np.append(data, np.zeros(most + 16, np.uint8)).astype(np.uint64)
    word = np.zeros(n + most + 8, dtype=np.uint64)
    for i in range(8):
        word = word << np.uint64(8) | wide[i:i + len(word)]
    inverse = np.empty(n, dtype=np.int64)
    inverse[sa] = np.arange(n)
    out = np.zeros(n, dtype=np.int64)
    starts = np.arange(0, n, lane)
    carried = np.zeros(len(starts), dtype=np.int64)
    bounds = [np.uint64(1 << (8 * b)) for b in range(7, 0, -1)]
    for t in range(lane):
        live = starts + t < n
        starts, carried = starts[live], carried[live]
        i = starts + t
        r = inverse[i]
        j = sa[np.maximum(r - 1, 0)]
        carried = np.where(r > 0, np.maximum(carried - 1, 0), 0)
        todo = np.nonzero(r > 0)[0]
        while len(todo):
            off = word[i[todo] + carried[todo]] ^ word[j[todo] + carried[todo]]
            same = off == 0
            step = np.full(len(todo), 8)
            if not same.all():
                rest = off[~same]
                step[~same] = sum((rest < b).astype(np.int64) for b in bounds)
            carried[todo] += step
            todo = todo[same & (carried[todo] < most)]
        carried = np.minimum(carried, most)
        out[r] = carried
    return out


class Shards:
    """The segments of one bucket, worked through in shards of about ``SHARD_BYTES``.

    Segments come sorted by anchor and part, then by place in the corpus, so of equal windows the
    one further ahead in a shard, or in an earlier shard, is the earlier one.  Of the anchor that
    goes on, hashes and places of the first windows are carried, 24 bytes a window."""

    def __init__(self, bodies: list[bytes]) -> None:
        self.bodies, self.carried_anchor = bodies, None
        self.carried = np.empty(0, np.uint64)  # sorted hashes of the first windows of the anchor that goes on
        self.segment, self.place = np.empty(0, np.int64), np.empty(0, np.int64)  # where each of them stands

    def repeated(self, anchors: np.ndarray, parts: np.ndarray, counts: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``own`` are the segments' numbers in the bucket.  For all windows of these segments, one after the other: whether it is a repeat; and
        their bytes' places in ``self.data``."""
        sizes = counts + LENGTH - 1
        self.data = data = np.frombuffer(b"".join(self.bodies[i] + bytes([END]) for i in own), dtype=np.uint8)
        begin = np.cumsum(sizes + 1) - (sizes + 1)
        windows = _ragged(begin, counts)
        number = np.full(len(data), -1)
        number[windows] = np.arange(len(windows))
        sa = suffix_array(data)
        fresh = common_prefixes(data, sa) < LENGTH
        group = np.cumsum(fresh) - 1
        first = np.minimum.reduceat(sa, np.nonzero(fresh)[0])[group]
        repeat = np.zeros(len(windows), dtype=bool)
        here = number[sa]
        repeat[here[here >= 0]] = (sa != first)[here >= 0]
        # Windows of the anchor that began in an earlier shard: binary search among its windows.
        new = np.append(True, (anchors[1:] != anchors[:-1]) | (parts[1:] != parts[:-1]))
        of = np.repeat(np.cumsum(new) - 1, counts)
        goes_on = self.carried_anchor == (int(anchors[0]), int(parts[0]))
        hashes = _gram_hashes(data, LENGTH)
        if goes_on:
            mine = np.nonzero((of == 0) & ~repeat)[0]
            repeat[mine[self.known(hashes[windows[mine]], windows[mine])]] = True
        if not goes_on or of[-1] > 0:
            self.carried_anchor = (int(anchors[-1]), int(parts[-1]))
            self.carried, self.segment, self.place = self.carried[:0], self.segment[:0], self.place[:0]
        kept = np.nonzero((of == of[-1]) & ~repeat)[0]
        owner = np.repeat(np.arange(len(own)), counts)[kept]
        fresh = hashes[windows[kept]]
        order = np.argsort(fresh, kind="stable")
        at = np.searchsorted(self.carried, fresh[order])
        self.carried = np.insert(self.carried, at, fresh[order])
        self.segment = np.insert(self.segment, at, own[owner[order]])
        self.place = np.insert(self.place, at, (windows[kept] - begin[owner])[order])
        return repeat, windows

    def known(self, hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Which windows (their hashes, their places in ``self.data``) are among the carried ones."""
        found = np.zeros(len(hashes), dtype=bool)
        low, high = np.searchsorted(self.carried, hashes), np.searchsorted(self.carried, hashes, side="right")
        for i in np.nonzero(high > low)[0]:
            text = self.data[at[i]:at[i] + LENGTH].tobytes()
            found[i] = any(self.bodies[self.segment[j]].startswith(text, self.place[j]) for j in range(low[i], high[i]))
        return found

    def text(self, at: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(self.data[at[:, None] + np.arange(LENGTH)]).view(f"S{LENGTH}").ravel()


def _shard_batches(shard_bytes: int):
    """Spans to remove, by bundle; of split anchors also the windows that stay so far."""
    def work(bundles: list[int], blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        unpack, tables, bodies = zstandard.ZstdDecompressor().decompress, [], []
        for blob in blobs:
            raw = unpack(blob)
            n = int.from_bytes(raw[:8], "little")
            table = np.frombuffer(raw, SEGMENT, n, 8)
            tables.append(table)
            at = 8 + n * SEGMENT.itemsize
            for size in table["count"].astype(np.int64) + LENGTH - 1:
                bodies.append(raw[at:at + size])
                at += size
        rows = np.concatenate(tables)
        bundle = np.repeat(np.array(bundles, dtype=np.int64), [len(t) for t in tables])
        order = np.lexsort((rows["first"], rows["text"], bundle, rows["order"], rows["part"], rows["anchor"]))
        first_seen: dict[tuple[int, bytes], int] = {}
        part_of = rows["part"].tolist()
        lead, spans = [], []
        for i in order:  # equal segments of a part: all windows but the first one's are repeats
            if first_seen.setdefault((part_of[i], bodies[i]), i) == i:
                lead.append(i)
            else:
                spans.append((i, int(rows["first"][i]), int(rows["first"][i]) + len(bodies[i])))
        lead = np.array(lead, dtype=np.int64)
        # What was said of anchors holds again: a lone segment whose anchor stands at one place has no repeats.
        same = rows["anchor"][lead][1:] == rows["anchor"][lead][:-1]
        lone = ~(np.append(same, False) | np.append(False, same)) & (rows["again"][lead] == 0) & (rows["part"][lead] == 0)
        lead = lead[~lone]
        held = np.cumsum([0, *(len(bodies[i]) for i in lead)])[1:]
        shards = Shards(bodies)
        for part in np.split(lead, np.searchsorted(held, np.arange(shard_bytes, held[-1] if len(held) else 0, shard_bytes))):
            if not len(part):
                continue
            counts = rows["count"][part].astype(np.int64)
            repeat, windows = shards.repeated(rows["anchor"][part], rows["part"][part], counts, part)
            owner = np.repeat(np.arange(len(part)), counts)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
            edge = np.nonzero(np.append(True, (repeat[1:] != repeat[:-1]) | (owner[1:] != owner[:-1])))[0]
            for a, b in zip(edge, np.append(edge[1:], len(repeat))):
                if repeat[a]:
                    i = part[owner[a]]
                    begin = int(rows["first"][i]) + int(place[a])
                    spans.append((i, begin, begin + int(b - a) + LENGTH - 1))
            stay = np.nonzero(~repeat & (rows["part"][part] > 0)[owner])[0]
            if len(stay):
                own = part[owner[stay]]
                yield _answer(bundle[own], None, rows["order"][own], rows["text"][own], rows["first"][own].astype(np.int64) + place[stay],
                              [x.ljust(LENGTH, b"\0") for x in shards.text(windows[stay]).tolist()])
        if spans:
            owner = np.array([s[0] for s in spans])
            table = np.stack([rows["text"][owner].astype(np.int64), [s[1] for s in spans], [s[2] for s in spans]], axis=1).astype("<i8")
            own = list(_by(bundle[owner]))
            yield _answer([b for b, _ in own], [table[r].tobytes() for _, r in own])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, bundles, blobs in _groups(batches):
            yield from work(bundles, blobs)
    return run


ANSWER = "bundle long, spans binary, ord long, text long, begin long, bytes binary"


def _answer(bundle, spans=None, order=None, text=None, begin=None, window=None) -> pa.RecordBatch:
    n = len(bundle)
    nothing = lambda kind: pa.nulls(n, kind)
    return pa.RecordBatch.from_arrays([
        pa.array(np.array(bundle, dtype=np.int64)), pa.array(spans, pa.binary()) if spans is not None else nothing(pa.binary()),
        *(pa.array(np.asarray(x).astype(np.int64)) if x is not None else nothing(pa.int64()) for x in (order, text, begin)),
        pa.array(window, pa.binary()) if window is not None else nothing(pa.binary())],
        names=["bundle", "spans", "ord", "text", "begin", "bytes"])


# --- cutting ----------------------------------------------------------------------------

def _cut_batches(kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, sizes, packed, spans, late in zip(*(batch.column(c).to_pylist() for c in ("ids", "sizes", "data", "spans", "late"))):
                data, sizes = _bytes(packed), np.array(sizes, dtype=np.int64)
                ends = np.cumsum(sizes)
                begin = ends - sizes
                single = np.array([(x["text"], x["begin"], x["begin"] + LENGTH) for x in late or []], dtype=np.int64).reshape(-1, 3)
                found = np.concatenate([single, *(np.frombuffer(s, "<i8").reshape(-1, 3) for s in spans or [])])
                depth = np.zeros(len(data) + 1, dtype=np.int64)
                np.add.at(depth, begin[found[:, 0]] + found[:, 1], 1)
                np.add.at(depth, begin[found[:, 0]] + found[:, 2], -1)
                gone = np.cumsum(depth[:-1]) > 0
                out_spans, kept = [], []
                for b, e in zip(begin, ends):
                    own = gone[b:e]
                    if not own.any():
                        out_spans.append([])
                        kept.append(data[b:e].tobytes())
                        continue
                    edge = np.nonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]])))[0]
                    out_spans.append([{"begin": int(x), "finish": int(y)} for x, y in edge.reshape(-1, 2)])
                    kept.append(data[b:e][~own].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, kind), pa.array(sizes), pa.array(out_spans, pa.list_(pa.struct([("begin", pa.int64()), ("finish", pa.int64())]))),
                     pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_bundles: int = HOT_BUNDLES,
                   shard_bytes: int = SHARD_BYTES, bundle_bytes: int = BUNDLE_BYTES, hot_windows: int = HOT_WINDOWS,
                   bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``doc_id, n_bytes, spans`` (of removed bytes: begin, finish) and ``kept`` (the other bytes)
    for every row of ``docs``.

    A byte goes if a string of 100 bytes that covers it also starts earlier: in a document with a
    smaller id, or before in the same one.  Ids are integers; NULL ids come last, and documents
    with one id are ordered by their place in the bundles.  NULL is the empty text; texts of
    less than 100 bytes lose nothing.  An empty table gives an empty result."""
    spark = docs.sparkSession
    ident = F.col(f"`{id_col}`")
    kind = docs.select(ident).schema[0].dataType.simpleString()
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"the order of documents needs integer ids, not {kind}")
    rows = docs.select(ident.alias("doc_id"), F.coalesce(ident.cast("long"), F.lit((1 << 63) - 1)).alias("ord"), F.col(f"`{text_col}`").alias("text"))
    bundles = rows.mapInArrow(_bundle_batches(bundle_bytes), f"ids array<{kind}>, orders array<long>, sizes array<long>, data binary")
    bundles = land(bundles.withColumn("bundle", F.monotonically_increasing_id()), "suffix_bundles")
    parts = shuffle_partitions(spark)
    buckets = _buckets(bundles, 2 * parts, bucket_bytes)

    anchors = bundles.select("bundle", "sizes", "data").mapInArrow(_anchor_batches(buckets), "bucket long, bundle long, blob binary")
    again = (anchors.repartition(parts, "bucket").sortWithinPartitions("bucket")
             .mapInArrow(_repeated_batches(hot_bundles, hot_windows), "bundle long, anchors binary, parts binary"))
    again = again.groupBy("bundle").agg(F.collect_list("anchors").alias("anchors"), F.collect_list("parts").alias("parts"))
    again = land(again, "suffix_anchors")
    segments = (bundles.join(again, "bundle").select("bundle", "sizes", "orders", "data", "anchors", "parts")
                .mapInArrow(_segment_batches(buckets), "bucket long, bundle long, blob binary"))
    answers = (segments.repartition(parts, "bucket").sortWithinPartitions("bucket")
               .mapInArrow(_shard_batches(shard_bytes), ANSWER))
    answers = land(answers, "suffix_answers")
    # The last round for split anchors: equal windows meet by their bytes, at most one per part.
    earlier = Window.partitionBy("bytes").orderBy("ord", "bundle", "text", "begin")
    late = answers.where("bytes IS NOT NULL").withColumn("nth", F.row_number().over(earlier)).where("nth > 1")
    spans = answers.where("spans IS NOT NULL").select("bundle", "spans", F.lit(None).cast("struct<text:bigint,begin:bigint>").alias("late"))
    spans = spans.unionByName(late.select("bundle", F.lit(None).cast("binary").alias("spans"), F.struct("text", "begin").alias("late")))
    spans = spans.groupBy("bundle").agg(F.collect_list("spans").alias("spans"), F.collect_list("late").alias("late"))
    cut = bundles.select("bundle", "ids", "sizes", "data").join(spans, "bundle", "left")
    arrow = {"tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32(), "bigint": pa.int64()}[kind]
    return cut.select("ids", "sizes", "data", "spans", "late").mapInArrow(
        _cut_batches(arrow), f"doc_id {kind}, n_bytes long, spans array<struct<begin:bigint,finish:bigint>>, kept binary")


def digest(found: DataFrame) -> DataFrame:
    """The result columns: counts and the hash of what is kept."""
    lengths = F.transform("spans", lambda s: s["finish"] - s["begin"])
    return found.select("doc_id", "n_bytes", F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
w AS (SELECT doc_id, p, md5(substring(h, 2 * p + 1, 200)) AS s FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS p FROM d WHERE n >= 100)),
r AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS nth FROM w) WHERE nth > 1),
b AS (SELECT doc_id, p, substring(h, 2 * p + 1, 2) AS x FROM (SELECT doc_id, h, unnest(range(0, n)) AS p FROM d)),
c AS (SELECT b.doc_id, b.p, x, coalesce(max(r.p) OVER (PARTITION BY b.doc_id ORDER BY b.p) >= b.p - 99, false) AS gone
      FROM b LEFT JOIN r ON b.doc_id = r.doc_id AND b.p = r.p),
e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), false) AS edge FROM c),
a AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (edge) AS n_spans,
             coalesce(string_agg(x, '' ORDER BY p) FILTER (NOT gone), '') AS kept FROM e GROUP BY doc_id)
SELECT d.doc_id, d.n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN a ON d.doc_id = a.doc_id
"""
