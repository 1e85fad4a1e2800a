"""Stateful reassembly of media from a frame stream.

``complete`` mode (the default) works in two stateful steps:

1. by (media, bucket of 65536 consecutive ids): the state is a list of runs of consecutive ids,
   each with its producer times and a digest, some 50 bytes a run.  Frames of one publication
   follow each other in producer time, so runs are kept in that order and joined where ids and
   times go on.  A frame whose id is there already, but at another time, belongs to another
   publication of the name; so does one that is more than ``apart_ms`` away.  A record whose time and
   id lie inside a run, or whose time lies inside an emitted publication, is a redelivered copy.
   A run that covers the bucket (the last bucket: up to the last frame) is emitted;
2. by media: runs of full buckets are held until buckets 0 to the last one follow each other in
   time, then the media is emitted.

So publications may overlap in arrival and complete in any order, and a media of any length
spreads over many tasks and small states.  What stays after completion is 16 bytes a publication
and bucket, its time span, by which copies in any later micro-batch are told.  Without timestamps
all frames of a name count as one publication.

Every frame has an outcome (:func:`reassemble_stream`): ``assembled`` media, ``copies``, and, where
``ttl_ms`` evicts state that received nothing for that long, ``evicted`` runs with a reason; what
is in none of them is in the state (:func:`pending_frames`).  Eviction first tries to join runs
that only their distance in time has kept apart.

``on_last`` mode reproduces the reference consumer: emit whatever arrived once the last frame
arrives (duplicates counted) and start a new entry for frames after it, in ``(partition,
offset)`` order.  It needs frames keyed by media, and holds numbers only.

No frame bytes are kept in state.  The frames are landed by a table sink and joined with the
emitted media by :func:`published_frames`.

The folds run in one of three engines, all with their state in RocksDB.  ``shelves`` (without
``ttl_ms`` the default) groups by a hash of the key, in ``SHELVES`` groups, with a map state of one
entry per key: Spark's cost of a group (its Arrow batch, pandas frames, calls) is shared by the
keys of a shelf, and a key costs a look-up and an update.  ``tws`` is a
``transformWithStateInPandas`` processor per key, with timers for ``ttl_ms``; ``group_state`` (the
default with ``ttl_ms``) has an ``applyInPandasWithState`` as its first step, and as its second one
the other kind, since Spark takes one of the former per query.  A checkpoint belongs to the engine
that began it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from lakeframe.functions.headers import LAST_YES
from lakeframe.operators.frames import dedupe_frames, frame_digest
from lakeframe.schemas import ASSEMBLED

BUCKET_IDS = 1 << 16
SHELVES = 512  # groups of keys, so the most tasks of a step; a shelf's share of one micro-batch is held at once
NO_TIME = -(1 << 62)
APART_MS = 5000  # frames of one publication are sent in one go
HALF = (1 << 30) - 1

# A run of consecutive ids in order of time.  Digests are sums of 60-bit numbers, in two halves.
RUN = np.dtype([("low", "<i4"), ("high", "<i4"), ("since", "<i8"), ("until", "<i8"), ("upper", "<i8"), ("lower", "<i8"),
                ("last", "?"), ("fps", "<i4"), ("height", "<i4"), ("width", "<i4")])
SPAN = np.dtype([("since", "<i8"), ("until", "<i8")])
# A full bucket that waits for the others of its media.
PART = np.dtype([("bucket", "<i8"), *RUN.descr])

OUTCOME = T.StructType([T.StructField("outcome", T.StringType()), *ASSEMBLED.fields, T.StructField("reason", T.StringType())])
_OUT_COLS = [f.name for f in OUTCOME.fields]
_PART_OUT = T.StructType([*OUTCOME.fields, T.StructField("part", T.BinaryType())])
_PART_COLS = [f.name for f in _PART_OUT.fields]
# ``n`` is the number of frames that wait in the state.
_STATE = "held binary, spans binary, n long"
_LAST_STATE = "n long, digest string, until long"

# A fold takes (key, state tuple or None, rows) and gives (state tuple or None, output rows); at
# eviction rows is None.  Rows are a frame or a dict of arrays.
Rows = pd.DataFrame | dict[str, np.ndarray]
Fold = Callable[[tuple, "tuple | None", "Rows | None"], "tuple[tuple | None, list[tuple]]"]


def _ints(rows: Rows, column: str) -> np.ndarray:
    return np.asarray(rows[column], dtype=np.int64)


def _is_last(rows: Rows) -> np.ndarray:
    return np.asarray(rows["last_frame"], dtype=object) == LAST_YES


def _time(micros: int):
    return None if micros == NO_TIME else pd.Timestamp(int(micros), unit="us")


def _assembled(media: str, runs: np.ndarray) -> tuple:
    """The outcome of a publication whose buckets' runs are these."""
    end = runs[-1]
    digest = (int(runs["upper"].sum()) << 30) + int(runs["lower"].sum())
    return ("assembled", media, int(end["high"]) + 1, int(end["high"]), int(end["fps"]), int(end["height"]), int(end["width"]),
            str(digest), _time(runs["since"].min()), _time(runs["until"].max()), None)


def _only(outcome: str, media: str, n: int, until: int, reason: str | None) -> tuple:
    return (outcome, media, n, None, None, None, None, None, None, _time(until), reason)


def join_runs(runs: np.ndarray, apart: int | None) -> np.ndarray:
    """Joins runs, sorted by (since, low), whose ids and times go on; not over a last frame nor
    over more than ``apart`` microseconds."""
    if len(runs) < 2:
        return runs
    a, b = runs[:-1], runs[1:]
    goes_on = (a["high"] + 1 == b["low"]) & (a["until"] <= b["since"]) & ~a["last"]
    if apart is not None:
        goes_on &= b["since"] - a["until"] <= apart
    first = np.flatnonzero(np.append(True, ~goes_on))
    if len(first) == len(runs):
        return runs
    out = runs[first]
    end = np.append(first[1:], len(runs)) - 1
    for c in ("high", "until", "last", "fps", "height", "width"):
        out[c] = runs[c][end]
    for c in ("upper", "lower"):
        out[c] = np.add.reduceat(runs[c], first)
    return out


def _sorted_runs(runs: np.ndarray) -> np.ndarray:
    return runs[np.lexsort((runs["low"], runs["since"]))]


def _inside(spans: np.ndarray, time: np.ndarray) -> np.ndarray:
    """Which times lie inside a span."""
    out = np.zeros(len(time), bool)
    for s in spans:
        out |= (time >= s["since"]) & (time <= s["until"])
    return out


def _seen(runs: np.ndarray, ids: np.ndarray, time: np.ndarray) -> np.ndarray:
    """Which records lie inside a run by id and time.  Runs that hold an id follow each other in
    time, so the last of them that begins no later than the record decides."""
    out = np.zeros(len(ids), bool)
    if len(runs) < 64:
        for r in runs:
            out |= (ids >= r["low"]) & (ids <= r["high"]) & (time >= r["since"]) & (time <= r["until"])
        return out
    order = np.lexsort((runs["since"], runs["low"]))
    by_low = runs[order]
    at = np.searchsorted(by_low["low"], ids, "right") - 1
    left = np.flatnonzero(at >= 0)
    while len(left):
        r = by_low[at[left]]
        out[left] |= (ids[left] <= r["high"]) & (time[left] >= r["since"]) & (time[left] <= r["until"])
        at[left] -= 1
        # a run further left may be longer; runs before the first that covers the id are few
        left = left[(at[left] >= 0) & ~out[left] & (np.maximum.accumulate(by_low["high"])[np.maximum(at[left], 0)] >= ids[left])]
    return out


def fold_bucket(key: tuple, state: tuple | None, rows: Rows | None, apart: int = APART_MS * 1000) -> tuple[tuple | None, list[tuple]]:
    """One micro-batch of one bucket, or its eviction (``rows`` None)."""
    media, start = key[0], int(key[1]) * BUCKET_IDS
    runs = np.frombuffer(state[0], RUN) if state else np.empty(0, RUN)
    spans = np.frombuffer(state[1], SPAN) if state else np.empty(0, SPAN)
    out: list[tuple] = []
    if rows is None:
        runs = join_runs(runs, None)
    else:
        ids, time = _ints(rows, "frame_id"), _ints(rows, "time")
        arrival = np.lexsort((_ints(rows, "offset"), _ints(rows, "partition"), ids, time))
        ids, time = ids[arrival], time[arrival]
        fresh = np.append(True, (ids[1:] != ids[:-1]) | (time[1:] != time[:-1])) & ~_inside(spans, time) & ~_seen(runs, ids, time)
        own = arrival[fresh]
        if len(own) < len(ids):
            out.append((*_only("copies", media, len(ids) - len(own), int(time.max()), None), None))
        if len(own):
            part = _ints(rows, "part")[own]
            new = np.zeros(len(own), RUN)
            new["low"] = new["high"] = ids[fresh]
            new["since"] = new["until"] = time[fresh]
            new["upper"], new["lower"] = part >> 30, part & HALF
            new["last"] = _is_last(rows)[own]
            for c in ("fps", "height", "width"):
                new[c] = np.asarray(rows[c])[own]
            runs = join_runs(_sorted_runs(np.concatenate([runs, join_runs(new, apart)])), apart)
    full = (runs["low"] == start) & (runs["last"] | (runs["high"] == start + BUCKET_IDS - 1))
    for r in runs[full]:
        if start == 0 and r["last"]:
            out.append((*_assembled(media, r.reshape(1)), None))
        else:
            part = np.zeros(1, PART)
            part["bucket"] = key[1]
            for c in RUN.names:
                part[c] = r[c]
            out.append((*_only("part", media, 0, NO_TIME, None), part.tobytes()))
    if full.any():
        spans = np.concatenate([spans, np.array([(r["since"], r["until"]) for r in runs[full]], SPAN)])
        runs = runs[~full]
    if rows is None:  # evicted: what is left is reported, spans go
        return None, out + [(*_only("evicted", media, int(r["high"] - r["low"]) + 1, int(r["until"]), _why(r)), None) for r in runs]
    return (runs.tobytes(), spans.tobytes(), int((runs["high"].astype("<i8") - runs["low"] + 1).sum())), out


def _why(run: np.void) -> str:
    return f"incomplete: frames {run['low']} to {run['high']}" + (", the last one" if run["last"] else "") + " arrived without the others"


def _is_part(rows: Rows) -> np.ndarray:
    return np.asarray(rows["outcome"], dtype=object) == "part"


def _passed(rows: pd.DataFrame, part: np.ndarray) -> pd.DataFrame:
    """The outcomes that the first step has settled."""
    passed = rows.loc[~part, _OUT_COLS].astype(object)
    return passed.where(passed.notna(), None)


def fold_media(key: tuple, state: tuple | None, rows: Rows | None, apart: int = APART_MS * 1000) -> tuple[tuple | None, list[tuple]]:
    """Full buckets of one media, emitted once 0 to the last one follow each other in time."""
    held = np.frombuffer(state[0], PART) if state else np.empty(0, PART)
    out: list[tuple] = []
    if rows is not None:
        own = _is_part(rows)
        if not own.all():
            out = list(_passed(rows, own).itertuples(index=False, name=None))
        held = np.concatenate([held, *(np.frombuffer(p, PART) for p in rows["part"][own])])
    held = held[np.lexsort((held["bucket"], held["since"]))]
    left = np.ones(len(held), bool)
    if len(held):
        a, b = held[:-1], held[1:]
        goes_on = (a["bucket"] + 1 == b["bucket"]) & (a["until"] <= b["since"]) & ~a["last"]
        if rows is not None:
            goes_on &= b["since"] - a["until"] <= apart
        first = np.flatnonzero(np.append(True, ~goes_on))
        for s, e in zip(first, np.append(first[1:], len(held))):
            if held["bucket"][s] == 0 and held["last"][e - 1]:
                out.append(_assembled(key[0], held[s:e]))
                left[s:e] = False
    held = held[left]
    if rows is None:
        return None, out + [_only("evicted", key[0], int(r["high"] - r["low"]) + 1, int(r["until"]), _why(r)) for r in held]
    n = int((held["high"].astype("<i8") - held["low"] + 1).sum())
    return ((held.tobytes(), b"", n) if len(held) else None), out


def _digest_sum(parts: np.ndarray) -> int:
    """Exact sum of 60-bit numbers, in halves that do not overflow."""
    return (int((parts >> 30).sum()) << 30) + int((parts & HALF).sum())


def fold_on_last(key: tuple, state: tuple | None, rows: Rows | None) -> tuple[tuple | None, list[tuple]]:
    """Frames in (partition, offset) order; each last frame ends an entry."""
    n, digest, until = (int(state[0]), int(state[1]), int(state[2])) if state else (0, 0, NO_TIME)
    if rows is None:
        return None, ([_only("evicted", key[0], n, until, "incomplete: no last frame arrived")] if n else [])
    order = np.lexsort((_ints(rows, "offset"), _ints(rows, "partition")))
    part, time = _ints(rows, "part")[order], _ints(rows, "time")[order]
    ends = np.nonzero(_is_last(rows)[order])[0]
    out, props, begin = [], [np.asarray(rows[c])[order] for c in ("frame_id", "fps", "height", "width")], 0
    for e in ends:
        until = max(until, int(time[begin:e + 1].max()))
        out.append(("assembled", key[0], n + int(e) + 1 - begin, *(int(x[e]) for x in props), str(digest + _digest_sum(part[begin:e + 1])),
                    None, _time(until), None))
        n, digest, until, begin = 0, 0, NO_TIME, int(e) + 1
    if begin < len(part):
        n, digest, until = n + len(part) - begin, digest + _digest_sum(part[begin:]), max(until, int(time[begin:].max()))
    return ((n, str(digest), until) if n else None), out


# --- engines ----------------------------------------------------------------------------

class FoldProcessor(StatefulProcessor):
    """``transformWithState`` form of a fold.  With ``ttl_ms`` a timer, set anew by every input,
    evicts the state and yields what the fold says about it."""

    def __init__(self, fold: Fold, state: str, columns: list[str], ttl_ms: int | None = None):
        self.fold, self.state_schema, self.columns, self.ttl_ms = fold, state, columns, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, handle.getValueState("state", self.state_schema)

    def _after(self, key: tuple, rows: pd.DataFrame | None) -> Iterator[pd.DataFrame]:
        current = self.state.get()
        after, out = self.fold(key, tuple(current) if current is not None else None, rows)
        if after is not None:
            self.state.update(after)
        elif current is not None:
            self.state.clear()
        if out:
            yield pd.DataFrame(out, columns=self.columns)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield from self._after(key, pd.concat(list(rows), ignore_index=True))
        if self.ttl_ms:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if self.state.exists():
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.ttl_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._after(key, None)

    def close(self) -> None:
        pass


class ShelfProcessor(StatefulProcessor):
    """``transformWithState`` form of a fold for all keys ``by`` of a group.  With ``settled`` only rows
    that are parts are folded, the others go on as they are."""

    def __init__(self, fold: Fold, by: list[str], keys: str, state: str, columns: list[str], settled: bool):
        self.fold, self.by, self.key_schema, self.state_schema, self.columns, self.settled = fold, by, keys, state, columns, settled

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getMapState("state", self.key_schema, self.state_schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        own = []
        for some in rows:
            if self.settled:
                part = _is_part(some)
                if not part.all():
                    yield _passed(some, part)
                some = some[part]
            if len(some):
                own.append(some)
        if not own:
            return
        frame, out = pd.concat(own, ignore_index=True), []
        arrays = {c: frame[c].to_numpy() for c in frame.columns}
        for at in frame.groupby(self.by, sort=False).indices.values():
            one = tuple(v.item() if isinstance(v, np.generic) else v for v in (arrays[c][at[0]] for c in self.by))
            current = self.state.getValue(one)
            after, found = self.fold(one, tuple(current) if current is not None else None, {c: v[at] for c, v in arrays.items()})
            if after is not None:
                self.state.updateValue(one, after)
            elif current is not None:
                self.state.removeKey(one)
            out += found
        if out:
            yield pd.DataFrame(out, columns=self.columns)

    def close(self) -> None:
        pass


def _group_fn(fold: Fold, columns: list[str], ttl_ms: int | None):
    def run(key, pdfs, state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            after, out = fold(key, tuple(state.get) if state.exists else None, None)
            state.remove()
        else:
            after, out = fold(key, tuple(state.get) if state.exists else None, pd.concat(list(pdfs), ignore_index=True))
            if after is not None:
                state.update(after)
                if ttl_ms:
                    state.setTimeoutDuration(ttl_ms)
            elif state.exists:
                state.remove()
        if out:
            yield pd.DataFrame(out, columns=columns)
    return run


def _stateful(df: DataFrame, by: list[str], fold: Fold, state: str, out, engine: str, ttl_ms: int | None) -> DataFrame:
    grouped, columns = df.groupBy(*by), [f.name for f in out.fields]
    if engine == "shelves":
        shelved = df.withColumn("shelf", F.pmod(F.xxhash64(*by), F.lit(SHELVES)).cast("int"))
        keys = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in by)
        return shelved.groupBy("shelf").transformWithStateInPandas(
            statefulProcessor=ShelfProcessor(fold, by, keys, state, columns, fold_media in (fold, getattr(fold, "func", None))),
            outputStructType=out, outputMode="Append", timeMode="None")
    if engine == "tws":
        return grouped.transformWithStateInPandas(statefulProcessor=FoldProcessor(fold, state, columns, ttl_ms), outputStructType=out,
                                                  outputMode="Append", timeMode="ProcessingTime" if ttl_ms else "None")
    timeout = "ProcessingTimeTimeout" if ttl_ms else "NoTimeout"
    return grouped.applyInPandasWithState(_group_fn(fold, columns, ttl_ms), out, state, "append", timeout)


def reassemble_stream(frames: DataFrame, mode: str = "complete", engine: str | None = None, ttl_ms: int | None = None,
                      apart_ms: int = APART_MS) -> DataFrame:
    """Frame stream (``media_name, frame_id, last_frame, fps, height, width, payload, partition,
    offset`` and optionally ``timestamp``) -> what became of the frames, append mode (T1):

    * ``assembled``: one row per media and publication, ``published_until`` its latest producer time;
    * ``copies``: ``n_frames`` redelivered frames of a media (``complete`` mode);
    * ``evicted``: ``n_frames`` frames whose others did not arrive within ``ttl_ms``, with the reason.

    Records without a media name, a frame id of 0 or more or a payload are not frames; split
    them off first (:func:`lakeframe.operators.frames.split_frames`), else the job fails.
    ``ttl_ms`` (off by default, as in the reference) evicts state that received nothing for that
    long (processing time).  Timeouts make every trigger run another batch, so use it with a
    processing-time trigger (a long-running stream), not ``availableNow``.  ``apart_ms`` parts two
    publications of a name: neighbouring frames of one are never further apart in producer time.
    ``engine`` is ``shelves``, ``tws`` or ``group_state`` (see above); the first has no timers, so no ``ttl_ms``."""
    engine = engine or ("group_state" if ttl_ms else "shelves")
    if mode not in ("complete", "on_last"):
        raise ValueError(mode)
    if engine not in ("shelves", "tws", "group_state") or (engine == "shelves" and ttl_ms):
        raise ValueError(f"engine {engine!r}, ttl_ms {ttl_ms}")
    time = F.unix_micros(F.col("timestamp")) if "timestamp" in frames.columns else F.lit(None).cast("long")
    checked = F.when(F.col("media_name").isNull() | ~F.coalesce(F.col("frame_id") >= 0, F.lit(False)) | F.col("payload").isNull(),
                     F.raise_error(F.lit("not a frame: media name, frame id or payload is missing")).cast("string")).otherwise(F.col("media_name"))
    slim = frames.select(
        checked.alias("media_name"), "frame_id", "last_frame", "fps", "height", "width", "partition", "offset",
        frame_digest(F.col("frame_id"), F.col("payload")).alias("part"), F.coalesce(time, F.lit(NO_TIME)).alias("time"))
    if mode == "on_last":
        return _stateful(slim, ["media_name"], fold_on_last, _LAST_STATE, OUTCOME, engine, ttl_ms)
    slim = slim.withColumn("bucket", F.expr(f"frame_id div {BUCKET_IDS}"))
    parts = _stateful(slim, ["media_name", "bucket"], partial(fold_bucket, apart=apart_ms * 1000), _STATE, _PART_OUT, engine, ttl_ms)
    # Spark takes one applyInPandasWithState per query, so there the second step is the other kind
    return _stateful(parts, ["media_name"], partial(fold_media, apart=apart_ms * 1000), _STATE, OUTCOME,
                     "tws" if engine == "group_state" else engine, ttl_ms)


def assemble_stream(frames: DataFrame, mode: str = "complete", engine: str | None = None, ttl_ms: int | None = None,
                    apart_ms: int = APART_MS) -> DataFrame:
    """The assembled media of :func:`reassemble_stream`, one row per publication."""
    outcomes = reassemble_stream(frames, mode, engine, ttl_ms, apart_ms)
    return outcomes.where(F.col("outcome") == "assembled").select(*[f.name for f in ASSEMBLED.fields])


def pending_frames(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``media_name, n_frames``: frames that wait in the state of a ``complete`` stream (engine
    ``shelves`` or ``group_state``) as of its last micro-batch."""
    def store(operator: int, variable: str | None) -> DataFrame:  # 0: the second step
        reader = spark.read.format("statestore").option("operatorId", operator)
        return (reader.option("stateVarName", variable) if variable else reader).load(checkpoint)

    second = store(0, "state")
    if "user_map_key" in second.columns:
        steps = [s.select("user_map_key.media_name", F.col("user_map_value.n").alias("n")) for s in (second, store(1, "state"))]
    else:
        steps = [second.select("key.media_name", F.col("value.n").alias("n")),
                 store(1, None).select("key.media_name", F.col("value.groupState.n").alias("n"))]
    return steps[0].unionByName(steps[1]).where("n > 0").groupBy("media_name").agg(F.sum("n").alias("n_frames"))


def published_frames(frames: DataFrame, assembled: DataFrame) -> DataFrame:
    """Landed frames of the emitted media, one row each: ``media_name, publication, pos, frame_id,
    payload, fps, height, width`` (K11, A1, O1).

    A publication's frames lie between its first and last producer time (where the mode does not
    know the first: after the publication before it); of redelivered copies the earliest arrival
    counts.  Frames stay rows, spread by (media, frame)."""
    by_age = Window.partitionBy("media_name").orderBy("published_until")
    media = assembled.select(
        F.col("media_name").alias("__media"), F.row_number().over(by_age).alias("publication"),
        F.lag("published_until").over(by_age).alias("__after"), F.col("published_since").alias("__since"), F.col("published_until").alias("__until"),
        F.col("fps").alias("__fps"), F.col("height").alias("__height"), F.col("width").alias("__width"), "last_frame_id")
    begun = F.when(F.col("__since").isNotNull(), F.col("timestamp") >= F.col("__since")).otherwise(
        F.col("__after").isNull() | (F.col("timestamp") > F.col("__after")))
    mine = ((F.col("media_name") == F.col("__media")) & (F.col("frame_id") <= F.col("last_frame_id"))
            & (F.col("__until").isNull() | (F.col("timestamp") <= F.col("__until"))) & begun)
    rows = frames.join(media, mine).withColumn("__key", F.struct("media_name", "publication"))
    return dedupe_frames(rows, "__key").select(
        "media_name", "publication", F.col("frame_id").cast("int").alias("pos"), "frame_id", "payload",
        F.col("__fps").alias("fps"), F.col("__height").alias("height"), F.col("__width").alias("width"))
