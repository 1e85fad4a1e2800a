"""Sharding: minimum-cost-flow resharding of an existing layout.

Documents of an old shard are cut into blocks by a hash of their place in it (so repeated rows
spread like any others), at least ``BLOCKS_PER_SHARD`` to a new shard's size, more where a block
would exceed ``BLOCK_BYTES``.  A minimum-cost flow from old shard sizes to new capacities
(staying is free, a moved byte costs one) says how many bytes each old shard sends where; what
can stay stays, so the network is cut down to one class of surplus bytes and the shards with
room.  The blocks then realise the flow, largest first.  What the driver
handles is the table of blocks, never rows.  The rewrite shuffles texts once, writes the
affected shards and leaves the files of the others alone.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lakeframe.session import scratch

from .common import KEY1, KEY2, keyed, land

ROW_BYTES = 16
BLOCKS_PER_SHARD = 64
BLOCK_BYTES = 256 << 20
FILE_BYTES = 128 << 20
MOST_FILES = 100_000  # names of old files are broadcast up to this number


# --- the flow ---------------------------------------------------------------------------

def min_cost_flow(supply: list[int], capacity: list[int], cost: np.ndarray) -> dict[tuple[int, int], int]:
    """Cheapest way to send all ``supply`` into ``capacity``: successive shortest paths with
    potentials.  ``cost[i, j]`` is the price of a unit from old i to new j."""
    n, m = len(supply), len(capacity)
    if sum(supply) > sum(capacity):
        raise ValueError("the capacities do not hold the supply")
    left, room = list(supply), list(capacity)
    flow: dict[int, dict[int, int]] = defaultdict(dict)  # by new shard: bytes from each old one
    high_old, high_new = np.zeros(n), np.zeros(m)
    while any(left):
        dist_old, dist_new = np.where(np.array(left) > 0, 0.0, np.inf), np.full(m, np.inf)
        from_old, from_new = np.full(m, -1), np.full(n, -1)
        heap = [(0.0, 0, i) for i in range(n) if left[i]]
        done_old, done_new, end = np.zeros(n, bool), np.zeros(m, bool), -1
        while heap:
            d, side, v = heapq.heappop(heap)
            if side == 0 and not done_old[v]:
                done_old[v] = True
                reach = d + cost[v] + high_old[v] - high_new
                for j in np.nonzero(reach < dist_new - 1e-12)[0]:
                    dist_new[j], from_old[j] = reach[j], v
                    heapq.heappush(heap, (reach[j], 1, int(j)))
            elif side == 1 and not done_new[v]:
                done_new[v] = True
                if room[v]:
                    end = v
                    break
                for i in flow[v]:  # bytes already sent here may be sent elsewhere instead
                    back = d - cost[i, v] + high_new[v] - high_old[i]
                    if back < dist_old[i] - 1e-12:
                        dist_old[i], from_new[i] = back, v
                        heapq.heappush(heap, (back, 0, i))
        path, j = [], end
        while True:
            i = int(from_old[j])
            path.append((i, j))
            if from_new[i] < 0:
                break
            j = int(from_new[i])
        amount = min([left[i], room[end], *(flow[int(from_new[a])][a] for a, _ in path if from_new[a] >= 0)])
        for a, b in path:
            flow[b][a] = flow[b].get(a, 0) + amount
            if from_new[a] >= 0:
                back = flow[int(from_new[a])]
                back[a] -= amount
                if not back[a]:
                    del back[a]
        left[i] -= amount
        room[end] -= amount
        reached = dist_new[end]
        high_old += np.minimum(dist_old, reached)
        high_new += np.minimum(dist_new, reached)
    return {(i, j): x for j, own in flow.items() for i, x in own.items() if x}


def fewest_moves(supply: list[int], capacity: list[int]) -> dict[tuple[int, int], int]:
    """The flow that moves the fewest bytes, old ``i`` staying at new ``i`` for nothing and a byte
    costing one on every other way.

    The moved bytes are the total without those that stay, and all of ``min(supply, capacity)`` can
    stay at once, since what is left of the supplies finds room anywhere at the same price.  Left
    over bytes of all old shards are therefore one class: the flow is solved from this class to the
    room left, and dealt back to its members in order, which adds one transfer a member at most."""
    if sum(supply) > sum(capacity):
        raise ValueError("the capacities do not hold the supply")
    stay = [min(s, c) for s, c in zip(supply, capacity)]
    flow = {(i, i): x for i, x in enumerate(stay) if x}
    surplus = [(i, s - (stay[i] if i < len(stay) else 0)) for i, s in enumerate(supply)]
    room = [c - (stay[j] if j < len(stay) else 0) for j, c in enumerate(capacity)]
    moved = min_cost_flow([sum(x for _, x in surplus)], room, np.ones((1, len(room))))
    owing = iter([(i, x) for i, x in surplus if x])
    i, left = next(owing, (0, 0))
    for (_, j), x in sorted(moved.items()):
        while x:
            take = min(x, left)
            flow[i, j] = flow.get((i, j), 0) + take
            x, left = x - take, left - take
            if not left:
                i, left = next(owing, (0, 0))
    return flow


def place_blocks(blocks: list[tuple[int, int, int]], flow: dict[tuple[int, int], int], capacity: list[int]) -> list[int]:
    """New shard of each block ``(old, block, bytes)``: largest first to the target its old shard
    still owes most, at home if that is a tie; then single blocks move from the fullest to the
    emptiest shard, relative to capacity, while that evens them out."""
    owed: dict[int, dict[int, int]] = defaultdict(dict)
    for (i, j), x in flow.items():
        owed[i][j] = x
    where, load = [0] * len(blocks), [0] * len(capacity)
    members: list[set[int]] = [set() for _ in capacity]
    for b in sorted(range(len(blocks)), key=lambda b: (-blocks[b][2], blocks[b][:2])):
        old, _, size = blocks[b]
        targets = owed[old] or {old if old < len(capacity) else 0: 0}
        j = max(targets, key=lambda j: (targets[j], j == old, -j))
        targets[j] -= size
        where[b], load[j] = j, load[j] + size
        members[j].add(b)
    for _ in range(20 * len(capacity)):
        over = [load[j] - capacity[j] for j in range(len(capacity))]
        full, empty = int(np.argmax(over)), int(np.argmin(over))
        gap = over[full] - over[empty]
        best = min(members[full], key=lambda b: (abs(gap - 2 * blocks[b][2]), b), default=None)
        if best is None or not 0 < blocks[best][2] < gap:
            break
        members[full].discard(best), members[empty].add(best)
        where[best] = empty
        load[full] -= blocks[best][2]
        load[empty] += blocks[best][2]
    return where


@dataclass
class Plan:
    """Where each block of each old shard goes."""

    blocks: list[tuple[int, int, int, int, int, int]]  # old, block, bytes, rows, shard, file
    file_start: dict[int, int] = field(default_factory=dict)  # slot of the first row of a file
    affected: set[int] = field(default_factory=set)
    moved_bytes: int = 0


def make_plan(table: list[tuple[int, int, int, int]], shards: int, capacity: list[int] | None = None,
              file_bytes: int = FILE_BYTES) -> Plan:
    """``table``: (old, block, bytes, rows).  Capacities are equal unless given."""
    total = sum(t[2] for t in table)
    olds = max([t[0] for t in table], default=-1) + 1
    if capacity is None:
        capacity = [total * (j + 1) // shards - total * j // shards for j in range(shards)]
    supply = [0] * olds
    for old, _, size, _ in table:
        supply[old] += size
    where = place_blocks([t[:3] for t in table], fewest_moves(supply, capacity), capacity)
    plan, by_shard = Plan([]), defaultdict(list)
    for t, shard in zip(table, where):
        by_shard[shard].append(t)
        if t[0] != shard:
            plan.moved_bytes += t[2]
            plan.affected |= {t[0], shard} & set(range(len(capacity)))
    file = -1
    for shard in sorted(by_shard):
        slot, size = 0, file_bytes
        for t in sorted(by_shard[shard]):
            if size >= file_bytes:
                file, size = file + 1, 0
                plan.file_start[file] = slot
            plan.blocks.append((*t, shard, file))
            size, slot = size + t[2], slot + t[3]
    return plan


# --- the rewrite ------------------------------------------------------------------------

@dataclass
class Layout:
    rows: DataFrame  # the rows with __lf_shard, __lf_slot, __lf_old and __lf_size
    plan: Plan
    path: str  # files of the affected shards, by shard


SHARD, SLOT, OLD, SIZE = "__lf_shard", "__lf_slot", "__lf_old", "__lf_size"


def reshard(docs: DataFrame, shards: int, capacity: list[int] | None = None, text_col: str = "text",
            id_col: str = "doc_id", file_bytes: int = FILE_BYTES) -> Layout:
    """Resharding of a table that Spark reads from files: the i-th file by name is old shard i.

    A row's size is the UTF-8 length of its text (none for NULL) plus 16.  New shards are
    numbered from 0 and get equal byte capacities unless ``capacity`` is given; slots are
    gapless from 0, in the order of old shard, block, id, row.  Affected shards are written
    below ``path``; the rows of the others are read from their old files.  Blocks are cut by a
    hash of the row's number in its file, so any number of repeated rows spreads evenly; where the
    file format does not number rows (all but Parquet) by a hash of the row, and repeated rows stay
    together.  A very long text is a row like any other: its shard is larger by what it exceeds a
    block.  Extra columns move along; names beginning with ``__lf_`` are taken.  An empty table gives an
    empty layout."""
    spark = docs.sparkSession
    size = F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0)).cast("long") + ROW_BYTES
    rows = keyed(docs).withColumns({"__lf_file": F.col("_metadata.file_path"), SIZE: size})
    try:
        rows = rows.withColumn("__lf_cell", F.pmod(F.xxhash64("_metadata.row_index"), F.lit(1 << 20)))
    except AnalysisException:
        rows = rows.withColumn("__lf_cell", F.pmod(KEY1, F.lit(1 << 20)))
    slim = land(rows.groupBy("__lf_file", F.col("__lf_cell").alias("cell")).agg(
        F.sum(SIZE).alias("size"), F.count(F.lit(1)).alias("n")), "sharding_cells")
    files = sorted(tuple(r) for r in slim.groupBy("__lf_file").agg(F.sum("size")).collect())
    total = sum(f[1] for f in files)
    numbered = spark.createDataFrame(
        [(name, i, max(1, -(-BLOCKS_PER_SHARD * shards * own // max(total, 1)), -(-own // BLOCK_BYTES))) for i, (name, own) in enumerate(files)],
        f"__lf_file string, {OLD} int, __lf_blocks int")
    if len(files) <= MOST_FILES:
        numbered = F.broadcast(numbered)
    block = F.pmod("__lf_cell", "__lf_blocks").cast("int")
    cells = slim.join(numbered, "__lf_file").groupBy(OLD, F.pmod("cell", "__lf_blocks").cast("int").alias("block"))
    table = sorted(tuple(r) for r in cells.agg(F.sum("size").cast("long"), F.sum("n").cast("long")).collect())
    plan = make_plan(table, shards, capacity, file_bytes)

    goes = spark.createDataFrame(
        [(old, b, shard, file, plan.file_start[file]) for old, b, _, _, shard, file in plan.blocks],
        T.StructType([T.StructField(OLD, T.IntegerType()), T.StructField("__lf_block", T.IntegerType()), T.StructField(SHARD, T.IntegerType()),
                      T.StructField("__lf_to", T.IntegerType()), T.StructField("__lf_start", T.LongType())]))
    rows = rows.join(numbered, "__lf_file").withColumn("__lf_block", block).join(goes, [OLD, "__lf_block"])
    # One file of a shard is one partition and one window; files are bounded by file_bytes and a block.
    rows = rows.repartitionById(max(1, len(plan.file_start)), F.col("__lf_to"))
    order = Window.partitionBy("__lf_to").orderBy(OLD, "__lf_block", F.isnull(f"`{id_col}`"), F.col(f"`{id_col}`"), KEY1, KEY2)
    rows = rows.withColumn(SLOT, F.col("__lf_start") + F.row_number().over(order) - 1)
    rows = rows.select(*[F.col(f"`{c}`") for c in docs.columns], OLD, SIZE, SLOT, SHARD)

    path = scratch(spark, "llm/sharding_files")
    changed = sorted(plan.affected)
    out = rows.where(F.col(SHARD).isin(changed)) if len(changed) < shards else rows
    out.write.option("compression", "zstd").partitionBy(SHARD).parquet(path)
    schema = T.StructType([f for f in rows.schema.fields if f.name != SHARD] + [T.StructField(SHARD, T.IntegerType())])
    written = spark.read.schema(schema).parquet(path)
    if len(changed) < shards:
        written = written.unionByName(rows.where(~F.col(SHARD).isin(changed)))
    return Layout(written, plan, path)
