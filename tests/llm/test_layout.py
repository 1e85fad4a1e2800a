"""Mixing, sharding and packing."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lakeframe.llm import mixing, packing, queries, sharding

from .conftest import hard_rows, prose

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


# --- mixing -----------------------------------------------------------------------------


def sizes(rows):
    total = Counter()
    for r in rows:
        total[r.source] += r.tokens
    return total


@pytest.mark.parametrize("limit", [1.0, 1.5, 3.0])
def test_repetition_limit_and_cover(spark, hard, limit):
    rows = mixing.mix_sources(hard, max_repetition=limit, block_tokens=500).collect()
    first = [r for r in rows if r.epoch == 0]
    assert Counter(r.doc_id for r in first) == Counter(r[0] for r in hard_rows())  # every row at least once
    total, most = sizes(first), max(sizes(first).values())
    smallest = min(total.values())
    exponent = next(k for k in range(mixing.GRID + 1) if (most / smallest) ** (1 - k / mixing.GRID) <= limit + 1e-9) / mixing.GRID
    emitted = sizes(rows)
    largest_row = max(r.tokens for r in rows)
    for s, n in total.items():
        quota = math.floor(n * (most / n) ** (1 - exponent) + 0.5)
        assert quota <= emitted[s] < quota + largest_row
    assert abs(sum({r.source: r.weight for r in rows}.values()) - 1) < 1e-6


def test_blocks_are_permutations_with_even_shares(spark):
    rng = random.Random(3)
    docs = [(i, prose(rng, "en", 10), "big" if i % 4 else "small") for i in range(2000)]
    rows = mixing.mix_sources(spark.createDataFrame(docs, "doc_id long, text string, source string"), max_repetition=2.0, block_tokens=2000).collect()
    slots, share = defaultdict(list), defaultdict(Counter)
    for r in rows:
        slots[r.block].append(r.slot)
        share[r.block][r.source] += r.tokens
    assert len(slots) > 5 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    weight = {r.source: r.weight for r in rows}
    for own in share.values():
        assert abs(own["small"] / sum(own.values()) - weight["small"]) < 0.02
    order = [r.doc_id for r in sorted((r for r in rows if r.source == "big" and r.epoch == 0), key=lambda r: (r.block, r.slot))]
    assert order != sorted(order)


def test_target_entropy(spark):
    docs = [(i, "w " * n, s) for i, (s, n) in enumerate([("a", 900), ("b", 60), ("c", 30), ("d", 10)])]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    sources = spark.createDataFrame([("a", 900), ("b", 60), ("c", 30), ("d", 10)], "source string, total long")
    k = mixing.find_exponent(sources, 0.8, None, None)

    def entropy(k):
        power = [(n / 1000) ** (k / mixing.GRID) for n in (900, 60, 30, 10)]
        return -sum(p / sum(power) * math.log(p / sum(power)) for p in power)
    assert entropy(k) >= 0.8 * math.log(4) - 1e-9 > entropy(k + 1)
    assert mixing.find_exponent(sources, 0.0, None, None) == mixing.GRID
    assert mixing.find_exponent(sources, 1.0, None, None) <= 2  # equal weights, within the tolerance
    rows = mixing.mix_sources(df, target_entropy=0.8, budget=500).collect()
    assert 500 <= sum(r.tokens for r in rows)  # whole documents, so the quota is met and no more
    with pytest.raises(ValueError):
        mixing.find_exponent(sources, None, 0.5, 1000)


def test_mixing_permutes_rows_without_ids(spark):
    rows = [(None, f"w{i} " * (i % 5 + 1), "s") for i in range(400)] + [(None, "same text", "s")] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix_sources(docs.repartition(3), max_repetition=1.0, block_tokens=200).orderBy("block", "slot").collect()
    assert len(mixed) == 700
    same = [k for k, r in enumerate(mixed) if r.tokens == 2]
    halves = sum(k < 350 for k in same)
    assert len(same) == 380 and abs(halves - 190) < 45  # spread over the order, not in one run


def test_parts_of_a_source_follow_its_tokens(spark, monkeypatch):
    assert [mixing.part_digits(n) for n in (0, 1 << 36, (1 << 36) + 1, 7 * 10 ** 12)] == [3, 3, 4, 5]
    docs = spark.createDataFrame([(i, "a b c " * (i % 4), f"s{i % 3}") for i in range(500)], "doc_id long, text string, source string")
    few = sorted(mixing.mix_sources(docs, max_repetition=2.0, block_tokens=300).collect(), key=str)
    monkeypatch.setattr(mixing, "PART_TOKENS", 0)
    assert sorted(mixing.mix_sources(docs, max_repetition=2.0, block_tokens=300).collect(), key=str) == few


def test_mixing_of_an_empty_table(empty):
    assert mixing.mix_sources(empty, max_repetition=2.0).collect() == []


# --- sharding ---------------------------------------------------------------------------

def cheapest(supply, capacity, cost):
    """Brute force over all integer flows."""
    best = math.inf

    def go(i, room, price):
        nonlocal best
        if price >= best:
            return
        if i == len(supply):
            best = price
            return

        def split(j, left, room, price):
            if j == len(room):
                if not left:
                    go(i + 1, room, price)
                return
            for x in range(min(left, room[j]) + 1):
                split(j + 1, left - x, (*room[:j], room[j] - x, *room[j + 1:]), price + x * cost[i][j])
        split(0, supply[i], room, price)
    go(0, tuple(capacity), 0)
    return best


def test_flow_is_cheapest():
    rng = random.Random(11)
    for _ in range(40):
        n, m = rng.randint(1, 3), rng.randint(1, 3)
        supply = [rng.randint(0, 4) for _ in range(n)]
        capacity = [rng.randint(0, 4) for _ in range(m)]
        capacity[0] += max(0, sum(supply) - sum(capacity))
        cost = [[rng.randint(0, 5) for _ in range(m)] for _ in range(n)]
        flow = sharding.min_cost_flow(supply, capacity, np.array(cost, dtype=float))
        assert [sum(x for (a, _), x in flow.items() if a == i) for i in range(n)] == supply
        assert all(sum(x for (_, b), x in flow.items() if b == j) <= capacity[j] for j in range(m))
        assert sum(x * cost[a][b] for (a, b), x in flow.items()) == cheapest(supply, capacity, cost)


def test_fewest_moves_equals_the_general_flow():
    rng = random.Random(12)
    for _ in range(60):
        n, m = rng.randint(1, 9), rng.randint(1, 6)
        supply = [rng.randint(0, 50) for _ in range(n)]
        total = sum(supply)
        capacity = [total * (j + 1) // m - total * j // m + rng.randint(0, 3) for j in range(m)]
        cost = np.ones((n, m))
        for i in range(min(n, m)):
            cost[i, i] = 0
        flow, general = sharding.fewest_moves(supply, capacity), sharding.min_cost_flow(supply, capacity, cost)
        assert [sum(x for (a, _), x in flow.items() if a == i) for i in range(n)] == supply
        assert all(sum(x for (_, b), x in flow.items() if b == j) <= capacity[j] for j in range(m))
        price = lambda f: sum(x for (a, b), x in f.items() if a != b)
        assert price(flow) == price(general) and all(x > 0 for x in flow.values())


def test_plan_of_many_old_files_takes_seconds():
    import time

    rng = random.Random(13)
    table = [(old, b, rng.randint(1, 200), 1) for old in range(20_000) for b in range(2)]
    began = time.time()
    plan = sharding.make_plan(table, 40)
    assert time.time() - began < 10
    load = Counter()
    for _, _, size, _, shard, _ in plan.blocks:
        load[shard] += size
    assert sum(load.values()) == sum(t[2] for t in table) and max(load.values()) - min(load.values()) <= 200


def test_repeated_rows_spread_over_all_shards(spark, tmp_path):
    text = "the same text again and again, " * 13
    rows = [(1, text)] * 20_000 + [(i, "x" * (i % 700)) for i in range(2, 3000)]
    spark.createDataFrame(rows[:20_000], "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "docs"))
    spark.createDataFrame(rows[20_000:], "doc_id long, text string").coalesce(2).write.mode("append").parquet(str(tmp_path / "docs"))
    layout = sharding.reshard(spark.read.parquet(str(tmp_path / "docs")), 40)
    check_layout(layout, rows, 40)
    load = [r[1] for r in layout.rows.groupBy(sharding.SHARD).agg({sharding.SIZE: "sum"}).collect()]
    assert len(load) == 40 and max(load) - min(load) <= 0.02 * sum(load) / 40


def test_rows_of_other_formats_are_told_by_their_content(spark, hard, tmp_path):
    hard.select("doc_id", "text").write.json(str(tmp_path / "docs"))
    docs = spark.read.schema("doc_id long, text string").json(str(tmp_path / "docs"))
    assert sharding.reshard(docs, 4).rows.count() == len(hard_rows())


def test_plan_moves_little_more_than_the_least():
    rng = random.Random(1)
    table = [(old, b, rng.randint(50, 150), 1) for old, n in enumerate([300, 100, 500, 10]) for b in range(n)]
    plan = sharding.make_plan(table, 6)
    supply = [sum(t[2] for t in table if t[0] == i) for i in range(4)]
    share = sum(supply) / 6
    least = sum(max(0, s - share) for s in supply)
    assert least - 2000 <= plan.moved_bytes <= least + 6 * 300
    load = Counter()
    for _, _, size, _, shard, _ in plan.blocks:
        load[shard] += size
    assert max(load.values()) - min(load.values()) <= 150


def check_layout(layout, rows, shards):
    got = layout.rows.collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    by = defaultdict(list)
    for r in got:
        by[r[sharding.SHARD]].append(r[sharding.SLOT])
        assert r[sharding.SIZE] == len((r.text or "").encode()) + 16
    assert set(by) <= set(range(shards)) and all(sorted(s) == list(range(len(s))) for s in by.values())
    return got


def test_layout_of_hard_rows(spark, hard, tmp_path):
    hard.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    got = check_layout(sharding.reshard(docs, 5), hard_rows(), 5)
    assert set(docs.columns) <= set(got[0].asDict())


def test_shards_that_need_no_change_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "docs")
    docs = [(i, "x" * 84) for i in range(400)]
    spark.createDataFrame(docs, "doc_id long, text string").repartition(4).write.parquet(path)
    table = spark.read.parquet(path)
    per_file = sorted(r[1] for r in table.groupBy("_metadata.file_path").count().collect())
    assert per_file == [100] * 4
    layout = sharding.reshard(table, 5, capacity=[10_000, 10_000, 10_000, 9_000, 1_000])
    assert layout.plan.affected == {3, 4} and layout.plan.moved_bytes <= 1_500
    check_layout(layout, docs, 5)
    written = {r[0].split(f"{sharding.SHARD}=")[1].split("/")[0] for r in spark.read.parquet(layout.path).select("_metadata.file_path").distinct().collect()}
    assert written == {"3", "4"}


def test_layout_of_an_empty_table(spark, empty, tmp_path):
    empty.write.parquet(str(tmp_path / "docs"))
    assert sharding.reshard(spark.read.parquet(str(tmp_path / "docs")), 4).rows.collect() == []


# --- packing ----------------------------------------------------------------------------

def check_packed(rows, texts, capacity):
    """``texts``: every document's text.  Pieces rebuild the ids; places are gapless."""
    whole = Tokenizer.from_file(VOCABULARY)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for own in by_sequence.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(x.length for x in own[:i]) for i in range(len(own))]
        assert sum(r.length for r in own) <= capacity.tokens and len(own) <= capacity.documents
        assert sum(r.length ** 2 for r in own) <= capacity.attention
    for doc, text in texts.items():
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        own = sorted(by_doc[doc], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert [r.start for r in own] == [sum(x.length for x in own[:i]) for i in range(len(own))]
        assert sum(r.length for r in own) == len(ids) and all(r.length == capacity.longest for r in own[1:])
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes()) for r in own)


def test_packed_documents_round_trip(spark, hard):
    rows = hard_rows()
    once = {i for i, n in Counter(r[0] for r in rows).items() if n == 1}
    texts = {r[0]: r[1] for r in rows if r[0] in once}
    got = packing.pack_documents(hard, VOCABULARY, keep_ids=True).collect()
    check_packed([r for r in got], texts, packing.Capacity())
    assert all(len(r.ids) == r.length for r in got)
    assert sum(r.piece == 0 for r in got) == len(rows)


def test_every_capacity_holds(spark):
    rng = random.Random(6)
    docs = [(i, prose(rng, "en", rng.choice([0, 0, 0, 5, 30, 90]))) for i in range(400)]
    for attention in (64 * 40, 64 * 64):  # the first one holds no piece of over 50 tokens, so documents are cut by it
        capacity = packing.Capacity(tokens=64, documents=3, attention=attention)
        for score in ("norm", "dot"):
            rows = packing.pack_documents(spark.createDataFrame(docs, "doc_id long, text string"), VOCABULARY, capacity, score).collect()
            check_packed(rows, dict(docs), capacity)
            by = defaultdict(list)
            for r in rows:
                by[r.sequence_id].append(r.length)
            assert all(sum(x) <= 64 and len(x) <= 3 and sum(n * n for n in x) <= attention for x in by.values())


def test_a_piece_beyond_a_capacity_raises(spark):
    found = spark.createDataFrame([(1, 0, 60), (2, 0, 5)], "row long, piece int, length long")
    for capacity in (packing.Capacity(tokens=64, documents=3, attention=2560), packing.Capacity(tokens=50), packing.Capacity(documents=0)):
        with pytest.raises(ValueError, match="beyond a capacity"):
            packing.pack(found, capacity)
    with pytest.raises(ValueError, match="beyond a capacity"):
        packing.vector_best_fit(np.array([[0.5, 0.1, 1.2]]))


def plain_best_fit(demand, score):
    """Vector best fit over all open bins, item by item."""
    weight = demand.mean(axis=0) / demand.mean(axis=0).sum()
    bins, where = [], {}
    for i in sorted(range(len(demand)), key=lambda i: (-demand[i][0], -demand[i][2], i)):
        best, at = None, None
        for b, left in enumerate(bins):
            if all(left[d] - demand[i][d] >= -1e-9 for d in range(3)):
                value = (-sum(left[d] * weight[d] * demand[i][d] for d in range(3)) if score == "dot"
                         else sum((left[d] - demand[i][d]) ** 2 * weight[d] for d in range(3)))
                if best is None or value < best - 1e-12:
                    best, at = value, b
        if at is None:
            bins.append([1.0] * 3)
            at = len(bins) - 1
        bins[at] = [bins[at][d] - demand[i][d] for d in range(3)]
        where[i] = at
    return bins, where


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_best_fit_equals_the_plain_form(score):
    rng = np.random.default_rng(9)
    for tokens, documents, attention in ((64, 100, 64 * 64), (64, 3, 64 * 64), (64, 8, 64 * 20)):
        capacity = packing.Capacity(tokens, documents, attention)
        lengths = rng.integers(1, capacity.longest + 1, 300)
        got = packing.vector_best_fit(capacity.of(lengths), score)
        bins, where = plain_best_fit(capacity.of(lengths), score)
        assert len(set(got.tolist())) == len(bins)
        # ties aside, every sequence holds the same lengths
        contents = lambda at: sorted(sorted(int(lengths[i]) for i in range(300) if at[i] == b) for b in range(len(bins)))
        assert contents(got) == contents(where)


def test_packing_is_tight_over_many_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 50)
    rng = random.Random(7)
    docs = [(i, prose(rng, "en", rng.randrange(1, 1500))) for i in range(600)]
    rows = packing.pack_documents(spark.createDataFrame(docs, "doc_id long, text string"), VOCABULARY).collect()
    check_packed(rows, {}, packing.Capacity())
    assert len({r.sequence_id for r in rows}) <= 1.02 * sum(r.length for r in rows) / 2048 + 1


def test_fast_ids_equal_those_of_the_tokenizer():
    fast, whole = packing.ByteBpe(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    rng = random.Random(12)
    ranges = [(0, 0x250), (0x250, 0x3000), (0x3000, 0xD800), (0xE000, 0x11000), (0x1F300, 0x1FB00), (0x10000, 0x11000)]
    texts = ["", "<|endoftext|> a <|endoftext|>", "a  b\n\n c d e\u0085f", "'S 's ' s", "a" * 3000]
    for _ in range(1500):
        low, high = rng.choice(ranges)
        texts.append("".join(rng.choice([chr(rng.randrange(low, high)), rng.choice(" \n\t'ab1.")]) for _ in range(rng.randrange(40))))
    for t in texts:
        assert list(fast.ids(t))[:-1] == whole.encode(t, add_special_tokens=False).ids, ascii(t)


def test_packing_of_an_empty_table(empty):
    assert packing.pack_documents(empty, VOCABULARY).collect() == []


def test_reshard_query_over_the_table(spark):
    rows = queries.op3_reshard(spark, "/root/testdata/sf0.01").collect()
    loads = Counter()
    for r in rows:
        loads[r["shard"]] += r["size"]
    assert len(loads) == 40 and max(loads.values()) < 1.05 * min(loads.values())
