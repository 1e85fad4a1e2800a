"""N-gram Jaccard join and tokenizer alignment against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers

from lakeframe.llm import alignment, jaccard_join
from tools.check_oracles import digest, duck

from .conftest import hard_rows, prose
from .test_dedup import classes

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# --- Jaccard join -----------------------------------------------------------------------

def token_set(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def reachable(rows, percent=90):
    """Component of each position, by all pairs."""
    sets = [token_set(r[1]) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    return sets, classes(links, range(len(rows)))


def smallest_id(rows, roots):
    first = {}
    for i, r in enumerate(rows):
        key = (r[0] is None, r[0] or 0)
        first[roots[i]] = min(first.get(roots[i], key), key)
    return [None if first[roots[i]][0] else first[roots[i]][1] for i in range(len(rows))]


def near_rows(seed, bases=6, copies=30):
    """Groups of copies with one to many edits, some near 0.9, some far below."""
    rng = random.Random(seed)
    rows = []
    for _ in range(bases):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.choice([8, 30, 90, 250]))]
        for _ in range(copies):
            own = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                own[rng.randrange(len(own))] = f"x{rng.randrange(1000)}"
            rows.append((len(rows), " ".join(own)))
    return rows


@pytest.mark.parametrize("seed,block,percent", [(1, 4096, 90), (2, 16, 90), (3, 4096, 70)])
def test_jaccard_join_equals_all_pairs(spark, monkeypatch, seed, block, percent):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)  # lists of over 16 entries are cut into slices
    rows = near_rows(seed)
    got = jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), percent=percent).collect()
    sets, roots = reachable(rows, percent)
    want = dict(zip((r[0] for r in rows), smallest_id(rows, roots)))
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == {r[0]: len(s) for r, s in zip(rows, sets)}


def test_jaccard_join_of_hard_rows(hard, empty):
    rows = hard_rows()
    sets, roots = reachable(rows)
    want = Counter((r[0], len(s), c) for r, s, c in zip(rows, sets, smallest_id(rows, roots)))
    got = jaccard_join.jaccard_join(hard)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == want
    assert jaccard_join.jaccard_join(empty).collect() == []


def test_a_prefix_of_l_more_tokens_shares_l(spark):
    """Linked sets share the smaller l of both prefixes, whatever l each has chosen."""
    rng = random.Random(5)
    counts = np.array([rng.choice([1, 3, 50, 4000]) for _ in range(1 << jaccard_join.CELL_BITS)])
    levels = set()
    for _ in range(300):
        base = np.unique(np.array([rng.getrandbits(64) for _ in range(rng.choice([12, 40, 200, 700]))], np.uint64))
        other = np.unique(np.append(base[:len(base) - rng.randrange(len(base) // 10 + 1)], [np.uint64(rng.getrandbits(64))]))
        both = len(np.intersect1d(base, other))
        if jaccard_join.linked(both, len(base), len(other), 90):
            (l1, p1), (l2, p2) = (jaccard_join.choose_prefix(s, counts, 1.0, 90) for s in (base, other))
            assert len(np.intersect1d(p1, p2)) >= min(l1, l2)
            levels |= {l1, l2}
            differing = np.bitwise_count(jaccard_join.parities(base) ^ jaccard_join.parities(other)).sum()
            assert differing <= len(base) + len(other) - 2 * both
    assert len(levels) > 1


def test_neighbours_of_a_list_are_kept_over_batches():
    rng = random.Random(8)
    rows = sorted((rng.randrange(30), rng.choice([10, 11, 50, 52, 200])) for _ in range(200))
    rows = [(t, i, n) for i, (t, n) in enumerate(rows)]
    for size in (1, 2, 3, 50, 500):
        batches = [pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows[at:at + size]], pa.int64()) for c in range(3)], names=["token", "node", "n"])
                   for at in range(0, len(rows), size)]
        got = [i for b in jaccard_join._neighbour_batches(90)(iter(batches)) for i in b.column("node").to_pylist()]
        near = {k for i, j in zip(rows, rows[1:]) if i[0] == j[0] and 100 * i[2] >= 90 * j[2] for k in (i[1], j[1])}
        assert got == sorted(near | {0, len(rows) - 1})


def test_a_group_of_near_copies_costs_links_in_proportion(spark):
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(words[:i % 200] + [f"x{i}"] + words[i % 200 + 1:])) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    keyed = jaccard_join.keyed(docs).select(jaccard_join.KEY1, jaccard_join.KEY2, "doc_id", "text")
    _, nodes = jaccard_join._nodes(spark, keyed, 3, 90)
    assert jaccard_join.jaccard_links(keyed, nodes, 3, 90).count() < 20 * len(rows)
    assert {r.component_id for r in jaccard_join.jaccard_join(docs).collect()} == {0}


def test_the_sql_of_the_jaccard_join_equals_all_pairs():
    rows = near_rows(4, bases=3, copies=20) + [(1000, None), (1001, ""), (1002, "one"), (1003, "ONE"), (1004, "one two")]
    con = duck("/root/testdata/sf0.001")
    con.execute("DROP VIEW documents")
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    sets, roots = reachable(rows)
    want = [(r[0], len(s), c) for r, s, c in zip(rows, sets, smallest_id(rows, roots))]
    got = con.execute(jaccard_join.ORACLE).fetchall()
    assert digest(["a", "b", "c"], got) == digest(["a", "b", "c"], want)


# --- alignment --------------------------------------------------------------------------

def spans_of(pieces):
    out, at = [], 0
    for p in pieces:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def aligned(texts):
    """The definition, token by token, with the tokenizers themselves."""
    import sentencepiece
    from tokenizers import Tokenizer

    from lakeframe.llm.packing import _byte_alphabet

    a, b, plain = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH), _byte_alphabet()
    a.encode_special_tokens = True
    docs, counts = [], Counter()
    for text in texts:
        links, groups, n = [], [], (0, 0)
        if text:
            found = a.encode(" " + text, add_special_tokens=False)
            a_ids, b_ids = found.ids, b.encode(text)
            a_parts = [bytes(plain[c] for c in t) for t in found.tokens]
            b_parts = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in b_ids]
            if b"".join(a_parts) == b"".join(b_parts) == (" " + text).encode():
                a_at, b_at = spans_of(a_parts), spans_of(b_parts)
                links = [(x, y) for x, (s, e) in zip(a_ids, a_at) for y, (u, v) in zip(b_ids, b_at) if s < v and u < e]
                low = 0
                for end in sorted({e for _, e in a_at} & {e for _, e in b_at}):
                    groups.append("|".join(",".join(str(i) for i, (s, e) in zip(ids, at) if low <= s and e <= end) for ids, at in ((a_ids, a_at), (b_ids, b_at))))
                    low = end
                n = (len(a_ids), len(b_ids))
        counts.update(links)
        docs.append((n, links, groups))
    best = {}
    for (_, y), many in counts.items():
        best[y] = max(best.get(y, 0), many)
    return [(*n, len(groups), len(links), sum(counts[k] == best[k[1]] for k in links), sum(counts[k] for k in links),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "") for n, links, groups in docs]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("table", [alignment.TABLE, 200, 0])
def test_alignment_equals_the_definition(spark, table):
    texts = [prose(random.Random(i), "de" if i % 2 else "en", 30) for i in range(20)] + [
        None, "", " ", "  two  spaces ", "\n\ttabs", "a▁b", "<|endoftext|> and <s>text</s> <0x41>", "Ünïcödé 😀 ẞ İ ﬁ é", "a\0b", "x" * 3000, "日本語テキスト"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in alignment.align(docs, A_PATH, B_PATH, table=table).collect()}
    assert [got[i] for i in range(len(texts))] == aligned(texts)


def test_alignment_of_hard_rows(hard, empty):
    rows = hard_rows()
    keep = [r for r in rows if len(r[1] or "") < 12000]
    got = Counter((r.doc_id, *(r[c] for c in COLUMNS[:4]), r.groups_sha256) for r in alignment.align(hard, A_PATH, B_PATH).collect())
    want = Counter((r[0], *x[:4], x[6]) for r, x in zip(keep, aligned([r[1] for r in keep])))
    assert sum(got.values()) == len(rows) and want <= got
    assert alignment.align(empty, A_PATH, B_PATH).collect() == []


@pytest.mark.parametrize("most", [1, 3, 9])
def test_pointer_jumping_labels_components(most):
    rng = random.Random(most)
    for _ in range(200):
        total = rng.randrange(1, 60)
        tilings = []
        for _ in range(2):
            left, parts = total, []
            while left:
                parts.append(min(left, rng.randrange(1, most + 1)))
                left -= parts[-1]
            tilings.append(np.array(parts))
        a, b = alignment.pointer_groups(alignment.Spans.of(*tilings))
        common = sorted(set(np.cumsum(tilings[0])) & set(np.cumsum(tilings[1])))
        for parts, label in zip(tilings, (a, b)):
            assert label.tolist() == [sum(c < e for c in common) for e in np.cumsum(parts)]


def test_alignment_checks_the_bytes_of_texts_together():
    voc = alignment.vocabularies(A_PATH, B_PATH)
    texts = ["ok", None, "two  ", "", "a▁b", "ﬁ ﬀ", "日本 😀", "a\x00b", "<0x41> <|endoftext|>", "x" * 300]
    a, b, n_a, n_b = voc.encode(texts)
    at_a, at_b = np.cumsum(n_a), np.cumsum(n_b)
    for i, text in enumerate(texts):
        own_a, own_b = a[at_a[i] - n_a[i]:at_a[i]].tolist(), b[at_b[i] - n_b[i]:at_b[i]].tolist()
        want_a, want_b = (voc.a.encode_ordinary(" " + text), voc.b.encode(text)) if text else ([], [])
        whole = (" " + text).encode() if text else b""
        if b"".join(voc.a_bytes[k] for k in want_a) != whole or b"".join(voc.b_bytes[k] for k in want_b) != whole:
            want_a = want_b = []
        assert (own_a, own_b) == (want_a, want_b)
    assert 0 < sum(n_a == 0) < len(texts) and not len(voc.encode([])[0])
