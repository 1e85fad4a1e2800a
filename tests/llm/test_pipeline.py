"""The pipeline, stage by stage against brute force, and the SQL of the queries."""

import re
import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest

import corpus_pipeline
from lakeframe.llm import mixing, queries
from tools.check_oracles import digest, duck

from .conftest import hard_rows
from .test_dedup import classes, plain, reference_fingerprint

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_stages_keep_and_drop_the_right_rows(spark, hard):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash_dedup", "mix_sources", "pack"]
    docs = corpus_pipeline.land(hard, "test_input")
    for name, stage in corpus_pipeline.STAGES:
        before, out = rows_of(docs), stage(spark, docs, SF)
        if name == "pack":
            assert sum(r.piece == 0 for r in out.collect()) == sum(before.values())
            break
        out = corpus_pipeline.land(out, "test_stage")
        assert out.columns == docs.columns
        after = rows_of(out)
        if name == "language_id":
            assert after <= before
            gone = {r[1] for r in before - after}
            assert {None, "", " \t\n", "123 456 !!!"} <= gone
        elif name == "exact_dedup":
            assert after <= before and Counter(plain(r[1]) for r in after.elements()) == Counter({plain(r[1]) for r in before})
        elif name == "simhash_dedup":
            prints = {r: reference_fingerprint(r[1]) for r in before}
            links = [(a, b) for a in before for b in before if (prints[a] ^ prints[b]).bit_count() <= 2]
            of = classes(links, before)
            assert after <= before and Counter(of[r] for r in after.elements()) == Counter(set(of.values()))
            for r in after:
                own = [x[0] for x in before if of[x] == of[r] and x[0] is not None]
                assert r[0] == (min(own) if own else None)
        else:
            assert set(after) == set(before)
            mixed = Counter(r.doc_id for r in mixing.mix_sources(docs, **corpus_pipeline.MIXING).collect())
            assert Counter(r[0] for r in after.elements()) == mixed
        docs = out


def test_run_over_tables(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and all(r.length <= 2048 for r in rows)


def test_run_on_an_empty_table(spark, empty, tmp_path):
    empty.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_copies_of_repeated_rows_are_counted_together(spark):
    docs = spark.createDataFrame([(1, "a b", "s", 1)] * 3 + [(2, "c", "t", 2)], "doc_id long, text string, source string, extra int")
    assert rows_of(corpus_pipeline.mix(spark, docs, SF))[(1, "a b", "s", 1)] == 3
    assert rows_of(corpus_pipeline.drop_exact_copies(spark, docs, SF)) == Counter({(1, "a b", "s", 1): 1, (2, "c", "t", 2): 1})


def test_rows_that_differ_in_a_map_alone_are_different_rows(spark):
    from lakeframe.llm.common import KEY1, keyed

    schema = "doc_id long, text string, source string, extra map<string,int>, deep array<struct<m: map<string,array<int>>>>"
    rows = [(1, "a b", "s", {"a": 1, "b": 2}, None), (1, "a b", "s", {"b": 2, "a": 1}, None), (1, "a b", "s", {"a": 1, "b": 3}, None),
            (1, "a b", "s", None, [({"k": [1]},)]), (1, "a b", "s", None, [({"k": [2]},)]), (1, "a b", "s", None, [(None,)])]
    docs = spark.createDataFrame(rows, schema)
    assert keyed(docs).select(KEY1).distinct().count() == 5  # the first two are equal
    kept = corpus_pipeline.mix(spark, docs, SF).collect()
    assert len(kept) == 6
    assert sum(r.extra == {"a": 1, "b": 3} for r in kept) == 1 and sum(r.extra == {"a": 1, "b": 2} for r in kept) == 2


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    df = queries.QUERIES[name](spark, SF)
    res = duck(SF).execute(queries.ORACLES[name])
    columns, want = [d[0] for d in res.description], res.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(columns, want)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_every_query_covers_its_table(spark, name):
    table, ident = {"op10": ("pages", "page_id"), "op13": ("embeddings", "vec_id")}.get(name.split("_")[0], ("documents", "doc_id"))
    got = queries.QUERIES[name](spark, SF)
    assert {r[0] for r in got.select(ident).distinct().collect()} == {r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(ident).collect()}


def test_nothing_else_imports_the_subpackage():
    root = Path(corpus_pipeline.__file__).parent
    code = "import sys; sys.modules['lakeframe.llm'] = None\nfrom lakeframe import registry\nassert registry.queries()"
    assert subprocess.run([sys.executable, "-c", code], cwd=root).returncode == 0
    for path in (root / "lakeframe").rglob("*.py"):
        if "llm" not in path.parts:
            assert not re.search(r"import.*\bllm\b|lakeframe\.llm|corpus_pipeline", path.read_text()), path


def test_hard_rows_are_hard():
    rows = hard_rows()
    assert any(r[0] is None for r in rows) and any(r[1] is None for r in rows) and max(Counter(rows).values()) == 3
