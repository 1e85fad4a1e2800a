"""Language ID, sketches, secret scan and URL filter."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from lakeframe.llm import language_id, queries, secret_scan, sketches, url_filter

from .conftest import hard_rows, prose

SF = "/root/testdata/sf0.01"


# --- language ID ------------------------------------------------------------------------

def brute_kneser_ney(texts, order, vocabulary):
    """p(symbol after history) straight from the definition, for one language."""
    grams = Counter()
    for t in texts:
        code, owner, _ = language_id.symbols([t])
        for p in np.nonzero(owner >= 0)[0]:
            grams[tuple(int(c) for c in code[p - order + 1:p + 1])] += 1
    by_order = {order: grams}
    for k in range(order - 1, 0, -1):
        by_order[k] = Counter(g[1:] for g in by_order[k + 1])

    def p(gram):
        k = len(gram)
        if k == 0:
            return 1 / (vocabulary + 1)
        table = by_order[k]
        ones, twos = sum(n == 1 for n in table.values()), sum(n == 2 for n in table.values())
        d = ones / (ones + 2 * twos) if ones and twos else 0.5
        same = {g: n for g, n in table.items() if g[:-1] == gram[:-1]}
        if not same:
            return p(gram[1:])
        total = sum(same.values())
        return max(table.get(gram, 0) - d, 0) / total + d * len(same) / total * p(gram[1:])
    return p


def test_model_is_interpolated_kneser_ney():
    rng = random.Random(5)
    texts = {lang: [prose(rng, lang, 12) for _ in range(6)] for lang in ("en", "de")}
    counts = {}
    for lang, own in texts.items():
        code, owner, _ = language_id.symbols(own)
        ends = np.nonzero(owner >= 0)[0]
        grams, n = np.unique(code[ends[:, None] + np.arange(1 - language_id.ORDER, 1)], axis=0, return_counts=True)
        counts[lang] = (grams, n)
    model = language_id.fit(counts)
    probe = "the und xylo and schön zq"
    code, owner, _ = language_id.symbols([probe])
    entropy, size, _ = model.cross_entropies([probe])
    seen = set()
    for own in texts.values():
        every, whose, _ = language_id.symbols(own)
        seen |= {int(c) for c in every[whose >= 0]}
    for i, lang in enumerate(model.languages):
        p = brute_kneser_ney(texts[lang], language_id.ORDER, len(seen))
        ends = np.nonzero(owner >= 0)[0]
        want = -sum(math.log(p(tuple(int(c) for c in code[e - language_id.ORDER + 1:e + 1]))) for e in ends) / len(ends)
        assert abs(entropy[0, i] - want) < 1e-4 and size[0] == len(ends)


def test_slices_do_not_change_a_score(monkeypatch):
    rng = random.Random(2)
    own = [prose(rng, "en", 200), prose(rng, "de", 300), "", "x"]
    code, owner, _ = language_id.symbols([prose(rng, "en", 500)])
    ends = np.nonzero(owner >= 0)[0]
    grams, n = np.unique(code[ends[:, None] + np.arange(1 - language_id.ORDER, 1)], axis=0, return_counts=True)
    model = language_id.fit({"en": (grams, n)})
    whole = model.cross_entropies(own)[0]
    monkeypatch.setattr(language_id, "SLICE", 37)
    assert np.allclose(model.cross_entropies(own)[0], whole)
    assert np.allclose(model.cross_entropies(own[1:2])[0][0], whole[1])


def test_held_out_accuracy_and_rejection(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries.op6_language_id(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    out = [r for r in got if r.held_out]
    assert sum(r.lang_pred == r.lang for r in out) / len(out) > 0.99
    assert sum(r.rejected for r in got) <= 0.002 * len(got)


def test_language_of_hard_rows(spark, hard, empty):
    model = language_id.train(hard)
    rows = language_id.identify(hard, model).collect()
    assert len(rows) == len(hard_rows())
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert all(by[i].lang_pred == "und" and by[i].rejected and by[i].score == 0 for i in (104, 105, 106, 107))
    assert by[100].lang_pred == "en" and by[108].lang_pred in ("en", "de")
    kept = language_id.keep_identified(hard, model)
    assert kept.columns == hard.columns and kept.count() == sum(not r.rejected for r in rows)
    none = language_id.train(empty)
    assert language_id.identify(empty, none).collect() == []
    assert all(r.rejected and r.lang_pred == "und" for r in language_id.identify(hard, none).collect())


def test_every_labelled_language_is_learned(spark):
    rng = random.Random(6)
    rows = [(i, prose(rng, "en", 50), "en") for i in range(300)]
    rows += [(1000 + i, prose(rng, "de", 3000), f"long{i // 3}") for i in range(30)] + [(2000 + i, prose(rng, "de", 20), f"lone{i}") for i in range(20)]
    rows += [(3000, "123", "few"), (3001, "", "few"), (3002, "ein wort", "few"), (3003, "456", "few")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want = docs.where(~language_id.held_out("doc_id") & docs.text.rlike("[a-z]")).select("lang").distinct().collect()
    assert language_id.train(docs, sample_chars=20_000).languages == sorted(r.lang for r in want)


def test_a_language_left_out_of_training_is_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang IS NOT NULL")
    rows = [(r.text or "", r.lang) for r in docs.select("text", "lang").collect()]
    rows = [r for r in rows if any(c.isalpha() for c in r[0])]
    languages = sorted({lang for _, lang in rows})
    assert len(languages) == 4
    for out in languages:
        model = language_id.train(docs.where(docs.lang != out))
        rejected = model.predict([t for t, _ in rows])[2]
        foreign = np.array([lang == out for _, lang in rows])
        assert rejected[foreign].mean() > 0.8 and rejected[~foreign].mean() < 0.01


def test_noise_is_rejected(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.train(docs)
    rng = random.Random(0)
    noise = ["".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(400)), "漢字仮名交じり文" * 40]
    assert list(model.predict(noise)[2]) == [True, True]


# --- sketches ---------------------------------------------------------------------------

def neighbours(rows):
    order = sorted(rows, key=lambda r: -r[0])
    return {r[0]: (r[1] or "", order[(k + 1) % len(order)][1] or "") for k, r in enumerate(order)}


def test_edited_texts_and_estimates(spark):
    rng = random.Random(4)
    rows = [(i * i, prose(rng, "en", rng.choice([0, 1, 4, 30, 400]))) for i in range(150)] + [(-5, None), (7, "😀 é" * 31)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in sketches.edited_fingerprints(docs, words=2, scale=2).collect()}
    assert len(got) == len(rows)
    off = []
    for i, (text, after) in neighbours(rows).items():
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        assert got[i].n_chars == len(text) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()

        def grams(t):
            w = t.split()
            return {tuple(w[j:j + 2]) for j in range(len(w) - 1)}
        if len(text.split()) >= 100:
            off.append(abs(got[i].near_edited - len(grams(text) & grams(edited)) / len(grams(text))))
    assert off and sum(off) / len(off) < 0.1


@pytest.mark.parametrize("n", [1, 2, 3])
def test_neighbours_of_few_documents(spark, n):
    rows = [(i, f"text number {i} of few") for i in range(n)]
    got = {r.doc_id: r for r in sketches.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (text, after) in neighbours(rows).items():
        half = len(text) // 2
        assert got[i].edited_sha256 == hashlib.sha256((text[:len(text) - half] + after[:half]).encode()).hexdigest()


@pytest.mark.parametrize("rows_per_range, most_cuts", [(2000, 65536), (7, 65536), (7, 3), (1, 2)])
def test_neighbours_over_ranges_null_ids_and_ties(spark, monkeypatch, rows_per_range, most_cuts):
    monkeypatch.setattr(sketches, "ROWS_PER_RANGE", rows_per_range)
    monkeypatch.setattr(sketches, "MOST_CUTS", most_cuts)
    rng = random.Random(rows_per_range)
    ids = [rng.randrange(300) for _ in range(150)] + [None] * 80
    docs = spark.createDataFrame([(d, f"text {i}") for i, d in enumerate(ids)], "doc_id long, text string").repartition(4)
    rows = sketches.fingerprints(docs).drop("sketch")
    got = {r.text: r.next_text for r in sketches.with_next(rows, ["text"]).collect()}
    order = sorted(rows.collect(), key=lambda r: (r.doc_id is None, -(r.doc_id or 0), r[0], r[1]))
    assert got == {r.text: order[(k + 1) % len(order)].text for k, r in enumerate(order)} and len(got) == len(ids)


def test_a_text_inside_another_is_never_at_zero(spark):
    rng = random.Random(12)
    rows = []
    for i in range(120):
        words = [f"w{rng.randrange(10 ** 6)}" for _ in range(rng.randrange(20, 60))]
        n = i % 12 + 1
        start = rng.randrange(len(words) - n)
        rows += [(4 * i + 1, " ".join(words[start:start + n])), (4 * i, " ".join(words))]
        rows += [(4 * i - 1, " ".join(reversed(words[start:start + n])) + " z"), (4 * i - 2, "other " + " ".join(words[:n]))]
    got = {r.doc_id: r for r in sketches.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[4 * i + 1].near_next > 0 for i in range(120))
    assert all(got[4 * i + 1].near_next == 1 for i in range(120) if i % 12 + 1 <= 5)
    assert all(got[4 * i - 1].near_next == 0 for i in range(120))


def test_sketches_of_hard_rows(hard, empty):
    rows = sketches.edited_fingerprints(hard).collect()
    assert len(rows) == len(hard_rows()) and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    by = {r.doc_id: r for r in rows}
    assert by[104].fingerprint == by[105].fingerprint == by[106].fingerprint == "" and by[107].fingerprint
    assert sketches.edited_fingerprints(empty).collect() == []


def test_sketches_merge_and_contain(spark):
    rng = random.Random(9)
    words = [f"w{rng.randrange(5000)}" for _ in range(4000)]
    rows = [(" ".join(words[:2000]), " ".join(words[1996:]), " ".join(words))]
    df = spark.createDataFrame(rows, "a string, b string, ab string")
    for c in ("a", "b", "ab"):
        df = sketches.with_sketch(df, c, f"s_{c}")
    r = df.select(sketches.merged(df.s_a, df.s_b).alias("m"), "s_ab", sketches.containment(df.s_a, df.s_ab).alias("inside"),
                  sketches.containment(df.s_ab, df.s_a).alias("outside")).first()
    assert r.m == r.s_ab and r.inside == 1.0 and 0.4 < r.outside < 0.6


# --- secrets ----------------------------------------------------------------------------

def brute_spans(text, scope=secret_scan.SCOPE):
    found = []
    for rank, p in enumerate(secret_scan.PATTERNS):
        regex = r"[0-9a-f]+" if p.kind == "hex" else p.regex
        for m in re.finditer(regex, text or "", re.A):
            if len(m[p.group]) >= p.least and all(re.search(n, m[0]) for n in p.needs):
                found.append((m.start(), rank, m.end(), p.kind))
    base = [f for f in found if f[3] in secret_scan.BASE]

    def hidden(f):
        stronger = {"endpoint": [], "ident": ["endpoint"], "key": ["endpoint", "ident"]}.get(f[3])
        return stronger is not None and any(o is not f and o[0] < f[2] and f[0] < o[2] for o in found if o[3] in (*secret_scan.BASE, *stronger))
    left = [f for f in found if not hidden(f)]

    def near(f, kinds):
        return any(o is not f and o[3] in kinds and (0 if o[0] < f[2] and f[0] < o[2] else max(f[0] - o[2], o[0] - f[2])) <= scope for o in left)
    told = {"ident": lambda f: near(f, secret_scan.SECRETS), "key": lambda f: near(f, secret_scan.NAMES) or near(f, secret_scan.PLACES),
            "endpoint": lambda f: near(f, secret_scan.NAMES) and near(f, secret_scan.SECRETS)}
    return sorted(base), sorted(f for f in left if f[3] not in told or told[f[3]](f))


def secret_texts():
    rng = random.Random(8)
    key = "aB3" * 9
    bits = ["password=abc", "token: 'longenough1'", "password=token:longvalue123", "API_KEY = \"XYZ12345678\"", "AKIA" + "A1" * 8, "AKIAAAA",
            "deadbeef" * 4, "deadbee", "https://db.example.com:5432/x", key, "login: alice", "user=bob", "client_id=" + key, "passwd:\t12345678",
            "secret=" + "f" * 40, "plain words here", "😀é", "x" * 300, "\n\n", "AKIAAKIA" + "B" * 12]
    out = ["", None, "".join(bits)]
    for _ in range(300):
        out.append(rng.choice(["", " ", "é "]).join(f" {rng.choice(bits)} " for _ in range(rng.randrange(12))))
    return out


def test_secret_scan_equals_brute_force(spark):
    texts = secret_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in secret_scan.digest(secret_scan.scan(docs)).collect()}
    kinds = Counter()
    for i, text in enumerate(texts):
        base, every = brute_spans(text)
        line = lambda spans: ",".join(f"{k}:{b}:{e}" for b, _, e, k in spans)
        count = Counter(k for *_, k in base)
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == (count["assign"], count["access"], count["hex"]), text
        assert got[i].base_sha256 == hashlib.sha256(line(base).encode()).hexdigest()
        assert got[i].spans == line(every), text
        kinds.update(k for *_, k in every)
    assert set(kinds) == set(secret_scan.KINDS)


def test_the_sql_of_the_secret_scan_equals_brute_force():
    import duckdb
    import pandas as pd

    texts = secret_texts()
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": range(len(texts)), "text": texts}))
    got = {r[0]: r for r in con.execute(secret_scan.oracle()).fetchall()}
    for i, text in enumerate(texts):
        assert got[i][5] == ",".join(f"{k}:{b}:{e}" for b, _, e, k in brute_spans(text)[1])


def test_weak_candidates_alone_are_not_reported(spark):
    key = "aB3" * 9
    texts = [key, "login: alice", "https://db.example.com/", f"login: alice {'.' * 300} {key}", f"login: alice {key}", f"https://h.example/ {key}",
             f"https://h.example/ login: alice {key}"]
    got = {r.doc_id: r.spans for r in secret_scan.digest(secret_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))).collect()}
    assert [sorted(s.split(":")[0] for s in got[i].split(",") if s) for i in range(7)] == [
        [], [], [], [], ["ident", "key"], ["key"], ["endpoint", "ident", "key"]]


def test_secret_scan_of_hard_rows(hard, empty):
    assert secret_scan.scan(hard).count() == len(hard_rows())
    assert secret_scan.scan(empty).collect() == []


# --- URLs -------------------------------------------------------------------------------

def brute_parts(url):
    _, there, rest = (url or "").partition("://")
    if not there:
        return "", ""
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(c.lower() if c.isascii() else c for c in host), re.match(r"[^?#]*", rest[len(host):])[0]


def brute_rule(host, path):
    best = None
    for r in queries.URL_RULES:
        h, p = r.text.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(r.text) > len(best.text)):
            best = r
    return best


URLS = [None, "", "no scheme", "http://", "http://COM/", "http://com", "http://x.Com/a?b#c", "https://example.com/en/1", "https://www.example.com/en/1",
        "https://a.www.example.com/en/", "http://notexample.com/en/1", "http://a.net/es/", "http://a.net/es", "http://net/fr/x?://y/", "a://b://c/d",
        "http://É.net/fr/Ä", "http://x.org#frag/en", "http://x.org?q=/en/", "http://user@x.com:80/"]


def test_url_parts_rules_and_verdicts(spark):
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS)] + [(None, None, None), (3, URLS[3], "h")], "page_id long, url string, host string")
    model = url_filter.train(queries.labelled_urls(spark))
    got = url_filter.judge(pages, queries.URL_RULES, model).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        url = URLS[r.page_id] if r.page_id is not None else None
        assert (r.host, r.path) == brute_parts(url), url
        rule = brute_rule(r.host, r.path)
        assert r.rule == (rule and rule.text), url
        assert r.verdict == (rule.verdict if rule else "block" if model.probability(r.host, r.path) > 0.5 else "allow")
    assert url_filter.judge(pages.limit(0), queries.URL_RULES, model).collect() == []


@pytest.mark.parametrize("mark", [".info", ".biz", "cdn.", ".edu", ".eu"])
def test_url_classifier_held_out_by_form(spark, mark):
    rows = [tuple(r) for r in url_filter.with_parts(queries.labelled_urls(spark)).select("host", "path", "block").collect()]
    train, test = [r for r in rows if mark not in r[0]], [r for r in rows if mark in r[0]]
    model = url_filter.fit(train)
    assert len(test) > 20 and sum((model.probability(h, p) > 0.5) == b for h, p, b in test) / len(test) > 0.95


def test_url_classifier_equals_an_independent_fit(spark):
    rows = [tuple(r) for r in url_filter.with_parts(queries.labelled_urls(spark)).select("host", "path", "block").collect()][::9]

    def grams(host, path):
        parts = [(m, ("^" + t + "$").encode()) for m, t in ((b"h", host), (b"p", path))]
        return {xxhash.xxh32_intdigest(m + t[i:i + n]) % 65536 for m, t in parts for n in (3, 4, 5) for i in range(len(t) - n + 1)}
    sets = [grams(h, p) for h, p, _ in rows]
    names = sorted(set().union(*sets))
    x = np.array([[math.log((len(rows) + 1) / sum(g in s for s in sets)) if g in own else 0.0 for g in names] for own in sets])
    x = np.hstack([x / np.linalg.norm(x, axis=1, keepdims=True), np.ones((len(rows), 1))])
    y = np.array([float(b) for *_, b in rows])
    ridge = np.array([1e-4] * len(names) + [0.0])
    # Newton's method in the span of the rows: the optimum has no other directions.
    basis, _ = np.linalg.qr(np.vstack([x, ridge == 0]).T)
    w = np.zeros(basis.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ basis @ w))
        slope = basis.T @ (x.T @ (p - y) / len(y) + ridge * (basis @ w))
        bend = basis.T @ ((x.T * (p * (1 - p) / len(y))) @ x + np.diag(ridge)) @ basis
        w -= np.linalg.solve(bend + 1e-12 * np.eye(len(w)), slope)
    best = 1 / (1 + np.exp(-x @ basis @ w))
    long = url_filter.fit(rows, rounds=100_000)
    assert max(abs(long.probability(h, p) - b) for (h, p, _), b in zip(rows, best)) < 0.01
    model = url_filter.fit(rows)
    assert all((model.probability(h, p) > 0.5) == (b > 0.5) for (h, p, _), b in zip(rows, best))


def test_very_long_urls_and_tied_rules(spark):
    url = "http://" + "a" * 100_000 + ".io/" + "pills/" * 20_000 + "?x"
    rules = [url_filter.Rule("block", "b.io/x/"), url_filter.Rule("allow", "b.io/x/"), url_filter.Rule("allow", "io/abc/"), url_filter.Rule("block", "a.io/ab/")]
    pages = spark.createDataFrame([(0, url), (1, "http://b.io/x/y"), (2, "http://a.io/ab/"), (3, "http://a.io/abc/ab/")], "page_id long, url string")
    got = {r.page_id: r for r in url_filter.judge(pages, rules, url_filter.train(queries.labelled_urls(spark))).collect()}
    assert len(got[0].host) == 100_003 and len(got[0].path) == 120_001 and got[0].rule is None and got[0].block_score is not None
    assert (got[1].rule, got[1].verdict) == ("b.io/x/", "block") and got[1].block_score is None
    assert (got[2].rule, got[2].verdict) == ("a.io/ab/", "block") and (got[3].rule, got[3].verdict) == ("io/abc/", "allow")


def test_url_training_bounds_and_empty_table(spark, monkeypatch):
    labelled = queries.labelled_urls(spark)
    model = url_filter.train(labelled.limit(0))
    assert model.probability("x", "y") == 0.5
    monkeypatch.setattr(url_filter, "MOST_LABELLED", 10)
    with pytest.raises(ValueError):
        url_filter.train(labelled)
