"""Secret scans with multipart credential linking (DataFrame operations only).

Base patterns find secrets on their own.  Weak candidates (an account name, a random-looking
string, an endpoint) are ordinary text by themselves and are reported only when complementary
parts of a credential lie within ``SCOPE`` code points of them in the same text.

A scan yields, per pattern, the lengths of the stretches before and of each match; exploded
matches get their places by a running sum.  The interval join of the parts is a sweep: ordered
by place, each part sees the nearest end before and the nearest start after it of every kind of
part.  That is linear in the number of parts, where pairs would be quadratic.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import land, text_of

SCOPE = 200


@dataclass(frozen=True)
class Pattern:
    kind: str
    regex: str
    base: bool
    least: int  # code points the match, or its group, must have
    group: int = 0
    needs: tuple[str, ...] = ()  # the match must also match these
    hint: str | None = None  # a literal every match contains


PATTERNS = [
    Pattern("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, 8, 1),
    Pattern("access", r"AKIA[A-Z0-9]+", True, 16, hint="AKIA"),
    # The least length stands in the pattern, else every letter from a to f were a match to drop.
    Pattern("hex", r"[0-9a-f]{32,}", True, 32),
    Pattern("endpoint", r"""[A-Za-z][A-Za-z0-9+.-]{0,15}://[^\x20\x09-\x0D"'<>]+""", False, 8, hint="://"),
    Pattern("ident", r"""(?i:user(?:_?name)?|login|account|client_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.@-]+)""", False, 3, 1),
    Pattern("key", r"[A-Za-z0-9+/_-]{20,}", False, 20, needs=(r"[0-9]", r"[A-Z]", r"[a-z]")),
]
KINDS = [p.kind for p in PATTERNS]
RANK = {p.kind: i for i, p in enumerate(PATTERNS)}
BASE = [p.kind for p in PATTERNS if p.base]
# Complementary parts: a name needs a secret, a random string a name or an endpoint, an endpoint both others.
NAMES, SECRETS, PLACES = ("access", "ident"), ("assign", "hex", "key"), ("endpoint",)


def _hits(text: Column, p: Pattern) -> Column:
    """(rank, i, gap, size, good) of all matches, leftmost and non-overlapping."""
    slots = F.filter(F.arrays_zip(F.split(text, p.regex, -1).alias("gap"), F.regexp_extract_all(text, F.lit(p.regex), F.lit(0)).alias("hit")),
                     lambda z: z["hit"].isNotNull())
    def good(hit: Column) -> Column:
        long = F.length(F.regexp_extract(hit, p.regex, p.group) if p.group else hit) >= p.least
        for also in p.needs:
            long = long & F.regexp_like(hit, F.lit(also))
        return long
    found = F.transform(slots, lambda z, i: F.struct(
        F.lit(RANK[p.kind]).alias("rank"), i.alias("i"), F.length(z["gap"]).cast("long").alias("gap"),
        F.length(z["hit"]).cast("long").alias("size"), good(z["hit"]).alias("good")))
    there = F.contains(text, F.lit(p.hint)) if p.hint else F.regexp_like(text, F.lit(p.regex))
    return F.when(there, found).otherwise(F.array().cast("array<struct<rank:int,i:int,gap:bigint,size:bigint,good:boolean>>"))


def _spans(rows: DataFrame) -> DataFrame:
    """``row, rank, begin, finish`` of every good match."""
    hits = rows.select("row", F.explode("hits").alias("h")).select("row", "h.*").repartition("row")
    so_far = Window.partitionBy("row", "rank").orderBy("i")
    hits = hits.withColumn("finish", F.sum(F.col("gap") + F.col("size")).over(so_far))
    return hits.where("good").select("row", "rank", (F.col("finish") - F.col("size")).alias("begin"), "finish")


def _is(kinds: tuple[str, ...] | list[str]) -> Column:
    return F.col("rank").isin([RANK[k] for k in kinds])


def linked(spans: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The spans to report: base ones, and weak ones whose complements are near.

    A weak span that overlaps one of a stronger kind (base kinds, then endpoint, ident, key) is
    that part's text and counts for nothing.  Near means a gap of at most ``scope``."""
    sweep = Window.partitionBy("row").orderBy("begin", "finish", "rank")
    before, after = sweep.rowsBetween(Window.unboundedPreceding, -1), sweep.rowsBetween(1, Window.unboundedFollowing)
    overlaps = {}
    for kinds in (BASE, ["endpoint"], ["ident"]):
        mine = _is(kinds)
        overlaps[kinds[0]] = (F.coalesce(F.max(F.when(mine, F.col("finish"))).over(before) > F.col("begin"), F.lit(False))
                              | F.coalesce(F.min(F.when(mine, F.col("begin"))).over(after) < F.col("finish"), F.lit(False)))
    spans = spans.withColumns({f"over_{k}": v for k, v in overlaps.items()})
    hidden = (~_is(BASE) & F.col("over_assign")) | (_is(["ident", "key"]) & F.col("over_endpoint")) | (_is(["key"]) & F.col("over_ident"))
    spans = spans.where(~hidden).select("row", "rank", "begin", "finish")
    near = {}
    for name, kinds in (("names", NAMES), ("secrets", SECRETS), ("places", PLACES)):
        mine = _is(kinds)
        near[name] = (F.coalesce(F.col("begin") - F.max(F.when(mine, F.col("finish"))).over(before) <= scope, F.lit(False))
                      | F.coalesce(F.min(F.when(mine, F.col("begin"))).over(after) - F.col("finish") <= scope, F.lit(False)))
    spans = spans.withColumns({f"near_{k}": v for k, v in near.items()})
    told = (_is(BASE) | (_is(["ident"]) & F.col("near_secrets")) | (_is(["key"]) & (F.col("near_names") | F.col("near_places")))
            | (_is(["endpoint"]) & F.col("near_names") & F.col("near_secrets")))
    return spans.where(told).select("row", "rank", "begin", "finish")


def scan(docs: DataFrame, scope: int = SCOPE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``found``, its spans as an array of (begin, rank, finish, kind) by begin, then
    kind as listed; places are code points, the finish exclusive.  One row per row of ``docs``;
    NULL is the empty text, which has no span.  An empty table gives an empty result."""
    text = F.col("text")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_of(text_col).alias("text"))
    rows = rows.select("doc_id", F.monotonically_increasing_id().alias("row"), F.concat(*[_hits(text, p) for p in PATTERNS]).alias("hits"))
    rows = land(rows, "secret_scan_hits")
    names = F.lit(KINDS)
    told = linked(_spans(rows), scope).groupBy("row").agg(F.sort_array(F.collect_list(F.struct(
        "begin", "rank", "finish", F.get(names, F.col("rank")).alias("kind")))).alias("found"))
    empty = F.array().cast("array<struct<begin:bigint,rank:int,finish:bigint,kind:string>>")
    return rows.select("row", "doc_id").join(told, "row", "left").select("doc_id", F.coalesce("found", empty).alias("found"))


def joined(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["finish"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """The result columns of a scan: counts and hash of the base spans, all spans as text."""
    base = F.filter("found", lambda s: s["rank"] < len(BASE))
    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["rank"] == RANK[kind])).cast("long").alias(f"n_{kind}")
    counts = [count(k) for k in BASE]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


def oracle() -> str:
    """DuckDB SQL for the registered query: the same patterns and rules over the raw table."""
    text = lambda regex: "'" + regex.replace("'", "''") + "'"
    ranks = lambda kinds: "(" + ", ".join(str(RANK[k]) for k in kinds) + ")"
    matches = " UNION ALL ".join(
        f"SELECT doc_id, {RANK[p.kind]} AS rank, string_split_regex(text, {text(p.regex)}) AS gaps, regexp_extract_all(text, {text(p.regex)}) AS hits FROM d"
        for p in PATTERNS)
    good = " ".join(
        f"WHEN {RANK[p.kind]} THEN length(regexp_extract(hit, {text(p.regex)}, {p.group})) >= {p.least}"
        + "".join(f" AND regexp_matches(hit, {text(n)})" for n in p.needs) for p in PATTERNS)

    def overlaps(kinds) -> str:
        return (f"(coalesce(max(CASE WHEN rank IN {ranks(kinds)} THEN finish END) OVER before > start, false)"
                f" OR coalesce(min(CASE WHEN rank IN {ranks(kinds)} THEN start END) OVER after < finish, false))")

    def near(kinds) -> str:
        return (f"(coalesce(start - max(CASE WHEN rank IN {ranks(kinds)} THEN finish END) OVER before <= {SCOPE}, false)"
                f" OR coalesce(min(CASE WHEN rank IN {ranks(kinds)} THEN start END) OVER after - finish <= {SCOPE}, false))")
    order = "PARTITION BY doc_id ORDER BY start, finish, rank ROWS BETWEEN"
    frames = f"WINDOW before AS ({order} UNBOUNDED PRECEDING AND 1 PRECEDING), after AS ({order} 1 FOLLOWING AND UNBOUNDED FOLLOWING)"
    kinds = "[" + ", ".join(f"'{k}'" for k in KINDS) + "]"
    one = f"{kinds}[rank + 1] || ':' || start || ':' || finish"
    counts = ", ".join(f"count(*) FILTER (rank = {RANK[k]}) AS n_{k}" for k in BASE)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS ({matches}),
u AS (SELECT doc_id, rank, gaps, hits, unnest(range(1, len(hits) + 1)) AS i FROM m),
h AS (SELECT doc_id, rank, i, hits[i] AS hit, length(gaps[i]) + length(hits[i]) AS step FROM u),
p AS (SELECT doc_id, rank, hit, CAST(sum(step) OVER (PARTITION BY doc_id, rank ORDER BY i) AS BIGINT) AS finish FROM h),
g AS (SELECT doc_id, rank, finish - length(hit) AS start, finish FROM p WHERE CASE rank {good} END),
o AS (SELECT *, {overlaps(BASE)} AS over_base, {overlaps(["endpoint"])} AS over_endpoint, {overlaps(["ident"])} AS over_ident FROM g {frames}),
v AS (SELECT doc_id, rank, start, finish FROM o
      WHERE NOT ((rank NOT IN {ranks(BASE)} AND over_base) OR (rank IN {ranks(["ident", "key"])} AND over_endpoint)
                 OR (rank IN {ranks(["key"])} AND over_ident))),
n AS (SELECT *, {near(NAMES)} AS names, {near(SECRETS)} AS secrets, {near(PLACES)} AS places FROM v {frames}),
t AS (SELECT * FROM n WHERE rank IN {ranks(BASE)} OR (rank IN {ranks(["ident"])} AND secrets)
      OR (rank IN {ranks(["key"])} AND (names OR places)) OR (rank IN {ranks(["endpoint"])} AND names AND secrets)),
a AS (SELECT doc_id, {counts}, coalesce(string_agg({one}, ',' ORDER BY start, rank) FILTER (rank IN {ranks(BASE)}), '') AS base,
             string_agg({one}, ',' ORDER BY start, rank) AS spans FROM t GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a ON d.doc_id = a.doc_id"""
