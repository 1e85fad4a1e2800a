"""URL filters: rules, and logistic regression on hashed character n-grams for the rest.

The classifier is fitted on the driver from a small labelled table of URLs (bounded by
``MOST_LABELLED``; a larger one is refused, not cut) and applied to every URL in Arrow batches.
Features are the character n-grams of host and path, hashed apart from each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_LABELLED = 20_000
BITS = 16
GRAMS = (3, 4, 5)


# --- parts of a URL and rules -----------------------------------------------------------

def with_parts(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds ``host`` and ``path``; NULL or a URL without ``://`` has both empty."""
    url = F.coalesce(F.col(f"`{url_col}`"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract("__lf_rest", r"^[^/?#]*", 0)
    pages = pages.withColumn("__lf_rest", rest).withColumn("__lf_host", host)
    path = F.regexp_extract(F.substring("__lf_rest", F.length("__lf_host") + 1, F.length("__lf_rest")), r"^[^?#]*", 0)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return pages.withColumns({"host": F.translate("__lf_host", upper, lower), "path": path}).drop("__lf_rest", "__lf_host")


@dataclass(frozen=True)
class Rule:
    """``text`` is host and path in one, like ``net/es/``; the path starts at the first slash."""

    verdict: str
    text: str

    def fits(self) -> Column:
        host, slash, path = self.text.partition("/")
        return ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit(slash + path))


def rule_columns(rules: list[Rule]) -> dict[str, Column]:
    """``rule`` and ``ruled`` (its verdict): the longest rule that fits, NULL if none does.  Of two
    rules of one length that both fit the first by text wins.  The list is part of the plan, so
    it is meant for hundreds of rules, not millions."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    rule, ruled = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in reversed(ordered):
        rule = F.when(r.fits(), F.lit(r.text)).otherwise(rule)
        ruled = F.when(r.fits(), F.lit(r.verdict)).otherwise(ruled)
    return {"rule": rule, "ruled": ruled}


# --- classifier -------------------------------------------------------------------------

def features(host: str, path: str) -> np.ndarray:
    """Distinct hashed n-grams of host and path, each text between marks of its own."""
    found = set()
    for mark, text in ((b"h", host), (b"p", path)):
        raw = b"^" + text.encode("utf-8", "surrogatepass") + b"$"
        for n in GRAMS:
            for i in range(len(raw) - n + 1):
                found.add(xxhash.xxh32_intdigest(mark + raw[i:i + n]) & (1 << BITS) - 1)
    return np.fromiter(sorted(found), dtype=np.int64, count=len(found))


@dataclass
class Model:
    weights: np.ndarray
    rarity: np.ndarray  # inverse document frequency in the labelled table, 0 where unseen
    bias: float

    def probability(self, host: str, path: str) -> float:
        f, v = _values(features(host, path), self.rarity)
        return float(1 / (1 + np.exp(-self.bias - (self.weights[f] * v).sum())))


def _values(found: np.ndarray, rarity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The known n-grams and their values: a vector of unit length, rare ones weighing more."""
    found = found[rarity[found] > 0]
    value = rarity[found]
    return found, value / max(np.sqrt((value * value).sum()), 1e-9)


def fit(rows: list[tuple[str, str, bool]], rounds: int = 2000, rate: float = 10.0, penalty: float = 1e-4) -> Model:
    """Full-batch gradient descent on the regularised log loss."""
    feats = [features(h, p) for h, p, _ in rows]
    y = np.array([float(b) for _, _, b in rows])
    seen = np.bincount(np.concatenate([*feats, np.empty(0, np.int64)]), minlength=1 << BITS)
    rarity = np.where(seen > 0, np.log((len(rows) + 1) / np.maximum(seen, 1)), 0.0)
    pairs = [_values(f, rarity) for f in feats]
    columns = np.concatenate([*(f for f, _ in pairs), np.empty(0, np.int64)])
    values = np.concatenate([*(v for _, v in pairs), np.empty(0)])
    lines = np.repeat(np.arange(len(rows)), [len(f) for f, _ in pairs])
    used, column = np.unique(columns, return_inverse=True)  # only these weights ever move
    own, bias = np.zeros(len(used)), 0.0
    for _ in range(rounds if len(rows) else 0):
        z = np.bincount(lines, weights=own[column] * values, minlength=len(rows)) + bias
        off = (1 / (1 + np.exp(-z)) - y) / len(rows)
        own -= rate * (np.bincount(column, weights=off[lines] * values, minlength=len(used)) + penalty * own)
        bias -= rate * off.sum()
    weights = np.zeros(1 << BITS)
    weights[used] = own
    return Model(weights, rarity, bias)


def train(labelled: DataFrame, url_col: str = "url", label_col: str = "block") -> Model:
    """Fit on a labelled table (URL, boolean: block).  Rows with a NULL label are left out; an
    empty table gives a model without weights, which allows everything it is undecided on."""
    parts = with_parts(labelled.where(F.col(label_col).isNotNull()), url_col).select("host", "path", F.col(label_col).cast("boolean"))
    rows = parts.limit(MOST_LABELLED + 1).collect()
    if len(rows) > MOST_LABELLED:
        raise ValueError(f"the labelled table has over {MOST_LABELLED} rows; give a smaller one")
    return fit(sorted(tuple(r) for r in rows))


def judge(pages: DataFrame, rules: list[Rule], model: Model, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, block_score`` of every row of ``pages``.

    The longest rule that fits decides; else the classifier blocks above one half, and only then
    there is a score.  NULL and malformed URLs have empty parts, which no rule fits, and go to
    the classifier.  A very long URL is read whole.  Repeated rows get equal answers; an empty
    table gives an empty result; columns other than the two named do not matter."""
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"))
    rows = with_parts(rows).withColumns(rule_columns(rules)).drop("url")
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            ruled = batch.column("ruled").to_pylist()
            score = [None if r else shared.value.probability(h, p) for r, h, p in zip(ruled, hosts, paths)]
            verdict = [r or ("block" if s > 0.5 else "allow") for r, s in zip(ruled, score)]
            names = ["page_id", "host", "path", "rule"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(verdict, pa.string()), pa.array(score, pa.float64())],
                                             names=[*names, "verdict", "block_score"])

    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, host string, path string, rule string, verdict string, block_score double")
