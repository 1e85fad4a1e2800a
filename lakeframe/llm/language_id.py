"""Language ID with interpolated Kneser-Ney character language models.

Training draws a bounded sample of the labelled rows by a hash (``sample_chars`` characters in
all, shared evenly by the languages), counts the highest-order grams in Spark and solves the
model from these counts.  One model holds all languages: per order a sorted array of gram
hashes beside a matrix of log probabilities, one column per language, and a sorted array of
context hashes beside the log back-off weights.  A hash's leading bits index the array, so a
lookup reads one or two entries.  The sample bounds the model, hence also its broadcast.

Scoring adds the log probabilities of every character of the whole text and takes the language
with the lowest cross-entropy per character.  Rows that were drawn but not counted calibrate
the confidence (a softmax temperature) and the rejection (how far a cross-entropy may lie from
its language, given the length).
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import land

SPACE, MARK = 32, 1 << 30
ORDER = 4
SAMPLE_CHARS = 8_000_000
SLICE = 1 << 19
TOWARDS_FOREIGN, TIMES_OWN, SHORT_TEXT = 0.65, 2.0, 4.0
OWN_SHARE, FEW = 0.999, 20
BASE, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
INDEX_BITS = 18
UNKNOWN = "und"

_TABLE: np.ndarray | None = None


def code_table() -> np.ndarray:
    """Symbol of each code point: letters in lower case, combining marks flagged, else a space."""
    global _TABLE
    if _TABLE is None:
        table = np.full(0x110000, SPACE, dtype=np.uint32)
        for c in range(0x110000):
            kind = unicodedata.category(chr(c))[0]
            if kind == "L":
                table[c] = ord(chr(c).lower()[0])
            elif kind == "M":
                table[c] = c | MARK
        _TABLE = table
    return _TABLE


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all texts in one array, each text after ``ORDER - 1`` spaces, runs of spaces as
    one; the text each symbol belongs to (-1 for padding); whether each text has a letter."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    raw = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    code, doc = code_table()[raw], np.repeat(np.arange(len(texts)), sizes)
    letter = np.zeros(len(texts), dtype=bool)
    letter[doc[(code != SPACE) & (code < MARK)]] = True
    fresh = np.append(True, doc[1:] != doc[:-1]) if len(doc) else np.empty(0, bool)
    keep = (code != SPACE) | ~np.append(False, (code[:-1] == SPACE)) & ~fresh if len(doc) else fresh
    code, doc = code[keep], doc[keep]
    at = np.arange(len(code)) + (doc + 1) * (ORDER - 1)
    total = len(code) + len(texts) * (ORDER - 1)
    padded, owner = np.full(total, SPACE, dtype=np.uint32), np.full(total, -1, dtype=np.int64)
    padded[at], owner[at] = code, doc
    return padded, owner, letter


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * MIX
    return h ^ (h >> np.uint64(29))


def _rolling(code: np.ndarray, orders: int) -> list[np.ndarray]:
    """``[k - 1][p]``: unmixed hash of the k symbols that end at p (wrapping; only full ones count)."""
    wide, out, power = code.astype(np.uint64) + np.uint64(1), [], np.uint64(1)
    so_far = np.zeros(len(code), dtype=np.uint64)
    for k in range(orders):
        shifted = np.zeros_like(wide)
        shifted[k:] = wide[:len(wide) - k]
        so_far = so_far + shifted * power
        out.append(so_far)
        power = np.uint64(int(power) * int(BASE) & (1 << 64) - 1)
    return out


@dataclass
class HashArray:
    """Sorted hashes, an index of their leading bits, and one row of values per hash."""

    keys: np.ndarray
    values: np.ndarray
    index: np.ndarray

    @staticmethod
    def build(keys: np.ndarray, values: np.ndarray) -> HashArray:
        edges = np.arange((1 << INDEX_BITS) + 1, dtype=np.uint64)
        index = np.searchsorted(keys >> np.uint64(64 - INDEX_BITS), edges).astype(np.int64)
        return HashArray(np.append(keys, ~np.uint64(0)), values.astype(np.float32), index)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Row of each hash, -1 where there is none."""
        lead = (hashes >> np.uint64(64 - INDEX_BITS)).astype(np.int64)
        at, end = self.index[lead], self.index[lead + 1]
        row = np.where((at < end) & (self.keys[at] == hashes), at, -1)
        left = np.nonzero((row < 0) & (at + 1 < end))[0]
        while len(left):
            at[left] += 1
            hit = self.keys[at[left]] == hashes[left]
            row[left[hit]] = at[left[hit]]
            left = left[~hit]
            left = left[at[left] + 1 < end[left]]
        return row


@dataclass
class Model:
    languages: list[str]
    grams: list[HashArray]  # by order, from 1
    contexts: list[HashArray]  # of the grams of each order; None for order 1
    unseen: np.ndarray  # log probability of a symbol never seen, by language
    limit: np.ndarray  # by language: cross-entropy beyond which a long text is rejected
    spread: np.ndarray  # by language: variance of the cross-entropy times the length
    sharpness: float = 1.0

    def log_probabilities(self, code: np.ndarray) -> np.ndarray:
        """(len(code), languages), for each symbol given the ORDER - 1 before it."""
        hashes = _rolling(code, ORDER)
        out = np.zeros((len(code), len(self.languages)), dtype=np.float32)
        todo = np.arange(len(code))
        for k in range(ORDER, 0, -1):
            row = self.grams[k - 1].find(_mixed(hashes[k - 1][todo]))
            hit = row >= 0
            out[todo[hit]] += self.grams[k - 1].values[row[hit]]
            todo = todo[~hit]
            if not len(todo):
                return out
            if k > 1:
                row = self.contexts[k - 1].find(_mixed(hashes[k - 2][np.maximum(todo - 1, 0)]))
                out[todo[row >= 0]] += self.contexts[k - 1].values[row[row >= 0]]
        out[todo] += self.unseen
        return out

    def cross_entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nats per symbol (texts, languages), the number of symbols, whether there is a letter."""
        code, owner, letter = symbols(texts)
        total = np.zeros((len(texts), len(self.languages)))
        for at in range(0, len(code), SLICE):
            low = max(0, at - ORDER + 1)
            part = self.log_probabilities(code[low:at + SLICE])[at - low:]
            mine = owner[at:at + SLICE]
            real = mine >= 0
            mine, part = mine[real], part[real]
            if len(mine):
                starts = np.nonzero(np.append(True, mine[1:] != mine[:-1]))[0]
                total[mine[starts]] -= np.add.reduceat(part, starts, axis=0, dtype=np.float64)
        size = np.bincount(owner[owner >= 0], minlength=len(texts))
        return total / np.maximum(size, 1)[:, None], size, letter

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, confidence (0 to 1) and whether the text is rejected."""
        if not texts or not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
        entropy, size, letter = self.cross_entropies(texts)
        best = entropy.argmin(axis=1)
        lowest = entropy.min(axis=1)
        score = 1 / np.exp(-self.sharpness * (entropy - lowest[:, None])).sum(axis=1)
        far = lowest > self.limit[best] + SHORT_TEXT * np.sqrt(self.spread[best] / np.maximum(size, 1))
        names = [self.languages[i] if ok else UNKNOWN for i, ok in zip(best, letter)]
        return names, np.where(letter, score, 0.0), far | ~letter


# --- training ---------------------------------------------------------------------------

def _gram_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            lang = np.array(part.column("lang").to_pylist(), dtype=object)
            code, owner, _ = symbols(part.column("text").to_pylist())
            if not len(code):
                continue
            top = _rolling(code, ORDER)[-1]
            for name in sorted(set(lang)):
                here = np.nonzero((owner >= 0) & (lang[owner] == name))[0]
                if not len(here):
                    continue
                _, first, count = np.unique(top[here], return_index=True, return_counts=True)
                ends = here[first]
                grams = code[ends[:, None] + np.arange(1 - ORDER, 1)[None, :]].astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(ends)), pa.array([g.tobytes() for g in grams], pa.binary()), pa.array(count, pa.int64())],
                    names=["lang", "gram", "n"])


def _hash_columns(grams: np.ndarray, k: int, skip_last: int = 0) -> np.ndarray:
    """Mixed hash of the last k symbols of each gram, or of the k before the last one."""
    end = grams.shape[1] - skip_last
    total, power = np.zeros(len(grams), dtype=np.uint64), np.uint64(1)
    for j in range(k):
        total = total + (grams[:, end - 1 - j].astype(np.uint64) + np.uint64(1)) * power
        power = np.uint64(int(power) * int(BASE) & (1 << 64) - 1)
    return _mixed(total)


def fit(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """Interpolated Kneser-Ney from ``{language: ((grams, ORDER) symbols, counts)}``."""
    languages = sorted(counts)
    types = {lang: [None] * ORDER for lang in languages}  # by order: distinct grams (symbols) and their counts
    for lang in languages:
        grams, n = counts[lang]
        for k in range(ORDER, 0, -1):
            types[lang][k - 1] = (grams, n.astype(np.float64))
            if k > 1:  # continuation counts: distinct symbols before a gram
                _, first, n = np.unique(_hash_columns(grams, k - 1), return_index=True, return_counts=True)
                grams = grams[first]
    vocabulary = len(np.unique(np.concatenate([types[lang][0][0][:, -1] for lang in languages])))
    uniform = 1.0 / (vocabulary + 1)
    grams_by_order, contexts_by_order, below, below_keys = [], [], None, None
    unseen = np.zeros(len(languages))
    for k in range(1, ORDER + 1):
        every = np.concatenate([types[lang][k - 1][0] for lang in languages])
        keys, first = np.unique(_hash_columns(every, k), return_index=True)
        every = every[first]
        if k > 1:
            lower = below[np.searchsorted(below_keys, _hash_columns(every, k - 1))]
            context = _hash_columns(every, k - 1, skip_last=1)
        else:
            lower, context = np.full((len(every), len(languages)), uniform), np.zeros(len(every), dtype=np.uint64)
        context_keys, of = np.unique(context, return_inverse=True)
        value, gamma = np.empty((len(keys), len(languages))), np.ones((len(context_keys), len(languages)))
        for i, lang in enumerate(languages):
            own, n = types[lang][k - 1]
            ones, twos = (n == 1).sum(), (n == 2).sum()
            discount = ones / (ones + 2 * twos) if ones and twos else 0.5
            count = np.zeros(len(keys))
            count[np.searchsorted(keys, _hash_columns(own, k))] = n
            seen = count > 0
            total = np.bincount(of, weights=count, minlength=len(context_keys))
            kinds = np.bincount(of, weights=seen, minlength=len(context_keys))
            known = total > 0
            gamma[known, i] = discount * kinds[known] / total[known]
            value[:, i] = np.maximum(count - discount, 0) / np.maximum(total, 1)[of] + gamma[of, i] * lower[:, i]
            if k == 1:
                unseen[i] = np.log(gamma[0, i] * uniform)
        grams_by_order.append(HashArray.build(keys, np.log(value)))
        contexts_by_order.append(HashArray.build(context_keys, np.log(gamma)) if k > 1 else None)
        below, below_keys = value, keys
    n = len(languages)
    return Model(languages, grams_by_order, contexts_by_order, unseen.astype(np.float32), np.full(n, np.inf), np.ones(n))


def calibrate(model: Model, rows: list[tuple[str, int, list[float]]]) -> None:
    """``rows``: (true language, symbols, cross-entropies) of rows that were not counted.

    Each row is read once more with its own language held out: the lowest cross-entropy over the
    models left is what a text in an unlearned language gets at best, under the model that takes
    it.  A language's limit lies ``TOWARDS_FOREIGN`` of the way from the median of its own rows to
    that of those (to that of all foreign rows under its model where it takes fewer than ``FEW``;
    to uniform symbols where there is only one language), at most at ``TIMES_OWN`` its own median
    and never below ``OWN_SHARE`` of its own rows.  So texts in two learned languages stay.  Short texts get ``SHORT_TEXT`` standard deviations more.  The
    sharpness of the confidence minimises log loss."""
    if not rows:
        return
    size = np.array([r[1] for r in rows], dtype=np.float64)
    entropy = np.array([r[2] for r in rows])
    truth = np.array([model.languages.index(r[0]) for r in rows])
    left = entropy.copy()
    left[np.arange(len(rows)), truth] = np.inf
    taker, lowest = left.argmin(axis=1), left.min(axis=1)
    for i in range(len(model.languages)):
        here = truth == i
        if not here.any():
            continue  # nothing to calibrate by: its limit stays infinite
        own = float(np.median(entropy[here, i]))
        taken = lowest[(taker == i) & ~here]
        if len(taken) < FEW:
            taken = entropy[~here, i]
        foreign = float(np.median(taken)) if len(taken) else float(np.log(len(model.grams[0].keys)))
        model.spread[i] = max(float(np.median((entropy[here, i] - own) ** 2 * size[here])) / 0.455, 1.0)
        slack = SHORT_TEXT * np.sqrt(model.spread[i] / np.maximum(size[here], 1))
        kept = float(np.quantile(entropy[here, i] - slack, OWN_SHARE))
        model.limit[i] = max(min(own + TOWARDS_FOREIGN * max(foreign - own, 0.5), TIMES_OWN * own), kept)
    gap = entropy - entropy.min(axis=1, keepdims=True)
    own_gap = gap[np.arange(len(rows)), truth]
    loss = {s: float((s * own_gap + np.log(np.exp(-s * gap).sum(axis=1))).mean()) for s in (1, 2, 4, 8, 16, 32, 64)}
    model.sharpness = float(min(loss, key=loss.get))


def held_out(id_col: str) -> Column:
    """Rows kept from training: CRC-32 of the id as text, mod 5, is 0 (a NULL id counts as '')."""
    return F.pmod(F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def train(docs: DataFrame, sample_chars: int = SAMPLE_CHARS, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> Model:
    """Fit on labelled rows that are not held out.  ``sample_chars`` bounds the expected number
    of characters drawn over all languages; four fifths are counted, one fifth calibrates.  Of each
    language the row with a letter that the draw reaches first is always counted, so that no
    labelled language leaves the model.
    With no labelled row the model has no language and rejects every text."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"), held_out(id_col).alias("out"),
                       F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("h"))
    rows = rows.where("NOT out AND lang IS NOT NULL AND text IS NOT NULL")
    place = F.pmod("h", F.lit(1 << 40))
    found = rows.groupBy("lang").agg(F.sum(F.length("text")), F.min(F.when(F.col("text").rlike(r"\p{L}"), place))).collect()
    sizes, firsts = {r[0]: r[1] for r in found if r[1]}, {r[0]: r[2] for r in found if r[2] is not None}
    if not sizes:
        return Model([], [], [], np.zeros(0), np.zeros(0), np.ones(0))
    share = sample_chars / len(sizes)
    limits = {lang: min(1.0, share / n) for lang, n in sizes.items()}
    limit = F.coalesce(F.create_map(*[F.lit(x) for lang, part in sorted(limits.items()) for x in (lang, part)])[F.col("lang")], F.lit(0.0))
    first = F.lit(False)
    if firsts:
        ahead = F.create_map(*[F.lit(x) for lang, h in sorted(firsts.items()) for x in (lang, h)])[F.col("lang")]
        first = F.coalesce(place == ahead, F.lit(False))
    part = F.when(first, F.lit(1)).otherwise(F.pmod("h", F.lit(5)))
    # landed: counting and calibration read the bounded sample, not the table again
    drawn = land(rows.where(first | (place / F.lit(float(1 << 40)) < limit)).select("text", "lang", part.alias("part")), "language_sample")
    counted = drawn.where("part <> 0").select("text", "lang").mapInArrow(_gram_batches, "lang string, gram binary, n long")
    found = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    counts = {}
    names = np.array(found.column("lang").to_pylist(), dtype=object)
    for lang in sorted(set(names)):
        own = found.filter(pa.array(names == lang)).sort_by("gram")
        grams = np.frombuffer(b"".join(own.column("gram").to_pylist()), dtype="<u4").reshape(-1, ORDER)
        counts[lang] = (grams, own.column("n").to_numpy())
    if not counts:
        return Model([], [], [], np.zeros(0), np.zeros(0), np.ones(0))
    model = fit(counts)
    shared = spark.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                entropy, size, letter = shared.value.cross_entropies(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang"), pa.array(size.astype(np.int64)), pa.array(list(entropy), pa.list_(pa.float64())), pa.array(letter)],
                    names=["lang", "size", "entropy", "letter"])

    spare = drawn.where("part = 0").select("text", "lang").mapInArrow(measure, "lang string, size long, entropy array<double>, letter boolean")
    calibrate(model, [(r[0], r[1], r[2]) for r in spare.where("letter").collect() if r[0] in counts])
    return model


def _chunks(batch: pa.RecordBatch, text_col: str | int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about a megabyte of text each."""
    at, size = 0, 0
    lengths = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False)
    for i, n in enumerate(lengths):
        size += int(n)
        if size >= 1 << 20:
            yield batch.slice(at, i + 1 - at)
            at, size = i + 1, 0
    if at < batch.num_rows:
        yield batch.slice(at)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` for every row of ``docs``.

    ``lang_pred`` is ``und`` and the row is rejected where the text is NULL or has no letter;
    else it is a learned language, and ``rejected`` says that the text resembles none of them.
    ``score`` is the calibrated confidence (0 for ``und``).  Of languages that tie the first in
    alphabetical order wins.  Repeated rows get equal answers.  Very long texts are read whole, in
    slices.  Other columns play no part, whatever their names."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _chunks(batch, "text"):
                names, score, rejected = shared.value.predict([t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(names, pa.string()), pa.array(score), pa.array(rejected)],
                    names=["doc_id", "held_out", "lang_pred", "score", "rejected"])

    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected, all columns as they are, without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _chunks(batch, place):
                _, _, rejected = shared.value.predict([t or "" for t in part.column(place).to_pylist()])
                yield part.filter(pa.array(~rejected))

    return docs.mapInArrow(run, docs.schema)
