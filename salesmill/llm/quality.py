"""Operator 11: quality by a generalised additive model with pairwise interactions.

A text is described by ``FEATURES``, shares and means over all its bytes, words and
lines. The model is a sum of look-up tables: one per feature over its bins, and one
over the bins of each of the ``PAIRS`` pairs of features that explain most of what the
single tables leave. Tables are learned by boosting in turn: in every round each
feature gets a shallow tree of ``LEAVES`` leaves on the gradient of the logistic loss,
whose leaves are added to its table in small steps, so features share the credit
whatever their order. A score is a logistic curve over the sum of the bins' entries.

The model learns from at most some ``SAMPLE`` labelled documents that are not held out
(a draw by hash, so about as many); rows with the same features and label teach once,
however many copies there are. Every whole text of the table is then scored.

Defined results: a null or empty text has the features of an empty one and a score
like any other; a null label teaches nothing; of several labels of one id each
teaches; a null ``doc_id`` is scored and never held out; without labels of both kinds
every score is their share (0.0 without any); repeated rows are scored alike; an empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmill.llm.base import arrow_batch, held_out, read, slices, small_batches, texts_of
from salesmill.llm.hashing import mixed, prefixes, spans

THRESHOLD = 0.3  # from this score on a document is predicted to be good
SAMPLE = 20_000  # labelled documents the tables are learned from
BATCH_BYTES = 1 << 20

FEATURES = (
    "bytes", "words", "lines", "letters", "capitals", "digits", "wide", "blanks", "stops", "signs", "odd_signs",
    "word_length", "longest_word", "shouted", "wordless", "distinct_words", "distinct_threes", "line_words",
    "short_lines", "repeated_lines", "ended_lines", "first_capitals",
)
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS, PAIR_ROUNDS = 150, 60
RATE = 0.1
LEAVES = 4
RIDGE = 1.0
LEAST = 2.0  # curvature a leaf must hold

SPACE, LOWER, UPPER, DIGIT, WIDE, STOP, SIGN, ODD, EDGE = range(9)
_KIND = np.full(256, ODD, np.uint8)
_KIND[list(b" \t\n\v\f\r")] = SPACE
_KIND[97:123] = LOWER
_KIND[65:91] = UPPER
_KIND[48:58] = DIGIT
_KIND[128:] = WIDE
_KIND[list(b".?")] = STOP
_KIND[list(b",;:'\"-()")] = SIGN
_KIND[255] = EDGE  # never part of UTF-8: ends a text


def _runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of True."""
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    return edge[0::2], edge[1::2]


def _distinct(owner: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """How many different hashes each owner has."""
    own = mixed(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(own, return_index=True)
    return np.bincount(owner[first], minlength=n)


def described(texts: list[bytes]) -> np.ndarray:
    """The features of each text, a row each."""
    n = len(texts)
    data = np.frombuffer(b"\xff".join([*texts, b""]), np.uint8)
    limits = np.cumsum([0, *(len(t) + 1 for t in texts)])
    kind = _KIND[data]
    sums = np.concatenate([[0], np.cumsum(kind == UPPER)])  # also tells shouted words

    def count(which: int) -> np.ndarray:
        total = sums if which == UPPER else np.concatenate([[0], np.cumsum(kind == which)])
        return total[limits[1:]] - total[limits[:-1]]

    kinds = np.stack([count(k) for k in range(EDGE)], 1).astype(np.float64)
    size = np.array([len(t) for t in texts], np.float64)
    bytes_ = np.maximum(size, 1)
    letters = kinds[:, LOWER] + kinds[:, UPPER] + kinds[:, WIDE]

    hashes = prefixes(data)
    starts, ends = _runs((kind != SPACE) & (kind != EDGE))
    owner = np.searchsorted(limits, starts, side="right") - 1
    length = ends - starts
    words = np.bincount(owner, minlength=n).astype(np.float64)
    some = np.maximum(words, 1)
    letter = np.concatenate([[0], np.cumsum((kind == LOWER) | (kind == UPPER) | (kind == WIDE))])
    own_letters, own_capitals = letter[ends] - letter[starts], sums[ends] - sums[starts]
    lower = np.concatenate([[0], np.cumsum(kind == LOWER)])
    shouted = (own_capitals >= 2) & (lower[ends] == lower[starts])
    longest = np.zeros(n)
    np.maximum.at(longest, owner, length)
    word = spans(hashes, starts, ends)
    threes = mixed(word[:-2] + mixed(word[1:-1] + mixed(word[2:]))) if len(word) > 2 else word[:0]
    together = owner[:-2] == owner[2:] if len(word) > 2 else np.zeros(0, bool)
    three_owner = owner[:-2][together] if len(word) > 2 else owner[:0]
    n_threes = np.maximum(np.bincount(three_owner, minlength=n), 1)

    starts_l, ends_l = _runs((data != 10) & (kind != EDGE))
    line_owner = np.searchsorted(limits, starts_l, side="right") - 1
    lines = np.bincount(line_owner, minlength=n).astype(np.float64)
    some_lines = np.maximum(lines, 1)
    line_words = np.searchsorted(starts, ends_l) - np.searchsorted(starts, starts_l)
    share = lambda flags, of, per: np.bincount(of, flags, n) / per
    line = spans(hashes, starts_l, ends_l)
    columns = (
        np.log1p(size), np.log1p(words), np.log1p(lines), letters / bytes_,
        kinds[:, UPPER] / np.maximum(kinds[:, UPPER] + kinds[:, LOWER], 1),
        kinds[:, DIGIT] / bytes_, kinds[:, WIDE] / bytes_, kinds[:, SPACE] / bytes_,
        kinds[:, STOP] / some, kinds[:, SIGN] / some, kinds[:, ODD] / some,
        share(length, owner, some), np.log1p(longest),
        share(shouted, owner, some), share(own_letters == 0, owner, some),
        _distinct(owner, word, n) / some, _distinct(three_owner, threes[together], n) / n_threes,
        words / some_lines, share(line_words < 4, line_owner, some_lines),
        1 - _distinct(line_owner, line, n) / some_lines,
        share(kind[ends_l - 1] == STOP, line_owner, some_lines),
        share(kind[starts] == UPPER, owner, some),
    )
    return np.stack(columns, 1)


@dataclass
class Additive:
    """Cuts of each feature, a table per feature and one per pair of features."""

    base: float
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)  # from a bin to its bin in pairs
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def binned(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(c, x[:, i], side="right") for i, c in enumerate(self.cuts)]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probabilities, by adding up the entries of the bins."""
        total = np.full(len(x), self.base)
        bins = self.binned(x)
        for at, table in zip(bins, self.tables):
            total += table[at]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            total += table[self.coarse[i][bins[i]], self.coarse[j][bins[j]]]
        return _logistic(total)


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Step of each bin by a tree of at most ``LEAVES`` leaves over bins in their order."""
    up_g, up_h = (np.concatenate([[0.0], np.cumsum(v)]) for v in (g, h))
    leaves = [(0, len(g))]
    while len(leaves) < LEAVES:
        best, split = 1e-9, None
        for s, e in leaves:
            at = np.arange(s + 1, e)
            if not len(at):
                continue
            left, right = (up_g[at] - up_g[s], up_h[at] - up_h[s]), (up_g[e] - up_g[at], up_h[e] - up_h[at])
            gain = _gain(*left) + _gain(*right) - _gain(up_g[e] - up_g[s], up_h[e] - up_h[s])
            gain[(left[1] < LEAST) | (right[1] < LEAST)] = -1
            top = int(np.argmax(gain))
            if gain[top] > best:
                best, split = gain[top], (s, int(at[top]), e)
        if split is None:
            break
        s, m, e = split
        leaves[leaves.index((s, e))] = (s, m)
        leaves.append((m, e))
    step = np.zeros(len(g))
    for s, e in leaves:
        step[s:e] = -(up_g[e] - up_g[s]) / (up_h[e] - up_h[s] + RIDGE)
    return step


def _corners(sums: np.ndarray) -> np.ndarray:
    """(cut of rows, cut of columns, quarter) sums of the four quarters of a table."""
    up = np.zeros((sums.shape[0] + 1, sums.shape[1] + 1))
    up[1:, 1:] = sums.cumsum(0).cumsum(1)
    a = up[1:-1, 1:-1]
    top, left, whole = up[1:-1, -1:], up[-1:, 1:-1], up[-1, -1]
    return np.stack([a, top - a, left - a, whole - top - left + a], -1)


def _quarters(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and step of the best tree that cuts a table of two features into quarters."""
    if min(g.shape) < 2:
        return 0.0, np.zeros(g.shape)
    gs, hs = _corners(g), _corners(h)
    gain = _gain(gs, hs).sum(-1) - _gain(g.sum(), h.sum())
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    value = -gs[i, j] / (hs[i, j] + RIDGE)
    step = np.empty(g.shape)
    step[: i + 1, : j + 1], step[: i + 1, j + 1 :], step[i + 1 :, : j + 1], step[i + 1 :, j + 1 :] = value
    return float(gain[i, j]), step


def fitted(x: np.ndarray, y: np.ndarray) -> Additive:
    """The tables learned from features and labels, rows in any order."""
    if not len(y):
        return Additive(-40.0)
    share = float(np.mean(y))
    if share in (0.0, 1.0):
        return Additive(40.0 if share else -40.0)
    both = np.unique(np.column_stack([x, y]), axis=0)
    x, y = both[:, :-1], both[:, -1]
    share = float(np.mean(y))
    model = Additive(float(np.log(share / (1 - share))))
    for column in x.T:
        cuts = np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1]))
        model.cuts.append(cuts)
        model.tables.append(np.zeros(len(cuts) + 1))
        model.coarse.append(np.arange(len(cuts) + 1) * min(PAIR_BINS, len(cuts) + 1) // (len(cuts) + 1))
    bins = model.binned(x)
    total = np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = _logistic(total)
        return p - y, p * (1 - p)

    for _ in range(ROUNDS):
        for at, table in zip(bins, model.tables):
            g, h = (np.bincount(at, v, len(table)) for v in slopes())
            step = RATE * _tree(g, h)
            table += step
            total += step[at]

    coarse = [model.coarse[i][at] for i, at in enumerate(bins)]
    sizes = [int(c[-1]) + 1 for c in model.coarse]

    def summed(i: int, j: int, values: tuple) -> list[np.ndarray]:
        at = coarse[i] * sizes[j] + coarse[j]
        return [np.bincount(at, v, sizes[i] * sizes[j]).reshape(sizes[i], sizes[j]) for v in values]

    left = slopes()
    gains = [
        (_quarters(*summed(i, j, left))[0], -i, -j) for i in range(len(bins)) for j in range(i + 1, len(bins))
    ]
    chosen = [(-i, -j) for gain, i, j in sorted(gains, reverse=True)[:PAIRS] if gain > 0]
    tables = {pair: np.zeros((sizes[pair[0]], sizes[pair[1]])) for pair in chosen}
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in tables.items():
            step = RATE * _quarters(*summed(i, j, slopes()))[1]
            table += step
            total += step[coarse[i], coarse[j]]
    model.pairs, model.pair_tables = chosen, [tables[pair] for pair in chosen]
    return model


TRAIN = pa.schema([("quality", pa.int32()), ("features", pa.list_(pa.float64()))])


def training_rows(docs: DataFrame, labels: DataFrame, sample: int) -> pa.Table:
    """Labels and features of about ``sample`` labelled documents that are not held out.

    The labels are drawn first, so what is sent to the scan of the documents is
    bounded by ``sample``; of the rows found, which are more where an id is repeated,
    a draw by their contents keeps the bound.
    """
    known = (
        labels.where("quality is not null and doc_id is not null")
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where(~held_out())
        .distinct()
    )
    drawn = known.where(_drawn(F.xxhash64("doc_id"), known.count(), sample))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = rows.join(F.broadcast(drawn), "doc_id")
    found = found.where(_drawn(F.xxhash64("doc_id", "text", F.lit(1)), found.count(), sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            x = described(texts_of(batch.column("text")))
            yield arrow_batch(TRAIN, {"quality": batch.column("quality"), "features": list(x)})

    return found.select("quality", "text").mapInArrow(run, "quality int, features array<double>").toArrow()


def _drawn(hashed: F.Column, count: int, sample: int) -> F.Column:
    part = min(1.0, sample / max(1, count))
    return F.pmod(hashed, F.lit(1 << 30)) < F.lit(int(part * (1 << 30)))


def trained(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Additive:
    table = training_rows(docs, labels, sample)
    x = np.array(table["features"].to_pylist(), np.float64).reshape(-1, len(FEATURES))
    return fitted(x, (table["quality"].to_numpy() != 0).astype(np.float64))


def quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    spark = docs.sparkSession
    small_batches(spark)
    model = spark.sparkContext.broadcast(trained(docs, labels, sample))
    result = pa.schema(
        [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            score = model.value.scores(described(texts_of(batch.column("text"))))
            columns = {n: batch.column(n) for n in ("doc_id", "held_out")}
            yield arrow_batch(result, {**columns, "score": score, "predicted": (score >= THRESHOLD).astype(np.int32)})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ddl = "doc_id long, held_out boolean, score double, predicted int"
    return rows.withColumn("held_out", held_out()).mapInArrow(run, ddl)


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
