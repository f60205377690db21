"""Operator 5: toxicity by class-conditional Kneser-Ney word models.

Two models of word pairs, of toxic and of ordinary texts, share their lowest order:

    P_c(w | v) = (max(n_c(v w) - 1, 0) + T_c(v) P_c(w)) / n_c(v .)
    P_c(w)     = (max(N_c(. w) - E_c, 0) + E_c V_c P(w)) / N_c(. .)
    P(w)       = (N(. w) + 1) / (N(. .) + V + 1)

n counts the different texts of a class that hold a pair, T the words seen after v,
N the words seen before w, and V words; P(w) counts over both classes together, so an
expression that both have hardly seen has the same lowest order in both and speaks
for neither. The discount of words is n1 / (n1 + 2 n2), from how many counts are one
and two; that of pairs is one, the most the method has, so a pair of a single text
gets its probability from the lower order. Copies of a text count once.

A document's score starts from the mean over its words of log P_toxic(w | v) - log
P_ordinary(w | v), the length-normalised comparison. A word or two may carry a long
document's label, so the largest of its words' terms log P_toxic(w) - log P_ordinary(w)
and the mean of the two largest count, too, each less ``CAUTION`` standard errors of
the count behind it: words seen in few toxic contexts, as those of a passage that was
copied, have terms almost as large as words seen in hundreds. Large terms come with
length, so its logarithm is the fourth. A logistic curve turns these into a probability.
It is fitted on at most some ``FIT_ROWS`` training texts, each scored as if it had not
been counted: its own pairs are taken off the counts, which is exact, as a text counts
once for each of its pairs.

Words are 64-bit hashes, and a pair a hash of two. Spark counts all pairs of all
training texts; what comes out is one table of the pairs that two texts of a class
hold and one of words. Both grow with the corpus. If
they fit in ``SENT_BYTES``, measured, each task gets them; otherwise documents are
gathered into chunks, whose distinct words and pairs meet the tables in a join.

Defined results: a null or empty text, or one without words, gets the score of
the share of toxic rows; a null label teaches nothing; of several labels of one
id each counts; a null ``doc_id`` is scored and never held out; without training
rows of both classes every score is that share (0.0 without any); repeated rows are
scored alike; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmill.llm.base import (
    arrow_batch,
    held_out,
    lean,
    read,
    saved,
    shuffle_width,
    slices,
    small_batches,
    texts_of,
)
from salesmill.llm.hashing import mixed
from salesmill.llm.word_hashes import words

CAUTION = 3.0
FIT_ROWS = 20_000
BATCH_BYTES = 1 << 20
HELD = 1 << 21  # pairs a task gathers before it counts them
SENT_BYTES = 160 << 20  # tables up to that size are sent to the tasks
CHUNK_BYTES = 32 << 20  # of texts that meet the tables together otherwise
START = np.uint64(0x5354415254)  # stands before the first word

PAIR, WORD = 0, 1
PAIRS = pa.schema([("v", pa.int64()), ("w", pa.int64()), ("n0", pa.int32()), ("n1", pa.int32())])
VALUES = ("n0", "n1", "t0", "t1", "m0", "m1")
COUNTED = pa.schema([("kind", pa.int32()), ("key", pa.int64())] + [(n, pa.int64()) for n in VALUES])
COUNTED_DDL = "kind int, key long, " + ", ".join(f"{n} long" for n in VALUES)
FEATURES = pa.schema([("id", pa.int64()), ("flag", pa.int32())] + [(n, pa.float64()) for n in "abcd"])
FEATURES_DDL = "id long, flag int, a double, b double, c double, d double"


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mixed(before * np.uint64(0x9E3779B97F4A7C15) + word)


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, the word before each, and where each text's words start."""
    word, edges = words(texts)
    before = np.concatenate([[START], word[:-1]]).astype(np.uint64) if len(word) else word
    before[edges[:-1][edges[:-1] < edges[1:]]] = START
    return word, before, edges


def training_texts(docs: DataFrame, labels: DataFrame, sent_bytes: int) -> tuple[DataFrame, int, int]:
    """(text, toxic, h) of labelled documents that are not held out, equal texts of a class once.

    Also how many there are, and how many are toxic.
    """
    known = labels.where("toxic is not null and doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") != 0).cast("int").alias("toxic")
    )
    rows = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out())
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    hashes = {"h": F.xxhash64("text"), "g": F.xxhash64("text", F.lit(1))}
    # Ids and hashes find one row of each text; only those rows' texts are wanted.
    once = saved(
        rows.select("doc_id", *(c.alias(n) for n, c in hashes.items()))
        .join(known.distinct(), "doc_id")
        .groupBy("doc_id", "h", "g", "toxic")
        .agg(F.count(F.lit(1)).alias("rows"))
        .groupBy("h", "g", "toxic")
        .agg(F.min(F.struct("doc_id", "rows")).alias("one"))
        .select("h", "g", "toxic", "one.*"),
        "training",
    )
    n, toxic = once.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    wanted = F.broadcast(once) if 64 * n <= sent_bytes else once
    found = rows.withColumns(hashes).join(wanted, ["doc_id", "h", "g"])
    # Few rows, if any, are there several times with id and text.
    copies = found.where("rows > 1").dropDuplicates(["h", "g", "toxic"])
    columns = ["text", "toxic", "h"]
    return found.where("rows = 1").select(*columns).unionByName(copies.select(*columns)), n, toxic


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs with the number of texts of each class that hold them, as far as a task gathers."""
    held, size = [], 0

    def counted() -> pa.RecordBatch:
        v, w, toxic = (np.concatenate(part) for part in zip(*held))
        key, first, back = np.unique(pair_keys(v, w), return_index=True, return_inverse=True)
        n1 = np.bincount(back, toxic, len(key)).astype(np.int32)
        n0 = np.bincount(back, 1 - toxic, len(key)).astype(np.int32)
        order = np.argsort(v[first])  # the rows of a word together take less room in the shuffle
        columns = {"v": v[first].view(np.int64), "w": w[first].view(np.int64), "n0": n0, "n1": n1}
        return arrow_batch(PAIRS, {n: c[order] for n, c in columns.items()})

    for batch in slices(batches, "text", BATCH_BYTES):
        word, before, edges = _tokens(texts_of(batch.column("text")))
        owner = np.repeat(np.arange(batch.num_rows), np.diff(edges))
        # Each pair of a text once.
        own = mixed(pair_keys(before, word) + owner.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        _, first = np.unique(own, return_index=True)
        held.append((before[first], word[first], batch.column("toxic").to_numpy()[owner[first]]))
        size += len(first)
        if size >= HELD:
            yield counted()
            held, size = [], 0
    if size:
        yield counted()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What sorted pairs add to the tables: the pairs that two texts hold, and words."""

    def rows(v, w, n0, n1) -> Iterator[pa.RecordBatch]:
        start = np.flatnonzero(np.append(True, (v[1:] != v[:-1]) | (w[1:] != w[:-1])))
        v, w = v[start], w[start]
        n = [np.add.reduceat(x.astype(np.int64), start) for x in (n0, n1)]
        seen = [(x > 0).astype(np.int64) for x in n]

        def out(kind: int, key: np.ndarray, **sums: np.ndarray) -> pa.RecordBatch:
            zero = np.zeros(len(key), np.int64)
            values = {name: sums.get(name, zero) for name in VALUES}
            return arrow_batch(COUNTED, {"kind": np.full(len(key), kind, np.int32), "key": key, **values})

        many = np.maximum(*n) > 1
        key = pair_keys(v[many].view(np.uint64), w[many].view(np.uint64)).view(np.int64)
        yield out(PAIR, key, n0=n[0][many], n1=n[1][many])
        name, back = np.unique(v, return_inverse=True)
        sums = {f"n{c}": np.bincount(back, n[c], len(name)).astype(np.int64) for c in (0, 1)}
        sums |= {f"t{c}": np.bincount(back, seen[c], len(name)).astype(np.int64) for c in (0, 1)}
        yield out(WORD, name, **sums)
        name, back = np.unique(w, return_inverse=True)
        yield out(WORD, name, **{f"m{c}": np.bincount(back, seen[c], len(name)).astype(np.int64) for c in (0, 1)})

    rest = None
    for batch in batches:
        columns = [batch.column(n).to_numpy() for n in PAIRS.names]
        rest = columns if rest is None else [np.concatenate(p) for p in zip(rest, columns)]
        v, w = rest[:2]
        if len(v) < HELD:
            continue
        # The last pair may go on in the next batch.
        cut = int(np.flatnonzero((v != v[-1]) | (w != w[-1]))[-1:].sum() + 1) if v[0] != v[-1] or w[0] != w[-1] else 0
        if cut:
            yield from rows(*(c[:cut] for c in rest))
            rest = [c[cut:] for c in rest]
    if rest is not None and len(rest[0]):
        yield from rows(*rest)


def counts(training: DataFrame) -> DataFrame:
    """The tables: (kind, key, counts), one row per pair that two texts hold and per word.

    Pairs are counted in the tasks before they are shuffled, and dealt by both of their
    words, so a word that very many follow is spread.
    """
    found = training.select("text", "toxic").mapInArrow(lean(_pairs), "v long, w long, n0 int, n1 int")
    sorted_ = found.repartition(shuffle_width(training.sparkSession), "v", "w").sortWithinPartitions("v", "w")
    rows = sorted_.mapInArrow(lean(_counted), COUNTED_DDL)
    return rows.groupBy("kind", "key").agg(*(F.sum(n).alias(n) for n in VALUES))


class Table:
    """Sorted keys and a row of counts for each."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[:, order]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of each key, 0 without a row, and whether it has one."""
        if not len(self.keys):
            return np.zeros((len(self.values), len(keys))), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        there = self.keys[at] == keys
        return np.where(there, self.values[:, at], 0).astype(np.float64), there

    @classmethod
    def of(cls, rows: pa.Table, names: tuple[str, ...]) -> Table:
        keys = rows["key"].to_numpy().view(np.uint64)
        values = [rows[n].to_numpy().astype(np.float32) for n in names]
        return cls(keys, np.array(values, np.float32).reshape(len(names), len(keys)))


class Totals:
    """Sums over all words: discounts, and how much there is in each class and in all."""

    def __init__(self, tables: DataFrame):
        of = lambda f: [F.sum(f(F.col(m)).cast("long")) for m in ("m0", "m1")]
        both = F.col("m0") + F.col("m1") > 0
        found = tables.where(F.col("kind") == WORD).agg(
            *of(lambda m: m == 1), *of(lambda m: m == 2), *of(lambda m: m > 0), *of(lambda m: m), F.sum(both.cast("long"))
        )
        n = [v or 0 for v in found.first()]
        self.discount = [n[c] / (n[c] + 2 * n[2 + c]) if n[c] else 0.5 for c in (0, 1)]
        self.seen, self.total = n[4:6], n[6:8]
        self.every, self.types = sum(self.total), n[8]


def log_odds(
    pairs: Table, table: Table, totals: Totals, word, before, edges, own: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """log P_toxic - log P_ordinary of each word after the one before it, and of the word alone.

    That of the word alone is less some standard errors of its toxic count.

    ``own`` has the class of each text where the texts were counted themselves; what
    a text added to the counts is then taken off.
    """
    key = pair_keys(before, word)
    n, there = pairs.find(key)
    after, types = (table.find(before)[0][i : i + 2] for i in (0, 2))
    m = table.find(word)[0][4:6]
    if own is not None and len(word):
        c = np.repeat(own, np.diff(edges))
        doc = np.repeat(np.arange(len(edges) - 1), np.diff(edges)).astype(np.uint64)
        every = np.arange(len(word))

        def of_text(names: np.ndarray) -> np.ndarray:
            return mixed(names + doc * np.uint64(0xC2B2AE3D27D4EB4F))

        _, first = np.unique(of_text(key), return_index=True)  # a text's pairs, each once
        alone = ~there[first] | (n[c[first], first] == 1)  # no other text of the class has the pair

        def taken(names: np.ndarray, weight: np.ndarray) -> np.ndarray:
            name, back = np.unique(of_text(names), return_inverse=True)
            return np.bincount(back[first], weight, len(name))[back]

        after, types = after.copy(), types.copy()
        after[c, every] -= taken(before, np.ones(len(first)))
        types[c, every] -= taken(before, alone.astype(float))
        m[c, every] -= taken(word, alone.astype(float))
        n[c, every] -= there
    shared = (m[0] + m[1] + 1) / (totals.every + totals.types + 1)
    logs, lows = [], []
    for c in (0, 1):
        e = totals.discount[c]
        low = (np.maximum(m[c] - e, 0) + e * totals.seen[c] * shared) / max(1, totals.total[c])
        high = (np.maximum(n[c] - 1, 0) + types[c] * low) / np.maximum(after[c], 1)
        logs.append(np.log(np.where(after[c] > 0, high, low)))
        lows.append(np.log(low))
    return logs[1] - logs[0], lows[1] - lows[0] - CAUTION / np.sqrt(np.maximum(m[1], 0) + 0.5)


def features(term: np.ndarray, alone: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """For each text: mean term, log of its words, largest term of a word and mean of the two largest.

    NaN without words.
    """
    out = np.full((len(edges) - 1, 4), np.nan)
    for i, (s, e) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
        if e > s:
            top = np.sort(np.partition(alone[s:e], e - s - 2)[-2:]) if e - s > 2 else np.sort(alone[s:e])
            out[i] = term[s:e].mean(), np.log(e - s), top[-1], top[-2:].mean()
    return out


def described(rows: DataFrame, tables: DataFrame, totals: Totals, sent, counted: bool) -> DataFrame:
    """(id, flag, a, b, c, d) of rows (id, flag, text): the features of each text.

    ``sent`` are the tables where they fit; ``counted`` says that the flag is the class
    that the text was counted in.
    """

    def of(batch: pa.RecordBatch, pairs: Table, table: Table) -> pa.RecordBatch:
        word, before, edges = _tokens(texts_of(batch.column("text")))
        own = batch.column("flag").to_numpy() if counted else None
        found = features(*log_odds(pairs, table, totals, word, before, edges, own), edges)
        columns = {"id": batch.column("id"), "flag": batch.column("flag")}
        return arrow_batch(FEATURES, {**columns, **dict(zip("abcd", found.T))})

    if sent is not None:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text", BATCH_BYTES):
                yield of(batch, *sent.value)

        return rows.mapInArrow(lean(run), FEATURES_DDL)

    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    chunk = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 + size // CHUNK_BYTES))
    stored = saved(rows.withColumn("chunk", chunk), "chunks")  # both sides must see the same chunks

    def asked(part: pa.Table) -> pa.Table:
        names: list[set] = [set(), set()]
        for batch in slices(iter(part.to_batches()), "text", BATCH_BYTES):
            word, before, _ = _tokens(texts_of(batch.column("text")))
            for held, keys in zip(names, (pair_keys(before, word), np.concatenate([word, before]))):
                held.update(np.unique(keys).view(np.int64).tolist())
        kinds = np.repeat(np.array([PAIR, WORD], np.int32), [len(held) for held in names])
        keys = pa.array([*names[0], *names[1]], pa.int64())
        chunks = pa.array(np.full(len(kinds), part["chunk"][0].as_py()))
        return pa.table({"chunk": chunks, "kind": kinds, "key": keys})

    def scored(part: pa.Table, known: pa.Table) -> pa.Table:
        kinds = known["kind"].to_numpy()
        pairs = Table.of(known.filter(pa.array(kinds == PAIR)), VALUES[:2])
        table = Table.of(known.filter(pa.array(kinds == WORD)), VALUES)
        out = [of(b, pairs, table) for b in slices(iter(part.to_batches()), "text", BATCH_BYTES)]
        return pa.Table.from_batches(out, FEATURES)

    wanted = stored.groupBy("chunk").applyInArrow(asked, "chunk long, kind int, key long")
    met = wanted.join(tables, ["kind", "key"])
    return stored.groupBy("chunk").cogroup(met.groupBy("chunk")).applyInArrow(scored, FEATURES_DDL)


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic curve, the constant last, by Newton's method."""
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-2] * (x.shape[1] - 1) + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fitted(training: DataFrame, count: int, tables: DataFrame, totals: Totals, sent) -> np.ndarray | None:
    """Weights of the curve, from a draw of the training texts; None without both classes."""
    part = min(1.0, FIT_ROWS / max(1, count))
    chosen = F.pmod(F.xxhash64("h", F.lit("fit")), F.lit(1 << 30)) < int(part * (1 << 30))
    rows = training.where(chosen).select(F.lit(0).cast("long").alias("id"), F.col("toxic").alias("flag"), "text")
    found = described(rows, tables, totals, sent, counted=True).toArrow()
    x = np.stack([found[n].to_numpy() for n in "abcd"], 1)
    y = (found["flag"].to_numpy() != 0).astype(np.float64)
    fine = ~np.isnan(x).any(1)
    x, y = x[fine], y[fine]
    if not 0 < y.sum() < len(y):
        return None
    order = np.lexsort((*x.T, y))  # the order of rows must not matter
    return logistic(x[order], y[order])


def toxicity(docs: DataFrame, labels: DataFrame, sent_bytes: int = SENT_BYTES) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    spark = docs.sparkSession
    small_batches(spark)
    training, n, toxic = training_texts(docs, labels, sent_bytes)
    tables = saved(counts(training), "counts")
    n_pairs, n_words = (tables.where(F.col("kind") == kind).count() for kind in (PAIR, WORD))
    share = toxic / n if n else 0.0
    totals = Totals(tables)
    sent = None
    if 16 * n_pairs + 32 * n_words <= sent_bytes:
        sent = spark.sparkContext.broadcast((_collected(tables, PAIR, VALUES[:2]), _collected(tables, WORD, VALUES)))
    weights = fitted(training, n, tables, totals, sent) if 0 < toxic < n else None
    rows = docs.select(
        F.col("doc_id").cast("long").alias("id"),
        held_out().cast("int").alias("flag"),
        F.col("text").cast("string").alias("text"),
    )
    if weights is None:
        score = F.lit(float(share))
        found = rows
    else:
        found = described(rows, tables, totals, sent, counted=False)
        z = F.lit(float(weights[-1]))
        for name, weight in zip("abcd", weights):
            z = z + F.col(name) * F.lit(float(weight))
        odds = 1 / (1 + F.exp(-F.least(F.greatest(z, F.lit(-30.0)), F.lit(30.0))))
        score = F.when(F.isnan("a"), F.lit(float(share))).otherwise(odds)
    scored = found.select(
        F.col("id").alias("doc_id"), (F.col("flag") == 1).alias("held_out"), score.alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _collected(tables: DataFrame, kind: int, names: tuple[str, ...]) -> Table:
    """A table that was measured to be small enough."""
    rows = tables.where(F.col("kind") == kind).select("key", *(F.col(n).cast("float").alias(n) for n in names))
    return Table.of(rows.toArrow(), names)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
