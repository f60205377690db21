"""Operator 8: language by a convolutional network over bytes.

A text is cut into windows of ``WINDOW`` bytes. Filters of two, three and four
bytes run over a window, each keeps its largest response, and a softmax over
these gives the window's probabilities. A text's are the mean of its windows'
log-probabilities, weighted by their bytes. The network is trained in numpy on a
sample of about ``SAMPLE`` labelled texts, the same share for each language and all
of a language that has fewer, with windows from anywhere in them; it is applied to all windows of all texts. As the input is one byte of
256 at each place, a filter is a sum of table rows, and its first layer runs as
look-ups of byte pairs.

Defined results: a null text or one without a letter is ``und`` with score 0; a
null ``lang`` teaches nothing; with no labelled text every prediction is ``und``;
a null ``doc_id`` gets a row, is never held out; repeated rows are predicted
alike; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmill.llm.base import held_out, lean, read, slices, small_batches, texts_of

UNKNOWN = "und"
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16  # per width
SAMPLE = 2000  # labelled texts the network learns from, over all languages
STEPS = 400
BATCH = 64
BATCH_BYTES = 2 << 20


class Network:
    """Filters ``w[width]`` (place, byte, filter), and a softmax layer."""

    def __init__(self, languages: list[str], seed: int = 1):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.w = {k: rng.normal(0, 0.3, (k, 256, FILTERS)).astype(np.float32) for k in WIDTHS}
        self.b = np.zeros(FILTERS * len(WIDTHS), np.float32)
        self.out = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))).astype(np.float32)
        self.c = np.zeros(len(languages), np.float32)
        for k in WIDTHS:
            self.w[k][:, 0] = 0  # what fills up the last window of a text

    def responses(self, x: np.ndarray, k: int) -> np.ndarray:
        """(window, place, filter) of the filters of one width."""
        n = x.shape[1] - k + 1
        return sum(self.w[k][j][x[:, j : j + n]] for j in range(k))

    def train(self, windows: np.ndarray, labels: np.ndarray, seed: int = 2) -> None:
        rng = np.random.default_rng(seed)
        names = [("out", None), ("c", None), ("b", None), *(("w", k) for k in WIDTHS)]
        values = {n: getattr(self, n[0]) if n[1] is None else self.w[n[1]] for n in names}
        first = {n: np.zeros_like(v) for n, v in values.items()}
        second = {n: np.zeros_like(v) for n, v in values.items()}
        for step in range(1, STEPS + 1):
            some = rng.integers(0, len(windows), BATCH)
            grads = self._gradients(windows[some], labels[some])
            rate = 0.01 * min(1.0, 2 * (1 - step / (STEPS + 1)))
            for n, g in grads.items():
                first[n] += 0.1 * (g - first[n])
                second[n] += 0.01 * (g * g - second[n])
                m, v = first[n] / (1 - 0.9**step), second[n] / (1 - 0.99**step)
                values[n] -= (rate * m / (np.sqrt(v) + 1e-6)).astype(np.float32)

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict:
        tops, places = [], []
        for k in WIDTHS:
            r = self.responses(x, k)
            places.append(r.argmax(1))
            tops.append(np.take_along_axis(r, places[-1][:, None], 1)[:, 0])
        h = np.concatenate(tops, 1) + self.b
        act = np.maximum(h, 0)
        p = _softmax(act @ self.out + self.c)
        p[np.arange(len(y)), y] -= 1
        p /= len(y)
        back = (p @ self.out.T) * (h > 0)
        grads = {("out", None): act.T @ p, ("c", None): p.sum(0), ("b", None): back.sum(0)}
        rows = np.arange(len(x))[:, None]
        for i, k in enumerate(WIDTHS):
            g = np.zeros_like(self.w[k])
            own = back[:, i * FILTERS : (i + 1) * FILTERS]
            for j in range(k):
                seen = x[rows, places[i] + j]
                np.add.at(g[j], (seen, np.arange(FILTERS)[None, :]), own)
            g[:, 0] = 0
            grads["w", k] = g
        return grads

    def tables(self) -> tuple[np.ndarray, ...]:
        """Responses to a byte pair: of width 2, of both halves of width 4, of the first two of 3."""
        pair = lambda a, b: (a[:, None] + b[None, :]).reshape(1 << 16, FILTERS)
        w2, w3, w4 = (self.w[k] for k in WIDTHS)
        return pair(w2[0], w2[1]), pair(w3[0], w3[1]), w3[2], pair(w4[0], w4[1]), pair(w4[2], w4[3])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def cut(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of all texts, the text of each and its bytes."""
    counts = [-(-len(t) // WINDOW) for t in texts]
    data = b"".join(t.ljust(n * WINDOW, b"\0") for t, n in zip(texts, counts))
    owner = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    sizes = np.minimum(np.array([len(t) for t in texts], np.int64)[owner] - place * WINDOW, WINDOW)
    return np.frombuffer(data, np.uint8).reshape(-1, WINDOW), owner, sizes


def log_probabilities(net: Network, tables: tuple, windows: np.ndarray) -> np.ndarray:
    """log P(language) of each window."""
    out = []
    t2, t3, t1, t4, t5 = tables
    for s in range(0, len(windows), 32):
        x = windows[s : s + 32]
        p = x[:, :-1].astype(np.int32) << 8 | x[:, 1:]
        tops = [
            t2[p].max(1),
            (t3[p[:, :-1]] + t1[x[:, 2:]]).max(1),
            (t4[p[:, :-2]] + t5[p[:, 2:]]).max(1),
        ]
        act = np.maximum(np.concatenate(tops, 1) + net.b, 0)
        z = act @ net.out + net.c
        z -= z.max(1, keepdims=True)
        out.append(z - np.log(np.exp(z).sum(1, keepdims=True)))
    return np.concatenate(out) if out else np.zeros((0, len(net.languages)))


def trained(docs: DataFrame, sample: int = SAMPLE) -> Network | None:
    """A network that learned from a sample of the labelled rows not held out."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    # The network has an output for each language, so these are few.
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return None
    quota = max(1, sample // len(counts))
    limits = [(lang, math.ceil(min(1.0, quota / n) * (1 << 30))) for lang, n in sorted(counts.items())]
    limit = F.create_map(*(F.lit(x) for pair in limits for x in pair))[F.col("lang")]
    chosen = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < limit
    found = rows.where(chosen).select("lang", "text", F.xxhash64("doc_id", "text").alias("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Three windows from anywhere in each text.
        for batch in batches:
            langs, windows = [], []
            for lang, text, h in zip(
                batch.column("lang").to_pylist(), texts_of(batch.column("text")), batch.column("h").to_pylist()
            ):
                for turn in range(3):
                    start = (h >> 8 * turn) % max(1, len(text) - WINDOW + 1)
                    part = text[start : start + WINDOW].ljust(WINDOW, b"\0")
                    if any(part):
                        langs.append(lang)
                        windows.append(part)
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array(langs, pa.string()), "window": pa.array(windows, pa.binary())}
            )

    table = found.mapInArrow(run, "lang string, window binary").toArrow().to_pydict()
    if not table["lang"]:
        return None
    # The order of rows must not matter.
    pairs = sorted(zip(table["lang"], table["window"]))
    languages = sorted({lang for lang, _ in pairs})
    net = Network(languages)
    windows = np.frombuffer(b"".join(w for _, w in pairs), np.uint8).reshape(-1, WINDOW)
    net.train(windows, np.array([languages.index(lang) for lang, _ in pairs]))
    return net


def _has_letter(text: bytes) -> bool:
    if text.isascii():
        return text.translate(None, _NO_LETTERS) != b""
    return any(map(str.isalpha, text.decode("utf-8", "replace")))


_NO_LETTERS = bytes(b for b in range(128) if not chr(b).isalpha())


def _predictor(held):
    tables: list = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = held.value
        if net and not tables:
            tables.append(net.tables())
        for batch in slices(batches, "text", BATCH_BYTES):
            texts = texts_of(batch.column("text"))
            lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if net:
                windows, owner, sizes = cut(texts)
                log_p = log_probabilities(net, tables[0], windows) * sizes[:, None]
                sums = np.stack([np.bincount(owner, c, len(texts)) for c in log_p.T], 1)
                bytes_ = np.array([max(1, len(t)) for t in texts])
                p = _softmax(sums / bytes_[:, None])
                best = p.argmax(1)
                for i, text in enumerate(texts):
                    if _has_letter(text):
                        lang[i], score[i] = net.languages[best[i]], p[i, best[i]]
            columns = {n: batch.column(n) for n in batch.schema.names}
            columns |= {"lang_pred": pa.array(lang, pa.string()), "score": score}
            yield pa.RecordBatch.from_pydict(columns)

    return run


def identified(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """All rows and columns of the documents, and ``lang_pred`` and ``score``."""
    small_batches(docs.sparkSession)
    net = docs.sparkSession.sparkContext.broadcast(trained(docs, sample))
    rows = docs.drop("lang_pred", "score")
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes) + ", lang_pred string, score double"
    return rows.mapInArrow(lean(_predictor(net)), schema)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("held_out", held_out())
    return identified(docs).select("doc_id", "held_out", "lang_pred", "score")
