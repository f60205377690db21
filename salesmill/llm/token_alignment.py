"""Operator 13: which tokens of two vocabularies end together, and how surely.

A text with a space put in front is encoded by a byte-level vocabulary (A) and by a
piece vocabulary (B). Places where tokens of both end cut the text into groups, and
the two tokens that end there are linked. How often a pair of ids is linked in the
whole corpus tells which A id stands for a B id most often.

The two sorted lists of ends are merged for all documents of a batch at once: one
numpy vector holds the A and B pointers of every lane, a step compares the ends they
point at, emits a link and a cut where they agree and moves whichever end is behind
(both on a link); lanes that are through are taken out of the vector. A lane is a
document, or ``LANE`` bytes of a long one, so a very long document does not keep
the others waiting: a stretch of two sorted lists can be merged by itself.

Corpus counts: documents are gathered into chunks of some megabytes, whose distinct
pairs with their counts go through the shuffle, so a pair that is everywhere has one
row per chunk. Links stay in the chunk as places in its list of pairs.

Defined results: a null or empty text has no tokens, nor has a text whose joined A
or B bytes differ from a space and the text (one that holds U+2581, say): zeros, no
ids and an empty digest; special strings inside a text are plain text; a null
``doc_id`` is kept; repeated rows are aligned alike and each counts; of ids that are
linked equally often all are best; an empty table gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmill.llm.base import arrow_batch, read, saved, slices, small_batches, texts_of
from salesmill.llm.encode import BYTE_BPE, encoder
from salesmill.llm.sentence_pieces import MODEL

LANE = 512  # bytes of a text that one pair of pointers walks
BATCH_BYTES = 1 << 20
CHUNK_BYTES = 8 << 20  # of texts whose pairs are counted together before the shuffle

ALIGNED = pa.schema(
    [("doc_id", pa.int64())]
    + [(n, pa.list_(pa.int32())) for n in ("a_ids", "b_ids", "a_cuts", "b_cuts")]
)
CHUNKS = pa.schema(
    [("chunk", pa.int64()), ("doc_id", pa.list_(pa.int64()))]
    + [(n, pa.list_(pa.int64())) for n in ("n_a", "n_b", "n_links")]
    + [("sha", pa.list_(pa.string())), ("pairs", pa.binary()), ("counts", pa.binary()), ("links", pa.binary())]
)
PAIRS = pa.schema([("chunk", pa.int64()), ("pair", pa.int64()), ("n", pa.int64())])
RESULT = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    + [("groups_sha256", pa.string())]
)
RESULT_DDL = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long,"
    " groups_sha256 string"
)


class Entries:
    """The bytes of every id of a vocabulary, one after another."""

    def __init__(self, entries: list[bytes]):
        self.size = np.array([len(e) for e in entries], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(entries), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.data[_runs(self.start[ids], self.size[ids])]


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of runs, one run after another."""
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes)


def byte_level(path: str) -> list[bytes]:
    """Bytes of each id of a byte-level vocabulary.

    Printable bytes of Latin-1 stand for themselves there, the others for the
    characters from 256 on, in their order.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in plain]
    of = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(other)}
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    entries = [b""] * (1 + max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])]))
    for entry, i in spec["model"]["vocab"].items():
        entries[i] = bytes(of[c] for c in entry) if all(c in of for c in entry) else entry.encode()
    return entries


def piece_bytes(processor) -> list[bytes]:
    """Bytes of each piece: byte pieces are the byte, U+2581 is a space."""
    ids = range(processor.get_piece_size())
    names = [processor.id_to_piece(i) for i in ids]
    return [
        bytes([int(name[3:5], 16)]) if processor.is_byte(i) else name.replace("▁", " ").encode()
        for i, name in zip(ids, names)
    ]


def merged(a_end: np.ndarray, b_end: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of equal ends in two sorted lists, all lanes walked in lockstep.

    Lane i holds the ends from ``edges[i]``, exclusive, to ``edges[i + 1]``.
    """
    a, b = (np.searchsorted(end, edges, side="right") for end in (a_end, b_end))
    a, a_stop, b, b_stop = a[:-1], a[1:], b[:-1], b[1:]
    links_a, links_b = [], []
    while True:
        open_ = (a < a_stop) & (b < b_stop)
        if not open_.all():
            a, a_stop, b, b_stop = a[open_], a_stop[open_], b[open_], b_stop[open_]
        if not len(a):
            break
        left, right = a_end[a], b_end[b]
        both = left == right
        links_a.append(a[both])
        links_b.append(b[both])
        a, b = a + (left <= right), b + (right <= left)
    if not links_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.sort(np.concatenate(links_a)), np.sort(np.concatenate(links_b))


@dataclass
class Aligned:
    """Tokens, links and groups of a batch of documents, one document after another.

    ``a_edge[d]`` is where the A ids of document d start, and so on; ``link_a`` and
    ``link_b`` are places of the linked tokens, which end the groups.
    """

    a: np.ndarray
    b: np.ndarray
    a_edge: np.ndarray
    b_edge: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    link_edge: np.ndarray


class Aligner:
    """Encodes and aligns batches of texts; kept by a worker from task to task."""

    def __init__(self, a_path: str = BYTE_BPE, b_path: str = MODEL):
        import sentencepiece

        self.encoder = encoder(a_path, "byte")
        self.processor = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a_entries = Entries(byte_level(a_path))
        self.b_entries = Entries(piece_bytes(self.processor))
        self._written: np.ndarray | None = None

    def align(self, texts: list[bytes]) -> Aligned:
        full = [b" " + t if t else b"" for t in texts]
        size = np.array([len(t) for t in full], np.int64)
        some = np.flatnonzero(size)
        a, a_count = _gathered(self.encoder.ids([full[d] for d in some]), some, len(full))
        asked = [texts[d].decode("utf-8", "replace") for d in some]
        b, b_count = _gathered(self.processor.encode(asked, num_threads=1), some, len(full))
        # A document whose bytes do not come back has no tokens.
        whole = np.ones(len(full), bool)
        for ids, count, entries in ((a, a_count, self.a_entries), (b, b_count, self.b_entries)):
            owner = np.repeat(np.arange(len(full)), count)
            whole &= np.bincount(owner, entries.size[ids], len(full)).astype(np.int64) == size
        for turn in range(2):
            a, a_count = _only(whole, a, a_count)
            b, b_count = _only(whole, b, b_count)
            if turn:
                break
            data = np.frombuffer(b"".join(t for t, w in zip(full, whole) if w), np.uint8)
            ends = np.cumsum(size[whole])
            wrong = np.flatnonzero((self.a_entries.joined(a) != data) | (self.b_entries.joined(b) != data))
            whole[np.flatnonzero(whole)[np.searchsorted(ends, wrong, side="right")]] = False
        a_end, b_end = np.cumsum(self.a_entries.size[a]), np.cumsum(self.b_entries.size[b])
        limits = np.cumsum([0, *np.where(whole, size, 0)])
        lanes = -(-np.diff(limits) // LANE)
        edges = np.append(limits[:-1].repeat(lanes) + LANE * _runs(np.zeros_like(lanes), lanes), limits[-1])
        link_a, link_b = merged(a_end, b_end, edges)
        a_edge, b_edge = np.cumsum([0, *a_count]), np.cumsum([0, *b_count])
        return Aligned(a, b, a_edge, b_edge, link_a, link_b, np.searchsorted(link_a, a_edge))

    def written(self, got: Aligned) -> list[bytes]:
        """The groups of each document as text: ``a1,a2|b1;a3|b2,b3``."""
        n = len(got.a) + len(got.b)
        if not n:
            return [b""] * (len(got.a_edge) - 1)
        # The tokens of both in the order of the text, a group's A ids first.
        a_size = np.diff(got.link_a + 1, prepend=0)
        b_size = np.diff(got.link_b + 1, prepend=0)
        start = np.cumsum(a_size + b_size) - a_size - b_size
        ids = np.empty(n, np.int64)
        ids[_runs(start, a_size)] = got.a
        ids[_runs(start + a_size, b_size)] = got.b
        after = np.zeros(n, np.int64)  # what follows an id: 0 a comma, 1 a bar, 2 a semicolon, 3 nothing
        after[start + a_size - 1] = 1
        after[start + a_size + b_size - 1] = 2
        edges = got.a_edge + got.b_edge
        filled = np.diff(edges) > 0
        after[edges[1:][filled] - 1] = 3
        if self._written is None:
            most = max(len(self.a_entries.size), len(self.b_entries.size))
            shown = [f"{i}{sign}".encode() for sign in (",", "|", ";", "") for i in range(most)]
            self._written = np.array(shown)
        width = self._written.itemsize
        text = self._written[after * (len(self._written) // 4) + ids]
        sizes = np.char.str_len(text)
        flat = text.view(np.uint8)
        data = flat[flat != 0].tobytes()
        upto = np.concatenate([[0], np.cumsum(sizes)])[edges]
        assert width and upto[-1] == len(data)
        return [data[s:e] for s, e in zip(upto[:-1].tolist(), upto[1:].tolist())]


def _gathered(runs: list, owners: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """All ids in one array, and how many each document has."""
    count = np.zeros(n, np.int64)
    count[owners] = [len(r) for r in runs]
    parts = [np.asarray(r, np.int64) for r in runs]
    return (np.concatenate(parts) if parts else np.zeros(0, np.int64)), count


def _only(whole: np.ndarray, ids: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return ids[np.repeat(whole, count)], np.where(whole, count, 0)


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str = BYTE_BPE, b_path: str = MODEL) -> Aligner:
    """The worker's aligner, kept from task to task."""
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
    return _ALIGNERS[a_path, b_path]


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def alignments(docs: DataFrame, a_path: str = BYTE_BPE, b_path: str = MODEL) -> DataFrame:
    """(doc_id, a_ids, b_ids, a_cuts, b_cuts): ids of both, and how many of each precede each cut.

    The tokens before a cut are linked: ``a_ids[a_cuts[i] - 1]`` with ``b_ids[b_cuts[i] - 1]``.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(a_path, b_path)
        for batch in slices(batches, "text", BATCH_BYTES):
            got = own.align(texts_of(batch.column("text")))
            a_cut = got.link_a + 1 - np.repeat(got.a_edge[:-1], np.diff(got.link_edge))
            b_cut = got.link_b + 1 - np.repeat(got.b_edge[:-1], np.diff(got.link_edge))
            lists = [(got.a, got.a_edge), (got.b, got.b_edge), (a_cut, got.link_edge), (b_cut, got.link_edge)]
            columns = [
                pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(values, pa.int32()))
                for values, edge in lists
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], schema=ALIGNED)

    lists = ", ".join(f"{n} array<int>" for n in ALIGNED.names[1:])
    return _documents(docs).mapInArrow(run, f"doc_id long, {lists}")


def _chunked(a_path: str, b_path: str):
    """One row per chunk of documents: digests, distinct pairs with counts, and links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(a_path, b_path)
        parts: list[tuple] = []
        size, number = 0, TaskContext.get().partitionId() << 32

        def row() -> pa.RecordBatch:
            ids, n_a, n_b, n_links, sha = (list(chain.from_iterable(some)) for some in list(zip(*parts))[:5])
            pairs, at, counts = np.unique(
                np.concatenate([p[5] for p in parts]), return_inverse=True, return_counts=True
            )
            # Two bytes a link where the chunk's pairs allow it.
            at = at.astype("<u2" if len(pairs) <= 1 << 16 else "<u4")
            values = [number, ids, n_a, n_b, n_links, sha, pairs.tobytes(), counts.tobytes(), at.tobytes()]
            return arrow_batch(CHUNKS, {n: [v] for n, v in zip(CHUNKS.names, values)})

        for batch in slices(batches, "text", BATCH_BYTES):
            texts = texts_of(batch.column("text"))
            got = own.align(texts)
            sha = [hashlib.sha256(t).hexdigest() if t else "" for t in own.written(got)]
            pairs = got.a[got.link_a] << 32 | got.b[got.link_b]
            sizes = [np.diff(edge).tolist() for edge in (got.a_edge, got.b_edge, got.link_edge)]
            parts.append((batch.column("doc_id").to_pylist(), *sizes, sha, pairs))
            size += sum(map(len, texts)) + len(texts)
            if size >= CHUNK_BYTES:
                yield row()
                parts, size, number = [], 0, number + 1
        if parts:
            yield row()

    return run


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk, pairs, counts in zip(*(batch.column(n).to_pylist() for n in ("chunk", "pairs", "counts"))):
            found = np.frombuffer(pairs, np.int64)
            columns = {"chunk": np.full(len(found), chunk), "pair": found, "n": np.frombuffer(counts, np.int64)}
            yield arrow_batch(PAIRS, columns)


def _judged(chunk: pa.Table, known: pa.Table) -> pa.Table:
    """The documents of one chunk, with what the corpus says about their links."""
    (row,) = chunk.to_pylist()
    pairs = np.frombuffer(row["pairs"], np.int64)
    at = np.frombuffer(row["links"], "<u2" if len(pairs) <= 1 << 16 else "<u4")
    place = np.searchsorted(pairs, known["pair"].to_numpy())
    count, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
    count[place] = known["count"].to_numpy()
    best[place] = known["best"].to_numpy()
    edges = np.cumsum([0, *row["n_links"]])
    sums = [np.concatenate([[0], np.cumsum(values[at])]) for values in (best, count)]
    best, count = (s[edges[1:]] - s[edges[:-1]] for s in sums)
    values = [row["doc_id"], row["n_a"], row["n_b"], row["n_links"], row["n_links"], best, count, row["sha"]]
    return pa.table([pa.array(v, f.type) for v, f in zip(values, RESULT)], schema=RESULT)


def aligned(docs: DataFrame, a_path: str = BYTE_BPE, b_path: str = MODEL) -> DataFrame:
    """Counts and digests of every document's alignment: the columns of ``RESULT``."""
    small_batches(docs.sparkSession)
    ddl = (
        "chunk long, doc_id array<long>, n_a array<long>, n_b array<long>, n_links array<long>,"
        " sha array<string>, pairs binary, counts binary, links binary"
    )
    chunks = saved(_documents(docs).mapInArrow(_chunked(a_path, b_path), ddl), "alignment-chunks")
    found = chunks.select("chunk", "pairs", "counts").mapInArrow(_pairs, "chunk long, pair long, n long")
    counts = found.groupBy("pair").agg(F.sum("n").alias("count"))
    counts = counts.withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)))
    # At most one row for each id of the B vocabulary.
    most = F.broadcast(counts.groupBy("b").agg(F.max("count").alias("most")))
    judged = counts.join(most, "b").select(
        "pair", "count", (F.col("count") == F.col("most")).cast("long").alias("best")
    )
    by_chunk = found.select("chunk", "pair").join(judged.hint("merge"), "pair")
    return (
        chunks.drop("counts")
        .groupBy("chunk")
        .cogroup(by_chunk.groupBy("chunk"))
        .applyInArrow(_judged, RESULT_DDL)
    )


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned(read(spark, sf_dir, "documents"))
