"""Operator 10: encoding and decoding by a SentencePiece model, many words at once.

A text is cut into words, each with the white space before it; no piece crosses
such a cut. Distinct words of one length advance together through a Viterbi
lattice in numpy: the hashes of all their substrings probe the sorted hashes of the
pieces, and at each end position the best predecessor of each word is stored as a
backpointer by a maximum over the lengths.

For a unigram model the value of a path is the sum of its pieces' scores. For a
merge (BPE) model, as the public vocabulary is, the pieces of every prefix of a
word are fixed, and a piece may follow another exactly if the merges would leave
both apart. So a path's value is 0 or minus infinity, the test of two neighbours
walks both down their own last merges, and the lattice gives the library's ids.
Blanks beyond one before a word are merged last and from the left, so a run of them
is the longest piece of blanks over and over, then the rest.

Characters without a piece become byte pieces. Decoding joins the pieces, turns
byte pieces to bytes and drops the space put in front.

Defined results: a null text counts as empty; an empty text has no ids; repeated
rows are encoded alike; a null ``doc_id`` is kept; an empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmill.llm.base import arrow_batch, read, slices, small_batches, texts_of

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁"
_WORDS = re.compile(rf"{SPACE}*[^{SPACE}]+|{SPACE}+")
REMEMBERED = 1_000_000  # words a worker keeps
LONGEST = 64  # longer words are seldom seen twice
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
BATCH_BYTES = 2 << 20
ANSWER_BITS = 21  # of the table of remembered answers
SLOT_BITS = 20  # of the table that leaves out most substrings before the search
LATTICE = 1 << 17  # places of a lattice at a time
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _hashes(codes: np.ndarray) -> np.ndarray:
    """Hash of every row of code points; that of a substring follows from any start."""
    h = np.zeros(len(codes), np.uint64)
    for j in range(codes.shape[1]):
        h = h * _BASE + codes[:, j].astype(np.uint64) + np.uint64(1)
    return h


def _slot(h: np.ndarray) -> np.ndarray:
    return (h * _MIX >> np.uint64(64 - SLOT_BITS)).astype(np.intp)


class Model:
    """Pieces of a model file, sorted by hash."""

    def __init__(self, path: str, kind: int | None = None):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces:
            raise ValueError("only models without normalisation are read")
        self.kind = kind or model.trainer_spec.model_type
        self.front = spec.add_dummy_prefix
        self.pieces = [p.piece for p in model.pieces]
        self.scores = np.array([p.score for p in model.pieces])
        types = np.array([p.type for p in model.pieces])
        self.unknown = int(np.flatnonzero(types == UNKNOWN)[0])
        self.bytes = np.full(256, self.unknown)
        for i in np.flatnonzero(types == BYTE):
            self.bytes[int(self.pieces[i][3:5], 16)] = i
        self.byte_of = np.full(len(types), -1)
        self.byte_of[self.bytes] = np.arange(256)
        self.byte_of[self.unknown] = -1
        self.control = types == CONTROL
        usable = np.flatnonzero((types == NORMAL) | (types == USER))
        self.longest = max(len(self.pieces[i]) for i in usable)
        if any(SPACE in self.pieces[i].lstrip(SPACE) for i in usable):
            raise ValueError("pieces must not cross words")
        self.lengths = np.array([len(p) for p in self.pieces])
        keys = np.zeros(len(types), np.uint64)
        for n in np.unique(self.lengths[usable]).tolist():
            some = usable[self.lengths[usable] == n]
            keys[some] = _hashes(np.array([[ord(c) for c in self.pieces[i]] for i in some]))
        self.key = keys
        order = usable[np.argsort(keys[usable], kind="stable")]
        self.sorted_keys, self.sorted_ids = keys[order], order
        if len(np.unique(self.sorted_keys)) != len(order):
            raise ValueError("two pieces share a hash")
        self.maybe = np.zeros(1 << SLOT_BITS, bool)
        self.maybe[_slot(self.sorted_keys)] = True
        self.lowest = self.scores[usable].min() - 10
        self.powers = np.multiply.accumulate(np.array([1] + [int(_BASE)] * (self.longest * 2), np.uint64))
        self.known = {self.pieces[i]: int(i) for i in usable}
        self.remembered: dict[str, bytes] = {}
        if self.kind == BPE:
            self._splits()
        self.answers = np.full(1 << ANSWER_BITS if self.kind == BPE else 0, -1, np.int64)
        self.blank = self._blank()

    def _blank(self) -> int:
        """Length of the longest piece of blanks, if these have one score below all others; else 0."""
        runs = {len(p): i for p, i in self.known.items() if p == SPACE * len(p)}
        several = [i for n, i in runs.items() if n > 1]
        others = [i for i in self.known.values() if i not in runs.values() and self.lengths[i] > 1]
        most = max(runs, default=0)
        fits = (
            self.kind == BPE
            and 1 in runs
            and len(several) > 0
            and len({self.scores[i] for i in several}) == 1
            and self.scores[several[0]] < self.scores[others].min()
            and self.merged(SPACE * most) == [SPACE * most]
        )
        return most if fits else 0

    def probe(self, h: np.ndarray) -> np.ndarray:
        """The piece of each hash, -1 without one."""
        at = np.minimum(np.searchsorted(self.sorted_keys, h), len(self.sorted_keys) - 1)
        return np.where(self.sorted_keys[at] == h, self.sorted_ids[at], -1)

    def _splits(self) -> None:
        """Rank of each piece, and the two pieces its last merge joined (-1 for none)."""
        self.rank = np.zeros(len(self.pieces), np.int64)
        self.rank[np.argsort(-self.scores, kind="stable")] = np.arange(len(self.pieces))
        self.left = np.full(len(self.pieces), -1)
        self.right = np.full(len(self.pieces), -1)
        for piece, i in self.known.items():
            if len(piece) > 1 and (parts := self.merged(piece, stop=2)) and len(parts) == 2:
                self.left[i], self.right[i] = (self.known.get(p, -1) for p in parts)

    def merged(self, word: str, stop: int = 1) -> list[str]:
        """A word's pieces by merging the best neighbours, first ones first, until ``stop`` are left."""
        parts = list(word)
        while len(parts) > stop:
            best, at = None, -1
            for i in range(len(parts) - 1):
                p = self.known.get(parts[i] + parts[i + 1])
                if p is not None and (best is None or self.scores[p] > best):
                    best, at = self.scores[p], i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging leaves pieces a and b apart when they stand side by side.

        The merges within both and those across are undone from the last one on:
        while the later of the two last merges is undone, a merge across, of the
        parts then touching, must not have come before it.
        """
        out = np.ones(len(a), bool)
        limit = np.full(len(a), np.iinfo(np.int64).max)
        open_ = np.arange(len(a))
        a, b = a.copy(), b.copy()
        while len(open_):
            x, y = a[open_], b[open_]
            across = self.probe(self.key[x] * self.powers[self.lengths[y]] + self.key[y])
            hit = (across >= 0) & (np.where(across >= 0, self.rank[across], 0) < limit[open_])
            out[open_[hit]] = False
            open_, x, y = open_[~hit], x[~hit], y[~hit]
            can_x, can_y = self.right[x] >= 0, self.left[y] >= 0
            rx = np.where(can_x, self.rank[x], -1)
            ry = np.where(can_y, self.rank[y], -1)
            undo_x = rx > ry
            # A merge on the left is done first where both are the same one.
            limit[open_] = np.where(undo_x, rx, ry + 1)
            a[open_[undo_x]] = self.right[x[undo_x]]
            b[open_[~undo_x & can_y]] = self.left[y[~undo_x & can_y]]
            open_ = open_[can_x | can_y]
        return out

    def beside(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """As ``apart``; answers are remembered, one for each place of a table of fixed size."""
        pair = a * len(self.pieces) + b
        place = (pair.astype(np.uint64) * _MIX >> np.uint64(64 - ANSWER_BITS)).astype(np.intp)
        kept = self.answers[place]
        out = (kept & 1).astype(bool)
        new = np.flatnonzero(kept >> 1 != pair)
        if len(new):
            asked, which = np.unique(pair[new], return_inverse=True)
            out[new] = self.apart(asked // len(self.pieces), asked % len(self.pieces))[which]
            self.answers[place[new]] = pair[new] * 2 + out[new]
        return out

    def candidates(self, prefix: np.ndarray) -> tuple[np.ndarray, ...]:
        """(end, word, length, piece) of all substrings that are pieces, by end; single characters always.

        ``prefix`` has the hashes of the words' beginnings, a row for each length.
        """
        found = []
        for length in range(1, min(len(prefix) - 1, self.longest) + 1):
            h = prefix[length:] - prefix[:-length] * self.powers[length]
            at, word = np.nonzero(self.maybe[_slot(h)]) if length > 1 else map(np.ravel, np.indices(h.shape))
            piece = self.probe(h[at, word])
            if length > 1:
                hit = np.flatnonzero(piece >= 0)
                at, word, piece = at[hit], word[hit], piece[hit]
            found.append((at + length, word, np.full(len(at), length), piece))
        parts = [np.concatenate(part) for part in zip(*found)]
        order = np.argsort(parts[0], kind="stable")
        return tuple(part[order] for part in parts)

    def lattice(self, words: list[str]) -> list[np.ndarray]:
        """Ids of words of one length."""
        n, size = len(words), len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(n, size)
        prefix = np.zeros((size + 1, n), np.uint64)
        for j in range(size):
            prefix[j + 1] = prefix[j] * _BASE + codes[:, j] + np.uint64(1)
        value = np.full((size + 1, n), -np.inf)
        value[0] = 0
        piece = np.full((size + 1, n), -1)
        back = np.zeros((size + 1, n), np.int64)
        ends, rows, lengths, pieces = self.candidates(prefix)
        edges = np.searchsorted(ends, np.arange(1, size + 2))
        for end in range(1, size + 1):
            span = slice(edges[end - 1], edges[end])
            row, length, one = rows[span], lengths[span], pieces[span]
            new = value[end - length, row]
            if self.kind == BPE:
                before = piece[end - length, row]
                pair = np.flatnonzero((before >= 0) & (one >= 0) & (new > -np.inf))
                new[pair[~self.beside(before[pair], one[pair])]] = -np.inf
            else:
                new += np.where(one >= 0, self.scores[one], self.lowest)
            # The best comes last for each word, of equals the shortest, and is what stays.
            order = np.lexsort((-length, new))
            order = order[new[order] > -np.inf]
            row = row[order]
            value[end, row], piece[end, row], back[end, row] = new[order], one[order], length[order]
        return self._paths(codes, piece, back)

    def _paths(self, codes: np.ndarray, piece: np.ndarray, back: np.ndarray) -> list[np.ndarray]:
        """All words followed back from their ends at once."""
        n, size = codes.shape
        at, live, steps = np.full(n, size), np.arange(n), []
        while len(live):
            steps.append((live, at[live]))
            at[live] -= back[at[live], live]
            live = live[at[live] > 0]
        who, place = (np.concatenate(part) for part in zip(*steps))
        order = np.lexsort((place, who))
        who, place = who[order], place[order]
        ids = piece[place, who]
        counts = np.ones(len(ids), np.int64)
        spelled = {int(i): self.bytes[list(chr(codes[who[i], place[i] - 1]).encode())] for i in np.flatnonzero(ids < 0)}
        for i, own in spelled.items():
            counts[i] = len(own)
        starts = np.concatenate([[0], np.cumsum(counts)])
        flat = np.repeat(ids, counts).astype("<u4")
        for i, own in spelled.items():
            flat[starts[i] : starts[i + 1]] = own
        cuts = starts[np.searchsorted(who, np.arange(n + 1))].tolist()
        return [flat[s:e] for s, e in zip(cuts[:-1], cuts[1:])]

    def blanks(self, n: int) -> list[int]:
        """Ids of n blanks: equal scores merge from the left, so the longest piece comes first and again."""
        whole, left = divmod(n, self.blank)
        rest = self.merged(SPACE * left) if left else []
        return [self.known[SPACE * self.blank]] * whole + [self.known[p] for p in rest]

    def words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of distinct words."""
        out: dict[str, bytes] = {}
        by_size: dict[int, set[str]] = {}
        spaced = []
        for word in words:
            if self.blank and word.startswith(SPACE * 2):
                # Blanks merge after all else: the word with one of them comes out as it would alone.
                tail = word.lstrip(SPACE)
                spaced.append((word, len(word) - len(tail), SPACE + tail if tail else ""))
                word = spaced[-1][2]
            if word:
                by_size.setdefault(len(word), set()).add(word)
        for size, distinct in by_size.items():
            same, step = list(distinct), max(1, min(4096, LATTICE // size))
            for s in range(0, len(same), step):
                some = same[s : s + step]
                out.update((w, ids.tobytes()) for w, ids in zip(some, self.lattice(some)))
        for word, n, alone in spaced:
            ids = np.frombuffer(out[alone] if alone else b"", "<u4")
            if len(ids) and ids[0] == self.known[SPACE]:
                ids = ids[1:]
            elif len(ids):
                n -= 1
            out[word] = np.concatenate([self.blanks(n), ids]).astype("<u4").tobytes()
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = []
        for text in texts:
            line = text.replace(" ", SPACE)
            cut.append(_WORDS.findall(SPACE + line if line and self.front else line))
        if len(self.remembered) > REMEMBERED:
            self.remembered.clear()
        known = self.remembered
        found = [list(map(known.get, words)) for words in cut]
        missing = list({w for ws, fs in zip(cut, found) for w, f in zip(ws, fs) if f is None})
        fresh = self.words(missing)
        known.update((w, ids) for w, ids in fresh.items() if len(w) <= LONGEST)
        return [
            np.frombuffer(b"".join([fresh[w] if f is None else f for w, f in zip(ws, fs)]), "<u4")
            for ws, fs in zip(cut, found)
        ]

    def decode(self, ids: np.ndarray) -> str:
        if not hasattr(self, "raw"):
            self.raw = [
                b"" if c else bytes([b]) if b >= 0 else p.replace(SPACE, " ").encode()
                for p, b, c in zip(self.pieces, self.byte_of.tolist(), self.control.tolist())
            ]
        text = b"".join(map(self.raw.__getitem__, ids.tolist()))
        return text.removeprefix(b" " if self.front else b"").decode("utf-8", "replace")


_MODELS: dict[str, Model] = {}


def model(path: str = MODEL) -> Model:
    """The worker's model, kept from task to task."""
    if path not in _MODELS:
        _MODELS[path] = Model(path)
    return _MODELS[path]


PIECES = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])


def encoded(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """(doc_id, ids) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            texts = [t.decode("utf-8", "replace") for t in texts_of(batch.column("text"))]
            yield arrow_batch(PIECES, {"doc_id": batch.column("doc_id"), "ids": model(path).encode(texts)})

    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, path: str = MODEL) -> DataFrame:
    """(doc_id, text) of lists of ids; a null list gives a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                None if ids is None else model(path).decode(np.array(ids, np.int64))
                for ids in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "text": pa.array(texts, pa.string())})

    return rows.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded again: its ids' number and checksum, and its checksum.

    ``text_crc32`` is that of the decoded text, ``same`` whether it is the text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            raw = texts_of(batch.column("text"))
            ids = model().encode([t.decode("utf-8", "replace") for t in raw])
            back = [model().decode(i).encode() for i in ids]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_ids": [len(i) for i in ids],
                    "ids_crc32": [zlib.crc32(i.tobytes()) for i in ids],
                    "text_crc32": [zlib.crc32(t) for t in back],
                    "same": [t == r for t, r in zip(back, raw)],
                }
            )

    small_batches(spark)
    rows = read(spark, sf_dir, "documents").select("doc_id", "text")
    return rows.mapInArrow(run, "doc_id long, n_ids long, ids_crc32 long, text_crc32 long, same boolean")
