"""Token ids of whole texts by the tokenizers library, remembering the ids of parts.

Both vocabularies cut a text before they look anything up, and some of those
cuts can be found without the library. Each part between such cuts is encoded
once per worker and then remembered, as the same words come back all the time.
"""

from __future__ import annotations

import re

import numpy as np
import public_tokenizers

from salesmill.llm.base import one_thread
from salesmill.llm.hashing import Table, prefixes, spans

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")

TABLE_BITS = 21  # at most a million parts are remembered
LONGEST = 64  # longer parts are seldom seen twice
STEP = 1 << 20  # bytes looked at together
MARK = "\x01"

# White space beyond ASCII; texts with any go to the library as they are.
_WIDE = re.compile(
    rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"
)
SPACE, LETTER, SIGN, OTHER, EDGE = range(5)
# The ends of texts are marked by a byte that UTF-8 never uses.
_KINDS = np.full(256, OTHER, np.uint8)
_KINDS[[9, 10, 11, 12, 13, 32]] = SPACE
_KINDS[[b for b in range(128) if chr(b).isalpha()]] = LETTER
_KINDS[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) != "'"]] = SIGN
_KINDS[255] = EDGE


def _kinds(data: np.ndarray) -> np.ndarray:
    """What each byte is to both vocabularies; the letters of Latin-1 count as such."""
    kinds = _KINDS[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    kinds[lead] = kinds[lead + 1] = LETTER
    return kinds


def _cuts(data: np.ndarray, kinds: np.ndarray, spaced: bool) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of parts that never share a token.

    ``spaced``: white space counts. Then a single space goes with what follows,
    another single one stands alone and a longer run stays with what follows.
    """
    space, edge = kinds == SPACE, kinds == EDGE
    body = ~(space | edge)
    before = np.concatenate([[EDGE], kinds[:-1]]).astype(np.uint8)
    first = np.flatnonzero(body & ((before == SPACE) | (before == EDGE)))
    if not len(first):
        whole = np.zeros(0, np.int64)
        first = whole
    # Letters and signs are parted only where a word holds nothing else.
    mixed_up = np.add.reduceat((kinds == OTHER).astype(np.int32), first) if len(first) else first
    start = np.zeros(len(data) + 1, bool)
    start[first] = True
    if spaced:
        run = space & (before != SPACE)
        start[:-1] |= run
        after = first[(first > 0)]
        after = after[space[after - 1]]
        lone = np.ones(len(after), bool)
        two = after > 1
        lone[two] = ~space[after[two] - 2]
        joined = after[~lone | (data[after - 1] == 32)]
        start[joined] = False
        long = np.zeros(len(data), bool)
        long[after[~lone]] = True
        mixed_up = mixed_up + long[first]
    turn = body & (
        ((kinds == LETTER) & (before == SIGN)) | ((kinds == SIGN) & (before == LETTER))
    )
    turn = np.flatnonzero(turn)
    if len(turn):
        turn = turn[mixed_up[np.searchsorted(first, turn, side="right") - 1] == 0]
        start[turn] = True
    starts = np.flatnonzero(start[:-1])
    stop = start.copy()
    stop[:-1] |= edge if spaced else ~body
    stop[-1] = True
    stops = np.flatnonzero(stop)
    ends = stops[np.searchsorted(stops, starts, side="right")]
    return starts, ends


class Encoder:
    """Encodes batches of texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str, kind: str):
        one_thread()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # As the vocabularies' guide has it: special strings in a text are plain text.
        self.tokenizer.encode_special_tokens = True
        self.kind = kind
        (self.mark,) = self._call(MARK)
        self.known = Table(TABLE_BITS)

    def ids(self, texts: list[bytes]) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        some, size = [], 0
        for i, text in enumerate(texts):
            if _WIDE.search(text):
                out[i] = self._call(text.decode("utf-8", "replace"))
                continue
            some.append(i)
            size += len(text)
            if size > STEP:
                self._fill(texts, some, out)
                some, size = [], 0
        if some:
            self._fill(texts, some, out)
        return out

    def _fill(self, texts: list[bytes], some: list[int], out: list) -> None:
        if self.known.full:
            self.known.clear()
        low = self.kind == "word"  # that vocabulary lower-cases all it reads
        chosen = [texts[i].lower() if low and texts[i].isascii() else texts[i] for i in some]
        data = np.frombuffer(b"\xff".join([*chosen, b""]), np.uint8)
        limits = np.cumsum([len(t) + 1 for t in chosen])
        starts, ends = _cuts(data, _kinds(data), spaced=not low)
        key = spans(prefixes(data, 0), starts, ends, 0)
        check = spans(prefixes(data, 1), starts, ends, 1)
        slots = self.known.slots(key, check)
        lost = np.flatnonzero(slots < 0)
        brief = lost[ends[lost] - starts[lost] <= LONGEST]
        _, one = np.unique(key[brief], return_index=True)
        fresh = brief[one]
        raw = data.tobytes()
        cut = [raw[s:e].decode("utf-8", "replace") for s, e in zip(starts[fresh], ends[fresh])]
        self.known.add(key[fresh], check[fresh], self._encode(cut))
        slots[brief] = self.known.slots(key[brief], check[brief])
        long = np.flatnonzero(slots < 0)
        ids, lengths = self.known.runs(np.where(slots < 0, self._empty(), slots))
        if len(long):
            own = [self._call(raw[s:e].decode("utf-8", "replace")) for s, e in zip(starts[long], ends[long])]
            at = (np.cumsum(lengths) - lengths)[long]
            sizes = [len(o) for o in own]
            ids = np.insert(ids, np.repeat(at, sizes), np.concatenate(own))
            lengths[long] = sizes
        upto = np.concatenate([[0], np.cumsum(lengths)])
        edges = upto[np.searchsorted(starts, np.concatenate([[0], limits]))]
        for k, i in enumerate(some):
            out[i] = ids[edges[k] : edges[k + 1]]

    def _empty(self) -> int:
        """The slot of a part without ids, standing in for parts not remembered."""
        nothing = np.zeros(1, np.uint64)
        if self.known.slots(nothing, nothing)[0] < 0:
            self.known.add(nothing, nothing, [np.zeros(0, np.uint32)])
        return int(self.known.slots(nothing, nothing)[0])

    def _encode(self, parts: list[str]) -> list[np.ndarray]:
        """Ids of unknown parts, many in one call, with a mark between them.

        No longer piece of either vocabulary holds the mark's byte, so nothing
        merges with it. Parts that hold it, or end in white space that would
        then be followed by something, or begin like a contraction, are encoded by themselves.
        """
        plain = {p for p in parts if p.isascii() and p.removeprefix(" ").isalpha()}
        if self.kind == "word":
            plain = {p for p in plain if p.islower()}
        alone = {p for p in parts if p not in plain and self._awkward(p)}
        fresh = {p: self._call(p) for p in alone}
        # One run of ASCII letters is looked up as it stands; the byte alphabet
        # of both vocabularies leaves letters alone and writes a space so.
        look = self.tokenizer.model.tokenize
        for p in plain:
            fresh[p] = np.array([t.id for t in look(p.replace(" ", "\u0120"))], "<u4")
        names = [p for p in parts if p not in fresh]
        between = f" {MARK} " if self.kind == "word" else MARK
        for i in range(0, len(names), 4096):
            some = names[i : i + 4096]
            ids = self._call(between.join(some))
            cuts = np.flatnonzero(ids == self.mark)
            if len(cuts) != len(some) - 1:
                raise AssertionError("the mark was merged with a part")
            starts, ends = [0, *(cuts + 1)], [*cuts, len(ids)]
            fresh.update((p, ids[s:e]) for p, s, e in zip(some, starts, ends))
        return [fresh[p] for p in parts]

    @staticmethod
    def _awkward(part: str) -> bool:
        return MARK in part or part[0] == "'" or (len(part) > 1 and part[-1].isspace())

    def _call(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, kind: str) -> Encoder:
    """The worker's encoder, kept from task to task."""
    if (path, kind) not in _ENCODERS:
        _ENCODERS[path, kind] = Encoder(path, kind)
    return _ENCODERS[path, kind]
