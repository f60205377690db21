"""The words of many texts as numbers, without making a string of each."""

from __future__ import annotations

import numpy as np

from salesmill.llm.hashing import prefixes, spans

# Letters are ASCII letters and every byte of a longer character; ASCII letters
# are lower-cased.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True
_LETTER[255] = False  # never part of UTF-8: ends a text


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, and where each text's words start."""
    data = _LOWER[np.frombuffer(b"\xff".join([*texts, b""]), np.uint8)]
    limits = np.cumsum([0, *(len(t) + 1 for t in texts)])
    letter = _LETTER[data]
    edge = np.flatnonzero(np.diff(letter, prepend=False, append=False))
    starts, ends = edge[0::2], edge[1::2]
    hashes = spans(prefixes(data), starts, ends)
    return hashes, np.searchsorted(starts, limits)
