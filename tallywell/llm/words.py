"""Words of many texts as arrays: bounds, owning text, 64-bit hash. Used inside tasks, on one Arrow batch at a time.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``. No text is cut: a text longer than
a block is processed in pieces that end at white space.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

WHITE = b" \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
BLOCK_BYTES = 1 << 20
_PUNCTUATION = string.punctuation.encode()
_STEP = np.uint64(0x9E3779B97F4A7C15)
_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[list(WHITE)] = True


class Words(NamedTuple):
    start: np.ndarray  # byte offset in the joined texts
    end: np.ndarray
    text: np.ndarray  # number of the text
    hash: np.ndarray  # uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _spread(byte: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A value of 64 random-looking bits for each (byte, place)."""
    return mix(mix((place.astype(np.uint64) << np.uint64(8) | byte.astype(np.uint64)) + _STEP) + _STEP)


_NEAR = 256  # places whose values are looked up
_NEAR_VALUES = _spread(np.tile(np.arange(256), _NEAR), np.repeat(np.arange(_NEAR), 256))


def _word_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Sum of the values of a word's (byte, place in the word), spread once more.

    Words whose hashes are equal without being equal are as rare as with a random function: no pattern of bytes, as in a
    polynomial with a fixed root, makes their values cancel.
    """
    size = end - start
    first = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(first, size)
    byte = raw[np.repeat(start, size) + place]
    near = place < _NEAR
    if near.all():
        value = _NEAR_VALUES[place << 8 | byte]
    else:
        value = np.where(near, _NEAR_VALUES[np.where(near, place, 0) << 8 | byte], _spread(byte, place))
    return mix(np.add.reduceat(value, first) + size.astype(np.uint64) * _STEP)


def normal_text(text: bytes | None) -> bytes:
    """Lower case, without ASCII punctuation: what near copies are compared on."""
    return (text or b"").decode("utf-8", "replace").lower().encode().translate(None, _PUNCTUATION)


def blocks(sizes: list[int], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``limit`` bytes in all, one text at least."""
    first = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield first, i
            first, total = i, 0
        total += n
    if first < len(sizes):
        yield first, len(sizes)


def _pieces(data: bytes) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(data):
        end = min(at + BLOCK_BYTES, len(data))
        if end < len(data):
            cut = max(data.rfind(w, at, end) for w in (b" ", b"\n"))
            if cut <= at:
                later = [k for k in (data.find(w, end) for w in (b" ", b"\n")) if k >= 0]
                cut = min(later, default=len(data) - 1)
            end = cut + 1
        yield at, end
        at = end


def words_of(texts: list[bytes]) -> Words:
    """All words of ``texts`` in order."""
    data = b"\n".join(texts) + b"\n"
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    ends_of_texts = np.cumsum(sizes)
    starts, ends, hashes = [], [], []
    for at, stop in _pieces(data):
        raw = np.frombuffer(data, np.uint8, stop - at, at)
        edge = np.diff(_IS_WHITE[raw], prepend=True, append=True)
        bounds = np.flatnonzero(edge)
        s, e = bounds[0::2], bounds[1::2]
        if not len(s):
            continue
        hashes.append(_word_hashes(raw, s, e))
        starts.append(s + at)
        ends.append(e + at)
    if not starts:
        return Words(*(np.zeros(0, np.int64) for _ in range(3)), np.zeros(0, np.uint64))
    start = np.concatenate(starts)
    return Words(
        start, np.concatenate(ends), np.searchsorted(ends_of_texts, start, "right"), np.concatenate(hashes)
    )


def windows(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` word hashes; the last k - 1 places are left out."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[i : n + i]
    return mix(out)
