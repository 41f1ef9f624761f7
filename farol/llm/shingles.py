"""Word shingles as sorted arrays of 64-bit hashes, by whole-array arithmetic."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

KEPT_WORDS = 400_000   # words whose hash a worker keeps (some 70 MB); beyond it they are hashed again
KEPT_BYTES = 64        # longer words are hashed each time
_ONE = np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Hashes(dict):
    """64 bits of the BLAKE2 digest of a word, kept for words met before."""

    def __missing__(self, word: bytes) -> int:
        value = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        if len(word) <= KEPT_BYTES:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = value
        return value


_HASHES = _Hashes()
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BYTES = np.arange(9, dtype=np.uint64)
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def word_hashes(raw: bytes) -> np.ndarray:
    """Hash of each maximal run of bytes that are not ASCII white space, A-Z lowered.

    Words of up to 8 bytes are their own number, mixed by a bijection of their
    length; longer ones are hashed by BLAKE2.
    """
    raw = raw.lower()
    data = np.frombuffer(raw, np.uint8)
    blank = np.ones(len(data) + 2, bool)
    blank[1:-1] = _BLANK[data]
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    start, size = edge[::2], edge[1::2] - edge[::2]
    eight = np.ndarray((len(data),), "<u8", raw + b"\0" * 7, strides=(1,)) if len(data) else np.empty(0, np.uint64)
    short = np.minimum(size, 8)
    out = mix((eight[start] & _MASK[short]) ^ mix(_BYTES[short] + _ONE))
    long = np.flatnonzero(size > 8)
    if len(long):
        words = [raw[a : a + n] for a, n in zip(start[long].tolist(), size[long].tolist(), strict=True)]
        out[long] = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    return out


def shingle_set(raw: bytes, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``width`` words; a shorter text is one shingle, no words give none."""
    h = word_hashes(raw)
    if not len(h):
        return h
    run = min(width, len(h))
    out = np.zeros(len(h) - run + 1, np.uint64)
    for i in range(run):
        out = mix(out + h[i : len(h) - run + 1 + i] + np.uint64(run))
    out.sort()
    return out[np.concatenate([[True], out[1:] != out[:-1]])]
