"""Word shingles as sorted sets of signed 64-bit hashes, computed with numpy over whole texts.

A-Z is lower-cased; words are runs of anything but ASCII white space; a text with fewer words
than a shingle has one shingle, its whole sequence; a text without words has none.
"""

import hashlib

import numpy as np

_BASE = 0x9E3779B97F4A7C15  # odd multipliers of the two polynomial hashes
_STEP = np.uint64(0xD6E8FEB86659FD93)
_CHUNK = 1 << 22


def _powers(n):
    out = np.empty(n, np.uint64)
    out[0] = 1
    if n > 1:
        out[1:] = _BASE
        np.multiply.accumulate(out, out=out)
    return out


def mix(h):
    """A bijection that spreads the bits of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(data: bytes):
    """A 64-bit hash per word of ``data``, in order."""
    raw = np.frombuffer(data, np.uint8)
    word = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    edge = np.flatnonzero(np.diff(word, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    low = raw + (((raw >= 65) & (raw <= 90)).astype(np.uint8) << 5)
    lengths = ends - starts
    at = np.flatnonzero(word)
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    within = np.arange(len(at)) - np.repeat(first, lengths)
    terms = (low[at].astype(np.uint64) + np.uint64(1)) * _powers(int(lengths.max()))[within]
    return mix(np.add.reduceat(terms, first) + lengths.astype(np.uint64))


def shingle_set(text, width):
    """Sorted distinct shingle hashes of one text (``None`` has none)."""
    words = word_hashes((text or "").encode())
    return _set_of(words, width)


def _set_of(words, width):
    n = len(words)
    if n == 0:
        return np.empty(0, np.int64)
    size = min(width, n)
    h = np.zeros(n - size + 1, np.uint64)
    for i in range(size):
        h = (h + words[i : n - size + 1 + i]) * _STEP
    if n < width:
        h = h + np.uint64(n)
    return np.unique(mix(h).view(np.int64))


def shingle_sets(texts, width):
    """``shingle_set`` of each text; short texts are hashed together, a chunk of bytes at a time."""
    group, size = [], 0
    for text in texts:
        data = (text or "").encode()
        group.append(data)
        size += len(data)
        if size >= _CHUNK:
            yield from _sets_of_group(group, width)
            group, size = [], 0
    yield from _sets_of_group(group, width)


def _sets_of_group(group, width):
    if not group:
        return
    joined = b"\n".join(group)
    words = word_hashes(joined)
    # Words of each text: its words are those that begin before the text's end.
    raw = np.frombuffer(joined, np.uint8)
    white = (raw == 32) | ((raw >= 9) & (raw <= 13))
    begins = np.flatnonzero(~white & np.concatenate([[True], white[:-1]])) if len(raw) else np.empty(0, int)
    ends = np.cumsum([len(x) + 1 for x in group])
    bounds = np.concatenate([[0], np.searchsorted(begins, ends)])
    for a, b in zip(bounds[:-1], bounds[1:]):
        yield _set_of(words[a:b], width)


def digest(values):
    """128 bits that stand for a whole set."""
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()
