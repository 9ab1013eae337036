"""128-bit hashes of words and word shingles, for a whole Arrow batch at once.

Words are hashed one by one with XXH3-128, as two 64-bit lanes. A shingle is
the chain of its words' hashes, mixed after each word, lane by lane. Two
shingles are the same if both lanes are; no structure of the texts makes
different words alike, as a polynomial hash has it.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import xxhash

#: characters between words: space, tab, line feed, vertical tab, form feed, carriage return; ``bytes.split`` parts at the same
BLANKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
#: A-Z in lower case, blanks as spaces; the rest stays
BLANK = bytes(0x20 if b in BLANKS else int(LOWER[b]) for b in range(256))
#: ASCII that is neither letter nor digit also parts words
NOT_WORD = bytes(0x20 if b < 128 and not chr(b).isalnum() else int(LOWER[b]) for b in range(256))

#: bytes split at once
CHUNK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _chunks(text: bytes):
    """The text in parts of about ``CHUNK`` bytes that end at a space; a longer word stays whole."""
    at = 0
    while len(text) - at > CHUNK:
        to = text.rfind(b" ", at + 1, at + CHUNK)
        if to <= at:
            to = text.find(b" ", at + CHUNK)
            if to < 0:
                break
        yield text[at:to]
        at = to
    yield text[at:]


def words(texts: list[bytes], between: bytes = BLANK) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of all texts (words x 2 lanes), and how many words each text has."""
    digests, counts = [], np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        for part in _chunks(text.translate(between)):
            found = part.split()
            counts[k] += len(found)
            digests.append(b"".join(map(xxhash.xxh3_128_digest, found)))
    return np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2), counts


def known_words(texts: list[bytes], vocabulary: dict[bytes, int], between: bytes = BLANK) -> tuple[np.ndarray, np.ndarray]:
    """Number of each word of all texts in a vocabulary, -1 for others; how many words each text has."""
    numbers, counts = [np.empty(0, np.int32)], np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        for part in _chunks(text.translate(between)):
            found = part.split()
            counts[k] += len(found)
            numbers.append(np.fromiter(map(vocabulary.get, found, repeat(-1)), np.int32, len(found)))
    return np.concatenate(numbers), counts


def shingles(texts: list[bytes], size: int, between: bytes = BLANK, at_most: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` words (shingles x 2 lanes); counts per text.

    A text of fewer words is one shingle (none, without ``at_most``); a text
    without words has none.
    """
    return shingles_of(*words(texts, between), size, at_most)


def shingles_of(h: np.ndarray, counts: np.ndarray, size: int, at_most: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """``shingles`` of texts whose words are hashed already."""
    short = np.where(counts > 0, 1, 0) if at_most else 0
    made = np.where(counts >= size, counts - size + 1, short).astype(np.int64)
    if not made.sum():
        return np.empty((0, 2), np.uint64), made
    text = np.repeat(np.arange(len(counts)), made)
    at = np.arange(len(text)) - np.repeat(np.cumsum(made) - made, made) + np.repeat(np.cumsum(counts) - counts, made)
    have = np.minimum(counts[text], size)
    out = np.repeat(have.astype(np.uint64)[:, None], 2, axis=1)
    for k in range(size):
        inside = k < have
        chained = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[np.minimum(at + k, len(h) - 1)])
        out = chained if inside.all() else np.where(inside[:, None], chained, out)
    return out, made


def distinct(h: np.ndarray) -> np.ndarray:
    """The different shingles in the order of their lanes."""
    h = h[np.argsort(h[:, 0])]
    tied = h[1:, 0] == h[:-1, 0]
    differs = tied & (h[1:, 1] != h[:-1, 1])
    if differs.any():  # two shingles agree in one lane
        h = h[np.lexsort((h[:, 1], h[:, 0]))]
        tied = (h[1:] == h[:-1]).all(axis=1)
    return h[np.concatenate([np.ones(min(len(h), 1), bool), ~tied])]


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """How many shingles two sets (of ``distinct``) have in common."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    place = np.searchsorted(b[:, 0], a[:, 0])
    same = (b[np.minimum(place, len(b) - 1)] == a).all(axis=1) & (place < len(b))
    if (a[1:, 0] == a[:-1, 0]).any() or (b[1:, 0] == b[:-1, 0]).any():
        return len(set(map(tuple, a.tolist())) & set(map(tuple, b.tolist())))
    return int(same.sum())
