"""Vectorised words and shingles of a batch of texts.

Texts are read as the UTF-8 bytes of one Arrow column.  Words are runs of bytes outside ``[\\x20\\x09-\\x0D]``; all
those bytes are ASCII, so cutting bytes is cutting code points.  A word's hash takes its bytes eight at a time, each
eight xored in and spread by a bijection; words over ``LONG`` bytes take xxh3.  A shingle's hash is a polynomial over
those of its words.  Two different words or shingles collide with a chance of about 2**-64.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

from .shared import CHUNK_BYTES

_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_P), -1, 1 << 64))

#: Bytes up to which a word is hashed in lanes with all others of its batch.
LONG = 256

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

_powers: dict[np.uint64, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64, kept between calls."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, CHUNK_BYTES + 1024), base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if n <= 4 * CHUNK_BYTES:
            _powers[base] = have
    return have[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of ``x`` over the word (a bijection)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column (null: empty) and the n + 1 offsets of its rows."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(column) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


@dataclass
class Words:
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    #: Of each document its first word; one more entry ends the last.
    first: np.ndarray

    @property
    def per_doc(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.per_doc)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the k-word windows at every word (those that leave their document mean nothing), and which fit."""
        n = len(self.hashes)
        h = np.zeros(n, np.uint64)
        for j, p in enumerate(powers(_Q, k)[:n]):
            h[:n - j] += self.hashes[j:] * p
        left = np.repeat(self.first[1:], self.per_doc) - np.arange(n)
        return mixed(h), left >= k


def runs(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes b with ``member[b]``; none crosses a document."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = member[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = word[:-1]
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = word[1:]
    return np.flatnonzero(word & (~before | edge[:-1])), np.flatnonzero(word & (~after | edge[1:])) + 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte strings data[start:end] (none empty)."""
    size = ends - starts
    h = mixed(size.astype(np.uint64) * _P)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray(len(data) + 1, "<u8", padded.data, strides=(1,))
    left = np.where(size > LONG, 0, size)
    rows = np.flatnonzero(left > 0)
    at = starts[rows]
    while len(rows):
        x = eights[at]
        rest = left[rows]
        part = rest < 8
        x[part] &= (np.uint64(1) << (rest[part].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        h[rows] = mixed(h[rows] ^ x)
        more = rest > 8
        left[rows] -= 8
        rows, at = rows[more], at[more] + 8
    for i in np.flatnonzero(size > LONG).tolist():
        h[i] = xxhash.xxh3_64_intdigest(data[starts[i]:ends[i]].tobytes())
    return h


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    starts, ends = runs(data, offsets, ~SPACE)
    return Words(starts, ends, hashes(data, starts, ends), np.searchsorted(starts, offsets))


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles of every document as (document, hash), sorted by both.

    A document with some words but fewer than k has one shingle, all its words; one without words has none.
    """
    h, fits = w.windows(k)
    docs = w.doc_of()
    short = np.flatnonzero((w.per_doc > 0) & (w.per_doc < k))
    whole = np.zeros(len(short), np.uint64)
    for j in range(k - 1):
        has = w.per_doc[short] > j
        whole[has] += w.hashes[w.first[short[has]] + j] * powers(_Q, k)[j]
    whole = mixed(whole + w.per_doc[short].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    docs, h = np.concatenate([docs[fits], short]), np.concatenate([h[fits], whole])
    order = np.lexsort((h, docs))
    docs, h = docs[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (h[1:] != h[:-1])
    return docs[new], h[new]
