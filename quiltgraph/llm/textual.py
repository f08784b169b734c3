"""Words of UTF-8 Arrow columns and their hashes, vectorised over whole batches.

A word is a maximal run of bytes other than blank, tab, line feed, vertical tab, form feed
and carriage return. Hashes are fixed functions of the bytes, alike in every process.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_R = 0x9E3779B97F4A7C15
#: Bytes of a word that are hashed in blocks of eight; longer words take a digest.
_BLOCKS = 32
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (xor-shift and multiply rounds); keeps distinct values distinct."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


@dataclass
class Words:
    data: np.ndarray  # bytes of all texts
    text: np.ndarray  # offsets of the texts in data, one more than texts
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # one past its last byte
    doc: np.ndarray  # offsets of the texts in the words, one more than texts

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.doc)

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.doc) - 1), self.counts)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column without nulls."""
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def words(column: pa.Array) -> Words:
    data, at = text_bytes(column)
    if not len(data):
        return Words(data, at, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64))
    solid = ~_SPACE[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    edge = at[:-1][at[:-1] < at[1:]]
    first[edge] = solid[edge]  # words do not cross from one text to the next
    edge = at[1:][at[:-1] < at[1:]] - 1
    last[edge] = solid[edge]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Words(data, at, start, end, np.searchsorted(start, at))


def word_hashes(w: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes: blocks of eight bytes, mixed one after the other; a BLAKE2b digest of long words."""
    if not len(w.start):
        return np.zeros(0, U)
    size = w.end - w.start
    padded = np.concatenate([w.data, np.zeros(8, np.uint8)])
    block = np.ndarray((len(w.data) + 1,), "<u8", padded, strides=(1,))
    h = mix(size.astype(U) * U(0xD6E8FEB86659FD93) + U(_R))
    live = np.flatnonzero(size <= _BLOCKS)
    for k in range(0, _BLOCKS, 8):
        live = live[size[live] > k]
        if not len(live):
            break
        h[live] = mix(h[live] * U(_R) ^ (block[w.start[live] + k] & _MASK[np.minimum(size[live] - k, 8)]))
    for i in np.flatnonzero(size > _BLOCKS).tolist():
        h[i] = U(int.from_bytes(hashlib.blake2b(w.data[w.start[i] : w.end[i]].tobytes(), digest_size=8).digest(), "little"))
    return h


def single_spaced(w: Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All words in a row, one blank after each, and where each begins and ends there."""
    size = w.end - w.start
    start = np.cumsum(size + 1) - size - 1
    end = start + size
    out = np.full(int(end[-1]) + 1 if len(end) else 0, 0x20, np.uint8)
    mine = np.ones(len(out), bool)
    mine[end] = False
    out[mine] = w.data[~_SPACE[w.data]]
    return out.tobytes(), start, end


def digest(part: bytes) -> bytes:
    """128 bits that stand for a run of words: without a key, but collision-resistant."""
    return hashlib.blake2b(part, digest_size=16).digest()


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * U(0xA0761D6478BD642F) + b + U(0xE7037ED1A0B428DB))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k values from each place on; len(h) - k + 1 of them. Ignores text borders."""
    if len(h) < k:
        return np.zeros(0, U)
    if k == 1:
        return h
    if k % 2:
        return _join(grams(h, k - 1)[: len(h) - k + 1], h[k - 1 :])
    half = grams(h, k // 2)
    return _join(half[: len(h) - k + 1], half[k // 2 :])


def inside(w: Words, k: int) -> np.ndarray:
    """Which k-word runs of the batch, by first word, lie within one text."""
    n = len(w.start) - k + 1
    if n <= 0:
        return np.zeros(0, bool)
    owner = w.owner()
    return owner[:n] == owner[k - 1 :]


def ragged(offsets: np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flat indices of the rows ``pick`` of a ragged array with ``offsets``, and the new offsets."""
    n = (offsets[1:] - offsets[:-1])[pick]
    out = np.concatenate([[0], np.cumsum(n)])
    return np.repeat(offsets[:-1][pick] - out[:-1], n) + np.arange(out[-1]), out
