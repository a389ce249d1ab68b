"""Directly addressable codes for token ids.

An id is cut into bytes, lowest first. Level 0 holds the lowest byte of every id, level
1 the next byte of those ids that have one, and so on. A bitmap beside each level says
whether an id goes on; the ones before a place, which are the id's place on the next
level, come from a directory of counts per 512 bits and a popcount within the block.

File: magic ``DAC1``, then little-endian 64-bit numbers: levels, ids, documents; per
level its length; document ids (signed), a byte per document that tells if the id is
known, and the first id of each document with the total after the last; then per level
its bytes, its bitmap (padded to whole blocks; none on the last level) and directory.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

MAGIC = b"DAC1"
BLOCK = 512


def pack(ids: np.ndarray, doc_ids: np.ndarray, known: np.ndarray, starts: np.ndarray) -> bytes:
    """The bytes of a file; ``starts`` has one entry per document and the total."""
    levels, rest = [], np.ascontiguousarray(ids, "<u4")
    while True:
        chunk, rest = (rest & 255).astype(np.uint8), rest >> 8
        more = rest > 0
        if not more.any():
            levels.append([chunk])
            break
        blocks = -(-len(chunk) // BLOCK)
        bits = np.zeros(blocks * BLOCK // 8, np.uint8)
        bits[: -(-len(chunk) // 8)] = np.packbits(more, bitorder="little")
        ones = np.bitwise_count(bits.view("<u8")).reshape(blocks, BLOCK // 64).sum(1, dtype=np.int64)
        levels.append([chunk, bits, (np.cumsum(ones) - ones).astype("<i8")])
        rest = rest[more]
    head = np.array([len(levels), len(ids), len(doc_ids), *[len(x[0]) for x in levels]], "<i8")
    parts = [MAGIC, head, np.asarray(doc_ids, "<i8"), np.asarray(known, np.uint8), np.asarray(starts, "<i8")]
    return b"".join(x if isinstance(x, bytes) else x.tobytes() for x in [*parts, *[y for x in levels for y in x]])


class Codes:
    """A file's content; any id is read without decoding its neighbours."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        self._data, self._at = data, 4
        n_levels, self.n_ids, self.n_documents = (int(x) for x in self._take("<i8", 3))
        lengths = self._take("<i8", n_levels).tolist()
        self.doc_ids = self._take("<i8", self.n_documents)
        self.known = self._take(np.uint8, self.n_documents).astype(bool)
        self.starts = self._take("<i8", self.n_documents + 1)
        self.levels = []
        for i, n in enumerate(lengths):
            chunk = self._take(np.uint8, n)
            blocks = 0 if i == n_levels - 1 else -(-n // BLOCK)
            self.levels.append((chunk, self._take("<u8", blocks * BLOCK // 64), self._take("<i8", blocks)))

    def _take(self, kind, n: int) -> np.ndarray:
        out = np.frombuffer(self._data, kind, n, self._at)
        self._at += out.nbytes
        return out

    def __getitem__(self, place: int) -> int:
        """Id number ``place``: one byte, one bit and one rank for each level it reaches."""
        value = 0
        for depth, (chunk, bits, ranks) in enumerate(self.levels):
            value |= int(chunk[place]) << 8 * depth
            if not len(bits):
                break
            word, bit = divmod(place, 64)
            if not int(bits[word]) >> bit & 1:
                break
            first = place // BLOCK * (BLOCK // 64)
            inside = int(np.bitwise_count(bits[first:word]).sum()) + (int(bits[word]) & (1 << bit) - 1).bit_count()
            place = int(ranks[place // BLOCK]) + inside
        return value

    def span(self, lo: int, hi: int) -> np.ndarray:
        """Ids lo to hi, hi excluded, as unsigned 32-bit numbers."""
        out = np.zeros(hi - lo, "<u4")
        held = np.arange(hi - lo)
        for depth, (chunk, bits, ranks) in enumerate(self.levels):
            out[held] |= chunk[lo:hi].astype("<u4") << np.uint32(8 * depth)
            if not len(bits) or hi <= lo:
                break
            more = np.unpackbits(bits[lo // 64 : -(-hi // 64)].view(np.uint8), bitorder="little")[lo % 64 :][: hi - lo].astype(bool)
            held = held[more]
            lo = self._rank(bits, ranks, lo)
            hi = lo + len(held)
        return out

    @staticmethod
    def _rank(bits: np.ndarray, ranks: np.ndarray, place: int) -> int:
        block, word = place // BLOCK, place // 64
        inside = int(np.bitwise_count(bits[block * (BLOCK // 64) : word]).sum())
        return int(ranks[block]) + inside + (int(bits[word]) & (1 << place % 64) - 1).bit_count()


def document_ids(read_at: Callable[[int, int], bytes], number: int) -> np.ndarray:
    """Ids of document ``number`` of a file of which ``read_at(size, offset)`` gives parts.

    Read are the header, two starts and, for each level, the bytes of the document, their
    bits from the start of their block, and a directory entry: nothing in proportion to the file.
    """

    def part(kind, offset: int, n: int) -> np.ndarray:
        return np.frombuffer(read_at(n * np.dtype(kind).itemsize, offset), kind, n)

    if bytes(read_at(4, 0)) != MAGIC:
        raise ValueError("not a file of directly addressable codes")
    n_levels, _, documents = part("<i8", 4, 3).tolist()
    if not 0 <= number < documents:
        raise IndexError(f"document {number} of {documents}")
    lengths = part("<i8", 28, n_levels).tolist()
    at = 28 + 8 * n_levels + 9 * documents
    lo, hi = part("<i8", at + 8 * number, 2).tolist()
    at += 8 * (documents + 1)
    out, held = np.zeros(hi - lo, "<u4"), np.arange(hi - lo)
    for depth, n in enumerate(lengths):
        out[held] |= part(np.uint8, at + lo, hi - lo).astype("<u4") << np.uint32(8 * depth)
        at += n
        if depth == n_levels - 1 or hi <= lo:
            break
        blocks, first, last = -(-n // BLOCK), lo // BLOCK, -(-hi // BLOCK)
        bits = np.unpackbits(part(np.uint8, at + first * BLOCK // 8, (last - first) * BLOCK // 8), bitorder="little")
        at += blocks * BLOCK // 8
        more = bits[lo - first * BLOCK : hi - first * BLOCK].astype(bool)
        ahead = int(bits[: lo - first * BLOCK].sum())
        lo = int(part("<i8", at + 8 * first, 1)[0]) + ahead
        at += 8 * blocks
        held = held[more]
        hi = lo + len(held)
    return out
