"""Sampled segmentation into vocabulary pieces, and its lossless inverse.

The pieces that match somewhere in a text form a lattice over its characters. A
forward pass sums the weights of all segmentations up to each place; backward sampling
then walks from the end and takes each last piece with its share of that sum, which
draws a whole segmentation with probability proportional to the product of its
pieces' weights. No piece of the vocabulary goes from a visible character on to a
blank, so the lattice falls apart before each run of blanks: equal words share one
forward pass, while each occurrence draws for itself. Draws are hashes of the row key,
the occurrence and the step, so that a row is cut alike on any cluster.

A vocabulary of merges has ranks in place of log probabilities. Their weights follow
Zipf's law, 1 / (rank + 2); a unigram vocabulary keeps its own scores.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

#: Characters of text cut together; a longer text is cut alone.
CHARACTERS = 1_500_000
#: Log weight of each byte of a character that no piece has.
BYTE_WEIGHT = -12.0
SPACE = "▁"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_RUN = re.compile(r" +[^ ]*")


class Vocabulary:
    """Pieces of a SentencePiece model by length and hash, with their log weights."""

    def __init__(self, path: str, sharpness: float = 1.0):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        usual = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))]
        scores = np.array([model.get_score(i) for i in usual])
        if len(scores) and scores.min() < -1000:  # merge ranks
            rank = np.argsort(np.argsort(-scores, kind="stable"), kind="stable")
            scores = -np.log(rank + 2.0)
        self.bytes = {int(model.id_to_piece(i)[1:-1], 16): i for i in range(n) if model.is_byte(i)}
        self.raw = [b""] * n
        for byte, i in self.bytes.items():
            self.raw[i] = bytes([byte])
        by_length: dict[int, list] = {}
        weights = np.full(n, -np.inf)
        for i, score in zip(usual, scores):
            piece = model.id_to_piece(i).replace(SPACE, " ")
            if " " in piece.lstrip(" "):
                raise ValueError("a piece joins a visible character with a blank behind it")
            self.raw[i] = piece.encode()
            weights[i] = sharpness * score
            for size in range(1, len(piece) + 1):
                by_length.setdefault(size, []).append((piece[:size], i if size == len(piece) else -1))
        self.weights = weights
        self.levels = []  # per length: sorted hashes of the pieces' beginnings, their piece ids or -1
        for size in sorted(by_length):
            best: dict[str, int] = {}
            for text, i in by_length[size]:
                best[text] = max(best.get(text, -1), i)
            codes = np.frombuffer("".join(best).encode("utf-32-le"), "<u4").reshape(-1, size).astype(np.uint64)
            hashes = np.zeros(len(codes), np.uint64)
            for k in range(size):
                hashes = hashes * _BASE + codes[:, k] + np.uint64(1)
            if len(np.unique(hashes)) < len(hashes):
                raise ValueError("two beginnings share a hash")
            order = np.argsort(hashes)
            self.levels.append((hashes[order], np.fromiter(best.values(), np.int64)[order]))
        self.kind = f"<u{id_bytes(n)}"
        sizes = np.array([len(r) for r in self.raw])
        self.sizes, self.begins = sizes, np.cumsum(sizes) - sizes
        self.pool = np.frombuffer(b"".join(self.raw), np.uint8)

    def byte_ids(self, character: int) -> list[int]:
        return [self.bytes[b] for b in chr(character).encode("utf-8", "surrogatepass")]


class Lattice:
    """Lattices of distinct words with the shares of their edges.

    Nodes are numbered by depth, words by falling length, so that a depth is one run of
    nodes and the words that reach it are the first ones. An edge has the share that it
    and the edges of its node before it hold, its length and its piece; a piece below
    zero is a character (-1 - character) that needs several byte pieces.
    """

    def __init__(self, words: list[str], vocabulary: Vocabulary):
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-sizes, kind="stable")
        self.rank = np.empty(len(words), np.int64)
        self.rank[order] = np.arange(len(words))
        sizes = sizes[order]
        self.sizes = sizes
        codes = np.frombuffer("".join([words[i] for i in order]).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        longest = int(sizes[0]) if len(sizes) else 0
        reach = np.searchsorted(-sizes, -np.arange(longest + 1), "right")  # words of that length or more
        self.depth = depth = np.concatenate([[0], np.cumsum(reach)])
        owner = np.repeat(np.arange(len(words)), sizes)
        inside = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        left = sizes[owner] - inside
        ends, pieces, lengths, begins = [], [], [], []
        hashes, at = np.zeros(len(codes), np.uint64), np.arange(len(codes))
        for size, (known, ids) in enumerate(vocabulary.levels, 1):
            at = at[left[at] >= size]
            hashes[at] = hashes[at] * _BASE + codes[at + size - 1] + np.uint64(1)
            found = np.minimum(np.searchsorted(known, hashes[at]), len(known) - 1)
            hit = known[found] == hashes[at]
            piece = np.where(hit, ids[found], -1)
            take = piece >= 0
            start, piece = at[take], piece[take]
            if size == 1:
                alone = at[~take]
                fallback = np.array([self._fallback(vocabulary, c) for c in codes[alone].tolist()], np.int64) if len(alone) else alone
                start, piece = np.concatenate([start, alone]), np.concatenate([piece, fallback])
            begins.append(depth[inside[start]] + owner[start])
            ends.append(depth[inside[start] + size] + owner[start])
            pieces.append(piece)
            lengths.append(np.full(len(start), size, np.int32))
            at = at[hit]
        nodes = int(depth[-1])
        degree = sum((np.bincount(e, minlength=nodes) for e in ends), np.zeros(nodes, np.int64))
        self.first = np.concatenate([[0], np.cumsum(degree)])
        n = int(self.first[-1])
        self.piece, self.length, self.share = np.empty(n, np.int64), np.empty(n, np.int32), np.empty(n)
        begin, seen = np.empty(n, np.int64), np.zeros(nodes, np.int64)
        for b, e, p, k in zip(begins, ends, pieces, lengths):
            slot = self.first[e] + seen[e]
            seen[e] += 1
            begin[slot], self.piece[slot], self.length[slot] = b, p, k
        width = np.ones(n)
        multi = self.piece < 0
        if multi.any():
            width[multi] = [len(chr(-1 - p).encode("utf-8", "surrogatepass")) for p in self.piece[multi].tolist()]
        weight = vocabulary.weights[np.maximum(self.piece, 0)]
        weight[multi | ~np.isfinite(weight)] = BYTE_WEIGHT
        weight *= width
        total = np.zeros(nodes)
        for t in range(1, longest + 1):
            lo, hi = int(self.first[depth[t]]), int(self.first[depth[t + 1]])
            starts = self.first[depth[t] : depth[t + 1]] - lo
            each = degree[depth[t] : depth[t + 1]]
            value = total[begin[lo:hi]] + weight[lo:hi]
            top = np.maximum.reduceat(value, starts)
            held = np.exp(value - np.repeat(top, each))
            sums = np.add.reduceat(held, starts)
            total[depth[t] : depth[t + 1]] = top + np.log(sums)
            shares = np.cumsum(held / np.repeat(sums, each))
            shares -= np.repeat(np.concatenate([[0.0], shares[starts[1:] - 1]]), each)
            shares[starts + each - 1] = 2.0
            self.share[lo:hi] = shares

    @staticmethod
    def _fallback(vocabulary: Vocabulary, character: int) -> int:
        return vocabulary.bytes[character] if character < 128 else -1 - character

    def sample(self, words: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of all occurrences in a row, and the number of each; ``seeds``: one hash per occurrence."""
        rank = self.rank[words]
        left = self.sizes[rank].copy()
        counts = np.zeros(len(words), np.int64)
        steps = []
        live = np.flatnonzero(left > 0)
        step = 0
        while len(live):
            node = self.depth[left[live]] + rank[live]
            draw = _mixed(seeds[live] + np.uint64(step * int(_BASE) & 0xFFFFFFFFFFFFFFFF))
            edge = self.first[node]
            behind = np.flatnonzero(self.share[edge] <= draw)
            while len(behind):
                edge[behind] += 1
                behind = behind[self.share[edge[behind]] <= draw[behind]]
            steps.append((live, self.piece[edge]))
            counts[live] += 1
            left[live] -= self.length[edge]
            live = live[left[live] > 0]
            step += 1
        ends = np.cumsum(counts)
        out = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
        for k, (at, piece) in enumerate(steps):
            out[ends[at] - 1 - k] = piece
        return out, counts


def _mixed(x: np.ndarray) -> np.ndarray:
    """Uniform numbers in [0, 1) from 64-bit counters."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) * 2.0**-53


@lru_cache(maxsize=4)
def _vocabulary(path: str, sharpness: float) -> Vocabulary:
    return Vocabulary(path, sharpness)


def encode_batch(texts: list[str], keys: list[str], vocabulary: Vocabulary, seed: int) -> list[bytes]:
    """Piece ids of each text, packed little-endian."""
    if any("  " in t or t.startswith(" ") or t.endswith(" ") for t in texts):
        split = [_RUN.findall(" " + t) for t in texts]
        flat = pa.array([w for ws in split for w in ws], pa.large_string())
        offsets = np.concatenate([[0], np.cumsum([len(ws) for ws in split])])
        lead = ""
    else:
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        flat, offsets, lead = split.flatten(), split.offsets.to_numpy(), " "
    coded = flat.dictionary_encode()
    lattice = Lattice([lead + w for w in coded.dictionary.to_pylist()], vocabulary)
    rows = np.diff(offsets)
    salts = np.fromiter((xxhash.xxh64_intdigest(k.encode("utf-8", "replace"), seed) for k in keys), np.uint64, len(keys))
    number = (np.arange(offsets[-1]) - np.repeat(offsets[:-1], rows)).astype(np.uint64)
    seeds = _mixed_bits(np.repeat(salts, rows) + number * np.uint64(0xD1342543DE82EF95))
    pieces, counts = lattice.sample(coded.indices.to_numpy().astype(np.int64), seeds)
    bounds = np.concatenate([[0], np.cumsum(counts)])[offsets]
    out = []
    for a, b in zip(bounds, bounds[1:]):
        ids = pieces[a:b]
        if (ids < 0).any():
            ids = np.array([j for i in ids.tolist() for j in ([i] if i >= 0 else vocabulary.byte_ids(-1 - i))], np.int64)
        out.append(ids.astype(vocabulary.kind).tobytes())
    return out


def _mixed_bits(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(33))


def decode_pieces_of(packed: bytes, vocabulary: Vocabulary) -> str:
    """The text of packed piece ids: their bytes in a row, less the blank set before the first word."""
    ids = np.frombuffer(packed, vocabulary.kind)
    if not len(ids):
        return ""
    sizes = vocabulary.sizes[ids]
    ends = np.cumsum(sizes)
    data = vocabulary.pool[np.arange(ends[-1]) + np.repeat(vocabulary.begins[ids] - (ends - sizes), sizes)].tobytes()
    return data.decode("utf-8")[1:]


def _parts(texts: list[str]) -> Iterator[tuple[int, int]]:
    lo, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= CHARACTERS:
            yield lo, i + 1
            lo, held = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def encode_pieces(text: Column, key: Column, vocabulary: str, seed: int = 7, sharpness: float = 1.0) -> Column:
    """Packed piece ids (binary) of a text, sampled by the row key. Null texts count as empty.

    A text always gets the blank before its first word, so an empty text is the one piece
    of a blank. Null keys are one key.
    """

    @F.pandas_udf(BinaryType())
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        held = _vocabulary(vocabulary, sharpness)
        for texts, keys in batches:
            t = [x or "" for x in texts]
            k = keys.tolist()
            for lo, hi in _parts(t):
                yield pd.Series(encode_batch(t[lo:hi], k[lo:hi], held, seed), dtype=object)

    return run.asNondeterministic()(text, F.coalesce(key.cast("string"), F.lit("")))


def decode_pieces(packed: Column, vocabulary: str) -> Column:
    """The text of packed piece ids; null for null."""

    @F.pandas_udf(StringType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        held = _vocabulary(vocabulary, 1.0)
        for batch in batches:
            yield pd.Series([None if p is None else decode_pieces_of(p, held) for p in batch], index=batch.index, dtype=object)

    return run(packed)


def id_bytes(pieces: int) -> int:
    """Bytes of a packed id of a vocabulary with so many pieces."""
    return 2 if pieces <= 1 << 16 else 4


def encode_documents(docs: DataFrame, vocabulary: str, seed: int = 7, sharpness: float = 1.0) -> DataFrame:
    """All columns of ``docs`` with pieces: the packed ids, seeded by doc_id.

    Repeated ids with equal texts are cut alike. An empty table gives an empty result. An
    input column named pieces is replaced.
    """
    return docs.withColumn("pieces", encode_pieces(F.col("text"), F.col("doc_id"), vocabulary, seed, sharpness))


def checked(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_pieces, pieces_crc32 and lossless (the decoded pieces are the text) of encoded documents."""
    import sentencepiece

    width = id_bytes(sentencepiece.SentencePieceProcessor(model_file=vocabulary).get_piece_size())
    lossless = decode_pieces(F.col("pieces"), vocabulary) == F.coalesce("text", F.lit(""))
    return encoded.select(
        "doc_id", (F.octet_length("pieces") / width).cast("long").alias("n_pieces"), F.crc32("pieces").alias("pieces_crc32"),
        lossless.alias("lossless"),
    )
