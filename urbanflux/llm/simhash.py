"""Near-duplicates by 64-bit SimHash, compared in bit-sliced form.

Two fingerprints within three bits agree in at least two of five bit blocks, so each
distinct fingerprint goes to ten buckets, one for each pair of blocks. Within a bucket
the fingerprints stand as 64 bit planes, one machine word holding one bit of 64
fingerprints. A query adds the 64 differences plane by plane into carry-save counters
of all 64 at once, and leaves a word once every counter in it has passed the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from urbanflux.llm.common import written_table
from urbanflux.llm.components import components

RADIUS = 3
BITS = 64
#: (lowest bit, width) of the five blocks.
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
#: Fingerprints of a bucket that are compared at once; a larger bucket is cut into tiles that meet in pairs.
TILE = 2048
#: (query, word) pairs whose counters are held at once.
HELD = 1 << 18
#: (query, word) pairs whose fingerprints are told apart at once.
PAIRED = 1 << 12
#: Fingerprints whose buckets are linked in one call.
LINKED = 1 << 16
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """64-bit hashes of the shingles of ``width`` words, repeats included; a shorter text is one shingle."""
    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return np.empty(0, ">u8")
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    size = min(width, len(words))
    hashed = xxhash.xxh64_intdigest
    return np.array([hashed(joined[a:b], 42) for a, b in zip(starts, ends[size - 1 :].tolist())], ">u8")


def fingerprint(text: str | None) -> int:
    """Signed 64-bit SimHash of the 3-word shingles, repeats included; 0 without words."""
    return fingerprint_of(shingle_hashes(text, 3))


def fingerprint_of(hashes: np.ndarray) -> int:
    """Signed 64-bit SimHash of big-endian hashes: the bits set in over half of them; 0 without any."""
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, np.int64)
    for lo in range(0, len(hashes), 1 << 16):
        part = hashes[lo : lo + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big", signed=True)


@F.pandas_udf(LongType())
def fingerprint_column(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in texts], index=texts.index, dtype="int64")


def _planes(prints: np.ndarray) -> np.ndarray:
    """64 rows; bit j of word w in row p is bit p of fingerprint 64 w + j."""
    padded = np.zeros(-(-len(prints) // BITS) * BITS, np.uint64)
    padded[: len(prints)] = prints
    bits = np.unpackbits(padded.astype("<u8").view(np.uint8).reshape(len(padded), 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def _within(planes: np.ndarray, prints: np.ndarray, query: np.ndarray, word: np.ndarray, over: np.ndarray, radius: int = RADIUS):
    """(query, word, bits) of the pairs whose word holds fingerprints within the radius; ``over``: bits left out.

    The radius is 2 at least. Counters have as many bits as the radius and begin so high that
    they run over with the first difference past it.
    """
    bits = radius.bit_length()
    counters = [np.full(len(query), _ALL if (1 << bits) - 1 - radius >> i & 1 else 0, np.uint64) for i in range(bits)]
    for p in range(0, BITS, 3):
        diffs = []
        for plane in range(p, min(p + 3, BITS)):
            set_bits = (prints[query] >> np.uint64(plane)) & np.uint64(1)
            diffs.append(planes[plane][word] ^ (np.uint64(0) - set_bits))
        diffs += [np.zeros(len(query), np.uint64)] * (3 - len(diffs))
        a, b, c = diffs
        # Carry-save: three one-bit inputs become a sum of weight 1 and a carry of weight 2.
        both = a ^ b
        total, carry = both ^ c, (a & b) | (both & c)
        carried = counters[0] & total
        counters[0] ^= total
        # Two carries of weight 2; at most one of them is passed on.
        up = counters[1] & carry
        counters[1] ^= carry
        up |= counters[1] & carried
        counters[1] ^= carried
        for counter in counters[2:]:
            held = counter & up
            counter ^= up
            up = held
        over |= up
        live = over != _ALL
        if not live.all():
            query, word, over, counters = query[live], word[live], over[live], [c[live] for c in counters]
        if not len(query):
            break
    return query, word, ~over


def words_within(
    prints: np.ndarray, queries: np.ndarray, lo: np.ndarray, hi: np.ndarray, radius: int = RADIUS, held: int = HELD,
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query, word, bits) part by part: bit j of word w is fingerprint 64 w + j.

    Query i is compared with the fingerprints lo[i] to hi[i], hi excluded, in bit-sliced form.
    """
    planes = _planes(prints)
    first, last = lo // BITS, (hi - 1) // BITS
    spans = np.cumsum(last - first + 1)
    at = 0
    while at < len(queries):
        done = int(spans[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(spans, done + held, "right")))
        n = last[at:end] - first[at:end] + 1
        query = np.repeat(np.arange(at, end), n)
        word = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[query]
        low = np.maximum(lo[query] - word * BITS, 0)
        high = np.minimum(hi[query] - word * BITS, BITS)
        inside = (_ALL << low.astype(np.uint64)) & (_ALL >> (BITS - high).astype(np.uint64))
        yield _within(planes, queries, query, word, ~inside, radius)
        at = end


def pairs_within(prints: np.ndarray, queries: np.ndarray, lo: np.ndarray, hi: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, place) of all pairs within the radius, part by part; ``lo`` and ``hi`` as in ``words_within``."""
    for query, word, bits in words_within(prints, queries, lo, hi, radius, PAIRED):
        row, bit = np.nonzero(np.unpackbits(bits.astype("<u8").view(np.uint8).reshape(len(bits), 8), axis=1, bitorder="little"))
        yield query[row], word[row] * BITS + bit


def linked_forest(buckets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect what fingerprints within the radius connect, bucket by bucket: a forest, not all pairs."""
    prints = np.concatenate(buckets).view(np.uint64) if buckets else np.empty(0, np.uint64)
    if not len(prints):
        return []
    sizes = np.array([len(b) for b in buckets])
    hi = np.repeat(np.cumsum(sizes), sizes)
    lo = hi - np.repeat(sizes, sizes)
    rows: dict[int, int] = {}
    for part in words_within(prints, prints, lo, hi):
        for q, w, bits in zip(*(x.tolist() for x in part)):
            shift = BITS * w - int(lo[q])
            rows[q] = rows.get(q, 0) | (bits << shift if shift >= 0 else bits >> -shift)
    links, signed = [], prints.view(np.int64).tolist()
    unseen: dict[int, int] = {}
    for start in rows:
        base = int(lo[start])
        left = unseen.get(base)
        if left is None:
            left = (1 << int(hi[start]) - base) - 1
        if not left >> start - base & 1:
            continue
        left ^= 1 << start - base
        stack = [start]
        while stack:
            node = stack.pop()
            new = rows.get(node, 0) & left
            left ^= new
            while new:
                bit = new & -new
                other = base + bit.bit_length() - 1
                new ^= bit
                links.append((signed[node], signed[other]))
                stack.append(other)
        unseen[base] = left
    return links


def _bucket_keys(print_: Column) -> Column:
    keys = []
    for number, pair in enumerate(combinations(BLOCKS, 2)):
        key = F.lit(number).cast("long")
        for low, width in pair:
            key = F.shiftleft(key, width).bitwiseOR(F.shiftrightunsigned(print_, low).bitwiseAND((1 << width) - 1))
        keys.append(key)
    return F.explode(F.array(*keys))


def _link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sizes = batch["prints"].map(len).cumsum().to_numpy()
        lo = 0
        while lo < len(batch):
            done = sizes[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(sizes, done + LINKED, "right")))
            links = linked_forest([np.asarray(p, np.int64) for p in batch["prints"].iloc[lo:hi]])
            yield pd.DataFrame(links, columns=["a", "b"], dtype="int64")
            lo = hi


def fingerprint_links(prints: DataFrame) -> DataFrame:
    """Distinct links (a, b) that connect all distinct fingerprints within the radius of each other."""
    keyed = prints.select("fingerprint", _bucket_keys(F.col("fingerprint")).alias("key"))
    sizes = keyed.groupBy("key").agg(F.ceil(F.count("*") / TILE).alias("tiles"), F.count("*").alias("n"))
    sizes = written_table(sizes.filter("n > 1").select("key", "tiles"), "buckets")
    dealt = keyed.join(sizes, "key").withColumn("tile", F.pmod(F.xxhash64("fingerprint"), "tiles"))
    tiles = dealt.groupBy("key", "tiles", "tile").agg(F.collect_list("fingerprint").alias("prints"))
    tiles = written_table(tiles, "tiles")
    whole = tiles.filter("tiles = 1").select("prints")
    cut = tiles.filter("tiles > 1")
    other = cut.select("key", F.col("tile").alias("tile_b"), F.col("prints").alias("prints_b"))
    pairs = cut.join(other, "key").filter("tile < tile_b").select(F.concat("prints", "prints_b").alias("prints"))
    return whole.union(pairs).mapInPandas(_link, "a long, b long").distinct()


def _classes(fingerprints: DataFrame, member: Column) -> DataFrame:
    """(fingerprint, least): the least member of each fingerprint's component."""
    own = written_table(fingerprints.groupBy("fingerprint").agg(F.min(member).alias("least")), "prints")
    links = written_table(fingerprint_links(own), "links")
    roots = written_table(components(links), "roots")
    reached = own.join(roots, own["fingerprint"] == roots["node"]).groupBy("root").agg(F.min("least").alias("reached"))
    reached = roots.join(reached, "root").select("node", "reached")
    classes = own.join(reached, own["fingerprint"] == reached["node"], "left")
    return written_table(classes.select("fingerprint", F.coalesce("reached", "least").alias("least")), "classes")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row.

    component_id is the smallest doc_id that links of three bits or fewer reach. Null
    and empty texts have fingerprint zero and are linked like any other; a text of one
    or two words is one shingle. Null ids get the least known id of their component,
    null if it has none. Repeated rows appear as often as given. An empty table gives
    an empty result. Other columns are not read.
    """
    prints = written_table(docs.select("doc_id", fingerprint_column("text").alias("fingerprint")), "fingerprints")
    classes = _classes(prints, F.col("doc_id"))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return prints.join(classes, "fingerprint").select("doc_id", digits.alias("fingerprint"), F.col("least").alias("component_id"))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one of each component left: the one with the least id, of repeated ids any one.

    Rows are told apart by a number that is written with them, so repeated and null
    ids lose nothing. All columns are kept as they are.
    """
    rows = docs.select(
        F.struct("*").alias("document"), F.monotonically_increasing_id().alias("row"), fingerprint_column("text").alias("fingerprint"),
    )
    rows = written_table(rows, "numbered")
    member = F.struct(F.col("document.doc_id").isNull().alias("unknown"), "document.doc_id", "row")
    prints = rows.select("fingerprint", member.alias("member"))
    kept = _classes(prints, F.col("member")).select("least.row").distinct()
    return rows.join(kept, "row", "left_semi").select("document.*")
