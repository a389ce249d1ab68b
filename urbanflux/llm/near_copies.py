"""One row of each group of near copies: SimHash of word shingles in bit-sliced form, then their exact Jaccard similarity.

Rows with one shingle set are one node, with a 64-bit SimHash of that set. At a Jaccard
similarity of 0.8 two fingerprints differ in ten bits and more, so blocks of them that
agree, as for a radius of three bits, would lose most links. MinHash bands deal the nodes
to buckets instead; within a bucket the fingerprints stand as bit planes and are
compared by carry-save counters within a wider radius, and what lies in it counts
only if the two sets, compared whole, are similar enough. With BANDS bands of ROWS
hashes a pair of similarity s meets nowhere with probability (1 - s^ROWS)^BANDS, 3e-6 at
0.8 and less above; over RADIUS bits lie between two sets of similarity 0.8 with
probability 1.1e-6 for 4 and 5 shingles and 6e-8 at most for any more.

A bucket is not compared pair by pair. In a round all its nodes meet one of them, the
center, which then leaves the bucket; nodes that are connected need not meet; nodes with
too many shingles of their own are like no other. What is still open after STARS rounds,
in most corpora nothing or a few rows, meets tile by tile where classes differ and the
shingles that others have too may suffice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from urbanflux.llm.common import StageTables, written_table
from urbanflux.llm.components import components
from urbanflux.llm.simhash import fingerprint_of, pairs_within, shingle_hashes

BANDS, ROWS = 32, 5
#: Most bits in which the fingerprints of two similar sets differ.
RADIUS = 28
#: Nodes of a bucket that stand as one set of bit planes; a larger bucket is cut into tiles.
TILE = 512
#: Rounds in which each open bucket meets one more center.
STARS = 4
#: (shingle, hash) pairs that are held at once.
HELD = 1 << 18
_RNG = np.random.default_rng(11)
_FACTORS = _RNG.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _RNG.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)
_MIX = _RNG.integers(0, 2**63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes; none for a text without words."""
    return np.unique(shingle_hashes(text, width).astype(np.int64))


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band; none without shingles."""
    if not len(shingles):
        return np.empty(0, np.int64)
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    x = shingles.view(np.uint64)
    x = x ^ (x >> np.uint64(32))
    step = max(1, HELD // len(least))
    for lo in range(0, len(x), step):
        y = x[lo : lo + step, None] * _FACTORS + _TERMS
        np.minimum(least, (y ^ (y >> np.uint64(29))).min(0), out=least)
    mixed = (least.reshape(BANDS, ROWS) * _MIX).sum(1, dtype=np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * _FACTORS[0] + _TERMS[:BANDS]
    return mixed.view(np.int64)


def _described(width: int):
    kind = StructType().add("digest", StringType()).add("n", IntegerType()).add("print", LongType()).add("bands", ArrayType(LongType()))

    @F.pandas_udf(kind)
    def described(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            s = shingle_set(text, width)
            out.append((hashlib.md5(s.tobytes()).hexdigest(), len(s), fingerprint_of(s.astype(">i8")), band_keys(s)))
        return pd.DataFrame(out, columns=["digest", "n", "print", "bands"], index=texts.index)

    return described


def _shingles(width: int):
    @F.pandas_udf(ArrayType(LongType()))
    def shingles(texts: pd.Series) -> pd.Series:
        return pd.Series([shingle_set(t, width) for t in texts], index=texts.index)

    return shingles


def _similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those pairs (a, b) whose sets are similar enough."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    both = pairs.join(one, "a").join(two, "b").withColumn("common", F.size(F.array_intersect("of_a", "of_b")))
    union = F.size("of_a") + F.size("of_b") - F.col("common")
    return both.filter(F.col("common") / union >= similarity).select("a", "b")


def _pair(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _sizes_allow(a: str, b: str, similarity: float) -> Column:
    return F.least(a, b) / F.greatest(a, b) >= similarity


def _sharing(similarity: float) -> float:
    """Least overlap of two similar sets as a share of the sum of their sizes."""
    return similarity / (1 + similarity)


def _may_overlap(similarity: float) -> Column:
    """Two sets (n, shared) and (n_b, shared_b) have no more in common than the lesser of their shared shingles."""
    return F.least("shared", "shared_b") >= _sharing(similarity) * (F.col("n") + F.col("n_b")) - 1e-6


def _open(classed: DataFrame) -> DataFrame:
    """Rows of buckets that hold more than one class."""
    kinds = classed.groupBy("key").agg(F.min("class").alias("one"), F.max("class").alias("other")).filter("one < other").select("key")
    return classed.join(kinds, "key", "left_semi")


def _classed(keyed: DataFrame, links: DataFrame, tables: StageTables) -> DataFrame:
    roots = tables.write(components(links), "roots").withColumnRenamed("node", "of")
    joined = keyed.join(roots, F.col("node") == F.col("of"), "left")
    return joined.select("key", "node", "n", "print", F.coalesce("root", "node").alias("class"))


def _able(open_: DataFrame, sets: DataFrame, similarity: float, tables: StageTables) -> DataFrame:
    """Rows of open buckets whose set may still be like another of its bucket, with ``shared``.

    A shingle that no other set of any open bucket has is in no intersection. A set
    whose other shingles, ``shared`` in number, are fewer than it must have in common
    with the smallest set of the bucket is like none of them.
    """
    nodes = open_.select("node").distinct()
    shingles = sets.join(nodes, "node", "left_semi").select("node", F.explode("shingles").alias("shingle"))
    alone = shingles.groupBy("shingle").agg(F.count("*").alias("sets"), F.min("node").alias("node")).filter("sets = 1")
    alone = tables.write(alone.groupBy("node").agg(F.count("*").alias("alone")), "alone")
    least = open_.groupBy("key").agg(F.min("n").alias("least"))
    counted = open_.join(alone, "node", "left").join(least, "key").withColumn("shared", F.col("n") - F.coalesce("alone", F.lit(0)))
    # A little less than the bound: the division below it is in floats.
    able = counted.filter(F.col("shared") >= _sharing(similarity) * (F.col("n") + F.col("least")) - 1e-6)
    return able.select("key", "node", "n", "print", "class", "shared")


def _tiles(rows: DataFrame, by: list[str], fields: list[str]) -> DataFrame:
    """One row for each group, with an array of each field, in one order."""
    held = rows.groupBy(*by).agg(F.collect_list(F.struct(*fields)).alias("held"))
    return held.select(*by, *[F.col(f"held.{f}").alias(f) for f in fields])


def _joined(arrays: pd.Series) -> np.ndarray:
    return np.concatenate([np.asarray(a, np.int64) for a in arrays])


def _by_centers(radius: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Pairs of a center and the nodes of its tile within the radius."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            node, hi = _joined(batch["node"]), batch["node"].map(len).cumsum().to_numpy()
            center, lo = batch["node_b"].to_numpy(), np.concatenate([[0], hi[:-1]])
            prints, queries = _joined(batch["print"]).view(np.uint64), batch["print_b"].to_numpy().view(np.uint64)
            for query, place in pairs_within(prints, queries, lo, hi, radius):
                yield pd.DataFrame({"a": center[query], "b": node[place]})

    return run


def _by_tiles(radius: int, similarity: float) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Pairs of two tiles within the radius that may be similar, each in the first band that both share."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            sizes, hi = batch["node"].map(len), batch["node_b"].map(len).cumsum().to_numpy()
            per_query = [np.repeat(x, sizes) for x in (np.concatenate([[0], hi[:-1]]), hi, batch["key"].to_numpy())]
            one = {c: _joined(batch[c]) for c in ("node", "print", "n", "class", "shared")}
            two = {c: _joined(batch[f"{c}_b"]) for c in one}
            bands, bands_b = _joined(batch["bands"]).reshape(-1, BANDS), _joined(batch["bands_b"]).reshape(-1, BANDS)
            lo, hi, key = per_query
            for query, place in pairs_within(two["print"].view(np.uint64), one["print"].view(np.uint64), lo, hi, radius):
                n, n_b = one["n"][query], two["n"][place]
                may = (one["class"][query] != two["class"][place]) & (np.minimum(n, n_b) / np.maximum(n, n_b) >= similarity)
                may &= np.minimum(one["shared"][query], two["shared"][place]) >= _sharing(similarity) * (n + n_b) - 1e-6
                query, place = query[may], place[may]
                first = (bands[query] == bands_b[place]).argmax(1)
                here = bands[query, first] == key[query]
                a, b = one["node"][query[here]], two["node"][place[here]]
                yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return run


def _by_buckets(able: DataFrame, bands: DataFrame, similarity: float, radius: int, tables: StageTables) -> DataFrame:
    """Pairs of different classes in one bucket, each pair once: in the first band that both share.

    Where that bucket is no longer open to both, they are of one class, have met, or are unlike.
    """
    fields = ["node", "print", "n", "class", "shared", "bands"]
    counts = able.groupBy("key").agg(F.ceil(F.count("*") / TILE).alias("tiles"))
    dealt = able.join(counts, "key").join(bands, "node").withColumn("tile", F.pmod(F.xxhash64("node"), "tiles"))
    one = tables.write(_tiles(dealt, ["key", "tile"], fields).withColumn("bands", F.flatten("bands")), "tiles")
    two = one.select("key", *[F.col(c).alias(f"{c}_b") for c in ("tile", *fields)])
    # A tile also meets itself; pairs found from both sides are made one.
    met = one.join(two, "key").filter("tile <= tile_b").drop("tile", "tile_b")
    return met.mapInPandas(_by_tiles(radius, similarity), "a long, b long").distinct()


def similar_links(heads: DataFrame, width: int, similarity: float, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that connect all nodes (node, n, print, bands, text) whose similar pairs share a band and lie within the radius.

    What each set shares with any other is counted before the first round, so that rows
    that are like none, however many meet in a bucket, take part in no round.
    """
    with StageTables() as lasting:
        keyed = lasting.write(heads.select("node", "n", "print", F.explode("bands").alias("key")), "bands")
        keyed = lasting.write(_open(keyed.withColumn("class", F.col("node"))), "buckets")
        known = keyed.select("node").distinct()
        sets = heads.join(known, "node", "left_semi").select("node", _shingles(width)("text").alias("shingles"))
        sets = lasting.write(sets, "sets")
        links = done = heads.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
        for number in range(STARS + 1):
            with StageTables() as tables:
                open_ = tables.write(_open(_classed(keyed, links, tables)), "open") if number else keyed
                able = tables.write(_open(_able(open_, sets, similarity, tables)), "able")
                if able.isEmpty():
                    break
                if number < STARS:
                    pairs, keyed = _star(able, similarity, radius, tables)
                    # A center has met its whole bucket and takes no part in it any more.
                    keyed = lasting.write(keyed, "keyed")
                else:
                    pairs = _by_buckets(able, heads.select("node", "bands"), similarity, radius, tables)
                pairs = lasting.write(pairs.join(done, ["a", "b"], "left_anti"), "pairs")
                links = lasting.write(links.union(_similar(pairs, sets, similarity)), "links")
                done = done.union(pairs)
        return written_table(links, "links")


def _star(able: DataFrame, similarity: float, radius: int, tables: StageTables) -> tuple[DataFrame, DataFrame]:
    """Pairs of each bucket's center and its other rows that it may be like, and the rows without the centers."""
    # The set with most shared shingles is the likest to the others; which one it is changes the pairs, not the result.
    best = able.groupBy("key").agg(F.max(F.struct("shared", "node", "n", "class", "print")).alias("best"), F.ceil(F.count("*") / TILE).alias("tiles"))
    best = best.select("key", "tiles", *[F.col(f"best.{c}").alias(f"{c}_b") for c in ("node", "n", "class", "shared", "print")])
    best = tables.write(best, "best")
    met = able.join(best, "key").filter(F.col("class") != F.col("class_b"))
    met = met.filter(_sizes_allow("n", "n_b", similarity) & _may_overlap(similarity))
    met = met.withColumn("tile", F.pmod(F.xxhash64("node"), "tiles"))
    near = _tiles(met, ["key", "tile", "node_b", "print_b"], ["node", "print"]).drop("key", "tile")
    near = near.mapInPandas(_by_centers(radius), "a long, b long")
    rest = able.join(best.select("key", F.col("node_b").alias("node")), ["key", "node"], "left_anti")
    return near.select(*_pair(F.col("a"), F.col("b"))).distinct(), rest.select("key", "node", "n", "print")


def keep_one_similar(docs: DataFrame, width: int = 5, similarity: float = 0.8, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` with one of each component left: the one with the least id, of repeated ids any one.

    Links join texts whose sets of ``width``-word shingles have at least the given
    Jaccard similarity, found by their SimHash within ``radius`` bits; the default holds for
    0.8 and more. Texts without words, null or empty, are alike; a shorter text
    than ``width`` words is one shingle. Texts of any length are compared whole. Rows are
    told apart by a number that is written with them, so repeated and null ids lose
    nothing; a null id comes after all others. All columns are kept as they are,
    whatever their names. An empty table gives an empty result.
    """
    about = _described(width)("text").alias("about")
    rows = docs.select(F.struct("*").alias("document"), F.monotonically_increasing_id().alias("row"), about)
    rows = written_table(rows, "numbered")
    member = F.struct(F.col("document.doc_id").isNull().alias("unknown"), F.col("document.doc_id").alias("doc_id"), "row")
    with StageTables() as tables:
        own = rows.groupBy("about.digest").agg(F.min(member).alias("least"))
        own = tables.write(own.select(F.col("least.row").alias("node"), "least"), "own")
        heads = rows.join(own, rows["row"] == own["node"]).select("node", "about.n", "about.print", "about.bands", F.col("document.text").alias("text"))
        roots = tables.write(components(similar_links(heads, width, similarity, radius)), "roots").withColumnRenamed("node", "of")
        classes = own.join(roots, F.col("node") == F.col("of"), "left").groupBy(F.coalesce("root", "node")).agg(F.min("least").alias("least"))
        kept = written_table(classes.select(F.col("least.row").alias("row")), "kept")
    return rows.join(kept, "row", "left_semi").select("document.*")
