"""Hard negatives for anchors, found behind bounds from segment summaries.

A vector is cut into equal segments. Of each segment its mean m and deviation d are
stored, d being the length of the segment minus its mean. For two segments of L
components a . b = L m_a m_b + (a - m_a) . (b - m_b), and the last product lies within
d_a d_b of zero. The sums over segments bound the score from both sides; a row whose
bounds miss everything an anchor still wants is left, the others meet narrower segments
and in the end the exact product of whole numbers. What an anchor wants are windows of
scores; the k best scores known in a window raise its lower end.

Rows are packed into chunks of one label, anchors into groups. Every group meets every
chunk that its labels allow, one such pair at a time: first, for the lower ends, one
chunk, then all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanflux.llm.common import ranked, written_table

POSITIVES, NEGATIVES = 5, 10
#: A negative's score as hundredths of the positive's, least and most.
LEAST, MOST = 30, 90
SCALE = 256.0
#: Rows of a chunk and anchors of a group.
CHUNK, GROUP = 4096, 4096
#: Anchors whose scores with a chunk are held at once.
SLICE = 512
#: Segments of a vector at each level of the bounds.
LEVELS = (4, 16)
#: Share of pairs left below which the exact products are made pair by pair.
SPARSE = 0.05
_KINDS = ("int8", "int16", "int32", "int64")
_LOW, _HIGH = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def quantized(embedding: Column, scale: float = SCALE) -> Column:
    return F.transform(embedding, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


def usable(embedding: Column) -> Column:
    finite = F.forall(embedding, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return embedding.isNotNull() & F.coalesce(finite, F.lit(False))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T in whole numbers; in floats only where these are exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64) if most < 2**53 else a @ b.T


def summaries(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Rows of [sqrt(L) * means, deviations] of the segments, whose last ones may be shorter."""
    edges = np.unique(np.linspace(0, vectors.shape[1], segments + 1).astype(int)[:-1])
    if not vectors.shape[1]:
        return np.zeros((len(vectors), 2))
    x = vectors.astype(np.float64)
    lengths = np.diff(np.append(edges, vectors.shape[1]))
    means = np.add.reduceat(x, edges, axis=1) / lengths
    rest = x - np.repeat(means, lengths, axis=1)
    return np.concatenate([means * np.sqrt(lengths), np.sqrt(np.add.reduceat(rest * rest, edges, axis=1))], axis=1)


def _matrix(kind: str, values: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(values, kind).reshape(rows, -1).astype(np.int64)


def _width(vectors: np.ndarray, width: int) -> np.ndarray:
    """As wide as the other side: components that a vector lacks add nothing to a product."""
    return np.pad(vectors, ((0, 0), (0, max(0, width - vectors.shape[1]))))


class Anchors:
    """A group's vectors with, per anchor, windows of wanted scores and the floors known for them."""

    def __init__(self, row):
        self.rows = np.frombuffer(row.g_rows, np.int64)
        self.labels = np.frombuffer(row.g_labels, np.int64)
        self.vectors = _matrix(row.g_kind, row.g_values, len(self.rows))
        shape = len(self.rows), -1
        self.low, self.high = (np.frombuffer(v, np.int64).reshape(shape) for v in (row.g_low, row.g_high))


def search(anchors: Anchors, row, same_label: bool, k: int) -> tuple[pd.DataFrame, int, int]:
    """Per anchor and window the k best rows of the chunk, and how many pairs there were and were scored."""
    rows, ids = np.frombuffer(row.c_rows, np.int64), np.frombuffer(row.c_ids, np.int64)
    chunk = _matrix(row.c_kind, row.c_values, len(rows))
    mine = np.flatnonzero((anchors.labels == row.c_label) == same_label)
    width = max(chunk.shape[1], anchors.vectors.shape[1])
    vectors, chunk = _width(anchors.vectors, width), _width(chunk, width)
    of_chunk = [summaries(chunk, s) for s in LEVELS]
    found, pairs, scored = [], 0, 0
    for lo in range(0, len(mine), SLICE):
        part = mine[lo : lo + SLICE]
        low, high = anchors.low[part], anchors.high[part]
        open_ = low <= high
        least = np.where(open_, low, _HIGH).min(1)[:, None].astype(np.float64)
        most = np.where(open_, high, _LOW).max(1)[:, None].astype(np.float64)
        alive = np.broadcast_to(open_.any(1)[:, None], (len(part), len(rows))) & (anchors.rows[part][:, None] != rows[None, :])
        pairs += int(alive.sum())
        for level, theirs in zip(LEVELS, of_chunk):
            own = summaries(vectors[part], level)
            s = own.shape[1] // 2
            middle, reach = own[:, :s] @ theirs[:, :s].T, own[:, s:] @ theirs[:, s:].T
            reach += 1e-9 * (np.abs(middle) + reach + np.linalg.norm(own, axis=1)[:, None] * np.linalg.norm(theirs, axis=1)) + 1
            alive &= (middle + reach >= least) & (middle - reach <= most)
        left = int(alive.sum())
        scored += left
        if not left:
            continue
        if left < SPARSE * alive.size:
            at, to = np.nonzero(alive)
            score = np.array([], np.int64)
            for cut in range(0, left, CHUNK * 16):
                a, b = vectors[part[at[cut : cut + CHUNK * 16]]], chunk[to[cut : cut + CHUNK * 16]]
                score = np.concatenate([score, np.einsum("ij,ij->i", a, b)])
        else:
            full = products(vectors[part], chunk)
            at, to = np.nonzero(alive & (full >= least) & (full <= most))
            score = full[at, to]
        for w in range(low.shape[1]):
            hit = (score >= low[at, w]) & (score <= high[at, w])
            a, b, s = at[hit], to[hit], score[hit]
            order = np.lexsort((rows[b], ids[b], -s, a))
            a, b, s = a[order], b[order], s[order]
            place = np.arange(len(a)) - np.searchsorted(a, a)
            keep = place < k
            found.append(pd.DataFrame({"anchor": anchors.rows[part[a[keep]]], "window": w, "id": ids[b[keep]], "row": rows[b[keep]], "score": s[keep]}))
    empty = pd.DataFrame({c: np.empty(0, np.int64) for c in ("anchor", "window", "id", "row", "score")})
    return pd.concat([empty, *found]), pairs, scored


_FOUND = "anchor long, window int, id long, row long, score long, pairs long, scored long"


def _searched(pairs: DataFrame, same_label: bool, k: int) -> DataFrame:
    """The k best of each anchor, window and chunk; a row without anchor counts pairs and scored pairs."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                found, n, scored = search(Anchors(row), row, same_label, k)
                count = pd.DataFrame({"anchor": [None], "pairs": [n], "scored": [scored]})
                yield pd.concat([found.astype("Int64"), count.astype("Int64")])[["anchor", "window", "id", "row", "score", "pairs", "scored"]]

    return pairs.mapInPandas(run, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "window").orderBy(F.col("score").desc(), "id", "row")
    ranks = found.filter("anchor is not null").drop("pairs", "scored").withColumn("rank", F.row_number().over(order))
    return ranks.filter(F.col("rank") <= k)


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each row holds the members of one chunk or group: theirs as arrays, whole numbers in the least width."""
    for batch in batches:
        for key, label, members in zip(batch["key"], batch["label"], batch["members"]):
            members = sorted(members, key=lambda m: m["row"])
            width = max(len(m["x"]) for m in members)
            values = np.zeros((len(members), width), np.int64)
            for at, m in enumerate(members):
                values[at, : len(m["x"])] = m["x"]
            column = lambda c: np.array([m[c] for m in members], np.int64).tobytes()
            most = max(int(values.max(initial=0)), -int(values.min(initial=0)))
            kind = next(k for k in _KINDS if most <= np.iinfo(k).max or k == "int64")
            yield pd.DataFrame([{
                "key": key, "label": label, "rows": column("row"), "ids": column("vec_id"), "labels": column("label"),
                "kind": kind, "values": values.astype(kind).tobytes(),
            }])


_PACKED = "key long, label long, rows binary, ids binary, labels binary, kind string, values binary"


def _chunks(rows: DataFrame) -> DataFrame:
    """Chunks of at most CHUNK rows of one label: c_key (dense, from 0), c_label, c_rows, c_ids, c_values."""
    placed = ranked(rows, ["label"], ["row"], "place").withColumn("block", F.floor((F.col("place") - 1) / CHUNK))
    members = F.collect_list(F.struct("row", "vec_id", "label", "x")).alias("members")
    packed = placed.groupBy("label", "block").agg(members).withColumn("key", F.xxhash64("label", "block"))
    packed = written_table(packed.select("key", "label", "members").mapInPandas(_packed, _PACKED), "chunks")
    numbers = ranked(packed.select("key"), [], ["key"], "c_key").select("key", (F.col("c_key") - 1).alias("c_key"))
    packed = packed.join(numbers, "key").select("c_key", F.col("label").alias("c_label"), *[F.col(c).alias(f"c_{c}") for c in ("rows", "ids", "kind", "values")])
    return written_table(packed, "numbered_chunks")


def _groups(rows: DataFrame, every: int) -> DataFrame:
    """Groups of at most GROUP anchors: g_key (dense, from 0) and g_rows, g_ids, g_labels, g_values."""
    asked = rows.filter(F.col("vec_id") % every == 0)
    placed = ranked(asked, [], ["label", "row"], "place").withColumn("key", F.floor((F.col("place") - 1) / GROUP))
    members = F.collect_list(F.struct("row", "vec_id", "label", "x")).alias("members")
    packed = placed.groupBy("key").agg(members).withColumn("label", F.lit(0))
    packed = packed.select("key", "label", "members").mapInPandas(_packed, _PACKED)
    packed = packed.drop("label").withColumnRenamed("key", "g_key")
    return written_table(packed.select("g_key", *[F.col(c).alias(f"g_{c}") for c in ("rows", "ids", "labels", "kind", "values")]), "groups")


def _with_windows(groups: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """``groups`` with g_low and g_high: n windows per anchor from ``wanted`` (anchor, window, low, high), empty where missing."""
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, rows, windows in zip(batch["g_key"], batch["g_rows"], batch["windows"]):
                rows = np.frombuffer(rows, np.int64)  # ascending, as _packed has left them
                low, high = np.full((len(rows), n), _HIGH), np.full((len(rows), n), _LOW)
                for w in windows if windows is not None else ():
                    at = np.searchsorted(rows, w["anchor"])
                    low[at, w["window"]], high[at, w["window"]] = w["low"], w["high"]
                yield pd.DataFrame([{"g_key": key, "g_low": low.tobytes(), "g_high": high.tobytes()}])

    one = wanted.groupBy("g_key").agg(F.collect_list(F.struct("anchor", "window", "low", "high")).alias("windows"))
    rows = groups.select("g_key", "g_rows").join(one, "g_key", "left").select("g_key", "g_rows", "windows")
    limits = rows.mapInPandas(pack, "g_key long, g_low binary, g_high binary")
    return groups.join(limits, "g_key")


def _paired(groups: DataFrame, pairs: DataFrame, chunks: DataFrame) -> DataFrame:
    """Groups and chunks of each pair (g_key, c_key)."""
    met = pairs.join(groups, "g_key").join(chunks, "c_key")
    return met.select("g_rows", "g_labels", "g_kind", "g_values", "g_low", "g_high", "c_label", "c_rows", "c_ids", "c_kind", "c_values")


def _two_rounds(groups: DataFrame, chunks: DataFrame, pairs: DataFrame, turn: list[str], windows: DataFrame, n: int, same_label: bool, k: int, name: str) -> DataFrame:
    """What all ``pairs`` find: one chunk for each ``turn`` first, the others above the floors known from it."""
    order = Window.partitionBy(*turn).orderBy(F.xxhash64("g_key", "c_key"), "c_key")
    pairs = written_table(pairs.withColumn("turn", F.row_number().over(order)), f"{name}_pairs")
    first = pairs.filter("turn = 1").select("g_key", "c_key")
    seen = written_table(_searched(_paired(_with_windows(groups, windows, n), first, chunks), same_label, k), f"{name}_first")
    floors = _best(seen, k).filter(F.col("rank") == k).select("anchor", "window", F.col("score").alias("floor"))
    raised = windows.join(floors, ["anchor", "window"], "left")
    raised = raised.withColumn("low", F.greatest("low", F.coalesce("floor", "low"))).drop("floor")
    rest = pairs.filter("turn > 1").select("g_key", "c_key")
    rest = written_table(_searched(_paired(_with_windows(groups, raised, n), rest, chunks), same_label, k), f"{name}_rest")
    return seen.unionByName(rest)


def labelled_vectors(vectors: DataFrame, turned: int | None = 7, labels: int = 10) -> DataFrame:
    """Written table of row (a number), vec_id, label and x (whole components) of the rows that take part.

    A null vec_id is written as the least long, which 100 doesn't divide and which comes first.
    """
    kept = vectors.filter(F.col("label").isNotNull() & usable(F.col("embedding")))
    label = F.col("label").cast("long")
    if turned:
        label = F.when(F.col("vec_id") % turned == 0, (label + 1) % labels).otherwise(label)
    return written_table(
        kept.select(F.monotonically_increasing_id().alias("row"), F.coalesce(F.col("vec_id").cast("long"), F.lit(_LOW)).alias("vec_id"), label.alias("label"), quantized(F.col("embedding")).alias("x")),
        "vectors",
    )


def mine(rows: DataFrame, every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """Negatives of every anchor and positive, and the pairs and scored pairs of both searches.

    ``rows`` has row, vec_id, label and x; anchors are the rows whose vec_id is divisible
    by ``every``. Returned: anchor, positive and negative as row numbers and as ids,
    rank and both scores, higher scores first, ties by smaller id, then row. The
    ``positives`` best other rows of its label are an anchor's positives. A negative has
    another label and a score from ``least`` to ``most`` hundredths of the positive's.
    """
    chunks, groups = _chunks(rows), _groups(rows, every)
    n_chunks = chunks.count()
    members = written_table(rows.filter(F.col("vec_id") % every == 0).select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), "label"), "anchors")
    keys = ranked(members.select("anchor", "label"), [], ["label", "anchor"], "place")
    keys = written_table(keys.select("anchor", "label", F.floor((F.col("place") - 1) / GROUP).alias("g_key")), "group_keys")
    # Positives: groups meet the chunks of their own labels.
    everything = keys.select("g_key", "anchor", F.lit(0).alias("window"), F.lit(_LOW).alias("low"), F.lit(_HIGH).alias("high"))
    own = keys.select("g_key", "label").distinct().join(chunks.select("c_key", F.col("c_label").alias("label")), "label")
    alike = _two_rounds(groups, chunks, own, ["g_key", "label"], everything, 1, True, positives, "positives")
    best = written_table(_best(alike, positives).drop("window"), "positives")
    # Windows of the negatives' scores, in whole numbers.
    score = F.col("score").cast("decimal(20,0)")
    low, high = F.ceil(score * least / 100).cast("long"), F.floor(score * most / 100).cast("long")
    windows = best.select("anchor", (F.col("rank") - 1).alias("window"), low.alias("low"), high.alias("high"))
    windows = written_table(windows.join(keys.select("anchor", "g_key"), "anchor").select("g_key", "anchor", "window", "low", "high"), "windows")
    # Negatives: groups meet all chunks.
    numbers = F.sequence(F.lit(0).cast("long"), F.lit(max(n_chunks - 1, 0)).cast("long"))
    all_ = groups.select("g_key", F.explode(numbers).alias("c_key"))
    other = _two_rounds(groups, chunks, all_, ["g_key"], windows, positives, False, negatives, "negatives")
    hard = _best(other, negatives)
    hard = hard.select("anchor", "window", "rank", F.col("row").alias("negative"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = best.select(
        "anchor", (F.col("rank") - 1).alias("window"), F.col("row").alias("positive"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    result = hard.join(named, ["anchor", "window"]).join(members.drop("label"), "anchor").drop("window")
    counts = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("pairs", "scored")]
    totals = [t.agg(F.lit(name).alias("search"), *counts) for name, t in (("positives", alike), ("negatives", other))]
    return result, totals[0].union(totals[1])


def hard_negatives(vectors: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score for the rows of ``vectors``.

    ``vectors`` has vec_id, embedding and label; other columns are not read. Rows with a
    null label, a null vector or a null or non-finite component take no part; a null
    vec_id is no anchor and comes first among equal scores. Repeated vec_ids are rows of
    their own. A shorter vector counts as filled up with zeros, an empty one as all
    zeros. Scores must fit 64 bits. An empty table, or one without anchors, gives an
    empty result. Where vec_id is divisible by 7 the label is turned by one of ten.
    """
    result, _ = mine(labelled_vectors(vectors))
    known = {c: F.when(F.col(c) != _LOW, F.col(c)) for c in ("positive_id", "negative_id")}
    return result.withColumns(known).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


HARD_SQL = """
with usable as (
  select row_number() over () as r, vec_id, (case when vec_id % 7 = 0 then (label + 1) % 10 else label end)::bigint as label,
    list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.r as anchor, a.vec_id as anchor_id, b.r, b.vec_id, a.label = b.label as same,
    coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])), 0)::bigint as score
  from usable a join usable b on a.r <> b.r where a.vec_id % 100 = 0
), positives as (
  select anchor, anchor_id, r, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor order by score desc, vec_id nulls first, r) <= 5
)
select p.anchor_id, positive_id, row_number() over (partition by anchor, p.r order by score desc, vec_id nulls first, n.r)::int as rank,
  vec_id as negative_id, positive_score, score as negative_score
from positives p join scored n using (anchor)
where not n.same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify row_number() over (partition by anchor, p.r order by score desc, vec_id nulls first, n.r) <= 10
"""
