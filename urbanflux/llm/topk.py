"""Exact top-k by inner product with block-at-a-time pruning.

Vectors stand in the order of their strongest term and are cut into ranges of 64, the
blocks; 64 blocks make a chunk. A block keeps the greatest and least value of every
component, its term maxima, and its vectors as forward index. For a query the summed
maxima bound every score in a block; blocks are scored from the highest bound on and
left as soon as a bound is below the k-th score known. The k-th score in the query's own
chunk is known from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanflux.llm.common import ranked, written_table

K = 20
BLOCK = 64
CHUNK = 64 * BLOCK
#: Chunks whose queries travel together.
GROUP = 8
_KINDS = ("int8", "int16", "int32", "int64")


def quantized(embedding: Column, scale: float = 64.0) -> Column:
    return F.transform(embedding, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


def _usable(embedding: Column) -> Column:
    finite = F.forall(embedding, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return embedding.isNotNull() & (F.size(embedding) > 0) & F.coalesce(finite, F.lit(False))


def _packed(matrix: np.ndarray) -> dict:
    most = int(np.abs(matrix).max(initial=0))
    kind = next(k for k in _KINDS if most <= np.iinfo(k).max)
    return {"kind": kind, "values": np.ascontiguousarray(matrix, kind).tobytes()}


def _unpacked(kind: str, values: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(values, kind).reshape(rows, -1)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T as whole numbers, in floats only where these are exact."""
    most = float(np.abs(a.astype(np.float64)).max(initial=0)) * float(np.abs(b.astype(np.float64)).max(initial=0)) * a.shape[1]
    kind = np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def _chunks(query_of, k: int) -> object:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """One row per chunk: its vectors, and its queries with the k-th score among the chunk's other vectors."""
        for batch in batches:
            for length, chunk, members in zip(batch["length"], batch["chunk"], batch["members"]):
                members = sorted(members, key=lambda m: m["place"])
                ids = np.array([m["vec_id"] for m in members], np.int64)
                matrix = np.array([m["vector"] for m in members], np.int64)
                asked = np.flatnonzero(query_of(ids))
                known = np.full(len(asked), np.iinfo(np.int64).min)
                if len(asked) and len(ids) > k:
                    scores = _products(matrix[asked], matrix)
                    scores[np.arange(len(asked)), asked] = np.iinfo(np.int64).min
                    known = np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k]
                row, queries = _packed(matrix), _packed(matrix[asked])
                yield pd.DataFrame([{
                    "length": length, "chunk": chunk, "ids": ids.tobytes(), "kind": row["kind"], "values": row["values"],
                    "query_places": (chunk * CHUNK + asked).astype(np.int64).tobytes(), "query_ids": ids[asked].tobytes(), "query_kind": queries["kind"], "query_values": queries["values"],
                    "known": known.astype(np.int64).tobytes(),
                }])

    return run


_CHUNK_SCHEMA = (
    "length int, chunk long, ids binary, kind string, values binary, "
    "query_places binary, query_ids binary, query_kind string, query_values binary, known binary"
)


def _search_chunk(queries, own, known, matrix, ids, k):
    """Scores and ids of the chunk's vectors that may be among a query's k best; ``own`` is the query's place in the chunk, if any."""
    starts = np.arange(0, len(ids), BLOCK)
    greatest, least = np.maximum.reduceat(matrix, starts), np.minimum.reduceat(matrix, starts)
    q = queries.astype(np.float64)
    bounds = np.maximum(q, 0) @ greatest.T.astype(np.float64) + np.minimum(q, 0) @ least.T.astype(np.float64)
    if np.abs(bounds).max(initial=0) >= 2**53:
        bounds[:] = np.inf  # not exact any more: leave nothing out
    order = np.argsort(-bounds, axis=1, kind="stable")
    kth = known.copy()
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    alive = np.arange(len(queries))
    for step in range(len(starts)):
        block = order[alive, step]
        alive = alive[bounds[alive, block] >= kth[alive]]
        if not len(alive):
            break
        block = order[alive, step]
        for b in np.unique(block):
            mine = alive[block == b]
            lo, hi = starts[b], min(starts[b] + BLOCK, len(ids))
            scores = _products(queries[mine], matrix[lo:hi])
            good = (scores >= kth[mine, None]) & (np.arange(lo, hi)[None, :] != own[mine, None])
            for at in np.flatnonzero(good.any(1)):
                place, pick = int(mine[at]), good[at]
                s, i = scores[at][pick], ids[lo:hi][pick]
                if place in held:
                    s, i = np.concatenate([held[place][0], s]), np.concatenate([held[place][1], i])
                held[place] = _best(s, i, k)
                if len(held[place][0]) == k:
                    kth[place] = max(kth[place], held[place][0][-1])
    return held


def _search(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                ids = np.frombuffer(row.ids, np.int64)
                matrix = _unpacked(row.kind, row.values, len(ids))
                for part in row.queries:
                    query_ids = np.frombuffer(part["query_ids"], np.int64)
                    if not len(query_ids):
                        continue
                    queries = _unpacked(part["query_kind"], part["query_values"], len(query_ids)).astype(np.int64)
                    known = np.frombuffer(part["known"], np.int64)
                    places = np.frombuffer(part["query_places"], np.int64)
                    held = _search_chunk(queries, places - row.chunk * CHUNK, known, matrix, ids, k)
                    sizes = [len(s) for s, _ in held.values()]
                    yield pd.DataFrame({
                        "length": np.full(sum(sizes), row.length, np.int32),
                        "query_place": np.repeat(places[list(held)], sizes) if held else np.empty(0, np.int64),
                        "query_id": np.repeat(query_ids[list(held)], sizes) if held else np.empty(0, np.int64),
                        "vec_id": np.concatenate([i for _, i in held.values()]) if held else np.empty(0, np.int64),
                        "score": np.concatenate([s for s, _ in held.values()]) if held else np.empty(0, np.int64),
                    })

    return run


def top_k(vectors: DataFrame, every: int = 20, k: int = K) -> DataFrame:
    """query_id, rank, vec_id and score: the k best other vectors of each vec_id divisible by ``every``.

    Ties go to the smaller vec_id. Vectors that are null, empty or hold null or
    non-finite components take no part, nor do rows without a vec_id. Rows are told
    apart by their written place, so of several rows with one vec_id each is a candidate,
    and each is a query of its own that leaves out only itself. A product needs equal
    lengths: a query meets the vectors of its own length. Scores must fit 64 bits. With k
    or fewer others a query gets all. An empty table gives an empty result. Other columns
    are not read.

    Queries are a share of the rows; they meet all rows in blocks, a group of queries
    with one chunk at a time, so a task holds one chunk and one group.
    """
    rows = vectors.filter(F.col("vec_id").isNotNull() & _usable(F.col("embedding")))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), quantized(F.col("embedding")).alias("vector"))
    rows = rows.withColumn("length", F.size("vector"))
    strength = F.transform("vector", lambda x: F.abs(x))
    term = F.array_position(strength, F.array_max(strength))
    rows = rows.withColumn("_term", F.when(F.element_at("vector", term.cast("int")) < 0, -term).otherwise(term))
    placed = ranked(rows, ["length"], ["_term", "vec_id", "vector"], "_place").withColumn("place", F.col("_place") - 1)
    grouped = placed.groupBy("length", F.floor(F.col("place") / CHUNK).alias("chunk"))
    grouped = grouped.agg(F.collect_list(F.struct("place", "vec_id", "vector")).alias("members"))
    chunks = written_table(grouped.mapInPandas(_chunks(lambda ids: ids % every == 0, k), _CHUNK_SCHEMA), "chunks")
    part = F.struct("query_places", "query_ids", "query_kind", "query_values", "known")
    groups = chunks.groupBy("length", F.floor(F.col("chunk") / GROUP).alias("group")).agg(F.collect_list(part).alias("queries"))
    last = chunks.groupBy("length").agg(F.max("chunk").alias("last"))
    groups = groups.join(last, "length")
    groups = groups.select("length", "queries", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))).alias("chunk"))
    pairs = groups.join(chunks.select("length", "chunk", "ids", "kind", "values"), ["length", "chunk"])
    found = pairs.mapInPandas(_search(k), "length int, query_place long, query_id long, vec_id long, score long")
    order = Window.partitionBy("length", "query_place").orderBy(F.col("score").desc(), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


TOP_K_SQL = """
with usable as (
  select row_number() over () as place, vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.place, q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
  from usable q join usable c on q.place <> c.place and len(q.v) = len(c.v) where q.vec_id % 20 = 0
), placed as (
  select query_id, row_number() over (partition by place order by score desc, vec_id)::int as rank, vec_id, score from scored
)
select query_id, rank, vec_id, score from placed where rank <= 20
"""
