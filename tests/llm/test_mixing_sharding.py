"""Mixing and sharding: invariants, odd rows, hot groups."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from urbanflux.llm import sharding
from urbanflux.llm.common import ranked
from urbanflux.llm.mixing import mix, mix_plan, source_targets
from urbanflux.llm.sharding import shard_documents


def targets_by_hand(sizes):
    """Share by weight; set what exceeds three times its size to that; share the rest again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    fixed = {}
    while True:
        rest = sum(sizes.values()) - sum(fixed.values())
        free = {s: weight[s] for s in names if s not in fixed}
        share = {s: rest * w / sum(free.values()) for s, w in free.items()}
        over = [s for s, x in share.items() if x > 3 * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: 3 * sizes[s] for s in over}


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = np.random.default_rng(seed)
    sizes = {f"s{i}": int(rng.integers(0, 10 ** rng.integers(1, 5))) for i in range(9)} | {None: 50, "é": 3}
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in source_targets(rows).collect()}
    want = targets_by_hand(sizes)
    assert got.keys() == want.keys()
    for s, t in want.items():
        assert got[s] == pytest.approx(t)


def documents(spark, n=3000):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else f"s{i % 11}"
        text = "copy of one text " * 9 if i % 3 == 1 else " ".join(["w"] * int(rng.integers(1, 200))) + f" {i}"
        rows.append((i, text, None if i % 97 == 0 else source))
    rows += [(None, None, "s1"), (None, "", None), (7, "again", "s1"), (7, "again", "s1"), (10**6, "long " * 30_000, "s2")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_mix(spark):
    docs = documents(spark)
    plan = mix_plan(docs.withColumn("size", F.lit("x"))).collect()
    assert len(plan) == docs.count()
    taken, target, largest = Counter(), {}, Counter()
    for r in plan:
        assert 0 <= r.copies <= 3 and r.size == (0 if r.size == 0 else r.size)
        taken[r.source] += r.copies * r.size
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
    for s, t in target.items():
        assert abs(taken[s] - t) <= 1.5 * largest[s]
    again = sorted((r.doc_id or -1, r.copies) for r in mix_plan(docs.repartition(7)).collect())
    assert again == sorted((r.doc_id or -1, r.copies) for r in plan)
    assert mix(docs).count() == sum(r.copies for r in plan) and mix(docs).columns == docs.columns


def test_mix_of_nothing(spark):
    docs = documents(spark).limit(0)
    assert mix_plan(docs).count() == 0 and mix(docs).count() == 0
    blank = spark.createDataFrame([(1, " ", "a"), (2, None, "b")], "doc_id long, text string, source string")
    assert [(r.target, r.copies) for r in mix_plan(blank).collect()] == [(0.0, 0), (0.0, 0)]


def test_ranks(spark):
    df = spark.range(2000).selectExpr("case when id % 3 = 0 then null else id % 2 end as g", "id % 50 as a", "id as b")
    got = ranked(df, ["g"], ["a", "b"], "r").collect()
    for g in (None, 0, 1):
        part = sorted((r.a, r.b, r.r) for r in got if r.g == g)
        assert [p[2] for p in part] == list(range(1, len(part) + 1))


def test_shards(spark):
    docs = documents(spark)
    out = shard_documents(docs.withColumn("shard", F.lit("mine"))).collect()
    assert len(out) == docs.count()
    sizes, slots = Counter(), {}
    for r in out:
        text = (r.text or "").encode()
        assert (r["size"], r.text_crc32) == (len(text) + 8, zlib.crc32(text))
        sizes[r.shard] += r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(sizes) <= set(range(24))  # a document larger than a shard leaves some empty
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    mean = sum(sizes.values()) / 24
    assert all(v <= mean + 2 * max(r["size"] for r in out) for v in sizes.values())


def test_shards_meet_the_tolerance(spark):
    docs = spark.range(60_000).selectExpr("id as doc_id", "if(id % 3 = 0, 'one text of many', repeat('x', cast(id % 90 as int)) || id) as text")
    sizes = [r.s for r in shard_documents(docs).groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert len(sizes) == 24 and max(sizes) - min(sizes) <= 2 * sharding.TOLERANCE * np.mean(sizes) + 200


def test_small_groups_stay_together(spark):
    docs = spark.range(9000).selectExpr("id as doc_id", "'text ' || cast(id % 3000 as string) || repeat(' word', 20) as text")
    apart = shard_documents(docs).groupBy("text").agg(F.countDistinct("shard").alias("n")).where("n > 1").count()
    assert apart <= 2


def test_shards_of_little(spark):
    one = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert [(r.slot, r["size"]) for r in shard_documents(one).collect()] == [(0, 9)]
    assert shard_documents(one.limit(0)).count() == 0


def test_rows_equal_in_text_and_id_are_parted(spark):
    """Half of all rows equal in text and id: twelve splitters fall among them."""
    same = spark.range(5000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("again").alias("text"))
    other = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.format_string("%04d", "id")).alias("text"))
    rows = shard_documents(same.union(other).repartition(5)).select("doc_id", "text", "size", "shard", "slot").collect()
    sizes, slots = Counter(), {}
    for r in rows:
        sizes[r.shard] += r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(rows) == 10_000 and len(sizes) == 24
    assert max(sizes.values()) - min(sizes.values()) <= 4 * 13  # a few rows at either edge
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_splitters_by_hand(spark):
    """Each splitter is the edge nearest to its share among all sorted (key, row) pairs, within the tolerance."""
    rng = np.random.default_rng(8)
    keys = np.concatenate([rng.integers(0, 1 << 62, 600), np.full(300, 12345 << 40), rng.integers(0, 1 << 20, 300)])
    data = sorted((int(k), int(r), int(z)) for k, r, z in zip(keys, rng.integers(0, 1 << 62, 1200), rng.integers(8, 60, 1200)))
    keyed = spark.createDataFrame(data, "key long, row long, size long")
    total = sum(z for _, _, z in data)
    for number, (key, row) in enumerate(sharding.splitters(keyed, 7, 0.001), 1):
        below = sum(z for k, r, z in data if (k, r) < (key, row))
        assert abs(below - total * number / 7) <= 60  # half of the largest row, or of two in one bin of rows
    assert sharding.splitters(keyed.limit(0), 3) == [(1 << 63, 0)] * 2
