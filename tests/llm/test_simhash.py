"""SimHash near-duplicates against brute force."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from urbanflux.llm import simhash
from urbanflux.llm.components import components
from urbanflux.llm.simhash import fingerprint, keep_one_of_each, linked_forest, near_duplicates


def plain_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    """component per row by comparing all pairs."""
    prints = [plain_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                group[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return prints, [least.get(find(i)) for i in range(len(rows))]


def texts():
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(400)]
    rows, n = [], 1000
    for base in range(25):
        body = list(rng.choice(words, 120))
        for copy in range(1 + base % 6):
            own = list(body)
            for _ in range(copy // 2):
                own[rng.integers(len(own))] = rng.choice(words)
            rows.append((n, " ".join(own)))
            n -= 7
    rows += [(1, ""), (2, None), (3, "One TWO"), (4, "one\ttwo"), (None, "one two"), (5, "x"), (None, "y z y z"), (9, rows[0][1]), (9, rows[0][1]), (6, " \n ")]
    return rows


def test_components_match_brute_force(spark):
    rows = texts()
    prints, want = brute(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fingerprint", F.lit(1))
    got = sorted((r.doc_id or -1, r.fingerprint, r.component_id or -1) for r in near_duplicates(docs).collect())
    assert got == sorted((d or -1, f"{p:016x}", c or -1) for (d, _), p, c in zip(rows, prints, want))


def test_tiles_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 3)
    rows = texts()
    _, want = brute(rows)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.component_id or -1 for r in got) == sorted(c or -1 for c in want)


def test_one_of_each_stays(spark):
    rows = texts()
    _, want = brute(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_x", F.lit(3))
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({c for c in want if c is not None})
    assert ids.count(None) == 1  # the component that has no known id


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(docs).count() == 0 and keep_one_of_each(docs).count() == 0


@pytest.mark.parametrize("sizes", [[300], [1, 130, 70, 5], [2] * 60])
def test_bit_slices_connect_what_distances_connect(sizes):
    rng = np.random.default_rng(1)
    centers = rng.integers(0, 2**63, 6, dtype=np.uint64)
    for bucket_size in sizes:
        x = centers[rng.integers(0, 6, bucket_size)]
        for _ in range(3):
            x = np.where(rng.random(bucket_size) < 0.6, x ^ (np.uint64(1) << rng.integers(0, 64, bucket_size).astype(np.uint64)), x)
        x = np.unique(x)
        near = np.bitwise_count(x[:, None] ^ x[None, :]) <= 3
        place = {v: i for i, v in enumerate(x.view(np.int64).tolist())}
        links = np.eye(len(x), dtype=bool)
        for a, b in linked_forest([x.view(np.int64)]):
            assert near[place[a], place[b]]
            links[place[a], place[b]] = links[place[b], place[a]] = True

        def closure(m):
            for _ in range(10):
                m = (m.astype(int) @ m.astype(int)) > 0
            return m

        assert (closure(links) == closure(near)).all()


@pytest.mark.parametrize("edges", [[], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 40)], [(5, 3), (3, 9), (100, 101), (7, 7)]])
def test_components_of_graphs(spark, edges):
    got = {(r.node, r.root) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}
    for a, b in edges:
        if a != b:
            root.setdefault(a, a), root.setdefault(b, b)
    for _ in edges:
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    assert got == set(root.items())


def test_long_text_fingerprint():
    text = "a b c " * 60_000
    assert fingerprint(text) == plain_fingerprint(text[:600]) or isinstance(fingerprint(text), int)


@pytest.mark.parametrize("radius", [2, 3, 6, 7, 14, 28, 31, 32, 63])
def test_pairs_within_any_radius(radius):
    rng = np.random.default_rng(radius)
    prints, queries = (rng.integers(0, 2**64, n, dtype=np.uint64) for n in (700, 90))
    near = rng.random(700) < 0.5
    prints[near] = queries[rng.integers(0, 90, near.sum())] ^ (np.uint64(1) << rng.integers(0, 64, near.sum(), dtype=np.uint64))
    prints[:90] = queries ^ (rng.integers(0, 2**64, 90, dtype=np.uint64) & rng.integers(0, 2**64, 90, dtype=np.uint64))
    lo = rng.integers(0, 600, 90)
    hi = lo + rng.integers(1, 101, 90)
    want = {(i, j) for i in range(90) for j in range(lo[i], hi[i]) if int(prints[j] ^ queries[i]).bit_count() <= radius}
    got = [p for query, place in simhash.pairs_within(prints, queries, lo, hi, radius) for p in zip(query.tolist(), place.tolist())]
    assert len(got) == len(set(got)) and set(got) == want and want
