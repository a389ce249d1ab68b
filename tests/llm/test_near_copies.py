"""Near copies by exact Jaccard similarity of 5-word shingles against brute force."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from urbanflux.llm import near_copies
from urbanflux.llm.near_copies import keep_one_similar


def plain_set(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def components_by_hand(rows, similarity=0.8):
    """Component number of each row by comparing all pairs."""
    sets, group = [plain_set(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a == b or (a | b and len(a & b) / len(a | b) >= similarity):
                group[find(i)] = find(j)
    return [find(i) for i in range(len(rows))]


def ids_by_hand(rows):
    least = {}
    for (doc_id, _), c in zip(rows, components_by_hand(rows)):
        least[c] = min(least.get(c, np.inf), np.inf if doc_id is None else doc_id)
    return sorted(least.values())


def texts():
    """Groups whose copies change one word after another, so that their similarity falls past 0.8."""
    rng = np.random.default_rng(8)
    words, rows, n = [f"w{i}" for i in range(500)], [], 1000
    for base in range(20):
        body = list(rng.choice(words, 150))
        for copy in range(9):
            own = list(body)
            for _ in range(copy):
                own[rng.integers(len(own))] = rng.choice(words)
            rows.append((n, " ".join(own)))
            n -= 3
            if base % 3 == 0:
                body = own
    rows += [(1, ""), (2, None), (3, "One TWO"), (4, "one\ttwo"), (None, "one two"), (5, "x"), (None, "y z y z"), (9, rows[0][1]), (9, rows[0][1])]
    return rows


def test_one_of_each_group_stays(spark):
    rows = texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit(3))
    for kept in (keep_one_similar(docs), corpus_pipeline.near_duplicates(spark, docs, "")):
        assert kept.columns == docs.columns
        assert sorted(np.inf if r.doc_id is None else r.doc_id for r in kept.collect()) == ids_by_hand(rows)
    assert keep_one_similar(docs.limit(0)).count() == 0


def hot_texts(n, seed=4, most=9, common=0.2):
    """Copies of one text, each with other words in up to ``most`` places, a share of them common ones: many links, and many rows like no other."""
    rng = np.random.default_rng(seed)
    base, rows = [f"b{i}" for i in range(150)], []
    for i in range(n):
        own = list(base)
        for at in rng.choice(len(own), rng.integers(0, most), replace=False):
            own[at] = f"own{i}x{at}" if rng.random() >= common else f"w{rng.integers(3)}"
        rows.append((i, " ".join(own)))
    return rows


@pytest.mark.parametrize("stars", [0, 3])
def test_hot_bucket(spark, monkeypatch, stars):
    monkeypatch.setattr(near_copies, "STARS", stars)
    rows = hot_texts(260) + texts()
    kept = keep_one_similar(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(np.inf if r.doc_id is None else r.doc_id for r in kept.collect()) == ids_by_hand(rows)


def test_pairs_of_a_hot_bucket_grow_with_its_rows(spark, monkeypatch):
    compared = []
    similar = near_copies._similar
    monkeypatch.setattr(near_copies, "_similar", lambda pairs, *a: compared.append(pairs.count()) or similar(pairs, *a))
    made = []
    for n in (400, 1600):
        rows = hot_texts(n, common=0.0)
        compared.clear()
        kept = keep_one_similar(spark.createDataFrame(rows, "doc_id long, text string")).count()
        assert kept > n / 20
        made.append(sum(compared))
    assert made[1] <= 6 * made[0] and made[1] < 16 * 1600, made


def print_by_hand(text):
    """SimHash of the distinct 5-word shingles, bit by bit."""
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in plain_set(text)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("stars", [0, 4])
@pytest.mark.parametrize("radius", [6, near_copies.RADIUS])
def test_only_pairs_within_the_radius_are_compared_whole(spark, monkeypatch, radius, stars):
    rows = [(i, t) for i, t in enumerate(dict.fromkeys(t for _, t in hot_texts(120) + texts() if plain_set(t)))]
    compared, similar = [], near_copies._similar
    monkeypatch.setattr(near_copies, "STARS", stars)
    monkeypatch.setattr(near_copies, "TILE", 16)
    monkeypatch.setattr(near_copies, "_similar", lambda pairs, sets, *a: compared.extend(_texts_of(pairs, sets)) or similar(pairs, sets, *a))
    keep_one_similar(spark.createDataFrame(rows, "doc_id long, text string"), radius=radius).collect()
    prints = {frozenset(xxhash.xxh64_intdigest(s.encode(), 42) for s in plain_set(t)): print_by_hand(t) for _, t in rows}
    apart = [(prints[a] ^ prints[b]).bit_count() for a, b in compared]
    assert len(apart) > 50 and max(apart) <= radius and len(set(map(frozenset, compared))) == len(compared)
    if radius == near_copies.RADIUS:
        assert max(apart) > 6


def _texts_of(pairs, sets):
    """Both sets of each pair, as sets of unsigned hashes."""
    known = {r.node: frozenset(x % 2**64 for x in r.shingles) for r in sets.collect()}
    return [(known[r.a], known[r.b]) for r in pairs.collect()]


def test_similar_sets_lie_within_the_radius():
    rows = texts() + hot_texts(60)
    sets, prints, seen = [plain_set(t) for _, t in rows], [print_by_hand(t) for _, t in rows], 0
    for i, a in enumerate(sets):
        for j in range(i):
            if a != sets[j] and len(a & sets[j]) / len(a | sets[j]) >= 0.8:
                seen += 1
                assert (prints[i] ^ prints[j]).bit_count() <= near_copies.RADIUS
    assert seen > 100
