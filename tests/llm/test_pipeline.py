"""The whole pipeline against brute force, stage by stage in plain Python."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F
from test_mixing_sharding import targets_by_hand
from test_near_copies import plain_set

import corpus_pipeline
from urbanflux.llm import quality, toxicity
from urbanflux.llm.common import table
from urbanflux.llm.pieces import Vocabulary, decode_pieces_of, encode_batch
from urbanflux.llm.queries import PIECES

SF = "/root/testdata/sf0.01"


def by_pairs(machine, features):
    """Probability of label 1, each pair of features weighed on its own."""
    pairs = sum(machine.factors[a] @ machine.factors[b] for i, a in enumerate(features) for b in features[i + 1 :])
    return 1 / (1 + math.exp(-(machine.bias + machine.weights[features].sum() + pairs)))


def heads_by_hand(rows):
    """Least doc_id of each component of 5-word Jaccard similarity 0.8; pairs without a common shingle are not compared."""
    sets, group, having = [plain_set(r.text) for r in rows], list(range(len(rows))), defaultdict(list)

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in {j for shingle in a or [None] for j in having[shingle]}:
            if a == sets[j] or len(a & sets[j]) / len(a | sets[j]) >= 0.8:
                group[find(i)] = find(j)
        for shingle in a or [None]:
            having[shingle].append(i)
    least = {}
    for i, r in enumerate(rows):
        least[find(i)] = min(least.get(find(i), r.doc_id), r.doc_id)
    return set(least.values())


def first_bits(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def copies_by_hand(rows):
    """Copies of each document by walking the expected copies of its source."""
    sources = defaultdict(list)
    for r in rows:
        sources[r.source].append((len((r.text or "").split()), first_bits(str(r.doc_id)), r.doc_id))
    sizes = {s: sum(x[0] for x in held) for s, held in sources.items()}
    targets, copies = targets_by_hand(sizes), {}
    for s, held in sources.items():
        rate, shift = targets[s] / sizes[s] if sizes[s] else 0.0, first_bits(f"offset/{s or ''}") % 65536 / 65536
        for place, (_, _, doc_id) in enumerate(sorted(held), 1):
            copies[doc_id] = math.floor(place * rate + shift) - math.floor((place - 1) * rate + shift)
    return copies


def test_pipeline(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    rows = docs.collect()
    assert len({r.doc_id for r in rows}) == len(rows)
    machine = toxicity.fit_toxicity(docs, labels)
    clean = [r for r in rows if by_pairs(machine, toxicity._features(machine, r.text)) < toxicity.THRESHOLD]
    left = spark.createDataFrame(clean, docs.schema)
    machine = quality.fit_quality(left, labels)
    good = [r for r in clean if by_pairs(machine, quality._features(machine, r.text)) >= quality.THRESHOLD]
    heads = heads_by_hand(good)
    single = [r for r in good if r.doc_id in heads]
    assert len(rows) > len(clean) > len(good) > len(single) > 0
    copies, vocabulary, want = copies_by_hand(single), Vocabulary(PIECES), Counter()
    for r in single:
        packed = encode_batch([r.text or ""], [str(r.doc_id)], vocabulary, 7)[0]
        assert decode_pieces_of(packed, vocabulary) == (r.text or "")
        want[r.doc_id, len(np.frombuffer(packed, vocabulary.kind)), zlib.crc32(packed), True] += copies[r.doc_id]
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "n_pieces", "pieces_crc32", "lossless"]
    assert Counter(tuple(r) for r in got.collect()) == +want


def test_stages_keep_the_columns(spark):
    """Nulls, repeated rows and further columns pass every stage; nothing comes of nothing."""
    rows = [(None, None, None, None, None, 1), (3, "a text", "en", "s", 6, 2), (3, "a text", "en", "s", 6, 2), (4, "", "en", None, 0, 3)]
    rows += [(10 + i, f"some words of text {i} " * 30, "en", "s", 9, 4) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score int")
    docs = docs.withColumns({c: F.lit(c) for c in ("document", "row", "size", "predicted", "fingerprint", "copies", "pieces")})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for given in (docs, docs.limit(0)):
            out = stage(spark, given, SF)
            assert out.columns == docs.columns, name
            assert {tuple(r) for r in out.collect()} <= {tuple(r) for r in given.collect()}
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, docs, SF).count() == len(rows) and last(spark, docs.limit(0), SF).count() == 0
