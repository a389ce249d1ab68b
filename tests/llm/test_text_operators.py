"""Licenses, quality rules, pieces, token files and top-k against brute force, SQL or a round trip."""

import os
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tools.check_queries import compare, connect
from urbanflux.llm import queries, topk
from urbanflux.llm.dac import Codes, document_ids, pack
from urbanflux.llm.divergence import measured, quality_rules
from urbanflux.llm.licenses import TEMPLATES, license_matches
from urbanflux.llm.pieces import Lattice, Vocabulary, checked, decode_pieces_of, encode_batch, encode_documents
from urbanflux.llm.token_files import Encoder, read_token_files, tokens_of, write_token_files
from urbanflux.llm.topk import top_k

ODD = ["", " ", "  a  b  ", "a▁b", "\n\t x", "日本 語 😀 text", "x" * 3000, "a b", " " * 100, "a\n b", "it's   fine\n\n ok 12 345",
       "<|endoftext|> a<|endoftext|>b", "word " * 20_000, "a  \nb  c"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, sf, name):
    assert compare(spark, connect(sf), sf, queries.QUERIES[name], queries.SQL[name]).startswith("ok")


def odd_documents(spark):
    rows = [(i, t, "en" if i % 2 else None, "s", len(t)) for i, t in enumerate(ODD)]
    rows += [(None, None, None, None, None), (3, "same", "xx", None, 4), (3, "same", "xx", None, 4), (None, "no id", "de", "s", 5)]
    return spark.createDataFrame(rows, DOCS).withColumns({"license": F.lit(1), "pieces": F.lit(2), "kept": F.lit("x"), "start": F.lit(0)})


# --- licenses

def test_licenses_in_odd_rows(spark):
    long = "some words " * 500 + dict(TEMPLATES)["MIT-grant"] + " and more " * 500
    near = dict(TEMPLATES)["BSD-grant"].replace("disclaimer", "notice")
    docs = odd_documents(spark).select(*DOCS.replace(" long", "").replace(" string", "").split(", ")).union(
        spark.createDataFrame([(50, long, None, None, None), (51, near, None, None, None), (51, near, None, None, None),
                               (52, "all RIGHTS, reserved", None, None, None), (53, "Permission is hereby granted, free of charge", None, None, None)], DOCS))
    got = {(r.doc_id, r.license): r for r in license_matches(docs).collect()}
    assert set(got) == {(50, "MIT-grant"), (51, "BSD-grant"), (52, "all-rights-reserved")}
    assert (got[50, "MIT-grant"].containment, got[50, "MIT-grant"].start_word) == (1.0, 1000)
    assert 0.8 <= got[51, "BSD-grant"].containment < 1
    assert license_matches(docs.limit(0)).count() == 0


def test_windows_are_not_sent_to_the_driver(spark):
    """However few bytes the written windows have, the templates are the side that is broadcast."""
    docs = spark.createDataFrame([(i, TEMPLATES[i % 9][1]) for i in range(50)], "doc_id long, text string")
    plan = license_matches(docs)._jdf.queryExecution().sparkPlan().toString()
    assert "BuildRight" in plan and "BuildLeft" not in plan, plan


# --- quality rules

def test_rules_on_odd_rows(spark):
    docs = odd_documents(spark)
    out = quality_rules(docs).collect()
    assert len(out) == docs.count()
    for r in out:
        assert r.kept is not None and not (r.kept and r.base_failed)
    assert quality_rules(docs.limit(0)).count() == 0


def test_rule_counts():
    n_words, chars, symbols, dup, repeat, _, _ = measured("a b c\na b c\n\n# é b\na b c", "en")
    assert (n_words, chars, symbols, dup) == (12, 12, 1, 2)
    windows = ["a b c".split(), "b c a".split(), "c a b".split()]
    words = "a b c a b c # é b a b c".split()
    tri = [tuple(words[i : i + 3]) for i in range(10)]
    assert repeat == len({j for i, t in enumerate(tri) if tri.count(t) > 1 for j in range(i, i + 3)}) and windows
    assert measured(None, None)[:5] == (0, 0, 0, 0, 0)


# --- pieces

@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(queries.PIECES)


def test_pieces_round_trip(spark, vocabulary):
    docs = odd_documents(spark)
    rows = checked(encode_documents(docs, queries.PIECES), queries.PIECES).collect()
    assert len(rows) == docs.count() and all(r.lossless for r in rows)
    assert checked(encode_documents(docs.limit(0), queries.PIECES), queries.PIECES).count() == 0


def test_pieces_depend_on_key_only(vocabulary):
    texts = ["the theories of everything " * 5] * 3
    a, b, c = encode_batch(texts, ["1", "2", "1"], vocabulary, 7)
    assert a == c != b
    assert encode_batch(["zz top", texts[0]], ["9", "1"], vocabulary, 7)[1] == a
    assert encode_batch(texts[:1], ["1"], vocabulary, 8)[0] != a
    assert decode_pieces_of(b, vocabulary) == texts[0]


def test_segmentations_follow_their_weights(vocabulary):
    word, n = " there", 40_000
    known = {raw.decode(errors="ignore"): i for i, raw in enumerate(vocabulary.raw) if np.isfinite(vocabulary.weights[i])}
    ways = {}

    def extend(at, ids, weight):
        if at == len(word):
            ways[tuple(ids)] = np.exp(weight)
        for end in range(at + 1, len(word) + 1):
            if word[at:end] in known:
                extend(end, [*ids, known[word[at:end]]], weight + vocabulary.weights[known[word[at:end]]])

    extend(0, [], 0.0)
    seeds = np.random.default_rng(0).integers(0, 2**63, n, dtype=np.uint64)
    ids, counts = Lattice([word], vocabulary).sample(np.zeros(n, np.int64), seeds)
    seen = {}
    for part in np.split(ids, np.cumsum(counts)[:-1]):
        seen[tuple(part.tolist())] = seen.get(tuple(part.tolist()), 0) + 1
    total = sum(ways.values())
    assert set(seen) <= set(ways)
    for way, weight in ways.items():
        p = weight / total
        assert abs(seen.get(way, 0) / n - p) < 5 * np.sqrt(p * (1 - p) / n) + 1e-3


# --- token files

def test_encoder_is_the_library():
    encoder = Encoder(queries.BYTE_BPE)
    texts = [*ODD, "An ordinary line, twice.\nAn ordinary line, twice."]
    for ids, text in zip(encoder.encode(texts), texts):
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_words_are_put_together_from_known_pieces(monkeypatch):
    encoder, rng = Encoder(queries.BYTE_BPE), np.random.default_rng(3)
    stems, marks = ["alpha", "Beta", "éñß", "ÀLL", "x"], ["", ".", ",###", "&&&", "\n", ".\n", "\n\n", "'s", "'", "9", "½", "ƻ", "×", "\t", "\u0301", "<|", "|>", "日本", "_"]
    texts = [" ".join("".join(rng.choice(stems) + rng.choice(marks) for _ in range(rng.integers(1, 4))).strip() or "x" for _ in range(60)) for _ in range(200)]
    for ids, text in zip(encoder.encode(texts), texts):
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    encoder.encode(["x alpha Beta. delta, x&&& ,,, x.\nalpha", "x x;x"])
    given, ids = [], encoder._ids
    monkeypatch.setattr(encoder, "_ids", lambda text: given.append(text) or ids(text))
    text = "x delta.\nalpha&&& Beta;alpha, ,,,alpha alpha;x\nx."
    assert encoder.encode([text])[0].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert given == ["x"]  # the word that begins the text


def test_forgotten_words_and_pieces_are_learnt_again(monkeypatch):
    monkeypatch.setattr("urbanflux.llm.token_files.REMEMBERED", 3)
    encoder = Encoder(queries.BYTE_BPE)
    for i in range(40):
        texts = [f"go {'abcdefgh'[i % 8]}one.{'xyz'[i % 3]}two\nthree; go {'pqrst'[i % 5]}four,{'uvw'[i % 3]}five end."]
        assert encoder.encode(texts)[0].tolist() == encoder.tokenizer.encode(texts[0], add_special_tokens=False).ids


@pytest.mark.parametrize("file_ids", [4_000_000, 40, 1])
def test_token_files(spark, tmp_path, file_ids):
    docs = odd_documents(spark).repartition(3)
    files = write_token_files(docs, queries.BYTE_BPE, str(tmp_path / "tokens"), file_ids)
    got = sorted(read_token_files(files).collect(), key=lambda r: r.start)
    encoder = Encoder(queries.BYTE_BPE)
    rows = docs.collect()
    assert [r.doc_id for r in got] == [None, None, *sorted(r.doc_id for r in rows if r.doc_id is not None)]
    want = {}
    for r in rows:
        ids = np.array([*encoder.tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        want.setdefault(r.doc_id, []).append((len(ids), zlib.crc32(ids.tobytes())))
    at = 0
    for r in got:
        assert r.start == at and (r.n_tokens, r.ids_crc32) in want[r.doc_id]
        at += r.n_tokens
    listed = files.orderBy("file").collect()
    assert [f.file for f in listed] == list(range(len(listed)))
    sizes = iter(r.n_tokens for r in got)
    for f in listed:
        held = [next(sizes) for _ in range(f.documents)]
        assert sum(held) == f.ids and sum(held[:-1]) < file_ids
    assert file_ids > 1 or len(listed) == len(rows)
    crcs = iter(r.ids_crc32 for r in got)
    for f in listed:
        for number in range(f.documents):
            assert zlib.crc32(tokens_of(f.path, number).tobytes()) == next(crcs)
    with pytest.raises(IndexError):
        tokens_of(listed[0].path, listed[0].documents)
    assert all(n.endswith(".dac") for n in os.listdir(tmp_path / "tokens") if not n.startswith("."))
    assert read_token_files(write_token_files(docs.limit(0), queries.BYTE_BPE, str(tmp_path / "none"))).count() == 0


@pytest.mark.parametrize("top", [1, 200, 256, 60_000, 2**24, 2**32])
def test_codes(top):
    ids = np.random.default_rng(top).integers(0, top, 5000, dtype=np.uint64).astype("<u4")
    codes = Codes(pack(ids, np.array([4, -1]), np.array([True, False]), np.array([0, 2000, 5000])))
    assert (codes.span(0, 5000) == ids).all() and codes.known.tolist() == [True, False]
    assert [codes[i] for i in range(0, 5000, 77)] == ids[::77].tolist()
    for lo, hi in ((0, 0), (511, 513), (512, 1024), (4999, 5000), (63, 2000)):
        assert (codes.span(lo, hi) == ids[lo:hi]).all()
    places = np.array([0, 0, 511, 513, 1024, 2000, 5000])
    data = pack(ids, np.arange(6), np.ones(6, bool), places)
    read = []
    for number, (lo, hi) in enumerate(zip(places, places[1:])):
        got = document_ids(lambda size, at: read.append(size) or data[at : at + size], number)
        assert (got == ids[lo:hi]).all()
        if number == 2:
            assert sum(read) < len(data) // 10
        read.clear()
    empty = Codes(pack(np.empty(0, "<u4"), np.empty(0), np.empty(0), np.array([0])))
    assert empty.n_ids == 0 and len(empty.span(0, 0)) == 0


# --- top-k

def best_by_hand(rows, k=20):
    """Every row is a candidate of every other row of its length, whatever its id."""
    usable = [
        (i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = Counter()
    for at, (i, q) in enumerate(usable):
        if i % 20 == 0:
            others = [(j, c) for there, (j, c) in enumerate(usable) if there != at and len(c) == len(q)]
            scored = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in others)
            out.update((i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k]))
    return out


@pytest.mark.parametrize("n, scale, k", [(700, 1.0, 20), (700, 1.0, 45), (700, 1.0, 3), (15, 1.0, 20), (300, 1e6, 20), (120, 1e7, 20)])
def test_top_k(spark, monkeypatch, n, scale, k):
    monkeypatch.setattr(topk, "BLOCK", 8)
    monkeypatch.setattr(topk, "CHUNK", 64)
    rng = np.random.default_rng(n)
    rows = [(i, [float(x) for x in rng.normal(size=3) * scale]) for i in range(n)]
    rows += [(2000 + i, [0.5, 0.5, 0.5]) for i in range(n // 3)]  # a hot vector
    rows += [(3000, None), (3020, []), (3040, [1.0, None, 2.0]), (3060, [float("nan"), 1.0, 1.0]), (3080, [float("inf"), 0.0, 0.0]),
             (None, [1.0, 1.0, 1.0]), (3100, [1.0, 2.0]), (3101, [1.0, 2.0]), (3102, [-1.0, 5.0]), (3200, [7.0]), (20, [0.1, 0.2, 0.3]), (1, [0.5, 0.5, 0.5])]
    rows += [(40, [0.5, 0.5, 0.5])] * 30  # an id that repeats, rows and all
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"label": F.lit(1), "score": F.lit("s"), "place": F.lit(0)})
    got = Counter((r.query_id, r.rank, r.vec_id, r.score) for r in top_k(df, k=k).collect())
    assert got == best_by_hand(rows, k)


def test_top_k_equals_its_sql(spark, tmp_path):
    """Repeated ids and odd lengths mean the same to both."""
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in rng.normal(size=2 + (n % 9 == 0))]) for n, i in enumerate(rng.integers(0, 120, 400))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    df.write.parquet(str(tmp_path / "embeddings"))
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{tmp_path}/embeddings/*.parquet'")
    want = con.execute(f"select query_id, rank, vec_id, score from ({topk.TOP_K_SQL})").fetchall()
    assert Counter(tuple(r) for r in top_k(df).collect()) == Counter(want) and len({r[0] for r in want}) == 6


def test_top_k_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert top_k(df).count() == 0
