"""Piece BPE against the library; clustering and vector codes against plain definitions."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import LONG, MESSY
from tidewell.llm import anchor_trees, mean_order_clusters, piece_bpe, vector_codes
from tidewell.llm.common import table
from tidewell.llm.queries import PIECES, QUERIES

# ---- pieces -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECES))


@pytest.fixture(scope="module")
def vocabulary():
    return piece_bpe.read_vocabulary(public_tokenizers.path(PIECES))


def digest_of(library, text):
    ids = library.encode(text or "") + [library.eos_id()]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids))


def test_documents_are_encoded_as_by_the_library(spark, small, library):
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_sentencepiece"](spark, small).collect()}
    docs = table(spark, small, "documents").select("doc_id", "text").collect()
    assert got == {r.doc_id: digest_of(library, r.text) for r in docs}


PARTS = ["  ", " ", "   ", "a", "b", "e", "th", "the", "ing", "▁", "é", "日本", "語", "①", "🙂", "\n", "\t", "x", "1", "2", "00", ".", "..", "=", "==", "-",
         "<0x0A>", "<s>", "</s>", "ß", "un", "re", "er", "in", "\x00", "​", "ﬁ", "М", "и", "р", "на", "　", "́"]


def odd_texts():
    rng = random.Random(3)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 16))) for _ in range(3000)]
    runs = [c * n for c in (" ", "x", "=", "-", "\n", "0", "ab", "▁", "①") for n in range(1, 70)]
    return texts + runs + ["a" + " " * n + "b" for n in range(70)] + [LONG, "x" * 300_000, " " * 300_000, "ab " * 150_000, None, ""]


def test_odd_texts(spark, library, vocabulary):
    texts = odd_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumns({c: F.lit(1) for c in ("id", "ids", "decoded")})
    got = {r.doc_id: (r.ids, r.decoded) for r in piece_bpe.decode(piece_bpe.encode(df, vocabulary, end=False), vocabulary).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text or "")
        assert got[i] == (ids, library.decode(ids)), repr(text)[:80]


def test_any_ids_are_decoded(spark, library, vocabulary):
    rng = random.Random(4)
    ids = lambda: rng.choice([0, 1, 2, 3 + rng.randrange(256), 3 + 0xE2, 3 + 0x91, 3 + 0xA0, rng.randrange(259, 32000), 259, 29871])
    rows = [(i, [ids() for _ in range(rng.randrange(8))]) for i in range(3000)] + [(None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, ids array<int>")
    got = {r.doc_id: r.decoded for r in piece_bpe.decode(df, vocabulary).collect()}
    assert got == {i: None if x is None else library.decode(x) for i, x in rows}


def test_words_fall_back_and_forget(library, vocabulary, monkeypatch):
    """Compatibility by re-merging, with few pairs and words remembered."""
    monkeypatch.setattr(piece_bpe, "PAIRS", 3)
    encoder = piece_bpe.Encoder(vocabulary)
    rng = random.Random(8)
    for _ in range(2000):
        word = "▁" + "".join(rng.choice("aeinorst") for _ in range(rng.randrange(1, 30)))
        assert np.frombuffer(encoder.word(word), dtype="<i4").tolist() == library.encode(word.replace("▁", ""))
    assert piece_bpe.merged("▁the", vocabulary.scores) == ["▁the"]
    assert "".join(piece_bpe.cuts("a b" * 200_000)) == "▁" + "a▁b" * 200_000


def test_pieces_of_messy_and_empty_tables(messy, empty, library, vocabulary):
    out = piece_bpe.digests(piece_bpe.decode(piece_bpe.encode(messy, vocabulary), vocabulary))
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(str((i, *digest_of(library, t))) for i, t, *_ in MESSY)
    assert piece_bpe.digests(piece_bpe.decode(piece_bpe.encode(empty, vocabulary), vocabulary)).count() == 0


# ---- whole vectors ----------------------------------------------------------------------


def vectors(n, dim, seed=0, bad=True):
    """Clusters, copies and ties; then rows that take no part."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(8, dim))[rng.integers(0, 8, n)] + rng.normal(size=(n, dim)) * 0.1
    x[: n // 3] = x[0]
    x[n // 3: n // 2] = np.round(x[n // 3: n // 2])
    rows = [(int(i), v.tolist(), int(i) % 5 if i % 7 else None) for i, v in zip(rng.permutation(n), x)]
    nan = float("nan")
    return rows + ([(5000, None, 1), (5001, [], 1), (5002, [nan] + [1.0] * (dim - 1), 1), (5003, [None] + [1.0] * (dim - 1), None),
                    (5004, [float("inf")] * dim, 2), (5005, [1e9] * dim, 2), (5006, [1.0] * (dim + 1), 2), (3, [0.0] * dim, 3), (3, [0.0] * dim, 3)] if bad else [])


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    return df.repartition(3).withColumns({c: F.lit(1) for c in ("id", "vector", "cluster", "distance", "code", "error", "n", "_label", "_cluster", "c", "v")})


@pytest.mark.parametrize("dim,clusters", [(64, 40), (6, 9)])
def test_clusters_by_definition(spark, dim, clusters):
    rows = vectors(500, dim)
    df = frame(spark, rows)
    model = mean_order_clusters.fit(df, clusters=clusters, dim=dim)
    out = mean_order_clusters.digests(mean_order_clusters.assign(df, model, dim=dim), model)
    want = brute.clusters([(i, v) for i, v, _ in rows if v and len(v) == dim and np.isfinite(np.array(v, dtype=float)).all() and max(v) < 1e8], clusters, 5)
    names = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    assert sorted(tuple(r[c] for c in names) for r in out.collect()) == want


def test_few_and_no_rows_to_cluster(spark):
    for rows in ([], [(1, [0.5] * 64, 1)], [(None, [0.5] * 64, 1)], [(1, [0.5] * 64, 1), (None, [0.25] * 64, 1), (2, [0.5] * 64, 1)]):
        df = frame(spark, rows)
        model = mean_order_clusters.fit(df)
        out = mean_order_clusters.digests(mean_order_clusters.assign(df, model), model).collect()
        assert len(out) == (len(rows) if len(model.centroids) else 0)
        assert {r.cluster for r in out} <= {0, 1}


def test_search_among_sorted_means_rejects_and_is_exact():
    rng = np.random.default_rng(2)
    centroids = rng.integers(-40, 40, size=(60, 16)) + rng.integers(-300, 300, size=(60, 1))
    centroids[7] = centroids[3]
    x = rng.integers(-60, 60, size=(900, 16)) + rng.integers(-300, 300, size=(900, 1))
    x[:200] = centroids[rng.integers(0, 60, 200)]
    search = mean_order_clusters.MeanOrder(centroids)
    number, distance = search.nearest(x)
    apart = ((x[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert (number == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()
    assert search.compared < 0.3 * apart.size


@pytest.mark.parametrize("dim,parts,entries", [(64, 16, 64), (8, 2, 5)])
def test_codes_by_definition(spark, monkeypatch, dim, parts, entries):
    monkeypatch.setattr(vector_codes, "BLOCK", 150)
    rows = vectors(500, dim, seed=1)
    df = frame(spark, rows)
    forest = vector_codes.plant(df, parts=parts)
    books = vector_codes.fit(forest, entries=entries)
    encoded = vector_codes.encode(forest, books)
    out = vector_codes.digests(encoded, books)
    want = brute.codes([r for r in rows if r[1] and len(r[1]) == dim and np.isfinite(np.array(r[1], dtype=float)).all() and max(r[1]) < 1e8], parts, entries, 2)
    assert sorted(tuple(r) for r in out.collect()) == want
    errors = [(sum((a - np.floor(256 * b) / 256) ** 2 for a, b in zip(r.decoded, v)) * 65536, r.error)
              for r in vector_codes.decode(encoded, books).collect() for i, v, _ in rows if i == r.vec_id and i != 3]
    assert len(errors) > 400 and all(abs(a - b) < 1e-3 for a, b in errors)


def test_few_and_no_vectors_to_encode(spark):
    for rows in ([], [(1, [0.5] * 64, 1)], [(None, [0.5] * 64, None)], [(1, [0.5] * 64, 1), (None, [0.25] * 64, None), (1, [0.5] * 64, None)], [(1, [1.0] * 7, 1)]):
        forest = vector_codes.plant(frame(spark, rows))
        books = vector_codes.fit(forest)
        out = vector_codes.digests(vector_codes.encode(forest, books), books).collect()
        assert len(out) == (len(rows) if books.entries.size else 0)
        assert sum(r.label_error for r in out) >= 0
    assert vector_codes.encode(vector_codes.plant(frame(spark, rows), label=None), books).columns == ["vec_id", "code", "error"]


@pytest.mark.parametrize("kind", ["plain", "equal", "ties", "heavy", "single"])
def test_trees_own_and_cache_what_they_hold(kind):
    rng = np.random.default_rng(5)
    width = 3
    x = {"plain": rng.normal(size=(1200, width)) * 100, "equal": np.repeat(rng.normal(size=(3, width)) * 50, 400, axis=0), "single": np.ones((1, width)),
         "ties": rng.integers(-2, 3, size=(900, width)), "heavy": rng.normal(size=(700, width)) ** 9 * 1000}[kind].astype(np.int64)
    books = np.stack([x[rng.integers(0, len(x), 20)] + rng.integers(-2, 3, size=(20, width)) for _ in range(2)])
    trees = anchor_trees.Trees.unpacked(anchor_trees.build(np.concatenate([x, x[::-1]]), [len(x)] * 2).packed(), width)
    codes, balls, owners, alone = anchor_trees.nearest(trees, books)
    both = np.stack([x, x[::-1]])
    want = ((both[:, :, None] - books[:, None]) ** 2).sum(axis=3).argmin(axis=2).ravel()
    got = np.empty_like(want)
    got[trees.origin] = codes
    assert (got == want).all() and sorted(trees.origin) == list(range(len(want)))
    for node in range(len(trees.low)):
        held = trees.points[trees.low[node]:trees.high[node]]
        assert (held.sum(axis=0) == trees.sums[node]).all()
        assert np.linalg.norm(held - held.mean(axis=0), axis=1).max() <= trees.radius[node] + 1e-6
    assert sum(trees.high[b] - trees.low[b] for b in balls) + alone.sum() == len(want)
    assert kind != "heavy" or len(balls) < (~alone).sum() / 2  # balls, not points, are owned
