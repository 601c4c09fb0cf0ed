from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.compare import differences
from tests.llm import brute
from tidewell.llm import embedding_dedup, graph, nn_descent
from tidewell.llm.common import table
from tidewell.llm.oracle import SQL
from tidewell.llm.queries import QUERIES
from tidewell.llm.url_filter import Automaton, Rule, judge_urls

BAD = [(900, None), (901, []), (902, [0.0] * 8), (903, [1.0, None] + [0.0] * 6), (904, [float("nan")] + [1.0] * 7), (905, [1.0] * 3),
       (906, [float("inf")] + [1.0] * 7), (None, [1.0] * 8)]


def planted(n=400, dim=8, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 8, dim))
    x = np.repeat(centres, 8, axis=0) + rng.normal(size=(n, dim)) * 0.15
    x[:5] = x[0]
    x[5] = x[0] * 1e200
    return x


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_its_sql(spark, con, small, name):
    problem, *_ = differences(spark, con, name, small)
    assert problem is None, problem


# ---- embeddings -------------------------------------------------------------------------


def test_near_copies_among_vectors(spark):
    x = planted()
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + BAD
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumns({c: F.lit(1) for c in ("id", "unit", "cell", "h", "i")})
    linked = brute.cosines(np.vstack([x[:5], [x[0]], x[6:]])) >= 0.9
    np.fill_diagonal(linked, False)
    want = brute.least_reachable(range(len(x)), zip(*np.nonzero(linked)))
    got = {r.vec_id: r for r in embedding_dedup.near_copies(df, cell=40, z=float("inf")).collect()}
    assert len(got) == len(rows)
    assert [got[i].n_links for i in range(len(x))] == linked.sum(axis=1).tolist()
    assert [got[i].component_id for i in range(len(x))] == [want[i] for i in range(len(x))]
    assert {(got[i].n_links, got[i].component_id == i, got[i].kept) for i, _ in BAD if i is not None} == {(0, True, True)}
    assert (got[None].n_links, got[None].component_id, got[None].kept) == (0, None, True)


def test_default_reach_finds_links_at_the_threshold(spark):
    rng = np.random.default_rng(4)
    base, u = rng.normal(size=(2, 600, 64))
    base /= np.linalg.norm(base, axis=1)[:, None]
    u -= (u * base).sum(axis=1)[:, None] * base
    u /= np.linalg.norm(u, axis=1)[:, None]
    x = np.concatenate([base, 0.901 * base + np.sqrt(1 - 0.901 ** 2) * u])
    got = embedding_dedup.near_copies(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>"), cell=50)
    assert got.where("n_links > 0").count() >= 0.98 * len(x)


def test_default_reach_finds_all_links_of_vectors_of_low_rank(spark):
    """Six effective dimensions of 256: partners lie much farther along the centres' differences than in random directions."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(800, 6)) @ rng.normal(size=(6, 256))
    linked = brute.cosines(x) >= 0.9
    np.fill_diagonal(linked, False)
    want = brute.least_reachable(range(len(x)), zip(*np.nonzero(linked)))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = {r.vec_id: r for r in embedding_dedup.near_copies(df, cell=40).collect()}
    assert [got[i].n_links for i in range(len(x))] == linked.sum(axis=1).tolist()
    assert [got[i].component_id for i in range(len(x))] == [want[i] for i in range(len(x))]


def test_blocks_of_a_hot_cell(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 30)
    x = planted(240, seed=3)
    x[:150] = x[0] + np.random.default_rng(1).normal(size=(150, 8)) * 0.05
    linked = brute.cosines(x) >= 0.9
    np.fill_diagonal(linked, False)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_copies(df, cell=60, z=float("inf")).collect()}
    assert [got[i] for i in range(len(x))] == linked.sum(axis=1).tolist()


def test_single_precision_only_rules_out(monkeypatch):
    """Cosines so near the threshold that single precision misjudges them; few pairs are compared in double precision."""
    monkeypatch.setattr(embedding_dedup, "TILE", 7)
    rng = np.random.default_rng(8)
    base, u = rng.normal(size=(2, 300, 64))
    base /= np.linalg.norm(base, axis=1)[:, None]
    u -= (u * base).sum(axis=1)[:, None] * base
    u /= np.linalg.norm(u, axis=1)[:, None]
    at = 0.9 + rng.choice([-1e-4, -1e-9, 1e-9, 1e-4], size=300)[:, None]
    other = at * base + np.sqrt(1 - at ** 2) * u
    got = {(x, y) for a, b in embedding_dedup.close(base, other, 0.9) for x, y in zip(a.tolist(), b.tolist())}
    assert got == set(zip(*(m.tolist() for m in np.nonzero(base @ other.T >= 0.9))))
    assert {x for x, y in got if x == y} == set(np.flatnonzero(at[:, 0] > 0.9).tolist())
    a, b = np.arange(1, 900, dtype=np.int32), np.arange(899, dtype=np.int32)
    keep = b != 500
    assert embedding_dedup._least_reached(901, a[keep], b[keep]).tolist() == [0] * 501 + [501] * 399 + [900]


def test_rows_travel_once_for_each_of_their_cells_and_blocks(spark, monkeypatch):
    """No row is dealt to have the cells counted, and none carries the list of its cells along."""
    exploded, explode = [], embedding_dedup.F.explode
    monkeypatch.setattr(embedding_dedup.F, "explode", lambda c: exploded.append(c) or explode(c))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(planted(200))], "vec_id bigint, embedding array<double>")
    found = embedding_dedup.near_copies(df, cell=40)
    assert sum(isinstance(c, str) and c == "cells" for c in exploded) == 1 and found.count() == 200


def test_empty_and_unusable_vectors(spark):
    df = spark.createDataFrame(BAD, "vec_id bigint, embedding array<double>")
    assert embedding_dedup.near_copies(df.where("vec_id in (900, 901)")).where("kept and n_links = 0").count() == 2
    assert embedding_dedup.near_copies(df.where("false")).count() == 0
    assert nn_descent.build(df.where("false")) is None and nn_descent.build(df.where("vec_id in (900, 901, 902)")) is None


def test_components_of_small_graphs_take_few_jobs(spark):
    """A long path, whose rounds were many, and texts."""
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1000), (7, 7), (None, 5), (-3, 1001)]
    text = lambda x: None if x is None else f"\u00e9{x}\U0001f600"
    context = spark.sparkContext
    for kind, made in (("bigint", lambda x: x), ("string", text)):
        context.setJobGroup(f"few-{kind}", "")
        got = graph.components(spark.createDataFrame([tuple(map(made, e)) for e in edges], f"a {kind}, b {kind}")).collect()
        context.setLocalProperty("spark.jobGroup.id", None)
        assert len(context.statusTracker().getJobIdsForGroup(f"few-{kind}")) <= 8
        assert sorted(tuple(r) for r in got) == sorted([(made(i), made(0)) for i in range(301)] + [(made(i), made(-3)) for i in (-3, 1000, 1001)])
    nothing = graph.components(spark.createDataFrame([(1, 1)], "a int, b int"))
    assert nothing.collect() == [] and nothing.dtypes == [("node", "int"), ("component", "int")]


def test_components(spark):
    rng = np.random.default_rng(0)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, size=(250, 2))] + [(i, i + 1) for i in range(1000, 1060)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = brute.least_reachable({x for e in edges for x in e}, edges)
    assert got == {i: c for i, c in want.items() if any(i in e and e[0] != e[1] for e in edges)}


def test_nearest_neighbours(spark, small):
    rows = {r.vec_id: r.embedding for r in table(spark, small, "embeddings").collect()}
    ids = sorted(rows)
    sims = brute.cosines([rows[i] for i in ids])
    np.fill_diagonal(sims, -9)
    got = QUERIES["op7_nearest_neighbours"](spark, small).collect()
    hits = 0
    for q in (i for i in ids if i % 50 == 0):
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in own] == [1, 2, 3, 4, 5]
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        assert all(r.score == pytest.approx(sims[ids.index(q), ids.index(r.vec_id)], abs=1e-12) for r in own)
        hits += len({r.vec_id for r in own} & {ids[i] for i in np.argsort(-sims[ids.index(q)])[:5]})
    assert hits >= 0.95 * 5 * len([i for i in ids if i % 50 == 0])


def test_recall_with_several_cells_and_rounds(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 24))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>")
    index = nn_descent.build(df, degree=24, overlap=3, cell=150, block=300)
    got = nn_descent.search(index, df.where("vec_id % 50 = 0"), beam=64).collect()
    sims = brute.cosines(x)
    np.fill_diagonal(sims, -9)
    hits = sum(r.vec_id in np.argsort(-sims[r.query_id])[:5] for r in got)
    assert len(got) == 300 and hits >= 0.9 * 300


@pytest.mark.parametrize("spread", [0.01, 0.001])
def test_recall_inside_a_group_of_near_copies(spark, spread):
    """Cosines of about 1 - spread ** 2, closer together than components rounded to bytes can tell."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(2500, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[:2000] = x[0] + spread * x[:2000]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>")
    sims = brute.cosines(x.astype(np.float32))
    np.fill_diagonal(sims, -9)
    got = nn_descent.search(nn_descent.build(df, cell=250, overlap=4, block=400), df.where("vec_id % 50 = 0")).collect()
    for queries in (range(0, 2000, 50), range(2000, 2500, 50)):
        own = [r for r in got if r.query_id in queries]
        hits = sum(r.score >= np.sort(sims[r.query_id])[-5] - 1e-14 for r in own)
        assert len(own) == 5 * len(queries) and hits >= 0.9 * len(own)


def test_few_and_bad_vectors_as_neighbours(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.1]), (50, [0.0, 2.0]), (50, [0.0, 2.0]), (100, None), (150, [0.0, 0.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = nn_descent.search(nn_descent.build(df), df.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [(0, 1, 1), (0, 2, 50), (50, 1, 1), (50, 2, 0)]


# ---- urls -------------------------------------------------------------------------------


def test_automaton_over_several_words():
    a = Automaton(["com/**", "*.com/**", "**ab**cd", "x" * 130 + "*y", "", "*"])
    got = a.matches([b"com/", b"a.com/x", b"a/b.com/x", b"abZcd", b"abcdab", b"x" * 131 + b"y", b"x" * 130 + b"/y", b"", "é".encode()])
    assert [np.flatnonzero(g).tolist() for g in got] == [[0], [1], [], [2, 5], [5], [3, 5], [], [4, 5], [5]]


def test_judged_urls(spark):
    urls = {1: "http://com/x", 2: "HTTP://A.Example.COM/en/q?x=/fr/", 3: "https://www.example.com/en/", 4: "http://x.net/es/1#a", 5: "http://x.net/es",
            6: "http://notexample.com/en/", 7: "no scheme", 8: None, 9: "", 10: "http://a.b://c.com/", 11: "http://spam.org", 12: "http://o.org/a/spam",
            13: "http://m.www.example.com/en/x", 14: "http://o.org/cgi-bin/x", 15: "http://É.com/ü", 16: "http://o.org/" + "a" * 20_000 + "/cgi-bin/",
            17: "http://net/fr/", 18: "http://example.com?x", 19: "x\ny://o.net/fr/\n"}
    df = spark.createDataFrame(list(urls.items()), "page_id bigint, url string").withColumns({c: F.lit(1) for c in ("id", "host", "path", "rule")})
    got = {r.page_id: (r.host if len(r.host) < 99 else "", r.rule, r.verdict) for r in judge_urls(df).collect()}
    assert got == {
        1: ("com", "com/", "allow"), 2: ("a.example.com", "example.com/en/", "block"), 3: ("www.example.com", "www.example.com/en/", "allow"),
        4: ("x.net", "net/es/", "block"), 5: ("x.net", None, "allow"), 6: ("notexample.com", "com/", "allow"), 7: ("", None, "allow"),
        8: ("", None, "allow"), 9: ("", None, "allow"), 10: ("a.b:", None, "allow"), 11: ("spam.org", None, "block"), 12: ("o.org", None, "allow"),
        13: ("m.www.example.com", "www.example.com/en/", "allow"), 14: ("o.org", None, "block"), 15: ("É.com", "com/", "allow"), 16: ("o.org", None, "block"),
        17: ("net", "net/fr/", "block"), 18: ("example.com", None, "allow"), 19: ("o.net", "net/fr/", "block")}
    assert judge_urls(df.where("false")).count() == 0
    assert judge_urls(df, [Rule("org", "/", "block")], []).where("verdict = 'block'").count() == 3
