"""Graph near-duplicates, prefix-forest search and components against brute force."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from ledgerloom.llm import hash_forest, hnsw, queries
from ledgerloom.llm.components import components
from ledgerloom.llm.tables import Scratch, prepare


def plain_links(ids, vectors, threshold=0.95):
    """n_links and component of every id; unusable vectors stand alone."""
    count, root = dict.fromkeys(ids, 0), {i: i for i in ids}
    good = [k for k, v in enumerate(vectors) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = []
    for k in good:
        for j in good:
            if j != k and len(vectors[j]) == len(vectors[k]):
                a, b = np.array(vectors[k], float), np.array(vectors[j], float)
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                    count[ids[k]] += 1
                    links.append((ids[k], ids[j]))
    for _ in ids:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    return {i: (count[i], root[i], root[i] == i) for i in ids}


def clustered(seed: int, groups: int, most: int, plain: int, dim: int = 32):
    random = np.random.default_rng(seed)
    rows = [random.normal(size=dim) for _ in range(plain)]
    for _ in range(groups):
        center = random.normal(size=dim)
        rows += [center * random.uniform(0.1, 5) + random.normal(size=dim) * random.uniform(0.02, 0.2) for _ in range(random.integers(2, most))]
    order = random.permutation(len(rows))
    return [rows[k].astype(np.float32).tolist() for k in order]


def shown(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}


def test_links_and_components_equal_brute_force(spark):
    vectors = clustered(1, 12, 40, 200)
    ids = [3 * k for k in range(len(vectors))]
    df = spark.createDataFrame(list(zip(ids, vectors, strict=True)), "vec_id bigint, embedding array<float>")
    want = plain_links(ids, vectors)
    assert shown(hnsw.near_duplicates(df)) == want
    # Several shards and slices of queries must agree.
    assert shown(hnsw.near_duplicates(df, settings=hnsw.Settings(shard_rows=70, query_rows=90, together=32))) == want


def test_recall_in_one_large_graph_and_a_widened_beam():
    vectors = hnsw.unit(np.array(clustered(2, 20, 60, 3000, 48), float))
    graph = hnsw.Graph(vectors.astype(np.float32), hnsw.Settings(beam=2))
    assert graph.audit() >= 0.99 and graph.beam >= 2
    held = vectors[graph.order]
    q, n = graph.search(vectors.astype(np.float32))
    sure = (vectors[q] * held[n]).sum(1) >= 0.95
    wanted = (vectors @ vectors.T >= 0.95).sum()
    assert len(graph.layers) > 1 and sure.sum() >= 0.99 * wanted


def test_equal_vectors_count_without_being_paired(spark):
    base = np.random.default_rng(4).normal(size=8)
    rows = [(k, base.tolist()) for k in range(50)] + [(100, (base * 3).tolist()), (101, (-base).tolist()), (7, base.tolist())]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = shown(hnsw.near_duplicates(df))
    assert got == {k: (50, 0, k == 0) for k in range(50)} | {100: (50, 0, False), 101: (0, 101, True)}


@pytest.fixture(scope="module")
def odd(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.01]), (3, None), (4, [0.0, 0.0]), (5, [1.0, None]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, []),
            (9, [1.0, 0.0, 0.0]), (10, [1.0, 0.001, 0.0]), (11, [1e300, 1e298]), (None, [1.0, 0.0]), (12, [0.0, 1.0]), (2, [2.0, 0.01])]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "1 label", "2 shard", "3 links")


def test_odd_vectors_link_with_nothing(odd):
    rows = hnsw.near_duplicates(odd).collect()
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in rows}
    alone = {k: (0, k, True) for k in (3, 4, 5, 6, 7, 8, 12)} | {None: (0, None, False)}
    assert got == alone | {1: (2, 1, True), 2: (2, 1, False), 11: (2, 1, False), 9: (1, 9, True), 10: (1, 9, False)}
    assert len(rows) == 13
    assert hnsw.near_duplicates(odd.limit(0)).count() == 0


def test_near_duplicate_query_on_the_driver_table(spark):
    ids, vectors = zip(*duckdb.connect().execute(f"SELECT vec_id, embedding FROM '{SMALL}/embeddings.parquet'").fetchall(), strict=True)
    unit = hnsw.unit(np.array(vectors, float))
    near = unit @ unit.T >= 0.95
    got = shown(queries.QUERIES["op1_hnsw"](spark, SMALL))
    assert {i: got[i][0] for i in ids} == {i: int(near[k].sum()) - 1 for k, i in enumerate(ids)}


def plain_nearest(ids, vectors, query, nearest=10):
    distance = np.sqrt(((vectors - vectors[query]) ** 2).sum(axis=1))
    return sorted((d, i) for d, i in zip(distance.tolist(), ids, strict=True) if i != ids[query])[:nearest]


def test_forest_query_reaches_the_recall_and_exact_scores(spark):
    ids, vectors = zip(*duckdb.connect().execute(f"SELECT vec_id, embedding FROM '{SMALL}/embeddings.parquet'").fetchall(), strict=True)
    vectors = np.array(vectors, float)
    found = {}
    for r in queries.QUERIES["op9_hash_forest"](spark, SMALL).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert found.keys() == {i for i in ids if i % 100 == 0}
    hits = 0
    for query, rows in found.items():
        want = {i: d for d, i in plain_nearest(ids, vectors, ids.index(query))}
        assert [r for r, _, _ in rows] == list(range(1, 11)) and [s for _, _, s in rows] == sorted(s for _, _, s in rows)
        assert all(s == pytest.approx(want[i], rel=1e-12) for _, i, s in rows if i in want)
        hits += sum(i in want for _, i, _ in rows)
    assert hits >= 0.9 * 10 * len(found)


def test_many_shards_find_what_one_would(spark):
    vectors = np.array(clustered(5, 5, 30, 900, 16), float)
    ids = list(range(len(vectors)))
    df = spark.createDataFrame(list(zip(ids, vectors.tolist(), strict=True)), "vec_id bigint, embedding array<double>")
    settings = hash_forest.Settings(shard_rows=200, query_rows=5)
    found = {}
    for r in hash_forest.nearest_neighbours(df, F.col("vec_id") % 50 == 0, settings=settings).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = sum(len(found[q] & {i for _, i in plain_nearest(ids, vectors, q)}) for q in range(0, len(ids), 50))
    assert hits >= 0.9 * 10 * len(found) and len(found) == len(range(0, len(ids), 50))


def test_ties_odd_vectors_and_few_candidates(spark, odd):
    got = hash_forest.nearest_neighbours(odd, F.col("vec_id") > 0).orderBy("query_id", "rank").collect()
    assert [r.vec_id for r in got if r.query_id == 1] == [2, 12, 11] and [r.vec_id for r in got if r.query_id == 9] == [10]
    assert {r.query_id for r in got} == {1, 2, 9, 10, 11, 12}
    same = spark.createDataFrame([(k, [1.0, 2.0]) for k in range(30, 0, -1)], "vec_id bigint, embedding array<double>")
    ties = hash_forest.nearest_neighbours(same, F.col("vec_id") == 3).orderBy("rank").collect()
    assert [(r["rank"], r.vec_id, r.score) for r in ties] == [(k + 1, i, 0.0) for k, i in enumerate([1, 2, 4, 5, 6, 7, 8, 9, 10, 11])]
    assert hash_forest.nearest_neighbours(odd.limit(0), F.col("vec_id") > 0).count() == 0


def test_components_of_paths_stars_and_odd_links(spark):
    prepare(spark)
    links = [(k, k + 1) for k in range(200, 260)] + [(900, k) for k in range(500, 540)] + [(5, 5), (7, None), (1, 3), (3, 1)]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r.node: r.component for r in components(Scratch(spark, "test"), df).collect()}
    assert got == {k: 200 for k in range(201, 261)} | {k: 500 for k in (*range(501, 540), 900)} | {3: 1}
    assert components(Scratch(spark, "test"), df.limit(0)).count() == 0
