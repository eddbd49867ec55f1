"""Near-duplicate vectors against brute force, the graph's search, and odd vectors."""

from collections import Counter

import numpy as np
import pytest

from tokenloom.llm import embeddings, queries

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, node string, packed int"


def near_vectors(rows, least):
    usable = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, above = [0] * len(rows), list(range(len(rows)))

    def root(i):
        while above[i] != i:
            i = above[i]
        return i

    for i in usable:
        for j in usable:
            x, y = np.array(rows[i][1], float), np.array(rows[j][1], float)
            if i != j and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                links[i] += 1
                above[root(i)] = root(j)
    names = {}
    for i, (key, _) in enumerate(rows):
        names.setdefault(root(i), []).append(key)
    low = {r: min((k for k in keys if k is not None), default=None) for r, keys in names.items()}
    return Counter((key, links[i], low[root(i)], key == low[root(i)]) for i, (key, _) in enumerate(rows))


def found(spark, rows, **options):
    table = spark.createDataFrame([(k, v, 1, "n", 2) for k, v in rows], SCHEMA)
    return Counter(tuple(r) for r in embeddings.groups(table, **options).collect())


def clustered(seed, number, size, clusters=12):
    """Rounded to single precision, as the table holds them."""
    draw = np.random.default_rng(seed)
    centre = draw.normal(size=(clusters, size))
    x = centre[draw.integers(0, clusters, number)] + draw.normal(size=(number, size)) * draw.choice([0.02, 0.15, 0.3], (number, 1))
    return [[float(v) for v in row] for row in x.astype(np.float32)]


@pytest.mark.parametrize("portion, shard, region", [(24_576, 1024, 8192), (40, 32, 8192), (100, 64, 60)])
def test_groups_equal_brute_force(spark, monkeypatch, portion, shard, region):
    monkeypatch.setattr(embeddings, "PORTION", portion)
    monkeypatch.setattr(embeddings, "SHARD", shard)
    monkeypatch.setattr(embeddings, "REGION", region)
    rows = list(enumerate(clustered(1, 400, 16)))
    rows += [(1000 + i, v) for i, v in rows[:30]] + [(5, rows[5][1])]
    assert found(spark, rows) == near_vectors(rows, embeddings.LEAST)


def test_odd_vectors(spark):
    plain = [1.0, 2.0, 3.0]
    rows = [
        (1, plain), (2, [2.0, 4.0, 6.0]), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 3.0]), (7, [1.0, float("nan"), 3.0]),
        (8, [float("inf"), 2.0, 3.0]), (None, plain), (9, [1.0, 2.0]), (10, [1.0, 2.0]), (1, plain), (11, [-1.0, -2.0, -3.0]),
        (12, [3e38, 1.0, 0.0]), (13, [3e38, 0.0, -0.0]), (14, [1e-40, 0.0, 0.0]), (None, None),
    ]
    assert found(spark, rows) == near_vectors(rows, embeddings.LEAST)
    assert found(spark, []) == Counter()


def test_range_search_meets_every_vector():
    x = np.array(clustered(3, 3000, 24, 200))
    x = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)
    graph = embeddings.flat_graph(x)
    got = {(int(q), int(v)) for a, b in embeddings.range_search(x, graph, 0.95) for q, v in zip(a, b)}
    want = {(int(q), int(v)) for q, v in zip(*np.nonzero(x @ x.T >= 0.95))}
    assert got <= want | {p for p in got if abs(float(x[p[0]] @ x[p[1]]) - 0.95) < 1e-5}
    assert len(got & want) >= 0.99 * len(want)
    # The graph is flat and sparse.
    assert len(graph[1]) < 3000 * 6 * embeddings.DEGREE


def test_a_step_does_not_read_all_vertices(monkeypatch):
    """The best vertex of a query was sought among all of them, so each vertex took time in proportion to its region."""

    class Counted(np.ndarray):
        read = 0

        def argmax(self, *args, **options):
            Counted.read += self.size
            return np.asarray(self).argmax(*args, **options)

    full = np.full
    monkeypatch.setattr(embeddings.np, "full", lambda *args, **options: full(*args, **options).view(Counted))
    read = {}
    for n in (1500, 6000):
        x = np.array(clustered(4, n, 16, n // 10))
        x = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)
        graph = embeddings.flat_graph(x)
        Counted.read = 0
        got = sum(len(a) for a, _ in embeddings.range_search(x, graph, 0.95))
        assert got >= n
        read[n] = Counted.read / n
    assert 0 < read[6000] < 2 * read[1500]


@pytest.mark.parametrize("block", [1, 7, 128, 10_000])
def test_blocks_give_the_same_pairs(monkeypatch, block):
    x = np.array(clustered(6, 500, 12, 40))
    x = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)
    graph = embeddings.flat_graph(x)
    pairs = lambda: {(int(q), int(v)) for a, b in embeddings.range_search(x, graph, 0.95) for q, v in zip(a, b)}
    want = pairs()
    monkeypatch.setattr(embeddings, "BLOCK", block)
    assert pairs() == want and len(want) > 500


def test_pruning_keeps_what_no_neighbour_covers():
    angle = np.array([0.0, 0.1, 0.2, 1.5, -0.1])
    x = np.stack([np.cos(angle), np.sin(angle)], 1)
    alike = x @ x.T
    order = np.argsort(-alike, axis=1, kind="stable")
    # A larger factor keeps the long edge from 0 to 3, which 1 brings nearer by less than that.
    for alpha, kept in ((1.0, {1, 4}), (1.2, {1, 3, 4})):
        start, end = embeddings.robust_prune(alike, order, alpha=alpha)
        assert set(end[start == 0].tolist()) == kept
        assert set(end[start == 3].tolist()) == {2}


def test_audit_counts_what_was_lost(spark):
    rows = [(i, 1, np.array(v, float).tobytes()) for i, v in enumerate(clustered(5, 100, 8))]
    vertices = spark.createDataFrame([(i, m, bytearray(p)) for i, m, p in rows], "node long, many long, packed binary")
    whole = embeddings.search(vertices).collect()
    there = sum(r.links for r in whole)
    linked = spark.createDataFrame(whole, "node long, links long, root long")
    assert there and embeddings.audit(vertices, linked) == (there, there)
    lost = linked.where(linked["node"] != whole[0].node)
    assert embeddings.audit(vertices, lost) == (there - whole[0].links, there)


def test_query_against_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    assert Counter(tuple(r) for r in queries.op12_embeddings(spark, SMALL).collect()) == near_vectors(rows, 0.95)
