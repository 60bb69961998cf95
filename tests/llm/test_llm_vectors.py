"""Vector operators against brute force."""

import numpy as np
import pytest
from conftest import SF

from cartwheel.llm import cells, scan
from cartwheel.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, score string, cell int"


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, g, "x", 1) for i, v, g in rows], SCHEMA)


ODD = [
    (1, None, 1),
    (2, [0.0, 0.0, 0.0], 1),
    (3, [1.0, None, 0.0], 1),
    (4, [float("nan"), 1.0, 0.0], 1),
    (5, [float("inf"), 1.0, 0.0], 1),
    (6, [], 1),
    (7, [1.0, 2.0], 1),
]


def near_table(spark, n=600):
    random = np.random.default_rng(1)
    rows = []
    centres = random.normal(size=(40, 3))
    for i in range(n):
        vector = centres[random.integers(40)] + random.normal(scale=0.05, size=3)
        rows.append((100 + i, [float(x) for x in vector.astype(np.float32)], int(random.integers(3)) if i % 20 else None))
    rows += [(2000 + i, rows[1][1], 1) for i in range(50)]  # one vector many times
    return rows


def brute(rows):
    usable = [(i, np.array(v, float), g) for i, v, g in rows if g is not None and v is not None and len(v) == 3 and all(x is not None for x in v) and np.isfinite(v).all() and any(v)]
    parent, links = {i: i for i, _, _ in rows}, dict.fromkeys((i for i, _, _ in rows), 0)

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for k, (i, v, g) in enumerate(usable):
        for j, w, h in usable[:k]:
            if g == h and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.98:
                links[i] += 1
                links[j] += 1
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (links[i], root(i), root(i) == i) for i in parent}


@pytest.mark.parametrize(("block", "cell_rows"), [(1024, 512), (16, 20)])
def test_near_copies_against_brute_force(spark, monkeypatch, block, cell_rows):
    """Also with many cells and small blocks, so that links cross both."""
    monkeypatch.setattr(cells, "BLOCK", block)
    monkeypatch.setattr(cells, "CELL_ROWS", cell_rows)
    rows = near_table(spark) + ODD
    found = cells.near_copies(table_of(spark, rows), "vec_id", "embedding", "label").collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found} == brute(rows)


def test_near_copies_of_nothing(spark):
    assert cells.near_copies(table_of(spark, []), "vec_id", "embedding", "label").count() == 0
    rows = [(1, None, 1), (2, [0.0], None), (None, [1.0, 0.0], 1)]
    found = cells.near_copies(table_of(spark, rows), "vec_id", "embedding", "label").collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in found) == [(0, 0, 0, True), (1, 0, 1, True), (2, 0, 2, True)]


def test_scan_recall_and_exact_scores(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = table.toPandas()
    vectors, ids = np.stack(rows.embedding).astype(float), rows.vec_id.to_numpy()
    found = QUERIES["op4_scan"](spark, SF).toPandas()
    hits = asked = 0
    for k in np.flatnonzero(ids % 20 == 0):
        scores = vectors @ vectors[k]
        scores[k] = -np.inf
        best = np.lexsort((ids, -scores))[:20]
        got = found[found.query_id == ids[k]].sort_values("rank")
        assert got["rank"].tolist() == list(range(1, 21))
        assert np.allclose(got.score, [scores[np.flatnonzero(ids == v)[0]] for v in got.vec_id], atol=1e-12)
        hits += len(set(got.vec_id) & set(ids[best]))
        asked += 20
    assert hits / asked >= 0.9


def test_scan_ties_and_odd_rows(spark):
    rows = [(10 + i, [1.0, 0.0, 0.0], 1) for i in range(30)] + [(100, [0.5, 0.0, 0.0], 1), *ODD]
    table = table_of(spark, rows)
    found = scan.search(table, "vec_id", "embedding", table.filter("vec_id IN (20, 100, 2, 3)"), k=20).collect()
    by = {q: [r.vec_id for r in sorted(found, key=lambda r: r.rank) if r.query_id == q] for q in (20, 100, 2, 3)}
    assert by[20] == [10 + i for i in range(21) if i != 10]
    assert by[100] == [10 + i for i in range(20)] and not by[2] and not by[3]
    few = scan.search(table.filter("vec_id < 13"), "vec_id", "embedding", table.filter("vec_id = 10"), k=20).collect()
    assert [(r.rank, r.vec_id, r.score) for r in few] == [(1, 11, 1.0), (2, 12, 1.0)]
    assert scan.search(table_of(spark, []), "vec_id", "embedding", table).count() == 0


def test_scan_prunes_and_keeps_the_best(spark):
    """Against all products of clustered vectors, with lists that are cut into several blocks."""
    random = np.random.default_rng(3)
    vectors = random.normal(size=(3000, 32))
    ids = np.arange(3000)
    turn = scan.rotation(32)
    spun = vectors @ turn.T
    columns = [np.ascontiguousarray(spun[:, s : s + scan.COLUMNS]) for s in range(0, 32, scan.COLUMNS)]
    norms = (vectors**2).sum(axis=1)
    hits = 0
    for q in range(60):
        at, scores = scan.scan_block(vectors[q], q, spun[q], vectors, columns, norms, ids, 20)
        exact = vectors @ vectors[q]
        exact[q] = -np.inf
        hits += len(set(at) & set(np.argsort(-exact)[:20]))
        assert np.allclose(scores, exact[at])
    assert hits / 1200 > 0.97


def test_a_carried_bound_leaves_out_what_cannot_count(spark):
    """Of two halves of a list, the second returns only what reaches the first one's k-th product; nothing near is lost."""
    random = np.random.default_rng(4)
    vectors, ids = random.normal(size=(4000, 32)), np.arange(4000)
    turn = scan.rotation(32)
    hits = returned = 0
    for q in range(40):
        found, tau = [], -np.inf
        for half in (slice(0, 2000), slice(2000, 4000)):
            spun = vectors[half] @ turn.T
            columns = [np.ascontiguousarray(spun[:, s : s + scan.COLUMNS]) for s in range(0, 32, scan.COLUMNS)]
            at, scores = scan.scan_block(vectors[q], q, vectors[q] @ turn.T, vectors[half], columns, (vectors[half] ** 2).sum(axis=1), ids[half], 20, tau)
            assert (scores >= tau).all() and np.allclose(scores, vectors[half][at] @ vectors[q])
            found += list(ids[half][at])
            tau = max(tau, scores.min()) if len(scores) == 20 else tau
        exact = vectors @ vectors[q]
        exact[q] = -np.inf
        hits += len(set(found) & set(np.argsort(-exact)[:20]))
        returned += len(found)
    assert hits / 800 > 0.97 and returned < 40 * 39


def test_repeated_queries_ask_once(spark):
    random = np.random.default_rng(5)
    rows = [(i, [float(x) for x in random.normal(size=8)], 1) for i in range(61)]
    table = table_of(spark, [*rows, rows[20]])
    found = scan.search(table, "vec_id", "embedding", table.filter("vec_id = 20"), k=20, lists=4, probes=4).collect()
    assert [r.rank for r in found] == list(range(1, 21)) and len({r.vec_id for r in found}) == 20
