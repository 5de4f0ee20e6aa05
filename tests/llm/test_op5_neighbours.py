import numpy as np
import pytest

from tidemark.llm import neighbours


def brute(vectors, threshold):
    n = len(vectors)
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    links = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            if i != j and ok[i] and ok[j] and len(vectors[i]) == len(vectors[j]):
                a, b = np.array(vectors[i], float), np.array(vectors[j], float)
                links[i, j] = a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold
    component = list(range(n))
    for _ in range(n):
        for i, j in zip(*np.nonzero(links), strict=True):
            component[i] = component[j] = min(component[i], component[j])
    return links.sum(axis=1).tolist(), component


def test_equal_to_brute_force(spark):
    rng = np.random.default_rng(5)
    vectors = []
    for size in (1, 1, 2, 3, 40, 70):
        centre = rng.normal(size=16)
        vectors += [(centre + 0.05 * rng.normal(size=16)).tolist() for _ in range(size)]
    vectors += [vectors[3], vectors[3], None, [], [0.0] * 16, [float("nan")] * 16, [None, 1.0], [float("inf"), 1.0], [1.0, 2.0], [2.0, 4.0]]
    vectors += [rng.normal(size=16).tolist() for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>").withColumn("node", __import__("pyspark").sql.functions.lit("x"))
    got = {r.vec_id: r for r in neighbours.near_duplicates(rows).collect()}
    links, component = brute(vectors, 0.95)
    assert [got[i].n_links for i in range(len(vectors))] == links
    assert [got[i].component_id for i in range(len(vectors))] == component
    assert all(r.kept == (r.component_id == r.vec_id) for r in got.values())


def test_blocks_of_a_large_component(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PORTION", 16)
    rng = np.random.default_rng(6)
    centre = rng.normal(size=8)
    rows = spark.createDataFrame([(i, (centre + 0.01 * rng.normal(size=8)).tolist()) for i in range(150)], "vec_id long, embedding array<double>")
    out = neighbours.near_duplicates(rows).collect()
    assert {r.n_links for r in out} == {149} and {r.component_id for r in out} == {0}


def test_empty_null_ids_and_repeated_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert neighbours.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])]
    out = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in neighbours.near_duplicates(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert out == [(1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True), (None, 0, None, False)]


def test_a_wide_component_is_compared_where_angles_do_not_decide(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PORTION", 8)
    rng = np.random.default_rng(9)
    # A chain of vectors on an arc, with noise, and a tight group at one end.
    vectors = [[np.cos(a), np.sin(a), *(0.02 * rng.normal(size=4))] for a in np.linspace(0, 1.4, 120)]
    vectors += [[1.0, *(0.01 * rng.normal(size=5))] for _ in range(60)]
    vectors = [[float(x) for x in v] for v in vectors]
    rows = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in neighbours.near_duplicates(rows).collect()}
    links, component = brute(vectors, 0.95)
    assert [got[i].n_links for i in range(len(vectors))] == links
    assert [got[i].component_id for i in range(len(vectors))] == component


def test_codings_grow_with_the_table():
    for n in (1, 10_000, 1_000_000, 30_000_000, 10**12):
        bits, tables = neighbours.codings(n, 0.95)
        meet = (1 - np.arccos(0.95) / np.pi) ** bits
        assert (1 - meet) ** tables <= neighbours.MISSED and tables <= 1024


def test_too_little_recall_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PASSES", 1)
    monkeypatch.setattr(neighbours, "audit", lambda *a: 0.5)
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.001])], "vec_id long, embedding array<double>")
    with pytest.raises(RuntimeError):
        neighbours.near_duplicates(rows)


@pytest.mark.parametrize("lone", [0, 3_000, 12_000])
def test_an_audit_sees_lost_links(spark, lone):
    """Sixty pairs of which half are lost, among any number of vectors without links."""
    rng = np.random.default_rng(lone)
    pairs = rng.normal(size=(60, 64))
    vectors = np.concatenate([pairs, pairs + rng.normal(size=(60, 64)) * 0.01, rng.normal(size=(lone, 64))])
    rows = neighbours.packed(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>"))
    nodes = rows.select("node", "vec", "vec_id")
    node = {r.vec_id: r.node for r in nodes.collect()}
    found = lambda kept: spark.createDataFrame([(node[i + k], node[i]) for i in range(kept) for k in (0, 60)], "node long, component long")
    assert neighbours.audit(nodes, found(60), 0.95) == 1.0
    assert abs(neighbours.audit(nodes, found(30), 0.95) - 0.5) <= 0.1
    alone = nodes.where("vec_id >= 60")
    assert neighbours.audit(alone, found(0), 0.95) is None
