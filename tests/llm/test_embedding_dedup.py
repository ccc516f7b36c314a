"""Sorted projection passes against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ventilake.llm import embedding_dedup as ed
from ventilake.llm import queries as q
from ventilake.llm.common import table

from conftest import SF_CHECK

ROWS = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.98):
    """All pairs; ``(vec_id, n_links, component_id)`` per row."""
    usable = []
    for _, v, label in rows:
        x = None if v is None or label is None or any(a is None for a in v) else np.array(v, dtype=np.float64)
        if x is not None and (not len(x) or not np.isfinite(x).all() or not x.any()):
            x = None
        if x is not None:
            x = x / np.abs(x).max()
            x = x / np.sqrt((x * x).sum())
        usable.append(x)
    n = len(rows)
    links = [[] for _ in rows]
    for i in range(n):
        for j in range(i):
            a, b = usable[i], usable[j]
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b >= threshold:
                links[i].append(j)
                links[j].append(i)
    component = list(range(n))
    out = []
    for i in range(n):
        if component[i] != i:
            continue
        todo, seen = [i], {i}
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        for j in seen:
            component[j] = -1
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out += [(rows[j][0], len(links[j]), min(ids) if ids else None) for j in seen]
    return sorted(out, key=str)


def near(rng, centre, n, angle):
    """Vectors at about ``angle`` (radians) from the centre."""
    noise = rng.standard_normal((n, len(centre)))
    noise -= np.outer(noise @ centre, centre) / (centre @ centre)
    noise *= np.linalg.norm(centre) / np.linalg.norm(noise, axis=1, keepdims=True)
    return centre * np.cos(angle) + noise * np.sin(angle)


def planted(dim=24, seed=1):
    rng = np.random.default_rng(seed)
    vectors, labels = [], []

    def add(x, label):
        vectors.extend(np.asarray(x, dtype=np.float32).tolist())
        labels.extend([label] * len(x))

    add(rng.standard_normal((300, dim)), 0)
    add(rng.standard_normal((60, dim)), 1)
    for angle, n in ((0.05, 30), (0.1, 150), (0.13, 60), (0.142, 80), (0.19, 20)):  # the last ones lie around the threshold
        add(near(rng, rng.standard_normal(dim), n, angle), 0)
    centre = rng.standard_normal(dim)
    add(near(rng, centre, 12, 0.08), 1)
    add(near(rng, centre, 12, 0.08), 2)  # alike, under another label
    add([centre] * 40, 1)  # exact copies
    add([3 * centre, 1e-30 * centre, 1e30 * centre / np.abs(centre).max(), -centre], 1)  # one direction, and its opposite
    chain = rng.standard_normal(dim)
    for _ in range(25):  # each is linked with its neighbours alone
        chain = near(rng, chain, 1, 0.17)[0]
        add([chain], 3)
    rows = [(int(i), v, int(k)) for i, v, k in zip(rng.permutation(len(vectors)) + 5, vectors, labels, strict=True)]
    odd = [
        (2000, None, 0), (2001, [], 0), (2002, [0.0] * dim, 0), (2003, [-0.0] * dim, 0), (2004, [float("nan")] * dim, 0),
        (2005, [float("inf")] + [1.0] * (dim - 1), 0), (2006, [None] + [1.0] * (dim - 1), 0), (2007, vectors[0], None),
        (2008, [1.0, 2.0], 0), (2009, [1.0, 2.0], 0), (2010, [2.0, 4.0], 0), (2011, [1.0], 0), (2012, [-0.0, 1.0], 0), (2013, [0.0, 1.0], 0),
        (None, vectors[400], labels[400]), (None, [9.0, 1.0], 7), (None, None, 7), (2014, vectors[1], 0), (2014, vectors[2], 0), (2014, vectors[2], 0),
    ]
    return rows + odd


@pytest.mark.parametrize("options", [{}, {"window": 8, "per_block": 16, "passes": 24, "together": 8}, {"together": 8, "passes": 8}])
def test_equals_all_pairs(spark, options):
    rows = planted()
    df = spark.createDataFrame(rows, ROWS).withColumns({"vector": F.lit("v"), "component": F.lit(1), "cid": F.lit("c")})
    df = df.withColumn("pass", F.lit(0))
    want = brute(rows)
    for parts, shuffles in ((1, 1), (12, 9)):
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffles))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            out = ed.embedding_dedup(df.repartition(parts), **options).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in out), key=str) == want
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out)


def test_doubles_and_empty_table(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), v, "a") for i, v in enumerate((near(rng, rng.standard_normal(10), 30, 0.14) * 1e200).tolist())]
    schema = "vec_id long, embedding array<double>, label string"
    out = ed.embedding_dedup(spark.createDataFrame(rows, schema)).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in out), key=str) == brute(rows)
    assert ed.embedding_dedup(spark.createDataFrame([], ROWS)).collect() == []
    nothing = ed.embedding_dedup(spark.createDataFrame([(1, None, 1), (2, [0.0], 1)], ROWS)).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in nothing) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_window_looks_at_every_neighbour():
    """Batches and windows: the pairs of an order are those at most a window apart, for any cut of the stream."""
    rng = np.random.default_rng(8)
    x = ed.units([v.astype("<f8").tobytes() for v in near(rng, rng.standard_normal(6), 90, 0.1)], "double")
    group = np.repeat([0, 1], [50, 40])
    want = {(i, j) for i in range(90) for j in range(i + 1, min(90, i + 8)) if group[i] == group[j] and x[i] @ x[j] >= 0.985}
    assert set(zip(*map(np.ndarray.tolist, ed.pairs_in_order(x, group, 7, 0.985)), strict=True)) == want
    parts = [set(zip(*map(np.ndarray.tolist, ed.pairs_in_order(x[: k + 9], group[: k + 9], 7, 0.985, k)), strict=True)) for k in range(0, 90, 9)]
    assert set().union(*parts) == want and sum(map(len, parts)) == len(want)


def test_query_equals_all_pairs(spark):
    rows = [tuple(r) for r in table(spark, SF_CHECK, "embeddings").select("vec_id", "embedding", "label").collect()]
    out = q.op11_embedding_dedup(spark, SF_CHECK).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in out), key=str) == brute(rows)
