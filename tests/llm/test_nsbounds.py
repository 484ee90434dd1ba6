"""Ns-bounds clustering against plain integer Lloyd rounds."""

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from lapstats.llm import nsbounds

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, _own int"


def brute(rows, clusters=16, rounds=3, dims=64, scale=64):
    """(vec_id, cluster, distance, cluster_inertia, inertia, sha) with Python integers."""
    keep = [(i, [int(np.floor(float(np.float32(x)) * scale)) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(np.float32(x)) for x in v)]
    named = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in keep if i is not None)
    c = [v for _, v in named[:clusters]]
    if not c:
        return []
    for t in range(rounds + 1):
        d = [min((sum((a - b) ** 2 for a, b in zip(v, m)), k) for k, m in enumerate(c)) for _, v in keep]
        if t < rounds:
            for k in range(len(c)):
                mine = [v for (_, v), (_, j) in zip(keep, d) if j == k]
                if mine:
                    c[k] = [sum(col) // len(mine) for col in zip(*mine)]
    sha = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in c]
    per = [sum(x for x, j in d if j == k) for k in range(len(c))]
    cap = lambda x: min(x, nsbounds.MOST)
    return sorted((repr(i), j, cap(x), cap(per[j]), cap(sum(per)), sha[j]) for (i, _), (x, j) in zip(keep, d))


def got(df):
    return sorted((repr(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


def test_awkward_vectors(spark):
    rg = random.Random(4)
    vec = lambda s=1.0: [rg.gauss(0, s) for _ in range(64)]
    rows = [(i, vec()) for i in range(120)]
    rows += [(200, None), (201, []), (202, vec()[:63]), (203, [None] + vec()[1:]), (204, [float("nan")] + vec()[1:]),
             (205, [float("inf")] + vec()[1:]), (None, vec()), (7, vec()), (8, rows[8][1]), (300, [0.0] * 64), (301, [0.0] * 64)]
    df = spark.createDataFrame([(i, v, 1, "x", 3) for i, v in rows], SCHEMA)
    assert got(nsbounds.cluster(df)) == brute(rows)
    assert nsbounds.cluster(df.where("false")).collect() == []
    few = [r for r in rows if r[0] in (1, 2, 3)]
    assert got(nsbounds.cluster(df.where("vec_id in (1, 2, 3)"))) == brute(few)


def test_components_beyond_int64(spark):
    rg = random.Random(6)
    rows = [(i, [rg.choice([-1, 1]) * 10.0 ** rg.randint(-3, 9 + i % 2 * 28) for _ in range(64)]) for i in range(40)]
    df = spark.createDataFrame([(i, v, 1, "x", 3) for i, v in rows], SCHEMA)
    assert got(nsbounds.cluster(df)) == brute(rows)


def test_bounds_spare_distances_and_change_nothing():
    """Well separated groups: later rounds compute far fewer distances than a full scan."""
    rng = np.random.default_rng(2)
    centre = rng.integers(-400, 400, (8, 16))
    x = (centre[np.arange(4000) % 8] + rng.integers(-20, 20, (4000, 16))).astype(np.int64)
    history, own = [centre.tolist()], np.full(len(x), -1)
    low, when, spent = np.zeros((len(x), 8)), np.zeros((len(x), 8), np.int64), []
    for _ in range(5):
        own, dist, low, when, n = nsbounds.assign(x, history, own, low, when)
        full = ((x[:, None, :] - np.array(history[-1])[None]) ** 2).sum(axis=2)
        assert (own == full.argmin(axis=1)).all() and (dist == full.min(axis=1)).all()
        spent.append(n)
        history.append([[int(v) for v in x[own == k].sum(axis=0) // (own == k).sum()] for k in range(8)])
    assert spent[0] == len(x) * 8 and max(spent[1:]) < len(x) * 2


def test_loosened_by_total_displacement():
    """A centroid that went and came back loosens nothing."""
    there = nsbounds.displacements([[[0, 0], [5, 5]], [[30, 40], [5, 5]], [[0, 0], [5, 9]]])
    assert there.tolist() == [[0.0, 4.0], [50.0, 4.0], [0.0, 0.0]]


def test_query_on_the_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    df = nsbounds.op13_ns_bounds(spark, sf)
    assert got(df) == brute(rows) and dict(df.dtypes)["distance"] == "bigint"
