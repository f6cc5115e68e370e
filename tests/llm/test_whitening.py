"""Whitening against whole-number arithmetic of numpy and Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from notewarden.llm import whitening

EMB = "vec_id bigint, embedding array<float>, label int"


def brute(vectors):
    """n, S, V and deviations of the usable vectors, all exact but V."""
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors]
    n, total = len(x), [sum(c) for c in zip(*x, strict=True)]
    off = [[n * c - s for c, s in zip(row, total, strict=True)] for row in x]
    d = range(len(total))
    cov = [[sum(row[i] * row[j] for row in off) for j in d] for i in d]
    return n, total, cov, [sum(c * c for c in row) for row in off]


def usable(v):
    return bool(v) and all(c is not None and math.isfinite(c) for c in v)


def vectors(n, dim, seed=3):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, dim)) @ rng.normal(size=(dim, dim)) * 0.1 + rng.normal(size=dim)).astype(np.float32).tolist()


def test_op11(spark):
    odd = [None, [], [None] * 12, [0.1] * 11 + [float("nan")], [float("inf")] + [0.5] * 11, [0.25] * 5, [0.25] * 5]
    rows = [(i, v, 0) for i, v in enumerate([*vectors(300, 12), *odd])] + [(None, v, 1) for v in vectors(3, 12, 4)] + [(7, vectors(300, 12)[7], 1)] * 3
    df = spark.createDataFrame(rows, EMB).repartition(5)
    good = [(i, v) for i, v, _ in rows if usable(v) and len(v) == 12]
    n, total, cov, deviation = brute([v for _, v in good])
    got = whitening.op11(df).toPandas()
    assert len(got) == 8 * n and set(got.n) == {n} and sorted(got.vec_id.dropna().astype(int).unique()) == sorted({i for i, _ in good if i is not None})
    assert sorted(got[got.component == 3].deviation) == sorted(deviation)
    v = np.array([[c / n**3 for c in row] for row in cov])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u.T[::-1]
    mean = np.array([s / n for s in total])
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in w] for _, w in good])
    for k in range(8):
        mine = got[got.component == k + 1].sort_values("whitened")
        want = (x - mean) @ u[k] / np.sqrt(e[k])
        assert min(np.abs(np.sort(s * want) - mine.whitened.to_numpy()).max() for s in (1, -1)) < 1e-9
        assert abs(mine.explained.iloc[0] - e[k] / np.trace(v)) < 1e-12
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9
    model = whitening.fit(df, "embedding")
    by_id = {r.vec_id: r for r in whitening.whiten(df.withColumn("whitening", F.lit(1)), model, "embedding").collect()}
    assert by_id[5].label == 0 and by_id[5].embedding == pytest.approx(rows[5][1])
    assert by_id[5].whitening.deviation == dict(zip((i for i, _ in good), deviation, strict=True))[5]


def test_exact_covariance(spark):
    """Differences of squares give every cross-covariance to the last digit, at any size of entry."""
    rng = random.Random(5)
    for size in (1.0, 1e6, 1e12, 1e25):
        many = [[rng.uniform(-size, size) for _ in range(4)] for _ in range(20)]
        df = spark.createDataFrame([(i, v) for i, v in enumerate(many)], "vec_id bigint, embedding array<double>").repartition(3)
        held = [[max(min(c, 2.0**53 - 98), -(2.0**53)) for c in v] for v in many]
        n, total, cov, deviation = brute(held)
        if size == 1e25:  # held at the ends of 64 bits
            assert whitening.op11(df).count() == 80
            continue
        assert whitening.covariance(df, "embedding") == (n, total, cov)
        rows = whitening.op11(df).where("component = 1").collect()
        assert {r.vec_id: r.deviation for r in rows} == {i: d if d < 1 << 63 else None for i, d in enumerate(deviation)}


def test_op11_degenerate(spark):
    none = spark.createDataFrame([], EMB)
    assert whitening.op11(none).count() == 0
    assert whitening.op11(spark.createDataFrame([(1, None, 0), (2, [], 0)], EMB)).count() == 0
    one = whitening.op11(spark.createDataFrame([(1, [0.5, 0.25], 0)], EMB)).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 1, 0, None, None, None), (2, 1, 0, None, None, None)]
    flat = whitening.op11(spark.createDataFrame([(i, [0.5 * i, 1.0], 0) for i in range(4)], EMB)).collect()
    assert {(r.component, r.whitened is None) for r in flat} == {(1, False), (2, True)} and flat[0].identity_error < 1e-12
    tie = whitening.op11(spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0], 0)], EMB)).collect()
    assert {r.vec_id for r in tie} == {1}
