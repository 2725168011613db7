"""Whitening against numpy on the distinct vectors."""

import math

import numpy as np
import pytest

from driftwell.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, weight double, component string, w int"


def frame(spark, vectors, ids=None, kind="float"):
    ids = range(len(vectors)) if ids is None else ids
    schema = SCHEMA.replace("array<float>", f"array<{kind}>")
    return spark.createDataFrame([(i, v, 1, "x", 1.0, "c", 0) for i, v in zip(ids, vectors)], schema)


def sound(v):
    return bool(v) and all(c is not None and math.isfinite(c) for c in v)


def brute(vectors, weights="one", components=4):
    """Per kept vector: n, deviation, whitened by component, explained; and the identity error."""
    x = [tuple(math.floor(256 * float(c)) for c in v) for v in vectors]
    distinct = sorted(set(x))
    weight = np.array([x.count(v) if weights == "counts" else 1 for v in distinct])
    n = int(weight.sum())
    sums = [sum(int(w) * v[i] for w, v in zip(weight, distinct)) for i in range(len(x[0]))]
    centred = np.array([[v[i] - sums[i] / n for i in range(len(v))] for v in distinct])
    e, axes = np.linalg.eigh((centred * weight[:, None]).T @ centred / n)
    order = np.argsort(-e)[:components]
    white = centred @ axes[:, order] / np.sqrt(np.maximum(e[order], 1e-300))
    at = {v: i for i, v in enumerate(distinct)}
    deviation = [sum((n * v[i] - sums[i]) ** 2 for i in range(len(v))) for v in x]
    return n, deviation, np.array([white[at[v]] for v in x]), e[order] / e.sum()


def check(found, vectors, ids, weights="one"):
    n, deviation, white, explained = brute(vectors, weights)
    width = white.shape[1]
    assert len(found) == len(vectors) * width
    by = {(r["vec_id"], r["component"]): r for r in found}
    for c in range(width):
        got = np.array([by[i, c + 1]["whitened"] for i in ids])
        sign = np.sign(got @ white[:, c])
        assert np.allclose(got, sign * white[:, c], atol=1e-8)
    for i, d in zip(ids, deviation):
        for c in range(width):
            row = by[i, c + 1]
            assert (row["n"], row["deviation"]) == (n, d)
            assert math.isclose(row["explained"], explained[c], rel_tol=1e-9)
            assert row["identity_error"] < 1e-9
    return by


@pytest.mark.parametrize("weights", ["one", "counts"])
def test_agrees_with_numpy(spark, weights):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(300, 6)) * [3, 2, 1.5, 1, 0.5, 0.2]).astype(np.float32).tolist()
    vectors += [vectors[0]] * 200 + [[c + 1e-6 for c in vectors[1]]] * 5
    bad = [None, [], [1.0, None, 0.0, 0.0, 0.0, 0.0], [float("nan")] * 6, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0], [1.0, 2.0]]
    rows = frame(spark, vectors + bad).repartition(5)
    found = whitening.whiten_embeddings(rows, weights=weights).collect()
    exact = [list(map(float, np.float32(v))) for v in vectors]
    check(found, exact, range(len(vectors)), weights)


def test_buckets_add_up_the_same(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(500, 5)).astype(np.float32).tolist()
    rows = frame(spark, vectors).repartition(70)
    check(whitening.whiten_embeddings(rows).collect(), vectors, range(500))


def test_large_entries_stay_exact(spark):
    """Sums beyond 64 bits are whole numbers still; a deviation that needs more is null."""
    vectors = [[1e12, 3.0], [-1e12, 1.0], [5.0, 2.0], [7.0, -3.0]]
    found = whitening.whiten_embeddings(frame(spark, vectors, kind="double")).collect()
    _, deviation, _, _ = brute(vectors)
    assert max(deviation) > 2**63
    assert {r["deviation"] for r in found if r["vec_id"] == 0} == {None}
    huge = frame(spark, [[1e300], [-1e300], [0.0]], kind="double")
    assert whitening.whiten_embeddings(huge).count() == 3


def test_vectors_without_variance(spark):
    rows = frame(spark, [[1.0, 2.0]] * 3 + [None])
    found = whitening.whiten_embeddings(rows).collect()
    assert {(r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in found} == {
        (1, 1, 0, None, None, None),
        (2, 1, 0, None, None, None),
    }
    # On a line: one component has all of the variance, the other none.
    line = whitening.whiten_embeddings(frame(spark, [[float(i), float(i)] for i in range(9)])).collect()
    first = [r for r in line if r["component"] == 1]
    assert all(math.isclose(r["explained"], 1.0) and r["identity_error"] < 1e-9 for r in first)
    assert {r["whitened"] for r in line if r["component"] == 2} == {None}


def test_empty_null_ids_and_repeats(spark):
    assert whitening.whiten_embeddings(frame(spark, [])).count() == 0
    assert whitening.whiten_embeddings(frame(spark, [None, []])).count() == 0
    repeated = frame(spark, [[1.0, 0.0], [1.0, 0.0], [0.0, 3.0], [2.0, 2.0]], [None, None, 5, 5])
    assert whitening.whiten_embeddings(repeated).count() == 8


def test_more_components_than_asked_dimensions(spark):
    rng = np.random.default_rng(6)
    rows = frame(spark, rng.normal(size=(50, 3)).astype(np.float32).tolist())
    assert {r["component"] for r in whitening.whiten_embeddings(rows).collect()} == {1, 2, 3}
