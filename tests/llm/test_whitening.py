from decimal import Decimal

import numpy as np
import pytest

from brickyard.llm import whitening
from brickyard.llm.common import table


def brute(rows):
    """Whitening by the textbook: covariance by products, over Python integers."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    xs = {i: [int(np.floor(64 * float(c))) + 1_000_000 for c in v] for i, v in kept}
    fit = sorted({tuple(x) for x in xs.values()})
    n, dims = len(fit), len(fit[0])
    total = [sum(x[d] for x in fit) for d in range(dims)]
    centred = np.array([[n * x[d] - total[d] for d in range(dims)] for x in fit], object)
    cov = np.array([[float(sum(centred[:, i] * centred[:, j])) / float(n) ** 3 for j in range(dims)] for i in range(dims)])
    deviation = {i: sum((n * c - t) ** 2 for c, t in zip(x, total)) for i, x in xs.items()}
    return xs, n, total, cov, deviation


def check(got, rows, top=16):
    xs, n, total, cov, deviation = brute(rows)
    values = np.linalg.eigvalsh(cov)[::-1]
    assert {r["vec_id"] for r in got} == set(xs)
    by_id = {}
    for r in got:
        by_id.setdefault(r["vec_id"], []).append(r)
        assert (r["n"], r["deviation"], int(r["deviation_exact"])) == (n, deviation[r["vec_id"]], deviation[r["vec_id"]])
        assert r["identity_error"] <= 1e-4
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / np.trace(cov), rel=1e-9)
    k = min(top, len(values))
    assert all(sorted(r["component"] for r in part) == list(range(1, k + 1)) for part in by_id.values())
    w = {i: np.array([r["whitened"] for r in sorted(part, key=lambda r: r["component"])], float) for i, part in by_id.items()}
    distinct = {tuple(x): w[i] for i, x in xs.items()}
    y = np.array(list(distinct.values()))
    x = np.array(list(distinct.keys()), float) - np.array(total, float) / n
    assert np.abs(y.T @ y / n - np.eye(k)).max() < 1e-6
    # the projection's axes are eigenvectors: x'y/n = V u / sqrt(e) = sqrt(e) u
    axes = x.T @ y / n / np.sqrt(values[:k])
    assert np.abs(cov @ axes - axes * values[:k]).max() < 1e-6 * values[0]
    assert np.allclose(np.linalg.norm(axes, axis=0), 1)


def test_given_vectors_equal_the_textbook(spark, sf):
    got = whitening.whiten(table(spark, sf, "embeddings")).collect()
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, sf, "embeddings").collect()]
    check(got, rows)


def test_odd_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(c) for c in rng.normal(0, 1 + i % 3, 5)]) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(40)] + [(0, rows[1][1])]  # copies; a repeated id
    odd = [(200, None), (201, []), (202, [1.0, None, 1.0, 1.0, 1.0]), (203, [float("nan")] * 5), (204, [float("inf")] + [0.0] * 4), (205, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1, 1.0) for i, v in rows + odd], "vec_id long, embedding array<float>, n int, whitened double")
    got = whitening.whiten(df).collect()
    assert sum(r["vec_id"] == 0 for r in got) == 10
    rounded = [(i, [float(np.float32(c)) for c in v]) for i, v in rows]
    check([r for r in got if r["vec_id"]], rounded[1:-1])


def test_small_and_large_values(spark):
    schema = "vec_id long, embedding array<double>"
    empty = whitening.whiten(spark.createDataFrame([], schema))
    assert empty.columns == whitening.whiten(spark.createDataFrame([(1, [0.5, 1.0])], schema)).columns and empty.count() == 0
    one = whitening.whiten(spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 1.0])], schema)).collect()
    assert len(one) == 4 and all(r["whitened"] is None and r["explained"] is None and r["deviation"] == 0 and r["n"] == 1 for r in one)
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), float(-i)]) for i in range(10)], schema)).collect()
    assert all((r["whitened"] is None) == (r["component"] == 2) for r in line)
    large = whitening.whiten(spark.createDataFrame([(i, [float(i) * 2**45, 1.0]) for i in range(3)], schema)).collect()
    assert {(r["vec_id"], r["deviation"], r["deviation_exact"]) for r in large} == {
        (0, None, Decimal((9 * 2**51) ** 2 // 9)), (1, 0, Decimal(0)), (2, None, Decimal((9 * 2**51) ** 2 // 9))}
    with pytest.raises(Exception, match="no exact integer"):
        whitening.whiten(spark.createDataFrame([(1, [2.0**60])], schema)).collect()


def test_a_step_of_sums_is_exact():
    x = np.array([[10**12, 5], [-(10**12), 7], [3, -4]], np.int64) + whitening.SHIFT
    found = whitening.squares(np.array([whitening.SHIFT] * 2, np.int64), x)
    assert int(found["own"][0]) == 2 * 10**24 + 9 and int(found["pair"][0]) == (10**12 + 5) ** 2 + (7 - 10**12) ** 2 + 1
