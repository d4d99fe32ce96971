import numpy as np
import pytest

from brickyard.operators.density import density_labels, fit_dbscan


def brute(x, eps, least):
    """Textbook DBSCAN; border points take any cluster in reach, so those are returned as sets."""
    near = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1) <= eps * eps
    core = near.sum(1) >= least
    label, n = np.full(len(x), -1), 0
    for i in np.flatnonzero(core):
        if label[i] >= 0:
            continue
        stack = [i]
        while stack:
            j = stack.pop()
            if label[j] >= 0:
                continue
            label[j] = n
            stack += [k for k in np.flatnonzero(near[j] & core) if label[k] < 0]
        n += 1
    return core, label, [set(label[near[i] & core]) for i in range(len(x))]


@pytest.mark.parametrize("d,n,least", [(2, 500, 10), (4, 260, 5)])
def test_against_brute_force(spark, d, n, least):
    rng = np.random.default_rng(d)
    blob = rng.normal(0, 0.25, (n // 2, d))
    x = np.vstack([blob, rng.uniform(-2, 2, (n // 3, d)), np.repeat(rng.uniform(-3, 3, (1, d)), 60, axis=0)]).round(3)
    core, label, reach = brute(x, 0.5, least)
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], ["i"] + [f"f{j}" for j in range(d)])
    out = {r["i"]: r for r in density_labels(df, [f"f{j}" for j in range(d)], 0.5, least).collect()}
    assert len(out) == len(x)
    assert [out[i]["is_core"] for i in range(len(x))] == core.astype(int).tolist()
    mapping = {}
    for i in np.flatnonzero(core):
        assert mapping.setdefault(label[i], out[i]["cluster"]) == out[i]["cluster"]
    assert sorted(mapping.values()) == list(range(label.max() + 1))
    for i in np.flatnonzero(~core):
        assert out[i]["cluster"] == min({mapping[c] for c in reach[i]}, default=-1)


def test_exactly_enough_neighbours(spark):
    df = spark.createDataFrame([(float(i) * 0.05, 0.0) for i in range(10)] + [(50.0, 50.0)] * 9, "price_per_sqft double, building_age double")
    out = {tuple(r[:2]): r["is_core"] for r in density_labels(df, ["price_per_sqft", "building_age"], 0.5, 10).collect()}
    assert out[0.25, 0.0] == 1 and out[50.0, 50.0] == 0
    _, results = fit_dbscan(df)
    assert results["n_clusters"] == 1
