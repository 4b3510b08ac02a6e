"""PCA and DBSCAN against numpy brute force."""

import numpy as np
import pytest

from orderlake.operators import density, features
from orderlake.plans.q_clustering import _gold_orders
from tests.conftest import SF0001


def brute_dbscan(X, eps, min_samples):
    n = len(X)
    d2 = ((X[:, None, :] - X[None, :, :]) ** 2).sum(-1)
    nb = d2 <= eps * eps
    core = nb.sum(1) >= min_samples
    labels = np.full(n, -1)
    lab = 0
    for i in range(n):
        if labels[i] != -1 or not core[i]:
            continue
        stack = [i]
        labels[i] = lab
        while stack:
            j = stack.pop()
            if core[j]:
                for k in np.nonzero(nb[j])[0]:
                    if labels[k] == -1:
                        labels[k] = lab
                        if core[k]:
                            stack.append(k)
        lab += 1
    return labels, core


@pytest.fixture(scope="module")
def scores(spark):
    return features.order_pca(_gold_orders(spark, SF0001), 3)


def test_pca_matches_numpy(spark, scores):
    feats, sc, fit = scores
    z = features.standardize(feats).orderBy("orderid").toPandas()
    X = z[features.FEATURES].to_numpy()
    cov = np.cov(X, rowvar=False)
    vals, vecs = np.linalg.eigh(cov)
    idx = np.argsort(vals)[::-1][:3]
    ratios = vals[idx] / vals.sum()
    assert np.allclose(fit.ratios, ratios, atol=1e-9)
    proj = X @ vecs[:, idx]
    got = sc.orderBy("orderid").toPandas()[["pca1", "pca2", "pca3"]].to_numpy()
    for i in range(3):  # equal up to the sign of each axis
        assert np.allclose(np.abs(got[:, i]), np.abs(proj[:, i]), atol=1e-7)


@pytest.mark.parametrize("eps,min_samples", [(0.9, 10), (0.3, 5), (0.15, 3)])
def test_dbscan_matches_brute_force(spark, scores, eps, min_samples):
    _, sc, _ = scores
    lab = density.dbscan(sc, "orderid", ["pca1", "pca2", "pca3"], eps, min_samples)
    got = sc.join(lab, "orderid").orderBy("orderid").toPandas()
    X = got[["pca1", "pca2", "pca3"]].to_numpy()
    want, core = brute_dbscan(X, eps, min_samples)
    assert (got["is_core"].to_numpy() == core).all()
    assert (got["cluster"].to_numpy() == want).all()


def test_dbscan_duplicates_and_2d(spark):
    rng = np.random.default_rng(7)
    pts = np.vstack([rng.normal(0, 0.3, (150, 2)), rng.normal(3, 0.3, (120, 2)),
                     np.repeat([[10.0, 10.0]], 40, axis=0), rng.uniform(-5, 15, (60, 2))])
    rows = [(f"{i:04d}", float(x), float(y)) for i, (x, y) in enumerate(pts)]
    df = spark.createDataFrame(rows, "id string, x double, y double")
    lab = density.dbscan(df, "id", ["x", "y"], 0.5, 8).orderBy("id").toPandas()
    want, core = brute_dbscan(pts, 0.5, 8)
    assert (lab["cluster"].to_numpy() == want).all()
    assert (lab["is_core"].to_numpy() == core).all()


def test_dbscan_hot_cell(spark):
    """A third of the points crowd into one grid cell; labels still match brute force."""
    rng = np.random.default_rng(11)
    hot = rng.uniform(0.0, 0.05, (300, 3))                       # one tiny region, one cell
    rest = np.vstack([rng.normal(1.0, 0.25, (300, 3)), rng.uniform(-3, 3, (300, 3))])
    pts = np.vstack([hot, rest])
    rows = [(f"{i:04d}", *map(float, p)) for i, p in enumerate(pts)]
    df = spark.createDataFrame(rows, "id string, x double, y double, z double")
    lab = density.dbscan(df, "id", ["x", "y", "z"], 0.3, 10).orderBy("id").toPandas()
    want, core = brute_dbscan(pts, 0.3, 10)
    assert (lab["cluster"].to_numpy() == want).all()
    assert (lab["is_core"].to_numpy() == core).all()
