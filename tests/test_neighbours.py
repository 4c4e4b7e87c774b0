"""Neighbour searches and clusters of dense clouds against plain versions; pairs must not reach the disk."""

import contextlib
import os
import threading
import time

import numpy as np
import pandas as pd
import pytest

from stratacloud.operators import clouds, clustering, facades, meshes, spatial

#: A cloud of so many points in reach of each other has 9 million pairs.
DENSE = 3000


def table(spark, p, **more):
    return spark.createDataFrame(pd.DataFrame({"pid": range(len(p)), "x": p[:, 0], "y": p[:, 1], "z": p[:, 2], **more}))


@pytest.fixture
def disk_mb(spark):
    """Most MB that shuffles, spills and checkpoints have taken at once; sorts spill at 200,000 rows meanwhile."""
    env, rows = spark._jvm.org.apache.spark.SparkEnv.get(), "spark.shuffle.spill.numElementsForceSpillThreshold"
    folders = [str(d) for d in env.blockManager().diskBlockManager().localDirs()] + [spark.conf.get("spark.checkpoint.dir").removeprefix("file:")]

    def taken():
        total = 0
        for folder in folders:
            for d, _, files in os.walk(folder):
                for f in files:
                    with contextlib.suppress(OSError):
                        total += os.path.getsize(os.path.join(d, f))
        return total / 1e6

    before, most, ended = taken(), [0.0], threading.Event()

    def watch():
        while not ended.wait(0.05):
            most[0] = max(most[0], taken() - before)

    watcher = threading.Thread(target=watch)
    env.conf().set(rows, "200000")
    watcher.start()
    yield lambda: max(most[0], taken() - before)
    ended.set()
    watcher.join()
    env.conf().remove(rows)


def plain(q, p, k, same):
    d2 = ((q[:, None] - p[None]) ** 2)[..., 0] + ((q[:, None] - p[None]) ** 2)[..., 1] + ((q[:, None] - p[None]) ** 2)[..., 2]
    if same:
        np.fill_diagonal(d2, np.inf)
    order = np.lexsort((np.broadcast_to(np.arange(len(p)), d2.shape), d2))[:, :k]
    return order, np.take_along_axis(d2, order, 1)


def dense():
    return np.random.default_rng(5).uniform(0.01, 0.99, size=(DENSE, 3))


def test_nearest_of_a_dense_cloud(spark, disk_mb):
    p = dense()
    got = spatial.nearest(table(spark, p), table(spark, p), 5, 1.0, same=True).toPandas().sort_values(["qid", "rank"])
    assert disk_mb() < 10
    assert (got["pid"].to_numpy().reshape(-1, 5) == plain(p, p, 5, True)[0]).all()


def test_nearest_frees_its_first_round(spark):
    folders = [str(d) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    shuffled = lambda: {os.path.join(d, f) for folder in folders for d, _, files in os.walk(folder) for f in files if f.startswith("shuffle_")}
    p, before = dense(), shuffled()
    got = spatial.nearest(table(spark, p), table(spark, p), 5, 1.0, same=True)  # the first round has run, the second hasn't
    ends = time.monotonic() + 10
    while (left := sum(os.path.getsize(f) for f in shuffled() - before if os.path.exists(f))) > 50_000 and time.monotonic() < ends:
        time.sleep(0.1)
    assert left <= 50_000
    assert (got.toPandas().sort_values(["qid", "rank"])["pid"].to_numpy().reshape(-1, 5) == plain(p, p, 5, True)[0]).all()


@pytest.mark.parametrize("same", [True, False])
def test_nearest_with_ties_copies_and_few_points(spark, same):
    rng = np.random.default_rng(1)
    lattice = np.stack(np.meshgrid(*[np.arange(14.0)] * 3), -1).reshape(-1, 3)
    for p, k in ((np.concatenate([lattice, np.repeat([[3.0, 3.0, 3.0]], 300, axis=0), rng.normal(0, 1e3, size=(20, 3))]), 20), (rng.normal(size=(7, 3)), 20), (np.zeros((5, 3)), 2)):
        p = p[rng.permutation(len(p))]
        got = spatial.nearest(table(spark, p), table(spark, p), k, 0.15, same=same).toPandas().sort_values(["qid", "rank"])
        want = plain(p, p, min(k, len(p) - same), same)[0]
        assert got["pid"].tolist() == want.ravel().tolist()


def test_nearest_leaves_out_rows_without_a_place(spark):
    cloud = spark.createDataFrame([(1, 0.0, 0.0, 0.0), (2, 1.0, 0.0, 0.0), (3, None, 0.0, 0.0), (4, float("nan"), 0.0, 0.0)], "pid long, x double, y double, z double")
    assert sorted((r.qid, r.pid) for r in spatial.nearest(cloud, cloud, 2, 1.0, same=True).collect()) == [(1, 2), (2, 1)]
    assert spatial.nearest(cloud, cloud.filter("pid > 9"), 2, 1.0).count() == 0


def test_outliers_of_a_dense_cloud(spark, disk_mb):
    p = np.concatenate([dense(), [[9.0, 9.0, 9.0]]])
    c = table(spark, p)
    got = clouds.outliers(spatial.nearest(c, c, 20, 1.0, same=True)).toPandas().sort_values("pid")
    assert disk_mb() < 10
    means = np.sqrt(plain(p, p, 20, True)[1]).mean(axis=1)
    assert np.allclose(got["mean_distance"], means) and (got["outlier"].to_numpy() == (means > means.mean() + 2 * means.std(ddof=1))).all()


def test_spread_values_of_a_dense_cloud(spark, disk_mb):
    p = dense()
    values = np.arange(DENSE) % 7.0
    got = facades.spread_values(table(spark, p + 0.05), table(spark, p, value=values), 3, 1.0).toPandas().sort_values("pid")
    assert disk_mb() < 10
    order, d2 = plain(p + 0.05, p, 3, False)
    w = 1 / (np.sqrt(d2) + 1e-8)
    assert np.allclose(got["value"], (w * values[order]).sum(axis=1) / w.sum(axis=1))


def test_spacing_of_a_dense_cloud(spark, disk_mb):
    p = dense()
    got = meshes.spacing(table(spark, p), 1.0).first().spacing
    assert disk_mb() < 10
    assert np.isclose(got, np.median(np.sqrt(plain(p, p, 1, True)[1])))


def plain_dbscan(p, eps, least):
    near = ((p[:, None] - p[None]) ** 2).sum(axis=2) <= eps * eps
    core = near.sum(axis=1) >= least
    label = np.where(core, np.arange(len(p)), len(p))
    while True:
        step = np.where(core, np.where(near & core, label, len(p)).min(axis=1), len(p))
        if (step == label).all():
            break
        label = step
    label = np.where(core, label, np.where(near & core, label, len(p)).min(axis=1))
    return np.where(label == len(p), -1, label)


def test_dbscan_of_a_dense_cloud(spark, disk_mb):
    p = dense()
    labels = clustering.dbscan(table(spark, p), 2.0, 5).toPandas()
    assert disk_mb() < 10
    assert len(labels) == DENSE and set(labels["label"]) == {0}


def test_dbscan_of_several_densities(spark):
    rng = np.random.default_rng(3)
    around = lambda n, at, s: rng.normal(at, s, size=(n, 3))
    # thin and dense parts, a gap of a little less and a little more than eps between dense ones, copies, noise
    p = np.concatenate([around(300, 0, 0.25), around(200, 2, 0.02), around(200, [2.2, 2, 2], 0.02), np.repeat([[5.0, 5, 5]], 50, axis=0), np.repeat([[5.0, 5, 5.07]], 3, axis=0), rng.uniform(-2, 4, size=(100, 3))])
    p = p[rng.permutation(len(p))]
    for eps, least in ((0.1, 5), (0.15, 3), (0.3, 12)):
        got = clustering.dbscan(table(spark, p), eps, least).toPandas().sort_values("pid")
        assert got["label"].tolist() == plain_dbscan(p, eps, least).tolist()


def test_dbscan_keeps_rows_without_a_place_as_noise(spark):
    cloud = spark.createDataFrame([(1, 0.0, 0.0, 0.0), (2, 0.1, 0.0, 0.0), (3, None, 0.0, 0.0), (4, float("nan"), 0.0, 0.0)], "pid long, x double, y double, z double")
    assert {r.pid: r.label for r in clustering.dbscan(cloud, 0.2, 2).collect()} == {1: 1, 2: 1, 3: -1, 4: -1}
