import time

import numpy as np
import pandas as pd
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from gridcast.plans import attribution


def grown(features, depth, rng, reuse=0.5):
    """Nodes of a random tree whose paths test some features more than once."""
    nodes, open_ = [], [(0, depth, 1000.0, [])]
    names = iter(range(1, 1 << 20))
    while open_:
        n, left, count, path = open_.pop()
        if not left or (left < depth - 1 and rng.random() < 0.15):
            nodes.append((n, -1, -1, -1, 0.0, rng.normal(), count, 1.0))
            continue
        j = int(rng.choice(path)) if path and rng.random() < reuse else int(rng.integers(features))
        l, r, share = next(names), next(names), rng.uniform(0.1, 0.9)
        nodes.append((n, l, r, j, rng.uniform(-1.5, 1.5), 0.0, count, 1.0))
        open_ += [(l, left - 1, count * share, [*path, j]), (r, left - 1, count * (1 - share), [*path, j])]
    return pd.DataFrame(nodes, columns=["id", "left", "right", "feature", "cut", "value", "count", "weight"])


def one_by_one(x, leaves):
    """Shapley values leaf by leaf, from the formula at the head of the module."""
    phi = np.zeros(x.shape)
    for leaf in leaves.itertuples():
        f, z = np.array(leaf.feature, int), np.array(leaf.share)
        if not len(f):
            continue
        points, weights = np.polynomial.legendre.leggauss(len(f))
        t, weights = (points + 1) / 2, weights / 2
        o = ((x[:, f] > np.array(leaf.low)) & (x[:, f] <= np.array(leaf.high))).astype(float)
        factor = z[:, None] * (1 - t) + o[..., None] * t
        for k, j in enumerate(f):
            phi[:, j] += leaf.value * (o[:, k] - z[k]) * (np.delete(factor, k, axis=1).prod(axis=1) @ weights)
    return phi


@pytest.mark.parametrize(("features", "depth", "rows"), [(3, 5, 40), (12, 7, 300), (40, 10, 2000), (2, 0, 5), (5, 1, 7), (4, 6, 1)])
def test_patterns_say_what_the_leaves_say_one_by_one(features, depth, rows):
    rng = np.random.default_rng(depth)
    leaves = pd.concat([attribution._paths((k,), grown(features, depth, rng)) for k in range(2)], ignore_index=True)
    x = np.round(rng.normal(size=(rows, features)), 1)
    groups, base = attribution._by_length(leaves.sample(frac=1, random_state=0))
    phi = attribution._shapley(x, groups)
    assert np.allclose(phi, one_by_one(x, leaves), rtol=0, atol=1e-12)
    assert np.isclose(base, sum(v * np.prod(s) for v, s in zip(leaves["value"], leaves["share"])))


def test_a_tree_of_many_leaves_meets_many_rows():
    rng = np.random.default_rng(1)
    leaves = attribution._paths((0,), grown(30, 13, rng, reuse=0.2))
    x = rng.normal(size=(20_000, 30))
    groups, _ = attribution._by_length(leaves)
    start = time.process_time()
    attribution._shapley(x, groups)
    assert len(leaves) > 700 and time.process_time() - start < 2  # leaf by leaf: 5.3 s


def test_repeated_and_null_ids_keep_their_rows(spark, monkeypatch):
    rng = np.random.default_rng(2)
    leaves = pd.concat([attribution._paths((k,), grown(2, 4, rng)) for k in range(4)], ignore_index=True)
    monkeypatch.setattr(attribution, "leaf_paths", lambda s, path: s.createDataFrame(leaves, attribution.LEAF))
    rows = [("a", 0.5, -0.5), ("a", 0.5, -0.5), (None, 1.0, 0.0), (None, -1.0, 0.2), ("b", 0.0, 0.0)]
    df = spark.createDataFrame(rows, "k string, f double, g double")
    got = attribution.attributions(df, "", ["f", "g"], ["k"], block_leaves=10, block_rows=2)
    parts = sorted((r.k or "", [round(v, 9) for v in r.phi]) for r in got.collect())
    phi = one_by_one(np.array([r[1:] for r in rows]), leaves)
    assert parts == sorted((r[0] or "", [round(v, 9) for v in p]) for r, p in zip(rows, phi))


def test_every_pair_of_blocks_has_a_task(spark, monkeypatch):
    rng = np.random.default_rng(3)
    leaves = attribution._paths((0,), grown(2, 4, rng))
    monkeypatch.setattr(attribution, "leaf_paths", lambda s, path: s.createDataFrame(leaves, attribution.LEAF))

    def explain(ids):
        return lambda rows, found: rows[ids].assign(base=float(TaskContext.get().partitionId()), phi=[[0.0, 0.0]] * len(rows))

    monkeypatch.setattr(attribution, "_explain", explain)
    df = spark.range(900).select("id", F.rand(1).alias("f"), F.rand(2).alias("g"))
    out = attribution.attributions(df, "", ["f", "g"], ["id"], block_rows=100)
    assert sorted(r.base for r in out.select("base").distinct().collect()) == list(range(9)) and out.count() == 900
