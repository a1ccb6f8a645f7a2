"""Which features moved a prediction, and by how much (path-dependent Shapley values of trees).

A tree predicts by adding up its leaves. For one leaf, let every feature j on its path have
o_j (the row meets all the path's conditions on j: 0 or 1) and z_j (the share of training rows
that follow the path through the splits on j). The leaf's Shapley value for feature i is

    v * (o_i - z_i) * integral over t in [0, 1] of  product over j != i of (z_j (1 - t) + o_j t),

a polynomial in t, which Gauss-Legendre nodes integrate exactly. The saved model is read as a
table: executors turn each tree into leaf paths, and blocks of leaves meet blocks of rows, both
of bounded size. No node reaches the driver.

The leaves of a small subtree (a bunch) share the conditions above it. Rows that meet the same
conditions of a bunch get the same values from it, so these are computed once per such pattern
that occurs, and a row looks up one number per feature and bunch instead of one per leaf and node.
"""

from __future__ import annotations

import json
import sys
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast.names import KEYS, TS, VALUE_TARGET
from gridcast.operators.dedup import latest_per_key
from gridcast.operators.sampling import sample_rows
from gridcast.plans.scoring import active_records, aligned_features
from gridcast.session import stage

# Executors get this module's code with the task and need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Leaves and rows that meet in one task, about; leaves of a bunch, at most.
BLOCK_LEAVES, BLOCK_ROWS = 60_000, 65_536
BUNCH_LEAVES = 10

#: A leaf: its bunch in the tree, the features its path tests, the ends of their intervals (low < x <= high), their shares, its value.
LEAF = "tree int, bunch int, feature array<int>, low array<double>, high array<double>, share array<double>, value double"


class Bunch(NamedTuple):
    """Leaves of a subtree. What all paths share: features, ends, shares (each of length d), in the order of the path.
    The others: features (k), ends and shares (each of shape (leaves, k); a feature that a path does not test has the whole
    line and share 1). Values (leaves). Quadrature points that the longest path needs."""

    above: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    below: np.ndarray
    lows: np.ndarray
    highs: np.ndarray
    shares: np.ndarray
    value: np.ndarray
    points: int


def _paths(key: tuple, nodes: pd.DataFrame) -> pd.DataFrame:
    """The leaves of one tree; nodes of (id, left, right, feature, cut, value, count, weight)."""
    at = {int(n): i for i, n in enumerate(nodes["id"])}
    left, right, feature = (nodes[c].to_numpy() for c in ("left", "right", "feature"))
    cut, value, count = (nodes[c].to_numpy() for c in ("cut", "value", "count"))
    weight, out = nodes["weight"].iloc[0], []
    order, leaves = [at[0]], np.ones(len(nodes), int)
    for n in order:
        if left[n] >= 0:
            order += [at[left[n]], at[right[n]]]
    for n in reversed(order):
        if left[n] >= 0:
            leaves[n] = leaves[at[left[n]]] + leaves[at[right[n]]]
    bunch, open_ = -1, [(at[0], {}, False)]
    while open_:
        n, path, inside = open_.pop()
        if not inside and leaves[n] <= BUNCH_LEAVES:
            bunch, inside = bunch + 1, True
        if left[n] < 0:
            low, high, share = (list(x) for x in zip(*path.values())) if path else ([], [], [])
            out.append((key[0], bunch, list(path), low, high, share, value[n] * weight))
            continue
        j = int(feature[n])
        low, high, share = path.get(j, (-np.inf, np.inf, 1.0))
        l, r = at[left[n]], at[right[n]]
        open_ += [(l, {**path, j: (low, min(high, cut[n]), share * count[l] / count[n])}, inside),
                  (r, {**path, j: (max(low, cut[n]), high, share * count[r] / count[n])}, inside)]
    return pd.DataFrame(out, columns=["tree", "bunch", "feature", "low", "high", "share", "value"])


def leaf_paths(spark: SparkSession, model_path: str) -> DataFrame:
    """The leaves of a saved ensemble as a table; values times the weights of their trees. A task holds one tree."""
    last = json.loads(spark.read.text(f"{model_path}/metadata").first()[0])["paramMap"]["stageUids"][-1]
    folder = f"{model_path}/stages/*_{last}"
    averaged = "RandomForest" in json.loads(spark.read.text(f"{folder}/metadata").first()[0])["class"]
    trees = spark.read.parquet(f"{folder}/treesMetadata").select(F.col("_1").alias("tree"), F.col("_3").alias("weight"))
    if averaged:
        trees = trees.withColumn("weight", F.lit(1.0 / trees.count()))
    node, split = F.col("nodeData"), F.col("nodeData.split")
    nodes = spark.read.parquet(f"{folder}/data").select(
        F.col("treeID").cast("int").alias("tree"), node["id"].alias("id"), node["leftChild"].alias("left"), node["rightChild"].alias("right"),
        split["featureIndex"].alias("feature"), F.get(split["leftCategoriesOrThreshold"], F.lit(0)).alias("cut"),
        node["prediction"].alias("value"), node["rawCount"].cast("double").alias("count"))
    return nodes.join(trees, "tree").groupBy("tree").applyInPandas(_paths, LEAF)


def _bunch(feature: np.ndarray, ends: np.ndarray, leaf: np.ndarray, value: np.ndarray) -> Bunch:
    """Of the steps of the leaves' paths (feature; low, high, share; number of the leaf)."""
    names, at = np.unique(feature, return_inverse=True)
    table = np.empty((3, len(value), len(names)))
    table[0], table[1], table[2] = -np.inf, np.inf, 1.0
    table[:, leaf, at] = ends
    shared = (table == table[:, :1]).all((0, 1))
    first = at[:np.searchsorted(leaf, 1)]
    above = first[shared[first]]
    own = np.flatnonzero(~shared)
    return Bunch(names[above], *table[:, 0, above], names[own], *table[:, :, own], value, (int(np.bincount(leaf).max()) + 1) // 2)


def _by_length(leaves: pd.DataFrame) -> tuple[list[Bunch], float]:
    """Leaves by bunch, and the part of the prediction that no feature moves."""
    leaves = leaves.sort_values(["tree", "bunch"], kind="stable")
    length = leaves["feature"].map(len).to_numpy(int)
    value = leaves["value"].to_numpy()
    base = float(value[length == 0].sum())
    leaves, value, length = leaves[length > 0], value[length > 0], length[length > 0]
    if not len(leaves):
        return [], base
    feature = np.concatenate(leaves["feature"].to_numpy())
    ends = np.stack([np.concatenate(leaves[c].to_numpy()) for c in ("low", "high", "share")])
    start = np.cumsum(length) - length
    base += float(value @ np.multiply.reduceat(ends[2], start))
    tree, bunch = leaves["tree"].to_numpy(), leaves["bunch"].to_numpy()
    first = np.flatnonzero(np.r_[True, (tree[1:] != tree[:-1]) | (bunch[1:] != bunch[:-1])])
    step, groups = np.r_[start, len(feature)], []
    for a, b in zip(first, np.r_[first[1:], len(leaves)]):
        steps = slice(step[a], step[b])
        groups.append(_bunch(feature[steps], ends[:, steps], np.repeat(np.arange(b - a), length[a:b]), value[a:b]))
    return groups, base


def _quadrature(points: int) -> tuple[np.ndarray, np.ndarray]:
    """Points and weights on [0, 1]."""
    t, weight = np.polynomial.legendre.leggauss(points)
    return (t + 1) / 2, weight / 2


def _numbered(code: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The codes (below size) that occur, in order, and the place of every row's code among them."""
    if size > 4 * len(code) + 1024:
        return np.unique(code, return_inverse=True)
    seen = np.zeros(size, bool)
    seen[code] = True
    found = np.flatnonzero(seen)
    place = np.empty(size, np.int32)
    place[found] = np.arange(len(found), dtype=np.int32)
    return found, place.take(code)


class _Patterns:
    """Numbers the rows of x by the conditions they meet. Conditions that a list begins with like the last list are not tested again."""

    def __init__(self, x: np.ndarray) -> None:
        self.x, self.last, self.most = x, [], 2 * x.shape[1] + 1024

    def of(self, tests: list[tuple[int, float, float]]) -> tuple[np.ndarray, np.ndarray]:
        """A row of every pattern of low < x <= high, and the number of each row's pattern."""
        keep = 0
        while keep < min(len(tests), len(self.last)) and tests[keep] == self.last[keep][0]:
            keep += 1
        del self.last[keep:]
        for test in tests[keep:]:
            code, size = self.last[-1][1:] if self.last else (np.zeros(self.x.shape[1], np.int32), 1)
            if 2 * size > self.most:
                found, code = _numbered(code, size)
                size = len(found)
            j, low, high = test
            met = self.x[j] <= high
            if low > -np.inf:
                met &= self.x[j] > low
            self.last.append((test, code + met * np.int32(size), 2 * size))
        found, number = _numbered(*self.last[-1][1:]) if tests else (np.zeros(1), np.zeros(self.x.shape[1], np.int32))
        row = np.empty(len(found), np.intp)
        row[number] = np.arange(len(number))
        return row, number


def _shapley(x: np.ndarray, groups: list[Bunch]) -> np.ndarray:
    """Shapley values of the rows of x, one column per feature."""
    # As in the trees: a value that is not below a cut goes right, NaN too.
    x = np.ascontiguousarray(np.nan_to_num(x.T, nan=np.finfo(float).max))
    phi = np.zeros(x.shape)
    if not x.shape[1]:
        return phi.T
    rules = {n: _quadrature(n) for n in {g.points for g in groups}}
    upper, lower, out = _Patterns(x), _Patterns(x), np.empty(x.shape[1])
    for g in groups:
        t, weight = rules[g.points]
        up, u = upper.of(list(zip(g.above.tolist(), g.low.tolist(), g.high.tolist())))
        cuts = {(j, c) for j, ends in zip(g.below.tolist(), np.concatenate([g.lows, g.highs]).T.tolist()) for c in ends if abs(c) < np.inf}
        down, d = lower.of([(j, -np.inf, c) for j, c in sorted(cuts)])
        pairs, number = _numbered(u * np.int64(len(down)) + d, len(up) * len(down))
        number = number.astype(np.intp)
        u, d = np.divmod(pairs, len(down))

        # What the shared conditions say: met or not, and their factor at every point.
        seen = x[g.above[:, None], up]
        met = (seen > g.low[:, None]) & (seen <= g.high[:, None])
        unmet = g.share[:, None] * (1 - t)
        factor = np.broadcast_to(weight, (len(up), len(t)))
        for m, by in zip(met, np.stack([unmet, unmet + t], axis=1)):
            factor = factor * by.take(m, axis=0)
        factor = factor.take(u, axis=0)

        # What the leaves say, of shape (leaves, features, patterns, points).
        seen = x[g.below[:, None], down]
        inside = ((seen > g.lows[..., None]) & (seen <= g.highs[..., None])).astype(float)[..., None]
        z = g.shares[..., None, None]
        step = z * (1 - t) + inside * t
        leaf = g.value[:, None, None] * step.prod(axis=1)
        moved = (leaf[:, None] * ((inside - z) / step)).sum(axis=0)

        # A condition that is not met counts the same whichever it is.
        ratios = np.concatenate([-1 / (1 - t)[None], (1 - g.share[:, None]) / (unmet + t)])
        parts = ratios @ (factor * leaf.sum(axis=0).take(d, axis=0)).T
        parts[1:] = np.where(met.take(u, axis=1), parts[1:], parts[0])
        for j, part in zip(g.above, parts[1:]):
            phi[j] += part.take(number, out=out, mode="clip")
        for j, by in zip(g.below, moved):
            phi[j] += np.einsum("ij,ij->i", factor, by.take(d, axis=0)).take(number, out=out, mode="clip")
    return np.ascontiguousarray(phi.T)


def _explain(ids: list[str]):
    """Cogroup of a block of rows and a block of leaves: base and phi as far as these leaves go."""
    def run(rows: pd.DataFrame, leaves: pd.DataFrame) -> pd.DataFrame:
        groups, base = _by_length(leaves)
        phi = _shapley(np.stack(rows["x"].to_numpy()).astype(float), groups) if len(rows) else []
        return rows[ids].assign(base=base, phi=list(phi))

    return run


def attributions(df: DataFrame, model_path: str, features: list[str], ids: list[str], block_leaves: int = BLOCK_LEAVES,
                 block_rows: int = BLOCK_ROWS) -> DataFrame:
    """ids, base, phi (one value per feature) for every row; base + sum(phi) is the prediction.

    Rows and trees are dealt into blocks; every block of rows meets every block of trees once, and what the blocks
    of trees say about a row is added up.
    """
    spark = df.sparkSession
    leaves = stage(leaf_paths(spark, model_path), "leaves")
    slim = stage(df.select(*ids, F.monotonically_increasing_id().alias("_row"),
                           F.array(*[F.col(f).cast("double") for f in features]).alias("x")), "explained")
    packs, parts = max(1, -(-leaves.count() // block_leaves)), max(1, -(-slim.count() // block_rows))

    def pair(part, pack):
        return (part * packs + pack).cast("int")

    def numbers(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    # A task for each pair of blocks: by hash several pairs would meet in one and the others wait.
    left = slim.withColumns({"_part": F.pmod(F.xxhash64("_row"), F.lit(parts)), "_pack": numbers(packs)})
    right = leaves.withColumns({"_part": numbers(parts), "_pack": F.pmod("tree", F.lit(packs))})
    left, right = (d.select("*", pair(F.col("_part"), F.col("_pack")).alias("_pair")).drop("_part", "_pack")
                   .repartitionById(parts * packs, "_pair") for d in (left, right))
    schema = T.StructType([slim.schema[i] for i in [*ids, "_row"]]
                          + [T.StructField("base", T.DoubleType()), T.StructField("phi", T.ArrayType(T.DoubleType()))])
    partial = (left.groupBy("_pair").cogroup(right.groupBy("_pair"))
               .applyInPandas(_explain([*ids, "_row"]), schema))
    if packs == 1:
        return partial.drop("_row")
    sums = partial.groupBy("_row", *ids).agg(F.sum("base").alias("base"), *[
        F.sum(F.col("phi")[i]).alias(f"_p{i}") for i in range(len(features))])
    return sums.select(*ids, "base", F.array(*[f"_p{i}" for i in range(len(features))]).alias("phi"))


def regression_record(registry: DataFrame, target: str = VALUE_TARGET) -> Row:
    found = active_records(registry.where(F.col("task_type") == "regression"), [target])
    if target not in found:
        raise ValueError(f"no active regression model for {target}")
    return found[target]


def global_attribution(cleaned: DataFrame, registry: DataFrame, target: str = VALUE_TARGET, top: int = 15,
                       sample: int | None = None, keys: list[str] = KEYS, ts: str = TS) -> DataFrame:
    """Features by mean |phi| over all rows, or over a sample of rows."""
    record = regression_record(registry, target)
    rows = cleaned if sample is None else sample_rows(cleaned, sample, [*keys, ts])
    phi = attributions(aligned_features(rows, record.features), record.model_path, record.features, [*keys, ts])
    means = phi.agg(*[F.avg(F.abs(F.col("phi")[i])).alias(f) for i, f in enumerate(record.features)])
    return means.unpivot([], record.features, "feature", "importance").orderBy(
        F.col("importance").desc(), "feature").limit(top)


def local_attribution(cleaned: DataFrame, registry: DataFrame, target: str = VALUE_TARGET, top: int | None = None,
                      fill_missing: float | None = None, keys: list[str] = KEYS, ts: str = TS) -> DataFrame:
    """The newest row of every key: base value, prediction and phi per feature, largest first."""
    record = regression_record(registry, target)
    rows = aligned_features(latest_per_key(cleaned, keys, ts), record.features, fill_missing)
    phi = attributions(rows, record.model_path, record.features, [*keys, ts])
    names = F.array(*[F.lit(f) for f in record.features])
    pairs = F.transform(F.arrays_zip(names.alias("feature"), F.col("phi").alias("value")),
                        lambda p: F.struct(F.abs(p["value"]).alias("size"), p["feature"].alias("feature"),
                                           p["value"].alias("value")))
    ordered = F.reverse(F.array_sort(pairs))
    if top:
        ordered = F.slice(ordered, 1, top)
    answer = F.col("base") + F.aggregate("phi", F.lit(0.0), lambda a, v: a + v)
    return (phi.select(*keys, ts, F.col("base").alias("base_value"), answer.alias("prediction"),
                       F.posexplode(ordered).alias("place", "p"))
            .select(*keys, ts, "base_value", "prediction", (F.col("place") + 1).alias("place"),
                    F.col("p.feature").alias("feature"), F.col("p.value").alias("shap_value"),
                    F.lit(record.model_name).alias("model_name"), F.lit(record.trained_at).alias("trained_at")))
