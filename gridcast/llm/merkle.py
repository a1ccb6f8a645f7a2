"""Merkle manifest of a dataset: a digest per row, a tree per group, a root over all, and proofs.

A row's leaf is the digest of its fields, each as its length in bytes and its value. The leaves of a group, in the
order of their ids, form a tree in which every `FANOUT` successive nodes become the digest of their digests, until
one is left; the groups' roots, in the order of the groups, form the tree above in the same way. A proof lists the
siblings met on the way from a leaf to the root.

1. Leaves are made by Spark's own functions, then only digests and ids move. A range sort gives each leaf its place.
2. FANOUT ** LEVELS successive leaves are a superblock. Each is reduced to one node; the levels above, a small share
   of the rows, are grouped eight by eight level by level, and every run of siblings is kept.
3. Subtree exchange: each superblock is told the runs on its way to the root (its outer nodes). Leaves and outer nodes
   are cogrouped by superblock; the task builds the local levels again, joins local and outer siblings into proofs
   and folds every leaf, or the leaf that is claimed in its place, up to the root.

Ids travel as text, which holds null ids too. No task holds more than a superblock and one run per level, whatever the size of a group.

Defined cases. Null in a field: `-`. Null group: a tree of its own, the first. Null id: before all others. Equal ids:
ordered by leaf; fully repeated rows have equal leaves at successive places. One row: its leaf is the root, its proof
the digest of nothing. Empty table: empty result. Long texts are hashed whole. Columns other than the fields are not
read.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from gridcast.llm.ranking import ranked
from gridcast.llm.tables import passing, stage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT_BITS = 3
FANOUT = 1 << FANOUT_BITS
#: Levels inside a superblock.
LEVELS = 3

_STEPS = "tree string, block long, step int, at int, run array<string>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(fields: list[Column]) -> Column:
    """Digest of the fields: each `-`, or the length of its value in bytes, `:` and the value."""
    def written(c: Column) -> Column:
        value = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*map(written, fields)).cast("binary"), 256)


def _joined(run: str) -> Column:
    return F.sha2(F.array_join(run, "").cast("binary"), 256)


def _levels(nodes: list[str], depth: int) -> list[list[str]]:
    """The nodes, and `depth` levels above them."""
    out = [nodes]
    for _ in range(depth):
        out.append([digest("".join(out[-1][i:i + FANOUT])) for i in range(0, len(out[-1]), FANOUT)])
    return out


def _depth(rows: int, levels: int) -> int:
    """Local levels of a tree of so many leaves."""
    depth = 0
    while rows > 1 and depth < levels:
        rows, depth = -(-rows // FANOUT), depth + 1
    return depth


def _climb(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """nodes: tree, at (place in its level), of (nodes in its level), digest. The runs of siblings of each level
    (tree, at of their parent, run), lowest first, and the last node of each tree (tree, digest)."""
    runs, tops = [], []
    while True:
        tops.append(nodes.where("of = 1").select("tree", "digest"))
        more = nodes.where("of > 1")
        if more.isEmpty():
            return runs, reduce(DataFrame.unionAll, tops)
        run = more.groupBy("tree", F.shiftright("at", FANOUT_BITS).alias("at")).agg(
            F.array_sort(F.collect_list(F.struct("at", "digest")))["digest"].alias("run"), F.any_value("of").alias("of"))
        run = stage(run, name)
        runs.append(run.select("tree", "at", "run"))
        nodes = run.select("tree", "at", F.ceil(F.col("of") / FANOUT).cast("long").alias("of"), _joined("run").alias("digest"))


def _reduce(levels: int):
    def run(key: tuple, leaves: pd.DataFrame) -> pd.DataFrame:
        leaves = leaves.sort_values("place")
        top = _levels(leaves["leaf"].tolist(), _depth(int(leaves["n"].iloc[0]), levels))[-1]
        return pd.DataFrame({"tree": [key[0]], "block": [key[1]], "n": [leaves["n"].iloc[0]], "digest": top})

    return run


def fold(start: str, steps: list[tuple[int, list[str]]]) -> str:
    """The root that a node leads to: steps are its place in each run of siblings, and the run."""
    for at, run in steps:
        start = digest("".join([*run[:at], start, *run[at + 1:]]))
    return start


def _finish(levels: int, with_proof: bool):
    names = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"] + ["proof"] * with_proof

    def run(key: tuple, leaves: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        leaves = leaves.sort_values("place")
        nodes = _levels(leaves["leaf"].tolist(), _depth(int(leaves["n"].iloc[0]), levels))
        outer = outer.sort_values("step")
        above = [(int(at), list(run)) for at, run in zip(outer["at"], outer["run"])]
        inside = int((outer["step"] < _TOP).sum())
        subroot = fold(nodes[-1][0], above[:inside])
        root = fold(subroot, above[inside:])
        beyond = [s for at, run in above for i, s in enumerate(run) if i != at]
        tail, rows = "".join(beyond), []
        for p, (own, claimed) in enumerate(zip(leaves["leaf"], leaves["claimed"])):
            steps, siblings = [], []
            for level, row in enumerate(nodes[:-1]):
                q = p >> (FANOUT_BITS * level)
                near, at = row[q & -FANOUT:(q | FANOUT - 1) + 1], q & FANOUT - 1
                steps.append((at, near))
                siblings += near[:at] + near[at + 1:]
            folded = fold(claimed if isinstance(claimed, str) else own, steps + above)
            rows.append((own, subroot, root, digest("".join(siblings) + tail), folded, folded == root, *[siblings + beyond] * with_proof))
        out = pd.DataFrame(rows, columns=names[1:])
        out.insert(0, "id", leaves["id"].to_numpy())
        return out

    return run


#: Steps of the tree over the groups are numbered from here.
_TOP = 1000


def proofs(rows: DataFrame, levels: int = LEVELS, with_proof: bool = False) -> DataFrame:
    """rows: group (string), id, leaf, and claimed (a digest to fold in the leaf's place, or null).
    Columns id, leaf, subroot, root, proof_sha256 (digest of all siblings in order), folded_root, verified and,
    with_proof, proof (the siblings)."""
    with passing(rows.sparkSession) as used:
        # '' for the null group and '=' before the others keep their order, and the key is never null.
        tree = F.coalesce(F.concat(F.lit("="), F.col("group")), F.lit(""))
        plain = stage(rows.select(tree.alias("tree"), "id", "leaf", "claimed"), "leaves")
        kind = plain.schema["id"].dataType
        placed = ranked(plain, [F.col("id").asc_nulls_first(), F.col("leaf")], ["tree"], "leaf-places")
        placed = placed.select("tree", F.shiftright("_place", FANOUT_BITS * levels).alias("block"), F.col("_place").alias("place"),
                               F.col("_of").alias("n"), F.col("id").cast("string").alias("id"), "leaf", "claimed")
        placed = stage(placed, "placed")
        blocks = stage(placed.select("tree", "block", "place", "n", "leaf").groupBy("tree", "block").applyInPandas(
            _reduce(levels), "tree string, block long, n long, digest string"), "superblocks")
        of = F.ceil(F.col("n") / FANOUT ** levels).cast("long")
        runs, subroots = _climb(blocks.select("tree", F.col("block").alias("at"), of.alias("of"), "digest"), "runs")
        subroots = stage(subroots, "subroots")
        tops = stage(ranked(subroots, [F.col("tree")], [], "subroot-places"), "tops")
        above, _ = _climb(tops.select(F.lit("").alias("tree"), F.col("_place").alias("at"), F.col("_of").alias("of"), "digest"), "upper-runs")

        def way(of_whom: DataFrame, at: str, levels_above: list[DataFrame], first: int) -> list[DataFrame]:
            """The runs that the nodes of_whom (tree, block, `at` in their level) meet, a table for each level."""
            out = []
            for i, run in enumerate(levels_above):
                run = run.select(F.col("tree").alias("_tree"), F.col("at").alias("_at"), "run")
                up = F.shiftright(at, FANOUT_BITS * (i + 1))
                step = F.shiftright(at, FANOUT_BITS * i).bitwiseAND(FANOUT - 1).cast("int")
                out.append(of_whom.join(run, (F.col("_in") == F.col("_tree")) & (up == F.col("_at")))
                           .select("tree", "block", F.lit(first + i).alias("step"), step.alias("at"), "run"))
            return out

        within = way(blocks.select("tree", "block", F.col("tree").alias("_in")), "block", runs, 0)
        upper = blocks.select("tree", "block").join(tops.select("tree", "_place"), "tree").withColumn("_in", F.lit(""))
        over = way(upper, "_place", above, _TOP)
        none = rows.sparkSession.createDataFrame([], _STEPS)
        outer = stage(reduce(DataFrame.unionAll, [*within, *over], none), "outer")
        used.keep(placed, outer)
    fields = "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    found = placed.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInPandas(
        _finish(levels, with_proof), fields + ", proof array<string>" * with_proof)
    return found.withColumn("id", F.col("id").cast(kind))


def manifest(docs: DataFrame, claimed: Column | None = None, fields: tuple[str, ...] = FIELDS, group_col: str = "lang",
             id_col: str = "doc_id", **options) -> DataFrame:
    """The proofs of all rows of `docs`, trees by `group_col`. claimed: a leaf of its own for some rows, to be held
    against the manifest."""
    claimed = F.lit(None).cast("string") if claimed is None else claimed
    return proofs(docs.select(docs[group_col].cast("string").alias("group"), docs[id_col].alias("id"),
                              leaf([docs[c] for c in fields]).alias("leaf"), claimed.alias("claimed")), **options)
