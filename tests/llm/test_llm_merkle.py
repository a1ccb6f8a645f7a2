import hashlib

import pytest
from llm_cases import CLASHING, DOCUMENTS
from pyspark.sql import functions as F, types as T

from gridcast.llm import merkle


def digest(x):
    return hashlib.sha256(x.encode()).hexdigest()


def plain_leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes):
    """Levels of the tree over the nodes, and for each node its siblings and places on the way up."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][i:i + 8])) for i in range(0, len(levels[-1]), 8)])
    ways = []
    for p in range(len(nodes)):
        way, q = [], p
        for level in levels[:-1]:
            way.append((q % 8, level[q - q % 8:q - q % 8 + 8]))
            q //= 8
        ways.append(way)
    return levels[-1][0], ways


def plain(rows):
    """rows: (group, id, leaf, claimed). Sorted result rows."""
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        trees[g] = climb([r[2] for r in groups[g]])
    root, above = climb([trees[g][0] for g in names])
    out = []
    for i, g in enumerate(names):
        for r, way in zip(groups[g], trees[g][1]):
            way = way + above[i]
            siblings = [s for at, run in way for k, s in enumerate(run) if k != at]
            cur = r[3] or r[2]
            for at, run in way:
                cur = digest("".join([*run[:at], cur, *run[at + 1:]]))
            out.append((r[1], r[2], trees[g][0], root, digest("".join(siblings)), cur, cur == root, siblings))
    return sorted(out, key=str)


def made(spread):
    return [(g, i, digest(f"{g}{i}"), digest("other") if i % 5 == 0 else None) for g, n in spread.items() for i in range(n)]


@pytest.mark.parametrize("levels", [1, 2, 3])
@pytest.mark.parametrize("spread", [{"a": 1}, {"a": 8, "b": 9, None: 3}, {"en": 150, "fr": 64, "é": 65, "": 1},
                                    {f"g{i}": 1 + i % 3 for i in range(20)}])
def test_proofs_equal_the_plain_version(spark, levels, spread):
    rows = made(spread)
    got = merkle.proofs(spark.createDataFrame(rows, "group string, id long, leaf string, claimed string").repartition(5), levels, with_proof=True)
    assert sorted([tuple(list(v) if isinstance(v, list) else v for v in r) for r in got.collect()], key=str) == plain(rows)


def test_defined_cases(spark):
    rows = [(None, "x", None, None, None), (None, None, "en", "s", 3), (7, "ä b", "en", "s", 3), (7, "ä b", "en", "s", 3), (7, "", None, "", 0)]
    full = [(i, t, g, s, n, True, 7, "x", 1, "y", "z", "o") for i, t, g, s, n in rows]
    docs = spark.createDataFrame(full, T._parse_datatype_string(CLASHING))
    got = merkle.manifest(docs).drop("proof")
    assert got.schema["id"].dataType == docs.schema["doc_id"].dataType
    want = plain([(g, i, plain_leaf((i, s, g, n, t)), None) for i, t, g, s, n in rows])
    assert sorted(map(tuple, got.collect()), key=str) == [w[:-1] for w in want]
    assert all(r.verified for r in got.collect())


def test_a_changed_text_is_noticed(spark):
    docs = spark.createDataFrame([(i, f"Text {i}", "en", "s", 6) for i in range(30)], DOCUMENTS)
    changed = F.when(docs.doc_id == 11, merkle.leaf([F.lower(docs[c]) if c == "text" else docs[c] for c in merkle.FIELDS]))
    assert [r.id for r in merkle.manifest(docs, changed).where("NOT verified").collect()] == [11]
    kept = merkle.manifest(docs, with_proof=True).where("id = 4").first()
    assert len(kept.proof) == 7 + 3 and kept.root == kept.subroot


def test_empty_table(spark):
    assert merkle.manifest(spark.createDataFrame([], DOCUMENTS)).collect() == []
