import math
import random

import numpy as np
import pytest

from gridcast.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, label int, id long, vector string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], SCHEMA)


def plain(rows, k):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            v = tuple(float(np.float32(x)) for x in v)
            good[i] = min(good.get(i, v), v)
    out = []
    for q, a in good.items():
        if q % 20:
            continue
        found = []
        for c, b in good.items():
            if c != q and len(a) == len(b):
                total = 0.0
                for x, y in zip(a, b):
                    total += x * y
                found.append((-total, c))
        out += [(q, rank, c, -s) for rank, (s, c) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def found(spark, rows, k=20, **blocks):
    good = neighbours.usable(vectors(spark, rows))
    return sorted(tuple(r) for r in neighbours.nearest(good.where("id % 20 = 0"), good, k, **blocks).collect())


def random_rows(seed, n, dim, scale=1.0):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, scale * (1 + i % 5)) for _ in range(dim)]) for i in range(n)]
    return rows + [(n + i, rows[7][1]) for i in range(60)] + [(n + 100 + i, [rng.choice([-1.0, 0.0, 1.0]) for _ in range(dim)]) for i in range(40)]


@pytest.mark.parametrize("blocks", [{}, {"query_rows": 4, "candidate_rows": 30}])
def test_equals_brute_force(spark, blocks):
    rows = random_rows(1, 200, 8)
    assert found(spark, rows, **blocks) == plain(rows, 20)


def test_defined_cases(spark):
    inf, nan = math.inf, math.nan
    rows = [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [None, 1.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (None, [1.0, 1.0]),
            (8, [1.0, 2.0, 3.0]), (20, [1.0, 0.0, 0.0]), (9, [-3.0, 1.0]), (1, [2.0, 0.5]), (1, [2.0, 1.0]), (40, [1e-30, 1e30]), (60, [5.0])]
    assert found(spark, rows) == plain(rows, 20)
    assert found(spark, []) == []


def test_tile_with_many_dimensions_and_few_candidates():
    rng = np.random.default_rng(3)
    q, c = rng.standard_normal((3, 2500)), rng.standard_normal((5, 2500))
    got = neighbours.tile(np.arange(3), q, np.arange(10, 15), c, 4)
    exact = q @ c.T
    for n in range(3):
        mine = [(i, s) for own, i, s in got if own == n]
        assert [i - 10 for i, _ in mine] == list(np.argsort(-exact[n])[:4])
        assert np.allclose([s for _, s in mine], np.sort(exact[n])[::-1][:4])
