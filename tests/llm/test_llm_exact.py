import hashlib
import random
from collections import defaultdict

import pytest
from llm_cases import documents

from gridcast.llm import exact_dedup

LONG = "x" * 70_000
ROWS = [(1, "Same text"), (2, "same TEXT"), (3, "same text "), (4, None), (5, ""), (6, "É"), (7, "é"), (8, LONG), (9, LONG.upper()),
        (10, LONG + "y"), (11, "a" * 64), (12, "a" * 64), (13, "a" * 63 + "b"), (13, "a" * 63 + "b"), (None, "alone"), (None, "same text"),
        (14, LONG[:-1] + "z"), (15, "a\x00b"), (16, "a\x00b"), (None, "both null"), (None, "both null")]


def lower(text):
    return (text or "").encode().lower()


def plain(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[lower(text)].append(i)
    out = []
    for i, text in rows:
        ids = groups[lower(text)]
        known = [x for x in ids if x is not None]
        out.append((i, max(known) if known else None, len(ids), hashlib.sha256(lower(text)).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, **settings):
    got = exact_dedup.equal_groups(documents(spark, rows), carried=["doc_id"], **settings)
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got.collect()), key=str)


def test_groups_equal_brute_force(spark):
    assert found(spark, ROWS) == plain(ROWS)


@pytest.mark.parametrize("first, growth", [(1, 1), (2, 2), (3, 5)])
def test_any_digit_widths(spark, first, growth):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("ab") for _ in range(rng.randrange(6)))) for i in range(120)]
    assert found(spark, rows, first=first, growth=growth) == plain(rows)


def test_empty_table(spark):
    assert found(spark, []) == []
    assert exact_dedup.deduplicated(documents(spark, [])).collect() == []


def test_deduplicated_keeps_one_of_each_and_all_columns(spark):
    docs = documents(spark, ROWS, clashing=True)
    kept = exact_dedup.deduplicated(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    rows = kept.collect()
    assert sorted(lower(r.text) for r in rows) == sorted({lower(t) for _, t in ROWS})
    best = {lower(t): k for (_, t), k in zip(ROWS, [max((i for i, u in ROWS if lower(u) == lower(t) and i is not None), default=None) for _, t in ROWS])}
    assert all(r.doc_id == best[lower(r.text)] for r in rows)
    assert all(r["odd name"] == "o" and r.keep_id == 7 for r in rows)
