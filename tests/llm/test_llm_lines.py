import random
from collections import defaultdict

import pytest
from llm_cases import documents, sentence

from gridcast.llm import lines


def plain(rows, depth=3, min_texts=5, constant=0.6):
    found = {t: [lines.masked(x) for x in t.split("\n")] for _, t in rows if t}
    leaves, places = defaultdict(set), defaultdict(set)
    leaf = lambda k: (len(k), tuple(k[:depth]))
    for t, ks in found.items():
        for k in ks:
            leaves[leaf(k)].add(t)
            for i, token in enumerate(k):
                places[leaf(k), i, token].add(t)
    templates = defaultdict(set)

    def template(k):
        if not k or len(leaves[leaf(k)]) < min_texts:
            return None
        fixed = [token != lines.FIELD and len(places[leaf(k), i, token]) >= min_texts for i, token in enumerate(k)]
        return " ".join(x if f else lines.FIELD for x, f in zip(k, fixed)) if sum(fixed) >= constant * len(k) else None

    for t, ks in found.items():
        for k in ks:
            templates[template(k)].add(t)
    keep = lambda k: template(k) is None or len(templates[template(k)]) < min_texts
    return {t: "\n".join(x for x, k in zip(t.split("\n"), ks) if keep(k)) for t, ks in found.items()}


def cases():
    rng = random.Random(2)
    rows = []
    for i in range(60):
        parts = [sentence(rng, rng.randrange(1, 12), 40) for _ in range(5)]
        parts.insert(2, f"Posted by user{i} on 2024-01-{i % 28 + 1} in News")
        parts.insert(0, "All rights reserved worldwide")
        parts.append(f"Share this {rng.choice(['story', 'page', 'post'])} with friends")
        rows.append((i, "\n".join([*parts, "", "  "])))
    return [*rows, *[(100 + i, "copied text\nof one source only") for i in range(9)], (200, None), (201, ""), (202, "\n\n"), (None, rows[0][1])]


def found(spark, rows, **settings):
    got = lines.without_templates(documents(spark, rows, clashing=True), **settings)
    return [(r.row, r.text, r.n_lines, r.n_dropped) for r in got.collect()]


@pytest.mark.parametrize("settings", [{}, {"min_texts": 2, "depth": 1, "constant": 0.3}])
def test_equals_brute_force(spark, settings):
    rows = cases()
    want = plain(rows, **settings)
    got = found(spark, rows, **settings)
    assert sorted((str(r.doc_id), t) for r, t, _, _ in got if t) == sorted((str(i), want[t]) for i, t in rows if t and want[t])
    for row, text, n_lines, n_dropped in got:
        assert row["odd name"] == "o" and n_lines == (len(row.text.split("\n")) if row.text else 0)
        assert n_dropped == n_lines - len(text.split("\n")) if text else True


def test_templates_and_copies(spark):
    rows = cases()
    by_id = {r.doc_id: (t, d) for r, t, _, d in found(spark, rows)}
    assert "All rights reserved worldwide" not in by_id[3][0] and "Posted by" not in by_id[3][0]
    assert by_id[100] == ("copied text\nof one source only", 0)  # nine copies are one text
    assert by_id[200] == (None, 0) and by_id[201] == ("", 0) and by_id[202] == ("\n\n", 0)


def test_empty_table_and_long_lines(spark):
    assert found(spark, []) == []
    long = " ".join(f"t{'x' * (i % 5)}" for i in range(20_000))
    got = found(spark, [(i, f"{long}\nown{'y' * i} line") for i in range(6)])
    assert all(d == 1 and "own" in t for _, t, _, d in got)
