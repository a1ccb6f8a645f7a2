import random
import re

import numpy as np
import pytest
from llm_cases import documents, edited, sentence

from gridcast.llm import minhash, words
from gridcast.llm.components import components


def shingles(text):
    found = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return {tuple(found[i:i + 5]) for i in range(len(found) - 4)} if len(found) >= 5 else {tuple(found)} if found else set()


def plain(rows):
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                group[root(i)] = root(j)
    smallest = {}
    for i, (doc, _) in enumerate(rows):
        smallest.setdefault(root(i), []).append(doc)
    out = []
    for i, (doc, _) in enumerate(rows):
        known = [d for d in smallest[root(i)] if d is not None]
        out.append((doc, len(sets[i]), min(known) if known else None))
    return sorted(out, key=str)


def found(spark, rows, **settings):
    got = minhash.near_groups(documents(spark, rows), **settings).collect()
    return sorted(((r.id, r.n_shingles, r.component_id) for r in got), key=str)


def cases():
    rng = random.Random(5)
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one two"), (4, "ONE  two"), (5, "one two three four five"), (None, "alone here"),
            (6, "One Two three\tfour five"), (7, "É a b c d"), (8, "é a b c d"), (None, "one two"), (9, "a b c d e f g h"), (9, "a b c d e f g h")]
    at = 10
    for size in (12, 60, 200, 1500):
        base = sentence(rng, size)
        for share in (0.0, 0.01, 0.02, 0.04, 0.05, 0.06, 0.08, 0.3):
            rows.append((at, edited(rng, base, share)))
            at += 1
    hub = sentence(rng, 150)  # a group of near copies around one text
    for _ in range(120):
        rows.append((at, edited(rng, hub, rng.choice([0.0, 0.01, 0.02, 0.03, 0.05, 0.06, 0.1]))))
        at += 1
    rng.shuffle(rows)
    return rows


def test_components_equal_brute_force(spark):
    rows = cases()
    assert found(spark, rows) == plain(rows)


def test_many_unlinked_classes_in_one_bucket(spark):
    # One wide band row makes nearly all share buckets: the prefix join alone decides.
    rows = [r for r in cases() if r[0] is not None]
    assert found(spark, rows, permutations=8, band_rows=1) == plain(rows)


def test_empty_table(spark):
    assert found(spark, []) == [] and minhash.deduplicated(documents(spark, [])).collect() == []


def test_deduplicated(spark):
    rows = cases()
    docs = documents(spark, rows, clashing=True)
    kept = minhash.deduplicated(docs)
    assert kept.dtypes == docs.dtypes
    got = sorted((str(r.doc_id), r.text or "") for r in kept.collect())
    # Documents without words all stay; of any other component one row with its smallest id stays.
    blank = [r for r in rows if not shingles(r[1])]
    assert len([g for g in got if not shingles(g[1])]) == len(blank)
    known = {c for (_, n, c) in plain(rows) if n and c is not None}
    assert sorted(int(i) for i, t in got if shingles(t) and i != "None") == sorted(known)


def test_words_and_hashes():
    import pyarrow as pa
    texts = ["A b\x0bc", None, "", "b", " lead", "tail ", "é x y", "a" * 50]
    data, offsets = words.buffers(pa.array(texts))
    starts, ends, first = words.word_spans(data, offsets)
    split = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for t in texts]
    assert [bytes(data[s:e]) for s, e in zip(starts, ends)] == [x for row in split for x in row]
    assert list(np.diff(first)) == [len(r) for r in split]
    hashes = words.word_hashes(data, starts, ends)
    by_word = {}
    for word, h in zip([x.lower() for row in split for x in row], hashes):
        assert by_word.setdefault(word, h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_hashes_do_not_depend_on_windows(monkeypatch):
    import pyarrow as pa
    texts = [" ".join(f"word{i}" for i in range(300)), "z" * 500 + " end"]
    data, offsets = words.buffers(pa.array(texts))
    starts, ends, _ = words.word_spans(data, offsets)
    whole = words.word_hashes(data, starts, ends)
    monkeypatch.setattr(words, "WINDOW", 64)
    assert (words.word_hashes(data, starts, ends) == whole).all()


@pytest.mark.parametrize("edges", [[], [(5, 5)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)] + [(50, 49)],
                                   [((7 * i) % 31, (11 * i + 3) % 31) for i in range(20)]])
def test_connected_components(spark, edges):
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {x: x for e in edges for x in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: v for x, v in label.items() if x in linked}
