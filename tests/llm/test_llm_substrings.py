import random

import pytest
from llm_cases import documents, edited, sentence

from gridcast.llm import substrings


def planted(rng):
    passages = [sentence(rng, n) for n in (51, 60, 80, 200)]
    rows = [(i, f"{sentence(rng, 120)}\n{passages[i % 4]} {sentence(rng, 90)}") for i in range(40)]
    fuzzy = [(40 + i, f"{sentence(rng, 50)} {edited(rng, passages[3], 0.05)}  {sentence(rng, 30)}") for i in range(6)]
    clean = [(60 + i, sentence(rng, 200)) for i in range(20)]
    return passages, rows, fuzzy, clean


def test_planted_passages_are_found_and_clean_documents_left(spark):
    rng = random.Random(8)
    passages, rows, fuzzy, clean = planted(rng)
    docs = documents(spark, [*rows, *fuzzy, *clean])
    spans = substrings.repeats(docs).collect()
    assert {s.doc for s in spans} == {r[0] for r in rows if r[0] > 3} | {r[0] for r in fuzzy}
    for s in spans:
        assert s.holder < s.doc and s.end_word - s.start_word >= 50
        if s.doc < 40 and s.holder == s.doc % 4:
            # The passage begins after 120 words; a word beside it may agree by chance.
            own = len(passages[s.doc % 4].split())
            assert 118 <= s.start_word <= 120 and 120 + own <= s.end_word <= 122 + own


def test_cutting_leaves_one_copy(spark):
    rng = random.Random(9)
    passages, rows, fuzzy, clean = planted(rng)
    docs = documents(spark, [*rows, *clean, (100, None), (101, ""), (102, " \n "), (103, passages[3])], clashing=True)
    kept = substrings.without_repeats(docs)
    assert kept.dtypes == docs.dtypes
    got = {r.doc_id: r for r in kept.collect()}
    assert 103 not in got and got[100].text is None and got[101].text == "" and got[102].text == " \n "
    for i, text in [*clean, *rows[:4]]:
        assert got[i].text == text
    for i, text in rows[4:]:
        before, _, after = text.partition(passages[i % 4])
        assert passages[i % 4] not in got[i].text and got[i].n_chars == len(got[i].text)
        assert got[i].text.startswith(before[:-20].strip()[:300]) and got[i].text.endswith(after.strip()[-300:])


def test_defined_cases(spark):
    text = " ".join(f"t{i}" for i in range(80))
    rows = [(None, text), (1, text), (1, text), (2, "short"), (3, None), (4, text.upper())]
    spans = substrings.repeats(documents(spark, rows)).collect()
    assert [(s.doc, s.holder, s.start_word, s.end_word) for s in spans] == [(4, 1, 0, 80)]
    assert substrings.repeats(documents(spark, [])).collect() == []
    assert substrings.without_repeats(documents(spark, [])).collect() == []


def test_very_long_and_repeating_texts(spark):
    rng = random.Random(4)
    long = sentence(rng, 30_000, 10**6)
    line = sentence(rng, 60)
    rows = [(1, long), (2, f"{sentence(rng, 40)} {long}"), (3, "was " * 400), (4, "was " * 300), (5, f"{line} {line} {line}"), (6, f"{line} {line}")]
    spans = {(s.doc, s.holder): (s.start_word, s.end_word) for s in substrings.repeats(documents(spark, rows)).collect()}
    assert spans[2, 1] == (40, 30_040) and (4, 3) in spans and (6, 5) in spans


def slow_chain(x, y, k, gap):
    best = []
    for i in range(len(x)):
        before = [best[j] - gap * (x[i] + y[i] - x[j] - y[j] - 2 * k) for j in range(i) if x[j] < x[i] and y[j] < y[i]]
        best.append(k + max([0.0, *before]))
    return max(best)


@pytest.mark.parametrize("seed", range(20))
def test_best_chain_equals_quadratic_search(seed):
    rng = random.Random(seed)
    matches = sorted({(rng.randrange(60), rng.randrange(60)) for _ in range(30)})
    x, y = [m[0] for m in matches], [m[1] for m in matches]
    chains = substrings.best_chains(x, y, 8, 0.2, 10**6)
    top = chains[0]
    assert all(x[a] < x[b] and y[a] < y[b] for a, b in zip(top, top[1:]))
    value = 8.0
    for a, b in zip(top, top[1:]):
        value = 8 + value - 0.2 * (x[b] + y[b] - x[a] - y[a] - 16)
    assert value == pytest.approx(slow_chain(x, y, 8, 0.2))
    assert sorted(i for c in chains for i in c) == list(range(len(x)))


@pytest.mark.parametrize("seed", range(20))
def test_best_chain_within_a_gap_equals_quadratic_search(seed):
    rng = random.Random(seed)
    matches = sorted({(rng.randrange(300), rng.randrange(300)) for _ in range(60)} | {(i, i + 7) for i in range(0, 120, 6)})
    x, y = [m[0] for m in matches], [m[1] for m in matches]
    best = []
    for i in range(len(x)):
        near = [j for j in range(i) if 0 < x[i] - x[j] <= 48 and 0 < y[i] - y[j] <= 48]
        best.append(8 + max([0.0, *[best[j] - 0.2 * (x[i] + y[i] - x[j] - y[j] - 16) for j in near]]))
    chains = substrings.best_chains(x, y, 8, 0.2, 40)
    for c in chains:
        assert all(0 < x[b] - x[a] <= 48 and 0 < y[b] - y[a] <= 48 for a, b in zip(c, c[1:]))
    value = 8 * len(chains[0]) - 0.2 * sum(x[b] + y[b] - x[a] - y[a] - 16 for a, b in zip(chains[0], chains[0][1:]))
    assert value == pytest.approx(max(best))
    assert sorted(i for c in chains for i in c) == list(range(len(x)))


def test_passages_after_a_long_one_are_found(spark):
    rng = random.Random(5)
    passages = [sentence(rng, n) for n in (1000, 60, 200, 55, 70)]
    rows = [(i, " ".join(f"{sentence(rng, 60, 10**6)} {p}" for p in passages)) for i in range(2)]
    spans = sorted((s.start_word, s.end_word) for s in substrings.repeats(documents(spark, rows)).collect())
    starts = [60, 1120, 1240, 1500, 1615]
    assert len(spans) == 5
    for (low, high), start, p in zip(spans, starts, passages):
        assert start - 2 <= low <= start and start + len(p.split()) <= high <= start + len(p.split()) + 2


def test_alignment():
    a = [b"%d" % i for i in range(100)]
    b = a[:30] + [b"x"] + a[30:60] + a[62:]
    assert substrings.align(a, b, [10, 40], [10, 41], 8) == (0, 100, 0, 99, 98)
    assert substrings.align(a, a[::-1], [10], [10], 8) is None
    assert substrings._common([b"a", b"b", b"c"], [b"a", b"c"]) == 2


def test_maxima_of_ranges_while_entries_come_and_go():
    rng = random.Random(3)
    for n in (1, 2, 7, 40):
        maxima, own = substrings._Maxima(n), {}
        for step in range(300):
            rank = rng.randrange(1, n + 1)
            if rank in own:
                maxima.leave(rank)
                del own[rank]
            else:
                own[rank] = (rng.randrange(5) / 2, step)
                maxima.enter(rank, own[rank])
            low, high = rng.randrange(1, n + 1), rng.randrange(0, n + 1)
            assert maxima.best(low, high) == max([v for r, v in own.items() if low <= r <= high], default=maxima.NONE)


@pytest.mark.parametrize("seed", range(10))
def test_common_words_equal_the_plain_table(seed):
    rng = random.Random(seed)
    a, b = ([rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(rng.randrange(25))] for _ in range(2))
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, u in enumerate(a, 1):
        for j, v in enumerate(b, 1):
            table[i][j] = table[i - 1][j - 1] + 1 if u == v else max(table[i - 1][j], table[i][j - 1])
    pairs = substrings._lcs(a, b)
    assert len(pairs) == table[-1][-1] and all(a[i] == b[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


@pytest.mark.parametrize("seed", range(30))
def test_longest_equal_stretch_equals_search(seed):
    rng = random.Random(seed)
    pairs, i, j = [], 0, 0
    for _ in range(rng.randrange(20, 90)):
        i, j = i + rng.choice([1, 1, 1, 1, 2, rng.randrange(1, 9)]), j + rng.choice([1, 1, 1, 1, 2, rng.randrange(1, 9)])
        pairs.append((i, j))

    def enough(p, q):
        words = 1 + sum(max(b[0] - a[0], b[1] - a[1]) for a, b in zip(pairs[p:q], pairs[p + 1:q + 1]))
        return q - p + 1 >= 0.8 * words - 1e-9

    best = max([pairs[q][0] - pairs[p][0] + 1 for p in range(len(pairs)) for q in range(p, len(pairs)) if enough(p, q)])
    found = list(substrings.passages(pairs, 10, 0.8))
    whole = len(pairs) >= 0.8 * max(pairs[-1][0] - pairs[0][0], pairs[-1][1] - pairs[0][1]) + 0.8
    if whole:
        assert [f[:2] for f in found] == [(pairs[0][0], pairs[-1][0] + 1)]
    else:
        assert max([f[1] - f[0] for f in found], default=0) == (best if best >= 10 else 0)
    spans = sorted(f[:2] for f in found)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert all(f[4] >= 0.8 * max(f[1] - f[0], f[3] - f[2]) - 1e-9 and f[1] - f[0] >= 10 for f in found)


def test_parts_of_a_chain_that_fails_as_a_whole(spark):
    """Quoted passages with other words between them, at most as many as a chain may step over."""
    rng = random.Random(6)
    quotes = [sentence(rng, 55, 10**6) for _ in range(4)]
    rows = [(i, " ".join(f"{sentence(rng, 36, 10**6)} {q}" for q in quotes)) for i in range(2)]
    spans = sorted((s.start_word, s.end_word) for s in substrings.repeats(documents(spark, rows), max_gap=40).collect())
    covered = {w for a, b in spans for w in range(a, b)}
    for n in range(4):
        start = 36 + n * 91
        assert set(range(start, start + 55)) <= covered


@pytest.mark.parametrize("share, words, least", [(0.0, 60, 1.0), (0.05, 60, 0.95), (0.1, 60, 0.9), (0.1, 200, 0.97), (0.15, 100, 0.85)])
def test_recall_of_edited_passages(spark, share, words, least):
    """Documents that hold one planted passage, random words of it replaced; a passage counts if it is still 80 % equal
    over 50 words by a plain search."""
    rng = random.Random(int(100 * share) + words)
    rows, due = [], set()
    for n in range(80):
        own = sentence(rng, words, 10**6).split()
        copy = [f"e{rng.randrange(10**6)}" if rng.random() < share else x for x in own]
        rows += [(n, f"{sentence(rng, 60, 10**6)} {' '.join(own)} {sentence(rng, 60, 10**6)}"),
                 (1000 + n, f"{sentence(rng, 70, 10**6)} {' '.join(copy)} {sentence(rng, 40, 10**6)}")]
        same = [x == y for x, y in zip(own, copy)]
        if any(sum(same[p:q]) >= 0.8 * (q - p) and same[p] and same[q - 1] for p in range(words) for q in range(p + 50, words + 1)):
            due.add((1000 + n, n))
    found = {(s.doc, s.holder) for s in substrings.repeats(documents(spark, rows)).collect()}
    print(share, words, len(due), len(found & due) / len(due))
    assert len(found & due) >= least * len(due) and {d for d, _ in found} <= {1000 + n for n in range(80)}
