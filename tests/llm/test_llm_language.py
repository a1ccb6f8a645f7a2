import random

import pyarrow as pa
import pytest
from llm_cases import documents

from gridcast.llm import language

SOUNDS = {"aa": ["ka", "to", "mi", "ra"], "bb": ["schn", "erg", "auf", "ich"], "cc": ["ção", "ñe", "ést", "où"]}


def corpus(n, seed=1):
    rng = random.Random(seed)
    word = lambda s: "".join(rng.choice(s) for _ in range(rng.randrange(1, 4)))
    return [(i, " ".join(word(SOUNDS[lang]) for _ in range(rng.randrange(5, 80))), lang) for i in range(n) for lang in [list(SOUNDS)[i % 3]]]


@pytest.fixture(scope="module")
def model(spark):
    return language.train(documents(spark, corpus(600)))


def test_held_out_accuracy_and_rejection(spark, model):
    rows = corpus(300, seed=2)
    got = {r.row.doc_id: r for r in language.identify(documents(spark, rows), model).collect()}
    assert sum(got[i].lang_pred == lang for i, _, lang in rows) >= 0.98 * len(rows)
    assert sum(got[i].accepted for i, _, _ in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in got.values()) and 0 < model.threshold <= 0.5


def test_defined_cases(spark, model):
    rows = [(1, None), (2, ""), (3, "1234 !! 56"), (4, "katomi " * 50_000, None), (4, "katomi"), (None, "schnerg auf ich"), (5, "é"), (6, "中"), (7, "a")]
    got = {(r.row.doc_id, (r.row.text or "")[:9]): r for r in language.identify(documents(spark, rows, clashing=True), model).collect()}
    for i in (1, 2, 3):
        r = next(v for k, v in got.items() if k[0] == i)
        assert (r.lang_pred, r.score, r.accepted) == (language.UNKNOWN, 0.0, False)
    assert got[4, "katomi ka"].lang_pred == got[4, "katomi"].lang_pred == "aa" and got[None, "schnerg a"].lang_pred == "bb"
    assert all(got[k].lang_pred in SOUNDS for k in got if k[0] in (5, 6, 7))
    assert got[4, "katomi"].row["odd name"] == "o"
    assert language.identify(documents(spark, []), model).collect() == []


def test_nothing_to_learn_from(spark):
    assert language.train(documents(spark, [])) is None and language.train(documents(spark, [(1, "x", None)])) is None
    got = language.identify(documents(spark, [(1, "text")]), None).first()
    assert (got.lang_pred, got.accepted) == (language.UNKNOWN, False)
    one = language.train(documents(spark, [(i, f"some text {i}") for i in range(10)]))
    assert language.identify(documents(spark, [(1, "text")]), one).first().lang_pred == "en"


def test_sample_is_bounded(spark):
    few = language.train(documents(spark, corpus(600)), sample_rows=30)
    assert few.languages == sorted(SOUNDS)


def test_held_out_rows_are_never_learnt_from(spark):
    rows = documents(spark, corpus(100)).where(language.learnable())
    import zlib
    assert {r.doc_id for r in rows.collect()} == {i for i in range(100) if zlib.crc32(str(i).encode()) % 4 != 2}


def test_scores_do_not_depend_on_the_batch(model):
    texts = [t for _, t, _ in corpus(50, seed=3)] + ["", None, "x"]
    whole = language._predict(model, pa.array(texts))
    for i, t in enumerate(texts):
        one = language._predict(model, pa.array([t], pa.string()))
        assert one[0][0] == whole[0][i] and abs(one[1][0] - whole[1][i]) < 1e-9 and one[2][0] == whole[2][i]
