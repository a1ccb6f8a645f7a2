import pytest
from llm_cases import CLASHING, DOCUMENTS, sentence
from pyspark.sql import types as T

from gridcast.llm import mixing


def corpus(spark, rows, schema=DOCUMENTS):
    """rows: (doc_id, text, source)."""
    full = [(i, t, "en", s, None) for i, t, s in rows]
    if schema != DOCUMENTS:
        full = [(*r, True, 7, "x", 1, "y", "z", "o") for r in full]
    return spark.createDataFrame(full, T._parse_datatype_string(schema))


def plain_targets(sizes, weights=(5, 2, 1), cap=3):
    """Shares handed out again until no source is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, done = sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in done]
        rest, pool = total - sum(done.values()), sum(weight[s] for s in open_)
        over = [s for s in open_ if cap * sizes[s] <= rest * weight[s] / pool]
        if not over:
            return {**done, **{s: rest * weight[s] / pool for s in open_}}
        done.update({s: cap * sizes[s] for s in over})


SIZES = [{"a": 10, "b": 1000, "c": 500}, {"é": 100, "z": 100, None: 4000, "Z": 3}, {"x": 7}, {str(i): 3 ** i for i in range(12)}]


@pytest.mark.parametrize("sizes", SIZES)
def test_targets_equal_the_plain_version(spark, sizes):
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()}
    assert got == pytest.approx(plain_targets(sizes), rel=1e-12)
    assert all(got[s] <= 3 * n for s, n in sizes.items()) and sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_taken_words_come_near_the_target(spark):
    import random
    rng = random.Random(3)
    rows = [(i, sentence(rng, rng.choice([5, 40, 300])), rng.choice(["big"] * 6 + ["mid", "mid", "rare"])) for i in range(600)]
    docs = corpus(spark, rows)
    got = mixing.plan(docs, carried=["doc_id", "source"]).select("row.*", "size", "source_size", "target", "copies").toPandas()
    assert len(got) == 600 and got.copies.between(0, 3).all()
    for _, one in got.groupby("source"):
        assert (one["size"] * one.copies).sum() == pytest.approx(one.target.iloc[0], rel=0.02)
        assert one["size"].sum() == one.source_size.iloc[0]
        rate = one.target.iloc[0] / one.source_size.iloc[0]
        assert one.copies.between(int(rate), int(rate) + 1).all()
    again = mixing.plan(docs.repartition(7), carried=["doc_id"]).select("row.doc_id", "copies").toPandas()
    assert dict(zip(got.doc_id, got.copies)) == dict(zip(again.doc_id, again.copies))
    mix = mixing.mixed(docs)
    assert mix.dtypes == docs.dtypes
    counts = {r.doc_id: r["count"] for r in mix.groupBy("doc_id").count().collect()}
    assert counts == {i: n for i, n in zip(got.doc_id, got.copies) if n}


def test_defined_cases(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "one two\tthree\n four", "a"), (None, "x y", None), (None, "x y", None), (4, " \n", "void"),
            (5, "p q", "b"), (5, "p q", "b")]
    docs = corpus(spark, rows, CLASHING)
    got = mixing.plan(docs)
    assert got.schema["row"].dataType == docs.schema
    found = got.select("row.doc_id", "row.source", "size", "source_size", "target", "copies").toPandas()
    assert sorted(found["size"]) == [0, 0, 0, 2, 2, 2, 2, 4]
    assert found[found.source == "void"].target.tolist() == [0.0] and found[found.source == "void"].copies.tolist() == [0]
    assert found[found.doc_id == 5].copies.nunique() == 1 and found[found.source.isna()].copies.nunique() == 1
    assert found[found.source == "a"].source_size.eq(4).all()
    assert mixing.mixed(docs).dtypes == docs.dtypes


def test_no_rows_and_no_words(spark):
    assert mixing.plan(corpus(spark, [])).collect() == []
    got = mixing.plan(corpus(spark, [(1, None, "a"), (2, "", None)])).select("target", "copies").collect()
    assert [tuple(r) for r in got] == [(0.0, 0)] * 2
