"""The operators' queries: against SQL where there is SQL, else against plain versions, on the smallest tables."""

import hashlib
import os
import zlib

import corpus_pipeline
import duckdb
import numpy as np
import pandas as pd
import pytest
import regex
from test_llm_alignment import FIGURES, plain as plain_alignment
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
from gridcast.llm import exact_dedup, queries
from gridcast.llm.tables import table
from gridcast.session import scratch_root

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def read(name):
    return pd.read_parquet(f"{SF_DIR}/{name}.parquet")


def cells(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    show = lambda x: "~" if x is None or x is pd.NA or x != x else repr(float(x)) if isinstance(x, float) and x != int(x) else str(int(x)) if isinstance(x, (int, float, np.integer)) and not isinstance(x, bool) else str(x)  # noqa: E501,E731
    return sorted(map(tuple, frame.map(show).to_numpy().tolist()))


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    assert cells(entry_points.queries()[name](spark, SF_DIR).toPandas()) == cells(duck.sql(entry_points.oracle_sql()[name]).df())


def test_one_query_of_each_operator():
    names = [n for n in entry_points.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry_points.queries()


@pytest.fixture(scope="module")
def ids():
    coder = Tokenizer.from_file(queries.TOKENIZER)
    docs = read("documents")
    return {i: coder.encode(t or "", add_special_tokens=False).ids for i, t in zip(docs.doc_id, docs.text)}


def test_packing(spark, ids):
    got = entry_points.queries()["op1_packing"](spark, SF_DIR).toPandas()
    assert got.length.sum() == sum(len(x) + 1 for x in ids.values()) and set(got.doc_id) == set(ids)
    for p in got.itertuples():
        own = np.array([*ids[p.doc_id], 1], "<u4")[p.start:p.start + p.length]
        assert zlib.crc32(own.tobytes()) == p.ids_crc32 and p.doc_tokens == len(ids[p.doc_id]) + 1


def test_bpe(spark, ids):
    got = entry_points.queries()["op6_bpe"](spark, SF_DIR).toPandas().set_index("doc_id")
    texts = read("documents").set_index("doc_id").text
    for i, own in ids.items():
        assert got.n_tokens[i] == len(own) and got.ids_sha256[i] == hashlib.sha256(",".join(map(str, own)).encode()).hexdigest()
        assert got.decoded_sha256[i] == hashlib.sha256((texts[i] or "").encode()).hexdigest()


def test_alignment(spark):
    docs = read("documents")
    got = entry_points.queries()["op13_alignment"](spark, SF_DIR).toPandas().set_index("doc_id")
    for i, want in zip(docs.doc_id, plain_alignment([t or None for t in docs.text])):
        assert tuple(got.loc[i, FIGURES]) == want


def test_language(spark):
    docs = read("documents")
    got = entry_points.queries()["op5_language_id"](spark, SF_DIR).toPandas().merge(docs, on="doc_id")
    assert len(got) == len(docs) and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    held = got[got.held_out & got.lang.notna()]
    assert (held.lang_pred == held.lang).mean() > 0.95


def test_html(spark):
    """The article of the tables' one template, taken by a pattern of its own."""
    import html
    got = entry_points.queries()["op7_html"](spark, SF_DIR).toPandas().set_index("page_id")
    for p in read("pages").itertuples():
        body = regex.search(r"<article>(.*?)(</article>|$)", p.html or "", regex.S)
        blocks = regex.split(r"</?(?:p|h1|br)>", body[1]) if body else []
        text = " ".join(filter(None, (" ".join(html.unescape(regex.sub("<[^>]*(>|$)", "", b)).split()) for b in blocks)))
        assert got.text[p.page_id] == text and got.n_chars[p.page_id] == len(text)


def test_substrings(spark):
    """Documents that share a run of 50 words with an earlier one are found; every span does repeat."""
    docs = read("documents")
    words = {i: (t or "").encode().lower().split() for i, t in zip(docs.doc_id, docs.text)}
    got = entry_points.queries()["op4_substring_dedup"](spark, SF_DIR).toPandas()
    first, need = {}, set()
    for i in sorted(words):
        for a in range(len(words[i]) - 49):
            if first.setdefault(tuple(words[i][a:a + 50]), i) != i:
                need.add(i)
    assert need <= set(got.doc_id)
    for s in got.itertuples():
        assert s.holder_id < s.doc_id and s.end_word - s.start_word >= 50
        mine, theirs = words[s.doc_id][s.start_word:s.end_word], words[s.holder_id][s.holder_start:s.holder_end]
        assert s.equal_words >= 0.8 * max(len(mine), len(theirs)) and s.equal_words <= len(mine)


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_pipeline_stages(spark):
    docs = table(spark, SF_DIR, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "minhash_dedup", "substring_dedup", "packing"]
    after = {}
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.stage(step(spark, docs, SF_DIR), name)
        assert out.dtypes == docs.dtypes
        after[name], before, docs = out.toPandas(), docs.toPandas(), out
        if name == "language_id":
            assert len(after[name]) >= 0.98 * len(before[before.text.str.contains(r"[a-z]", na=False)])
        if name == "exact_dedup":
            assert sorted(after[name].doc_id) == sorted(before.groupby(before.text.str.encode("utf-8").map(bytes.lower)).doc_id.max())
        if name == "minhash_dedup":
            sets = {i: shingles(t) for i, t in zip(before.doc_id, before.text)}
            kept = set(after[name].doc_id)
            near = lambda a, b: a and b and 100 * len(a & b) >= 75 * len(a | b)
            smaller = {i for i in sets for j in sets if j < i and near(sets[i], sets[j])}
            assert not kept & smaller and all(i in kept for i in sets if not any(near(sets[i], sets[j]) for j in sets if j != i))
        if name == "substring_dedup":
            kept = dict(zip(after[name].doc_id, after[name].text))
            assert all(len(t) == n for t, n in zip(after[name].text, after[name].n_chars))
            first = {}
            for i in sorted(kept):
                w = kept[i].encode().lower().split()
                assert all(first.setdefault(tuple(w[a:a + 60]), i) == i for a in range(len(w) - 59))
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).toPandas()
    assert set(packed.doc_id) == set(after["substring_dedup"].doc_id)
    assert packed.groupby("sequence_id").length.sum().iloc[:-1].eq(2048).all()


def test_stages_take_empty_documents(spark):
    docs = table(spark, SF_DIR, "documents").limit(0)
    for _, step in corpus_pipeline.STAGES:
        out = step(spark, docs, SF_DIR)
        assert out.collect() == []


def test_stages_can_be_chained_unwritten_and_run_leaves_its_result_only(spark):
    docs = table(spark, SF_DIR, "documents")
    for _, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, SF_DIR)
    chained = {r.doc_id for r in docs.select("doc_id").collect()}
    before = set(os.listdir(scratch_root(spark)))
    packed = entry_points.queries()["pipeline"](spark, SF_DIR)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == chained
    assert len(set(os.listdir(scratch_root(spark))) - before) == 1


def test_exact_dedup_reads_whole_texts(spark):
    docs = table(spark, SF_DIR, "documents")
    assert exact_dedup.equal_groups(docs, carried=["doc_id"]).count() == docs.count()


def test_warc_query_takes_null_ids(spark, tmp_path):
    pages = pd.DataFrame({"page_id": pd.array([None, 3, 5, None], "Int64"), "url": ["u", "u", None, None], "html": ["a", "a", None, "b"]})
    pages.to_parquet(tmp_path / "pages.parquet")
    got = entry_points.queries()["op3_warc"](spark, str(tmp_path)).toPandas()
    assert sorted(got.page_id.dropna()) == [3, 5] and got.page_id.isna().sum() == 2
    assert got[got.page_id == 3].record_type.tolist() == ["response"] and sorted(got.payload_bytes) == [0, 1, 1, 1]
