"""Corpus pipeline: from `documents` to packed training sequences.

Each stage takes what its predecessor kept, written as Parquet in between. All but the last return the columns of
`documents`, whatever further ones there are; the last returns the pieces of documents with their token ids and places
in sequences. A stage's result reads tables that the stage wrote on its way; they go when a later stage is given
documents that are read from elsewhere, as then the result has been written. Stages may also be chained unwritten.

Defined cases, the same at every stage: an empty table gives an empty result, texts of any length are read whole, and
a null in any other column is carried along. What each stage does with null and empty texts, null ids, ties and
repeated rows is said there.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gridcast.llm import exact_dedup, language, minhash, packing, substrings
from gridcast.llm.tables import Passing, passing, stage, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised.

    Null and empty texts, texts without a letter and those below the calibrated score go. Repeated rows are judged
    alike, null ids like others. Null labels are not learnt from; if there is no label at all there is no model to
    judge by, and every document stays."""
    model = language.train(docs.where(language.learnable()))
    return docs if model is None else language.identify(docs, model).where("accepted").select("row.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of every group of equal texts: the row with the largest doc_id.

    Null and empty texts are equal. A null id is smaller than any other. Of rows that share id and text one stays."""
    return exact_dedup.deduplicated(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of every group of near copies: the row with the smallest doc_id.

    Texts without words are no copies of one another, each stays. A group's null ids go if it has another id; of rows
    that share the smallest id, and of a group with null ids only, one stays."""
    return minhash.deduplicated(docs)


def substring(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document with a smaller id holds.

    Null, empty and short texts and rows with null ids stay as they are; rows of one id are no repeats of each other.
    Documents of which no word is left go."""
    return substrings.without_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens.

    A null or empty text is its closing id alone. Every row is packed, repeated ones too; equal curve keys follow one
    another by id, null ids first."""
    return packing.pack(docs, TOKENIZER)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

_LEFT: list[Passing] = []


def _tidy(spark: SparkSession, docs: DataFrame) -> None:
    """Delete the tables of earlier stages, unless `docs` still reads them."""
    left, _LEFT[:] = [t for t in _LEFT if t.of(spark)], []
    for tables in left:
        if tables.read_by(docs):
            _LEFT.append(tables)
        else:
            tables.delete()


def _tidied(step: Stage) -> Stage:
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _tidy(spark, docs)
        with passing(spark, keep_all=True) as tables:
            out = step(spark, docs, sf_dir)
        _LEFT.append(tables)
        return out

    run_step.__doc__ = step.__doc__
    return run_step


STAGES: list[tuple[str, Stage]] = [(name, _tidied(step)) for name, step in (
    ("language_id", language_id), ("exact_dedup", exact), ("minhash_dedup", near), ("substring_dedup", substring), ("packing", pack))]

#: A trained model and fuzzy alignment take part; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, step in STAGES:
        with passing(spark, keep_all=True) as result:
            docs = stage(step(spark, docs, sf_dir), name)
        if before:
            before.delete()
        before = result
    _tidy(spark, docs)
    return docs
