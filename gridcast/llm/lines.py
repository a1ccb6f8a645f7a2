"""Line dedup with a log-template tree.

A line is what stands between line feeds; its tokens are runs of bytes outside ASCII white space. Tokens with a
digit, an `@` or `://` are variable fields and become `<*>`.

1. Tree. A line falls to the leaf of its number of tokens and its first `depth` tokens: a tree of fixed depth.
   Only leaves that `min_texts` different texts reach go on.
2. Template. In a leaf, a token that stands at its place in the lines of `min_texts` texts is constant, any
   other is a variable field: `<*>`.
3. A template that occurs in `min_texts` different texts and is constant in at least `constant` of its tokens
   recurs; its lines are dropped from all documents.

Texts are counted, not documents, so exact copies of a text do not make its lines recur, and equal texts are
worked on once. All counts are aggregated in the map tasks first; joins on hot leaves can be split.

Defined cases. Null or empty text: no lines, nothing dropped. Blank lines: kept, no template. Repeated rows:
cleaned alike. Empty table: empty result. Lines and texts of any length are read whole. `without_templates`
carries all columns along, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from gridcast.llm.tables import passing, stage

DEPTH = 3
MIN_TEXTS = 5
CONSTANT = 0.6
FIELD = "<*>"

_VARIABLE = re.compile(rb"[0-9@]|://")


def _general(token: bytes) -> bytes:
    return FIELD.encode() if _VARIABLE.search(token) else token


def masked(line: str) -> list[str]:
    """The tokens of a line, variable fields generalised."""
    return [_general(t).decode() for t in line.encode().split()]


def _digest(text: str) -> bytes:
    return xxhash.xxh3_128_digest(text.encode())


def _leaves(depth: int, with_lines: bool):
    """The leaf of every line; with_lines: also its number and the line."""
    names = ["text", "size", "head", *["line", "raw"] * with_lines]

    def made(columns: list[list]) -> pa.RecordBatch:
        kinds = [pa.binary(), pa.int32(), pa.binary(), pa.int32(), pa.binary()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays([a.cast(pa.string()) if n in ("head", "raw") else a for a, n in zip(arrays, names)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in names]
            for text in b.column(0).to_pylist():
                key = _digest(text) if text else b""
                for number, raw in enumerate(text.encode().split(b"\n") if text else ()):
                    if tokens := raw.split():
                        cells = (key, len(tokens), b" ".join(map(_general, tokens[:depth])), number, raw)
                        for column, cell in zip(out, cells):
                            column.append(cell)
                if len(out[0]) > 20_000:
                    yield made(out)
                    out = [[] for _ in names]
            yield made(out)

    return run


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        tokens = pa.array([masked(x) for x in b.column(4).to_pylist()], pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([*b.columns[:4], tokens], names=["text", "size", "head", "line", "tokens"])


def recurring(docs: DataFrame, text_col: str = "text", depth: int = DEPTH, min_texts: int = MIN_TEXTS,
              constant: float = CONSTANT) -> DataFrame:
    """Columns text (digest of a text), line (number, from 0) and template of all lines to drop."""
    plain = docs.select(docs[text_col].alias("text"))
    key = "text binary, size int, head string"
    reached = (plain.mapInArrow(_leaves(depth, False), key).distinct().groupBy("size", "head").count()
               .where(F.col("count") >= min_texts).select("size", "head"))
    reached = stage(reached, "leaves")
    rows = plain.mapInArrow(_leaves(depth, True), f"{key}, line int, raw string").join(reached.hint("merge"), ["size", "head"])
    rows = stage(rows.select("text", "size", "head", "line", "raw"), "leaf-lines").dropDuplicates(["text", "line"])
    rows = stage(rows.mapInArrow(_tokens, f"{key}, line int, tokens array<string>"), "lines")
    cells = rows.select("text", "line", "size", "head", F.posexplode("tokens").alias("at", "token"))
    place = ["size", "head", "at", "token"]
    constants = stage(cells.where(F.col("token") != FIELD).select(*place, "text").distinct().groupBy(*place).count()
                      .where(F.col("count") >= min_texts).select(*place, F.lit(True).alias("fixed")), "constants")
    templates = (cells.join(constants.hint("merge"), place, "left")
                 .groupBy("text", "line", "size", "head")
                 .agg(F.array_sort(F.collect_list(F.struct("at", F.when(F.col("fixed"), F.col("token")).otherwise(FIELD).alias("token")))).alias("cells"),
                      F.count("fixed").alias("fixed"))
                 .where(F.col("fixed") >= constant * F.col("size"))
                 .select("text", "line", F.concat_ws(" ", F.transform("cells", lambda c: c.token)).alias("template")))
    templates = stage(templates, "templates")
    often = stage(templates.select("text", "template").distinct().groupBy("template").count()
                  .where(F.col("count") >= min_texts).select("template"), "recurring")
    return templates.join(often.hint("merge"), "template").select("text", "line", "template")


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts, lines, dropped = [], [], []
        for text, drop in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            split = text.split("\n") if text else []
            gone = set(drop or ())
            texts.append("\n".join(line for i, line in enumerate(split) if i not in gone) if gone else text)
            lines.append(len(split))
            dropped.append(len(gone))
        yield pa.RecordBatch.from_arrays([b.column(2), pa.array(texts, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
                                         names=["row", "text", "n_lines", "n_dropped"])


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keys = [_digest(t) if t else None for t in b.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(keys, pa.binary())], names=["text", "row", "key"])


def without_templates(docs: DataFrame, text_col: str = "text", carried: list[str] | None = None, **settings) -> DataFrame:
    """Columns row (struct of the carried columns, default all), text (without the lines), n_lines and n_dropped."""
    carried = docs.columns if carried is None else carried
    with passing(docs.sparkSession) as used:
        drops = stage(recurring(docs, text_col, **settings).groupBy(F.col("text").alias("key"))
                      .agg(F.collect_list("line").alias("drop")), "drops")
        used.keep(drops)
    plain = docs.select(docs[text_col].alias("text"), F.struct(*[docs[c] for c in carried]).alias("row"))
    keyed = plain.mapInArrow(_keyed, T.StructType([*plain.schema.fields, T.StructField("key", T.BinaryType())]))
    joined = keyed.join(drops.hint("merge"), "key", "left").select("text", "drop", "row")
    return joined.mapInArrow(_cleaned, T.StructType([plain.schema["row"], plain.schema["text"], T.StructField("n_lines", T.LongType()),
                                                     T.StructField("n_dropped", T.LongType())]))
