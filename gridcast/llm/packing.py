"""Packing along a space-filling curve.

Documents become hashed bags of words, signed and scaled to length one, are projected to a few dimensions and
ordered by the Hilbert key of that point, so that documents with similar words follow each other. A range sort
by (key, id) deals them out; the tasks tokenise their range in order, and the concatenation of all ranges is
cut every `length` tokens: a sequence holds neighbours of the curve, only the last one is padded.

A first pass writes each document's tokens with its offset inside its range; the ranges' totals (one number
per partition) give every range its place, and the second pass cuts documents at multiples of `length`.

Defined cases. Null or empty text: the closing id alone. Equal keys: ordered by id, and the range sort may cut
between them, so copies do not meet in one task. Repeated rows: each is packed. Null ids: first among equals.
Empty table: empty result. Long texts are cut over as many sequences as they fill. Columns other than id and
text are not read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from gridcast.llm import words as w
from gridcast.llm.tables import spread, stage

LENGTH = 2048
CLOSING_ID = 1
DIMENSIONS = 4
BITS = 12
BUCKETS = 1 << 10
PART_BYTES = 1 << 20


def byte_values() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: bytes without a printable form follow from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


@lru_cache(maxsize=2)
def encoding(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a tokenizers file. Its ids are those of the tokenizers library (tested), at three times the speed."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    value = byte_values()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(value[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
    ids = [spec["model"]["vocab"][a + b] for a, b in pairs]
    if ids != sorted(ids):
        raise ValueError("ids have to follow the order of the merges")
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Positions on the Hilbert curve of points with `bits` bits in each dimension (rows x dimensions)."""
    x = points.astype(np.int64).T.copy()
    dims, top = len(x), 1 << (bits - 1)
    q = top
    while q > 1:  # undo the turns of the sub-cubes, largest first
        low = q - 1
        for i in range(dims):
            far = (x[i] & q) > 0
            swap = np.where(far, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(far, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = top
    while q > 1:
        flip = np.where(x[-1] & q, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def curve_keys(column: pa.Array) -> np.ndarray:
    """Hilbert key of each text."""
    axes = np.random.default_rng(7).standard_normal((BUCKETS, DIMENSIONS))
    data, offsets = w.buffers(column)
    out = []
    for low, high in w.slices(offsets, PART_BYTES):
        part = data[offsets[low]:offsets[high]]
        starts, ends, first = w.word_spans(part, offsets[low:high + 1] - offsets[low])
        hashes = w.word_hashes(part, starts, ends)
        bucket = (hashes >> np.uint64(54)).astype(np.int64)
        sign = 1.0 - 2.0 * (hashes & np.uint64(1)).astype(np.float64)
        points = np.zeros((high - low, DIMENSIONS))
        for i, (a, b) in enumerate(zip(first[:-1], first[1:])):
            bag = np.bincount(bucket[a:b], sign[a:b], BUCKETS)
            if norm := np.sqrt(bag @ bag):
                points[i] = bag @ axes / norm
        # A unit vector's coordinates are normal; the logistic curve spreads them over the cells.
        cells = ((1 << BITS) / (1 + np.exp(-1.7 * points))).astype(np.int64)
        out.append(hilbert(np.minimum(cells, (1 << BITS) - 1), BITS))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(curve_keys(b.column(1)))], names=["id", "text", "key"])


def _tokenised(path: str, closing: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, at = encoding(path), TaskContext.get().partitionId(), 0
        kind = np.dtype("<u2") if max(coder.n_vocab, closing + 1) <= 1 << 16 else np.dtype("<u4")
        for b in batches:
            starts, sizes, rows = [], [], []
            for text in b.column(1).to_pylist():
                ids = np.append(coder.encode_to_numpy(text or "", allowed_special="all"), closing).astype(kind)
                rows.append(ids.tobytes())
                sizes.append(len(ids))
                starts.append(at)
                at += len(ids)
            n = len(rows)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([part] * n, pa.int32()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(rows, pa.binary())], names=["id", "part", "at", "tokens", "ids"])

    return w.lean(run)


def _pieces(length: int, with_ids: bool):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in names]
            for r, (at, size, raw) in enumerate(zip(*[b.column(i).to_pylist() for i in (1, 2, 3)])):
                ids = np.frombuffer(raw, f"<u{len(raw) // size}").astype("<u4")
                begin = 0
                while begin < size:
                    sequence, offset = divmod(at + begin, length)
                    piece = ids[begin:begin + length - offset].tobytes()
                    cells = [r, begin, len(piece) // 4, zlib.crc32(piece), size, sequence, offset, piece]
                    for column, cell in zip(out, cells):
                        column.append(cell)
                    begin += length - offset
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(out[0], pa.int64())), *[pa.array(c, pa.int64()) for c in out[1:7]],
                                              *[pa.array(c, pa.binary()) for c in out[7:]]], names=names)

    return w.lean(run)


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
         closing: int = CLOSING_ID, with_ids: bool = True) -> DataFrame:
    """One row per piece of a document: doc_id, start (its document's ids before it), length, ids_crc32,
    doc_tokens, sequence_id, offset (in the sequence) and, with_ids, ids (little-endian 32-bit)."""
    plain = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = plain.schema["id"].dataType.simpleString()
    ordered = (plain.mapInArrow(w.lean(_keyed), f"id {kind}, text string, key long")
               .repartitionByRange(spread(docs.sparkSession), "key", "id").sortWithinPartitions("key", "id"))
    tokens = stage(ordered.select("id", "text").mapInArrow(
        _tokenised(path, closing), f"id {kind}, part int, at long, tokens long, ids binary"), "tokens")
    base, bases = 0, []
    for r in tokens.groupBy("part").agg(F.sum("tokens").alias("n")).orderBy("part").collect():  # one row per partition
        bases.append((r.part, base))
        base += r.n
    places = docs.sparkSession.createDataFrame(bases, "part int, base long")
    placed = tokens.join(F.broadcast(places), "part").select("id", (F.col("at") + F.col("base")).alias("at"), "tokens", "ids")
    fields = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return placed.mapInArrow(_pieces(length, with_ids), f"doc_id {kind}, {fields}" + ", ids binary" * with_ids)
