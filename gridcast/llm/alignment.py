"""Alignment of two tokenizers' tokens over the same texts.

A text is tokenised by a byte-level BPE (A, over a space and the text) and by a sentencepiece model (B, which puts a
space in front itself); tokens are intervals of the same bytes. Groups are the smallest stretches that both
tokenisations cut out: the components of the tokens under overlap.

Pointer jumping finds them. Every token points to the token farthest to the right among those that overlap it: an A
token to the B token that covers its last byte, a B token to the A token that covers its last byte if that ends
later, else to itself. Successors are doubled for all tokens of a slice of texts at once until nothing moves; each
token then holds the terminal B token of its component, its group's label. A chain of n tokens takes log2(n) steps.

Links are the pairs of an A and a B token that end on the same byte. Their pairs of ids are counted over the corpus,
pre-aggregated per document and task. Documents then need the counts of their own pairs: the FREQUENT most frequent
pairs, a table of fixed size, go to every task, and what pairs are not among them meet their counts by a join.

Defined cases. Null or empty texts, and texts whose bytes one of the tokenisations does not give back (B normalises,
or the text holds U+2581): no tokens, zeros, empty digest. Null ids and repeated rows: every row is answered for
itself and counts. Empty table: empty result. Columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from gridcast.llm import packing
from gridcast.llm.tables import passing, stage

#: Pairs that are sent to every task, 20 bytes each.
FREQUENT = 1 << 18
#: Pairs that a task holds before it passes its counts on.
HELD = 1 << 20
PART_BYTES = 1 << 19
#: Rows of pairs sent on at once.
SLICE = 1 << 16

_SHIFT = 32


class Vocabulary:
    """The bytes of a tokenizer's tokens, and their decimal ids before `,`, `|` and `;`."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.tokens = tokens
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.texts = np.array([f"{i}{end}" for end in ",|;" for i in range(len(tokens))], object)


@lru_cache(maxsize=2)
def coder_a(path: str):
    coder = packing.encoding(path)
    tokens = []
    for i in range(coder.n_vocab):
        try:
            tokens.append(coder.decode_single_token_bytes(i))
        except KeyError:
            tokens.append(b"")
    return coder, Vocabulary(tokens)


@lru_cache(maxsize=2)
def coder_b(path: str):
    coder = sentencepiece.SentencePieceProcessor(model_file=path)
    return coder, Vocabulary([bytes([int(coder.id_to_piece(i)[1:-1], 16)]) if coder.is_byte(i)
                              else coder.id_to_piece(i).replace("▁", " ").encode() for i in range(coder.vocab_size())])


def labels(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The terminal B token of every A and of every B token, by pointer jumping. Both arrays ascend and end alike."""
    n = len(ends_a)
    covers_a = np.searchsorted(ends_b, ends_a)  # the B token over an A token's last byte: none reaches farther
    covers_b = np.searchsorted(ends_a, ends_b)
    own = np.arange(len(ends_b)) + n
    successor = np.concatenate([covers_a + n, np.where(ends_a[covers_b] > ends_b, covers_b, own)])
    while True:
        further = successor[successor]
        if (further == successor).all():
            return successor[:n] - n, successor[n:] - n
        successor = further


def _aligned(path_a: str, path_b: str):
    """From (id, text): row (a number of its own), id, the document's figures and its pairs with their number."""
    def slices(texts: list[str | None]) -> Iterator[list[str | None]]:
        low, held = 0, 0
        for i, t in enumerate(texts):
            held += len(t or "")
            if held >= PART_BYTES:
                yield texts[low:i + 1]
                low, held = i + 1, 0
        if low < len(texts):
            yield texts[low:]

    def figures(texts: list[str | None]) -> list[tuple]:
        (one, first), (two, second) = coder_a(path_a), coder_b(path_b)
        raw = [b" " + t.encode() if t else b"" for t in texts]
        ids_a = [one.encode_to_numpy(" " + t, disallowed_special=()) if t else [] for t in texts]
        ids_b = two.encode([t or "" for t in texts], num_threads=1)
        for r, whole in enumerate(raw):
            if (b"".join(map(first.tokens.__getitem__, ids_a[r])) != whole
                    or b"".join(map(second.tokens.__getitem__, ids_b[r])) != whole):
                raw[r], ids_a[r], ids_b[r] = b"", [], []
        sizes_a, sizes_b = np.array([len(x) for x in ids_a]), np.array([len(x) for x in ids_b])
        a = np.concatenate([np.asarray(x, np.int64) for x in ids_a])
        b = np.concatenate([np.asarray(x, np.int64) for x in ids_b])
        if not len(a):
            return [(0, 0, 0, "", b"", b"")] * len(texts)
        ends_a, ends_b = np.cumsum(first.lengths[a]), np.cumsum(second.lengths[b])
        of_a, of_b = labels(ends_a, ends_b)
        terminal = np.flatnonzero(of_b == np.arange(len(b)))  # one per group, ascending
        group_a, group_b = np.searchsorted(terminal, of_a), np.searchsorted(terminal, of_b)
        # Tokens in the order of writing: by group, A before B.
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        last_a = np.append(group_a[1:] != group_a[:-1], True)
        last_b = np.append(group_b[1:] != group_b[:-1], True)
        written = np.concatenate([first.texts[a + len(first.tokens) * last_a],
                                  second.texts[b + 2 * len(second.tokens) * last_b]])[order]
        pairs = a[last_a] << _SHIFT | b[terminal]
        stops_a, stops_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
        stops = np.concatenate([[0], np.searchsorted(terminal, stops_b)])
        out = []
        for r in range(len(texts)):
            if not sizes_a[r]:
                out.append((0, 0, 0, "", b"", b""))
                continue
            low, high = stops_a[r] - sizes_a[r] + stops_b[r] - sizes_b[r], stops_a[r] + stops_b[r]
            text = "".join(written[low:high].tolist())[:-1]
            kinds, times = np.unique(pairs[stops[r]:stops[r + 1]], return_counts=True)
            out.append((int(sizes_a[r]), int(sizes_b[r]), int(stops[r + 1] - stops[r]), hashlib.sha256(text.encode()).hexdigest(),
                        kinds.astype("<i8").tobytes(), times.astype("<i4").tobytes()))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            out = [f for texts in slices(batch.column(1).to_pylist()) for f in figures(texts)]
            if not out:
                continue
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + len(out))), batch.column(0), *[pa.array(c, pa.int64()) for c in columns[:3]],
                 pa.array(columns[3], pa.string()), *[pa.array(c, pa.binary()) for c in columns[4:]]],
                names=["row", "id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"])
            row += len(out)
            pa.default_memory_pool().release_unused()

    return run


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs, their times, and how many each row has, from the last two columns."""
    kinds, times = (batch.column(i).to_pylist() for i in (-2, -1))
    return (np.frombuffer(b"".join(kinds), "<i8"), np.frombuffer(b"".join(times), "<i4").astype(np.int64),
            np.array([len(k) // 8 for k in kinds], np.int64))


def _summed(pairs: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(pairs, kind="stable")
    pairs, times = pairs[order], times[order]
    starts = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1])) if len(pairs) else np.zeros(0, np.int64)
    return pairs[starts], np.add.reduceat(times, starts) if len(starts) else times


def _counted(held: int):
    """Counts of the pairs of a task, passed on whenever more than `held` are at hand."""
    def sent(pairs: np.ndarray, times: np.ndarray) -> Iterator[pa.RecordBatch]:
        for low in range(0, len(pairs), SLICE):
            yield pa.RecordBatch.from_arrays([pa.array(pairs[low:low + SLICE]), pa.array(times[low:low + SLICE])], names=["pair", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            more, numbers, _ = _unpacked(batch)
            pairs, times = _summed(np.concatenate([pairs, more]), np.concatenate([times, numbers]))
            if len(pairs) > held:
                yield from sent(pairs, times)
                pairs, times = pairs[:0], times[:0]
        yield from sent(pairs, times)

    return run


def _looked_up(known: np.ndarray, counts: np.ndarray, best: np.ndarray):
    """Per document: row, None, and sums over its frequent pairs; and row, pair, times of each other pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, times, sizes = _unpacked(batch)
            rows = np.repeat(np.arange(len(sizes)), sizes)
            at = np.minimum(np.searchsorted(known, pairs), max(0, len(known) - 1))
            found = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
            total, top = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            np.add.at(total, rows[found], counts[at[found]] * times[found])
            np.add.at(top, rows[found], best[at[found]] * times[found])
            ids, n = batch.column(0), len(sizes)
            yield pa.RecordBatch.from_arrays([ids, pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(top), pa.array(total)], names=_PARTS)
            rows, pairs, times = rows[~found], pairs[~found], times[~found]
            for low in range(0, len(rows), SLICE):
                cut = slice(low, low + SLICE)
                m = len(rows[cut])
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows[cut])), pa.array(pairs[cut]), pa.array(times[cut]),
                                                  pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64())], names=_PARTS)

    return run


_PARTS = ["row", "pair", "times", "n_best", "count_sum"]


def pair_counts(documents: DataFrame, held: int = HELD) -> DataFrame:
    """From the table of aligned documents: pair, n (links that hold it) and best (n is the highest of its B id)."""
    counts = documents.select("pairs", "times").mapInArrow(_counted(held), "pair long, n long")
    counts = stage(counts.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("b", F.col("pair").bitwiseAND((1 << _SHIFT) - 1)), "pair-counts")
    highest = stage(counts.groupBy("b").agg(F.max("n").alias("most")), "highest")
    return stage(counts.join(highest, "b").select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best")), "pair-best")


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
            frequent: int = FREQUENT, held: int = HELD) -> DataFrame:
    """Per row of `docs`: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    plain = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = plain.schema["id"].dataType.simpleString()
    with passing(docs.sparkSession) as used:
        documents = stage(plain.mapInArrow(
            _aligned(path_a, path_b), f"row long, id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, "
            "pairs binary, times binary"), "aligned", compression="zstd")
        counts = pair_counts(documents, held)
        top = counts.orderBy(F.desc("n"), "pair").limit(frequent).orderBy("pair").toPandas()  # at most `frequent` rows
        shared = [top[c].to_numpy(np.int64) for c in ("pair", "n", "best")]
        parts = stage(documents.select("row", "pairs", "times").mapInArrow(
            _looked_up(*shared), ", ".join(f"{c} long" for c in _PARTS)), "pair-parts")
        rare = parts.where("pair IS NOT NULL").select("row", "pair", "times").join(counts, "pair").select(
            "row", (F.col("best") * F.col("times")).alias("n_best"), (F.col("n") * F.col("times")).alias("count_sum"))
        sums = rare.groupBy("row").agg(F.sum("n_best").alias("more_best"), F.sum("count_sum").alias("more_sum"))
        sums = stage(parts.where("pair IS NULL").select("row", "n_best", "count_sum").join(sums, "row", "left").select(
            "row", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
            (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum")), "pair-sums")
        used.keep(documents, sums)
    return documents.select("row", "id", "n_a", "n_b", "n_groups", "groups_sha256").join(sums, "row").select(
        "id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256")
