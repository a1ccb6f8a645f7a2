"""Near-dedup by min-max hashing.

A document is the set of its distinct five-word shingles (words.py); with fewer words the whole sequence is its
one shingle, without words it has none and is linked with nothing. Each permutation of the hash space yields
two signature values, the smallest and the largest image of the set: half the hash evaluations of plain MinHash
for as many values. A band joins values of `rows` different permutations, minima and maxima in bands of their
own; with 64 permutations and 4 rows (32 bands) a pair at the threshold 0.75 misses every band with
probability (1 - 0.75^4)^32 = 5e-6.

Equal word sequences form one class before banding. Classes that share a bucket are candidates, yet not all
their pairs are formed:

1. Every class of a bucket is compared with the bucket's hub: the class whose buckets are largest altogether,
   which in a group of near copies is the text they come from.
2. Of these links the components are taken. Pairs of candidates in different components are left, and for them
   the shingles of the classes in mixed buckets are joined by prefixes: two sets within the threshold share one
   of the rarest shingles of each, as many as the threshold leaves room for, so the common shingles of a large
   group bring no pairs.

A large group of near copies thus costs links in proportion to its size, and no pair of candidates within the
threshold is lost between components. Every link is confirmed on the full shingle sets:
100 * intersection >= 75 * union.

Defined cases. Null or empty text, or no words: no shingles, component of its own. Null id: takes part; the
component's id is its smallest non-null id, else null. Repeated rows: all get the same answer; `deduplicated`
returns one of them. Empty table: empty result. Further columns are carried along by `deduplicated` only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from gridcast.llm import words as w
from gridcast.llm.components import components
from gridcast.llm.tables import passing, stage

SHINGLE = 5
PERMUTATIONS = 64
BAND_ROWS = 4
PERCENT = 75
#: Bytes of text hashed at once.
PART_BYTES = 1 << 20


def _parts(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word hashes of successive rows, and where each row's words begin (one more at the end)."""
    data, offsets = w.buffers(column)
    for low, high in w.slices(offsets, PART_BYTES):
        part = data[offsets[low]:offsets[high]]
        starts, ends, first = w.word_spans(part, offsets[low:high + 1] - offsets[low])
        yield w.word_hashes(part, starts, ends), first


def _sets(hashes: np.ndarray, first: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    shingles, out = w.runs(hashes, size), []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= size:
            out.append(np.unique(shingles[a:b - size + 1]))
        elif b > a:
            out.append(w.runs(hashes[a:b], int(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _signatures(size: int, permutations: int, band_rows: int):
    spread = np.random.default_rng(5)
    factors = spread.integers(1, 1 << 63, permutations, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = spread.integers(0, 1 << 63, permutations, dtype=np.uint64)
    bands = permutations // band_rows

    def of(sets: list[np.ndarray]) -> np.ndarray:
        """A row of band hashes for each set; none may be empty."""
        starts = np.cumsum([0, *map(len, sets[:-1])])
        whole = np.concatenate(sets)
        out = np.empty((len(sets), 2 * bands), np.uint64)
        for band in range(bands):
            low, high = np.uint64(2 * band + 1), np.uint64(2 * band + 2)
            for k in range(band * band_rows, (band + 1) * band_rows):
                image = whole * factors[k] + shifts[k]
                low = w.mix(low + np.minimum.reduceat(image, starts))
                high = w.mix(high + np.maximum.reduceat(image, starts))
            out[:, 2 * band], out[:, 2 * band + 1] = low, high
        return out.view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, nodes, rows, has = [], [], [], []
            for hashes, first in _parts(b.column(1)):
                sets = _sets(hashes, first, size)
                counts += map(len, sets)
                nodes += [xxhash.xxh3_128_digest(hashes[a:z].tobytes()) if z > a else None for a, z in zip(first[:-1], first[1:])]
                has += [len(s) > 0 for s in sets]
                if some := [s for s in sets if len(s)]:
                    rows.append(of(some))
            flat = np.concatenate(rows) if rows else np.zeros((0, 2 * bands), np.int64)
            ends = np.concatenate([[0], np.cumsum(has)]).astype(np.int32) * (2 * bands)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(counts, pa.int64()), pa.array(nodes, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.ravel()))],
                names=["id", "n_shingles", "node", "bands"])

    return w.lean(run)


def _nodes(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for column in columns:
        yield pa.array([xxhash.xxh3_128_digest(h[a:z].tobytes()) if z > a else None
                        for h, first in _parts(column) for a, z in zip(first[:-1], first[1:])], pa.binary())
        w.give_back()


def node_of(text: Column) -> Column:
    """Digest of the word sequence of a text, null without words. Only the text goes to the Python worker."""
    return F.arrow_udf(_nodes, T.BinaryType()).asNondeterministic()(text)


def _confirm(size: int, percent: int):
    def sets(column: pa.Array) -> list[np.ndarray]:
        return [s for hashes, first in _parts(column) for s in _sets(hashes, first, size)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(sets(b.column(2)), sets(b.column(3))):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both) and both > 0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return w.lean(run)


def _shingles(size: int):
    """Rows (class, number of its shingles, shingle) from rows (class, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            low = 0
            for hashes, first in _parts(b.column(1)):
                sets = _sets(hashes, first, size)
                sizes = np.array([len(s) for s in sets], np.int64)
                rows = np.repeat(np.arange(low, low + len(sets)), sizes)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(rows)), pa.array(np.repeat(sizes, sizes)),
                     pa.array(np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64))], names=["c", "n", "shingle"])
                low += len(sets)

    return w.lean(run)


def _across(members: DataFrame, labels: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs x, y of classes with different labels that may be within the threshold, of the classes in buckets
    with several labels: a prefix-filtered join of their shingles."""
    known = members.select("band", "c").join(labels.withColumnRenamed("node", "c").hint("merge"), "c", "left").select(
        "band", "c", F.coalesce("label", "c").alias("label"))
    known = stage(known, "labelled")
    mixed = known.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("band")
    some = stage(known.join(stage(mixed, "mixed").hint("merge"), "band").select("c", "label").distinct(), "some")
    shingles = stage(texts.join(some.hint("merge"), "c").select("c", "text")
                     .mapInArrow(_shingles(size), "c long, n long, shingle long"), "shingles")
    counts = stage(shingles.groupBy("shingle").agg(F.count(F.lit(1)).alias("classes")), "counts")

    # Two sets of a >= b shingles share at least percent / (100 + percent) * (a + b) of them, so they have one in
    # common among the first a - ceil(p a) + 1 and b - ceil(2 p / (1 + p) b) + 1 of one order of all shingles.
    rarest = Window.partitionBy("c").orderBy("classes", "shingle")
    n, rank = F.col("n"), F.col("rank")
    prefix = (shingles.join(counts.hint("merge"), "shingle").withColumn("rank", F.row_number().over(rarest))
              .where(rank <= n - F.ceil(percent * n / 100) + 1).where("classes > 1")
              .withColumn("short", rank <= n - F.ceil(2 * percent * n / (100 + percent)) + 1))
    prefix = stage(prefix.join(some.hint("merge"), "c").select("shingle", "c", "n", "rank", "short", "label"), "prefixes")
    parts = prefix.groupBy("shingle", "label").agg(F.count(F.lit(1)).alias("classes"))
    mains = stage(parts.groupBy("shingle").agg(F.count(F.lit(1)).alias("labels"), F.max_by("label", F.struct("classes", "label")).alias("main"))
                  .where("labels > 1").select("shingle", "main"), "mains")
    # Classes outside a shingle's main component against all others: no pair inside a component is formed.
    few = stage(prefix.join(mains.hint("merge"), "shingle").where("label <> main")
                .select("shingle", *[F.col(c).alias(f"{c}_x") for c in ("c", "n", "rank", "short", "label")]), "few")
    larger = (F.col("n_x") > n) | ((F.col("n_x") == n) & (F.col("c_x") > F.col("c")))
    enough = (F.least(F.col("n_x") - F.col("rank_x"), n - rank) + 1) * (100 + percent) >= percent * (F.col("n_x") + n)
    return (prefix.join(few.hint("merge"), "shingle")
            .where((F.col("label") != F.col("label_x")) & F.when(larger, F.col("short")).otherwise(F.col("short_x")) & enough)
            .select(F.col("c_x").alias("x"), F.col("c").alias("y")))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                permutations: int = PERMUTATIONS, band_rows: int = BAND_ROWS, percent: int = PERCENT) -> DataFrame:
    """One row per row of `docs`: id, n_shingles, node (digest of the word sequence, null without words),
    rows (rows in the component), component (a number for it) and
    component_id (smallest id reachable)."""
    with passing(docs.sparkSession) as used:
        plain = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
        kind = plain.schema["id"].dataType.simpleString()
        signed = stage(plain.mapInArrow(_signatures(size, permutations, band_rows),
                                        f"id {kind}, n_shingles long, node binary, bands array<long>"), "signatures")
        classes = stage(signed.where("node IS NOT NULL").groupBy("node")
                        .agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("rows"),
                             F.any_value("n_shingles").alias("n"), F.any_value("bands").alias("bands"))
                        .withColumn("c", F.monotonically_increasing_id()), "classes")
        banded = classes.select("c", "n", F.explode("bands").alias("band"))
        buckets = stage(banded.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "buckets")
        members = stage(banded.join(buckets.hint("merge"), "band"), "members")
        weights = stage(members.groupBy("c").agg(F.sum("size").alias("weight")), "weights")
        hubs = (members.join(weights.hint("merge"), "c").groupBy("band")
                .agg(F.max(F.struct("weight", "c", "n")).alias("hub")).select("band", "hub.c", "hub.n"))
        hubs = stage(hubs.withColumnsRenamed({"c": "hub", "n": "hub_n"}), "hubs")

        # One text of every class that shares a bucket: a row of its smallest id.
        wanted = weights.select("c").join(classes.select("c", "node", F.xxhash64("id").alias("h")).hint("merge"), "c")
        found = plain.withColumn("node", node_of(F.col("text"))).withColumn("h", F.xxhash64("id")).join(
            stage(wanted, "wanted").hint("merge"), ["node", "h"])
        texts = stage(found.groupBy("node", "h").agg(F.any_value("c").alias("c"), F.any_value("text").alias("text"))
                      .select("c", "text"), "texts")

        def confirmed(pairs: DataFrame) -> DataFrame:
            pairs = stage(pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "pairs")
            both = (pairs.join(texts.select(F.col("c").alias("a"), F.col("text").alias("text_a")).hint("merge"), "a")
                    .join(texts.select(F.col("c").alias("b"), F.col("text").alias("text_b")).hint("merge"), "b"))
            return stage(both.select("a", "b", "text_a", "text_b").mapInArrow(_confirm(size, percent), "a long, b long"), "links")

        links = confirmed(members.join(hubs.hint("merge"), "band").where("c <> hub")
                          .where(100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n"))
                          .select(F.col("hub").alias("x"), F.col("c").alias("y")))
        labels = stage(components(links), "labels")
        links = links.unionAll(confirmed(_across(members, labels, texts, size, percent)))
        labels = stage(components(links), "labels")

        labelled = classes.select("c", "node", "id", "rows").join(
            labels.withColumnRenamed("node", "c").hint("merge"), "c", "left").select(
            "node", "id", "rows", F.coalesce("label", "c").alias("label"))
        labelled = stage(labelled, "labelled")
        lowest = stage(labelled.groupBy("label").agg(F.min("id").alias("component_id"), F.sum("rows").alias("rows")), "lowest")
        named = stage(labelled.select("node", "label").join(lowest.hint("merge"), "label").select("node", "component_id", "rows", "label"),
                      "named")
        used.keep(signed, named)
    return signed.select("id", "n_shingles", "node").join(named.hint("merge"), "node", "left").select(
        "id", "n_shingles", "node", "rows", F.col("label").alias("component"),
        F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of every group (that with the smallest id), with the columns of `docs`."""
    wide = docs.select(docs[id_col].alias("id"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    rows = wide.select("id", node_of(F.col("row").getField(text_col)).alias("node"), "row").withColumn("h", F.xxhash64("id"))
    with passing(docs.sparkSession) as used:
        groups = near_groups(docs, id_col, text_col)
        stays = (groups.where("node IS NOT NULL").where(F.col("id").eqNullSafe(F.col("component_id")))
                 .groupBy("node", F.xxhash64("id").alias("h"))
                 .agg(F.max("rows").alias("rows"), F.max("component").alias("component")))
        kept = stage(rows.join(stage(stays, "stays").hint("merge"), ["node", "h"]).select("row", "rows", "component"), "kept")
        used.keep(kept)
    # Several rows of one component can share its smallest id; one of them stays.
    return (rows.where("node IS NULL").select("row.*").unionAll(kept.where("rows = 1").select("row.*"))
            .unionAll(kept.where("rows > 1").dropDuplicates(["component"]).select("row.*")))
