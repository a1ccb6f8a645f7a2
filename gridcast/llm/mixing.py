"""Mixing sources to target weights.

1. Words are counted per source. Sources, in the order of their code points and null last, take the weights in
   turn; each one's target is its share of all words by weight, but at most `cap` times what it has. What a source
   cannot take is shared again among the others by weight, until none is above (water filling: every round is an
   aggregate over the table of sources, of which only two sums reach the driver).
2. A source's rate is target / size. Each document is emitted floor(rate) times, plus once more if a draw from the
   hash of its id, size and a seed lies below the fraction of the rate.
3. Independent draws leave a source of few or long documents far from its target. All `SEEDS` seeds are therefore
   summed up in one pass per source, and the source uses the seed whose total is nearest to its target.

The table of sources has one row each; it joins back by a null-safe join that Spark plans by the table's size, and
whose hot keys it splits. Counting is pre-aggregated in the map tasks.

Defined cases. Null or empty text, or no words: size 0, emitted as often as its source's rate says, takes no words.
Null source: a source of its own, the last one. Null id: drawn by its size alone. Repeated rows: each counts, all
draw alike. A source without words, or no words at all: target 0, nothing is emitted. Empty table: empty result.
Further columns are carried along whatever their names; own columns start with `_mix_`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from gridcast.llm.ranking import ranked
from gridcast.llm.tables import passing, stage

WEIGHTS = (5, 2, 1)
CAP = 3
SEEDS = 32
DRAW_BITS = 48


def words(text: Column) -> Column:
    """Runs of bytes outside ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _extra(seed: Column) -> Column:
    """Whether the draw under this seed adds a copy."""
    digits = F.substring(F.md5(F.concat(F.col("_mix_key"), F.lit("|"), seed.cast("string")).cast("binary")), 1, DRAW_BITS // 4)
    return F.conv(digits, 16, 10).cast("double") / float(1 << DRAW_BITS) < F.col("_mix_rate") - F.floor("_mix_rate")


def _copies(seed: Column) -> Column:
    return F.floor("_mix_rate") + _extra(seed).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """sizes: one row per source, columns source and size. Columns source, size, weight, target."""
    order = [F.col("source").isNull(), F.col("source")]
    turn = F.col("_place") % len(weights)
    weight = reduce(lambda rest, i: F.when(turn == i, weights[i]).otherwise(rest), range(len(weights)), F.lit(None).cast("long"))
    rows = stage(ranked(sizes, order, [], "mix-places").select("source", "size", weight.cast("long").alias("weight")), "mix-weights")
    wide = "decimal(38,0)"
    total, pool, sources = rows.agg(F.sum(F.col("size").cast(wide)), F.sum(F.col("weight").cast(wide)), F.count(F.lit(1))).first()
    rest, shared, full = int(total or 0), int(pool or 0), 0

    def at_cap() -> Column:
        """The cap is at most the source's share of what is left."""
        return (cap * F.col("size")).cast(wide) * F.lit(str(shared)).cast(wide) <= F.col("weight").cast(wide) * F.lit(str(rest)).cast(wide)

    while sources:
        taken, used, n = rows.where(at_cap()).agg(F.sum((cap * F.col("size")).cast(wide)), F.sum(F.col("weight").cast(wide)),
                                                  F.count(F.lit(1))).first()
        if n == full:
            break
        full, rest, shared = n, int(total) - int(taken), int(pool) - int(used)
    share = F.lit(float(rest)) * F.col("weight") / F.lit(float(shared or 1))
    return rows.withColumn("target", F.when(at_cap(), (cap * F.col("size")).cast("double")).otherwise(share))


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carried: list[str] | None = None,
         weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seeds: int = SEEDS) -> DataFrame:
    """Per row of `docs`: `row` (a struct of the carried columns, default all), size (its words), source_size, target
    (both of its source) and copies (how often the mix holds it)."""
    carried = docs.columns if carried is None else carried
    size = words(docs[text_col])
    sized = docs.select(
        F.struct(*[docs[c] for c in carried]).alias("_mix_row"), docs[source_col].alias("_mix_source"), size.alias("_mix_size"),
        F.concat(F.coalesce(docs[id_col].cast("string"), F.lit("")), F.lit("|"), size.cast("string")).alias("_mix_key"))
    with passing(docs.sparkSession) as used:
        slim = stage(sized if text_col not in carried else sized.drop("_mix_row"), "mix-sizes")
        sizes = slim.groupBy(F.col("_mix_source").alias("source")).agg(F.sum("_mix_size").alias("size"))
        rates = targets(stage(sizes, "mix-sources"), weights, cap)
        rates = rates.withColumn("_mix_rate", F.coalesce(F.try_divide("target", "size"), F.lit(0.0)))
        rates = stage(rates.withColumnsRenamed({"size": "source_size"}), "mix-rates")
        drawn = slim.join(rates, F.col("_mix_source").eqNullSafe(F.col("source")))
        totals = drawn.groupBy("source").agg(F.first("target").alias("target"), *[
            F.sum(F.col("_mix_size") * _copies(F.lit(s))).alias(f"_s{s}") for s in range(seeds)])
        nearest = F.array_min(F.array(*[F.struct(F.abs(F.col(f"_s{s}") - F.col("target")).alias("off"), F.lit(s).alias("seed"))
                                        for s in range(seeds)]))
        best = totals.select(F.col("source").alias("_mix_of"), nearest["seed"].alias("_mix_seed"))
        chosen = rates.join(stage(best, "mix-seeds"), F.col("source").eqNullSafe(F.col("_mix_of"))).select(
            "source", "source_size", "target", "_mix_rate", "_mix_seed")
        chosen = stage(chosen, "mix-chosen")
        used.keep(chosen, slim)
    rows = sized if text_col in carried else slim
    return rows.join(chosen, F.col("_mix_source").eqNullSafe(F.col("source"))).select(
        F.col("_mix_row").alias("row"), F.col("_mix_size").alias("size"), "source_size", "target",
        _copies(F.col("_mix_seed")).alias("copies"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as the plan says, with the columns of `docs`."""
    planned = plan(docs, **options).where("copies > 0")
    return planned.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")
