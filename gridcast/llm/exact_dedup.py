"""Exact dedup by distributed MSD radix partitioning.

Every document is a byte string: its text, A-Z as a-z, in UTF-8; null text is empty. The radix key is that
string with its length in front. A round takes the next digit (a run of successive bytes, `growth` times as
wide in each round), counts documents per (group, digit) and lets go those that are alone; the others form
the groups of the next round until their bytes are used up. What ends together is equal, byte by byte; no
digest takes part. A text of n bytes is done after log(n / first) / log(growth) rounds.

Counts are pre-aggregated in the map tasks, and the count table joins back by a sort-merge join whose hot
groups Spark splits, so a group may hold any share of the rows.

Defined cases. Null or empty text: a text like any other (empty). Null id: counts as smaller than any id;
a group of null ids only has a null `keep_id`. Repeated rows (same id and text): all rows get the same answer,
each counts towards `group_size`; `deduplicated` returns one of them. Empty table: empty result. Further
columns are carried along whatever their names; own columns start with `_radix_`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from gridcast.llm.tables import passing, stage

FIRST_BYTES = 64
GROWTH = 8


def _lowered(text: Column) -> Column:
    """A-Z as a-z, nothing else: the length in bytes stays."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _digit(text: Column, at: int, width: int) -> Column:
    """Bytes of the key from `at` on. The first ones lie in as many characters, so a long text is not gone through for them."""
    part = F.substring(text, 1, width) if at == 0 else text
    return F.substring(_lowered(part).cast("binary"), at + 1, width)


def _split(rows: DataFrame, text: Column, counts: DataFrame, at: int, width: int) -> DataFrame:
    """The rows with their group of the next round; `_radix_over` marks those that are alone or used up."""
    over = (F.col("_radix_size") <= at + width) | F.col("_radix_n").isNull()
    extra = [F.when(~over, F.col("_radix_text")).alias("_radix_text")] if "_radix_text" in rows.columns else []
    joined = (rows.withColumn("_radix_digit", _digit(text, at, width))
              .join(counts.hint("merge"), ["_radix_group", "_radix_digit"], "left")
              .select("_radix_row", "_radix_sha", "_radix_size", *extra, F.col("_radix_next").alias("_radix_group"), "_radix_n", "_radix_keep",
                      over.alias("_radix_over")))
    return stage(joined, "radix-rows")


def equal_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carried: list[str] | None = None,
                 first: int = FIRST_BYTES, growth: int = GROWTH) -> DataFrame:
    """Columns `carried` (default: all), `text_sha256`, `keep_id` (largest id of the group) and `group_size`."""
    carried = docs.columns if carried is None else carried
    named = docs.withColumn("_radix_id", docs[id_col])
    # Each text moves once: in the carried row if it is there, else beside it until its group is settled.
    inside = text_col in carried
    text = F.coalesce(F.col("_radix_row").getField(text_col) if inside else F.col("_radix_text"), F.lit(""))
    rows = named.select(F.struct(*[named[c] for c in [*carried, "_radix_id"]]).alias("_radix_row"),
                        *([] if inside else [named[text_col].alias("_radix_text")]))
    kept = ["_radix_row", "_radix_sha", "_radix_size", *([] if inside else ["_radix_text"]), "_radix_group"]
    size = F.octet_length(text).cast("long")
    rows = rows.withColumns({"_radix_sha": F.sha2(_lowered(text).cast("binary"), 256), "_radix_size": size, "_radix_group": size})
    at, width, ended = 0, first, []
    while True:
        counts = (rows.groupBy("_radix_group", _digit(text, at, width).alias("_radix_digit"))
                  .agg(F.count(F.lit(1)).alias("_radix_n"), F.max("_radix_row._radix_id").alias("_radix_keep"))
                  .where("_radix_n > 1").withColumn("_radix_next", F.monotonically_increasing_id()))
        with passing(docs.sparkSession) as used:
            joined = _split(rows, text, stage(counts, "radix-counts"), at, width)
            used.keep(joined)
        ended.append(joined.where("_radix_over").select("_radix_row", "_radix_sha", "_radix_n", "_radix_keep"))
        rows = joined.where("NOT _radix_over").select(*kept)
        at, width = at + width, width * growth
        if rows.isEmpty():
            break
    out = reduce(DataFrame.unionAll, ended)
    alone = F.col("_radix_n").isNull()
    return out.select(*[F.col("_radix_row").getField(c).alias(c) for c in carried],
                      F.col("_radix_sha").alias("text_sha256"),
                      F.when(alone, F.col("_radix_row._radix_id")).otherwise(F.col("_radix_keep")).alias("keep_id"),
                      F.coalesce("_radix_n", F.lit(1)).cast("long").alias("group_size"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, one of every group of equal texts, with the columns of `docs`."""
    # Columns by place, so that none clashes with those of the groups.
    names = [f"_radix_c{i}" for i in range(len(docs.columns))]
    at = dict(zip(docs.columns, names))
    found = equal_groups(docs.toDF(*names), at[id_col], at[text_col], names)
    found = found.where(F.col(at[id_col]).eqNullSafe(F.col("keep_id")))
    back = [F.col(n).alias(c) for n, c in zip(names, docs.columns)]
    # Rows left in a group share id and text; one of them stays.
    rest = found.where("group_size > 1").dropDuplicates([at[id_col], "text_sha256"]).select(*back)
    return found.where("group_size = 1").select(*back).unionAll(rest)
