"""Row-based windows over long series.

`over_rows` numbers the rows of every key, cuts the numbering into equal parts, copies the
few rows near a cut into the neighbouring part, evaluates all window columns per part with a
single sort, and keeps each row once. The result equals windows over the whole key.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.names import CHUNK_HOURS, KEYS, MAX_SHIFT, TS
from gridcast.operators.gaps import CHUNK, chunk_of, over

INDEX = "_index"
TOTAL = "_total"


def with_row_index(df: DataFrame, keys: list[str], order: list[str], bucket: Column | None) -> DataFrame:
    """Add `_index` (from 0, in `order`, per key) and `_total` (rows of the key).

    `bucket` must not decrease along `order`. Only bucket counts are added up per key; the
    rows themselves are numbered inside their bucket. Without a bucket a key is numbered in
    one window partition.
    """
    whole = Window.partitionBy(*keys)
    if bucket is None:
        # The count names the order as well, so that both windows share one sort.
        ordered = whole.orderBy(*order)
        everything = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return df.withColumns({INDEX: F.row_number().over(ordered) - 1, TOTAL: F.count(F.lit(1)).over(everything)})
    d = df.withColumn(CHUNK, bucket)
    part = [*keys, CHUNK]
    counts = d.groupBy(*part).agg(F.count(F.lit(1)).alias("_n"))
    before = whole.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
                            F.sum("_n").over(whole).alias(TOTAL))
    d = d.withColumn("_inside", F.row_number().over(Window.partitionBy(*part).orderBy(*order)))
    return (d.join(offsets, part).withColumn(INDEX, F.col("_offset") + F.col("_inside") - 1)
            .drop(CHUNK, "_offset", "_inside"))


def with_time_index(df: DataFrame, keys: list[str] = KEYS, ts: str = TS,
                    chunk_hours: int | None = CHUNK_HOURS) -> DataFrame:
    bucket = None if chunk_hours is None else chunk_of(F.col(ts), chunk_hours)
    return with_row_index(df, keys, [ts], bucket)


@dataclass(frozen=True)
class Rows:
    """An ordered window; `last(n)` is the frame of the newest n rows."""

    part: tuple[str, ...]
    order: str

    @property
    def all(self) -> str:
        return over(list(self.part), self.order)

    def last(self, n: int) -> str:
        return over(list(self.part), self.order, f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW")


def over_rows(df: DataFrame, build: Callable[[Rows], dict[str, str]],
              keys: list[str] = KEYS, ts: str = TS, back: int = MAX_SHIFT, ahead: int = 0,
              chunk_hours: int | None = CHUNK_HOURS) -> DataFrame:
    """Add the SQL columns of `build(rows)`, which look at most `back` / `ahead` rows away.

    Parts have `chunk_hours` rows; None evaluates whole keys, for series known to be short.
    """
    if chunk_hours is None:
        return _with_sql(df, build(Rows(tuple(keys), ts)))
    if chunk_hours < max(back, ahead):
        raise ValueError("a part must be at least as long as the look-back and look-ahead")
    d = df if INDEX in df.columns else with_time_index(df, keys, ts, chunk_hours)
    size = F.lit(chunk_hours)
    own = F.floor(F.col(INDEX) / size)
    place = F.col(INDEX) % size
    parts = [own]
    if back:
        parts.append(F.when((place >= chunk_hours - back) & ((own + 1) * size < F.col(TOTAL)), own + 1))
    if ahead:
        parts.append(F.when((place < ahead) & (own > 0), own - 1))
    d = d.withColumn("_part", F.explode(F.array_compact(F.array(*parts))))
    d = _with_sql(d, build(Rows((*keys, "_part"), INDEX))).where(F.col("_part") == F.floor(F.col(INDEX) / size)).drop("_part")
    return d if INDEX in df.columns else d.drop(INDEX, TOTAL)


def _with_sql(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr("*", *[f"{text} AS `{name}`" for name, text in columns.items()])


# ---- window columns, as SQL text ----------------------------------------------------------

def lag(c: str, rows: Rows, k: int) -> str:
    return f"lag(`{c}`, {k}) {rows.all}"


def lead(c: str, rows: Rows, k: int) -> str:
    return f"lead(`{c}`, {k}) {rows.all}"


def full_frame(function: str, c: str, rows: Rows, n: int) -> str:
    """`function` over the last n rows, null unless all n readings are there."""
    frame = rows.last(n)
    return f"CASE WHEN count(`{c}`) {frame} = {n} THEN {function}(`{c}`) {frame} END"


def rolling_mean(c: str, rows: Rows, n: int) -> str:
    return full_frame("avg", c, rows, n)


def rolling_std(c: str, rows: Rows, n: int) -> str:
    return full_frame("stddev_samp", c, rows, n)


def delta(c: str, rows: Rows, k: int) -> str:
    return f"`{c}` - {lag(c, rows, k)}"
