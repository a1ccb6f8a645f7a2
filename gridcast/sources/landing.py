"""Landed JSON payloads -> hourly rows.

One file or text row is one response of a site; the site is a column beside the payload
(a partition folder `site=...` when read from files).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast.names import KEYS, POLLUTANTS, POLLUTION_PAYLOAD, TS, WEATHER_FIELDS, WEATHER_PAYLOAD
from gridcast.operators.dedup import first_rows


FETCHED = "fetched_at"


def _keyed(payload: T.StructType, keys: dict[str, str] | None) -> T.StructType:
    extra = T.StructType([T.StructField(k, T._parse_datatype_string(v)) for k, v in (keys or {}).items()])
    return T.StructType(payload.fields + extra.fields)


def read_payloads(spark: SparkSession, path: str, payload: T.StructType,
                  keys: dict[str, str] | None = None, multi_line: bool = True) -> DataFrame:
    """JSON files, one payload per file or (multi_line=False) per line; `keys` are further columns, e.g. those of
    the folders: {"site": "string"}.

    `fetched_at` is the time the file was written, unless the payload brings a column of that name.
    """
    files = spark.read.schema(_keyed(payload, keys)).json(path, multiLine=multi_line)
    return files if FETCHED in files.columns else files.withColumn(FETCHED, F.col("_metadata.file_modification_time"))


def _newest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key and hour: the newest fetch wins, and inside a payload its first reading.

    Fetches of the same time are told apart by what they hold, so the order of the input never matters.
    """
    values = [c for c in rows.columns if c not in (*keys, TS, FETCHED, "_pos")]
    return first_rows(rows, [*keys, TS], [F.col(FETCHED).desc_nulls_last(), F.col("_pos"),
                                          *[F.col(c).asc_nulls_last() for c in values]]).drop(FETCHED, "_pos")


def _fetched(payloads: DataFrame) -> Column:
    return (F.col(FETCHED) if FETCHED in payloads.columns else F.lit(None)).cast("timestamp").alias(FETCHED)


def pollution_rows(payloads: DataFrame, keys: list[str] = KEYS, require_rows: bool = False) -> DataFrame:
    """`list[]` of {dt, components} -> one row per hour; an absent component is null.

    Of several payloads with the same hour the one fetched last wins (column `fetched_at`), inside a
    payload the first reading. `require_rows` makes an empty result an error, as a history load must
    not be empty.
    """
    d = payloads.select(*keys, _fetched(payloads), F.posexplode("list").alias("_pos", "_item"))
    d = d.select(*keys, F.date_trunc("hour", F.timestamp_seconds("_item.dt")).alias(TS), FETCHED, "_pos", "_item.dt",
                 *[F.col(f"_item.components.{p}").alias(p) for p in POLLUTANTS])
    d = _newest(d, keys).drop("dt")
    if require_rows and d.isEmpty():
        raise ValueError("no pollution rows in the payloads")
    return d


def weather_rows(payloads: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Parallel `hourly` arrays -> one row per hour, with channel names; `pollution_rows` says which row wins."""
    arrays = ["time", *WEATHER_FIELDS]
    # An absent field would make the whole zip null; as an empty array it gives null readings.
    kinds = {f.name: f.dataType.simpleString() for f in payloads.schema["hourly"].dataType.fields}
    zipped = F.expr("arrays_zip(" + ", ".join(
        f"coalesce(hourly.{a}, CAST(array() AS {kinds[a]}))" for a in arrays) + ")")
    zipped = zipped.cast("array<struct<" + ", ".join(f"{a}:{kinds[a][6:-1]}" for a in arrays) + ">>")
    d = payloads.select(*keys, _fetched(payloads), F.posexplode(zipped).alias("_pos", "_h"))
    d = d.select(*keys, F.col("_h.time").try_cast("timestamp").alias(TS), FETCHED, "_pos",
                 *[F.col(f"_h.{f}").alias(c) for f, c in WEATHER_FIELDS.items()])
    return _newest(d.where(F.col(TS).isNotNull()), keys)


def parse_payload(text: Column, payload: T.StructType) -> Column:
    return F.from_json(text, payload)
