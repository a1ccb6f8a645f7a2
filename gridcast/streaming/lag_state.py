"""Online lags: the newest values of every key kept as state.

The stream is aggregated to closed hours first, so a key brings at most one row per hour to its state, however many
events it has. The rows of a batch come in any order and a key may bring a whole history at once: up to PIECE_ROWS rows
are put in order in memory; beyond that they are laid away in the state by spans of SPAN_HOURS hours, and the spans are
then taken out in order of time, one by one. A task holds a piece and a span of a key, never its whole batch.

A late hour (older than one that was released by an earlier batch) is neither lost nor taken for the newest: it gets the
lags it has among the rows still kept, and rows that come later count it. Rows released before it stay as they are.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from gridcast.names import AQI_LAGS, TS


# Executors get this module's code with the task and need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIECE_ROWS = 65_536
SPAN_HOURS = 16_384
_HOUR = 3_600_000_000  # microseconds

_RECENT = T.StructType([T.StructField("at", T.LongType()), T.StructField("v", T.DoubleType())])
_PLACE = T.StructType([T.StructField("span", T.LongType()), T.StructField("piece", T.LongType())])
_LAID = T.StructType([T.StructField("at", T.BinaryType()), T.StructField("v", T.BinaryType())])


class LagState(StatefulProcessor):
    """Keeps the last max(lags) rows of a key, oldest first."""

    def __init__(self, keys: list[str], value: str, lags: list[int], ts: str, piece_rows: int, span_hours: int):
        self.keys, self.value, self.lags, self.ts = keys, value, lags, ts
        self.piece_rows, self.span = piece_rows, span_hours * _HOUR

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.recent = handle.getListState("recent", _RECENT)
        self.laid = handle.getMapState("laid", _PLACE, _LAID)

    def _columns(self, pieces: list[pd.DataFrame]) -> tuple[np.ndarray, np.ndarray]:
        rows = pd.concat(pieces)
        return (rows[self.ts].to_numpy().astype("datetime64[us]").astype("int64"),
                rows[self.value].to_numpy(dtype="float64", na_value=np.nan))

    def _lay(self, pieces: list[pd.DataFrame], places: dict[int, list[int]]) -> None:
        at, v = self._columns(pieces)
        spans = at // self.span
        for span in np.unique(spans).tolist():
            mine = spans == span
            held = places.setdefault(span, [])
            self.laid.updateValue((span, len(held)), (at[mine].tobytes(), v[mine].tobytes()))
            held.append(len(held))

    def _taken(self, span: int, pieces: list[int]) -> tuple[np.ndarray, np.ndarray]:
        parts = [self.laid.getValue((span, p)) for p in pieces]
        for p in pieces:
            self.laid.removeKey((span, p))
        return tuple(np.concatenate([np.frombuffer(part[i], kind) for part in parts]) for i, kind in ((0, "int64"), (1, "float64")))

    def _released(self, key, at: np.ndarray, v: np.ndarray) -> pd.DataFrame:
        old = list(self.recent.get()) if self.recent.exists() else []
        every = np.r_[np.array([r[0] for r in old], "int64"), at]
        order = np.argsort(every, kind="stable")
        series = pd.Series(np.r_[[np.nan if r[1] is None else r[1] for r in old], v], dtype="float64").iloc[order].reset_index(drop=True)
        fresh = np.flatnonzero(order >= len(old))
        out = pd.DataFrame({k: [x] * len(fresh) for k, x in zip(self.keys, key)})
        out[self.ts] = pd.to_datetime(every[order][fresh], unit="us")
        out[self.value] = series.to_numpy()[fresh]
        for k in self.lags:
            out[f"{self.value}_lag_{k}h"] = series.shift(k).to_numpy()[fresh]
        last = slice(-max(self.lags), None)
        self.recent.put([(int(t), None if np.isnan(x) else float(x)) for t, x in zip(every[order][last], series.to_numpy()[last])])
        return out

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held, count, places = [], 0, {}
        for piece in rows:
            held.append(piece)
            count += len(piece)
            if count > self.piece_rows:
                self._lay(held, places)
                held, count = [], 0
        if not places:
            if held:
                yield self._released(key, *self._columns(held))
            return
        if held:
            self._lay(held, places)
        for span in sorted(places):
            yield self._released(key, *self._taken(span, places[span]))

    def close(self) -> None:
        pass


def lag_stream(hourly: DataFrame, value: str, keys: list[str], lags: list[int] | None = None, ts: str = TS,
               piece_rows: int = PIECE_ROWS, span_hours: int = SPAN_HOURS) -> DataFrame:
    """Row-based lags of `value` per key, over the rows in the order of their hours."""
    lags = lags or AQI_LAGS
    kinds = {f.name: f for f in hourly.schema.fields}
    schema = T.StructType([kinds[k] for k in keys] + [kinds[ts], kinds[value]]
                          + [T.StructField(f"{value}_lag_{k}h", T.DoubleType()) for k in lags])
    return hourly.groupBy(*keys).transformWithStateInPandas(
        LagState(keys, value, lags, ts, piece_rows, span_hours), outputStructType=schema, outputMode="Append", timeMode="None")
