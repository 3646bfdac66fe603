"""Keyed stateful processors for ``transformWithStateInPandas``.

Each processor sees, per key and micro-batch, only that batch's rows of the
key (bounded by the trigger size) plus its small keyed state; the work inside
is vectorised pandas.  State lives in the RocksDB store and is checkpointed.

* :class:`TwinProcessor` - T1/T2/T5: merges DESIRED and REPORTED states per
  device, emits the merged record after every input, and expires a device
  whose reported state is ``ttl_days`` whole days old, using event-time timers
  (stream time, so replays are deterministic; the reference uses wall clock).
* :class:`TopKDistinctProcessor` - A8/A9: bounded leaderboard per group,
  equal scores collapse to the earliest arrival, at most ``k`` rows of state.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql.streaming.stateful_processor import (ExpiredTimerInfo, StatefulProcessor,
                                                      StatefulProcessorHandle, TimerValues)
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField, StructType,
                               TimestampType)

# The processors are shipped by value: the driver-side Python runner that
# validates state schemas does not see files added with addPyFile.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DAY_MS = 86_400_000

TWIN_FIELDS = ["timestamp", "wind_speed_mph", "power"]
TWIN_STATE_SCHEMA = StructType(
    [StructField(f"desired_{f}", t) for f, t in zip(TWIN_FIELDS, [TimestampType(), DoubleType(), StringType()])]
    + [StructField(f"reported_{f}", t) for f, t in zip(TWIN_FIELDS, [TimestampType(), DoubleType(), StringType()])]
)


def twin_output_schema(key_type) -> StructType:
    return StructType([StructField("key", key_type), StructField("event_id", LongType()),
                       StructField("emit_idx", LongType())] + list(TWIN_STATE_SCHEMA.fields))


def _none(v):
    if v is None:
        return None
    if isinstance(v, float) and np.isnan(v):
        return None
    if v is pd.NaT:
        return None
    return v


def _typed(v, dt):
    """Values from a mixed pandas frame (integers become float64 next to NaN)
    converted back to the state schema's Python type."""
    if v is None:
        return None
    if isinstance(dt, (LongType, IntegerType)):
        return int(v)
    if isinstance(dt, DoubleType):
        return float(v)
    return v


class TwinProcessor(StatefulProcessor):
    """Input columns: key, event_id, emit_idx, type, timestamp, wind_speed_mph, power."""

    def __init__(self, ttl_days: int = 7, use_timers: bool = False, processing_check_ms: int | None = None):
        self.ttl_ms = ttl_days * DAY_MS
        self.use_timers = use_timers  # event-time TTL timer (timeMode="EventTime", T4/T5)
        # wall-clock periodic TTL check every N ms (timeMode="ProcessingTime", T3 - the reference's punctuator)
        self.check_ms = processing_check_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("twin", TWIN_STATE_SCHEMA)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues
                        ) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True).sort_values(["event_id", "emit_idx"], kind="stable")
        pdf = pdf.reset_index(drop=True)
        prev = self.state.get() if self.state.exists() else (None,) * 6
        pos = pd.Series(np.arange(len(pdf)), dtype="float64")
        out = {"key": pdf["key"], "event_id": pdf["event_id"], "emit_idx": pdf["emit_idx"]}
        for side, typ, offset in (("desired", "DESIRED", 0), ("reported", "REPORTED", 3)):
            # index of the latest row of this type so far (forward fill), -1 = from state
            last = pos.where(pdf["type"] == typ).ffill().fillna(-1).astype("int64")
            for j, f in enumerate(TWIN_FIELDS):
                vals = pdf[f].reindex(last.clip(lower=0)).reset_index(drop=True)
                vals = vals.astype(object).where(last >= 0, prev[offset + j])
                out[f"{side}_{f}"] = vals
        res = pd.DataFrame(out)
        final = tuple(_none(res[c].iloc[-1]) for c in TWIN_STATE_SCHEMA.fieldNames())
        self.state.update(final)
        if self.check_ms:
            if not list(self.handle.listTimers()):
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.check_ms)
        elif self.use_timers:
            # one TTL timer per key, at reported time + ttl
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            rep_ts = final[3]
            if rep_ts is not None:
                self.handle.registerTimer(int(pd.Timestamp(rep_ts).value // 1_000_000) + self.ttl_ms)
        yield res

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo
                           ) -> Iterator[pd.DataFrame]:
        if self.state.exists():
            rep_ts = self.state.get()[3]
            now = timerValues.getCurrentProcessingTimeInMs() if self.check_ms else expiredTimerInfo.getExpiryTimeInMs()
            if rep_ts is not None and int(pd.Timestamp(rep_ts).value // 1_000_000) + self.ttl_ms <= now:
                self.state.clear()  # expiry emits nothing
            elif self.check_ms:
                self.handle.registerTimer(now + self.check_ms)  # periodic: check again later
        return iter([])

    def close(self) -> None:
        pass


class TopKDistinctProcessor(StatefulProcessor):
    """Bounded top-k per group.  Input: group key column(s), ``score``,
    ``seq`` and payload columns (``payload`` names, all carried in state)."""

    def __init__(self, key_cols: list[str], payload: StructType, k: int = 3):
        self.key_cols, self.payload, self.k = key_cols, payload, k
        self.state_schema = StructType([StructField("score", DoubleType()), StructField("seq", LongType())]
                                       + list(payload.fields))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.top = handle.getListState("top", self.state_schema)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues
                        ) -> Iterator[pd.DataFrame]:
        cols = self.state_schema.fieldNames()
        top = pd.DataFrame(list(self.top.get()), columns=cols) if self.top.exists() else None
        # fold the batch chunk by chunk (the reduction is associative), so a hot
        # group never sits in memory whole: one Arrow chunk + k rows at a time
        for chunk in rows:
            cand = chunk[cols] if top is None else pd.concat([top, chunk[cols]], ignore_index=True)
            # equal scores: the earliest arrival stays; then the k highest scores
            firsts = cand.sort_values(["score", "seq"], ascending=[False, True]).drop_duplicates("score")
            top = firsts.head(self.k).reset_index(drop=True)
        if top is None:
            return
        fields = self.state_schema.fields
        self.top.put([tuple(_typed(_none(v), f.dataType) for v, f in zip(r, fields))
                      for r in top.itertuples(index=False, name=None)])
        out = top.copy()
        out["rank"] = np.arange(1, len(top) + 1, dtype="int32")
        for c, v in zip(self.key_cols, key):
            out[c] = v
        yield out

    def close(self) -> None:
        pass


class AsOfJoinProcessor(StatefulProcessor):
    """J1/J2 streaming, exact: input is the keyed union of stream rows
    (``asof_side = 0``) and table changelog rows (``asof_side = 1``, ``asof_dead`` marks
    a tombstone), ordered by ``seq``.  Table rows update the state; each stream
    row is emitted with the table value as of its arrival, or dropped when the
    key has no live value (inner join).  Table-side columns are ``table_cols``."""

    def __init__(self, stream_cols: list[str], table_cols: list[str], table_schema: StructType):
        self.stream_cols, self.table_cols, self.table_schema = stream_cols, table_cols, table_schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.value = handle.getValueState("table", self.table_schema)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues
                        ) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True)
        # at one position the stream row comes first: it sees earlier records only
        pdf = pdf.sort_values(["seq", "asof_side"], kind="stable").reset_index(drop=True)
        prev = self.value.get() if self.value.exists() else None
        is_tab = pdf["asof_side"] == 1
        pos = pd.Series(np.arange(len(pdf)), dtype="float64")
        last = pos.where(is_tab).ffill().fillna(-1).astype("int64")   # latest table row so far
        src = last.clip(lower=0)
        out = pdf.loc[~is_tab, self.stream_cols].copy()
        sel = last[~is_tab]
        for j, c in enumerate(self.table_cols):
            vals = pdf[c].reindex(src[~is_tab]).reset_index(drop=True).astype(object)
            fallback = prev[j] if prev is not None else None
            out[c] = vals.where(sel.reset_index(drop=True) >= 0, fallback).values
        dead = pdf["asof_dead"].reindex(src[~is_tab]).reset_index(drop=True)
        prev_dead = prev is None
        live = np.where(sel.reset_index(drop=True) >= 0, ~dead.astype(bool), not prev_dead)
        out = out[live]
        if is_tab.any():
            row = pdf[is_tab].iloc[-1]
            if bool(row["asof_dead"]):
                self.value.clear()
            else:
                self.value.update(tuple(_typed(_none(row[c]), f.dataType)
                                        for c, f in zip(self.table_cols, self.table_schema.fields)))
        yield out.reset_index(drop=True)

    def close(self) -> None:
        pass


class GraceProcessor(StatefulProcessor):
    """W2/W3 streaming, exact per record: keyed by input partition,
    the state is that partition's stream time (highest event time seen).  Rows
    of a batch are replayed in arrival order; a row is late when its window end
    is not after ``stream time - grace`` (stream time including the row).  Emits
    every row with ``is_late`` so the caller keeps either side.  Event times
    and window ends are epoch microseconds (``ts_us``, ``window_end_us``)."""

    def __init__(self, grace_us: int):
        self.grace_us = grace_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.st = handle.getValueState("stream_time", StructType([StructField("us", LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues
                        ) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True).sort_values("seq", kind="stable").reset_index(drop=True)
        prev = self.st.get()[0] if self.st.exists() else None
        run = np.maximum.accumulate(pdf["ts_us"].to_numpy(dtype="int64"))
        if prev is not None:
            run = np.maximum(run, prev)
        pdf["stream_time_us"] = run
        pdf["is_late"] = pdf["window_end_us"].to_numpy() <= run - self.grace_us
        self.st.update((int(run[-1]),))
        yield pdf

    def close(self) -> None:
        pass
