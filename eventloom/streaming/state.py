"""Streams that keep a state of their own for each key: sequence rules in event order, lateness against a high-water mark.

State lies in RocksDB with changelog checkpoints (session.STATE), beyond an executor's memory; a lost executor's keys are
loaded again from the checkpoint. A key's rows of one batch meet in one task; what waits for the watermark is bounded by its delay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

GAP, STILL = "sequence_gap", "timestamp_not_advancing"
_WAITING = pa.schema([("id", pa.string()), ("seq", pa.int64()), ("ms", pa.int64())])


#: Rows of an entry of the state: what waits is kept in packed entries, since a call to the state costs more than a row's judgement.
ROWS_PER_ENTRY = 100_000


def _packed(rows: pa.Table) -> list[tuple[bytes]]:
    """Entries of the state that hold the rows."""
    out = []
    for part in rows.combine_chunks().to_batches(ROWS_PER_ENTRY):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, part.schema) as writer:
            writer.write_batch(part)
        out.append((sink.getvalue().to_pybytes(),))
    return out


class SequenceRules(StatefulProcessor):
    """Holds rows until the watermark has passed them, judges them in order (ms, seq), and keeps the last one judged."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "seq bigint, ms bigint")
        self.pending = handle.getListState("pending", "rows binary")

    def _judge(self, watermark: int, came: list[pa.Table]) -> pd.DataFrame:
        """The rules of all rows that no earlier one can still come before; what came joins those that wait."""
        rows = pa.concat_tables([_WAITING.empty_table(), *(pa.ipc.open_stream(bytes(e[0])).read_all() for e in self.pending.get()), *came])
        seq, ms = rows["seq"].to_numpy(), rows["ms"].to_numpy()
        passed = ms <= watermark
        order = np.flatnonzero(passed)
        order = order[np.lexsort((seq[order], ms[order]))]
        rule = np.full(len(order), None, dtype=object)
        if len(order):
            seq, at, before = seq[order], ms[order], self.last.get()
            rule[1:] = np.where(np.diff(seq) > 1, GAP, np.where(np.diff(at) <= 0, STILL, None))
            if before is not None:
                rule[0] = GAP if seq[0] - before[0] > 1 else STILL if at[0] <= before[1] else None
            self.last.update((int(seq[-1]), int(at[-1])))
            if passed.all():
                self.pending.clear()
            else:
                self.pending.put(_packed(rows.filter(pa.array(~passed))))
        elif came:
            self.pending.appendList(_packed(pa.concat_tables(came)))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if not passed.all():
            self.handle.registerTimer(int(ms[~passed].min()))
        return pd.DataFrame({"id": rows["id"].take(pa.array(order)).to_numpy(), "rule": rule}, dtype=object)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        came = [pa.Table.from_pandas(part[["id", "seq", "ms"]], schema=_WAITING, preserve_index=False) for part in rows if len(part)]
        yield self._judge(timerValues.getCurrentWatermarkInMs(), came)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._judge(timerValues.getCurrentWatermarkInMs(), [])

    def close(self) -> None:
        """Nothing is held outside the state."""


def sequence_rule_stream(stream: DataFrame, device: str, id_col: str, seq: str, ms: str, watermark: str = "5 seconds") -> DataFrame:
    """(device, id string, rule) of each row of a stream, as sequence_rules judges a table in order of (ms, seq), each row once.

    A row comes out when the watermark has passed its time; rows that come later than the watermark allows are dropped
    and counted by Spark. Rows without a time, number or device are left out.
    """
    rows = stream.where(F.col(device).isNotNull() & F.col(seq).isNotNull() & F.col(ms).isNotNull()).select(
        F.col(device).alias("device"), F.col(id_col).cast("string").alias("id"), F.col(seq).cast("bigint").alias("seq"), F.col(ms).cast("bigint").alias("ms"), F.timestamp_millis(F.col(ms)).alias("at")
    )
    kind = rows.schema["device"].dataType.simpleString()
    return rows.withWatermark("at", watermark).groupBy("device").transformWithStateInPandas(_with_key(SequenceRules, "device")(), f"device {kind}, id string, rule string", "Append", "EventTime")


class Lateness(StatefulProcessor):
    """Keeps the largest time of each stream, and classes rows against it in the order of their arrival."""

    def __init__(self, delay_ms: int, ttl_ms: int | None):
        self.delay_ms, self.ttl_ms = delay_ms, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.high = handle.getValueState("high", "ms bigint", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        came = pd.concat(list(rows)).sort_values("arrival", kind="stable")
        before = came["ms"].cummax().shift().astype("Int64")
        if self.high.exists():
            before = before.fillna(self.high.get()[0]).clip(lower=self.high.get()[0])
        behind = before - came["ms"]
        kind = pd.Series("late_tolerated", index=came.index).mask(behind >= self.delay_ms, "late_beyond").mask(before.isna() | (behind < 0), "on_time")
        top = int(came["ms"].max())
        self.high.update((top if before.isna().iloc[0] else max(top, int(before.iloc[0])),))
        yield pd.DataFrame({"id": came["id"].to_numpy(object), "lateness": kind.to_numpy(object)})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        return iter(())

    def close(self) -> None:
        """Nothing is held outside the state."""


def lateness_stream(stream: DataFrame, by: str, id_col: str, ms: str, arrival: str, delay_ms: int = 5000, ttl_ms: int | None = None) -> DataFrame:
    """(stream, id string, lateness) of each row, as lateness classes a table in order of arrival, as soon as it has come.

    Arrival numbers order the rows of a batch; batches follow each other. With ttl_ms, a stream that is silent for so long
    starts anew; that goes by the clock, so such a query has no end of its own (availableNow would go on looking at
    the clock). Rows without a stream or a time are left out.
    """
    rows = stream.where(F.col(by).isNotNull() & F.col(ms).isNotNull()).select(
        F.col(by).cast("string").alias("stream"), F.col(id_col).cast("string").alias("id"), F.col(ms).cast("bigint").alias("ms"), F.col(arrival).cast("bigint").alias("arrival")
    )
    return rows.groupBy("stream").transformWithStateInPandas(_with_key(Lateness, "stream")(delay_ms, ttl_ms), "stream string, id string, lateness string", "Append", "None" if ttl_ms is None else "ProcessingTime")


def _with_key(kind: type, name: str) -> type:
    """The processor with the group's key as first column of what it gives."""

    class Keyed(kind):
        def handleInputRows(self, key, rows, timerValues):
            for out in super().handleInputRows(key, rows, timerValues):
                out.insert(0, name, key[0])
                yield out

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            for out in super().handleExpiredTimer(key, timerValues, expiredTimerInfo):
                out.insert(0, name, key[0])
                yield out

    return Keyed
