"""Intervals meet points on streams, a group of keys and a cell of time at a time.

A join of two streams reads and writes its state some ten times for each row. Here the rows of ``SLOTS``
groups of keys, dealt by a hash, are matched in each cell with array operations, and what a group keeps
of a cell is one value, as Arrow columns, that is written only when the cell gets rows and goes with
its timer once event time has passed the cell. Rows travel packed, many in one, since Python takes the rows
of a stateful operator one by one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

# Groups of keys that share a call and a state value in a cell. A query keeps the number it began with.
SLOTS = 16
# Rows that are packed, or sent on, at a time.
PACKED, SENT = 200_000, 50_000


def _bytes(table: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
        writer.write_table(table)
    return out.getvalue().to_pybytes()


def _table(packed) -> pa.Table:
    return pa.ipc.open_stream(packed).read_all()


def _numbers(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers or times as numbers, and where they are not null."""
    return column.cast(pa.int64()).fill_null(0).to_numpy(), column.is_valid().to_numpy()


class MeetState(StatefulProcessor):
    """Intervals and points of one group and cell. ``seen`` of an interval says whether it met a point."""

    def __init__(self, key: tuple[str, str], start: str, end: str, at: str):
        self.key, self.start, self.end, self.at = key, start, end, at

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.value = handle.getValueState("held", T.StructType().add("intervals", T.BinaryType()).add("points", T.BinaryType()))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        came = [[], []]
        for part in rows:
            for point, packed in zip(part["is_point"], part["packed"]):
                came[int(point)].append(_table(packed))
        found = self.value.get()
        if found is None:
            self.handle.registerTimer(int(key[1]) // 1000)
        held, before = (_table(v) if v is not None else None for v in (found or (None, None)))
        intervals, points = ([pa.concat_tables(tables)] if tables else [] for tables in came)
        # What is held has met the points before; it meets the new ones, and new intervals meet all.
        every = pa.concat_tables([*([before] if before is not None else []), *points]) if points or before is not None else None
        kept = []
        if held is not None:
            seen = held.column("seen").to_numpy().copy()
            held = held.drop_columns("seen")
            for new in points:
                yield from self._met(held, seen, new)
            kept.append(held.append_column("seen", pa.array(seen)))
        for new in intervals:
            seen = np.zeros(new.num_rows, bool)
            if every is not None:
                yield from self._met(new, seen, every)
            kept.append(new.append_column("seen", pa.array(seen)))
        self.value.update((_bytes(pa.concat_tables(kept).combine_chunks()) if kept else None,
                           _bytes(every.combine_chunks()) if every is not None else None))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Event time has passed the cell: intervals that met no point, alone."""
        found = self.value.get()
        self.value.clear()
        if found is not None and found[0] is not None:
            held = _table(found[0])
            alone = held.filter(pa.array(~held.column("seen").to_numpy())).drop_columns("seen")
            for first in range(0, alone.num_rows, SENT):
                yield _sent(alone.slice(first, SENT), None)

    def close(self) -> None:
        pass

    def _met(self, intervals: pa.Table, seen: np.ndarray, points: pa.Table) -> Iterator[pd.DataFrame]:
        """Each interval with the points of its key inside it; marks in ``seen`` the ones that have any."""
        n = intervals.num_rows
        keys = [t.column(k) for t, k in zip((intervals, points), self.key)]
        if all(pa.types.is_integer(k.type) for k in keys):
            named = np.concatenate([_numbers(k)[0] for k in keys])
        else:
            named = np.concatenate([k.fill_null("").to_numpy() for k in keys])
        code = pd.factorize(named)[0].astype(np.int64)
        (start, starts), (end, ends), (at, _) = _numbers(intervals.column(self.start)), _numbers(intervals.column(self.end)), \
            _numbers(points.column(self.at))
        # Points in the order of key and time, so that the points of an interval are a range of them.
        times, place = np.unique(at, return_inverse=True)
        step = len(times) + 1
        rank = code[n:] * step + place
        order = np.argsort(rank, kind="stable")
        rank, lowest = rank[order], code[:n] * step
        first = np.searchsorted(rank, lowest + np.searchsorted(times, start, "left"), "left")
        after = np.searchsorted(rank, lowest + np.searchsorted(times, end, "right"), "left")
        count = np.where(starts & ends & keys[0].is_valid().to_numpy(), np.maximum(after - first, 0), 0)
        seen |= count > 0
        until = np.cumsum(count)
        for low in range(0, int(until[-1]) if n else 0, SENT):
            pair = np.arange(low, min(low + SENT, int(until[-1])))
            row = np.searchsorted(until, pair, "right")
            yield _sent(intervals.take(pa.array(row)), points.take(pa.array(order[first[row] + pair - (until - count)[row]])))


def _sent(intervals: pa.Table, points: pa.Table | None) -> pd.DataFrame:
    return pd.DataFrame({"intervals": [_bytes(intervals)], "points": [None if points is None else _bytes(points)]})


def _packer(point: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows to one row for each group and cell, holding them as Arrow columns."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, rows = [], 0
        for batch in batches:
            kept.append(batch)
            rows += batch.num_rows
            if rows >= PACKED:
                yield from packed(kept)
                kept, rows = [], 0
        if rows:
            yield from packed(kept)

    def packed(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        slot, number = table.column("slot").to_numpy(), table.column("number").to_numpy()
        order = np.lexsort([slot, number])
        slot, number = slot[order], number[order]
        first = np.flatnonzero(np.append(True, (slot[1:] != slot[:-1]) | (number[1:] != number[:-1])))
        table = table.take(pa.array(order))
        head, table = table.select(["slot", "number", "event_cell"]).take(pa.array(first)), table.drop_columns(["slot", "number", "event_cell"])
        table = table.combine_chunks()
        rows = pa.array([_bytes(table.slice(low, high - low)) for low, high in zip(first, np.append(first[1:], len(order)))], pa.binary())
        yield from (head.append_column("is_point", pa.array(np.full(len(first), point))).append_column("packed", rows)
                    .combine_chunks().to_batches())

    return pack


def _unpacker(names: list[str], schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for left, right in zip(*(batch.column(c).to_pylist() for c in ("intervals", "points"))):
                left = _table(left)
                columns = dict(zip(left.column_names, left.columns))
                if right is not None:
                    right = _table(right)
                    columns |= dict(zip(right.column_names, right.columns))
                rows = pa.table([columns[f.name].cast(f.type) if f.name in columns else pa.nulls(left.num_rows, f.type)
                                 for f in schema], names=names)
                yield from rows.combine_chunks().to_batches()

    return unpack


def meet_stream(intervals: DataFrame, points: DataFrame, key: tuple[str, str], start: str, end: str, at: str,
                cell: tuple[str, str]) -> DataFrame:
    """The left outer join of two streams on equal ``key`` and ``cell`` (names on either side; keys are
    both numbers or both text) and ``at`` between ``start`` and ``end``, as a join of streams gives it.

    Both cells carry the watermark; that of ``points`` is there only to be met and does not come back.
    Pairs come with the later of their rows, an interval without a point once its cell has passed.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    def packed(df: DataFrame, name: str, cell: str, point: bool) -> DataFrame:
        # The cell keeps its mark of the watermark, so that late rows are left out.
        head = T.StructType([T.StructField("slot", T.IntegerType()), T.StructField("number", T.LongType()),
                             T.StructField("event_cell", T.TimestampType(), True, df.schema[cell].metadata)])
        flat = df.where(F.col(cell).isNotNull()).select(
            F.pmod(F.xxhash64(F.col(name).cast("string")), F.lit(SLOTS)).cast("int").alias("slot"),
            F.unix_micros(cell).alias("number"), F.col(cell).alias("event_cell"), *[c for c in df.columns if not point or c != cell])
        return flat.mapInArrow(_packer(point), T.StructType([*head.fields]).add("is_point", T.BooleanType()).add("packed", T.BinaryType()))

    usable = points.where(F.col(key[1]).isNotNull() & F.col(at).isNotNull())
    both = packed(intervals, key[0], cell[0], False).union(packed(usable, key[1], cell[1], True))
    found = both.groupBy("slot", "number").transformWithStateInPandas(
        statefulProcessor=MeetState(key, start, end, at), outputMode="append", timeMode="EventTime",
        outputStructType=T.StructType().add("intervals", T.BinaryType()).add("points", T.BinaryType()))
    fields = [*intervals.schema.fields, *points.drop(cell[1]).schema.fields]
    out = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    return found.mapInArrow(_unpacker(out.names, to_arrow_schema(out)), out)
