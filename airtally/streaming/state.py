"""Keyed state on streams: device sessions, user activity, spans per event type.

A call into Python and its state costs far more than a row, so keys are dealt by a hash to
``BUCKETS`` groups: a processor takes the rows of all keys of a group in one micro-batch with array
operations, each key's in time order. What it keeps of a key has a fixed size (an open
session, or a counter and a day); those of a group are one value, as Arrow columns. A key that goes quiet is
closed by a timer, one for each group, set for the key that is due first: on the clock
of the workers (``PROCESSING``), or on event time when the stream has a watermark
(``EVENT``). ``NEVER`` sets no timer. A query on the clock always has another batch
to wait for, so it does not end by itself under an ``availableNow`` trigger.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from airtally.functions.values import type_number
from airtally.operators.sessions import END_FROM, START, START_BELOW, STOP, SWITCH

PROCESSING, EVENT, NEVER = "ProcessingTime", "EventTime", "None"
# Marks of a closed activity, and idle times in milliseconds.
CLOSED_ACTIVITY, CLOSED_SPANS = 500, 999
SESSION_IDLE, ACTIVITY_IDLE = 90_000, 30_000
# Stands for a null number, as a column with nulls would come to pandas as doubles.
NOTHING = -(1 << 63)
# Groups of keys that share a call and a state value. A query keeps the number it began with.
BUCKETS = 1024


def _codes(columns: list[np.ndarray]) -> np.ndarray:
    """Equal rows get equal numbers, from 0 in the order they first come."""
    code = np.zeros(len(columns[0]), np.int64)
    for column in columns:
        part, values = pd.factorize(column)
        code = pd.factorize(code * len(values) + part)[0].astype(np.int64)
    return code


def _packed(columns: dict[str, np.ndarray]) -> bytes:
    batch, out = pa.RecordBatch.from_pydict(columns), pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema) as writer:
        writer.write_batch(batch)
    return out.getvalue().to_pybytes()


def _unpacked(value: bytes) -> dict[str, np.ndarray]:
    table = pa.ipc.open_stream(value).read_all()
    return {name: table.column(name).to_numpy().copy() for name in table.column_names}


class _Grouped(StatefulProcessor):
    """State of the keys of one group: a column for each part of the key, each of ``FIELDS`` and ``due``,
    the time of the key's timer in milliseconds. A key without the first field is not kept."""

    #: What is kept of a key.
    FIELDS: tuple[str, ...] = ()

    def __init__(self, keys: list[str], idle_ms: int, clock: str):
        self.names, self.idle_ms, self.clock = keys, idle_ms, clock
        self.parts = [c for k in keys for c in (k, f"{k}_null")]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.value = handle.getValueState("held", T.StructType().add("rows", T.BinaryType()).add("timer", T.LongType()))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        came = pd.concat(rows, ignore_index=True)
        came = {c: came[c].to_numpy() for c in came.columns}
        held, timer = self._load()
        before = len(held["due"]) if held else 0
        names = {c: np.concatenate([held[c], came[c]]) if held else came[c] for c in self.parts}
        code = _codes(list(names.values()))
        # Kept keys come first and differ, so their numbers are their places.
        first = np.unique(code, return_index=True)[1]
        self.keys = {c: values[first] for c, values in names.items()}
        self.kept = {f: np.concatenate([held[f] if held else np.zeros(0, np.int64), np.full(len(first) - before, NOTHING)])
                     for f in (*self.FIELDS, "due")}
        yield from self._take(code[before:], came, timerValues)
        self._store(timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, _ = self._load()
        self.keys = {c: held[c] for c in self.parts}
        self.kept = {f: held[f] for f in (*self.FIELDS, "due")}
        due = self.kept["due"]
        over = np.flatnonzero((due != NOTHING) & ((due <= expiredTimerInfo.getExpiryTimeInMs()) | (due < self._now(timerValues))))
        yield from self._close(over, timerValues)
        self._store(None)

    def close(self) -> None:
        pass

    def _take(self, key: np.ndarray, came: dict[str, np.ndarray], timers) -> Iterator[pd.DataFrame]:
        """Rows that came, ``key`` holding the number of each row's key, into results and ``kept``."""
        raise NotImplementedError

    def _close(self, over: np.ndarray, timers) -> Iterator[pd.DataFrame]:
        """The keys whose time has come."""
        raise NotImplementedError

    def _now(self, timers) -> int:
        return timers.getCurrentWatermarkInMs() if self.clock == EVENT else timers.getCurrentProcessingTimeInMs()

    def _renew(self, key: np.ndarray, newest: np.ndarray, timers) -> None:
        """Move the idle time of keys behind their newest row."""
        if self.clock != NEVER:
            now = self._now(timers)
            self.kept["due"][key] = (np.maximum(newest // 1000, now) if self.clock == EVENT else now) + self.idle_ms

    def _load(self) -> tuple[dict[str, np.ndarray], int | None]:
        found = self.value.get()
        return (_unpacked(bytes(found[0])), found[1]) if found is not None else ({}, None)

    def _store(self, timer: int | None) -> None:
        here = self.kept[self.FIELDS[0] if self.FIELDS else "due"] != NOTHING
        due = self.kept["due"][here]
        due = due[due != NOTHING]
        first = int(due.min()) if len(due) else None
        if timer != first:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if first is not None:
                self.handle.registerTimer(first)
        if here.any():
            self.value.update((_packed({c: values[here] for c, values in {**self.keys, **self.kept}.items()}), first))
        else:
            self.value.clear()

    def _frame(self, key: np.ndarray, **columns) -> Iterator[pd.DataFrame]:
        """Result rows, ``key`` holding the number of each row's key."""
        if len(key):
            yield pd.DataFrame({**{k: _nullable(self.keys[k][key], self.keys[f"{k}_null"][key]) for k in self.names}, **columns})


def _nullable(values: np.ndarray, null: np.ndarray):
    if values.dtype == np.int64:
        return pd.arrays.IntegerArray(values, null.astype(bool))
    return np.where(null, None, values)


class _Sessions(_Grouped):
    """Actions of (user, device)s, the open session of each before its rows."""

    def _actions(self, key: np.ndarray, came: dict[str, np.ndarray]) -> tuple[np.ndarray, ...]:
        known = (came["at"] != NOTHING) & np.isin(came["action"], (START, STOP, SWITCH))
        opened = np.flatnonzero(self.kept["start"] != NOTHING)
        # What is open counts as a start before all rows.
        late = np.repeat([0, 1], [len(opened), known.sum()])
        key = np.concatenate([opened, key[known]])
        at, tie, action, channel = (np.concatenate([before, came[c][known]]) for c, before in (
            ("at", self.kept["start"][opened]), ("tie", np.zeros(len(opened), np.int64)),
            ("action", np.full(len(opened), START)), ("channel", self.kept["channel"][opened])))
        order = np.lexsort([channel, action, tie, at, late, key])
        key, at, action, channel, late = key[order], at[order], action[order], channel[order], late[order]
        return key, at, action, channel, late, np.isin(action, (START, SWITCH))

    def _keep(self, key: np.ndarray, at: np.ndarray, channel: np.ndarray, opens: np.ndarray) -> np.ndarray:
        """Hold the sessions that the last rows of keys opened; gives the places of those rows."""
        self.kept["start"][key] = NOTHING
        last = np.flatnonzero(np.append(key[1:] != key[:-1], True)[:len(key)] & opens)
        self.kept["start"][key[last]], self.kept["channel"][key[last]] = at[last], channel[last]
        return last


class SessionState(_Sessions):
    """Open session of a (user, device)."""

    FIELDS = ("start", "channel")

    def _take(self, key, came, timers):
        touched = np.unique(key)
        key, at, action, channel, _, opens = self._actions(key, came)
        # A session lies between neighbours: it ends with the next action, unless that only starts anew.
        # On event time a pause ends it even where no timer ran between two rows of a batch.
        idle = at[1:] - at[:-1] > self.idle_ms * 1000 if self.clock == EVENT else np.zeros(max(len(at) - 1, 0), bool)
        ended = opens[:-1] & (key[1:] == key[:-1]) & (idle | np.isin(action[1:], (STOP, SWITCH)))
        yield from self._sessions(key[:-1][ended], channel[:-1][ended], at[:-1][ended], np.where(idle, 0, at[1:])[ended])
        last = self._keep(key, at, channel, opens)
        last = last[np.isin(key[last], touched)]
        self.kept["due"][touched] = NOTHING
        self._renew(key[last], at[last], timers)

    def _close(self, over, timers):
        start, channel = self.kept["start"][over], self.kept["channel"][over]
        yield from self._sessions(over, channel, start, np.zeros(len(over), np.int64))
        self.kept["start"][over] = NOTHING

    def _sessions(self, key, channel, start, end):
        return self._frame(key, start=start, end=end, channel_id=_nullable(channel, channel == NOTHING))


class PartState(_Sessions):
    """Open session of a (user, device), sent on whenever event time passes the end of a cell."""

    FIELDS = ("start", "channel", "since")

    def __init__(self, keys: list[str], seconds: int):
        super().__init__(keys, 0, EVENT)
        self.width = seconds * 1_000_000

    def _take(self, key, came, timers):
        key, at, action, channel, late, opens = self._actions(key, came)
        since = np.where(late == 0, self.kept["since"][key], at)
        ended = opens[:-1] & (key[1:] == key[:-1]) & np.isin(action[1:], (STOP, SWITCH))
        yield from self._sent(key[:-1][ended], channel[:-1][ended], at[:-1][ended], since[:-1][ended], at[1:][ended], True)
        last = self._keep(key, at, channel, opens)
        self.kept["since"][key[last]] = since[last]
        self._await()

    def _close(self, over, timers):
        """Parts up to the last border that event time has passed."""
        until = np.full(len(over), timers.getCurrentWatermarkInMs() * 1000)
        channel, start, since = (self.kept[f][over] for f in ("channel", "start", "since"))
        yield from self._sent(over, channel, start, since, until, False)
        self.kept["since"][over] = np.maximum(since, until // self.width * self.width)
        self._await()

    def _await(self) -> None:
        """The timer of an open session: the next border."""
        self.kept["due"][:] = np.where(self.kept["start"] != NOTHING, (self.kept["since"] // self.width + 1) * self.width // 1000, NOTHING)

    def _sent(self, key, channel, start, since, until, closed: bool):
        """A part for each border passed and, of ended sessions, the rest."""
        passed = np.maximum(until // self.width - since // self.width, 0)
        parts = passed + closed
        row = np.repeat(np.arange(len(key)), parts)
        place = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
        border = (since // self.width)[row] + place
        rest = place == passed[row]
        return self._frame(
            key[row], channel_id=_nullable(channel[row], channel[row] == NOTHING), start=start[row],
            since=np.where(place == 0, since[row], border * self.width),
            until=np.where(rest, until[row], (border + 1) * self.width), closed=rest)


class ActivityState(_Grouped):
    """Type numbers that a micro-batch adds to a user's days, in parts numbered as they come."""

    FIELDS = ("parts", "day")
    DAY = 86_400_000_000

    def _take(self, key, came, timers):
        touched = np.unique(key)
        self._renew(touched, np.zeros(len(touched), np.int64), timers)
        known = (came["at"] != NOTHING) & (came["number"] != NOTHING)
        key, at, tie, number = key[known], *(came[c][known] for c in ("at", "tie", "number"))
        if not len(key):
            return
        order = np.lexsort([number, tie, at, key])
        key, at, number = key[order], at[order], number[order]
        day = at // self.DAY
        first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (day[1:] != day[:-1])))
        last = np.flatnonzero(np.append(key[1:] != key[:-1], True))
        users, at_user, days = np.unique(key[first], return_index=True, return_counts=True)
        before = self.kept["parts"][users]
        before = np.where(before == NOTHING, 0, before)
        part = np.arange(len(first)) + np.repeat(before - at_user, days)
        self.kept["parts"][users] = before + days
        self.kept["day"][users] = np.maximum(self.kept["day"][users], day[last])
        self._renew(users, at[last], timers)
        yield from self._parts(key[first], day[first], part, np.split(number.astype(np.int32), first[1:]),
                               np.maximum.reduceat(np.where(number < START_BELOW, at, 0), first),
                               np.maximum.reduceat(np.where(number >= END_FROM, at, 0), first))

    def _close(self, over, timers):
        none = np.zeros(len(over), np.int64)
        yield from self._parts(over, self.kept["day"][over], self.kept["parts"][over], [[CLOSED_ACTIVITY]] * len(over), none, none)
        self.kept["parts"][over] += 1
        self.kept["due"][over] = NOTHING

    def _parts(self, key, day, part, types: list, start, end):
        return self._frame(key, day=day.astype(np.int32), part=part, type_ints=pd.Series(types, dtype=object), start=start, end=end)


class SpanState(_Grouped):
    """First and last time per event type of a user within a micro-batch."""

    def _take(self, key, came, timers):
        touched = np.unique(key)
        self._renew(touched, np.zeros(len(touched), np.int64), timers)
        known = (came["at"] != NOTHING) & (came["number"] != NOTHING)
        key, at, number = key[known], came["at"][known], came["number"][known]
        if not len(key):
            return
        newest = np.full(len(self.kept["due"]), NOTHING)
        np.maximum.at(newest, key, at)
        users = np.unique(key)
        self._renew(users, newest[users], timers)
        order = np.lexsort([at, number, key])
        key, at, number = key[order], at[order], number[order]
        first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (number[1:] != number[:-1])))
        last = np.append(first[1:], len(key)) - 1
        yield from self._frame(key[first], type_int=number[first].astype(np.int32), start=at[first],
                               end=np.where(last > first, at[last], 0))

    def _close(self, over, timers):
        none = np.zeros(len(over), np.int64)
        yield from self._frame(over, type_int=np.full(len(over), CLOSED_SPANS, np.int32), start=none, end=none)
        self.kept["due"][over] = NOTHING


def _at(ts: str, tie: str | None) -> list[Column]:
    """Time as microseconds and a tiebreak, as the processors take them."""
    return [_number(F.unix_micros(F.col(ts)), "at"), _number(F.col(tie) if tie else F.lit(0), "tie")]


def _time(name: str, alias: str | None = None):
    return F.timestamp_micros(F.col(name)).alias(alias or name)


def _number(column: Column, alias: str) -> Column:
    return F.coalesce(column.cast("bigint"), F.lit(NOTHING)).alias(alias)


def _run(df: DataFrame, keys: list[str], processor: StatefulProcessor, out: T.StructType,
         mode: str, clock: str) -> DataFrame:
    """``processor`` over the groups of keys. Keys travel as numbers or text, beside whether they are null."""
    whole = {k: isinstance(df.schema[k].dataType, T.IntegralType) for k in keys}
    carried = [c for k in keys for c in (
        F.coalesce(F.col(k).cast("bigint" if whole[k] else "string"), F.lit(0 if whole[k] else "")).alias(k),
        F.col(k).isNull().alias(f"{k}_null"))]
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int").alias("bucket")
    found = df.select(bucket, *carried, *[c for c in df.columns if c not in keys]).groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=_out({k: T.LongType() if whole[k] else T.StringType() for k in keys}, out),
        outputMode=mode, timeMode=clock)
    return found.withColumns({k: F.col(k).cast(df.schema[k].dataType) for k in keys})


def _out(keys: dict[str, T.DataType], values: T.StructType) -> T.StructType:
    schema = T.StructType()
    for name, kind in keys.items():
        schema.add(name, kind)
    return T.StructType([*schema.fields, *values.fields])


def _actions(actions: DataFrame, tiebreak: str | None, clock: str) -> DataFrame:
    return actions.select("user_id", "device_id", _number(F.col("channel_id"), "channel"), _number(F.col("action"), "action"),
                          *_at("action_ts", tiebreak), *(["action_ts"] if clock == EVENT else []))


def device_sessions_stream(actions: DataFrame, idle_ms: int = SESSION_IDLE, mode: str = "update",
                           tiebreak: str | None = None, clock: str = PROCESSING) -> DataFrame:
    """Streaming form of ``device_sessions``; a session nobody ends for ``idle_ms``
    is emitted with end = epoch 0."""
    keys = ["user_id", "device_id"]
    out = T.StructType().add("start", T.LongType()).add("end", T.LongType()).add("channel_id", T.LongType())
    found = _run(_actions(actions, tiebreak, clock), keys, SessionState(keys, idle_ms, clock), out, mode, clock)
    return found.select(*keys, F.col("channel_id").cast(actions.schema["channel_id"].dataType)
                        .alias("channel_id"), _time("start", "start_ts"), _time("end", "end_ts"))


def session_parts_stream(actions: DataFrame, seconds: int, tiebreak: str | None = None) -> DataFrame:
    """Sessions of an action stream with a watermark on ``action_ts``, a part per cell of ``seconds``.

    A part comes as soon as event time passes its cell, the last one, ``closed``, with the
    action that ends the session. What was sent of a session that another start discards
    is never closed.
    """
    keys = ["user_id", "device_id"]
    out = (T.StructType().add("channel_id", T.LongType()).add("start", T.LongType()).add("since", T.LongType())
           .add("until", T.LongType()).add("closed", T.BooleanType()))
    found = _run(_actions(actions, tiebreak, EVENT), keys, PartState(keys, seconds), out, "append", EVENT)
    return found.select(*keys, F.col("channel_id").cast(actions.schema["channel_id"].dataType).alias("channel_id"),
                        _time("start", "session_start"), _time("since", "part_start"), _time("until", "part_end"), "closed")


def _numbered(events: DataFrame, tiebreak: str | None, clock: str) -> DataFrame:
    return events.select("user_id", _number(type_number(F.col("event_type")), "number"), *_at("event_ts", tiebreak),
                         *(["event_ts"] if clock == EVENT else []))


def activity_parts_stream(events: DataFrame, idle_ms: int = ACTIVITY_IDLE, mode: str = "append",
                          tiebreak: str | None = None, clock: str = PROCESSING) -> DataFrame:
    """What each micro-batch adds to the activity of a user on a day, and after ``idle_ms`` the
    mark 500 on the last day.

    Every event is sent on once, so the output grows with the input and not with the lists.
    ``part`` numbers a user's rows as they come; ``activity_days`` puts them together.
    """
    out = (T.StructType().add("day", T.IntegerType()).add("part", T.LongType()).add("type_ints", T.ArrayType(T.IntegerType()))
           .add("start", T.LongType()).add("end", T.LongType()))
    found = _run(_numbered(events, tiebreak, clock), ["user_id"], ActivityState(["user_id"], idle_ms, clock), out, mode, clock)
    return found.select("user_id", F.date_from_unix_date("day").alias("day"), "part", "type_ints",
                        _time("start"), _time("end"))


def activity_days(parts: DataFrame) -> DataFrame:
    """The parts of ``activity_parts_stream`` as ``user_activity`` gives them: a row per user and day."""
    in_order = F.sort_array(F.collect_list(F.struct("part", "type_ints")))
    return parts.groupBy("user_id", "day").agg(
        F.flatten(F.transform(in_order, lambda p: p["type_ints"])).alias("type_ints"),
        F.max("start").alias("start"), F.max("end").alias("end"))


def type_spans_stream(events: DataFrame, idle_ms: int = ACTIVITY_IDLE, mode: str = "append",
                      clock: str = PROCESSING) -> DataFrame:
    """Streaming form of ``type_spans``, each micro-batch by itself; after
    ``idle_ms`` a row with type 999."""
    out = T.StructType().add("type_int", T.IntegerType()).add("start", T.LongType()).add("end", T.LongType())
    found = _run(_numbered(events, None, clock), ["user_id"],
                 SpanState(["user_id"], idle_ms, clock), out, mode, clock)
    return found.select("user_id", "type_int", _time("start"), _time("end"))
