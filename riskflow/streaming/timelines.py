"""The measures of ``operators.timelines`` on a stream, with state per key that expires.

A row is measured when the watermark has passed it: no row before it can come any more, so what is
written is final and equals the batch measure over all rows that came in time. Rows that come when
the watermark has passed them are dropped, as Spark defines it; rows without a user or a time are on
no timeline and not written. A run that ends leaves the rows that the watermark has not passed in
the state; the next run goes on with them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from riskflow.operators.timelines import (
    MICROS, UNITS, VelocityRule, micros, score, stretch_of, units,
)
from riskflow.session import ship_package

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Users share state keys, as each key costs calls between Spark and Python however few its rows
# are. These numbers are part of the keys: a checkpoint keeps those that it began with.
STRETCH_PARTS = 16
USER_PARTS = 1024
# Rows of a frame that is handed back.
CHUNK = 100_000
# Numbers that stand for a user and a time stay below this.
WIDEST = 2**62
PACKED = "packed binary"
VELOCITY_ROW = ("user_id string, at long, transaction_id string, velocity_count long, units long")
VELOCITY_STATE = pa.schema([
    ("user_id", pa.string()), ("at", pa.int64()), ("units", pa.int64()), ("own", pa.bool_()),
    ("transaction_id", pa.string())])
DEVICE_ROW = ("user_id string, at long, transaction_id string, device_id string, "
              "previous_device string, device_changed boolean, device_is_new boolean")
DEVICE_STATE = pa.schema([
    ("user_id", pa.string()), ("at", pa.int64()), ("transaction_id", pa.string()), ("device_id", pa.string())])
# Where each device of a user was first seen, and whether it is the user's last.
DEVICE_KNOWN = DEVICE_STATE.append(pa.field("last", pa.bool_()))


def ready_for_state(spark: SparkSession) -> None:
    """Keyed state with timers needs this store and the package's code in the Python workers.
    Streams without keyed state do not notice."""
    if spark.conf.get(STORE, None) != ROCKSDB:
        spark.conf.set(STORE, ROCKSDB)
    ship_package(spark)


def _timer(at: int) -> int:
    """The first millisecond that is not before a time in microseconds."""
    return -(-at // 1000)


def _part_of(key: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def _pack(table: pa.Table) -> tuple[bytes]:
    """Rows as one value of the state."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return (sink.getvalue().to_pybytes(),)


def _unpack(values, schema: pa.Schema) -> pa.Table:
    tables = [pa.ipc.open_stream(value[0]).read_all() for value in values]
    return pa.concat_tables(tables) if tables else schema.empty_table()


def _sorted(table: pa.Table, *names: str) -> pa.Table:
    """By these columns, nulls first; texts go by code points."""
    return table.take(pc.sort_indices(
        table, sort_keys=[(name, "ascending") for name in names], null_placement="at_start"))


def _codes(*columns) -> np.ndarray:
    """A number per combination of values, the same for equal ones; a null is a value."""
    out = np.zeros(len(columns[0]), dtype=np.int64)
    for column in columns:
        own = pc.dictionary_encode(column.combine_chunks(), null_encoding="encode")
        own = (own.combine_chunks() if isinstance(own, pa.ChunkedArray) else own).indices.to_numpy(zero_copy_only=False)
        out = np.unique(out * (int(own.max(initial=0)) + 1) + own, return_inverse=True)[1].astype(np.int64)
    return out


def _taken(column, places: np.ndarray):
    """The values at these places, null for a negative one."""
    return column.take(pa.array(np.where(places < 0, 0, places), mask=places < 0))


def _starts(same: np.ndarray) -> np.ndarray:
    """True at the first of each run of equal values."""
    out = np.ones(len(same), dtype=bool)
    out[1:] = same[1:] != same[:-1]
    return out


def _frames(table: pa.Table) -> Iterator[pd.DataFrame]:
    for start in range(0, table.num_rows, CHUNK):
        yield table.slice(start, CHUNK).to_pandas()


class _OnceFinal(StatefulProcessor):
    """Collects rows and hands those to ``_final`` that the watermark has passed, at most once.

    A state key holds the rows of many users, packed by columns. One timer stands at the earliest
    waiting row; it is set anew when it has fired.
    """

    schema: pa.Schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._rows = handle.getListState("rows", PACKED)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        parts = [pa.Table.from_pandas(part[self.schema.names], self.schema, preserve_index=False) for part in rows]
        if parts:
            came = pa.concat_tables(parts)
            self._rows.appendList([_pack(came.slice(start, CHUNK)) for start in range(0, came.num_rows, CHUNK)])
            self._wait_for(pc.min(came["at"]).as_py())
        return iter(())

    def _waiting(self, timer_values) -> tuple[int, pa.Table]:
        """The watermark and the rows of the state."""
        return timer_values.getCurrentWatermarkInMs() * 1000, _unpack(self._rows.get(), self.schema)

    def _keep(self, rows: pa.Table) -> None:
        if rows.num_rows:
            self._rows.put([_pack(rows.slice(start, CHUNK)) for start in range(0, rows.num_rows, CHUNK)])
        else:
            self._rows.clear()

    def _wait_for(self, at: int) -> None:
        self._handle.registerTimer(_timer(at))

    def close(self) -> None:
        pass


class _Velocity(_OnceFinal):
    """Rows of one stretch, with those of the window before it (not its own)."""

    schema = VELOCITY_STATE

    def __init__(self, rule: VelocityRule) -> None:
        self._rule = rule

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        window = self._rule.window_seconds * MICROS
        passed, rows = self._waiting(timerValues)
        at = rows["at"].to_numpy()
        out = _measured(rows.filter(pa.array(at <= passed)), window)
        late = rows.filter(pa.array(at > passed))
        # What still counts for rows to come; they are later than the watermark.
        kept = rows.filter(pa.array((at > passed - window) & (at <= passed)))
        end = (key[0] + 1) * self._rule.stretch_seconds * MICROS
        if passed >= end and not late.num_rows:
            kept = kept.slice(0, 0)
        if kept.num_rows:
            kept = kept.set_column(3, "own", pa.array(np.zeros(kept.num_rows, dtype=bool))) \
                .set_column(4, "transaction_id", pa.nulls(kept.num_rows, pa.string()))
        self._keep(pa.concat_tables([kept, late]))
        if late.num_rows:
            self._wait_for(pc.min(late["at"]).as_py())
        elif kept.num_rows:
            self._wait_for(min(end, pc.max(kept["at"]).as_py() + window))
        yield from _frames(out)


def _measured(rows: pa.Table, window: int) -> pa.Table:
    """Count and units in the window of each own row; ties count each other."""
    rows = _sorted(rows, "user_id", "at")
    user, at = _codes(rows["user_id"]), rows["at"].to_numpy()
    first, last = np.zeros(len(at), dtype=np.int64), np.zeros(len(at), dtype=np.int64)
    if len(at):
        # Times as numbers that rise from user to user, further apart than any window.
        user, apart = np.cumsum(_starts(user)) - 1, int(at.max()) - int(at.min()) + window + 1
        users = max(1, WIDEST // apart)
        cuts = np.searchsorted(user, np.arange(0, user[-1] + users + 1, users))
        for low, high in zip(cuts[:-1], cuts[1:]):
            line = at[low:high] - at.min() + (user[low:high] - user[low]) * apart
            first[low:high] = low + np.searchsorted(line, line - window, "left")
            last[low:high] = low + np.searchsorted(line, line, "right")
    total = np.concatenate([[0], np.cumsum(rows["units"].to_numpy())])
    out = pa.table({
        "user_id": rows["user_id"], "at": rows["at"], "transaction_id": rows["transaction_id"],
        "velocity_count": pa.array(last - first, pa.int64()), "units": pa.array(total[last] - total[first], pa.int64()),
    })
    return out.filter(rows["own"])


def _known(df: DataFrame, delay: str) -> DataFrame:
    return df.where("user_id is not null and event_time is not null").withWatermark("event_time", delay)


def stream_velocity(df: DataFrame, rule: VelocityRule = VelocityRule(), delay: str = "1 hour") -> DataFrame:
    """transaction_id, user_id, event_time and the measures of :func:`velocity`, once final.

    State is kept per stretch and part of the users, so a user with very many rows is spread over
    the tasks by time. It holds the rows that wait for the watermark and those of one window before
    it.
    """
    ready_for_state(df.sparkSession)
    at = micros(F.col("event_time"))
    own, after = stretch_of(at, rule.stretch_seconds), stretch_of(
        at + F.lit(rule.window_seconds * MICROS + 1), rule.stretch_seconds)
    places = F.filter(F.array(
        F.struct(own.alias("stretch"), F.lit(True).alias("own")),
        F.when(after > own, F.struct(after.alias("stretch"), F.lit(False).alias("own"))),
    ), lambda place: place.isNotNull())
    rows = _known(df, delay).select(
        "user_id", "event_time", at.alias("at"), units(F.col("amount")).alias("units"), "transaction_id",
        F.inline(places),
    )
    found = rows.withColumn("part", _part_of(F.col("user_id"), STRETCH_PARTS)).groupBy("stretch", "part").transformWithStateInPandas(
        _Velocity(rule), VELOCITY_ROW, "Append", "EventTime")
    return found.select(
        "transaction_id", "user_id", F.timestamp_micros("at").alias("event_time"), "velocity_count",
        (F.col("units") / F.lit(float(UNITS))).alias("velocity_amount"),
        score(F.col("velocity_count"), rule.limit).alias("velocity_score"),
        F.to_date(F.timestamp_micros("at")).alias("event_date"),
    )


class _Devices(_OnceFinal):
    """Of some users the last device, the devices seen, and the rows that wait for the watermark."""

    schema = DEVICE_STATE

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self._known = handle.getValueState("known", PACKED)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed, rows = self._waiting(timerValues)
        due = pc.less_equal(rows["at"], passed)
        final, late = rows.filter(due), rows.filter(pc.invert(due))
        if not final.num_rows:  # an earlier timer of this batch has seen to them
            return
        self._keep(late)
        if late.num_rows:
            self._wait_for(pc.min(late["at"]).as_py())
        del rows, due, late
        known = _unpack([self._known.get()] if self._known.exists() else [], DEVICE_KNOWN)
        found, known = _changes(final, known)
        self._known.update(_pack(known))
        yield from _frames(found)


def _changes(rows: pa.Table, known: pa.Table) -> tuple[pa.Table, pa.Table]:
    """The columns of :func:`device_changes` for rows after those that ``known`` tells of, and what
    is known after them."""
    rows = _sorted(rows, "user_id", "at", "transaction_id")
    n, place = rows.num_rows, np.arange(rows.num_rows)
    both = pa.concat_tables([rows.select(DEVICE_STATE.names), known.select(DEVICE_STATE.names)])
    users, pairs = _codes(both["user_id"]), _codes(both["user_id"], both["device_id"])
    user, pair, there = users[:n], pairs[:n], rows["device_id"].is_valid().to_numpy()
    # The user's last row with a device, before each row: here, or else what is known.
    start = np.maximum.accumulate(np.where(_starts(user), place, 0))
    sofar = np.maximum.accumulate(np.where(there, place, -1))
    before = np.concatenate([[-1], sofar[:-1]])
    carried = np.full(users.max(initial=0) + 1, -1)
    last = known["last"].to_numpy()
    carried[users[n:][last]] = n + np.flatnonzero(last)
    previous = np.where(before >= start, before, carried[user])
    # Where each device is first seen; a row that repeats that one is first as well.
    first = np.full(pairs.max(initial=0) + 1, -1)
    first[pair[there][::-1]] = place[there][::-1]
    first[pairs[n:]] = n + np.arange(known.num_rows)
    at, ids = both["at"].to_numpy(), _codes(both["transaction_id"])
    origin = first[pair]
    is_new = there & (at[origin] == at[:n]) & (ids[origin] == ids[:n])
    changed = there & (previous >= 0) & (pairs[previous] != pair)
    found = pa.table({
        **{name: rows[name] for name in DEVICE_STATE.names},
        "previous_device": _taken(both["device_id"], previous),
        "device_changed": pa.array(changed), "device_is_new": pa.array(is_new),
    })
    seen = first[first >= 0]
    latest = carried.copy()
    ends = np.flatnonzero(there)
    latest[user[ends]] = ends  # the last assignment of a user stands
    is_last = np.zeros(len(first), dtype=bool)
    is_last[pairs[latest[latest >= 0]]] = True
    after = both.take(pa.array(seen)).append_column("last", pa.array(is_last[first >= 0]))
    return found, after.cast(DEVICE_KNOWN)


def stream_device_changes(df: DataFrame, delay: str = "1 hour") -> DataFrame:
    """transaction_id, user_id, event_time, device_id and the columns of :func:`device_changes`.

    State is kept per part of the users: the rows that wait, each user's last device, and where each
    device was first seen. What a user's timeline says depends on all of it, so a user's rows of one
    micro-batch are one task's, worked on by columns; limit the micro-batch where a user may have
    very many.
    """
    ready_for_state(df.sparkSession)
    rows = _known(df, delay).select(
        "user_id", "event_time", micros(F.col("event_time")).alias("at"), "transaction_id", "device_id")
    found = rows.withColumn("part", _part_of(F.col("user_id"), USER_PARTS)).groupBy("part").transformWithStateInPandas(
        _Devices(), DEVICE_ROW, "Append", "EventTime")
    time = F.timestamp_micros("at")
    return found.select("transaction_id", "user_id", time.alias("event_time"), "device_id", "previous_device",
                        "device_changed", "device_is_new", F.to_date(time).alias("event_date"))
