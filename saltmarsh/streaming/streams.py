"""Structured Streaming forms of batch operators: files in, parquet out, one run over what is there."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import IntegerType, StructType

from ..functions.scale import newest
from ..operators.textops import moderate
from ..session import scratch_path
from ..sources.tables import SCHEMAS


def read_stream(spark: SparkSession, folder: str, name: str, files_per_batch: int | None = None) -> DataFrame:
    """The named table, one file or a folder of files, as a stream; each micro-batch takes up to ``files_per_batch`` files."""
    reader = spark.readStream.schema(SCHEMAS[name])
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{folder}/{name}.parque[t]")  # a pattern of one name: the stream source takes no plain file


def drain(stream: DataFrame, name: str) -> DataFrame:
    """Run the stream over all input that is there and return what it wrote."""
    spark = stream.sparkSession
    out = scratch_path(spark, f"stream-{name}")
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start(f"{out}/data")
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/data")


def upsert_into(stream: DataFrame, path: str) -> None:
    """Run the stream over all input that is there and keep its rows as versions of the rows of the table at ``path``.

    A micro-batch is one folder of the table, written anew if the batch is run again; the checkpoint lies beside it, so a
    restart goes on where the last run ended and a repeated run changes nothing.
    """
    spark = stream.sparkSession

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/data/batch={number}")

    # A first folder, so that a stream without input has a table too.
    spark.createDataFrame([], stream.schema).write.mode("overwrite").parquet(f"{path}/data/batch=-1")
    store = "spark.sql.streaming.stateStore.providerClass"
    held = spark.conf.get(store)
    spark.conf.set(store, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")  # state on disk, as timers need it
    try:
        query = stream.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.set(store, held)


def read_upserts(spark: SparkSession, path: str, schema, keys: list[str]) -> DataFrame:
    """The last version of every row of an upserted table: by batch, then by ``step`` if there is one. Rows with ``gone`` set are left out."""
    rows = spark.read.schema(StructType(list(schema.fields)).add("batch", IntegerType())).parquet(f"{path}/data")
    values = [c for c in rows.columns if c not in (*keys, "batch", "step")]
    order = F.struct("batch", *[c for c in ("step",) if c in rows.columns])
    last = newest(rows, keys, order, values)
    return last.where(~F.col("gone")).drop("gone") if "gone" in values else last


def drain_upserts(stream: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """:func:`upsert_into` a table of its own; its rows as they stand at the end, open windows and sessions included."""
    path = scratch_path(stream.sparkSession, f"upserts-{name}")
    upsert_into(stream, path)
    return read_upserts(stream.sparkSession, path, stream.schema, keys)


def with_event_time(stream: DataFrame, column: str, delay: str) -> DataFrame:
    return stream.withColumn("event_time", F.col(column).cast("timestamp")).withWatermark("event_time", delay)


def moderation(stream: DataFrame) -> DataFrame:
    return moderate(stream)


def event_counts(stream: DataFrame, size: str = "1 hour", slide: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Events per window and type; rows later than ``delay`` are dropped. Appended, a window is written once it is closed; upserted, whenever it grows."""
    w = F.window("event_time", size, slide) if slide else F.window("event_time", size)
    counts = with_event_time(stream, "ts", delay).groupBy(w, "event_type").agg(F.count("*").alias("events"), F.sum("value").alias("value"))
    return counts.select(F.col("window.start").alias("started"), F.col("window.end").alias("ended"), "event_type", "events", "value")


class Sessions(StatefulProcessor):
    """The open sessions of a user as a list of (first, last, events). A row within ``gap`` of sessions joins them into one."""

    def __init__(self, gap: int):
        self.gap = gap

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "first bigint, last bigint, events bigint")

    def handleInputRows(self, key, rows, timerValues):
        before = sorted(tuple(int(v) for v in r) for r in self.open.get())
        times = sorted(int(t) for pdf in rows for t in pdf["at"])
        merged: list[list[int]] = []
        for first, last, events in sorted(before + [(t, t, 1) for t in times]):
            if merged and first < merged[-1][1] + self.gap:
                merged[-1][1] = max(merged[-1][1], last)
                merged[-1][2] += events
            else:
                merged.append([first, last, events])
        now = [tuple(m) for m in merged]
        self._keep([s for s in now if s[1] + self.gap > timerValues.getCurrentWatermarkInMs()])
        starts = {s[0] for s in now}
        out = [(key[0], *s, False) for s in now if s not in before] + [(key[0], *s, True) for s in before if s[0] not in starts]
        yield pd.DataFrame(out, columns=["user_id", "first", "last", "events", "gone"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self._keep([s for s in (tuple(int(v) for v in r) for r in self.open.get()) if s[1] + self.gap > expiredTimerInfo.getExpiryTimeInMs()])
        yield pd.DataFrame({c: [] for c in ("user_id", "first", "last", "events", "gone")})

    def _keep(self, sessions: list) -> None:
        if not sessions:
            self.open.clear()
            return
        self.open.put(sessions)
        self.handle.registerTimer(max(s[1] for s in sessions) + self.gap)  # older ones go with the next row or this timer

    def close(self) -> None:
        pass


def user_sessions(stream: DataFrame, gap_hours: int = 6, delay: str = "1 hour") -> DataFrame:
    """Sessions per user, for an upserted table with keys (user_id, first): a row whenever a session begins or grows, and one with
    ``gone`` set for a session that a late row has joined to an earlier one. ``first`` and ``last`` are milliseconds since 1970.

    The state holds a user's sessions until the event clock has passed their gap; rows without a user or a time are left out.
    """
    rows = with_event_time(stream.where("user_id IS NOT NULL AND ts IS NOT NULL"), "ts", delay)
    rows = rows.select("user_id", "event_time", F.unix_millis("event_time").alias("at"))
    return rows.groupBy("user_id").transformWithStateInPandas(
        Sessions(gap_hours * 3_600_000), "user_id bigint, first bigint, last bigint, events bigint, gone boolean", "Update", "EventTime"
    )


def distinct_requests(stream: DataFrame, key: str = "props", delay: str | None = None) -> DataFrame:
    """Requests whose key was not seen before; with ``delay``, not within that time, and the state forgets older keys.

    Without ``delay`` the result is the same for any split into micro-batches, and the state grows with the keys.
    """
    if delay is None:
        return stream.dropDuplicates([key])
    return with_event_time(stream, "ts", delay).dropDuplicatesWithinWatermark([key])


NEVER = np.iinfo(np.int64).max
BUCKETS = 256  # Fixed for a checkpoint: state lies under the bucket of a request.


class Deadlines(StatefulProcessor):
    """A bucket of requests: when each was opened and decided. Its deadline, or before it was opened its decision, is when it is
    due; the bucket's one timer stands at the earliest."""

    def __init__(self, allowed: int):
        self.allowed = allowed

    def init(self, handle) -> None:
        self.handle = handle
        self.requests = handle.getValueState("requests", "packed binary")

    def handleInputRows(self, key, rows, timerValues):
        held = self._held()
        timer, seen = self._due(held).min(initial=NEVER), []
        for pdf in rows:
            at, decides = pdf["at"].to_numpy(np.int64), pdf["is_decision"].to_numpy(bool)
            new = np.column_stack([pdf["id"].to_numpy(np.int64), np.where(decides, NEVER, at), np.where(decides, at, NEVER)])
            held = self._first(np.concatenate([held, new]))
            seen.append(np.unique(new[:, 0]))
        self._keep(held, timer)
        told = held[np.isin(held[:, 0], np.concatenate(seen)) & (held[:, 1] != NEVER)]
        yield self._rows(told, "open", 0)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held = self._held()
        due = self._due(held)
        gone = (due < timerValues.getCurrentWatermarkInMs()) | (due <= expiredTimerInfo.getExpiryTimeInMs())
        self._keep(held[~gone], expiredTimerInfo.getExpiryTimeInMs(), expired=True)
        yield self._rows(held[gone & (held[:, 1] != NEVER)], "breached", 1)

    def _held(self) -> np.ndarray:
        """Rows of id, first opening and first decision, ascending by id."""
        packed = self.requests.get()
        return np.frombuffer(packed[0] if packed else b"", np.int64).reshape(-1, 3)

    def _keep(self, held: np.ndarray, timer: int, expired: bool = False) -> None:
        wanted = self._due(held).min(initial=NEVER)
        if wanted != timer:
            if timer != NEVER and not expired:  # one that went off is forgotten by Spark
                self.handle.deleteTimer(int(timer))
            if wanted != NEVER:
                self.handle.registerTimer(int(wanted))
        if len(held):
            self.requests.update((held.tobytes(),))
        else:
            self.requests.clear()

    @staticmethod
    def _first(rows: np.ndarray) -> np.ndarray:
        rows = rows[np.argsort(rows[:, 0], kind="stable")]
        starts = np.flatnonzero(np.append(True, rows[1:, 0] != rows[:-1, 0])) if len(rows) else np.zeros(0, np.int64)
        return np.column_stack([rows[starts, 0], np.minimum.reduceat(rows[:, 1:], starts, axis=0)]) if len(rows) else rows

    def _due(self, held: np.ndarray) -> np.ndarray:
        return np.where(held[:, 1] == NEVER, held[:, 2], np.where(held[:, 1] == NEVER, 0, held[:, 1]) + self.allowed)

    def _rows(self, held: np.ndarray, undecided: str, step: int) -> pd.DataFrame:
        deadline = held[:, 1] + self.allowed
        return pd.DataFrame({"id": held[:, 0], "deadline": deadline, "state": np.where(held[:, 2] > deadline, undecided, "decided").astype(object), "step": np.int32(step)})

    def close(self) -> None:
        pass


def request_deadlines(stream: DataFrame, hours: int = 48, delay: str = "1 day", buckets: int = BUCKETS) -> DataFrame:
    """Requests with their deadline, for an upserted table with key id: ``open``, ``decided`` or ``breached``; ``deadline`` in milliseconds since 1970.

    A request opens with its first undecided row; its deadline is ``hours`` later. An event-time timer goes off once the event
    clock, ``delay`` behind the latest row, has passed the deadline: without a decision by then the request is
    breached, and a later decision withdraws nothing. The state then forgets the request, as it does a decision
    whose request is not opened before the clock passes it. Rows without a time are left out.

    State and timers are kept for a bucket of requests, by a hash of their ids, so Python is called for every bucket of a batch and not
    for every request.
    """
    rows = with_event_time(stream.where("o_orderkey IS NOT NULL AND o_orderdate IS NOT NULL"), "o_orderdate", delay)
    rows = rows.select(
        F.col("o_orderkey").alias("id"), "event_time", F.unix_millis("event_time").alias("at"), F.coalesce(F.col("o_orderstatus") != "P", F.lit(False)).alias("is_decision")
    )
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)))
    return rows.groupBy("bucket").transformWithStateInPandas(Deadlines(hours * 3_600_000), "id bigint, deadline bigint, state string, step int", "Update", "EventTime")


def sla_breaches(requests: DataFrame, clock: DataFrame) -> DataFrame:
    """Requests of an upserted table that are breached, or open beyond the latest time (``at``, milliseconds) of ``clock``: a timer is behind that by its delay."""
    latest = clock.agg(F.max("at").alias("at")).scalar()
    return requests.where((F.col("state") == "breached") | ((F.col("state") == "open") & (F.col("deadline") <= latest))).select("id", "deadline")
