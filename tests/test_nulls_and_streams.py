"""NULL keys in the keyed helpers, and streams over folders of several files."""

import datetime as dt
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from saltmarsh.functions.scale import null_safe_join, previous, quantiles, running
from saltmarsh.operators.stats import chi_square, forecast_drop, one_hot, target_encoding
from saltmarsh.operators.windows import against_group
from saltmarsh.sources.tables import SCHEMAS
from saltmarsh.streaming import streams as sm

T0 = dt.datetime(2024, 1, 1)
MS0 = 1_704_067_200_000

ROWS = [("a", 1, 10.0, 1), ("a", None, 20.0, 0), (None, 1, 30.0, 1), (None, 2, 50.0, 0), ("b", 5, None, 1)]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "k string, o int, v double, y int")


def test_running_and_previous_keep_null_keys_and_orders(rows):
    out = running(rows, ["k"], ["o"], F.floor(F.col("o") / 2), total=F.coalesce("v", F.lit(0.0)))
    assert {(r["k"], r["o"]): r["total"] for r in out.collect()} == {("a", None): 20, ("a", 1): 30, (None, 1): 30, (None, 2): 80, ("b", 5): 0}
    out = previous(rows, ["k"], ["o"], F.floor(F.col("o") / 2), ["v"])
    assert {(r["k"], r["o"]): r["prev_v"] for r in out.collect()} == {("a", None): None, ("a", 1): 20, (None, 1): None, (None, 2): 30, ("b", 5): None}


def test_keyed_quantiles_and_means_keep_the_null_group(rows):
    assert {r["k"]: r["m"] for r in quantiles(rows, "v", {"m": 0.5}, ["k"]).collect()} == {"a": 15, None: 40}
    assert {(r["k"], r["v"]): r["deviation"] for r in against_group(rows, "k", "v").collect()}[(None, 50.0)] == 10
    assert target_encoding(rows.withColumn("id", F.monotonically_increasing_id()), "k", "y", "id").count() == len(ROWS)


def test_chi_square_counts_null_levels(spark):
    df = spark.createDataFrame([(a, b) for a, b, n in [("x", None, 3), ("x", "q", 1), (None, None, 1), (None, "q", 3)] for _ in range(n)], "a string, b string")
    out = chi_square(df, "a", "b").collect()
    assert {(r["a"], r["b"]): r["observed"] for r in out} == {("x", None): 3, ("x", "q"): 1, (None, None): 1, (None, "q"): 3}
    assert {r["dof"] for r in out} == {1.0} and out[0]["chi2"] == pytest.approx(2.0)


def test_null_safe_join_keeps_left_keys(rows):
    other = rows.groupBy("k").agg(F.count("*").alias("n"))
    assert {r["k"]: r["n"] for r in null_safe_join(rows, other, ["k"]).collect()} == {"a": 2, None: 2, "b": 1}
    with pytest.raises(ValueError):
        null_safe_join(rows, other, [])


def test_levels_without_a_cap_and_single_months(spark):
    wide = one_hot(spark.range(1200).select(F.col("id").cast("string").alias("c")), "c", "c")
    assert len(wide.columns) == 1200
    monthly = spark.createDataFrame([(1, 1, 5), (2, 1, 5), (2, 2, 7)], "u int, m int, v int").withColumn("v", F.col("v").cast("decimal(18,2)"))
    out = {r["u"]: (r["forecast"], r["is_drop"]) for r in forecast_drop(monthly, "u", "m", "v", 3).collect()}
    assert out == {1: (None, None), 2: (9.0, False)}


def test_streams_read_folders_in_any_split(spark, small, tmp_path):
    events = spark.read.parquet(f"{small}/events.parquet")
    events.repartitionByRange(4, "ts").write.parquet(f"{tmp_path}/events.parquet")
    kinds = {}
    for files in (None, 1):
        stream = sm.read_stream(spark, str(tmp_path), "events", files)
        kinds[files] = sm.drain(sm.distinct_requests(stream).select("props"), "d").count()
    assert kinds[None] == kinds[1] == events.select("props").distinct().count()
    want = {(r["w"], r["event_type"]): r["n"] for r in events.groupBy(F.date_trunc("hour", "ts").alias("w"), "event_type").agg(F.count("*").alias("n")).collect()}
    for folder, files in ((small, None), (str(tmp_path), None), (str(tmp_path), 1)):
        counts = sm.event_counts(sm.read_stream(spark, folder, "events", files), delay="40 days")  # files may come in any order
        got = sm.drain_upserts(counts, "c", ["started", "event_type"]).collect()
        assert {(r["started"], r["event_type"]): r["events"] for r in got} == want


def files_in_turn(spark, folder, name, batches):
    """Each batch of rows as one file, later ones with a later time of change."""
    (folder / f"{name}.parquet").mkdir()
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMAS[name]).coalesce(1).write.parquet(str(folder / f"b{k}"))
        part = next((folder / f"b{k}").glob("part-*"))
        os.utime(part.rename(folder / f"{name}.parquet" / f"{k}.parquet"), (1e9 + k, 1e9 + k))


def event(n, user, hour):
    return (n, T0 + dt.timedelta(hours=hour), user, "view", 1.0, "p")


def test_sessions_grow_and_merge(spark, tmp_path):
    batches = [[event(1, 1, 0), event(2, 1, 10), event(3, 2, 0)], [event(4, 1, 5), event(5, 2, 2)], [event(6, 1, 200), event(7, None, 3)], [event(8, 1, 203)]]
    files_in_turn(spark, tmp_path, "events", batches)
    for files in (1, 2, None):
        stream = sm.user_sessions(sm.read_stream(spark, str(tmp_path), "events", files), 6, "24 hours")
        got = sm.drain_upserts(stream, "s", ["user_id", "first"]).collect()
        hours = {(r["user_id"], (r["first"] - MS0) // 3_600_000, (r["last"] - MS0) // 3_600_000, r["events"]) for r in got}
        assert hours == {(1, 0, 10, 3), (2, 0, 2, 2), (1, 200, 203, 2)}


def order(key, status, day):
    return (key, 1, status, 1.0, T0 + dt.timedelta(days=day), "1-URGENT")


def test_deadlines_fire_once(spark, tmp_path):
    batches = [[order(1, "P", 0), order(2, "P", 0), order(5, "F", 0)], [order(1, "F", 1), order(3, "P", 1)], [order(9, "P", 20)], [order(2, "F", 21), order(9, "F", 23)]]
    files_in_turn(spark, tmp_path, "orders", batches)
    for files in (1, None):
        rows = sm.drain_upserts(sm.request_deadlines(sm.read_stream(spark, str(tmp_path), "orders", files)), "d", ["id"])
        clock = spark.createDataFrame([(MS0 + 23 * 86_400_000,)], "at bigint")
        assert {r["id"] for r in sm.sla_breaches(rows, clock).collect()} == {2, 3, 9}
        assert {r["id"]: r["state"] for r in rows.collect()}[1] == "decided"


def test_upserts_survive_restarts(spark, small, tmp_path):
    events = spark.read.parquet(f"{small}/events.parquet")
    batches = [[tuple(r) for r in events.where(f"event_id % 3 = {k}").collect()] for k in range(3)]
    files_in_turn(spark, tmp_path, "events", batches[:2])
    keys, out = ["started", "event_type"], str(tmp_path / "out")

    def run():
        stream = sm.event_counts(sm.read_stream(spark, str(tmp_path), "events", 1), delay="40 days")
        sm.upsert_into(stream, out)
        return sm.read_upserts(spark, out, stream.schema, keys).agg(F.sum("events")).first()[0]

    assert run() == run() == len(batches[0]) + len(batches[1])
    spark.createDataFrame(batches[2], SCHEMAS["events"]).coalesce(1).write.parquet(str(tmp_path / "late"))
    next((tmp_path / "late").glob("part-*")).rename(tmp_path / "events.parquet" / "2.parquet")
    assert run() == 1000
    commits = tmp_path / "out" / "checkpoint" / "commits"
    last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
    (commits / str(last)).unlink()  # as if the run had ended between the sink and the commit
    (commits / f".{last}.crc").unlink(missing_ok=True)
    assert run() == 1000


def test_deadlines_take_a_bucket_at_once():
    """State is asked for once per call, however many requests a bucket holds."""

    class Handle:
        calls, kept, timers = 0, None, set()

        def getValueState(self, name, schema):
            return self

        def get(self):
            self.calls += 1
            return self.kept

        def update(self, value):
            self.calls, self.kept = self.calls + 1, value

        def clear(self):
            self.calls, self.kept = self.calls + 1, None

        def registerTimer(self, at):
            self.timers = self.timers | {at}

        def deleteTimer(self, at):
            self.timers = self.timers - {at}

    class Clock:
        def __init__(self, at):
            self.getCurrentWatermarkInMs = self.getExpiryTimeInMs = lambda: at

    handle, bucket = Handle(), sm.Deadlines(10)
    bucket.init(handle)
    pdfs = [pd.DataFrame({"id": range(n, 1000, 2), "at": 5 + n, "is_decision": n == 1}) for n in (0, 1)]
    pdfs.append(pd.DataFrame({"id": [0, 2, 4], "at": [15, 16, 3], "is_decision": [True, True, False]}))
    out = pd.concat(bucket.handleInputRows((0,), iter(pdfs), Clock(0)))
    assert handle.calls == 2 and handle.timers == {6}  # odd ids have a decision only
    assert len(out) == 500 and set(out["step"]) == {0}
    assert dict(zip(out["id"][:3], zip(out["deadline"], out["state"]))) == {0: (15, "decided"), 2: (15, "open"), 4: (13, "open")}
    out = pd.concat(bucket.handleExpiredTimer((0,), Clock(14), Clock(6)))
    assert out.values.tolist() == [[4, 13, "breached", 1]] and 15 in handle.timers
    out = pd.concat(bucket.handleExpiredTimer((0,), Clock(16), Clock(15)))
    assert len(out) == 499 and (out["state"] == "decided").sum() == 1 and handle.kept is None
