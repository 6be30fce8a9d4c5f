"""Joins and running sums that hold when one key has a large part of all rows."""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saltmarsh.session import cut_lineage

MOST = 20_000  # rows that are broadcast at most


def join_keyed(left: DataFrame, right: DataFrame, key: list[str], weight: str, most: int = MOST) -> DataFrame:
    """``left`` left-joined to ``right``, which has one row per ``key`` and says in ``weight`` how many rows meet it.

    The ``most`` heaviest rows of ``right`` are broadcast, so no hot key is shuffled; the other
    rows meet in a shuffle join. A null in the key joins nothing. ``right`` is read several times and
    should be a written table.
    """
    bare = right.drop(weight)
    if right.count() <= most:
        return left.join(F.broadcast(bare), key, "left")
    heavy = cut_lineage(right.orderBy(F.desc(weight), *key).limit(most))
    null = F.lit(False)
    for k in key:
        null = null | F.col(k).isNull()
    more = [c for c in bare.columns if c not in key]
    kinds = dict(bare.dtypes)
    blank = left.where(null).select("*", *[F.lit(None).cast(kinds[c]).alias(c) for c in more])
    known = left.where(~null)
    hot = known.join(F.broadcast(heavy.drop(weight)), key)
    cold = known.join(F.broadcast(heavy.select(*key)), key, "left_anti").join(bare, key, "left")
    return hot.unionByName(cold).unionByName(blank)


def _run(names: list[str], key: str, values: list[str]):
    """Inclusive running sums modulo 2^64 within the sorted rows of each partition, and the partition's number."""

    def run(batches):
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        last, carry = None, [np.zeros(1, np.uint64) for _ in values]
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            keys = batch.column(names.index(key)).to_numpy()
            first = np.append(True, keys[1:] != keys[:-1])
            start = np.flatnonzero(first)
            group = np.cumsum(first) - 1
            out = []
            for k, v in enumerate(values):
                x = batch.column(names.index(v)).to_numpy().view(np.uint64)
                total = np.cumsum(x, dtype=np.uint64)
                before = np.append(np.zeros(1, np.uint64), total)[start]
                if last is not None and keys[0] == last:
                    before[0] -= carry[k][0]
                total = total - before[group]
                out.append(pa.array(total.view(np.int64)))
                carry[k] = total[-1:].copy()
            last = keys[-1]
            yield pa.RecordBatch.from_arrays([*batch.columns, *out, pa.array(np.full(n, pid, np.int32))], [*names, *[f"sum_{v}" for v in values], "pid"])

    return run


def wrapped(a, b, minus: bool = False):
    """a + b, or a - b, modulo 2^64 as a long."""
    x, y = a.cast("decimal(38,0)"), b.cast("decimal(38,0)")
    wide = (x - y if minus else x + y) + F.lit(Decimal(2**63))
    slow = (F.pmod(wide, F.lit(Decimal(2**64))) - F.lit(Decimal(2**63))).cast("long")
    return F.coalesce(F.try_subtract(a, b) if minus else F.try_add(a, b), slow)


def running_sums(rows: DataFrame, key: str, order: list, values: list[str]) -> DataFrame:
    """``rows`` with ``sum_<v>``: running sums modulo 2^64, the row included, of each of the long columns ``values`` per ``key``.

    ``key`` is a long without nulls. Rows are dealt into ranges of (key, order), so a hot key is
    spread over many tasks; every task adds up its range as a stream and the result is written. What is
    carried from a range to the next is one sum per range, which the driver adds up.
    """
    names = rows.columns
    kinds = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes)
    sums = [f"sum_{v}" for v in values]
    ranged = rows.repartitionByRange(F.col(key), *order).sortWithinPartitions(F.col(key), *order)
    done = cut_lineage(ranged.mapInArrow(_run(names, key, values), f"{kinds}, {', '.join(f'{s} long' for s in sums)}, pid int"))
    edges = [tuple(r) for r in done.groupBy("pid").agg(F.min(key), F.max(key)).orderBy("pid").collect()]  # one per range
    crossing = [(a[0], a[2]) for a, b in zip(edges, edges[1:]) if a[2] == b[1]]
    if not crossing:
        return done.select(*names, *sums)
    ends = rows.sparkSession.createDataFrame(crossing, f"pid int, `{key}` long")
    at_end = done.join(F.broadcast(ends), ["pid", key]).groupBy("pid").agg(*[F.sum(F.col(v).cast("decimal(38,0)")).alias(v) for v in values])
    total = {r["pid"]: [int(r[v]) for v in values] for r in at_end.collect()}
    carried, now = [], [0] * len(values)
    for a, b in zip(edges, edges[1:]):
        if a[2] != b[1]:
            now = [0] * len(values)
            continue
        now = [x + y for x, y in zip(now if a[1] == a[2] else [0] * len(values), total[a[0]])]
        carried.append((b[0], b[1], *[(x + 2**63) % 2**64 - 2**63 for x in now]))
    offsets = rows.sparkSession.createDataFrame(carried, f"pid int, `{key}` long, {', '.join(f'add_{v} long' for v in values)}")
    met = done.join(F.broadcast(offsets), ["pid", key], "left")
    out = [F.when(F.col(f"add_{v}").isNull(), F.col(f"sum_{v}")).otherwise(wrapped(F.col(f"sum_{v}"), F.col(f"add_{v}"))).alias(f"sum_{v}") for v in values]
    return met.select(*names, *out)
