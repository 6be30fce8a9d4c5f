"""Density clusters in any number of columns: an eps-join over a metric partition."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut_lineage
from .clusters import connected_groups

FAN = 16  # pivots by which a part is split
PART = 4096  # objects that are compared at once on either side
SPLIT = 8  # parts per side when a box is refined
BLOCK = 512  # home objects of one matrix
COPY = 1000  # comparisons that cost as much as one more copy of an object
GAIN = 0.7  # a split has to bring the work below this share


def _cells(columns: list[str], side: float) -> Column:
    return F.array(*[F.floor(F.col(c) / side).cast("bigint") for c in columns])


def _distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v))


def metric_parts(objects: DataFrame, reach: float, part: int = PART) -> DataFrame:
    """``objects`` (node, centre, radius, ...) in parts so that objects within ``reach`` plus their radii meet in one.

    Every object is at ``home`` in the part of its nearest pivot. By the triangle inequality an object that reaches a home
    object of another pivot is farther from that pivot than from its own by at most twice their reach; there it is a
    guest. Pivots are ``FAN`` of a part's own objects. Parts of more than ``part`` objects are split as long as that
    saves work, counting comparisons and copies of objects: where all objects are close it does not.
    Columns added: ``part``, ``home`` and, of the part, ``homes`` and ``size``.
    """
    widest = objects.agg(F.max("radius")).first()[0] or 0.0
    kept = objects.columns
    counts = [F.count("*").alias("size"), F.count_if("home").alias("homes")]
    work = (F.col("homes") + COPY) * F.col("size")
    now = objects.select("*", F.lit("").alias("part"), F.lit(True).alias("home"))
    now = cut_lineage(now.join(now.groupBy("part").agg(*counts), "part"))
    done = []
    while True:
        done.append(now.where(F.col("size") <= part))
        rest = now.where(F.col("size") > part)
        if rest.isEmpty():
            break
        order = F.xxhash64("node", "part")
        chosen = rest.where("home").withColumn("r", F.row_number().over(W.partitionBy("part").orderBy(order, "node"))).where(F.col("r") <= FAN)
        pivots = cut_lineage(chosen.groupBy("part").agg(F.collect_list("centre").alias("pivots")))
        far = rest.join(pivots, "part").withColumn("d", F.transform("pivots", lambda p: _distance(F.col("centre"), p)))
        far = far.withColumn("near", F.array_min("d"))
        room = 2 * (reach + widest + F.col("radius")) + 1e-9
        own = F.array_position("d", F.col("near")) - 1
        to = F.filter(F.transform("d", lambda v, i: F.when(v <= F.col("near") + room, i)), lambda i: i.isNotNull())
        dealt = far.select(*kept, "part", "home", own.alias("own"), F.explode(to).alias("to"))
        dealt = cut_lineage(dealt.withColumn("home", F.col("home") & (F.col("to") == F.col("own"))).drop("own"))
        subs = dealt.groupBy("part", "to").agg(*counts).where("homes > 0")
        before = rest.groupBy("part").agg(F.max(work).alias("before"))
        worth = subs.groupBy("part").agg(F.sum(work).alias("after")).join(before, "part").where(F.col("after") < GAIN * F.col("before"))
        worth = cut_lineage(worth.select("part"))
        done.append(rest.join(worth, "part", "left_anti"))
        split = dealt.join(subs.join(worth, "part"), ["part", "to"])
        now = cut_lineage(split.withColumn("part", F.concat_ws("/", "part", "to")).drop("to"))
    return reduce(lambda a, b: a.unionByName(b), done)


def comparison_jobs(parts: DataFrame, part: int = PART) -> DataFrame:
    """Rows of (job, home) in which every home object meets every object of its part, at most about ``part`` on either side."""
    rows, columns = F.ceil(F.col("homes") / part).cast("int"), F.ceil(F.col("size") / part).cast("int")
    slot = F.xxhash64("node", F.lit(17))
    mine = F.transform(F.sequence(F.lit(0), columns - 1), lambda j: F.concat_ws(":", "part", F.pmod(slot, rows), j))
    others = F.transform(F.sequence(F.lit(0), rows - 1), lambda i: F.concat_ws(":", "part", i, F.pmod(slot, columns)))
    plain = parts.withColumn("_mine", F.when(F.col("home"), mine)).withColumn("_others", others).drop("home")
    left = plain.where("_mine IS NOT NULL").select("*", F.explode("_mine").alias("job"), F.lit(True).alias("home"))
    right = plain.select("*", F.explode("_others").alias("job"), F.lit(False).alias("home"))
    return left.unionByName(right).drop("_mine", "_others", "part", "homes", "size")


def _boxes(table: pa.Table, d: int) -> tuple[np.ndarray, np.ndarray]:
    low, high = (pa.compute.list_flatten(table.column(name)).to_numpy().reshape(len(table), d) for name in ("lo", "hi"))
    return low, high


def _reaches(home: tuple, guests: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Squared least and largest distance between points of the boxes ``home`` and those of ``guests``."""
    near = np.zeros((len(home[0]), len(guests[0])))
    far = np.zeros_like(near)
    for k in range(home[0].shape[1]):
        lo, hi = home[0][:, k, None], home[1][:, k, None]
        one, two = guests[0][None, :, k] - hi, lo - guests[1][None, :, k]
        near += np.maximum(np.maximum(one, two), 0.0) ** 2
        far += np.maximum(guests[1][None, :, k] - lo, hi - guests[0][None, :, k]) ** 2
    return near, far


def _reached(home: tuple, guests: tuple, eps2: float):
    """Per block of home objects (from, to): matrices of the guests that are surely within reach, and of those that may be.

    Points are compared by one matrix product; only distances too close to the limit for it are computed again. Boxes are
    compared as such.
    """
    x, y = home[0], guests[0]
    wide = [np.flatnonzero((lo != hi).any(axis=1)) for lo, hi in (home, guests)]
    centre = y.mean(axis=0) if len(y) else 0.0
    xc, yc = x - centre, y - centre
    xx, yy = (xc**2).sum(axis=1), (yc**2).sum(axis=1)
    slack = 1e-12 * ((xx.max() if len(xx) else 0.0) + (yy.max() if len(yy) else 0.0)) + 1e-300
    for a in range(0, len(x), BLOCK):
        b = min(a + BLOCK, len(x))
        d2 = xx[a:b, None] + yy[None, :] - 2 * (xc[a:b] @ yc.T)
        sure, maybe = d2 <= eps2 - slack, np.zeros((b - a, len(y)), bool)
        i, j = np.nonzero(np.abs(d2 - eps2) <= slack)
        sure[i, j] = _plain(x[a + i], y[j]) <= eps2
        rows = wide[0][(wide[0] >= a) & (wide[0] < b)]
        if len(rows):
            near, far = _reaches((x[rows], home[1][rows]), guests)
            sure[rows - a], maybe[rows - a] = far <= eps2, (near <= eps2) & (far > eps2)
        if len(wide[1]):
            near, far = _reaches((x[a:b], home[1][a:b]), (y[wide[1]], guests[1][wide[1]]))
            sure[:, wide[1]], maybe[:, wide[1]] = far <= eps2, (near <= eps2) & (far > eps2)
        yield a, b, sure, maybe


def _plain(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    total = np.zeros(len(x))
    for k in range(x.shape[1]):
        total += (x[:, k] - y[:, k]) ** 2
    return total


def _sides(table: pa.Table) -> tuple[pa.Table, pa.Table]:
    home = table.column("home").to_numpy(zero_copy_only=False).astype(bool)
    return table.filter(pa.array(home)), table.filter(pa.array(~home))


def _count_near(eps2: float, d: int):
    """Per home point the points that are surely within reach, and the boxes that may hold some."""

    def run(table: pa.Table) -> pa.Table:
        mine, others = _sides(table)
        mine = mine.filter(pa.compute.invert(mine.column("full")))
        home, guests = _boxes(mine, d), _boxes(others, d)
        n, nodes = others.column("n").to_numpy(), others.column("node").to_numpy()
        sure, open_boxes = [], []
        for _, _, within, maybe in _reached(home, guests, eps2):
            sure += (within @ n).tolist()
            open_boxes += [nodes[m].tolist() for m in maybe]
        return pa.table([mine.column("node"), pa.array(sure, pa.int64()), pa.array(open_boxes, pa.list_(pa.int64()))], ["node", "sure", "boxes"])

    return run


def _link_near(eps2: float, d: int):
    """Enough of the sure links among the objects to connect what they connect, and the pairs of boxes that may be linked beyond those."""

    def run(table: pa.Table) -> pa.Table:
        mine, others = _sides(table)
        home, guests = _boxes(mine, d), _boxes(others, d)
        nodes, at = np.unique(np.append(mine.column("node").to_numpy(), others.column("node").to_numpy()), return_inverse=True)
        left, right = at[: len(mine)], at[len(mine) :]
        linked, maybe = [], []
        for a, b, within, open_pairs in _reached(home, guests, eps2):
            linked.append((left[a:b], within))
            i, j = np.nonzero(open_pairs)
            maybe.append(np.stack([left[a + i], right[j]], axis=1))
        label = np.arange(len(nodes))
        moved = bool(len(mine) and len(others))
        while moved:
            was = label.copy()
            for rows, m in linked:
                low = np.minimum(label[rows], np.where(m, label[right][None, :], len(nodes)).min(axis=1))
                label[rows] = low
                np.minimum.at(label, right, np.where(m, low[:, None], len(nodes)).min(axis=0))
            moved = bool((was != label).any())
        pairs = np.concatenate(maybe) if maybe else np.zeros((0, 2), np.int64)
        pairs = np.unique(np.sort(pairs[label[pairs[:, 0]] != label[pairs[:, 1]]], axis=1), axis=0)
        hang = np.flatnonzero(label != np.arange(len(nodes)))
        a = np.append(nodes[hang], nodes[pairs[:, 0]])
        b = np.append(nodes[label[hang]], nodes[pairs[:, 1]])
        sure = np.append(np.ones(len(hang), bool), np.zeros(len(pairs), bool))
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sure)], ["a", "b", "sure"])

    return run


def _label_near(eps2: float, d: int):
    """Per home point the smallest label that is surely within reach, and the boxes of smaller labels that may be."""

    def run(table: pa.Table) -> pa.Table:
        mine, others = _sides(table)
        mine = mine.filter(pa.compute.is_null(mine.column("label")))
        others = others.filter(pa.compute.is_valid(others.column("label")))
        home, guests = _boxes(mine, d), _boxes(others, d)
        labels, nodes = others.column("label").to_numpy(), others.column("node").to_numpy()
        best, open_boxes, top = [], [], np.iinfo(np.int64).max
        for _, _, within, maybe in _reached(home, guests, eps2):
            low = np.where(within, labels[None, :], top).min(axis=1, initial=top)
            best += [None if v == top else int(v) for v in low]
            open_boxes += [nodes[m].tolist() for m in maybe & (labels[None, :] < low[:, None])]
        return pa.table([mine.column("node"), pa.array(best, pa.int64()), pa.array(open_boxes, pa.list_(pa.int64()))], ["node", "label", "boxes"])

    return run


def _refined(points: DataFrame, xs: list[str], side: float, level: int) -> DataFrame:
    """Boxes of the points (node, x...) in every part of the grid at ``level``, with the part they lie in one level up."""
    part, parent = _cells(xs, side / SPLIT**level), _cells(xs, side / SPLIT ** (level - 1))
    boxes = points.select("node", part.alias("part"), parent.alias("parent"), *xs).groupBy("node", "part").agg(
        F.min("parent").alias("parent"), F.count("*").alias("n"), F.array(*[F.min(x) for x in xs]).alias("lo"), F.array(*[F.max(x) for x in xs]).alias("hi")
    )
    return boxes if level > 1 else boxes.withColumn("parent", F.lit(None).cast("array<bigint>"))


def _reach2(a_lo: Column, a_hi: Column, b_lo: Column, b_hi: Column) -> tuple[Column, Column]:
    def total(c):
        return F.aggregate(c, F.lit(0.0), lambda s, v: s + v * v)

    gap = F.zip_with(F.zip_with(b_lo, a_hi, lambda x, y: x - y), F.zip_with(a_lo, b_hi, lambda x, y: x - y), lambda x, y: F.greatest(x, y, F.lit(0.0)))
    span = F.zip_with(F.zip_with(b_hi, a_lo, lambda x, y: x - y), F.zip_with(a_hi, b_lo, lambda x, y: x - y), lambda x, y: F.greatest(x, y))
    return total(gap), total(span)


def _refinement(pairs: DataFrame, points: DataFrame, xs: list[str], side: float, eps: float, settled):
    """Judge pairs (a, b) of nodes by ever smaller boxes of their points: yields the judged pairs of every level, of which those neither
    surely within nor surely beyond eps, and not ``settled(judged)`` already, go on. Boxes end as single places."""
    now, level = pairs.select("a", "b", F.lit(None).cast("array<bigint>").alias("pa"), F.lit(None).cast("array<bigint>").alias("pb")), 0
    while not now.isEmpty():
        level += 1
        ends = now.select(F.col("a").alias("node")).union(now.select("b")).distinct()
        boxes = cut_lineage(_refined(points.join(ends, "node", "left_semi"), xs, side, level))

        def end(s, boxes=boxes):
            return boxes.select(F.col("node").alias(s), F.coalesce("parent", F.array().cast("array<bigint>")).alias(f"p{s}"), F.col("part").alias(f"q{s}"), *[F.col(c).alias(f"{s}_{c}") for c in ("n", "lo", "hi")])

        both = now.select("a", "b", *[F.coalesce(c, F.array().cast("array<bigint>")).alias(c) for c in ("pa", "pb")])
        near, far = _reach2(*[F.col(c) for c in ("a_lo", "a_hi", "b_lo", "b_hi")])
        judged = both.join(end("a"), ["a", "pa"]).join(end("b"), ["b", "pb"]).select("a", "b", "qa", "qb", "b_n", near.alias("near"), far.alias("far"))
        judged = cut_lineage(judged.where(F.col("near") <= eps * eps))
        yield judged
        now = settled(judged.where(F.col("far") > eps * eps)).select("a", "b", F.col("qa").alias("pa"), F.col("qb").alias("pb"))


def _linked_pairs(pairs: DataFrame, points: DataFrame, xs: list[str], side: float, eps: float) -> DataFrame:
    """Those of the pairs (a, b) of nodes that have points within eps of each other."""
    found: list[DataFrame] = []

    def settled(rest):
        return reduce(lambda r, f: r.join(f, ["a", "b"], "left_anti"), found, rest)

    for judged in _refinement(pairs, points, xs, side, eps, settled):
        found.append(judged.where(F.col("far") <= eps * eps).select("a", "b").distinct())
    return reduce(lambda x, y: x.unionByName(y), found) if found else pairs.select("a", "b").limit(0)


def density_clusters(df: DataFrame, id_col: str, columns: list[str], eps: float, min_points: int, part: int = PART) -> DataFrame:
    """DBSCAN labels: the smallest core id of the cluster, -1 for noise; (id, cluster, is_core), any number of columns.

    Points lie in grid cells so small that a cell's points are all neighbours; a cell with ``min_points`` is full: all its
    points are core and it goes on as one box, however many points it holds. The other points are single. Points
    and boxes are dealt into overlapping parts (:func:`metric_parts`) in which numpy compares blocks of them: single
    points are counted, core ones linked, the rest labelled, and only counts, spanning links and labels leave a
    task. Where a box is partly within eps, its points are looked at in ever smaller boxes, so copies
    of one place cost as much as one point. A border point takes the smallest label near it. A null id or value takes no part in
    clustering and is noise.
    """
    d = len(columns)
    side, eps2 = eps / math.sqrt(d), eps * eps
    xs = [f"x{i}" for i in range(d)]
    every = df.select(F.col(id_col).cast("bigint").alias("id"), *[F.col(c).cast("double").alias(x) for c, x in zip(columns, xs)])
    points = cut_lineage(every.dropna().withColumn("cell", _cells(xs, side)))
    full = points.groupBy("cell").agg(
        F.count("*").alias("n"), F.min("id").alias("node"), F.array(*[F.min(x) for x in xs]).alias("lo"), F.array(*[F.max(x) for x in xs]).alias("hi")
    )
    full = cut_lineage(full.where(F.col("n") >= min_points))
    inside = cut_lineage(points.join(full.select("cell", "node"), "cell", "left"))
    at = F.array(*xs)
    single = inside.where("node IS NULL").select(F.col("id").alias("node"), F.lit(1).cast("bigint").alias("n"), at.alias("lo"), at.alias("hi"), F.lit(False).alias("full"))
    objects = single.unionByName(full.select("node", "n", "lo", "hi", F.lit(True).alias("full")))
    centre = F.zip_with("lo", "hi", lambda a, b: (a + b) / 2)
    objects = objects.withColumn("centre", centre).withColumn("radius", _distance(F.col("lo"), F.col("hi")) / 2)
    jobs = cut_lineage(comparison_jobs(metric_parts(objects, eps, part), part).drop("centre", "radius"))
    nodes = inside.select(F.coalesce("node", "id").alias("node"), *xs)  # the points of every object

    counted = jobs.groupBy("job").applyInArrow(_count_near(eps2, d), "node bigint, sure bigint, boxes array<bigint>")
    counted = cut_lineage(counted.groupBy("node").agg(F.sum("sure").alias("sure"), F.array_distinct(F.flatten(F.collect_list("boxes"))).alias("boxes")))
    sure = F.col("sure") >= min_points
    cores = [counted.where(sure).select("node"), full.select("node")]
    open_pairs = counted.where(~sure).select(F.col("node").alias("a"), F.explode("boxes").alias("b"))
    reached = []
    for judged in _refinement(cut_lineage(open_pairs), nodes, xs, side, eps, lambda rest: rest):
        reached.append(judged.where(F.col("far") <= eps2).select(F.col("a").alias("node"), F.col("b_n").alias("sure")))
    if reached:
        more = reduce(lambda x, y: x.unionByName(y), [counted.where(~sure).select("node", "sure"), *reached])
        cores.append(more.groupBy("node").agg(F.sum("sure").alias("sure")).where(sure).select("node"))
    core = cut_lineage(reduce(lambda x, y: x.unionByName(y), cores))

    links = cut_lineage(jobs.join(core, "node", "left_semi").groupBy("job").applyInArrow(_link_near(eps2, d), "a bigint, b bigint, sure boolean"))
    groups = connected_groups(core, links.where("sure"))
    name = {s: groups.select(F.col("node").alias(s), F.col("group").alias(f"g{s}")) for s in ("a", "b")}
    apart = links.where("NOT sure").join(name["a"], "a").join(name["b"], "b").where("ga <> gb").select("a", "b").distinct()
    joined = cut_lineage(_linked_pairs(cut_lineage(apart), nodes, xs, side, eps))
    between = joined.join(name["a"], "a").join(name["b"], "b").select(F.col("ga").alias("a"), F.col("gb").alias("b"))
    merged = connected_groups(groups.select(F.col("group").alias("node")).distinct(), between)
    label = groups.join(merged.select(F.col("node").alias("group"), F.col("group").alias("label")), "group").select("node", "label")
    label = cut_lineage(label)

    seen = jobs.join(label, "node", "left").groupBy("job").applyInArrow(_label_near(eps2, d), "node bigint, label bigint, boxes array<bigint>")
    seen = cut_lineage(seen)
    least = seen.groupBy("node").agg(F.min("label").alias("label"))
    doubt = seen.select("node", F.explode("boxes").alias("b")).distinct().join(label.select(F.col("node").alias("b"), F.col("label").alias("maybe")), "b")
    doubt = cut_lineage(doubt.join(least, "node").where("label IS NULL OR maybe < label").select(F.col("node").alias("a"), "b", "maybe"))
    near_boxes = _linked_pairs(doubt, nodes, xs, side, eps).join(doubt, ["a", "b"]).select(F.col("a").alias("node"), F.col("maybe").alias("label"))
    border = least.unionByName(near_boxes).groupBy("node").agg(F.min("label").alias("label")).where("label IS NOT NULL")
    found = label.withColumn("is_core", F.lit(True)).unionByName(border.withColumn("is_core", F.lit(False)))
    by_id = inside.select("id", F.coalesce("node", "id").alias("node")).join(found, "node", "left")
    out = every.select("id").join(by_id.select("id", "label", "is_core"), "id", "left")
    return out.select(F.col("id").alias(id_col), F.coalesce("label", F.lit(-1)).cast("bigint").alias("cluster"), F.coalesce("is_core", F.lit(False)).alias("is_core"))
