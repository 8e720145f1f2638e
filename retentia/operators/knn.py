"""Exact nearest neighbours without comparing every pair.

Points are dealt to the cells of a k-d tree over a sample, cut into groups of bounded size. A point first looks inside
its own group, which bounds its k-th distance. Then every group meets the points of other groups that its bounding box
and farthest k-th distance cannot rule out: they are streamed past the group, a few thousand at a time, so that a task
holds one group and one batch, and no point is copied more often than there are groups. Inside a task small cells of
both sides are compared only where their boxes are near enough. Points whose k-th distance is far above that of their
group seek in groups of their own. Copies of a point are searched once and told apart by id afterwards.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retentia.session import cut_lineage, lookup

BLOCK_ROWS = 4096
# A group has a block at least and that many at most, with about that many groups in between.
GROUP_BLOCKS = 8
GROUPS = 24
MAX_CELLS = 8192
# Sampled rows per cell of the tree.
SAMPLE_ROWS = 32
# Rows of a task's small cells, and how many of them are compared at once.
CELL_ROWS = 256
MEET_CELLS = 32
# Points that reach this much farther than nine tenths of their group seek apart from it.
FAR = 2.0
NOBODY = np.iinfo(np.int64).max
# Rows compared at a time inside a task.
CHUNK = 512


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances, from differences a feature at a time (no cancellation)."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        out += (a[:, j : j + 1] - b[None, :, j]) ** 2
    return np.sqrt(out)


def _closest(ids, x, other_ids, other_x, k: int) -> pd.DataFrame:
    """Up to k nearest others per row, itself left out; ties go to the smaller id."""
    parts = []
    order = np.argsort(other_ids, kind="stable")
    other_ids, other_x = other_ids[order], other_x[order]
    for lo in range(0, len(ids), CHUNK):
        some = ids[lo : lo + CHUNK]
        d = _distances(x[lo : lo + CHUNK], other_x)
        d[some[:, None] == other_ids[None, :]] = np.inf
        near = np.argsort(d, axis=1, kind="stable")[:, :k]
        dist = np.take_along_axis(d, near, axis=1)
        parts.append(
            pd.DataFrame({"id": np.repeat(some, near.shape[1]), "nn": other_ids[near].ravel(), "d": dist.ravel()})
        )
    out = pd.concat(parts) if parts else pd.DataFrame({"id": [], "nn": [], "d": []})
    return out[np.isfinite(out["d"])]


def _matrix(column) -> np.ndarray:
    return np.stack(column.to_numpy()).astype("float64")


def nearest(points: DataFrame, k: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, nn, d, rank): the k nearest other points of each point.

    `points` has a unique long `id` and an array<double> `x`. Ties go to the smaller id, whatever
    the blocks. Equal points are searched once: their smallest id stands for them, its neighbours
    are other values, and the ids of each value are filled in by id.
    """
    # -0.0 and 0.0 are the same place.
    points = points.select("id", F.transform("x", lambda v: v + F.lit(0.0)).alias("x"))
    # Each map task sends k + 1 ids a value at most: Spark limits the groups before it deals them out.
    first = points.withColumn("number", F.row_number().over(Window.partitionBy("x").orderBy("id"))).where(F.col("number") <= k + 1)
    members = cut_lineage(first.withColumn("rep", F.min("id").over(Window.partitionBy("x"))))
    values = members.where("number = 1").select("id", "x")
    near = _nearest_values(values, k, block_rows).select(F.col("id").alias("rep"), F.col("nn").alias("other"), "d")
    others = members.where(F.col("number") <= k).select(F.col("rep").alias("other"), F.col("id").alias("nn"))
    far = near.join(others, "other").select("rep", "nn", "d")
    own = members.select("rep", F.col("id").alias("nn"), F.lit(0.0).alias("d"))
    place = F.row_number().over(Window.partitionBy("rep").orderBy("d", "nn"))
    kept = far.unionByName(own).withColumn("place", place).where(F.col("place") <= k + 1)
    lists = kept.groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("d", "nn"))).alias("near"))
    lists = cut_lineage(lists.join(values.withColumnRenamed("id", "rep"), "rep").select("x", "near"))
    # Values with more copies than a block are few and come to their points; the others are joined by value.
    many = points.groupBy("x").count().where(F.col("count") > block_rows).select("x")
    hot = lookup(lists.join(many, "x", "left_semi"))
    found = points.join(hot, "x").unionByName(points.join(hot.select("x"), "x", "left_anti").join(lists, "x"))
    # Left out of its list, a point has k others there.
    found = found.select("id", F.slice(F.filter("near", lambda c: c["nn"] != F.col("id")), 1, k).alias("near"))
    return found.select("id", F.posexplode("near").alias("at", "c")).select("id", "c.nn", "c.d", (F.col("at") + 1).alias("rank"))


def _cells(x: np.ndarray, rows: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """An order of the rows and its stretches of at most `rows` rows: halves along the widest feature, again and again."""
    order, done, work = np.arange(len(x)), [], [(0, len(x))]
    while work:
        a, b = work.pop()
        if b - a <= rows:
            done.append((a, b))
            continue
        some = x[order[a:b]]
        middle = (b - a) // 2
        order[a:b] = order[a:b][np.argpartition(some[:, np.argmax(some.max(0) - some.min(0))], middle)]
        work += [(a, a + middle), (a + middle, b)]
    return order, sorted(done)


def _gaps(lo: np.ndarray, hi: np.ndarray, other_lo: np.ndarray, other_hi: np.ndarray) -> np.ndarray:
    """Squared distances of all boxes to all other boxes, 0 where they meet."""
    out = np.zeros((len(lo), len(other_lo)))
    for j in range(lo.shape[1]):
        out += np.maximum(np.maximum(other_lo[None, :, j] - hi[:, j, None], lo[:, j, None] - other_hi[None, :, j]), 0) ** 2
    return out


class _Seekers:
    """Points and their k nearest among the points met so far; ties go to the smaller id."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int, near: np.ndarray | None = None, d: np.ndarray | None = None):
        order, self.cells = _cells(x, CELL_ROWS)
        self.ids, self.x, self.k = ids[order], x[order], k
        self.near = np.full((len(ids), k), NOBODY) if near is None else near[order]
        self.d = np.full((len(ids), k), np.inf) if d is None else d[order]
        self.lo = np.array([self.x[a:b].min(0) for a, b in self.cells])
        self.hi = np.array([self.x[a:b].max(0) for a, b in self.cells])

    def meet(self, ids: np.ndarray, x: np.ndarray) -> None:
        """Take the points in, cells whose boxes are too far away left out."""
        order, cells = _cells(x, CELL_ROWS)
        ids, x = ids[order], x[order]
        lo, hi = np.array([x[a:b].min(0) for a, b in cells]), np.array([x[a:b].max(0) for a, b in cells])
        gaps = _gaps(self.lo, self.hi, lo, hi)
        for c, (a, b) in enumerate(self.cells):
            by_gap = np.argsort(gaps[c], kind="stable")
            first = 0
            while first < len(by_gap):
                reach = self.d[a:b, -1].max()
                # Without a bound the nearest cells come first, one by one; then all within reach.
                most = 1 if np.isinf(reach) else MEET_CELLS
                some = by_gap[first : first + most]
                some = some[gaps[c][some] <= reach * reach * (1 + 1e-9)]
                if not len(some):
                    break
                at = np.concatenate([np.arange(*cells[i]) for i in some])
                self._compare(a, b, ids[at], x[at])
                first += most

    def _compare(self, a: int, b: int, ids: np.ndarray, x: np.ndarray) -> None:
        """Products rule out most pairs; distances of the others come from differences, a feature at a time (no cancellation)."""
        own, middle = self.x[a:b], self.x[a:b].mean(0)
        p, q = own - middle, x - middle
        pp, qq = (p * p).sum(1), (q * q).sum(1)
        slack = 1e-15 * (x.shape[1] + 8) * (pp.max() + qq.max())
        bound = self.d[a:b, -1] ** 2
        if np.isinf(bound).any():
            bound = np.full(b - a, np.inf)
            if len(x) > self.k + 1:
                # One more than k, as a point may meet itself.
                bound = np.partition(pp[:, None] + qq[None] - 2 * (p @ q.T), self.k, axis=1)[:, self.k] + slack
        if np.isinf(bound).any():
            row, col = np.divmod(np.arange((b - a) * len(x)), len(x))
        else:
            # One product says how far a pair's squared distance, halved, is below the bound.
            room = np.hstack([p, np.ones((b - a, 1)), ((bound * (1 + 1e-9) - pp) / 2 + slack)[:, None]])
            row, col = np.divmod(np.flatnonzero(room @ np.hstack([q, -qq[:, None] / 2, np.ones((len(q), 1))]).T >= 0), len(x))
        other = ids[col] != self.ids[a + row]
        row, col = row[other], col[other]
        if not len(row):
            return
        square = np.zeros(len(row))
        for j in range(x.shape[1]):
            square += (own[row, j] - x[col, j]) ** 2
        who = np.unique(row)
        rows = np.concatenate([np.repeat(who, self.k), row])
        near = np.concatenate([self.near[a + who].ravel(), ids[col]])
        d = np.concatenate([self.d[a + who].ravel(), np.sqrt(square)])
        order = np.lexsort((near, d, rows))
        rows, near, d = rows[order], near[order], d[order]
        # A point that was met before stands beside itself.
        fresh = np.isfinite(d) & np.concatenate([[True], (rows[1:] != rows[:-1]) | (near[1:] != near[:-1])])
        rows, near, d = rows[fresh], near[fresh], d[fresh]
        starts = np.searchsorted(rows, rows)
        place = np.arange(len(rows)) - starts
        kept = place < self.k
        self.near[a + who], self.d[a + who] = NOBODY, np.inf
        self.near[a + rows[kept], place[kept]], self.d[a + rows[kept], place[kept]] = near[kept], d[kept]

    def found(self) -> pd.DataFrame:
        """(id, nn, d, rank) of the neighbours found."""
        row, place = np.nonzero(np.isfinite(self.d))
        return pd.DataFrame({"id": self.ids[row], "nn": self.near[row, place], "d": self.d[row, place], "rank": (place + 1).astype("int32")})


def _nearest_values(points: DataFrame, k: int, block_rows: int) -> DataFrame:
    """(id, nn, d, rank): the k nearest of points that all differ; ties go to the smaller id."""
    def alone(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, x = pdf["id"].to_numpy(), _matrix(pdf["x"])
        return _closest(ids, x, ids, x, k)

    n = points.count()
    if n <= block_rows:
        # One cell of one block, whatever its place.
        return _best(points.groupBy(F.lit(0).alias("cell")).applyInPandas(alone, "id long, nn long, d double"), k)
    # Few groups make few copies, many make small tasks.
    rows = int(min(max(block_rows, n / GROUPS), GROUP_BLOCKS * block_rows))
    placed = cut_lineage(_placed(points, _tree(points, min(MAX_CELLS, ceil(n / rows)))))
    sizes = placed.groupBy("cell").count().collect()  # one row per cell
    parts = points.sparkSession.createDataFrame([(r["cell"], max(1, ceil(r["count"] / (2 * rows)))) for r in sizes], "cell int, parts int")
    first_part = F.sum("parts").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
    numbers = lookup(parts.coalesce(1).withColumn("first", F.coalesce(first_part, F.lit(0)).cast("int")))
    grouped = placed.join(numbers, "cell").select(
        "id", "x", (F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts"))).cast("int").alias("g")
    )

    def own(pdf: pd.DataFrame) -> pd.DataFrame:
        seekers = _Seekers(pdf["id"].to_numpy(), _matrix(pdf["x"]), k)
        seekers.meet(seekers.ids, seekers.x)
        reach = seekers.d[:, -1]
        far = reach > FAR * np.quantile(reach, 0.9) if np.isfinite(reach).all() else np.zeros(len(reach), dtype=bool)
        return pd.DataFrame({"id": seekers.ids, "x": list(seekers.x), "g": pdf["g"].iloc[0], "far": far, "near": list(seekers.near), "d": list(seekers.d)})

    schema = "id long, x array<double>, g int, far boolean, near array<long>, d array<double>"
    first = cut_lineage(grouped.groupBy("g").applyInPandas(own, schema))
    groups, far = first.agg(F.max("g") + 1, F.count_if("far")).first()
    apart = ceil(far / rows)
    seek = F.when(F.col("far"), groups + F.pmod(F.xxhash64("id"), F.lit(max(apart, 1)))).otherwise(F.col("g")).cast("int")
    seekers = first.withColumn("s", seek)
    reach = _reaches(seekers)

    def routed(batches):
        """The points beside every group that they may be neighbours in."""
        for pdf in _chunks(batches):
            x, g = _matrix(pdf["x"]), pdf["g"].to_numpy()
            near = _gaps(x, x, reach["lo"], reach["hi"]) <= (reach["r"] ** 2 * (1 + 1e-9))[None]
            row, at = np.nonzero(near & (g[:, None] != reach["s"][None]))
            for lo in range(0, len(row), 20000):
                some = slice(lo, lo + 20000)
                yield pd.DataFrame({"s": reach["s"][at[some]], "id": pdf["id"].to_numpy()[row[some]], "x": pdf["x"].to_numpy()[row[some]]})

    nothing = [F.lit(None).cast("array<long>").alias("near"), F.lit(None).cast("array<double>").alias("d")]
    others = first.select("id", "x", "g").mapInPandas(routed, "s int, id long, x array<double>").select("s", F.lit(1).alias("kind"), "id", "x", *nothing)
    both = seekers.select("s", F.lit(0).alias("kind"), "id", "x", "near", "d").unionByName(others)

    def streamed(batches):
        """Rows by group, its seekers before the points that come past."""
        s, waiting, group = None, [], None
        for pdf in batches:
            for number, part in pdf.groupby("s", sort=True):
                if number != s:
                    if s is not None:
                        yield (group or seeking(waiting)).found()
                    s, waiting, group = number, [], None
                own = part["kind"] == 0
                if own.any():
                    waiting.append(part[own])
                if not own.all():
                    group = group or seeking(waiting)
                    some = part[~own]
                    group.meet(some["id"].to_numpy(), _matrix(some["x"]))
        if s is not None:
            yield (group or seeking(waiting)).found()

    def seeking(waiting):
        rows = pd.concat(waiting)
        return _Seekers(rows["id"].to_numpy(), _matrix(rows["x"]), k, np.stack(rows["near"].to_numpy()), _matrix(rows["d"]))

    dealt = both.repartition(groups + apart, "s").sortWithinPartitions("s", "kind")
    return dealt.mapInPandas(streamed, "id long, nn long, d double, rank int")


def _chunks(batches):
    for pdf in batches:
        for lo in range(0, len(pdf), CHUNK):
            yield pdf.iloc[lo : lo + CHUNK]


def _tree(points: DataFrame, leaves: int) -> list[tuple]:
    """Splits (feature, cut, low, high) of a k-d tree over a sample by hash order; the others are (None, cell, None, None)."""
    rows = points.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS * min(leaves, MAX_CELLS)).select("x").collect()
    x = np.array([r.x for r in rows], dtype="float64")
    nodes, cells, work = [None], 0, [(0, np.arange(len(x)), leaves)]
    while work:
        at, own, m = work.pop()
        spread = x[own].max(0) - x[own].min(0) if len(own) > 1 else np.zeros(x.shape[1])
        spread = np.nan_to_num(spread, nan=0.0, posinf=0.0)
        if m < 2 or spread.max(initial=0) <= 0:
            nodes[at], cells = (None, cells, None, None), cells + 1
            continue
        j = int(np.argmax(spread))
        values = np.sort(x[own, j])
        cut = values[len(values) * (m // 2) // m]
        # The cut's own values go right; a cut at the least value would leave the left side empty.
        cut = cut if cut > values[0] else values[np.searchsorted(values, cut, "right")]
        low = x[own, j] < cut
        nodes[at] = (j, cut, len(nodes), len(nodes) + 1)
        work += [(len(nodes), own[low], m // 2), (len(nodes) + 1, own[~low], m - m // 2)]
        nodes += [None, None]
    return nodes


def _placed(points: DataFrame, nodes: list[tuple]) -> DataFrame:
    """Adds the cell of the tree."""

    def place(batches):
        for pdf in batches:
            x = _matrix(pdf["x"]) if len(pdf) else np.zeros((0, 1))
            cell, work = np.zeros(len(pdf), dtype="int32"), [(0, np.arange(len(pdf)))]
            while work:
                at, own = work.pop()
                j, cut, low, high = nodes[at]
                if j is None:
                    cell[own] = cut
                elif len(own):
                    left = x[own, j] < cut
                    work += [(low, own[left]), (high, own[~left])]
            yield pdf.assign(cell=cell)

    return points.select("id", "x").mapInPandas(place, "id long, x array<double>, cell int")


def _reaches(seekers: DataFrame) -> dict[str, np.ndarray]:
    """Per group of seekers its number s, bounding box lo, hi and the farthest k-th distance r (infinite if one has fewer)."""

    def boxes(batches):
        for pdf in batches:
            for s, part in pdf.groupby("s"):
                x = _matrix(part["x"])
                yield pd.DataFrame({"s": [s], "lo": [x.min(0)], "hi": [x.max(0)], "r": [max(d[-1] for d in part["d"])]})

    found: dict = {}
    # A few rows per group and task.
    for r in seekers.select("s", "x", "d").mapInPandas(boxes, "s int, lo array<double>, hi array<double>, r double").collect():
        lo, hi, reach = found.get(r.s, (np.inf, -np.inf, 0.0))
        found[r.s] = (np.minimum(lo, r.lo), np.maximum(hi, r.hi), max(reach, r.r))
    numbers = sorted(found)
    return {
        "s": np.array(numbers, dtype="int32"), "lo": np.array([found[s][0] for s in numbers]), "hi": np.array([found[s][1] for s in numbers]),
        "r": np.array([found[s][2] for s in numbers]),
    }


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k nearest per point out of the candidates."""
    w = Window.partitionBy("id").orderBy("d", "nn")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
