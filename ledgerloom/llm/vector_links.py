"""Near-copies among vectors: exact threshold pairs by dual traversal of cover trees."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, stored

UNITS = "vec_id long, label long, size int, unit array<double>"
NEAR = "label long, size int, cell int, gap double"
DEALT = "label long, size int, low int, high int, cell int, vec_id long, unit array<double>"
LINKS = "a long, b long"
SLACK = 1e-7


class CoverTree:
    """Nested nets of points: the net of level i holds points more than 2**(1 - i) apart, and
    each point of the next net lies within that radius of one of them.

    A node knows its points and its covering radius, the largest distance from its centre to
    any of them. Nodes of few points are leaves.
    """

    def __init__(self, points: np.ndarray, leaf: int = 32):
        self.points, self.leaf = points, leaf
        self.members: list[np.ndarray] = []
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.children: list[list[int]] = []
        if len(points):
            self._add(np.arange(len(points)), 0, 1)

    def _add(self, members: np.ndarray, centre: int, level: int) -> int:
        node = len(self.members)
        away = distances(self.points[members], self.points[centre])
        self.members.append(members)
        self.centre.append(centre)
        self.radius.append(float(away.max()))
        self.children.append([])
        if len(members) <= self.leaf or self.radius[node] <= SLACK:
            return node
        reach = 2.0 ** (1 - level)
        while self.radius[node] <= reach:  # levels on which the node would be its own only child
            reach, level = reach / 2, level + 1
        parts, rest = [], np.concatenate(([centre], members[members != centre]))
        while len(rest):
            picks, owner = self._net(rest, reach)
            order = np.argsort(owner, kind="stable")
            bounds = np.searchsorted(owner[order], np.arange(len(picks) + 1))
            parts += [(int(p), rest[order[lo:hi]]) for p, lo, hi in zip(picks, bounds[:-1], bounds[1:], strict=True)]
            rest = rest[owner == len(picks)]
        self.children[node] = [self._add(part, pick, level + 1) for pick, part in parts]
        return node

    def _net(self, rest: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """Some of the next points of the net, more than `reach` apart, and for each point of
        `rest` the first that covers it, or their number."""
        some = rest[: max(1, min(256, (1 << 21) // len(rest)))]
        close = distances(self.points[some], self.points[some]) <= reach
        chosen: list[int] = []
        for i in range(len(some)):
            if not close[i, chosen].any():
                chosen.append(i)
        covers = distances(self.points[rest], self.points[some[chosen]]) <= reach
        return some[chosen], np.where(covers.any(axis=1), covers.argmax(axis=1), len(chosen))


def distances(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Distances between points of length 1."""
    return np.sqrt(np.clip(2 - 2 * (points @ others.T), 0, None))


def close_pairs(first: CoverTree, second: CoverTree, limit: float, block: int = 1 << 20):
    """Index pairs (i in first, j in second) at most `limit` apart, in arrays.

    Pairs of nodes whose centres are further apart than both covering radii and the limit are
    pruned. Of the others the larger node is opened; leaves are compared point by point.
    """
    if not first.members or not second.members:
        return
    centres1, centres2 = first.points[first.centre], second.points[second.centre]
    radius1, radius2 = np.array(first.radius), np.array(second.radius)
    inner2 = np.array([bool(c) for c in second.children])

    def near(nodes: np.ndarray, others: np.ndarray) -> np.ndarray:
        return distances(centres1[nodes], centres2[others]) <= radius1[nodes][:, None] + radius2[others] + limit + SLACK

    todo = [(0, np.array([0]))]
    while todo:
        node, others = todo.pop()
        others = others[near(np.array([node]), others)[0]]
        leaf = not first.children[node]
        open_ = inner2[others] & (leaf | (radius2[others] >= radius1[node]))
        while open_.any():
            below = np.array([c for o in others[open_] for c in second.children[o]])
            others = np.concatenate((others[~open_], below[near(np.array([node]), below)[0]]))
            open_ = inner2[others] & (leaf | (radius2[others] >= radius1[node]))
        if not len(others):
            continue
        if leaf:
            own, theirs = first.members[node], np.concatenate([second.members[o] for o in others])
            step = max(1, block // len(own))
            for at in range(0, len(theirs), step):
                part = theirs[at : at + step]
                i, j = np.nonzero(distances(first.points[own], second.points[part]) <= limit + SLACK)
                yield own[i], part[j]
        else:
            children = np.array(first.children[node])
            step = max(1, block // len(others))
            for at in range(0, len(children), step):
                for child, row in zip(children[at : at + step], near(children[at : at + step], others), strict=True):
                    if row.any():
                        todo.append((int(child), others[row]))


def unit_vector(values) -> np.ndarray | None:
    """The vector at length 1 in double precision; None for vectors that link with nothing."""
    if values is None or len(values) == 0:
        return None
    out = np.asarray(values, float)
    scale = np.abs(out).max() if np.isfinite(out).all() else 0.0
    return out / scale / np.linalg.norm(out / scale) if scale else None


def _normalise(frames):
    for frame in frames:
        units = [None if pd.isna(label) else unit_vector(e) for e, label in zip(frame.embedding, frame.label, strict=True)]
        yield pd.DataFrame({
            "vec_id": frame.vec_id, "label": frame.label.astype("Int64"), "size": [0 if u is None else len(u) for u in units], "unit": units,
        })


def _grouped(frame, pivots):
    """Per label and length: its rows, their vectors, and the distances to the pivots."""
    for key, own in frame.groupby(["label", "size"]):
        units = np.stack(own.unit.to_list())
        centres = pivots.get((int(key[0]), int(key[1])), units[:1])
        yield key, own, units, distances(units, centres)


def _near(pivots):
    def run(frames):
        for frame in frames:
            out = [pd.DataFrame({"label": [], "size": [], "cell": [], "gap": []})]
            for key, _, _, gap in _grouped(frame, pivots):
                cell = gap.argmin(axis=1)
                out.append(pd.DataFrame({"label": key[0], "size": key[1], "cell": cell, "gap": gap[np.arange(len(gap)), cell]}))
            yield pd.concat(out)

    return run


def _deal(pivots, radius, limit: float):
    """A vector goes to its own cell, and to the task of each pair of its cell with another in
    which it can have a partner: the other cell's ball comes near enough, and a partner is
    nearer to its own pivot than to this one's."""

    def run(frames):
        for frame in frames:
            out = [pd.DataFrame({"label": [], "size": [], "low": [], "high": [], "cell": [], "vec_id": [], "unit": []})]
            for key, own, _, gap in _grouped(frame, pivots):
                cell = gap.argmin(axis=1)
                reach = radius.get((int(key[0]), int(key[1])))
                if reach is None:
                    meets = np.ones((len(own), 1), bool)
                else:
                    meets = (gap <= reach + limit + SLACK) & (gap - gap.min(axis=1)[:, None] <= 2 * (limit + SLACK))
                row, other = np.nonzero(meets)
                taken = own.iloc[row]
                out.append(pd.DataFrame({
                    "label": key[0], "size": key[1], "low": np.minimum(cell[row], other), "high": np.maximum(cell[row], other),
                    "cell": cell[row], "vec_id": taken.vec_id.to_numpy(), "unit": taken.unit.to_numpy(),
                }))
            yield pd.concat(out)

    return run


def _compare(limit: float, cosine: float, leaf: int):
    """The links between two cells, or within one."""

    def run(key, frame):
        low, high = key[2], key[3]
        sides = [frame[frame.cell == low]] + ([frame[frame.cell == high]] if low != high else [])
        found = [np.zeros((0, 2), np.int64)]
        if all(len(s) for s in sides):
            trees = [CoverTree(np.stack(s.unit.to_list()), leaf) for s in sides]
            ids = [s.vec_id.to_numpy() for s in sides]
            for i, j in close_pairs(trees[0], trees[-1], limit):
                exact = np.einsum("ij,ij->i", trees[0].points[i], trees[-1].points[j]) >= cosine
                found.append(np.column_stack((ids[0][i[exact]], ids[-1][j[exact]])))
        pairs = np.concatenate(found)
        pairs = np.unique(np.sort(pairs[pairs[:, 0] != pairs[:, 1]], axis=1), axis=0)
        return pd.DataFrame({"a": pairs[:, 1], "b": pairs[:, 0]})

    return run


def link_vectors(
    vectors: DataFrame, cosine: float = 0.93, cell: int = 8192, pivots: int = 16_384, leaf: int = 32,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors of one label and one length are linked when their cosine, in double precision, is
    at least `cosine`. Null and zero vectors, and vectors with null or non-finite components,
    link with nothing, as do vectors without a label.

    1. Equal vectors become one point with a count, so a vector in a third of all rows is one.
    2. Points are dealt to the nearest of their label's pivots. About one point in `cell` is a
       pivot, and at most about `pivots` in all, drawn by a hash; the pivots and the radius of
       each cell are all that the driver sees. Labels below a cell's size are one cell.
    3. The covering radii prune pairs of cells, point by point. For each pair left, and each
       cell, a task builds cover trees and traverses two at a time.
    4. Links are weighted with the counts of equal vectors; components come from stars over
       the links.

    In many dimensions without clusters the balls overlap, nothing is pruned, and the work is
    that of all pairs of cells of a label.

    Null id: left out. Repeated rows: each counts as a vector. Ids of different vectors are
    taken to differ. No vectors: no rows.
    """
    limit = float(np.sqrt(2 - 2 * cosine))
    read = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("embedding"),
        F.col(f"`{label_col}`").cast("long").alias("label"),
    ).where("vec_id IS NOT NULL")
    made = read.mapInPandas(_normalise, UNITS)
    units = stored(made.withColumns({"m1": F.xxhash64("unit"), "m2": F.xxhash64("unit", F.lit(1))}), "units")
    valid = units.where("size > 0")
    name = ["label", "size", "m1", "m2"]
    copies = valid.groupBy(*name).agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    points = stored(
        valid.join(copies.select(*name, F.col("rep").alias("vec_id")), [*name, "vec_id"], "left_semi")
        .dropDuplicates(name).select("vec_id", "label", "size", "unit", "m1"), "points",
    )
    every = max(cell, -(-points.count() // pivots))
    large = points.groupBy("label", "size").agg(F.count("*").alias("n")).where(F.col("n") > every).select("label", "size")
    drawn = points.join(large, ["label", "size"], "left_semi").where(F.pmod("m1", F.lit(every)) == 0).select("label", "size", "unit")
    centres: dict[tuple[int, int], list] = {}
    for row in drawn.toLocalIterator():
        centres.setdefault((row["label"], row["size"]), []).append(row["unit"])
    found = {key: np.array(c) for key, c in centres.items()}

    radius = {key: np.zeros(len(c)) for key, c in found.items()}
    if found:
        reach = points.join(large, ["label", "size"], "left_semi").select("label", "size", "unit").mapInPandas(_near(found), NEAR)
        for row in reach.groupBy("label", "size", "cell").agg(F.max("gap").alias("gap")).toLocalIterator():
            if (row["label"], row["size"]) in radius:
                radius[row["label"], row["size"]][row["cell"]] = row["gap"]
    links = stored(
        points.select("vec_id", "label", "size", "unit").mapInPandas(_deal(found, radius, limit), DEALT)
        .groupBy("label", "size", "low", "high").applyInPandas(_compare(limit, cosine, leaf), LINKS).distinct(), "links",
    )

    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    partners = both.join(copies.select(F.col("rep").alias("b"), "copies"), "b").groupBy(F.col("a").alias("rep")).agg(F.sum("copies").alias("others"))
    classes = (
        copies.join(partners, "rep", "left").join(components(links).withColumnRenamed("node", "rep"), "rep", "left")
        .select(*name, (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    )
    out = units.select("vec_id", *name).join(classes, name, "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), (component == F.col("vec_id")).alias("kept"))
