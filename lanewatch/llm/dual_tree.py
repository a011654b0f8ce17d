"""Exact search for the largest inner products with dual cover trees.

Queries and candidates hang in the same tree.  Its upper levels are a cover tree of a bounded
sample: centres that are vectors, each child within half its parent's scale, siblings further
apart than that.  All rows are placed below their nearest leaf, and radii are those of the
rows placed there, so bounds hold for every row.  Leaves with few rows share a block, leaves
with many are dealt to several blocks by a hash; queries are grouped in the same way.

A first pass lets each leaf's queries meet the one block that promises most.  The worst kth
score of a leaf's queries then prunes pairs of nodes from the root down: the product of any
query and row below two nodes is at most q.x + |q| rx + |x| rq + rq rx.  Groups meet only the
blocks of pairs that are left, and inside a task both sides become cover trees again, which
are descended together with the queries' current kth scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lanewatch.llm.common import written

#: Most vectors that the upper tree is made of, and most of its leaves.
SAMPLE = 4096
LEAVES = 256
#: Rows of a block, queries of a group.
BLOCK = 8192
GROUP = 1024
#: Vectors of a leaf of the trees inside a task.
SMALL = 128
#: Members tried before a node is divided.
_TRIAL = 512
#: Integer components are below this, so that products of 2,048 of them fit 64 bits.
LARGEST = 1 << 26

FOUND = "query_id long, vec_id long, score long"


@dataclass
class Node:
    """A centre, the farthest distance below it, and what is below."""

    centre: np.ndarray
    members: np.ndarray
    radius: float
    children: list["Node"] = field(default_factory=list)
    number: int = -1  # of a leaf

    def leaves(self) -> list["Node"]:
        return [leaf for c in self.children for leaf in c.leaves()] if self.children else [self]


def _net(points: np.ndarray, members: np.ndarray, scale: float, most: int):
    """Centres more than ``scale`` apart that cover all members, and each member's nearest.

    None if there would be more than ``most``, or if three quarters of a part of the members
    already lie apart from each other.
    """
    if len(members) > 2 * _TRIAL:
        trial = members[::len(members) // _TRIAL][:_TRIAL]
        if _net(points, trial, scale, 3 * _TRIAL // 4) is None:
            return None
    centres = [0]
    nearest = np.linalg.norm(points[members] - points[members[0]], axis=1)
    owner = np.zeros(len(members), np.int64)
    while True:
        far = int(np.argmax(nearest))
        if nearest[far] <= scale:
            return owner, np.array(centres)
        if len(centres) == most:
            return None
        away = np.linalg.norm(points[members] - points[members[far]], axis=1)
        closer = away < nearest
        owner[closer], nearest = len(centres), np.minimum(nearest, away)
        centres.append(far)


def cover_tree(points: np.ndarray, small: int, most: int | None = None) -> Node:
    """A cover tree of the points; nodes of at most ``small`` are not divided.

    A child's scale is half its parent's radius.
    Neither is a node divided whose net would hold more than 64 and a quarter of its points, as
    where all are equally far apart, nor if the tree then had more than ``most`` leaves.
    """
    everything = np.arange(len(points))
    root = Node(points[0], everything, 0.0)
    root.radius = float(np.linalg.norm(points - points[0], axis=1).max())
    waiting, leaves = [root], 1
    while waiting:
        waiting.sort(key=lambda n: n.radius)
        node = waiting.pop()
        if len(node.members) <= small or node.radius == 0:
            continue
        allowed = max(64, len(node.members) // 4)
        if most is not None:
            allowed = min(allowed, most - leaves + 1)
        if allowed < 2:
            continue
        # The first member is the node's own centre.
        found = _net(points, node.members, node.radius / 2, allowed)
        if found is None:
            continue
        owner, centres = found
        for k, centre in enumerate(centres):
            below = node.members[owner == k]
            own = node.members[centre]
            below = np.concatenate([[own], below[below != own]])
            radius = float(np.linalg.norm(points[below] - points[own], axis=1).max())
            node.children.append(Node(points[own], below, radius))
        waiting += node.children
        leaves += len(centres) - 1
    return root


def bound(a: Node, b: Node) -> float:
    """No product of a vector below ``a`` and one below ``b`` is larger."""
    across = float(a.centre @ b.centre)
    wide, broad = np.sqrt(a.centre @ a.centre), np.sqrt(b.centre @ b.centre)
    top = across + wide * b.radius + broad * a.radius + a.radius * b.radius
    return float(top + 1e-9 * (abs(across) + wide * b.radius + broad * a.radius
                               + a.radius * b.radius + 1))


class Search:
    """Both trees of a task, descended together."""

    def __init__(self, rows, row_ids, queries, query_ids, floors, k: int):
        order = np.argsort(row_ids, kind="stable")
        self.x, self.x_ids = rows[order], row_ids[order]
        self.q, self.q_ids = queries, query_ids
        self.floors = np.array(floors, np.float64)
        self.k = k
        largest = max(1, int(np.abs(rows).max())) * max(1, int(np.abs(queries).max()))
        #: Products are exact in doubles, or else are made of integers.
        self.small = largest * rows.shape[1] < 1 << 53
        if not self.small:  # scores are compared as doubles
            self.floors = np.nextafter(self.floors, -np.inf)
        self.best: list[tuple[np.ndarray, np.ndarray]] = [
            (np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in query_ids]
        self.scored = 0

    def products(self, asked: np.ndarray, rows: np.ndarray) -> np.ndarray:
        if self.small:
            return (self.qf[asked] @ self.xf[rows].T).astype(np.int64)
        return self.q[asked] @ self.x[rows].T

    def meet(self, asked: np.ndarray, rows: np.ndarray) -> None:
        """All products of two leaves; each query keeps its k best so far."""
        scores = self.products(asked, rows)
        self.scored += scores.size
        good = scores >= self.floors[asked][:, None]
        good &= self.q_ids[asked][:, None] != self.x_ids[rows][None]
        for at in np.flatnonzero(good.any(axis=1)).tolist():
            query, places = asked[at], np.flatnonzero(good[at])
            found = scores[at, places]
            if len(places) > self.k:  # of equal ones the smaller id, which stands first
                least = np.partition(found, len(found) - self.k)[len(found) - self.k]
                above, level = found > least, np.flatnonzero(found == least)
                above[level[:self.k - int(above.sum())]] = True
                places, found = places[above], found[above]
            held, ids = self.best[query]
            found = np.concatenate([held, found])
            ids = np.concatenate([ids, self.x_ids[rows[places]]])
            order = np.lexsort((ids, -found))[:self.k]
            self.best[query] = found[order], ids[order]
            if len(order) == self.k:
                kth = float(found[order[-1]])
                self.floors[query] = max(
                    self.floors[query], kth if self.small else np.nextafter(kth, -np.inf))

    def descend(self, asked: Node, rows: Node) -> None:
        if bound(asked, rows) < self.floors[asked.members].min():
            return
        if not asked.children and not rows.children:
            members = np.sort(rows.members)
            for low in range(0, len(members), 4096):
                for first in range(0, len(asked.members), 256):
                    self.meet(asked.members[first:first + 256], members[low:low + 4096])
            return
        if not rows.children or (asked.children and asked.radius > rows.radius):
            pairs = [(child, rows) for child in asked.children]
        else:
            pairs = [(asked, child) for child in rows.children]
        for a, b in sorted(pairs, key=lambda pair: -bound(*pair)):
            self.descend(a, b)

    def run(self, small: int) -> pd.DataFrame:
        self.xf, self.qf = self.x.astype(np.float64), self.q.astype(np.float64)
        self.descend(cover_tree(self.qf, small), cover_tree(self.xf, small))
        sizes = [len(scores) for scores, _ in self.best]
        return pd.DataFrame({
            "query_id": np.repeat(self.q_ids, sizes),
            "vec_id": np.concatenate([ids for _, ids in self.best]),
            "score": np.concatenate([scores for scores, _ in self.best])})


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, factor: int) -> DataFrame:
    """``(id, vec)``: floor(factor * x) of vectors that are not null and finite.

    A vector with a component of ``LARGEST`` or more, or of a length other than the commonest,
    takes no part.  Of rows that repeat an id the smallest vector counts.
    """
    vec = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * F.lit(float(factor))))
    fine: Column = F.forall(F.col(vector_col), lambda x: x.isNotNull() & (
        F.abs(x.cast("double") * F.lit(float(factor))) < F.lit(float(LARGEST - 1))))
    kept = (
        rows.where(F.coalesce(fine, F.lit(False)) & (F.size(F.col(vector_col)) > 0))
        .select(F.col(id_col).cast("long").alias("id"), vec.cast("array<int>").alias("vec"))
        .where("id is not null"))
    kept = kept.groupBy("id").agg(F.min("vec").alias("vec"))
    return written(kept, "integer-vectors")


def _matrix(values) -> np.ndarray:
    return np.stack([np.asarray(v) for v in values]).astype(np.int64)


def _placer(centres: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column("vec").flatten().to_numpy(zero_copy_only=False)
            vectors = flat.reshape(batch.num_rows, -1).astype(np.float64)
            near = (centres**2).sum(1)[None] - 2 * vectors @ centres.T
            leaf = near.argmin(axis=1)
            away = np.linalg.norm(vectors - centres[leaf], axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("vec"), batch.column("asked"),
                 pa.array(leaf.astype(np.int32)), pa.array(away)],
                ["id", "vec", "asked", "leaf", "away"])
    return run


def _searcher(k: int, small: int):
    def run(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or asked.empty:
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "vec_id", "score")})
        return Search(
            _matrix(rows["vec"]), rows["id"].to_numpy(), _matrix(asked["query_vec"]),
            asked["query"].to_numpy(), asked["floor"].to_numpy(), k).run(small)
    return run


def dealt(counts: dict[int, int], order: list[int], size: int) -> dict[int, tuple[int, int]]:
    """Per leaf its first block and number of blocks; small leaves in a row share one."""
    out, block, filled = {}, 0, 0
    for leaf in order:
        n = counts.get(leaf, 0)
        if not n:
            continue
        if n > size:
            block += 1 if filled else 0
            parts = -(-n // size)
            out[leaf], block, filled = (block, parts), block + parts, 0
            continue
        if filled + n > size:
            block, filled = block + 1, 0
        out[leaf] = (block, 1)
        filled += n
    return out


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _kept_pairs(root: Node, rows: dict[int, float], asked: dict[int, float],
                worst: dict[int, float]) -> list[tuple[int, int]]:
    """Pairs of leaves (queries, rows) that may hold a better product, from the root down."""
    def copied(node: Node, radii: dict[int, float], floors: dict[int, float] | None) -> Node | None:
        children = [c for c in (copied(c, radii, floors) for c in node.children) if c]
        if not children and node.number not in radii:
            return None
        out = Node(node.centre, node.members, radii.get(node.number, 0.0), children, node.number)
        if children:  # by the triangle inequality
            out.radius = max(
                float(np.linalg.norm(c.centre - node.centre)) + c.radius for c in children)
        if floors is not None:
            out.floor = (min(c.floor for c in children) if children
                         else floors.get(node.number, -np.inf))
        return out

    kept, waiting = [], [(copied(root, asked, worst), copied(root, rows, None))]
    while waiting:
        a, b = waiting.pop()
        if bound(a, b) < a.floor:
            continue
        if not a.children and not b.children:
            kept.append((a.number, b.number))
        elif not b.children or (a.children and a.radius > b.radius):
            waiting += [(child, b) for child in a.children]
        else:
            waiting += [(a, child) for child in b.children]
    return kept


def _met(rows: DataFrame, asked: DataFrame, units: DataFrame, k: int, small: int) -> DataFrame:
    """What the groups find in the blocks that ``units`` pairs them with."""
    there = rows.join(units, "block").select("id", "vec", "block", "crowd")
    here = asked.join(units.select(
        F.col("crowd").alias("own_crowd"), F.col("block").alias("own_block")), "own_crowd")
    here = here.select("query", "query_vec", "floor", "own_crowd", "own_block")
    return there.groupBy("block", "crowd").cogroup(
        here.groupBy("own_block", "own_crowd")).applyInPandas(_searcher(k, small), FOUND)


def largest_products(rows: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id",
                     vector_col: str = "embedding", factor: int = 256, sample: int = SAMPLE,
                     leaves: int = LEAVES, block: int = BLOCK, group: int = GROUP,
                     small: int = SMALL, seed: int = 5) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query row's k largest inner products, exactly.

    Vectors are floor(``factor`` * x) by component, scores integers; ties go to the smaller id.
    ``queries`` is a condition on ``id``.  Candidates are all rows of other ids; a query has
    fewer than k where there are fewer.  Vectors that are null, empty or hold null or
    non-finite components take no part, nor do those of a length other than the commonest, of
    components beyond ``LARGEST``, or without an id; of rows that repeat an id the smallest
    vector counts.  A table without queries gives no rows.  Only the two named columns are
    read.  The upper tree is made of at most ``sample`` vectors and has at most ``leaves``
    leaves; every row is searched.
    """
    spark = rows.sparkSession
    usable = integer_vectors(rows, id_col, vector_col, factor)
    usual = usable.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    schema = "query_id long, rank int, vec_id long, score long"
    if usual is None:
        return spark.createDataFrame([], schema)
    usable = usable.where(F.size("vec") == usual["d"])
    drawn = usable.orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(sample).select("vec")
    points = np.array([r["vec"] for r in drawn.collect()], np.float64)
    root = cover_tree(points, max(1, len(points) // leaves), leaves)
    ends = root.leaves()
    for number, leaf in enumerate(ends):
        leaf.number = number
    placed = written(usable.withColumn("asked", F.coalesce(queries, F.lit(False))).mapInArrow(
        _placer(np.stack([leaf.centre for leaf in ends])),
        "id long, vec array<int>, asked boolean, leaf int, away double"), "placed-vectors")
    stats = placed.groupBy("leaf").agg(
        F.count("*").alias("rows"), F.max("away").alias("radius"),
        F.count_if("asked").alias("asked"),
        F.max(F.when(F.col("asked"), F.col("away"))).alias("asked_radius")).collect()
    order = list(range(len(ends)))
    blocks = dealt({s["leaf"]: s["rows"] for s in stats}, order, block)
    crowds = dealt({s["leaf"]: s["asked"] for s in stats}, order, group)
    if not crowds:
        return spark.createDataFrame([], schema)

    def numbered(plan: dict[int, tuple[int, int]], name: str) -> Column:
        """A row's block, from its leaf's first one and the row's hash."""
        first = F.create_map(*[F.lit(x) for leaf, (at, _) in plan.items() for x in (leaf, at)])
        parts = F.create_map(*[F.lit(x) for leaf, (_, n) in plan.items() for x in (leaf, n)])
        return (first[F.col("leaf")] + F.pmod(F.xxhash64("id"), parts[F.col("leaf")])).cast(
            "int").alias(name)

    candidates = placed.select("id", "vec", "leaf", numbered(blocks, "block"))
    asked = placed.where("asked").select(
        F.col("id").alias("query"), F.col("vec").alias("query_vec"),
        F.col("leaf").alias("query_leaf"), numbered(crowds, "own_crowd"))

    def spans(plan: dict[int, tuple[int, int]], leaf: int) -> range:
        at, parts = plan[leaf]
        return range(at, at + parts)

    # First pass: every group meets the block that promises most to one of its leaves.
    promising = {}
    for a in crowds:
        best = max(blocks, key=lambda b: float(ends[a].centre @ ends[b].centre))
        promising[a] = best
    pairs = sorted({(c, blocks[b][0]) for a, b in promising.items() for c in spans(crowds, a)})
    units = spark.createDataFrame(pairs, "crowd int, block int")
    unknown = asked.withColumn("floor", F.lit(float("-inf")))
    first = written(_best(_met(candidates, unknown, units, k, small), k), "first-products")
    floors = first.groupBy("query_id").agg(
        F.when(F.count("*") >= k, F.min("score")).cast("double").alias("kth"))
    asked = written(asked.join(floors, asked["query"] == floors["query_id"], "left").select(
        "query", "query_vec", "query_leaf", "own_crowd",
        F.coalesce("kth", F.lit(float("-inf"))).alias("floor")), "asked-vectors")
    worst = {r["query_leaf"]: r["floor"]
             for r in asked.groupBy("query_leaf").agg(F.min("floor").alias("floor")).collect()}

    # Pairs of leaves that are left, and from them pairs of groups and blocks.
    kept = _kept_pairs(
        root, {s["leaf"]: s["radius"] for s in stats},
        {s["leaf"]: s["asked_radius"] for s in stats if s["asked"]}, worst)
    spread = spark.createDataFrame(
        [(*crowds[a], *blocks[b]) for a, b in kept],
        "c int, c_parts int, b int, b_parts int")
    units = (
        spread.select(F.explode(F.expr("sequence(c, c + c_parts - 1)")).alias("crowd"), "b", "b_parts")
        .select("crowd", F.explode(F.expr("sequence(b, b + b_parts - 1)")).alias("block"))
        .distinct().join(spark.createDataFrame(pairs, "crowd int, block int"),
                         ["crowd", "block"], "left_anti"))
    units = written(units, "product-units")
    found = _met(candidates, asked, units, k, small)
    return _best(found.unionByName(first.select("query_id", "vec_id", "score")), k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
