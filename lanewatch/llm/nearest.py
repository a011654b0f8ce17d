"""Approximate nearest neighbours: multiprobe p-stable hashing with exact reranking.

A table cuts ``hashes`` Gaussian projections into slots of one width; a vector's slots
name its bucket.  How far a near neighbour's projections lie from the query's is fitted
on a bounded sample.  From this, each perturbed bucket has a probability of holding a
neighbour; a query visits buckets in the order of these probabilities until their sum
reaches the table's target.  Candidates of all tables are ranked by exact distance.

Buckets are dealt to tasks in chunks of rows and of queries, so a crowded bucket is
shared by many tasks.  A query that finds fewer rows than asked looks at every bucket.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lanewatch.llm.common import written
from lanewatch.llm.words import mixed

#: Most vectors that the index is fitted on.
SAMPLE = 4096
CHUNK = 512
#: Fewer hashes are used where queries would visit more buckets than this on average.
VISITED = 1024


@dataclass
class Index:
    """Projections of all tables, slot width, and the fitted spread of near neighbours."""

    directions: np.ndarray  # tables x hashes x dimensions
    shifts: np.ndarray  # tables x hashes
    width: float
    slope: float
    spread: float
    lowest: np.ndarray
    highest: np.ndarray
    target: float

    def projected(self, table: int, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.directions[table].T

    def slots(self, table: int, vectors: np.ndarray) -> np.ndarray:
        places = (self.projected(table, vectors) + self.shifts[table]) / self.width
        # The outermost slots are open, so far-off vectors have a bucket that is visited.
        return np.clip(np.floor(places).astype(np.int64), self.lowest[table], self.highest[table])

    def keys(self, table: int, slots: np.ndarray) -> np.ndarray:
        key = np.full(len(slots), table + 1, np.uint64)
        for k in range(slots.shape[1]):
            key = mixed(key * np.uint64(31) + (slots[:, k] + (1 << 20)).astype(np.uint64))
        return key.view(np.int64)

    def probes(self, table: int, vector: np.ndarray, most: float = math.inf) -> np.ndarray:
        """Slots of the buckets that a query visits, likeliest first; the first ``most``."""
        centre = self.projected(table, vector[None])[0]
        choices = []
        for k, place in enumerate(centre):
            slots = np.arange(self.lowest[table][k], self.highest[table][k] + 1)
            edges = slots * self.width - self.shifts[table][k]
            low, high = edges.copy(), edges + self.width
            low[0], high[-1] = -np.inf, np.inf
            middle = self.slope * place
            chance = _normal((high - middle) / self.spread) - _normal((low - middle) / self.spread)
            order = np.argsort(-chance, kind="stable")
            choices.append((slots[order], np.maximum(chance[order], 1e-300)))
        first = (0,) * len(choices)

        def cost(at: tuple[int, ...]) -> float:
            return -sum(math.log(c[1][i]) for c, i in zip(choices, at))

        waiting, seen, visited, mass = [(cost(first), first)], {first}, [], 0.0
        while waiting and mass < self.target and len(visited) < most:
            spent, at = heapq.heappop(waiting)
            visited.append([c[0][i] for c, i in zip(choices, at)])
            mass += math.exp(-spent)
            for k in range(len(at)):
                step = at[:k] + (at[k] + 1,) + at[k + 1:]
                if step[k] < len(choices[k][0]) and step not in seen:
                    seen.add(step)
                    heapq.heappush(waiting, (cost(step), step))
        return np.array(visited, np.int64)


def _normal(x: np.ndarray) -> np.ndarray:
    return np.array([0.5 * math.erfc(-v / math.sqrt(2)) for v in x])


def distances(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Squared distances by products: to preselect, not to rank."""
    return np.maximum((queries**2).sum(1)[:, None] + (rows**2).sum(1)[None]
                      - 2 * queries @ rows.T, 0)


def fit_index(sample: np.ndarray, rows: int, k: int, tables: int, recall: float,
              bucket_rows: int, seed: int) -> Index:
    """Fit slot width, number of hashes and neighbour spread on a sample of vectors.

    Neighbours within a sample lie further off than among all rows, so the fitted spread
    errs towards visiting more.  Where near neighbours are hardly nearer than the rest,
    many buckets must be visited; then there are fewer hashes and larger buckets.
    """
    asked = np.arange(min(len(sample), 512))
    near = distances(sample[asked], sample)
    near[asked, asked] = np.inf
    count = min(k, len(sample) - 1)
    found = np.argpartition(near, count - 1, axis=1)[:, :count].ravel()
    # A projection cut at about its standard deviation tells about two bits.
    hashes = max(1, min(12, round(math.log2(max(2, rows / bucket_rows)) / 2)))
    while True:
        random = np.random.default_rng(seed)
        directions = random.standard_normal((tables, hashes, sample.shape[1]))
        values = np.stack([sample @ d.T for d in directions])
        width = 1.35 * float(values.std()) or 1.0
        shifts = random.uniform(0, width, (tables, hashes))
        slots = np.floor((values + shifts[:, None]) / width).astype(np.int64)
        own = np.repeat(values[:, asked], count, axis=1).ravel()
        their = values[:, found].ravel()
        slope = float(np.clip(own @ their / max(own @ own, 1e-300), 0, 1))
        spread = float(np.sqrt(np.mean((their - slope * own) ** 2)))
        index = Index(
            directions, shifts, width, slope, max(spread, 1e-6 * width), slots.min(axis=1),
            slots.max(axis=1), 1 - (1 - recall) ** (1 / tables))
        visited = np.mean([
            len(index.probes(0, vector, 4 * VISITED)) for vector in sample[asked[:24]]])
        if hashes == 1 or visited <= VISITED:
            return index
        hashes -= 1


def usable_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, vec)`` of vectors that are not null, not zero, finite, and of the usual length."""
    vec = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    finite: Column = F.forall(
        "vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = (
        rows.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec"))
        .where("id is not null and vec is not null").where(F.size("vec") > 0)
        .where(F.coalesce(finite, F.lit(False)))
        .where(F.exists("vec", lambda x: x != 0)))
    usual = kept.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return kept.where(F.size("vec") == (usual["d"] if usual else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _hasher(index: Index, probing: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column("vec"))
            for table in range(len(index.directions)):
                if probing:
                    slots = [index.probes(table, v) for v in vectors]
                    owner = np.repeat(np.arange(len(slots)), [len(s) for s in slots])
                    keys = index.keys(table, np.concatenate(slots))
                else:
                    owner = np.arange(len(vectors))
                    keys = index.keys(table, index.slots(table, vectors))
                for low in range(0, len(owner), 4096):
                    part = pa.array(owner[low:low + 4096])
                    yield pa.RecordBatch.from_pydict({
                        "id": batch.column("id").take(part), "vec": batch.column("vec").take(part),
                        "key": pa.array(keys[low:low + 4096])})
    return run


def _ranker(k: int):
    empty = pd.DataFrame({"query_id": pd.Series(dtype="int64"),
                          "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})

    def run(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or asked.empty:
            return empty
        x, q = np.stack(rows["vec"].to_numpy()), np.stack(asked["vec"].to_numpy())
        ids, query_ids = rows["id"].to_numpy(), asked["id"].to_numpy()
        near = distances(q, x)
        near[query_ids[:, None] == ids[None]] = np.inf
        reach = min(k, len(ids)) - 1
        limit = np.partition(near, reach, axis=1)[:, reach]
        slack = 1e-9 * ((q**2).sum(1) + (x**2).sum(1).max())
        who, what = np.nonzero((near <= (limit + slack)[:, None]) & np.isfinite(near))
        score = np.sqrt(((q[who] - x[what]) ** 2).sum(1))
        out = pd.DataFrame({"query_id": query_ids[who], "vec_id": ids[what], "score": score})
        out = out.sort_values(["query_id", "score", "vec_id"]).drop_duplicates(
            ["query_id", "vec_id"])
        return out.groupby("query_id").head(k)
    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k nearest of each query over all its buckets and tables."""
    from pyspark.sql import Window

    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _ranked(buckets: DataFrame, probes: DataFrame, k: int) -> DataFrame:
    """Meet bucket rows and probes chunk by chunk: at most k rows per query and chunk."""
    def counted(rows: DataFrame, name: str, label: str) -> DataFrame:
        return written(rows.groupBy("key").agg(
            F.ceil(F.count("*") / F.lit(CHUNK)).cast("int").alias(name)), label)

    chunks = counted(buckets, "n", "bucket-chunks").join(counted(probes, "m", "probe-chunks"), "key")
    chunks = written(chunks, "bucket-plan")

    def dealt(rows: DataFrame, own: str, count: str, other: str, others: str) -> DataFrame:
        return rows.join(chunks, "key").select(
            "id", "vec", "key", F.pmod(F.xxhash64("id"), F.col(count)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.col(others) - 1)).alias(other))

    unit = ["key", "row_chunk", "query_chunk"]
    rows = dealt(buckets, "row_chunk", "n", "query_chunk", "m").groupBy(*unit)
    asked = dealt(probes, "query_chunk", "m", "row_chunk", "n").groupBy(*unit)
    return rows.cogroup(asked).applyInPandas(
        _ranker(k), "query_id long, vec_id long, score double")


def nearest_neighbours(rows: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id",
                       vector_col: str = "embedding", tables: int = 2, recall: float = 0.985,
                       bucket_rows: int = 2000, sample: int = SAMPLE, seed: int = 11) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest found of each query row.

    ``queries`` is a condition on ``id``.  ``recall`` is the probability, by the fitted
    estimate, that a neighbour lies in a bucket that is visited.  Scores are Euclidean
    distances in double precision on the vectors as given; ties go to the smaller id.
    Vectors that are null, zero, or hold null or non-finite numbers take no part, nor do
    rows without an id or of a length other than the commonest.  Rows that repeat an id
    count once, with their nearest vector, and none is its own neighbour.
    """
    usable = written(usable_vectors(rows, id_col, vector_col), "vectors")
    total = usable.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if total < 2:
        return rows.sparkSession.createDataFrame([], schema)
    drawn = usable.orderBy(F.xxhash64(F.lit(seed), "id"), "vec").limit(sample).select("vec")
    vectors = np.array([r["vec"] for r in drawn.collect()], float)
    index = fit_index(vectors, total, k, tables, recall, bucket_rows, seed)
    hashed = "id long, vec array<double>, key long"
    asked = usable.where(queries)
    buckets = written(usable.mapInArrow(_hasher(index, False), hashed), "buckets")
    probes = written(asked.mapInArrow(_hasher(index, True), hashed), "probes")
    found = written(_best(_ranked(buckets, probes, k), k), "neighbours")
    # Too few found: look at all rows.
    full = found.groupBy("query_id").count().where(F.col("count") >= k)
    short = written(asked.join(full, asked["id"] == full["query_id"], "left_anti"), "short-queries")
    if total > 1 and not short.isEmpty():
        # One bucket for all rows; chunks share it out.
        again = _best(_ranked(
            usable.withColumn("key", F.lit(0).cast("long")),
            short.withColumn("key", F.lit(0).cast("long")).select("id", "vec", "key"), k), k)
        found = found.join(short.select(F.col("id").alias("query_id")).distinct(), "query_id",
                           "left_anti").unionByName(again)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
