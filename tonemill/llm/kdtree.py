"""Exact top-k by inner product over KD-trees, one tree per shard of the vectors.

Components become ``floor(scale * x)``, so scores are whole numbers. A shard's tree splits at the
median of the widest dimension; every node keeps the tight box of its vectors. A query's bound
for a box is the largest inner product that any point of the box could have. Nodes are visited
best bound first until no bound reaches the k-th best score so far.

Queries and shards travel as blocks. Each block of queries first searches one shard; the k-th
scores found there go with it to all others, where most nodes are then never opened.

Defined cases: vectors that are null, or hold null, NaN or infinite components, take no part, nor
do null IDs; only vectors of equal length meet; ties go to the smaller ID; rows that share the
query's ID count as its own and are no candidates; every other row is a candidate, and every
query row asks, so repeated rows count as often as they stand; other columns are not read; an
empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tonemill.plans.materialize import materialize

LEAF = 64
SHARD_ROWS = 4096
QUERY_ROWS = 256
_EXACT = 2.0**53


def build(points: np.ndarray) -> dict[str, np.ndarray]:
    """Order of the rows, and per node its rows ``start..end``, children and box."""
    order = np.arange(len(points))
    start, end, left, low, high = [0], [len(points)], [-1], [], []
    node = 0
    while node < len(start):
        a, b = start[node], end[node]
        own = points[order[a:b]]
        low.append(own.min(axis=0))
        high.append(own.max(axis=0))
        wide = high[-1] - low[-1]
        if b - a > LEAF and wide.max() > 0:
            middle = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(own[:, wide.argmax()], middle)]
            left[node] = len(start)
            start += [a, a + middle]
            end += [a + middle, b]
            left += [-1, -1]
        node += 1
    return {"order": order, "start": np.array(start), "end": np.array(end),
            "left": np.array(left), "low": np.array(low), "high": np.array(high)}


class Shard:
    """A tree with its vectors in leaf order."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        # Exact in floating point while no sum of products can pass 2**53; whole numbers beyond.
        widest = float(np.abs(points).max(initial=0))
        self.widest = widest
        tree = build(points)
        self.ids, self.points = ids[tree["order"]], points[tree["order"]]
        self.start, self.end, self.left = (tree[c].tolist() for c in ("start", "end", "left"))
        self.low, self.high = tree["low"], tree["high"]

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int, kth: np.ndarray):
        """Per query the best ``(score, id)`` with a score of at least its ``kth``."""
        largest = float(np.abs(queries).max(initial=0)) * self.widest * queries.shape[1]
        kind = np.float64 if largest < _EXACT else object
        points, low, high, queries = (
            x.astype(kind) for x in (self.points, self.low, self.high, queries))
        up = np.where(queries > 0, queries, 0)
        bounds = up @ high.T + (queries - up) @ low.T
        out = []
        for i, query in enumerate(queries):
            floor, own, bound = kth[i], int(ids[i]), bounds[i].tolist()
            best: list[tuple[int, int]] = []
            heap = [(-bound[0], 0)]
            while heap and -heap[0][0] >= floor:
                node = heapq.heappop(heap)[1]
                if self.left[node] >= 0:
                    for child in (self.left[node], self.left[node] + 1):
                        if bound[child] >= floor:
                            heapq.heappush(heap, (-bound[child], child))
                    continue
                a, b = self.start[node], self.end[node]
                scores = points[a:b] @ query
                hit = np.flatnonzero((scores >= floor) & (self.ids[a:b] != own))
                if len(hit):
                    best += [(int(s), -int(j)) for s, j in zip(scores[hit], self.ids[a:b][hit])]
                    best = heapq.nlargest(k, best)
                    if len(best) == k:
                        floor = max(floor, best[-1][0])
            out.append([(s, -j) for s, j in best])
        return out


def whole_vectors(table: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """``id, v``: vectors of whole numbers, without those that take no part."""
    v = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale))
    sound = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                     & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return table.filter(F.col(key).isNotNull() & F.col(vector).isNotNull() & sound).select(
        F.col(key).cast("long").alias("id"), v.alias("v"))


def _counted(vectors: DataFrame, k: int) -> DataFrame:
    """``id, v`` with each repeated row ``k`` times at most: more can't stand among ``k`` best."""
    return vectors.groupBy("id", "v").agg(F.count("*").alias("n")).select(
        "id", "v", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k)).cast("int"))).alias("_copy")
    ).drop("_copy")


def _blocks(vectors: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """One row per block and vector length: ``block, dim, ids, points`` as bytes."""
    n = max(1, -(-vectors.count() // rows))

    def pack(table: pa.Table) -> pa.Table:
        points = table.column("v").combine_chunks().flatten().to_numpy()
        ids = table.column("id").combine_chunks().to_numpy()
        return pa.table({"block": table.column("block").slice(0, 1),
                         "dim": table.column("dim").slice(0, 1),
                         "ids": pa.array([ids.tobytes()], pa.binary()),
                         "points": pa.array([points.tobytes()], pa.binary())})

    grouped = vectors.select("id", "v", F.size("v").alias("dim"), F.pmod(
        F.xxhash64("id", "v"), F.lit(n)).cast("int").alias("block")).groupBy("block", "dim")
    return grouped.applyInArrow(pack, "block int, dim int, ids binary, points binary"), n


def _matrix(ids, points) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids.as_buffer(), np.int64)
    return ids, np.frombuffer(points.as_buffer(), np.int64).reshape(len(ids), -1)


def _search(pairs: DataFrame, k: int) -> DataFrame:
    """``block, dim, ids, points, kth, found`` for blocks that meet a shard each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, shard = None, None
        for batch in batches:
            for i in range(len(batch)):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                if name != (row["shard"].as_py(), row["dim"].as_py()):
                    name = (row["shard"].as_py(), row["dim"].as_py())
                    shard = Shard(*_matrix(row["s_ids"], row["s_points"]))
                ids, queries = _matrix(row["ids"], row["points"])
                kth = (np.frombuffer(row["kth"].as_buffer(), np.float64)
                       if row["kth"].is_valid else np.full(len(ids), -np.inf))
                found = shard.search(ids, queries, k, kth)
                kth = np.array([max(f, own[-1][0]) if len(own) == k else f
                                for f, own in zip(kth.tolist(), found)], np.float64)
                flat = [{"query_id": int(q), "id": j, "score": s}
                        for q, own in zip(ids, found) for s, j in own]
                yield pa.RecordBatch.from_pydict({
                    "block": [row["block"].as_py()], "dim": [row["dim"].as_py()],
                    "shard": [row["shard"].as_py()], "kth": [kth.tobytes()],
                    "found": [flat]}, pa.schema([
                        ("block", pa.int32()), ("dim", pa.int32()), ("shard", pa.int32()),
                        ("kth", pa.binary()), ("found", pa.list_(pa.struct([
                            ("query_id", pa.int64()), ("id", pa.int64()),
                            ("score", pa.int64())])))]))

    return pairs.select("block", "dim", "ids", "points", "kth", "shard", "s_ids", "s_points"
                        ).mapInArrow(run, "block int, dim int, shard int, kth binary, found "
                                          "array<struct<query_id:long,id:long,score:long>>")


def top_k(table: DataFrame, is_query: Column, k: int, key: str = "vec_id",
          vector: str = "embedding", scale: int = 256, shard_rows: int = SHARD_ROWS,
          query_rows: int = QUERY_ROWS) -> DataFrame:
    """``query_id, rank, key, score``: the ``k`` best of all other rows for each query row."""
    vectors = materialize(_counted(whole_vectors(table, key, vector, scale), k), "vectors")
    asked = materialize(_counted(whole_vectors(table.filter(is_query), key, vector, scale), k),
                        "queries")
    packed, n_shards = _blocks(vectors, shard_rows)
    shards = materialize(packed.select(F.col("block").alias("shard"), "dim",
                                       F.col("ids").alias("s_ids"),
                                       F.col("points").alias("s_points")), "shards")
    blocks = materialize(_blocks(asked, query_rows)[0], "blocks")
    # A block's first shard is one that has vectors of its length.
    homes = shards.groupBy("dim").agg(F.sort_array(F.collect_list("shard")).alias("all"))
    blocks = blocks.join(homes, "dim").withColumn(
        "home", F.get("all", F.pmod("block", F.size("all"))))
    # Shards are dealt out by number; the blocks that meet one are spread over tasks.
    met = blocks.withColumn("kth", F.lit(None).cast("binary")).withColumn("shard", F.col("home"))
    first = materialize(_search(met.join(shards, ["shard", "dim"]), k), "first")
    known = first.select("block", "dim", "kth")
    others = (
        blocks.join(known, ["block", "dim"])
        .withColumn("shard", F.explode("all")).filter(F.col("shard") != F.col("home"))
        .join(shards, ["shard", "dim"])
    )
    found = first.select("found").union(_search(others, k).select("found"))
    rows = found.select(F.explode("found").alias("f")).select("f.*")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(key), "score")
