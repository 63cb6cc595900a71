"""Nearest neighbours by inner product over an inverted multi-index.

Vectors are cut into halves, and each half is quantised with its own centroids, fitted on a bounded
sample; a pair of centroids is a cell. A query goes through the cells by descending sum of its inner
products with the two centroids, from a heap, until the cells seen hold the wanted share of all rows;
the last sum is its threshold. Rows are laid out in blocks by their first centroid (large ones split),
a query visits the blocks with a cell above its threshold, and the rows of those cells are reranked
by the exact inner product in double precision.

Of equal vectors only the ``top`` + 1 with the smallest ids can ever be reported, so the others stay
out of the blocks; they are queries all the same.

Defined cases: vectors that are null, zero, of another length than most, or hold a null or non-finite
component take no part. A query is never its own neighbour; rows that repeat an id are one candidate, with the
smallest of their vectors.
Fewer candidates than ``top`` give fewer rows. Ties go to the smaller id. Further columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mirepoix.llm.common import stored

TOP = 20
SAMPLE_ROWS = 20_000
# Rows a query examines, as a share of all. Vectors without clusters need a large share.
PROBE_SHARE = 0.6
# Centroids of a half: so many times the cube root of the number of rows, up to the most.
CENTROIDS, MAX_CENTROIDS = 3, 256
BLOCK_ROWS = 8_192
QUERY_ROWS = 2_048
RERANK_ROWS = 1_024


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): the vectors that take part, as doubles."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select("vec_id", v.alias("v")).filter("vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0").filter(fine)
    rows = rows.filter(F.exists("v", lambda x: x != 0))
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.filter(F.size("v") == (common["d"] if common else 0))


def centroids(points: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """k-means from evenly spaced rows; an emptied centroid stays where it was."""
    found = points[np.linspace(0, len(points) - 1, min(k, len(points))).astype(int)].copy()
    for _ in range(rounds):
        near = nearest(points, found)
        counts = np.bincount(near, minlength=len(found))
        sums = np.zeros_like(found)
        np.add.at(sums, near, points)
        found[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return found


def nearest(points: np.ndarray, found: np.ndarray) -> np.ndarray:
    return ((found * found).sum(1)[None] - 2 * points @ found.T).argmin(1)


def threshold(first: np.ndarray, second: np.ndarray, counts: np.ndarray, wanted: float) -> float:
    """The sum at which cells, taken by descending ``first[i] + second[j]``, hold ``wanted`` rows."""
    order = np.argsort(-second, kind="stable")
    sums, held = second[order].tolist(), counts[:, order].tolist()
    first = first.tolist()
    heap = [(-(f + sums[0]), i, 0) for i, f in enumerate(first)]
    heapq.heapify(heap)
    seen, last = 0, -np.inf
    while heap and seen < wanted:
        least, i, j = heap[0]
        last = -least
        seen += held[i][j]
        if j + 1 < len(sums):
            heapq.heapreplace(heap, (-(first[i] + sums[j + 1]), i, j + 1))
        else:
            heapq.heappop(heap)
    return last


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _best(x: np.ndarray, ids: np.ndarray, cells: np.ndarray, q: np.ndarray, q_ids: np.ndarray, limits: np.ndarray,
          one: np.ndarray, two: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of each query's best rows among those whose cells it visits."""
    half = one.shape[1]
    s1, s2 = q[:, :half] @ one.T, q[:, half:] @ two.T
    scores = np.full((len(q), len(x)), -np.inf)
    order = np.argsort(cells, kind="stable")
    cuts = np.flatnonzero(np.append(True, np.diff(cells[order] // len(two)) != 0))
    for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
        i = int(cells[order[a]]) // len(two)
        # the cells of one first centroid together, so many rows at a time
        for c in range(a, b, RERANK_ROWS):
            rows = order[c:min(b, c + RERANK_ROWS)]
            visit = s1[:, i, None] + s2[:, cells[rows] % len(two)] >= limits[:, None]
            some = np.flatnonzero(visit.any(1))
            scores[np.ix_(some, rows)] = np.where(visit[some], q[some] @ x[rows].T, -np.inf)
    scores[q_ids[:, None] == ids[None]] = -np.inf
    k = min(top, len(x))
    floor = np.partition(scores, len(x) - k, axis=1)[:, len(x) - k]
    a, b = np.nonzero((scores >= floor[:, None] - 1e-9) & np.isfinite(scores))
    # the exact sums, the same for equal vectors
    exact = (q[a] * x[b]).sum(1)
    keep = np.lexsort((ids[b], -exact, a))
    a, b, exact = a[keep], b[keep], exact[keep]
    place = np.arange(len(a)) - np.searchsorted(a, a)
    return a[place < top], b[place < top], exact[place < top]


def search(vectors: DataFrame, queries: DataFrame, top: int = TOP, share: float = PROBE_SHARE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``top`` nearest vectors found for each of ``queries``."""
    spark = vectors.sparkSession
    rows = usable(vectors).groupBy("vec_id").agg(F.min("v").alias("v"))
    alike = Window.partitionBy(F.xxhash64("v"), F.xxhash64(F.lit(7), "v")).orderBy("vec_id")
    rows = stored(rows.withColumn("copy", F.row_number().over(alike)).filter(F.col("copy") <= top + 1).drop("copy"), "vectors")
    asked = stored(usable(queries).groupBy("vec_id").agg(F.min("v").alias("v")), "asked")
    total, n_asked = rows.count(), asked.count()
    shape = "query_id bigint, rank int, vec_id bigint, score double"
    if not total or not n_asked:
        return spark.createDataFrame([], shape)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).toArrow()
    points = _matrix(sample.column("v").combine_chunks())
    half = points.shape[1] // 2
    k = max(1, min(MAX_CENTROIDS, len(points), int(CENTROIDS * total ** (1 / 3))))
    one, two = centroids(points[:, :half], k), centroids(points[:, half:], k)
    books = spark.sparkContext.broadcast((one, two))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = books.value
        for batch in batches:
            x = _matrix(batch.column("v"))
            cells = nearest(x[:, :half], one) * len(two) + nearest(x[:, half:], two) if len(x) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells.astype(np.int32))], ["vec_id", "v", "cell"])

    entries = stored(rows.mapInArrow(assign, "vec_id bigint, v array<double>, cell int"), "entries")
    counts = np.zeros((len(one), len(two)), np.int64)
    for r in entries.groupBy("cell").count().collect():  # at most MAX_CENTROIDS squared rows
        counts[divmod(r["cell"], len(two))] = r["count"]
    # blocks: consecutive first centroids of about ``size`` rows together, a larger one split
    size = max(256, min(BLOCK_ROWS, total // 32))
    start, parts, at, filled = [], [], 0, 0
    for n in counts.sum(1).tolist():
        if filled and filled + n > size:
            at, filled = at + 1, 0
        start.append(at)
        parts.append(max(1, -(-n // size)))
        filled += n
        if parts[-1] > 1:
            at, filled = at + parts[-1], 0
    turns = -(-n_asked // QUERY_ROWS)
    blocks = spark.sparkContext.broadcast((np.array(start), np.array(parts), counts))
    first = F.floor(F.col("cell") / len(two)).cast("int")
    block = F.get(F.array(*map(F.lit, start)), first) + F.pmod(F.xxhash64("vec_id"), F.get(F.array(*map(F.lit, parts)), first)).cast("int")
    entries = entries.withColumn("block", block).withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))))
    wanted = max(share * total, top + 1)  # no fewer than the report holds, and the query itself

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (one, two), (start, parts, counts) = books.value, blocks.value
        for batch in batches:
            q = _matrix(batch.column("v")) if len(batch) else np.zeros((0, 2 * half))
            at, block, limits = [], [], []
            for n, (s1, s2) in enumerate(zip(q[:, :half] @ one.T, q[:, half:] @ two.T, strict=True)):
                limit = threshold(s1, s2, counts, wanted) - 1e-9
                i = np.flatnonzero((s1 + s2.max() >= limit) & (counts.sum(1) > 0))
                to = np.unique(np.concatenate([np.arange(start[c], start[c] + parts[c]) for c in i]))
                at += [n] * len(to)
                block += to.tolist()
                limits += [limit] * len(to)
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(at), batch.column("v").take(at), pa.array(block, pa.int32()), pa.array(limits, pa.float64())],
                ["query_id", "q", "block", "limit"])

    # the heaps are most of a query's work before the rerank: spread them, the file of queries is small
    asked = asked.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "vec_id")
    routed = asked.mapInArrow(route, "query_id bigint, q array<double>, block int, limit double")
    routed = routed.withColumn("turn", F.pmod(F.xxhash64("query_id"), F.lit(turns)).cast("int"))

    def rerank(found: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if found.empty or asked.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        one, two = books.value
        x, ids = np.stack(found["v"].to_numpy()), found["vec_id"].to_numpy()
        q, q_ids = np.stack(asked["q"].to_numpy()), asked["query_id"].to_numpy()
        a, b, s = _best(x, ids, found["cell"].to_numpy(), q, q_ids, asked["limit"].to_numpy(), one, two, top)
        return pd.DataFrame({"query_id": q_ids[a], "vec_id": ids[b], "score": s})

    pairs = entries.groupBy("block", "turn").cogroup(routed.groupBy("block", "turn")).applyInPandas(rerank, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")
