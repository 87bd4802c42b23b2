"""Exact k-means by Shallot search, over integer vectors.

Vectors lie in blocks. Each block keeps, for every vector, its nearest and its second-nearest centroid,
an upper bound of the distance to the first and a lower bound of the distance to all others. After the
centroids have moved, the bounds move by as much; a vector whose upper bound stays below its lower
bound, or below half the distance from its centroid to the next one, keeps its centroid unseen. All
others measure both remembered centroids and start from the closer one. They look through its
neighbours in order of distance, within a ball of the distance to the start plus the distance to the
second-nearest so far, which shrinks as closer ones are found. What lies in the ball is compared by
squared distances in integers, ties going to the smaller number, so rounding decides nothing: bounds
are floating-point numbers widened by more than their error, and only spare work.

A round reads the blocks once and writes them with their new state and with the sums of their
clusters; no vector is shuffled. The driver gets count x (dims + 1) sums a round, and tasks get the
centroids, whatever the number of vectors. Each round is a stored table, so lost executors cost the
blocks they were at work on.

Only vectors of exactly `dims` components, none null or not finite, take part, nor do those with a
component so large (134,217,728 after scaling, for 64 components) that a squared distance would not
fit a long. Repeated rows are vectors each. Rows without id take part, but start no centroid. Starting
vectors of equal hash are ordered by their components. Fewer vectors than centroids make fewer
centroids; an empty table gives no rows. An inertia that does not fit a long is null. Other columns are
not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.storage import stored
from tallyline.llm.textbytes import tidy

BLOCK = 4096

#: Relative width that covers the rounding of square roots and of a few sums of them.
SLACK = 1e-9

STATE = "ids array<long>, vectors binary, near binary, second binary, upper binary, lower binary, totals array<long>"
RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def whole_vectors(table: DataFrame, vector_id: str, vector: str, dims: int, scale: int) -> DataFrame:
    """id and v (doubles) of the vectors that take part."""
    most = math.isqrt(2**62 // dims) // 2
    v = F.col(f"`{vector}`").cast("array<double>")
    good = (F.size(v) == dims) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * scale < most))
    return table.filter(good).select(F.col(f"`{vector_id}`").cast("long").alias("id"), v.alias("v"))


def started(rows: DataFrame, count: int, scale: int, seed: str) -> np.ndarray:
    """The vectors with the smallest hashes of seed and id; count of them at most."""
    hashed = rows.filter("id IS NOT NULL").withColumn("h", F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256))
    first = hashed.orderBy("h", "v").limit(count).collect()
    return np.array([np.floor(np.array(r["v"]) * scale) for r in first]).astype(np.int64)


def squared(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact squared distances, row by row or to one vector."""
    gap = points - others
    return np.einsum("ij,ij->i", gap, gap)


class Ball:
    """Centroids with their neighbours in order of distance."""

    def __init__(self, at: np.ndarray):
        self.at = at
        apart = np.array([squared(at, one) for one in at], float).reshape(len(at), len(at))
        self.gap = np.sqrt(apart)
        np.fill_diagonal(apart, -1)
        self.order = np.argsort(apart, axis=1, kind="stable")
        self.half = np.full(len(at), np.inf)
        if len(at) > 1:
            self.half = self.gap[np.arange(len(at)), self.order[:, 1]] / 2 * (1 - SLACK)

    def scan(self, start: int, points: np.ndarray, d1: np.ndarray, c2: np.ndarray, d2: np.ndarray) -> tuple[np.ndarray, ...]:
        """Nearest and second-nearest centroid of points and their squared distances, from start on.

        d1 are the distances to start, and d2 those to the remembered centroids c2.
        """
        c1, reach, seen = np.full(len(points), start), np.sqrt(d1.astype(float)), c2.copy()
        d1, c2, d2 = d1.copy(), c2.copy(), d2.copy()
        live = np.arange(len(points))
        for j in self.order[start][1:]:
            live = live[self.gap[start, j] <= (reach[live] + np.sqrt(d2[live].astype(float))) * (1 + SLACK)]
            if not len(live):
                break
            rows = live[seen[live] != j]
            d = squared(points[rows], self.at[j])
            first = (d < d1[rows]) | ((d == d1[rows]) & (j < c1[rows]))
            second = ~first & ((d < d2[rows]) | ((d == d2[rows]) & (j < c2[rows])))
            won, came = rows[first], rows[second]
            d2[won], c2[won] = d1[won], c1[won]
            d1[won], c1[won] = d[first], j
            d2[came], c2[came] = d[second], j
        return c1, d1, c2, d2

    def assign(self, points: np.ndarray, near: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> int:
        """Bring the state up to date; how many vectors had to look round."""

        def unsure(rows: np.ndarray) -> np.ndarray:
            return rows[upper[rows] >= np.maximum(lower[rows], self.half[near[rows]])]

        rows = unsure(np.arange(len(points)))
        upper[rows] = np.sqrt(squared(points[rows], self.at[near[rows]]).astype(float)) * (1 + SLACK)
        rows = unsure(rows)
        one, two = near[rows], second[rows]
        d1, d2 = (squared(points[rows], self.at[c]) for c in (one, two))
        swap = (d2 < d1) | ((d2 == d1) & (two < one))
        one, two = np.where(swap, two, one), np.where(swap, one, two)
        d1, d2 = np.where(swap, d2, d1), np.where(swap, d1, d2)
        for start in np.unique(one):
            mine = np.flatnonzero(one == start)
            at = rows[mine]
            near[at], best, second[at], next_best = self.scan(start, points[at], d1[mine], two[mine], d2[mine])
            upper[at] = np.sqrt(best.astype(float)) * (1 + SLACK)
            lower[at] = np.sqrt(next_best.astype(float)) * (1 - SLACK)
        return len(rows)


def moved(near: np.ndarray, upper: np.ndarray, lower: np.ndarray, before: np.ndarray, after: np.ndarray) -> None:
    """Widen the bounds by what the centroids have moved."""
    step = np.sqrt(squared(after, before).astype(float)) * (1 + SLACK)
    largest = int(np.argmax(step))
    others = np.delete(step, largest).max(initial=0.0)
    upper += step[near]
    lower -= np.where(near == largest, others, step[largest])


def state_row(ids: pa.Array, points: np.ndarray, near: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray, count: int, centroids: np.ndarray | None) -> pa.RecordBatch:
    """A block with its state; totals are the sums and sizes of its clusters, or at the end the sums of
    the high and low 31 bits of the distances, which cannot overflow."""
    if centroids is None:
        totals = np.zeros((count, points.shape[1] + 1), np.int64)
        for c in np.unique(near):
            mine = points[near == c]
            totals[c, :-1], totals[c, -1] = mine.sum(0), len(mine)
    else:
        totals = np.zeros((count, 2), np.int64)
        distance = squared(points, centroids[near])
        np.add.at(totals, near, np.stack([distance >> 31, distance & (2**31 - 1)], 1))
    width = int(np.abs(points).max(initial=0))
    kind = "<i1" if width < 2**7 else "<i2" if width < 2**15 else "<i4"
    raw = [points.astype(kind), near.astype("<i4"), second.astype("<i4"), upper, lower]
    lists = pa.ListArray.from_arrays([0, len(ids)], ids.cast(pa.int64()))
    return pa.RecordBatch.from_arrays(
        [lists, *[pa.array([x.tobytes()], pa.binary()) for x in raw], pa.array([totals.ravel().tolist()], pa.list_(pa.int64()))],
        names=["ids", "vectors", "near", "second", "upper", "lower", "totals"],
    )


def unpacked(row: dict, dims: int) -> tuple[np.ndarray, ...]:
    near, second = (np.frombuffer(row[c], "<i4").astype(np.int64) for c in ("near", "second"))
    upper, lower = (np.frombuffer(row[c], "<f8").copy() for c in ("upper", "lower"))
    size = len(row["vectors"]) // (len(near) * dims)
    return np.frombuffer(row["vectors"], f"<i{size}").reshape(-1, dims).astype(np.int64), near, second, upper, lower


def first_round(rows: DataFrame, centroids: np.ndarray, scale: int, last: bool) -> DataFrame:
    """Blocks of the vectors with their state; all begin between the first two centroids."""
    count, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ball = Ball(centroids)
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                part = batch.slice(a, BLOCK)
                points = np.floor(part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims) * scale).astype(np.int64)
                n = len(points)
                near, second = np.zeros(n, np.int64), np.full(n, min(1, count - 1))
                upper, lower = np.full(n, np.inf), np.full(n, -np.inf)
                ball.assign(points, near, second, upper, lower)
                yield state_row(part.column(0), points, near, second, upper, lower, count, centroids if last else None)

    return rows.mapInArrow(tidy(run), STATE)


def next_round(blocks: DataFrame, before: np.ndarray, after: np.ndarray, last: bool) -> DataFrame:
    """The blocks with their state for the centroids after a move."""
    count, dims = after.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ball = Ball(after)
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in ("vectors", "near", "second", "upper", "lower")}
                points, near, second, upper, lower = unpacked(row, dims)
                moved(near, upper, lower, before, after)
                ball.assign(points, near, second, upper, lower)
                ids = batch.column("ids")[k].values
                yield state_row(ids, points, near, second, upper, lower, count, after if last else None)

    return blocks.mapInArrow(tidy(run), STATE)


def summed(blocks: DataFrame, count: int) -> list[list[int]]:
    """The totals of all blocks, by cluster: a few numbers for each, added up in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            total = total + batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1).sum(0)
        if isinstance(total, np.ndarray):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["place", "n"])

    found = blocks.select("totals").mapInArrow(run, "place int, n long")
    rows = found.groupBy("place").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).collect()  # bounded by count and dims
    flat = [int(r["n"]) for r in sorted(rows, key=lambda r: r["place"])]
    step = len(flat) // count
    return [flat[k * step : (k + 1) * step] for k in range(count)]


def averaged(totals: list[list[int]], centroids: np.ndarray) -> np.ndarray:
    """Exact floors of the averages; an empty cluster keeps its centroid."""
    return np.array([[x // own[-1] for x in own[:-1]] if own[-1] else old.tolist() for own, old in zip(totals, centroids, strict=True)], np.int64)


def cluster(
    table: DataFrame,
    count: int = 16,
    rounds: int = 3,
    dims: int = 64,
    scale: int = 64,
    seed: str = "1:",
    vector_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia and centroid_sha256 of each vector.

    Components are scaled and floored. rounds is how often centroids move; then vectors are assigned
    once more.
    """
    rows = whole_vectors(table, vector_id, vector, dims, scale)
    centroids = started(rows, count, scale, seed)
    if not len(centroids):
        names = [c.split() for c in RESULT.split(", ")]
        return rows.select(F.col("id").alias("vec_id"), *[F.lit(None).cast(kind).alias(c) for c, kind in names[1:]])
    blocks = stored(first_round(rows, centroids, scale, rounds == 0), "blocks")
    for k in range(rounds):
        totals = summed(blocks, len(centroids))
        if not totals[0]:  # the rows have gone since
            break
        after = averaged(totals, centroids)
        blocks, centroids = stored(next_round(blocks, centroids, after, k == rounds - 1), "blocks"), after
    inertias = [(high << 31) + low for high, low in summed(blocks, len(centroids))]
    return assigned(blocks, centroids, inertias)


def fitting(n: int) -> int | None:
    return n if n < 2**63 else None


def assigned(blocks: DataFrame, centroids: np.ndarray, inertias: list[int]) -> DataFrame:
    """One row for each vector of the blocks."""
    dims, whole = centroids.shape[1], fitting(sum(inertias))
    digests = pa.array([hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()])
    each = pa.array([fitting(n) for n in inertias], pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in ("vectors", "near", "second", "upper", "lower")}
                points, near, *_ = unpacked(row, dims)
                cells = pa.array(near, pa.int32())
                columns = [
                    batch.column("ids")[k].values,
                    cells,
                    pa.array(squared(points, centroids[near])),
                    each.take(cells),
                    pa.array([whole] * len(near), pa.int64()),
                    digests.take(cells),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in RESULT.split(", ")])

    return blocks.mapInArrow(tidy(run), RESULT)


def oracle(count: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64) -> str:
    """The same in SQL, measuring every vector against every centroid."""
    steps = [
        f"""vectors AS (
  SELECT vec_id, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings WHERE len(embedding) = {dims} AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), c0 AS (
  SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || vec_id)) AS INTEGER) - 1 AS k, v
  FROM vectors ORDER BY sha256('1:' || vec_id) LIMIT {count}
)"""
    ]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS (
  SELECT vec_id, any_value(v) AS v, min(struct_pack(d := d, k := k)) AS best FROM (
    SELECT p.vec_id, p.v, c.k, CAST(list_sum([(p.v[i] - c.v[i]) * (p.v[i] - c.v[i]) FOR i IN range(1, {dims + 1})]) AS BIGINT) AS d
    FROM vectors p CROSS JOIN c{r} c) GROUP BY vec_id
)""")
        if r < rounds:
            steps.append(f"""s{r} AS (
  SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM (
    SELECT best.k AS k, i, sum(v[i]) AS s, count(*) AS n FROM a{r}, range(1, {dims + 1}) r(i) GROUP BY 1, 2) GROUP BY k
), c{r + 1} AS (
  SELECT c.k, coalesce(s.v, c.v) AS v FROM c{r} c LEFT JOIN s{r} s ON s.k = c.k
)""")
    return f"""
WITH {", ".join(steps)}
SELECT vec_id, best.k AS cluster, best.d AS distance,
  CAST(sum(best.d) OVER (PARTITION BY best.k) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} c ON c.k = best.k
"""
