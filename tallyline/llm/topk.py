"""Exact top-k search by distributed histogram selection.

Components are scaled and floored to integers, and scores are integer inner products. Every pass
scores every candidate against every query, in blocks. A pass adds up, for each query, a histogram of
the scores within the interval that still holds its k-th best score; the histogram shrinks the
interval, until it is a single value. The last pass keeps what scores higher, and of the scores equal
to the k-th those of the smallest ids, each task first cutting its own to k.

Blocks meet in a Cartesian product of the stored partitions: each task reads some query blocks and some
candidate blocks from where they are stored. Nothing is repeated in a shuffle, and nothing is
collected for a broadcast, so the driver holds no vectors, however many queries there are. A task takes
one query block after the other past its candidates, which it holds: PART_BYTES of them at most.

All intervals have one width, a power of the number of bins, so that they divide without remainder.
A task stops counting a bin once it has found the rank that is sought in it or higher: what lies there
or lower in its histogram cannot move the choice any more. So few scores are counted and few bins sent.
The histograms are summed by (query block, slice of its queries), so no task sees more than its slice.

A task holds the histograms of HELD_BLOCKS query blocks at most, and scores QUERY_STEP queries at a time.

Vectors that are null, empty, or hold null or non-finite components take no part, nor do those whose
id is null. A query meets only vectors of its own dimension. Repeated rows are candidates each; rows
with the query's own id are not. An id is one query, however often it occurs; of different vectors of one
id the smallest, compared component by component, is the query. Scores must fit 63 bits: a vector
with a component beyond 2^30 / sqrt(dimension), once scaled, takes no part. An empty table gives no rows, and
columns other than the id and the vector are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyline.llm.storage import stored
from tallyline.session import splits_of

QUERY_BLOCK, QUERY_STEP, CANDIDATE_BLOCK, BINS, SLICES, HELD_BLOCKS = 4096, 512, 4096, 512, 8, 2
#: Queries that a task takes past its candidates, bytes of candidates that it holds, and candidates of a block by which it first raises the floor.
PART_QUERIES, PART_BYTES, FIRST = 1 << 16, 32 << 20, 256
#: Query blocks that one task deals out, so that the parts are even.
DEALT = 64
LARGEST_SCORE = 2.0**60
#: Floats that hold whole numbers up to a bound, and so exact scores below it.
EXACT = ((np.float32, 2.0**24), (np.float64, 2.0**53))

STATE = "dim int, qb long, ids binary, vectors binary, low binary, need binary"


def whole_vectors(table: DataFrame, vector_id: str, vector: str, scale: int) -> DataFrame:
    """id, v (integers) and dim of the vectors that take part."""
    parts = F.col(vector)
    most = F.sqrt(F.lit(LARGEST_SCORE) / F.size(parts)) - 1
    fits = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) <= most))
    valid = F.col(vector_id).isNotNull() & (F.size(parts) > 0) & fits
    return table.filter(valid).select(
        F.col(vector_id).cast("long").alias("id"),
        F.transform(parts, lambda x: F.floor(x.cast("double") * scale)).alias("v"),
        F.size(parts).alias("dim"),
    )


def packed(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Blocks of vectors of one dimension: dim, a block number, the ids and numbers as bytes, and the largest square sum.

    The numbers are of the smallest type that holds them all. Ids of a block ascend.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 2))
            for dim in np.unique(dims):
                mine = np.flatnonzero(dims == dim)
                flat = batch.column(1).take(pa.array(mine)).flatten().to_numpy(zero_copy_only=False).astype("<i8")
                flat = flat.reshape(len(mine), dim)
                for a in range(0, len(mine), size):
                    own, part = ids[mine[a : a + size]], flat[a : a + size]
                    order = np.argsort(own, kind="stable")
                    own, part = own[order], part[order]
                    most = int(np.abs(part).max(initial=0))
                    kind = "<i2" if most < 2**15 else "<i4" if most < 2**31 else "<i8"
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([dim], pa.int32()),
                            pa.array([own.astype("<i8").tobytes()]),
                            pa.array([part.astype(kind).tobytes()]),
                            pa.array([int((part * part).sum(1).max(initial=0))], pa.int64()),
                        ],
                        names=["dim", "ids", "vectors", "reach"],
                    )

    blocks = rows.mapInArrow(run, "dim int, ids binary, vectors binary, reach long")
    return blocks.withColumn(name, F.monotonically_increasing_id())


def unpacked(dim: int, ids: bytes, vectors: bytes) -> tuple[np.ndarray, np.ndarray]:
    own = np.frombuffer(ids, "<i8")
    size = len(vectors) // (len(own) * dim)
    return own, np.frombuffer(vectors, f"<i{size}").reshape(len(own), dim)


def most_square(vectors: np.ndarray) -> float:
    return float(np.square(vectors.astype(float)).sum(1).max(initial=0))


def hits(row: dict, floor: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """Queries of a block, and the pairs that score their floor or more: the query's place among them, the
    candidate's id, and the exact score. By query, then by id; without the query's own id.

    floor is read anew before each part of the scores, so what a part has shown can raise it for the next.
    """
    own, vectors = unpacked(row["dim"], row["c_ids"], row["c_vectors"])
    ids, queries = unpacked(row["dim"], row["ids"], row["vectors"])
    # Every sum of some of a score's products is within this bound, so none of them is rounded.
    bound = math.sqrt(most_square(queries) * most_square(vectors)) * (1 + 1e-6) + 1
    kind, reach = next(((kind, most) for kind, most in EXACT if bound < most), (np.int64, 2.0**62))
    queries, vectors = queries.astype(kind), vectors.astype(kind).T
    for a in range(0, len(ids), QUERY_STEP):
        cut = slice(a, a + QUERY_STEP)
        score = queries[cut] @ vectors
        for part in (slice(0, FIRST), slice(FIRST, None)):
            seen = score[:, part]
            least = np.clip(floor[cut], -int(reach), int(reach)).astype(kind)
            q, c = np.divmod(np.flatnonzero(seen >= least[:, None]), max(1, seen.shape[1]))
            value = seen[q, c].astype(np.int64)
            c += part.start
            other = ids[cut][q] != own[c]
            yield cut, q[other], own[c[other]], value[other]


def columns(batch: pa.RecordBatch) -> Iterator[dict]:
    for k in range(batch.num_rows):
        yield {n: batch.column(n)[k].as_py() for n in batch.schema.names}


def started(blocks: DataFrame, low: int, k: int) -> DataFrame:
    """The state of each query block: where the interval begins, and the rank that is sought in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in columns(batch):
                n = len(row["ids"]) // 8
                yield state_row(row, np.full(n, low), np.full(n, k))

    return blocks.mapInArrow(run, STATE)


def state_row(row: dict, low: np.ndarray, need: np.ndarray) -> pa.RecordBatch:
    values = [row["ids"], row["vectors"], low.astype("<i8").tobytes(), need.astype("<i8").tobytes()]
    return pa.RecordBatch.from_arrays(
        [pa.array([row["dim"]], pa.int32()), pa.array([row["qb"]], pa.int64()), *[pa.array([v], pa.binary()) for v in values]],
        names=["dim", "qb", "ids", "vectors", "low", "need"],
    )


def pairs(state: DataFrame, candidates: DataFrame, blocks: int, parts: int) -> DataFrame:
    """Each query block beside each candidate block of its dimension; a task's rows are by query block.

    The queries are dealt over so many parts. The hint rules out a broadcast, which would go through the driver.
    """
    dealt = state.coalesce(math.ceil(blocks / DEALT)).repartition(parts) if blocks else state
    met = candidates.select("dim", F.col("ids").alias("c_ids"), F.col("vectors").alias("c_vectors"))
    return dealt.join(met.hint("shuffle_replicate_nl"), "dim")


def sparse(counts: np.ndarray) -> bytes:
    """A histogram for each query, as bytes: how many bins are not empty, which, and their counts."""
    filled = counts > 0
    which = np.nonzero(filled)[1]
    return filled.sum(1).astype("<u2").tobytes() + which.astype("<u2").tobytes() + counts[filled].astype("<i8").tobytes()


def dense(data: bytes, n: int) -> np.ndarray:
    """The histograms of n queries, queries x BINS."""
    filled = np.frombuffer(data, "<u2", n)
    total = int(filled.sum(dtype=np.int64))
    counts = np.zeros((n, BINS), np.int64)
    which = np.frombuffer(data, "<u2", total, 2 * n)
    counts[np.repeat(np.arange(n), filled), which] = np.frombuffer(data, "<i8", total, 2 * (n + total))
    return counts


def sliced(n: int) -> list[slice]:
    """The queries of a block of n, in SLICES."""
    return [slice(k * n // SLICES, (k + 1) * n // SLICES) for k in range(SLICES)]


def from_above(counts: np.ndarray) -> np.ndarray:
    """How many scores are in each bin or a higher one."""
    return np.cumsum(counts[:, ::-1], 1)[:, ::-1]


def highest(enough: np.ndarray) -> np.ndarray:
    """The highest bin that is enough, -1 without any."""
    return np.where(enough.any(1), enough.shape[1] - 1 - np.argmax(enough[:, ::-1], 1), -1)


def histograms(met: DataFrame, width: int) -> DataFrame:
    """qb, slice, n and counts (of n queries) of the scores that can move the choice of a bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for row in columns(batch):
                low, need = (np.frombuffer(row[n], "<i8") for n in ("low", "need"))
                if row["qb"] not in held:
                    if len(held) == HELD_BLOCKS:
                        yield from given(held)
                        held.clear()
                    held[row["qb"]] = np.zeros((len(low), BINS), np.int64), low.copy(), need
                counts, floor, _ = held[row["qb"]]
                for cut, q, _, score in hits(row, floor):
                    place = (score - low[cut][q]) // width
                    q, place = q[place < BINS] + cut.start, place[place < BINS]
                    if len(q):
                        np.add.at(counts.reshape(-1), q * BINS + place, 1)
                        q = np.unique(q)
                        floor[q] = low[q] + (highest(from_above(counts[q]) >= need[q, None]) + 1) * width
        yield from given(held)

    def given(held: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for qb, (counts, _, need) in held.items():
            counts[from_above(counts) - counts >= need[:, None]] = 0
            for k, cut in enumerate(sliced(len(counts))):
                if cut.start < cut.stop:
                    yield counted_row(qb, k, counts[cut])

    def add(_: tuple, groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, key = 0, None
        for batch in groups:
            for row in columns(batch):
                total, key = total + dense(row["counts"], row["n"]), (row["qb"], row["slice"])
        yield counted_row(*key, total)

    kind = "qb long, slice int, n int, counts binary"
    return met.mapInArrow(run, kind).groupBy("qb", "slice").applyInArrow(add, kind)


def counted_row(qb: int, part: int, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([qb], pa.int64()), pa.array([part], pa.int32()), pa.array([len(counts)], pa.int32()), pa.array([sparse(counts)], pa.binary())],
        names=["qb", "slice", "n", "counts"],
    )


def narrowed(state: DataFrame, counted: DataFrame, width: int) -> DataFrame:
    """The state with each interval cut to the bin that holds the k-th best score.

    need becomes the rank of that score within its bin. With fewer than k scores in all, the interval
    is the lowest value, so that everything is kept.
    """
    slices = counted.groupBy("qb").agg(F.sort_array(F.collect_list(F.struct("slice", "counts"))).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in columns(batch):
                low, need = (np.frombuffer(row[n], "<i8").copy() for n in ("low", "need"))
                cuts = sliced(len(low))
                for part in row["parts"] or []:
                    cut = cuts[part["slice"]]
                    counts = dense(part["counts"], len(low[cut]))
                    above = from_above(counts)  # this bin and higher ones
                    chosen = highest(above >= need[cut, None])
                    found = np.flatnonzero(chosen >= 0)
                    need[cut][found] -= (above - counts)[found, chosen[found]]
                    low[cut] += np.maximum(chosen, 0) * width
                yield state_row(row, low, need)

    return state.join(slices.hint("merge"), "qb", "left").mapInArrow(run, STATE)


def finished(met: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id and score of what each task has above the k-th score, and its k best ties."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qb, best = None, empty
        for batch in batches:
            for row in columns(batch):
                if row["qb"] != qb:
                    yield given(best)
                    qb, best = row["qb"], empty
                low, ids = (np.frombuffer(row[n], "<i8") for n in ("low", "ids"))
                for cut, q, c, score in hits(row, low):
                    # Fewer than k score higher, so of a block's hits by id none but the first 2k can be among its k best ties.
                    some = (score > low[cut][q]) | (np.arange(len(q)) - np.searchsorted(q, q) < 2 * k)
                    if some.any():
                        best = [np.concatenate(x) for x in zip(best, (ids[cut][q[some]], c[some], score[some]), strict=True)]
                if len(best[0]) > 4 * k * len(ids):
                    best = cut_to_k(best)
        yield given(best)

    empty = [np.zeros(0, np.int64)] * 3

    def cut_to_k(best: list[np.ndarray]) -> list[np.ndarray]:
        q, c, score = best
        order = np.lexsort((c, -score, q))
        q = q[order]
        kept = np.arange(len(q)) - np.searchsorted(q, q) < k
        return [q[kept], c[order][kept], score[order][kept]]

    def given(best: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in cut_to_k(best)], names=["query_id", "vec_id", "score"])

    return met.mapInArrow(run, "query_id long, vec_id long, score long")


def search(
    table: DataFrame,
    is_query: Callable[[Column], Column],
    k: int = 5,
    vector_id: str = "vec_id",
    vector: str = "embedding",
    scale: int = 256,
) -> DataFrame:
    """query_id, rank, vec_id and score: the k best rows for every row whose id is_query accepts."""
    spark = table.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = whole_vectors(table, vector_id, vector, scale)
    asked = rows.filter(is_query(F.col("id"))).groupBy("id").agg(F.min("v").alias("v")).select("id", "v", F.size("v").alias("dim"))
    asked = asked.coalesce(max(1, tasks // 4))
    with splits_of(spark, PART_BYTES):
        candidates = stored(packed(rows, CANDIDATE_BLOCK, "cb"), "candidates", compression="none")
        reach = int(candidates.agg(F.max("reach")).first()[0] or 0)  # of the queries too, which are candidates
        state = stored(started(packed(asked, QUERY_BLOCK, "qb"), -reach, k), "state")
        blocks, queries = state.agg(F.count("*"), F.sum(F.octet_length("ids")) / 8).first()
        parts = max(math.ceil((queries or 0) / PART_QUERIES), min(blocks, math.ceil(tasks / max(1, candidates.rdd.getNumPartitions()))), 1)
        width = 1
        while width * BINS < 2 * reach + 1:
            width *= BINS
        while width:
            counted = histograms(pairs(state, candidates, blocks, parts), width)
            state = stored(narrowed(state, counted, width), "state")
            width //= BINS
        best = finished(pairs(state, candidates, blocks, parts), k)
        place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        ranked = best.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
        return stored(ranked.select("query_id", "rank", "vec_id", "score"), "ranked")


ORACLE = """
WITH vectors AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF abs(256 * CAST(x AS DOUBLE)) > sqrt(power(2.0, 60) / len(embedding)) - 1]) = 0
), queries AS (
  SELECT vec_id, min(v) AS v FROM vectors WHERE vec_id % 50 = 0 GROUP BY vec_id
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM queries q JOIN vectors c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
