"""MinHash near-duplicates by an LSH forest, confirmed on full shingle sets.

1. Documents of equal shingle sets are one class, of the smallest doc_id; classes have a signature of
   TREES * DEPTH minimum hashes.
2. The forest is TREES sorted orders of the classes, each by the signature from another place on.
   Classes are dealt to partitions by range, so a dense region spreads over several. Neighbours with
   DEPTH or more hashes in common are candidates. So are the first classes of a region, deeper
   ones where it is dense: the longer the common prefix, the smaller the region.
3. Candidates are confirmed on the full sets, and links joined to components.
4. What is left are pairs of classes that share a region of some tree and are still apart. Regions of
   up to SMALL classes are compared by signature first and the likely pairs confirmed; larger ones
   are cut into blocks, and the pairs of different components in each two blocks are counted exactly
   inside a task, which returns no more links than there are components. So no pair that shares a
   region goes unseen, and no task gets a whole region.

Two sets of Jaccard similarity s share no region with probability (1 - s ** DEPTH) ** TREES, which is
3e-5 at 0.8, 4e-7 at 0.85 and 6e-10 at 0.9. A pair of a small region is not confirmed if its
signatures agree in under LIKELY of all places, over five deviations below 0.8.

Very long texts are read whole, each in memory once. An empty table gives no rows.
Null texts and texts without words have no shingles and are linked with nothing. Rows of one doc_id
are one document; a null doc_id is linked with nothing and kept. Columns other than doc_id and text
pass through `deduplicated` unchanged, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.components import components
from tallyline.llm.storage import stored
from tallyline.llm.textbytes import SPACES, Spans, blocks, mix, runs, tidy, utf8, windows

SHINGLE, THRESHOLD = 5, 80
TREES, DEPTH, DEEP = 20, 4, 8
LIKELY = 0.57
SMALL, BLOCK = 64, 256
BROADCAST_IDS = 4_000_000
PAIRS_PER_TASK = 2_000
CLASSES_PER_TASK = 12_000

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_random = np.random.default_rng(20240607)
FIRST, SECOND = (_random.integers(0, 1 << 31, TREES * DEPTH, np.uint32) * np.uint32(2) + np.uint32(1) for _ in range(2))


def shingle_sets(data: np.ndarray, at: np.ndarray, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a block."""
    data = LOWER[data]
    start, end, doc = runs(~SPACES[data], at)
    words = Spans(data).hashes(start, end)
    shape, place = windows(words, doc, size)
    owner = doc[place]
    n = len(at) - 1
    cut = np.searchsorted(owner, np.arange(n + 1))
    word_cut = np.searchsorted(doc, np.arange(n + 1))
    out = []
    for k in range(n):
        if cut[k] < cut[k + 1]:
            out.append(np.unique(shape[cut[k] : cut[k + 1]]))
        elif word_cut[k] < word_cut[k + 1]:  # fewer words than a shingle has: the sequence is one
            few = words[word_cut[k] : word_cut[k + 1]]
            out.append(windows(few, np.zeros(len(few), np.int64), len(few))[0] ^ np.uint64(len(few)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(shingles: np.ndarray) -> bytes:
    """Minimum hashes, big-endian, so that they sort as bytes."""
    low, high = shingles.astype(np.uint32), (shingles >> np.uint64(32)).astype(np.uint32)
    return (FIRST[:, None] * low + SECOND[:, None] * high).min(1).astype(">u4").tobytes()


def each_set(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    """doc_ids and shingle sets of the texts of batches (doc_id, text), a block at a time."""
    for batch in batches:
        data, at = utf8(batch.column(1))
        ids = batch.column(0).to_pylist()
        for a, b in blocks(at):
            yield ids[a:b], shingle_sets(data[at[a] : at[b]], at[a : b + 1] - at[a], size)


def measured(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, two sums that tell sets apart, and the signature (null without shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in each_set(batches, size):
            sums = [[mix(s ^ np.uint64(c)).sum(dtype=np.uint64).astype(np.int64) for s in sets] for c in (0x51ED, 0xA3B1)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    *[pa.array(x, pa.int64()) for x in sums],
                    pa.array([signature(s) if len(s) else None for s in sets], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "sum1", "sum2", "signature"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(tidy(run), "doc_id long, n_shingles long, sum1 long, sum2 long, signature binary")


def forest(classes: DataFrame, tasks: int) -> DataFrame:
    """Rows a, b (candidates), and h, a (classes that share a region h), from the sorted orders."""
    twice = F.concat("signature", "signature")
    orders = [F.struct(F.lit(t).alias("tree"), F.substring(twice, 4 * DEPTH * t + 1, 4 * DEEP).alias("key")) for t in range(TREES)]
    rows = classes.select(F.inline(F.array(*orders)), "id").select("tree", "key", "id")
    rows = rows.repartitionByRange(tasks, "tree", "key", "id").sortWithinPartitions("tree", "key", "id")

    def regions(tree: np.ndarray, key: np.ndarray, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        n = len(ids)
        parts = key.view(np.uint8).reshape(n, DEEP, 4)
        same = np.concatenate([[False], tree[1:] == tree[:-1]])[:, None] & np.concatenate([np.zeros((1, DEEP), bool), (parts[1:] == parts[:-1]).all(2)])
        common = np.cumprod(same, 1).sum(1)  # with the row before
        pairs = []
        for depth in (DEPTH, (DEPTH + DEEP) // 2, DEEP):
            heads = np.flatnonzero(common < depth)
            first = heads[np.searchsorted(heads, np.arange(n), "right") - 1]
            inner = np.flatnonzero(common >= depth)
            pairs.append(np.stack([ids[first[inner]], ids[inner]], 1))
        inner = np.flatnonzero(common >= DEPTH)
        pairs.append(np.stack([ids[inner - 1], ids[inner]], 1))
        pairs = np.unique(np.sort(np.concatenate(pairs), 1), axis=0)
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        heads = np.flatnonzero(common < DEPTH)
        length = np.diff(np.append(heads, n))
        region = np.repeat(np.arange(len(heads)), length)
        shared = np.flatnonzero((length > 1)[region] | (region == 0) | (region == len(heads) - 1))
        code = mix(tree.astype(np.uint64) + np.uint64(1))
        for k in range(DEPTH):
            code = mix(code ^ parts[:, k].copy().view("<u4").ravel().astype(np.uint64))
        # The regions at both ends may go on in other partitions, so their heads are marked.
        ends = np.unique([heads[0], heads[-1]])
        yield as_rows(pairs[:, 0], pairs[:, 1], None, 0)
        yield as_rows(ids[shared], None, code[shared].astype(np.int64), 1)
        yield as_rows(ids[ends], None, code[ends].astype(np.int64), 2)

    def as_rows(a: np.ndarray, b: np.ndarray | None, h: np.ndarray | None, kind: int) -> pa.RecordBatch:
        none = pa.nulls(len(a), pa.int64())
        columns = [pa.array(a, pa.int64()), none if b is None else pa.array(b, pa.int64()), none if h is None else pa.array(h, pa.int64()), pa.array(np.full(len(a), kind, np.int32))]
        return pa.RecordBatch.from_arrays(columns, names=["a", "b", "h", "kind"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(b.column(0).to_numpy(), np.frombuffer(b"".join(b.column(1).to_pylist()), f"S{4 * DEEP}"), b.column(2).to_numpy()) for b in batches if b.num_rows]
        if got:  # a partition is a bounded share of the order
            yield from regions(*(np.concatenate(c) for c in zip(*got, strict=True)))

    return rows.mapInArrow(tidy(run), "a long, b long, h long, kind int")


def similar(one: np.ndarray, two: np.ndarray, threshold: int) -> bool:
    both = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * both >= threshold * (len(one) + len(two) - both)


def confirmed(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs whose full sets are similar enough. A hot class's rows are split at run time."""
    one = sets.select(F.col("id").alias("a"), F.col("shingles").alias("one"))
    two = sets.select(F.col("id").alias("b"), F.col("shingles").alias("two"))
    met = pairs.join(one, "a").join(two, "b").select("a", "b", "one", "two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for k in range(batch.num_rows):
                one, two = (np.frombuffer(batch.column(c)[k].as_buffer(), "<u8") for c in (2, 3))
                keep.append(min(len(one), len(two)) * 100 >= threshold * max(len(one), len(two)) and similar(one, two, threshold))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return met.mapInArrow(tidy(run), "a long, b long")


def likely_pairs(members: DataFrame, tasks: int, threshold: int) -> DataFrame:
    """Pairs of different components in one small region whose signatures agree enough."""

    def run(key: tuple, groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(groups)).sort_by("h")
        h, ids, n, comp = (table.column(c).to_numpy() for c in ("h", "id", "n", "component"))
        marks = np.frombuffer(b"".join(table.column("signature").to_pylist()), "<u4").reshape(len(h), -1)
        cut = np.append(np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])), len(h))
        out = []
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            x, y = np.triu_indices(b - a, 1)
            x, y = x + a, y + a
            ok = (comp[x] != comp[y]) & (100 * np.minimum(n[x], n[y]) >= threshold * np.maximum(n[x], n[y]))
            x, y = x[ok], y[ok]
            ok = (marks[x] == marks[y]).mean(1) >= LIKELY
            out.append(np.stack([ids[x[ok]], ids[y[ok]]], 1))
        pairs = np.unique(np.sort(np.concatenate(out), 1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    sharded = members.withColumn("shard", F.pmod("h", F.lit(tasks)))
    return sharded.groupBy("shard").applyInArrow(run, "a long, b long").distinct()


def block_links(members: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Links between different components within large regions, counted block against block."""
    count = F.ceil(F.col("size") / BLOCK).cast("int")
    rows = members.withColumn("count", count).withColumn("block", F.pmod(F.xxhash64("id"), F.col("count")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("count") - 1)).alias("other")
    rows = rows.select("h", "id", "component", "block", other)
    rows = rows.select("h", "id", "component", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    rows = rows.join(sets.select("id", "shingles"), "id")

    def run(key: tuple, groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(groups))  # two blocks at most
        ids, comp, block = (table.column(c).to_numpy() for c in ("id", "component", "block"))
        links = []
        if len(np.unique(comp)) > 1:
            sets_of = [np.frombuffer(s, "<u8") for s in table.column("shingles").to_pylist()]
            size = np.array([len(s) for s in sets_of])
            i, j = key[1].as_py(), key[2].as_py()
            left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
            _, code = np.unique(np.concatenate(sets_of), return_inverse=True)
            owner = np.repeat(np.arange(len(ids)), size)
            order = np.lexsort((owner, code))
            code, owner = code[order], owner[order]
            bounds = np.append(np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])), len(code))
            both = np.zeros((len(ids), len(ids)), np.int32)
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                if b - a > 1:
                    both[np.ix_(owner[a:b], owner[a:b])] += 1
            cross = both[np.ix_(left, right)]
            union = size[left][:, None] + size[right][None] - cross
            x, y = np.nonzero((100 * cross >= threshold * union) & (comp[left][:, None] != comp[right][None]))
            parent: dict[int, int] = {}

            def root(v: int) -> int:
                while parent.setdefault(v, v) != v:
                    v = parent[v]
                return v

            for a, b in zip(left[x].tolist(), right[y].tolist(), strict=True):
                ra, rb = root(int(comp[a])), root(int(comp[b]))
                if ra != rb:
                    parent[max(ra, rb)] = min(ra, rb)
                    links.append((int(ids[a]), int(ids[b])))
        a, b = zip(*links, strict=True) if links else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return rows.groupBy("h", "i", "j").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = stored(measured(docs, size), "measured")
    own = ["n_shingles", "sum1", "sum2"]
    ids = rows.filter(F.col("signature").isNotNull() & F.col("doc_id").isNotNull())
    classes = ids.groupBy(*own).agg(F.min(F.struct("doc_id", "signature")).alias("first"))
    classes = stored(classes.select("first.*", *own).withColumnRenamed("doc_id", "id"), "classes")
    tasks = max(partitions, classes.count() // CLASSES_PER_TASK)
    told = stored(forest(classes, tasks), "forest")
    shared = told.filter("kind = 1").select("h", F.col("a").alias("id"))
    ends = told.filter("kind = 2").select("h", "a")
    first = ends.groupBy("h").agg(F.min("a").alias("b"))
    pairs = told.filter("kind = 0").select("a", "b").unionAll(ends.join(first, "h").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    pairs = stored(pairs.filter("a <> b").distinct(), "pairs")
    crowded = shared.groupBy("h").agg(F.count("*").alias("size")).filter("size > 1")
    shared = stored(shared.join(crowded, "h"), "shared")
    sets = full_sets(docs, shared.select("id").distinct(), size)
    links = stored(confirmed(pairs.repartition(max(partitions, 1), "a"), sets, threshold), "links")
    joined = components(links)
    members = shared.join(joined, "id", "left").withColumn("component", F.coalesce("component", "id"))
    apart = members.groupBy("h").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("h")
    members = stored(members.join(apart, "h"), "members")
    small = members.filter(F.col("size") <= SMALL).join(classes.select("id", F.col("n_shingles").alias("n"), "signature"), "id")
    more = confirmed(likely_pairs(small, tasks, threshold), sets, threshold)
    more = more.unionAll(block_links(members.filter(F.col("size") > SMALL), sets, threshold))
    joined = components(links.unionAll(more))
    class_ids = classes.select("id", *own).join(joined, "id", "left").withColumn("component_id", F.coalesce("component", "id"))
    # A set that is in many documents is one row of the right side; the left side is split if it is hot.
    done = rows.drop("signature").join(class_ids.drop("id", "component"), own, "left")
    return done.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def full_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """id and shingles (sorted 64-bit numbers) of the wanted documents.

    Up to BROADCAST_IDS ids are broadcast, so that texts need not be shuffled; more are joined.
    """
    wanted = broadcast_if_small(wanted.withColumnRenamed("id", "doc_id"))
    rows = docs.select(F.col("doc_id").cast("long"), "text").join(wanted, "doc_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in each_set(batches, size):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())], names=["id", "shingles"])

    return stored(rows.mapInArrow(tidy(run), "id long, shingles binary"), "sets")


def deduplicated(docs: DataFrame, size: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of the documents that stay: the smallest doc_id of each component, one row of it.

    Up to BROADCAST_IDS ids are broadcast, so that texts need not be shuffled; more are joined.
    """
    found = stored(near_duplicates(docs, size, threshold), "found")
    gone = found.filter(~F.col("kept")).select(F.col("doc_id").alias("gone_id")).distinct()
    gone = broadcast_if_small(gone)
    rest = docs.join(gone, docs["doc_id"].cast("long") == gone["gone_id"], "left_anti")
    again = found.filter("kept").groupBy(F.col("doc_id").alias("again_id")).count().filter("count > 1 AND again_id IS NOT NULL")
    again = stored(again.select("again_id"), "again")
    if again.isEmpty():
        return rest
    again = broadcast_if_small(again)
    same = rest["doc_id"].cast("long") == again["again_id"]
    once = rest.join(again, same, "left_semi").dropDuplicates(["doc_id"])
    return rest.join(again, same, "left_anti").unionByName(once)


def broadcast_if_small(ids: DataFrame) -> DataFrame:
    ids = stored(ids, "ids")
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


ORACLE = r"""
WITH RECURSIVE word AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(w) >= 3 THEN [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]
         WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g
  FROM word
), size AS (
  SELECT doc_id, count(*) AS n FROM shingle GROUP BY 1
), pair AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM shingle a JOIN shingle b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), link AS (
  SELECT a, b FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE 100 * shared >= 85 * (x.n + y.n - shared)
), edge AS (
  SELECT a, b FROM link UNION SELECT b, a FROM link
), reach AS (
  SELECT doc_id AS id, doc_id AS root FROM documents
  UNION SELECT e.b, r.root FROM reach r JOIN edge e ON e.a = r.id
), component AS (
  SELECT id, min(root) AS component_id FROM reach GROUP BY 1
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN component c ON c.id = d.doc_id LEFT JOIN size s USING (doc_id)
"""
