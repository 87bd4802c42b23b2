"""Words that differ by one letter, and the spelling that each goes back to, by k-d trees.

A word's letters are counted into a vector of 90 places, one for each letter that a word can have. One
edit moves that vector little: a replaced letter takes one count up and one down, an inserted one takes
one up. So near words of one length lie within an L1 distance of two, and near words of neighbouring
lengths within one. For each length a k-d tree divides the vectors into cells. It is grown from a
bounded sample (SAMPLE words in all), which only shapes the cells: they cover everything, and every
word has its place in one. A word is sent to the cells of its own and of the next length whose box its
vector can reach by such a step, and to no others. A cell grows a finer tree over its words, finds the
vectors within reach in the boxes that are left, and compares the letters in order.

Cells are dealt to tasks and read as sorted streams: a task holds the words of one cell, at most about
CELL of them, and one batch of those that look into it. A cell with more words is cut into parts, and
those that look into it are dealt over as many tasks, so that every pair still meets. Words of the very
same letters cannot be told apart by counts; many thousands of them are compared pair by pair, over
tasks. What is sent grows with the number of distinct words, not with the texts.

Words are counted in Spark, with counts added up in each task. Null texts have no words. A row without
doc_id keeps its runs as they are. Repeated rows count once each. An empty table gives no rows. A text's
runs are held at once while it is read, about ten times its bytes; letters of a run are not limited.
Other columns are not read, whatever their names. Words with equally frequent near words take the one
that is first by code points.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.storage import stored
from tallyline.llm.textbytes import tidy

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = 90  # a-z, then U+00C0 to U+00FF

#: Words that shape the trees; words of a cell; sampled words that a cell needs; vectors of a fine box.
SAMPLE, CELL, LEAST, FINE = 200_000, 4096, 16, 96

#: What a word is to a cell: one of its own, or one that looks for a replaced or an inserted letter.
OWN, REPLACED, INSERTED = 0, 1, 2

SENT = "cell int, part int, salt int, kind int, word string, n long"
FOUND = "word string, other string, other_n long"


def thinned(doc_id: Column, run: Column, every: int) -> Column:
    """The run without one letter where the checksum of doc_id and run is a multiple of every."""
    h = F.crc32(F.concat(doc_id.cast("string"), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    less = F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))
    return F.when(h % every == 0, less).otherwise(run)


def word_counts(docs: DataFrame, least_letters: int, least_count: int, every: int) -> DataFrame:
    """word and n of all words of so many letters that occur so often."""
    runs = docs.select(F.col("doc_id"), F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.filter(F.length("run") >= least_letters).withColumn("run", F.translate("run", UPPER, LOWER))
    words = runs.select(thinned(F.col("doc_id"), F.col("run"), every).alias("word")).filter(F.length("word") >= least_letters)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def spelled(words: list[str]) -> np.ndarray:
    """Words of one length as rows of letter numbers."""
    code = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1)
    return np.where(code < 0xC0, code - ord("a"), code - 0xC0 + 26).astype(np.uint8)


def counted(letters: np.ndarray) -> np.ndarray:
    """How often each word has each letter."""
    place = letters + np.arange(len(letters))[:, None] * LETTERS
    return np.bincount(place.ravel(), minlength=len(letters) * LETTERS).reshape(-1, LETTERS)


def halves(points: np.ndarray) -> tuple[int, int] | None:
    """The letter and the count at which points fall into the most equal parts."""
    n = len(points)
    below = np.stack([(points <= v).sum(0) for v in range(4)])
    cut, letter = divmod(int(np.abs(below - n / 2).argmin()), LETTERS)
    if 64 * min(below[cut, letter], n - below[cut, letter]) < n:
        low, high = points.min(0), points.max(0)
        letter = int((high - low).argmax())
        cut = int(low[letter] + high[letter]) // 2
        less = int((points[:, letter] <= cut).sum())
        if 64 * min(less, n - less) < n:
            return None
    return letter, cut


class Tree:
    """A k-d tree over letter counts; leaves are numbered from `first` on."""

    def __init__(self, points: np.ndarray, leaf: int, first: int = 0):
        self.leaves, self.first = [], first
        self.root = self._grown(points, np.arange(len(points)), leaf)

    def _grown(self, points: np.ndarray, rows: np.ndarray, leaf: int) -> tuple | int:
        cut = halves(points[rows]) if len(rows) > leaf else None
        if cut is None:
            self.leaves.append(rows)
            return self.first + len(self.leaves) - 1
        less = points[rows, cut[0]] <= cut[1]
        return (*cut, self._grown(points, rows[less], leaf), self._grown(points, rows[~less], leaf))

    def __len__(self) -> int:
        return len(self.leaves)

    def reached(self, points: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """Each leaf with the rows of points whose counts, moved so far up and down, can lie in its box."""
        rows = np.arange(len(points))
        none = np.zeros(len(points), np.int64)
        yield from self._visit(self.root, points, rows, none, none, {}, up, down)

    def _visit(self, node, points, rows, ups, downs, box, up, down) -> Iterator[tuple[int, np.ndarray]]:
        if not len(rows):
            return
        if not isinstance(node, tuple):
            yield node, rows
            return
        letter, cut, less, more = node
        x = points[rows, letter]
        low, high = box.get(letter, (0, None))
        over = downs + np.maximum(0, x - cut) - (0 if high is None else np.maximum(0, x - high))
        ok = over <= down
        yield from self._visit(less, points, rows[ok], ups[ok], over[ok], box | {letter: (low, cut)}, up, down)
        under = ups + np.maximum(0, cut + 1 - x) - np.maximum(0, low - x)
        ok = under <= up
        yield from self._visit(more, points, rows[ok], under[ok], downs[ok], box | {letter: (cut + 1, high)}, up, down)


def by_length(words: list[str]) -> dict[int, np.ndarray]:
    size = np.fromiter(map(len, words), np.int64, len(words))
    return {int(k): np.flatnonzero(size == k) for k in np.unique(size)}


def planted(sample: list[str], total: int) -> dict[int, Tree]:
    """A tree for each length of the sample, which stands for total words."""
    trees, first = {}, 0
    leaf = max(LEAST, CELL * len(sample) // (2 * max(1, total)))
    for size, rows in by_length(sample).items():
        trees[size] = Tree(counted(spelled([sample[k] for k in rows])), leaf, first)
        first += len(trees[size])
    return trees


def cell_of_length(size: int) -> int:
    """Lengths that the sample lacks have one cell each, below zero."""
    return -size


def routes(trees: dict[int, Tree], words: list[str], kinds: tuple[int, ...]) -> Iterator[tuple[int, int, np.ndarray]]:
    """kind, cell and the places of words that belong to the cell or look into it."""
    moves = {OWN: (0, 0, 0), REPLACED: (0, 1, 1), INSERTED: (1, 1, 0)}
    for size, rows in by_length(words).items():
        points = counted(spelled([words[k] for k in rows]))
        for kind in kinds:
            longer, up, down = moves[kind]
            tree = trees.get(size + longer)
            found = tree.reached(points, up, down) if tree else [(cell_of_length(size + longer), np.arange(len(rows)))]
            for cell, mine in found:
                yield kind, cell, rows[mine]


def homes(words: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """cell and n_words of the cells with words in them, as counted in each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(cell, len(rows)) for _, cell, rows in routes(trees, batch.column(0).to_pylist(), (OWN,))]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*found, strict=True), (pa.int32(), pa.int64()), strict=True)], names=["cell", "n_words"])

    return words.select("word").mapInArrow(tidy(run), "cell int, n_words long")


def sent(words: DataFrame, trees: dict[int, Tree], parts: dict[int, int]) -> DataFrame:
    """Every word in its cell and in those that it looks into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            check = np.fromiter((zlib.crc32(w.encode()) for w in texts), np.int64, len(texts))
            for kind, cell, rows in routes(trees, texts, (OWN, REPLACED, INSERTED)):
                many = parts.get(cell, 1)
                mine = check[rows] % many
                again = np.repeat(np.arange(many), len(rows))
                part, salt = (np.tile(mine, many), again) if kind == OWN else (again, np.tile(mine, many))
                size, taken = len(again), batch.take(pa.array(np.tile(rows, many)))
                fixed = [pa.array(np.full(size, v, np.int32)) for v in (cell, kind)]
                yield pa.RecordBatch.from_arrays(
                    [fixed[0], pa.array(part.astype(np.int32)), pa.array(salt.astype(np.int32)), fixed[1], taken.column(0), taken.column(1)],
                    names=["cell", "part", "salt", "kind", "word", "n"],
                )

    return words.select("word", "n").mapInArrow(tidy(run), SENT)


def one_edit(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Which rows of letters differ by one replaced letter, or by one that long has more."""
    if short.shape[1] == long.shape[1]:
        return (short != long).sum(1) == 1
    ahead = np.logical_and.accumulate(short == long[:, :-1], axis=1).sum(1)
    behind = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(1)
    return ahead + behind >= short.shape[1]


class Cell:
    """Words of one length, with a fine tree over their letter counts."""

    def __init__(self, words: list[str], n: list[int]):
        self.words, self.n = words, n
        self.letters = spelled(words)
        counts = counted(self.letters)
        self.tree = Tree(counts, FINE)
        self.kind = np.float32 if self.letters.shape[1] < 2000 else np.float64  # squares stay exact
        self.counts = counts.astype(self.kind)
        self.square = (self.counts**2).sum(1)

    def near(self, words: list[str], kind: int) -> tuple[np.ndarray, np.ndarray]:
        """Places in words, and in the cell, of all pairs that are one edit apart.

        Between words of one length, an L1 distance of two is a squared L2 distance of two, and between
        neighbouring lengths one is one, so that a matrix product finds the vectors.
        """
        letters = spelled(words)
        counts = counted(letters)
        exact, square = counts.astype(self.kind), (counts**2).sum(1).astype(self.kind)
        step = max(1, 4_000_000 // self.letters.shape[1])
        empty = np.zeros(0, np.int64)
        out = [(empty, empty)]
        for leaf, rows in self.tree.reached(counts, 1, 1 if kind == REPLACED else 0):
            own = self.tree.leaves[leaf]
            gap = square[rows][:, None] + self.square[own][None] - 2 * (exact[rows] @ self.counts[own].T)
            q, p = np.nonzero(gap == (2 if kind == REPLACED else 1))
            q, p = rows[q], own[p]
            for a in range(0, len(q), step):
                ok = one_edit(letters[q[a : a + step]], self.letters[p[a : a + step]])
                out.append((q[a : a + step][ok], p[a : a + step][ok]))
        return tuple(map(np.concatenate, zip(*out, strict=True)))


def pairs(cell: Cell, words: list[str], n: list[int], kind: int) -> pa.RecordBatch:
    """The near words found: for those that look; and for the cell's, where only they look."""
    q, p = cell.near(words, kind)
    rows = [(words[a], cell.words[b], cell.n[b]) for a, b in zip(q.tolist(), p.tolist(), strict=True)]
    if kind == INSERTED:
        rows += [(cell.words[b], words[a], n[a]) for a, b in zip(q.tolist(), p.tolist(), strict=True)]
    word, other, other_n = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(other, pa.string()), pa.array(other_n, pa.int64())], names=["word", "other", "other_n"])


def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of sorted rows of SENT, in which a cell's words come before those that look into it."""
    key, cell, words, n = None, None, [], []
    for batch in batches:
        place = np.stack([batch.column(k).to_numpy() for k in range(4)], 1)
        edges = np.flatnonzero((place[1:] != place[:-1]).any(1)) + 1 if batch.num_rows else []
        for a, b in zip([0, *edges], [*edges, batch.num_rows], strict=True):
            if a == b:
                continue
            run, kind = batch.slice(a, b - a), int(place[a, 3])
            if tuple(place[a, :3]) != key:
                key, cell, words, n = tuple(place[a, :3]), None, [], []
            texts, counts = run.column(4).to_pylist(), run.column(5).to_pylist()
            if kind == OWN:
                words += texts
                n += counts
            elif words:
                cell = cell or Cell(words, n)
                yield pairs(cell, texts, counts, kind)


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near and best (a struct of minus n and word) of all words (word, n) with near words."""
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = words.count()
    chosen = words.filter(F.pmod(F.xxhash64("word"), F.lit(max(1, total))) < SAMPLE).select("word")
    trees = planted(sorted(r["word"] for r in chosen.collect()), total)  # about SAMPLE at most
    spread = words.repartition(tasks)
    large = homes(spread, trees).groupBy("cell").agg(F.sum("n_words").alias("n")).filter(F.col("n") > 2 * CELL)
    parts = {r["cell"]: -(-r["n"] // CELL) for r in large.collect()}  # few: each stands for 2 * CELL words
    rows = sent(spread, trees, parts).repartition(tasks, "cell", "part", "salt").sortWithinPartitions("cell", "part", "salt", "kind")
    found = rows.mapInArrow(tidy(searched), FOUND)
    return found.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))


def last_forms(links: DataFrame) -> DataFrame:
    """word and root of links (word, to), following them to the end; each round doubles the steps."""
    roots = stored(links, "roots")
    while True:
        onward = roots.select(F.col("word").alias("to"), F.col("to").alias("then"))
        further = roots.join(onward, "to", "left")
        if further.filter("then IS NOT NULL").isEmpty():
            return roots.select("word", F.col("to").alias("root"))
        roots = stored(further.select("word", F.coalesce("then", "to").alias("to")), "roots")


def group(docs: DataFrame, least_letters: int = 6, least_count: int = 5, times: int = 5, every: int = 199) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of docs (doc_id, text).

    Runs lose a letter where their checksum is a multiple of `every`. A word's form is its most frequent
    near word, if that is at least `times` as frequent; its root is where its forms end.
    """
    words = stored(word_counts(docs, least_letters, least_count, every), "words")
    judged = words.join(near_words(words), "word", "left").withColumn("best_n", -F.col("best.less"))
    form = F.when(F.col("best_n") >= times * F.col("n"), F.col("best.other"))
    judged = stored(
        judged.select(
            "word",
            form.alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(form.isNotNull(), F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    roots = last_forms(judged.filter("form IS NOT NULL").select("word", F.col("form").alias("to")))
    out = judged.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return out.select("word", "form", "root", "n", "n_near", "form_n")


def checksums(rule: int = 0xEDB88320) -> list[int]:
    """The table of the checksum, by its rule."""
    out = []
    for k in range(256):
        for _ in range(8):
            k = (k >> 1) ^ (rule if k & 1 else 0)
        out.append(k)
    return out


ORACLE = f"""
WITH RECURSIVE tab AS MATERIALIZED (SELECT {checksums()} AS t
), runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '{RUN}')), '{UPPER}', '{LOWER}') AS run FROM documents
  ) WHERE length(run) >= 6 GROUP BY 1, 2
), bytes AS (
  SELECT *, flatten([CASE WHEN c < 128 THEN [c] ELSE [192 + (c >> 6), 128 + (c & 63)] END
    FOR c IN [unicode(x) FOR x IN string_split(doc_id || ':' || run, '')]]) AS b
  FROM runs
), hashed AS (
  SELECT doc_id, run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, b::BIGINT[]), lambda a, c: xor(a >> 8, t[1 + (xor(a, c) & 255)]))) AS h
  FROM bytes, tab
), words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN doc_id IS NOT NULL AND h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word
    FROM hashed
  ) WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), cuts AS MATERIALIZED (
  SELECT word, n, k, substr(word, 1, k - 1) || substr(word, k + 1) AS rest FROM words, unnest(range(1, length(word) + 1)) r(k)
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.k = b.k AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, min(struct_pack(less := -other_n, other := other)) AS best FROM near GROUP BY word
), forms AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.less >= 5 * w.n THEN best.other END AS form, CASE WHEN -best.less >= 5 * w.n THEN -best.less END AS form_n
  FROM words w LEFT JOIN best ON best.word = w.word
), chain AS (
  SELECT word, word AS root FROM forms
  UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL
), ends AS (
  SELECT c.word, c.root FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NULL
)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM forms f JOIN ends e ON e.word = f.word
"""
