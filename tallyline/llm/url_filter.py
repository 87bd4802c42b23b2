"""URLs judged by rules, and those that no rule fits by a ratio of two character language models.

A rule names a host, with its subdomains, and the beginning of a path; the longest that fits decides.
The URLs that rules allow or block teach two Markov models over the characters of host and path, one for
each verdict. Their order varies: a sequence of characters counts as context, up to ORDER characters,
wherever it was seen often enough (LEAST times beyond pairs), and each prediction blends all known
contexts from the shortest to the longest, each giving the shorter one as much weight as it has distinct
followers (Witten and Bell). A URL's score is the difference of its log-likelihoods by the two models,
divided by its characters and the end mark. One in FOLD labelled texts teaches no model; on these a
logistic curve is fitted, with both verdicts of equal weight, from a histogram of their scores. What has
a chance of at least one half is allowed.

Counting and scoring take the same way at every size. Counts of all labelled URLs are added up by 64-bit
hashes of sequences, in each batch first, so a common host costs a row a batch. To score, URLs lie in
parts of PART rows, or one where they are long; each part asks for its distinct sequences, these meet
the model in a join by hash, and what is found goes back to its part. Nothing of the model passes
through the driver, nor through one task; the driver gets the histogram, at most 2 x 40,001 rows.

Null URLs and those without `://` have an empty host and path, which no rule fits and the models judge
by their end mark alone. Rows without a page_id and repeated rows are judged like others and kept.
Without URLs that a rule allows, or blocks, all others get the verdict of those there are; without
either they are allowed. An empty table gives no rows. A long URL is read in pieces of STEP characters.
Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.storage import stored
from tallyline.llm.textbytes import ROOT, mix, tidy

#: Verdict and rule, a host followed by the beginning of a path.
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]

ORDER, LEAST, FOLD = 5, 2, 5
PART, STEP, LONG = 2048, 200_000, 4096

#: Marks of beginning and end, beyond all code points, and how many symbols there are in all.
BEGIN, END = 0x110000, 0x110001
SYMBOLS = END + 1
EMPTY = np.uint64(0x9AE16A3B2F90404F)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: How fine and how far the histogram of scores reaches.
GRAIN, FAR = 1000, 20

COUNTS = ["n_allow", "n_block", "t_allow", "t_block", "d_allow", "d_block"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, with A-Z in lower case, and the path after it; both empty where there is no ://."""
    found = [F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)([^?#]*)", k), F.lit("")) for k in (1, 2)]
    return F.translate(found[0], UPPER, LOWER), found[1]


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null without one."""
    which = verdict = F.lit(None).cast("string")
    for said, rule in sorted(rules, key=lambda r: len(r[1])):
        name, _, start = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{start}")
        which, verdict = F.when(fits, F.lit(rule)).otherwise(which), F.when(fits, F.lit(said)).otherwise(verdict)
    return which, verdict


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in a row, each between its marks, and for each symbol the place of its text's begin mark."""
    size = np.fromiter(map(len, texts), np.int64, len(texts)) + 2
    begin = np.cumsum(size) - size
    codes = np.empty(int(size.sum()), np.int64)
    inner = np.ones(len(codes), bool)
    inner[begin] = inner[begin + size - 1] = False
    codes[begin], codes[begin + size - 1] = BEGIN, END
    codes[inner] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    return codes, np.repeat(begin, size)


def sequences(codes: np.ndarray, begin: np.ndarray, order: int) -> Iterator[tuple[slice, list[np.ndarray]]]:
    """For pieces of the row: the places, and the hashes of the 0, 1, ... symbols that end at each.

    A hash is zero where the sequence would begin before its text. Pieces have the last symbol of the
    one before them as their first, whose sequences are contexts only.
    """
    for a in range(0, len(codes), STEP):
        far = max(0, a - order - 1)
        near = max(0, a - 1) - far
        part = codes[far : a + STEP].astype(np.uint64)
        room = np.arange(far, far + len(part)) - begin[far : a + STEP] + 1
        rows = [np.full(len(part), EMPTY)]
        for size in range(1, order + 2):
            before = np.concatenate([[EMPTY], rows[-1][:-1]])
            hashed = mix(before * np.uint64(ROOT) + part)
            rows.append(np.where(room >= size, hashed | np.uint64(1), np.uint64(0)))
        yield slice(far + near, far + len(part)), [r[near:] for r in rows]


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def taught(urls: DataFrame, order: int) -> DataFrame:
    """z, parent, size and how often URLs (text, label) of either verdict have the sequence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, begin = symbols(batch.column(0).to_pylist())
            text = np.cumsum(codes == BEGIN) - 1
            allowed = (batch.column(1).to_numpy(zero_copy_only=False) == "allow")[text]
            for at, rows in sequences(codes, begin, order):
                told = codes[at][1:] != BEGIN
                good = allowed[at][1:][told]
                for size in range(1, order + 2):
                    z, parent = rows[size][1:][told], rows[size - 1][:-1][told]
                    there = z != 0
                    z, where, back = np.unique(z[there], return_index=True, return_inverse=True)
                    n = np.bincount(back, good[there], len(z)), np.bincount(back, ~good[there], len(z))
                    yield pa.RecordBatch.from_arrays(
                        [signed(z), signed(parent[there][where]), pa.array(np.full(len(z), size, np.int32)), *[pa.array(x.astype(np.int64)) for x in n]],
                        names=["z", "parent", "size", "n_allow", "n_block"],
                    )

    return urls.select("text", "label").mapInArrow(tidy(run), "z long, parent long, size int, n_allow long, n_block long")


def model(urls: DataFrame, order: int = ORDER, least: int = LEAST) -> DataFrame:
    """z and, by verdict, its count, that of what follows it, and how many distinct symbols do."""
    grams = taught(urls, order).groupBy("z", "parent", "size").agg(F.sum("n_allow").alias("n_allow"), F.sum("n_block").alias("n_block"))
    grams = stored(grams.filter((F.col("size") <= 2) | (F.col("n_allow") + F.col("n_block") >= least)), "sequences")
    none = F.lit(0).cast("long")
    follow = grams.groupBy(F.col("parent").alias("z")).agg(
        F.sum("n_allow").alias("t_allow"),
        F.sum("n_block").alias("t_block"),
        F.count_if(F.col("n_allow") > 0).alias("d_allow"),
        F.count_if(F.col("n_block") > 0).alias("d_block"),
    )
    own = grams.select("z", "n_allow", "n_block", *[none.alias(c) for c in COUNTS[2:]])
    both = own.unionByName(follow.select("z", *[none.alias(c) for c in COUNTS[:2]], *COUNTS[2:]))
    return both.groupBy("z").agg(*[F.sum(c).alias(c) for c in COUNTS])


def asked(urls: DataFrame, order: int) -> DataFrame:
    """part and z of the sequences in its texts; about once each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column(0).to_numpy()
            for part in np.unique(parts):
                mine = np.flatnonzero(parts == part)
                codes, begin = symbols(batch.column(1).take(pa.array(mine)).to_pylist())
                for _, rows in sequences(codes, begin, order):
                    z = np.unique(np.concatenate([r[r != 0] for r in rows]))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(z), part)), signed(z)], names=["part", "z"])

    return urls.select("part", "text").mapInArrow(tidy(run), "part long, z long")


def differences(texts: list[str], known: pa.Table, order: int) -> np.ndarray:
    """Each text's difference of log-likelihoods by symbol, from the counts (z, COUNTS) known of it."""
    key = known.column("z").to_numpy().view(np.uint64)
    key, first = np.unique(key, return_index=True)
    counts = np.stack([known.column(c).to_numpy()[first] for c in COUNTS], 1).astype(float)
    key, counts = np.append(key, np.uint64(2**64 - 1)), np.vstack([counts, np.zeros(len(COUNTS))])

    def looked(z: np.ndarray) -> np.ndarray:
        at = np.searchsorted(key, z)
        return np.where((key[np.minimum(at, len(key) - 1)] == z)[:, None], counts[np.minimum(at, len(key) - 1)], 0.0)

    codes, begin = symbols(texts)
    total = np.zeros(len(codes))
    for at, rows in sequences(codes, begin, order):
        chance = np.full((len(rows[0]) - 1, 2), 1.0 / SYMBOLS)
        for size in range(order + 1):
            n, context = looked(rows[size + 1][1:])[:, :2], looked(rows[size][:-1])
            t, d = context[:, 2:4], context[:, 4:]
            seen = (t > 0) & (rows[size + 1][1:] != 0)[:, None]
            chance = np.where(seen, (n + d * chance) / np.where(seen, t + d, 1.0), chance)
        gain = np.log(chance[:, 0]) - np.log(chance[:, 1])
        total[at][1:] = np.where(codes[at][1:] != BEGIN, gain, 0.0)
    text = np.cumsum(codes == BEGIN) - 1
    return np.bincount(text, total, len(texts)) / np.maximum(1, np.bincount(text, minlength=len(texts)) - 1)


def scored(urls: DataFrame, learned: DataFrame, order: int) -> DataFrame:
    """The rows (part, text, ...) with their difference."""
    found = asked(urls, order).join(learned, "z")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        texts = left.column("text").to_pylist()
        return left.append_column("difference", pa.array(differences(texts, right, order), pa.float64()))

    kind = urls.withColumn("difference", F.lit(0.0)).schema
    return urls.groupBy("part").cogroup(found.groupBy("part")).applyInArrow(run, kind)


def curve(bins: list[tuple[float, str, int]]) -> tuple[float, float] | None:
    """Slope and shift of the logistic curve for (score, verdict, count), both verdicts weighing alike."""
    x = np.array([b[0] for b in bins], float)
    y = np.array([b[1] == "allow" for b in bins], float)
    n = np.array([b[2] for b in bins], float)
    if not len(x) or not 0 < y.mean() < 1:
        return None
    weight = n * np.where(y > 0, 0.5 / n[y > 0].sum(), 0.5 / n[y == 0].sum())
    at, design = np.zeros(2), np.stack([x, np.ones_like(x)], 1)
    ridge = 1e-4 * np.eye(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ at, -500, 500)))
        slope = design.T @ (weight * (p - y)) + ridge @ at
        step = np.linalg.solve(design.T @ (design * (weight * p * (1 - p))[:, None]) + ridge, slope)
        at = at - step * min(1.0, 5 / max(1e-12, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-9:
            break
    return float(at[0]), float(at[1])


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, order: int = ORDER, least: int = LEAST) -> DataFrame:
    """page_id, host, path, rule, verdict and score (the chance that a rule would allow it) of each page."""
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    parsed = parsed.select("*", rule.alias("rule"), verdict.alias("label"), F.concat("host", "path").alias("text"))
    rows = stored(parsed.withColumn("row", F.monotonically_increasing_id()), "urls")
    by_hash = F.pmod(F.xxhash64("text"), F.lit(FOLD)) == 0
    learned = stored(model(rows.filter(F.col("label").isNotNull() & ~by_hash), order, least), "model")
    # Rows of one partition are numbered one after another, so parts need no shuffle to be told.
    part = F.when(F.length("text") > LONG, -1 - F.col("row")).otherwise(F.shiftright("row", PART.bit_length() - 1))
    judged = stored(scored(rows.withColumn("part", part).drop("row"), learned, order), "scores")
    grain = F.round(F.greatest(F.lit(-FAR), F.least(F.lit(FAR), "difference")) * GRAIN).cast("int")
    bins = judged.filter(F.col("label").isNotNull() & by_hash).groupBy(grain.alias("bin"), "label").count()
    fitted = curve([(r["bin"] / GRAIN, r["label"], r["count"]) for r in bins.orderBy("bin", "label").collect()])
    said = {r["label"] for r in rows.select("label").distinct().collect()} - {None}
    if len(said) < 2:
        chance = F.lit(0.0 if said == {"block"} else 1.0)
    else:
        slope, shift = fitted if fitted and fitted[0] > 0 else (1.0, 0.0)
        chance = 1 / (1 + F.exp(-(F.lit(slope) * F.col("difference") + F.lit(shift))))
    own = F.when(F.col("score") >= 0.5, "allow").otherwise("block")
    return judged.withColumn("score", chance).select("page_id", "host", "path", "rule", F.coalesce("label", own).alias("verdict"), "score")


#: Host, path, the longest rule that fits, and what it says.
RULES_ORACLE = r"""
WITH rules(said, rule) AS (
  VALUES ('allow', 'org/'), ('block', 'example.org/es/'), ('block', 'example.org/en/1'), ('allow', 'com/fr/'), ('block', 'com/de/')
), parsed AS (
  SELECT row_number() OVER () AS r, page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), fitting AS (
  SELECT r, arg_max(rule, length(rule)) AS rule, arg_max(said, length(rule)) AS rule_verdict
  FROM parsed JOIN rules
    ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
    AND starts_with(path, substr(rule, strpos(rule, '/')))
  GROUP BY r
)
SELECT page_id, host, path, rule, rule_verdict FROM parsed LEFT JOIN fitting USING (r)
"""
