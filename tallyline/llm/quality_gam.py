"""Quality classifier: a generalised additive model with pairwise interactions.

Features of every text are measured once, in numpy, and stored. On a bounded sample of labelled rows
the features are cut into quantile bins, and cyclic boosting visits one feature after another: a
shallow tree over its bins is fitted to the gradient and added to the feature's lookup table. The
pairs whose coarse two-way tables explain most of what is left get tables of their own, boosted
alike. A score adds one table entry for each feature and pair and goes through the logistic function.

At most `SAMPLE_ROWS` labelled rows are used, those with the smallest hash of doc_id. Null and empty
texts have all features zero and are scored as such. Labels that are null, or of unknown documents,
are not used; without any label, or with one class only, the score is a constant. Repeated documents
are scored once each; repeated labels count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.quality_rules import base_counts
from tallyline.llm.storage import stored
from tallyline.llm.textbytes import SPACES, Spans, blocks, mix, per_text, runs, table, tidy, utf8

SAMPLE_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 48, 12, 6
ROUNDS, RATE, LEAST = 150, 0.1, 8.0
THRESHOLD = 0.3

UPPER, LOWER, DIGITS = table([(65, 90)]), table([(97, 122)]), table([(48, 57)])
MARKS = table([(33, 47), (58, 64), (91, 96), (123, 126)])
FEATURES = (
    "log_words", "word_length", "symbols", "upper", "digits", "marks", "bars", "shouts", "wide",
    "dup_lines", "repeated", "distinct", "line_length", "bare_words", "long_words", "ends", "same_line",
)


def features(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A row of FEATURES for each text of a block; all are shares or logarithms."""
    n = len(at) - 1
    base = base_counts(data, at)
    start, end, doc = runs(~SPACES[data], at)
    words = np.maximum(1, base["n_words"])
    size = np.maximum(1, np.diff(at))
    spans = Spans(data)
    key = mix(spans.hashes(start, end) ^ mix(doc.astype(np.uint64) + np.uint64(1)))
    _, first = np.unique(key, return_index=True)
    alpha = UPPER[data] | LOWER[data] | (data >= 0x80)
    sums = np.concatenate([[0], np.cumsum(alpha)])
    bare = sums[end] == sums[start]
    close = MARKS[data[end - 1]] if len(end) else np.zeros(0, bool)
    line_start, line_end, line_doc = runs(data != 10, at)
    lines = np.maximum(1, np.bincount(line_doc, minlength=n))
    letters = np.maximum(1, per_text(UPPER[data] | LOWER[data], at))
    columns = [
        np.log1p(base["n_words"]),
        base["word_chars"] / words,
        base["n_symbols"] / words,
        per_text(UPPER[data], at) / letters,
        per_text(DIGITS[data], at) / size,
        per_text(MARKS[data], at) / size,
        per_text(data == 0x7C, at) / words,
        per_text(data == 0x21, at) / words,
        per_text(data >= 0xC0, at) / size,
        base["n_dup_lines"] / lines,
        base["n_repeat_words"] / words,
        np.bincount(doc[first], minlength=n) / words,
        np.log1p(words / lines),
        np.bincount(doc[bare], minlength=n) / words,
        np.bincount(doc[end - start > 20], minlength=n) / words,
        np.bincount(doc[close], minlength=n) / words,
        np.log1p(base["n_dup_lines"]),
    ]
    out = np.stack(columns, 1).astype(np.float32)
    out[base["n_words"] == 0] = 0
    return out


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and x, the features, of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = utf8(batch.column(1))
            out = np.zeros((batch.num_rows, len(FEATURES)), np.float32)
            for a, b in blocks(at):
                out[a:b] = features(data[at[a] : at[b]], at[a : b + 1] - at[a])
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(FEATURES))
            lists = pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(run), "doc_id long, x array<float>")


def tree(gradient: np.ndarray, weight: np.ndarray, leaves: int = 4) -> np.ndarray:
    """The values of a tree of so many leaves over ordered bins, from sums in each bin."""
    cuts = [0, len(gradient)]
    g, w = np.concatenate([[0], np.cumsum(gradient)]), np.concatenate([[0], np.cumsum(weight)])

    def gain(a: int, b: int) -> float:
        return (g[b] - g[a]) ** 2 / (w[b] - w[a] + 1e-9)

    while len(cuts) <= leaves:
        best = (1e-9, None)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            for c in range(a + 1, b):
                if w[c] - w[a] >= LEAST / 8 and w[b] - w[c] >= LEAST / 8:
                    best = max(best, (gain(a, c) + gain(c, b) - gain(a, b), c))
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(gradient))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        out[a:b] = (g[b] - g[a]) / (w[b] - w[a] + 1.0)
    return out


def plane_tree(gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A tree over a two-way table: one cut of the first axis, then a tree of the second on each side."""
    best, out = -1.0, None
    for turned in (False, True):
        g, w = (gradient.T, weight.T) if turned else (gradient, weight)
        gs, ws = np.cumsum(g, 0), np.cumsum(w, 0)
        for c in range(1, len(g)):
            halves = [(gs[c - 1], ws[c - 1]), (gs[-1] - gs[c - 1], ws[-1] - ws[c - 1])]
            if min(h[1].sum() for h in halves) < LEAST / 8:
                continue
            parts = [tree(a, b, 2) for a, b in halves]
            worth = sum((p * a).sum() for p, (a, _) in zip(parts, halves, strict=True))
            if worth > best:
                made = np.concatenate([np.repeat(parts[0][None], c, 0), np.repeat(parts[1][None], len(g) - c, 0)])
                best, out = worth, made.T if turned else made
    return np.zeros_like(gradient) if out is None else out


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, k], "right") for k, e in enumerate(edges)], 1)


def train(x: np.ndarray, y: np.ndarray) -> dict:
    """Edges and lookup tables; of one class or no rows, a constant."""
    chance = float(y.mean()) if len(y) else 0.5
    if len(y) == 0 or chance in (0.0, 1.0):
        return {"base": float(np.log((chance + 0.01) / (1.01 - chance))), "edges": [], "tables": [], "pairs": []}
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(x.shape[1])]
    coarse = [e[np.unique(np.linspace(0, len(e) - 1, min(len(e), PAIR_BINS - 1)).astype(int))] if len(e) else e for e in edges]
    fine, wide = binned(x, edges), binned(x, coarse)
    base = float(np.log(chance / (1 - chance)))
    total = np.full(len(y), base)
    tables = [np.zeros(len(e) + 1) for e in edges]

    def slope() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for k, values in enumerate(tables):
            g, w = slope()
            step = RATE * tree(np.bincount(fine[:, k], g, len(values)), np.bincount(fine[:, k], w, len(values)))
            values += step
            total += step[fine[:, k]]
    g, w = slope()
    worth = []
    for a, b in combinations(range(x.shape[1]), 2):
        shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
        cell = wide[:, a] * shape[1] + wide[:, b]
        gs, ws = (np.bincount(cell, v, shape[0] * shape[1]) for v in (g, w))
        worth.append(((gs**2 / (ws + 1)).sum(), a, b, shape))
    pairs = [(a, b, np.zeros(shape)) for _, a, b, shape in sorted(worth, key=lambda r: (-r[0], r[1], r[2]))[:PAIRS]]
    for _ in range(ROUNDS // 3):
        for a, b, values in pairs:
            g, w = slope()
            cell = wide[:, a] * values.shape[1] + wide[:, b]
            sums = [np.bincount(cell, v, values.size).reshape(values.shape) for v in (g, w)]
            step = RATE * plane_tree(*sums)
            values += step
            total += step.ravel()[cell]
    return {"base": base, "edges": edges, "coarse": coarse, "tables": tables, "pairs": pairs}


def chances(model: dict, x: np.ndarray) -> np.ndarray:
    """Bin additions, then the logistic function."""
    total = np.full(len(x), model["base"])
    if model["edges"]:
        fine, wide = binned(x, model["edges"]), binned(x, model["coarse"])
        for k, values in enumerate(model["tables"]):
            total += values[fine[:, k]]
        for a, b, values in model["pairs"]:
            total += values[wide[:, a], wide[:, b]]
    return 1 / (1 + np.exp(-total))


def remainder(doc_id: str, of: int) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % of


def classify(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    rows = stored(measured(docs), "features")
    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int")).dropna()
    known = known.filter(remainder("doc_id", 5) != 0).join(rows, "doc_id")
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample_rows).select("x", "quality").toArrow()
    y = sample.column("quality").to_numpy().astype(float)
    x = sample.column("x").combine_chunks()
    x = np.asarray(x.flatten(), np.float32).reshape(len(y), len(FEATURES))
    model = docs.sparkSession.sparkContext.broadcast(train(x, (y > 0).astype(float)))  # a few tables

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            score = chances(model.value, flat.reshape(batch.num_rows, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["doc_id", "score"])

    scored = rows.mapInArrow(tidy(run), "doc_id long, score double")
    return scored.select(
        "doc_id",
        F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
