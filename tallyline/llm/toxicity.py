"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is the embedding of the word (one shared entry for rare words) beside the mean
embedding of its character n-grams, three to five bytes long and within marks for its ends. The first
number of an embedding starts as the log odds of toxic documents that have the word or n-gram, drawn
towards zero where few documents have it; training goes on from there. Two recurrent passes read each window of WINDOW words; attention
gates choose the states, and their mean and their total weight give the evidence of the window.
Windows overlap, cover whole texts, and all are scored. In training the log odds of a document are a
constant plus the softplus of the evidence of each window. In a score, only what lies above a floor
counts, and of that the best run of RUN neighbouring windows. The floor is the evidence that CLEAN_PASSES
windows of a clean text of that length pass on average, so it rises with the length of the text: clean text
stays clean however much of it there is. Beyond the sampled windows the floor follows an exponential tail.

Training runs on the driver over a bounded sample of labelled rows: at most SAMPLE_TOXIC toxic and
SAMPLE_CLEAN clean ones, those with the smallest hash of doc_id, and at most SAMPLE_BYTES of text; texts
of more than SAMPLE_TEXT bytes teach nothing, so that none of them can fill the sample. At
the end the log odds are scaled and moved so that they fit the shares that the classes have among all
labelled rows. Scoring is a single pass
over the documents with a small broadcast network; the inputs of distinct words are projected once a
task, in a bounded cache.

Null and empty texts are one window without words; very long texts are scored whole, their windows 2,000 at
a time. An empty table gives no rows; extra columns pass through, those named like a new one are replaced. Labels that are null or of unknown documents are
not used; without both classes the score is the share of toxic labels (0 without labels). Repeated
documents are scored once each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallyline.llm.bpe import added, schema_with
from tallyline.llm.quality_gam import remainder
from tallyline.llm.storage import stored
from tallyline.llm.textbytes import mix, tidy, utf8

WINDOW, STRIDE = 32, 24
WORD_DIM = CHAR_DIM = HIDDEN = 8
GRAMS, GRAM_SIZES = 1 << 16, (3, 4, 5)
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_BYTES, SAMPLE_TEXT = 1000, 1500, 16_000_000, 500_000
#: The clean windows whose evidence counts, on average over clean texts of any one length; the least
#: number and share of clean windows that the tail of their evidence is fitted to; and the neighbouring
#: windows that make up the score of a text.
CLEAN_PASSES, TAIL_LEAST, TAIL_SHARE, RUN = 0.1, 10, 0.001, 8

LEAST_DOCS, SHRINK, STEPS, BATCH, RATE = 5, 5.0, 250, 32, 0.015
CACHE_WORDS = 100_000
THRESHOLD = 0.7
WORD = re.compile(r"\w+")


class Grams(NamedTuple):
    """The hashed n-grams of words in a row, and where each word's begin."""

    code: np.ndarray
    at: np.ndarray

    def per_word(self) -> np.ndarray:
        return np.diff(np.append(self.at, len(self.code)))


def word_grams(words: list[str]) -> Grams:
    """All n-grams of each word within marks for both ends; every word has at least one."""
    data, at = utf8(pa.array([f"\2{w}\3" for w in words], pa.string()))
    word = np.repeat(np.arange(len(words)), np.diff(at))
    codes, owners = [], []
    for size in GRAM_SIZES:
        n = max(0, len(data) - size + 1)
        code = np.full(n, size, np.uint64)
        for k in range(size):
            code = (code << np.uint64(8)) | data[k : k + n]
        inside = np.flatnonzero(word[:n] == word[size - 1 :]) if n else np.zeros(0, np.int64)
        codes.append((mix(code[inside]) % np.uint64(GRAMS)).astype(np.int64))
        owners.append(word[inside])
    code, owner = np.concatenate(codes), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return Grams(code[order], np.searchsorted(owner[order], np.arange(len(words))))


def window_rows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, first word (among all words) and words of each window."""
    n = np.maximum(1, -(-(lengths - WINDOW) // STRIDE) + 1)
    doc = np.repeat(np.arange(len(lengths)), n)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    first = k * STRIDE
    return doc, (np.cumsum(lengths) - lengths)[doc] + first, np.minimum(WINDOW, lengths[doc] - first)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(1) / (np.float32(1) + np.exp(-x))


def initial(words: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    size = WORD_DIM + CHAR_DIM
    return {
        "word": normal(words, WORD_DIM, scale=0.1),
        "char": normal(GRAMS, CHAR_DIM, scale=0.1),
        "input": normal(2, size, 3 * HIDDEN, scale=size**-0.5),
        "state": normal(2, HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5),
        "bias": np.zeros((2, 1, 3 * HIDDEN), np.float32),
        "gate": normal(2 * HIDDEN, scale=0.3),
        "gate_bias": np.full(1, -1, np.float32),
        "out": normal(2 * HIDDEN, scale=0.3),
        "mass": np.full(1, 0.5, np.float32),
        "out_bias": np.full(1, -2, np.float32),
        "base": np.full(1, -3, np.float32),
    }


def projected(net: dict, word: np.ndarray, grams: Grams) -> tuple[np.ndarray, np.ndarray]:
    """The inputs x of words, and x times the input weights of both directions."""
    chars = np.add.reduceat(net["char"][grams.code], grams.at) / grams.per_word()[:, None].astype(np.float32)
    x = np.concatenate([net["word"][word], chars.astype(net["char"].dtype)], 1)
    return x, np.matmul(x[None], net["input"]) + net["bias"]


def summed(values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """The sums of the values of each row number."""
    out = np.zeros((rows, values.shape[1]), values.dtype)
    order = np.argsort(row, kind="stable")
    head = np.flatnonzero(np.diff(row[order], prepend=-1))
    if len(head):
        out[row[order[head]]] = np.add.reduceat(values[order], head, axis=0)
    return out


def forward(net: dict, table: np.ndarray, rows: np.ndarray, there: np.ndarray, keep: bool) -> tuple[np.ndarray, list, dict]:
    """Evidence of each window. table: projected words by direction; rows: (2, steps, windows),
    the words in the order in which each direction reads them; there: alike, 1 where there is one."""
    h = np.zeros((2, rows.shape[2], HIDDEN), np.float32)
    states, steps = np.empty((rows.shape[1], *h.shape), np.float32), []
    one, two = np.int64(0), np.int64(1)
    for t in range(rows.shape[1]):
        x = np.stack([table[one][rows[0, t]], table[two][rows[1, t]]])
        u = np.matmul(h, net["state"])
        zr = sigmoid(x[:, :, : 2 * HIDDEN] + u[:, :, : 2 * HIDDEN])
        z, r = zr[:, :, :HIDDEN], zr[:, :, HIDDEN:]
        c = np.tanh(x[:, :, 2 * HIDDEN :] + r * u[:, :, 2 * HIDDEN :])
        step = z * (c - h) * there[:, t, :, None]
        if keep:
            steps.append((h, z, r, c, u[:, :, 2 * HIDDEN :]))
        h = h + step
        states[t] = h
    both = np.concatenate([states[:, 0], states[::-1, 1]], 2)  # steps, windows, 2 * HIDDEN
    mask = there[0]
    a = sigmoid(both @ net["gate"] + net["gate_bias"]) * mask
    weight = a.sum(0)
    context = np.einsum("tw,twh->wh", a, both) / (1 + weight)[:, None]
    e = context @ net["out"] + net["mass"] * np.log1p(weight) + net["out_bias"]
    return e, steps, {"both": both, "a": a, "weight": weight, "context": context, "mask": mask}


def backward(net: dict, de: np.ndarray, steps: list, kept: dict, rows: np.ndarray, there: np.ndarray, words: int) -> tuple[dict, np.ndarray]:
    """Gradients of the network, and of the projected words (by direction and word)."""
    both, a, weight, context = kept["both"], kept["a"], kept["weight"], kept["context"]
    grad = {
        "out": de @ context,
        "mass": np.array([(de * np.log1p(weight)).sum()], np.float32),
        "out_bias": np.array([de.sum()], np.float32),
    }
    dcontext = de[:, None] * net["out"]
    scaled = dcontext / (1 + weight)[:, None]
    dweight = de * net["mass"] / (1 + weight) - (scaled * context).sum(1)
    da = (np.einsum("wh,twh->tw", scaled, both) + dweight) * a * (1 - a)
    grad["gate"] = np.einsum("tw,twh->h", da, both)
    grad["gate_bias"] = np.array([da.sum()], np.float32)
    dboth = a[:, :, None] * scaled + da[:, :, None] * net["gate"]
    dstates = np.stack([dboth[:, :, :HIDDEN], dboth[::-1, :, HIDDEN:]], 1)  # steps, 2, windows, HIDDEN
    grad["state"] = np.zeros_like(net["state"])
    each = np.empty((len(steps), *dstates.shape[1:3], 3 * HIDDEN), np.float32)
    dh = np.zeros_like(dstates[0])
    turned = net["state"].transpose(0, 2, 1)
    for t in range(len(steps) - 1, -1, -1):
        h, z, r, c, uc = steps[t]
        dh = dh + dstates[t]
        mask = there[:, t, :, None]
        dstep = dh * mask
        dc = dstep * z * (1 - c * c)
        dz = dstep * (c - h) * z * (1 - z)
        dr = dc * uc * r * (1 - r)
        du = np.concatenate([dz, dr, dc * r], 2)
        dx = np.concatenate([dz, dr, dc], 2)
        grad["state"] += np.matmul(h.transpose(0, 2, 1), du)
        each[t] = dx
        dh = dh - dstep * z + np.matmul(du, turned)
    dtable = [summed(each[:, k].reshape(-1, 3 * HIDDEN), rows[k].ravel(), words) for k in (0, 1)]
    return grad, np.stack(dtable)


def both_ways(doc: np.ndarray, first: np.ndarray, size: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """rows and there of forward() for windows over the word numbers of texts in a row."""
    slot = np.arange(WINDOW)[:, None]
    there = (slot < size[None]).astype(np.float32)
    place = np.where(there > 0, first[None] + slot, 0)
    rows = words[place] if len(words) else np.zeros(place.shape, np.int64)
    return np.stack([rows, rows[::-1]]), np.stack([there, there[::-1]])


def softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, x)


def log_odds(rows_of_texts: Iterator[np.ndarray], toxic: np.ndarray, rows: int) -> np.ndarray:
    """For each word or n-gram, the log odds of the toxic documents that have it, less those of all,
    drawn towards zero where few have it."""
    n, with_toxic = np.zeros(rows), np.zeros(rows)
    for row, label in zip(rows_of_texts, toxic, strict=True):
        row = np.unique(row)
        n[row] += 1
        with_toxic[row] += label
    base = (toxic.sum() + 1) / (len(toxic) + 2)
    share = (with_toxic + base) / (n + 1)
    odds = np.log(share / (1 - share)) - np.log(base / (1 - base))
    return np.where(n >= LEAST_DOCS, odds * n / (n + SHRINK), 0.0).astype(np.float32)


class Floors(NamedTuple):
    """Evidence that clean windows rarely pass: what so many of the sampled ones pass, and beyond them an
    exponential tail."""

    largest: np.ndarray
    sampled: int
    tail: float
    mean: float

    @classmethod
    def of(cls, clean: np.ndarray) -> Floors:
        falling = -np.sort(-clean.astype(float))
        tail = min(len(falling), max(TAIL_LEAST, int(TAIL_SHARE * len(falling))))
        over = falling[:tail] - falling[tail - 1]
        return cls(falling[: max(tail, int(CLEAN_PASSES * len(falling)))], len(falling), tail, float(over.mean()))

    def at(self, windows: np.ndarray) -> np.ndarray:
        """For texts of so many windows, the evidence that CLEAN_PASSES of them pass if all are clean."""
        passing = CLEAN_PASSES / np.maximum(1, windows) * self.sampled
        within = np.interp(passing, np.arange(1, len(self.largest) + 1), self.largest)
        beyond = self.largest[self.tail - 1] + self.mean * np.log(self.tail / passing)
        return np.where(passing < self.tail, beyond, within)


def calibrated(logit: np.ndarray, toxic: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Scale and move of the log odds that fit the weighted rows best, by Newton steps."""
    x = np.stack([logit, np.ones_like(logit)], 1)
    fit = np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ fit, -30, 30)))
        slope = x.T @ (weights * (p - toxic)) + 0.01 * (fit - [1, 0])
        bend = (x * (weights * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(2)
        fit = fit - np.clip(np.linalg.solve(bend, slope), -2, 2)
    return float(max(fit[0], 0.05)), float(fit[1])


def train(texts: list[str], toxic: np.ndarray, weights: np.ndarray, seed: int = 7) -> dict:
    """A network from labelled texts; weights are those of the rows for the calibration."""
    rng = np.random.default_rng(seed)
    distinct: dict[str, int] = {}
    coded = [np.array([distinct.setdefault(w, len(distinct)) for w in WORD.findall(t.lower())], np.int32) for t in texts]
    seen = np.zeros(len(distinct), np.int64)
    for words in coded:
        seen[np.unique(words)] += 1
    known = np.cumsum(seen >= LEAST_DOCS) * (seen >= LEAST_DOCS)  # 0 for the rare ones
    vocabulary = {w: int(k) for w, k in zip(distinct, known, strict=True) if k}
    net = initial(len(vocabulary) + 1, rng)
    every = word_grams(list(distinct))
    every, many = every._replace(code=every.code.astype(np.int32)), every.per_word()
    del distinct

    def grams_of(used: np.ndarray) -> Grams:
        n = many[used]
        at = np.cumsum(n) - n
        return Grams(every.code[np.repeat(every.at[used] - at, n) + np.arange(n.sum())], at)

    if len(seen):
        net["word"][1:, 0] += log_odds((known[w] for w in coded), toxic, len(vocabulary) + 1)[1:]
        net["char"][:, 0] += log_odds((grams_of(np.unique(w)).code for w in coded), toxic, GRAMS)
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.items()}
    count, batches = 0, max(1, len(texts) // BATCH)
    while count < STEPS and len(seen):
        order = rng.permutation(len(texts))
        for part in range(batches):
            chosen = order[part::batches]
            used, local = np.unique(np.concatenate([coded[k] for k in chosen]), return_inverse=True)
            count += 1
            if not len(used):
                continue
            doc, first, size = window_rows(np.array([len(coded[k]) for k in chosen]))
            rows, there = both_ways(doc, first, size, local)
            grams = grams_of(used)
            x, table = projected(net, known[used], grams)
            e, steps, kept = forward(net, table, rows, there, True)
            logit = net["base"] + np.bincount(doc, softplus(e), len(chosen))
            miss = ((1 / (1 + np.exp(-logit)) - toxic[chosen]) / len(chosen)).astype(np.float32)
            grad, dtable = backward(net, (miss[doc] * sigmoid(e)).astype(np.float32), steps, kept, rows, there, len(used))
            grad["base"] = np.array([miss.sum()], np.float32)
            grad["bias"] = dtable.sum(1, keepdims=True)
            grad["input"] = np.matmul(x.T[None], dtable)
            dx = np.matmul(dtable, net["input"].transpose(0, 2, 1)).sum(0)
            grad["word"] = summed(dx[:, :WORD_DIM], known[used], len(net["word"]))
            n = grams.per_word()
            grad["char"] = summed(np.repeat(dx[:, WORD_DIM:] / n[:, None].astype(np.float32), n, axis=0), grams.code, GRAMS)
            size = max(1e-9, float(np.sqrt(sum((g * g).sum() for g in grad.values()))))
            rate = RATE * max(0.1, 1 - count / STEPS) * (1 - 0.999**count) ** 0.5 / (1 - 0.9**count)
            for k, g in grad.items():
                m, v = moments[k]
                g = g * min(1.0, 1 / size)
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                net[k] = net[k] - (rate * m / (np.sqrt(v) + 1e-7)).astype(np.float32)
    model = {"net": net, "vocabulary": vocabulary, "floors": Floors(np.zeros(1), 1, 1, 0.0), "scale": 1.0, "move": 0.0}
    scorer = Scorer(model)
    clean = [t for t, y in zip(texts, toxic, strict=True) if not y]
    found = [scorer.windows(clean[k : k + 100])[1] for k in range(0, len(clean), 100)]
    if found:
        model["floors"] = scorer.floors = Floors.of(np.concatenate(found))
    odds = np.concatenate([scorer.log_odds(texts[k : k + 100]) for k in range(0, len(texts), 100)])
    model["scale"], model["move"] = calibrated(odds, toxic, weights)
    return model


class Scorer:
    """Scores texts with a trained network; keeps the projections of a bounded number of words."""

    def __init__(self, model: dict):
        self.net, self.vocabulary, self.known = model["net"], model["vocabulary"], {}
        self.floors, self.scale, self.move = model["floors"], model["scale"], model["move"]
        self.table = np.zeros((2, 0, 3 * HIDDEN), np.float32)
        self.room = 0

    def learn(self, words: list[str]) -> None:
        if len(self.known) + len(words) > CACHE_WORDS:
            self.known.clear()
        need = len(self.known) + len(words)
        if need > self.room:
            self.room = max(min(2 * need, CACHE_WORDS + len(words)), 20_000)
            grown = np.zeros((2, self.room, 3 * HIDDEN), np.float32)
            grown[:, : self.table.shape[1]] = self.table
            self.table = grown
        at = len(self.known)
        ids = np.array([self.vocabulary.get(w, 0) for w in words], np.int64)
        self.table[:, at : at + len(words)] = projected(self.net, ids, word_grams(words))[1]
        self.known.update(zip(words, range(at, at + len(words)), strict=True))

    def score(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.scale * self.log_odds(texts) + self.move)))

    def log_odds(self, texts: list[str | None]) -> np.ndarray:
        """What the windows of each text say beyond what clean windows say, added up over the RUN
        neighbouring ones that say most. Of more windows, the most clean one says more, so the floor
        rises with their number, and a text is no worse for being long."""
        doc, said = self.windows(texts)
        floor = self.floors.at(np.bincount(doc, minlength=len(texts)))
        beyond = np.cumsum(np.maximum(0, said.astype(float) - floor[doc]), dtype=float)
        first = np.maximum(np.arange(len(doc)) - RUN + 1, np.searchsorted(doc, doc))
        most = np.zeros(len(texts))
        np.maximum.at(most, doc, beyond - np.where(first > 0, beyond[first - 1], 0.0))
        return float(self.net["base"][0]) + most

    def windows(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The text of each window, and its evidence, which is never below zero."""
        split = [WORD.findall(t.lower()) if t else [] for t in texts]
        known = self.known
        every = set().union(*split)
        fresh = every.difference(known)
        if fresh:
            self.learn(list(fresh if len(known) + len(fresh) <= CACHE_WORDS else every))
        words = np.fromiter(map(known.__getitem__, chain.from_iterable(split)), np.int64)
        doc, first, size = window_rows(np.array([len(w) for w in split], np.int64))
        evidence = np.empty(len(doc), np.float32)
        for a in range(0, len(doc), 2000):
            cut = slice(a, a + 2000)
            rows, there = both_ways(doc[cut], first[cut], size[cut], words)
            evidence[cut] = forward(self.net, self.table, rows, there, False)[0]
        return doc, softplus(evidence)


def fit(docs: DataFrame, labels: DataFrame) -> dict | float:
    """A network from the labelled rows outside the held-out third, or the share of toxic labels."""
    known = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).dropna()
    known = known.filter(remainder("doc_id", 3) != 1).withColumn("toxic", (F.col("toxic") > 0).cast("int"))
    shares = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(shares) < 2:
        return float(next(iter(shares), 0))
    spark = docs.sparkSession
    limits = {1: SAMPLE_TOXIC, 0: SAMPLE_CLEAN}
    chosen = [known.filter(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for k, n in limits.items()]
    ids = spark.createDataFrame(chosen[0].unionAll(chosen[1]).collect(), known.schema)  # bounded by limits
    rows = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(ids), "doc_id").filter(F.octet_length("text") <= SAMPLE_TEXT)
    # One row a document, however often it is given, so no more rows than the limits.
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("text", "toxic")).alias("first")).select("doc_id", "first.*")
    rows = stored(rows, "sample")
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(order), F.lit(0))
    sizes = rows.select("doc_id", F.octet_length("text").alias("size")).withColumn("before", before)
    taken = sizes.filter(F.col("before") < SAMPLE_BYTES).select("doc_id", "before")
    sample = rows.join(F.broadcast(taken), "doc_id").orderBy("before").collect()
    texts, y = [r["text"] for r in sample], np.array([r["toxic"] for r in sample], float)
    if len(np.unique(y)) < 2:
        return shares[1] / sum(shares.values())
    share = shares[1] / sum(shares.values())
    weights = np.where(y > 0, share / y.mean(), (1 - share) / (1 - y.mean()))
    return train(texts, y, weights)


def scored(docs: DataFrame, model: dict | float) -> DataFrame:
    """The rows with their score. model is a small network, whatever the number of documents."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value) if isinstance(shared.value, dict) else None
        for whole in batches:
            for first in range(0, whole.num_rows, 100):
                batch = whole.slice(first, 100)
                texts = batch.column(batch.schema.names.index("text")).to_pylist()
                score = scorer.score(texts) if scorer else np.full(len(texts), shared.value)
                yield added(batch, {"score": pa.array(score.astype(float))})

    return docs.mapInArrow(tidy(run), schema_with(docs, score=T.DoubleType()))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows with held_out, score and predicted."""
    return scored(docs, fit(docs, labels)).withColumns(
        {
            "held_out": F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)),
            "predicted": (F.col("score") >= threshold).cast("int"),
        }
    )
