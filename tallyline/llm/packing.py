"""Best-fit packing of tokenized documents by length patterns.

Only the histogram of piece lengths (at most `size` numbers) reaches the driver. There, patterns of
one, two or three lengths that fill a sequence exactly are enumerated, their repeat counts are fitted
to the histogram by non-negative least squares and rounded down, and what is left is packed best fit,
longest first, whole groups of equal sequences at a time. The plan has a row for each kind of
sequence, never one for each document. Pieces get a number among those of their length by window
functions over hash buckets, so a length that a third of all pieces have is still spread out, and
find their place in the plan by that number.

Null and empty texts are one id long (the closing id). Repeated rows are packed once each.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from tallyline.llm.bpe import TEXTS_AT_ONCE, PieceCache, list_array
from tallyline.llm.matcher import BEYOND, Matcher
from tallyline.llm.textbytes import tidy

SIZE = 2048
PIECES_PER_BUCKET = 4_000
PIECE_COLUMNS = "doc_id long, piece int, start long, length long, ids_crc32 long"

Plan = list[tuple[tuple[int, ...], int]]


def word_pattern(spec: dict) -> str:
    """The expression of the split step, whose matches are the words."""
    steps = spec["pre_tokenizer"]["pretokenizers"]
    return next(s["pattern"]["Regex"] for s in steps if s["type"] == "Split")


def word_tokenizer(whole: str) -> Tokenizer:
    """The tokenizer for single words: without the steps that normalize and split texts."""
    spec = json.loads(whole)
    steps = spec["pre_tokenizer"]["pretokenizers"]
    spec["normalizer"], spec["pre_tokenizer"] = None, next(s for s in steps if s["type"] == "ByteLevel")
    made = Tokenizer.from_str(json.dumps(spec))
    made.encode_special_tokens = True
    return made


def pieces(docs: DataFrame, path: str, size: int = SIZE, closing: int = 0, with_ids: bool = False, added_vocabulary: bool = False) -> DataFrame:
    """A row for each piece of each document's ids: its place, its length and its checksum.

    The ids are those of the tokenizer file without special tokens, and the closing id. With
    added_vocabulary, the content of an added token in a text becomes its id, as the library has it by
    default, else plain pieces. Only documents longer than size are cut.
    """
    whole = Tokenizer.from_file(path).to_str()
    pattern = word_pattern(json.loads(whole))
    tokens = [t["content"].lower() for t in json.loads(whole)["added_tokens"] if t["content"]] if added_vocabulary else []
    added_content = re.compile("|".join(map(re.escape, tokens))) if tokens else None
    spec = docs.sparkSession.sparkContext.broadcast(whole)  # one vocabulary
    end = np.array([closing], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        normal = Tokenizer.from_str(spec.value).normalizer.normalize_str
        full = None  # made where a text needs it
        cache, cut = PieceCache(word_tokenizer(spec.value)), Matcher(pattern)
        for batch in (w.slice(k, TEXTS_AT_ONCE) for w in batches for k in range(0, w.num_rows, TEXTS_AT_ONCE)):
            names, out = batch.schema.names, []
            texts = batch.column(names.index("text")).to_pylist()
            plain = [(normal(t) if BEYOND.search(t) else t.lower()) if t else "" for t in texts]
            whole_text = [added_content is not None and added_content.search(p) is not None for p in plain]
            words = [cut.findall(p) if p and not w else [] for p, w in zip(plain, whole_text, strict=True)]
            cache.prepare(words)
            for row, (doc, own) in enumerate(zip(batch.column(names.index("doc_id")).to_pylist(), words, strict=True)):
                if whole_text[row]:
                    full = full or Tokenizer.from_str(spec.value)
                    own_ids = np.array(full.encode(texts[row], add_special_tokens=False).ids, "<u4").tobytes()
                else:
                    own_ids = cache.join(own)
                ids = own_ids + end
                for k, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at : at + 4 * size]
                    out.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part), part))
            columns = list(zip(*out, strict=True)) if out else [()] * 6
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)]
            if with_ids:
                arrays.append(list_array(list(columns[5])))
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)

    slim = docs.select(F.col("doc_id").cast("long"), "text")
    return slim.mapInArrow(tidy(run), PIECE_COLUMNS + (", ids array<int>" if with_ids else ""))


def exact_patterns(counts: np.ndarray) -> np.ndarray:
    """Rows of three lengths (0: none) that occur and add up to a whole sequence."""
    size = len(counts) - 1
    there = counts > 0
    have = np.flatnonzero(there)
    rows = [np.array([[size, 0, 0]])] if there[size] else []
    low = have[have * 2 <= size]
    low = low[there[size - low] & (low < size)]
    rows.append(np.stack([size - low, low, 0 * low], 1))
    for small in have[have * 3 <= size]:
        mid = have[(have >= small) & (have * 2 <= size - small)]
        big = size - small - mid
        ok = there[big]
        rows.append(np.stack([big[ok], mid[ok], np.full(ok.sum(), small)], 1))
    return np.concatenate(rows).astype(np.int64)


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Repeat counts x >= 0 with the least squares of (lengths used by x) - counts.

    Accelerated projected gradient; a step is two passes over the patterns.
    """
    n = len(counts)

    def used(x: np.ndarray) -> np.ndarray:
        out = sum(np.bincount(patterns[:, k], x, n) for k in range(3))
        out[0] = 0
        return out

    def gradient(x: np.ndarray) -> np.ndarray:
        miss = used(x) - counts
        miss[0] = 0
        return miss[patterns].sum(axis=1)

    probe = np.ones(len(patterns))
    for _ in range(20):  # the largest eigenvalue, for the step
        probe = used(probe)[patterns].sum(axis=1)
        norm = np.linalg.norm(probe)
        probe /= max(norm, 1e-9)
    step = 1 / max(norm * 1.01, 1e-9)
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(rounds):
        x_next = np.maximum(0, y - step * gradient(y))
        t_next = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = x_next + (t - 1) / t_next * (x_next - x)
        x, t = x_next, t_next
    return x


def best_fit(counts: np.ndarray) -> Plan:
    """Best fit, longest first, for so many pieces of each length; equal sequences stay together."""
    size = len(counts) - 1
    by_room: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)

    def put(kind: tuple[int, ...], n: int) -> None:
        if n:
            room = by_room[size - sum(kind)]
            room[kind] = room.get(kind, 0) + n

    for length in range(size, 0, -1):
        left = int(counts[length])
        while left:
            room = next((r for r in range(length, size + 1) if by_room.get(r)), None)
            if room is None:
                kind, have = (), left
            else:
                kind, have = by_room[room].popitem()
            fits = (size - sum(kind)) // length
            full = min(have, left // fits)
            put(kind + (length,) * fits, full)
            left -= full * fits
            have -= full
            if have and left < fits and left:
                put(kind + (length,) * left, 1)
                have, left = have - 1, 0
            if room is not None:
                put(kind, have)
    return [(kind, n) for kinds in by_room.values() for kind, n in kinds.items()]


def plan_sequences(counts: np.ndarray) -> Plan:
    """Kinds of sequences and how often each occurs, for counts[length] pieces of each length."""
    left = counts.astype(np.int64).copy()
    plan: Plan = []
    patterns = exact_patterns(left)
    if len(patterns):
        repeats = fit(patterns, left.astype(float))
        order = np.argsort(-repeats, kind="stable")
        for wanted in (np.floor(repeats), np.where(repeats > 1e-3, np.inf, 0)):  # then what still fits
            for k in order[wanted[order] > 0]:
                kind, times = np.unique(patterns[k][patterns[k] > 0], return_counts=True)
                n = int(min(wanted[k], (left[kind] // times).min()))
                if n > 0:
                    left[kind] -= n * times
                    plan.append((tuple(int(x) for x in patterns[k] if x), n))
    return plan + best_fit(left)


def slots(plan: Plan) -> dict[str, np.ndarray]:
    """The plan by length: the k-th piece of a length finds its row by (length, first <= k)."""
    rows, taken, sequence = [], defaultdict(int), 0
    for kind, n in plan:
        offset, at = 0, {}
        for length in kind:
            rows.append((length, taken[length], sequence, offset))
            taken[length] += n
            offset += length
        sequence += n
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return dict(zip(("length", "first", "sequence", "offset"), table.T.copy(), strict=True))


def pack(cut: DataFrame, size: int = SIZE) -> DataFrame:
    """The pieces with their sequence_id and offset. cut is read twice, so it should be stored.

    The broadcast plan has a few rows for each of at most size lengths, whatever the number of pieces.
    """
    counted = cut.groupBy("length").count().collect()  # at most size rows
    counts = np.zeros(size + 1, np.int64)
    for row in counted:
        counts[row["length"]] = row["count"]
    plan = cut.sparkSession.sparkContext.broadcast(slots(plan_sequences(counts)))
    buckets = max(1, int(counts.sum()) // PIECES_PER_BUCKET)
    spread = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    sums = spread.groupBy("bucket", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("bucket", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    number = F.row_number().over(Window.partitionBy("bucket", "length").orderBy("doc_id", "piece"))
    ranked = spread.withColumn("k", number).join(sums, ["bucket", "length"])
    ranked = ranked.withColumn("k", F.col("k") + F.col("base") - 1).drop("bucket", "base")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = plan.value
        for batch in batches:
            got = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in ("length", "k")}
            first_of = np.searchsorted(p["length"], got["length"])
            row = np.empty(len(first_of), np.int64)
            for length in np.unique(got["length"]):
                mine = got["length"] == length
                low, high = np.searchsorted(p["length"], [length, length + 1])
                row[mine] = low + np.searchsorted(p["first"][low:high], got["k"][mine], "right") - 1
            arrays = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            arrays.append(pa.array(p["sequence"][row] + got["k"] - p["first"][row]))
            arrays.append(pa.array(p["offset"][row]))
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(tidy(run), PIECE_COLUMNS + ", sequence_id long, offset long")
