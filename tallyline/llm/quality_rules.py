"""Quality rules: counts of words, symbols and repeats, and n-gram perplexity bands by language.

The language model is an interpolated modified Kneser-Ney model over the UTF-8 bytes of the texts
(digits count as one byte value), one for each value of lang and half of its documents, dealt by a hash
of the text. A document is scored by the model of the other half, so neither its own n-grams nor those
of its copies make it likely. Only documents that pass the base rules and have no more symbols a word
than their language's limit teach a model: PLAIN_SYMBOLS, or twice the median where that is more. Junk
that is frequent in the corpus is thus not learned. Spark counts the n-grams of these documents, each
task adding up its own first, and smooths the counts with DataFrame operations. The finished model is a
set of sorted arrays of packed n-grams (a hash without collisions, as n bytes fit one integer), searched
by binary search. Up to `MODEL_ROWS` rows it is broadcast; a larger one is joined to each text's distinct
n-grams instead, with the same results.

A document's entropy is its mean negative log2 probability per byte, and its perplexity 2 to the
power of that. The limits of a language lie REACH spreads from the median of the documents that teach,
from a histogram; a document outside is rejected. The spread is the larger distance from the median to
the percentiles TAIL and 1 - TAIL, which lie so far within that a tenth of junk or a third of copies
hardly moves them, and at least SLACK bits divided by the root of the number of documents. A document
whose language has no other half is scored as bytes of equal chance.

Null texts have no words; a document without words fails the base rule, and so does one with under 20.
A null lang is a language of its own. Repeated rows are judged and returned once each. Columns of the
input named like a new one are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallyline.llm.bpe import added, schema_with
from tallyline.llm.storage import stored
from tallyline.llm.textbytes import SPACES, Spans, blocks, mix, per_text, runs, table, tidy, utf8, windows

ORDER = 4
REACH, TAIL, SLACK = 12.0, 0.2, 1.0
PLAIN_SYMBOLS = 0.1
BINS_PER_BIT = 200
MODEL_ROWS = 3_000_000
BROADCAST_LANGUAGES = 10_000
SYMBOLS = table([(ord(c), ord(c)) for c in "#*$%&|<>"])
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def distinct_per_text(key: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """How many different keys each text has."""
    own = mix(key ^ mix(doc.astype(np.uint64) + np.uint64(1)))
    _, first = np.unique(own, return_index=True)
    return np.bincount(doc[first], minlength=n)


def base_counts(data: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts of the texts of a block."""
    n = len(at) - 1
    solid = ~SPACES[data]
    spans = Spans(data)
    start, end, doc = runs(solid, at)
    words = spans.hashes(start, end)
    line_start, line_end, line_doc = runs(data != 10, at)
    sums = np.concatenate([[0], np.cumsum(solid)])
    full = sums[line_end] > sums[line_start]
    line_doc = line_doc[full]
    line = spans.hashes(line_start[full], line_end[full])
    shape, place = windows(words, doc, WINDOW)
    shape = mix(shape ^ mix(doc[place].astype(np.uint64) + np.uint64(1)))
    ordered = np.sort(shape)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if len(twice):
        found = np.searchsorted(twice, shape)
        place = place[twice[np.minimum(found, len(twice) - 1)] == shape]
    else:
        place = place[:0]
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, place, 1)
    np.add.at(edge, place + WINDOW, -1)
    covered = np.cumsum(edge)[:-1] > 0
    return {
        "n_words": np.bincount(doc, minlength=n),
        "word_chars": per_text(solid & ((data & 0xC0) != 0x80), at),
        "n_symbols": per_text(SYMBOLS[data], at),
        "n_dup_lines": np.bincount(line_doc, minlength=n) - distinct_per_text(line, line_doc, n),
        "n_repeat_words": np.bincount(doc[covered], minlength=n),
    }


def grams(data: np.ndarray, at: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The packed n-grams that end at each byte and at the end of each text, and their text's number.

    Each text follows order - 1 bytes 2 and ends with a byte 3.
    """
    n, pad = len(at) - 1, order - 1
    doc = np.repeat(np.arange(n), np.diff(at))
    out = np.full(len(data) + n * order, 2, np.uint64)
    digits = (data >= 0x30) & (data <= 0x39)
    out[np.arange(len(data)) + doc * order + pad] = np.where(digits, 0x30, data)
    last = at[1:] + np.arange(n) * order + pad
    out[last] = 3
    code = np.zeros(len(out) - pad, np.uint64)
    for k in range(order):
        code = (code << np.uint64(8)) | out[k : len(out) - pad + k]
    owner = np.repeat(np.arange(n), np.diff(at) + order)[pad:]
    within = np.ones(len(out), bool)
    within[(at[:-1] + np.arange(n) * order)[:, None] + np.arange(pad)] = False
    return code[within[pad:]], owner[within[pad:]]


#: N-grams that a task holds, of all languages together.
HELD_GRAMS = 1_000_000


def base_failed(n_words, n_repeat_words):
    """The base rules, of columns or of arrays."""
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def by_language(batch: pa.RecordBatch, name: str = "lang") -> Iterator[tuple[str, np.ndarray]]:
    """Each language of a batch ('' for null) and its rows."""
    langs = batch.column(batch.schema.names.index(name)).fill_null("").to_numpy(zero_copy_only=False)
    for lang in sorted(set(langs)):
        yield lang, np.flatnonzero(langs == lang)


def teaching(texts: pa.Array, most: np.ndarray) -> pa.Array:
    """The texts that pass the base rules and have at most so many symbols a word."""
    data, at = utf8(texts)
    chosen = np.zeros(len(texts), bool)
    for first, last in blocks(at):
        counts = base_counts(data[at[first] : at[last]], at[first : last + 1] - at[first])
        plain = counts["n_symbols"] <= most[first:last] * counts["n_words"]
        chosen[first:last] = plain & ~base_failed(counts["n_words"], counts["n_repeat_words"])
    return texts.filter(pa.array(chosen))


def count_grams(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """lang, gram and n over all documents; given most_symbols, over those that teach."""
    columns = ["lang", "text"] + ["most_symbols"] * ("most_symbols" in docs.columns)

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        codes, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return codes, np.bincount(back, np.concatenate([p[1] for p in parts])).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, list] = {}
        held = 0  # n-grams of all languages together
        for batch in batches:
            for lang, rows in by_language(batch):
                texts = batch.column(batch.schema.names.index("text")).take(pa.array(rows))
                if "most_symbols" in batch.schema.names:
                    most = batch.column(batch.schema.names.index("most_symbols")).to_numpy(zero_copy_only=False)
                    texts = teaching(texts, most[rows])
                data, at = utf8(texts)
                for first, last in blocks(at):
                    codes, _ = grams(data[at[first] : at[last]], at[first : last + 1] - at[first], order)
                    parts = kept.setdefault(lang, [])
                    parts.append(np.unique(codes, return_counts=True))
                    held += len(parts[-1][0])
                    if held > 2 * HELD_GRAMS:
                        kept = {k: [merged(own)] for k, own in kept.items()}
                        held = sum(len(own[0][0]) for own in kept.values())
                    while held > HELD_GRAMS and all(len(own) == 1 for own in kept.values()):
                        most_held = max(kept, key=lambda k: len(kept[k][0][0]))  # Spark adds its rows up
                        held -= len(kept[most_held][0][0])
                        yield as_rows(most_held, *kept.pop(most_held)[0])
        for lang, parts in kept.items():
            yield as_rows(lang, *merged(parts))

    def as_rows(lang: str, codes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        langs = pa.array(np.zeros(len(codes), np.int32))
        return pa.RecordBatch.from_arrays(
            [pa.DictionaryArray.from_arrays(langs, pa.array([lang])).cast(pa.string()), pa.array(codes.astype(np.int64)), pa.array(n)],
            names=["lang", "gram", "n"],
        )

    rows = docs.select(*columns).mapInArrow(tidy(run), "lang string, gram long, n long")
    return rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def kneser_ney(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """lang, size, kind, gram, value: log2 probabilities (kind 0) and, of contexts, log2 weights of
    the next smaller n-gram (kind 1), for every n-gram size from 1 to order."""
    levels = {order: counts}
    for size in range(order - 1, 0, -1):  # the number of different bytes before it
        shorter = (F.col("gram").bitwiseAND((1 << 8 * size) - 1)).alias("gram")
        levels[size] = stored(levels[size + 1].groupBy("lang", shorter).agg(F.count("*").alias("n")), "level")
    few = counts.select("lang").distinct().count() <= BROADCAST_LANGUAGES

    def narrow(table: DataFrame) -> DataFrame:
        """A table of a row for each language, for joins that need not deal rows by language."""
        return F.broadcast(table) if few else table

    lower, out = None, []
    for size in range(1, order + 1):
        rows = levels[size].withColumn("context", F.shiftright("gram", 8))
        n = [F.count_if(F.col("n") == k).cast("double") for k in (1, 2, 3, 4)]
        seen = levels[size].groupBy("lang").agg(*[c.alias(f"n{k}") for k, c in enumerate(n, 1)])
        y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
        cut = seen.select("lang", *[
            F.when((F.col(f"n{k}") > 0) & (F.col("n1") > 0), F.greatest(F.lit(0.0), F.least(F.lit(float(k)), k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}")))).otherwise(k / 2).alias(f"d{k}")
            for k in (1, 2, 3)
        ])
        own = Window.partitionBy("lang", "context")
        rows = rows.join(narrow(cut), "lang").withColumn("off", F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3")))
        if size == 1:  # one context; summed up before it is joined
            total = rows.groupBy("lang").agg(F.sum("n").alias("total"), F.sum("off").alias("cut"))
            rows = rows.join(narrow(total), "lang")
        else:
            rows = rows.withColumns({"total": F.sum("n").over(own), "cut": F.sum("off").over(own)})
        rows = rows.withColumns({"weight": F.col("cut") / F.col("total"), "share": (F.col("n") - F.col("off")) / F.col("total")})
        if size == 1:
            chance = rows.select("lang", "gram", "context", "weight", (F.col("share") + F.col("weight") / 256).alias("p"))
        else:
            tail = F.col("gram").bitwiseAND((1 << 8 * (size - 1)) - 1)
            below = lower.select("lang", F.col("gram").alias("tail"), F.col("p").alias("p_below"))
            chance = rows.withColumn("tail", tail).join(below, ["lang", "tail"])
            chance = chance.select("lang", "gram", "context", "weight", (F.col("share") + F.col("weight") * F.col("p_below")).alias("p"))
        lower = chance = stored(chance, "chances")  # read by its own rows, its contexts and the next size
        out.append(chance.select("lang", F.lit(size).alias("size"), F.lit(0).alias("kind"), "gram", F.log2("p").alias("value")))
        contexts = chance.groupBy("lang", "context").agg(F.first("weight").alias("weight"))
        out.append(contexts.select("lang", F.lit(size).alias("size"), F.lit(1), F.col("context"), F.log2(F.greatest("weight", F.lit(1e-12)))))
    model = out[0]
    for part in out[1:]:
        model = model.unionAll(part)
    return model


def arrays_of(model: DataFrame) -> dict[tuple, tuple[np.ndarray, np.ndarray]]:
    """(lang, size, kind) -> sorted n-grams and their values."""
    part = F.concat_ws("\t", "lang", "size", "kind").alias("part")
    rows = model.select(part, "gram", F.col("value").cast("float")).toArrow()
    parts = rows.column("part").combine_chunks().dictionary_encode()
    code = parts.indices.to_numpy()
    gram, value = (rows.column(c).to_numpy() for c in ("gram", "value"))
    order = np.lexsort((gram, code))
    code, gram, value = code[order], gram[order].astype(np.uint64), value[order]
    cut = np.searchsorted(code, np.arange(len(parts.dictionary) + 1))
    names = [k.rsplit("\t", 2) for k in parts.dictionary.to_pylist()]
    keys = [(lang, int(size), int(kind)) for lang, size, kind in names]
    return {k: (gram[a:b].copy(), value[a:b].copy()) for k, a, b in zip(keys, cut[:-1], cut[1:], strict=True)}


NONE = (np.zeros(1, np.uint64), np.zeros(1, np.float32))


def found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The value of each wanted key, and whether it is there."""
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return values[at], keys[at] == wanted


def log_chances(model: dict, lang: str, wanted: np.ndarray, order: int) -> np.ndarray:
    """log2 probabilities of sorted n-grams; unseen ones fall back on shorter ones."""
    out, open_, size = np.zeros(len(wanted)), np.arange(len(wanted)), order
    while len(open_) and size:
        code = wanted[open_] & np.uint64((1 << 8 * size) - 1)
        value, there = found(*model.get((lang, size, 0), NONE), code)
        there &= (lang, size, 0) in model
        out[open_[there]] += value[there]
        open_, code = open_[~there], code[~there]
        weight, there = found(*model.get((lang, size, 1), NONE), code >> np.uint64(8))
        out[open_] += np.where(there, weight, 0.0)
        size -= 1
    out[open_] -= 8
    return out


def entropies(model: dict, lang: str, data: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
    """Mean bits per byte of the texts of a block."""
    code, owner = grams(data, at, order)
    key = np.sort((code << np.uint64(20)) | owner.astype(np.uint64))
    code, owner = key >> np.uint64(20), (key & np.uint64((1 << 20) - 1)).astype(np.int64)
    head = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    chances = log_chances(model, lang, code[head], order)
    each = np.repeat(chances, np.diff(np.append(head, len(code))))
    n = len(at) - 1
    return -np.bincount(owner, each, n) / np.maximum(1, np.bincount(owner, minlength=n))


def measured(docs: DataFrame, model: dict | None, order: int, by: str = "lang") -> DataFrame:
    """The rows with the base counts, and with bits per byte if a model is given, whose parts `by` names."""
    shared = docs.sparkSession.sparkContext.broadcast(model) if model is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.names.index("text"))
            out = {name: np.zeros(batch.num_rows, np.int64) for name in COUNTS}
            bits = np.zeros(batch.num_rows)
            for lang, rows in by_language(batch, by):
                data, at = utf8(column.take(pa.array(rows)))
                for first, last in blocks(at):
                    for low in range(first, last, 1 << 20):
                        high = min(last, low + (1 << 20))
                        part, own = data[at[low] : at[high]], at[low : high + 1] - at[low]
                        for name, value in base_counts(part, own).items():
                            out[name][rows[low:high]] = value
                        if shared is not None:
                            bits[rows[low:high]] = entropies(shared.value, lang, part, own, order)
            new = {k: pa.array(v) for k, v in out.items()}
            yield added(batch, new | ({"bits": pa.array(bits)} if shared is not None else {}))

    kinds = {name: T.LongType() for name in COUNTS}
    if shared is not None:
        kinds["bits"] = T.DoubleType()
    return docs.mapInArrow(tidy(run), schema_with(docs, **kinds))


def joined_bits(docs: DataFrame, model: DataFrame, order: int) -> DataFrame:
    """row_id and bits, by joining each text's distinct n-grams to a model too large to broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.names.index("row_id")).to_numpy(zero_copy_only=False)
            for lang, rows in by_language(batch):
                data, at = utf8(batch.column(batch.schema.names.index("text")).take(pa.array(rows)))
                for k in range(len(rows)):
                    code, _ = grams(data[at[k] : at[k + 1]], np.array([0, at[k + 1] - at[k]]), order)
                    gram, times = np.unique(code, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(gram), ids[rows[k]])), pa.array([lang] * len(gram), pa.string()), pa.array(gram.astype(np.int64)), pa.array(times)],
                        names=["row_id", "lang", "gram", "times"],
                    )

    rows = docs.select("row_id", "lang", "text").mapInArrow(tidy(run), "row_id long, lang string, gram long, times long")
    rows = stored(rows, "document_grams")
    chances = joined_chances(rows.select("lang", "gram").distinct(), model, order)
    met = rows.join(chances, ["lang", "gram"])
    return met.groupBy("row_id").agg((-F.sum(F.col("times") * F.col("value")) / F.sum("times")).alias("bits"))


def joined_chances(wanted: DataFrame, model: DataFrame, order: int) -> DataFrame:
    """lang, gram and value: the log2 probabilities of n-grams; unseen ones fall back on shorter ones.

    Every size looks up its own distinct n-grams, so a key meets at most 256 rows.
    """
    tail = {size: F.col("gram").bitwiseAND((1 << 8 * (size - 1)) - 1) for size in range(1, order + 1)}
    levels = {order: wanted}
    for size in range(order - 1, 0, -1):
        levels[size] = levels[size + 1].select("lang", tail[size + 1].alias("gram")).distinct()
    lower = None
    for size in range(1, order + 1):
        part = model.filter(F.col("size") == size)
        own = part.filter("kind = 0").select("lang", "gram", F.col("value").alias("own"))
        weight = part.filter("kind = 1").select("lang", F.col("gram").alias("context"), F.col("value").alias("weight"))
        rows = levels[size].withColumns({"context": F.shiftright("gram", 8), "tail": tail[size]})
        rows = rows.join(own, ["lang", "gram"], "left").join(weight, ["lang", "context"], "left")
        below = F.lit(-8.0)
        if lower is not None:
            rows, below = rows.join(lower, ["lang", "tail"]), F.col("below")
        value = F.coalesce("own", F.coalesce("weight", F.lit(0.0)) + below)
        out = rows.select("lang", "gram", value.alias("value"))
        lower = out.select("lang", F.col("gram").alias("tail"), F.col("value").alias("below"))
    return out


def symbol_limits(docs: DataFrame) -> DataFrame:
    """lang and most_symbols: how many symbols a word a document that teaches may have."""
    counted = measured(docs.select("lang", "text"), None, ORDER)
    counted = counted.filter(~base_failed(F.col("n_words"), F.col("n_repeat_words")))
    bins = counted.groupBy("lang", F.floor(100 * F.col("n_symbols") / F.col("n_words")).alias("bin")).count()
    up = Window.partitionBy("lang").orderBy("bin")
    bins = bins.withColumns({"upto": F.sum("count").over(up), "total": F.sum("count").over(Window.partitionBy("lang"))})
    middle = F.min(F.when(2 * F.col("upto") >= F.col("total"), F.col("bin") + 1)) / 100
    return bins.groupBy("lang").agg(F.greatest(F.lit(PLAIN_SYMBOLS), 2 * middle).alias("most_symbols"))


def bands(scored: DataFrame, reach: float = REACH) -> DataFrame:
    """lang, low and high: bits per byte outside of which documents of the language are rejected."""
    bins = scored.groupBy("lang", F.floor(F.col("bits") * BINS_PER_BIT).alias("bin")).count()
    up = Window.partitionBy("lang").orderBy("bin")
    bins = bins.withColumns({"upto": F.sum("count").over(up), "total": F.sum("count").over(Window.partitionBy("lang"))})
    level = (F.col("bin") + 0.5) / BINS_PER_BIT
    places = {"low": TAIL, "middle": 0.5, "high": 1 - TAIL}
    found = bins.groupBy("lang").agg(
        *[F.min(F.when(F.col("upto") >= q * F.col("total"), level)).alias(name) for name, q in places.items()],
        F.first("total").alias("total"),
    )
    least = F.greatest(F.lit(1 / BINS_PER_BIT), SLACK / F.sqrt("total"))
    spread = F.greatest(F.col("middle") - F.col("low"), F.col("high") - F.col("middle"), least) * reach
    return found.select("lang", (F.col("middle") - spread).alias("low"), (F.col("middle") + spread).alias("high"))


def assess(docs: DataFrame, keep: list[str], order: int = ORDER, reach: float = REACH, model_rows: int = MODEL_ROWS) -> DataFrame:
    """The columns `keep` of all rows with the base counts, perplexity, base_failed and kept."""
    source = docs.select(*keep, *[c for c in ("lang", "text") if c not in keep])
    language = F.coalesce(F.col("lang"), F.lit(""))
    symbols = stored(symbol_limits(source.withColumn("lang", language)), "symbols").withColumnRenamed("lang", "band_lang")
    if symbols.count() <= BROADCAST_LANGUAGES:
        symbols = F.broadcast(symbols)
    half = F.pmod(F.xxhash64("text"), F.lit(2))
    source = source.withColumn("band_lang", language).join(symbols, "band_lang", "left").fillna(0.0, ["most_symbols"])
    source = source.withColumns({"scored_by": F.concat_ws("\n", "band_lang", half), "teaches": F.concat_ws("\n", "band_lang", 1 - half)})
    taught = source.select(F.col("teaches").alias("lang"), "text", "most_symbols")
    model = kneser_ney(stored(count_grams(taught, order), "grams"), order)
    model = stored(model.withColumn("value", F.col("value").cast("float")), "model")
    if model.count() <= model_rows:
        scored = measured(source, arrays_of(model), order, "scored_by")
    else:
        numbered = stored(source.withColumn("row_id", F.monotonically_increasing_id()), "numbered")
        bits = joined_bits(numbered.select("row_id", F.col("scored_by").alias("lang"), "text"), model, order)
        scored = measured(numbered, None, order).drop("bits").join(bits, "row_id", "left")
        scored = scored.drop("row_id").fillna(0.0, ["bits"])
    scored = stored(scored.select(*keep, *COUNTS, "bits", "band_lang", "most_symbols"), "scored")
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    plain = scored.filter(~failed & (F.col("n_symbols") <= F.col("most_symbols") * F.col("n_words")))
    limits = stored(bands(plain.select(F.col("band_lang").alias("lang"), "bits"), reach), "bands")
    limits = limits.withColumnRenamed("lang", "band_lang")
    if limits.count() <= BROADCAST_LANGUAGES:
        limits = F.broadcast(limits)
    judged = scored.join(limits, "band_lang", "left")
    within = F.col("bits").between(F.col("low"), F.col("high"))
    return judged.select(
        *keep,
        *COUNTS,
        F.pow(F.lit(2.0), "bits").alias("perplexity"),
        failed.alias("base_failed"),
        (~failed & F.coalesce(within, F.lit(False))).alias("kept"),
    )


#: The base counts and the base rule of every document.
BASE_ORACLE = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), words AS (
  SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i
  FROM (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM texts)
), eights AS (
  SELECT r, i, count(*) OVER line AS n, string_agg(word, ' ') OVER line AS eight
  FROM words WINDOW line AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)
), twice AS (
  SELECT r, i FROM (SELECT *, count(*) OVER (PARTITION BY r, eight) AS times FROM eights WHERE n = 8) WHERE times > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM twice, range(8) AS step(k) GROUP BY r
), lines AS (
  SELECT r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS line FROM texts
), counted AS (
  SELECT
    doc_id,
    CAST(len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(line) - list_unique(line) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM texts JOIN lines USING (r) LEFT JOIN covered USING (r)
)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted
"""
