"""Byte-level BPE encoding and decoding with the tokenizers library.

A rank file gives the vocabulary as bytes. The library wants characters, so every byte is mapped to
a printable character, and the merges are all splits of a token into two tokens, in the order of the
token's rank. Texts are cut by the pattern, each distinct match is encoded once per task (up to a
bounded cache), and a text's ids are its matches' ids in a row. Decoding puts the bytes of ids in a
row; a character that is split over several ids comes back whole, as its bytes are joined before any
of them is read as text.

Null and empty texts have no ids. Repeated rows and extra columns pass through. A column named like
a new one is replaced.
"""

from __future__ import annotations

import base64
import json
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer, decoders, models, pre_tokenizers

from tallyline.llm.matcher import Matcher
from tallyline.llm.textbytes import tidy

CACHE_ENTRIES, CACHE_CHARACTERS = 300_000, 8_000_000
TEXTS_AT_ONCE = 200


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if printable, else one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    return [chr(moved.get(b, b)) for b in range(256)]


SHOWN = dict(enumerate(byte_characters()))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def tokenizer_of(ranks: dict[bytes, int]) -> Tokenizer:
    """A tokenizer that encodes one match of the pattern as a rank file's merges do."""
    shown = byte_characters()
    as_text = {token: "".join(shown[b] for b in token) for token in ranks}
    merges = []
    for token in sorted(ranks, key=ranks.__getitem__):
        splits = [(token[:i], token[i:]) for i in range(1, len(token))]
        splits = [(a, b) for a, b in splits if a in ranks and b in ranks]
        merges += [(as_text[a], as_text[b]) for a, b in sorted(splits, key=lambda s: (ranks[s[0]], ranks[s[1]]))]
    made = Tokenizer(models.BPE({as_text[t]: r for t, r in ranks.items()}, merges, ignore_merges=True))
    made.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    made.decoder = decoders.ByteLevel()
    return made


class PieceCache:
    """Ids of distinct matches as int32 bytes; emptied when it has too many, or too long ones."""

    def __init__(self, tokenizer: Tokenizer, entries: int = CACHE_ENTRIES, characters: int = CACHE_CHARACTERS):
        self.tokenizer, self.entries, self.characters, self.known, self.size = tokenizer, entries, characters, {}, 0

    def join(self, pieces: list[str]) -> bytes:
        known = self.known
        try:
            return b"".join(map(known.__getitem__, pieces))
        except KeyError:
            pass
        self.learn({p for p in pieces if p not in known})
        return b"".join(map(known.__getitem__, pieces))

    def learn(self, new: set[str]) -> None:
        """Encode new matches, each shown to the library as one character a byte."""
        split = self.tokenizer.model.tokenize
        for word in new:
            shown = word if word.isascii() and word.isalpha() else word.encode().decode("latin-1").translate(SHOWN)
            self.known[word] = array("i", [t.id for t in split(shown)]).tobytes()
            self.size += len(word)

    def prepare(self, pieces: list[list[str]]) -> None:
        """Make room for, and encode, what is new in several texts."""
        known = self.known
        if len(known) > self.entries or self.size > self.characters:
            known.clear()
            self.size = 0
        self.learn(set().union(*pieces).difference(known))


def list_array(parts: list[bytes]) -> pa.Array:
    """int32 lists from their bytes."""
    at = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) // 4 for p in parts], out=at[1:])
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.frombuffer(b"".join(parts), "<i4")))


def added(batch: pa.RecordBatch, new: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch with these columns at its end, instead of any of the same name."""
    kept = [n for n in batch.schema.names if n not in new]
    return pa.RecordBatch.from_arrays([batch.column(n) for n in kept] + list(new.values()), names=kept + list(new))


def schema_with(df: DataFrame, **new: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema if f.name not in new] + [T.StructField(n, t) for n, t in new.items()])


Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def encoder(spark: SparkSession, path: str, pattern: str, text: str = "text", offsets: bool = False) -> Step:
    """A step over batches that adds ids and, with offsets, byte_starts and char_starts."""
    ranks = read_ranks(path)
    spec = spark.sparkContext.broadcast(tokenizer_of(ranks).to_str())  # one vocabulary
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)

    def places(texts: list[str | None], parts: list[bytes]) -> dict[str, pa.Array]:
        starts, chars = [], []
        for t, part in zip(texts, parts, strict=True):
            ids = np.frombuffer(part, "<i4")
            begin = np.cumsum(lengths[ids]) - lengths[ids]
            raw = np.frombuffer((t or "").encode(), np.uint8)
            lead = np.cumsum((raw & 0xC0) != 0x80) - 1
            starts.append(begin.astype("<i4").tobytes())
            chars.append(lead[begin].astype("<i4").tobytes())
        return {"byte_starts": list_array(starts), "char_starts": list_array(chars)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, cut = PieceCache(Tokenizer.from_str(spec.value)), Matcher(pattern)
        for whole in batches:
            for first in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(first, TEXTS_AT_ONCE)
                texts = batch.column(batch.schema.names.index(text)).to_pylist()
                pieces = [cut.findall(t) if t else [] for t in texts]
                cache.prepare(pieces)
                parts = [cache.join(p) for p in pieces]
                new = {"ids": list_array(parts)}
                yield added(batch, new | (places(texts, parts) if offsets else {}))

    return run


def decoder(spark: SparkSession, path: str, ids: str = "ids") -> Step:
    """A step over batches that adds decoded, the bytes of the ids."""
    shown = {c: b for b, c in enumerate(byte_characters())}
    vocabulary = json.loads(tokenizer_of(read_ranks(path)).to_str())["model"]["vocab"]
    by_id: list[bytes] = [b""] * (max(vocabulary.values()) + 1)
    for token, k in vocabulary.items():
        by_id[k] = bytes(shown[c] for c in token)
    table = spark.sparkContext.broadcast(by_id)  # one vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        back = table.value
        for batch in batches:
            column = batch.column(batch.schema.names.index(ids))
            at = np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
            flat = column.flatten().to_numpy(zero_copy_only=False)
            out = [b"".join(map(back.__getitem__, flat[a:b].tolist())) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield added(batch, {"decoded": pa.array(out, pa.binary())})

    return run


INTS = T.ArrayType(T.IntegerType())


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", offsets: bool = False) -> DataFrame:
    """The rows with ids array<int>, and with offsets also byte_starts and char_starts.

    byte_starts are the places of the tokens in the UTF-8 text; char_starts number the characters
    that these bytes belong to, so a split character has the same start for each of its tokens.
    """
    kinds = {"ids": INTS} | ({"byte_starts": INTS, "char_starts": INTS} if offsets else {})
    return docs.mapInArrow(tidy(encoder(docs.sparkSession, path, pattern, text, offsets)), schema_with(docs, **kinds))


def decode(docs: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """The rows with decoded binary: the bytes of the ids. Null ids count as none."""
    return docs.mapInArrow(tidy(decoder(docs.sparkSession, path, ids)), schema_with(docs, decoded=T.BinaryType()))


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """The rows without the text but with ids and decoded, both made in one pass of one worker."""
    there, back = encoder(docs.sparkSession, path, pattern, text), decoder(docs.sparkSession, path)
    kinds = schema_with(docs, ids=INTS, decoded=T.BinaryType())
    slim = T.StructType([f for f in kinds if f.name != text])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in back(there(batches)):
            yield batch.select(slim.names)

    return docs.mapInArrow(tidy(run), slim)


def digests(coded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of encoded and decoded documents."""
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
