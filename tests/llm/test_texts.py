"""Tokenizing, packing, quality rules and license scans against plain versions."""

from __future__ import annotations

import base64
import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as vocabularies
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyline.llm import bpe, license_scan, packing, quality_rules
from tallyline.llm.matcher import Matcher
from tallyline.llm.storage import stored

from .cases import SCHEMA, SPLIT, documents

RANKS = vocabularies.path("byte_bpe_multi_50k.tiktoken")
WORDS = vocabularies.path("word_bpe_49k.json")
ODD = [*"  \t\n\r\x0b\x1c\x85\xa0　''sstdmlrve.,!?-_aAzZ09éßΣς½²٣日本🙂́‍İ×ª\x00", "'s", "'ll", " 't", "<|endoftext|>"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), SCHEMA)


def odd_texts(n: int) -> list[str]:
    rng = random.Random(5)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def tiktoken_encoding() -> tiktoken.Encoding:
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=vocabularies.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_equals_tiktoken_and_comes_back(spark, docs):
    odd = spark.createDataFrame([(1000 + k, t, None, None, 0) for k, t in enumerate(odd_texts(3000))], SCHEMA)
    rows = docs.unionAll(odd).withColumn("ids", F.lit("clash")).withColumn("decoded", F.lit(1))
    plain = tiktoken_encoding()
    got = bpe.round_trip(rows.withColumn("copy", F.col("text")), RANKS, vocabularies.PATTERN).collect()
    assert len(got) == rows.count()
    for row in got:
        assert row["ids"] == plain.encode_ordinary(row["copy"] or "")
        assert bytes(row["decoded"]) == (row["copy"] or "").encode()


def test_digests(docs):
    plain = tiktoken_encoding()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for row in bpe.digests(bpe.round_trip(docs, RANKS, vocabularies.PATTERN)).collect():
        ids = plain.encode_ordinary(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()


def test_offsets_follow_split_characters(spark):
    rows = spark.createDataFrame([(1, "a 🙂日本 né")], "doc_id long, text string")
    row = bpe.encode(rows, RANKS, vocabularies.PATTERN, offsets=True).first()
    whole = "a 🙂日本 né".encode()
    plain = tiktoken_encoding()
    for k, (token, at, char) in enumerate(zip(row["ids"], row["byte_starts"], row["char_starts"], strict=True)):
        piece = plain.decode_single_token_bytes(token)
        assert whole[at : at + len(piece)] == piece, k
        assert char == sum(b & 0xC0 != 0x80 for b in whole[: at + 1]) - 1


def test_decode_of_null_ids(spark):
    rows = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [bytes(r["decoded"]) for r in bpe.decode(rows, RANKS).collect()] == [b"", b""]


def test_word_matches_equal_the_tokenizer():
    whole = Tokenizer.from_file(WORDS)
    whole.encode_special_tokens = True
    spec = whole.to_str()
    cut, cache = Matcher(packing.word_pattern(json.loads(spec))), bpe.PieceCache(packing.word_tokenizer(spec))
    for text in odd_texts(3000):
        words = cut.findall(whole.normalizer.normalize_str(text))
        cache.prepare([words])
        assert np.frombuffer(cache.join(words), "<i4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_cache_is_emptied_and_stays_right():
    cache = bpe.PieceCache(packing.word_tokenizer(Tokenizer.from_file(WORDS).to_str()), entries=3)
    words = "alpha beta gamma delta epsilon alpha beta".split()
    first = cache.join(words)
    for _ in range(3):
        cache.prepare([words, ["zeta", "eta"]])
        assert cache.join(words) == first


@pytest.mark.parametrize("size", [2048, 64])
def test_packing(spark, docs, size):
    whole = Tokenizer.from_file(WORDS)
    whole.encode_special_tokens = True
    placed = packing.pack(stored(packing.pieces(docs, WORDS, size), "pieces"), size).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in placed:
        by_doc[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    expected, total = defaultdict(list), 0
    for i, text, *_ in documents():
        ids = whole.encode(text or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        for k, at in enumerate(range(0, len(ids), size)):
            part = ids[at : at + size]
            expected[i].append((k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert {k: sorted(v) for k, v in by_doc.items()} == {k: sorted(v) for k, v in expected.items()}
    for parts in by_sequence.values():
        ends = 0
        for offset, length in sorted(parts):
            assert offset == ends
            ends += length
        assert ends <= size
    assert len(by_sequence) <= math.ceil(total / size) + 1


def test_added_tokens_in_texts_equal_the_library(spark, tmp_path):
    """The registered query, against the library as it is by default."""
    from tallyline.llm.queries import op5_best_fit_packing

    whole = Tokenizer.from_file(WORDS)
    texts = ["a <|endoftext|> b", "<|startoftext|>x<|endoftext|><|endoftext|>", "A <|ENDOFTEXT|> é", "a <|endoftext b", "no", ""]
    spark.createDataFrame([(k, t, "en", "a", 0) for k, t in enumerate(texts)], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    ids = {k: whole.encode(t, add_special_tokens=False).ids + [0] for k, t in enumerate(texts)}
    assert ids[0] == [320, 49407, 321, 0]
    got = {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in op5_best_fit_packing(spark, str(tmp_path)).collect()}
    assert got == {k: (len(v), zlib.crc32(np.array(v, "<u4").tobytes())) for k, v in ids.items()}


def test_packing_of_nothing(spark, docs):
    assert packing.pack(stored(packing.pieces(docs.limit(0), WORDS), "pieces")).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_plan_uses_every_piece_and_is_close_to_the_bound(seed):
    rng = np.random.default_rng(seed)
    counts = np.zeros(2049, np.int64)
    lengths = np.minimum(2048, rng.lognormal(6, 1, 20_000).astype(int) + 1)
    np.add.at(counts, lengths, 1)
    used, sequences = np.zeros(2049, np.int64), 0
    for kind, n in packing.plan_sequences(counts):
        assert sum(kind) <= 2048
        sequences += n
        for length in kind:
            used[length] += n
    assert (used == counts).all()
    assert sequences <= math.ceil(lengths.sum() / 2048) + 2


def plain_counts(text: str | None) -> tuple:
    text = text or ""
    words = SPLIT.findall(text)
    lines = [x for x in text.split("\n") if SPLIT.search(x)]
    seen = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    covered = {k + j for k in range(len(words) - 7) if seen[tuple(words[k : k + 8])] > 1 for j in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_counts_and_verdicts(docs):
    clashing = docs.withColumn("bits", F.lit("x")).withColumn("n_words", F.lit(-1))
    for judged in (quality_rules.assess(docs, ["doc_id", "text"]), quality_rules.assess(clashing, ["doc_id", "text"])):
        rows = judged.collect()
        assert len(rows) == len(documents())
        for r in rows:
            counts = plain_counts(r["text"])
            assert tuple(r[c] for c in quality_rules.COUNTS) == counts
            failed = counts[0] < 20 or 100 * counts[4] > 30 * counts[0]
            assert r["base_failed"] == failed
            assert not (failed and r["kept"])


def test_a_model_that_is_joined_gives_the_same(docs):
    a, b = (sorted(quality_rules.assess(docs, ["doc_id", "source"], model_rows=n).collect(), key=str) for n in (10**9, 0))
    assert [r.asDict() | {"perplexity": 0} for r in a] == [r.asDict() | {"perplexity": 0} for r in b]
    assert np.allclose([r["perplexity"] for r in a], [r["perplexity"] for r in b], rtol=1e-5)


def test_quality_of_nothing(docs):
    assert quality_rules.assess(docs.limit(0), ["doc_id"]).count() == 0


def test_kneser_ney_adds_up_to_one(spark):
    """For each context, the chances of all 256 bytes."""
    texts = spark.createDataFrame([("x", "abracadabra alakazam abraxas"), ("x", "abba baba")], "lang string, text string")
    order = 3
    model = quality_rules.arrays_of(quality_rules.kneser_ney(quality_rules.count_grams(texts, order), order))
    for context in (b"ab", b"ra", b"zz", b"\x02a"):
        codes = np.array([context[0] << 16 | context[1] << 8 | c for c in range(256)], np.uint64)
        chances = 2 ** quality_rules.log_chances(model, "x", codes, order)
        assert abs(chances.sum() - 1) < 0.02 and (chances > 0).all()


def test_entropy_against_a_plain_model(spark):
    text = "banana bandana"
    table = spark.createDataFrame([("x", text)], "lang string, text string")
    order = 2
    model = quality_rules.arrays_of(quality_rules.kneser_ney(quality_rules.count_grams(table, order), order))
    raw = text.encode()
    padded = b"\2" + raw + b"\3"
    pairs = Counter(zip(padded[:-1], padded[1:], strict=True))
    singles = Counter(b for _, b in pairs)

    def cuts(counts: Counter) -> list[float]:
        n = [sum(v == k for v in counts.values()) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        return [min(k, max(0, k - (k + 1) * y * n[k] / n[k - 1])) if n[k - 1] and n[0] else k / 2 for k in (1, 2, 3)]

    def single(b: int) -> float:
        d, all_ = cuts(singles), sum(singles.values())
        off = sum(d[min(v, 3) - 1] for v in singles.values())
        return (singles[b] - d[min(singles[b], 3) - 1]) / all_ + off / all_ / 256

    def pair(a: int, b: int) -> float:
        d = cuts(pairs)
        own = {k: v for k, v in pairs.items() if k[0] == a}
        off, all_ = sum(d[min(v, 3) - 1] for v in own.values()), sum(own.values())
        return (own[a, b] - d[min(own[a, b], 3) - 1]) / all_ + off / all_ * single(b)

    bits = -sum(math.log2(pair(a, b)) for a, b in zip(padded[:-1], padded[1:], strict=True)) / (len(raw) + 1)
    got = quality_rules.entropies(model, "x", np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), order)[0]
    assert abs(got - bits) < 1e-5


def test_unlike_text_is_rejected(spark):
    from .cases import prose

    rows = [(k, prose(k, 80), "en", "a", 0) for k in range(200)]
    rows.append((999, " ".join(f"{k:x}%q{k * 7919:x}$" for k in range(60)), "en", "a", 0))
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.assess(spark.createDataFrame(rows, SCHEMA), ["doc_id"]).collect()}
    assert not kept[999]
    assert all(v for k, v in kept.items() if k != 999)


@pytest.mark.parametrize("percent", [3, 10])
def test_frequent_junk_is_rejected(spark, percent):
    """Junk of one make, more of it than the outer percentiles of a language."""
    from .cases import prose

    clean = [(k, prose(k, 80), "en", "a", 0) for k in range(400)]
    rng, texts = random.Random(1), []
    for k in range(400 * percent // 100):
        words = prose(5000 + k, 80).split()
        kind = k % 3
        if kind == 0:
            words = [w + rng.choice(["###", "$$$", "%%%"]) for w in words]
        elif kind == 1:
            words = [w + " |" for w in words]
        else:
            words = ["".join(rng.choices("bcdfghjkqvwxz", k=7)) for _ in words]
        texts.append(" ".join(words))
    junk = [(1000 + k, t, "en", "a", 0) for k, t in enumerate(texts)]
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.assess(spark.createDataFrame(clean + junk, SCHEMA), ["doc_id"]).collect()}
    assert not [k for k, v in kept.items() if k >= 1000 and v]
    assert all(v for k, v in kept.items() if k < 1000)


def test_a_language_of_symbols_teaches_its_model(spark):
    from .cases import prose

    rows = [(k, prose(k, 80).replace(" ", " $ "), "sh", "a", 0) for k in range(100)]
    rows.append((999, " ".join(f"{k:x}q{k * 7919:x}" for k in range(60)), "sh", "a", 0))
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.assess(spark.createDataFrame(rows, SCHEMA), ["doc_id"]).collect()}
    assert {k for k, v in kept.items() if not v} == {999}


def license_rows() -> list[tuple]:
    mit = next(iter(license_scan.TEMPLATES))
    words = mit.split()
    changed = " ".join([*words[:8], "indeed", *words[8:14], *words[15:]])
    return [
        (1, "Licensed UNDER the  MIT-License, cc by nc. under the mit license"),
        (2, "under the mit licence; Apache License, Version 2.0 and apache license version 2"),
        (3, f"so: {mit} and more"),
        (4, f"so: {changed} and more"),
        (5, " ".join(words[:6])),
        (6, None),
        (7, ""),
        (8, "cc by nc cc by nc by nc"),
        (8, "cc by nc cc by nc by nc"),
        (9, "Über ünder the mit license ÀÉ cc by ñc"),
        (None, "under the mit license"),
    ]


def test_license_scan(spark):
    docs = spark.createDataFrame(license_rows(), "doc_id long, text string").withColumn("label", F.lit(3)).withColumn("place", F.lit("x"))
    got = license_scan.scan(docs).collect()
    assert len(got) == len(license_rows())
    expected = []
    for i, text in license_rows():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans(license_scan.UPPER, license_scan.LOWER)))
        starts, labels = [], set()
        for phrase, label in license_scan.PHRASES.items():
            parts = phrase.split()
            here = [k for k in range(len(words)) if words[k : k + len(parts)] == parts]
            starts += here
            labels |= {label} if here else set()
        expected.append((i, len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))))
    found = [(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got]
    assert sorted(found, key=str) == sorted(expected, key=str)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[3]["labels"] == "mit" and by_id[3]["score"] == 1
    assert by_id[4]["labels"] == "mit" and 0.6 <= by_id[4]["score"] < 1
    assert by_id[5]["labels"] == "" and by_id[5]["score"] < 0.6
    assert by_id[6]["score"] == 0 and by_id[7]["labels"] == ""
    assert all(set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) for r in got)


def test_license_scan_of_nothing(spark):
    assert license_scan.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_repeated_phrases_of_a_license_are_no_license(spark):
    """Parts of a template count once, however often a text has them."""
    whole = next(iter(license_scan.TEMPLATES))
    rows = [
        (1, "the terms of " * 14),
        (2, "this software and associated " * 9),
        (3, "the terms of " * 5000),
        (4, whole),
        (5, whole.replace("charge", "any charge") + " the terms of" * 20),
        (6, " ".join(reversed(whole.split()))),
    ]
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[k][0] for k in sorted(got)] == ["", "", "", "mit", "mit", ""]
    assert all(got[k][1] < 0.5 for k in (1, 2, 3, 6)) and got[4][1] == 1.0 and got[5][1] > 0.8


def test_long_templates_are_met_by_sections(spark):
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(words), " ".join(words[:100]), " ".join([*words[:150], "x", *words[150:]]), " ".join(words[:60] * 9)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in license_scan.scan(table, {}, {" ".join(words): "own"}).collect()}
    assert got[0] == 1.0 and got[1] == pytest.approx(0.25, abs=0.03) and got[2] > 0.95 and got[3] < 0.2
