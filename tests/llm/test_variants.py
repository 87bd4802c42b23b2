"""Near words and forms against comparing every word with every other."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from functools import cache

import numpy as np
import pytest

from tallyline.llm import variants

from .cases import LOWERED, SCHEMA, documents


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain(rows: list[tuple], least_count: int, every: int) -> list[tuple]:
    n = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWERED)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    words = {w: k for w, k in n.items() if len(w) >= 6 and k >= least_count}
    form, many = {}, {}
    for w in words:
        near = sorted((-words[v], v) for v in words if abs(len(v) - len(w)) < 2 and v != w and one_edit(v, w))
        many[w] = len(near)
        if near and -near[0][0] >= 5 * words[w]:
            form[w] = near[0][1]
    out = []
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, words[w], many[w], words[form[w]] if w in form else None))
    return sorted(out)


def texts() -> list[tuple]:
    """Words with edits of edits, accents, one common word, words of the same letters, and long ones."""
    rng = random.Random(9)
    base = ["".join(rng.choices("etaoinshrdluéßñ", k=rng.randint(5, 11))) for _ in range(60)]
    said = []
    for w in base:
        said += [w] * rng.choice([1, 5, 30, 700])
        for _ in range(12):
            k, c = rng.randrange(len(w)), rng.choice("etaoÿÀz")
            v = rng.choice([w[:k] + w[k + 1 :], w[:k] + c + w[k:], w[:k] + c + w[k + 1 :]])
            said += [v] * rng.choice([1, 4, 5, 26, 130])
            said += [v[:k] + v[k + 1 :]] * rng.choice([0, 5])
    said += ["".join(rng.sample("abcdefg", 7)) for _ in range(9000)]  # the same letters
    said += ["a" * 3000] * 30 + ["a" * 2999 + "b"] * 5 + ["a" * 3001] * 6 + ["Zusammen"] * 40 + ["ZUSAMMEN"] * 9 + ["zusammeN"] * 3 + ["zussammen"] * 5
    rng.shuffle(said)
    rows = [(k, " ".join(said[k::40]), "en", "a", 0) for k in range(40)]
    return rows + [(None, " ".join(said[:500]), "en", "a", 0), (3, rows[3][1], "en", "a", 0), *documents()]


@cache
def expected() -> list[tuple]:
    return plain(texts(), 2, 19)


@pytest.mark.parametrize(("cell", "sample", "fine"), [(4096, 200_000, 96), (256, 200_000, 8), (256, 100, 16)])
def test_words_of_awkward_texts(spark, monkeypatch, cell, sample, fine):
    for name, value in (("CELL", cell), ("SAMPLE", sample), ("FINE", fine), ("LEAST", 2)):
        monkeypatch.setattr(variants, name, value)
    table = spark.createDataFrame(texts(), SCHEMA).withColumnsRenamed({"lang": "word", "source": "n", "n_chars": "form"})
    got = sorted(tuple(r) for r in variants.group(table, least_count=2, every=19).collect())
    assert got == expected()
    assert any(r[1] is not None and r[1] != r[2] for r in got)


def test_words_of_nothing(spark):
    assert variants.group(spark.createDataFrame([], SCHEMA)).count() == 0
    assert variants.group(spark.createDataFrame([(1, None, "", "", 0), (2, "", "", "", 0)], SCHEMA)).count() == 0


def test_boxes_hold_all_that_a_step_reaches():
    rng = np.random.default_rng(2)
    points = rng.integers(0, 4, (800, variants.LETTERS)) * (rng.random((800, variants.LETTERS)) < 0.1)
    tree = variants.Tree(points, 8)
    assert sorted(np.concatenate(tree.leaves)) == list(range(800)) and len(tree) > 50
    for up, down in ((0, 0), (1, 0), (1, 1)):
        visits = {leaf: set(rows) for leaf, rows in tree.reached(points, up, down)}
        gap = points[None] - points[:, None]
        within = (np.maximum(gap, 0).sum(2) <= up) & (np.maximum(-gap, 0).sum(2) <= down)
        for leaf, rows in enumerate(tree.leaves):
            assert set(np.flatnonzero(within[:, rows].any(1))) <= visits.get(leaf, set())
        if not up:
            assert {k: v for k, v in visits.items()} == {k: set(rows) for k, rows in enumerate(tree.leaves)}


def test_the_query_equals_its_sql(spark):
    import duckdb

    from tallyline.llm.queries import llm_oracles, llm_queries

    folder = "/root/testdata/sf0.01"
    out = llm_queries()["op12_variants"](spark, folder)
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    expected = connection.sql(f"SELECT {', '.join(out.columns)} FROM ({llm_oracles()['op12_variants']})").fetchall()
    assert sorted(map(tuple, out.collect()), key=str) == sorted(expected, key=str) and expected
