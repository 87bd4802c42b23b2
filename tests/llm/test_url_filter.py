"""Rules against plain string work, and both language models against dictionaries of sequences."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.llm import url_filter

from .cases import LOWERED

SCHEMA = "page_id long, url string, html string, host string, part string, row string"
TLDS, LANGS = ["org", "com", "net"], ["en", "es", "fr", "de"]


def pages(n: int = 500) -> list[tuple]:
    rng = random.Random(4)
    rows = []
    for k in range(n):
        site = "".join(rng.choices(["tion", "ber", "WWW.", "al", "x"], k=3))
        rows.append((k, f"http{rng.choice(['', 's'])}://{site}.example.{rng.choice(TLDS)}/{rng.choice(LANGS)}/{rng.randrange(2000)}{rng.choice(['', '?a=/b', '#top', '.html'])}"))
    odd = [None, "", "no scheme/com/fr/", "://", "x://org", "x://ORG/", "x://notorg/a", "x://a.org", "x://a.org?x/", "x://a.org/é/日本🙂", "x://com/fr/", "x://com/FR/",
           "x://a.com:80/fr/", "a://b.com/de/://c.org/", "x://\n.org/\n", "x://example.org/es", "x://example.org/es/", "x://sub.example.org/en/1", "x://example.org/en/2",
           "x://fexample.org/en/1", "x://.org/", "y://z.net/" + "abc/" * 3000, "y://w.org/" + "fr/" * 2000]
    rows += [(1000 + k, u) for k, u in enumerate(odd)]
    rows += [(None, "x://b.net/fr/5"), (3, rows[3][1]), (3, rows[3][1])] + [(2000 + k, "x://hot.example.net/fr/7") for k in range(300)]
    return [(*r, "clash", "clash", "clash", "clash") for r in rows]


def parts_of(url: str | None) -> tuple[str, str]:
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:end].translate(LOWERED), rest[end:]
    return host, rest[: min([rest.index(c) for c in "?#" if c in rest], default=len(rest))]


def rule_of(host: str, path: str) -> tuple[str | None, str | None]:
    found = (None, None)
    for verdict, rule in sorted(url_filter.RULES, key=lambda r: len(r[1])):
        name, start = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            found = rule, verdict
    return found


def plain_differences(texts: list[str], known: list[tuple[str, str]], order: int, least: int) -> list[float]:
    """By counts of sequences as tuples; known holds texts and verdicts."""

    def steps(text: str):
        row = ["<", *text, ">"]
        for i in range(1, len(row)):
            for m in range(min(order, i) + 1):
                yield i, m, (*row[i - m : i],), row[i]

    counts = {v: Counter((c, s) for t, said in known if said == v for _, _, c, s in steps(t)) for v in ("allow", "block")}
    keep = {z for z in {*counts["allow"], *counts["block"]} if len(z[0]) < 2 or counts["allow"][z] + counts["block"][z] >= least}
    follow = {v: {} for v in counts}
    for v, own in counts.items():
        for z in keep:
            if own[z]:
                t, d = follow[v].get(z[0], (0, 0))
                follow[v][z[0]] = (t + own[z], d + 1)
    out = []
    for text in texts:
        total = 0.0
        chance = {}
        for i, m, context, s in steps(text):
            for v, own in counts.items():
                before = chance[i, v] if m else 1 / url_filter.SYMBOLS
                t, d = follow[v].get(context, (0, 0))
                n = own[context, s] if (context, s) in keep else 0
                chance[i, v] = (n + d * before) / (t + d) if t else before
        for i in range(1, len(text) + 2):
            total += math.log(chance[i, "allow"]) - math.log(chance[i, "block"])
        out.append(total / (len(text) + 1))
    return out


@pytest.mark.parametrize(("step", "part", "order"), [(200_000, 2048, 5), (50, 8, 5), (7, 64, 2)])
def test_verdicts_of_awkward_addresses(spark, monkeypatch, step, part, order):
    monkeypatch.setattr(url_filter, "STEP", step)
    monkeypatch.setattr(url_filter, "PART", part)
    rows = pages()
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted((tuple(r) for r in url_filter.judge(table, order=order).collect()), key=str)
    told = [(i, *parts_of(u)) for i, u, *_ in rows]
    assert sorted((g[:3] for g in got), key=str) == sorted(told, key=str)
    for _, host, path, rule, verdict, score in got:
        expected, said = rule_of(host, path)
        assert rule == expected and verdict == (said or ("allow" if score >= 0.5 else "block")) and 0 <= score <= 1
    texts = sorted({h + p for _, h, p in told})
    fold = {r["t"]: r["f"] for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", (F.pmod(F.xxhash64("t"), F.lit(5)) == 0).alias("f")).collect()}
    labelled = [(h + p, rule_of(h, p)[1]) for _, h, p in told if rule_of(h, p)[1]]
    difference = dict(zip(texts, plain_differences(texts, [(t, v) for t, v in labelled if not fold[t]], order, 2), strict=True))
    bins = Counter((round(max(-20, min(20, difference[t])) * 1000) / 1000, v) for t, v in labelled if fold[t])
    slope, shift = url_filter.curve([(x, v, n) for (x, v), n in sorted(bins.items())])
    for _, host, path, *_, score in got:
        assert score == pytest.approx(1 / (1 + math.exp(-(slope * difference[host + path] + shift))), rel=1e-2, abs=1e-6)


def test_models_tell_held_out_addresses(spark):
    """Addresses that a rule judges, and no model has seen, get the rule's verdict from the score."""
    rows = url_filter.judge(spark.read.parquet("/root/testdata/sf0.1/pages.parquet")).withColumn("text", F.concat("host", "path"))
    seen = rows.filter("rule IS NOT NULL").filter(F.pmod(F.xxhash64("text"), F.lit(url_filter.FOLD)) == 0)
    right = seen.select(F.avg(((F.col("score") >= 0.5) == (F.col("verdict") == "allow")).cast("int"))).first()[0]
    assert right > 0.97


@pytest.mark.parametrize(("urls", "verdict"), [(["x://a.net/", "x://b.org/"], "allow"), (["x://a.net/", "x://b.com/de/"], "block"), (["x://a.net/", None], "allow")])
def test_verdicts_without_both_kinds(spark, urls, verdict):
    rows = [(k, u, "", "", "", "") for k, u in enumerate(urls)]
    assert {r["verdict"] for r in url_filter.judge(spark.createDataFrame(rows, SCHEMA)).collect()} == {verdict}
    assert url_filter.judge(spark.createDataFrame([], SCHEMA)).count() == 0


def test_curve_needs_both_verdicts():
    assert url_filter.curve([]) is None and url_filter.curve([(1.0, "allow", 5)]) is None
    slope, shift = url_filter.curve([(x / 10, "allow" if x > 3 else "block", 7) for x in range(-20, 20)])
    assert slope > 0 and 0.2 < -shift / slope < 0.5
    assert np.isfinite(url_filter.curve([(-1.0, "block", 10**9), (1.0, "allow", 1)])).all()
