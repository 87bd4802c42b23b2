"""Small documents with every awkward case, and plain versions of what the operators compute."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWERED = str.maketrans(UPPER, LOWER)
SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    parts = ["an", "the", "ré", "tion", "ber", "os", "mi", "ñu", "la", "er", "ing", "sch"]
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(n))


def documents() -> list[tuple]:
    """Rows of SCHEMA: copies, near copies, shared passages, nulls, empty and long texts."""
    base, passage = prose(1, 90), prose(2, 60)
    words = base.split()
    near = " ".join([*words[:40], "changed", *words[41:]])
    rows = [
        (1, base, "en", "a"),
        (2, base, "en", "a"),
        (3, near, "en", "b"),
        (4, prose(3, 50) + "\n" + passage + "\n" + prose(4, 30), "en", "a"),
        (5, passage + " " + prose(5, 70), "de", "a"),
        (6, None, "en", None),
        (7, "", "en", "a"),
        (8, " \t\n ", None, "a"),
        (9, "one", "en", "a"),
        (10, "one two", "en", "a"),
        (11, "one two", "fr", "a"),
        (12, prose(6, 6000), "en", "a"),
        (13, "same line here\n" * 30, "en", "a"),
        (14, "x" * 400, "en", "a"),
        (15, "x" * 300, "en", "a"),
        (16, "日本語のテキスト " * 40 + "🙂" * 30, "ja", "a"),
        (17, "日本語のテキスト " * 35, "ja", "a"),
        (18, "it's 12 o'clock, don't   wait!\r\n\r\nWe'LL see… <|endoftext|> ½ ²", "en", "a"),
        (20, base, "en", "a"),
        (20, base, "en", "a"),
        (None, prose(7, 30), "en", "a"),
    ]
    rows += [(100 + k, prose(100 + k, 60 + k), "en", "a") for k in range(40)]
    return [(i, t, lang, source, len(t or "")) for i, t, lang, source in rows]


def shingles(text: str | None, size: int) -> set:
    words = SPLIT.findall((text or "").translate(LOWERED))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}


def near_components(rows: list[tuple], size: int, percent: int) -> dict:
    """doc_id to the smallest doc_id of its component."""
    sets = {r[0]: shingles(r[1], size) for r in rows if r[0] is not None}
    root = {k: k for k in sets}

    def find(k: int) -> int:
        while root[k] != k:
            k = root[k]
        return k

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in sets}


def removed_bytes(rows: list[tuple], length: int) -> list[tuple]:
    """For each row its bytes, and a flag for each byte that a string of an earlier document covers."""
    out = []
    texts = [(i, (t or "").encode()) for i, t, *_ in rows]
    first: dict[bytes, int] = {}
    for i, raw in texts:
        if i is not None:
            for k in range(len(raw) - length + 1):
                s = raw[k : k + length]
                first[s] = min(i, first.get(s, i))
    for i, raw in texts:
        flags = [False] * len(raw)
        for k in range(len(raw) - length + 1):
            if i is not None and first[raw[k : k + length]] < i:
                flags[k : k + length] = [True] * length
        out.append((i, raw, flags))
    return out


def plain_base_failed(text: str | None) -> bool:
    words = SPLIT.findall(text or "")
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    covered = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(8)}
    return len(words) < 20 or 100 * len(covered) > 30 * len(words)
