"""Matches of a tokenizer's splitting expression, with its own meaning of \\p{L}, \\p{N} and \\s."""

from __future__ import annotations

import re

import regex

#: Characters whose classes are known without Unicode tables: ASCII without most controls, Latin
#: letters, and some marks. A text of these alone is split by the faster standard library.
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
OTHER = "×÷¡«»¿–—‘’“”…€"
BEYOND = re.compile(f"[^\\t\\n\\r\\x20-\\x7e{LETTERS}{OTHER}]")


def rewritten(pattern: str, inside: dict[str, str], outside: dict[str, str]) -> str:
    """The expression with its escapes replaced, differently within brackets."""
    out, at, bracket = [], 0, False
    while at < len(pattern):
        size = 5 if pattern.startswith(("\\p{L}", "\\p{N}"), at) else 2 if pattern[at] == "\\" else 1
        part = pattern[at : at + size]
        bracket = part == "[" or (bracket and part != "]")
        out.append((inside if bracket else outside).get(part, part))
        at += size
    return "".join(out)


ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d|"


def words_first(pattern: str) -> str:
    """The same matches, trying words before the English endings, which begin unlike any word."""
    first, _, rest = pattern.removeprefix(ENDINGS).partition("|")
    if not pattern.startswith(ENDINGS) or first not in (" ?\\p{L}+", "[\\p{L}]+"):
        return pattern
    return f"{first}|'(?:s|t|re|ve|m|ll|d)|{rest}"


class Matcher:
    def __init__(self, pattern: str):
        pattern = words_first(pattern)
        plain = {"\\p{L}": LETTERS, "\\p{N}": "0-9"}
        self.plain = re.compile(rewritten(pattern, plain, {k: f"[{v}]" for k, v in plain.items()} | {"\\S": "[^\\t-\\r ]", "\\s": "[\\t-\\r ]"}))
        white = {"\\s": "\\p{White_Space}", "\\S": "\\P{White_Space}"}
        self.whole = regex.compile(rewritten(pattern, white, white))

    def findall(self, text: str) -> list[str]:
        return (self.whole if BEYOND.search(text) else self.plain).findall(text)
