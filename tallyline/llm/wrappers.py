"""HTML extraction by wrappers: union-free regular expressions inferred from the pages of a host.

A page becomes a stream of elements and text slots. Equal neighbours, and equal runs of two or three
elements, become a repeated group; aligning two pages' expressions turns what only one of them has
into optional groups, and texts that differ into slots. A task folds its pages into one expression
for each host, and the tasks' expressions are folded in two further steps, by (host, salt) and by
host, so a host that a third of all pages belong to is a few small rows. Neighbours of a tag without
meaning (div, section) are a repetition only if they hold like elements. An expression grows with the
variety of the host's markup, not with its pages: an element of more than WIDEST children folds
those of one label into one group, and beyond that labels that one page alone has (generated
class names) into one of their tag.

On the finished expression, slots that vary over pages are content; elements of mostly links, and texts
that are the same on all of three or more pages of different text, are not. The region of a host is the
innermost element that holds DOMINANT of the varying text, not beyond a repetition, an article, or a
varying heading beside it. Every page is aligned with its host's expression, and what is aligned with
the region is its main element, if it holds at least half of the page's text; of main elements by name
in the region, those with most of its text take its place. Names alone decide only where
the expression does not: on hosts of fewer pages or of templates too different, and where an article or
main element lies apart from the region. They are then article, else main, else one named like them, the first that has
text on the page. Menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and reader comments are also dropped by their names,
but not an element that a page's text is in (`Page.layout`). Without a main element by name the marked elements
are dropped too, but texts of the host only where at least half of the page's text is left, so that copies
with a small difference do not remove their own text.
The texts of the elements that stay are the main text: references decoded, white space in a block made
one space, blocks joined by line ends. A header or heading within the article belongs to it.

Null and empty pages, and pages without main text, give an empty text. A page without a host is of
the host ''. Elements are read to any depth.
Repeated rows are extracted once each; extra columns pass through, those named like a new one are
replaced.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.bpe import added, schema_with
from tallyline.llm.storage import stored

LONGEST_RUN, PAGES_SEEN, SALTS, HOSTS_PER_TASK = 3, 3, 16, 2_000
BROADCAST_BYTES = 32_000_000
WIDEST, DOMINANT = 48, 0.8

#: Names of the HTML standard.
RAW = frozenset("script style noscript template iframe textarea title select option svg math object canvas video audio".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSES_LIKE = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
SCOPES = frozenset("ul ol dl table body article div section".split())
GENERIC = frozenset("div section".split())
REGIONS = GENERIC | frozenset("article main table tbody tr td center".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

DROPPED_TAGS = frozenset("head nav footer aside form button dialog menu".split()) | RAW
DROPPED_NAMES = re.compile(
    r"(?:^|[-_ ])(?:ads?|adverts?|advertisement|sponsor(?:ed)?|promo|banner|cookies?|consent|notice|popup|modal|newsletter|subscribe|share|sharing|social"
    r"|sidebar|side-bar|menu|nav|navbar|navigation|breadcrumbs?|footer|comments?|commentlist|replies|respond|disqus|related|widget|login|signup|search|complementary|contentinfo)(?:$|[-_ ])"
)
#: Names of the same words that tell how a page is laid out.
LAYOUT_NAMES = re.compile(r"(?:^|-|_| )(?:has|no|with|without|left|right|one|two|three|wrap|wrapper|container|inner|outer|row|grid|columns?|cols?|layout|content|main|page|site|enabled|disabled)(?:$|-|_| )")
TOP_ONLY = re.compile(r"(?:^|[-_ ])(?:header|masthead|topbar|top-bar)(?:$|[-_ ])")
MAIN_NAMES = re.compile(r"(?:^|[-_ ])(?:article|article-body|post|post-content|entry|entry-content|story|content|main|main-content)(?:$|[-_ ])")

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
DIGITS = re.compile(r"\d+")

# A node of a page: [label, children]; a text: (text, is it in a link).
# An element of an expression: [label, optional, repeated, seen, letters, letters in links, texts, children],
# where seen has the digests of up to PAGES_SEEN pages, and texts is the checksum of its own text, 0 before there is one and -1 for several.
# Its label is the page's, with HOLDER at its end if it is of a generic tag and has elements, or ANY for the names of those of one page each.
LABEL, OPTIONAL, REPEATED, SEEN, LETTERS, LINKED, TEXTS, CHILDREN = range(8)
HOLDER, ANY = "\n", " *"
REGION = 4


def label_of(tag: str, attributes: str) -> str:
    """The tag with the names it is given, without numbers."""
    if "=" not in attributes and "hidden" not in attributes:
        return tag
    names = []
    for name, value in ATTRIBUTE.findall(attributes):
        names += ["hidden"] if name.lower() == "hidden" else DIGITS.sub("", value.strip("\"'").lower()).split()
    return " ".join([tag, *sorted(set(names))])


def parsed(html: str) -> list:
    """The page as a tree of block elements; inline elements only tell which texts are links."""
    root = ["html", []]
    stack, links, at = [root], 0, 0
    tags, open_ = ["html"], Counter()
    lower = None
    for token in TOKEN.finditer(html):
        if token.start() < at:
            continue
        if token.start() > at:
            stack[-1][1].append((html[at : token.start()], links > 0))
        at = token.end()
        closing, tag, attributes = token.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            if tag == "a":
                links = max(0, links - 1)
            elif open_[tag]:
                last = ""
                while last != tag:
                    stack.pop()
                    last = tags.pop()
                    open_[last] -= 1
            continue
        if tag in RAW:
            lower = lower or html.lower()
            end = lower.find(f"</{tag}", at)
            end = len(html) if end < 0 else end
            close = html.find(">", end)
            at = len(html) if close < 0 else close + 1
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                stack[-1][1].append((" ", False) if tag == "br" else ["hr", []])
            continue
        label = label_of(tag, attributes) if attributes else tag
        if tag in INLINE and not (label != tag and (DROPPED_NAMES.search(label) or "hidden" in label)):
            links += tag == "a"
            continue
        if tag in ("html", "body"):
            continue
        if tag in CLOSES_P and tags[-1] == "p":
            stack.pop()
            open_[tags.pop()] -= 1
        like = CLOSES_LIKE.get(tag)
        if like:
            for k in range(len(tags) - 1, 0, -1):
                if tags[k] in like:
                    if tag != "tr" or tags[k] == "tr":
                        open_.subtract(tags[k:])
                        del stack[k:], tags[k:]
                    continue
                if tags[k] in SCOPES:
                    break
        node = [label, []]
        stack[-1][1].append(node)
        stack.append(node)
        tags.append(tag)
        open_[tag] += 1
    if at < len(html):
        stack[-1][1].append((html[at:], links > 0))
    return root


def room(depth: int) -> None:
    """Lets calls nest for elements of this depth; these are calls of Python alone, which need no C stack."""
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 4 * depth + 5_000))


def packed(root: list) -> str:
    """An expression as JSON: its elements in order, each with the number of its children."""
    out, stack = [], [root]
    while stack:
        element = stack.pop()
        out.append([*element[:CHILDREN], len(element[CHILDREN])])
        stack += reversed(element[CHILDREN])
    return json.dumps(out)


def unpacked(rows: list) -> list:
    """The expression of the parsed JSON."""
    root = [*rows[0][:CHILDREN], []]
    stack = [(root, rows[0][CHILDREN])]
    for row in rows[1:]:
        while len(stack[-1][0][CHILDREN]) == stack[-1][1]:
            stack.pop()
        element = [*row[:CHILDREN], []]
        stack[-1][0][CHILDREN].append(element)
        stack.append((element, row[CHILDREN]))
    return root


def read_wrapper(body: str) -> list:
    rows = json.loads(body)
    room(len(rows))
    return unpacked(rows)


def digest(root: list) -> int:
    """Of the texts of a page, whatever its attributes are."""
    out, stack = hashlib.blake2b(digest_size=6), [root]
    while stack:
        item = stack.pop()
        if isinstance(item, tuple):
            out.update(" ".join(item[0].split()).encode("utf-8", "surrogatepass") + b"\0")
        else:
            stack += reversed(item[1])
    return int.from_bytes(out.digest())


def key_of(node: list) -> str:
    """The label of a page's element in an expression."""
    holder = node[0].partition(" ")[0] in GENERIC and any(isinstance(c, list) and c[0] != "hr" for c in node[1])
    return node[0] + HOLDER if holder else node[0]


def any_of(label: str) -> str:
    """The label of elements of this tag with names of one page each."""
    return label.partition(" ")[0].strip() + ANY + (HOLDER if label.endswith(HOLDER) else "")


def alike(one: list, two: list) -> bool:
    """Whether two neighbours are a repetition."""
    if one[LABEL] != two[LABEL]:
        return False
    return not one[LABEL].endswith(HOLDER) or not {c[LABEL] for c in one[CHILDREN]}.isdisjoint(c[LABEL] for c in two[CHILDREN])


def expression(node: list, page: int) -> list:
    """The expression of one page's element; page is the page's digest."""
    letters = linked = check = 0
    children = []
    for child in node[1]:
        if isinstance(child, tuple):
            size = len(child[0]) if not child[0].isspace() else 0
            if size:
                letters += size
                linked += size if child[1] else 0
                check = zlib.crc32(child[0].strip().encode(), check)
        else:
            add_to(children, expression(child, page))
    return [key_of(node), 0, 0, [page], letters, linked, check, bounded(runs_folded(children))]


def add_to(children: list, child: list) -> None:
    """Puts an element behind the others; with one like it before it becomes a repetition."""
    if children and alike(children[-1], child):
        children[-1] = folded(children[-1], child)
        children[-1][REPEATED] = 1
    else:
        children.append(child)


def bounded(children: list) -> list:
    """With more than WIDEST children, one of each label, then one of each tag for labels that one page alone has."""
    if len(children) <= WIDEST:
        return children
    children = grouped(children, [c[LABEL] for c in children])
    if len(children) <= WIDEST:
        return children
    return grouped(children, [any_of(c[LABEL]) if len(c[SEEN]) == 1 and " " in c[LABEL] else c[LABEL] for c in children])


def grouped(children: list, labels: list[str]) -> list:
    """One child of each label, where its first was."""
    found: dict[str, list] = {}
    for child, label in zip(children, labels, strict=True):
        child = [label, *child[1:]]
        if label in found:
            found[label] = folded(found[label], child)
            found[label][OPTIONAL] = found[label][REPEATED] = 1
        else:
            found[label] = child
    return list(found.values())


def runs_folded(children: list) -> list:
    """Equal runs of two or three elements, one after another, become one repeated run."""
    for size in range(2, LONGEST_RUN + 1):
        k = 0
        while k + 2 * size <= len(children):
            if all(map(alike, children[k : k + size], children[k + size : k + 2 * size])):
                for i in range(size):
                    children[k + i] = folded(children[k + i], children[k + size + i])
                    children[k + i][REPEATED] = 1
                del children[k + size : k + 2 * size]
            else:
                k += 1
    return children


def folded(one: list, two: list) -> list:
    """The expression of what either matches; what one of them lacks becomes optional."""
    left, right = one[CHILDREN], two[CHILDREN]
    if [c[LABEL] for c in left] == [c[LABEL] for c in right]:
        children = [folded(a, b) for a, b in zip(left, right, strict=True)]
    else:
        children = []
        match = SequenceMatcher(None, [c[LABEL] for c in left], [c[LABEL] for c in right], autojunk=False)
        for kind, a, b, c, d in match.get_opcodes():
            if kind == "equal":
                children += [folded(x, y) for x, y in zip(left[a:b], right[c:d], strict=True)]
            else:
                children += [[x[0], 1, *x[2:]] for x in left[a:b] + right[c:d]]
        joined = []
        for child in children:
            add_to(joined, child)
        children = bounded(runs_folded(joined))
    texts = one[TEXTS] if one[TEXTS] == two[TEXTS] else -1
    seen = one[SEEN] if one[SEEN] == two[SEEN] else sorted({*one[SEEN], *two[SEEN]})[:PAGES_SEEN]
    return [one[0], one[1] | two[1], one[2] | two[2], seen, one[4] + two[4], one[5] + two[5], texts, children]


def shown(element: list) -> str:
    """The expression as text: ( )? and ( )+ for optional and repeated elements, # for a slot."""
    if isinstance(element[0], list):
        element = unpacked(element)
    inner = ("#" if element[TEXTS] == -1 else "text" if element[TEXTS] else "") + "".join(map(shown, element[CHILDREN]))
    body = f"<{element[LABEL].strip()}>{inner}</>"
    mark = "*" if element[OPTIONAL] and element[REPEATED] else "?" if element[OPTIONAL] else "+" if element[REPEATED] else ""
    return f"({body}){mark}" if mark else body


def names_of(label: str) -> tuple[str, str]:
    tag, _, names = label.strip().partition(" ")
    return tag, names


def dropped_by_tag(label: str) -> bool:
    tag, names = names_of(label)
    return tag in DROPPED_TAGS or "hidden" in names.split()


def dropped_by_name(label: str) -> bool:
    return DROPPED_NAMES.search(names_of(label)[1]) is not None


def dropped_outside(label: str) -> bool:
    """Whether it is dropped unless it is within the main element."""
    tag, names = names_of(label)
    return tag == "header" or TOP_ONLY.search(names) is not None


def main_kind(label: str) -> int | None:
    """0: article, 1: main, 2: others with such a name."""
    tag, names = names_of(label)
    return 0 if tag == "article" else 1 if tag == "main" or "main" in names.split() else 2 if MAIN_NAMES.search(names) else None


def rules(root: list) -> list:
    """The expression as [label, marks, children]: 1 mostly links, 2 the same text on all pages, REGION the host's region."""
    made = [root[LABEL], 0, []]
    order, stack, inner = [], [(root, made, -1)], []
    while stack:
        element, rule, parent = stack.pop()
        number = len(order)
        order.append((element, rule, parent))
        inner.append([])
        if number:
            inner[parent].append(number)
        for child in element[CHILDREN]:
            rule[2].append([child[LABEL], 0, []])
            stack.append((child, rule[2][-1], number))
    totals = [[e[LETTERS], e[LINKED]] for e, _, _ in order]
    slots = [e[LETTERS] - e[LINKED] if e[TEXTS] == -1 else 0 for e, _, _ in order]
    heads = [names_of(e[LABEL])[0] in HEADINGS and slots[n] > 0 for n, (e, _, _) in enumerate(order)]
    for number in range(len(order) - 1, -1, -1):
        element, rule, parent = order[number]
        letters, linked = totals[number]
        links = element[LABEL] != "html" and letters > 0 and 2 * linked > letters
        rule[1] = int(links) | 2 * int(len(element[SEEN]) >= PAGES_SEEN and element[TEXTS] > 0)
        if links or dropped_anyhow(element[LABEL]):
            slots[number], heads[number] = 0, False
        if number:
            totals[parent][0] += letters
            totals[parent][1] += linked
            slots[parent] += slots[number]
            heads[parent] = heads[parent] or heads[number]
    at = 0
    while len(root[SEEN]) >= PAGES_SEEN and inner[at] and slots[at]:
        best = max(inner[at], key=slots.__getitem__)
        element, tag = order[best][0], names_of(order[best][0][LABEL])[0]
        beside = any(heads[n] for n in inner[at] if n != best)
        if tag not in REGIONS or element[REPEATED] or beside or slots[best] < DOMINANT * slots[at]:
            break
        at = best
        if tag == "article":
            break
    if at:
        order[at][1][1] |= REGION
    return made


def dropped_anyhow(label: str) -> bool:
    """Whether its tag or name drops it, and it is no layout."""
    return dropped_by_tag(label) or dropped_outside(label) or (dropped_by_name(label) and not LAYOUT_NAMES.search(names_of(label)[1]))


class Page:
    """The elements of a page in order, aligned with its host's expression, and its texts between block ends."""

    def __init__(self, html: str, rule: list):
        self.labels, self.parents, self.marks = ["html"], [-1], [rule[1]]
        self.texts: list[tuple[int, str, bool] | None] = []  # None: a block begins or ends
        stack = [[0, iter(parsed(html)[1]), rule[2], 0]]
        while stack:
            top = stack[-1]
            number, nodes, children, k = top
            for child in nodes:
                if isinstance(child, tuple):
                    self.texts.append((number, *child))
                    continue
                self.texts.append(None)
                key = key_of(child)
                if not (k < len(children) and children[k][0] == key):
                    order = [*range(k, len(children)), *range(k)]
                    k = next((i for x in (key, any_of(key)) for i in order if children[i][0] == x), k)
                same = k < len(children) and children[k][0] in (key, any_of(key))
                top[3] = k
                self.labels.append(child[0])
                self.parents.append(number)
                self.marks.append(children[k][1] if same else 0)
                stack.append([len(self.labels) - 1, iter(child[1]), children[k][2] if same else [], 0])
                break
            else:
                stack.pop()
                self.texts.append(None)
        self.by_tag = [dropped_by_tag(x) for x in self.labels]
        self.by_name = [dropped_by_name(x) for x in self.labels]
        self.outside = [dropped_outside(x) for x in self.labels]
        self.kinds = [main_kind(x) for x in self.labels]
        for number in self.layout():
            self.by_name[number] = False

    def sums(self, linked: bool, dropped: list[bool]) -> list[int]:
        """For each element the letters in it, with those in links or not, but without dropped elements in it."""
        out = [0] * len(self.labels)
        for number, text, link in filter(None, self.texts):
            if (linked or not link) and not text.isspace():
                out[number] += len(text)
        for number in range(len(out) - 1, 0, -1):
            if not dropped[number]:
                out[self.parents[number]] += out[number]
        return out

    def letters(self, keep: list[bool]) -> int:
        return sum(len(text) for number, text, _ in filter(None, self.texts) if keep[number] and not text.isspace())

    def dropped(self) -> list[bool]:
        return [a or b for a, b in zip(self.by_tag, self.by_name, strict=True)]

    def layout(self) -> list[int]:
        """Elements with a dropped name that hold the page's text.

        Such an element stays if most of the page's text outside links is in it, and there is no main
        element outside elements of that kind, or less text in that than in main elements within, or
        the name is one of layouts; and a layout that holds the only main element stays.
        """
        named = [n for n, x in enumerate(self.by_name) if x and not self.by_tag[n]]
        if not named:
            return []
        chosen = self.mains()
        letters = self.sums(False, self.by_tag)
        clean = self.sums(True, self.dropped())
        outside = sum(clean[n] for n in chosen)
        inner = [0] * len(letters)
        for number in range(len(letters) - 1, 0, -1):
            if self.by_tag[number]:
                continue
            if self.kinds[number] is not None and not self.by_name[number]:
                inner[number] = clean[number] or inner[number]
            inner[self.parents[number]] += inner[number]
        out = []
        for n in named:
            layout = LAYOUT_NAMES.search(names_of(self.labels[n])[1]) is not None
            most = 2 * letters[n] > letters[0]
            if most and (not chosen or inner[n] > outside or layout) or layout and not chosen and inner[n]:
                out.append(n)
        return out

    def mains(self) -> list[int]:
        """The outermost main elements of the first kind that has text."""
        dropped = self.dropped()
        letters = self.sums(True, dropped)
        for kind in range(3):
            found, closed = [], [False] * len(letters)
            for number, parent in enumerate(self.parents):
                closed[number] = (number > 0 and closed[parent]) or dropped[number] or self.outside[number]
                if not closed[number] and self.kinds[number] == kind and letters[number]:
                    found.append(number)
                    closed[number] = True
            if found:
                return found
        return []

    def region(self) -> list[int]:
        """The elements aligned with the host's region, if they hold at least half of the page's text."""
        dropped = self.dropped()
        letters = self.sums(False, dropped)
        found, closed = [], [False] * len(letters)
        for number, parent in enumerate(self.parents):
            closed[number] = (number > 0 and closed[parent]) or dropped[number] or self.outside[number]
            if not closed[number] and self.marks[number] & REGION:
                found.append(number)
                closed[number] = True
        return found if 2 * sum(letters[n] for n in found) >= letters[0] else []

    def main_elements(self) -> tuple[list[int], bool]:
        """The elements that the text is in, by the expression, else by names; and whether they have such names."""
        named, region = self.mains(), self.region()
        if not region:
            return named, bool(named)
        within = self.inside(region)
        own = [n for n in named if within[n]]
        letters = self.sums(True, self.dropped())
        if 2 * sum(letters[n] for n in own) >= sum(letters[n] for n in region):
            return own, True
        apart = self.inside(named)
        if named and not own and self.kinds[named[0]] in (0, 1) and not any(apart[n] for n in region):
            return named, True
        return region, False

    def inside(self, chosen: list[int]) -> list[bool]:
        """Whether each element is one of these or in one."""
        out, those = [], set(chosen)
        for number, parent in enumerate(self.parents):
            out.append(number in those or (number > 0 and out[parent]))
        return out

    def kept(self, chosen: list[int], named: bool, constant: bool) -> list[bool]:
        """Whether the own text of each element stays; without a main element by name, constant texts are dropped."""
        dropped, mains = self.dropped(), set(chosen)
        inside, gone, out = [False] * len(dropped), [False] * len(dropped), []
        for number, parent in enumerate(self.parents):
            inside[number] = number in mains or (number > 0 and inside[parent])
            gone[number] = (number > 0 and gone[parent]) or dropped[number] or (self.outside[number] and not inside[number])
            marks = 0 if named else self.marks[number]
            gone[number] = gone[number] or marks & 1 > 0
            out.append(not gone[number] and not (constant and marks & 2) and (inside[number] or not chosen))
        return out


def main_text(html: str, rule: list) -> str:
    """The texts of the kept elements of a page that is aligned with its host's expression."""
    page = Page(html, rule)
    chosen, named = page.main_elements()
    keep, every = (page.kept(chosen, named, constant) for constant in (True, False))
    if 2 * page.letters(keep) < page.letters(every):
        keep = every
    out, piece = [], []
    for part in [*page.texts, None]:
        if part is not None:
            if keep[part[0]]:
                piece.append(part[1])
        elif piece:
            text = " ".join(unescape("".join(piece)).split())
            piece.clear()
            if text:
                out.append(text)
    return "\n".join(out)


def with_host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    return pages.withColumn("host", host)


def infer(pages: DataFrame) -> DataFrame:
    """host and wrapper (an expression as JSON) over all pages."""

    def fold_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list] = {}
        for batch in batches:
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                room((html or "").count("<"))
                page = parsed(html or "")
                made = expression(page, digest(page))
                found[host] = folded(found[host], made) if host in found else made
            if len(found) > HOSTS_PER_TASK:
                yield rows_of(found)
                found = {}
        yield rows_of(found)

    def rows_of(found: dict[str, list]) -> pa.RecordBatch:
        bodies = [packed(e) for e in found.values()]
        return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(bodies, pa.string())], names=["host", "wrapper"])

    def fold(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = None
        for batch in batches:
            for body in sorted(batch.column(batch.schema.names.index("wrapper")).to_pylist()):
                made = folded(made, read_wrapper(body)) if made else read_wrapper(body)
        yield rows_of({key[0].as_py(): made})

    kind = "host string, wrapper string"
    parts = pages.select("host", "html").mapInArrow(fold_pages, kind)
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)))
    return salted.groupBy("host", "salt").applyInArrow(fold, kind).groupBy("host").applyInArrow(fold, kind)


def extract(pages: DataFrame) -> DataFrame:
    """The rows with text, the main text of the page.

    Wrappers of up to BROADCAST_BYTES in all are broadcast; more are joined by host, where the rows
    of a hot host are split at run time.
    """
    pages = with_host(pages)
    wrappers = stored(infer(pages), "wrappers")
    size = wrappers.agg(F.sum(F.length("wrapper"))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        known = {r["host"]: r["wrapper"] for r in wrappers.collect()}
        shared = pages.sparkSession.sparkContext.broadcast(known)
        source = pages
    else:
        shared = None
        source = pages.join(wrappers.withColumnRenamed("wrapper", "wrapper_of_host"), "host")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: dict[str, list] = {}
        for batch in batches:
            names, texts = batch.schema.names, []
            bodies = None if shared else batch.column(names.index("wrapper_of_host")).to_pylist()
            hosts, htmls = (batch.column(names.index(c)).to_pylist() for c in ("host", "html"))
            for k, (host, html) in enumerate(zip(hosts, htmls, strict=True)):
                if host not in ready:
                    if len(ready) > HOSTS_PER_TASK:
                        ready.clear()
                    ready[host] = rules(read_wrapper(shared.value[host] if shared else bodies[k]))
                texts.append(main_text(html, ready[host]) if html else "")
            made = added(batch, {"text": pa.array(texts, pa.string())})
            yield made.select([n for n in made.schema.names if n not in ("host", "wrapper_of_host")])

    schema = schema_with(source, text=T.StringType())
    return source.mapInArrow(run, T.StructType([f for f in schema if f.name not in ("host", "wrapper_of_host")]))
