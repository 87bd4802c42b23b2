"""Dedup of passages: bytes that repeat a passage of an earlier document are removed.

A string of LENGTH bytes goes if it starts in an earlier document too. That is read off suffix order:
longest previous factors tell how much each suffix shares with one of an earlier document. In suffix
order the best such match lies at the previous or the next place whose document is smaller, and what is
shared with it is the least of what neighbours share in between. Places whose factor reaches LENGTH
bytes mark the bytes that go, so the first copy stays. A longer match is the sum of those that begin one
byte on, so suffixes are compared for LENGTH bytes, eight at a time, and no further.

One suffix order of a whole corpus does not split into parts. But only suffixes that share LENGTH bytes
must meet, so the order is built for parts in which these are together.

The work is done in parts that never need the whole corpus. Each string belongs to its anchor, the
smallest hash among its ANCHOR-byte substrings, so equal strings have equal anchors, and neighbouring
strings mostly share one: a text is a row of segments, each with one anchor and the strings that
belong to it. Then

1. documents are dealt to groups; every group sends the distinct anchors it has, by hash bucket,
2. every bucket tells each group which of its anchors other groups have too,
3. every group sends the distinct segments of repeated anchors, each with its smallest doc_id,
4. every bucket takes each distinct segment once, with its smallest doc_id, puts the suffixes that are
   long enough in order, finds their longest previous factors and answers, for every segment sent, which
   of its strings have an earlier match: all, if the same segment has a smaller doc_id,
5. every group marks the bytes of those strings.

An anchor of more than HOT_SEGMENTS segments in all is split: its strings are not sent as segments to the
bucket of the anchor, but one by one, as hashes with their smallest doc_id in the group, to the buckets
of the hashes, whose bytes are put in order there. Equal strings have equal anchors, so either all of
them take this way or none.

A group sends an anchor, segment or string once, however many of its documents have it, so a passage that a
third of all documents share is a few rows for each group. Anchors and segments are told apart by 64-bit
hashes.

Null texts are empty. Strings of the same doc_id do not remove each other, so repeated rows of a
document are treated alike; rows without doc_id are kept whole and remove nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.bpe import added
from tallyline.llm.textbytes import ROOT, blocks, eights, mix, release_memory, string_hashes, utf8

LENGTH, ANCHOR = 50, 24
GROUP_BYTES, GROUPS_PER_TASK, BUCKET_BYTES = 4_000_000, 4, 4_000_000
MESSAGE = "group long, bucket long, kind int, body binary"
ANCHORS, SEGMENTS, STRINGS = 1, 3, 4
HOT_SEGMENTS = 50_000
ANCHOR_BYTES = 5
CACHED_BYTES = 100_000  # texts whose hashes stay in a core's cache while their segments are cut


class Segments(NamedTuple):
    """Rows of strings that share an anchor; places are those in the bytes of all texts."""

    anchor: np.ndarray
    first: np.ndarray  # where the first string begins
    count: np.ndarray  # strings, each one byte on
    text: np.ndarray  # number of the text
    code: np.ndarray  # hash of the bytes of all its strings


def segments(data: np.ndarray, at: np.ndarray, length: int) -> Segments:
    """The segments of the texts of a block, in order.

    The anchor is the leftmost of the smallest upper halves of the hashes, so it depends on the
    string alone.
    """
    n = len(data)
    if n < length:
        return Segments(*(np.zeros(0, k) for k in (np.uint64, np.int64, np.int64, np.int64, np.uint64)))
    words = eights(data)
    hashes = string_hashes(words, ANCHOR)
    key = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    width, wide = 1, length - ANCHOR + 1
    while width * 2 <= wide:
        key = np.minimum(key[: len(key) - width], key[width:])
        width *= 2
    if wide > width:
        key = np.minimum(key[: len(key) - (wide - width)], key[wide - width :])
    chosen = key.astype(np.uint32)
    valid = np.ones(n - length + 1, bool)
    for begin, end in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        valid[max(begin, end - length + 1) : end] = False
    apart = chosen[1:] != chosen[:-1]
    begins, ends = valid.copy(), valid
    begins[1:] &= apart | ~valid[:-1]
    ends[:-1] &= apart | ~ends[1:]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends)
    count = last - first + 1
    text = np.searchsorted(at, first, "right") - 1
    return Segments(hashes[chosen[first]], first, count, text, segment_codes(words, first, count, length))


def segment_codes(words: np.ndarray, first: np.ndarray, count: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the bytes of segments of count strings, of which the first one begins at first.

    A segment is shorter than two strings, so its first and last string tell all of its bytes.
    """
    code = string_hashes(words, length, first) * np.uint64(ROOT) ^ string_hashes(words, length, first + count - 1)
    return mix(code + count.astype(np.uint64))


class Group:
    """The documents of a group in a fixed order, and the segments of those with a doc_id."""

    def __init__(self, table: pa.Table, length: int):
        order = [("doc_id", "ascending"), ("text", "ascending")]
        self.table = table.combine_chunks().sort_by(order)
        self.length = length
        self.data, self.at = utf8(self.table.column("text"))
        ids = self.table.column("doc_id").cast(pa.int64()).combine_chunks()
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        parts = []
        for a, b in blocks(self.at, CACHED_BYTES):
            s = segments(self.data[self.at[a] : self.at[b]], self.at[a : b + 1] - self.at[a], length)
            s = s._replace(first=s.first + self.at[a], text=s.text + a)
            keep = known[s.text]
            parts.append(Segments(*(x[keep] for x in s)))
        empty = segments(self.data[:0], np.zeros(1, np.int64), length)
        self.segments = Segments(*(np.concatenate(x) for x in zip(empty, *parts, strict=True)))


def mask_type(length: int) -> np.dtype:
    """Of a mask with a bit for each string that a segment can have."""
    for kind in ("<u4", "<u8"):
        if length - ANCHOR + 1 <= 8 * np.dtype(kind).itemsize:
            return np.dtype(kind)
    raise ValueError(f"strings of {length} bytes are too long for anchors of {ANCHOR}")


def bucket_of(anchor: np.ndarray, buckets: int) -> np.ndarray:
    return ((anchor >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def shortened(anchor: np.ndarray) -> np.ndarray:
    """The lower bytes; equal anchors stay equal, and a chance match costs work, not results."""
    return anchor & np.uint64((1 << 8 * ANCHOR_BYTES) - 1)


def as_bytes(values: np.ndarray, size: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]).tobytes()


def from_bytes(body: bytes, size: int) -> np.ndarray:
    out = np.zeros((len(body) // size, 8), np.uint8)
    out[:, :size] = np.frombuffer(body, np.uint8).reshape(-1, size)
    return out.view("<u8").ravel()


def messages(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 4
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["group", "bucket", "kind", "body"])


def keys_of(anchor: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and shortened anchor in one number."""
    return shortened(anchor) | (bucket_of(anchor, buckets).astype(np.uint64) << np.uint64(8 * ANCHOR_BYTES))


def split_by(bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each value of ascending numbers, and where it stands."""
    if len(bucket):
        cut = np.append(np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])), len(bucket))
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            yield int(bucket[a]), slice(a, b)


def anchor_messages(number: int, group: Group, buckets: int) -> Iterator[tuple[int, int, int, bytes]]:
    """For each bucket the anchors, and of each the number of its segments as a power of two, rounded up."""
    keys, times = np.unique(keys_of(group.segments.anchor, buckets), return_counts=True)
    powers = np.ceil(np.log2(times)).astype(np.uint8)
    for bucket, own in split_by((keys >> np.uint64(8 * ANCHOR_BYTES)).astype(np.int64)):
        yield number, bucket, ANCHORS, as_bytes(keys[own], ANCHOR_BYTES) + powers[own].tobytes()


def contained(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def shared_anchors(hot: int = HOT_SEGMENTS) -> Callable:
    """For every group of a bucket, two bits for each of its anchors: whether another group has it, and
    whether it has more than `hot` segments in all."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        bodies = rows.column("body").to_pylist()
        cuts = [len(b) // (ANCHOR_BYTES + 1) * ANCHOR_BYTES for b in bodies]
        lists = [from_bytes(b[:c], ANCHOR_BYTES) for b, c in zip(bodies, cuts, strict=True)]
        powers = np.concatenate([np.frombuffer(b, np.uint8, offset=c) for b, c in zip(bodies, cuts, strict=True)])
        every = np.concatenate(lists)
        order = np.argsort(every)
        every = every[order]
        heads = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
        distinct, groups_of = every[heads], np.diff(np.append(heads, len(every)))
        times = np.add.reduceat(np.int64(1) << powers[order].astype(np.int64), heads)
        answers = [distinct[groups_of > 1], distinct[times > hot]]
        groups, bucket = rows.column("group").to_pylist(), key[0].as_py()
        found = [b"".join(np.packbits(contained(own, x)).tobytes() for x in answers) for own in lists]
        yield messages([(g, bucket, ANCHORS, body) for g, body in zip(groups, found, strict=True)])

    return run


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and which of them each value is."""
    order = np.argsort(values)
    ordered = values[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    place = np.empty(len(values), np.int64)
    place[order] = np.cumsum(fresh) - 1
    return ordered[fresh], place


class Strings:
    """The strings of some segments of a group, one by one."""

    def __init__(self, group: Group, chosen: np.ndarray, buckets: int):
        count = group.segments.count[chosen]
        place = np.repeat(group.segments.first[chosen], count) + within(count)
        doc = np.repeat(group.ids[group.segments.text[chosen]], count)
        code = np.zeros(len(place), np.uint64)
        for a, b in blocks(group.at) if len(place) else ():
            first, last = np.searchsorted(place, group.at[[a, b]])
            if first < last:
                words = eights(group.data[group.at[a] : group.at[b]])
                code[first:last] = string_hashes(words, group.length, place[first:last] - group.at[a])
        bucket = (code % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((doc, code, bucket))
        self.place, self.doc, code, bucket = place[order], doc[order], code[order], bucket[order]
        fresh = np.ones(len(code), bool)
        fresh[1:] = code[1:] != code[:-1]
        #: for every string, the distinct one; of equal ones, the smallest doc_id first
        self.head = np.flatnonzero(fresh)
        self.owner = np.cumsum(fresh) - 1
        self.code, self.bucket = code[self.head], bucket[self.head]

    def sent(self, number: int) -> Iterator[tuple[int, int, int, bytes]]:
        """For each bucket: the smallest doc_ids and the hashes of the distinct strings."""
        for bucket, own in split_by(self.bucket):
            docs = self.doc[self.head[own]].astype("<i8")
            yield number, bucket, STRINGS, docs.tobytes() + self.code[own].astype("<u8").tobytes()

    def earlier(self, answers: dict[int, bytes]) -> np.ndarray:
        """Where strings with an earlier match begin."""
        if not len(self.head):
            return self.place
        flags = [np.unpackbits(np.frombuffer(answers[b], np.uint8), count=s.stop - s.start) for b, s in split_by(self.bucket)]
        elsewhere = np.concatenate(flags).astype(bool)[self.owner]
        return self.place[elsewhere | (self.doc > self.doc[self.head][self.owner])]


class Repeats:
    """The segments of a group whose anchor another group has, or another document of this one."""

    def __init__(self, group: Group, answers: dict[int, bytes], buckets: int):
        own = group.segments
        key = keys_of(own.anchor, buckets)
        keys, place = distinct(key)
        flags = [np.zeros((2, 0), np.uint8)]
        for b, s in split_by((keys >> np.uint64(8 * ANCHOR_BYTES)).astype(np.int64)):
            flags.append(np.unpackbits(np.frombuffer(answers[b], np.uint8).reshape(2, -1), axis=1, count=s.stop - s.start))
        elsewhere, hot = np.concatenate(flags, axis=1).astype(bool)
        doc = group.ids[own.text]
        low, high = np.full(len(keys), np.iinfo(np.int64).max), np.full(len(keys), np.iinfo(np.int64).min)
        np.minimum.at(low, place, doc)
        np.maximum.at(high, place, doc)
        repeated = (elsewhere | (low < high))[place]
        self.strings = Strings(group, np.flatnonzero(repeated & hot[place]), buckets)
        chosen = np.flatnonzero(repeated & ~hot[place])
        bucket = (key[chosen] >> np.uint64(8 * ANCHOR_BYTES)).astype(np.int64)
        code = own.code[chosen]
        order = np.lexsort((doc[chosen], code, bucket))
        chosen, bucket, code = chosen[order], bucket[order], code[order]
        fresh = np.ones(len(chosen), bool)
        fresh[1:] = (bucket[1:] != bucket[:-1]) | (code[1:] != code[:-1])
        #: for every segment, the distinct one of the same bytes; of these, the smallest doc_id first
        self.first, self.count, self.doc = own.first[chosen], own.count[chosen], doc[chosen]
        self.head = np.flatnonzero(fresh)
        self.owner = np.cumsum(fresh) - 1
        self.bucket = bucket[self.head]

    def sent(self, number: int, group: Group) -> Iterator[tuple[int, int, int, bytes]]:
        """For each bucket: how many distinct segments, their smallest doc_ids, counts and bytes."""
        for bucket, own in split_by(self.bucket):
            head = self.head[own]
            count, first = self.count[head], self.first[head]
            size = count - 1 + group.length
            ends = np.cumsum(size)
            place = np.arange(ends[-1]) + np.repeat(first - (ends - size), size)
            body = [np.array([len(head)], "<i8").tobytes(), self.doc[head].astype("<i8").tobytes(), count.astype(np.uint8).tobytes(), group.data[place].tobytes()]
            yield number, bucket, SEGMENTS, b"".join(body)
        yield from self.strings.sent(number)

    def covered(self, group: Group, answers: dict[int, bytes], strings: dict[int, bytes]) -> np.ndarray:
        """For every byte of the group, whether a string with an earlier match covers it."""
        edge = np.zeros(len(group.data) + 1, np.int32)
        hit = self.strings.earlier(strings)
        edge[hit] += 1
        edge[hit + group.length] -= 1
        if len(self.head):
            kind = mask_type(group.length)
            masks = np.concatenate([np.frombuffer(answers[b], kind) for b, _ in split_by(self.bucket)])
            later = self.doc > self.doc[self.head][self.owner]
            mask = np.where(later, np.iinfo(kind).max, masks[self.owner])
            for k in range(int(self.count.max())):
                hit = self.first[(self.count > k) & ((mask >> kind.type(k)) & kind.type(1)).astype(bool)] + k
                edge[hit] += 1  # strings begin at different places
                edge[hit + group.length] -= 1
        return np.cumsum(edge[:-1]) > 0


Words = Callable[[np.ndarray, int], np.ndarray]


def suffix_order(n: int, word: Words, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of n suffixes by their first words, and of how many words each, but the first, shares
    with the one before it. word gives the k-th word of some suffixes; ties alone are read further."""
    own = word(np.arange(n), 0)
    order = np.argsort(own)
    own = own[order]
    same = np.zeros(n, bool)
    same[1:] = own[1:] == own[:-1]
    shared = np.zeros(n, np.int16)
    for step in range(1, steps):
        shared[same] = step
        tied = same.copy()
        tied[:-1] |= same[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        run = np.cumsum(~same)[at]
        own = word(order[at], step)
        turn = np.argsort(own)
        own = own[turn]
        rank = np.empty(len(own), np.int64)
        rank[turn] = np.cumsum(np.concatenate([[0], own[1:] != own[:-1]]))
        key = run * (len(own) + 1) + rank  # ties stay together, and are told apart by this word
        turn = np.argsort(key)
        order[at], own, run = order[at][turn], rank[turn], run[turn]
        same = np.zeros(n, bool)
        same[at[1:]] = (own[1:] == own[:-1]) & (run[1:] == run[:-1])
    shared[same] = steps
    return order, shared


def previous_smaller(doc: np.ndarray, shared: np.ndarray, enough: int) -> np.ndarray:
    """How many words each place shares with the nearest one before it of a smaller document; 0 if fewer
    than enough. Everybody looks on from where the one before has got to, so steps double."""
    before, least = np.arange(len(doc)) - 1, shared.copy()
    live = np.flatnonzero(least >= enough)
    live = live[doc[before[live]] >= doc[live]]
    while len(live):
        at = before[live]
        least[live], before[live] = np.minimum(least[live], least[at]), before[at]
        live = live[least[live] >= enough]
        live = live[doc[before[live]] >= doc[live]]
    return np.where(least >= enough, least, 0)


def longest_previous(doc: np.ndarray, word: Words, steps: int, enough: int = 1) -> np.ndarray:
    """How many words each suffix shares with one of an earlier document, if enough; else 0."""
    order, shared = suffix_order(len(doc), word, steps)
    ordered = doc[order]
    back = np.zeros(len(doc), shared.dtype)
    back[1:] = shared[:0:-1]
    left = previous_smaller(ordered, shared, enough)
    right = previous_smaller(ordered[::-1], back, enough)[::-1]
    out = np.empty(len(doc), shared.dtype)
    out[order] = np.maximum(left, right)
    return out


def words_at(data: np.ndarray, place: np.ndarray, length: int) -> tuple[Words, int]:
    """The words of the strings of length bytes that begin at some places; the last one overlaps."""
    every = np.ndarray((max(0, len(data) - 7),), ">u8", buffer=np.ascontiguousarray(data), strides=(1,))
    starts = [*range(0, length - 8, 8), length - 8]
    return lambda which, step: every[place[which] + starts[step]].astype(np.uint64), len(starts)


def answered_segments(length: int) -> Callable:
    """For every group of a bucket, a mask for each segment: which of its strings have an earlier match;
    and a bit for each string that was sent alone."""

    def strings(bucket: int, rows: pa.Table) -> pa.RecordBatch:
        bodies = rows.column("body").to_pylist()
        sizes = [len(b) // 16 for b in bodies]
        docs = np.concatenate([np.frombuffer(b, "<i8", n) for b, n in zip(bodies, sizes, strict=True)])
        codes = np.concatenate([np.frombuffer(b, "<u8", n, 8 * n) for b, n in zip(bodies, sizes, strict=True)])
        earlier = np.split(longest_previous(docs, lambda which, _: codes[which], 1) > 0, np.cumsum(sizes)[:-1])
        groups = rows.column("group").to_pylist()
        return messages([(g, bucket, STRINGS, np.packbits(x).tobytes()) for g, x in zip(groups, earlier, strict=True)])

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        rows = pa.Table.from_batches(list(batches))
        alone = np.equal(rows.column("kind").to_numpy(), STRINGS)
        if alone.any():
            yield strings(key[0].as_py(), rows.filter(pa.array(alone)))
            rows = rows.filter(pa.array(~alone))
            if not rows.num_rows:
                return
        docs, counts, parts = [], [], []
        for body in rows.column("body").to_pylist():
            n = int(np.frombuffer(body, "<i8", 1)[0])
            docs.append(np.frombuffer(body, "<i8", n, 8))
            count = np.frombuffer(body, np.uint8, n, 8 + 8 * n).astype(np.int64)
            parts.append(np.frombuffer(body, np.uint8, offset=8 + 9 * n))
            counts.append(count)
        doc, count, data = np.concatenate(docs), np.concatenate(counts), np.concatenate(parts)
        first = np.cumsum(count - 1 + length) - (count - 1 + length)
        # Groups send the same segments; of each, one of the smallest doc_id takes its place in the order.
        same = distinct(segment_codes(eights(data), first, count, length))[1]
        order = np.lexsort((doc, same))
        chosen = order[np.flatnonzero(np.diff(same[order], prepend=-1))]
        times = count[chosen]
        word, steps = words_at(data, np.repeat(first[chosen], times) + within(times), length)
        earlier = longest_previous(np.repeat(doc[chosen], times), word, steps, steps) >= steps
        kind = mask_type(length)
        masks = np.add.reduceat(earlier.astype(kind) << within(times).astype(kind), np.cumsum(times) - times).astype(kind)
        masks = np.where(doc > doc[chosen][same], np.iinfo(kind).max, masks[same]).astype(kind)
        ends = np.cumsum([0, *map(len, counts)])
        parts = [masks[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
        yield messages([(g, key[0].as_py(), SEGMENTS, p) for g, p in zip(rows.column("group").to_pylist(), parts, strict=True)])

    return run


def within(count: np.ndarray) -> np.ndarray:
    """0, 1, ... for each count."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - count, count)


def answers_of(table: pa.Table, kind: int) -> dict[int, bytes]:
    rows = zip(*(table.column(c).to_pylist() for c in ("bucket", "kind", "body")), strict=True)
    return {b: body for b, k, body in rows if k == kind}


def whole_characters(data: np.ndarray, covered: np.ndarray) -> np.ndarray:
    """Of the covered bytes, those of characters that are covered in full."""
    leads = np.flatnonzero((data & 0xC0) != 0x80)
    if not len(leads):
        return covered
    return np.repeat(np.logical_and.reduceat(covered, leads), np.diff(np.append(leads, len(data))))


def without_repeats(docs: DataFrame, length: int = LENGTH, characters: bool = False, hot: int = HOT_SEGMENTS) -> DataFrame:
    """The rows with kept (the remaining bytes), n_bytes, n_removed and n_spans, and removed: the
    first and last + 1 byte of each removed run.

    With characters, a character of which some bytes would stay stays whole, so that kept is text.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(partitions, total // GROUP_BYTES)
    buckets = max(partitions, total // BUCKET_BYTES)
    group_name = next(n for n in ("group", "group_", "group__", "group___") if n not in docs.columns)
    number = F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups))
    dealt = docs.withColumn(group_name, number).repartition(max(partitions, groups // GROUPS_PER_TASK), group_name)
    by_group = dealt.groupBy(group_name)

    def send_anchors(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        group = Group(pa.Table.from_batches(list(batches)), length)
        yield messages(list(anchor_messages(key[0].as_py(), group, buckets)))

    def send_segments(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        release_memory()
        group = Group(left, length)
        sent = Repeats(group, answers_of(right, ANCHORS), buckets).sent(key[0].as_py(), group)
        return pa.Table.from_batches([messages(list(sent))])

    def remove(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        release_memory()
        group = Group(left, length)
        covered = Repeats(group, answers_of(right, ANCHORS), buckets).covered(group, answers_of(right, SEGMENTS), answers_of(right, STRINGS))
        if characters:
            covered = whole_characters(group.data, covered)
        kept, removed, sizes = [], [], []
        for a, b in zip(group.at[:-1], group.at[1:], strict=True):
            own = covered[a:b]
            edges = np.flatnonzero(np.diff(own.astype(np.int8), prepend=0, append=0))
            kept.append(group.data[a:b][~own].tobytes())
            removed.append(edges.tolist())
            sizes.append((b - a, own.sum(), len(edges) // 2))
        n = np.array(sizes, np.int64).reshape(-1, 3)
        new = {
            "kept": pa.array(kept, pa.binary()),
            "n_bytes": pa.array(n[:, 0]),
            "n_removed": pa.array(n[:, 1]),
            "n_spans": pa.array(n[:, 2]),
            "removed": pa.array(removed, pa.list_(pa.int64())),
        }
        batches = group.table.drop_columns([group_name]).combine_chunks().to_batches()
        return pa.Table.from_batches([added(b, new) for b in batches])

    by_bucket = by_group.applyInArrow(send_anchors, MESSAGE).groupBy("bucket")
    found = by_bucket.applyInArrow(shared_anchors(hot), MESSAGE)
    sent = by_group.cogroup(found.groupBy("group")).applyInArrow(send_segments, MESSAGE)
    masks = sent.groupBy("bucket").applyInArrow(answered_segments(length), MESSAGE)
    kinds = {"kept": T.BinaryType(), "n_bytes": T.LongType(), "n_removed": T.LongType(), "n_spans": T.LongType(), "removed": T.ArrayType(T.LongType())}
    schema = T.StructType([f for f in docs.schema if f.name not in kinds] + [T.StructField(n, t) for n, t in kinds.items()])
    return by_group.cogroup(found.unionAll(masks).groupBy("group")).applyInArrow(remove, schema)


ORACLE = """
WITH raw AS (
  SELECT doc_id, encode(coalesce(text, '')) AS t, hex(t) AS h FROM documents
), place AS (
  SELECT doc_id, unnest(range(0, octet_length(t) - 49)) AS p, t FROM raw
), string AS (
  SELECT doc_id, p, t[p + 1 : p + 50] AS s FROM place
), first AS (
  SELECT s, min(doc_id) AS doc_id FROM string GROUP BY 1
), later AS (
  SELECT t.doc_id, t.p FROM string t JOIN first f ON f.s = t.s WHERE f.doc_id < t.doc_id
), marked AS (
  SELECT doc_id, p, p > coalesce(max(p + 50) OVER (PARTITION BY doc_id ORDER BY p
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS fresh
  FROM later
), numbered AS (
  SELECT doc_id, p, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM marked
), span AS (
  SELECT doc_id, run, min(p) AS a, max(p) + 50 AS b FROM numbered GROUP BY 1, 2
), gap AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS x, a AS y FROM span
  UNION ALL SELECT doc_id, max(b), NULL FROM span GROUP BY 1
), rest AS (
  SELECT g.doc_id, string_agg(h[2 * x + 1 : coalesce(2 * y, length(h))], '' ORDER BY x) AS k
  FROM gap g JOIN raw USING (doc_id) GROUP BY 1
), total AS (
  SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM span GROUP BY 1
)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM raw LEFT JOIN total USING (doc_id) LEFT JOIN rest USING (doc_id)
"""
