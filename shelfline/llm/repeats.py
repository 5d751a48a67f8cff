"""Exact repeats of 200 bytes, by a depth-limited radix sort of suffixes.

Two suffixes are told apart through their first 200 bytes only (a window), and a sort by passes of
most-significant digits leaves as equal groups exactly the windows that repeat. A digit here is a 64-bit
fingerprint of a block of bytes; the digits of passes 2 and 3 have 32 bits of a second, independent one beside them (the
check), without which some of the many pairs of windows in 100 TB would be confused. The first digit is that of the window's anchor: of all 64-byte blocks inside the
window the one with the least fingerprint, so that equal windows have equal anchors wherever
they stand, and neighbouring windows mostly share one. Passes:

1. Anchors (about one in 70 bytes) are sorted by their digit. An anchor found once has no repeated window and leaves.
2. Within a group of equal anchors the next digit covers the anchor and all that any of its windows
   can reach, 136 bytes on either side. If another has the same, all windows of the anchor are repeated.
3. Where a group has several such digits, its windows are sorted by the digit of all 200 bytes, one
   of each equal digit of pass 2 and all single ones. Groups of two or more are repeated.

Each pass packs the entries of a task's share of documents by the leading bits of the digit, into
buckets that hold so many entries as fit a task; the buckets' number follows the bytes of all documents. What stands twice in a share is
settled there, and one entry stands for it in the bucket: a passage in a third of all documents is one entry per share. Answers go back to the documents, by a key of their id and text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.common import batches, rows_of, stored, table

LENGTH = 200
ANCHOR = 64
REACH = LENGTH - ANCHOR
SLICE = 1 << 19  # windows of a document that are looked at together
SHARE_ENTRIES = 1 << 18
BUCKET_ANCHOR_BYTES, BUCKET_WINDOW_BYTES = 16 << 20, 4 << 20
BROADCAST_KEYS = 500_000  # 8 MB
OUTSIDE = 0xFF  # stands around a text; no byte of UTF-8

REPEATED, SHIPPED = 1, 2  # marks of anchors; both may hold
# What an entry of a bucket stands for: two or more equal ones of its share, or an anchor with several reaches there.
TWICE, MIXED = 1, 2

_ORDER = np.uint64(0x9E3779B97F4A7C15)
SEEDS = (20_240_602, 20_250_311)  # of the digits and of their checks
_ENTRIES = pa.schema([("bucket", pa.int32()), ("n", pa.int32()), ("data", pa.binary()), ("key", pa.int64()), ("places", pa.binary())])
ENTRIES = "bucket int, n int, data binary, key long, places binary"
ANSWERS = "key long, places binary"


@lru_cache(maxsize=2)
def _constants(seed: int) -> tuple[np.ndarray, dict[int, np.uint64]]:
    """A random number for each byte, and powers of a random odd base."""
    random = np.random.default_rng(seed)
    numbers = random.integers(0, 1 << 64, 256, np.uint64)
    base = int(random.integers(0, 1 << 63)) * 2 + 1
    return numbers, {n: np.uint64(pow(base, n, 1 << 64)) for n in (1, 2, 4, 8, 16, 32, 64, 72, 128, 136, 200)}


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Blocks:
    """Fingerprints of all blocks of 8, 64 and 128 bytes of a buffer, and of longer blocks made of these."""

    def __init__(self, buffer: np.ndarray, seed: int):
        numbers, self.power = _constants(seed)
        level, n = numbers[buffer], 1
        self.of: dict[int, np.ndarray] = {}
        while n < 128:
            level = level[:-n] * self.power[n] + level[n:]
            n *= 2
            if n in (8, 64, 128):
                self.of[n] = level

    def anchor(self, at: np.ndarray) -> np.ndarray:
        return _mixed(self.of[64][at])

    def reach(self, at: np.ndarray) -> np.ndarray:
        """Of an anchor and all that its windows may reach."""
        h8, h64, h128, p = self.of[8], self.of[64], self.of[128], self.power
        left = h128[at - 136] * p[8] + h8[at - 8]
        right = h128[at + 64] * p[8] + h8[at + 192]
        return _mixed((left * p[64] + h64[at]) * p[136] + right)

    def window(self, at: np.ndarray) -> np.ndarray:
        p = self.power
        return _mixed(self.of[128][at] * p[72] + self.of[64][at + 128] * p[8] + self.of[8][at + 192])


class Digits:
    """Digits of a buffer's anchors and windows, with the checks of the latter and of what anchors reach."""

    def __init__(self, buffer: np.ndarray):
        self.blocks, self.checks = (Blocks(buffer, seed) for seed in SEEDS)

    def anchors(self, starts: np.ndarray) -> np.ndarray:
        """For each window the place of its anchor. Equal fingerprints within a window need no order: the digits are the same."""
        blocks = self.blocks.of[64]
        places = np.arange(len(blocks), dtype=np.uint64) & np.uint64(0xFFFF)
        # Another mix than that of the digits: the least of many would all fall into the first buckets.
        least, n = _mixed(blocks ^ _ORDER) & ~np.uint64(0xFFFF) | places, 1
        while 2 * n <= REACH + 1:
            least = np.minimum(least[:-n], least[n:])
            n *= 2
        rest = REACH + 1 - n
        least = np.minimum(least[starts], least[starts + rest])
        return starts + (((least & np.uint64(0xFFFF)).astype(np.int64) - starts) & 0xFFFF)

    def anchor_digit(self, at: np.ndarray) -> np.ndarray:
        return self.blocks.anchor(at)

    def reach_digit(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.blocks.reach(at), _high(self.checks.reach(at))

    def window_digit(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.blocks.window(at), _high(self.checks.window(at))


def _high(digit: np.ndarray) -> np.ndarray:
    return (digit >> np.uint64(32)).astype("<u4")


def _slices(texts: list[bytes], most: int) -> Iterator[tuple[np.ndarray, list[tuple[int, int, int, int]]]]:
    """Buffers with parts (text's number, its first window, windows, place of that window in the buffer).

    Around each part stands what its windows' anchors can reach, or ``OUTSIDE``.
    """
    held, parts, size = [], [], 0
    for number, text in enumerate(texts):
        windows = len(text) - LENGTH + 1
        for low in range(0, max(0, windows), most):
            high = min(windows, low + most)
            before, body = text[max(0, low - REACH) : low], text[low : high + 2 * REACH + ANCHOR]
            part = bytes([OUTSIDE]) * (REACH - len(before)) + before + body
            part += bytes([OUTSIDE]) * (high - low + 3 * REACH + ANCHOR - len(part))
            held.append(part)
            parts.append((number, low, high - low, size + REACH))
            size += len(part)
            if size >= most:
                yield np.frombuffer(b"".join(held), np.uint8), parts
                held, parts, size = [], [], 0
    if parts:
        yield np.frombuffer(b"".join(held), np.uint8), parts


def _runs(texts: list[bytes], most: int) -> Iterator[tuple[Digits, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per buffer its digits and, for each run of windows with one anchor: the text's number, the first window, how many,
    the first window's place in the buffer and the anchor's."""
    for buffer, parts in _slices(texts, most):
        digits = Digits(buffer)
        number, low, count, place = (np.array(x, np.int64) for x in zip(*parts, strict=True))
        starts = np.arange(count.sum()) + np.repeat(place - np.cumsum(count) + count, count)
        anchors = digits.anchors(starts)
        first = np.zeros(len(starts), bool)
        first[np.cumsum(count) - count] = True
        first[1:] |= anchors[1:] != anchors[:-1]
        at = np.flatnonzero(first)
        part = np.searchsorted(np.cumsum(count), at, side="right")
        lengths = np.diff(np.append(at, len(starts)))
        yield digits, number[part], low[part] + starts[at] - place[part], lengths, starts[at], anchors[at]


def _texts(batch_rows: Iterator[tuple], size: int = SLICE) -> Iterator[list[tuple]]:
    """Rows (key, UTF-8 bytes, ...) in groups of about ``size`` bytes."""
    held, n = [], 0
    for row in batch_rows:
        held.append(row)
        n += len(row[1]) + 64
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def _by_key(keys: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, bytes]]:
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    edges = np.flatnonzero(np.diff(keys)) + 1
    for low, high in zip(np.append(0, edges), np.append(edges, len(keys)), strict=True):
        if high > low:
            yield int(keys[low]), values[low:high].tobytes()


def _packed(digit: np.ndarray, buckets: int, *columns: np.ndarray) -> Iterator[tuple]:
    """Entries by the leading bits of their digit."""
    bucket = ((digit >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for number in np.flatnonzero(np.diff(edges)).tolist():
        own = order[edges[number] : edges[number + 1]]
        yield number, len(own), b"".join(c[own].tobytes() for c in (digit, *columns)), 0, None


def _unpacked(rows: pd.DataFrame, *kinds: str) -> list[np.ndarray]:
    parts: list[list] = [[] for _ in kinds]
    for n, data in zip(rows["n"], rows["data"], strict=True):
        at = 0
        for part, kind in zip(parts, kinds, strict=True):
            part.append(np.frombuffer(data, kind, n, at))
            at += n * np.dtype(kind).itemsize
    return [np.concatenate(p) for p in parts]


def _dealt(keys: np.ndarray, values: np.ndarray, groups: int) -> Iterator[tuple[int, int, bytes]]:
    """Values of eight bytes with their keys, packed by groups of keys: (group, how many, keys and values)."""
    values = np.ascontiguousarray(values).view(np.int64).reshape(-1)
    group = keys % groups
    order = np.argsort(group, kind="stable")
    edges = np.flatnonzero(np.diff(group[order])) + 1
    for own in np.split(order, edges):
        if len(own):
            yield int(group[own[0]]), len(own), keys[own].tobytes() + values[own].tobytes()


def _settled(keys: np.ndarray, places: np.ndarray, groups: int) -> Iterator[tuple]:
    """What a share knows by itself goes along with the entries."""
    return ((group, n, None, 0, packed) for group, n, packed in _dealt(keys, places, groups))


def _single(starts: np.ndarray) -> np.ndarray:
    """Places (first window, windows) of single windows."""
    return np.stack([starts, np.ones_like(starts)], 1).astype("<i4")


def _answered(entries: DataFrame, buckets: int, answer: Callable[[pd.DataFrame], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """Per key the answers of the buckets to their entries, and what the shares had settled.

    A bucket packs its answers by groups of keys, as many as there are buckets, so it has a row per group and not per key.
    """

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        asked = rows["data"].notna()
        found = list(_dealt(*answer(rows[asked]), buckets)) if asked.any() else []
        settled = rows.loc[~asked, ["bucket", "n", "places"]].itertuples(index=False, name=None)
        return pd.DataFrame([*found, *settled], columns=["part", "n", "packed"]).astype({"part": "int32", "n": "int32"})

    def spread(rows: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([np.frombuffer(d, np.int64, n) for n, d in zip(rows["n"], rows["packed"], strict=True)])
        values = np.concatenate([np.frombuffer(d, np.int64, n, 8 * n) for n, d in zip(rows["n"], rows["packed"], strict=True)])
        return pd.DataFrame(_by_key(keys, values), columns=["key", "places"])

    packed = entries.groupBy("bucket").applyInPandas(work, "part int, n int, packed binary")
    return packed.groupBy("part").applyInPandas(spread, ANSWERS).select("key", F.array("places").alias("found"))


def _groups(*columns: np.ndarray, last: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """An order by the columns, and in that order the number of the group of equal ones. Rows of ``last`` end their group."""
    order = np.lexsort(columns[::-1] if last is None else (last, *columns[::-1]))
    new = np.zeros(len(order), bool)
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    return order, np.cumsum(new)


def _settle(anchor: np.ndarray, reach: np.ndarray, flags: np.ndarray, *checks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marks of anchors; which is the first of its pair of digits; which has an anchor's digit with several reaches.

    Reaches are equal if their ``checks`` are, too.
    """
    # A share's MIXED entry gets no answer, so it may lead only where all of its group are such.
    order, group = _groups(anchor, reach, *checks, last=flags == MIXED)
    _, anchors = _groups(anchor[order])  # these are in order already
    lead = np.append(True, group[1:] != group[:-1])
    repeated = np.bincount(group, 1 + (flags[order] == TWICE))[group] > 1
    mixed = np.bincount(anchors, lead + 2 * (flags[order] == MIXED))[anchors] > 1
    marks, leads, several = np.zeros(len(order), np.int64), np.zeros(len(order), bool), np.zeros(len(order), bool)
    marks[order] = np.where(repeated, REPEATED, 0) | np.where(mixed & (lead | ~repeated), SHIPPED, 0)
    leads[order], several[order] = lead, mixed
    return marks, leads, several


def _anchor_entries(docs: DataFrame, buckets: int, most: int, share: int) -> DataFrame:
    """Passes 1 and 2 within each share: entries for the buckets, and places already settled."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def closed(held: list[tuple]) -> Iterator[tuple]:
            anchor, reach, check, key, place = (np.concatenate(x) for x in zip(*held, strict=True))
            marks, leads, mixed = _settle(anchor, reach, np.zeros(len(anchor), np.uint8), check)
            # An anchor with several reaches here is settled: its windows are shipped, and one entry tells the bucket so.
            # Of equal pairs of digits one asks the bucket; the others are repeated and need no more.
            settled = mixed | ~leads
            yield from _settled(key[settled], place[settled] << 2 | marks[settled], buckets)
            flags = np.where(mixed, MIXED, np.where(marks & REPEATED, TWICE, 0)).astype(np.uint8)
            _, first = np.unique(anchor, return_index=True)
            sent = leads & ~mixed
            sent[first] |= mixed[first]
            yield from _packed(anchor[sent], buckets, reach[sent], check[sent], key[sent], place[sent], flags[sent])

        def found() -> Iterator[tuple]:
            held, n = [], 0
            rows = ((key, (text or "").encode("utf-8", "replace")) for batch in parts for key, text in rows_of(batch))
            for group in _texts(rows):
                keys = np.array([r[0] for r in group], np.int64)
                seen = []
                for digits, number, first, _, place, at in _runs([r[1] for r in group], most):
                    seen.append((number, first + at - place, digits.anchor_digit(at), *digits.reach_digit(at)))
                if not seen:
                    continue
                number, place, anchor, reach, check = (np.concatenate(x) for x in zip(*seen, strict=True))
                _, once = np.unique(number << 32 | place, return_index=True)  # two slices may share an anchor
                held.append((anchor[once], reach[once], check[once], keys[number[once]], place[once]))
                n += len(once)
                if n >= share:
                    yield from closed(held)
                    held, n = [], 0
            if held:
                yield from closed(held)

        yield from batches(found(), _ENTRIES)

    return docs.select("key", "text").mapInArrow(work, ENTRIES)


def _anchor_answers(entries: DataFrame, buckets: int) -> DataFrame:
    """Passes 1 and 2 over the buckets: marks of the anchors that repeat."""

    def answer(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        anchor, reach, check, key, place, flags = _unpacked(rows, "<u8", "<u8", "<u4", "<i8", "<i8", "u1")
        marks, _, _ = _settle(anchor, reach, flags, check)
        hit = (marks > 0) & (flags != MIXED)
        return key[hit], place[hit] << 2 | marks[hit]

    return _answered(entries, buckets, answer)


def _window_entries(docs: DataFrame, buckets: int, most: int, share: int) -> DataFrame:
    """Pass 3 within each share. ``docs``: key, text, marks. ``places`` are pairs (first window, windows)."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def closed(held: list[tuple]) -> Iterator[tuple]:
            digit, check, key, start, known = (np.concatenate(x) for x in zip(*held, strict=True))
            order, group = _groups(digit, check)
            several = np.zeros(len(order), bool)
            several[order] = np.bincount(group)[group] > 1
            settled = several & ~known
            yield from _settled(key[settled], _single(start[settled]), buckets)
            # In the order of the texts, in which keys and places compress well.
            sent = np.sort(order[np.append(True, group[1:] != group[:-1])])
            yield from _packed(digit[sent], buckets, check[sent], key[sent], start[sent].astype("<i4"), (several | known)[sent].astype(np.uint8))

        def found() -> Iterator[tuple]:
            held, n = [], 0
            rows = ((key, (text or "").encode("utf-8", "replace"), marks) for batch in parts for key, text, marks in rows_of(batch))
            for group in _texts(rows):
                keys = np.array([r[0] for r in group], np.int64)
                marks = [np.frombuffer(b"".join(r[2]), np.int64) for r in group]
                wanted = np.concatenate([(i << 34) + (m >> 2 << 2) for i, m in enumerate(marks)])
                given = np.concatenate([m & 3 for m in marks])
                order = np.argsort(wanted, kind="stable")
                wanted, given = wanted[order], given[order]
                same = np.append(True, wanted[1:] != wanted[:-1])  # equal rows answer for each other
                given = np.bitwise_or.reduceat(given, np.flatnonzero(same))
                wanted = wanted[same]
                runs = []
                for digits, number, first, count, place, at in _runs([r[1] for r in group], most):
                    asked = (number << 34) + (first + at - place << 2)
                    where = np.minimum(np.searchsorted(wanted, asked), len(wanted) - 1)
                    mark = np.where(wanted[where] == asked, given[where], 0)
                    whole = mark & REPEATED > 0
                    runs.append((number[whole], first[whole], count[whole]))
                    ship = np.flatnonzero(mark & SHIPPED)
                    each = count[ship]
                    step = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                    for low in range(0, len(step), share):
                        own = slice(low, low + share)
                        run = np.repeat(ship, each)[own]
                        held.append((*digits.window_digit(place[run] + step[own]), keys[number[run]], first[run] + step[own], whole[run]))
                        n += len(run)
                        if n >= share:
                            yield from closed(held)
                            held, n = [], 0
                if runs:
                    number, first, count = (np.concatenate(x) for x in zip(*runs, strict=True))
                    yield from _settled(keys[number], np.stack([first, count], 1).astype("<i4"), buckets)
            if held:
                yield from closed(held)

        yield from batches(found(), _ENTRIES)

    # Shares must come out alike if a task runs again, so its rows are put in order first.
    return docs.select("key", "text", "marks").sortWithinPartitions("key").mapInArrow(work, ENTRIES)


def _window_answers(entries: DataFrame, buckets: int) -> DataFrame:
    def answer(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        digit, check, key, start, known = _unpacked(rows, "<u8", "<u4", "<i8", "<i4", "u1")
        order, group = _groups(digit, check)
        hit = np.sort(order[(np.bincount(group)[group] > 1) & (known[order] == 0)])
        return key[hit], _single(start[hit])

    return _answered(entries, buckets, answer)


def cut(text: bytes, places: list[bytes] | None) -> tuple[bytes, int, int]:
    """The bytes left, the number removed and the number of maximal runs removed."""
    if not places:
        return text, 0, 0
    first, count = np.frombuffer(b"".join(places), "<i4").astype(np.int64).reshape(-1, 2).T
    change = np.zeros(len(text) + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, first + count - 1 + LENGTH, -1)
    gone = np.cumsum(change[:-1]) > 0
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), int(gone.sum()), spans


def _few(found: DataFrame) -> DataFrame:
    """The keys of a stored table, broadcast if they are few: only the texts they name need a shuffle then."""
    keys = found.select("key")
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def _with(docs: DataFrame, found: DataFrame) -> DataFrame:
    return docs.join(_few(found), "key", "left_semi").join(found.hint("shuffle_hash"), "key")


def _without(docs: DataFrame, found: DataFrame) -> DataFrame:
    return docs.join(_few(found), "key", "left_anti")


def remove_repeats(docs: DataFrame, slice_windows: int = SLICE, share_entries: int = SHARE_ENTRIES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the bytes left) for each row of ``docs``.

    A byte goes if a 200-byte string that covers it also starts elsewhere, in any row or in the same one; strings are
    those of the input. Rows of equal content repeat each other. A null text is empty; texts of under 200 bytes stay.
    The bytes left need not be valid UTF-8. ``slice_windows`` and ``share_entries`` bound what a task holds at once. Other columns are not read. Strings are taken for equal if 96 bits of
    fingerprints agree; their bytes are not compared, so two different ones could be confused once in some 10^28 pairs.
    """
    text = F.coalesce("text", F.lit("")).alias("text")
    keyed = docs.select(F.col("doc_id").cast("long"), text).withColumn("key", F.xxhash64("doc_id", "text"))
    size = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 + size // BUCKET_ANCHOR_BYTES
    anchors = _anchor_entries(keyed, buckets, slice_windows, share_entries)
    marks = stored(_anchor_answers(anchors, buckets).withColumnRenamed("found", "marks"), "anchor-marks")
    marked = _with(keyed, marks)
    buckets = 1 + size // BUCKET_WINDOW_BYTES
    windows = _window_entries(marked, buckets, slice_windows, share_entries)
    places = stored(_window_answers(windows, buckets).withColumnRenamed("found", "places"), "repeat-places")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for batch in parts:
                for doc_id, own, where in rows_of(batch):
                    data = own.encode("utf-8", "replace")
                    kept, removed, spans = cut(data, where)
                    yield doc_id, len(data), removed, spans, kept

        yield from batches(found(), pa.schema([*((n, pa.int64()) for n in ("doc_id", "n_bytes", "n_removed", "n_spans")), ("kept", pa.binary())]))

    whole = _without(keyed, places).withColumn("places", F.lit(None).cast("array<binary>"))
    return whole.unionByName(_with(keyed, places)).select("doc_id", "text", "places").mapInArrow(work, schema)


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
