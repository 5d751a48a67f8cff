"""Secret scans: fixed patterns, and a battery of randomness tests on long tokens.

Tokens are runs of 20 or more of the characters A-Z, a-z, 0-9, +, /, _ and -; shorter ones carry too little evidence and are not
tested. A run with separators (a path, an identifier) may hold a key, so its parts of 20 or more between / and +, between - and _,
and between all four are tested too, each by itself; what is found inside a longer finding is part of that.

A long token is taken for a string over the smallest usual alphabet that has all its characters (digits, hex,
base 32, 36, 62 or 64; from 64 characters on also letters alone). Three tests ask whether it was drawn at random from it: chi-squared uniformity of
the characters, the number of runs above and below the middle, and the correlation of
neighbours. Fisher's method makes one value of the three.

What value does ordinary text get? All prose of all texts, without blanks, marks and candidates, is cut end to end to the
lengths of a class's tokens and every cut is tested the same way; tokens of more than 64 characters are set against prose of
64, which looks more random than longer prose does. In each class a token's p-value is the share of prose that looks as random; where no prose does, an exponential tail fitted to the
most random hundredth of it, so that a single token among many can be found. The Benjamini-Hochberg rule
bounds the false discoveries, each class by itself, since short strings carry little evidence.

The candidates, without the texts, go to a stored table. If there are any, the texts are read once more for their prose; the
counts are a few numbers per class, and the limits they give are applied to the table.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.common import batches, rows_of, stored, table

FALSE_DISCOVERIES = 0.01
KINDS = ("assign", "access", "hex", "random")

# Letters stand for both cases in ASCII only.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_TOKEN = 20
TOKEN = re.compile(rf"[A-Za-z0-9+/_-]{{{LEAST_TOKEN},}}")
# Parts of a run: as base64url, as base64 and as letters and digits alone.
PARTS = tuple(re.compile(rf"[A-Za-z0-9{own}]{{{LEAST_TOKEN},}}") for own in ("_-", "+/", ""))
# Alphabets in order of size; a token belongs to the first that has all its characters.
ALPHABETS = tuple(
    (name, {c: i for i, c in enumerate(characters)})
    for name, characters in (
        ("digits", "0123456789"),
        ("hex", "0123456789abcdef"),
        ("upper hex", "0123456789ABCDEF"),
        ("lower letters", "abcdefghijklmnopqrstuvwxyz"),
        ("upper letters", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
        ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"),
        ("upper base36", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        ("letters", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
        ("base62", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
        ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
        ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
    )
)
_NOT_PROSE = bytes(b for b in range(128) if not chr(b).isalnum())
PROSE_LENGTH = 64  # of the longest cuts
# Short prose is all letters, and looks random over them alone; so does no long prose.
LONG_ONLY = ("lower letters", "upper letters", "letters")
PROSE_CLASS = PROSE_LENGTH.bit_length()  # and of all longer tokens
PROSE_LENGTHS = 64  # of a class's cuts, by turns
PROSE_BYTES, CUTS = 1 << 20, 4096  # prose and cuts that are tested at once
SHORT_TEXT = 256  # texts with less prose are joined
TAIL_SHARE, LEAST_TAIL = 100, 20  # the tail is fitted to this part of the cuts, and to so many at least
STEPS, LAST_STEP = 8, 400  # value steps per power of ten; all below the last one count alike

FINDINGS = "base array<struct<kind:int,start:int,end:int>>, tokens array<struct<start:int,end:int,class:int,step:int>>"


def _tail(z: float) -> float:
    """Two-sided normal tail."""
    return math.erfc(abs(z) / math.sqrt(2))


def uniformity(places: list[int], size: int) -> float:
    """Chi-squared test of equal shares, by the Wilson-Hilferty cube root."""
    n, counts = len(places), {}
    for p in places:
        counts[p] = counts.get(p, 0) + 1
    chi2 = sum(c * c for c in counts.values()) * size / n - n
    df = size - 1
    z = ((max(chi2, 0) / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return 0.5 * math.erfc(z / math.sqrt(2))


def runs(places: list[int], size: int) -> float:
    """Runs of characters of the lower and the upper half of the alphabet."""
    upper = [p >= size / 2 for p in places]
    n, a = len(places), sum(upper)
    b = n - a
    if not a or not b:
        return 2.0 ** (1 - n)
    mean = 1 + 2 * a * b / n
    spread = math.sqrt(max((mean - 1) * (mean - 2) / (n - 1), 1e-9))
    return _tail((1 + sum(x != y for x, y in zip(upper, upper[1:], strict=False)) - mean) / spread)


def serial_correlation(places: list[int]) -> float:
    n = len(places)
    mean = sum(places) / n
    off = [p - mean for p in places]
    around = sum(x * x for x in off)
    if not around:
        return 0.0
    return _tail(sum(x * y for x, y in zip(off, off[1:], strict=False)) / around * math.sqrt(n))


def randomness(text: str) -> tuple[str, float] | None:
    """The inferred encoding and the combined p-value of the battery; None if no alphabet fits."""
    own = set(text)
    for name, alphabet in ALPHABETS:
        if own <= alphabet.keys() and (len(text) >= PROSE_LENGTH or name not in LONG_ONLY):
            places = [alphabet[c] for c in text]
            tests = (uniformity(places, len(alphabet)), runs(places, len(alphabet)), serial_correlation(places))
            half = -sum(math.log(max(p, 1e-300)) for p in tests)  # half of Fisher's statistic; chi-squared, 6 degrees
            return name, math.exp(-half) * (1 + half + half * half / 2)
    return None


def _step(value: float) -> int:
    return min(LAST_STEP, int(-math.log10(max(value, 1e-60)) * STEPS))


def prose_of(text: str) -> str:
    """ASCII letters and digits without the runs that may be tokens."""
    return TOKEN.sub(" ", text).encode("ascii", "ignore").translate(None, _NOT_PROSE).decode()


def token_spans(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """A run and its different parts."""
    if text[start:end].isalnum():
        return [(start, end)]
    return sorted({(start, end), *(m.span() for own in PARTS for m in own.finditer(text, start, end))})


def scan_text(text: str) -> tuple[list, list]:
    """Base spans (kind, start, end) and candidate tokens (start, end, class, step)."""
    base = []
    small = text.lower()
    if "passw" in small or "secret" in small or "token" in small or "api" in small:
        base += [(0, *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        base += [(1, *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    base += [(2, *m.span()) for m in HEX.finditer(text)]
    base.sort(key=lambda s: (s[1], s[0]))
    tokens = []
    for m in TOKEN.finditer(text):
        for start, end in token_spans(text, *m.span()):
            found = randomness(text[start:end])
            if found is not None:
                tokens.append((start, end, (end - start).bit_length(), _step(found[1])))
    return base, tokens


def find(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The stored candidates of every row: columns ``keep``, base and tokens."""
    columns = [docs.schema[c] for c in keep]
    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in columns), FINDINGS])
    span = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
    token = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("class", pa.int32()), ("step", pa.int32())])

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                found = [scan_text(t or "") for t in part.column(part.num_columns - 1).to_pylist()]
                lists = [
                    pa.array([[dict(zip((f.name for f in kind), x, strict=True)) for x in row[i]] for row in found], pa.list_(kind))
                    for i, kind in enumerate((span, token))
                ]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *lists], names=[*keep, "base", "tokens"])

    return stored(docs.select(*keep, F.col("text").alias("__text")).mapInArrow(work, ddl), "secret-candidates")


# By character: a bit for each alphabet that has it, and its place in each.
_FITS = np.array([sum(1 << i for i, (_, own) in enumerate(ALPHABETS) if chr(c) in own) for c in range(128)], np.int64)
_PLACES = np.array([[own.get(chr(c), 0) for c in range(128)] for _, own in ALPHABETS], np.int64)
_SIZES = np.array([len(own) for _, own in ALPHABETS], np.int64)
_SHORT = sum(1 << i for i, (name, _) in enumerate(ALPHABETS) if name not in LONG_ONLY)


def _tails(z: np.ndarray) -> np.ndarray:
    return np.array([math.erfc(x) for x in (z / math.sqrt(2)).tolist()])


def cut_steps(cuts: np.ndarray) -> np.ndarray:
    """The steps of ``randomness`` for cuts of one length, rows of the codes of letters and digits; many at a time."""
    n, length = cuts.shape
    fits = np.bitwise_and.reduce(_FITS[cuts], axis=1)
    if length < PROSE_LENGTH:
        fits &= _SHORT
    alphabet = np.log2(fits & -fits).astype(np.int64)
    size = _SIZES[alphabet]
    places = _PLACES[alphabet[:, None], cuts]
    # As in ``uniformity``, ``runs`` and ``serial_correlation``.
    counts = np.bincount((places + 64 * np.arange(n)[:, None]).ravel(), minlength=64 * n).reshape(n, 64)
    df = size - 1
    chi2 = np.maximum((counts * counts).sum(axis=1) * size / length - length, 0)
    even = 0.5 * _tails((np.cbrt(chi2 / df) - (1 - 2 / (9 * df))) / np.sqrt(2 / (9 * df)))
    upper = 2 * places >= size[:, None]
    a = upper.sum(axis=1)
    b = length - a
    mean = 1 + 2 * a * b / length
    spread = np.sqrt(np.maximum((mean - 1) * (mean - 2) / (length - 1), 1e-9))
    changes = (upper[:, 1:] != upper[:, :-1]).sum(axis=1)
    in_runs = np.where((a == 0) | (b == 0), 2.0 ** (1 - length), _tails(np.abs(1 + changes - mean) / spread))
    total, middle = places.sum(axis=1), places.mean(axis=1)
    squares = (places * places).sum(axis=1)
    neighbours = (places[:, 1:] * places[:, :-1]).sum(axis=1) - middle * (2 * total - places[:, 0] - places[:, -1]) + (length - 1) * middle * middle
    alike = length * squares == total * total
    around = np.where(alike, 1.0, squares - total * middle)
    serial = np.where(alike, 0.0, _tails(np.abs(neighbours / around * math.sqrt(length))))
    half = -sum(np.log(np.maximum(p, 1e-300)) for p in (even, in_runs, serial))
    values = np.exp(-half) * (1 + half + half * half / 2)
    return np.minimum(LAST_STEP, (-np.log10(np.maximum(values, 1e-60)) * STEPS).astype(np.int64))


def prose_cuts(texts: Iterable[str | None], lengths: dict[int, list[int]]) -> Counter:
    """How many cuts of the texts' prose have each (class, step). All prose is cut end to end to each class's ``lengths`` by
    turns, from a turn that the prose itself gives."""
    seen: Counter = Counter()
    turns = {name: np.array(own) for name, own in lengths.items()}

    def count(proses: list[bytes]) -> None:
        data = np.frombuffer(b"".join(proses), np.uint8)
        for name, own in turns.items():
            starts, sizes, at = [], [], 0
            for prose in proses:
                turn = (zlib.crc32(prose) * len(own)) >> 32
                size = own[(turn + np.arange(len(prose) // own.min() + 1)) % len(own)]
                end = np.cumsum(size)
                whole = np.searchsorted(end, len(prose), "right")
                starts.append(at + (end - size)[:whole])
                sizes.append(size[:whole])
                at += len(prose)
            first, size = np.concatenate(starts), np.concatenate(sizes)
            for length in np.unique(size).tolist():
                of_length = first[size == length]
                for low in range(0, len(of_length), CUTS):
                    steps = cut_steps(data[of_length[low : low + CUTS, None] + np.arange(length)])
                    seen.update({(name, step): n for step, n in enumerate(np.bincount(steps).tolist()) if n})

    held, size, short = [], 0, ""
    for text in texts:
        prose = short + prose_of(text or "")
        if len(prose) < SHORT_TEXT:
            short = prose
            continue
        short = ""
        held.append(prose.encode())
        size += len(prose)
        if size >= PROSE_BYTES:
            count(held)
            held, size = [], 0
    count([*held, short.encode()])
    return seen


def _prose_counts(docs: DataFrame, lengths: dict[int, list[int]]) -> dict[int, dict[int, int]]:
    """Per class and step the number of cuts of prose."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = prose_cuts((t for batch in parts for (t,) in rows_of(batch)), lengths)
        yield from batches(((*k, n) for k, n in seen.items()), pa.schema([("class", pa.int32()), ("step", pa.int32()), ("n", pa.int64())]))

    rows = docs.select("text").mapInArrow(work, "class int, step int, n long").groupBy("class", "step").agg(F.sum("n").alias("n"))
    counts: dict[int, dict[int, int]] = {name: {} for name in lengths}
    for row in rows.collect():  # at most LAST_STEP + 1 rows for each of three classes
        counts[row["class"]][row["step"]] = row["n"]
    return counts


def p_values(prose: dict[int, int]) -> list[float]:
    """For each step the chance of prose to look as random, by the counts of its steps and the fitted tail."""
    n = sum(prose.values())
    share, seen = [], 0
    for step in range(LAST_STEP + 1):
        seen += prose.get(step, 0)
        share.append(seen)
    wanted = max(LEAST_TAIL, n // TAIL_SHARE)
    fitted = None
    if n >= 2 * wanted:
        edge = next(s for s, c in enumerate(share) if c >= wanted)
        # Steps are whole numbers; the mean distance from the edge, half a step more, is the scale of the tail.
        scale = 0.5 + sum((edge - s) * c for s, c in prose.items() if s <= edge) / share[edge]
        fitted = [share[edge] / n * math.exp(-(edge - s) / scale) if s < edge else share[s] / n for s in range(LAST_STEP + 1)]
    plain = [(1 + c) / (1 + n) for c in share]
    return plain if fitted is None else [min(p, max(f, c / n)) for p, f, c in zip(plain, fitted, share, strict=True)]


def limits(found: DataFrame, docs: DataFrame, rate: float = FALSE_DISCOVERIES) -> dict[int, int]:
    """Per length class the last step at which a token counts as random, by Benjamini-Hochberg."""
    size = F.least(F.col("t.end") - F.col("t.start"), F.lit(PROSE_LENGTH)).alias("size")
    counts = found.select(F.explode("tokens").alias("t")).select("t.class", "t.step", size).groupBy("class", "step", "size").count()
    by_class: dict[int, Counter] = {}
    sizes: dict[int, Counter] = {}
    for row in counts.collect():  # at most LAST_STEP + 1 rows for each of 44 lengths and 24 classes above
        by_class.setdefault(row["class"], Counter())[row["step"]] += row["count"]
        sizes.setdefault(min(row["class"], PROSE_CLASS), Counter())[row["size"]] += row["count"]
    if not by_class:
        return {}
    lengths = {}
    for name, own in sizes.items():
        # As many of each length as tokens have it, 64 in all.
        total, order = sum(own.values()), sorted(own.items())
        ends = list(accumulate(c for _, c in order))
        lengths[name] = [next(n for (n, _), e in zip(order, ends, strict=True) if e * 2 * PROSE_LENGTHS > (2 * i + 1) * total) for i in range(PROSE_LENGTHS)]
    prose = {name: p_values(own) for name, own in _prose_counts(docs, lengths).items()}
    last = {}
    for name, steps in by_class.items():
        n_tokens, seen = sum(steps.values()), 0
        for step in sorted(steps):
            seen += steps[step]
            if prose[min(name, PROSE_CLASS)][step] <= rate * seen / n_tokens:
                last[name] = step
    return last


def random_spans(base: list[dict], tokens: list[dict], last: dict[int, int]) -> list[tuple[int, int]]:
    """Spans of the tokens that count as random by ``last``, overlap nothing in ``base`` and lie in no longer one of their kind.

    One sweep over sorted spans each, so a text may hold any number of them.
    """
    starts = sorted((b["start"], b["end"]) for b in base)
    firsts = [start for start, _ in starts]
    reach = list(accumulate((end for _, end in starts), max))  # how far base spans that begin so early go
    passed = []
    for t in tokens:
        if t["step"] <= last.get(t["class"], -1):
            before = bisect_left(firsts, t["end"])
            if not before or reach[before - 1] <= t["start"]:
                passed.append((t["start"], -t["end"]))
    found, furthest = [], 0
    for start, end in sorted(passed):
        # Those before begin no later; one that goes as far is as long or longer.
        if -end > furthest or (found and found[-1] == (start, -end)):
            found.append((start, -end))
            furthest = -end
    return found


def scan(docs: DataFrame, rate: float = FALSE_DISCOVERIES, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``, then ``base`` and ``spans``: arrays of (kind, start, end), in code points, end exclusive.

    ``base`` has the matches of the fixed patterns, by start and then by kind; ``spans`` has these and the tokens found to
    be random that overlap none of them and lie in no longer one of their kind. A null or empty text has no spans; repeated rows are each scanned; texts
    of any length are scanned whole.
    """
    found = find(docs, keep)
    last = limits(found, docs, rate)

    random = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))

    @F.arrow_udf("array<struct<start:int,kind:int,end:int>>")
    def beyond(base: pa.Array, tokens: pa.Array) -> pa.Array:
        return pa.array([[{"start": a, "kind": 3, "end": z} for a, z in random_spans(b, t, last)] for b, t in zip(base.to_pylist(), tokens.to_pylist(), strict=True)], random)

    extra = beyond(F.col("base"), F.col("tokens"))
    base = F.transform("base", lambda b: F.struct(b["start"].alias("start"), b["kind"].alias("kind"), b["end"].alias("end")))

    def named(spans):
        kinds = F.array(*map(F.lit, KINDS))
        return F.transform(F.array_sort(spans), lambda s: F.struct(F.element_at(kinds, s["kind"] + 1).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    return found.select(*keep, named(base).alias("base"), named(F.concat(base, extra)).alias("spans"))


def _text(spans: str):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS[:3]), F.sha2(_text("base").cast("binary"), 256).alias("base_sha256"), _text("spans").alias("spans"))
