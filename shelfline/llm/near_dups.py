"""Near duplicates by b-bit MinHash, confirmed on full sets.

A document's set are its distinct five-word shingles, as 64-bit hashes. Equal sets are one node
from the start. Of 128 minima per set, groups of four make 32 band keys; of every minimum, mixed with its
number, four bits are kept, 64 bytes a set. (The lowest bits of the minima themselves would not do: they are those of the
shingle, whatever the function, so that a few shingles decide for all functions whether they agree.) Sets that share a band are
candidates; counting the equal groups of bits, less the sixteenth that agree by chance, estimates their similarity, and pairs
far below the threshold are dropped. Sets of up to 32 shingles are kept whole beside their bits, and two such sets are compared exactly instead. At a similarity of 0.75 a pair shares no band in one case of 200,000, and is dropped by the
estimate (0.55) in one of millions. What is left is compared on the full sets.

Members of a bucket are not paired with one another at once. First each is compared with the bucket's smallest
member, and the links found make components. Only buckets that then hold several components are
looked at again, for pairs of different components, so every candidate pair is either compared or already
known to be connected. Of such a bucket only the members outside its largest component go to the tiles it is cut into; the
others stay in one. Its members get a second, finer sketch, one bit of each of 1,024 minima, with a standard error of 0.02: it drops
most pairs below 0.67, and a pair of 0.75 in one case of 18,000. A large group of near copies has very many pairs just below the threshold, so sets of
up to 1,024 shingles also carry half of each hash, and what two such sets can share at most is counted in the join itself. So what
comes out of the join are links, but for chance or larger sets, and not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.common import ascii_lower, batches, rows_of, shielded, stored, table
from shelfline.llm.components import components
from shelfline.operators.lookups import join_folded

WORDS = 5
PERCENT = 75
BANDS, ROWS = 32, 4
BITS = 4
LEAST_ESTIMATE = 0.55
FINE_MINIMA = 1024
LEAST_FINE = 0.67
TILE = 256
BROADCAST_IDS = 500_000  # 8 MB of ids
CACHED_WORDS = 400_000
SMALL = 32  # shingles of sets that need no estimate
CARRIED = 1024  # shingles of sets that are taken along where buckets are looked at again

_RANDOM = np.random.default_rng(20_240_601)
_FACTORS = _RANDOM.integers(0, 1 << 32, max(BANDS * ROWS, FINE_MINIMA), np.uint64).astype(np.uint32) | np.uint32(1)
_OFFSETS = _RANDOM.integers(0, 1 << 32, len(_FACTORS), np.uint64).astype(np.uint32)
_PLACES = _RANDOM.integers(0, 1 << 63, WORDS, np.uint64) | np.uint64(1)
_BAND_PLACES = _RANDOM.integers(0, 1 << 63, (BANDS, ROWS), np.uint64) | np.uint64(1)
_LONGS = BANDS * ROWS * BITS // 64

SIGNED = "doc_id long, n_shingles long, digest binary, bands array<long>, bits array<long>, small array<long>"
_SIGNED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("bands", pa.list_(pa.int64())), ("bits", pa.list_(pa.int64())), ("small", pa.list_(pa.int64()))])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Shingler:
    """Sets of shingle hashes of texts; remembers the hashes of the words seen last."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = ascii_lower(text).split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(words) < WORDS:
            return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
        known = self.known
        if len(known) > CACHED_WORDS:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = len(words) - WORDS + 1
        total = np.zeros(n, np.uint64)
        for i in range(WORDS):
            total += hashes[i : i + n] * _PLACES[i]
        return np.unique(_mixed(total))


def minima(shingles: np.ndarray, n: int = BANDS * ROWS) -> np.ndarray:
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    step = (1 << 18) // n
    parts = [(low[at : at + step, None] * _FACTORS[:n] + _OFFSETS[:n]).min(0) for at in range(0, len(low), step)]
    return np.minimum.reduce(parts)


def band_keys(found: np.ndarray) -> np.ndarray:
    groups = found.reshape(BANDS, ROWS).astype(np.uint64)
    return _mixed((groups * _BAND_PLACES).sum(1) + _BAND_PLACES[:, 0]).view(np.int64)


def low_bits(found: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Bits of all minima, each mixed with its number, packed to 64-bit numbers."""
    own = _mixed(found.astype(np.uint64) << np.uint64(32) | np.arange(1, len(found) + 1, dtype=np.uint64))
    own = (own >> np.uint64(64 - bits)).reshape(-1, 64 // bits)
    return (own << (np.arange(own.shape[1], dtype=np.uint64) * np.uint64(bits))).sum(1, dtype=np.uint64).view(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and, unless the set is empty, its digest, band keys, bits and, if it is small, all of it."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()

        def found() -> Iterator[tuple]:
            for batch in parts:
                for doc_id, text in rows_of(batch):
                    own = shingler(text)
                    if not len(own):
                        yield doc_id, 0, None, None, None, None
                        continue
                    least = minima(own)
                    yield doc_id, len(own), xxhash.xxh3_128_digest(own.tobytes()), band_keys(least), low_bits(least), own.view(np.int64) if len(own) <= SMALL else None

        yield from batches(found(), _SIGNED, size=2048)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, SIGNED)


def estimate(a: str, b: str, bits: int = BITS, longs: int = _LONGS) -> Column:
    """Similarity by counting equal groups of bits, corrected for those that agree by chance."""
    ones = sum(1 << at for at in range(0, 64, bits))
    ones = ones - (1 << 64) if ones >> 63 else ones

    def equal(i: int) -> Column:
        differ = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        some = reduce(lambda x, y: x.bitwiseOR(y), [F.shiftrightunsigned(differ, s) if s else differ for s in range(bits)])
        return F.bit_count(F.bitwise_not(some).bitwiseAND(F.lit(ones).cast("long")))

    share = reduce(lambda x, y: x + y, [equal(i) for i in range(longs)]) / F.lit(float(longs * 64 // bits))
    chance = 1.0 / (1 << bits)
    return (share - chance) / (1 - chance)


def _likely(a: str, b: str) -> Column:
    """Pairs whose sizes allow the threshold and whose estimate comes near it; of two small sets those that are links."""
    small, large = F.least(f"n_{a}", f"n_{b}"), F.greatest(f"n_{a}", f"n_{b}")
    shared = F.size(F.array_intersect(f"small_{a}", f"small_{b}"))
    exact = shared * 100 >= PERCENT * (F.col(f"n_{a}") + F.col(f"n_{b}") - shared)
    near = F.when(_both_small(a, b), exact).otherwise(estimate(f"bits_{a}", f"bits_{b}") >= LEAST_ESTIMATE)
    return (small * 100 >= large * PERCENT) & near


def _both_small(a: str, b: str) -> Column:
    return (F.col(f"n_{a}") <= SMALL) & (F.col(f"n_{b}") <= SMALL)


def _nodes(nodes: DataFrame, name: str) -> DataFrame:
    return nodes.select(F.col("node").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("bits").alias(f"bits_{name}"), F.col("small").alias(f"small_{name}"))


def _only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` with a doc_id in ``ids``, a stored table."""
    few = ids.count() <= BROADCAST_IDS
    return docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text").join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")


def _fine_bits(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """For the documents ``ids`` only: node, fine (one bit of each of many minima), halves (the distinct lower halves of the shingles'
    hashes, of sets that are not too large) and lost (how many halves fell together)."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()

        def found() -> Iterator[tuple]:
            for batch in parts:
                for doc_id, text in rows_of(batch):
                    own = shingler(text)
                    if len(own):
                        halves = np.unique(own.astype(np.uint32).view(np.int32))
                        yield doc_id, low_bits(minima(own, FINE_MINIMA), 1), halves if len(own) <= CARRIED else None, len(own) - len(halves)

        yield from batches(found(), pa.schema([("node", pa.int64()), ("fine", pa.list_(pa.int64())), ("halves", pa.list_(pa.int32())), ("lost", pa.int32())]))

    return stored(_only(docs, ids).mapInArrow(work, "node long, fine array<long>, halves array<int>, lost int"), "fine-sketches")


def _may_link(a: str, b: str) -> Column:
    """False for pairs that share too little: sets share no more than their halves do, and those that fell together."""
    shared = F.size(F.array_intersect(f"halves_{a}", f"halves_{b}")) + F.least(f"lost_{a}", f"lost_{b}")
    enough = shared * 100 >= PERCENT * (F.col(f"n_{a}") + F.col(f"n_{b}") - shared)
    return F.col(f"halves_{a}").isNull() | F.col(f"halves_{b}").isNull() | enough


def _confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are as similar as asked for. Sets are made of the texts of candidates only."""
    wanted = _only(docs, stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "candidate-ids"))

    def shingled(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        found = ((doc_id, shingler(text).tobytes()) for batch in parts for doc_id, text in rows_of(batch))
        yield from batches(found, pa.schema([("doc_id", pa.int64()), ("shingles", pa.binary())]))

    sets = stored(wanted.mapInArrow(shingled, "doc_id long, shingles binary"), "candidate-sets")

    def compared(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links() -> Iterator[tuple]:
            for batch in parts:
                for i in range(batch.num_rows):
                    a, b, x, y = (c[i].as_py() for c in batch.columns)
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    if len(x) and len(y):
                        at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                        shared = int((x[at] == y).sum())
                        if shared * 100 >= PERCENT * (len(x) + len(y) - shared):
                            yield a, b

        yield from batches(links(), pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    one = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    other = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    both = pairs.select("a", "b").join(one.hint("shuffle_hash"), "a").join(other.hint("shuffle_hash"), "b").select("a", "b", "x", "y")
    return stored(both.mapInArrow(compared, "a long, b long"), "links")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, a row for each row of ``docs``.

    Documents are linked if their sets have a similarity of 0.75 or more; the component is the smallest doc_id that links lead
    to. Null and empty texts, and texts without words, have empty sets and are linked with nothing. Fewer than
    five words are one shingle. Rows with one doc_id are one document, with the links of each of them; a row with a
    null doc_id is linked with nothing, has no component and is kept. Texts are shingled whole. Other columns are not read.
    """
    signed = stored(signatures(docs), "signatures")
    real = signed.where("digest is not null and doc_id is not null")
    classes = stored(
        real.groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"), F.first("bits").alias("bits"), F.first("small").alias("small")),
        "shingle-classes",
    )
    nodes = classes.select("node", "n_shingles", "bits", "small", "bands")

    # Buckets of two or more, each member with the bucket's smallest.
    banded = classes.select(F.explode("bands").alias("band"), "node")
    buckets = banded.groupBy("band").agg(F.min("node").alias("pivot"), F.max("node").alias("last")).where("pivot <> last").drop("last")
    members = stored(join_folded(banded, buckets, ["band"], "inner"), "buckets")
    stars = members.where("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    likely = stars.join(_nodes(nodes, "a"), "a").join(_nodes(nodes, "b"), "b").where(_likely("a", "b")).select("a", "b")
    likely = stored(likely.distinct(), "likely-stars")
    links = _confirmed(likely, docs)

    # A doc_id with several texts holds the classes of all of them together.
    several = real.groupBy("doc_id").agg(F.count_distinct("digest").alias("n")).where("n > 1").select("doc_id")
    same = real.join(several, "doc_id", "left_semi").join(classes.select("digest", "node"), "digest").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    links = links.unionByName(same)

    # Pairs of different components in one bucket.
    joined = stored(components(links), "components")
    placed = members.join(joined, "node", "left").select("band", "node", F.coalesce("component", "node").alias("component"))
    mixed = (
        placed.groupBy("band", "component")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("band")
        .agg(F.count(F.lit(1)).alias("kinds"), F.max(F.struct("n", "component"))["component"].alias("main"), F.sum("n").alias("n"))
        .where("kinds > 1")
        .select("band", "main", F.ceil(F.col("n") / TILE).cast("int").alias("tiles"))
    )
    open_members = stored(join_folded(placed, mixed, ["band"], "inner"), "open-buckets")
    fine = _fine_bits(stored(open_members.select(F.col("node").alias("doc_id")).distinct(), "open-nodes"), docs)
    # A doc_id with several texts has a sketch of each; any two rows may meet.
    sketched = open_members.join(nodes.join(fine, "node"), "node")

    def side(own: DataFrame, name: str, tile: Column) -> DataFrame:
        renamed = {"node": name, "component": f"of_{name}", "n_shingles": f"n_{name}"} | {c: f"{c}_{name}" for c in ("bits", "small", "fine", "halves", "lost", "bands", "band")}
        return own.select(tile.alias(f"tile_{name}"), (F.col("component") == F.col("main")).alias(f"main_{name}"), *[F.col(c).alias(n) for c, n in renamed.items()])

    left = side(sketched, "a", F.pmod(F.xxhash64("node"), "tiles").cast("int"))
    right = side(sketched.where("component <> main"), "b", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    same_tile = (F.col("band_a") == F.col("band_b")) & (F.col("tile_a") == F.col("tile_b"))
    # Two members outside the largest component meet twice.
    different = (F.col("of_a") != F.col("of_b")) & (F.col("main_a") | (F.col("a") > F.col("b")))
    likely_fine = _both_small("a", "b") | (estimate("fine_a", "fine_b", 1, FINE_MINIMA // 64) >= LEAST_FINE)
    # A pair comes out of the first band that it shares only.
    first_band = F.array_intersect("bands_a", "bands_b")[0] == F.col("band_a")
    near = F.when(different & _likely("a", "b") & likely_fine, first_band & _may_link("a", "b")).otherwise(False)
    across = left.join(right, same_tile & near).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    across = stored(across.distinct().join(likely, ["a", "b"], "left_anti"), "likely-across")

    # Links between components make components of components.
    known = joined.select("node", "component")
    of = [known.select(F.col("node").alias(n), F.col("component").alias(f"of_{n}")) for n in ("a", "b")]
    between = _confirmed(across, docs).join(of[0], "a", "left").join(of[1], "b", "left")
    between = between.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    merged = components(between).select(F.col("node").alias("component"), F.col("component").alias("top"))
    by_class = (
        classes.select("digest", "node")
        .join(known, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .join(merged, "component", "left")
        .select("digest", F.coalesce("top", "component").alias("component_id"))
    )
    null_id = F.col("doc_id").isNull()
    result = signed.select("doc_id", "n_shingles", "digest").join(by_class, "digest", "left")
    component = F.when(null_id, F.lit(None).cast("long")).otherwise(F.coalesce("component_id", "doc_id"))
    return result.select("doc_id", "n_shingles", component.alias("component_id"), (null_id | (component == F.col("doc_id"))).alias("kept"))


def op6_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group, that with the smallest id."""
    found = near_duplicates(docs.select("doc_id", "text"))
    gone = stored(found.groupBy("doc_id").agg(F.max("kept").alias("kept")).where("not kept").select(F.col("doc_id").alias("__gone")), "near-copies")

    def work(own: DataFrame) -> DataFrame:
        few = gone.count() <= BROADCAST_IDS
        return own.join(F.broadcast(gone) if few else gone, F.col("doc_id").cast("long") == F.col("__gone"), "left_anti")

    return shielded(docs, work)
