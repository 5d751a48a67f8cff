"""Operators on documents against plain versions, on given tables and on awkward rows."""

import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from cases import CLASHING, DOCS, LINE, empty, frame
from pyspark.sql import functions as F

import shelfline.llm.line_dedup as line_dedup
import shelfline.llm.repeats as repeats
from compare import connect, differences
from shelfline.llm import contamination, near_dups, packing
from shelfline.llm.queries import QUERIES, SQL


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def given(spark, sf_dir):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", SQL)
def test_sql_says_the_same(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), SQL[name]) == []


# Line deduplication


def digest(df):
    return df.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256))


def test_lines_of_awkward_rows(spark):
    docs = frame(spark, clashing=CLASHING)
    found = line_dedup.dedup_lines(docs, line_dedup.LineIndex.build(docs))
    assert rows(digest(found)) == Counter(brute.lines(DOCS))


def test_lines_without_asking_the_filters(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "FILTER_BYTES", -1)
    docs = frame(spark)
    assert rows(digest(line_dedup.dedup_lines(docs, line_dedup.LineIndex.build(docs)))) == Counter(brute.lines(DOCS))


def test_lines_of_no_documents(spark):
    docs = empty(spark)
    assert line_dedup.dedup_lines(docs, line_dedup.LineIndex.build(docs)).count() == 0


def members(index):
    held = index.counts.where(F.col("n_docs") >= index.min_docs).select("digest", F.lit(0).cast("long").alias("doc_id"))
    return held.count(), index.let_through(held).count()


def test_line_index_is_reversible(spark):
    """Deleting what was inserted restores counts; filters hold all frequent keys at each step."""
    line = [f"line number {i} is long enough to count" for i in range(60)]
    first = [(i, "\n".join(line[j] for j in range(60) if (i * j) % 5 < 2)) for i in range(12)]
    more = [(100 + i, "\n".join(line[i % 7 :: 3])) for i in range(8)]
    index = line_dedup.LineIndex.build(frame(spark, first), shard_keys=8)
    before = rows(index.counts)
    grown = index.insert(frame(spark, more))
    assert rows(grown.counts) == rows(line_dedup.LineIndex.build(frame(spark, first + more)).counts)
    assert len(set(members(grown))) == 1
    assert rows(digest(line_dedup.dedup_lines(frame(spark, first + more), grown))) == Counter(brute.lines(first + more))
    ids = spark.createDataFrame([(i,) for i, _ in more] + [(999_999,)], "doc_id long")
    shrunk = grown.delete(ids)
    assert rows(shrunk.counts) == before
    assert len(set(members(shrunk))) == 1
    assert rows(grown.insert(frame(spark, more)).counts) == rows(grown.counts)


def test_a_document_on_several_rows_is_deleted_at_once(spark):
    line = "this line is long enough to be counted"
    docs = [(1, line), (2, line), (3, line), (3, line + "\nanother line that is long enough"), (4, line)]
    index = line_dedup.LineIndex.build(frame(spark, docs))
    assert {(r.n_docs, r.holder) for r in index.counts.collect()} == {(4, 4), (1, 3)}
    shrunk = index.delete(spark.createDataFrame([(3,)], "doc_id long"))
    assert rows(shrunk.counts) == rows(line_dedup.LineIndex.build(frame(spark, [d for d in docs if d[0] != 3])).counts)
    assert rows(shrunk.insert(frame(spark, docs[2:4])).counts) == rows(index.counts)


def test_cuckoo_filter():
    numbers = np.random.default_rng(1).integers(0, 1 << 63, (5000, 2), np.uint64)
    own = line_dedup.CuckooFilter(len(numbers))
    assert own.insert(numbers) and own.contains(numbers).all()
    others = np.random.default_rng(2).integers(0, 1 << 63, (20_000, 2), np.uint64)
    assert own.contains(others).mean() < 0.002
    own.delete(numbers[:2500])
    assert own.contains(numbers[2500:]).all()
    assert own.contains(numbers[:2500]).mean() < 0.01
    assert not line_dedup.CuckooFilter(8).insert(numbers)


# Packing


def check_pieces(found, docs):
    """Every id in exactly one piece, sequences without gaps and without padding."""
    encoder = packing.encoder(packing.default_tokenizer())
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(packing.default_tokenizer())
    want = defaultdict(Counter)
    for doc_id, text in docs:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]
        want[doc_id][tuple(ids)] += 1
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] > 0
        by_doc[r["doc_id"]].append((r["doc_tokens"], r["start"], tuple(ids.tolist())))
        sequences[r["sequence_id"]].append((r["offset"], r["length"], r["sequence_length"]))
    assert set(by_doc) == set(want)
    for doc_id, pieces in by_doc.items():
        whole = Counter()
        for ids, n in want[doc_id].items():
            whole.update({i: n * c for i, c in Counter(ids).items()})
        assert Counter(i for p in pieces for i in p[2]) == whole
        if sum(want[doc_id].values()) == 1:
            assert tuple(i for p in sorted(pieces, key=lambda p: p[1]) for i in p[2]) == next(iter(want[doc_id]))
    for own in sequences.values():
        end = 0
        for offset, length, size in sorted(own):
            assert offset == end
            end += length
            assert size == max(x[2] for x in own)
        assert end == size <= packing.SEQUENCE and size & (size - 1) == 0
    assert encoder is packing.encoder(packing.default_tokenizer())


def test_packing(spark, sf_dir, given):
    check_pieces(packing.pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), packing.default_tokenizer()).collect(), given)


def test_packing_of_awkward_rows(spark):
    odd = DOCS + [(30, "a <|endoftext|> b<|startoftext|>c x<|endoftext|"), (31, "İstanbul ΣΟΦΟΣ é  x\x1cy"), (32, "it's. Mr.'s ***$$$ 12,5")]
    check_pieces(packing.pack(frame(spark, odd, CLASHING), packing.default_tokenizer(), block_tokens=3000).collect(), odd)
    assert packing.pack(empty(spark), packing.default_tokenizer()).count() == 0


def test_packed_costs_are_balanced():
    sizes = np.random.default_rng(3).integers(1, 4096, 3000).tolist()
    placed, room = packing.pack_block(list(enumerate(sizes)), 4096, 1.0, 1 / 1024)
    cost = np.zeros(len(room))
    for _, taken, at, _ in placed:
        cost[at] += taken + taken * taken / 1024
    in_order = np.cumsum(sizes)
    assert sum(x == 4096 for x in room) == in_order[-1] // 4096
    assert len(placed) < 1.4 * len(sizes)
    full = cost[np.array(room) == 4096]
    assert full.std() < 0.25 * full.mean()


# Near duplicates


def test_near_duplicates(spark, sf_dir, given):
    assert rows(QUERIES["op6_near_dups"](spark, sf_dir)) == Counter(brute.near_duplicates(given))


def test_near_duplicates_of_awkward_rows(spark):
    known = [d for d in DOCS if d[0] is not None and d[0] != 14]
    found = near_dups.near_duplicates(frame(spark, known + [(None, LINE), (None, None)], CLASHING))
    want = Counter((i, n, c, i == c) for i, n, c, _ in brute.near_duplicates(known))
    assert rows(found) == want + Counter([(None, len(brute.shingle_set(LINE)), None, True), (None, 0, None, True)])
    assert near_dups.near_duplicates(empty(spark)).count() == 0


def test_near_duplicates_across_chains_and_large_groups(spark, monkeypatch):
    """Chains of small edits join; a group larger than a tile, with outsiders that share its buckets."""
    monkeypatch.setattr(near_dups, "TILE", 4)
    random = np.random.default_rng(5)
    word = [f"w{i}" for i in range(400)]
    base = random.choice(word, 60).tolist()
    docs = []
    for i in range(40):  # each a few words further from the first
        docs.append((1000 - i, " ".join(base)))
        base[int(random.integers(60))] = f"new{i}"
    for i in range(60):
        own = random.choice(word, 80).tolist() if i % 6 == 0 else own
        edited = list(own)
        for _ in range(int(random.integers(0, 4))):
            edited[int(random.integers(80))] = str(random.choice(word))
        docs.append((i, " ".join(edited)))
    assert rows(near_dups.near_duplicates(frame(spark, docs))) == Counter(brute.near_duplicates(docs))


def test_rows_of_one_id_are_one_document(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    found = {(r[0], r[1]): r[2] for r in near_dups.near_duplicates(frame(spark, [(5, a), (5, b + " x"), (3, a), (4, b + " x")])).collect()}
    assert set(found.values()) == {3}


@pytest.mark.parametrize("core, more", [(3, 1), (6, 2), (12, 4), (21, 7), (30, 10)])
def test_short_texts_among_unlinked_smaller_ids(spark, core, more):
    """Pairs of similarity 0.75; buckets they share hold texts with smaller ids that are linked with neither."""
    docs = []
    for case in range(20):
        base = [f"c{case}w{i}" for i in range(core + 4)]
        docs += [(case * 40 + i, " ".join(base + [f"p{case}n{i}w{j}" for j in range(core * 2 // 3)])) for i in range(30)]
        docs += [(10_000 + 2 * case, " ".join(base)), (10_001 + 2 * case, " ".join(base + [f"b{case}w{j}" for j in range(more)]))]
    found = near_dups.near_duplicates(frame(spark, docs)).where("doc_id >= 10000").collect()
    assert len(found) == 40 and {r["doc_id"]: r["component_id"] for r in found} == {i: i // 2 * 2 for i in range(10_000, 10_040)}


@pytest.mark.parametrize("bits, n", [(1, near_dups.FINE_MINIMA), (near_dups.BITS, near_dups.BANDS * near_dups.ROWS)])
def test_bits_of_different_shingles_agree_by_chance_only(bits, n):
    """Sets of one shingle have minima of that shingle for all functions."""
    for x in np.random.default_rng(14).integers(0, 1 << 63, (50, 2), np.uint64):
        one, other = (near_dups.low_bits(near_dups.minima(x[i : i + 1], n), bits).view(np.uint64) for i in (0, 1))
        places = (np.arange(0, 64, bits, dtype=np.uint64)[None], np.uint64((1 << bits) - 1))
        agree = np.mean((one[:, None] >> places[0] & places[1]) == (other[:, None] >> places[0] & places[1]))
        chance = 0.5**bits
        assert abs(agree - chance) < 5 * (chance * (1 - chance) / n) ** 0.5


def test_estimate_counts_equal_bits(spark):
    random = np.random.default_rng(6)
    shared = random.integers(0, 1 << 63, 4000, np.uint64)
    other = random.integers(0, 1 << 63, 1000, np.uint64)
    a, b = (near_dups.low_bits(near_dups.minima(x)).tolist() for x in (shared, np.concatenate([shared[:3000], other])))
    value = spark.createDataFrame([(a, b)], "a array<long>, b array<long>").select(near_dups.estimate("a", "b")).first()[0]
    assert abs(value - 3000 / 5000) < 0.15
    assert spark.createDataFrame([(a, a)], "a array<long>, b array<long>").select(near_dups.estimate("a", "b")).first()[0] == 1


# Benchmark passages


ITEMS = [
    (1, "one two three four five six seven eight nine ten eleven twelve"), (2, "Two words"), (3, None), (4, ""), (5, "!!!"),
    (6, "émigré-été"), (None, "second"), (1, "aaaa aaaa aaaa aaaa aaaa aaaa aaaa aaaa aaaa aaaa aaaa"), (7, "word1 of1 word2 of2"),
]
TEXTS = DOCS + [
    (40, "x One, two; three four five six seven eight nine TEN eleven y"), (41, "one two three four five six seven eight nine"),
    (42, "two words two words émigré étés émigré Été"), (43, "seconds second"),
]


def contaminated(found):
    return rows(found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256), "contaminated"))


@pytest.mark.parametrize("shard_words", [500_000, 11])
def test_contamination(spark, shard_words):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = contamination.mark_contamination(frame(spark, TEXTS, CLASHING), items, shard_words=shard_words)
    assert contaminated(found) == Counter(brute.contamination(TEXTS, ITEMS))


def test_contamination_of_given_tables(spark, sf_dir, given):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    assert rows(QUERIES["op8_contamination"](spark, sf_dir)) == Counter(brute.contamination(given, items))


def test_benchmark_is_cut_into_bounded_shards(spark):
    """Items on many partitions, one of them longer than a shard; only the last pass is part of the plan."""
    words = [f"w{i}" for i in range(300)]
    own = [(i, " ".join(words[7 * i : 7 * i + 5 + i])) for i in range(25)] + [(99, " ".join(words))]
    items = spark.createDataFrame(own, "item_id long, text string").repartition(6)
    parts = contamination.benchmark_parts(items, shard_words=40).withColumn("n", F.size(F.split(F.col("words").cast("string"), " ")))
    sizes = [r["n"] for r in parts.groupBy("shard").agg(F.sum("n").alias("n")).collect()]
    total = sum(5 + i for i in range(25)) + 300
    assert max(sizes) <= 40 and sum(sizes) >= total and len(sizes) <= 4 * total // 40
    docs = [(i, " ".join(words[i : i + 30])) for i in range(0, 300, 11)] + DOCS
    found = contamination.mark_contamination(frame(spark, docs, CLASHING), items, shard_words=40)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert contaminated(found) == Counter(brute.contamination(docs, own))


def test_contamination_of_nothing(spark):
    no_items = spark.createDataFrame([], "item_id long, text string")
    assert contaminated(contamination.mark_contamination(frame(spark, TEXTS), no_items)) == Counter(brute.contamination(TEXTS, []))
    assert contamination.mark_contamination(empty(spark), spark.createDataFrame(ITEMS, "item_id long, text string")).count() == 0


# Repeated strings


def repeated(found):
    return rows(found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)))


def test_repeats_of_given_documents(spark, sf_dir, given):
    assert rows(QUERIES["op10_repeats"](spark, sf_dir)) == Counter(brute.repeats(given))


@pytest.mark.parametrize("slice_windows, share", [(1 << 19, 1 << 18), (150, 40)])
def test_repeats_of_awkward_rows(spark, slice_windows, share):
    short = [(i, t if len(t or "") < 10_000 else t[:6000] + t[-50:]) for i, t in DOCS]
    assert repeated(repeats.remove_repeats(frame(spark, short, CLASHING), slice_windows, share)) == Counter(brute.repeats(short))


def test_repeats_at_all_overlaps(spark):
    """Passages of 150 to 400 bytes, with multi-byte letters, at random places of random texts."""
    random = np.random.default_rng(7)
    letters = list("abcdefghij éß語")

    def text(n):
        return "".join(random.choice(letters, n))

    passages = [text(n) for n in (150, 180, 199, 200, 201, 230, 400)]
    docs = [(i, text(int(random.integers(0, 300))) + str(random.choice(passages)) + text(int(random.integers(0, 300))) + str(random.choice(passages))) for i in range(120)]
    docs += [(i + 1000, t[3 : len(t) - 3]) for i, t in docs[:20]]
    assert repeated(repeats.remove_repeats(frame(spark, docs))) == Counter(brute.repeats(docs))


@pytest.mark.parametrize("order", [1, -1])
def test_a_settled_share_does_not_answer_for_others(order):
    """A share with two reaches of an anchor, and one with the first of them only, in both orders of the bucket's rows."""
    anchor, reach, flags = np.array([7, 7], np.uint64), np.array([1, 1], np.uint64), np.array([repeats.MIXED, 0], np.uint8)[::order]
    marks, _, _ = repeats._settle(anchor, reach, flags)
    assert marks[flags != repeats.MIXED].tolist() == [repeats.REPEATED | repeats.SHIPPED]


def test_equal_digits_with_unequal_checks_are_told_apart():
    """A confused 64-bit fingerprint does not make a repeat."""
    anchor, reach, check = np.array([7, 7, 7], np.uint64), np.array([1, 1, 1], np.uint64), np.array([5, 9, 5], np.uint32)
    marks, _, several = repeats._settle(anchor, reach, np.zeros(3, np.uint8), check)
    assert several.all() and (marks & repeats.REPEATED > 0).tolist() == [True, False, True] and marks[1] == repeats.SHIPPED
    _, group = repeats._groups(reach, check)
    assert np.bincount(group).tolist() == [2, 1]


def test_digits_and_checks_have_nothing_in_common():
    """Both are equal for equal windows wherever they stand, and differ for others, each in its own way."""
    buffer = np.random.default_rng(3).integers(0, 256, 1400, np.uint8)
    buffer[800:1400] = buffer[200:800]
    digits = repeats.Digits(buffer)
    digit, check = digits.window_digit(np.arange(200, 400))
    again = digits.window_digit(np.arange(800, 1000))
    assert (digit == again[0]).all() and (check == again[1]).all()
    assert len(np.unique(digit)) == len(np.unique(check)) == 200
    bits = np.unpackbits(((digit >> np.uint64(32)).astype(np.uint32) ^ check).view(np.uint8))
    assert 0.45 < bits.mean() < 0.55


@pytest.mark.parametrize("order", [1, -1])
@pytest.mark.parametrize("share", [1, 4, 12])
def test_repeats_of_a_passage_in_several_contexts(spark, share, order):
    """Copies of a text in some shares, and the passage they hold in another context in others."""
    random = np.random.default_rng(12)

    def text(n):
        return "".join(random.choice(list("abcdefghijklmnop"), n))

    passage, docs = text(230), []
    for i in range(6):
        whole = text(300) + passage + text(300)
        docs += [(10 * i, whole), (10 * i + 1, text(250) + passage + text(250)), (10 * i + 2, whole), (10 * i + 3, whole[:700])]
    docs = docs[::order]
    own = spark.createDataFrame(docs, "doc_id long, text string").repartition(5, "doc_id")
    assert repeated(repeats.remove_repeats(own, share_entries=share)) == Counter(brute.repeats(docs))


def test_repeats_of_nothing(spark):
    assert repeats.remove_repeats(empty(spark)).count() == 0


def test_crc_of_ids_is_unsigned(spark, sf_dir):
    row = QUERIES["op5_packing"](spark, sf_dir).agg(F.min("ids_crc32"), F.max("ids_crc32")).first()
    assert row[0] >= 0 and row[1] > 1 << 31
    assert zlib.crc32(b"") == 0
