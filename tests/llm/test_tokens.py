"""Token counts, alignment and ranked search against plain versions."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as public
import pyarrow.parquet as pq
import pytest
import sentencepiece
from cases import CLASHING, DOCS, empty, frame
from hypothesis import given as drawn
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfline.llm import alignment, lexical, token_counts

A_PATH, B_PATH = public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")
ODD = [
    "", " ", "  two  blanks ", "a\n\n b\t \tc", "x <|endoftext|> y<|endoftext|>", "it's we'll 1st 2nd a1b2", " \xa0 nbsp\xa0 b  \xa0\xa0c", "。、好的。好", "\x1c a\x1c!",
    "tab\tline\r\nend ", "</s> <s> <unk> <0x41>", "é" * 50, "🙂 ok 🙂🙂", "no_blank" * 40, "▁ has the mark", "zero\x00byte", "İstanbul ΣΑΣ", " lead", "trail  ",
]


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def given(spark, sf_dir):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


def together(given):
    return DOCS + [(1000 + i, t) for i, t in enumerate(ODD)] + given[:60]


# Token counts


@pytest.fixture(scope="module")
def whole():
    bpe, pieces = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    return {A_PATH: lambda t: len(bpe.encode(t, add_special_tokens=False)), B_PATH: lambda t: len(pieces.encode(t))}


@pytest.mark.parametrize("path", [A_PATH, B_PATH])
def test_token_counts(spark, given, whole, path):
    docs = together(given)
    found = token_counts.count_tokens(frame(spark, docs, clashing=["N_BYTES", "over_limit"]), path, limit=100)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_bytes", "n_tokens", "over_limit"]
    expected = Counter((i, len((t or "").encode()), whole[path](t or ""), whole[path](t or "") > 100) for i, t in docs)
    assert rows(found.select("doc_id", "n_bytes", "n_tokens", "over_limit")) == expected


@pytest.mark.parametrize("path", [A_PATH, B_PATH])
def test_token_counts_of_small_parts_and_batches(spark, given, whole, path):
    own = token_counts.Counter(path)
    assert own.cut is not None
    texts = [t for _, t in together(given)]
    assert own.count(texts, part_bytes=8, batch_bytes=64).tolist() == [whole[path](t or "") for t in texts]
    assert own.count([]).tolist() == []


@settings(max_examples=300, deadline=None)
@drawn(st.text(alphabet="ab1 2\n\t'st.,!<|endoftext|>éß好。的、\xa0▁\x1c", max_size=60), st.integers(1, 12))
def test_parts_have_the_tokens_of_the_text(text, size):
    for path in (A_PATH, B_PATH):
        own = token_counts.counter(path)
        parts = [p for p in token_counts.split_safely(text, own.cut, size) if p]
        assert sum(own.lengths(parts)) == sum(own.lengths([text])), parts


def test_texts_of_other_tokenizers_are_not_split(whole):
    own = token_counts.Counter(public.path("word_bpe_49k.json"))
    assert own.cut is None
    plain = Tokenizer.from_file(public.path("word_bpe_49k.json"))
    assert own.count(ODD, part_bytes=4).tolist() == [len(plain.encode(t, add_special_tokens=False)) for t in ODD]


def test_no_token_counts(spark):
    assert token_counts.count_tokens(empty(spark), A_PATH).count() == 0


# Alignment


@pytest.fixture(scope="module")
def sides():
    a, b = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    a.encode_special_tokens = True
    visible = alignment.byte_alphabet()
    entries = {i: bytes(visible.get(c, 0) for c in t) for t, i in a.get_vocab().items()}

    def encode(text):
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        ids_b = b.encode(text)
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        return [(i, entries[i]) for i in ids_a], list(zip(ids_b, bytes_b, strict=True))

    return encode


def plain_alignment(docs, encode):
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups: every pair of tokens of a document compared."""
    found, held = [], Counter()
    for doc_id, text in docs:
        spans = []
        for tokens in encode(text) if text else ((), ()):
            at, own = 0, []
            for i, value in tokens:
                own.append((i, at, at + len(value)))
                at += len(value)
            spans.append((own, b"".join(v for _, v in tokens)))
        (a, a_bytes), (b, b_bytes) = spans or (((), b""), ((), b""))
        if not text or not a_bytes == b_bytes == (" " + text).encode():
            found.append((doc_id, 0, 0, 0, [], ""))
            continue
        links = []
        low = 0
        for i, s, e in a:
            while b[low][2] <= s:
                low += 1
            j = low
            while j < len(b) and b[j][1] < e:
                links.append((i, b[j][0]))
                j += 1
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, start = [], 0
        at = [0, 0]
        for end in ends:
            part = []
            for n, own in enumerate((a, b)):
                first = at[n]
                while at[n] < len(own) and own[at[n]][2] <= end:
                    at[n] += 1
                part.append(",".join(str(i) for i, _, _ in own[first : at[n]]))
            groups.append("|".join(part))
            start = end
        assert start == len(a_bytes)
        held.update(set(links))
        found.append((doc_id, len(a), len(b), len(groups), links, ";".join(groups)))
    highest = defaultdict(int)
    for (a_id, _), n in held.items():
        highest[a_id] = max(highest[a_id], n)
    return [(i, n_a, n_b, n_g, len(links), sum(held[p] == highest[p[0]] for p in links), sum(held[p] for p in links), g) for i, n_a, n_b, n_g, links, g in found]


@pytest.mark.parametrize("sizes", [{}, {"window": 3000, "block_size": 9000}])
def test_alignment(spark, given, sides, sizes):
    docs = together(given)
    docs = docs + [(2000, "one ▁ mark far in " * 30), (2001, "plain words and " * 30 + "▁"), (2002, "the same"), (2002, "the same")]
    expected = plain_alignment(docs, sides)
    found = alignment.align(frame(spark, docs, clashing=["N_A", "groups", "block"]), A_PATH, B_PATH, whole_groups=True, **sizes).documents()
    assert rows(found) == Counter(expected)
    hashed = alignment.align(frame(spark, docs), A_PATH, B_PATH, **sizes).documents()
    assert rows(hashed) == Counter((*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[1] else "") for r in expected)
    assert {r[0]: r[1] for r in expected if r[0] in (2000, 2001, 1000 + ODD.index("▁ has the mark"))} == dict.fromkeys((2000, 2001, 1000 + ODD.index("▁ has the mark")), 0)


def test_alignment_counts_pairs_by_documents(spark, sides):
    docs = [(1, "the cat"), (2, "the the the"), (None, "the dog"), (2, "the the the"), (3, None), (4, "")]
    found = alignment.align(frame(spark, docs), A_PATH, B_PATH, block_size=20)
    (a_id,) = [i for i, v in sides("the")[0]]
    assert [r["n_docs"] for r in found.pair_counts().where(F.col("a_id") == a_id).collect()] == [4]
    assert rows(found.documents().select("doc_id", "n_links", "count_sum")) == Counter(
        (r[0], r[4], r[6]) for r in plain_alignment(docs, sides)
    )


def test_alignment_empties_its_table(spark, given, sides, monkeypatch):
    known = alignment.Stretches(A_PATH, B_PATH)
    monkeypatch.setattr(alignment, "TABLE_STRETCHES", 10)
    monkeypatch.setattr(alignment.TaskContext, "get", lambda: type("T", (), {"partitionId": lambda self: 0})())
    out = list(alignment._aligned(iter(given[:20]), known, True, 1 << 20, 100))
    assert [(r[0], *r[1:5]) for r in plain_alignment(given[:20], sides)] == [(r[1], *r[2:6]) for r in out]


def test_no_alignment(spark):
    assert alignment.align(empty(spark), A_PATH, B_PATH).documents().count() == 0
    nothing = alignment.align(frame(spark, [(1, None), (2, "")]), A_PATH, B_PATH)
    assert rows(nothing.documents()) == Counter([(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")])


# Ranked search


def plain_ranking(docs, items, k):
    """item_id, rank, doc_id, score: every document scored."""

    def terms(text):
        return Counter(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))

    held = [(i, terms(t)) for i, t in docs]
    held = [(i, own, sum(own.values())) for i, own in held if own]
    total, words = len(held), sum(n for *_, n in held)
    df = Counter(term for _, own, _ in held for term in own)
    found = []
    for item_id, text in items:
        scored = []
        for doc_id, own, n in held:
            m = 100 - 25 + 25 * n * total // words
            score = sum(
                times * math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (1_000_000_000 * own[t] // (1000 * own[t] + 12 * m)) for t, times in terms(text).items() if t in own
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        found += [(item_id, rank, best[3], -best[0]) for rank, best in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return found


def frame_of_items(spark, items):
    return spark.createDataFrame([(t, i, "x") for i, t in items], "text string, item_id long, score string")


ITEMS = [(1, "copies of one text are here"), (1, "copies of one text are here"), (2, None), (3, ""), (4, "!!"), (None, "word1 of2 aaaa aaaa"), (5, "nowhere-found qqq"), (6, "ÉTÉ émigré 語 zero id NEGATIVE")]


@pytest.mark.parametrize("sizes", [{}, {"area": 64, "held_entries": 200}, {"area": 4000, "held_entries": 1 << 20}])
def test_ranking_of_awkward_rows(spark, given, sizes):
    docs = together(given)
    index = lexical.build_index(frame(spark, docs, clashing=["score", "RANK", "block"]), **sizes)
    for k in (1, 3, 20):
        found = lexical.search(index, frame_of_items(spark, ITEMS), k)
        assert rows(found) == Counter(plain_ranking(docs, ITEMS, k))


def test_ranking_in_groups_of_queries(spark, sf_dir, given):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    index = lexical.build_index(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    found = lexical.search(index, frame_of_items(spark, items), query_terms_at_once=200)
    assert rows(found) == Counter(plain_ranking(given, items, 20))


def test_bounds_hold_and_few_documents_are_scored(spark, sf_dir, given):
    """Upper bounds are no lower than scores; most documents are left out on proof."""
    index = lexical.build_index(spark.read.parquet(f"{sf_dir}/documents.parquet").coalesce(1))
    n_docs, n_words = index.agg(F.sum("n_terms"), F.sum("n_words")).first()
    terms = [tuple(r) for r in lexical.document_counts(index).collect()]
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for t, df in terms}
    rng = np.random.default_rng(3)
    texts = [lexical.terms_of(t) for _, t in given]
    asked = []
    for item in range(20):
        own = texts[rng.integers(len(texts))]
        asked += [(item, t, weight[t]) for t in {own[i].decode() for i in rng.integers(0, max(1, len(own)), 12) if len(own)} if weight[t] > 0]
    queries = lexical.Queries(asked, n_docs, n_words)
    best = [lexical.Best(3) for _ in queries.items]
    scored = total = 0
    for row in index.collect():
        block = lexical.Block(row.asDict(), queries)
        for (own, weights), bounds in zip(queries.own, block.bounds(queries, 0, len(block.ids)), strict=True):
            assert (bounds >= block.scores(np.arange(len(block.ids)), own, weights)).all()
        scored += lexical.search_block(block, queries, best)
        total += len(block.ids) * len(queries.items)
    assert scored < 0.3 * total


def test_no_ranking(spark):
    nothing = lexical.build_index(empty(spark))
    assert lexical.search(nothing, frame_of_items(spark, ITEMS)).count() == 0
    index = lexical.build_index(frame(spark))
    assert lexical.search(index, frame_of_items(spark, [])).count() == 0
    assert lexical.search(lexical.build_index(frame(spark, [(1, None), (2, "?!")])), frame_of_items(spark, ITEMS)).count() == 0


def test_lexical_blocks_lie_in_small_row_groups(spark):
    """A reader holds the blocks of a whole row group, several megabytes each, at once."""
    docs = frame(spark, [(i, f"word{i} and other{i % 7} words") for i in range(400)]).coalesce(1)
    index = lexical.build_index(docs, area=64)
    files = [pq.ParquetFile(f.removeprefix("file://")) for f in index.inputFiles()]
    assert max(f.metadata.num_rows for f in files) > lexical.ROW_GROUP
    assert all(f.metadata.row_group(i).num_rows <= lexical.ROW_GROUP for f in files for i in range(f.metadata.num_row_groups))
