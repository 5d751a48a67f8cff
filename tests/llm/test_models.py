"""Scores, predictions, searches, rules and the pipeline."""

import itertools
import math
import re
import time
from collections import Counter

import brute
import numpy as np
import pyarrow.parquet as pq
import pytest
from cases import CLASHING, DOCS, LINE, LONG, empty, frame
from hypothesis import given as drawn
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from shelfline.llm import langid, near_dups, secrets, subword_lm, topk, url_rules
from shelfline.llm.common import held_out
from shelfline.llm.queries import QUERIES

# Exact top-k


def best(vectors, every, k):
    """query_id, rank, vec_id, score, all pairs scored."""
    own = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    found = []
    for n, (query, q) in enumerate(own):
        if query % every:
            continue
        scores = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), i) for m, (i, v) in enumerate(own) if m != n)
        found += [(query, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return Counter(found)


def test_topk_of_awkward_vectors(spark):
    random = np.random.default_rng(8)
    vectors = [(int(i), random.normal(0, 0.2, 12).astype(np.float32).tolist()) for i in random.permutation(300)]
    vectors += [(5000, None), (5001, [None, 1.0]), (5002, [math.nan] * 12), (5003, [math.inf] * 12), (None, [0.1] * 12), (5005, []), (5010, [0.3, -0.2])]
    vectors += [(0, vectors[0][1]), (400, vectors[1][1]), (402, vectors[1][1]), (402, vectors[1][1]), (500, [0.0] * 12), (-10, [100.0] * 12)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumn("score", F.lit("mine")).repartition(3)
    index = topk.build_index(frame, block_rows=64)
    found = topk.search(index, topk.query_blocks(index, every=10, query_rows=7), k=5)
    assert Counter(tuple(r)[1:] for r in found.collect()) == best(vectors, 10, 5)


def test_topk_in_groups_of_queries(spark):
    """Queries aren't joined to blocks, which would hold a copy of them for every share of the index; and blocks lie in small row groups."""
    random = np.random.default_rng(3)
    vectors = [(i % 200, random.normal(0, 0.2, 8).astype(np.float32).tolist()) for i in range(240)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").repartition(1)
    index = topk.build_index(frame, block_rows=2)
    queries = topk.query_blocks(index, every=5, query_rows=3)
    found = topk.search(index, queries, k=3, query_bytes=700)
    assert Counter(tuple(r)[1:] for r in found.collect()) == best(vectors, 5, 3)
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    files = [pq.ParquetFile(f.removeprefix("file://")) for f in index.inputFiles()]
    assert max(f.metadata.num_rows for f in files) > topk.ROW_GROUP
    assert all(f.metadata.row_group(i).num_rows <= topk.ROW_GROUP for f in files for i in range(f.metadata.num_row_groups))


def test_topk_of_few_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    for vectors in ([], [(50, [1.0])], [(50, [1.0]), (7, [-1.0])]):
        index = topk.build_index(spark.createDataFrame(vectors, schema))
        found = topk.search(index, topk.query_blocks(index, every=50))
        assert Counter(tuple(r)[1:] for r in found.collect()) == best(vectors, 50, 5)


def test_topk_of_large_components(spark):
    """Scores are exact up to 64 bits, and stop there."""
    rng = np.random.default_rng(8)
    big = [(i, [float(x) for x in rng.integers(-(10**6), 10**6, 16)]) for i in range(1, 60)]
    huge = [(60, [1e30] * 16), (100, [-1e12, *[0.0] * 15]), (61, [3e6, *[0.5] * 15])]
    frame = spark.createDataFrame(big + huge, "vec_id long, embedding array<double>").repartition(2)
    index = topk.build_index(frame, block_rows=16)
    found = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.search(index, topk.query_blocks(index, every=50), k=5).collect()}
    whole = {i: [min(max(math.floor(x * 256), -(1 << 62)), 1 << 62) for x in v] for i, v in big + huge}
    for query in (50, 100):
        scores = {i: min(max(sum(a * b for a, b in zip(v, whole[query], strict=True)), -(1 << 63)), (1 << 63) - 1) for i, v in whole.items() if i != query}
        best = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:5]
        assert [found[query, n] for n in range(1, 6)] == best


def test_search_stops_before_the_last_segment_and_stays_exact():
    random = np.random.default_rng(9)
    own = np.floor(256 * random.normal(0, 0.125, (2000, 64))).astype(np.int64)
    rows, dims = np.nonzero(own)
    order = np.argsort(-np.abs(own[rows, dims]), kind="stable")
    block = topk.Block(3, 64, np.arange(2000).tobytes(), rows[order].astype(np.int16).tobytes(), dims[order].astype(np.int32).tobytes(), own[rows, dims][order].astype(np.int64).tobytes())
    used = []
    segments = block.segments

    def counted():
        for segment in segments():
            used.append(1)
            yield segment

    block.segments = counted
    exact = own[:20] @ own.T
    for number, at, scores in block.search(own[:20], topk._uids(3, 2000)[:20], 5):
        exact[number, number] = -(10**9)
        assert scores.tolist() == sorted(exact[number].tolist(), reverse=True)[:5]
        assert exact[number][at].tolist() == scores.tolist()
    assert len(used) < len(list(segments()))


# Subword likelihood


def test_lattice_adds_up_all_segmentations():
    pieces = {"▁a": -1.0, "▁": -2.0, "a": -1.5, "ab": -1.2, "b": -2.5, "▁ab": -3.0, "ba": -1.1}
    vocabulary = subword_lm.Vocabulary(pieces, [-6.0] * 256, -1.0)

    def paths(text):
        if not text:
            return 1.0
        total = sum(math.exp(p) * paths(text[len(s) :]) for s, p in pieces.items() if text.startswith(s))
        return total + math.exp(-6.0 * len(text[0].encode())) * paths(text[1:])

    for n in range(1, 6):
        for letters in itertools.product("abé", repeat=n):
            word = "".join(letters)
            assert vocabulary.word(word.encode()) == pytest.approx(math.log(paths("▁" + word)), abs=1e-9)


def check_base(found, docs):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", brute.lower(t or ""))) for i, t in docs]
    counts = Counter()
    for i, own in words:
        if not brute.in_bucket(i, 10, 0):
            counts.update([*own, None])
    total, different = sum(counts.values()), len(counts)
    want = Counter()
    for i, own in words:
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (different + 1))) for w in [*own, None])
        want[i, brute.in_bucket(i, 10, 0), len(own) + 1, sum(counts[w] > 0 for w in [*own, None]), total, round(base, 5)] += 1
    assert Counter((*tuple(r)[:5], round(r["base_score"], 5)) for r in found) == want
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)


def test_scores_of_given_documents(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    check_base(QUERIES["op2_subword_lm"](spark, sf_dir).collect(), docs)


@pytest.mark.parametrize("chunk_words", [100, 1 << 22])
def test_scores_of_awkward_rows(spark, chunk_words):
    training = ~held_out(F.col("doc_id"), 10, 0)
    path = subword_lm.default_tokenizer()
    check_base(subword_lm.score_texts(frame(spark, clashing=CLASHING), path, training, chunk_words).collect(), DOCS)
    assert subword_lm.score_texts(empty(spark), path, training).count() == 0
    check_base(subword_lm.score_texts(frame(spark, DOCS), path, training, chunk_words).collect(), DOCS)
    alone = [(i, t) for i, t in DOCS if brute.in_bucket(i, 10, 0)]
    check_base(subword_lm.score_texts(frame(spark, alone), path, training).collect(), alone)


def test_equal_texts_score_equally_and_likely_ones_higher(spark):
    docs = [(i, "the cat sat on the mat and the dog sat too") for i in range(30)] + [(100, "the cat sat"), (101, "qzx vkj wpf")]
    found = {r["doc_id"]: r["score"] for r in subword_lm.score_texts(frame(spark, docs), subword_lm.default_tokenizer(), F.col("doc_id") < 50).collect()}
    assert len({found[i] for i in range(30)}) == 1
    assert found[100] > found[101]


# Secrets


def spans(found):
    return [(s["kind"], s["start"], s["end"]) for s in found]


SECRETS = [
    "password=hunter2hunter", 'api_key: "abc', "TOKEN = abcd.efgh-1234==", "secret='x' token=12345678 apikey=ABCDEFGH",
    "paſſword=abcdefgh", "AKIA" + "Z" * 12, "AKIA123 AKIA" + "0" * 20, "0123456789abcdef" * 2, "0123456789ABCDEF" * 2, "f" * 31,
    "passwd=password=password=abc", "é" * 5 + "token:ééé token:abcdefgh", "token =\nabcdefgh", 'secret"="abcdefgh"',
]


def test_fixed_patterns(spark):
    docs = DOCS + list(enumerate(SECRETS, 100))
    found = secrets.scan(frame(spark, docs, CLASHING), keep=("doc_id", "text")).collect()
    assert Counter((r["doc_id"], r["text"]) for r in found) == Counter(docs)
    for r in found:
        base = brute.base_spans(r["text"] or "")
        assert spans(r["base"]) == base
        assert set(base) <= set(spans(r["spans"]))
    assert secrets.scan(empty(spark)).count() == 0


def test_random_tokens_are_found_and_prose_is_not(spark):
    random = np.random.default_rng(10)
    word = ["river", "stone", "window", "because", "morning", "under", "there", "nothing", "people", "written"]
    alphabet = np.array(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"))
    docs, planted = [], {}
    for i in range(400):
        before = " ".join(random.choice(word, 30))
        token = "".join(random.choice(alphabet, 40))
        structured = "-".join(random.choice(word, 5)) + "-2024"
        planted[i] = (len(before) + 1, len(before) + 41)
        docs.append((i, f"{before} {token} {' '.join(random.choice(word, 30))} {structured}"))
    found = {r["doc_id"]: [s[1:] for s in spans(r["spans"])] for r in secrets.scan(frame(spark, docs)).collect()}
    assert np.mean([planted[i] in found[i] for i in planted]) > 0.9
    assert np.mean([len(set(found[i]) - {planted[i]}) > 0 for i in planted]) < 0.05


@pytest.mark.parametrize("planted_tokens", [1, 3, 10])
def test_few_random_tokens_of_a_length_are_found(spark, planted_tokens):
    """Keys of all lengths, at the start of texts and one after another, among many that are not random."""
    random = np.random.default_rng(20 + planted_tokens)
    word = ["river", "stone", "window", "because", "Morning", "under", "there", "nothing", "people", "written"]
    alphabet = np.array(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"))
    docs = [(i, " ".join(random.choice(word, 150)) + f" {'-'.join(random.choice(word, 5))}-2024") for i in range(300)]
    planted = {}
    for length in (48, 64, 130, 300, 2000):
        tokens = []
        while len(tokens) < planted_tokens:  # such as the battery takes for random
            token = "".join(random.choice(alphabet, length))
            if secrets.randomness(token)[1] > 0.05:
                tokens.append(token)
        planted[1000 + length] = [(i * (length + 1), i * (length + 1) + length) for i in range(planted_tokens)]
        docs.append((1000 + length, " ".join(tokens)))
    found = {r["doc_id"]: [s[1:] for s in spans(r["spans"])] for r in secrets.scan(frame(spark, docs)).collect()}
    assert {i: found[i] for i in planted} == planted
    assert sum(len(found[i]) for i in range(300)) <= 3


def test_keys_without_digits_and_in_paths_are_found(spark):
    """Letters only, digits only, url-safe after a path, and glued to an identifier."""
    random = np.random.default_rng(30)
    word = ["river", "stone", "window", "because", "Morning", "under", "there", "nothing", "people", "written"]
    letters, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", "0123456789"

    def key(alphabet, n, *holds):
        while True:
            own = "".join(random.choice(list(alphabet), n))
            if all(h in own for h in holds) and secrets.randomness(own)[1] > 0.1:
                return own

    docs = [(i, " ".join(random.choice(word, 150))) for i in range(200)]
    path, name = "/usr/share/objects/windows/river/stone/keys/", "river_stone_window_because_morning_under_nothing_people_"
    keys = {1001: ("", key(letters, 40)), 1002: ("", key(digits, 32)), 1005: ("", key(digits, 100)), 1006: ("", key(letters[26:], 900))}
    keys |= {1003: (path, key(letters + digits + "-_", 86, "-", "_")), 1004: (name, key(letters + digits, 64))}
    docs += [(i, f"{' '.join(word)} {before}{own} {' '.join(word)}") for i, (before, own) in keys.items()]
    found = {r["doc_id"]: [s[1:] for s in spans(r["spans"])] for r in secrets.scan(frame(spark, docs)).collect()}
    for i, (before, own) in keys.items():
        start = len(" ".join(word)) + 1
        assert any(a <= start + len(before) and b == start + len(before) + len(own) for a, b in found[i]), (i, found[i])
    assert sum(len(found[i]) for i in range(200)) == 0


def test_one_text_with_very_many_findings():
    """Base spans and tokens meet in one sweep: 32,000 of each in a few seconds."""
    last, n = {0: 3}, 32_000
    base = [{"start": 100 * i, "kind": 2, "end": 100 * i + 40} for i in range(n)]
    tokens = [{"start": 100 * i + o, "end": 100 * i + o + 25, "class": 0, "step": i % 5} for i in range(n) for o in (20, 45, 70)]
    began = time.monotonic()
    found = secrets.random_spans(base, tokens, last)
    assert time.monotonic() - began < 10
    assert found == [(100 * i + o, 100 * i + o + 25) for i in range(n) if i % 5 <= 3 for o in (45, 70)]


@drawn(st.lists(st.tuples(st.integers(0, 30), st.integers(1, 12), st.integers(0, 3)), max_size=12), st.lists(st.tuples(st.integers(0, 40), st.integers(1, 6)), max_size=4))
def test_random_spans_by_their_definition(tokens, base):
    tokens = [{"start": a, "end": a + n, "class": 0, "step": s} for a, n, s in tokens]
    base = [{"start": a, "kind": 0, "end": a + n} for a, n in base]
    passed = [t for t in tokens if t["step"] <= 1 and not any(b["start"] < t["end"] and t["start"] < b["end"] for b in base)]
    stay = [
        (t["start"], t["end"]) for t in passed
        if not any(o["start"] <= t["start"] and t["end"] <= o["end"] and o["end"] - o["start"] > t["end"] - t["start"] for o in passed)
    ]
    assert secrets.random_spans(base, tokens, {0: 1}) == sorted(stay)


def test_parts_of_runs():
    run = "/keys/of/AbC-d_EfGhIjKlMnOpQr+StUvWxYzAbCdEfGhIjKl"
    parts = {run[a:b] for a, b in secrets.token_spans(run, 0, len(run))}
    assert parts == {run, "AbC-d_EfGhIjKlMnOpQr", "StUvWxYzAbCdEfGhIjKl", "EfGhIjKlMnOpQr+StUvWxYzAbCdEfGhIjKl"}
    assert secrets.token_spans("a" * 30, 0, 30) == [(0, 30)]
    assert [t[:2] for t in secrets.scan_text("x " + "QwErTyUiOpAsDfGhJkLz")[1]] == [(2, 22)]


def test_tail_of_prose_goes_below_one_in_all():
    steps = Counter((40 + 4 * np.random.default_rng(13).standard_normal(5000)).astype(int).tolist())
    p = secrets.p_values(steps)
    assert p == sorted(p) and p[5] < 1e-5 and abs(p[40] - 0.55) < 0.1
    assert secrets.p_values(Counter({30: 3}))[0] == 1 / 4
    steps[0] += 50
    assert secrets.p_values(steps)[0] >= 50 / 5050


def test_battery_accepts_random_and_rejects_patterns():
    random = np.random.default_rng(11)
    values = [secrets.randomness("".join(random.choice(list("0123456789abcdef"), 40)))[1] for _ in range(400)]
    assert 0.3 < np.mean(values) < 0.7
    for text in ("0123456789abcdef" * 3, "0" * 39 + "1", "ab12" * 12):
        assert secrets.randomness(text)[1] < 0.01
    assert secrets.randomness("not of any alphabet!") is None


# Languages


def test_held_out_accuracy(spark, sf_dir):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = QUERIES["op7_langid"](spark, sf_dir).collect()
    assert len(found) == len(lang)
    assert all(r["held_out"] == brute.in_bucket(r["doc_id"], 4, 2) and 0 <= r["score"] <= 1 for r in found)
    apart = [r for r in found if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in apart]) > 0.97
    assert np.mean([r["rejected"] for r in found]) < 0.02


def plain_kneser_ney(texts, size, order=langid.ORDER):
    """Probability of a letter after others, from dictionaries of tuples."""
    grams = Counter(tuple(w) for t in texts for w in langid.windows(t).tolist())
    tables = {}
    for k in range(order, 0, -1):
        ones, twos = sum(n == 1 for n in grams.values()), sum(n == 2 for n in grams.values())
        discount = min(0.95, max(0.05, ones / (ones + 2 * twos) if ones + twos else 0.5))
        totals, types = Counter(), Counter()
        for g, n in grams.items():
            totals[g[:-1]] += n
            types[g[:-1]] += 1
        tables[k] = (grams, totals, types, discount)
        grams = Counter(g[1:] for g in grams)

    def p(gram):
        if not gram:
            return 1 / size
        counts, totals, types, d = tables[len(gram)]
        total = totals[gram[:-1]]
        lower = p(gram[1:])
        return max(counts[gram] - d, 0) / total + d * types[gram[:-1]] / total * lower if total else lower

    return p


def test_probabilities_are_those_of_kneser_ney():
    corpora = [["the cat sat on the mat", "that hat", "a", "the"], ["кот сидел на мате", "тот кот"], ["猫坐在垫子上", "那只猫", "猫"]]
    alphabet = langid.Alphabet.of(Counter(c for own in corpora for t in own for c in t if c.isalpha()))
    encoded = [[alphabet.encode(t) for t in own] for own in corpora]
    models = langid.Models(alphabet, encoded)
    rng = np.random.default_rng(5)
    rows = np.concatenate([*[langid.windows(t) for own in encoded for t in own], rng.integers(0, models.size, (200, langid.ORDER)).astype(np.uint32)])
    found = np.exp2(models.log2(rows))
    for i, own in enumerate(encoded):
        plain = plain_kneser_ney(own, models.size)
        assert found[:, i] == pytest.approx([plain(tuple(r)) for r in rows.tolist()], rel=1e-5)
    # Over all letters after one context they add up to one.
    every = np.repeat(rows[3:4], models.size, 0)
    every[:, -1] = np.arange(models.size)
    assert np.exp2(models.log2(every)).sum(0) == pytest.approx(1, abs=1e-6)


def test_no_letter_and_no_script_is_cut_off(spark):
    """Latin, Cyrillic and Han texts together, with thousands of letters; close languages of a script stay apart."""
    rng = np.random.default_rng(11)

    def letters(first, n):
        found = (chr(first + i) for i in range(2 * n + 200))
        return [c for c in found if c.isalpha() and c.lower() == c][:n]

    alphabets = {"la": letters(0x61, 26), "lb": letters(0x61, 26)[:18], "ca": letters(0x430, 30), "cb": letters(0x430, 30)[6:], "ha": letters(0x4E00, 1500), "hb": letters(0x5200, 1500), "hc": letters(0x7000, 3000)}
    words = {name: ["".join(rng.choice(own, rng.integers(2, 7))) for _ in range(400)] for name, own in alphabets.items()}
    names = list(words)
    docs = [(i, " ".join(rng.choice(words[names[i % len(names)]], 25)), names[i % len(names)]) for i in range(700)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    models = langid.train(frame.where("doc_id % 4 <> 0"))
    assert len(models.alphabet.letters) > 2000
    found = langid.identify(frame.where("doc_id % 4 = 0"), models).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) > 0.97


def test_languages_of_awkward_rows(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    models = langid.train(given.withColumn("text", F.when(F.col("doc_id") % 9 != 0, F.col("text"))))
    found = langid.identify(frame(spark, clashing=CLASHING), models).collect()
    assert Counter((r["doc_id"], r["text"]) for r in found) == Counter(DOCS)
    for r in found:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] in models.names) == letters and (r["lang_pred"] == "und") == (not letters)
        if not letters:
            assert r["rejected"] and r["score"] == 0
    assert langid.identify(empty(spark), models).count() == 0
    nothing = langid.train(empty(spark))
    assert {r["lang_pred"] for r in langid.identify(frame(spark), nothing).collect()} == {"und"}
    one = langid.train(given.where("lang = 'de'"))
    assert {r["lang_pred"] for r in langid.identify(given.where("lang = 'de'"), one).collect()} == {"de"}


# Url rules

URLS = [
    "http://example.net/en/1", "http://EXAMPLE.net/de/", "https://a.b.example.net/en", "http://example.net", "http://notexample.net/en/x",
    "http://example.com/de/x?u=http://example.org/", "http://example.com/fr/", "http://org/fr/", "http://x.org/fr/?q", "ftp://x.org#/fr/",
    None, "", "no host", "://", "://net/", "http://net?/", "http://./en/", "http://a..net/", "http://example.net./en/", "HTTP://Ä.NET/", "http://x.example.net/en/deep/er",
]
MORE_RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.net", "/en/deep/", "block"), ("example.net", "/en/deep/e", "allow"),
    ("b.example.net", "/", "block"), ("example.com", "", "block"), ("example.com", "/de/", "allow"), ("EXAMPLE.com", "/de/", "block"),
    ("org", "/fr/", "allow"), (None, "/", "block"), ("net", None, "block"), ("", "/", "block"),
]


def judged(url, rules):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (brute.lower(m[1]), m[2]) if m else ("", "")
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    top = max(fits, default=None)
    return host, path, top and top[2], top[3] if top else "allow"


@pytest.mark.parametrize("rules", [url_rules.RULES, MORE_RULES, []])
@pytest.mark.parametrize("slice_rows", [1, 512])
def test_url_rules(spark, rules, slice_rows):
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(URLS * 2)], "page_id long, url string, rule string").repartition(3)
    found = url_rules.match_urls(pages, url_rules.rule_table(spark, rules) if rules else spark.createDataFrame([], "host string, path string, verdict string"), slice_rows=slice_rows)
    lowered = [(brute.lower(h), p, v) for h, p, v in rules if h is not None and p is not None]
    want = Counter((i, *judged(u, lowered)) for i, u in enumerate(URLS * 2))
    assert Counter(tuple(r) for r in found.select("page_id", "host", "path", "rule", "verdict").collect()) == want


def test_url_rules_run_without_python(spark, sf_dir):
    plan = QUERIES["op9_url_rules"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)
    assert "Window" in plan


def test_url_rules_beside_columns_of_any_name(spark):
    pages = spark.createDataFrame([("https://a.example.net/en/x", 1, 2, 3), (None, 4, 5, 6)], "url string, best int, node int, `has.dot` int")
    rules = spark.createDataFrame([("net", "/", "block"), ("example.net", "/en/", "allow")], "host string, path string, verdict string")
    found = {r["best"]: (r["node"], r["has.dot"], r["rule"], r["verdict"]) for r in url_rules.match_urls(pages, rules).collect()}
    assert found == {1: (2, 3, "example.net/en/", "allow"), 4: (5, 6, None, "allow")}


def test_hot_host_is_spread(spark):
    """Two thirds of the urls are of one host. They are looked up where they are, and its slices are swept in tasks of their own."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.shuffle.partitions": "32",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        n = F.col("id")
        pages = spark.range(60_000, numPartitions=8).select(
            F.concat(F.lit("http://"), F.when(n % 3 < 2, F.lit("hot.example.net")).otherwise(F.concat(F.lit("h"), (n % 997).cast("string"), F.lit(".org"))), F.lit("/p"), n.cast("string")).alias("url")
        )
        rules = spark.createDataFrame([("example.net", "/p1", "block"), ("org", "/", "block")], "host string, path string, verdict string")
        found = url_rules.match_urls(pages, rules)
        blocked = sum(r["verdict"] == "block" for r in found.collect())
        assert blocked == sum(1 for i in range(60_000) if i % 3 == 2 or str(i).startswith("1"))
        plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert re.search(r"hashpartitioning\(node#\d+, slice#\d+", plan)
        assert sum("BroadcastHashJoin" in x and "node#" in x for x in plan.split("\n")) >= 2
    finally:
        for key in conf:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_url_rules_of_no_pages(spark):
    assert url_rules.match_urls(spark.createDataFrame([], "page_id long, url string"), url_rules.rule_table(spark)).count() == 0


# Pipeline


def test_pipeline(spark, sf_dir):
    """Each stage against a plain version of it on that stage's own input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        after = corpus_pipeline.stored(stage(spark, docs, sf_dir), name)
        if name == "packing":
            assert {r[0] for r in after.select("doc_id").distinct().collect()} == {i for i, _ in before}
            assert Counter(tuple(r) for r in after.select("doc_id", "start", "length").collect()) == Counter(
                tuple(r) for r in corpus_pipeline.run(spark, sf_dir).select("doc_id", "start", "length").collect()
            )
            break
        assert after.columns == columns
        kept = [(r["doc_id"], r["text"]) for r in after.collect()]
        if name == "language_id":
            assert set(kept) <= set(before) and len(kept) > 0.95 * len(before)
        if name == "line_dedup":
            want = {r[0]: r[3] for r in brute.lines(before)}
            assert {i: brute.sha(t) for i, t in kept} == want
        if name == "near_dups":
            assert {i for i, _ in kept} == {r[0] for r in brute.near_duplicates(before) if r[3]}
        if name == "decontamination":
            assert {i for i, _ in kept} == {r[0] for r in brute.contamination(before, items) if not r[5]}
        docs = after


def test_pipeline_of_no_and_of_unlabelled_documents(spark, sf_dir):
    """Without labels nothing can be learned, so only texts without letters go; without documents all stages return none."""
    language = corpus_pipeline.STAGES[0][1]
    bare = frame(spark).withColumn("lang", F.lit(None).cast("string"))
    kept = {r["doc_id"] for r in language(spark, bare, sf_dir).collect()}
    assert kept == {i for i, t in DOCS if any(c.isalpha() for c in t or "")}
    docs = frame(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, sf_dir)
        assert after.count() == 0 and (name == "packing" or after.columns == docs.columns)
        docs = docs if name == "packing" else after


def test_first_and_last_stage_with_awkward_rows(spark, sf_dir):
    odd = frame(spark, DOCS, ["n_words", "__text", "score", "LANG_PRED", "rejected", "start"])
    language, packing_stage = corpus_pipeline.STAGES[0][1], corpus_pipeline.STAGES[-1][1]
    assert language(spark, odd, sf_dir).columns == odd.columns
    pieces = packing_stage(spark, odd, sf_dir)
    assert pieces.select(F.sum("length")).first()[0] == pieces.select("doc_id", "doc_tokens", "start").where("start = 0").agg(F.sum("doc_tokens")).first()[0]


def test_stages_with_awkward_rows(spark, sf_dir):
    odd = frame(spark, DOCS + [(60, LINE + " " + LONG[:500])], ["n_words", "__text", "kept", "component_id", "digest"])
    for _, stage in corpus_pipeline.STAGES[1:4]:
        after = stage(spark, odd, sf_dir)
        assert after.columns == odd.columns
        assert after.count() > 0 and stage(spark, odd.limit(0), sf_dir).count() == 0
    assert {r["n_words"] for r in stage(spark, odd, sf_dir).collect()} == {"mine"}
    assert near_dups.near_dup_stage(spark, odd, sf_dir).where("doc_id is null").count() == 2
