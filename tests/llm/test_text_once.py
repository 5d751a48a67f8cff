"""A text that an operator keeps goes to its tasks once, and scoring holds few arrays of a batch's size."""

import tracemalloc

import numpy as np
import pytest

from shelfline.llm import contamination, langid

DOCS = [(i, f"{'abc' if i % 2 else 'xyz'} words of a text {i} " * 5, "ab"[i % 2], "s") for i in range(24)]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string, lang string, source string")


@pytest.fixture
def sent(monkeypatch, docs):
    """Columns that go to tasks."""
    seen = []
    plain = type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, *a, **b: seen.append(self.columns) or plain(self, *a, **b))
    return seen


def test_language_stage_sends_a_text_once(docs, sent):
    models = langid.train(docs)
    found = langid.identify(docs, models).collect()
    assert sent == [["doc_id", "text", "lang", "source"]]
    assert sorted((r.doc_id, r.text, r.lang_pred) for r in found) == [(i, text, lang) for i, text, lang, _ in DOCS]
    # Without the text among the columns that stay, it goes along for the prediction alone.
    alone = langid.identify(docs, models, keep=("doc_id",))
    assert sent[1] == ["doc_id", "__text"] and alone.columns == ["doc_id", "lang_pred", "score", "bits", "rejected"]
    assert sorted((r.doc_id, r.lang_pred, r.score) for r in alone.collect()) == sorted((r.doc_id, r.lang_pred, r.score) for r in found)


def test_decontamination_sends_a_text_once(spark, docs, sent):
    benchmark = spark.createDataFrame([("q", DOCS[3][1])], "item_id string, text string")
    marked = contamination.mark_contamination(docs, benchmark)
    assert sent[-1] == ["doc_id", "text", "lang", "source"]
    assert marked.columns[:4] == sent[-1]
    kept = contamination.mark_contamination(docs, benchmark, keep=("doc_id",))
    assert sent[-1] == ["doc_id", "__text"]
    assert sorted((r.doc_id, r.n_hit, r.n_items) for r in marked.collect()) == sorted((r.doc_id, r.n_hit, r.n_items) for r in kept.collect())


def test_texts_stay_whole_over_several_shards(spark, docs):
    benchmark = spark.createDataFrame([(f"q{i}", DOCS[i][1]) for i in range(4)], "item_id string, text string")
    one, more = (contamination.mark_contamination(docs, benchmark, shard_words=n).collect() for n in (500_000, 20))
    assert sorted(map(str, one)) == sorted(map(str, more))
    assert {(r.doc_id, r.text) for r in more} == {(i, text) for i, text, _, _ in DOCS}


def test_scoring_holds_little():
    letters = np.random.default_rng(1)
    alphabet = langid.Alphabet.of(dict.fromkeys("abcdefghij", 1))
    texts = [letters.integers(0, 12, 60_000).astype(np.uint32) for _ in range(4)]
    models = langid.LanguageModels(alphabet, list("abcd"), langid.Models(alphabet, [[t] for t in texts]), [])
    many = [letters.integers(0, 12, 3_000).astype(np.uint32) for _ in range(250)]
    tracemalloc.start()
    found = models.entropies(many)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    print("peak", peak / 1e6)
    assert found.shape == (250, 4) and peak < 30e6
