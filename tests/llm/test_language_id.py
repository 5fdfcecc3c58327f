from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import language_id as L

PIECES = {"a": 0, "b": 1, "ab": 2, "ba": 3, "aba": 4, "▁": 5, "▁a": 6}
UNKNOWN = len(PIECES)


def segmentations(word):
    if not word:
        yield []
        return
    for k in range(1, len(word) + 1):
        number = PIECES.get(word[:k], UNKNOWN if k == 1 else None)
        if number is not None:
            for rest in segmentations(word[k:]):
                yield [number, *rest]


def test_forward_sums_all_segmentations():
    table = np.random.default_rng(0).random((len(PIECES) + 1, 2)) * 0.1
    words = ["▁abab", "▁aabx", "▁a", "▁", "▁babab", "xyzab"]
    expected = [np.log(sum(np.prod(table[s], axis=0) for s in segmentations(w))) for w in words]
    assert np.allclose(L.Lattice(PIECES).log_probability(words, table), expected)


def test_expected_counts_match_enumeration():
    column = np.random.default_rng(1).random(len(PIECES) + 1) * 0.1
    into = np.zeros(len(PIECES) + 1)
    L.Lattice(PIECES).expected_counts(["▁abab", "▁baba"], np.array([2.0, 1.0]), column, into)
    expected = np.zeros(len(PIECES) + 1)
    for word, n in (("▁abab", 2.0), ("▁baba", 1.0)):
        chances = [(np.prod(column[s]), s) for s in segmentations(word)]
        total = sum(p for p, _ in chances)
        for p, s in chances:
            np.add.at(expected, s, n * p / total)
    assert np.allclose(into, expected)


def test_very_long_words(monkeypatch):
    """Both ways of evaluating a word agree, without underflow."""
    table = np.random.default_rng(3).random((len(PIECES) + 1, 2)) * 0.01
    rng = np.random.default_rng(4)
    words = ["▁" + "".join(rng.choice(list("abx"), size=n)) for n in (1, 2, 3, 900, 1500)]
    lattice = L.Lattice(PIECES)
    expected = [lattice._forward([w], table)[0] for w in words]
    assert np.isfinite(expected).all() and expected[-1][0] < -1000
    monkeypatch.setattr(L, "LONG_WORD", 0)
    assert np.allclose(lattice.log_probability(words, table), expected, rtol=1e-12)


def test_word_memory_bound_does_not_change_scores(monkeypatch):
    pieces = L.load_pieces(L.default_vocabulary())
    rng = np.random.default_rng(2)
    p = rng.random((len(pieces), 2))
    model = L.LanguageModel(L.default_vocabulary(), ["a", "b"], p / p.sum(axis=0), np.array([0.5, 0.5]))
    texts = ["one two three four", "five six one", "seven eight two nine ten"]
    expected = L.TextScorer(model).logs(texts)
    monkeypatch.setattr(L, "CACHED_WORDS", 2)
    scorer = L.TextScorer(model)
    assert np.allclose([scorer.logs([t])[0] for t in texts], expected)
    assert len(scorer.known) <= 2


def corpus():
    en = "the cat sat on the mat and the dog ran to the house of this man"
    de = "die katze lag auf der matte und der hund lief zu dem haus von diesem mann"
    rows = [(i, f"{en} {i}", "en") for i in range(30)] + [(100 + i, f"{de} {i}", "de") for i in range(30)]
    return rows


def test_query_on_odd_rows(spark, make_docs, as_tables):
    odd = [(200, None, "en"), (201, "", "de"), (202, "12 34 !!", None), (None, "the dog and the cat", None),
           (203, "der hund " * 40_000, None), (203, "der hund " * 40_000, None), (204, "x", None)]
    docs = make_docs(corpus() + odd, extra=("lang_pred", "score", "held_out"))
    got = L.op9_language_id(spark, as_tables(documents=docs)).toPandas()
    assert got.columns.tolist() == ["doc_id", "held_out", "lang_pred", "score"]
    assert len(got) == 67
    by_id = got.set_index("doc_id")
    for i in (200, 201, 202):
        assert (by_id.lang_pred[i], by_id.score[i]) == ("und", 0.0)
    assert by_id.lang_pred[203].tolist() == ["de", "de"]
    assert got[got.doc_id.isna()].lang_pred.tolist() == ["en"] and got[got.doc_id.isna()].held_out.tolist() == [False]
    held = got[got.held_out & (got.doc_id < 200)]
    assert len(held) > 5
    assert (held.lang_pred == held.doc_id.map(lambda i: "en" if i < 100 else "de")).all()
    assert got.score.between(0, 1).all()


def test_empty_table_and_nothing_to_learn(spark, make_docs, as_tables):
    assert L.identify(make_docs([]), L.train(make_docs([]), L.learnable())).count() == 0
    docs = make_docs([(1, "some text", None)])
    assert L.identify(docs, L.train(docs, L.learnable())).first()["lang_pred"] == "und"


@pytest.mark.parametrize("table", ["sf0.01"])
def test_held_out_accuracy(spark, table):
    sf = f"/root/testdata/{table}"
    got = L.op9_language_id(spark, sf).join(
        spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.99


def test_languages_without_blanks(spark, make_docs):
    """Whole texts as single words: their languages are learnt all the same."""
    rng = np.random.default_rng(4)
    signs = {"aa": list("人大中一日国本生年月"), "bb": list("のにはをたがでてとし"), "cc": ["ab ", "ba ", "abba "]}
    rows = [(i, "".join(rng.choice(signs[lang], size=int(rng.integers(70, 300)))) + ", 1", lang)
            for i, lang in enumerate(["cc", "aa", "bb"] * 40)]
    learnt, asked = [r for r in rows if r[0] < 90], [r for r in rows if r[0] >= 90]
    model = L.train(make_docs(learnt), F.lit(True))
    told = {r.doc_id: r.lang_pred for r in L.identify(make_docs(asked), model).collect()}
    assert told == {i: lang for i, _, lang in asked}
    long = "".join(rng.choice(signs["aa"], size=150))
    parts = spark.createDataFrame([(long,), ("short",)], "w string").select(L._segments(F.col("w")).alias("s")).collect()
    assert [[(p.word, p.head) for p in r.s] for r in parts] == [
        [(long[:64], True), (long[64:128], False), (long[128:], False)], [("short", True)]]
