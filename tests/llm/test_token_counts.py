from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from llm import token_counts as K

MODEL = public_tokenizers.path("piece_bpe_32k.model")
FULL = sentencepiece.SentencePieceProcessor(model_file=MODEL)
COUNT = K.merges()


def expected(texts):
    return [len(FULL.encode(t)) if t else 0 for t in texts]


@given(st.lists(st.text(alphabet="aben  ▁tiouhr\n\t.é日<s>0\x00😀", max_size=40), max_size=5))
@settings(max_examples=400, deadline=None)
def test_equals_library(texts):
    assert COUNT(texts) == expected(texts)


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_any_text(text):
    assert COUNT([text]) == expected([text])


@given(st.text(alphabet="aelinst", max_size=300))
@settings(max_examples=300, deadline=None)
def test_long_letter_runs(text):
    assert COUNT([text]) == expected([text])


def test_random_pieces_joined():
    rng = random.Random(3)
    pieces = [FULL.id_to_piece(i).replace(K.BLANK, " ") for i in range(259, 32_000)]
    texts = ["".join(rng.choices(pieces, k=40)) for _ in range(400)]
    assert COUNT(texts) == expected(texts)


@pytest.mark.parametrize("text", [
    "", " ", "   ", " " * 15, " " * 16, " " * 17, " " * 33, " " * 50 + "word", "x" + " " * 5000 + "y  z", "a" * 20_000, "ab" * 10_000,
    "=" * 3000, "\n" * 3000, "<s> </s> <unk> <0x41> <|endoftext|>", "naïve ﬁ ①", "日本語" * 2000, "▁▁x", "the" * 7000])
def test_runs(text):
    assert COUNT([text, None, text]) == [*expected([text]), 0, *expected([text])]


@pytest.mark.parametrize("blanks", range(30, 120, 7))
@pytest.mark.parametrize("tail", ["", "w", "\n", "日"])
def test_blank_runs(blanks, tail):
    assert COUNT(["q" + " " * blanks + tail]) == expected(["q" + " " * blanks + tail])


def test_long_runs_take_no_time():
    assert COUNT.blank_run == 16
    assert COUNT([" " * 1_000_000 + "x"])[0] == expected([" " * 3200 + "x"])[0] + (1_000_000 - 3200) // 16


def test_slices_parts_and_memory(monkeypatch):
    rng = random.Random(5)
    words = ["".join(rng.choices("etaoinshrdlu1X日", k=rng.randint(1, 12))) for _ in range(300)]
    text = "".join(rng.choice([" ", "  ", "", "\n"]) + w for w in rng.choices(words, k=3000))
    want = expected([text, text[:500], ""])
    for name, value in (("SLICE_CHARS", 50), ("PART_CHARS", 5), ("CACHED_WORDS", 7)):
        monkeypatch.setattr(K, name, value)
        assert K.Merges(MODEL)([text, text[:500], ""]) == want


def test_one_by_one():
    """Steps equal the merges one at a time, on a vocabulary whose ranks are in no trained order."""
    rng = random.Random(11)
    for _ in range(300):
        m = object.__new__(K.Merges)
        pieces = {"a": 0, "b": 1, "c": 2}
        while len(pieces) < 12:
            pieces.setdefault("".join(rng.choices(list(pieces), k=2)), len(pieces))
        names = list(pieces)
        ranks = {p: rng.randint(0, 4) for p in names}
        m.width = len(names)
        pairs = {pieces[p[:i]] * m.width + pieces[p[i:]]: (ranks[p], pieces[p]) for p in names for i in range(1, len(p))
                 if p[:i] in pieces and p[i:] in pieces}
        m.keys = np.array(sorted(pairs), dtype=np.int64)
        m.ranks, m.made = (np.array([pairs[k][i] for k in sorted(pairs)], dtype=np.int32) for i in (0, 1))
        m.emits = np.ones(m.width, dtype=np.int64)
        texts = ["".join(rng.choices("abc", k=rng.randint(1, 14))) for _ in range(8)]
        want = []
        for t in texts:
            now = list(t)
            while True:
                best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(now, now[1:])) if a + b in pieces), default=None)
                if best is None:
                    break
                i = best[1]
                now[i:i + 2] = [now[i] + now[i + 1]]
            want.append(len(now))
        sym = np.array([pieces[c] for t in texts for c in t], dtype=np.int32)
        owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        out = np.zeros(len(texts), dtype=np.int64)
        m._merge(sym, owner, np.diff(owner, prepend=-1) > 0, out)
        assert out.tolist() == want


def test_query(spark, make_docs, as_tables):
    rows = [(1, "hello world " * 3000), (2, None), (3, ""), (4, "x"), (4, "x"), (None, "no id <s>"), (5, "日本 " * 4000),
            *[(10 + i, "some words here, " * i) for i in range(40)]]
    docs = make_docs(rows, extra=("n_tokens", "n_bytes", "over_limit")).repartition(3)
    got = K.op12_token_counts(spark, as_tables(documents=docs))
    assert got.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    want = [(i, len((t or "").encode()), n, n > 4096) for (i, t), n in zip(rows, expected([t for _, t in rows]))]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert K.count_tokens(make_docs([])).count() == 0
