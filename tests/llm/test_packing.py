from __future__ import annotations

import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm import packing as K

FULL = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
ENCODE = K.Encoder()


def ids_of(text):
    return FULL.encode(text or "", add_special_tokens=False).ids


@given(st.lists(st.text(alphabet="ab 1.'s\n\t é日😀\x1c\x0b ɐ", max_size=16), max_size=4))
@settings(max_examples=300, deadline=None)
def test_encoder_equals_tokenizer(texts):
    got = [np.frombuffer(b, "<u4").tolist() for b in ENCODE(texts)]
    assert got == [ids_of(t) for t in texts]


@given(st.text(max_size=40))
@settings(max_examples=200, deadline=None)
def test_encoder_on_any_text(text):
    assert np.frombuffer(ENCODE([text])[0], "<u4").tolist() == ids_of(text)


def test_encoder_beyond_its_memory(monkeypatch):
    monkeypatch.setattr(K, "CACHED_WORDS", 3)
    encode = K.Encoder()
    texts = ["one two three four five", "six two seven <|endoftext|> x", "five four  three", None, ""]
    for _ in range(2):
        assert [np.frombuffer(b, "<u4").tolist() for b in encode(texts)] == [ids_of(t) for t in texts]


@given(st.lists(st.text(alphabet="ab 1.'s\n\t é\x1c\x85\xa0ɏɐ日", max_size=30), max_size=6))
@settings(max_examples=200, deadline=None)
def test_ids_are_put_in_place_in_steps(texts):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(K, "GATHERED_WORDS", 2)
        assert [np.frombuffer(b, "<u4").tolist() for b in ENCODE(texts)] == [ids_of(t) for t in texts]


def test_many_different_words_cost_far_less_than_whole_texts():
    rng = random.Random(3)
    parts = "th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le".split()
    words = ["".join(rng.choices(parts, k=rng.randint(2, 6))) for _ in range(300_000)]
    common = words[:3000]
    texts = [" ".join(rng.choice(common) if rng.random() < 0.7 else rng.choice(words) for _ in range(500)) for _ in range(1000)]
    took = {"whole": [], "words": []}
    for _ in range(3):
        encode = K.Encoder()
        start = time.process_time()
        got = encode(texts)
        took["words"].append(time.process_time() - start)
        start = time.process_time()
        expected = [encode._encode(t) for t in texts]
        took["whole"].append(time.process_time() - start)
        assert got == expected
        assert not encode.known         # no familiar word is held
    assert min(took["words"]) < 0.65 * min(took["whole"]), took


@given(st.integers(1, 60).flatmap(lambda room: st.tuples(
    st.just(room), st.dictionaries(st.integers(1, room), st.integers(1, 40), max_size=12))))
@settings(max_examples=300, deadline=None)
def test_plan_is_best_fit_decreasing(case):
    room, counts = case
    fill, ranks = defaultdict(list), defaultdict(list)
    for length, lo, hi, each, sequence, offset in K.best_fit(counts, room):
        for q in range(lo, hi + 1):
            fill[sequence + (q - lo) // each].append((offset + (q - lo) % each * length, length))
            ranks[length].append(q)
    assert {k: list(range(n)) for k, n in counts.items()} == dict(ranks)
    for held in fill.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= room
    bins = []
    for length in sorted(Counter(counts).elements(), reverse=True):
        fits = [i for i, free in enumerate(bins) if free >= length]
        if fits:
            bins[min(fits, key=lambda i: bins[i])] -= length
        else:
            bins.append(room - length)
    assert len(bins) == len(fill)


@pytest.mark.parametrize("n,expected", [(1, [(0, 1)]), (1024, [(0, 1024)]), (1025, [(0, 1), (1, 1024)]),
                                        (2048, [(0, 1024), (1024, 1024)])])
def test_pieces(n, expected):
    assert K.pieces_of(n, 1024) == expected


def test_query_round_trip(spark, make_docs, as_tables):
    rows = [(1, "hello world " * 600), (2, None), (3, ""), (4, "x"), (4, "x"), (None, "no id"), (5, "word " * 1023),
            (6, "long text, " * 20_000)] + [(10 + i, "some words here " * (i % 7)) for i in range(60)]
    docs = make_docs(rows, extra=("length", "task", "piece"))
    got = K.op3_packing(spark, as_tables(documents=docs)).toPandas()
    assert got.columns.tolist() == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    expected = Counter()
    for i, text in rows:
        ids = [*ids_of(text), 2]
        head = len(ids) if len(ids) <= 1024 else (len(ids) % 1024 or 1024)
        for n, start in enumerate([0, *range(head, len(ids), 1024)]):
            part = ids[start:(head if n == 0 else start + 1024)]
            expected[i, n, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    found = Counter((None if np.isnan(r.doc_id) else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32)
                    for r in got.itertuples())
    assert found == expected
    for _, s in got.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s.offset.tolist() == [0, *s.length.cumsum().tolist()[:-1]] and s.length.sum() <= 1024
    with_ids = K.pack(make_docs(rows[:4]), with_ids=True).toPandas()
    assert (with_ids.ids.map(len) == 4 * with_ids.length).all()
    assert K.pack(make_docs([])).count() == 0
