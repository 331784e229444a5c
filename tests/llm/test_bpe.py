import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import AWKWARD, SMALL
from tidemark.llm import bpe as B
from tidemark.llm.lexicon import Lexicon, compile_words


@pytest.fixture(scope="module")
def vocabulary():
    return B.Vocabulary.load(B.default_vocabulary())


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(B.default_vocabulary())
    t.no_truncation()
    t.no_padding()
    return t


def encoder(vocabulary, words=(" the", "the", "a", " don")):
    block = np.frombuffer(B.build_lexicon(list(words), vocabulary), "<i4")
    return B._Encoder(vocabulary, Lexicon(block))


def ids_of(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_ids_equal_the_library(vocabulary, library):
    rng = random.Random(5)
    parts = list("abc '  \n\t\r.,!1２٣é中文ßñ🙂​\x1c\x85#$ªº²Ω'sdlltre") + ["<|endoftext|>", "<|endof", "don't ", " the", "I'LL", " ", "…"]
    cases = ["", " ", "\n\n a", "<|endoftext|>", "x<|endoftext|><|endoftext|> y  <|endoftext|>z", "a" * 3000, "ab" * 300 + " " + "é" * 400, " " * 99 + "x"]
    cases += ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    got = encoder(vocabulary).encode(cases)
    want = [x.ids for x in library.encode_batch(cases, add_special_tokens=False)]
    assert [ids_of(g) for g in got] == want
    back = [x.decode("utf-8", "replace") for x in vocabulary.decode_many(got)]
    assert back == [library.decode(w, skip_special_tokens=False) for w in want]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80))
def test_any_text_equals_the_library(text):
    from tokenizers import Tokenizer

    global _LIB, _ENC
    try:
        _LIB
    except NameError:
        _LIB, _ENC = Tokenizer.from_file(B.default_vocabulary()), encoder(B.Vocabulary.load(B.default_vocabulary()))
    assert ids_of(_ENC.encode([text])[0]) == _LIB.encode(text, add_special_tokens=False).ids


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.binary(min_size=1, max_size=6), st.lists(st.integers(0, 60_000), max_size=4), max_size=40), st.lists(st.binary(max_size=7), max_size=20))
def test_transducer_is_exact_and_minimal(entries, others):
    lexicon = Lexicon(np.frombuffer(compile_words(entries), "<i4"))
    words = sorted(entries)
    assert lexicon.ranks(words).tolist() == list(range(len(words)))
    for rank, w in enumerate(words):
        assert ids_of(lexicon.packed_ids(rank)) == entries[w]
    for w, rank in zip(others, lexicon.ranks(others).tolist()):
        assert (rank >= 0) == (w in entries)
    # minimal: as many states as there are different sets of endings
    ends = {tuple(sorted(w[len(p) :] for w in words if w.startswith(p))) for w in [*words, b""] for p in [w[:i] for i in range(len(w) + 1)]}
    assert lexicon.states == len(ends)


def test_query_equals_the_library(lspark, texts, library):
    got = sorted(tuple(r) for r in B.op10_bpe_encode_decode(lspark, SMALL).collect())
    want = []
    for d, t in texts:
        ids = library.encode(t, add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert got == want


def test_awkward_rows(awkward, nothing, library):
    got = sorted(str((r["doc_id"], ids_of(r["ids"]), r["decoded"])) for r in B.encode(awkward, B.default_vocabulary()).collect())
    want = []
    for d, t, *_ in AWKWARD:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append(str((d, ids, t or "")))
    assert got == sorted(want)
    assert B.encode(nothing, B.default_vocabulary()).collect() == []


def test_summaries_find_frequent_words(lspark, monkeypatch):
    monkeypatch.setattr(B, "SUMMARY", 50)
    rows = [(" ".join(f"rare{i}x{k}" for k in range(40)) + " common" * 30,) for i in range(60)]
    words = B.frequent_words(lspark.createDataFrame(rows, "text string").repartition(3), most=10)
    assert " common" in words and len(words) <= 10
