import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from meterlark.llm import bpe
from meterlark.llm.queries import WORD_BPE

TEXTS = [
    None, "", " ", "Hello, wörld! it's 123 ñ\n\tend", "a<|endoftext|>b <|startoftext|>", "ΟΔΟΣ ΣΑΣ İstanbul", "\x1c\x1d x\x85y\xa0z",
    "é ﬁ Å 한국어 日本語 🙂🙂 '''s'll", "x" * 3000 + " " + "ab" * 400, "wir haben " * 2000, "\U00010d50 Ᲊ ࢏", "!?!?.,;: 1,2.3 don't",
]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(WORD_BPE)
    t.no_padding()
    t.no_truncation()
    return t


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_round_trip_equals_the_library(spark, library):
    docs = spark.createDataFrame(list(enumerate(TEXTS)) + [(3, TEXTS[3])], "doc_id long, text string").withColumn("ids", bpe.F.lit("clash"))
    lexicon = bpe.fit_lexicon(docs, WORD_BPE, words=20)
    got = sorted(map(tuple, bpe.round_trip(docs, WORD_BPE, lexicon=lexicon).collect()))
    assert got == sorted((k, *expected(library, t)) for k, t in [*enumerate(TEXTS), (3, TEXTS[3])])
    encoded = bpe.encode(docs, WORD_BPE, lexicon=lexicon)
    texts = {r.doc_id: r.decoded for r in bpe.decode(encoded, WORD_BPE).collect()}
    assert texts == {k: library.decode(library.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False) for k, t in enumerate(TEXTS)}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.round_trip(docs, WORD_BPE, lexicon=bpe.fit_lexicon(docs, WORD_BPE)).count() == 0


def test_lexicon_shares_suffixes_and_finds_only_its_words(tmp_path):
    words = [b"thing", b"bring", b"bringing", b"thinging", b"a", b"ab"]
    ids = {w: np.asarray([k, k + 1], "<u4").tobytes() for k, w in enumerate(words)}
    (tmp_path / "lexicon").write_bytes(bpe.build_lexicon(ids))
    lexicon = bpe.Lexicon(str(tmp_path / "lexicon"))
    assert lexicon.find([*words, b"b", b"thingi", b"abc", b"x" * 99]) == [*ids.values(), None, None, None, None]
    assert len(lexicon.final) < sum(map(len, words)) / 2
    (tmp_path / "none").write_bytes(bpe.build_lexicon({}))
    assert bpe.Lexicon(str(tmp_path / "none")).find([b"a"]) == [None]


VOCABULARY = bpe.Vocabulary(WORD_BPE)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_words_equal_the_library_for_any_text(library, text):
    got = bpe.Encoder(VOCABULARY, None).packed([text])[0]
    assert np.frombuffer(got, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_both_ways_of_merging_agree():
    for piece in ("theretionand", "ß" * 15, "aaaaaaaaaaaaaaaaaaaaaaaaa", "!!??!!??!!"):
        raw = np.frombuffer(piece.encode(), np.uint8)
        ids = [*VOCABULARY.inner[raw[:-1]].tolist(), int(VOCABULARY.last[raw[-1]])]
        assert np.frombuffer(VOCABULARY.merged([piece.encode()])[0], "<u4").tolist() == bpe._merge_long(ids, VOCABULARY.merges)
