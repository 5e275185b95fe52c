import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from meterlark.llm import tokenfiles
from meterlark.llm.queries import END_ID, WORD_BPE, op10_token_files


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(WORD_BPE)
    t.no_padding()
    t.no_truncation()
    return t


def check(library, rows, got):
    """Whether all documents are there, in order of their ids, one after the other."""
    want = []
    for k, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, END_ID]
        want.append((k, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    got = sorted(map(tuple, got), key=lambda r: r[1])
    assert sorted(((k, n, crc) for k, _, n, crc in got), key=repr) == sorted(want, key=repr)
    assert [k for k, *_ in got] == sorted((k for k, _ in rows), key=lambda k: (k is not None, k or 0))
    assert [start for _, start, *_ in got] == [sum(n for _, _, n, _ in got[:i]) for i in range(len(got))]
    return got


TEXTS = [None, "", " \n", "Hello wörld it's 42", "a<|endoftext|>b <|ENDOFTEXT|>", "Σ ΑΣ\x85x\xa0y z\x1cw", "é Å 日本語 \U00010d50", "long " * 30000]
ROWS = [(7 * k % 100, t) for k, t in enumerate(TEXTS)] + [(None, "no id"), (None, None), (7, "again"), (7, "again"), (-5, "before")]


def test_any_text_equals_the_library(library):
    rng = random.Random(11)
    ranges = [(33, 127), (33, 127), (0xC0, 0x250), (0x100, 0x180), (0x300, 0x340), (0x370, 0x400), (0x1E00, 0x1F00), (0x2000, 0x2070), (0x3040, 0x3100), (0x1F600, 0x1F640)]
    extra = [" ", " ", "\n", "\t", "\u0130", "i\u0307", "'s", "'", "\xa0", "\x85", "<|", "<|endoftext|>", "...", "DEN\u0130.", "ß", "ẞ", "Σ", "ŉ", "ǅ", "×", "÷"]
    texts = ["".join(rng.choice(extra) if rng.random() < 0.3 else chr(rng.randrange(*rng.choice(ranges))) for _ in range(rng.randint(1, 30))) for _ in range(20_000)]
    texts += ["Ali\u0130, ve DEN\u0130.", *(chr(c) + "," for c in range(0xC0, 0x250)), *(f"a{chr(c)}b!? {chr(c)}" for c in range(0xC0, 0x250))]
    encoder = tokenfiles.LibraryEncoder(WORD_BPE)
    for start in range(0, len(texts), 500):
        part = texts[start : start + 500]
        want = library.encode_batch(part, add_special_tokens=False)
        for text, got, w in zip(part, encoder.packed(part, END_ID), want, strict=True):
            assert np.frombuffer(got, encoder.kind).tolist() == [*w.ids, END_ID], text


def test_files_equal_the_library(spark, library):
    docs = spark.createDataFrame([(k, t, 1) for k, t in ROWS], "doc_id long, text string, start int")
    files = tokenfiles.write(docs, WORD_BPE, END_ID)
    got = check(library, ROWS, tokenfiles.read(spark, files, digests=True).collect())
    ids = {r.start: r.ids for r in tokenfiles.read(spark, files).collect()}
    for _, start, n, crc in got:
        assert len(ids[start]) == n and zlib.crc32(np.array(ids[start], "<u4").tobytes()) == crc


def test_many_files_and_single_documents(spark, library, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check(library, rows, op10_token_files(spark, sf_dir).collect())
    monkeypatch.setattr(tokenfiles, "FILE_BYTES", 5000)
    files = tokenfiles.write(docs, WORD_BPE, END_ID)
    assert files.count() > 8
    check(library, rows, tokenfiles.read(spark, files, digests=True).collect())
    reader = tokenfiles.FileReader(files.orderBy("part", "number").first()["file"])
    k = reader.ids[-1]
    assert reader.tokens(reader.find(k)[-1]).tolist() == [*library.encode(dict(rows)[k], add_special_tokens=False).ids, END_ID]
    assert reader.find(10**9) == []


def test_another_dictionary_is_an_error(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    name = tokenfiles.write(docs, WORD_BPE, END_ID).first()["file"]
    with open(tokenfiles.store(name.rpartition("/")[0])[1] + "/" + tokenfiles.DICTIONARY, "ab") as f:
        f.write(b"x")
    with pytest.raises(ValueError, match="another dictionary"):
        tokenfiles.FileReader(name)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert tokenfiles.read(spark, tokenfiles.write(docs, WORD_BPE, END_ID)).count() == 0
