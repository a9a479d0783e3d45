"""Ids and decoded texts against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from barloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", "b", " ", " ", "'", "’", "\t", "\n", "\r\n", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", " ", "​", "　", "é", "é", "漢字", "🙂", "12", "٣", "²"]
PIECES += ["'s", "'ll", "'re", ".", ",", "!!", "###", "Σ", "ß", "İ", "<|endoftext|>", "<|endof", " the", " and", "ing", "tion", "\n\n", "  "]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_any_text(library):
    random.seed(11)
    with open(PATH, encoding="utf-8") as f:
        codec = bpe.Codec(f.read(), cache_words=50)  # small, so that it is emptied often
    for _ in range(20_000):
        text = "".join(random.choices(PIECES, k=random.randint(0, 16)))
        want = library.encode(text, add_special_tokens=False).ids
        ids = codec.encode(text)
        assert np.frombuffer(ids, np.uint32).tolist() == want, text
        assert codec.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_table(spark, library):
    texts = [None, "", " ", "word", "  two  blanks ", "z" * 60_000, "漢" * 20_000, "a b " * 30_000, "same", "same", "<|endoftext|>"]
    rows = [(i if i != 9 else 8, t, "x") for i, t in enumerate(texts)] + [(None, "no id", "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string")
    got = bpe.encode(docs, PATH)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(((i, *expected(library, t)) for i, t, _ in rows), key=repr)
    ids = {r[0]: (r[1], r[2]) for r in bpe.encode(docs, PATH, output="ids").collect()}
    assert ids[3] == (library.encode("word", add_special_tokens=False).ids, "word") and ids[0] == ([], "")


def test_no_rows(spark):
    assert bpe.encode(spark.createDataFrame([], "doc_id bigint, text string"), PATH).collect() == []
