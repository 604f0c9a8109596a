import os

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from foliomill.llm import tokenize

PATH = tokenize.tokenizer_path()
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary")
TEXTS = [
    "", "   ", "\n", "a  b   c \n\n  d\t e  ", "<|endoftext|> x", "foo\x85x y", "it's we'll I'LL", "日本語 ñandú 😀😀", "x" * 3000,
    "ab " * 3000, "a\x00 b \x00", " lead", "tail ", "tail  ", "... ........ ---- =====", "1234567890 12 a1b2", "a\xa0 b \xa0c",
    "399-2018-EPEN-28657, (Fdo.) Garcunar Quedalón",
]


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoder():
    return tokenize.CorpusEncoder(PATH)


def ids(encoder, texts):
    return [np.frombuffer(b, "<i8").tolist() for b in encoder.encode(texts)]


def test_same_ids(encoder, reference):
    assert ids(encoder, TEXTS) == [reference(t) for t in TEXTS]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcdeé ñ\n\t.'-0123456789AZ$sl😀"), max_size=60))
def test_any_text(text):
    from tokenizers import Tokenizer

    t = test_any_text.__dict__.setdefault("t", Tokenizer.from_file(PATH))
    t.encode_special_tokens = True
    assert ids(tokenize.encoder(PATH), [text]) == [t.encode(text, add_special_tokens=False).ids]


def test_full_memory_is_let_go(reference, monkeypatch):
    monkeypatch.setattr(tokenize, "MEMO", 3)
    enc = tokenize.CorpusEncoder(PATH)
    for text in TEXTS:
        assert ids(enc, [text]) == [reference(text)]


def test_rows(spark, reference):
    df = spark.createDataFrame([(1, "hola mundo", 5), (2, None, 6), (3, "", 7), (1, "hola mundo", 5)], "doc_id bigint, text string, ids int")
    got = sorted((r[0], list(r[1])) for r in tokenize.token_ids(df).collect())
    assert got == [(1, reference("hola mundo"))] * 2 + [(2, []), (3, [])]
    counts = sorted(tuple(r) for r in tokenize.token_counts(df.select("doc_id", "text")).collect())
    assert counts == [(1, len(reference("hola mundo")))] * 2 + [(2, 0), (3, 0)]
    assert tokenize.token_ids(df.where("doc_id > 9")).count() == 0
