"""Token counts against the tokenizer library."""

import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillwright.llm import token_counts as op

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
MERGES = op.Merges.load(PATH)


def of_library(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


TEXTS = [
    "", " ", "a", "Hello world", "  two  spaces \n\n\t x", "it's we'll I'D don't", "x" * 3000,
    "ab" * 5000, "é ñ ß 漢字 🙂🙂 ́", "12 345  ½ ²", "<|endoftext|>", "a<|endoftext|> b<|endoftext|>",
    "<|endoftext", "\x00\x1c\x1d\x85\xa0 　 z", "!!! ??? --- ==", "\r\n \r\n", "a​b",
    " ".join(str(i) for i in range(3000)), "the " * 2000, "\n" * 500, " " * 500 + "x",
]


@pytest.mark.parametrize("text", TEXTS)
def test_count(text):
    assert MERGES.count(text) == of_library(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]),
                                  st.sampled_from(" \n'stdaeiou12<|> ")), max_size=60))
def test_random_text(text):
    assert MERGES.count(text) == of_library(text)


def test_full_cache():
    small = op.Merges(MERGES.ranks, MERGES.specials, most_known=3)
    rng = random.Random(1)
    text = " ".join("".join(rng.choices("abcde", k=6)) for _ in range(200))
    assert small.count(text) == of_library(text) and len(small.known) <= 3


def test_rows(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "a b"), (3, None), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "doc_id", "text", "'q' AS n_bytes", "1 AS _body")
    found = op.token_counts(df, PATH, 100).collect()
    want = [(i, len((t or "").encode()), n := of_library(t or ""), n > 100) for i, t in rows]
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)
    assert op.token_counts(df.limit(0), PATH).count() == 0
