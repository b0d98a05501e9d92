"""The word cache against the tokenizer itself."""

import json

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm.queries import TOKENIZER
from millrace.llm.tokens import END, token_ids


@pytest.fixture(scope="module")
def tokens():
    return token_ids(TOKENIZER)


def ids(tokens, text):
    return np.frombuffer(next(tokens.encode([text])), tokens.dtype).tolist()


def test_every_entry_of_the_vocabulary_merges_to_itself(tokens):
    """Then merging by rank of the joined bytes takes the same steps as merging by listed pairs."""
    spec = json.loads(tokens.tokenizer.to_str())
    vocab, added = spec["model"]["vocab"], {x["id"] for x in spec["added_tokens"]}
    model = tokens.tokenizer.model
    for token, i in vocab.items():
        if i in added:
            continue
        if token.endswith("</w>"):
            assert [t.id for t in model.tokenize(token[:-4])] == [i]
        else:
            pieces = model.tokenize(token + chr(0x100))  # a byte that no merge takes
            assert pieces[0].id == i and len(pieces) == 2
    assert END.encode() not in "".join(vocab).encode()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x250), st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'sSİΣ<|")), max_size=60))
def test_as_the_tokenizer(text):
    tokens = token_ids(TOKENIZER)
    assert ids(tokens, text) == tokens.slow(text)


@pytest.mark.parametrize("text", ["<|endoftext|> a<|startoftext|>", "I'LL don't 'S'", "x\x01y", "a b\u0085c", "ΑΣ ας Σ", "", "aaaa" * 400])
def test_hard_cases(tokens, text):
    assert ids(tokens, text) == tokens.slow(text)


def test_null_and_order(tokens):
    got = list(tokens.encode([None, "b a", "", "a"]))
    assert [np.frombuffer(x, tokens.dtype).tolist() for x in got] == [[], tokens.slow("b a"), [], tokens.slow("a")]


def test_generations(tokens, monkeypatch):
    monkeypatch.setattr("millrace.llm.tokens.CACHE_WORDS", 3)
    for text in ("one two three four", "two five six", "one seven two", "eight nine ten one"):
        assert ids(tokens, text) == tokens.slow(text)
