"""Ids from remembered words equal ids of whole texts."""

import struct

import duckdb
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tickloom.llm.tokens import WordEncoder

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
PAIRS = {f: (WordEncoder(public_tokenizers.path(f), memory=500), Tokenizer.from_file(public_tokenizers.path(f))) for f in FILES}
CASES = [
    "", " ", "\n", "a  b", "a\n\nb", " a", "a ", "a \n b", "a\tb c", "it's they'LL we've 's", "x<|endoftext|>y <|startoftext|> z",
    "café café İstanbul ΣΑΣ ß", "a b   c", "12 345 6a7 b8", "a\x1cb \x1c c", "\r\nx\r\n", "日本語 の 文", "🙂 🙂🙂 a🙂",
    "word... (two) [three] \"four\" five!? six|", "́ a ̸b", "a" * 300 + " " + "b" * 300, "<|endoftext|>", "é. è, Ê!!", "\x00 a \x7f",
]


def ids(data: bytes) -> list[int]:
    return list(struct.unpack(f"<{len(data) // 4}I", data))


@pytest.mark.parametrize("name", FILES)
def test_styles_are_known(name):
    assert PAIRS[name][0].style in ("spaces", "words")


@pytest.mark.parametrize("name", FILES)
def test_cases(name):
    mine, whole = PAIRS[name]
    for text in CASES:
        assert ids(mine.encode(text)) == whole.encode(text, add_special_tokens=False).ids, text
    assert mine.encode(None) == b""


@pytest.mark.parametrize("name", FILES)
def test_documents(name, sf_dir):
    mine, whole = PAIRS[name]
    for (text,) in duckdb.sql(f"select text from '{sf_dir}/documents.parquet'").fetchall():
        assert ids(mine.encode(text)) == whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab Zé́'.!s\n\t  \r1<|>"), st.characters(exclude_categories=["Cs"])), max_size=30))
def test_any_text(name, text):
    mine, whole = PAIRS[name]
    assert ids(mine.encode(text)) == whole.encode(text, add_special_tokens=False).ids
