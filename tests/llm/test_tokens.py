import base64
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corundum.llm import tokens

TEXTS = [
    "", " ", "\n\n\n", "hello world", "don't we'll I'm", "<|endoftext|> is text", "１２３ ４", "naïve café ß", "漢字かな交じり文", "🙂👨‍👩‍👧", "\x00\x01�", "a" * 5000, " " * 3000 + "x",
    "C1=CC=C(C=C1)[C@@H](N)C(=O)O" * 40, "\t tab\r\n line", "xyz" * 2000 + "ü",
]


@pytest.fixture(scope="module")
def ours():
    return tokens.PrefixEncoder.from_json(tokens.tokenizer_content())


@pytest.fixture(scope="module")
def theirs():
    import tiktoken

    lines = Path(tokens.TOKENIZER_DIR, "byte_bpe_50k.tiktoken").read_bytes().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines)}
    return tiktoken.Encoding("test", pat_str=tokens.WORDS, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("text", TEXTS)
def test_equals_the_library(text, ours, theirs):
    assert ours.encode(text) == theirs.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_equals_the_library_on_any_text(ours, theirs, text):
    assert ours.encode(text) == theirs.encode_ordinary(text)


def test_columns(spark, ours):
    rows = [(1, None), (2, ""), (3, "hello hello"), (3, "hello hello"), (4, "x" * 20_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    content = tokens.tokenizer_content()
    got = [tuple(r) for r in df.select("doc_id", tokens.token_ids(df["text"], content), tokens.token_count(df["text"], content)).collect()]
    assert [(i, ids, n) for i, ids, n in got] == [(i, ours.encode(t), len(ours.encode(t))) for i, t in rows]
    assert df.limit(0).select(tokens.token_ids(df["text"], content)).count() == 0
