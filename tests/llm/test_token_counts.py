import random

import public_tokenizers
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from fleetgauge.llm import token_counts
from fleetgauge.llm.tokenizer_files import Encoder

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model")
ODD = [
    "", " ", "\n\n", "  two  spaces ", "tab\tand\r\nline", "it's we'll I'D ''s 'st", "a'b'c", "<|endoftext|>", "x<|endoftext|>y <|startoftext|>",
    "Café e ́ a̸", "각 각", "你好。世界、あ", "123 45six7", "▁ ▁a", "<0x41> <s> </s>",
    "ﬁne Å İstanbul ΣΣ", " nbsp em ls", "e-mail@x.org (a) [b] {c}~d", "\U0001f600\U0001f468‍\U0001f469", "a" * 300, "0123456789" * 30,
]


def library(name):
    if name.endswith(".model"):
        model = SentencePieceProcessor(model_file=public_tokenizers.path(name))
        return lambda t: len(model.encode(t))
    coder = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda t: len(coder.encode(t, add_special_tokens=False))


def encoder(name):
    with open(public_tokenizers.path(name), "rb") as f:
        return Encoder(name, f.read(), False)


def mixed(rng, n):
    return "".join(rng.choice(["word", "It's", " ", "  ", "\n", ".", "x,y", "9", "é", "é", "你", "。", "'", "<|endoftext|>", "_", "\t"]) for _ in range(n))


@pytest.mark.parametrize("name", FILES)
def test_pieces_count_as_the_whole(name):
    rng, count, mine = random.Random(5), library(name), encoder(name)
    texts = ODD + [mixed(rng, rng.randint(1, 120)) for _ in range(300)]
    for size in (4, 9, 40):
        got = token_counts.lengths(mine, pa.array(texts), piece=size, batch=100)
        assert [(t, n) for t, n in zip(texts, got.tolist(), strict=True) if n != count(t)] == []
    assert mine.cut is not None and len(list(mine.pieces("some words and more " * 20, 30))) > 10


def test_long_runs_stay_whole():
    mine = encoder("piece_bpe_32k.model")
    assert list(mine.pieces("x" * 1000, 10)) == ["x" * 1000]
    assert list(mine.pieces("x" * 1000 + " y", 10)) == ["x" * 1000, "y"]


@pytest.mark.parametrize("name", FILES)
def test_rows(spark, name):
    long = "many words of one text, " * 20000
    rows = [(1, t, "en") for t in ODD] + [(None, "no id", "en"), (None, "no id", "en"), (2, None, None), (3, long, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").repartition(3)
    got = token_counts.count_tokens(docs, public_tokenizers.path(name)).collect()
    count = library(name)
    want = [(d, len((t or "").encode()), count(t or "")) for d, t, _ in rows]
    key = lambda r: (r[0] or 0, *r[1:])
    assert sorted((tuple(r) for r in got), key=key) == sorted(((*w, w[2] > 2048) for w in want), key=key)
    assert sum(r.over_limit for r in got) == 1


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id int, text string")
    assert token_counts.count_tokens(docs, public_tokenizers.path(FILES[0])).collect() == []
